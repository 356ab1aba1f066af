"""Benchmark decontamination: CGK embedding, repeated bit-sampling LSH, exact edit distance.

The CGK random walk reads a sequence with a pointer that, after each output,
moves on by a random bit of (step, symbol): sequences at small edit distance
give outputs at small Hamming distance. Symbols are words (lower case, cut at
white space and ASCII punctuation).

*Index.* Items fall into length classes. From every offset of an item at which
an item-sized walk still fits, the walk is taken ``tables`` times and ``SAMPLED``
of its outputs are hashed into a key. Tables are added until, in every class, a share
``recall`` of seeded copies of the items with ``DESIGN_RATIO`` edits is met by at least one.

*Query.* Every document walks from every ``STRIDE``-th of its own words, and for
classes whose items may hold fewer offsets than that (under 9 words) from every
word: any alignment meets an offset of the index, the first one in short classes. A
walk stays at the end of its text or item, so a text's neighbours do not change its
keys. A window whose key is in the index is a candidate; the exact edit distance of
the whole item to the words around it decides: at most ``max_ratio`` of the item's words.

Documents stay where they are: no shuffle. Items are broadcast in blocks of
``BLOCK_WORDS`` words at most; more items mean more passes in the same tasks.

Null or wordless texts are clean; null or wordless items match nothing; equal
items are all reported. Repeated rows are judged alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RATIO = 0.2
DESIGN_RATIO = MAX_RATIO
RECALL = 0.95
STRIDE = 4
SAMPLED = 6
#: Words of the longest walk; longer items are found by any such part of them.
LONGEST = 128
#: Words of items held by a task at a time.
BLOCK_WORDS = 500_000
#: Bytes of documents handled together.
BLOCK_BYTES = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[:48] = 32
_FOLD[58:65] = _FOLD[91:97] = _FOLD[123:128] = 32
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER_CACHE: dict[str, np.ndarray] = {}


def _power_tables(n: int):
    if len(_POWER_CACHE.get("p", ())) < n:
        _POWER_CACHE["p"], _POWER_CACHE["q"] = _powers(_P, n), _powers(_P_INV, n)
    return _POWER_CACHE["p"][:n], _POWER_CACHE["q"][:n]


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(29)
    return x


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the first word of each text (one more at the end)."""
    data = _FOLD[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    is_word = data != 32
    edge = np.diff(np.concatenate(([0], is_word.astype(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    p, q = _power_tables(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p, dtype=np.uint64)))
    h = _mix((sums[end] - sums[start]) * q[start], 17)
    lens = np.array([len(t) + 1 for t in texts])
    first = np.searchsorted(start, np.cumsum(lens) - lens)
    return h, np.append(first, len(h))


def length_class(n: int) -> int:
    """Least length of the class that ``n`` words fall into: ratios of 1.5 from 4 up."""
    low = 4
    while low * 3 // 2 <= min(n, LONGEST):
        low = low * 3 // 2
    return min(low, n)


def stride(low: int) -> int:
    """Words between the starts for class ``low``: its shortest items hold ``low`` words."""
    return STRIDE if len(offsets(low, low)) >= STRIDE else 1


def offsets(n: int, low: int) -> range:
    """Offsets of an item of ``n`` words from which walks of class ``low`` are taken."""
    return range(n - (3 * low + 4) // 5 + 1)


def spaced(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``words`` with the end mark 0 after each text, and where each text then begins."""
    return np.insert(words, first[1:], np.uint64(0)), first + np.arange(len(first))


def starts(first: np.ndarray, step: int) -> np.ndarray:
    """Every ``step``-th word of each text of :func:`spaced`, from the text's own first word."""
    within = np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))
    mark = np.zeros(first[-1], dtype=bool)
    mark[first[1:] - 1] = True
    return np.flatnonzero((within % step == 0) & ~mark)


class Walks:
    """The random walks of ``tables`` repetitions for length classes ``lows``."""

    def __init__(self, lows: list[int], tables: int, seed: int = 5):
        self.lows, self.tables, self.seed = sorted(lows), tables, seed
        # a table's samples depend on nothing else, so tables keep what was measured on them
        self.samples = [{low: np.sort(np.random.default_rng((seed, table, low)).choice(low, min(SAMPLED, low), replace=False))
                         for low in self.lows} for table in range(tables)]

    def keys(self, words: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(table, class, key of each start ``at``): one walk serves all classes. ``words`` are
        :func:`spaced`; a walk that comes to an end mark stays there."""
        steps = self.lows[-1] if self.lows else 0
        ends = np.flatnonzero(words == 0)
        for table, samples in enumerate(self.samples):
            pos = at.copy()
            keys = {low: np.full(len(at), np.uint64(low)) for low in self.lows}
            for j in range(steps):
                if j % 64 == 0:
                    bits = _mix(words, self.seed * 1_000_003 + table * 1009 + j // 64 + 1)
                    bits[ends] = 0
                for low in self.lows:
                    if j < low and j in samples[low]:
                        keys[low] = (keys[low] * np.uint64(_P)) ^ words[pos]
                if j + 1 in self.lows:
                    yield table, j + 1, _mix(keys[j + 1], table)
                pos += ((bits[pos] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)


class Index:
    """Keys of every offset of the items, by table and class."""

    def __init__(self, items: list[tuple[object, np.ndarray]], recall: float, max_ratio: float,
                 tables: int | None = None):
        self.items, self.max_ratio = items, max_ratio
        groups: dict[int, list[int]] = {}
        for k, (_, w) in enumerate(items):
            if len(w):
                groups.setdefault(length_class(len(w)), []).append(k)
        self.tables = tables or self._tables(groups, recall)
        self.walks = Walks(list(groups), self.tables)
        self.entries = {}
        for low, members in groups.items():
            words, first = self._joined([items[k][1] for k in members])
            item, offset, at = [], [], []
            for k, base in zip(members, first.tolist()):
                for o in offsets(len(items[k][1]), low):
                    item.append(k)
                    offset.append(o)
                    at.append(base + o)
            item, offset = np.array(item), np.array(offset)
            for table, c, keys in self._only([low]).keys(words, np.array(at)):
                order = np.argsort(keys, kind="stable")
                bits = max(10, (16 * len(keys)).bit_length())
                seen = np.zeros(1 << bits, dtype=bool)
                seen[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
                self.entries[table, c] = (keys[order], item[order], offset[order], seen, bits)

    @staticmethod
    def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return spaced(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))

    def _only(self, lows: list[int]) -> Walks:
        one = Walks.__new__(Walks)
        one.lows, one.tables, one.seed = lows, self.tables, self.walks.seed
        one.samples = self.walks.samples
        return one

    def _tables(self, groups: dict[int, list[int]], recall: float) -> int:
        """Tables needed so that a share ``recall`` of the seeded copies with ``DESIGN_RATIO`` edits is
        met by one of them at least, in the class where that is hardest."""
        rng = np.random.default_rng(23)
        need = 1
        for low, members in groups.items():
            picked = [members[i % len(members)] for i in range(max(200, len(members)))]
            if len(picked) > 400:
                picked = rng.choice(picked, 400, replace=False).tolist()
            copies = []
            for k in picked:
                w = list(self.items[k][1])
                for _ in range(int(DESIGN_RATIO * len(w))):
                    i, kind = int(rng.integers(len(w))), int(rng.integers(3))
                    new = np.uint64(rng.integers(1 << 62))
                    w[i:i + 1] = [[new], [], [w[i], new]][kind]
                around = rng.integers(1, 1 << 62, int(rng.integers(STRIDE)) + STRIDE, dtype=np.uint64)
                copies.append(np.array([*around[STRIDE:], *w, *around[:STRIDE]], dtype=np.uint64))
            words, first = self._joined(copies)
            own = list(dict.fromkeys(picked))
            tables, wanted = 4, max(1, math.ceil(min(recall, 1) * len(picked)))
            while True:
                probe = Index([self.items[k] for k in own], recall, self.max_ratio, tables=tables)
                met_by = np.full(len(picked), tables)
                for table, c, at, item, _ in probe.candidates(words, first):
                    of = np.searchsorted(first, at, side="right") - 1
                    np.minimum.at(met_by, of[np.array(own)[item] == np.array(picked)[of]], table)
                if (met_by < tables).sum() >= wanted:
                    break
                tables *= 2
            need = max(need, int(np.sort(met_by)[wanted - 1]) + 1)
        return need

    def candidates(self, words: np.ndarray, first: np.ndarray):
        """(table, class, starts, item, offset) of the windows of the :func:`spaced` texts whose key is in the index."""
        for step in sorted({stride(low) for low in self.walks.lows}):
            at = starts(first, step)
            for table, c, keys in self._only([low for low in self.walks.lows if stride(low) == step]).keys(words, at):
                known, item, offset, seen, bits = self.entries[table, c]
                rows = np.flatnonzero(seen[(keys >> np.uint64(64 - bits)).astype(np.int64)])
                lo = np.searchsorted(known, keys[rows], "left")
                hi = np.searchsorted(known, keys[rows], "right")
                n = hi - lo
                if n.any():
                    rows = np.repeat(rows, n)
                    entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                    yield table, c, at[rows], item[entry], offset[entry]


def edit_distance_within(item: np.ndarray, words: np.ndarray) -> int:
    """Least edit distance of ``item`` to any run of ``words``."""
    n = len(words)
    column = np.arange(n + 1)
    row = np.zeros(n + 1, dtype=np.int64)
    for k, w in enumerate(item, 1):
        new = np.empty(n + 1, dtype=np.int64)
        new[0] = k
        np.minimum(row[:-1] + (words != w), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - column) + column
    return int(row.min())


def found_items(index: Index, texts: list[bytes]) -> list[list[int]]:
    """For each text the positions in ``index.items`` of the items that it holds."""
    out: list[set[int]] = [set() for _ in texts]
    lo, size = 0, 0
    for k in range(len(texts) + 1):
        if k == len(texts) or (size and size + len(texts[k]) > BLOCK_BYTES):
            _search(index, texts[lo:k], out[lo:k])
            lo, size = k, 0
        if k < len(texts):
            size += len(texts[k]) + 1
    return [sorted(x) for x in out]


def _search(index: Index, texts: list[bytes], out: list[set[int]]) -> None:
    if not texts:
        return
    words, first = spaced(*word_hashes(texts))
    tried: set[tuple[int, int, int]] = set()
    for _, _, at, item, offset in index.candidates(words, first):
        text = np.searchsorted(first, at, side="right") - 1
        for t, i, begin in zip(text.tolist(), item.tolist(), (at - offset).tolist()):
            if i in out[t]:
                continue
            target = index.items[i][1]
            edits = int(index.max_ratio * len(target))
            around = (max(first[t], begin - 2 * edits), min(first[t + 1] - 1, begin + len(target) + 2 * edits))
            if (t, i, around[0]) in tried:
                continue
            tried.add((t, i, around[0]))
            near = words[around[0]:around[1]]
            # a word of the item that is not there at all costs an edit
            if len(target) - np.isin(target, near).sum() <= edits and edit_distance_within(target, near) <= edits:
                out[t].add(i)


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, np.ndarray]]]:
    """The items as (id, word hashes), in blocks of BLOCK_WORDS words at most (or one longer item)."""
    block, size = [], 0
    rows = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).orderBy("i", "t")
    for row in rows.toLocalIterator():
        words, _ = word_hashes([(row["t"] or "").encode("utf-8", "replace")])
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row["i"], words))
        size += len(words)
    if block:
        yield block


def decontaminate(df: DataFrame, items: DataFrame, id_col: str = "item_id", item_text_col: str = "text",
                  text_col: str = "text", max_ratio: float = MAX_RATIO, recall: float = RECALL) -> DataFrame:
    """``df`` with ``item_ids`` (sorted ids of the items found in the row's text) and
    ``contaminated``; input columns of these names are replaced."""
    spark = df.sparkSession
    item_type = items.schema[id_col].dataType.simpleString()
    others = [c for c in df.columns if c not in ("item_ids", "contaminated") or c == text_col]
    rows = df.select(F.struct(*others).alias("row"), F.col(text_col).alias("text"),
                     F.array().cast(f"array<{item_type}>").alias("item_ids"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, item_ids array<{item_type}>"
    for block in item_blocks(items, id_col, item_text_col):
        shared = spark.sparkContext.broadcast(Index(block, recall, max_ratio))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                texts = [(t.as_py() or "").encode("utf-8", "replace") for t in batch.column(1)]
                ids = [old + [index.items[i][0] for i in new] for old, new in
                       zip(batch.column(2).to_pylist(), found_items(index, texts))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                                  pa.array(ids, batch.column(2).type)], names=["row", "text", "item_ids"])

        rows = rows.mapInArrow(run, schema)
    return rows.select("row.*", F.array_sort(F.filter("item_ids", lambda x: x.isNotNull())).alias("item_ids"),
                       (F.size("item_ids") > 0).alias("contaminated"))


def query(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_ids."""
    found = decontaminate(documents.select("doc_id", "text"), benchmark)
    return found.select("doc_id", "contaminated", F.size("item_ids").cast("long").alias("n_items"), "item_ids")
