"""Alignment of two tokenizers through inverted pair bitmaps.

A text is cut into tokens A and tokens B over the same bytes. Byte offsets where
both end a token cut it into groups; two token occurrences are linked if their
byte ranges overlap. For every id pair (a, b) the corpus is inverted:

1. ``postings``: documents come in blocks of at most ``BLOCK_DOCS`` texts (and
   ``BLOCK_BYTES``, or one longer text). Of each pair and block one row holds
   compressed bitmaps over the block's documents: bit d of plane p is bit p of
   the number of links of document d. Documents' bits are OR-merged into the
   planes; zero bytes are left out. The document count is the popcount of the
   OR of all planes, the link count the sum of the planes' popcounts times 2^p.
2. ``pair_counts``: blocks are disjoint, so a pair's bitmap over the corpus is
   their union and popcounts add up. A pair's rows are added in the tasks first.
3. ``link_scores``: the corpus-wide counts join the pairs of the blocks, without
   their bitmaps, and meet the bitmaps in the block, which returns to every document
   the sum over its planes. The bitmaps are shuffled once.

Texts are cut at single spaces between other characters before they are encoded,
and equal pieces are encoded once: the byte-level pattern always cuts there, and
no piece of the other vocabulary has a space mark behind another character (both
are read from the vocabulary files; otherwise whole texts are encoded). Tokens
are the same as those of whole texts. The vocabulary files go to the tasks as a
broadcast of their bytes (a few MB, whatever the input).

Defined cases. Null and empty texts, and texts whose tokens do not give back
their bytes, have no tokens: zeros, and '' as hash. A null id is kept. Repeated
rows are documents of their own. A very long text is a block of its own; memory
follows the longest text. An empty table gives an empty result. Equal highest
counts of a B id are all best. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import pieces, saved

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_DOCS = 1 << 12
BLOCK_BYTES = 4 << 20
#: Distinct pieces of texts a task remembers, and characters that are joined to be encoded.
HELD_PIECES, JOINED_CHARS = 400_000, 1 << 15
B_BITS, SLOT_BITS = 25, 12
SPACE = "▁"
# Fixed value: where byte-level vocabularies cut texts before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters below (Latin scripts, marks) are classed alike by all versions of Unicode.
PLAIN_END = "\u0370"
#: A space between two characters that are no white space.
BETWEEN = re.compile(r" (?=\S)(?<=\S )")


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others, in order, from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_file)
        plain = byte_of_char()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, k in self.a.get_vocab().items():
            self.a_bytes[k] = bytes(plain[c] for c in entry) if all(c in plain for c in entry) else entry.encode()
        names = [self.b.id_to_piece(k) for k in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(x[3:5], 16)]) if self.b.is_byte(k) else x.replace(SPACE, " ").encode() for k, x in enumerate(names)]
        self.a_size, self.b_size = (np.array([len(x) for x in table], dtype=np.int64) for table in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = ([str(k) for k in range(len(table))] for table in (self.a_bytes, self.b_bytes))
        self.marked = [x + m for table, marks in ((self.a_text, ",|"), (self.b_text, ",;")) for x in table for m in marks]
        spec = json.loads(a_file)
        first = spec["pre_tokenizer"] or {}
        self.cuts = (first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
                     and not spec["normalizer"] and not any(SPACE in x.lstrip(SPACE) for x in names))

        # where ids follow the order of the merges, a faster library gives the same tokens
        pairs = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        ordered = self.cuts and all(vocab["".join(x)] == 256 + k for k, x in enumerate(pairs)) and len(pairs) + 256 == len(vocab)
        self.merges = Encoding("a", pat_str=PATTERN, mergeable_ranks={self.a_bytes[k]: k for k in vocab.values()}, special_tokens={}) if ordered else None

    def parts(self, text: str) -> list[str]:
        """Pieces of a text that can be encoded alone, without the space before each."""
        return BETWEEN.split(text) if self.cuts else [text]

    def encode(self, parts: list[str]) -> tuple[np.ndarray, list[list[int]]]:
        """A ids of all parts one after another, B ids of each. Plain parts (see :data:`PLAIN_END`)
        without white space at their ends are joined by single spaces for A, which cuts there again."""
        strings, run, size = [], [], 0  # (text, plain)
        for x in parts:
            alone = not self.cuts or x[0].isspace() or x[-1].isspace() or max(x) >= PLAIN_END
            if run and (alone or size > JOINED_CHARS):
                strings.append((" " + " ".join(run), True))
                run, size = [], 0
            if alone:
                strings.append((" " + x, False))
            else:
                run.append(x)
                size += len(x)
        if run:
            strings.append((" " + " ".join(run), True))
        rest = iter(self.a.encode_batch_fast([x for x, plain in strings if not (plain and self.merges)], add_special_tokens=False))
        a = [np.array(self.merges.encode_ordinary(x) if plain and self.merges else next(rest).ids, dtype=np.int64) for x, plain in strings]
        return np.concatenate([np.zeros(0, np.int64), *a]), self.b.encode(parts, num_threads=1)


@dataclass
class Aligned:
    """Some pieces' tokens and links: counts by piece, and the links' pairs one piece after another."""
    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray
    groups: list[bytes]


def _steps(ends: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """How many of ``ends`` lie up to each of ``stops`` and beyond the one before."""
    return np.diff(np.concatenate(([0], np.searchsorted(ends, stops, side="right"))))


def align_parts(enc: Encoder, parts: list[str]) -> Aligned:
    a, ids_b = enc.encode(parts)
    raw = [b" " + x.encode("utf-8", "replace") for x in parts]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    n_b = np.fromiter(map(len, ids_b), np.int64, len(ids_b))
    b = np.fromiter(chain.from_iterable(ids_b), np.int64, n_b.sum())
    # A gives back every byte; a piece whose B tokens do not has no tokens
    bytes_b = np.concatenate(([0], np.cumsum(enc.b_size[b])))[np.concatenate(([0], np.cumsum(n_b)))]
    joined = b"".join([enc.b_bytes[k] for k in b.tolist()])
    good = np.diff(bytes_b) == size
    if joined != b"".join(raw):
        good &= np.fromiter((joined[i:j] == r for i, j, r in zip(bytes_b[:-1].tolist(), bytes_b[1:].tolist(), raw)), bool, len(raw))
    end_a, part_end = np.cumsum(enc.a_size[a]), np.cumsum(size)
    n_a = _steps(end_a, part_end)
    if b"".join([enc.a_bytes[k] for k in a.tolist()]) != b"".join(raw):
        raise ValueError("the first tokenizer does not give back the bytes of its text")
    if not good.all():
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b, size = (np.where(good, x, 0) for x in (n_a, n_b, size))
        end_a, part_end = np.cumsum(enc.a_size[a]), np.cumsum(size)
    end_b = np.cumsum(enc.b_size[b])
    both = np.sort(np.concatenate((end_a, end_b)), kind="stable")  # two sorted runs
    again = both[1:] == both[:-1]
    ends = both[np.concatenate(([True], ~again))] if len(both) else both  # the bytes between two ends lie in one A and one B token: one link
    cuts = both[1:][again]
    pairs = a[np.searchsorted(end_a, ends)] << B_BITS | b[np.searchsorted(end_b, ends)]
    n_links, n_groups = _steps(ends, part_end), _steps(cuts, part_end)
    # groups as text: the tokens in the order of (group, side), each with the mark behind it
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    last_a, last_b = (np.concatenate((g[1:] != g[:-1], [True])) if len(g) else np.zeros(0, bool) for g in (group_a, group_b))
    order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
    at = np.concatenate((2 * a + last_a, 2 * len(enc.a_text) + 2 * b + last_b))[order]
    named = [enc.marked[k] for k in at.tolist()]
    stops = np.cumsum(n_a + n_b).tolist()
    groups = ["".join(named[i:j])[:-1].encode() for i, j in zip([0, *stops], stops)]
    return Aligned(good, n_a, n_b, n_groups, n_links, pairs, groups)


class Memory:
    """Aligned pieces by text; forgotten when they are too many."""

    def __init__(self, enc: Encoder, held: int = HELD_PIECES):
        self.enc, self.held, self.at = enc, held, {}
        self.known = align_parts(enc, [])

    def take(self, parts: list[str]) -> np.ndarray:
        """Positions of ``parts`` in ``known``."""
        if len(self.at) > self.held:
            self.at, self.known = {}, align_parts(self.enc, [])
        new = [x for x in dict.fromkeys(parts) if x not in self.at]
        if new:
            more, old = align_parts(self.enc, new), self.known
            self.known = Aligned(*(np.concatenate((getattr(old, k), getattr(more, k))) for k in ("good", "n_a", "n_b", "n_groups", "n_links", "pairs")), old.groups + more.groups)
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
        return np.fromiter(map(self.at.__getitem__, parts), np.int64, len(parts))


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[k], starts[k] + 1, ... (sizes[k] of them) for each k."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def bitmaps(keys: np.ndarray, mult: np.ndarray) -> dict[str, pa.Array]:
    """Compressed planes of each pair from ``keys`` (pair << SLOT_BITS | document) with their numbers of links.

    A pair's binary: the positions (2 bytes) of its bytes that are not zero, then these bytes plane by plane.
    """
    order = np.argsort(keys, kind="stable")
    keys, mult = keys[order], mult[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    keys, mult = keys[first], np.add.reduceat(mult, first)
    eight = keys >> 3
    first = np.flatnonzero(np.concatenate(([True], eight[1:] != eight[:-1])))
    bit = (1 << (keys & 7)).astype(np.uint8)
    planes = [np.bitwise_or.reduceat(np.where(mult >> p & 1, bit, 0).astype(np.uint8), first) for p in range(int(mult.max()).bit_length())]
    pair, spot = eight[first] >> (SLOT_BITS - 3), (eight[first] & ((1 << SLOT_BITS - 3) - 1)).astype("<u2")
    start = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    size = np.diff(np.concatenate((start, [len(pair)])))
    ones = [np.add.reduceat(np.bitwise_count(x).astype(np.int64), start) for x in planes]
    depth = np.max([np.where(n > 0, p + 1, 0) for p, n in enumerate(ones)], axis=0)
    docs = np.add.reduceat(np.bitwise_count(np.bitwise_or.reduce(planes, axis=0)).astype(np.int64), start)
    links = sum(n << p for p, n in enumerate(ones))
    length = size * (2 + depth)
    offsets = np.concatenate(([0], np.cumsum(length)))
    out = np.zeros(offsets[-1], dtype=np.uint8)
    rank = _runs(np.zeros(len(size), np.int64), size)
    base, wide, deep = (np.repeat(x, size) for x in (offsets[:-1], size, depth))
    out[base + 2 * rank], out[base + 2 * rank + 1] = spot & 255, spot >> 8
    for p, x in enumerate(planes):
        has = deep > p
        out[(base + 2 * wide + p * wide + rank)[has]] = x[has]
    packed = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)])
    return {"pair": pa.array(pair[start]), "planes": pa.array(depth.astype(np.int32)), "docs": pa.array(docs), "links": pa.array(links), "bitmap": packed}


def unpacked(planes: np.ndarray, lengths: np.ndarray, data: np.ndarray):
    """(row, document, number of links) of the bitmaps that lie in ``data`` one after another."""
    size = lengths // (2 + planes)
    base = np.cumsum(lengths) - lengths
    rank = _runs(np.zeros(len(size), np.int64), size)
    row = np.repeat(np.arange(len(size)), size)
    at = base[row] + 2 * rank
    spot = data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8
    mult = np.zeros((len(row), 8), dtype=np.int64)
    for p in range(int(planes.max(initial=0))):
        has = np.flatnonzero(planes[row] > p)
        k = row[has]
        byte = data[base[k] + (2 + p) * size[k] + rank[has]]
        mult[has] |= np.unpackbits(byte[:, None], axis=1, bitorder="little").astype(np.int64) << p
    e, bit = np.nonzero(mult)
    return row[e], spot[e] * 8 + bit, mult[e, bit]


def _block(memory: Memory, texts: list[str | None]):
    """(columns by document, their postings) of one block of texts."""
    lists = [memory.enc.parts(t) if t else [] for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    at = memory.take(list(chain.from_iterable(lists)))
    known, doc = memory.known, np.repeat(np.arange(len(lists)), sizes)
    bad = np.zeros(len(lists), dtype=bool)
    bad[doc[~known.good[at]]] = True
    keep = ~bad[doc]
    at, doc = at[keep], doc[keep]
    stops = np.cumsum(np.bincount(doc, minlength=len(lists)))
    total = lambda x: np.diff(np.concatenate(([0], np.concatenate(([0], np.cumsum(x[at])))[stops])))
    columns = {k: total(getattr(known, k)) for k in ("n_a", "n_b", "n_groups", "n_links")}
    names = [known.groups[k] for k in at.tolist()]
    columns["groups_sha256"] = [hashlib.sha256(b";".join(names[i:j])).hexdigest() if j > i else "" for i, j in zip([0, *stops.tolist()], stops.tolist())]
    if not len(at):
        return columns, None
    both, n = np.unique(doc * len(known.good) + at, return_counts=True)
    doc, at = both // len(known.good), both % len(known.good)
    size = known.n_links[at]
    begin = np.cumsum(known.n_links) - known.n_links
    keys = known.pairs[_runs(begin[at], size)] << SLOT_BITS | np.repeat(doc, size)
    return columns, bitmaps(keys, np.repeat(n, size))


def postings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None,
             block_docs: int = BLOCK_DOCS, held: int = HELD_PIECES) -> DataFrame:
    """Rows of two kinds, written once. Documents: block, slot, id, n_a, n_b, n_groups, n_links,
    groups_sha256. Pairs (slot null): block, pair, planes, docs, links, bitmap."""
    files = []
    for path in (a_path or f"{TOKENIZERS}/{A_FILE}", b_path or f"{TOKENIZERS}/{B_FILE}"):
        with open(path, "rb") as f:  # read on the driver: executors need no copy
            files.append(f.read())
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(files)
    id_type = dict(df.dtypes)[id_col]
    schema = (f"block long, slot long, id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pair long, planes int, docs long, links long, bitmap binary")

    def run(batches):
        from pyspark import TaskContext

        memory, done = Memory(Encoder(*shared.value), held), 0
        types = None
        for batch in chain.from_iterable(_cut(x, block_docs) for x in pieces(batches, BLOCK_BYTES)):
            if types is None:
                types = pa.schema([("block", pa.int64()), ("slot", pa.int64()), ("id", batch.schema.field(0).type), *((k, pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")),
                                   ("groups_sha256", pa.string()), ("pair", pa.int64()), ("planes", pa.int32()), ("docs", pa.int64()), ("links", pa.int64()), ("bitmap", pa.binary())])
            block = TaskContext.get().partitionId() << 32 | done
            done += 1
            columns, found = _block(memory, batch.column(1).to_pylist())
            for given in ({"slot": np.arange(batch.num_rows), "id": batch.column(0), **columns}, found):
                if given is not None:
                    n = len(next(iter(given.values())))
                    given = {"block": np.full(n, block), **given}
                    yield pa.RecordBatch.from_arrays([pa.nulls(n, f.type) if f.name not in given else x if isinstance(x := given[f.name], pa.Array) else pa.array(x, f.type) for f in types], schema=types)

    found = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    return saved(found, "alignment-postings")


def _cut(batch: pa.RecordBatch, rows: int):
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def pair_counts(post: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, n_links) over the corpus."""
    return (post.where("slot IS NULL").groupBy("pair").agg(F.sum("docs").alias("n_docs"), F.sum("links").alias("n_links"))
            .select("pair", F.shiftright("pair", B_BITS).alias("a"), F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b"), "n_docs", "n_links"))


def link_scores(post: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, slot, n_best, count_sum): over a document's links, how many have a pair that is
    its B id's most frequent one, and the sum of the pairs' link counts."""
    best = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    marked = counts.join(best, "b").select("pair", F.col("n_links").alias("count"), (F.col("n_links") == F.col("most")).alias("best"))

    def run(group: pa.Table, told: pa.Table) -> pa.Table:
        n_best, count_sum = np.zeros(1 << SLOT_BITS, np.int64), np.zeros(1 << SLOT_BITS, np.int64)
        told = told.sort_by("pair")
        named, count = told.column("pair").to_numpy(), told.column("count").to_numpy()
        is_best = told.column("best").to_numpy()
        for part in group.to_batches(max_chunksize=1 << 14):
            bits = part.column("bitmap")
            lengths = np.diff(np.frombuffer(bits.buffers()[1], np.int32)[bits.offset:bits.offset + len(bits) + 1]).astype(np.int64)
            begin = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset]
            row, doc, mult = unpacked(part.column("planes").to_numpy().astype(np.int64), lengths, np.frombuffer(bits.buffers()[2], np.uint8)[begin:])
            at = np.searchsorted(named, part.column("pair").to_numpy())
            np.add.at(count_sum, doc, mult * count[at][row])
            np.add.at(n_best, doc, mult * is_best[at][row])
        slots = np.flatnonzero(count_sum)
        return pa.table({"block": np.full(len(slots), group.column("block")[0].as_py()), "slot": slots, "n_best": n_best[slots], "count_sum": count_sum[slots]})

    pairs = post.where("slot IS NULL")
    named = pairs.select(F.col("pair").alias("of"), F.col("block").alias("at"))  # names of their own: both sides come from one table
    told = named.join(marked, F.col("of") == F.col("pair")).select("at", F.col("of").alias("pair"), "count", "best")
    return (pairs.select("block", "pair", "planes", "bitmap").groupBy("block").cogroup(told.groupBy("at"))
            .applyInArrow(run, "block long, slot long, n_best long, count_sum long"))


def align(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``df``; options: those of :func:`postings`."""
    post = postings(df, id_col, text_col, **options)
    scores = link_scores(post, saved(pair_counts(post), "alignment-pairs"))
    rows = post.where("slot IS NOT NULL").select("block", "slot", F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return (rows.join(scores, ["block", "slot"], "left")
            .select(id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
