"""SimHash near-duplicate classes by a binary-trie self-join.

1. ``fingerprints``: 64-bit SimHash of word shingles, one Arrow pass over the texts.
2. ``trie_links``: the distinct fingerprints form a binary trie. It is cut into
   subtrees of at most ``leaf_size`` fingerprints; pairs of subtrees whose
   prefixes already differ in too many bits are never formed. Each remaining
   pair is one task group, in which both subtrees are descended together, the
   differing bits added up and a node pair dropped once they exceed the budget.
3. ``components``: links join into classes (large-star / small-star).

Copies of a text collapse to one fingerprint before the join, so a group of
identical copies costs one trie leaf. A task sends on a spanning set of its
links (each fingerprint with the smallest one it reaches inside the task), not
all pairs: the classes are the same and the output is linear.

Nulls, empty texts and texts without a word have fingerprint zero, linked like
any other. A null id takes part, but names a class only if the class has no
other id (the class id is then null). Repeated rows give repeated result rows.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import lower_words, saved
from citypulse.llm.graph import components

SEED = 42
BITS = 64
#: Bits are counted over so many hashes at a time, which bounds memory for very long texts.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = lower_words(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[len(words) - n:].tolist()
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, BLOCK):
        part = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i:i + BLOCK], ends[i:i + BLOCK])],
                        dtype=">u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(id, fp): fp is the fingerprint's bit pattern as a signed long."""
    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)),
                              dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    id_type = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, fp long")


def trie_cut(fps: DataFrame, leaf_size: int) -> list[tuple[int, int]]:
    """(prefix, depth) of subtrees that cover the trie, in order, each with at most
    ``leaf_size`` distinct fingerprints. Only counts by prefix reach the driver:
    their number follows the number of fingerprints divided by ``leaf_size``."""
    done, open_, step = [], [(0, 0)], 5
    total = fps.count()
    if total <= leaf_size:
        return open_
    depth = max(1, min(BITS, (total // leaf_size).bit_length()))
    while open_:
        at = F.shiftrightunsigned("fp", BITS - depth)
        parents: dict[int, list[int]] = {}
        for p, d in open_:
            parents.setdefault(d, []).append(p)
        (d0, tops), = parents.items()
        rows = fps if d0 == 0 else fps.join(
            F.broadcast(fps.sparkSession.createDataFrame([(p,) for p in tops], "top long")),
            F.shiftrightunsigned("fp", BITS - d0) == F.col("top"))
        counts = {r["p"]: r["n"] for r in rows.groupBy(at.alias("p")).agg(F.count("*").alias("n")).collect()}
        over = []
        for p in range(1 << depth) if d0 == 0 else sorted(
                (t << (depth - d0)) + i for t in tops for i in range(1 << (depth - d0))):
            (over if counts.get(p, 0) > leaf_size and depth < BITS else done).append((p, depth))
        open_, depth = over, min(BITS, depth + step)
    return sorted(done, key=lambda x: x[0] << (BITS - x[1]))


def near_prefixes(cut: list[tuple[int, int]], max_bits: int) -> np.ndarray:
    """Pairs (i <= j) of subtrees of the cut whose common depth differs in at most
    ``max_bits`` bits, found by descending the trie of the cut pairwise."""
    starts = [p << (BITS - d) for p, d in cut]
    pairs = []

    def inside(lo, hi):  # the cut below a node is a run of entries
        return hi - lo == 1

    def split(lo, hi, depth, prefix):
        mid = prefix | 1 << (BITS - 1 - depth)
        import bisect
        return bisect.bisect_left(starts, mid, lo, hi), mid

    stack = [(0, len(cut), 0, 0, len(cut), 0, 0, 0)]
    while stack:
        alo, ahi, ap, blo, bhi, bp, depth, err = stack.pop()
        if inside(alo, ahi) and inside(blo, bhi):
            common = min(cut[alo][1], cut[blo][1])
            differing = ((starts[alo] ^ starts[blo]) >> (BITS - common)) if common else 0
            if differing.bit_count() <= max_bits:
                pairs.append((min(alo, blo), max(alo, blo)))
            continue
        halves = []
        for lo, hi, prefix in ((alo, ahi, ap), (blo, bhi, bp)):
            if inside(lo, hi) and cut[lo][1] <= depth:
                halves.append([(lo, hi, prefix, None)])
            else:
                m, mid = split(lo, hi, depth, prefix)
                halves.append([(lo, m, prefix, 0), (m, hi, mid, 1)])
        same = (alo, ahi) == (blo, bhi)
        for x in halves[0]:
            for y in halves[1]:
                if same and x[3] is not None and x[3] > y[3] or x[0] == x[1] or y[0] == y[1]:
                    continue
                e = err + (x[3] is not None and y[3] is not None and x[3] != y[3])
                if e <= max_bits:
                    stack.append((*x[:3], *y[:3], depth + 1, e))
    return np.unique(np.array(pairs, dtype=np.int64).reshape(-1, 2), axis=0)


def descend(a: np.ndarray, b: np.ndarray, same: bool, max_bits: int, work: int = 1 << 18):
    """Pairs of positions in the sorted arrays ``a`` and ``b`` within ``max_bits``
    differing bits. Node pairs are ranges of the arrays; a block of node pairs is
    taken a level down at a time, and the stack of blocks bounds the memory.
    ``same``: a is b, and each unordered pair is found once."""
    one = np.ones(1, dtype=np.int64)
    stack = [(0, 0 * one, len(a) * one, 0 * one, len(b) * one, 0 * one)]
    found = []
    while stack:
        depth, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > work:
            half = len(alo) // 2
            for part in (slice(None, half), slice(half, None)):
                stack.append((depth, alo[part], ahi[part], blo[part], bhi[part], err[part]))
            continue
        small = (ahi - alo) * (bhi - blo) <= 16
        if depth == BITS:
            small[:] = True
        if small.any():
            i, j = _expand(alo[small], ahi[small], blo[small], bhi[small])
            near = np.bitwise_count(a[i] ^ b[j]) <= max_bits
            if same:
                near &= i < j
            found.append((i[near], j[near]))
            keep = ~small
            alo, ahi, blo, bhi, err = alo[keep], ahi[keep], blo[keep], bhi[keep], err[keep]
        if not len(alo):
            continue
        bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
        low = bit - np.uint64(1)
        amid = np.searchsorted(a, (a[alo] & ~(bit | low)) | bit)
        bmid = np.searchsorted(b, (b[blo] & ~(bit | low)) | bit)
        amid, bmid = np.clip(amid, alo, ahi), np.clip(bmid, blo, bhi)
        parts = []
        for l0, h0, l1, h1, more in ((alo, amid, blo, bmid, 0), (alo, amid, bmid, bhi, 1),
                                     (amid, ahi, blo, bmid, 1), (amid, ahi, bmid, bhi, 0)):
            ok = (h0 > l0) & (h1 > l1) & (err + more <= max_bits)
            if same:
                ok &= l0 <= l1
            parts.append((l0[ok], h0[ok], l1[ok], h1[ok], err[ok] + more))
        nxt = [np.concatenate(x) for x in zip(*parts)]
        if len(nxt[0]):
            stack.append((depth + 1, *nxt))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _expand(alo, ahi, blo, bhi):
    na, nb = ahi - alo, bhi - blo
    n = na * nb
    row = np.repeat(np.arange(len(n)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return alo[row] + k // nb[row], blo[row] + k % nb[row]


def _spanning(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) over links i-j, without the roots."""
    label = np.arange(n)
    while True:
        m = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        np.minimum.at(new, label[i], m)
        np.minimum.at(new, label[j], m)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def trie_links(fps: DataFrame, max_bits: int = 2, leaf_size: int = 1 << 15) -> DataFrame:
    """(a, b): a spanning set of the links between the distinct fingerprints of ``fps`` (fp).

    Each subtree of the cut is packed into one row (at most ``leaf_size`` longs), so
    that a pair of subtrees is a row of two blocks rather than two sets of rows."""
    cut = trie_cut(fps, leaf_size)
    spark = fps.sparkSession
    shared = spark.sparkContext.broadcast(np.array([p << (BITS - d) for p, d in cut], dtype=np.uint64))

    def place(batches):
        for batch in batches:
            fp = batch.column(0)
            node = np.searchsorted(shared.value, fp.to_numpy(zero_copy_only=False).view(np.uint64), side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(node), fp], names=["node", "fp"])

    def packed(group: pa.Table) -> pa.Table:
        block = np.sort(group.column("fp").to_numpy().view(np.uint64))
        return pa.table({"node": group.column("node")[:1], "block": pa.array([block.tobytes()], pa.binary())})

    def join(group: pa.Table) -> pa.Table:
        a = np.frombuffer(group.column("first")[0].as_py(), dtype=np.uint64)
        if group.column("i")[0] == group.column("j")[0]:
            both = a
            i, j = descend(a, a, True, max_bits)
        else:
            b = np.frombuffer(group.column("second")[0].as_py(), dtype=np.uint64)
            i, j = descend(a, b, False, max_bits)
            both, j = np.concatenate((a, b)), j + len(a)
        x, y = _spanning(i, j, len(both))
        return pa.table({"a": pa.array(both[x].view(np.int64)), "b": pa.array(both[y].view(np.int64))})

    blocks = saved(fps.mapInArrow(place, "node long, fp long").groupBy("node")
                   .applyInArrow(packed, "node long, block binary"), "simhash-blocks")
    pairs = spark.createDataFrame(near_prefixes(cut, max_bits).tolist(), "i long, j long")
    return (pairs.join(blocks.select(F.col("node").alias("i"), F.col("block").alias("first")), "i")
            .join(blocks.select(F.col("node").alias("j"), F.col("block").alias("second")), "j")
            .groupBy("i", "j").applyInArrow(join, "a long, b long"))


def simhash_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, leaf_size: int = 1 << 15) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of ``df``.

    ``fingerprint``: 16 hex digits; ``component_id``: the smallest id among all
    rows whose fingerprints are connected by links of at most ``max_bits`` bits.
    """
    marked = saved(fingerprints(df, id_col, text_col, shingle), "simhash")
    classes = saved(marked.groupBy("fp").agg(F.min("id").alias("least")), "simhash-fps")
    roots = components(trie_links(classes.select("fp"), max_bits, leaf_size))
    named = (classes.join(roots, classes["fp"] == roots["node"], "left")
             .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = named.join(least, "root").select("fp", "component_id")
    return (marked.join(of_fp, "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))
