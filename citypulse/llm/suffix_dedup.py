"""Exact removal of byte strings of ``length`` bytes that start at more than one place.

*Sampling.* Each window of ``length`` bytes is given an anchor: the leftmost
least hash of its first ``ANCHOR_SPAN`` positions. Equal windows have equal
anchors, so only suffixes that start at anchors (some 1.3 %) leave a document.
A *segment* is the run of windows with one anchor.

*Copies first.* Segments are counted by (hash of the bytes after the anchor,
hash of the segment). All windows of a segment that is found again are repeats;
one representative of it goes on. Groups are combined before the shuffle.

*Per-shard suffix arrays.* Representatives whose anchors are alike while the
segments differ (an edge of a repeat lies in them) are dealt to shards by
anchor, a few thousand each. A shard builds the suffix array of its segments
(Larsson-Sadakane) and Kasai's common prefixes, and so finds, byte for byte,
which windows occur elsewhere in the shard.

*Merging across shards.* An anchor with very many different segments is dealt
over several shards. Each of these sends on its distinct windows as a sorted run
of 64-bit hashes; runs are cut into ranges, and in each range every run is looked
up in all of them by binary search.

Null text counts as empty. Repeated rows are copies of one another. A null id is
kept. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import pieces, saved
from citypulse.llm.suffix_array import common_prefixes, joined, suffix_array

LENGTH = 200
#: Positions of a window among which its anchor is chosen, and bytes hashed at each.
ANCHOR_SPAN, GRAM = 150, 8
#: Segments in a shard; an anchor with more different segments is dealt over several shards.
SHARD = 4000
#: Window hashes in one range of the merge.
RANGE = 200_000
#: Bytes of text that are looked at together when anchors are chosen.
BLOCK = 1 << 20


def _hashes(data: np.ndarray) -> np.ndarray:
    """A hash of GRAM bytes from every position, above the position itself."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    grams = np.empty(len(data) + 8, dtype=np.uint64)
    for k in range(GRAM):
        part = padded[k:k + (len(padded) - k) // 8 * 8].view("<u8")
        target = grams[k::8]
        target[:] = part[:len(target)]
    x = grams[:len(data)]
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x &= np.uint64(0xFFFFFFFF00000000)
    x |= np.arange(len(x), dtype=np.uint64)
    return x


def _sliding_min(x: np.ndarray, span: int) -> np.ndarray:
    """Least value of each run of ``span`` values."""
    size, m = 1, x
    while size * 2 <= span:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = span - size
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def segments(texts: list[bytes], length: int):
    """(text index, first window, number of windows, anchor) of every segment, as arrays;
    positions count from the start of the text."""
    span = min(ANCHOR_SPAN, length - GRAM)
    out = [[], [], [], []]
    for k0, k1, lo in _blocks(texts, length):
        data = np.frombuffer(b"".join(texts[k0:k1]) if lo is None else texts[k0][lo:lo + BLOCK + length], dtype=np.uint8)
        lens = np.array([len(t) for t in texts[k0:k1]] if lo is None else [len(data)])
        starts = np.cumsum(lens) - lens
        if len(data) < length:
            continue
        windows = np.maximum(lens - length + 1, 0)
        if lo is not None:
            windows = np.minimum(windows, BLOCK)
        of = np.repeat(np.arange(len(lens)), windows)
        at = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows) + starts[of]
        anchor = (_sliding_min(_hashes(data), span)[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        if not len(anchor):
            continue
        new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1]))))
        text = of[new]
        base = starts[text] - (0 if lo is None else lo)
        for got, part in zip(out, (text + k0, at[new] - base, np.diff(np.append(new, len(of))), anchor[new] - base)):
            got.append(part)
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def _blocks(texts: list[bytes], length: int):
    """Runs of short texts of about BLOCK bytes, and pieces of longer texts that
    overlap so that every window lies whole in one piece."""
    k0, size = 0, 0
    for k, text in enumerate(texts):
        if len(text) > BLOCK:
            if k > k0:
                yield k0, k, None
            for lo in range(0, len(text) - length + 1, BLOCK):
                yield k, k + 1, lo
            k0, size = k + 1, 0
        else:
            size += len(text)
            if size > BLOCK:
                yield k0, k + 1, None
                k0, size = k + 1, 0
    if k0 < len(texts):
        yield k0, len(texts), None


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def _text_bytes(column) -> list[bytes]:
    return [(t.as_py() or "").encode("utf-8", "replace") for t in column]


def document_segments(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, segment, doc, start, n): hashes of the bytes after the anchor and of
    the whole segment, the document's key, first window and number of windows."""
    span = min(ANCHOR_SPAN, length - GRAM)
    tail = length - span + 1

    def run(batches):
        h = xxhash.xxh3_64_intdigest
        for batch in pieces(batches):
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            texts = _text_bytes(batch.column(1))
            of, start, n, anchor = segments(texts, length)
            first, second = [], []
            for k, s, m, a in zip(of.tolist(), start.tolist(), n.tolist(), anchor.tolist()):
                text = texts[k]
                first.append(h(text[a:a + tail]))
                second.append(h(text[s:s + m - 1 + length]))
            yield pa.RecordBatch.from_arrays(
                [_signed(first), _signed(second), pa.array(doc[of]), pa.array(start.astype(np.int32)),
                 pa.array(n.astype(np.int32))], names=["anchor", "segment", "doc", "start", "n"])

    return docs.select("doc", "text").mapInArrow(run, "anchor long, segment long, doc long, start int, n int")


def _shard_repeats(length: int):
    """Suffix-array work on one shard: rows (doc, from, to, hash). A row with a hash is
    a distinct window of a shard that shares its anchor with other shards, alone in
    this shard if doc is set; other rows are runs of bytes to remove."""
    def run(group: pa.Table) -> pa.Table:
        seg = [b.as_py() for b in group.column("bytes")]
        doc, start, copies = (group.column(c).to_numpy() for c in ("doc", "start", "copies"))
        split = group.column("part")[0].as_py() > 0
        data, at = joined(seg)
        sa, rank = suffix_array(data)
        shared = common_prefixes(data, at, sa, rank, length)
        windows = np.array([len(s) for s in seg]) - length + 1
        of = np.repeat(np.arange(len(seg)), windows)
        pos = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        # windows in suffix order fall into classes of equal windows
        slot = np.argsort(rank[at[of] + pos], kind="stable")
        of, pos = of[slot], pos[slot]
        r = rank[at[of] + pos]
        joins = np.zeros(len(of), dtype=bool)
        if len(of):
            joins[1:] = _joined(shared[sa], r, length)
        cls = np.cumsum(~joins) - 1
        size = np.bincount(cls)
        lone = copies[of] == 1
        hit = lone & (size[cls] > 1)
        rows = _runs(doc, start, of[hit], pos[hit], length)
        empty = pa.nulls(len(rows[0]), pa.int64())
        table = pa.table({"doc": rows[0], "from": rows[1], "to": rows[2], "hash": empty})
        if split and len(of):
            firsts = np.flatnonzero(~joins)
            digests = [xxhash.xxh3_64_intdigest(seg[of[k]][pos[k]:pos[k] + length]) for k in firsts.tolist()]
            single = (size == 1) & lone[firsts]
            runs = pa.table({
                "doc": pa.array(doc[of[firsts]], mask=~single), "from": start[of[firsts]] + pos[firsts],
                "to": start[of[firsts]] + pos[firsts] + length, "hash": _signed(digests)})
            table = pa.concat_tables([table, runs.cast(table.schema)])
        return table

    return run


def _joined(lcp: np.ndarray, r: np.ndarray, length: int) -> np.ndarray:
    """Whether each window (by its rank, ascending) equals the one before it: all common
    prefixes between their ranks are at least ``length``."""
    breaks = np.cumsum(lcp < length)
    return breaks[r[1:]] == breaks[r[:-1]]


def _runs(doc, start, of, pos, length):
    """Neighbouring windows of a segment as runs of bytes."""
    order = np.lexsort((pos, of))
    of, pos = of[order], pos[order]
    new = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (pos[1:] != pos[:-1] + 1)))) if len(of) else \
        np.zeros(0, np.int64)
    last = np.append(new[1:], len(of)) - 1 if len(new) else new
    begin = start[of[new]].astype(np.int64) + pos[new]
    return doc[of[new]], begin, start[of[last]].astype(np.int64) + pos[last] + length


def merge_runs(windows: DataFrame) -> DataFrame:
    """(doc, from, to) of the windows that another shard has too. ``windows``: (doc, from,
    to, hash); each range of hashes is one group, where each shard's run is sorted."""
    total = windows.count()
    if not total:
        return windows.select("doc", "from", "to").limit(0)
    bits = max(0, (total // RANGE).bit_length())

    def run(group: pa.Table) -> pa.Table:
        h = group.column("hash").to_numpy()
        everything = np.sort(h)
        seen = np.searchsorted(everything, h, "right") - np.searchsorted(everything, h, "left")
        found = group.select(["doc", "from", "to"]).filter(pa.array(seen > 1))
        return found.filter(found.column("doc").is_valid())

    return (windows.withColumn("range", F.shiftrightunsigned("hash", 63 - bits) if bits else F.lit(0).cast("long"))
            .groupBy("range").applyInArrow(run, "doc long, from long, to long"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(doc, from, to): runs of bytes to remove, which may overlap, of ``docs`` (doc, text)."""
    found = saved(document_segments(docs, length), "suffix-segments")
    counted = saved(found.groupBy("anchor", "segment").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc", "start", "n")).alias("at")), "suffix-counts")
    again = counted.where("copies > 1").select("anchor", "segment")
    ranges = saved(found.join(again, ["anchor", "segment"]).select(
        "doc", F.col("start").cast("long").alias("from"),
        (F.col("start") + F.col("n") - 1 + length).cast("long").alias("to")), "suffix-copies")

    anchors = counted.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed = saved(counted.join(anchors, "anchor").select(
        "anchor", "segment", "copies", "kinds", "at.*"), "suffix-mixed")
    shards = max(1, mixed.count() // shard)
    parts = F.ceil(F.col("kinds") / F.lit(float(shard))).cast("long")
    wide = F.col("kinds") > shard
    placed = mixed.select(
        "doc", F.struct("start", "n", "copies",
                        F.when(wide, F.col("anchor")).otherwise(F.pmod("anchor", F.lit(shards))).alias("shard"),
                        F.when(wide, 1 + F.pmod("segment", parts)).otherwise(F.lit(0).cast("long")).alias("part")).alias("seg"))
    wanted = placed.groupBy("doc").agg(F.collect_list("seg").alias("segs"))

    def cut(batches):
        for batch in pieces(batches):
            texts = _text_bytes(batch.column(1))
            flat = [(d, s, t[s["start"]:s["start"] + s["n"] - 1 + length])
                    for d, t, segs in zip(batch.column(0).to_pylist(), texts, batch.column(2))
                    for s in segs.as_py()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s[c] for _, s, _ in flat], pa.int64()) for c in ("shard", "part")]
                + [pa.array([d for d, _, _ in flat], pa.int64())]
                + [pa.array([s[c] for _, s, _ in flat], pa.int64()) for c in ("start", "copies")]
                + [pa.array([b for _, _, b in flat], pa.binary())],
                names=["shard", "part", "doc", "start", "copies", "bytes"])

    cuts = saved(docs.select("doc", "text").join(wanted, "doc").select("doc", "text", "segs").mapInArrow(
        cut, "shard long, part long, doc long, start long, copies long, bytes binary"), "suffix-pieces")
    edges = saved(cuts.groupBy("shard", "part").applyInArrow(
        _shard_repeats(length), "doc long, from long, to long, hash long"), "suffix-edges")
    return (ranges.union(edges.where("hash IS NULL").select("doc", "from", "to"))
            .union(merge_runs(edges.where("hash IS NOT NULL"))))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   shard: int = SHARD) -> DataFrame:
    """Every row of ``df`` with n_bytes, n_removed, n_spans, kept_text (the bytes that
    stay, without characters cut in two) and kept_sha256 (of all bytes that stay);
    input columns of these names are replaced.

    A document's key is a hash of its id and text, so rows with one id and
    different texts stay apart."""
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(id_col).isNull(),
                     F.coalesce(F.col(text_col), F.lit("")))
    docs = df.select(key.alias("doc"), F.col(text_col).alias("text"))
    spans = repeated_ranges(docs, length, shard).groupBy("doc").agg(
        F.array_sort(F.collect_set(F.struct(F.col("from"), F.col("to")))).alias("spans"))
    added = ["n_bytes", "n_removed", "n_spans", "kept_text", "kept_sha256"]
    others = [c for c in df.columns if c not in added or c in (id_col, text_col)]
    rows = df.select(F.struct(*others).alias("row"), key.alias("doc"), F.col(text_col).alias("text")).join(
        spans, "doc", "left")

    def run(batches):
        for batch in pieces(batches):
            cols = [[], [], [], [], []]
            for text, found in zip(batch.column(1), batch.column(2)):
                data = (text.as_py() or "").encode("utf-8", "replace")
                kept, at, n = [], 0, 0
                for span in found.as_py() or ():
                    if span["from"] > at or n == 0:
                        n += 1
                        kept.append(data[at:span["from"]])
                    at = max(at, span["to"])
                kept = b"".join([*kept, data[at:]])
                for c, v in zip(cols, (len(data), len(data) - len(kept), n, kept.decode("utf-8", "ignore"), hashlib.sha256(kept).hexdigest())):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                                             names=["row", *added])

    row_type = rows.schema["row"].dataType.simpleString()
    return rows.select("row", "text", "spans").mapInArrow(
        run, f"row {row_type}, n_bytes long, n_removed long, n_spans long, kept_text string, kept_sha256 string"
    ).select("row.*", *added)


def query(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents.select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
