"""MinHash near-duplicate classes by a signature-coordinate inverted join.

1. ``signed``: distinct word shingles of every text (64-bit hashes), their number,
   a key of the whole set and ``COORDINATES`` minima of multiply-shift hashes.
   Texts of equal sets become one node, however many they are.
2. ``prefix_postings``: a set is posted under each (coordinate, value). Pairs must
   agree in ``MATCHES`` coordinates. A value that occurs once agrees with nothing;
   of the others, in the order of how often they occur, two such sets share one
   among each one's rarest ``COORDINATES - MATCHES + 1``: only these stay posted,
   so that values of very common shingles are hardly ever looked at.
3. ``hub_pairs``: each list's first set against the others of the list, a row a
   posting. Linked sets are joined into classes, which settles lists of near copies.
4. ``rest_pairs``: lists that still hold several classes are merged in chunks:
   sets outside the first set's class against all sets of the list. Pairs inside
   one class, of sizes that rule a link out, met in a rarer list, or with too few
   agreeing coordinates among the first ones are skipped; pairs with enough
   agreements are sent on, packed by chunk.
5. ``linked``, ``linked_within``: the whole sets of each pair decide (100 * intersection
   >= 80 * union). A chunk's sets meet once, and it sends on a spanning set of its links.

No list is capped and none has all its pairs emitted. A pair at the similarity
of 0.8 agrees in fewer than 58 of 96 coordinates with a chance of 3e-6 (less
above it); sets are compared by 64-bit hashes of shingles, so a false match of
two shingles of two texts of 1,000 words has a chance of 1e-13.

Defined cases. Null and empty texts and texts without a word have an empty set,
are linked with nothing and are their own class. A text of fewer words than the
shingle has its whole sequence as one shingle. A null id takes part, but names a
class only if the class has no other id. Repeated rows give repeated result rows;
rows of one id and different texts are judged by their texts, and each that names
its class is kept. A very long text is one row of one task. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import lower_words, pieces, saved
from citypulse.llm.graph import components, spanning

COORDINATES = 96
MATCHES = 58
SEED = 42
#: Shingles (and coordinates) of the sets of one list that are merged with others at a time.
CHUNK = 1 << 20
#: Distinct words a task remembers the hashes of, and shingles that are signed at a time.
HELD_WORDS, BLOCK = 1 << 19, 1 << 10
#: Pairs compared at a time.
PAIRS = 1 << 16
#: Bits (a power of two) of the filter that texts pass before they are shuffled.
FILTER_BITS = 24

_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose result looks random (multiplications and shifted xors)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of words, remembered."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > HELD_WORDS:
            known.clear()
        new = set(words).difference(known)
        known.update(zip(new, map(xxhash.xxh64_intdigest, new)))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, shingle: int, hashes: Hashes) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words)
    n = max(1, len(h) - shingle + 1)
    out = mixed(h[:n] + np.uint64(min(shingle, len(h))))
    for k in range(1, min(shingle, len(h))):
        out = mixed(out * np.uint64(3) + h[k:n + k])
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), BLOCK):
        np.minimum(low, (found[at:at + BLOCK, None] * FACTORS + TERMS).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _lists(values: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * COORDINATES), pa.array(np.concatenate(values) if values else np.zeros(0, np.int32)))


def signed(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, n, key, sig): ``key`` stands for the whole set (null: empty)."""
    def run(batches):
        hashes = Hashes()
        for batch in pieces(batches):
            sets = [shingle_set(t, shingle, hashes) for t in batch.column(1).to_pylist()]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), _lists([signature(s) for s in sets])],
                                             names=["id", "n", "key", "sig"])

    id_type = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {id_type}, n long, key binary, sig array<int>")


def prefix_postings(sets: DataFrame) -> DataFrame:
    """(coord, sid, before): each set under its rarest coordinate-value pairs that others may share;
    ``before``: the coordinates of the rarer ones it is posted under."""
    posted = sets.select("sid", F.posexplode("sig").alias("at", "value")).select(
        "sid", F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF)).alias("coord"))
    often = saved(posted.groupBy("coord").agg(F.count("*").alias("often")).where("often > 1"), "minhash-often")
    kept = (posted.join(often, "coord").groupBy("sid").agg(F.collect_list(F.struct("often", "coord")).alias("own"))
            .where(F.size("own") >= MATCHES))
    first = F.slice(F.sort_array("own"), F.lit(1), F.size("own") - (MATCHES - 1))
    at = F.transform("own", lambda x: F.shiftright(x["coord"], 32).cast("byte"))
    return (kept.select("sid", first.alias("own")).withColumn("at", at).select("sid", "at", F.posexplode("own").alias("k", "one"))
            .select(F.col("one.coord").alias("coord"), "sid", F.slice("at", F.lit(1), F.col("k")).alias("before")))


def hub_pairs(posted: DataFrame) -> DataFrame:
    """(a, b): the first set of each list with each other set of it."""
    hubs = posted.groupBy("coord").agg(F.min("sid").alias("a"), F.count("*").alias("many")).where("many > 1")
    return (posted.join(hubs, "coord").where("sid <> a").select("a", F.col("sid").alias("b")).distinct())


def enough_matches(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that agree in enough coordinates."""
    own = sets.select("sid", "sig", "n")
    both = (pairs.join(own.select(F.col("sid").alias("a"), F.col("sig").alias("sa"), F.col("n").alias("na")), "a")
            .join(own.select(F.col("sid").alias("b"), F.col("sig").alias("sb"), F.col("n").alias("nb")), "b"))
    same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda x, y: x + y)
    return both.where(_sizes_allow(F.col("na"), F.col("nb")) & (same >= MATCHES)).select("a", "b")


def _sizes_allow(x, y):
    """An intersection of at most the smaller size can reach 80 % of a union of at least the larger."""
    return (100 * x >= 80 * y) & (100 * y >= 80 * x)


def rest_pairs(posted: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(pairs, sids): pairs of lists' sets in different classes that agree in enough coordinates, packed
    (two longs a pair), and the sets they name. A pair is found in the first list that both share.

    The class of a list's first set is its main class; ``other`` sets are outside it. Both are dealt
    in chunks of bounded size: every set meets every chunk of others, each other set every chunk of all."""
    told = posted.join(classes, "sid", "left").join(sets.select("sid", "n"), "sid").withColumn("root", F.coalesce("root", "sid"))
    told = saved(told, "minhash-told")
    size = F.sum(F.col("n") + COORDINATES)
    main = (told.groupBy("coord").agg(F.min(F.struct("sid", "root")).alias("hub"), F.count("*").alias("many"), size.alias("all"))
            .select("coord", F.col("hub.root").alias("main"), "many", "all").where("many > 1"))
    marked = told.select("coord", "sid", "root", "n").join(main, "coord").withColumn("other", F.col("root") != F.col("main"))
    mixed_lists = marked.where("other").groupBy("coord", "main", "all").agg(size.alias("others"))
    rows = saved(told.join(mixed_lists, "coord").withColumn("other", F.col("root") != F.col("main")), "minhash-mixed")
    rows = rows.join(sets.select("sid", "sig"), "sid")  # the signatures of sets in such lists alone
    n_all, n_other = F.ceil(F.col("all") / CHUNK), F.ceil(F.col("others") / CHUNK)
    spot = F.xxhash64("sid")
    kept = ["sid", "root", "other", "n", "sig", "before"]
    as_any = rows.select("coord", F.pmod(spot, n_all).alias("i"), F.explode(F.sequence(F.lit(0), n_other - 1)).alias("j"), F.lit(False).alias("second"), *kept)
    as_other = rows.where("other").select("coord", F.explode(F.sequence(F.lit(0), n_all - 1)).alias("i"), F.pmod(spot, n_other).alias("j"), F.lit(True).alias("second"), *kept)
    dealt = as_any.unionByName(as_other).repartition("coord", "i", "j").sortWithinPartitions("coord", "i", "j", "second")

    def run(batches):
        rest, pairs, held = None, [], 0

        def sent():
            both = np.concatenate(pairs)
            sids = np.unique(both)
            return pa.RecordBatch.from_arrays([pa.array([both.tobytes()], pa.binary()), pa.array([sids], pa.list_(pa.int64()))], names=["pairs", "sids"])
        for batch in batches:
            rest = pa.concat_tables([*([] if rest is None else [rest]), pa.Table.from_batches([batch])])
            group = [rest.column(c).to_numpy() for c in ("coord", "i", "j")]
            before = np.logical_or.reduce([g != g[-1] for g in group]) if len(rest) else np.zeros(0, bool)
            last = int(before.sum())  # the last group may go on in the next batch
            for found, size in _agreeing(rest.slice(0, last)):
                pairs.append(found)
                held += size
                if held >= CHUNK:
                    yield sent()
                    pairs, held = [], 0
            rest = rest.slice(last).combine_chunks()
        for found, _ in _agreeing(rest) if rest is not None else ():
            pairs.append(found)
        if pairs:
            yield sent()

    return dealt.mapInArrow(run, "pairs binary, sids array<long>")


def _agreeing(t: pa.Table):
    """Of each group of rows: blocks of its agreeing pairs (n x 2), with what their sets weigh."""
    if not len(t):
        return
    group = [t.column(c).to_numpy() for c in ("coord", "i", "j")]
    sid, root, n = (t.column(c).to_numpy() for c in ("sid", "root", "n"))
    other, second = (t.column(c).to_numpy(zero_copy_only=False) for c in ("other", "second"))
    sig = t.column("sig").combine_chunks().flatten().to_numpy().reshape(len(t), COORDINATES)
    before = t.column("before").combine_chunks()
    earlier = np.zeros((len(t), COORDINATES), dtype=bool)
    earlier[np.repeat(np.arange(len(t)), before.value_lengths().to_numpy()), before.flatten().to_numpy()] = True
    new = np.concatenate(([True], np.logical_or.reduce([g[1:] != g[:-1] for g in group])))
    start = np.flatnonzero(new)
    stop = np.concatenate((start[1:], [len(t)]))
    seconds = np.add.reduceat(second.astype(np.int64), start)
    mid = stop - seconds  # rows of a group: any sets, then others
    for k in np.flatnonzero((seconds > 0) & (mid > start)).tolist():
        wide = max(1, PAIRS // int(seconds[k]))
        weight = int((n[start[k]:stop[k]] + COORDINATES).sum())
        for at in range(int(start[k]), int(mid[k]), wide):
            x, y = np.meshgrid(np.arange(at, min(at + wide, int(mid[k]))), np.arange(int(mid[k]), int(stop[k])), indexing="ij")
            x, y = x.ravel(), y.ravel()
            ok = (root[x] != root[y]) & (~other[x] | (sid[x] < sid[y])) & _sizes_allow(n[x], n[y])
            x, y = x[ok], y[ok]
            half = COORDINATES // 2  # of the first half, at most so many may differ
            agree = (sig[x, :half] == sig[y, :half]).sum(axis=1)
            ok = agree >= MATCHES - (COORDINATES - half)
            x, y = x[ok], y[ok]
            same = sig[x] == sig[y]
            ok = (same.sum(axis=1) >= MATCHES) & ~(same & earlier[x]).any(axis=1)  # not met in a rarer list
            if ok.any():
                yield np.stack((sid[x[ok]], sid[y[ok]]), axis=1), weight
                weight = 0


def maybe_among(rows: DataFrame, col: str, wanted: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The ``rows`` whose ``col`` may be in ``wanted`` (one column): all that are, and few others.

    Each wanted value sets one of 2^bits bits. Their words (at most 2^bits / 64, whatever the
    input) are broadcast, so that rows which nobody wants are left before they are shuffled."""
    h = lambda c: F.xxhash64(F.lit(SEED), c).bitwiseAND((1 << bits) - 1)
    bit = lambda c: F.expr(f"shiftleft(1L, cast({c} & 63 AS int))")
    words = (wanted.select(h(F.col(wanted.columns[0])).alias("__h")).select(F.shiftright("__h", 6).alias("__word"), bit("__h").alias("__bit"))
             .groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))
    return (rows.withColumn("__h", h(F.col(col))).join(F.broadcast(words), F.shiftright("__h", 6) == F.col("__word"))
            .where(F.col("__bits").bitwiseAND(bit("__h")) != 0).select(*rows.columns))


def whole_sets(df: DataFrame, id_col: str, text_col: str, wanted: DataFrame, shingle: int) -> DataFrame:
    """(sid, found): the sets, as sorted bytes, of the ``wanted`` (sid, least, key), from the texts of their smallest ids."""
    docs = df.select(F.col(id_col).alias("least"), F.col(text_col).alias("text"))
    docs = maybe_among(docs, "least", wanted.select(F.col("least").alias("id")))
    texts = docs.join(wanted.select(F.col("least").alias("id")).distinct(), F.col("least").eqNullSafe(F.col("id")), "left_semi")

    def run(batches):
        hashes = Hashes()
        for batch in pieces(batches):
            sets = [shingle_set(t, shingle, hashes) for t in batch.column(0).to_pylist()]
            found = [s.tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in found], pa.binary()), pa.array(found, pa.binary())], names=["key", "found"])

    sets = texts.select("text").mapInArrow(run, "key binary, found binary")
    return sets.join(wanted.select("sid", "key"), "key").groupBy("sid").agg(F.first("found").alias("found"))


def linked(pairs: DataFrame, found: DataFrame, percent: int = 80) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    both = (pairs.join(found.select(F.col("sid").alias("a"), F.col("found").alias("fa")), "a")
            .join(found.select(F.col("sid").alias("b"), F.col("found").alias("fb")), "b").select("a", "b", "fa", "fb"))

    def run(batches):
        for batch in pieces(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def linked_within(packed: DataFrame, found: DataFrame, percent: int = 80) -> DataFrame:
    """(a, b): of each row of ``packed`` (pairs, sids) a spanning set of the pairs that are similar enough.

    A row's sets meet in one group; it is bounded like the chunks that the pairs come from."""
    blocks = saved(packed.withColumn("block", F.monotonically_increasing_id()), "minhash-rest")
    none = F.lit(None)
    sets = blocks.select("block", F.explode("sids").alias("sid")).join(found, "sid").select("block", "sid", "found", none.cast("binary").alias("pairs"))
    asked = blocks.select("block", none.cast("long").alias("sid"), none.cast("binary").alias("found"), "pairs")

    def run(group: pa.Table) -> pa.Table:
        given = group.filter(pc.is_valid(group.column("pairs"))).column("pairs")[0].as_py()
        group = group.filter(pc.is_valid(group.column("sid"))).sort_by("sid")
        sids = group.column("sid").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("found")]
        pairs = np.searchsorted(sids, np.frombuffer(given, np.int64).reshape(-1, 2))
        good = similar(sets, pairs, percent)
        a, b = spanning(sids[pairs[good, 0]], sids[pairs[good, 1]])
        return pa.table({"a": a, "b": b})

    return sets.unionByName(asked).groupBy("block").applyInArrow(run, "a long, b long")


def similar(sets: list[np.ndarray], pairs: np.ndarray, percent: int, at_once: int = 1 << 22) -> np.ndarray:
    """Positions of the pairs (positions of two sets) whose intersection is at least ``percent`` of the union.

    One set at a time is marked among all shingles of the group, and its partners' marks are added up."""
    size = np.array([len(s) for s in sets])
    names, local = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.zeros(0), np.zeros(0, np.int64))
    begin = np.cumsum(size) - size
    mark = np.zeros(len(names), dtype=bool)
    order = np.argsort(pairs[:, 0], kind="stable")
    bounds = np.flatnonzero(np.concatenate(([True], np.diff(pairs[order, 0]) != 0, [True]))) if len(order) else np.zeros(1, np.int64)
    good = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        a = pairs[order[lo], 0]
        own = local[begin[a]:begin[a] + size[a]]
        mark[own] = True
        step = max(1, at_once // max(1, int(size[pairs[order[lo:hi], 1]].max())))
        for first in range(lo, hi, step):
            some = order[first:min(hi, first + step)]
            b = pairs[some, 1]
            ends = np.cumsum(size[b])
            rows = np.repeat(begin[b] - (ends - size[b]), size[b]) + np.arange(ends[-1])
            shared = np.add.reduceat(mark[local[rows]].astype(np.int64), ends - size[b])
            good.append(some[100 * shared >= percent * (size[a] + size[b] - shared)])
        mark[own] = False
    return np.concatenate(good) if good else np.zeros(0, np.int64)


def minhash_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) of every row of ``df``."""
    marked = saved(signed(df, id_col, text_col, shingle), "minhash-signed")
    sets = saved(marked.where("key IS NOT NULL").groupBy("key")
                 .agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig"))
                 .withColumn("sid", F.monotonically_increasing_id()), "minhash-sets")
    posted = saved(prefix_postings(sets), "minhash-posted")

    def whole(sids: DataFrame) -> DataFrame:
        wanted = saved(sids.distinct().join(sets.select("sid", "least", "key"), "sid"), "minhash-wanted")
        return saved(whole_sets(df, id_col, text_col, wanted, shingle), "minhash-whole")

    near = saved(enough_matches(hub_pairs(posted), sets), "minhash-hubs")
    links = saved(linked(near, whole(near.select(F.col("a").alias("sid")).union(near.select("b")))), "minhash-links")
    first = saved(components(links).withColumnsRenamed({"node": "sid"}), "minhash-first")
    rest = saved(rest_pairs(posted, sets, first), "minhash-pairs")
    more = saved(linked_within(rest, whole(rest.select(F.explode("sids").alias("sid")))), "minhash-links")
    # classes of classes: links between the first classes' roots
    roots = first.select("sid", "root")
    ends = (more.join(roots.withColumnsRenamed({"sid": "a", "root": "ra"}), "a", "left")
            .join(roots.withColumnsRenamed({"sid": "b", "root": "rb"}), "b", "left")
            .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    second = components(ends).select(F.col("node").alias("root"), F.col("root").alias("top"))
    named = (sets.select("sid", "key", "least").join(first, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
             .join(second, "root", "left").select("key", "least", F.coalesce("top", "root").alias("top")))
    least = named.groupBy("top").agg(F.min("least").alias("component"))
    of_key = named.join(least, "top").select("key", "component")
    out = marked.select("id", "n", "key").join(of_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


#: Exact classes: all pairs that share a shingle, for small tables.
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, hash(unnest(s)) AS g FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS root FROM sizes UNION SELECT e.b, r.root FROM reached r JOIN edges e ON e.a = r.node WHERE r.root < e.b)
SELECT s.doc_id, s.n AS n_shingles, min(r.root) AS component_id, s.doc_id = min(r.root) AS kept
FROM sizes s JOIN reached r ON r.node = s.doc_id GROUP BY s.doc_id, s.n
"""
