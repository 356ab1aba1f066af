"""MinHash classes against the links of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from citypulse.llm import minhash, queries
from conftest import SMOKE


def plain_set(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else set(w)


def plain_classes(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def family(rng, size, near, words=60):
    """Copies of a text with ``near`` words replaced, and a chain of small changes."""
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(size):
        t = list(base)
        for _ in range(rng.randint(0, near)):
            t[rng.randrange(words)] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(t))
        if rng.random() < 0.2:
            base = t
    return out


@pytest.mark.parametrize("chunk,batch", [(1 << 20, "10000"), (700, "9")])
def test_classes_equal_all_pairs(spark, monkeypatch, chunk, batch):
    """Families of near copies, exact copies, chains, and lists merged in small chunks."""
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    rng = random.Random(11)
    texts = [t for _ in range(6) for t in family(rng, 40, 6)] + [t for _ in range(4) for t in family(rng, 20, 14)]
    texts += ["the same common passage of words that many share " * 2 + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randint(2, 30))) for _ in range(60)]
    texts += [texts[0]] * 30 + ["one", "one", "ONE", "two", "a b", "a b c", "b a"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = got(minhash.minhash_classes(spark.createDataFrame(rows, "doc_id long, text string")))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted = plain_classes(rows)
    assert found == wanted
    assert len({r[2] for r in wanted}) < len(rows) - 100


def test_rest_pairs_find_what_the_hubs_miss(spark, monkeypatch):
    """Without the links of hubs, the merge of the lists alone finds every link."""
    monkeypatch.setattr(minhash, "hub_pairs", lambda posted: posted.select(F.col("sid").alias("a"), F.col("sid").alias("b")).where("false"))
    rng = random.Random(2)
    rows = list(enumerate(t for _ in range(5) for t in family(rng, 30, 8)))
    assert got(minhash.minhash_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == plain_classes(rows)


def test_documents(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(queries.QUERIES["op13_minhash"](spark, SMOKE)) == plain_classes(rows)


def test_edge_cases(spark):
    """Null ids, null and empty texts, repeated rows, one id of two texts, a very long text, clashing columns, no rows."""
    long = " ".join(f"w{k % 7919}" for k in range(60_000))
    rows = [(None, None), (1, None), (2, ""), (2, ""), (3, " \t\n"), (None, "lone text of a null id"), (None, "shared text here"), (9, "shared text here"),
            (4, "Shared TEXT here"), (4, "another text entirely"), (5, long), (6, long + " end"), (6, long + " end"), (7, "x"), (8, "X")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS sid", "'k' AS key", "3 AS n")
    found = got(minhash.minhash_classes(df))
    wanted = [(d, n, c, k or (d is None and c is None)) for d, n, c, k in plain_classes(rows)]
    assert found == sorted(wanted, key=str)
    assert minhash.minhash_classes(df.where("false")).count() == 0


def test_sets_of_hashes_have_the_size_of_the_sets_of_shingles():
    hashes = minhash.Hashes()
    for text in ("a b a b a", "a", "", "b a", "x y z x y"):
        assert len(minhash.shingle_set(text, 2, hashes)) == len(plain_set(text))
    assert set(minhash.shingle_set("a b", 2, hashes)).isdisjoint(minhash.shingle_set("b a", 2, hashes))


@pytest.mark.parametrize("bits", [24, 8])
def test_unwanted_texts_are_left_before_the_shuffle(spark, bits):
    """All wanted rows pass, null ids and repeated rows too, and few others; a full filter loses nothing."""
    rows = spark.createDataFrame([(k, f"t{k}") for k in range(2000)] + [(5, "again"), (None, "n")], "least long, text string")
    wanted = spark.createDataFrame([(k,) for k in range(0, 2000, 20)] + [(5,), (None,)], "id long")
    found = {(r["least"], r["text"]) for r in minhash.maybe_among(rows, "least", wanted, bits).collect()}
    assert found >= {(k, f"t{k}") for k in range(0, 2000, 20)} | {(5, "t5"), (5, "again"), (None, "n")}
    assert len(found) < (110 if bits == 24 else 1500)


def test_texts_of_sets_that_meet_nothing_are_not_shuffled(spark):
    """Only texts that are wanted reach the exact join by id."""
    df = spark.createDataFrame([(k, f"text {k}") for k in range(500)], "doc_id long, text string")
    wanted = spark.createDataFrame([(1, 7, b"k")], "sid long, least long, key binary")
    plan = minhash.whole_sets(df, "doc_id", "text", wanted, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "__bits" in plan[plan.index("LeftSemi"):]
