"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from citypulse.llm import spelling
from conftest import SMOKE


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=10):
    form, out = {}, {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = len(close)
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, out[w], counts[form[w]] if form[w] else None))
    return rows


def got(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.parametrize("range_words,batch", [(1 << 16, "10000"), (16, "7")])
def test_forms_equal_brute_force(spark, monkeypatch, range_words, batch):
    """Many near words, runs of equal letters, words that are prefixes of others, chains of forms."""
    monkeypatch.setattr(spelling, "RANGE_WORDS", range_words)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rng = random.Random(5)
        words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(400)} | {"a" * k for k in range(1, 9)}
        counts = {w: rng.choice((2, 3, 20, 25, 200, 250, 3000)) for w in words}
        df = spark.createDataFrame(list(counts.items()), "word string, n long")
        found = spelling.variant_forms(df)
        assert found.count() == len(counts)
        assert got(found) == brute(counts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nodes_are_numbered_once():
    words = sorted({"ab", "abc", "abd", "b", "ba", "bab"})
    shared = {"a": -1, "ab": -2}
    numbers, lengths = spelling.node_paths(words, 100, shared)
    at, prefix_of = 0, {}
    for w, k in zip(words, lengths):
        for d in range(k):
            assert prefix_of.setdefault(w[:d], numbers[at + d]) == numbers[at + d]
        at += k
    assert len(set(prefix_of.values())) == len(prefix_of) and prefix_of["ab"] == -2


def plain_words(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def test_query_on_documents(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    rows = [(r[0], r[1]) for r in docs.collect()]
    counts = plain_words(rows)
    found = {r["word"]: r for r in spelling.query(docs).collect()}
    assert {w: r["n"] for w, r in found.items()} == counts
    rng = random.Random(1)
    for w in rng.sample(sorted(counts), 200):
        close = [v for v in counts if abs(len(v) - len(w)) <= 1 and near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        has = best is not None and counts[best] >= 10 * counts[w]
        assert (found[w]["n_near"], found[w]["form"], found[w]["form_n"]) == (len(close), best if has else None, counts[best] if has else None)
    assert any(r["form"] for r in found.values())


def test_edge_cases(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns, an empty table."""
    rows = [(None, "Misspell misspell", 1), (None, None, 2), (1, "", 3), (1, "ÉTUDIANT Étudiant étudiant", 4), (1, "ÉTUDIANT Étudiant étudiant", 4), (2, "longword " * 50_000, 5), (3, "short × word", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, wid long").selectExpr("*", "text AS word", "doc_id AS n", "1 AS p", "2 AS shard")
    assert {r["word"]: r["n"] for r in spelling.query(df).collect()} == plain_words([r[:2] for r in rows])
    empty = spelling.query(df.where("false"))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]
