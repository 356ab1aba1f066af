"""Suffix arrays and repeat removal against brute force."""

import hashlib
import random

import numpy as np
import pytest

from citypulse.llm import queries, suffix_dedup
from citypulse.llm.common import table
from citypulse.llm.suffix_array import common_prefixes, joined, suffix_array
from conftest import SMOKE


def plain(rows, length=200):
    seen = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for k, (_, b) in enumerate(data):
        for p in range(len(b) - length + 1):
            h = hash(b[p:p + length])
            seen[h] = seen.get(h, 0) + 1
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 1, dtype=np.int8)
        for p in range(len(b) - length + 1):
            if seen[hash(b[p:p + length])] > 1:
                gone[p:p + length] = 1
        spans = int((np.diff(np.concatenate(([0], gone))) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    segs = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randrange(0, 60))) for _ in range(40)] + [b"abab" * 30] * 3
    data, starts = joined(segs)
    sa, rank = suffix_array(data)
    assert sorted(sa.tolist()) == list(range(len(data))) and (rank[sa] == np.arange(len(data))).all()
    tails = {int(s) + i: seg[i:] for s, seg in zip(starts, segs) for i in range(len(seg))}
    order = [tails[p] for p in sa.tolist() if p in tails]
    assert order == sorted(order)
    shared = common_prefixes(data, starts, sa, rank, 50)
    for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()):
        if b in tails:
            x, y = tails.get(a, b""), tails[b]
            n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert shared[b] == min(n, 50)


@pytest.mark.parametrize("shard", [3, 4000])
def test_random_repeats(spark, shard):
    rng = random.Random(shard)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [text(rng.randrange(150, 500)) for _ in range(6)]
    line = text(120)
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 300))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(0, 40)
            parts += [s[a:len(s) - rng.randrange(0, 40)], text(rng.randrange(0, 200))]
        if i % 2:
            parts += [line, text(rng.randrange(30, 200))]
        rows.append((i, "".join(parts)))
    rows += [(100, rows[3][1]), (101, None), (102, ""), (103, "z" * 700), (104, "xy" * 300), (105, "ab " * 66),
             (106, text(199)), (107, shared[0][:200]), (108, shared[1] + shared[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffix_dedup.remove_repeats(df, shard=shard).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(out) == plain(rows)


def test_long_text_repeated_rows_null_ids_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 5000)
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(30_000))
    rows = [(1, long), (2, long[12_000:12_450] + "tail" + long[4900:5300]), (None, "q" * 250), (4, "one row " * 20),
            (4, "one row " * 20), (4, "another text of the id " + "".join(rng.choice("xyz") for _ in range(300)))]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n_spans string")
    out = suffix_dedup.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(out) == plain(rows)
    assert suffix_dedup.query(df.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SMOKE, "documents").select("doc_id", "text").collect()]
    assert got(queries.QUERIES["op7_suffix_dedup"](spark, SMOKE)) == plain(rows)
