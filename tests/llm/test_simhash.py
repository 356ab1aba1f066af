"""SimHash classes against brute force, on a table slice-free sf0.001 and on hand-made rows."""

import random

import numpy as np
import pytest
import xxhash

from citypulse.llm import queries, simhash
from citypulse.llm.common import table
from conftest import SMOKE


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows, max_bits=2):
    fps = {d: plain_fingerprint(t) for d, t in rows}
    ids = sorted(fps)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(d, f"{fps[d]:016x}", find(d)) for d in ids}


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SMOKE, "documents").select("doc_id", "text").collect()]
    got = {tuple(r) for r in queries.QUERIES["op5_simhash"](spark, SMOKE).collect()}
    assert got == plain_classes(rows)


@pytest.mark.parametrize("leaf_size", [4, 64, 100_000])
def test_trie_links_any_cut(spark, leaf_size):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = {0, 3, *base}
    for b in base[:30]:
        for _ in range(4):
            fps.add(b ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    from citypulse.llm.graph import components
    roots = {r["node"]: r["root"] for r in components(simhash.trie_links(df, 2, leaf_size)).collect()}
    got = {}
    for x in signed:
        got.setdefault(roots.get(x, x), set()).add(x)
    label = {x: x for x in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    want = {}
    for x, s in zip(fps, signed):
        want.setdefault(label[x], set()).add(s)
    assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values()}


def test_nulls_empty_repeats_and_other_columns(spark):
    df = spark.createDataFrame(
        [(1, None, 9), (2, "", 9), (3, " \t\n", 9), (None, "a b c d", 9), (7, "A B c  d", 9), (7, "a b c d", 9),
         (8, "x" * 50_000, 9), (9, "w " * 70_000, 9)],
        "doc_id long, text string, fingerprint int")
    rows = simhash.simhash_classes(df).collect()
    assert len(rows) == 8
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["fingerprint"], r["component_id"]))
    assert {by[i][0] for i in (1, 2, 3)} == {("0" * 16, 1)}
    assert by[None][0][1] == 7 and len(by[7]) == 2 and by[7][0] == by[7][1]
    assert by[9][0][0] == f"{plain_fingerprint('w w w'):016x}"


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_classes(df).collect() == []
