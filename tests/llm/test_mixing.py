"""Mixing: SQL oracle, budgets against a plain water filling, edge rows."""

import random
from fractions import Fraction

import pytest

from citypulse.llm import mixing, queries
from conftest import SF001
from oracle import compare, duck


def test_query_matches_sql(spark):
    rep = compare(spark, "op6", queries.QUERIES["op6_mix_sources"], queries.ORACLES["op6_mix_sources"], SF001, duck(SF001))
    assert rep["ok"], rep


def plain_fill(budget, caps, weights):
    given = {}
    open_ = [k for k in caps if weights[k] > 0]
    left = budget
    while True:
        price = Fraction(left, sum(weights[k] for k in open_)) if open_ else 0
        full = [k for k in open_ if caps[k] <= price * weights[k]]
        if not full:
            break
        for k in full:
            given[k] = caps[k]
            left -= caps[k]
            open_.remove(k)
    return given | {k: price * weights[k] // 1 for k in open_}


@pytest.mark.parametrize("seed", [1, 2])
def test_budgets(spark, seed):
    rng = random.Random(seed)
    leaves = [(f"=d{d}", f"=l{x}", f"=s{s}", rng.choice([5, 40, 300, 5000])) for d in range(3) for x in range(3)
              for s in range(rng.randrange(1, 4))]
    weights = {"__domain": {"=d0": 6, "=d1": 3, "=d2": 0}, "__lang": {"=l0": 4}, "__source": {"=s1": 7}}
    total = sum(t for *_, t in leaves)
    df = spark.createDataFrame(leaves, "__domain string, __lang string, __source string, tokens long")
    got = {tuple(r[:3]): r["given"] for r in mixing.budgets(df, total * 8 // 10, 2, weights).collect()}
    want = {}
    w = lambda lvl, k: weights[lvl].get(k, 1)
    cap = lambda *p: sum(2 * t for *k, t in leaves if tuple(k[:len(p)]) == p)
    domains = sorted({x[0] for x in leaves})
    for d, b in plain_fill(total * 8 // 10, {d: cap(d) for d in domains}, {d: w("__domain", d) for d in domains}).items():
        langs = sorted({x[1] for x in leaves if x[0] == d})
        for x, c in plain_fill(b, {x: cap(d, x) for x in langs}, {x: w("__lang", x) for x in langs}).items():
            sources = sorted({y[2] for y in leaves if y[:2] == (d, x)})
            for s, g in plain_fill(c, {s: cap(d, x, s) for s in sources}, {s: w("__source", s) for s in sources}).items():
                want[d, x, s] = g
    assert got == want


def test_prefixes_epochs_and_edge_rows(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"src{i % 2}") for i in range(400)]
    rows += [(None, "a b", None, None), (None, "a b", None, None), (900, None, "en", "src0"), (901, "", "de", ""),
             (902, "x " * 30_000, "fr", "src12"), (3, "same id", "en", "src1")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, source string, epoch string")
    out = mixing.mix(df, budget_pct=150, max_epochs=3, weights={"__domain": {"books": 1, "web": 9}}).collect()
    by_leaf = {}
    for r in out:
        by_leaf.setdefault((r["lang"], r["source"]), []).append(r)
    total = sum(len((t or "").split()) for _, t, _, _ in rows)
    assert sum(r["n_tokens"] for r in out) <= total * 1.5 + 31_000
    for leaf, got in by_leaf.items():
        last = max(r["epoch"] for r in got)
        members = [r for r in rows if r[2:] == leaf]
        for e in range(last):
            assert sorted(str(r["doc_id"]) for r in got if r["epoch"] == e) == sorted(str(m[0]) for m in members)
    assert mixing.mix(df.limit(0)).collect() == []
    assert sorted(map(str, mixing.mix(df).collect())) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))
