"""GRU scores: gradients by differences, a proper distribution, base counts by brute force, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from citypulse.llm import gru, lm_score, queries
from citypulse.llm.common import table
from conftest import SMOKE


def small_params():
    rng = np.random.default_rng(1)
    p = gru.initial(rng.integers(1, 90, gru.FREQUENT).astype(float), rng.integers(1, 90, gru.SHAPES).astype(float))
    return {k: v.astype(np.float64) for k, v in p.items()}


def test_gradients_match_differences():
    p, rng = small_params(), np.random.default_rng(2)
    x = rng.integers(0, gru.START, (5, 3))
    x[0] = gru.START
    x[3, 1] = gru.START
    y = rng.integers(0, gru.START, (5, 3))
    h0 = np.zeros((3, gru.HIDDEN))
    _, grads, _ = gru.gradients(p, x, y, h0)
    for name, at in (("U", (3, 40)), ("U", (2, 60)), ("X", (int(x[1, 0]), 7)), ("X", (gru.START, 55)), ("C", (4, 20)),
                     ("u", (50,)), ("w", (int(gru.class_of(y)[0, 0]) % gru.GROUPS, 3))):
        eps, old = 1e-4, p[name][at]
        p[name][at] = old + eps
        up = gru.gradients(p, x, y, h0)[0]
        p[name][at] = old - eps
        down = gru.gradients(p, x, y, h0)[0]
        p[name][at] = old
        assert abs((up - down) / (2 * eps) - grads[name][at]) < 2e-3 * max(1, abs(grads[name][at])), (name, at)


def test_symbols_sum_to_one_and_state_carries_over_windows():
    p = gru.initial(np.ones(gru.FREQUENT), np.ones(gru.SHAPES))
    h = np.random.default_rng(0).standard_normal((1, gru.HIDDEN)).astype(np.float32)
    every = np.arange(gru.FREQUENT + gru.SHAPES)
    assert abs(np.exp(gru.log_probs(p, np.repeat(h, len(every), 0), every)).sum() - 1) < 1e-4
    texts = [np.append(np.random.default_rng(i).integers(0, gru.START, n), gru.END) for i, n in enumerate((0, 3, 50, 200))]
    together = gru.score_all(p, texts)
    for t, got in zip(texts, together):
        h, last, total = np.zeros((1, gru.HIDDEN), np.float32), gru.START, 0.0
        for s in t:
            h, _ = gru.step(p, np.array([last]), h)
            total += gru.log_probs(p, h, np.array([s]))[0]
            last = s
        assert abs(total - got) < 1e-3 * max(1, abs(total))


def plain_base(rows):
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    c = Counter()
    for d, t in rows:
        if not held[d]:
            c.update([*(t or "").encode().lower().split(), None])
    n, z = sum(c.values()), math.log10(sum(c.values()) + 0.1 * (len(c) + 1))
    out = {}
    for d, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        out[d] = (held[d], len(tokens), sum(c[w] > 0 for w in tokens), n, sum(math.log10(c[w] + 0.1) - z for w in tokens))
    return out


def test_query_counts_and_gain(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "HEAD", 3000)
    rows = [tuple(r) for r in table(spark, SMOKE, "documents").select("doc_id", "text").collect()]
    want = plain_base(rows)
    got = {r["doc_id"]: r for r in queries.QUERIES["op2_lm_score"](spark, SMOKE).collect()}
    assert got.keys() == want.keys()
    for d, w in want.items():
        g = got[d]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == w[:4], d
        assert abs(g["base_score"] - w[4]) < 1e-6 * max(1, abs(w[4]))
    held = [g for g in got.values() if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "", "x"), (3, "a b " * 30_000, "x"),
                                (4, "never seen", "x")], "doc_id long, text string, score string")
    rows = lm_score.lm_scores(df).collect()
    assert len(rows) == 5
    assert {r["n_tokens"] for r in rows} == {1, 60_001, 3}
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert lm_score.lm_scores(df.limit(0)).collect() == []


def test_whole_training_sees_every_symbol_once(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(0, gru.START, n), gru.END).astype(np.int16) for n in (0, 5, 900, 17, 3000, 1, 40)]
    seen, plain = Counter(), gru.gradients

    def counted(p, x, y, h):
        seen.update(zip(x.ravel().tolist(), y.ravel().tolist()))
        return plain(p, x, y, h)

    monkeypatch.setattr(gru, "gradients", counted)
    p = gru.initial(np.ones(gru.FREQUENT), np.ones(gru.SHAPES))
    trained = gru.train_whole(p, texts, width=16)
    assert seen == Counter(pair for t in texts for pair in zip([gru.START, *t.tolist()], t.tolist()))
    assert all(np.isfinite(v).all() for v in trained.values())


def test_every_training_text_trains_the_model_whatever_its_id(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "WARM_TOKENS", 50)
    df = spark.createDataFrame([(None, f"only{i} and word{i % 7}") for i in range(300)], "id long, text string").withColumn("held_out", F.lit(False))
    vocab = lm_score.vocabulary(df, lm_score.word_counts(df.select("text")))
    moved = (lm_score.fitted(lm_score.encoded(df, vocab), vocab)["X"] != gru.initial(*vocab.start)["X"]).any(axis=1)
    assert moved[:len(vocab.index)].all() and moved[gru.START]


def test_scores_do_not_depend_on_the_split(spark, monkeypatch):
    """One or many partitions, rows in any order, several shares added up in levels, equal rows among them."""
    monkeypatch.setattr(lm_score, "SHARE_TOKENS", 6000)
    monkeypatch.setattr(lm_score, "FAN_IN", 3)
    docs = table(spark, SMOKE, "documents").select("doc_id", "text").where(F.length("text") < 2000)
    docs = docs.union(docs.where("doc_id = 3")).union(docs.where("doc_id = 3"))
    got = [sorted((r["doc_id"], round(r["score"], 3), round(r["base_score"], 6)) for r in lm_score.lm_scores(d).collect())
           for d in (docs.coalesce(1), docs.orderBy(F.xxhash64("text")).repartition(9))]
    for a, b in zip(*got):
        assert a[0] == b[0] and a[2] == b[2] and abs(a[1] - b[1]) < 2e-3 * max(1, abs(a[1]))
