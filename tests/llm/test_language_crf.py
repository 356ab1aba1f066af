"""Language field: marginals by enumeration, held-out accuracy, switched text, edge rows."""

import itertools
import zlib

import numpy as np

from citypulse.llm import language_crf, queries
from citypulse.llm.common import table
from conftest import SF001


def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    lens = np.array([4, 3, 1])
    emit, start, move = rng.standard_normal((8, 3)), rng.standard_normal(3), rng.standard_normal((3, 3))
    got = language_crf.forward_backward(emit, lens, start, move)
    at = 0
    for n in lens:
        want = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            s = start[path[0]] + sum(emit[at + t, y] for t, y in enumerate(path)) + sum(
                move[a, b] for a, b in zip(path, path[1:]))
            for t, y in enumerate(path):
                want[t, y] += np.exp(s)
        assert np.allclose(got[at:at + n], want / want.sum(axis=1, keepdims=True), atol=1e-6)
        at += n


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in table(spark, SF001, "documents").select("doc_id", "lang").collect()}
    rows = queries.QUERIES["op10_language_crf"](spark, SF001).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_switched_text_and_edge_rows(spark):
    en = "the house and the garden of that old man with his three children who were there "
    de = "das haus und der garten von dem alten mann mit seinen drei kindern die dort waren "
    rows = [(i, en if i % 2 else de, "en" if i % 2 else "de") for i in range(60)]
    more = [(100, en * 3 + de, None), (101, None, None), (102, " 12 %% \n", None), (103, "", "en"), (None, de, None),
            (104, en * 5000, None), (104, en * 5000, None), (105, "漢字 かな", None), (106, "… — 😀", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows + more], "doc_id long, text string, lang string, score int")
    out = [r for r in language_crf.identify(df).collect() if r["doc_id"] is None or r["doc_id"] >= 100]
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(more)
    assert by[100]["lang_pred"] == "en" and 0.6 < by[100]["score"] < 0.9 and by[100]["lang_shares"]["de"] > 0.1
    assert [by[i]["lang_pred"] for i in (101, 102, 103, 106)] == ["und"] * 4
    assert by[None]["lang_pred"] == "de" and by[104]["lang_pred"] == "en" and by[105]["lang_pred"] in ("de", "en")
    assert language_crf.identify(df.where("lang is null and doc_id = 100")).first()["lang_pred"] == "und"
    assert language_crf.identify(df.limit(0)).collect() == []


def test_rows_of_one_id_and_equal_rows(spark):
    """All texts under one id still teach their languages; the order and split of the rows change nothing."""
    docs = table(spark, SF001, "documents").where("lang IN ('en', 'fr')").selectExpr("7L AS doc_id", "text", "lang", "doc_id AS own")
    docs = docs.union(docs.where("own < 20")).union(docs.where("own < 20"))
    got = [language_crf.identify(d).select("own", "lang", "lang_pred", "score").collect() for d in (docs.coalesce(1), docs.repartition(5, "own"))]
    right = [r["lang"] == r["lang_pred"] for r in got[0]]
    assert sum(right) > 0.9 * len(right)
    known = {r["own"]: (r["lang_pred"], r["score"]) for r in got[0]}
    assert all(known[r["own"]][0] == r["lang_pred"] and abs(known[r["own"]][1] - r["score"]) < 1e-4 for r in got[1])
