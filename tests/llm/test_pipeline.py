"""The pipeline stage by stage against the operators' brute-force versions, and on edge rows."""

import duckdb

import corpus_pipeline
from citypulse.llm import mixing, rule_ensemble
from citypulse.llm.common import saved, table
from conftest import SMOKE
from test_decontam import brute
from test_simhash import plain_classes


def cut(rows, length=200):
    """Brute force of the repeat removal, on characters' bytes."""
    data = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in data:
        for p in range(len(b) - length + 1):
            seen[b[p:p + length]] = seen.get(b[p:p + length], 0) + 1
    out = {}
    for (d, _), b in zip(rows, data):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\x01" * length
        out[d] = bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "ignore")
    return out


def test_stages_against_brute_force(spark, tmp_path):
    docs = table(spark, SMOKE, "documents")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], SMOKE), "test-stage"))
        assert name == "source_mixing" or out[-1].columns == columns
    texts = [{r["doc_id"]: r["text"] for r in d.collect()} for d in out]
    model = rule_ensemble.classify(docs, table(spark, SMOKE, "labels"))
    assert texts[1].keys() == {r["doc_id"] for r in model.where("predicted = 1").collect()}
    assert texts[2].keys() == {c for _, _, c in plain_classes(texts[1].items())}
    assert texts[3] == cut(list(texts[2].items()))
    items = [tuple(r) for r in table(spark, SMOKE, "benchmark").collect()]
    hits = brute(list(texts[3].values()), items)
    assert texts[4].keys() == {d for d, h in zip(texts[3], hits) if not h}
    out[4].toPandas().to_parquet(tmp_path / "d.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d.parquet'")
    want = sorted(con.execute(mixing.ORACLE_SQL).fetchall())
    got = sorted(tuple(r) for r in out[5].select("doc_id", "domain", "lang", "source", "epoch", "n_tokens").collect())
    assert got == want and steps


def test_edge_rows(spark):
    clean = " ".join(f"word{i} goes" for i in range(200)) + "."
    rows = [(1, clean, "en", "src1", 5), (1, clean, "en", "src1", 5), (None, clean + " More here now.", None, None, None),
            (3, None, "en", "src2", None), (4, "", "de", "", 0), (5, "other " + " ".join(f"x{i}" for i in range(30_000)), "fr", "src12", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for use in (docs, docs.limit(0)):
        out = use
        for _, stage in corpus_pipeline.STAGES:
            out = saved(stage(spark, out, SMOKE), "test-edge")
        assert out.count() <= 12 and (use is docs) == (out.count() > 0)
    alone = corpus_pipeline.near_copies(spark, docs, SMOKE).collect()
    assert sorted(str(r["doc_id"]) for r in alone if r["text"] and len(r["text"]) < 10_000)[:1] == ["1"]
