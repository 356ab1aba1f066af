"""Rule ensemble: held-out accuracy, agreement of the compiled column with the rules, edge rows."""

import math
import zlib

from citypulse.llm import queries, rule_ensemble
from citypulse.llm.common import table
from conftest import SF001


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op8_rule_ensemble"](spark, SF001).collect()
    truth = {r["doc_id"]: r["quality"] for r in table(spark, SF001, "labels").collect()}
    assert len(rows) == table(spark, SF001, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)


def test_rules_are_conjunctions_with_sparse_weights(spark):
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    model = rule_ensemble.fitted_model(docs, labels)
    assert 0 < len(model.rules) < 200
    rows = rule_ensemble.with_statistics(docs.select("doc_id", "text"), "text").withColumn("s", model.score()).collect()
    for r in rows[:200]:
        z = model.intercept + sum(w for rule, w in model.rules if all(
            r[f"__{n}"] <= v if most else r[f"__{n}"] > v for n, most, v in rule.conditions))
        assert abs(r["s"] - 1 / (1 + math.exp(-z))) < 1e-9


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "x y", 0.5), (4, "word " * 50_000, 0.5),
                                  (4, "word " * 50_000, 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(4, 1), (4, 1), (None, 0), (1, None)], "doc_id long, quality int")
    out = rule_ensemble.classify(docs, labels).collect()
    assert len(out) == 5 and len({r["score"] for r in out}) == 1  # one kind of label: a constant
    assert rule_ensemble.classify(docs, labels.limit(0)).first()["score"] == 0.5
    assert rule_ensemble.classify(docs.limit(0), labels).collect() == []
