"""ML jobs: planted signal beats the prior, attributions add up, forecasts are well formed."""

import pytest
from pyspark.sql import functions as F

from citypulse import contract as C
from citypulse.operators import explain, models
from conftest import SMOKE


@pytest.fixture(scope="module")
def planted(spark):
    df = spark.range(0, 4000).select(F.col("id").alias("dr_no"))
    cols = {c: (F.xxhash64(F.col("dr_no"), F.lit(i)) % 100).cast("double") / 10 for i, c in enumerate(C.NUMERIC_FEATURES)}
    df = df.withColumns(cols)
    df = df.withColumns({"area_name": F.concat(F.lit("A"), (F.col("dr_no") % 5).cast("string")),
                         "victim_sex": F.lit("M"), "victim_descent": F.lit("X"), "part_of_day": F.lit("Morning")})
    return df.withColumn("y", (F.col("hour") > 5).cast("int"))


def test_logreg_learns_planted_signal(spark, planted):
    metrics, fitted, test = models.train_classifier(planted, "y", ("logreg",), sample=None, key="dr_no")
    m = metrics.first()
    assert m.roc_auc > 0.95 and m.accuracy > 0.8
    imp = explain.feature_importances(spark, fitted["logreg"], planted, top=3).collect()
    assert imp[0].feature == "hour"


def test_shapley_local_accuracy(spark, planted):
    _, fitted, _ = models.train_classifier(planted, "y", ("logreg",), sample=None, key="dr_no")
    vals = explain.attribution_values(fitted["logreg"], planted, "dr_no", sample=20, n_samples=4, background=50)
    rows = vals.groupBy("dr_no").agg(F.sum("phi").alias("s"), F.first("fx").alias("fx"),
                                     F.first("fbg").alias("fbg")).collect()
    assert len(rows) == 20
    for r in rows:
        assert r.s == pytest.approx(r.fx - r.fbg, abs=1e-9)


def test_forecast_next_period_shape(spark):
    from citypulse.plans import common
    daily = common.daily(spark, SMOKE)
    model, codes, metrics, preds = models.train_daily_forecaster(daily, max_iter=3)
    out = models.forecast_next_period(daily, model, codes, horizon_days=3)
    n_areas = daily.select("area_id").distinct().count()
    assert out.count() == 3 * n_areas
    assert out.where(F.col("y_pred") < 0).count() == 0
    assert metrics.first().n > 0


def test_saved_model_scores_alone(spark, planted, tmp_path):
    from citypulse.sources import files
    odd = planted.withColumn("area_name", F.when(F.col("dr_no") % 997 == 0, F.lit("it's a \\ rare one")).otherwise(F.col("area_name")))
    fitted = models.train_logreg(odd, "y", max_iter=10)
    files.save_model(fitted.model, str(tmp_path / "m"))
    own = fitted.transform(odd).withColumnRenamed("prob", "own").select(*odd.columns, "own")
    both = models.with_prob(files.load_model(str(tmp_path / "m")).transform(own))
    assert both.agg(F.max(F.abs(F.col("prob") - F.col("own")))).first()[0] == 0
    names = explain.expanded_feature_names(fitted, odd)
    assert sum("infrequent" in n for n in names) == 1


def test_short_area_is_forecast(spark):
    from citypulse.plans import common
    daily = common.daily(spark, SMOKE)
    model, codes, _, _ = models.train_daily_forecaster(daily, max_iter=2)
    last = daily.agg(F.max("date")).first()[0]
    short = daily.where(F.col("date") >= F.date_sub(F.lit(last), 5)).where(F.col("area_id") == daily.first()["area_id"])
    more = daily.unionByName(short.withColumns({"area_id": F.lit(999).cast(daily.schema["area_id"].dataType), "area_name": F.lit("new")}))
    out = models.forecast_next_period(more, model, codes, horizon_days=2)
    assert out.where("area_id = 999").count() == 2


def test_whole_test_side_is_scored(spark, planted):
    metrics, _, test = models.train_classifier(planted, "y", ("logreg",), sample=500, key="dr_no")
    m = metrics.first()
    assert m.tp + m.fp + m.tn + m.fn == test.count() == 800
    assert m.support_1 + m.support_0 == 800 and 0 < m.precision_1 <= 1


def test_training_partitions_are_bounded_by_rows(spark):
    """Partitions that are too large are split, not only small ones merged."""
    frame, n, cached = models.sized_for_training(spark.range(0, 40_000, 1, 6).toDF("x"), rows_per_partition=1000)
    try:
        sizes = frame.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count(F.lit(1))).first()
        assert n == 40_000 == frame.count() and sizes[0] <= 2000 and sizes[1] == 40
    finally:
        cached.unpersist()


def test_rows_that_no_model_sees_are_not_written(spark, planted, monkeypatch):
    """With a sample, the test rows and the sample are stored, and they are those of the exact split."""
    written = {}
    monkeypatch.setattr(models, "stored", lambda df, name: written.setdefault(name, df.localCheckpoint()))
    _, _, test = models.train_classifier(planted, "y", ("logreg",), sample=500, key="dr_no", params={"logreg": {"max_iter": 5}})
    assert {name: df.count() for name, df in written.items()} == {"train": 500, "test": 800, "scored": 800}
    split = models.sampling.stratified_split(planted, "y", 0.8, "dr_no")
    keys = lambda df: {r.dr_no for r in df.select("dr_no").collect()}
    assert keys(test) == keys(split.where("split = 'test'"))
    assert keys(written["train"]) == keys(models.sampling.exact_sample(split.where("split = 'train'"), 500, "dr_no"))
