"""The registered fits run in full: no parameter of a query leaves out rounds, trees, depth or rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from citypulse.operators import boosting, models
from citypulse.plans import common, q_models


class Asked(Exception):
    """Raised instead of a fit, with what it was asked for."""


def instead(monkeypatch, module, name):
    def told(*args, **kw):
        raise Asked(args, kw)
    monkeypatch.setattr(module, name, told)


@pytest.fixture(scope="module")
def panel(spark):
    days = spark.range(420).select(F.date_add(F.lit(dt.date(2021, 1, 4)), F.col("id").cast("int")).alias("date"))
    areas = spark.range(2).select(F.col("id").cast("int").alias("area_id"), F.concat(F.lit("A"), "id").alias("area_name"))
    return days.crossJoin(areas).withColumn("crimes", (F.dayofyear("date") % 7 + F.col("area_id")).cast("long"))


def test_daily_forecaster_may_run_all_rounds(spark, panel, monkeypatch):
    monkeypatch.setattr(common, "daily", lambda *_: panel)
    instead(monkeypatch, boosting, "fit_boosted")
    with pytest.raises(Asked) as asked:
        q_models.q_train_daily_forecaster(spark, "daily")
    assert asked.value.args[0][5:] == (1500, 60)


def test_weekly_forecaster_may_run_all_rounds(spark, panel, monkeypatch):
    monkeypatch.setattr(common, "weekly", lambda *_: panel.where(F.dayofweek("date") == 2))
    instead(monkeypatch, boosting, "fit_boosted")
    with pytest.raises(Asked) as asked:
        q_models.q_train_weekly_forecaster(spark, "weekly")
    assert asked.value.args[0][5:] == (1500, 60)


@pytest.fixture
def no_tables(monkeypatch):
    """The classifier queries read nothing: only what they ask of the fit is looked at."""
    monkeypatch.setattr(common, "_artifact", lambda *_: None)
    monkeypatch.setattr(q_models, "split_features", lambda *_: (None, None))
    monkeypatch.setattr(models, "category_levels", lambda *_: {})
    monkeypatch.setattr(q_models, "_FITTED", {})


def test_random_forest_has_all_trees_at_full_depth(spark, no_tables, monkeypatch):
    instead(monkeypatch, models, "_fit")
    with pytest.raises(Asked) as asked:
        q_models.q_train_random_forest(spark, "rf")
    name, _, target, _ = asked.value.args[0]
    forest = models.classifier(name, target, **asked.value.args[1])
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode()) == (180, 18, 8)


@pytest.mark.parametrize("query", [q_models.q_train_boosted_trees, q_models.q_feature_importances, q_models.q_attribution_summary])
def test_boosted_trees_have_all_rounds(spark, no_tables, monkeypatch, query):
    instead(monkeypatch, models, "_fit")
    with pytest.raises(Asked) as asked:
        query(spark, "gbt")
    name, _, target, _ = asked.value.args[0]
    boosted = models.classifier(name, target, **asked.value.args[1])
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getMinInstancesPerNode()) == (400, 6, 80)


def test_classifiers_see_all_train_rows_and_all_rounds(spark, no_tables, monkeypatch):
    instead(monkeypatch, models, "train_classifier")
    with pytest.raises(Asked) as asked:
        q_models.q_train_classifier(spark, "battery")
    assert asked.value.args[1]["sample"] is None and not asked.value.args[1].get("params")
