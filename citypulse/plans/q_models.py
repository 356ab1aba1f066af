"""Catalog entries for the ML jobs (rows-only checks: no SQL equivalent).

Each returns a small, checkable result (metrics, importances, predictions),
computed from the whole fixture table, with the reference values of the functions'
defaults (forecasters 1500 rounds and a patience of 60, classifiers 400 rounds and 180
trees of depth 18) and all train rows. The
features and their split are written once a session, and a model that one
query has fitted is explained by the others.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from citypulse import contract as C
from citypulse.operators import cleaning, explain, models, sampling
from citypulse.plans import common
from citypulse.plans.catalog import register, rounded

TARGET = "is_violent"


def incident_features(spark, sf):
    return cleaning.build_incident_features(common.clean(spark, sf, "dr_no", *C.INCIDENT_FEATURE_COLUMNS), keep=("dr_no",))


def split_features(spark, sf):
    """Exact 80/20 stratified split, written once a session to the shared folder so model
    fitting does not re-run the upstream joins."""
    f = common._artifact(spark, sf, "ml-features", lambda: incident_features(spark, sf))
    s = common._artifact(spark, sf, "ml-split", lambda: sampling.stratified_split(f, TARGET, 0.8, "dr_no"))
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


_FITTED: dict = {}

FITS = {
    "gbt": lambda spark, sf: models.train_boosted_trees(split_features(spark, sf)[0], TARGET),
    "logreg": lambda spark, sf: models.train_logreg(split_features(spark, sf)[0], TARGET),
    "daily": lambda spark, sf: models.train_daily_forecaster(common.daily(spark, sf)),
}


def fitted(spark, sf, name, anew=False):
    """A model of this session and table; the training queries fit theirs ``anew``, others take what there is."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), name)
    if anew or key not in _FITTED:
        _FITTED[key] = FITS[name](spark, sf)
    return _FITTED[key]


def _test_metrics(model, test, name):
    from citypulse.operators import evaluate
    from citypulse.operators.spatial import _checkpoint
    scored = _checkpoint(model.transform(test).select(TARGET, "prob"))
    bm = evaluate.binary_metrics(scored, TARGET, "prob")
    rm = evaluate.ranking_metrics(scored, TARGET, "prob")
    return rounded(bm.crossJoin(rm).select(F.lit(name).alias("model"), "accuracy", "f1_pos", "f1_macro",
                                           "roc_auc", "pr_auc", "tp", "fp", "tn", "fn"))


@register("feature_pipeline")
def q_feature_pipeline(spark, sf):
    from pyspark.ml import Pipeline
    f = incident_features(spark, sf)
    levels = models.category_levels(f)
    out = Pipeline(stages=models.feature_pipeline(levels)).fit(f).transform(f)
    arr = vector_to_array("features")
    return rounded(out.select("dr_no", F.size(arr).alias("n_features"),
                              F.aggregate(arr, F.lit(0.0), lambda a, x: a + F.abs(x)).alias("l1")))


@register("train_logreg")
def q_train_logreg(spark, sf):
    return _test_metrics(fitted(spark, sf, "logreg", anew=True), split_features(spark, sf)[1], "logreg")


@register("train_random_forest")
def q_train_random_forest(spark, sf):
    train, test = split_features(spark, sf)
    forest = models.train_random_forest(train, TARGET)
    return _test_metrics(forest, test, "rf")


@register("train_boosted_trees")
def q_train_boosted_trees(spark, sf):
    return _test_metrics(fitted(spark, sf, "gbt", anew=True), split_features(spark, sf)[1], "gbt")


@register("train_classifier")
def q_train_classifier(spark, sf):
    """Both targets of the reference's runner with its two models, fitted on all train rows."""
    feats = common._artifact(spark, sf, "ml-features", lambda: incident_features(spark, sf))
    both = [models.train_classifier(feats, target, ("logreg", "gbt"), sample=None, key="dr_no")[0]
            for target in ("is_violent", "is_arrest")]
    return rounded(both[0].unionByName(both[1]))


@register("feature_importances")
def q_feature_importances(spark, sf):
    return rounded(explain.feature_importances(spark, fitted(spark, sf, "gbt"), split_features(spark, sf)[0], top=20))


@register("permutation_importance")
def q_permutation_importance(spark, sf):
    return rounded(explain.permutation_importance(fitted(spark, sf, "logreg"), split_features(spark, sf)[1], TARGET, "dr_no", n_repeats=5, top=15))


@register("attribution_summary")
def q_attribution_summary(spark, sf):
    """Exact attributions of the boosted model, over all test rows."""
    return rounded(explain.attribution_summary(fitted(spark, sf, "gbt"), split_features(spark, sf)[1], "dr_no"))


@register("kmeans_area_archetypes")
def q_kmeans_area_archetypes(spark, sf):
    return rounded(models.kmeans_area_archetypes(common.daily(spark, sf), k=4))


@register("train_daily_forecaster")
def q_train_daily_forecaster(spark, sf):
    return rounded(fitted(spark, sf, "daily", anew=True)[2])


@register("train_weekly_forecaster")
def q_train_weekly_forecaster(spark, sf):
    _, _, metrics, _ = models.train_weekly_forecaster(common.weekly(spark, sf))
    return rounded(metrics)


@register("forecast_next_period")
def q_forecast_next_period(spark, sf):
    model, codes, _, _ = fitted(spark, sf, "daily")
    return rounded(models.forecast_next_period(common.daily(spark, sf), model, codes, horizon_days=7))
