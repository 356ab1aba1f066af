"""Spark ML jobs: incident classifiers, area archetypes, panel forecasters.

Training data are DataFrames end to end (Spark ML fits with tree/treeAggregate
jobs over the partitions). Train/test frames are persisted once per fit and
released afterwards. Iteration counts default to the reference values, which the
catalog uses too.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse import contract as C
from citypulse.operators import boosting, evaluate, features, sampling
from citypulse.operators.describe import area_profile
from citypulse.operators.histograms import HistogramGBTClassifier
from citypulse.session import scratch_path, stored

#: Level of rare values; starts with a control character, so no plain value equals it.
INFREQUENT = "\u0001infrequent"


# --- feature pipeline ---------------------------------------------------------

def category_levels(train: DataFrame, cats=C.CATEGORICAL_FEATURES, min_frequency: int = 200) -> dict:
    """Per categorical column: (frequent values, rare values) seen in training.

    Computed with one distributed aggregation; only the distinct category
    values (model metadata, like StringIndexer's labels) reach the driver.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in cats])
    counts = (train.select(F.inline(pairs)).where(F.col("val").isNotNull())
              .groupBy("col", "val").count().collect())
    levels = {c: ([], []) for c in cats}
    for r in counts:
        (levels[r["col"]][0] if r["count"] >= min_frequency else levels[r["col"]][1]).append(r["val"])
    return levels


def bucket_rare(levels: dict) -> SQLTransformer:
    """A pipeline stage (saved and loaded with the model): rare training values
    share one level of a reserved name; unseen values stay as they are (the
    indexer then maps them to an all-zero one-hot row)."""
    quoted = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    cols = []
    for c, (_, rare) in levels.items():
        value = f"CAST(`{c}` AS STRING)"
        if rare:
            value = f"CASE WHEN {value} IN ({', '.join(map(quoted, sorted(rare)))}) THEN {quoted(INFREQUENT)} ELSE {value} END"
        cols.append(f"{value} AS `{c}__b`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(cols)} FROM __THIS__")


def feature_pipeline(levels: dict, numeric=C.NUMERIC_FEATURES, cats=C.CATEGORICAL_FEATURES) -> list:
    """Stages: bucket rare levels, index + one-hot the categoricals (unknown -> zeros),
    standardise the numerics, assemble ``features``."""
    idx = [f"{c}__i" for c in cats]
    ohe = [f"{c}__oh" for c in cats]
    return [
        bucket_rare(levels),
        StringIndexer(inputCols=[f"{c}__b" for c in cats], outputCols=idx, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True),
        VectorAssembler(inputCols=list(numeric), outputCol="__num", handleInvalid="keep"),
        StandardScaler(inputCol="__num", outputCol="__num_z", withMean=True, withStd=True),
        VectorAssembler(inputCols=["__num_z", *ohe], outputCol="features"),
    ]


def balanced_weights(df: DataFrame, label: str, out: str = "w") -> DataFrame:
    """Class weights n / (2 n_c) (scikit-learn's 'balanced')."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    total = counts.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k"))
    wt = counts.crossJoin(total).select(label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias(out))
    return df.join(F.broadcast(wt), label)


def classifier(name: str, label: str, **kw):
    if name == "logreg":
        return LogisticRegression(labelCol=label, weightCol="w", maxIter=kw.get("max_iter", 400),
                                  regParam=kw.get("reg_param", 1e-5), elasticNetParam=0.0,
                                  standardization=False)
    if name == "rf":
        return RandomForestClassifier(labelCol=label, weightCol="w", numTrees=kw.get("num_trees", 180),
                                      maxDepth=kw.get("max_depth", 18),
                                      minInstancesPerNode=kw.get("min_leaf", 8), seed=C.SEED)
    if name == "gbt":
        return HistogramGBTClassifier("__num_z", C.CATEGORICAL_FEATURES, labelCol=label, weightCol="w", maxIter=kw.get("max_iter", 400),
                                      stepSize=0.05, maxDepth=kw.get("max_depth", 6),
                                      minInstancesPerNode=kw.get("min_leaf", 80), seed=C.SEED)
    raise ValueError(f"unknown model {name!r}")


@dataclass
class FittedClassifier:
    """A fitted pipeline; ``model`` alone is enough to score, also after saving and loading."""

    name: str
    target: str
    model: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return with_prob(self.model.transform(df))


def with_prob(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prob", vector_to_array("probability")[1])


ROWS_PER_PARTITION = 250_000


def sized_for_training(df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION):
    """Persist a training frame and size its partitions by row count.

    Iterative fitters run one job per iteration / tree level; with a few
    thousand rows per task the per-task cost dominates, with too many rows a
    task spills. The frame is counted, dealt to about ``rows_per_partition`` rows
    per partition (one shuffle if its own partitions are larger, none if they are
    smaller), but to no fewer partitions than there are cores, so that a fit never
    runs in one task, and cached so, on disk: a fitter reads it a few times and
    keeps what it iterates over in memory itself. Returns (frame, row count, cached frame to
    unpersist).
    """
    from pyspark import StorageLevel
    n = df.count()
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-n // rows_per_partition))
    have = df.rdd.getNumPartitions()
    cached = (df.repartition(wanted) if have < wanted else df.coalesce(wanted)).persist(StorageLevel.DISK_ONLY)
    return cached, n, cached


def _fit(name: str, train: DataFrame, target: str, levels: dict, **kw) -> FittedClassifier:
    cols = [*C.NUMERIC_FEATURES, *C.CATEGORICAL_FEATURES, target]
    prepared, n, cached = sized_for_training(balanced_weights(train.select(*cols), target))
    try:
        if name == "logreg" and "reg_param" not in kw:
            # liblinear C = 1 on a weighted loss sum equals regParam = 1 / sum(weights);
            # balanced weights sum to the row count
            kw["reg_param"] = 1.0 / max(1, n)
        pipe = Pipeline(stages=feature_pipeline(levels) + [classifier(name, target, **kw)])
        model = pipe.fit(prepared)
    finally:
        cached.unpersist()
    # as saved and loaded: without the training summary, which keeps the session (and what it observes) in the scoring closures
    path = scratch_path(train.sparkSession, f"ml-model-{name}")
    model.write().save(path)
    return FittedClassifier(name, target, PipelineModel.load(path))


def train_logreg(train: DataFrame, target: str, levels: dict | None = None, **kw) -> FittedClassifier:
    return _fit("logreg", train, target, levels or category_levels(train), **kw)


def train_random_forest(train: DataFrame, target: str, levels: dict | None = None, **kw) -> FittedClassifier:
    return _fit("rf", train, target, levels or category_levels(train), **kw)


def train_boosted_trees(train: DataFrame, target: str, levels: dict | None = None, **kw) -> FittedClassifier:
    return _fit("gbt", train, target, levels or category_levels(train), **kw)


def train_classifier(feats: DataFrame, target: str, models=("logreg", "rf", "gbt"), test_size: float = 0.2,
                     sample: int | None = 250_000, params: dict | None = None, key: str = "row_id"):
    """Stratified split of all rows -> fit each model -> metrics over the whole test side.

    ``sample`` bounds only the rows a model is *fitted* on (an exact seeded sample of
    the train side; None: all of it). ``feats`` is read several times (give a stored
    table); what is written to the shared folder are the test rows and the rows fitted
    on, not the train rows that no model sees. Returns (metrics DataFrame with one row per model, with precision,
    recall and support of both classes, {name: FittedClassifier}, test DataFrame).
    """
    params = params or {}
    split = sampling.stratified_split(feats.where(F.col(target).isNotNull()), target, 1 - test_size, key, levels=14, first_k=sampling.first_k_one_pass)
    if sample is None:
        split = stored(split, "split")
    train, test = (split.where(F.col("split") == side) for side in ("train", "test"))
    if sample is not None:
        train, test = stored(sampling.exact_sample(train, sample, key, first_k=sampling.first_k_one_pass), "train"), stored(test, "test")
    levels = category_levels(train)
    fitted, rows = {}, []
    for name in models:
        fc = _fit(name, train, target, levels, **params.get(name, {}))
        fitted[name] = fc
        scored = stored(fc.transform(test).select(target, "prob"), "scored")
        bm = evaluate.binary_metrics(scored, target, "prob")
        rm = evaluate.ranking_metrics(scored, target, "prob")
        rows.append(bm.crossJoin(rm).select(F.lit(target).alias("target"), F.lit(name).alias("model"),
                                            "accuracy", "f1_pos", "f1_macro", "roc_auc", "pr_auc",
                                            "tp", "fp", "tn", "fn", *per_class_report()))
    metrics = rows[0]
    for r in rows[1:]:
        metrics = metrics.unionByName(r)
    return metrics, fitted, test


def per_class_report() -> list:
    """Precision, recall and support of both classes from the confusion counts."""
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return [share(tp, tp + fp).alias("precision_1"), share(tp, tp + fn).alias("recall_1"), (tp + fn).alias("support_1"),
            share(tn, tn + fn).alias("precision_0"), share(tn, tn + fp).alias("recall_0"), (tn + fp).alias("support_0")]


# --- area archetypes ----------------------------------------------------------

def kmeans_area_archetypes(daily: DataFrame, k: int = 4, n_init: int = 10, seed: int = C.SEED) -> DataFrame:
    """Cluster areas by daily profile (z-scored), best of ``n_init`` seeds by
    training cost; archetype ids renumbered by mean crimes, highest first."""
    prof = area_profile(daily).fillna(0.0)
    cols = ["mean_crimes", "std_crimes", "violent", "arrest"]
    prep = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="__x"),
                            StandardScaler(inputCol="__x", outputCol="features", withMean=True, withStd=True)])
    z = prep.fit(prof).transform(prof).persist()
    best, best_cost = None, None
    for i in range(n_init):
        m = KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol="__c").fit(z)
        cost = m.summary.trainingCost
        if best_cost is None or cost < best_cost:
            best, best_cost = m, cost
    labelled = best.transform(z)
    order = labelled.groupBy("__c").agg(F.avg("mean_crimes").alias("__m"))
    order = order.withColumn("archetype", (F.row_number().over(Window.orderBy(F.col("__m").desc(), "__c")) - 1))
    out = labelled.join(F.broadcast(order), "__c").select("area_id", "area_name", *cols,
                                                         F.col("archetype").cast("int"))
    z.unpersist()
    return out


# --- panel forecasters ----------------------------------------------------------

def _forecast_fit(p: DataFrame, feats, test_n: int, val_n: int, unit_days: int, naive: str,
                  max_iter: int, patience: int | None, **params):
    codes = sampling.area_code_map(p)
    p = p.join(F.broadcast(codes), "area_id")
    data = stored(sampling.forward_chained_split(p, test_n, val_n, unit_days=unit_days), "forecast")
    # areas are a nominal feature; one code more stands for areas unknown to the fit
    model = boosting.fit_boosted(data.where(F.col("split") != "test").withColumn("__is_val", F.col("split") == "val"), "crimes", "__is_val", feats,
                                 {"area_code": codes.count() + 1}, max_iter, patience, **params)
    test = model.transform(data.where(F.col("split") == "test"))
    preds = stored(test.select("date", "area_id", "area_code", "area_name", F.col("crimes").alias("y_true"),
                               F.greatest(F.col("prediction"), F.lit(0.0)).alias("y_pred"),
                               F.col(naive).alias("naive")), "forecast-test")
    metrics = evaluate.regression_metrics(preds, "y_true", "y_pred", "naive")
    span = preds.agg(F.min("date").alias("test_start"), F.max("date").alias("test_end"))
    metrics = metrics.crossJoin(span).withColumns({"rounds": F.lit(len(model.errors)), "best_round": F.lit(model.best)})
    return model, codes, metrics, preds.drop("naive")


def train_daily_forecaster(panel: DataFrame, horizon_days: int = 28, test_days: int = 60,
                           val_days: int = 60, max_iter: int = 1500, feats=C.DAILY_FORECAST_FEATURES,
                           patience: int | None = 60, **params):
    """Global boosted-tree forecaster over the daily area panel (see :mod:`citypulse.operators.boosting`):
    at most ``max_iter`` rounds, stopped when the validation error has not fallen for ``patience``.

    Returns (model, area code map, metrics, test predictions). ``horizon_days``
    is recorded in the metrics only.
    """
    p = features.add_lag_features(panel).dropna(subset=["lag_28", "roll_mean_28", "adow_mean"])
    model, codes, metrics, preds = _forecast_fit(p, feats, test_days, val_days, 1, "roll_mean_28", max_iter, patience, **params)
    metrics = metrics.withColumn("horizon_days", F.lit(horizon_days))
    return model, codes, metrics, preds


def train_weekly_forecaster(weekly: DataFrame, test_weeks: int = 8, val_weeks: int = 8,
                            max_iter: int = 1500, feats=C.WEEKLY_FORECAST_FEATURES, patience: int | None = 60, **params):
    p = features.weekly_lag_features(weekly).dropna(subset=["lag_8", "roll_mean_12"])
    model, codes, metrics, preds = _forecast_fit(p, feats, test_weeks, val_weeks, 7, "roll_mean_4", max_iter, patience, **params)
    metrics = metrics.withColumn("horizon_days", F.lit(7 * test_weeks))
    return model, codes, metrics, preds


def _next_features(values: np.ndarray, day, code: int, feats) -> list[float]:
    """Features of ``day`` after the ``values`` of the days before it (missing: NaN)."""
    def feature(name: str) -> float:
        kind, _, n = name.rpartition("_")
        if kind == "lag":
            return values[-int(n)] if len(values) >= int(n) else np.nan
        if kind in ("roll_mean", "roll_std"):
            last = values[-int(n):]
            if len(last) < int(n) or np.isnan(last).any():
                return np.nan
            return last.mean() if kind == "roll_mean" else last.std(ddof=1)
        dow = day.weekday()
        return float({"dow": dow, "month": day.month, "year": day.year, "doy": day.timetuple().tm_yday, "weekofyear": day.isocalendar()[1],
                      "is_weekend": int(dow >= 5), "area_code": code}[name])
    return [feature(f) for f in feats]


def forecast_next_period(panel: DataFrame, model: boosting.BoostedTrees, codes: DataFrame, horizon_days: int = 7,
                         history_days: int = 90) -> DataFrame:
    """Recursive h-step forecast: each day's clipped prediction becomes history
    for the next day's lags and rolling windows.

    One job, whatever the horizon: an area's state is the last ``history_days``
    days (the longest window), and the recursion runs over it in one group per
    area; the group's size is that of the history, not of the incidents. An
    expanding feature would need all history and is refused. An area too short
    to train on gets a forecast under a code that no other area has.
    """
    feats = list(model.features)
    if "adow_mean" in feats:
        raise ValueError("adow_mean is a mean over all history; forecast_next_period keeps only the last days")
    last = panel.agg(F.max("date").alias("__last"))
    unknown = codes.agg((F.coalesce(F.max("area_code"), F.lit(-1)) + 1).cast("int").alias("__unknown"))
    hist = (panel.crossJoin(F.broadcast(last)).where(F.col("date") > F.date_sub("__last", history_days))
            .join(codes, "area_id", "left").crossJoin(F.broadcast(unknown))
            .select("date", "area_id", "area_name", F.col("crimes").cast("double").alias("crimes"), "__last",
                    F.coalesce("area_code", "__unknown").alias("area_code")))
    shared = panel.sparkSession.sparkContext.broadcast(model)
    types = dict(panel.dtypes)

    def run(group):
        group = group.sort_values("date")
        values, first = group["crimes"].to_numpy(), group.iloc[0]
        days = [first["__last"] + datetime.timedelta(days=k) for k in range(1, horizon_days + 1)]
        for day in days:
            x = np.array([_next_features(values, day, first["area_code"], feats)])
            values = np.append(values, max(shared.value.predict(x)[0], 0.0))
        return pd.DataFrame({"date": days, "area_id": first["area_id"], "area_name": first["area_name"], "y_pred": values[len(values) - len(days):]})

    # an area id has one name in a panel; areas are told apart by both, as in the panel's key
    return hist.groupBy("area_id", "area_name").applyInPandas(
        run, f"date date, area_id {types['area_id']}, area_name {types['area_name']}, y_pred double")
