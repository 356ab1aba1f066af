"""Composite area risk: component aggregates, min-max scaling, rank, tiers.

The only pass over the panel is one conditional aggregation over the last
``trend_long`` days; scaling, ranking and tiering then run on the per-area
table (one row per area).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse import contract as C


def min_max_scale(df: DataFrame, cols, suffix: str = "_n") -> DataFrame:
    """Scale each column to [0, 1]; a constant or empty column scales to 0."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    stats = df.agg(*[x for c in cols for x in (F.min(c).alias(f"__mn_{c}"),
                                              F.max(c).alias(f"__mx_{c}"))])
    j = df.crossJoin(F.broadcast(stats))
    out = {}
    for c in cols:
        rng = F.col(f"__mx_{c}") - F.col(f"__mn_{c}")
        scaled = (F.col(c) - F.col(f"__mn_{c}")) / rng
        out[f"{c}{suffix}"] = F.when(rng.isNull() | (rng == 0), F.lit(0.0)).otherwise(scaled)
    return j.withColumns(out).drop(*[x for c in cols for x in (f"__mn_{c}", f"__mx_{c}")])


def rank_desc_min(df: DataFrame, col: str, out: str = "risk_rank", part=()) -> DataFrame:
    """Descending rank where ties share the smallest rank (1, 1, 3, ...)."""
    w = Window.partitionBy(*part).orderBy(F.col(col).desc()) if part else Window.orderBy(F.col(col).desc())
    return df.withColumn(out, F.rank().over(w).cast("int"))


def quantile_tiers(df: DataFrame, col: str, out: str = "risk_tier", labels=C.RISK_TIERS) -> DataFrame:
    """Quartile labels from interpolated quartile edges, right-closed, lowest
    edge included. Duplicate edges fall to the lowest matching tier."""
    q = df.agg(F.percentile(F.col(col), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("__q"))
    x = F.col(col)
    tier = (F.when(x.isNull(), F.lit(None))
            .when(x <= F.col("__q")[0], labels[0])
            .when(x <= F.col("__q")[1], labels[1])
            .when(x <= F.col("__q")[2], labels[2])
            .otherwise(labels[3]))
    return df.crossJoin(F.broadcast(q)).withColumn(out, tier).drop("__q")


def area_components(daily: DataFrame, recent_days: int = 28, trend_long: int = 90) -> DataFrame:
    """Per area: intensity & violence over the last ``recent_days`` days, and the
    long-window mean/std, from one conditional aggregation."""
    last = daily.agg(F.max("date").alias("__last"))
    d = (daily.crossJoin(F.broadcast(last))
         .where(F.col("date") > F.date_sub(F.col("__last"), trend_long)))
    recent = F.col("date") > F.date_sub(F.col("__last"), recent_days)
    g = d.groupBy("area_id", "area_name").agg(
        F.avg(F.when(recent, F.col("crimes"))).alias("intensity"),
        F.avg(F.when(recent, F.col("violent_ratio"))).alias("violence"),
        F.avg("crimes").alias("long_mean"),
        F.stddev_samp("crimes").alias("long_std"),
        F.count_if(recent).alias("__n_recent"),
    ).where(F.col("__n_recent") > 0).drop("__n_recent")
    trend = F.try_divide(F.col("intensity") - F.col("long_mean"),
                         F.when(F.col("long_std") != 0, F.col("long_std")))
    return g.withColumn("trend", F.coalesce(trend, F.lit(0.0)))


def join_area_components(components: DataFrame, forecast: DataFrame | None) -> DataFrame:
    """Attach the mean forecast per area (left join); an area without a
    forecast row, or no forecast at all, falls back to its intensity."""
    if forecast is None:
        return components.withColumn("forecast", F.col("intensity"))
    f = forecast.groupBy("area_id", "area_name").agg(F.avg("y_pred").alias("__fc"))
    return (components.join(f, ["area_id", "area_name"], "left")
            .withColumn("forecast", F.coalesce(F.col("__fc"), F.col("intensity"))).drop("__fc"))


def area_risk(daily: DataFrame, forecast: DataFrame | None = None, recent_days: int = 28,
              trend_long: int = 90, weights: dict | None = None) -> DataFrame:
    w = weights or C.RISK_WEIGHTS
    out = join_area_components(area_components(daily, recent_days, trend_long), forecast)
    out = min_max_scale(out, ["intensity", "trend", "violence", "forecast"])
    score = (F.lit(w["intensity"]) * F.col("intensity_n") + F.lit(w["trend"]) * F.col("trend_n")
             + F.lit(w["violence"]) * F.col("violence_n") + F.lit(w["forecast"]) * F.col("forecast_n"))
    out = out.withColumn("risk_score", score)
    out = rank_desc_min(out, "risk_score")
    return quantile_tiers(out, "risk_score")


def risk_decomposition(risk: DataFrame, top: int = 10) -> DataFrame:
    """Top areas by score with their four normalised components."""
    return (risk.orderBy(F.col("risk_score").desc(), F.col("area_id"))
            .limit(top)
            .select("area_id", "area_name", "risk_rank", "risk_score", "risk_tier",
                    "intensity_n", "trend_n", "violence_n", "forecast_n"))
