"""Leak-free lag / rolling / calendar features over area panels.

Windows are partitioned by area and ordered by date. They run on the dense
panel (one row per area-day), so every window partition is bounded by the
calendar span whatever the incident volume or area skew. Two window specs in
total: (area) and (area, dow); Spark sorts once per spec.

Rolling statistics use the R rows strictly before the current one and are
null until R such rows exist (the documented per-area meaning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _w(part=("area_id",), order="date"):
    return Window.partitionBy(*part).orderBy(order)


def lag_features(panel: DataFrame, lags=(1, 7, 14, 28), col: str = "crimes",
                 part=("area_id",), order: str = "date") -> DataFrame:
    w = _w(part, order)
    return panel.withColumns({f"lag_{L}": F.lag(F.col(col), L).over(w).cast("double") for L in lags})


def rolling_features(panel: DataFrame, rolls=(7, 28, 90), col: str = "crimes",
                     part=("area_id",), order: str = "date", stds=None) -> DataFrame:
    """Mean and sample std over the previous R rows (current row excluded)."""
    w = _w(part, order)
    stds = rolls if stds is None else stds
    out = {}
    for R in rolls:
        frame = w.rowsBetween(-R, -1)
        full = F.count(F.col(col)).over(frame) == R
        out[f"roll_mean_{R}"] = F.when(full, F.avg(F.col(col)).over(frame))
        if R in stds:
            out[f"roll_std_{R}"] = F.when(full, F.stddev_samp(F.col(col)).over(frame))
    return panel.withColumns(out)


def calendar_features(panel: DataFrame, date: str = "date") -> DataFrame:
    d = F.col(date)
    dow = F.weekday(d).cast("int")
    return panel.withColumns({
        "dow": dow,
        "month": F.month(d).cast("int"),
        "year": F.year(d).cast("int"),
        "doy": F.dayofyear(d).cast("int"),
        "weekofyear": F.weekofyear(d).cast("int"),
        "is_weekend": (dow >= 5).cast("int"),
    })


def expanding_dow_mean(panel: DataFrame, col: str = "crimes", min_periods: int = 4) -> DataFrame:
    """Mean of all earlier rows of the same (area, weekday); null below 4 rows."""
    if "dow" not in panel.columns:
        panel = panel.withColumn("dow", F.weekday("date").cast("int"))
    frame = _w(("area_id", "dow")).rowsBetween(Window.unboundedPreceding, -1)
    enough = F.count(F.col(col)).over(frame) >= min_periods
    return panel.withColumn("adow_mean", F.when(enough, F.avg(F.col(col)).over(frame)))


def add_lag_features(panel: DataFrame, lags=(1, 7, 14, 28), rolls=(7, 28, 90)) -> DataFrame:
    p = lag_features(panel, lags)
    p = rolling_features(p, rolls)
    p = calendar_features(p)
    return expanding_dow_mean(p)


def weekly_lag_features(weekly: DataFrame) -> DataFrame:
    """Weekly panel: lags 1/2/4/8, rolling mean 4/12, rolling std 4, calendar."""
    p = lag_features(weekly, (1, 2, 4, 8))
    p = rolling_features(p, (4, 12), stds=(4,))
    d = F.col("date")
    return p.withColumns({
        "weekofyear": F.weekofyear(d).cast("int"),
        "month": F.month(d).cast("int"),
        "year": F.year(d).cast("int"),
    })


def moving_average_7(daily: DataFrame, col: str = "crimes") -> DataFrame:
    """Trailing 7-row mean including the current row (min 1 row)."""
    w = Window.partitionBy("area_id", "area_name").orderBy("date").rowsBetween(-6, 0)
    return daily.withColumn("roll7", F.avg(F.col(col)).over(w))
