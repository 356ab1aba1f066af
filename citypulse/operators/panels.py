"""Area x time panels: aggregation, densification, weekly roll-up, resampling,
incomplete-tail trimming.

Row-level data is touched only by hash aggregations (partial + final, so a hot
area is pre-combined map-side). Everything after the first aggregation runs on
the panel, whose size is bounded by days x areas, not by incident count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citypulse.functions.scalar import safe_ratio

COUNT_COLS = ("crimes", "violent", "arrests")


def date_spine(bounds: DataFrame, lo: str = "lo", hi: str = "hi", step_days: int = 1,
               name: str = "date") -> DataFrame:
    """Calendar from a one-row ``(lo, hi)`` frame, one row per step.

    Its size is bounded by the calendar span, so it is safe to broadcast.
    """
    seq = F.sequence(F.col(lo), F.col(hi), F.expr(f"INTERVAL {int(step_days)} DAY"))
    return bounds.where(F.col(lo).isNotNull()).select(F.explode(seq).alias(name))


def densify_panel(agg: DataFrame, bounds: DataFrame, keys=("area_id", "area_name"),
                  fill_cols=("crimes", "violent", "arrests", "violent_ratio", "arrest_ratio"),
                  date_col: str = "date") -> DataFrame:
    """Full date range x observed (id, name) pairs, left-joined, zero-filled.

    ``bounds`` is a one-row frame with the date range (lo, hi). The area pairs
    are crossed once each (an id observed with two names keeps both pairs).
    """
    keys = list(keys)
    areas = agg.select(*keys).distinct()
    spine = date_spine(bounds, name=date_col)
    grid = areas.crossJoin(F.broadcast(spine))
    out = grid.join(agg, on=[date_col, *keys], how="left")
    fills = {c: F.coalesce(F.col(c), F.lit(0).cast(dict(agg.dtypes)[c])) for c in fill_cols}
    return out.withColumns(fills).select(date_col, *keys, *fill_cols)


def daily_area_panel(clean: DataFrame, dense: bool = True) -> DataFrame:
    """Per (date, area): crimes = count(dr_no), violent, arrests, two ratios.

    Groups with a null area key are dropped (as a pandas groupby does), but
    still take part in the date range. The incident table is read once: the
    sparse (date, area) aggregate, bounded by days x areas, is checkpointed
    and the date range, area list and densified grid are all derived from it.
    """
    from citypulse.session import materialize
    grouped = materialize(
        clean.groupBy(F.to_date("date_occurred").alias("date"), "area_id", "area_name")
        .agg(F.count("dr_no").alias("crimes"),
             F.sum("is_violent").cast("bigint").alias("violent"),
             F.sum("is_arrest").cast("bigint").alias("arrests")))
    agg = (grouped.where(F.col("date").isNotNull() & F.col("area_id").isNotNull()
                         & F.col("area_name").isNotNull())
           .withColumns({"violent_ratio": safe_ratio("violent", "crimes"),
                         "arrest_ratio": safe_ratio("arrests", "crimes")}))
    if not dense:
        return agg
    bounds = grouped.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return densify_panel(agg, bounds)


def week_start(date_col="date") -> Column:
    """Monday on or before the date."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.date_sub(c, F.weekday(c))


def weekly_area_panel(daily: DataFrame) -> DataFrame:
    """Monday-start weekly sums per area with null-safe ratios."""
    agg = (daily.groupBy(week_start("date").alias("date"), "area_id", "area_name")
           .agg(*[F.sum(c).cast("bigint").alias(c) for c in COUNT_COLS]))
    return agg.withColumns({"violent_ratio": safe_ratio("violent", "crimes"),
                            "arrest_ratio": safe_ratio("arrests", "crimes")})


def period_label(ts, freq: str) -> Column:
    """Resample bin label: D = the day, W = the Sunday ending the week,
    ME = the last day of the month."""
    d = F.to_date(ts) if isinstance(ts, Column) else F.to_date(F.col(ts))
    if freq == "D":
        return d
    if freq == "W":
        return F.date_add(d, F.lit(6) - F.weekday(d))
    if freq == "ME":
        return F.last_day(d)
    raise ValueError(f"unsupported frequency {freq!r}")


def _label_spine(bounds: DataFrame, freq: str, name: str = "date") -> DataFrame:
    if freq == "D":
        return date_spine(bounds, name=name)
    if freq == "W":
        return date_spine(bounds, step_days=7, name=name)
    months = F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("INTERVAL 1 MONTH"))
    return (bounds.where(F.col("lo").isNotNull())
            .select(F.explode(months).alias("__m"))
            .select(F.last_day("__m").alias(name)))


def resample_two_series(df: DataFrame, freq: str = "ME", ts: str = "date_occurred",
                        flag: str = "is_violent") -> DataFrame:
    """All-rows and flagged-rows counts per period, outer-aligned on the label.

    Inside each series' own [first, last] label range gaps are 0; outside the
    flagged series' range its value is null (full-outer alignment).
    """
    from citypulse.session import materialize
    label = period_label(ts, freq)
    agg = materialize(df.where(F.col(ts).isNotNull())
                      .groupBy(label.alias("date"))
                      .agg(F.count("dr_no").alias("n_all"),
                           F.count(F.when(F.col(flag) == 1, F.col("dr_no"))).alias("n_flag"),
                           F.count_if(F.col(flag) == 1).alias("rows_flag")))
    bounds = agg.agg(F.min("date").alias("lo"), F.max("date").alias("hi"),
                     F.min(F.when(F.col("rows_flag") > 0, F.col("date"))).alias("flo"),
                     F.max(F.when(F.col("rows_flag") > 0, F.col("date"))).alias("fhi"))
    spine = _label_spine(bounds, freq)
    out = (spine.join(agg, "date", "left")
           .crossJoin(F.broadcast(bounds.select("flo", "fhi"))))
    in_flag = F.col("date").between(F.col("flo"), F.col("fhi"))
    return out.select(
        "date",
        F.coalesce(F.col("n_all"), F.lit(0)).cast("bigint").alias("all_crimes"),
        F.when(in_flag, F.coalesce(F.col("n_flag"), F.lit(0))).cast("bigint").alias("violent"),
    )


def resample_counts(df: DataFrame, freq: str = "ME", ts: str = "date_occurred",
                    count_col: str = "dr_no") -> DataFrame:
    """Row count per period label, gaps zero-filled between first and last label."""
    from citypulse.session import materialize
    agg = materialize(df.where(F.col(ts).isNotNull())
                      .groupBy(period_label(ts, freq).alias("date"))
                      .agg(F.count(count_col).alias("n")))
    bounds = agg.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    spine = _label_spine(bounds, freq)
    return (spine.join(agg, "date", "left")
            .select("date", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def citywide_daily_totals(daily: DataFrame) -> DataFrame:
    return daily.groupBy("date").agg(F.sum("crimes").cast("bigint").alias("crimes"))


def tail_cutoff(daily: DataFrame, threshold: float = 0.70, min_days: int = 14,
                baseline_lag: int = 42, roll: int = 7) -> DataFrame:
    """One-row frame with the cut-off date (keep ``date <= cutoff``).

    City-wide totals: trailing 7-row sum (min 1 row) against the same sum 42
    rows earlier. If all of the last ``min_days`` ratios are below the
    threshold the cut is the latest date whose ratio is not below it; null
    ratios (no baseline yet, zero baseline) count as good. The windows run on
    the per-date totals, a table bounded by the calendar span.
    """
    totals = citywide_daily_totals(daily)
    w = Window.orderBy("date")
    roll7 = F.sum("crimes").over(w.rowsBetween(-(roll - 1), 0))
    t = totals.withColumn("roll7", roll7)
    t = t.withColumns({
        "ratio": F.try_divide(F.col("roll7").cast("double"),
                              F.lag("roll7", baseline_lag).over(w).cast("double")),
        "rn_desc": F.row_number().over(Window.orderBy(F.col("date").desc())),
    })
    bad = F.coalesce(F.col("ratio") < F.lit(threshold), F.lit(False))
    tail = F.col("rn_desc") <= min_days
    s = t.agg(
        F.count_if(tail).alias("n_tail"),
        F.count_if(tail & bad).alias("n_tail_bad"),
        F.max(F.when(~bad, F.col("date"))).alias("last_good"),
        F.max("date").alias("last_date"),
    )
    fires = (F.col("n_tail") > 0) & (F.col("n_tail") == F.col("n_tail_bad"))
    return s.select(F.when(fires, F.coalesce(F.col("last_good"), F.col("last_date")))
                    .otherwise(F.col("last_date")).alias("cutoff"))


def trim_incomplete_tail(daily: DataFrame, threshold: float = 0.70, min_days: int = 14) -> DataFrame:
    cut = tail_cutoff(daily, threshold, min_days)
    return (daily.crossJoin(F.broadcast(cut))
            .where(F.col("date") <= F.col("cutoff")).drop("cutoff"))


def trim_weekly_tail(weekly: DataFrame, daily_trimmed: DataFrame, days: int = 14) -> DataFrame:
    """Keep weeks starting on or before (last kept day - ``days``)."""
    last = daily_trimmed.agg(F.date_sub(F.max("date"), days).alias("__wk_cut"))
    return (weekly.crossJoin(F.broadcast(last))
            .where(F.col("date") <= F.col("__wk_cut")).drop("__wk_cut"))
