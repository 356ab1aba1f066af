"""Descriptive aggregates (EDA and dashboard queries).

Each operator is one hash aggregation over the incident table (partial +
final, so hot keys are combined map-side) followed by work on the small
aggregated result. Null group keys are dropped, as a pandas groupby does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse.functions.scalar import safe_ratio

# --- fixed values -----------------------------------------------------------
DOW_LABELS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
# --- end of fixed values ----------------------------------------------------


def dataset_overview(clean: DataFrame) -> DataFrame:
    """One row: size, date range, distinct areas/types, shares, missing-lat share."""
    return clean.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(clean.columns)).cast("int").alias("columns"),
        F.min("date_occurred").alias("date_min"),
        F.max("date_occurred").alias("date_max"),
        F.count_distinct("area_name").alias("areas"),
        F.count_distinct("crime_desc").alias("crime_types"),
        F.avg("is_violent").alias("violent_share"),
        F.avg("is_arrest").alias("arrest_share"),
        F.avg(F.col("lat").isNull().cast("int")).alias("missing_lat_pct"),
    )


def missing_table(df: DataFrame) -> DataFrame:
    """Per-column null count and fraction, only columns with nulls, most first.

    One aggregate pass computes every column's null count; the one-row result
    is unpivoted to one row per column.
    """
    cols = df.columns
    aliases = {c: f"c{i}" for i, c in enumerate(cols)}
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(aliases[c]) for c in cols])
    names = F.create_map(*[x for c in cols for x in (F.lit(aliases[c]), F.lit(c))])
    long = one.unpivot("__n", list(aliases.values()), "__alias", "missing_count")
    return (long.where(F.col("missing_count") > 0)
            .select(names[F.col("__alias")].alias("column"),
                    (F.col("missing_count") / F.col("__n")).alias("missing_pct"),
                    F.col("missing_count")))


def hour_dow_matrix(df: DataFrame) -> DataFrame:
    """Counts by day of week x hour (fixed 24 hour columns, zero-filled),
    labelled by the dow key, not by position."""
    valid = df.where(F.col("dow").isNotNull() & F.col("hour").isNotNull())
    hours = [F.count_if(F.col("hour") == h).alias(f"h{h:02d}") for h in range(24)]
    labels = F.create_map(*[x for i, lab in enumerate(DOW_LABELS) for x in (F.lit(i), F.lit(lab))])
    return (valid.groupBy("dow").agg(*hours)
            .withColumn("dow_label", labels[F.col("dow")]))


def top_k_categories(df: DataFrame, by: str, k: int = 15) -> DataFrame:
    """Row count per category, largest first, ties by name; top k."""
    return (df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(by)).limit(k))


def top_k_within_area(df: DataFrame, k: int = 12, area: str | None = None,
                      area_col: str = "area_name", by: str = "crime_desc") -> DataFrame:
    """Top k categories inside one area, or inside every area at once.

    The all-areas form ranks the (area, category) counts with a window whose
    partitions hold one area's categories, never incident rows.
    """
    base = df.where(F.col(area_col).isNotNull() & F.col(by).isNotNull())
    if area is not None:
        base = base.where(F.col(area_col) == area)
    counts = base.groupBy(area_col, by).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(area_col).orderBy(F.col("n").desc(), F.col(by))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def victim_age_histogram(df: DataFrame, bins: int = 40, lo: float = 5, hi: float = 90,
                         col: str = "victim_age") -> DataFrame:
    """Equal-width histogram over the ages kept in [lo, hi].

    Bin edges span the observed min..max after the filter; the last bin is
    closed; empty bins are present with count 0. The incident table is read
    once: counts per distinct value (a table bounded by the value range) are
    checkpointed, and range and bins are computed from them.
    """
    from citypulse.session import materialize
    vals = materialize(
        df.where(F.col(col).isNotNull() & F.col(col).between(lo, hi))
        .groupBy(F.col(col).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("c")))
    rng = vals.agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    width = (F.col("mx") - F.col("mn")) / F.lit(bins)
    raw_bin = F.floor((F.col("x") - F.col("mn")) * F.lit(bins) / F.nullif(F.col("mx") - F.col("mn"), F.lit(0.0)))
    b = F.least(F.lit(bins - 1), F.coalesce(raw_bin, F.lit(0))).cast("int")
    counts = vals.crossJoin(F.broadcast(rng)).groupBy(b.alias("bin")).agg(F.sum("c").alias("n"))
    spine = rng.where(F.col("mn").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "mn", "mx")
    return (spine.join(counts, "bin", "left")
            .select("bin",
                    (F.col("mn") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("mn") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def victim_sex_counts(df: DataFrame) -> DataFrame:
    return (df.where(F.col("victim_sex").isNotNull()).groupBy("victim_sex")
            .agg(F.count(F.lit(1)).alias("n")))


def arrest_rate_by_crime(df: DataFrame, min_n: int = 1000, k: int = 15) -> DataFrame:
    """Crime types with more than ``min_n`` reports, ranked by arrest rate."""
    g = (df.where(F.col("crime_desc").isNotNull()).groupBy("crime_desc")
         .agg(F.count("dr_no").alias("n"), F.sum("is_arrest").cast("bigint").alias("arrests"))
         .where(F.col("n") > min_n)
         .withColumn("arrest_rate", F.col("arrests") / F.col("n")))
    return g.orderBy(F.col("arrest_rate").desc(), F.col("crime_desc")).limit(k)


def share_by_area(df: DataFrame, flags=("is_violent", "is_arrest"),
                  names=("violent_share", "arrest_rate"), area_col: str = "area_name") -> DataFrame:
    """Mean of 0/1 flags per area (violent share, arrest rate) in one pass."""
    return (df.where(F.col(area_col).isNotNull()).groupBy(area_col)
            .agg(*[F.avg(f).alias(n) for f, n in zip(flags, names)]))


def kpi_summary(filtered: DataFrame) -> DataFrame:
    """Count, violent %, arrest %, distinct areas and types; 0 when empty."""
    return filtered.agg(
        F.count(F.lit(1)).alias("crimes"),
        F.coalesce(F.avg("is_violent") * 100, F.lit(0.0)).alias("violent_pct"),
        F.coalesce(F.avg("is_arrest") * 100, F.lit(0.0)).alias("arrest_pct"),
        F.count_distinct("area_name").alias("areas"),
        F.count_distinct("crime_desc").alias("crime_types"),
    )


def counts_by_period(df: DataFrame) -> DataFrame:
    """Counts by month-of-year and by hour in one pass (two grouping sets)."""
    g = (df.groupingSets([["month"], ["hour"]], "month", "hour")
         .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("__gid")))
    # __gid = 1 -> grouped by month only; 2 -> grouped by hour only
    return g.select(
        F.when(F.col("__gid") == 1, F.lit("month")).otherwise(F.lit("hour")).alias("period"),
        F.when(F.col("__gid") == 1, F.col("month")).otherwise(F.col("hour")).alias("value"),
        "n",
    ).where(F.col("value").isNotNull())


def area_profile(daily: DataFrame) -> DataFrame:
    """Per area: mean and sample std of daily crimes, mean violent, mean arrests."""
    return daily.groupBy("area_id", "area_name").agg(
        F.avg("crimes").alias("mean_crimes"),
        F.coalesce(F.stddev_samp("crimes"), F.lit(0.0)).alias("std_crimes"),
        F.avg("violent").alias("violent"),
        F.avg("arrests").alias("arrest"),
    )


def grid_hotspots(df: DataFrame, cell_deg: float = 0.0025) -> DataFrame:
    """Nearest-cell raster: count and violent share per grid cell.

    Cells are integer keys (half-even rounding of lat/cell, lon/cell); the
    output centre is key x cell.
    """
    pts = df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    ky = F.rint(F.col("lat") / F.lit(cell_deg)).cast("bigint")
    kx = F.rint(F.col("lon") / F.lit(cell_deg)).cast("bigint")
    g = (pts.groupBy(ky.alias("lat_key"), kx.alias("lon_key"))
         .agg(F.count("dr_no").alias("crimes"), F.sum("is_violent").cast("bigint").alias("violent")))
    return g.select(
        (F.col("lat_key") * F.lit(cell_deg)).alias("lat"),
        (F.col("lon_key") * F.lit(cell_deg)).alias("lon"),
        "lat_key", "lon_key", "crimes", "violent",
        safe_ratio("violent", "crimes").alias("violent_share"),
    )


def forecast_vs_actual(pred: DataFrame, n_areas: int = 4) -> DataFrame:
    """Actual vs predicted rows for the first ``n_areas`` area ids."""
    first = pred.select("area_id").distinct().orderBy("area_id").limit(n_areas)
    return pred.join(F.broadcast(first), "area_id", "left_semi").select(
        "date", "area_id", "area_name", "y_true", "y_pred")


def forecast_totals(fc: DataFrame) -> DataFrame:
    """Forecast summed by date and by area in one pass (two grouping sets)."""
    g = (fc.groupingSets([["date"], ["area_id", "area_name"]], "date", "area_id", "area_name")
         .agg(F.sum("y_pred").alias("y_pred_total"), F.grouping_id().alias("__gid")))
    return g.select(
        F.when(F.col("__gid") == 3, F.lit("date")).otherwise(F.lit("area")).alias("by"),
        "date", "area_id", "area_name", "y_pred_total")


def area_drilldown(daily: DataFrame, risk: DataFrame | None = None, recent_rows: int = 28) -> DataFrame:
    """Per area: mean crimes/day, mean of the last 28 rows, risk tier (left join)."""
    w = Window.partitionBy("area_id", "area_name").orderBy(F.col("date").desc())
    ranked = daily.withColumn("__rn", F.row_number().over(w))
    out = ranked.groupBy("area_id", "area_name").agg(
        F.avg("crimes").alias("mean_per_day"),
        F.avg(F.when(F.col("__rn") <= recent_rows, F.col("crimes"))).alias("recent_mean"))
    if risk is not None:
        out = out.join(risk.select("area_id", "area_name", "risk_tier"), ["area_id", "area_name"], "left")
    return out
