"""Cleaning: renames, typed parsing, derived fields, targets, filters.

All per-row work is one projection of built-in expressions; the composite
:func:`clean_incidents` emits a single ``Project`` over the scan so Catalyst
can prune columns and push filters into the Parquet/CSV reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse import contract as C
from citypulse.functions import scalar as X
from citypulse.operators.sampling import union_history
from citypulse.session import stored


# -- single-step operators ----------------------------------------------------

def rename_columns(raw: DataFrame, mapping: dict | None = None) -> DataFrame:
    """Raw column names -> contract names (unknown columns pass through)."""
    m = {k: v for k, v in (mapping or C.RAW_TO_CONTRACT).items() if k in raw.columns}
    return raw.withColumnsRenamed(m)


def parse_timestamps(df: DataFrame, cols=("date_occurred", "date_reported"),
                     fmt: str = C.RAW_DATE_FORMAT) -> DataFrame:
    """Text -> TIMESTAMP_NTZ; unparsable -> null. Already-typed columns pass."""
    out = {}
    for c in cols:
        dtype = dict(df.dtypes)[c]
        out[c] = X.parse_ts_ntz(c, fmt) if dtype == "string" else F.col(c).cast("timestamp_ntz")
    return df.withColumns(out)


def hour_from_hhmm(df: DataFrame, src: str = "time_occurred", out: str = "hour") -> DataFrame:
    return df.withColumn(out, X.hour_from_hhmm(src))


def calendar_fields(df: DataFrame, ts: str = "date_occurred") -> DataFrame:
    """dow (Mon=0), month, year, ISO week, is_weekend (null date -> false)."""
    dow = X.weekday_mon0(ts)
    return df.withColumns({
        "dow": dow,
        "month": F.month(ts).cast("int"),
        "year": F.year(ts).cast("int"),
        "week": F.weekofyear(ts).cast("int"),
        "is_weekend": X.is_weekend_expr(dow),
    })


def report_lag_days(df: DataFrame) -> DataFrame:
    return df.withColumn("report_lag_days",
                         X.report_lag_days_expr("date_reported", "date_occurred"))


def part_of_day(df: DataFrame, hour: str = "hour") -> DataFrame:
    return df.withColumn("part_of_day", X.part_of_day_expr(hour))


def clean_victim_age(df: DataFrame) -> DataFrame:
    return df.withColumn("victim_age", X.clean_age_expr("victim_age"))


def normalize_victim_sex(df: DataFrame) -> DataFrame:
    return df.withColumn("victim_sex", X.victim_sex_expr("victim_sex"))


def default_victim_descent(df: DataFrame, default: str = "X") -> DataFrame:
    return df.withColumn("victim_descent", F.coalesce(F.col("victim_descent"), F.lit(default)))


def mask_out_of_bbox(df: DataFrame, bbox: dict | None = None) -> DataFrame:
    """has_coords = inside the inclusive box; outside -> both coordinates null."""
    inside = X.in_bbox_expr("lat", "lon", bbox)
    return df.withColumns({
        "has_coords": inside,
        "lat": F.when(inside, F.col("lat")),
        "lon": F.when(inside, F.col("lon")),
    })


def derive_is_violent(df: DataFrame, codes=C.VIOLENT_CRIME_CODES) -> DataFrame:
    return df.withColumn("is_violent", X.flag_in("crime_code", codes))


def derive_is_arrest(df: DataFrame, statuses=C.ARREST_STATUSES) -> DataFrame:
    return df.withColumn("is_arrest", X.flag_in("status_code", statuses))


def map_status_group(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    return df.withColumn("status_group", X.status_group_expr("status_code", mapping))


def flag_weapon_used(df: DataFrame) -> DataFrame:
    return df.withColumn("weapon_used", F.col("weapon_code").isNotNull().cast("int"))


def drop_undated(df: DataFrame) -> DataFrame:
    """Drop rows without ``date_occurred``; :func:`undated_counts` counts them."""
    return df.where(F.col("date_occurred").isNotNull())


def undated_counts(df: DataFrame, by=()) -> DataFrame:
    """(kept, dropped): rows with and without ``date_occurred``, overall or by columns.

    A plain aggregate over one column (a Parquet scan reads nothing else, a CSV scan parses
    nothing else), so that nothing is left behind in the session."""
    undated = F.col("date_occurred").isNull()
    return df.groupBy(*by).agg(F.count_if(~undated).alias("kept"), F.count_if(undated).alias("dropped"))


# -- composite ------------------------------------------------------------------

def clean_incidents(raw: DataFrame, bbox: dict | None = None,
                    violent_codes=C.VIOLENT_CRIME_CODES) -> DataFrame:
    """Raw incident table -> the 41-column clean table, as one projection.

    Order is not imposed here (a global sort is a full shuffle); sinks order
    within partitions by ``date_occurred, dr_no`` when needed.
    """
    df = parse_timestamps(rename_columns(raw))
    occ = F.col("date_occurred")
    hour = X.hour_from_hhmm("time_occurred")
    dow = X.weekday_mon0(occ)
    inside = X.in_bbox_expr("lat", "lon", bbox)
    derived = {
        "victim_age": X.clean_age_expr("victim_age"),
        "victim_sex": X.victim_sex_expr("victim_sex"),
        "victim_descent": F.coalesce(F.col("victim_descent"), F.lit("X")),
        "lat": F.when(inside, F.col("lat")),
        "lon": F.when(inside, F.col("lon")),
        "hour": hour,
        "dow": dow,
        "month": F.month(occ).cast("int"),
        "year": F.year(occ).cast("int"),
        "week": F.weekofyear(occ).cast("int"),
        "is_weekend": X.is_weekend_expr(dow),
        "report_lag_days": X.report_lag_days_expr("date_reported", occ),
        "part_of_day": X.part_of_day_expr(hour),
        "has_coords": inside,
        "is_violent": X.flag_in("crime_code", violent_codes),
        "is_arrest": X.flag_in("status_code", C.ARREST_STATUSES),
        "status_group": X.status_group_expr("status_code"),
        "weapon_used": F.col("weapon_code").isNotNull().cast("int"),
    }
    cols = [derived.get(c, F.col(c)).alias(c) for c in C.CONTRACT_COLUMNS]
    cols += [derived[c].alias(c) for c in C.DERIVED_COLUMNS]
    return df.select(*cols).where(occ.isNotNull())


# -- incident features --------------------------------------------------------

#: Distinct values that one task may put in order, and ranges that a wider interval is cut into.
ORDERED_VALUES, MEDIAN_BINS = 10_000, 1024


def medians(df: DataFrame, cols) -> dict[str, float | None]:
    """The exact, interpolated median of every column (None: no values; NaN counts as missing).

    Values are counted per value once (combined in the tasks) and stored. The interval that
    holds a middle rank is then cut into ranges of equal width, whose totals tell the range of
    the rank, and narrowed to the smallest and largest value seen in it, until it holds no more
    than ``ORDERED_VALUES`` distinct values. A pass is one job over the values still inside and
    sends ``MEDIAN_BINS`` totals a search to the driver.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])
    counts = stored(df.select(F.inline(pairs)).where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("c", "v")
                    .agg(F.count(F.lit(1)).alias("n")), "median-counts")
    whole = counts.groupBy("c").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("values"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    searches = [{"id": f"{r['c']}:{k}", "c": r["c"], "rank": (r["total"] + k) // 2, "lo": r["lo"], "hi": r["hi"], "values": r["values"]} for r in whole for k in (1, 2)]
    while wide := [s for s in searches if s["values"] > ORDERED_VALUES]:
        for s in wide:
            rank = s["rank"]
            for b in bins_of(counts, s):
                if rank <= b["n"]:
                    s |= {"rank": rank, "lo": b["lo"], "hi": b["hi"], "values": b["values"]}
                    break
                rank -= b["n"]
    upto = Window.partitionBy("id").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    found = {}
    if searches:
        inside = [counts.where((F.col("c") == s["c"]) & F.col("v").between(s["lo"], s["hi"])).select(F.lit(s["id"]).alias("id"), F.lit(s["rank"]).alias("rank"), "v", "n") for s in searches]
        placed = union_history(*inside).withColumn("last", F.sum("n").over(upto)).where((F.col("last") >= F.col("rank")) & (F.col("last") - F.col("n") < F.col("rank")))
        found = {r["id"]: r["v"] for r in placed.select("id", "v").collect()}
    return {c: found[f"{c}:1"] * 0.5 + found[f"{c}:2"] * 0.5 if f"{c}:1" in found else None for c in cols}


def bins_of(counts: DataFrame, search: dict) -> list:
    """Totals, distinct values and ends of the ranges of a search's interval, in order.

    Halved ends keep the width finite; infinite values have ranges of their own."""
    inside = counts.where((F.col("c") == search["c"]) & F.col("v").between(search["lo"], search["hi"]))
    finite = F.abs("v") < float("inf")
    ends = inside.agg(F.min(F.when(finite, F.col("v"))).alias("a"), F.max(F.when(finite, F.col("v"))).alias("b")).first()
    a, b = (ends["a"] or 0.0) / 2, (ends["b"] or 0.0) / 2
    place = F.least(F.floor((F.col("v") / 2 - a) / ((b - a) or 1.0) * MEDIAN_BINS), F.lit(MEDIAN_BINS - 1))
    at = F.when(F.col("v") == float("-inf"), -1).when(F.col("v") == float("inf"), MEDIAN_BINS).otherwise(place)
    return (inside.groupBy(at.alias("bin")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .orderBy("bin").collect())


def impute_median(df: DataFrame, cols=("victim_age", "lat", "lon")) -> DataFrame:
    """Fill nulls with the column's global median (exact, interpolated; see :func:`medians`)."""
    middle = medians(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(middle[c]).cast("double")) for c in cols})


def clip_report_lag(df: DataFrame, lo: int = 0, hi: int = 365) -> DataFrame:
    c = F.coalesce(F.col("report_lag_days"), F.lit(0))
    return df.withColumn("report_lag_days",
                         F.least(F.lit(hi), F.greatest(F.lit(lo), c)).cast("bigint"))


def cyclic_encode(df: DataFrame, periods: dict | None = None) -> DataFrame:
    periods = periods or {"hour": 24, "dow": 7, "month": 12}
    out = {}
    for c, p in periods.items():
        out[f"{c}_sin"] = X.cyclic_sin(c, p)
        out[f"{c}_cos"] = X.cyclic_cos(c, p)
    return df.withColumns(out)


def build_incident_features(clean: DataFrame, keep=()) -> DataFrame:
    """21 projected columns + imputations + 6 cyclic encodings (27 columns);
    ``keep`` carries extra columns through (e.g. a row key)."""
    feats = clean.select(*keep, *C.INCIDENT_FEATURE_COLUMNS)
    feats = impute_median(feats)
    feats = clip_report_lag(feats)
    return cyclic_encode(feats)


# -- filters -------------------------------------------------------------------

def filter_incidents(df: DataFrame, start=None, end=None, areas=None,
                     violent_only: bool = False) -> DataFrame:
    """Date range [start, end + 1 day), area list (empty = all), violent only."""
    cond = F.lit(True)
    occ = F.col("date_occurred")
    if start is not None:
        cond = cond & (occ >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        upper = F.date_add(F.lit(str(end)).cast("date"), 1).cast("timestamp_ntz")
        cond = cond & (occ < upper)
    if areas:
        cond = cond & F.col("area_name").isin(list(areas))
    if violent_only:
        cond = cond & (F.col("is_violent") == 1)
    return df.where(cond)


def drop_missing_coords(df: DataFrame, violent_only: bool = False) -> DataFrame:
    out = df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return out.where(F.col("is_violent") == 1) if violent_only else out


def filter_domain_values(df: DataFrame) -> DataFrame:
    """Distinct non-null area names with the table's date range on each row.

    One pass: per-area date ranges (null area kept as its own group) are
    checkpointed; the overall range and the area list come from that table.
    """
    from citypulse.session import materialize
    per_area = materialize(df.groupBy("area_name").agg(F.min("date_occurred").alias("lo"),
                                                        F.max("date_occurred").alias("hi")))
    rng = per_area.agg(F.min("lo").alias("date_min"), F.max("hi").alias("date_max"))
    return (per_area.where(F.col("area_name").isNotNull()).select("area_name")
            .crossJoin(F.broadcast(rng)))
