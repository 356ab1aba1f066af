"""Catalog entries for cleaning, projections, scalar functions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from citypulse import contract as C
from citypulse.operators import cleaning
from citypulse.plans import common
from citypulse.plans.catalog import register, rounded
from citypulse.plans.oracle_sql import BASE, RAW, RENAMED, with_ctes
from citypulse.sources import fixtures

R = [RAW, RENAMED]


def _sql(body, ctes=None):
    return with_ctes(*(ctes or BASE), body=body)


@register("rename_columns", _sql(
    "SELECT * REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon) FROM renamed", R))
def q_rename_columns(spark, sf):
    return rounded(common.renamed_fresh(spark, sf))


BAD_RAW = """
bad_raw AS (
  SELECT "DR_NO", "Date Rptd", CASE WHEN "DR_NO" % 97 = 0 THEN NULL WHEN "DR_NO" % 89 = 0 THEN 'unknown' ELSE "DATE OCC" END AS "DATE OCC" FROM raw
),
dated AS (
  SELECT "DR_NO" AS dr_no, try_strptime("Date Rptd", '%m/%d/%Y %I:%M:%S %p') AS date_reported,
         try_strptime("DATE OCC", '%m/%d/%Y %I:%M:%S %p') AS date_occurred FROM bad_raw
)"""


def _bad_dated(spark, sf):
    r = fixtures.bad_dates(common.raw(spark, sf))
    return cleaning.parse_timestamps(cleaning.rename_columns(r))


@register("parse_timestamps", _sql("SELECT dr_no, date_reported, date_occurred FROM dated", [RAW, BAD_RAW]))
def q_parse_timestamps(spark, sf):
    return _bad_dated(spark, sf).select("dr_no", "date_reported", "date_occurred")


@register("hour_from_hhmm", _sql(
    "SELECT dr_no, time_occurred, CAST(greatest(0, least(23, floor(coalesce(time_occurred, 0) / 100))) "
    "AS INTEGER) AS hour FROM renamed", R))
def q_hour_from_hhmm(spark, sf):
    return cleaning.hour_from_hhmm(common.renamed(spark, sf, "dr_no", "time_occurred")).select("dr_no", "time_occurred", "hour")


@register("calendar_fields", _sql(
    "SELECT dr_no, CAST(isodow(date_occurred) - 1 AS INTEGER) AS dow, "
    "CAST(month(date_occurred) AS INTEGER) AS month, CAST(year(date_occurred) AS INTEGER) AS year, "
    "CAST(weekofyear(date_occurred) AS INTEGER) AS week, "
    "coalesce(isodow(date_occurred) IN (6, 7), false) AS is_weekend FROM renamed", R))
def q_calendar_fields(spark, sf):
    return cleaning.calendar_fields(common.renamed(spark, sf, "dr_no", "date_occurred")).select(
        "dr_no", "dow", "month", "year", "week", "is_weekend")


@register("report_lag_days", _sql(
    "SELECT dr_no, CAST(floor((epoch(date_reported) - epoch(date_occurred)) / 86400) AS BIGINT) "
    "AS report_lag_days FROM renamed", R))
def q_report_lag_days(spark, sf):
    return cleaning.report_lag_days(common.renamed(spark, sf, "dr_no", "date_reported", "date_occurred")).select("dr_no", "report_lag_days")


@register("part_of_day", _sql("SELECT dr_no, hour, part_of_day FROM clean"))
def q_part_of_day(spark, sf):
    df = cleaning.hour_from_hhmm(common.renamed(spark, sf, "dr_no", "time_occurred"))
    return cleaning.part_of_day(df).select("dr_no", "hour", "part_of_day")


@register("clean_victim_age", _sql(
    "SELECT dr_no, CAST(CASE WHEN victim_age > 0 AND victim_age <= 110 THEN victim_age END AS INTEGER) "
    "AS victim_age FROM renamed", R))
def q_clean_victim_age(spark, sf):
    return cleaning.clean_victim_age(common.renamed(spark, sf, "dr_no", "victim_age")).select("dr_no", "victim_age")


@register("normalize_victim_sex", _sql(
    "SELECT dr_no, CASE WHEN upper(victim_sex) IN ('M', 'F') THEN upper(victim_sex) "
    "ELSE 'Unknown' END AS victim_sex FROM renamed", R))
def q_normalize_victim_sex(spark, sf):
    return cleaning.normalize_victim_sex(common.renamed(spark, sf, "dr_no", "victim_sex")).select("dr_no", "victim_sex")


@register("default_victim_descent", _sql(
    "SELECT dr_no, coalesce(victim_descent, 'X') AS victim_descent FROM renamed", R))
def q_default_victim_descent(spark, sf):
    return cleaning.default_victim_descent(common.renamed(spark, sf, "dr_no", "victim_descent")).select("dr_no", "victim_descent")


@register("mask_out_of_bbox", _sql(
    "SELECT dr_no, has_coords, round(lat, 6) AS lat, round(lon, 6) AS lon FROM clean"))
def q_mask_out_of_bbox(spark, sf):
    return rounded(cleaning.mask_out_of_bbox(common.renamed(spark, sf, "dr_no", "lat", "lon"))
                   .select("dr_no", "has_coords", "lat", "lon"))


@register("derive_is_violent", _sql("SELECT dr_no, crime_code, is_violent FROM clean"))
def q_derive_is_violent(spark, sf):
    return cleaning.derive_is_violent(common.renamed(spark, sf, "dr_no", "crime_code")).select("dr_no", "crime_code", "is_violent")


@register("derive_is_arrest", _sql("SELECT dr_no, status_code, is_arrest FROM clean"))
def q_derive_is_arrest(spark, sf):
    return cleaning.derive_is_arrest(common.renamed(spark, sf, "dr_no", "status_code")).select("dr_no", "status_code", "is_arrest")


@register("map_status_group", _sql("SELECT dr_no, status_code, status_group FROM clean"))
def q_map_status_group(spark, sf):
    return cleaning.map_status_group(common.renamed(spark, sf, "dr_no", "status_code")).select("dr_no", "status_code", "status_group")


@register("flag_weapon_used", _sql("SELECT dr_no, weapon_used FROM clean"))
def q_flag_weapon_used(spark, sf):
    return cleaning.flag_weapon_used(common.renamed(spark, sf, "dr_no", "weapon_code")).select("dr_no", "weapon_used")


@register("drop_undated", _sql(
    "SELECT count(date_occurred) AS kept_rows, count(DISTINCT dr_no) FILTER (WHERE date_occurred IS NOT NULL) AS kept_ids, "
    "count(date_occurred) AS kept, count(*) - count(date_occurred) AS dropped FROM dated", [RAW, BAD_RAW]))
def q_drop_undated(spark, sf):
    """The kept rows, counted, beside the counts that the operator reports."""
    dated = _bad_dated(spark, sf)
    kept = cleaning.drop_undated(dated).agg(F.count(F.lit(1)).alias("kept_rows"), F.count_distinct("dr_no").alias("kept_ids"))
    return kept.crossJoin(cleaning.undated_counts(dated))


@register("clean_incidents", _sql(
    "SELECT * REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon) FROM clean"))
def q_clean_incidents(spark, sf):
    return rounded(common.clean_fresh(spark, sf))


FEATURES_SQL = """
feat_med AS (
  SELECT median(CAST(victim_age AS DOUBLE)) AS m_age, median(lat) AS m_lat, median(lon) AS m_lon
  FROM clean
),
features AS (
  SELECT area_id, area_name, hour, dow, month, year, is_weekend, part_of_day,
    coalesce(CAST(victim_age AS DOUBLE), m_age) AS victim_age, victim_sex, victim_descent,
    premise_code, weapon_used, coalesce(lat, m_lat) AS lat, coalesce(lon, m_lon) AS lon,
    CAST(least(365, greatest(0, coalesce(report_lag_days, 0))) AS BIGINT) AS report_lag_days,
    crime_code, crime_desc, part_class, is_violent, is_arrest,
    sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
    sin(2 * pi() * dow / 7) AS dow_sin, cos(2 * pi() * dow / 7) AS dow_cos,
    sin(2 * pi() * month / 12) AS month_sin, cos(2 * pi() * month / 12) AS month_cos,
    dr_no
  FROM clean CROSS JOIN feat_med
)"""


@register("build_incident_features", _sql(
    "SELECT * EXCLUDE (dr_no) REPLACE (round(victim_age, 6) AS victim_age, round(lat, 6) AS lat, "
    "round(lon, 6) AS lon, round(hour_sin, 6) AS hour_sin, round(hour_cos, 6) AS hour_cos, "
    "round(dow_sin, 6) AS dow_sin, round(dow_cos, 6) AS dow_cos, round(month_sin, 6) AS month_sin, "
    "round(month_cos, 6) AS month_cos) FROM features", BASE + [FEATURES_SQL]))
def q_build_incident_features(spark, sf):
    return rounded(cleaning.build_incident_features(common.clean(spark, sf, *C.INCIDENT_FEATURE_COLUMNS)))


@register("impute_median", _sql(
    "SELECT dr_no, round(victim_age, 6) AS victim_age, round(lat, 6) AS lat, round(lon, 6) AS lon "
    "FROM features", BASE + [FEATURES_SQL]))
def q_impute_median(spark, sf):
    df = common.clean(spark, sf, "dr_no", "victim_age", "lat", "lon")
    return rounded(cleaning.impute_median(df))


@register("clip_report_lag", _sql(
    "SELECT dr_no, CAST(least(365, greatest(0, coalesce(report_lag_days, 0))) AS BIGINT) "
    "AS report_lag_days FROM clean"))
def q_clip_report_lag(spark, sf):
    return cleaning.clip_report_lag(common.clean(spark, sf, "dr_no", "report_lag_days")).select("dr_no", "report_lag_days")


@register("cyclic_encode", _sql(
    "SELECT dr_no, round(hour_sin, 6) AS hour_sin, round(hour_cos, 6) AS hour_cos, "
    "round(dow_sin, 6) AS dow_sin, round(dow_cos, 6) AS dow_cos, round(month_sin, 6) AS month_sin, "
    "round(month_cos, 6) AS month_cos FROM features", BASE + [FEATURES_SQL]))
def q_cyclic_encode(spark, sf):
    df = cleaning.cyclic_encode(common.clean(spark, sf, "dr_no", "hour", "dow", "month"))
    return rounded(df.select("dr_no", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
                             "month_sin", "month_cos"))


# Dashboard-style filter: a date window, three areas, violent only.
FILTER_ARGS = dict(start="1996-01-01", end="1998-12-31",
                   areas=["NATION_3", "NATION_7", "NATION_12"], violent_only=True)


@register("filter_incidents", _sql(
    "SELECT dr_no, date_occurred, area_name, is_violent FROM clean "
    "WHERE date_occurred >= TIMESTAMP '1996-01-01' AND date_occurred < TIMESTAMP '1999-01-01' "
    "AND area_name IN ('NATION_3', 'NATION_7', 'NATION_12') AND is_violent = 1"))
def q_filter_incidents(spark, sf):
    return cleaning.filter_incidents(common.clean(spark, sf, "dr_no", "date_occurred", "area_name", "is_violent"), **FILTER_ARGS).select(
        "dr_no", "date_occurred", "area_name", "is_violent")


@register("drop_missing_coords", _sql(
    "SELECT dr_no, round(lat, 6) AS lat, round(lon, 6) AS lon FROM clean "
    "WHERE lat IS NOT NULL AND lon IS NOT NULL"))
def q_drop_missing_coords(spark, sf):
    return rounded(cleaning.drop_missing_coords(common.clean(spark, sf, "dr_no", "lat", "lon")).select("dr_no", "lat", "lon"))


@register("filter_domain_values", _sql(
    "SELECT a.area_name, r.date_min, r.date_max FROM "
    "(SELECT DISTINCT area_name FROM clean WHERE area_name IS NOT NULL) a CROSS JOIN "
    "(SELECT min(date_occurred) AS date_min, max(date_occurred) AS date_max FROM clean) r"))
def q_filter_domain_values(spark, sf):
    return cleaning.filter_domain_values(common.clean(spark, sf, "area_name", "date_occurred"))
