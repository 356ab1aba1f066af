"""Catalog entries for descriptive aggregates and grid hotspots."""

from __future__ import annotations

from citypulse import contract as C
from citypulse.operators import cleaning, describe
from citypulse.plans import common
from citypulse.plans.catalog import register, rounded
from citypulse.plans.oracle_sql import BASE, DAILY, with_ctes
from citypulse.plans.q_cleaning import FILTER_ARGS
from citypulse.sources import fixtures

EVENTS = """
ev AS (
  SELECT CAST(event_id AS BIGINT) AS dr_no, ts AS date_occurred,
    CAST(user_id % 21 AS INTEGER) AS area_id, 'Area ' || CAST(user_id % 21 AS VARCHAR) AS area_name,
    event_type AS crime_desc, CAST(event_type = 'error' AS INTEGER) AS is_violent,
    CAST(floor(value) AS INTEGER) AS victim_age, CAST(hour(ts) AS INTEGER) AS hour,
    CAST(isodow(ts) - 1 AS INTEGER) AS dow, CAST(month(ts) AS INTEGER) AS month
  FROM events
)"""


def _sql(body, extra=()):
    return with_ctes(*BASE, *extra, body=body)


@register("dataset_overview", _sql(
    f"SELECT count(*) AS rows, CAST({len(C.CLEAN_COLUMNS)} AS INTEGER) AS columns, "
    "min(date_occurred) AS date_min, max(date_occurred) AS date_max, "
    "count(DISTINCT area_name) AS areas, count(DISTINCT crime_desc) AS crime_types, "
    "round(avg(is_violent), 6) AS violent_share, round(avg(is_arrest), 6) AS arrest_share, "
    "round(avg(CAST(lat IS NULL AS INTEGER)), 6) AS missing_lat_pct FROM clean"))
def q_dataset_overview(spark, sf):
    return rounded(describe.dataset_overview(common.clean_fresh(spark, sf)))


def _missing_sql():
    parts = [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
             f"count(*) AS n FROM clean" for c in C.CLEAN_COLUMNS]
    return _sql("SELECT column_name, round(missing_count / n, 6) AS missing_pct, missing_count FROM ("
                + " UNION ALL ".join(parts) + ") WHERE missing_count > 0")


@register("missing_table", _missing_sql())
def q_missing_table(spark, sf):
    out = describe.missing_table(common.clean_fresh(spark, sf))
    return rounded(out.withColumnRenamed("column", "column_name"))


@register("hour_dow_matrix", with_ctes(EVENTS, body=(
    "SELECT dow, " + ", ".join(f"count(*) FILTER (WHERE hour = {h}) AS h{h:02d}" for h in range(24))
    + ", CASE dow " + " ".join(f"WHEN {i} THEN '{lab}'" for i, lab in enumerate(describe.DOW_LABELS))
    + " END AS dow_label FROM ev WHERE dow IS NOT NULL AND hour IS NOT NULL GROUP BY dow")))
def q_hour_dow_matrix(spark, sf):
    return describe.hour_dow_matrix(fixtures.event_incidents(spark, sf))


@register("top_k_categories", _sql(
    "SELECT crime_desc, count(*) AS n FROM clean WHERE crime_desc IS NOT NULL GROUP BY crime_desc "
    "ORDER BY n DESC, crime_desc LIMIT 15"))
def q_top_k_categories(spark, sf):
    return describe.top_k_categories(common.clean(spark, sf, "crime_desc"), "crime_desc", 15)


@register("top_k_within_area", _sql(
    "SELECT * FROM (SELECT area_name, crime_desc, n, CAST(row_number() OVER (PARTITION BY area_name "
    "ORDER BY n DESC, crime_desc) AS INTEGER) AS rank FROM (SELECT area_name, crime_desc, count(*) AS n "
    "FROM clean WHERE area_name IS NOT NULL AND crime_desc IS NOT NULL GROUP BY 1, 2)) WHERE rank <= 12"))
def q_top_k_within_area(spark, sf):
    return describe.top_k_within_area(common.clean(spark, sf, "area_name", "crime_desc"), k=12)


@register("victim_age_histogram", _sql("""
SELECT s.bin, round(mn + bin * ((mx - mn) / 40), 6) AS bin_lo,
       round(mn + (bin + 1) * ((mx - mn) / 40), 6) AS bin_hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(unnest(range(0, 40)) AS INTEGER) AS bin, mn, mx FROM hr WHERE mn IS NOT NULL) s
LEFT JOIN (
  SELECT CAST(least(39, coalesce(floor((x - mn) * 40 / nullif(mx - mn, 0)), 0)) AS INTEGER) AS bin,
         count(*) AS n
  FROM hv, hr GROUP BY 1
) c USING (bin)""", ["""
hv AS (SELECT CAST(victim_age AS DOUBLE) AS x FROM clean
       WHERE victim_age IS NOT NULL AND victim_age BETWEEN 5 AND 90),
hr AS (SELECT min(x) AS mn, max(x) AS mx FROM hv)"""]))
def q_victim_age_histogram(spark, sf):
    return rounded(describe.victim_age_histogram(common.clean(spark, sf, "victim_age")))


@register("victim_sex_counts", _sql(
    "SELECT victim_sex, count(*) AS n FROM clean WHERE victim_sex IS NOT NULL GROUP BY victim_sex"))
def q_victim_sex_counts(spark, sf):
    return describe.victim_sex_counts(common.clean(spark, sf, "victim_sex"))


@register("arrest_rate_by_crime", _sql(
    "SELECT crime_desc, n, arrests, round(arrests / n, 6) AS arrest_rate FROM ("
    "SELECT crime_desc, count(dr_no) AS n, CAST(sum(is_arrest) AS BIGINT) AS arrests FROM clean "
    "WHERE crime_desc IS NOT NULL GROUP BY crime_desc) WHERE n > 400 "
    "ORDER BY arrests / n DESC, crime_desc LIMIT 15"))
def q_arrest_rate_by_crime(spark, sf):
    return rounded(describe.arrest_rate_by_crime(common.clean(spark, sf, "dr_no", "crime_desc", "is_arrest"), min_n=400))


@register("share_by_area", _sql(
    "SELECT area_name, round(avg(is_violent), 6) AS violent_share, round(avg(is_arrest), 6) AS arrest_rate "
    "FROM clean WHERE area_name IS NOT NULL GROUP BY area_name"))
def q_share_by_area(spark, sf):
    return rounded(describe.share_by_area(common.clean(spark, sf, "area_name", "is_violent", "is_arrest")))


@register("kpi_summary", _sql(
    "SELECT count(*) AS crimes, round(coalesce(avg(is_violent) * 100, 0.0), 6) AS violent_pct, "
    "round(coalesce(avg(is_arrest) * 100, 0.0), 6) AS arrest_pct, count(DISTINCT area_name) AS areas, "
    "count(DISTINCT crime_desc) AS crime_types FROM clean "
    "WHERE date_occurred >= TIMESTAMP '1996-01-01' AND date_occurred < TIMESTAMP '1999-01-01' "
    "AND area_name IN ('NATION_3', 'NATION_7', 'NATION_12')"))
def q_kpi_summary(spark, sf):
    args = dict(FILTER_ARGS, violent_only=False)
    return rounded(describe.kpi_summary(cleaning.filter_incidents(common.clean(spark, sf, "date_occurred", "area_name", "crime_desc", "is_violent", "is_arrest"), **args)))


@register("counts_by_period", _sql(
    "SELECT 'month' AS period, month AS value, count(*) AS n FROM clean WHERE month IS NOT NULL "
    "GROUP BY month UNION ALL SELECT 'hour' AS period, hour AS value, count(*) AS n FROM clean "
    "WHERE hour IS NOT NULL GROUP BY hour"))
def q_counts_by_period(spark, sf):
    return describe.counts_by_period(common.clean(spark, sf, "month", "hour"))


@register("area_profile", _sql(
    "SELECT area_id, area_name, round(avg(crimes), 6) AS mean_crimes, "
    "round(coalesce(stddev_samp(crimes), 0.0), 6) AS std_crimes, round(avg(violent), 6) AS violent, "
    "round(avg(arrests), 6) AS arrest FROM daily GROUP BY area_id, area_name", [DAILY]))
def q_area_profile(spark, sf):
    return rounded(describe.area_profile(common.daily(spark, sf)))


@register("grid_hotspots", _sql("""
SELECT round(lat_key * CAST(0.0025 AS DOUBLE), 6) AS lat, round(lon_key * CAST(0.0025 AS DOUBLE), 6) AS lon, lat_key, lon_key,
       crimes, violent, round(coalesce(CAST(violent AS DOUBLE) / nullif(crimes, 0), 0.0), 6) AS violent_share
FROM (
  SELECT CAST(round_even(lat / 0.0025, 0) AS BIGINT) AS lat_key,
         CAST(round_even(lon / 0.0025, 0) AS BIGINT) AS lon_key,
         count(dr_no) AS crimes, CAST(sum(is_violent) AS BIGINT) AS violent
  FROM clean WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY 1, 2
)"""))
def q_grid_hotspots(spark, sf):
    return rounded(describe.grid_hotspots(common.clean(spark, sf, "dr_no", "lat", "lon", "is_violent")))
