"""Catalog entries for panels, densification, resampling and tail trimming."""

from __future__ import annotations

from pyspark.sql import functions as F

from citypulse.operators import panels
from citypulse.plans import common
from citypulse.plans.catalog import register, rounded
from citypulse.plans.oracle_sql import BASE, DAILY, THIN, daily_ctes, trim_ctes, weekly_cte, with_ctes

PANEL_COLS = ("date, area_id, area_name, crimes, violent, arrests, "
              "round(violent_ratio, 6) AS violent_ratio, round(arrest_ratio, 6) AS arrest_ratio")


def _sql(body, extra=()):
    return with_ctes(*BASE, *extra, body=body)


@register("daily_area_panel", _sql(f"SELECT {PANEL_COLS} FROM daily", [DAILY]))
def q_daily_area_panel(spark, sf):
    return rounded(common.daily_fresh(spark, sf))


# densify on a sparse input: the thinned fixture leaves many (date, area) cells empty.
@register("densify_panel", _sql(
    "SELECT date, area_id, area_name, crimes, violent, arrests FROM dthin",
    [THIN, daily_ctes("clean_thin", "dthin")]))
def q_densify_panel(spark, sf):
    from citypulse.sources import fixtures
    sparse = panels.daily_area_panel(fixtures.thin_tail(common.panel_input(spark, sf)), dense=False)
    bounds = sparse.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return panels.densify_panel(sparse, bounds, fill_cols=("crimes", "violent", "arrests"))


@register("weekly_area_panel", _sql(f"SELECT {PANEL_COLS} FROM weekly", [DAILY, weekly_cte()]))
def q_weekly_area_panel(spark, sf):
    return rounded(common.weekly(spark, sf))


RESAMPLE_W = """
rs_agg AS (
  SELECT CAST(CAST(date_occurred AS DATE) + CAST(7 - isodow(date_occurred) AS INTEGER) AS DATE) AS date,
         count(dr_no) AS n
  FROM clean GROUP BY 1
),
rs_spine AS (
  SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE) AS date FROM rs_agg
)"""


@register("resample_counts", _sql(
    "SELECT s.date, CAST(coalesce(a.n, 0) AS BIGINT) AS n FROM rs_spine s LEFT JOIN rs_agg a USING (date)",
    [RESAMPLE_W]))
def q_resample_counts(spark, sf):
    return panels.resample_counts(common.clean(spark, sf, "dr_no", "date_occurred"), freq="W")


RESAMPLE_ME = """
two_agg AS (
  SELECT last_day(CAST(date_occurred AS DATE)) AS date, count(dr_no) AS n_all,
         count(CASE WHEN is_violent = 1 THEN dr_no END) AS n_flag,
         count(*) FILTER (WHERE is_violent = 1) AS rows_flag
  FROM clean GROUP BY 1
),
two_bounds AS (
  SELECT min(date) AS lo, max(date) AS hi,
         min(date) FILTER (WHERE rows_flag > 0) AS flo, max(date) FILTER (WHERE rows_flag > 0) AS fhi
  FROM two_agg
),
two_spine AS (
  SELECT last_day(CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi),
         INTERVAL 1 MONTH)) AS DATE)) AS date FROM two_bounds
)"""


@register("resample_two_series", _sql(
    "SELECT s.date, CAST(coalesce(a.n_all, 0) AS BIGINT) AS all_crimes, "
    "CAST(CASE WHEN s.date BETWEEN b.flo AND b.fhi THEN coalesce(a.n_flag, 0) END AS BIGINT) AS violent "
    "FROM two_spine s LEFT JOIN two_agg a USING (date) CROSS JOIN two_bounds b", [RESAMPLE_ME]))
def q_resample_two_series(spark, sf):
    return panels.resample_two_series(common.clean(spark, sf, "dr_no", "date_occurred", "is_violent"), freq="ME")


@register("citywide_daily_totals", _sql(
    "SELECT date, CAST(sum(crimes) AS BIGINT) AS crimes FROM daily GROUP BY date", [DAILY]))
def q_citywide_daily_totals(spark, sf):
    return panels.citywide_daily_totals(common.daily(spark, sf))


@register("trim_incomplete_tail", _sql(
    f"SELECT {PANEL_COLS} FROM trimmed",
    [THIN, daily_ctes("clean_thin", "dthin"), trim_ctes("dthin", "trimmed")]))
def q_trim_incomplete_tail(spark, sf):
    return rounded(panels.trim_incomplete_tail(common.daily_thin(spark, sf)))


@register("trim_weekly_tail", _sql(
    f"SELECT {PANEL_COLS} FROM wthin WHERE date <= (SELECT max(date) - 14 FROM trimmed)",
    [THIN, daily_ctes("clean_thin", "dthin"), trim_ctes("dthin", "trimmed"),
     weekly_cte("dthin", "wthin")]))
def q_trim_weekly_tail(spark, sf):
    d = common.daily_thin(spark, sf)
    return rounded(panels.trim_weekly_tail(panels.weekly_area_panel(d), panels.trim_incomplete_tail(d)))
