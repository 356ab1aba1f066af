"""Catalog entries: window features, risk scoring, metrics, splits, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from citypulse.operators import describe, evaluate, features, risk, sampling
from citypulse.plans import common
from citypulse.plans.catalog import register, rounded
from citypulse.plans.oracle_sql import BASE, DAILY, weekly_cte, with_ctes
from citypulse.session import stored
from citypulse.sources import fixtures


def _sql(body, extra=()):
    return with_ctes(*BASE, *extra, body=body)


def _win(part, frame=None):
    f = f" ROWS BETWEEN {frame}" if frame else ""
    return f"OVER (PARTITION BY {part} ORDER BY date{f})"


def lag_sql(src="daily", name="lagged", lags=(1, 7, 14, 28), rolls=(7, 28, 90), stds=None,
            calendar="daily"):
    stds = rolls if stds is None else stds
    cols = [f"CAST(lag(crimes, {L}) {_win('area_id')} AS DOUBLE) AS lag_{L}" for L in lags]
    for R in rolls:
        w = _win("area_id", f"{R} PRECEDING AND 1 PRECEDING")
        cols.append(f"CASE WHEN count(crimes) {w} = {R} THEN avg(crimes) {w} END AS roll_mean_{R}")
        if R in stds:
            cols.append(f"CASE WHEN count(crimes) {w} = {R} THEN stddev_samp(crimes) {w} END AS roll_std_{R}")
    if calendar == "daily":
        cols += ["CAST(isodow(date) - 1 AS INTEGER) AS dow", "CAST(month(date) AS INTEGER) AS month",
                 "CAST(year(date) AS INTEGER) AS year", "CAST(dayofyear(date) AS INTEGER) AS doy",
                 "CAST(weekofyear(date) AS INTEGER) AS weekofyear",
                 "CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend"]
    else:
        cols += ["CAST(weekofyear(date) AS INTEGER) AS weekofyear",
                 "CAST(month(date) AS INTEGER) AS month", "CAST(year(date) AS INTEGER) AS year"]
    body = f"{name}_0 AS (SELECT *, {', '.join(cols)} FROM {src})"
    if calendar == "daily":
        w = _win("area_id, dow", "UNBOUNDED PRECEDING AND 1 PRECEDING")
        body += (f",\n{name} AS (SELECT *, CASE WHEN count(crimes) {w} >= 4 THEN avg(crimes) {w} END "
                 f"AS adow_mean FROM {name}_0)")
    else:
        body += f",\n{name} AS (SELECT * FROM {name}_0)"
    return "\n" + body


LAGGED = lag_sql()
R6 = "round({0}, 6) AS {0}"


def _r(*cols):
    return ", ".join(R6.format(c) for c in cols)


ROLL_COLS = ("roll_mean_7", "roll_std_7", "roll_mean_28", "roll_std_28", "roll_mean_90", "roll_std_90")
CAL_COLS = "dow, month, year, doy, weekofyear, is_weekend"


def lagged(spark, sf):
    return features.add_lag_features(common.daily(spark, sf))


@register("lag_features", _sql("SELECT date, area_id, lag_1, lag_7, lag_14, lag_28 FROM lagged",
                               [DAILY, LAGGED]))
def q_lag_features(spark, sf):
    return features.lag_features(common.daily(spark, sf)).select(
        "date", "area_id", "lag_1", "lag_7", "lag_14", "lag_28")


@register("rolling_features", _sql(f"SELECT date, area_id, {_r(*ROLL_COLS)} FROM lagged", [DAILY, LAGGED]))
def q_rolling_features(spark, sf):
    return rounded(features.rolling_features(common.daily(spark, sf)).select("date", "area_id", *ROLL_COLS))


@register("calendar_features", _sql(f"SELECT date, area_id, {CAL_COLS} FROM lagged", [DAILY, LAGGED]))
def q_calendar_features(spark, sf):
    return features.calendar_features(common.daily(spark, sf)).select(
        "date", "area_id", *CAL_COLS.split(", "))


@register("expanding_dow_mean", _sql(f"SELECT date, area_id, {_r('adow_mean')} FROM lagged", [DAILY, LAGGED]))
def q_expanding_dow_mean(spark, sf):
    return rounded(features.expanding_dow_mean(common.daily(spark, sf)).select("date", "area_id", "adow_mean"))


ALL_LAG = ("date, area_id, area_name, crimes, violent, arrests, lag_1, lag_7, lag_14, lag_28, "
           f"{_r(*ROLL_COLS, 'violent_ratio', 'arrest_ratio', 'adow_mean')}, {CAL_COLS}")


@register("add_lag_features", _sql(f"SELECT {ALL_LAG} FROM lagged", [DAILY, LAGGED]))
def q_add_lag_features(spark, sf):
    return rounded(lagged(spark, sf))


WEEKLY_LAGGED = lag_sql("weekly", "wlagged", (1, 2, 4, 8), (4, 12), (4,), calendar="weekly")
WEEKLY_COLS = ("date, area_id, area_name, crimes, lag_1, lag_2, lag_4, lag_8, "
               f"{_r('roll_mean_4', 'roll_mean_12', 'roll_std_4')}, weekofyear, month, year")


@register("weekly_lag_features", _sql(f"SELECT {WEEKLY_COLS} FROM wlagged",
                                      [DAILY, weekly_cte(), WEEKLY_LAGGED]))
def q_weekly_lag_features(spark, sf):
    p = features.weekly_lag_features(common.weekly(spark, sf))
    return rounded(p.select("date", "area_id", "area_name", "crimes", "lag_1", "lag_2", "lag_4", "lag_8",
                            "roll_mean_4", "roll_mean_12", "roll_std_4", "weekofyear", "month", "year"))


@register("moving_average_7", _sql(
    "SELECT date, area_id, area_name, round(avg(crimes) OVER (PARTITION BY area_id, area_name ORDER BY date "
    "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS roll7 FROM daily", [DAILY]))
def q_moving_average_7(spark, sf):
    return rounded(features.moving_average_7(common.daily(spark, sf)).select("date", "area_id", "area_name", "roll7"))


# --- risk ----------------------------------------------------------------------

PROFILE = """
profile AS (
  SELECT area_id, area_name, avg(crimes) AS mean_crimes, coalesce(stddev_samp(crimes), 0.0) AS std_crimes,
         avg(violent) AS violent, avg(arrests) AS arrest
  FROM daily GROUP BY area_id, area_name
)"""


@register("min_max_scale", _sql(
    "SELECT area_id, round((mean_crimes - mn1) / nullif(mx1 - mn1, 0), 6) AS mean_crimes_n, "
    "round(CASE WHEN mx2 = mn2 THEN 0.0 ELSE (std_crimes - mn2) / (mx2 - mn2) END, 6) AS std_crimes_n "
    "FROM profile, (SELECT min(mean_crimes) mn1, max(mean_crimes) mx1, min(std_crimes) mn2, "
    "max(std_crimes) mx2 FROM profile)", [DAILY, PROFILE]))
def q_min_max_scale(spark, sf):
    prof = describe.area_profile(common.daily(spark, sf))
    return rounded(risk.min_max_scale(prof, ["mean_crimes", "std_crimes"]).select(
        "area_id", "mean_crimes_n", "std_crimes_n"))


@register("rank_desc_min", _sql(
    "SELECT area_id, violent, CAST(rank() OVER (ORDER BY violent DESC) AS INTEGER) AS violent_rank "
    "FROM (SELECT area_id, CAST(floor(sum(violent) / 10) AS BIGINT) AS violent FROM daily GROUP BY area_id)", [DAILY]))
def q_rank_desc_min(spark, sf):
    t = common.daily(spark, sf).groupBy("area_id").agg(
        F.floor(F.sum("violent") / 10).cast("bigint").alias("violent"))
    return risk.rank_desc_min(t, "violent", "violent_rank")


@register("quantile_tiers", _sql(
    "SELECT area_id, round(mean_crimes, 6) AS mean_crimes, CASE WHEN mean_crimes IS NULL THEN NULL "
    "WHEN mean_crimes <= q1 THEN 'Low' WHEN mean_crimes <= q2 THEN 'Medium' WHEN mean_crimes <= q3 "
    "THEN 'High' ELSE 'Critical' END AS tier FROM profile, (SELECT quantile_cont(mean_crimes, 0.25) q1, "
    "quantile_cont(mean_crimes, 0.5) q2, quantile_cont(mean_crimes, 0.75) q3 FROM profile)",
    [DAILY, PROFILE]))
def q_quantile_tiers(spark, sf):
    prof = describe.area_profile(common.daily(spark, sf))
    return rounded(risk.quantile_tiers(prof, "mean_crimes", "tier").select("area_id", "mean_crimes", "tier"))


@register("first_per_group", _sql(
    "SELECT area_name, crime_desc AS top_crime, n FROM (SELECT area_name, crime_desc, n, row_number() OVER "
    "(PARTITION BY area_name ORDER BY n DESC, crime_desc) AS rn FROM (SELECT area_name, crime_desc, "
    "count(*) AS n FROM clean WHERE area_name IS NOT NULL AND crime_desc IS NOT NULL GROUP BY 1, 2)) "
    "WHERE rn = 1"))
def q_first_per_group(spark, sf):
    top = describe.top_k_within_area(common.clean(spark, sf, "area_name", "crime_desc"), k=1)
    return top.select("area_name", F.col("crime_desc").alias("top_crime"), "n")


# Forecast stand-in from the panel itself (no model): the last 7 days of the
# lagged panel with y_pred = previous 28-day mean; areas with id % 3 = 0 have
# none, exercising the fallback to intensity.
FC = """
fc AS (
  SELECT date, area_id, area_name, roll_mean_28 AS y_pred FROM lagged
  WHERE date > (SELECT max(date) - 7 FROM lagged) AND area_id % 3 <> 0
)"""


def forecast_standin(lag):
    last = lag.agg(F.date_sub(F.max("date"), 7).alias("__c"))
    return (lag.crossJoin(F.broadcast(last)).where((F.col("date") > F.col("__c")) & (F.col("area_id") % 3 != 0))
            .select("date", "area_id", "area_name", F.col("roll_mean_28").alias("y_pred")))


RISK = """
rk_last AS (SELECT max(date) AS last_day FROM daily),
rk_comp AS (
  SELECT area_id, area_name,
    avg(crimes) FILTER (WHERE date > last_day - 28) AS intensity,
    avg(violent_ratio) FILTER (WHERE date > last_day - 28) AS violence,
    avg(crimes) AS long_mean, stddev_samp(crimes) AS long_std,
    count(*) FILTER (WHERE date > last_day - 28) AS n_recent
  FROM daily, rk_last WHERE date > last_day - 90 GROUP BY area_id, area_name
),
rk_fc AS (SELECT area_id, area_name, avg(y_pred) AS f FROM fc GROUP BY area_id, area_name),
rk_j AS (
  SELECT c.area_id, c.area_name, intensity, violence, long_mean, long_std,
    coalesce((intensity - long_mean) / nullif(long_std, 0), 0.0) AS trend,
    coalesce(f.f, intensity) AS forecast
  FROM rk_comp c LEFT JOIN rk_fc f ON c.area_id = f.area_id AND c.area_name = f.area_name
  WHERE n_recent > 0
),
rk_mm AS (
  SELECT min(intensity) a0, max(intensity) a1, min(trend) b0, max(trend) b1,
         min(violence) c0, max(violence) c1, min(forecast) d0, max(forecast) d1 FROM rk_j
),
rk_n AS (
  SELECT rk_j.*,
    CASE WHEN a1 - a0 = 0 OR a1 - a0 IS NULL THEN 0.0 ELSE (intensity - a0) / (a1 - a0) END AS intensity_n,
    CASE WHEN b1 - b0 = 0 OR b1 - b0 IS NULL THEN 0.0 ELSE (trend - b0) / (b1 - b0) END AS trend_n,
    CASE WHEN c1 - c0 = 0 OR c1 - c0 IS NULL THEN 0.0 ELSE (violence - c0) / (c1 - c0) END AS violence_n,
    CASE WHEN d1 - d0 = 0 OR d1 - d0 IS NULL THEN 0.0 ELSE (forecast - d0) / (d1 - d0) END AS forecast_n
  FROM rk_j, rk_mm
),
rk_s AS (
  SELECT *, 0.35 * intensity_n + 0.2 * trend_n + 0.2 * violence_n + 0.25 * forecast_n AS risk_score FROM rk_n
),
rk_q AS (SELECT quantile_cont(risk_score, 0.25) q1, quantile_cont(risk_score, 0.5) q2,
                quantile_cont(risk_score, 0.75) q3 FROM rk_s),
risk AS (
  SELECT rk_s.*, CAST(rank() OVER (ORDER BY risk_score DESC) AS INTEGER) AS risk_rank,
    CASE WHEN risk_score IS NULL THEN NULL WHEN risk_score <= q1 THEN 'Low' WHEN risk_score <= q2 THEN 'Medium'
         WHEN risk_score <= q3 THEN 'High' ELSE 'Critical' END AS risk_tier
  FROM rk_s, rk_q
)"""

RISK_COLS = ("intensity", "violence", "long_mean", "long_std", "trend", "forecast", "intensity_n",
             "trend_n", "violence_n", "forecast_n", "risk_score")


def risk_table(spark, sf):
    d = common.daily(spark, sf)
    return risk.area_risk(d, forecast_standin(features.add_lag_features(d)))


NO_FC = "fc AS (SELECT area_id, area_name, CAST(NULL AS DOUBLE) AS y_pred FROM daily WHERE 1 = 0)"


@register("area_risk_no_forecast", _sql(f"SELECT area_id, area_name, {_r(*RISK_COLS)}, risk_rank, risk_tier FROM risk",
                            [DAILY, NO_FC, RISK]))
def q_area_risk_no_forecast(spark, sf):
    return rounded(risk.area_risk(common.daily(spark, sf)))


@register("area_risk", _sql(f"SELECT area_id, area_name, {_r(*RISK_COLS)}, risk_rank, risk_tier FROM risk",
                            [DAILY, LAGGED, FC, RISK]))
def q_area_risk(spark, sf):
    return rounded(risk_table(spark, sf))


@register("risk_decomposition", _sql(
    "SELECT area_id, area_name, risk_rank, round(risk_score, 6) AS risk_score, risk_tier, "
    f"{_r('intensity_n', 'trend_n', 'violence_n', 'forecast_n')} FROM risk "
    "ORDER BY risk_score DESC, area_id LIMIT 10", [DAILY, LAGGED, FC, RISK]))
def q_risk_decomposition(spark, sf):
    return rounded(risk.risk_decomposition(risk_table(spark, sf)))


@register("join_area_components", _sql(
    f"SELECT area_id, area_name, {_r('intensity', 'forecast')} FROM rk_j", [DAILY, LAGGED, FC, RISK]))
def q_join_area_components(spark, sf):
    d = common.daily(spark, sf)
    comp = risk.area_components(d)
    j = risk.join_area_components(comp, forecast_standin(features.add_lag_features(d)))
    return rounded(j.select("area_id", "area_name", "intensity", "forecast"))


@register("area_drilldown", _sql(
    "SELECT d.area_id, d.area_name, round(avg(crimes), 6) AS mean_per_day, "
    "round(avg(crimes) FILTER (WHERE rn <= 28), 6) AS recent_mean, any_value(r.risk_tier) AS risk_tier "
    "FROM (SELECT *, row_number() OVER (PARTITION BY area_id, area_name ORDER BY date DESC) AS rn FROM daily) d "
    "LEFT JOIN risk r ON d.area_id = r.area_id AND d.area_name = r.area_name GROUP BY d.area_id, d.area_name",
    [DAILY, LAGGED, FC, RISK]))
def q_area_drilldown(spark, sf):
    return rounded(describe.area_drilldown(common.daily(spark, sf), risk_table(spark, sf)))


# --- forecast evaluation on the panel's own baselines -----------------------------

SCORED = """
fcut AS (SELECT max(date) AS mx FROM lagged WHERE lag_28 IS NOT NULL AND roll_mean_28 IS NOT NULL
         AND adow_mean IS NOT NULL),
fsplit AS (
  SELECT l.*, CASE WHEN date <= mx - 120 THEN 'train' WHEN date <= mx - 60 THEN 'val' ELSE 'test' END AS split
  FROM lagged l, fcut
  WHERE lag_28 IS NOT NULL AND roll_mean_28 IS NOT NULL AND adow_mean IS NOT NULL
),
ftest AS (
  SELECT date, area_id, area_name, crimes AS y_true, roll_mean_7 AS y_pred, roll_mean_28 AS naive
  FROM fsplit WHERE split = 'test'
)"""


def split_panel(spark, sf):
    lag = lagged(spark, sf).dropna(subset=["lag_28", "roll_mean_28", "adow_mean"])
    return sampling.forward_chained_split(lag, test_days=60, val_days=60)


def naive_scored(spark, sf):
    t = split_panel(spark, sf).where(F.col("split") == "test")
    return t.select("date", "area_id", "area_name", F.col("crimes").alias("y_true"),
                    F.col("roll_mean_7").alias("y_pred"), F.col("roll_mean_28").alias("naive"))


@register("forward_chained_split", _sql("SELECT date, area_id, split FROM fsplit", [DAILY, LAGGED, SCORED]))
def q_forward_chained_split(spark, sf):
    return split_panel(spark, sf).select("date", "area_id", "split")


@register("naive_baseline", _sql(
    "SELECT date, area_id, y_true, round(coalesce(naive, avg(y_true) OVER ()), 6) AS naive FROM ftest",
    [DAILY, LAGGED, SCORED]))
def q_naive_baseline(spark, sf):
    t = naive_scored(spark, sf)
    mean = t.agg(F.avg("y_true").alias("__m"))
    return rounded(t.crossJoin(F.broadcast(mean)).select(
        "date", "area_id", "y_true", F.coalesce(F.col("naive"), F.col("__m")).alias("naive")))


@register("regression_metrics", _sql("""
SELECT count(*) AS n, round(avg(abs(y_pred - y_true)), 6) AS mae,
  round(sqrt(avg((y_pred - y_true) ^ 2)), 6) AS rmse,
  round(avg(CASE WHEN y_true > 0 THEN abs(y_pred - y_true) / y_true END), 6) AS mape,
  round(avg(abs(coalesce(naive, ybar) - y_true)), 6) AS naive_mae,
  round(CASE WHEN sum((y_true - ybar) ^ 2) > 0 THEN 1 - sum((y_pred - y_true) ^ 2) / sum((y_true - ybar) ^ 2)
       WHEN sum((y_pred - y_true) ^ 2) = 0 THEN 1.0 ELSE 0.0 END, 6) AS r2,
  round(CASE WHEN avg(abs(coalesce(naive, ybar) - y_true)) > 0
       THEN 1 - avg(abs(y_pred - y_true)) / avg(abs(coalesce(naive, ybar) - y_true)) ELSE 0.0 END, 6) AS skill
FROM ftest, (SELECT avg(y_true) AS ybar FROM ftest)""", [DAILY, LAGGED, SCORED]))
def q_regression_metrics(spark, sf):
    return rounded(evaluate.regression_metrics(naive_scored(spark, sf)))


@register("forecast_vs_actual", _sql(
    f"SELECT date, area_id, area_name, y_true, {_r('y_pred')} FROM ftest WHERE area_id IN "
    "(SELECT DISTINCT area_id FROM ftest ORDER BY area_id LIMIT 4)", [DAILY, LAGGED, SCORED]))
def q_forecast_vs_actual(spark, sf):
    return rounded(describe.forecast_vs_actual(naive_scored(spark, sf)))


@register("forecast_totals", _sql(
    "SELECT 'date' AS by, date, CAST(NULL AS INTEGER) AS area_id, CAST(NULL AS VARCHAR) AS area_name, "
    "round(sum(y_pred), 6) AS y_pred_total FROM fc GROUP BY date UNION ALL SELECT 'area' AS by, "
    "CAST(NULL AS DATE) AS date, area_id, area_name, round(sum(y_pred), 6) AS y_pred_total FROM fc "
    "GROUP BY area_id, area_name", [DAILY, LAGGED, FC]))
def q_forecast_totals(spark, sf):
    return rounded(describe.forecast_totals(forecast_standin(lagged(spark, sf))))


# --- classifier metrics on fixed scores ---------------------------------------------

SC = """
sc AS (SELECT o_orderkey AS row_id, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
              CAST(floor(o_totalprice / 5000) / 100 AS DOUBLE) AS score FROM orders),
st AS (SELECT score AS s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
       FROM sc GROUP BY score),
cu AS (SELECT s, pos, neg,
         coalesce(sum(pos) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pb,
         coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
       FROM st),
tot AS (SELECT sum(pos) AS np, sum(neg) AS nn FROM st)"""

BIN = """
cm AS (SELECT count(*) FILTER (WHERE y = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE y <> 1 AND score >= 0.5) AS fp,
              count(*) FILTER (WHERE y <> 1 AND score < 0.5) AS tn, count(*) FILTER (WHERE y = 1 AND score < 0.5) AS fn
       FROM sc),
pr AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision_pos, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall_pos,
              coalesce(tn / nullif(tn + fn, 0), 0.0) AS precision_neg, coalesce(tn / nullif(tn + fp, 0), 0.0) AS recall_neg
       FROM cm),
f AS (SELECT *, coalesce(2 * precision_pos * recall_pos / nullif(precision_pos + recall_pos, 0), 0.0) AS f1_pos,
             coalesce(2 * precision_neg * recall_neg / nullif(precision_neg + recall_neg, 0), 0.0) AS f1_neg FROM pr)"""


@register("binary_metrics", with_ctes(SC, BIN, body=(
    f"SELECT tp, fp, tn, fn, {_r('precision_pos', 'recall_pos', 'precision_neg', 'recall_neg', 'f1_pos', 'f1_neg')}, "
    "round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0.0), 6) AS accuracy, "
    "round((f1_pos + f1_neg) / 2, 6) AS f1_macro, tp + fn AS support_pos, tn + fp AS support_neg FROM f")))
def q_binary_metrics(spark, sf):
    return rounded(evaluate.binary_metrics(fixtures.scored(spark, sf), "y", "score"))


@register("roc_auc", with_ctes(SC, body=(
    "SELECT round(sum(pos * (nb + neg * 0.5)) / any_value(np * nn), 6) AS roc_auc FROM cu, tot")))
def q_roc_auc(spark, sf):
    return rounded(evaluate.roc_auc(fixtures.scored(spark, sf), "y", "score"))


@register("average_precision", with_ctes(SC, body=(
    "SELECT round(sum(CASE WHEN pos > 0 THEN pos / np * (np - pb) / ((np - pb) + (nn - nb)) END), 6) "
    "AS average_precision FROM cu, tot")))
def q_average_precision(spark, sf):
    return rounded(evaluate.average_precision(fixtures.scored(spark, sf), "y", "score"))


# Model battery stand-in: two targets x two scorers, best by PR-AUC.
BEST = """
bs AS (
  SELECT t.target, m.model, CASE WHEN t.target = 'is_f' THEN CAST(o_orderstatus = 'F' AS INTEGER)
         ELSE CAST(o_orderstatus = 'O' AS INTEGER) END AS y,
         CASE WHEN m.model = 'price' THEN floor(o_totalprice / 5000) / 100
              ELSE 1 - floor(o_totalprice / 5000) / 100 END AS score
  FROM orders, (VALUES ('is_f'), ('is_o')) t(target), (VALUES ('price'), ('price_inverse')) m(model)
),
bst AS (SELECT target, model, score AS s, count(*) FILTER (WHERE y = 1) AS pos,
               count(*) FILTER (WHERE y <> 1) AS neg FROM bs GROUP BY 1, 2, 3),
bcu AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS pb, coalesce(sum(neg) OVER w, 0) AS nb,
               sum(pos) OVER (PARTITION BY target, model) AS np, sum(neg) OVER (PARTITION BY target, model) AS nn
        FROM bst WINDOW w AS (PARTITION BY target, model ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
bm AS (SELECT target, model, sum(CASE WHEN pos > 0 THEN pos / np * (np - pb) / ((np - pb) + (nn - nb)) END) AS pr_auc
       FROM bcu GROUP BY 1, 2)"""


@register("select_best_model", with_ctes(BEST, body=(
    "SELECT target, model AS best_model, round(pr_auc, 6) AS best_pr_auc FROM (SELECT *, row_number() OVER "
    "(PARTITION BY target ORDER BY pr_auc DESC, model) AS rn FROM bm) WHERE rn = 1")))
def q_select_best_model(spark, sf):
    o = fixtures.table(spark, sf, "orders")
    base = F.floor(F.col("o_totalprice") / 5000) / 100
    rows = []
    for target, status in (("is_f", "F"), ("is_o", "O")):
        for model, score in (("price", base), ("price_inverse", 1 - base)):
            scored = o.select((F.col("o_orderstatus") == status).cast("int").alias("y"),
                              score.cast("double").alias("prob"))
            rows.append(evaluate.average_precision(scored, "y", "prob").select(
                F.lit(target).alias("target"), F.lit(model).alias("model"),
                F.col("average_precision").alias("pr_auc")))
    metrics = rows[0]
    for r in rows[1:]:
        metrics = metrics.unionByName(r)
    return rounded(evaluate.select_best_model(metrics))


# --- unions, distinct, code maps, splits --------------------------------------------

@register("union_history", _sql(
    "SELECT date, area_id, area_name, crimes FROM daily WHERE date > (SELECT max(date) - 7 FROM daily) "
    "UNION ALL SELECT CAST(m + INTERVAL (k) DAY AS DATE) AS date, area_id, area_name, CAST(NULL AS BIGINT) AS crimes "
    "FROM (SELECT DISTINCT area_id, area_name FROM daily), (SELECT max(date) AS m FROM daily), range(1, 8) r(k)",
    [DAILY]))
def q_union_history(spark, sf):
    d = common.daily(spark, sf)
    last = d.agg(F.max("date").alias("__m"))
    recent = (d.crossJoin(F.broadcast(last)).where(F.col("date") > F.date_sub("__m", 7))
              .select("date", "area_id", "area_name", "crimes"))
    areas = d.select("area_id", "area_name").distinct()
    steps = last.select(F.explode(F.sequence(F.date_add("__m", 1), F.date_add("__m", 7))).alias("date"))
    placeholders = areas.crossJoin(F.broadcast(steps))
    return sampling.union_history(recent, placeholders).select("date", "area_id", "area_name", "crimes")


@register("distinct_pairs", _sql(
    "SELECT area_id, area_name, dr_no AS first_dr_no, date_occurred AS first_date FROM (SELECT area_id, "
    "area_name, dr_no, date_occurred, row_number() OVER (PARTITION BY area_id, area_name ORDER BY "
    "date_occurred, dr_no) AS rn FROM clean) WHERE rn = 1"))
def q_distinct_pairs(spark, sf):
    c = common.clean(spark, sf, "area_id", "area_name", "dr_no", "date_occurred")
    out = sampling.distinct_pairs(c, ["area_id", "area_name"], first_by=["date_occurred", "dr_no"])
    return out.select("area_id", "area_name", F.col("dr_no").alias("first_dr_no"),
                      F.col("date_occurred").alias("first_date"))


@register("area_code_map", _sql(
    "SELECT area_id, CAST(dense_rank() OVER (ORDER BY area_id) - 1 AS INTEGER) AS area_code "
    "FROM (SELECT DISTINCT area_id FROM daily)", [DAILY]))
def q_area_code_map(spark, sf):
    return sampling.area_code_map(common.daily(spark, sf))


@register("exact_sample")
def q_exact_sample(spark, sf):
    """Rows-only check: exactly 5000 incidents (fewer tables give all rows)."""
    return sampling.exact_sample(common.clean(spark, sf, "dr_no", "area_id", "is_violent"), 5000)


@register("exact_sample_check", _sql(
    "SELECT least(5000, count(*)) AS n, least(5000, count(*)) AS n_members FROM clean"))
def q_exact_sample_check(spark, sf):
    """The sample's size, and how many of its rows are members of the sampled table."""
    c = common.clean(spark, sf, "dr_no")
    s = stored(sampling.exact_sample(c, 5000), "sample")
    # the table is cut down to the (at most 5000) sampled keys where it is read
    met = c.join(F.broadcast(s.distinct()), "dr_no", "left_semi")
    members = s.join(met, "dr_no", "left_semi").agg(F.count(F.lit(1)).alias("n_members"))
    return s.agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(members))


@register("stratified_split", _sql(
    "SELECT is_violent, 'train' AS split, CAST(round(count(*) * 0.8) AS BIGINT) AS n FROM clean GROUP BY is_violent UNION ALL "
    "SELECT is_violent, 'test' AS split, CAST(count(*) - round(count(*) * 0.8) AS BIGINT) AS n FROM clean GROUP BY is_violent"))
def q_stratified_split(spark, sf):
    """Counts per (class, split) of an exact 80/20 split."""
    c = common.clean(spark, sf, "dr_no", "is_violent")
    s = sampling.stratified_split(c, "is_violent", 0.8)
    return s.groupBy("is_violent", "split").agg(F.count(F.lit(1)).alias("n"))
