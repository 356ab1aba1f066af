"""End-to-end run of the seven batch steps, with Parquet artifacts between them.

preprocess -> features -> eda -> hotspot -> models -> forecast -> risk, the same
step order and artifacts as the re-implemented batch job, expressed with the
library's operators. Used by ``bench.py`` for a like-for-like wall time.
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from citypulse.operators import cleaning, describe, explain, models, panels, risk, spatial
from citypulse.sources import files, fixtures


def _sink(df):
    df.write.format("noop").mode("overwrite").save()


def run_steps(spark: SparkSession, sf_dir: str, out: str, boost_rounds: int = 20) -> dict:
    t, marks = time.perf_counter(), {}

    def mark(name):
        nonlocal t
        now = time.perf_counter()
        marks[name] = round(now - t, 3)
        t = now

    # preprocess: raw -> clean parquet
    clean = cleaning.clean_incidents(fixtures.raw_incidents(spark, sf_dir))
    files.write_parquet_artifacts(clean, f"{out}/clean", sort_within=["date_occurred", "dr_no"])
    clean = files.scan_parquet(spark, f"{out}/clean")
    mark("preprocess")
    # features: incident features, daily and weekly panels
    feats = cleaning.build_incident_features(clean, keep=("dr_no",))
    files.write_parquet_artifacts(feats, f"{out}/incident_features")
    daily = panels.daily_area_panel(clean)
    files.write_parquet_artifacts(daily, f"{out}/daily")
    daily = files.scan_parquet(spark, f"{out}/daily")
    weekly = panels.weekly_area_panel(daily)
    files.write_parquet_artifacts(weekly, f"{out}/weekly")
    mark("features")
    # eda: overview + descriptive aggregates
    for df in (describe.dataset_overview(clean), panels.resample_two_series(clean, "ME"),
               describe.hour_dow_matrix(clean), describe.top_k_categories(clean, "area_name"),
               describe.top_k_categories(clean, "crime_desc"), describe.victim_age_histogram(clean),
               describe.victim_sex_counts(clean), describe.arrest_rate_by_crime(clean),
               describe.share_by_area(clean)):
        _sink(df)
    mark("eda")
    # hotspot: grid top 500, DBSCAN on a 60 000-point sample, cluster summary, heat points
    grid = describe.grid_hotspots(clean).orderBy(F.col("crimes").desc()).limit(500)
    files.write_parquet_artifacts(grid, f"{out}/grid_top500")
    db = spatial.dbscan_hotspots(clean, eps_km=0.4, min_samples=80, sample_size=60_000)
    files.write_parquet_artifacts(spatial.cluster_summary(db), f"{out}/clusters")
    _sink(spatial.heat_points(clean, cell_deg=0.0025))
    _sink(spatial.heat_points(clean, violent_only=True, cell_deg=0.0025))
    mark("hotspot")
    # models: two targets x (logreg, boosted trees), fitted on 200 000 train rows at most
    feats = files.scan_parquet(spark, f"{out}/incident_features")
    for target in ("is_violent", "is_arrest"):
        metrics, fitted, test = models.train_classifier(
            feats, target, ("logreg", "gbt"), sample=200_000, key="dr_no",
            params={"gbt": {"max_iter": boost_rounds}})
        best = metrics.orderBy(F.col("pr_auc").desc()).first()["model"]
        files.save_model(fitted[best].model, f"{out}/model_{target}")
        _sink(explain.attribution_summary(fitted["gbt"], test, "dr_no", sample=3000))
    mark("models")
    # forecast: daily model + next 7 days + weekly model
    daily_t = panels.trim_incomplete_tail(daily)
    model, codes, dm, preds = models.train_daily_forecaster(daily_t, max_iter=boost_rounds)
    files.write_parquet_artifacts(preds, f"{out}/forecast_predictions")
    nxt = models.forecast_next_period(daily_t, model, codes, horizon_days=7)
    files.write_parquet_artifacts(nxt, f"{out}/forecast_next7")
    wk = panels.trim_weekly_tail(files.scan_parquet(spark, f"{out}/weekly"), daily_t)
    _, _, wm, wpreds = models.train_weekly_forecaster(wk, max_iter=boost_rounds)
    files.write_parquet_artifacts(wpreds, f"{out}/forecast_weekly_predictions")
    files.write_metrics_json(dm.unionByName(wm, allowMissingColumns=True), f"{out}/forecast_metrics")
    mark("forecast")
    # risk
    r = risk.area_risk(daily_t, files.scan_parquet(spark, f"{out}/forecast_next7"))
    files.write_parquet_artifacts(r, f"{out}/area_risk")
    mark("risk")
    return marks
