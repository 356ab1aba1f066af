"""Catalog entries for sources and sinks.

Written tables go under the shared checkpoint folder named by the session
(``spark.checkpoint.dir``), never a machine-local temp folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from citypulse import contract as C
from citypulse.plans import common
from citypulse.plans.catalog import register, rounded
from citypulse.plans.oracle_sql import BASE, RAW, with_ctes
from citypulse.session import scratch_path
from citypulse.sources import files, fixtures

RAW_ROUNDED = 'SELECT * REPLACE (round("LAT", 6) AS "LAT", round("LON", 6) AS "LON") FROM raw'


def _csv_copy(spark, sf):
    path = scratch_path(spark, "raw-csv")
    (fixtures.raw_incidents(spark, sf).write.mode("overwrite")
     .option("header", True).option("quote", '"').option("escape", '"').csv(path))
    return path


@register("scan_incidents_csv", with_ctes(RAW, body=RAW_ROUNDED))
def q_scan_incidents_csv(spark, sf):
    return rounded(files.scan_incidents_csv(spark, _csv_copy(spark, sf)))


@register("scan_incidents_rejects", with_ctes(RAW, body="""
SELECT "column", CAST(count(*) AS BIGINT) AS rejected FROM (
  SELECT 'TIME OCC' AS "column" FROM raw WHERE "DR_NO" % 101 = 0 UNION ALL
  SELECT 'Vict Age' FROM raw WHERE "DR_NO" % 103 = 0 UNION ALL
  SELECT 'LAT' FROM raw WHERE "DR_NO" % 107 = 0 UNION ALL
  SELECT 'AREA' FROM raw WHERE "DR_NO" % 109 = 0) GROUP BY 1"""))
def q_scan_incidents_rejects(spark, sf):
    """Values of a CSV copy that are no numbers of their column, by column."""
    path = scratch_path(spark, "raw-csv-bad")
    (fixtures.bad_numbers(fixtures.raw_incidents(spark, sf)).write.mode("overwrite")
     .option("header", True).option("quote", '"').option("escape", '"').csv(path))
    return files.rejected_counts(files.scan_incidents_checked(spark, path))


@register("read_through_parquet", with_ctes(RAW, body=RAW_ROUNDED))
def q_read_through_parquet(spark, sf):
    csv = _csv_copy(spark, sf)
    cache = scratch_path(spark, "raw-cache")
    files.read_through_parquet(spark, csv, cache)          # builds the cache
    return rounded(files.read_through_parquet(spark, csv, cache))  # reuses it


@register("scan_parquet", with_ctes(
    "x AS (SELECT 1)", body="SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem "
    "WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_returnflag = 'R'"))
def q_scan_parquet(spark, sf):
    """Column pruning + pushed filters reach the Parquet reader."""
    li = files.scan_parquet(spark, f"{sf.rstrip('/')}/lineitem.parquet")
    return (li.where((F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
                     & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_linenumber", "l_shipdate"))


@register("write_parquet_artifacts", with_ctes(
    *BASE, body="SELECT year, count(*) AS rows FROM clean GROUP BY year"))
def q_write_parquet_artifacts(spark, sf):
    path = scratch_path(spark, "clean")
    files.write_parquet_artifacts(common.clean_fresh(spark, sf), path, partition_by=["year"],
                                  sort_within=["date_occurred", "dr_no"])
    back = files.scan_parquet(spark, path)
    return back.groupBy("year").agg(F.count(F.lit(1)).alias("rows"))


@register("metrics_json", with_ctes(
    *BASE, body="SELECT count(*) AS rows, round(avg(report_lag_days), 6) AS mean_lag, "
    "round(avg(is_violent), 6) AS violent_share FROM clean"))
def q_metrics_json(spark, sf):
    m = common.clean(spark, sf, "report_lag_days", "is_violent").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("report_lag_days").alias("mean_lag"),
        F.avg("is_violent").alias("violent_share"))
    path = scratch_path(spark, "metrics")
    files.write_metrics_json(m, path)
    return rounded(files.read_metrics_json(spark, path, "rows BIGINT, mean_lag DOUBLE, violent_share DOUBLE"))


@register("model_store")
def q_model_store(spark, sf):
    """Fit a classifier, save it, load it by its path alone, score the feature rows with
    both: every row, with the difference of the two scores (0)."""
    from citypulse.operators import cleaning, models
    feats = cleaning.build_incident_features(common.clean(spark, sf, "dr_no", *C.INCIDENT_FEATURE_COLUMNS), keep=("dr_no",))
    fitted = models.train_logreg(feats, "is_violent", max_iter=20)
    path = scratch_path(spark, "model")
    files.save_model(fitted.model, path)
    own = fitted.transform(feats).withColumnRenamed("prob", "own").select(*feats.columns, "own")
    both = models.with_prob(files.load_model(path).transform(own))
    return both.select("dr_no", "prob", F.abs(F.col("prob") - F.col("own")).alias("difference"))


