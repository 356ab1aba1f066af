"""Shared upstream stages for catalog queries (fixture -> clean -> panels).

Like the batch job it re-implements, the clean incident table and the daily
panel are materialised once as Parquet artifacts (per session and input
folder, under the shared checkpoint folder) and read by the queries that
consume them. A query that names the columns it reads gets an artifact of
those alone, so that the joins behind it carry and the artifact holds nothing
else. Each query still runs its own operator from those inputs; the
operators that build the artifacts (``clean_incidents``, ``daily_area_panel``)
are always run from their raw inputs.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from citypulse.operators import cleaning, panels
from citypulse.session import scratch_path
from citypulse.sources import fixtures

_ARTIFACTS: dict = {}
BUILD_SECONDS: dict = {}


def _artifact(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), name)
    if key not in _ARTIFACTS:
        t0 = time.perf_counter()
        path = scratch_path(spark, f"artifact-{name[:60]}")
        build().write.mode("overwrite").parquet(path)
        _ARTIFACTS[key] = path
        BUILD_SECONDS[f"{name}@{key[1]}"] = round(time.perf_counter() - t0, 3)
    return spark.read.parquet(_ARTIFACTS[key])


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.raw_incidents(spark, sf)


def renamed_fresh(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.parse_timestamps(cleaning.rename_columns(raw(spark, sf)))


def _columns(spark: SparkSession, sf: str, name: str, build, cols) -> DataFrame:
    """The artifact ``name`` with the columns ``cols`` (none: all of them)."""
    if not cols:
        return _artifact(spark, sf, name, lambda: build(spark, sf))
    return _artifact(spark, sf, "-".join([name, *cols]), lambda: build(spark, sf).select(*cols))


def renamed(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Renamed + parsed raw table (input of the single-step cleaning queries)."""
    return _columns(spark, sf, "renamed", renamed_fresh, cols)


def clean_fresh(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_incidents(raw(spark, sf))


def clean(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    return _columns(spark, sf, "clean", clean_fresh, cols)


def panel_input(spark: SparkSession, sf: str) -> DataFrame:
    """What the panels are counted from."""
    return clean(spark, sf, "dr_no", "date_occurred", "area_id", "area_name", "is_violent", "is_arrest")


def daily_fresh(spark: SparkSession, sf: str) -> DataFrame:
    return panels.daily_area_panel(panel_input(spark, sf))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return _artifact(spark, sf, "daily", lambda: daily_fresh(spark, sf))


def daily_thin(spark: SparkSession, sf: str) -> DataFrame:
    return _artifact(spark, sf, "daily_thin",
                     lambda: panels.daily_area_panel(fixtures.thin_tail(panel_input(spark, sf))))


def weekly(spark: SparkSession, sf: str) -> DataFrame:
    return panels.weekly_area_panel(daily(spark, sf))
