"""Registry of named queries: ``name -> (spark_fn(spark, sf_dir), oracle_sql | None)``.

Each query reads the driver tables through a fixture adapter and runs one
operator (plus whatever the operator needs upstream). Double columns are
rounded to 6 places on the way out so the Spark result and the DuckDB oracle
can be compared by value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for name, typ in df.dtypes:
        if typ in ("double", "float"):
            cols.append(F.round(F.col(name).cast("double"), digits).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def load_all() -> None:
    """Import the query modules so their ``register`` calls run."""
    import importlib
    for mod in ("q_sources", "q_cleaning", "q_panels", "q_describe", "q_windows", "q_spatial", "q_models"):
        importlib.import_module(f"citypulse.plans.{mod}")
