"""File sources and sinks (CSV, Parquet, JSON metrics, ML model store)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse import contract as C


def raw_schema_ddl() -> str:
    return ", ".join(f"`{name}` {typ}" for name, typ in C.RAW_TYPES.items())


def scan_incidents_csv(spark: SparkSession, path: str, nrows: int | None = None) -> DataFrame:
    """Typed CSV scan of the raw incident file.

    The schema is declared (no inference pass). Quoted fields may hold commas;
    malformed numbers become null instead of failing the job. Dates stay as
    text here and are parsed by :func:`citypulse.operators.cleaning.parse_timestamps`.
    ``nrows`` keeps the first n rows of the file (a LIMIT, used for quick runs).
    """
    df = (spark.read.schema(raw_schema_ddl())
          .option("header", True).option("quote", '"').option("escape", '"')
          .option("multiLine", False).option("mode", "PERMISSIVE")
          .csv(path))
    if nrows is not None:
        df = df.limit(int(nrows))
    return df


def scan_incidents_checked(spark: SparkSession, path: str) -> DataFrame:
    """The typed scan with a channel for what it could not type: ``rejected``, an array of
    (column, value) of texts that are no number of their column, or of the whole line
    (column ``line``) when it has too few or too many fields. One pass over the text."""
    texts = ", ".join(f"`{name}` string" for name in C.RAW_TYPES)
    # fields are only counted when all of them are parsed
    raw = (spark.read.schema(f"{texts}, `{BAD_LINE}` string").option("columnNameOfCorruptRecord", BAD_LINE).option("columnPruning", False)
           .option("header", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    typed, failed = [], [F.struct(F.lit("line").alias("column"), F.col(BAD_LINE).alias("value"))]
    for name, kind in C.RAW_TYPES.items():
        text = F.col(f"`{name}`")
        value = text if kind == "string" else F.when(F.trim(text).rlike(NUMBERS[kind]), F.trim(text).try_cast(kind))
        typed.append(value.alias(name))
        if kind != "string":
            failed.append(F.struct(F.lit(name).alias("column"), F.when(value.isNull(), text).alias("value")))
    rejected = F.filter(F.array(*failed), lambda x: x["value"].isNotNull())
    return raw.select(*typed, rejected.alias("rejected"))


#: Holds a line whose number of fields is wrong.
BAD_LINE = "__bad_line"
#: What counts as a number of a type (a cast alone would also take "12.7" for an integer).
NUMBERS = {"int": r"^[+-]?[0-9]+$", "bigint": r"^[+-]?[0-9]+$", "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"}


def rejected_records(checked: DataFrame, key: str = "DR_NO") -> DataFrame:
    """(key, column, value): one row a rejected field or line."""
    return checked.select(F.col(key), F.explode("rejected").alias("r")).select(key, "r.column", "r.value")


def rejected_counts(checked: DataFrame) -> DataFrame:
    """(column, rejected): how many values of each column (or whole lines) were rejected."""
    return checked.select(F.explode("rejected").alias("r")).groupBy("r.column").agg(F.count(F.lit(1)).alias("rejected"))


def _source_state(spark: SparkSession, path: str) -> dict:
    """Number, size and a digest of (path, size, time) of a source's files; their content is not read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    digest = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).cast("string")
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), digest.alias("digest")).first().asDict()


def _manifest(spark: SparkSession, cache_path: str) -> dict | None:
    try:
        rows = spark.read.schema("files long, bytes long, digest string, schema string, complete boolean").json(f"{cache_path}/manifest").collect()
    except AnalysisException:
        return None
    return rows[0].asDict() if len(rows) == 1 else None


def read_through_parquet(spark: SparkSession, csv_path: str, cache_path: str,
                         nrows: int | None = None, use_cache: bool = True) -> DataFrame:
    """Reuse a Parquet copy of the CSV when it is one of this very source, else build it.

    ``cache_path`` holds the copy (``data``) and a manifest of the source's files (paths,
    sizes, times) and the declared schema. A rebuild first marks the manifest incomplete
    and commits it last, so a changed source is read anew and a half-written copy is never
    used. A row-limited read never touches the cache.
    """
    if nrows is not None or not use_cache:
        return scan_incidents_csv(spark, csv_path, nrows)
    wanted = _source_state(spark, csv_path) | {"schema": raw_schema_ddl(), "complete": True}
    if _manifest(spark, cache_path) != wanted:
        def commit(state):
            row = spark.createDataFrame([tuple(state.values())], "files long, bytes long, digest string, schema string, complete boolean")
            row.coalesce(1).write.mode("overwrite").json(f"{cache_path}/manifest")
        commit(wanted | {"complete": False})
        scan_incidents_csv(spark, csv_path).write.mode("overwrite").parquet(f"{cache_path}/data")
        commit(wanted)
    return spark.read.parquet(f"{cache_path}/data")


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over at least ``min_partitions`` tasks (default: the
    cluster's default parallelism).

    A file with a single row group is one input split, so a CPU-heavy plan
    over it (parsing, joins with broadcast dimensions) would run in one task.
    Large inputs already have many splits and pass through untouched; the
    check reads only the planned partition count (no job).
    """
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; a missing path is an explicit error."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"parquet not found: {path}") from exc
    return df.select(*columns) if columns else df


def write_parquet_artifacts(df: DataFrame, path: str, partition_by: list[str] | None = None,
                            sort_within: list[str] | None = None, mode: str = "overwrite") -> str:
    """Write an artifact table. Ordering is applied per partition only (no global sort).

    Rows to be ordered are dealt to tasks of bounded size first (a rebalance: large partitions are
    split), so that no task sorts a whole input split. They are ordered by the folders' columns
    first, which is the order that the writer asks for: with another one it would sort again."""
    out = df
    if sort_within:
        out = df.hint("rebalance", *(partition_by or sort_within)).sortWithinPartitions(*(partition_by or ()), *sort_within)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_metrics_json(metrics: DataFrame, path: str) -> str:
    """Metric tables are a handful of rows: written as one JSON file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_metrics_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


def save_model(model, path: str) -> str:
    """Persist a fitted Spark ML model / PipelineModel (no pickle)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
