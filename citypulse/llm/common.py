"""Helpers shared by the corpus operators: tables, shared scratch tables, folds, words.

A *word* is ``[^\\x20\\x09-\\x0D]+``. ``bytes.split()`` cuts at exactly these
six bytes and ``bytes.lower()`` lower-cases exactly A-Z, so the Python side
works on UTF-8 bytes; the JVM side uses :data:`WORD_REGEX`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse.session import ensure_checkpoint_dir

#: Java regular expressions for one word and one run of white space between words.
WORD_REGEX = r"[^\x20\x09-\x0D]+"
SPACE_REGEX = r"[\x20\x09-\x0D]+"


#: Drops a query's shuffle files as soon as its result is written.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of what is written inside go as soon as it is written."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts
    the lineage, survives lost executors and keeps column pruning and statistics.
    The shuffle files behind it go when it is written."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id's text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def lower_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []


def pieces(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of some ``limit`` bytes (or one longer row):
    bounds what a task holds as Python objects at a time."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
