"""Training-corpus pipeline: five corpus operators applied to ``documents`` one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and reads it back as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citypulse.llm import decontam, mixing, rule_ensemble, simhash, suffix_dedup
from citypulse.llm.common import saved, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return rule_ensemble.classify(docs, table(spark, sf_dir, "labels")).where("predicted = 1").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one of smallest id (a null id only if there is
    no other; of texts with one id, the one of smallest text hash). Of repeated rows one stays."""
    mark = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()).alias("h"))
    classes = simhash.simhash_classes(docs.select(mark.alias("__mark"), "text"), "__mark", "text", shingle=3, max_bits=2)
    first = classes.select(F.col("component_id.doc_id").alias("__id"), F.col("component_id.h").alias("__h")).distinct()
    rows = docs.withColumn("__h", mark["h"])
    # rows with one id and text are equal up to other columns: the first of them in their order stays
    copies = Window.partitionBy("doc_id", "__h").orderBy(*[c for c in docs.columns if c not in ("doc_id", "text")])
    single = rows.withColumn("__n", F.row_number().over(copies)).where("__n = 1")
    return single.join(first, single["doc_id"].eqNullSafe(first["__id"]) & (single["__h"] == first["__h"]),
                       "left_semi").select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that occur more than once; a null text stays null."""
    cut = suffix_dedup.remove_repeats(docs, "doc_id", "text")
    new = {"text": F.when(F.col("text").isNotNull(), F.col("kept_text")),
           "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("n_chars")).cast("long")}
    return cut.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("NOT contaminated").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn to the target weights, once for each epoch they are drawn in."""
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_copies),
    ("suffix_array_dedup", repeats),
    ("benchmark_decontamination", benchmark_free),
    ("source_mixing", mixture),
]

#: No SQL: the classifier, the random walks and the byte-wise cuts have none; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
