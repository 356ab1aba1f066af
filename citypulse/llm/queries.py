"""The registered queries: thin wrappers that apply each operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citypulse.llm import alignment, decontam, html_extract, language_crf, line_rules, lm_score, minhash, mixing, rule_ensemble, simhash, spelling, suffix_dedup, warc_fixity
from citypulse.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.query(table(spark, sf_dir, "pages"))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(table(spark, sf_dir, "documents"), "doc_id", "text", shingle=3, max_bits=2)


@query
def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.query(table(spark, sf_dir, "documents"))


ORACLES["op4_line_rules"] = line_rules.ORACLE_SQL


@query
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.query(table(spark, sf_dir, "documents"))


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.query(table(spark, sf_dir, "documents"))


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(table(spark, sf_dir, "documents"))


ORACLES["op6_mix_sources"] = mixing.ORACLE_SQL


@query
def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_fixity.query(table(spark, sf_dir, "pages"))


ORACLES["op9_warc_fixity"] = warc_fixity.ORACLE_SQL


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.query(table(spark, sf_dir, "documents"))


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_classes(table(spark, sf_dir, "documents"), "doc_id", "text", shingle=2)


ORACLES["op13_minhash"] = minhash.ORACLE_SQL
