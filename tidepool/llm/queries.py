"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame.

Each one applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import decontaminate, html_text, language, licenses, near_dedup, oracle, periods, pieces, pii, quality, repair, sharding, token_counts, toxicity
from tidepool.llm.common import read


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_report(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item whose passage it repeats."""
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read(spark, sf_dir, "documents"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every text, and whether they decode to the whole text."""
    return pieces.piece_report(read(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.dedup_report(read(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(read(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(read(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_plan(read(spark, sf_dir, "documents"), shards=40)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest edits of every conversation, after the given damage."""
    return repair.repair_report(read(spark, sf_dir, "conversations"))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words, after runs were planted in one document of ten."""
    return periods.period_report(read(spark, sf_dir, "documents"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_pieces": op6_pieces,
    "op7_near_dedup": op7_near_dedup,
    "op8_html_text": op8_html_text,
    "op9_language": op9_language,
    "op10_sharding": op10_sharding,
    "op11_repair": op11_repair,
    "op12_periods": op12_periods,
    "op13_pii": op13_pii,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = oracle.all_sql()
