"""The training-data pipeline over ``documents``.

STAGES in order; each is written as Parquet in the shared folder and reread as
the next one's documents. All but the last return the columns of the table
they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import decontaminate, language, near_dedup, pieces, toxicity
from tidepool.llm.common import read, written

#: Similarity, in percent, from which the near_dedup stage links two documents
#: (op7_near_dedup has its own limit).
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the filters are fitted on the rows
    that the stage gets."""
    return language.keep_known(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; fitted on the labelled ones among them."""
    return toxicity.keep_civil(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of those that are NEAR_PERCENT alike."""
    return near_dedup.keep_one(docs, percent=NEAR_PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no passage of the benchmark."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids, and whether these decode to the text."""
    done = pieces.with_pieces(docs)
    return done.withColumn("n_tokens", F.size("ids").cast("long")).withColumn(
        "round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))).drop("decoded")


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminated),
    ("pieces", encoded),
]

#: Not expressible in SQL; tests/llm compare it with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
