"""Incremental ingest of a listing table: new rows above the stored max id,
and backfill pages below the stored min id.

The reference pages a REST listing on the driver; here the listing is a
table and each mode is one filtered scan whose predicate on the id reaches
the parquet reader. Only the one-row cursor (min, max) comes to the driver.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.time import epoch_to_string
from tidepool.operators.backlog import id_cursor
from tidepool.session import path_exists
from tidepool.sources.tables import append_evolving


def with_start_text(df: DataFrame, start: str = "start_time", name: str = "td_start") -> DataFrame:
    """Add the epoch start time as ``yyyy-MM-dd HH:mm:ss`` text."""
    return df.withColumn(name, epoch_to_string(F.col(start)))


def read_cursor(spark: SparkSession, target: str, key: str, key_type: T.DataType | None = None) -> tuple:
    """(min, max) of the key in the target; (None, None) if it is missing or
    holds no rows. The scan has a schema of that one column, so no file's
    footer is read to find one and an empty folder is no error."""
    if not path_exists(spark, target):  # nothing ingested yet
        return None, None
    schema = T.StructType([T.StructField(key, key_type or T.LongType())])
    row = id_cursor(spark.read.schema(schema).parquet(target), key).first()
    return (row["min_id"], row["max_id"]) if row else (None, None)


def ingest_new(spark: SparkSession, source: DataFrame, target: str, key: str = "match_id",
               start: str = "start_time") -> DataFrame:
    """Append every source row with ``key`` above the target's max.

    The cursor is read before anything is written, so a run takes all new
    rows, not one page. Returns the appended rows (lazily)."""
    _, max_id = read_cursor(spark, target, key, source.schema[key].dataType)
    new = source if max_id is None else source.filter(F.col(key) > F.lit(max_id))
    new = with_start_text(new, start)
    append_evolving(new, target)
    return new


def ingest_backfill(spark: SparkSession, source: DataFrame, target: str, key: str = "match_id",
                    start: str = "start_time", rows: int | None = None) -> DataFrame:
    """Append every source row below the target's min id: one filtered scan,
    no sort. ``rows`` takes only so many of them, newest first (a trial run;
    the chosen rows meet in one task)."""
    min_id, _ = read_cursor(spark, target, key, source.schema[key].dataType)
    older = source if min_id is None else source.filter(F.col(key) < F.lit(min_id))
    if rows is not None:
        older = older.orderBy(F.col(key).desc()).limit(rows)
    page = with_start_text(older, start)
    append_evolving(page, target)
    return page


def ingest(spark: SparkSession, source: DataFrame, target: str, mode: Literal["new", "history"] = "new",
           **kwargs) -> DataFrame:
    """Mode switch: ``new`` pulls above the max id, ``history`` backfills."""
    if mode == "new":
        return ingest_new(spark, source, target, **kwargs)
    if mode == "history":
        return ingest_backfill(spark, source, target, **kwargs)
    raise ValueError(f"unknown ingest mode {mode!r}")
