"""Backlog of listed ids not processed yet, and the id cursor.

The reference finds the backlog with ``LEFT JOIN ... WHERE right IS NULL``
and ``DISTINCT``; Catalyst does not turn that into an anti join, so it is
written as ``left_anti`` here. Both sides are reduced to distinct keys
first (map-side-combined aggregates whose outputs are already hash
partitioned on the key, so a shuffle join adds no exchange of its own). Whether the
small side is broadcast is left to AQE's runtime size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def backlog(listing: DataFrame, done: DataFrame, key: str = "match_id", done_key: str | None = None) -> DataFrame:
    """Distinct ``key`` values of ``listing`` absent from ``done``.

    NULL keys are never "done" (NULL does not join) and come out once,
    like the SQL form."""
    done_key = done_key or key
    processed = done.select(F.col(done_key).alias(key)).distinct()
    # both sides deduplicated before the join (map-side partial aggregates);
    # with a shuffle join the join reuses their key partitioning
    return listing.select(key).distinct().join(processed, on=key, how="left_anti")


def backlog_batch(backlog_ids: DataFrame, n: int | None = None, key: str = "match_id") -> DataFrame:
    """The ids to process next: the whole backlog, or with ``n`` the lowest
    ``n`` of it (a top-k for trial runs: each task keeps its own ``n`` best)."""
    if n is None:
        return backlog_ids.select(key)
    return backlog_ids.orderBy(F.col(key).asc_nulls_last()).limit(n)


def id_cursor(df: DataFrame, key: str = "match_id") -> DataFrame:
    """``MIN`` and ``MAX`` of the key in one scan (the reference runs two)."""
    return df.agg(F.min(key).alias("min_id"), F.max(key).alias("max_id"))


def id_cursor_from_files(spark: SparkSession, path: str, key: str = "match_id") -> DataFrame:
    """:func:`id_cursor` of a parquet table from the statistics in its files'
    footers: the aggregate is pushed into the scan, which then reads no rows.

    The pushdown is one of the V2 file source and a session setting that counts
    when the plan is made, so the plan is made here, under these settings."""
    settings = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = id_cursor(spark.read.parquet(path), key)
        out._jdf.queryExecution().executedPlan()
        return out
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
