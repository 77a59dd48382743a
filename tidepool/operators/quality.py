"""Data quality checks over any table, keyed by column names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_size(
    df: DataFrame, key: str, expected: int, not_null: Sequence[str] = (), count_name: str = "n_rows"
) -> DataFrame:
    """Keys whose number of rows (with every ``not_null`` column set)
    differs from ``expected``: ``GROUP BY key HAVING COUNT(*) != n``.
    The count merges map-side, so a hot key costs one row per task."""
    cond = F.lit(True)
    for c in not_null:
        cond = cond & F.col(c).isNotNull()
    counted = df.filter(cond).groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    return counted.filter(F.col(count_name) != F.lit(expected))


def uniqueness(df: DataFrame, *key: str) -> DataFrame:
    """One row: ``COUNT(*)`` and ``COUNT(DISTINCT key)`` (of one column or
    several; a key with a NULL column is not counted).

    Written as two aggregations: per key (partial counts merge map-side,
    NULL keys kept as a group), then a global sum -- the plan Spark would
    build for the DISTINCT, without the Expand."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count_if(reduce(and_, [F.col(k).isNotNull() for k in key])).alias("n_distinct_keys"),
    )
