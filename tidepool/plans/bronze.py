"""Bronze jobs: the backlog of ids to fetch, the full load of raw JSON
documents into a catalog table, the flat player table exploded from it, and
the checks on both."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.backlog import backlog, backlog_batch
from tidepool.operators.nested import explode_players
from tidepool.operators.quality import group_size, uniqueness
from tidepool.session import path_exists
from tidepool.sources.json_docs import read_json_docs
from tidepool.sources.tables import full_load_once, read_ledger, replace_table


def load_bronze(spark: SparkSession, raw_dir: str, schema: T.StructType, database: str, table: str,
                location: str | None = None, key: str = "match_id") -> bool:
    """First load only: scan the raw documents under the fixed schema, keep
    those with a key, write ``database.table``. A no-op when it exists."""
    return full_load_once(spark, lambda: read_json_docs(spark, raw_dir, schema, key), database, table, location)


def load_bronze_checked(spark: SparkSession, raw_dir: str, schema: T.StructType, database: str, table: str,
                        location: str | None = None, key: str = "match_id") -> DataFrame:
    """:func:`load_bronze` and the check of what it loaded (:func:`check_details`):
    the rows are counted in the write itself, distinct keys over the stored key
    columns only. On a table that exists nothing is loaded and both come from it."""
    seen = Observation()
    counted = lambda: read_json_docs(spark, raw_dir, schema, key).observe(seen, F.count(F.lit(1)).alias("n_rows"))
    loaded = full_load_once(spark, counted, database, table, location)
    stored = spark.table(f"`{database}`.`{table}`")
    if not loaded:
        return check_details(stored)
    keys = [c for c in (key, "part") if c in stored.columns]
    distinct = stored.select(*keys).dropna().distinct().agg(F.count(F.lit(1)).alias("n_distinct_keys"))
    return distinct.select(F.lit(int(seen.get["n_rows"])).cast("bigint").alias("n_rows"), "n_distinct_keys")


def build_players(spark: SparkSession, database: str, details: str, players: str,
                  array: str = "players", start: str = "start_time", ts_col: str | None = None,
                  day_col: str | None = None, period: str = "day") -> DataFrame:
    """Drop and recreate the player table: one row per array element,
    ``player.*`` plus the start time as text. The explode needs no shuffle.

    ``ts_col`` adds the start as a TIMESTAMP (window filters on it push down
    to the scan); ``day_col`` adds its DATE and partitions the table by it,
    so a 6-month window reads 6 months of folders out of the whole history
    (``period="month"`` partitions by the month's first day instead: fewer,
    larger folders).
    Without them the table has the reference's columns."""
    flat = explode_players(spark.table(f"`{database}`.`{details}`"), array=array, start=start, ts_col=ts_col)
    if day_col:
        day = F.to_date(F.timestamp_seconds(F.col(start)))
        flat = flat.withColumn(day_col, F.trunc(day, "month") if period == "month" else day)
    return replace_table(flat, database, players, partition_by=[day_col] if day_col else None)


# Players per match expected by the group-size check.
PLAYERS_PER_MATCH = 10


def check_players(players: DataFrame, expected: int = PLAYERS_PER_MATCH) -> DataFrame:
    """Matches whose number of players with an account and a slot is not
    ``expected`` (empty when the table is clean)."""
    return group_size(players, "match_id", expected, not_null=["account_id", "player_slot"])


def check_details(details: DataFrame) -> DataFrame:
    """One row: documents vs distinct document keys -- match id, and part
    where matches may come in parts (equal when no duplicates)."""
    return uniqueness(details, *[c for c in ("match_id", "part") if c in details.columns])


def pending_matches(spark: SparkSession, history_path: str, ledger_path: str, key: str = "match_id",
                    n: int | None = None, key_type: T.DataType | None = None) -> DataFrame:
    """Listed ids not in the processed-id ledger; with ``n`` the lowest ``n``
    of them (the next batch to fetch). A missing ledger means nothing is
    processed yet."""
    # a schema of the one column: no file's footer is read to find it
    history = spark.read.schema(T.StructType([T.StructField(key, key_type or T.LongType())])).parquet(history_path)
    if path_exists(spark, ledger_path):
        done = read_ledger(spark, ledger_path, key)
    else:
        done = history.select(key).limit(0)
    ids = backlog(history, done, key)
    return ids if n is None else backlog_batch(ids, n, key)
