"""Ever-growing keyed tables in Spark's storage buckets.

A ledger of processed ids, or a table that batches are merged into, only grows;
joining it with a new batch should not shuffle it again each time. The tables
here are catalog tables bucketed by their key (``bucketBy``), so a join or a
distinct on the key reads each bucket where it lies and only the batch is
shuffled, into the table's own number of buckets. That number is chosen from
the bytes of the first write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.backlog import backlog
from tidepool.operators.upsert import buckets_for, latest_per_key
from tidepool.sources.tables import new_version, publish, table_exists

def bucket_count(spark: SparkSession, name: str) -> int:
    """The number of buckets of a catalog table (looked up through its view)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    found = [r["data_type"] for r in rows if r["col_name"] == "Num Buckets"]
    if not found:
        raise ValueError(f"{name} is not bucketed")
    return int(found[0])


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, mode: str = "error") -> None:
    """Write rows into buckets of ``key``: one file of a bucket for each write,
    instead of one from every task."""
    df.repartition(buckets, F.col(key)).write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def append_bucketed(df: DataFrame, database: str, table: str, key: str, expected_bytes: int = 0) -> None:
    """Append to a bucketed table (a ledger, a listing), creating it at first
    with buckets for ``expected_bytes``."""
    spark, name = df.sparkSession, f"`{database}`.`{table}`"
    if table_exists(spark, database, table):
        write_bucketed(df.select(*spark.table(name).columns), name, key, bucket_count(spark, name), mode="append")
    else:
        write_bucketed(df, name, key, buckets_for(expected_bytes))


def pending_ids(spark: SparkSession, database: str, listing: str, ledger: str, key: str = "match_id") -> DataFrame:
    """Listed ids that the ledger does not hold, both bucketed by the id: neither
    table is shuffled, and the processed ones are never sent to all tasks."""
    done = spark.table(f"`{database}`.`{ledger}`").hint("merge")
    return backlog(spark.table(f"`{database}`.`{listing}`"), done, key)


def merge_bucketed(batch: DataFrame, database: str, table: str, key: str, order_col: str | None = None, expected_bytes: int = 0) -> DataFrame:
    """Upsert a batch into a bucketed table and publish the result (readers see
    the old rows until then). The table's rows stay in their buckets; the batch is
    dealt into these and replaces or adds its keys. The first batch creates the
    table."""
    spark, name, version = batch.sparkSession, f"`{database}`.`{table}`", new_version(table)
    if not table_exists(spark, database, table):
        write_bucketed(latest_per_key(batch, key, order_col), f"`{database}`.`{version}`", key, buckets_for(expected_bytes))
        return publish(spark, database, table, version)
    buckets = bucket_count(spark, _shown(spark, database, table))
    merged = merged_rows(batch, database, table, key, order_col, buckets)
    # every task already holds rows of one bucket: no shuffle before the write
    merged.write.format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(f"`{database}`.`{version}`")
    return publish(spark, database, table, version)


def merged_rows(batch: DataFrame, database: str, table: str, key: str, order_col: str | None, buckets: int) -> DataFrame:
    """The table's rows after the batch; the old ones come straight from their
    buckets, the batch's are dealt into the same number. NULL keys match nothing."""
    old = batch.sparkSession.table(_shown(batch.sparkSession, database, table))
    new = latest_per_key(batch, key, order_col)
    # dealt out last: any other partitioning would make the join shuffle the table
    keys = new.select(key).where(F.col(key).isNotNull()).repartition(buckets, F.col(key))
    kept = old.hint("merge").join(keys, key, "left_anti")
    return kept.unionByName(new.repartition(buckets, F.col(key)), allowMissingColumns=True)


def _shown(spark: SparkSession, database: str, table: str) -> str:
    """The table that the view ``table`` shows."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{table}`").collect()
    text = next((r["data_type"] for r in rows if r["col_name"] == "View Text"), None)
    return text.split(" FROM ")[1] if text else f"`{database}`.`{table}`"
