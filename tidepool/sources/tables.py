"""Batch tables: scan by path, evolving append, id ledger, catalog helpers.

Tables are parquet directories or catalog tables. Scans go through
``spark.read.parquet`` so column pruning and filter pushdown reach the files.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidepool.session import path_exists, read_text, write_text


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Scan a parquet table by path; ``merge_schema`` unions file schemas
    (columns added by later appends read as NULL in older files)."""
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(path)


def table_name(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(table_name(sf_dir, name))


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows whose columns may be a superset of the table's.

    Parquet keeps each file's own schema; readers pass ``merge_schema=True``
    and older rows read NULL in new columns. A column that comes with another
    type raises before anything is written: every later merged read would
    fail. The merged schema is kept beside the data (``_schema.json``), so
    the check reads no footers. The write is distributed; small files are the
    job of :func:`tidepool.sources.maintain.compact_table`.
    """
    spark, note = df.sparkSession, f"{path.rstrip('/')}/_schema.json"
    known: dict[str, T.StructField] = {}
    if path_exists(spark, note):
        known = {f.name: f for f in T.StructType.fromJson(json.loads(read_text(spark, note))).fields}
    elif path_exists(spark, path) and spark.read.schema("_none INT").parquet(path).inputFiles():
        known = {f.name: f for f in read_table(spark, path, merge_schema=True).schema.fields}
    for f in df.schema.fields:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise TypeError(f"column {f.name} is {known[f.name].dataType.simpleString()} in {path}, not {f.dataType.simpleString()}")
    df.write.mode("append").parquet(path)
    new = [f for f in df.schema.fields if f.name not in known]
    if new:
        write_text(spark, note, T.StructType([*known.values(), *new]).json())


def ledger_append(ids: DataFrame, path: str, key: str = "match_id") -> None:
    """Append processed ids to a one-column ledger, once per run (not once
    per id). Readers take ``DISTINCT``; appends never rewrite the ledger."""
    ids.select(key).write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str, key: str = "match_id") -> DataFrame:
    return spark.read.parquet(path).select(key).distinct()


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` with an optional location."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`{loc}")


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    """Catalog lookup; False (not an error) when the database is missing,
    and case-insensitive like the rest of the catalog."""
    if not spark.catalog.databaseExists(database):
        return False
    return spark.catalog.tableExists(f"`{database}`.`{table}`")


def _versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """Names of the tables that ``replace_table`` wrote for ``table``, oldest first."""
    mark = f"{table.lower()}__v"
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{database}`").collect()]
    return sorted(n for n in names if n.lower().startswith(mark))


def publish(spark: SparkSession, database: str, table: str, version: str, keep: int = 1) -> DataFrame:
    """Let the view ``table`` show the table ``version``, in one catalog step, and
    drop all but the ``keep`` versions before it (a reader that began on
    the last one can finish).

    A plain table of that name, as an earlier release left it, is renamed to be the
    oldest version first; that one time a reader can find none in between."""
    name = f"`{database}`.`{table}`"
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO `{database}`.`{table}__v{0:020d}_table`")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM `{database}`.`{version}`")
    older = [v for v in _versions(spark, database, table) if v.lower() < version.lower()]
    for old in older[: len(older) - keep if keep else None]:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{old}`")
    return spark.table(name)


def new_version(table: str) -> str:
    """A name for the next version of a table; names sort by time."""
    return f"{table}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


def replace_table(df: DataFrame, database: str, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """Recreate a catalog table from a query, optionally partitioned (e.g. by
    day, so dated queries prune whole folders).

    The query's rows are written as a new version beside the old one; only
    then the view that readers use is pointed at it. A query that fails, or a
    crash before that step, leaves the old rows readable, and a query may read the table that it
    replaces. Versions that never got published are dropped by the next run.

    A partitioned write is rebalanced on the partition columns first: a
    folder gets its rows from one task, or a few if it is large, instead of
    one small file from every task."""
    spark, version = df.sparkSession, new_version(table)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"`{database}`.`{version}`")
    return publish(spark, database, table, version)


def full_load_once(
    spark: SparkSession, df_factory, database: str, table: str, location: str | None = None
) -> bool:
    """Create ``database.table`` from ``df_factory()`` unless it already
    exists. Returns True when the load ran; the factory is not evaluated on
    the no-op path."""
    create_database(spark, database, location)
    if table_exists(spark, database, table):
        return False
    df_factory().write.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{table}`")
    return True


def register_views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Temporary views over tables by path, for queries written as SQL."""
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(name)


def rows_frame(spark: SparkSession, rows: list[dict], schema) -> DataFrame:
    """Small driver-side records (an API page, a test case) as a DataFrame
    under an explicit schema (``StructType`` or DDL text): inference would
    fail on int/float mixes and on keys that are NULL in every record.
    Integers in floating-point fields are widened, missing keys read as
    NULL, unknown keys are dropped. For bulk data read files instead."""
    struct = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
    floating = {f.name for f in struct.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def value(r: dict, name: str):
        v = r.get(name)
        return float(v) if name in floating and isinstance(v, int) and not isinstance(v, bool) else v

    return spark.createDataFrame([tuple(value(r, f.name) for f in struct.fields) for r in rows], struct)
