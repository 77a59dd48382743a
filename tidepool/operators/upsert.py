"""Keyed upsert (MERGE: matched -> update all columns, else insert all)
without a MERGE-capable table format.

``upsert(old, new, key)`` is the relational form:
``old LEFT ANTI JOIN keys(new) UNION BY NAME new``. The anti join probes
only the batch's distinct keys; AQE broadcasts them when their runtime size
is under the threshold and falls back to a shuffle join otherwise.

``SnapshotStore`` applies upserts to a parquet table in hash buckets of the
key: a batch rewrites only the buckets that its keys fall into, and shuffles its
own rows only, until the buckets have gathered many files. It is a thin
folder layout, not a table format: no concurrent writers, no time travel.
"""

from __future__ import annotations

import json
import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import read_text, write_text


DUPLICATE = "batch holds several rows for one"

#: Bytes that a bucket should hold once the table has grown to the expected size.
BUCKET_BYTES = 256 * 1024 * 1024
#: Fewest buckets of a snapshot store.
LEAST_BUCKETS = 16
#: Files that a bucket may have on average before a batch gathers its rows again.
FILES_PER_BUCKET = 8
#: Bytes of a batch's keys that are broadcast at once, those of a row beside its key, and most such turns.
KEYS_BYTES = 64 * 1024 * 1024
KEY_ROW_BYTES = 32
MOST_TURNS = 64


def buckets_for(expected_bytes: int, least: int = 1) -> int:
    """Buckets for a table of that size; a power of two, so that tables of
    other sizes have a number that divides it or is a multiple."""
    n = max(least, 1)
    while n * BUCKET_BYTES < expected_bytes:
        n *= 2
    return n


def turns(sizes: dict[int, int], most: int) -> list[set[int]] | None:
    """The buckets in groups of at most ``most`` bytes; None if that takes more
    than MOST_TURNS groups, or if one bucket alone has more."""
    groups: list[set[int]] = []
    held = most
    for b, n in sorted(sizes.items()):
        if n > most:
            return None
        if not groups or held + n > most:
            groups.append(set())
            held = 0
        groups[-1].add(b)
        held += n
    return groups if len(groups) <= MOST_TURNS else None


class DuplicateKeyError(ValueError):
    pass


def latest_per_key(new: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """One row per non-NULL key; NULL-key rows are all kept (MERGE never
    matches NULL, so each is an insert).

    With ``order_col`` the row with the greatest order value wins (ties go
    to the greater row hash, so the pick is deterministic); the ``max_by``
    merges map-side. Without it duplicates raise, like a
    MERGE whose source has two rows for one target row."""
    keyed = new.filter(F.col(key).isNotNull())
    nulls = new.filter(F.col(key).isNull())
    others = [c for c in new.columns if c != key]
    if order_col is None:
        row = F.struct(*[F.col(c) for c in others]) if others else F.lit(0)
        one = keyed.groupBy(key).agg(F.first(row).alias("_row"), F.count(F.lit(1)).alias("_n"))
        ok = F.when(F.col("_n") == 1, F.col(key)).otherwise(
            F.raise_error(F.lit(f"{DUPLICATE} {key}; pass order_col")).cast(new.schema[key].dataType))
        one = one.select(ok.alias(key), *[F.col(f"_row.{c}").alias(c) for c in others]).select(*new.columns)
        return one.unionByName(nulls)
    # ties on the order value go to the greater row hash: deterministic on
    # retry, and no ordering is needed on the row itself (maps allowed)
    hashable = [F.col(f.name) for f in new.schema.fields
                if f.name != key and not isinstance(f.dataType, T.MapType)]
    rank = F.struct(F.col(order_col), F.xxhash64(*hashable) if hashable else F.lit(0))
    best = keyed.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in others]), rank).alias("_row"))
    best = best.select(F.col(key), *[F.col(f"_row.{c}").alias(c) for c in others]).select(*new.columns)
    return best.unionByName(nulls)


def upsert(old: DataFrame | None, new: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """The merged table: old rows whose key is not in ``new``, plus ``new``.
    Columns only in one side read NULL in the other (schema evolution)."""
    new = latest_per_key(new, key, order_col)
    if old is None:
        return new
    keys = new.select(key).filter(F.col(key).isNotNull()).distinct()
    kept = old.join(keys, on=key, how="left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


class SnapshotStore:
    """A keyed parquet table in hash buckets, one version per change.

    ``<path>/data/v=<version>/bucket=<n>/`` holds rows, ``<path>/commits/``
    one small JSON per version, written after its data: which version each
    bucket is read from, and the last batch applied of each streaming query.
    Readers take the newest commit, so data without one (a failed write) is
    never seen. A batch that its query has already applied is skipped, and a
    query with a new checkpoint builds on the newest version like any other.
    """

    _COMMIT = re.compile(r"^(\d+)\.json$")

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, expected_bytes: int = 0):
        """The first write fixes the number of buckets: ``buckets``, or as many
        as a table of ``expected_bytes`` takes (at least LEAST_BUCKETS)."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets or buckets_for(expected_bytes, LEAST_BUCKETS)

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hpath

    def _names(self, path: str) -> list[str]:
        fs, hpath = self._hadoop(path)
        return [st.getPath().getName() for st in fs.listStatus(hpath)] if fs.exists(hpath) else []

    def committed(self) -> list[int]:
        """Committed versions, ascending."""
        found = [self._COMMIT.match(n) for n in self._names(f"{self.path}/commits")]
        return sorted(int(m[1]) for m in found if m)

    def _commit(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/commits/{version:020d}.json"))

    def _newest(self) -> tuple[int, dict] | None:
        done = self.committed()
        if done:
            return done[-1], self._commit(done[-1])
        if self._names(f"{self.path}/data"):
            raise RuntimeError(f"{self.path} holds data but no commit: its first write did not finish")
        return None

    def _files(self, commit: dict, buckets: set[int] | None = None) -> list[str]:
        return [f"{self.path}/data/v={v}/bucket={b}" for b, v in sorted(commit["buckets"].items(), key=lambda x: int(x[0]))
                if buckets is None or int(b) in buckets]

    def _read(self, commit: dict, buckets: set[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(commit["schema"])
        files = self._files(commit, buckets)
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame | None:
        if version is not None:
            return self._read(self._commit(version))
        newest = self._newest()
        return self._read(newest[1]) if newest else None

    def _bucket(self, df: DataFrame, key: str, buckets: int):
        """The bucket of each row; rows with a NULL key are spread by their content."""
        flat = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
        spread = F.when(F.col(key).isNull(), F.xxhash64(*flat)).otherwise(F.xxhash64(F.col(key)))
        return F.pmod(spread, F.lit(buckets)).cast("int")

    def _write_data(self, df: DataFrame, key: str, version: int, buckets: int, mode: str = "overwrite", gather: bool = True) -> list[int]:
        """Write rows under a version, each bucket from one task (a few if it
        is large), or with ``gather`` off by the task that has them; returns the
        version's buckets that hold rows."""
        target = f"{self.path}/data/v={version}"
        rows = df.withColumn("bucket", self._bucket(df, key, buckets))
        (rows.hint("rebalance", "bucket") if gather else rows).write.mode(mode).partitionBy("bucket").parquet(target)
        return [int(n.split("=")[1]) for n in self._names(target) if n.startswith("bucket=")]

    def _finish(self, version: int, buckets: dict, schema: T.StructType, applied: dict, count: int, key: str) -> int:
        body = {"buckets": {str(b): v for b, v in buckets.items()}, "schema": schema.jsonValue(), "applied": applied, "n_buckets": count, "key": key}
        write_text(self.spark, f"{self.path}/commits/{version:020d}.json", json.dumps(body))
        return version

    def write(self, df: DataFrame, key: str) -> int:
        """The first version of the table."""
        if self._newest():
            raise RuntimeError(f"{self.path} already holds a table")
        got = self._write_data(df, key, 0, self.buckets)
        return self._finish(0, dict.fromkeys(got, 0), df.schema, {}, self.buckets, key)

    def apply_batch(self, batch: DataFrame, batch_id: int, key: str, order_col: str | None = None, query_id: str = "") -> int:
        """Upsert one (micro-)batch; returns the newest version. Only the
        buckets of the batch's keys are read and written again."""
        newest = self._newest()
        try:
            if newest is None:
                got = self._write_data(latest_per_key(batch, key, order_col), key, 0, self.buckets)
                return self._finish(0, dict.fromkeys(got, 0), batch.schema, {query_id: batch_id}, self.buckets, key)
            last, commit = newest
            if commit["applied"].get(query_id, -1) >= batch_id:
                return last  # a replay
            count, version = commit["n_buckets"], last + 1
            # at most n_buckets numbers come to the driver
            size = F.sum(F.lit(KEY_ROW_BYTES) + F.coalesce(F.length(F.col(key).cast("string")), F.lit(0)))
            sizes = {r["b"]: r["n"] for r in batch.groupBy(self._bucket(batch, key, count).alias("b")).agg(size.alias("n")).collect()}
            touched = set(sizes)
            merged = upsert(self._read(commit, touched), batch, key, order_col)
            files = [n for f in self._files(commit, touched) for n in self._names(f) if n.endswith(".parquet")]
            groups = turns(sizes, KEYS_BYTES)
            if not touched:
                got = []
            elif groups is None or len(files) > FILES_PER_BUCKET * len(touched):
                got = self._write_data(merged, key, version, count)
            else:
                got = self._write_in_place(commit, groups, batch, version, key, order_col)
        except PySparkException as e:
            if DUPLICATE in str(e):
                raise DuplicateKeyError(f"{DUPLICATE} {key}; pass order_col") from e
            raise
        buckets = {int(b): v for b, v in commit["buckets"].items() if int(b) not in touched} | dict.fromkeys(got, version)
        return self._finish(version, buckets, merged.schema, commit["applied"] | {query_id: batch_id}, count, key)

    def _write_in_place(self, commit: dict, groups: list[set[int]], batch: DataFrame, version: int, key: str, order_col: str | None) -> list[int]:
        """The merged rows of the groups' buckets, with the batch alone shuffled:
        the stored rows lie in their buckets, and each group's are written by the
        tasks that read them, without the keys (broadcast) that the batch has there."""
        count, none, mode = commit["n_buckets"], F.lit(False), "overwrite"
        if order_col is None:
            # the keys alone tell that each has one row: the rows need no grouping
            if not batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
                raise DuplicateKeyError(f"{DUPLICATE} {key}; pass order_col")
            new = batch
        else:
            new = latest_per_key(batch, key, order_col)
        place = F.pmod(F.xxhash64(F.col(key)), F.lit(count)).cast("int")
        for group in groups:
            if self._files(commit, group):
                keys = batch.filter(F.col(key).isNotNull() & place.isin(*group)).select(key)
                kept = self._read(commit, group).join(F.broadcast(keys), on=key, how="left_anti")
                # a union with no row of the other side: the columns and types of the whole
                self._write_data(kept.unionByName(batch.filter(none), allowMissingColumns=True), key, version, count, mode, gather=False)
                mode = "append"
        old = self._read(commit).filter(none)
        return self._write_data(old.unionByName(new, allowMissingColumns=True), key, version, count, mode)

    def prune(self, keep: int = 2) -> list[int]:
        """Delete the commits before the newest ``keep``, and the bucket folders
        that no commit left reads; returns the versions removed. Readers of
        a removed version fail, so ``keep`` must cover the longest read."""
        done = self.committed()
        gone, left = done[:-keep], done[-keep:]
        if not gone:
            return []
        used = {(int(v), int(b)) for n in left for b, v in self._commit(n)["buckets"].items()}
        for n in gone:
            fs, hpath = self._hadoop(f"{self.path}/commits/{n:020d}.json")
            fs.delete(hpath, False)
        for name in self._names(f"{self.path}/data"):
            v = int(name.split("=")[1])
            if v <= left[-1]:
                for b in self._names(f"{self.path}/data/{name}"):
                    if b.startswith("bucket=") and (v, int(b.split("=")[1])) not in used:
                        fs, hpath = self._hadoop(f"{self.path}/data/{name}/{b}")
                        fs.delete(hpath, True)
        return gone


class MergeTarget:
    """Upserts into a catalog table whose format supports MERGE (Delta,
    Iceberg, ...) with ``DataFrame.mergeInto``: only the touched files are
    rewritten, unlike a full snapshot. Same ``apply_batch`` interface as
    :class:`SnapshotStore`; MERGE on a non-NULL key is idempotent, so a
    replayed micro-batch leaves the table as it was. Plain parquet tables
    refuse MERGE; use :class:`SnapshotStore` for them. As there, rows with a
    NULL key are inserts, so a replay inserts those again; filter them before
    if that matters (the stream does)."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark = spark
        self.table = table

    def apply_batch(self, batch: DataFrame, batch_id: int, key: str, order_col: str | None = None, query_id: str = "") -> int:
        new = latest_per_key(batch, key, order_col).alias("_src")
        cond = F.col(f"{self.table}.{key}") == F.col(f"_src.{key}")
        new.mergeInto(self.table, cond).whenMatched().updateAll().whenNotMatched().insertAll().merge()
        return batch_id

    def read(self) -> DataFrame:
        return self.spark.table(self.table)
