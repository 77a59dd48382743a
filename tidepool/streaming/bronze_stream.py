"""Streaming JSON documents into a keyed table.

``readStream`` over a folder of JSON files under a fixed schema, at most
``max_files`` files per micro-batch; ``foreachBatch`` upserts each batch
into a :class:`~tidepool.operators.upsert.SnapshotStore` (plain parquet) or a
:class:`~tidepool.operators.upsert.MergeTarget` (a MERGE-capable catalog
table); progress lives in
the checkpoint. ``available_now`` drains what is there in rate-limited
batches and stops (the reference sleeps, drains and stops).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.upsert import MergeTarget, SnapshotStore

# Files per micro-batch of the document stream.
MAX_FILES_PER_TRIGGER = 1000


def json_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files: int = MAX_FILES_PER_TRIGGER, archive_dir: str | None = None) -> DataFrame:
    """Streaming scan of new JSON files under a fixed schema. With ``archive_dir``
    (outside ``path``, on the same file system) files of committed batches are moved there, so
    that the folder's listing holds what is still to be read, not all that ever came."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.json(path)


def stream_upsert(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    store: SnapshotStore | MergeTarget,
    checkpoint: str,
    key: str = "match_id",
    order_col: str | None = None,
    max_files: int = MAX_FILES_PER_TRIGGER,
    available_now: bool = True,
    timeout_s: float | None = None,
    run_for_s: float | None = None,
    interval: str = "10 seconds",
    keep: int | None = 3,
    archive_dir: str | None = None,
):
    """Run the stream.

    * ``available_now`` (default): drain what is there in rate-limited
      batches, block until done (or ``timeout_s``) and stop.
    * otherwise a ``processingTime`` trigger every ``interval``; with
      ``run_for_s`` the call runs that long, then processes everything
      still available and stops (the reference's bounded run); without it
      the running query is returned to the caller.

    A snapshot store keeps its newest ``keep`` versions (None: all), so its
    size does not grow with the number of batches.

    ``archive_dir``: where files go once the batch after theirs has begun (Spark
    cleans what is committed before it plans the next batch).

    Returns the ``StreamingQuery``."""
    docs = json_stream(spark, source_dir, schema, max_files, archive_dir).filter(F.col(key).isNotNull())

    def apply(batch: DataFrame, batch_id: int) -> None:
        # the batch is read more than once (touched buckets, upsert): keep
        # the parsed rows instead of parsing the JSON files again; a lost
        # executor only means those blocks are recomputed from the files
        batch = batch.persist()
        try:
            query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
            store.apply_batch(batch, batch_id, key, order_col, query_id=query_id)
            if keep and isinstance(store, SnapshotStore):
                store.prune(keep)
        finally:
            batch.unpersist()

    writer = docs.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    query = writer.start()
    if available_now:
        query.awaitTermination(timeout_s)
    elif run_for_s is not None:
        query.awaitTermination(run_for_s)
        query.processAllAvailable()
        query.stop()
    return query
