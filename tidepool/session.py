"""Session settings and the shared scratch folder.

Jobs never pick a machine-local folder on their own: every sink that is not
given an explicit path goes under the folder named by ``spark.checkpoint.dir``
(the shared folder of the cluster). Only in a local session without that
setting -- tests -- a temporary folder is created and registered as the
checkpoint dir, so later calls in the same session agree on it; on a cluster
an unset folder is an error, since executors could not see a local one.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job needs to be right (UTC wall clock for epoch <-> string) and
# sized for executors rather than for one machine. Static settings (memory)
# belong to the launcher, not here.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only below a checked runtime size; AQE re-plans with real sizes
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # target bytes per post-shuffle partition (AQE coalesces towards it)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # a selective side of a join prunes the other side's scan at runtime
    # (bloom filter on the probe keys; partition pruning for partitioned tables)
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}

# Bytes of rows per initial shuffle partition (AQE coalesces from there).
BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024
# Bytes that rows take in memory for one byte of parquet. A sorted key column is
# kept in 3 to 4 bytes a row, a broadcast or a sort holds 16 and more.
FILE_EXPANSION = 8


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under a path (file-system metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system (metadata only)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def size_for_input(spark: SparkSession, input_bytes: int) -> int:
    """Size joins and shuffles for the rows of the input, not for its files.

    A side of a join is broadcast by the size that its rows take (file sizes
    alone let the driver gather millions of packed keys). Shuffles start with enough
    partitions, so a partition stays near ``BYTES_PER_SHUFFLE_PARTITION`` at any
    scale; never fewer than the session's own setting. Returns the initial
    partition count."""
    spark.conf.set("spark.sql.sources.fileCompressionFactor", str(float(FILE_EXPANSION)))
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-int(input_bytes) * FILE_EXPANSION // BYTES_PER_SHUFFLE_PARTITION)
    n = max(current, wanted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidepool") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; a temporary folder is set only when none is
    configured and the master is local. Elsewhere a missing setting raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidepool-ckpt-")
    sc.setCheckpointDir(configured)
    # setCheckpointDir adds a per-application subfolder; use what Spark chose
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tidepool/{name}-{uuid.uuid4().hex[:12]}"


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(hpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, body: str) -> None:
    """Write a small text file; readers see the old or the new one, whole."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    out = fs.create(part, True)
    out.write(bytearray(body.encode("utf-8")))
    out.close()
    # one rename that replaces: a reader, or a crash, never finds none
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(part), fs.makeQualified(hpath), options)
