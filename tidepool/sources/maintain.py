"""Table maintenance: rewrite a table of many small files as few files."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

TARGET_FILE_BYTES = 256 * 1024 * 1024


@contextmanager
def _conf(spark: SparkSession, settings: dict[str, str]):
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns of a partitioned folder layout (``col=value``), outermost first."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    cols = []
    while True:
        inner = [st.getPath() for st in fs.listStatus(hpath) if st.isDirectory() and "=" in st.getPath().getName()]
        if not inner:
            return cols
        cols.append(inner[0].getName().split("=")[0])
        hpath = inner[0]


def compact_table(spark: SparkSession, src: str, dst: str, target_file_bytes: int = TARGET_FILE_BYTES,
                  sort_by: list[str] | None = None) -> int:
    """Rewrite ``src`` into ``dst`` as files of about ``target_file_bytes``.

    No shuffle: the scan itself packs small files into read splits of the
    target size (``maxPartitionBytes``, with the per-file open cost made
    small and no minimum split count), and each split is written as one
    file. A partitioned table keeps its partitions; its rows are rebalanced
    on them first, so that a folder gets few files. The schema is the union of all
    files' schemas (columns of later appends stay); columns and rows of the
    copy are compared with the source before returning. ``sort_by`` sorts within each
    file (better encoding and min/max pruning). The source stays as it is
    (readers switch to ``dst``), so a failed run leaves no half table.
    Returns the number of files written."""
    by = partition_columns(spark, src)
    settings = {
        "spark.sql.files.maxPartitionBytes": str(target_file_bytes),
        "spark.sql.files.openCostInBytes": str(max(1, min(4 * 1024 * 1024, target_file_bytes // 1024))),
        "spark.sql.files.minPartitionNum": "1",
    }
    with _conf(spark, settings):
        source = spark.read.option("mergeSchema", "true").parquet(src)
        df = source.hint("rebalance", *by) if by else source
        if sort_by or by:
            df = df.sortWithinPartitions(*by, *(sort_by or []))
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(dst)
    copy = spark.read.schema(source.schema).parquet(dst)
    written = spark.read.option("mergeSchema", "true").parquet(dst) if data_files(spark, dst) else copy
    if sorted(written.columns) != sorted(source.columns) or copy.count() != source.count():
        raise RuntimeError(f"{dst} is no full copy of {src}")
    return data_files(spark, dst)


def data_files(spark: SparkSession, path: str) -> int:
    """Number of parquet files under a path, partitions included."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    files = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(hpath, True)
    n = 0
    while files.hasNext():
        n += files.next().getPath().getName().endswith(".parquet")
    return n
