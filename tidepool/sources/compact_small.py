"""Selective compaction: only small files of a parquet table are rewritten.

The files are chosen by a listing (names and sizes, no footers). They are read
together, packed into splits of the target size by the scan, and written to a
hidden staging folder of the table; large files are neither read nor
touched. Rows are counted before anything is moved. A plan file beside the table
names the old and the new files before the swap begins, so that a swap that was interrupted is
finished by the next call and no row is lost or doubled for good.

While a swap runs, a reader that lists the folder can see both the old and
the new files. Jobs that need to read meanwhile take
:func:`tidepool.sources.maintain.compact_table` and publish its copy.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from tidepool.session import read_text, write_text
from tidepool.sources.maintain import TARGET_FILE_BYTES, _conf, partition_columns

PLAN = "_compaction.json"


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files of a table (path below the table) and their bytes; hidden folders left out."""
    hpath, fs = _fs(spark, path)
    root = fs.makeQualified(hpath).toString().rstrip("/") + "/"
    out, files = {}, fs.listFiles(hpath, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().toString().removeprefix(root)
        if name.endswith(".parquet") and not any(p.startswith(("_", ".")) for p in name.split("/")):
            out[name] = f.getLen()
    return out


def small_files(sizes: dict[str, int], target_file_bytes: int) -> list[str]:
    """Files under half the target, in folders that hold two or more such."""
    by_folder: dict[str, list[str]] = {}
    for name, size in sizes.items():
        if 2 * size < target_file_bytes:
            by_folder.setdefault(name.rpartition("/")[0], []).append(name)
    return sorted(n for names in by_folder.values() if len(names) > 1 for n in names)


def _swap(spark: SparkSession, path: str) -> None:
    """Move the new files in and take the old ones out, as the plan file says;
    every step may be repeated."""
    root = path.rstrip("/")
    plan = json.loads(read_text(spark, f"{root}/{PLAN}"))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    _, fs = _fs(spark, root)
    for name in plan["new"]:
        src, dst = hadoop(f"{root}/{plan['staging']}/{name}"), hadoop(f"{root}/{name}")
        if fs.exists(src):
            fs.mkdirs(dst.getParent())
            if not fs.rename(src, dst):
                raise OSError(f"could not move {name}")
    for name in plan["old"]:
        fs.delete(hadoop(f"{root}/{name}"), False)
    fs.delete(hadoop(f"{root}/{plan['staging']}"), True)
    fs.delete(hadoop(f"{root}/{PLAN}"), False)
    spark.catalog.refreshByPath(path)


def compact_small(spark: SparkSession, path: str, target_file_bytes: int = TARGET_FILE_BYTES) -> tuple[int, int]:
    """Rewrite the small files of a table in place; (files taken, files written).

    Partitioned tables keep their partitions, columns that only some files have
    stay. A run that was interrupted before its swap leaves the table as it was."""
    root = path.rstrip("/")
    hpath, fs = _fs(spark, f"{root}/{PLAN}")
    if fs.exists(hpath):
        _swap(spark, path)
    old = small_files(table_files(spark, root), target_file_bytes)
    if not old:
        return 0, 0
    staging = f"_compacted_{uuid.uuid4().hex[:12]}"
    by = partition_columns(spark, root)
    settings = {"spark.sql.files.maxPartitionBytes": str(target_file_bytes), "spark.sql.files.openCostInBytes": str(max(1, min(4 << 20, target_file_bytes // 1024))),
                "spark.sql.files.minPartitionNum": "1"}
    with _conf(spark, settings):
        source = spark.read.option("mergeSchema", "true").option("basePath", root).parquet(*[f"{root}/{n}" for n in old])
        rows = source.hint("rebalance", *by).sortWithinPartitions(*by) if by else source
        writer = rows.write
        (writer.partitionBy(*by) if by else writer).parquet(f"{root}/{staging}")
    copy = spark.read.schema(source.schema).option("basePath", f"{root}/{staging}").parquet(f"{root}/{staging}")
    if copy.count() != source.count():
        raise RuntimeError(f"{staging} is no full copy of the small files of {path}")
    new = sorted(table_files(spark, f"{root}/{staging}"))
    write_text(spark, f"{root}/{PLAN}", json.dumps({"staging": staging, "old": old, "new": new}))
    _swap(spark, path)
    return len(old), len(new)
