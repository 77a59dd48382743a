"""Selective compaction, quarantine, checks observed in the load, a source that is cleaned."""

import json

import pytest
from conftest import local_path, rows
from pyspark.sql import functions as F

from tidepool.sources import compact_small as cs
from tidepool.sources.compact_small import compact_small, table_files
from tidepool.sources.json_docs import read_json_docs
from tidepool.sources.quarantine import BROKEN, KEYLESS, broken_documents, quarantine


def numbers(spark, lo, hi):
    return spark.range(lo, hi).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS v")


def test_large_files_keep_their_names_and_evolved_columns_stay(spark, scratch):
    path = scratch("select")
    numbers(spark, 0, 40_000).coalesce(1).write.parquet(path)
    large = set(table_files(spark, path))
    for k in range(6):
        part = numbers(spark, 50_000 + 100 * k, 50_000 + 100 * k + 100)
        (part.withColumn("more", F.lit(k)) if k % 2 else part).coalesce(1).write.mode("append").parquet(path)
    before = rows(spark.read.option("mergeSchema", "true").parquet(path), "id", "v", "more")
    assert compact_small(spark, path, target_file_bytes=1 << 20) == (6, 1)
    after = table_files(spark, path)
    assert large < set(after) and len(after) == 2
    assert rows(spark.read.option("mergeSchema", "true").parquet(path), "id", "v", "more") == before
    assert compact_small(spark, path, target_file_bytes=1 << 20) == (0, 0) and set(table_files(spark, path)) == set(after)


def test_partitions_are_kept(spark, scratch):
    path = scratch("select_parts")
    for k in range(4):
        numbers(spark, 1000 * k, 1000 * k + 900).withColumn("day", F.expr("id % 3")).coalesce(2).write.mode("append").partitionBy("day").parquet(path)
    before = rows(spark.read.parquet(path), "id", "v", "day")
    taken, written = compact_small(spark, path)
    assert taken == 24 and written <= 6
    assert rows(spark.read.parquet(path), "id", "v", "day") == before
    assert {f.split("/")[0] for f in table_files(spark, path)} == {"day=0", "day=1", "day=2"}


def test_interrupted_swap_is_finished_by_the_next_call(spark, scratch, monkeypatch):
    path = scratch("select_crash")
    for k in range(5):
        numbers(spark, 100 * k, 100 * k + 100).coalesce(1).write.mode("append").parquet(path)
    before = rows(spark.read.parquet(path))
    with monkeypatch.context() as m:
        m.setattr(cs, "_swap", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError, match="crash"):
            compact_small(spark, path)
    # the table is as it was; the staged copy is hidden
    assert rows(spark.read.parquet(path)) == before and len(table_files(spark, path)) == 5
    assert compact_small(spark, path) == (0, 0)
    assert rows(spark.read.parquet(path)) == before and len(table_files(spark, path)) == 1


def test_dropped_documents_are_kept_and_counted(spark, scratch):
    import os

    raw, table = scratch("raw"), scratch("quarantine")
    os.makedirs(local_path(raw))
    docs = [{"match_id": 1, "a": "x"}, {"match_id": 2, "a": 5}, {"a": "no key"}, {"match_id": "text"}]
    lines = [json.dumps(d) for d in docs] + ['{"match_id": 3, "a": ', "not json", "", "  ", "[]"]
    with open(f"{local_path(raw)}/docs.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    schema = spark.createDataFrame([], "match_id BIGINT, a STRING").schema
    good = read_json_docs(spark, raw, schema)
    assert rows(good, "match_id") == [(1,), (2,)]
    bad = broken_documents(spark, raw, schema).collect()
    assert {r["text"] for r in bad} == {lines[2], lines[3], lines[4], lines[5], "[]"}
    assert {r["text"]: r["reason"] for r in bad}[lines[2]] == KEYLESS and {r["text"]: r["reason"] for r in bad}["not json"] == BROKEN
    assert all(r["file"].endswith("docs.json") for r in bad)
    for _ in range(2):
        counts = quarantine(spark, raw, schema, table, "first")
        assert sum(counts.values()) == 5 and spark.read.parquet(table).count() == 5


def test_load_counts_its_own_rows(spark, scratch):
    import uuid

    from tidepool.plans.bronze import load_bronze_checked
    from tidepool.sources.json_docs import land_json

    raw = scratch("observed")
    docs = spark.range(0, 50).selectExpr("id DIV 2 AS match_id", "id AS part", "'x' AS a")
    land_json(docs, raw)
    db = f"obs_{uuid.uuid4().hex[:8]}"
    got = load_bronze_checked(spark, raw, docs.schema, db, "details", location=scratch("obs_db"))
    assert rows(got, "n_rows", "n_distinct_keys") == [(50, 50)]
    again = load_bronze_checked(spark, raw, docs.schema, db, "details")
    assert rows(again, "n_rows", "n_distinct_keys") == [(50, 50)]


def test_drained_folder_is_archived(spark, scratch):
    import os

    from tidepool.operators.upsert import SnapshotStore
    from tidepool.sources.json_docs import land_json
    from tidepool.streaming.bronze_stream import stream_upsert

    base = scratch("archive")
    store = SnapshotStore(spark, f"{base}/table")
    one = spark.range(0, 40).selectExpr("id AS match_id", "'a' AS v")
    schema, files = one.schema, lambda d: sorted(f for _, _, fs in os.walk(local_path(d)) for f in fs if f.startswith("part-"))
    landed = []
    for lo in (0, 40, 80):
        land_json(spark.range(lo, lo + 40).selectExpr("id AS match_id", "'a' AS v").repartition(3), f"{base}/in", mode="append")
        landed += [f for f in files(f"{base}/in") if f not in landed]
        stream_upsert(spark, f"{base}/in", schema, store, f"{base}/_checkpoint", key="match_id", archive_dir=f"{base}/old")
    # a run cleans what the run before it committed
    stream_upsert(spark, f"{base}/in", schema, store, f"{base}/_checkpoint", key="match_id", archive_dir=f"{base}/old")
    assert sorted(files(f"{base}/in") + files(f"{base}/old")) == sorted(landed)
    assert len(landed) == 9 and set(files(f"{base}/in")).isdisjoint(landed[:3])
    assert rows(store.read(), "match_id") == sorted(((k,) for k in range(120)), key=repr)


def test_target_of_the_compaction_does_not_grow_with_the_table(spark, scratch, monkeypatch):
    """Eight large files: a task rewrites about one of them, not a third of the table."""
    from conftest import SF_SMALL
    from tidepool.plans import catalog
    from tidepool.session import path_bytes

    base, seen = scratch("eight"), []
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    li.repartitionByRange(8, "l_orderkey").write.parquet(f"{base}/lineitem.parquet")
    monkeypatch.setattr(catalog, "compact_small", lambda s, path, target: seen.append((path_bytes(s, path), target)) or compact_small(s, path, target))
    assert catalog.QUERIES["compact_small"](spark, base).count() == 6000
    assert 5 * seen[0][1] < seen[0][0]
