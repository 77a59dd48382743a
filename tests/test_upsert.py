import pytest

from conftest import rows
from tidepool.operators import upsert as upsert_module
from tidepool.operators.upsert import DuplicateKeyError, SnapshotStore, turns, upsert
from tidepool.sources.json_docs import land_json
from tidepool.streaming.bronze_stream import stream_upsert

SCHEMA = "k LONG, v STRING, ts LONG"


def test_upsert_cases(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], SCHEMA)
    new = spark.createDataFrame([(1, "A", 2), (3, "c", 2), (None, "x", 2), (None, "y", 2)], SCHEMA)
    got = rows(upsert(old, new, "k"), "k", "v")
    assert got == rows(spark.createDataFrame(
        [(1, "A"), (2, "b"), (3, "c"), (None, "n"), (None, "x"), (None, "y")], "k LONG, v STRING"))


def test_duplicate_keys(spark):
    old = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    dup = spark.createDataFrame([(1, "B", 2), (1, "C", 3), (2, "d", 1)], SCHEMA)
    assert rows(upsert(old, dup, "k", order_col="ts"), "k", "v") == [(1, "C"), (2, "d")]
    with pytest.raises(Exception, match="several rows for one k"):
        upsert(old, dup, "k").collect()


def test_new_column_reads_null_for_old_rows(spark):
    old = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    new = spark.createDataFrame([(2, "b", 1, 9.0)], SCHEMA + ", extra DOUBLE")
    assert rows(upsert(old, new, "k"), "k", "extra") == [(1, None), (2, 9.0)]


def test_replayed_batch_is_skipped(spark, scratch):
    store = SnapshotStore(spark, scratch("snap"))
    store.write(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA), "k")
    b0 = spark.createDataFrame([(2, "B", 2), (3, "c", 2)], SCHEMA)
    b1 = spark.createDataFrame([(3, "C", 3)], SCHEMA)
    assert store.apply_batch(b0, 0, "k", query_id="q") == 1
    assert store.apply_batch(b1, 1, "k", query_id="q") == 2
    first = rows(store.read(), "k", "v")
    assert store.apply_batch(b1, 1, "k", query_id="q") == 2  # replay
    assert rows(store.read(), "k", "v") == first == [(1, "a"), (2, "B"), (3, "C")]
    assert store.committed() == [0, 1, 2]


def test_new_checkpoint_builds_on_the_newest_version(spark, scratch):
    store = SnapshotStore(spark, scratch("fresh"))
    store.write(spark.createDataFrame([(1, "a", 1)], SCHEMA), "k")
    for n in range(3):
        store.apply_batch(spark.createDataFrame([(n, "old", 2)], SCHEMA), n, "k", query_id="first")
    store.apply_batch(spark.createDataFrame([(7, "new", 3)], SCHEMA), 0, "k", query_id="second")
    assert rows(store.read(), "k", "v") == [(0, "old"), (1, "old"), (2, "old"), (7, "new")]


def test_only_touched_buckets_are_rewritten(spark, scratch):
    store = SnapshotStore(spark, scratch("touched"), buckets=8)
    store.write(spark.range(0, 200).selectExpr("id AS k", "'a' AS v", "0L AS ts"), "k")
    before = store._commit(0)["buckets"]
    store.apply_batch(spark.createDataFrame([(5, "B", 1)], SCHEMA), 0, "k")
    after = store._commit(1)["buckets"]
    assert [b for b in before if before[b] != after[b]] == [b for b, v in after.items() if v == 1]
    assert sum(v == 1 for v in after.values()) == 1 and len(after) == 8
    assert store.read().count() == 200 and rows(store.read().filter("k = 5"), "v") == [("B",)]
    assert store.read(0).filter("v = 'B'").count() == 0


def test_bucket_count_follows_the_expected_size_and_stays(spark, scratch, monkeypatch):
    monkeypatch.setattr(upsert_module, "BUCKET_BYTES", 1000)
    path = scratch("sized")
    store = SnapshotStore(spark, path, expected_bytes=40_000)
    store.write(spark.range(0, 500).selectExpr("id AS k", "'a' AS v", "0L AS ts"), "k")
    assert len(store._commit(0)["buckets"]) == 64
    # a later run that expects another size keeps the table's own number
    SnapshotStore(spark, path).apply_batch(spark.createDataFrame([(5, "B", 1)], SCHEMA), 0, "k")
    assert sum(v == 1 for v in store._commit(1)["buckets"].values()) == 1 and store._commit(1)["n_buckets"] == 64
    assert store.read().count() == 500 and rows(store.read().filter("k = 5"), "v") == [("B",)]


def test_unfinished_writes_are_never_read(spark, scratch):
    spark.sparkContext._jsc.hadoopConfiguration().set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        store = SnapshotStore(spark, scratch("nomark"))
        store.write(spark.createDataFrame([(1, "a", 1)], SCHEMA), "k")
        store.apply_batch(spark.createDataFrame([(2, "b", 1)], SCHEMA), 0, "k")
        assert rows(store.read(), "k") == [(1,), (2,)]
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    # data of a failed first write, without a commit
    broken = SnapshotStore(spark, scratch("broken"))
    broken._write_data(spark.createDataFrame([(1, "a", 1)], SCHEMA), "k", 0, 16)
    for act in (broken.read, lambda: broken.apply_batch(spark.createDataFrame([(2, "b", 1)], SCHEMA), 0, "k")):
        with pytest.raises(RuntimeError, match="did not finish"):
            act()


def test_null_keys_and_new_columns_in_the_store(spark, scratch):
    store = SnapshotStore(spark, scratch("nulls"), buckets=4)
    store.write(spark.createDataFrame([(1, "a", 1), (None, "n", 1)], SCHEMA), "k")
    store.apply_batch(spark.createDataFrame([(None, "x", 2, 9.0), (1, "A", 2, 8.0)], SCHEMA + ", extra DOUBLE"), 0, "k")
    assert rows(store.read(), "k", "v", "extra") == sorted([(1, "A", 8.0), (None, "n", None), (None, "x", 9.0)], key=repr)
    with pytest.raises(DuplicateKeyError):
        store.apply_batch(spark.createDataFrame([(5, "x", 2), (5, "y", 2)], SCHEMA), 1, "k")
    assert store.committed() == [0, 1]


def test_stream_equals_batch(spark, scratch):
    base = scratch("stream")
    old = spark.range(0, 100).selectExpr("id AS k", "'old' AS v", "0L AS ts")
    changes = spark.range(50, 150).selectExpr("id AS k", "concat('new', id) AS v", "1L AS ts")
    store = SnapshotStore(spark, base + "/t")
    store.write(old, "k")
    land_json(changes.repartition(5), base + "/in")
    stream_upsert(spark, base + "/in", old.schema, store, base + "/ck", key="k", max_files=2)
    assert len(store.committed()) == 3  # rate limit: several micro-batches, old versions pruned
    assert store.committed()[-1] >= 3
    assert rows(store.read(), "k", "v") == rows(upsert(old, changes, "k"), "k", "v")
    # restart with the same checkpoint: nothing new, nothing applied twice
    before = store.committed()
    stream_upsert(spark, base + "/in", old.schema, store, base + "/ck", key="k", max_files=2)
    assert store.committed() == before


def test_merge_target_refuses_plain_parquet(spark, scratch):
    from tidepool.operators.upsert import MergeTarget

    spark.sql(f"CREATE SCHEMA IF NOT EXISTS tp_merge LOCATION '{scratch('merge')}'")
    spark.createDataFrame([(1, "a", 1)], SCHEMA).write.mode("overwrite").format("parquet").saveAsTable("tp_merge.t")
    target = MergeTarget(spark, "tp_merge.t")
    with pytest.raises(Exception, match="(?i)merge|unsupported|not support"):
        target.apply_batch(spark.createDataFrame([(1, "b", 2)], SCHEMA), 0, "k")
    assert rows(target.read(), "k", "v") == [(1, "a")]


def test_prune_keeps_what_the_newest_versions_read(spark, scratch):
    store = SnapshotStore(spark, scratch("prune"), buckets=4)
    store.write(spark.range(0, 40).selectExpr("id AS k", "'a' AS v", "0L AS ts"), "k")
    for n in range(4):
        store.apply_batch(spark.createDataFrame([(n, "x", n)], SCHEMA), n, "k")
    want = rows(store.read(), "k", "v")
    assert store.prune(keep=2) == [0, 1, 2]
    assert store.committed() == [3, 4]
    assert rows(store.read(), "k", "v") == want and store.read(3).count() == 40
    used = {(v, b) for n in (3, 4) for b, v in store._commit(n)["buckets"].items()}
    left = {(int(v.split("=")[1]), b.split("=")[1]) for v in store._names(f"{store.path}/data")
            for b in store._names(f"{store.path}/data/{v}") if b.startswith("bucket=")}
    assert left == used


def test_latest_per_key_with_map_column_and_ties(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, {"x": 1}), (1, "b", 5, {"x": 2}), (1, "c", 4, {"x": 3}), (2, "d", 1, None)],
        "k LONG, v STRING, ts LONG, m MAP<STRING, INT>")
    first = rows(upsert(None, df, "k", order_col="ts"), "k", "v")
    again = rows(upsert(None, df.repartition(3), "k", order_col="ts"), "k", "v")
    assert first == again and len(first) == 2
    assert dict(first)[1] in ("a", "b") and dict(first)[2] == "d"


def test_bounded_processing_time_run(spark, scratch):
    base = scratch("bounded")
    old = spark.range(0, 10).selectExpr("id AS k", "'old' AS v", "0L AS ts")
    changes = spark.range(5, 20).selectExpr("id AS k", "'new' AS v", "1L AS ts")
    store = SnapshotStore(spark, base + "/t")
    store.write(old, "k")
    land_json(changes.repartition(3), base + "/in")
    q = stream_upsert(spark, base + "/in", old.schema, store, base + "/ck", key="k", max_files=1,
                      available_now=False, run_for_s=1, interval="200 milliseconds")
    assert not q.isActive
    assert rows(store.read(), "k", "v") == rows(upsert(old, changes, "k"), "k", "v")


def test_turns_hold_all_buckets_under_the_limit():
    assert turns({0: 5, 1: 5, 2: 5, 3: 1}, 10) == [{0, 1}, {2, 3}]
    assert turns({}, 10) == [] and turns({0: 11}, 10) is None
    assert turns(dict.fromkeys(range(200), 9), 10) is None


def test_a_batch_is_merged_without_a_shuffle_of_the_stored_rows(spark, scratch, monkeypatch):
    # keys in several turns, null keys, a new column and a wider type, and in the
    # end so many files that the buckets are gathered again
    monkeypatch.setattr(upsert_module, "KEYS_BYTES", 2_000)
    monkeypatch.setattr(upsert_module, "FILES_PER_BUCKET", 3)
    gathered, write = [], SnapshotStore._write_data

    def spy(self, df, key, version, buckets, mode="overwrite", gather=True):
        gathered.append((version, gather, df.count()))
        return write(self, df, key, version, buckets, mode, gather)

    monkeypatch.setattr(SnapshotStore, "_write_data", spy)
    store = SnapshotStore(spark, scratch("in_place"), buckets=4)
    old = spark.range(1000).selectExpr("IF(id % 100 = 0, NULL, id) AS k", "CAST(1 AS INT) AS v")
    store.write(old, "k")
    want = old
    for n in range(1, 5):
        batch = spark.range(50 * n, 50 * n + 200).selectExpr("IF(id % 97 = 0, NULL, id) AS k", f"CAST({n} AS BIGINT) + 10000000000 AS v", f"'{n}' AS w")
        want = upsert(want, batch, "k")
        store.apply_batch(batch, n, "k")
        assert rows(store.read(), "k", "v", "w") == rows(want, "k", "v", "w")
    first = [(gather, n) for version, gather, n in gathered if version == 1]
    # only the rows of the batch are gathered
    assert [n for gather, n in first if gather] == [200] and len(first) > 2
    # with many files a bucket's rows come together again
    assert any(gather and n > 900 for version, gather, n in gathered if version > 1)
