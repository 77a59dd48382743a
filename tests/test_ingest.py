from pyspark.sql import functions as F

from conftest import rows
from tidepool.operators.backlog import backlog, backlog_batch, id_cursor
from tidepool.sources.ingest import ingest, ingest_backfill, ingest_new
from tidepool.sources.tables import (append_evolving, full_load_once, ledger_append, read_ledger, read_table,
                                     table_exists)


def listing(spark, lo, hi):
    return spark.range(lo, hi).selectExpr("id AS match_id", "id * 60 AS start_time")


def test_ingest_new_twice_adds_nothing(spark, scratch):
    target = scratch("hist")
    append_evolving(listing(spark, 0, 10).withColumn("td_start", F.lit("x")), target)
    src = listing(spark, 0, 1000)  # far more than one page of new ids
    ingest_new(spark, src, target)
    assert read_table(spark, target).count() == 1000
    ingest(spark, src, target, mode="new")
    assert read_table(spark, target).count() == 1000
    assert rows(id_cursor(read_table(spark, target))) == [(0, 999)]


def test_ingest_into_empty_target(spark, scratch):
    target = scratch("empty")
    ingest_new(spark, listing(spark, 5, 8), target)
    got = rows(read_table(spark, target), "match_id", "td_start")
    assert got == [(5, "1970-01-01 00:05:00"), (6, "1970-01-01 00:06:00"), (7, "1970-01-01 00:07:00")]


def test_backfill_pages_below_min(spark, scratch):
    target = scratch("back")
    append_evolving(listing(spark, 500, 510).withColumn("td_start", F.lit("x")), target)
    ingest_backfill(spark, listing(spark, 0, 1000), target, rows=30)
    ids = sorted(r["match_id"] for r in read_table(spark, target).collect())
    assert ids == list(range(470, 510))
    ingest_backfill(spark, listing(spark, 0, 1000), target)  # all that is left
    assert sorted(r["match_id"] for r in read_table(spark, target).collect()) == list(range(0, 510))


def test_append_with_new_column(spark, scratch):
    path = scratch("evolve")
    append_evolving(spark.createDataFrame([(1, "a")], "id LONG, x STRING"), path)
    append_evolving(spark.createDataFrame([(2, "b", 5.0)], "id LONG, x STRING, y DOUBLE"), path)
    assert rows(read_table(spark, path, merge_schema=True), "id", "x", "y") == [(1, "a", None), (2, "b", 5.0)]


def test_ledger_and_backlog(spark, scratch):
    path = scratch("ledger")
    ledger_append(spark.createDataFrame([(1,), (2,)], "match_id LONG"), path)
    ledger_append(spark.createDataFrame([(2,), (3,)], "match_id LONG"), path)
    done = read_ledger(spark, path)
    assert rows(done) == [(1,), (2,), (3,)]
    hist = spark.createDataFrame([(1,), (4,), (4,), (5,), (None,), (6,)], "match_id LONG")
    got = backlog(hist, done)
    # same as LEFT JOIN ... IS NULL + DISTINCT
    hist.createOrReplaceTempView("h")
    done.createOrReplaceTempView("d")
    ref = spark.sql("SELECT DISTINCT h.match_id FROM h LEFT JOIN d ON h.match_id = d.match_id WHERE d.match_id IS NULL")
    assert rows(got) == rows(ref) == [(4,), (5,), (6,), (None,)]
    assert rows(backlog_batch(got, 2)) == [(4,), (5,)]


def test_full_load_once(spark, scratch):
    base = scratch("db")
    calls = []

    def factory():
        calls.append(1)
        return spark.createDataFrame([(1,)], "match_id LONG")

    assert not table_exists(spark, "no_such_db_xyz", "t")
    assert full_load_once(spark, factory, "tp_test_db", "T1", location=base)
    assert not full_load_once(spark, factory, "tp_test_db", "t1", location=base)
    assert len(calls) == 1
    assert table_exists(spark, "TP_TEST_DB", "t1")


def test_compaction_makes_few_files_without_shuffle(spark, scratch):
    import glob

    from conftest import local_path
    from tidepool.sources.maintain import compact_table

    src, dst = scratch("small"), scratch("big")
    df = spark.range(0, 20000).selectExpr("id", "id % 7 AS g")
    df.repartition(40).write.parquet(src)
    n = compact_table(spark, src, dst, target_file_bytes=64 * 1024 * 1024)
    files = glob.glob(local_path(dst) + "/*.parquet")
    assert n == len(files) == 1
    assert rows(spark.read.parquet(dst)) == rows(df)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None  # settings restored


def test_pending_matches_and_checks(spark, scratch):
    from tidepool.plans.bronze import check_details, check_players, pending_matches

    hist, ledger = scratch("h"), scratch("l")
    append_evolving(listing(spark, 0, 30), hist)
    assert pending_matches(spark, hist, ledger).count() == 30  # no ledger yet
    ledger_append(spark.range(0, 25).selectExpr("id AS match_id"), ledger)
    assert rows(pending_matches(spark, hist, ledger, n=3)) == [(25,), (26,), (27,)]
    players = spark.range(0, 21).selectExpr("id DIV 10 AS match_id", "id AS account_id", "id % 10 AS player_slot")
    assert rows(check_players(players)) == [(2, 1)]
    assert rows(check_details(players)) == [(21, 3)]


def test_rows_frame_with_schema(spark):
    from tidepool.sources.tables import rows_frame

    page = [{"match_id": 1, "start_time": 10, "score": 3}, {"match_id": 2, "start_time": 20, "score": 2.5},
            {"match_id": 3, "extra": "x"}]
    df = rows_frame(spark, page, "match_id LONG, start_time LONG, score DOUBLE, patch LONG")
    assert rows(df) == [(1, 10, 3.0, None), (2, 20, 2.5, None), (3, None, None, None)]


def test_ingest_mode_switch_and_missing_target(spark, scratch):
    import pytest

    from tidepool.sources.ingest import read_cursor

    target = scratch("absent")
    assert read_cursor(spark, target, "match_id") == (None, None)
    with pytest.raises(ValueError):
        ingest(spark, listing(spark, 0, 3), target, mode="sideways")
    ingest(spark, listing(spark, 0, 50), target, mode="history", rows=20)
    assert sorted(r["match_id"] for r in read_table(spark, target).collect()) == list(range(30, 50))


def test_cursor_of_an_empty_folder_and_its_plan(spark, scratch):
    import os

    from conftest import local_path
    from tidepool.sources.ingest import read_cursor

    target = scratch("hollow")
    os.makedirs(local_path(target))  # what a failed first append leaves
    assert read_cursor(spark, target, "match_id") == (None, None)
    ingest_new(spark, listing(spark, 0, 5), target)
    assert read_cursor(spark, target, "match_id") == (0, 4)


def test_append_refuses_a_changed_type(spark, scratch):
    import pytest

    path = scratch("types")
    append_evolving(spark.createDataFrame([(1, "a")], "id LONG, x STRING"), path)
    with pytest.raises(TypeError, match="column x"):
        append_evolving(spark.createDataFrame([(2, 5)], "id LONG, x LONG"), path)
    assert rows(read_table(spark, path, merge_schema=True)) == [(1, "a")]


def test_compaction_keeps_columns_of_later_appends(spark, scratch):
    from tidepool.sources.maintain import compact_table

    src = scratch("evolved")
    for k in range(9):
        append_evolving(spark.createDataFrame([(k, "x")], "id LONG, x STRING"), src)
    append_evolving(spark.createDataFrame([(9, "y", 1.5)], "id LONG, x STRING, late DOUBLE"), src)
    for trial in range(4):
        dst = scratch(f"evolved{trial}")
        assert compact_table(spark, src, dst) == 1
        got = spark.read.parquet(dst)
        assert rows(got, "id", "late") == [(k, None) for k in range(9)] + [(9, 1.5)]


def test_compaction_keeps_partitions(spark, scratch):
    from tidepool.sources.maintain import compact_table, data_files, partition_columns

    src, dst = scratch("parts"), scratch("parts_dst")
    df = spark.range(0, 2000).selectExpr("id", "id % 3 AS a", "id % 2 AS b")
    df.repartition(8).write.partitionBy("a", "b").parquet(src)
    assert data_files(spark, src) == 48
    assert compact_table(spark, src, dst) == 6 == data_files(spark, dst)
    assert partition_columns(spark, dst) == ["a", "b"]
    assert rows(spark.read.parquet(dst), "id", "a", "b") == rows(df, "id", "a", "b")


def test_partitioned_player_table_has_few_files_per_folder(spark, scratch):
    from tidepool.sources.maintain import data_files
    from tidepool.sources.tables import create_database, replace_table

    base = scratch("rebalanced")
    create_database(spark, "tp_rebalanced", base)
    df = spark.range(0, 8000, 1, 8).selectExpr("id", "id % 40 AS mo")
    replace_table(df, "tp_rebalanced", "t", partition_by=["mo"])
    assert data_files(spark, f"{base}") <= 80
    assert rows(spark.table("tp_rebalanced.t"), "id", "mo") == rows(df, "id", "mo")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest

    from tidepool import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_text_files_go_through_the_file_system(spark, scratch):
    from tidepool.session import read_text, write_text

    path = scratch("note") + "/_hidden.json"
    write_text(spark, path, "{}")
    write_text(spark, path, "[1, \u00e9]")
    assert read_text(spark, path) == "[1, \u00e9]"
