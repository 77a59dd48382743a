"""Tables are replaced without a gap; ledgers and tables in buckets."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidepool.operators.bucketed import append_bucketed, bucket_count, merge_bucketed, merged_rows, pending_ids, write_bucketed
from tidepool.operators.upsert import upsert
from tidepool.sources import tables
from tidepool.sources.tables import create_database, replace_table, table_exists


@pytest.fixture()
def db(spark, scratch):
    import uuid

    name = f"pub_{uuid.uuid4().hex[:8]}"
    create_database(spark, name, scratch(name))
    return name


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_failing_query_leaves_the_old_rows(spark, db):
    replace_table(spark.range(3), db, "t")
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        replace_table(bad, db, "t")
    assert spark.table(f"{db}.t").count() == 3
    assert replace_table(spark.range(7), db, "t").count() == 7


def test_query_may_read_the_table_that_it_replaces(spark, db):
    replace_table(spark.range(3), db, "t")
    assert rows(replace_table(spark.table(f"{db}.t").selectExpr("id + 10 AS id", "'x' AS more"), db, "t")) == [(10, "x"), (11, "x"), (12, "x")]


def test_crash_between_write_and_publish(spark, db, monkeypatch):
    replace_table(spark.range(3), db, "t")
    with monkeypatch.context() as m:
        m.setattr(tables, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError, match="crash"):
            replace_table(spark.range(9), db, "t")
    assert table_exists(spark, db, "t") and spark.table(f"{db}.t").count() == 3
    for n in (4, 5, 6):
        replace_table(spark.range(n), db, "t")
    assert spark.table(f"{db}.t").count() == 6
    # the shown version and one before it stay
    assert len(tables._versions(spark, db, "t")) == 2


def test_plain_table_of_the_name_is_taken_over(spark, db):
    spark.range(2).write.saveAsTable(f"{db}.t")
    assert replace_table(spark.range(4), db, "t", partition_by=None).count() == 4


def test_text_file_is_replaced_in_one_step(spark, scratch):
    from tidepool.session import read_text, write_text

    path = scratch("text") + "/note.json"
    for body in ("{}", "[1]"):
        write_text(spark, path, body)
        assert read_text(spark, path) == body


def test_ledger_in_buckets_is_not_shuffled(spark, db):
    append_bucketed(spark.range(0, 1000).toDF("match_id"), db, "listing", "match_id", expected_bytes=1 << 30)
    append_bucketed(spark.range(0, 400).toDF("match_id"), db, "ledger", "match_id", expected_bytes=1 << 30)
    append_bucketed(spark.range(300, 900).toDF("match_id"), db, "ledger", "match_id")
    assert bucket_count(spark, f"{db}.ledger") == 4
    df = pending_ids(spark, db, "listing", "ledger")
    assert "Exchange" not in plan(df) and "LeftAnti" in plan(df)
    assert rows(df) == [(k,) for k in range(900, 1000)]


def test_merge_leaves_the_tables_rows_in_their_buckets(spark, db):
    old = spark.range(0, 500).selectExpr("CASE WHEN id < 490 THEN id END AS k", "id AS v")
    new = spark.range(400, 600).selectExpr("CASE WHEN id < 590 THEN id END AS k", "-id AS v", "'n' AS extra")
    merge_bucketed(old, db, "t", "k", expected_bytes=1 << 30)
    df = merged_rows(new, db, "t", "k", None, 4)
    assert "Bucketed: true" in plan(df) and "SelectedBucketsCount: 4 out of 4" in plan(df)
    # nothing between the old table's scan and the join shuffles it
    old_side = plan(df).split("LeftAnti")[1].split("FileScan")[0]
    assert "Exchange" not in old_side and "Sort [k" in old_side
    out = merge_bucketed(new, db, "t", "k")
    assert rows(out.select("k", "v", "extra")) == rows(upsert(old, new, "k").select("k", "v", "extra"))
    again = merge_bucketed(new, db, "t", "k")
    assert again.where("k IS NOT NULL").count() == 590 and again.where("k IS NULL").count() == 30


def test_new_bucketed_table_needs_no_expected_size(spark, db):
    write_bucketed(spark.range(3).toDF("k"), f"{db}.one", "k", 1)
    assert bucket_count(spark, f"{db}.one") == 1
    with pytest.raises(ValueError, match="not bucketed"):
        spark.range(3).write.saveAsTable(f"{db}.plain")
        bucket_count(spark, f"{db}.plain")


@pytest.mark.parametrize(("name", "table"), [("merge_bucketed", "orders"), ("pending_bucketed", "lineitem")])
def test_buckets_are_counted_by_the_rows_in_memory(spark, monkeypatch, name, table):
    """A file that is as large as a bucket may be: its rows, sorted in memory, are several."""
    from conftest import SF_SMALL
    from tidepool.operators import upsert as upsert_module
    from tidepool.plans import catalog
    from tidepool.session import path_bytes

    monkeypatch.setattr(upsert_module, "BUCKET_BYTES", path_bytes(spark, f"{SF_SMALL}/{table}.parquet"))
    df = catalog.QUERIES[name](spark, SF_SMALL)
    assert len({f.rsplit("_", 1)[1] for f in df.inputFiles()}) == 8
