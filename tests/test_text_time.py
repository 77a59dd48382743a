"""Windows on a time column kept as text."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidepool.functions.time import window_filter
from tidepool.operators.backlog import id_cursor, id_cursor_from_files

FORMS = ["{:%Y-%m-%d %H:%M:%S}", "{:%Y-%m-%d}", " {:%Y-%m-%d %H:%M:%S} ", "{:%Y-%m-%dT%H:%M:%S}Z", "{:%Y-%m-%d %H:%M:%S}+14:00", "{:%Y-%m-%d %H:%M:%S}-11:30", "+{:%Y-%m-%d}", "0{:%Y-%m-%d}",
         "{:%Y-%m}", "{:%Y}", "{:%Y-%m-%d %H:%M:%S.%f}", "{0.year}-{0.month}-{0.day}", "{0.year}-{0.month}-{0.day} {0.hour}:{0.minute}", "{0.year}-{0.month:02d}-{0.day}", "{0.year}-{0.month}"]
BAD = [None, "", " ", "null", "2001-13-01", "2001-06-31", "20010601", "2001/06/01", "June 2001", "99999-01-01", "2001-06-15x", "~", "é"]


def table(spark):
    first = dt.datetime(2000, 6, 1, 3, 4, 5)
    days = [first + dt.timedelta(days=3 * k, hours=5 * k) for k in range(240)]
    return spark.createDataFrame([(f.format(d),) for d in days for f in FORMS] + [(b,) for b in BAD], "td_match STRING")


@pytest.mark.parametrize("ref", ["2001-08-01 00:00:00", "2001-07-16 05:06:07", "2001-12-31 23:59:59", "2001-01-01 00:00:00", "2001-09-30 12:00:00", "2002-02-28 00:00:00"])
def test_same_rows_as_the_parsed_form(spark, ref):
    df, at = table(spark), dt.datetime.fromisoformat(ref)
    parsed = df.withColumn("ts", F.try_to_timestamp("td_match"))
    for closed in (False, True):
        for end in (False, True):
            args = dict(ref=at, months=6, start_inclusive=closed, end_exclusive=end)
            want = parsed.where(window_filter(parsed, "ts", **args)).select("td_match")
            assert rows(df.where(window_filter(df, "td_match", **args))) == rows(want)
            assert want.count() > 50


def test_bounds_are_pushed_to_the_scan(spark, scratch):
    path = scratch("text")
    table(spark).write.parquet(path)
    df = spark.read.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    at = dt.datetime(2001, 8, 1)
    p = df.where(window_filter(df, "td_match", at, 6, start_inclusive=False, end_exclusive=True))._jdf.queryExecution().executedPlan().toString()
    pushed = p.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(td_match,2001-02)" in pushed or "GreaterThanOrEqual(td_match,2001-02-01)" in pushed
    assert "LessThan(td_match,2001-09)" in pushed


def test_id_cursor_reads_statistics_only(spark, scratch):
    path = scratch("ids")
    df = spark.range(5, 5000).selectExpr("CASE WHEN id % 7 > 0 THEN id END AS match_id", "id AS other")
    df.repartition(3).write.parquet(path)
    got = id_cursor_from_files(spark, path)
    assert "PushedAggregation: [MIN(match_id), MAX(match_id)]" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(id_cursor(df))
    spark.createDataFrame([(None,)], "match_id BIGINT").write.parquet(path + "_null")
    assert rows(id_cursor_from_files(spark, path + "_null")) == [(None, None)]
