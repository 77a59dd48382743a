"""The physical plans have the shape the design relies on."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidepool.operators.backlog import backlog
from tidepool.operators.nested import explode_players
from tidepool.plans.features import entity_features
from tidepool.plans.onehot import draft_onehot
from tidepool.plans.standin import match_documents, player_rows
from tidepool.sources.tables import load


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")  # untruncated scan metadata
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_window_pushed_to_scan_and_no_expand(spark):
    p = plan(entity_features(player_rows(spark, SF_SMALL), ref="2001-08-01 00:00:00"))
    assert "GreaterThanOrEqual(o_orderdate,2001-02-02T00:00)" in p
    assert "LessThan(o_orderdate,2001-08-01T00:00)" in p
    assert "Expand" not in p  # no DISTINCT rewrite
    assert p.count("Exchange hashpartitioning") <= 3  # (entity, event), entity, lifetime entity


def test_one_hot_aggregates_bits_not_columns(spark):
    p = plan(draft_onehot(player_rows(spark, SF_SMALL), side="is_side_a", outcome="side_a_win",
                          ref="2001-08-01 00:00:00"))
    agg = [line for line in p.split("\n") if "HashAggregate" in line][0]
    assert agg.count("bit_or(") == 4 and "max(CASE" not in agg
    assert "GreaterThanOrEqual(o_orderdate,2001-02-01T00:00)" in p


def test_backlog_is_an_anti_join(spark):
    listing = load(spark, SF_SMALL, "orders").selectExpr("o_orderkey AS match_id")
    done = load(spark, SF_SMALL, "lineitem").selectExpr("l_orderkey AS match_id")
    p = plan(backlog(listing, done))
    assert "LeftAnti" in p and "LeftOuter" not in p


def test_explode_reads_only_named_fields(spark, scratch):
    path = scratch("docs")
    match_documents(spark, SF_SMALL).write.parquet(path)
    docs = spark.read.parquet(path)
    p = plan(explode_players(docs, fields=["account_id", "hero_id"]).select("account_id", "hero_id"))
    read = [line for line in p.split("\n") if "ReadSchema" in line][0]
    assert "struct<players:array<struct<account_id:bigint,hero_id:bigint,start_time:bigint>>>" in read


def test_day_partitions_pruned_and_same_result(spark, scratch):
    from conftest import rows
    from tidepool.plans.bronze import build_players
    from tidepool.sources.tables import create_database

    base = scratch("dayparts")
    create_database(spark, "tp_days", base)
    # documents of the last ~8 months only: a test-sized number of day folders
    recent = match_documents(spark, SF_SMALL).filter("start_time >= unix_timestamp(TIMESTAMP'2000-12-01 00:00:00')")
    recent.write.mode("overwrite").format("parquet").saveAsTable("tp_days.details")
    players = build_players(spark, "tp_days", "details", "players", ts_col="ts_match", day_col="dt_match")
    measures = [("vl_avg_kills", "kills"), ("avg_win_rate", "win")]
    kw = dict(ts="ts_match", measures=measures, ref="2001-08-01 00:00:00")
    pruned = entity_features(players, day_col="dt_match", **kw)
    p = plan(pruned)
    scan = [line for line in p.split("\n") if "PartitionFilters" in line and "dt_match" in line][0]
    assert "dt_match#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(pruned) == rows(entity_features(players, **kw))
    assert pruned.count() > 0
    text_form = entity_features(players, ts="td_match", measures=measures, ref="2001-08-01 00:00:00")
    assert rows(text_form) == rows(pruned)


def test_month_partitions_pruned_and_same_result(spark, scratch):
    from conftest import rows
    from tidepool.plans.bronze import build_players
    from tidepool.sources.tables import create_database

    create_database(spark, "tp_months", scratch("monthparts"))
    match_documents(spark, SF_SMALL).write.mode("overwrite").format("parquet").saveAsTable("tp_months.details")
    players = build_players(spark, "tp_months", "details", "players", ts_col="ts_match", day_col="mo_match",
                            period="month")
    measures = [("vl_avg_kills", "kills")]
    kw = dict(ts="ts_match", measures=measures, ref="2001-08-01 00:00:00")
    pruned = entity_features(players, day_col="mo_match", period="month", **kw)
    scan = [line for line in plan(pruned).split("\n") if "PartitionFilters" in line and "mo_match" in line][0]
    assert "mo_match#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(pruned) == rows(entity_features(players, **kw))
    onehot = draft_onehot(players, side="isRadiant", ts="ts_match", ref="2001-08-01 00:00:00",
                          day_col="mo_match", period="month")
    assert rows(onehot) == rows(draft_onehot(players, side="isRadiant", ts="ts_match", ref="2001-08-01 00:00:00"))


def test_long_match_comes_in_parts(spark, scratch):
    """One order of 1,000 lines: several documents, each with a key of its own."""
    from tidepool.plans import catalog
    from tidepool.plans.bronze import check_details

    base = scratch("long")
    for t in ("orders", "customer"):
        load(spark, SF_SMALL, t).write.parquet(f"{base}/{t}.parquet")
    li = load(spark, SF_SMALL, "lineitem")
    number = li.schema["l_linenumber"].dataType.simpleString()
    first = li.orderBy("l_orderkey", "l_linenumber").limit(1)
    long = first.crossJoin(spark.range(100, 1100).withColumnRenamed("id", "_n")).withColumn("l_linenumber", F.col("_n").cast(number)).drop("_n")
    li.unionByName(long).write.parquet(f"{base}/lineitem.parquet")
    docs = match_documents(spark, base)
    check = check_details(docs).first()
    assert check["n_rows"] == check["n_distinct_keys"] > 1500
    assert docs.selectExpr("max(size(players)) AS n").first()["n"] <= 64
    assert explode_players(docs).count() == 7000
    assert catalog.QUERIES["check_details"](spark, base).first() == check
    assert catalog.QUERIES["stream_bronze_players"](spark, base).count() == 7000


def test_side_is_broadcast_by_its_rows_not_its_file(spark, monkeypatch):
    """A threshold between the bytes of the orders' packed keys and of their rows:
    the driver must not gather them."""
    from tidepool import session
    from tidepool.plans import catalog

    monkeypatch.setitem(session.RUNTIME_CONF, "spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        for name in ("check_group_size", "explode_players"):
            p = plan(catalog.QUERIES[name](spark, SF_SMALL))
            assert "[o_orderkey" in p.split("SortMergeJoin [l_orderkey")[1].split("\n")[0]
            assert not any("BroadcastHashJoin [l_orderkey" in line for line in p.split("\n"))
    finally:
        monkeypatch.undo()
        session.configure(spark)
