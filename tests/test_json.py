import os

from pyspark.sql import types as T

from conftest import local_path, rows
from pyspark.sql import functions as F

from tidepool.operators.nested import explode_items, explode_players, flatten_structs, nest_rows
from tidepool.sources.json_docs import parse_json_column, read_json_docs, schema_from_json, schema_to_json

PLAYER = T.StructType([
    T.StructField("account_id", T.LongType()),
    T.StructField("kda", T.LongType()),
    T.StructField("stuns", T.StringType()),
    T.StructField("start_time", T.LongType()),
])
DOC = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("radiant_win", T.BooleanType()),
    T.StructField("league", T.StructType([T.StructField("leagueid", T.LongType()),
                                          T.StructField("name", T.StringType())])),
    T.StructField("players", T.ArrayType(PLAYER, True)),
])


def write_docs(path, docs):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    for i, text in enumerate(docs):
        with open(os.path.join(p, f"part-{i}.json"), "w") as fh:
            fh.write(text + "\n")


def test_permissive_fixed_schema(spark, scratch):
    d = scratch("json")
    write_docs(d, [
        '{"match_id": 1, "radiant_win": true, "extra": 5, "players": ['
        '{"account_id": 10, "kda": 3.5, "stuns": 1.25, "start_time": 0}, '
        '{"account_id": 11, "kda": 2, "stuns": "x", "start_time": 60}]}',
        '{"match_id": 2, "league": {"leagueid": 7, "name": "L"}}',
        '{bad json',
    ])
    raw = spark.read.schema(DOC).json(d)
    assert raw.count() == 3  # the broken file is one all-NULL row
    docs = read_json_docs(spark, d, DOC, key="match_id")
    got = {r["match_id"]: r for r in docs.collect()}
    assert set(got) == {1, 2}  # broken row removed by the key filter
    p = got[1]["players"]
    assert p[0]["kda"] is None and p[0]["account_id"] == 10  # wrong type: that field only
    assert p[0]["stuns"] == "1.25"  # number read as string keeps its text
    assert p[1]["kda"] == 2
    assert got[2]["players"] is None and got[2]["league"]["leagueid"] == 7  # missing key -> NULL
    assert "extra" not in docs.columns  # unknown key dropped

    flat = explode_players(docs)
    assert rows(flat, "account_id", "td_match") == [(10, "1970-01-01 00:00:00"), (11, "1970-01-01 00:01:00")]
    pruned = explode_players(docs, fields=["account_id"])
    assert rows(pruned, "account_id", "td_match") == rows(flat, "account_id", "td_match")


def test_explode_empty_and_null_arrays(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, [(5, None, None, 1)])], T.StructType([
        T.StructField("match_id", T.LongType()), T.StructField("players", T.ArrayType(PLAYER))]))
    out = explode_items(df, keep=["match_id"])
    assert rows(out, "match_id", "account_id") == [(3, 5)]


def test_from_json_column_same_as_scan(spark):
    df = spark.createDataFrame([('{"match_id": 1, "players": [{"account_id": 3}]}',), ("{bad",)], "value STRING")
    out = parse_json_column(df, "value", DOC, alias="doc").select("doc.match_id", "doc.players")
    got = sorted(out.collect(), key=lambda r: r["match_id"] is None)
    assert got[0]["match_id"] == 1 and got[0]["players"][0]["account_id"] == 3
    assert got[1]["match_id"] is None


def test_schema_file_roundtrip(spark, scratch):
    path = scratch("schema") + "/s.json"
    schema_to_json(DOC, path, spark)
    assert schema_from_json(path, spark) == DOC


def test_flatten_structs(spark):
    df = spark.createDataFrame([(1, (7, "L"))], "match_id LONG, league STRUCT<leagueid: LONG, name: STRING>")
    assert flatten_structs(df, ["league"], keep=["match_id"]).columns == ["match_id", "league_leagueid", "league_name"]
    assert flatten_structs(df, ["league"], prefix=False).collect()[0].asDict() == {"leagueid": 7, "name": "L"}


def test_nest_rows_splits_hot_key(spark, monkeypatch):
    from tidepool.operators import nested

    monkeypatch.setattr(nested, "ROWS_PER_BLOCK", 200)
    df = spark.range(0, 1000).selectExpr("CASE WHEN id < 900 THEN 1 ELSE id END AS k", "struct(id DIV 2 AS v) AS v")
    out = nest_rows(df, key="k", part="part", item="v", array="vs", size=64)
    hot = out.filter("k = 1").collect()
    assert sum(len(r["vs"]) for r in hot) == 900 and max(len(r["vs"]) for r in hot) <= 64
    assert len({r["part"] for r in hot}) == len(hot) >= 15
    assert [r["part"] for r in out.filter("k <> 1").collect()] == [0] * 100
    assert rows(out.selectExpr("k", "explode(vs) AS v")) == rows(df)


def test_order_of_a_thousand_lines_becomes_documents_of_bounded_size(spark, scratch):
    from conftest import SF_SMALL
    from tidepool.plans.standin import PLAYERS_PER_PART, match_documents
    from tidepool.sources.tables import load

    base = scratch("thousand")
    for t in ("orders", "customer"):
        load(spark, SF_SMALL, t).write.parquet(f"{base}/{t}.parquet")
    li = load(spark, SF_SMALL, "lineitem")
    key = li.agg({"l_orderkey": "min"}).first()[0]
    li.withColumn("l_orderkey", F.when(li.l_partkey % 5 == 0, key).otherwise(li.l_orderkey)).write.parquet(f"{base}/lineitem.parquet")
    docs = match_documents(spark, base)
    sizes = docs.filter(F.col("match_id") == key).select("part", F.size("players").alias("n")).collect()
    assert sum(r["n"] for r in sizes) > 1000 and max(r["n"] for r in sizes) <= PLAYERS_PER_PART and len({r["part"] for r in sizes}) == len(sizes)
    assert explode_players(docs).count() == li.count()


def test_document_schema_file_matches_documents(spark):
    from conftest import SF_SMALL
    from tidepool.plans.standin import match_documents
    from tidepool.sources.json_docs import match_document_schema

    fixed = {f.name: f.dataType.simpleString() for f in match_document_schema().fields}
    assert fixed == {f.name: f.dataType.simpleString() for f in match_documents(spark, SF_SMALL).schema.fields}


def test_land_json_compressed_roundtrip(spark, scratch):
    from tidepool.sources.json_docs import land_json

    path = scratch("gz")
    df = spark.createDataFrame([(1, (7, "L"), [(10, None, "1.5", 0)])],
                               "match_id LONG, league STRUCT<leagueid: LONG, name: STRING>, players " +
                               "ARRAY<STRUCT<account_id: LONG, kda: LONG, stuns: STRING, start_time: LONG>>")
    land_json(df, path, compression="gzip")
    back = read_json_docs(spark, path, DOC, key="match_id")
    r = back.collect()[0]
    assert r["league"]["name"] == "L" and r["players"][0]["stuns"] == "1.5" and r["radiant_win"] is None


def test_rows_that_lie_by_the_key_are_nested_without_a_shuffle(spark):
    """No key is large: the rows stay where they are, also for a join on the key."""
    df = spark.range(0, 3000).selectExpr("id % 700 AS k", "struct(id AS v) AS v").repartition(5, "k")
    out = nest_rows(df, key="k", part="part", item="v", array="vs", size=64)
    got = out.collect()
    assert len(got) == 700 and sum(len(r["vs"]) for r in got) == 3000
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "collect_list(v" in final and "Union" not in final
    assert final.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in final


def test_null_keys_are_nested_and_large_ones_dealt(spark, monkeypatch):
    from tidepool.operators import nested

    monkeypatch.setattr(nested, "ROWS_PER_BLOCK", 50)
    df = spark.range(0, 400).selectExpr("CASE WHEN id < 300 THEN NULL WHEN id < 310 THEN 1 ELSE id END AS k", "struct(id AS v) AS v")
    out = nest_rows(df, key="k", part="part", item="v", array="vs", size=16)
    assert rows(out.selectExpr("k", "explode(vs) AS v")) == rows(df)
    nulls = out.where("k IS NULL").collect()
    assert len({r["part"] >> 20 for r in nulls}) == 6 and max(len(r["vs"]) for r in nulls) <= 16
    assert [r["part"] for r in out.where("k = 1").collect()] == [0]
