import zlib
from collections import Counter

from pyspark.sql import functions as F

from llm_data import EDGE_TEXTS, SMALL, documents, empty
from tidepool.llm import sharding
from tidepool.llm.queries import QUERIES


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)


def test_permutation_is_whole_and_invertible():
    for n in (1, 2, 3, 5, 40, 41, 1000, 1025):
        places = [sharding.place_of(g, n, 40) for g in range(n)]
        assert sorted(p * 40 + s for s, p in places) == list(range(n))
        assert all(sharding.row_at(s, p, n, 40) == g for g, (s, p) in enumerate(places))


def test_column_form_equals_the_plain_one(spark):
    for n in (1, 7, 1000, 70_000):
        rows = spark.range(0, min(n, 500)).select("id", sharding.permuted(F.col("id"), n).alias("p")).collect()
        assert all((r["p"] % 40, r["p"] // 40) == sharding.place_of(r["id"], n, 40) for r in rows)


def test_seeds_and_order(spark):
    a = [sharding.place_of(g, 1000, 40, seed=1) for g in range(1000)]
    assert a != [sharding.place_of(g, 1000, 40, seed=2) for g in range(1000)]
    # neighbours are spread over the shards
    assert len({s for s, _ in a[:100]}) > 30


def test_plan_over_edge_texts(spark):
    rows = sharding.shard_plan(documents(spark, EDGE_TEXTS), shards=4).collect()
    check(rows, EDGE_TEXTS, 4)
    for r in rows:
        raw = (EDGE_TEXTS[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        assert (r["shard"], r["slot"]) == sharding.place_of(r["row_number"], len(EDGE_TEXTS), 4)


def test_row_numbers_do_not_depend_on_the_layout(spark):
    df = documents(spark, [f"t{k}" for k in range(500)])
    plain = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_plan(df).collect()}
    dealt = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_plan(df.repartition(7)).collect()}
    assert plain == dealt


def test_repeated_rows_null_ids_empty_table(spark):
    df = documents(spark, ["same"]).withColumn("doc_id", F.lit(None).cast("long"))
    many = df.join(spark.range(0, 300).select(F.lit(1).alias("row_number"))).selectExpr("*", "2 AS shard", "3 AS _p", "4 AS _part")
    check(sharding.shard_plan(many, shards=7).collect(), range(300), 7)
    assert sharding.shard_plan(empty(spark)).collect() == []


def test_query_covers_the_table(spark):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    df = QUERIES["op10_sharding"](spark, SMALL)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    check(df.collect(), texts, 40)
