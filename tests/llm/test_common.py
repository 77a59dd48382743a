from collections import Counter

from pyspark.sql import functions as F

from tidepool.llm import common


def wanted(rows, k):
    """The k smallest rows of each value, ranked one by one."""
    seen, out = Counter(), set()
    for v, i, h in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[2] % (1 << 52), r[2])):
        seen[v] += 1
        if seen[v] <= k:
            out.add((v, i, h))
    return out


def test_smallest_rows_of_hot_small_and_missing_values(spark):
    value = F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 997 == 1, None).when(F.col("id") == 5, "one").otherwise("hot")
    df = spark.range(20_000).select(value.alias("v"), "id", F.xxhash64("id").alias("h"))
    rows = [tuple(r) for r in df.collect()]
    for k in (1, 30, 500, 50_000):
        got = [tuple(r) for r in common.smallest(df, "v", "h", k).collect()]
        assert len(got) == len(set(got)) and set(got) == wanted(rows, k)
    assert common.smallest(df.where("id < 0"), "v", "h", 5).collect() == []


def test_equal_hashes_count_one_by_one(spark):
    df = spark.range(1000).select(F.lit("a").alias("v"), "id", F.lit(7).cast("long").alias("h"))
    assert common.smallest(df, "v", "h", 40).count() == 40


def test_rows_are_ranked_by_value_and_range(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("v"), "id", F.xxhash64("id").alias("h"))
    plan = common.smallest(df, "v", "h", 300)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # rows by value and range; by value alone only the counts of the ranges
    assert len(windows) == 2
    assert sum("row_number" in w and "_p" in w.split("row_number", 1)[1] for w in windows) == 1
    assert sum("sum(_c" in w for w in windows) == 1
