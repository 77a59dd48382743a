from pyspark.sql import types as T

from conftest import rows
from tidepool.operators.quality import group_size, uniqueness


def test_group_size_lists_offenders(spark):
    data = [(1, i, i) for i in range(9)] + [(2, i, i) for i in range(10)] + [(3, i, i) for i in range(11)]
    data += [(2, None, 99), (2, 98, None)]  # not counted: NULL account / slot
    schema = "match_id LONG, account_id LONG, player_slot LONG"
    df = spark.createDataFrame(data, schema)
    out = group_size(df, "match_id", 10, not_null=["account_id", "PLAYER_SLOT"])
    assert rows(out) == [(1, 9), (3, 11)]


def test_uniqueness(spark):
    schema = T.StructType([T.StructField("k", T.LongType())])
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], schema)
    assert rows(uniqueness(df, "k")) == [(4, 2)]
    assert rows(uniqueness(df.limit(0), "k")) == [(0, 0)]
