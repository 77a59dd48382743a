"""Features from monthly partial aggregates equal those from all rows."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidepool.plans.features import entity_features
from tidepool.plans.state import features_from_state, fold_batch, whole_months
from tidepool.functions.time import as_reference

MEASURES = [("avg_a", "a"), ("avg_b", "b")]
SCHEMA = "account_id BIGINT, match_id BIGINT, lane_role BIGINT, a BIGINT, b DOUBLE, td_match TIMESTAMP"


def players(spark, n=1500, seed=3):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        account = r.choice([None, None, 1, *range(2, 25)])
        match = r.choice([None, *range(1, 90), 10**12 + r.randint(0, 9), -r.randint(1, 70)])
        day = f"20{r.choice(['00', '01'])}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d} {r.randint(0, 23):02d}:00:00"
        out.append((account, match, r.randint(1, 5), r.choice([None, r.randint(0, 99)]), r.choice([None, 0.25 * r.randint(0, 9)]), None if r.random() < 0.02 else day))
    df = spark.createDataFrame(out + out[:200], SCHEMA.replace("TIMESTAMP", "STRING"))
    return df.withColumn("td_match", F.col("td_match").cast("timestamp"))


def same(a, b):
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in t) for t in rows(a)] == [
        tuple(round(x, 9) if isinstance(x, float) else x for x in t) for t in rows(b, *a.columns)]


@pytest.fixture(scope="module")
def kept(spark):
    from tidepool.session import scratch_path

    base = scratch_path(spark, "state")
    players(spark).withColumn("mo", F.trunc("td_match", "month")).write.partitionBy("mo").parquet(f"{base}/players")
    table = spark.read.parquet(f"{base}/players")
    for name, cond in (("a", "td_match < TIMESTAMP'2000-09-10'"), ("b", "td_match BETWEEN TIMESTAMP'2000-09-10' AND TIMESTAMP'2001-05-05 11:00:00'"), ("c", "td_match > TIMESTAMP'2001-05-05 11:00:00'")):
        fold_batch(table.where(cond), f"{base}/state", name, measures=MEASURES)
    return table, f"{base}/state"


@pytest.mark.parametrize("ref", ["2001-08-01 00:00:00", "2001-07-16 05:00:00", "2001-03-31 12:00:00", "2001-03-01", "2000-02-10 00:00:00"])
def test_equals_the_features_of_all_rows(spark, kept, ref):
    table, state = kept
    for month_col in ("mo", None):
        got = features_from_state(spark, state, table, measures=MEASURES, ref=ref, month_col=month_col)
        assert same(entity_features(table, measures=MEASURES, ref=ref), got), (ref, month_col)


def test_a_batch_that_is_folded_again_counts_once(spark, kept):
    table, state = kept
    fold_batch(table.where("td_match > TIMESTAMP'2001-05-05 11:00:00'"), state, "c", measures=MEASURES)
    assert same(entity_features(table, measures=MEASURES, ref="2001-08-01"), features_from_state(spark, state, table, measures=MEASURES, ref="2001-08-01"))


def test_only_edge_months_are_read_from_the_rows(spark, kept):
    table, state = kept
    assert whole_months(as_reference("2001-08-01"), 6) == (as_reference("2001-03-01").date(), as_reference("2001-08-01").date())
    df = features_from_state(spark, state, table, measures=MEASURES, ref="2001-07-16", month_col="mo")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    scans = [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
    own = [x for x in scans if "/players" in x]
    assert own and all("PartitionFilters: [" in x and "mo#" in x.split("PartitionFilters: [")[1] for x in own)
    assert "2001-02-01" in own[0] and "2001-07-01" in own[0]
