import datetime as dt

import pytest
from pyspark.sql import types as T

from conftest import SF_SMALL, rows
from tidepool.plans.features import PLAYER_MEASURES, entity_features, entity_lifetime
from tidepool.plans.standin import player_rows

REF = "2001-08-01 00:00:00"

SCHEMA = T.StructType([
    T.StructField("account_id", T.LongType()),
    T.StructField("match_id", T.LongType()),
    T.StructField("lane_role", T.LongType()),
    T.StructField("kills", T.LongType()),
    T.StructField("td_match", T.TimestampNTZType()),
])
MEASURES = [("vl_avg_kills", "kills")]


def feats(spark, data, **kw):
    df = spark.createDataFrame(data, SCHEMA)
    return {r["account_id"]: r for r in entity_features(df, measures=MEASURES, ref=REF, **kw).collect()}


def test_null_account_is_one_group_share_above_one(spark):
    t = dt.datetime(2001, 7, 1)
    out = feats(spark, [(None, 7, 1, 3, t), (None, 7, 1, 5, t), (1, 8, 2, 1, t)])
    assert out[None]["qt_matches"] == 1
    assert out[None]["pctg_lane_role_1"] == 2.0  # rows / distinct matches
    assert out[None]["tq_days_first_match"] == 0  # NULL never joins: COALESCEd
    assert out[None]["vl_avg_kills"] == 4.0
    assert out[1]["tq_days_first_match"] == 31


def test_all_null_matches_give_zero_not_error(spark):
    t = dt.datetime(2001, 7, 1)
    out = feats(spark, [(5, None, 1, 3, t), (5, None, 2, 1, t)])
    r = out[5]
    assert r["qt_matches"] == 0
    assert r["tq_match_month"] == pytest.approx(0.0)  # 0 matches / 1 month
    assert r["pctg_lane_role_1"] == 0 and r["pctg_lane_role_2"] == 0  # zero divisor -> 0
    assert r["vl_avg_kills"] == 2.0


def test_window_bounds_open_both_ends(spark):
    start = dt.datetime(2001, 2, 1)  # add_months(ref, -6) exactly
    out = feats(spark, [
        (1, 1, 1, 1, start),  # on the start: DATE(t) > start is false
        (1, 2, 1, 1, start + dt.timedelta(hours=23)),  # same date: out
        (1, 3, 1, 1, dt.datetime(2001, 2, 2)),  # next day: in
        (1, 4, 1, 1, dt.datetime(2001, 8, 1)),  # at ref: out
        (1, 5, 1, 1, dt.datetime(2001, 7, 31, 23, 59, 59)),  # just before ref: in
    ])
    assert out[1]["qt_matches"] == 2
    assert out[1]["qt_days_last_match"] == 1
    assert out[1]["tq_days_first_match"] == 181  # lifetime reads the whole history
    assert out[1]["tq_match_month"] == 1.0  # Feb and Jul -> 2 months, 2 matches


def test_string_time_column_matches_timestamp(spark):
    data = [(1, 1, 1, 2, dt.datetime(2001, 3, 5, 10)), (1, 2, 3, 4, dt.datetime(2001, 6, 1)),
            (2, 3, 4, 6, dt.datetime(2000, 1, 1))]
    df = spark.createDataFrame(data, SCHEMA)
    as_text = df.selectExpr("account_id", "match_id", "lane_role", "kills",
                            "date_format(td_match, 'yyyy-MM-dd HH:mm:ss') AS td_match")
    a = entity_features(df, measures=MEASURES, ref=REF)
    b = entity_features(as_text, measures=MEASURES, ref=REF)
    assert rows(a) == rows(b)


def test_no_distinct_plan_equals_distinct_sql(spark):
    """Cross-form: the DISTINCT-based SQL of the feature query in Spark."""
    pm = player_rows(spark, SF_SMALL)
    pm.createOrReplaceTempView("pm_small")
    avgs = ", ".join(f"AVG({src}) AS {name}" for name, src in PLAYER_MEASURES)
    roles = ", ".join(
        f"SUM(CASE WHEN lane_role = {r} THEN 1 ELSE 0 END) / COUNT(DISTINCT match_id) AS pctg_lane_role_{r}"
        for r in (1, 2, 3, 4))
    ref = "TIMESTAMP_NTZ'2001-08-01 00:00:00'"
    one_level = spark.sql(f"""
      WITH s AS (
        SELECT account_id, COUNT(DISTINCT match_id) AS qt_matches,
               MIN(datediff({ref}, td_match)) AS qt_days_last_match,
               COUNT(DISTINCT match_id) / COUNT(DISTINCT month(td_match)) AS tq_match_month,
               COUNT(DISTINCT match_id) / 6 AS tq_match_month_6, {avgs}, {roles}
        FROM pm_small
        WHERE td_match > add_months({ref}, -6) AND td_match < {ref}
        GROUP BY account_id),
      l AS (SELECT account_id, MAX(datediff({ref}, td_match)) AS tq_days_first_match FROM pm_small GROUP BY 1)
      SELECT s.*, COALESCE(l.tq_days_first_match, 0) AS tq_days_first_match
      FROM s LEFT JOIN l ON s.account_id = l.account_id""")
    ours = entity_features(pm, ref=REF).drop("dt_ref")
    cols = sorted(ours.columns)

    def rounded(df):
        return sorted(tuple(round(float(r[c]), 9) if r[c] is not None else None for c in cols)
                      for r in df.select(*cols).collect())

    assert rounded(ours) == rounded(one_level)
    assert ours.count() > 0


def test_lifetime_alone(spark):
    df = spark.createDataFrame([(1, 1, 1, 1, dt.datetime(2001, 7, 31)), (1, 2, 1, 1, dt.datetime(2001, 7, 1))], SCHEMA)
    assert rows(entity_lifetime(df, ref=REF)) == [(1, 31)]


def test_long_window_counts_calendar_months(spark):
    data = [(1, 1, 1, 1, dt.datetime(2000, 3, 5)), (1, 2, 1, 1, dt.datetime(2001, 3, 5)),
            (1, 3, 1, 1, dt.datetime(2001, 3, 9)), (2, 4, 1, 1, dt.datetime(2001, 5, 1)),
            (None, 5, 1, 1, dt.datetime(2000, 6, 1)), (None, 6, 1, 1, dt.datetime(2001, 6, 1))]
    yearly = feats(spark, data, months=24, calendar_months=True)
    assert yearly[1]["tq_match_month"] == 1.5  # 3 matches over 2 calendar months
    assert yearly[None]["tq_match_month"] == 1.0  # the NULL account group counts its months too
    assert yearly[1]["tq_match_month_24"] == 3 / 24
    folded = feats(spark, data, months=24)
    assert folded[1]["tq_match_month"] == 3.0  # month-of-year folds March 2000 and 2001
    assert yearly[2]["tq_match_month"] == 1.0


def test_unparsable_text_time_is_skipped(spark):
    df = spark.createDataFrame([(1, 1, 1, 2, "2001-07-01 00:00:00"), (1, 2, 1, 4, "not a time")],
                               "account_id LONG, match_id LONG, lane_role LONG, kills LONG, td_match STRING")
    out = entity_features(df, measures=MEASURES, ref=REF).collect()
    assert [(r["account_id"], r["qt_matches"], r["vl_avg_kills"]) for r in out] == [(1, 1, 2.0)]


def test_reference_instant_forms():
    from tidepool.functions.time import as_reference, months_back

    assert as_reference("2001-08-01 00:00:00") == dt.datetime(2001, 8, 1)
    assert as_reference(dt.date(2001, 8, 1)) == dt.datetime(2001, 8, 1)
    assert as_reference(None) <= dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert months_back(dt.datetime(2001, 8, 31), 6) == dt.date(2001, 2, 28)  # clamps like add_months
    assert months_back(dt.datetime(2000, 8, 31), 6) == dt.date(2000, 2, 29)
    assert months_back(dt.datetime(2001, 3, 15), 12) == dt.date(2000, 3, 15)


def test_months_back_equals_spark_add_months(spark):
    import random

    from tidepool.functions.time import months_back

    rnd = random.Random(7)
    cases = [(dt.date(1990, 1, 1) + dt.timedelta(days=rnd.randrange(0, 15000)), rnd.randrange(0, 40))
             for _ in range(300)]
    cases += [(dt.date(2001, m, 28 + k), n) for m in (1, 3, 5, 7, 8, 10, 12) for k in range(4) for n in (1, 6, 12)
              if (dt.date(2001, m, 1) + dt.timedelta(days=27 + k)).month == m]
    df = spark.createDataFrame(cases, "d DATE, n INT").selectExpr("d", "n", "add_months(d, -n) AS back")
    for r in df.collect():
        assert months_back(dt.datetime(r["d"].year, r["d"].month, r["d"].day), r["n"]) == r["back"], r


def test_first_seen_table_gives_the_same_lifetime(spark):
    from tidepool.plans.features import entity_first_seen, merge_first_seen

    pm = player_rows(spark, SF_SMALL)
    whole = entity_features(pm, ref=REF)
    old = pm.filter("td_match < TIMESTAMP_NTZ'1999-01-01 00:00:00'")
    new = pm.filter("td_match >= TIMESTAMP_NTZ'1999-01-01 00:00:00'")
    seen = merge_first_seen(entity_first_seen(old), new)
    assert seen.count() == pm.select("account_id").distinct().count()
    assert rows(entity_features(pm, ref=REF, first_seen=seen)) == rows(whole)
    assert rows(entity_lifetime(pm, ref=REF)) == rows(entity_lifetime(first_seen=seen, ref=REF))


def test_hot_entity_and_hot_pair_give_exact_results(spark):
    """A third of the rows on one account (and a big share on one of its
    matches, plus NULL keys) -- the plan without DISTINCT equals the SQL form."""
    base = spark.range(0, 30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 7 = 0 THEN NULL ELSE id % 500 END AS account_id",
        "CASE WHEN id % 6 = 0 THEN 42 WHEN id % 11 = 0 THEN NULL ELSE id % 4000 END AS match_id",
        "id % 5 AS lane_role", "id % 13 AS kills",
        "timestamp_ntz'2001-02-02 00:00:00' + make_interval(0, 0, 0, CAST(id % 170 AS INT)) AS td_match",
    )
    base.createOrReplaceTempView("hot_rows")
    ref = "TIMESTAMP_NTZ'2001-08-01 00:00:00'"
    sql = spark.sql(f"""
      SELECT account_id, COUNT(DISTINCT match_id) AS qt_matches, AVG(kills) AS vl_avg_kills,
             COALESCE(SUM(CASE WHEN lane_role = 1 THEN 1 ELSE 0 END) / COUNT(DISTINCT match_id), 0) AS pctg_lane_role_1,
             COALESCE(COUNT(DISTINCT match_id) / COUNT(DISTINCT month(td_match)), 0) AS tq_match_month
      FROM hot_rows WHERE td_match > add_months({ref}, -6) AND td_match < {ref} GROUP BY account_id""")
    ours = entity_features(base, measures=MEASURES, ref=REF).select(
        "account_id", "qt_matches", "vl_avg_kills", "pctg_lane_role_1", "tq_match_month")

    def rounded(df):
        return sorted((tuple(round(float(v), 9) if v is not None else None for v in r) for r in df.collect()),
                      key=repr)

    assert rounded(ours) == rounded(sql)


def test_date_typed_time_column(spark):
    data = [(1, 1, 1, 2, dt.datetime(2001, 2, 1)), (1, 2, 1, 4, dt.datetime(2001, 2, 2)),
            (1, 3, 2, 6, dt.datetime(2001, 7, 31)), (2, 4, 1, 8, dt.datetime(2001, 8, 1))]
    ts_df = spark.createDataFrame(data, SCHEMA)
    date_df = ts_df.withColumn("td_match", ts_df["td_match"].cast("date"))
    a = entity_features(ts_df, measures=MEASURES, ref=REF)
    b = entity_features(date_df, measures=MEASURES, ref=REF)
    assert rows(a) == rows(b)
    assert {r["account_id"]: r["qt_matches"] for r in b.collect()} == {1: 2}


def test_reference_instants_with_a_zone_are_converted():
    from tidepool.functions.time import as_reference

    want = dt.datetime(2001, 7, 31, 22, 30)
    assert as_reference("2001-08-01T00:30:00+02:00") == want
    assert as_reference(dt.datetime(2001, 8, 1, 0, 30, tzinfo=dt.timezone(dt.timedelta(hours=2)))) == want
    assert as_reference("2001-08-01 00:30:00.250000") == dt.datetime(2001, 8, 1, 0, 30, 0, 250000)
    assert as_reference(dt.date(2001, 8, 1)) == dt.datetime(2001, 8, 1)
