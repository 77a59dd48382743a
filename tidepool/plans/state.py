"""Feature tables over a sliding window from mergeable monthly state.

The feature query reads six months of rows for every new day. Here each batch
of rows is reduced once to partial aggregates per (entity, calendar month) and
appended; a run merges the partials of the months that lie wholly in the window and
reads rows only for the months at its edges. All parts merge:

* sums and counts of each measure, counts per role, first and last day, one bit
  for the month of the year;
* the events themselves as an exact bitmap in words of 64: the word is
  ``event >> 6``, its bits are OR-ed. Distinct events over any set of months
  are ``sum(bit_count(bit_or(bits)))`` per entity, however often a row comes
  and even if an event has rows in several months. A word is a row of three
  longs, so an entity of few events costs a row for each at most, and
  a hot one (a third of all rows, say) a row for 64 events that lie together;
  fixed bitmaps of 4 KB would cost the former a bitmap for each.

A batch's partials are one folder (``batch=<name>``) that the same batch
overwrites, so a run that is repeated counts nothing twice; months are folders
below, which a window prunes. The first day over all months gives the lifetime
without reading history. Partials of a (entity, month) merge map-side before
they cross the network.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.time import as_reference, as_time, months_back, time_sql, window_filter
from tidepool.plans.features import PLAYER_MEASURES, PLAYER_ROLES, feature_columns

#: Events of one word of the bitmap, as a shift.
WORD_SHIFT = 6


def _sums(measures: Sequence[tuple[str, str]], roles: Sequence[int]) -> list[str]:
    """Names of the columns that add up."""
    return [x for i in range(len(measures)) for x in (f"s{i}", f"n{i}")] + [f"r{int(r)}" for r in roles]


def monthly_stats(rows: DataFrame, *, entity: str, ts: str, role: str, measures: Sequence[tuple[str, str]], roles: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Per entity (and ``by``): sums and counts, days, months of the year."""
    t = time_sql(rows, ts)
    aggs = [f"sum(`{src}`) AS s{i}" for i, (_, src) in enumerate(measures)] + [f"count(`{src}`) AS n{i}" for i, (_, src) in enumerate(measures)]
    aggs += [f"sum(CASE WHEN `{role}` = {int(r)} THEN 1 ELSE 0 END) AS r{int(r)}" for r in roles]
    aggs += [f"min(to_date({t})) AS first_day", f"max(to_date({t})) AS last_day", f"bit_or(shiftleft(1, month({t}))) AS month_bits"]
    return rows.groupBy(entity, *by).agg(*[F.expr(a) for a in aggs])


def event_words(rows: DataFrame, *, entity: str, event: str, by: Sequence[str] = ()) -> DataFrame:
    """Per entity (and ``by``) and word of 64 events: the bits of its events.
    Events are whole numbers; NULL ones are left out, as COUNT(DISTINCT) does."""
    e = f"CAST(`{event}` AS BIGINT)"
    # an arithmetic shift: negative numbers have words of their own
    return rows.where(F.col(event).isNotNull()).groupBy(entity, *by, F.expr(f"shiftright({e}, {WORD_SHIFT})").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, CAST({e} & 63 AS INT)))").alias("bits"))


def fold_batch(rows: DataFrame, state: str, batch: str, *, entity: str = "account_id", event: str = "match_id", ts: str = "td_match", role: str = "lane_role",
               measures: Sequence[tuple[str, str]] = PLAYER_MEASURES, roles: Sequence[int] = PLAYER_ROLES) -> None:
    """Reduce a batch of new rows to its partials and keep them under ``state``.
    Rows without a time belong to no month (no window holds them; a lifetime
    ignores them). Each of the two parts is complete or absent: the batch's folder is overwritten."""
    month = F.trunc(F.to_date(as_time(rows, ts)), "month")
    dated = rows.withColumn("mo", month).where(F.col("mo").isNotNull())
    parts = {"stats": monthly_stats(dated, entity=entity, ts=ts, role=role, measures=measures, roles=roles, by=["mo"]),
             "words": event_words(dated, entity=entity, event=event, by=["mo"])}
    for name, part in parts.items():
        part.write.mode("overwrite").partitionBy("mo").parquet(f"{state.rstrip('/')}/{name}/batch={batch}")


def whole_months(ref: _dt.datetime, months: int) -> tuple[_dt.date, _dt.date]:
    """First day of the first, and first day after the last month that lies
    wholly in the window (start open, end open at ``ref``)."""
    start = months_back(ref, months) + _dt.timedelta(days=1)
    first = start if start.day == 1 else _dt.date(start.year + start.month // 12, start.month % 12 + 1, 1)
    return first, max(first, ref.date().replace(day=1))


def features_from_state(
    spark: SparkSession,
    state: str,
    rows: DataFrame,
    *,
    entity: str = "account_id",
    event: str = "match_id",
    ts: str = "td_match",
    role: str = "lane_role",
    measures: Sequence[tuple[str, str]] = PLAYER_MEASURES,
    roles: Sequence[int] = PLAYER_ROLES,
    ref: str | _dt.date | _dt.datetime | None = None,
    months: int = 6,
    month_col: str | None = None,
) -> DataFrame:
    """:func:`tidepool.plans.features.entity_features` from the state that
    :func:`fold_batch` keeps. ``rows`` is the player table; only the months at the
    edges of the window are read from it. ``month_col``: its partition column, the first day
    of the month, so that other folders are not even listed."""
    ref_ts = as_reference(ref)
    first, after = whole_months(ref_ts, months)
    inside = (F.col("mo") >= F.lit(first)) & (F.col("mo") < F.lit(after))
    stats, words = (spark.read.parquet(f"{state.rstrip('/')}/{n}") for n in ("stats", "words"))

    # the edges: rows of the window outside its whole months
    window = window_filter(rows, ts, ref_ts, months, start_inclusive=False, end_exclusive=True, day_col=month_col, period="month")
    time = as_time(rows, ts)
    if month_col:
        outside = (F.col(month_col) < F.lit(first)) | (F.col(month_col) >= F.lit(after))
    else:
        outside = (time < F.lit(first)) | (time >= F.lit(after))
    edge = rows.where(window & outside)
    cols = [entity, *_sums(measures, roles), "last_day", "month_bits"]
    parts = stats.where(inside).select(*cols).unionByName(
        monthly_stats(edge, entity=entity, ts=ts, role=role, measures=measures, roles=roles).select(*cols))
    bits = words.where(inside).select(entity, "word", "bits").unionByName(event_words(edge, entity=entity, event=event))
    counted = bits.groupBy(entity, "word").agg(F.bit_or("bits").alias("bits")).select(entity, F.bit_count("bits").alias("_events"))
    both = parts.unionByName(counted, allowMissingColumns=True)
    day = f"DATE'{ref_ts.date().isoformat()}'"
    merged = both.groupBy(entity).agg(*[F.expr(e) for e in [
        "sum(_events) AS qt_matches", f"CAST(datediff({day}, max(last_day)) AS BIGINT) AS qt_days_last_match", "bit_count(bit_or(month_bits)) AS _n_months",
        *[f"try_divide(CAST(sum(s{i}) AS DOUBLE), sum(n{i})) AS `{name}`" for i, (name, _) in enumerate(measures)],
        *[f"sum(r{int(r)}) AS _r{int(r)}" for r in roles]]])
    seen = stats.groupBy(entity).agg(F.min("first_day").alias("first_day"))
    lifetime = seen.select(entity, F.datediff(F.lit(ref_ts.date()), "first_day").cast("bigint").alias("tq_days_first_match"))
    return feature_columns(merged, lifetime, entity=entity, role=role, measures=measures, roles=roles, ref=ref_ts, months=months)
