"""Wide one-hot matrix: one row per event, one 0/1 column per (side, item).

The SQL form is one ``MAX(CASE WHEN item = i AND side = s THEN 1 ELSE 0 END)``
per column: 240 aggregates, which Spark runs outside whole-stage codegen and
carries as 240 buffers through the shuffle. Here each row sets one bit,
``bit_or`` folds the bits per event into ``ceil(items / 64)`` longs per side,
and the columns are read back from the bits after the aggregate. The
aggregate has a handful of fixed-width buffers, merges map-side, stays in
codegen, and the shuffle carries a few longs per event instead of 240 ints.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.time import as_reference, window_filter

# Hero ids of the draft matrix (same list on both sides):
# 1 to 138 without 15, 24, 25, 60, 82, 115, 116, 117, 118, 122, 124, 125,
# 127, 130, 131, 132, 133, 134.
HERO_IDS = [
    1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 18, 19, 20,
    21, 22, 23, 26, 27, 28, 29, 30, 31, 32, 33, 34, 35, 36, 37, 38, 39, 40,
    41, 42, 43, 44, 45, 46, 47, 48, 49, 50, 51, 52, 53, 54, 55, 56, 57, 58,
    59, 61, 62, 63, 64, 65, 66, 67, 68, 69, 70, 71, 72, 73, 74, 75, 76, 77,
    78, 79, 80, 81, 83, 84, 85, 86, 87, 88, 89, 90, 91, 92, 93, 94, 95, 96,
    97, 98, 99, 100, 101, 102, 103, 104, 105, 106, 107, 108, 109, 110, 111,
    112, 113, 114, 119, 120, 121, 123, 126, 128, 129, 135, 136, 137, 138,
]
# Side names used in the column names.
SIDE_NAMES = ("radiant", "dire")

_WORD = 64


def one_hot_columns(items: Sequence[int], sides: Sequence[str] = SIDE_NAMES, label: str = "hero") -> list[str]:
    return [f"{s}_{label}_{i}" for s in sides for i in items]


def one_hot(
    df: DataFrame,
    *,
    key: str,
    item: str,
    side: str,
    items: Sequence[int],
    carry: Mapping[str, Column] | None = None,
    sides: Sequence[str] = SIDE_NAMES,
    label: str = "hero",
) -> DataFrame:
    """Per ``key``: ``carry`` aggregates, then ``<side>_<label>_<item>`` = 1
    when some row of the key has that item on that side (``side`` true for
    the first side, false for the second; NULL side counts for neither)."""
    items = [int(i) for i in items]
    if len(set(items)) != len(items):
        raise ValueError("items must be distinct")
    n_words = (len(items) + _WORD - 1) // _WORD
    # The expressions are SQL text handed over in bulk: hundreds of Column
    # objects built one by one cost a driver round trip each.
    listed = ", ".join(str(i) for i in items)
    # position of the item in the list, computed once per row (-1: not listed)
    df = df.withColumn("_pos", F.expr(f"array_position(array({listed}), `{item}`) - 1"))

    aggs = [agg.alias(name) for name, agg in (carry or {}).items()]
    for s_idx, flag in enumerate(("true", "false")):
        for w in range(n_words):
            lo, hi = w * _WORD, (w + 1) * _WORD
            aggs.append(F.expr(
                f"bit_or(CASE WHEN `{side}` = {flag} AND _pos >= {lo} AND _pos < {hi} "
                f"THEN shiftleft(1L, CAST(_pos - {lo} AS INT)) ELSE 0L END)"
            ).alias(f"_w{s_idx}_{w}"))
    folded = df.groupBy(key).agg(*aggs)

    out = [f"`{key}`"] + [f"`{name}`" for name in (carry or {})]
    for s_idx, s_name in enumerate(sides):
        for p, i in enumerate(items):
            out.append(f"CAST(shiftright(_w{s_idx}_{p // _WORD}, {p % _WORD}) & 1 AS INT) AS `{s_name}_{label}_{i}`")
    return folded.selectExpr(*out)


def draft_onehot(
    players: DataFrame,
    *,
    key: str = "match_id",
    item: str = "hero_id",
    side: str = "isRadiant",
    outcome: str = "radiant_win",
    ts: str = "td_match",
    items: Sequence[int] = HERO_IDS,
    ref: str | _dt.date | _dt.datetime | None = None,
    months: int = 6,
    day_col: str | None = None,
    period: str = "day",
) -> DataFrame:
    """Draft matrix over matches since ``add_months(ref, -months)`` (start
    inclusive, no end), with the match outcome as ``MAX(outcome)``;
    ``day_col`` as in :func:`tidepool.functions.time.window_filter`."""
    ref_ts = as_reference(ref)
    recent = players.filter(
        window_filter(players, ts, ref_ts, months, start_inclusive=True, end_exclusive=False, day_col=day_col,
                      period=period)
    )
    return one_hot(
        recent,
        key=key,
        item=item,
        side=side,
        items=items,
        carry={"radiant_win": F.max(F.col(outcome))},
    )
