"""Time helpers: epoch <-> string, reference dates and rolling windows.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so
the expression stays inside whole-stage codegen. Window bounds are written
as plain comparisons of the *stored* column against a constant, which the
optimizer folds and the parquet scan receives as a pushed filter (a
``CAST(ts AS DATE) > d`` form would not push down).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text form of epoch start times.
EPOCH_FORMAT = "yyyy-MM-dd HH:mm:ss"


def epoch_to_string(epoch: str | Column, fmt: str = EPOCH_FORMAT) -> Column:
    """Epoch seconds -> wall-clock text in the session time zone."""
    c = F.col(epoch) if isinstance(epoch, str) else epoch
    return F.from_unixtime(c, fmt)


def as_reference(ref: str | _dt.date | _dt.datetime | None) -> _dt.datetime:
    """The reference instant in UTC, without a zone. Values with a zone or an
    offset are converted; ``None`` means now."""
    if ref is None:
        return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    if isinstance(ref, _dt.date) and not isinstance(ref, _dt.datetime):
        return _dt.datetime(ref.year, ref.month, ref.day)
    if not isinstance(ref, _dt.datetime):
        ref = _dt.datetime.fromisoformat(str(ref))
    return ref.astimezone(_dt.timezone.utc).replace(tzinfo=None) if ref.tzinfo else ref


def time_type(df: DataFrame, ts: str) -> T.DataType:
    return df.schema[ts].dataType


def as_time(df: DataFrame, ts: str) -> Column:
    """The time column as a timestamp; a text column is parsed like the
    implicit cast Spark applies when such a column meets a date (text that
    does not parse reads as NULL instead of failing the job)."""
    dtype = time_type(df, ts)
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(F.col(ts))
    return F.col(ts)


def _const(value: _dt.datetime, dtype: T.DataType) -> Column:
    """A literal of the column's own type, so no cast lands on the column."""
    text = value.isoformat(sep=" ")  # keeps fractions of a second
    if isinstance(dtype, T.DateType):
        return F.lit(value.date())
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast(T.TimestampNTZType())
    return F.lit(text).cast(T.TimestampType())


def months_back(ref: _dt.datetime, months: int) -> _dt.date:
    """``add_months(ref, -months)`` as a date: clamps to the month's last day."""
    y, m = divmod(ref.year * 12 + (ref.month - 1) - months, 12)
    m += 1
    nxt = _dt.date(y + (m == 12), 1 if m == 12 else m + 1, 1)
    last = (nxt - _dt.timedelta(days=1)).day
    return _dt.date(y, m, min(ref.day, last))


def text_window(col: Column, start: _dt.datetime, end: _dt.datetime | None) -> Column:
    """Comparisons of a time column kept as text that hold for every text that
    parses into [start, end), whatever its form; they push down to the scan,
    where parsing does not. The caller rechecks the parsed value.

    Texts ``yyyy-MM-dd HH:mm:ss`` sort by time, so the bounds are texts as well,
    a day wider for texts with a zone offset, the upper one at the end of its month
    for days of one digit. A month of one digit sorts after those of two, so such
    texts of the last year are let through; so is all that sorts before '1' (blanks, signs,
    leading zeros). None of these stand in a table of the one form, so row groups
    outside the window are still skipped. Text without a date (a time of day) is no instant."""
    lo = start - _dt.timedelta(days=1)
    # '2001' is the first of January, '2001-02' the first of February
    low = f"{lo:%Y-%m-%d}" if lo.day > 1 else f"{lo:%Y-%m}" if lo.month > 1 else f"{lo:%Y}"
    cond = col >= F.lit(low)
    if end is not None:
        hi = end + _dt.timedelta(days=1)
        after = f"{hi.year + hi.month // 12:04d}-{hi.month % 12 + 1:02d}"
        one_digit = ((col >= F.lit(f"{hi:%Y}-1")) & (col < F.lit(f"{hi:%Y}-1."))) | ((col >= F.lit(f"{hi:%Y}-2")) & (col < F.lit(f"{hi:%Y}-:")))
        cond = cond & ((col < F.lit(after)) | one_digit)
    return cond | (col < F.lit("1"))


def window_filter(
    df: DataFrame,
    ts: str,
    ref: _dt.datetime,
    months: int,
    start_inclusive: bool,
    end_exclusive: bool,
    day_col: str | None = None,
    period: str = "day",
) -> Column:
    """Rolling window over the last ``months`` months before ``ref``.

    ``start_inclusive=False`` is ``DATE(ts) > add_months(ref, -months)``;
    ``True`` is ``>=``. ``end_exclusive`` adds ``ts < ref``. Both are
    rewritten as comparisons against literals of the column's type; a text
    column gets bounds on its text (:func:`text_window`) and a recheck of the parsed value.
    ``day_col`` names a DATE column holding ``DATE(ts)`` (``period="day"``)
    or its first day of the month (``period="month"``) -- typically the
    partition column of the table; the same bounds on it let the scan skip
    whole partitions (Spark does not derive them from ``ts``).
    """
    dtype = time_type(df, ts)
    start = months_back(ref, months)
    if not start_inclusive:
        start = start + _dt.timedelta(days=1)
    start_dt = _dt.datetime(start.year, start.month, start.day)
    if isinstance(dtype, T.StringType):
        col, dtype = F.try_to_timestamp(F.col(ts)), T.TimestampType()
        cond = text_window(F.col(ts), start_dt, ref if end_exclusive else None) & (col >= _const(start_dt, dtype))
    else:
        col = F.col(ts)
        cond = col >= _const(start_dt, dtype)
    if end_exclusive:
        if isinstance(dtype, T.DateType):
            cond = cond & (col < F.lit(ref.date()) if ref.time() == _dt.time(0) else col <= F.lit(ref.date()))
        else:
            cond = cond & (col < _const(ref, dtype))
    if day_col:
        day = F.col(day_col)
        first, last = start, ref.date()
        if period == "month":
            first, last = first.replace(day=1), last.replace(day=1)
        elif period != "day":
            raise ValueError(f"unknown period {period!r}")
        cond = cond & (day >= F.lit(first))
        if end_exclusive:
            cond = cond & (day <= F.lit(last))
    return cond


def days_since(df: DataFrame, ts: str, ref: _dt.datetime) -> Column:
    """``datediff(ref, ts)`` in whole days, as BIGINT."""
    return F.datediff(F.lit(ref.date()), F.to_date(as_time(df, ts))).cast("bigint")


# SQL-text forms of the same expressions, for plans that hand many
# expressions to Spark in one call (``selectExpr`` / ``agg`` of ``expr``).

def time_sql(df: DataFrame, ts: str) -> str:
    if isinstance(time_type(df, ts), T.StringType):
        return f"try_to_timestamp(`{ts}`)"
    return f"`{ts}`"


def days_since_sql(df: DataFrame, ts: str, ref: _dt.datetime) -> str:
    return f"CAST(datediff(DATE'{ref.date().isoformat()}', to_date({time_sql(df, ts)})) AS BIGINT)"


def month_bit_sql(df: DataFrame, ts: str) -> str:
    """One bit per calendar month-of-year (1..12, no year): distinct months
    of a group are ``bit_count(bit_or(bits))`` -- exact and mergeable,
    unlike ``COUNT(DISTINCT month(ts))``, which needs an Expand."""
    return f"shiftleft(1, month({time_sql(df, ts)}))"
