"""Date/time helpers (D01-D17) and time bucketing.

Event ``ts`` columns are TIMESTAMP_NTZ in UTC; epoch conversions go through a
cast to TIMESTAMP with the session zone pinned to UTC (see ``session.py``).
Three week numbers exist in the views and must never be mixed (Z08):
``legacy_week`` (Sunday-based, week 1 starts Jan 1), ``week_start_monday``
(Monday truncation) and ``ceil_week`` (ceil(dayofyear/7)).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.columns import ColumnOrName, _c


def as_of_date(as_of: dt.date | str) -> Column:
    """The evaluation date as a literal (jobs never call current_date())."""
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def as_of_ts(as_of: dt.datetime | dt.date) -> Column:
    if not isinstance(as_of, dt.datetime):
        as_of = dt.datetime.combine(as_of, dt.time())
    return F.lit(as_of).cast("timestamp_ntz")


def epoch_seconds(ts: ColumnOrName) -> Column:
    """D08 ``UNIX_SECONDS``."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def epoch_micros(ts: ColumnOrName) -> Column:
    """D07 ``TIMESTAMP_TO_USEC``."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def from_epoch_seconds(s: ColumnOrName) -> Column:
    return F.timestamp_seconds(_c(s)).cast("timestamp_ntz")


def from_epoch_micros(us: ColumnOrName) -> Column:
    """D07 ``USEC_TO_TIMESTAMP`` / ``TIMESTAMP_MICROS``."""
    return F.timestamp_micros(_c(us)).cast("timestamp_ntz")


def shift(ts: ColumnOrName, n: int, unit: str) -> Column:
    """D04 legacy ``DATE_ADD(ts, n, unit)`` for DAY, WEEK, MONTH, YEAR, HOUR, MINUTE."""
    t = _c(ts)
    u = unit.upper()
    if u in ("MONTH", "YEAR"):
        months = n * (12 if u == "YEAR" else 1)
        return F.timestamp_add("MONTH", F.lit(months), t)
    per = {"WEEK": ("DAY", 7), "DAY": ("DAY", 1), "HOUR": ("HOUR", 1), "MINUTE": ("MINUTE", 1),
           "SECOND": ("SECOND", 1)}[u]
    return F.timestamp_add(per[0], F.lit(n * per[1]), t)


def micros_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """D15 ``later - earlier`` in microseconds."""
    return epoch_micros(later) - epoch_micros(earlier)


def legacy_week(ts: ColumnOrName) -> Column:
    """D11 legacy ``WEEK(ts)``: Sunday-based; days before the year's first Sunday are week 1."""
    d = F.to_date(_c(ts))
    jan1_dow = F.dayofweek(F.trunc(d, "year"))  # 1 = Sunday
    return (F.floor((F.dayofyear(d) + jan1_dow - 2) / 7) + 1).cast("long")


def ceil_week(ts: ColumnOrName) -> Column:
    """D12 ``CEIL(DAYOFYEAR(ts)/7)``."""
    return F.ceil(F.dayofyear(F.to_date(_c(ts))) / 7).cast("long")


def week_start_monday(ts: ColumnOrName) -> Column:
    """D09 ``UTC_USEC_TO_WEEK(ts, 1)``: the Monday that starts ts's week (as DATE)."""
    return F.to_date(F.date_trunc("week", _c(ts)))


def month_start(ts: ColumnOrName) -> Column:
    return F.trunc(F.to_date(_c(ts)), "month")


def period_label(start: ColumnOrName, unit: str, fmt: str) -> Column:
    """Format the last microsecond of the period that begins at ``start``."""
    s = _c(start).cast("timestamp_ntz")
    end = shift(s, 1, unit)
    return F.date_format(F.timestamp_add("MICROSECOND", F.lit(-1), end), fmt)


def day_space_padded(d: ColumnOrName) -> Column:
    """``%e``: day of month padded with a space to width 2."""
    return F.lpad(F.dayofmonth(_c(d)).cast("string"), 2, " ")


def date_from_parts(y: ColumnOrName, m: ColumnOrName, d: ColumnOrName) -> Column:
    """``y-mm-dd`` text from numeric parts."""
    return F.concat_ws("-", _c(y).cast("string"), F.lpad(_c(m).cast("string"), 2, "0"),
                       F.lpad(_c(d).cast("string"), 2, "0"))


# ------------------------------------------------------------------ buckets T01-T05
def epoch_bucket(ts: ColumnOrName, seconds: int) -> Column:
    """T01 ``TIMESTAMP_SECONDS(DIV(UNIX_SECONDS(ts), w) * w)``."""
    return from_epoch_seconds(F.floor(epoch_seconds(ts) / seconds).cast("long") * seconds)


def now_bucket(ts: ColumnOrName, as_of: dt.datetime, width_micros: int) -> Column:
    """T02 ``FLOOR((now - ts) / width)``; index 0 is the most recent interval."""
    return F.floor((epoch_micros(as_of_ts(as_of)) - epoch_micros(ts)) / width_micros).cast("long")


def day_period(ts: ColumnOrName, as_of: dt.date, days: int) -> Column:
    """T03 ``FLOOR(DATEDIFF(now, ts) / days)``."""
    return F.floor(F.datediff(as_of_date(as_of), F.to_date(_c(ts))) / days).cast("long")


def period_bounds(ts: ColumnOrName, unit: str) -> tuple[Column, Column]:
    """Inclusive start and exclusive end of the calendar week (Monday) or month."""
    if unit.upper() == "WEEK":
        s = week_start_monday(ts)
        return s, F.date_add(s, 7)
    s = month_start(ts)
    return s, F.add_months(s, 1)
