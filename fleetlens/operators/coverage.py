"""Whether nested schedules show something on a day, and at all times of it.

A presentation has placeholders, a placeholder has items; both may be bound to dates, hours and a
recurrence.  The tests run inside the nested arrays, so a presentation is one row from scan to
result: no explode, and no shuffle to bring its items together again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def untimed(x: Column) -> Column:
    """Not bound to any time (a missing mark counts as untimed)."""
    return ~_yes(x["timeDefined"])


def within_dates(x: Column, day: dt.date) -> Column:
    """``day`` lies between startDate and endDate; a missing bound is open."""
    t = F.lit(day)
    return _yes(t >= F.coalesce(x["startDate"], t)) & _yes(t <= F.coalesce(x["endDate"], t))


def displayable(x: Column, day: dt.date) -> Column:
    return untimed(x) | within_dates(x, day)


def visible(x: Column) -> Column:
    """A placeholder is seen unless it is switched off."""
    return F.coalesce(x["visibility"], F.lit(True))


def every_day(x: Column) -> Column:
    """The recurrence leaves out no day: none, daily, or weekly on all seven days, every time round."""
    each = x["recurrenceFrequency"] == 1
    return x["recurrenceType"].isNull() | _yes((x["recurrenceType"] == "Daily") & each) | _yes(
        (x["recurrenceType"] == "Weekly") & each & (F.size(x["recurrenceDaysOfWeek"]) == 7))


def always_on(x: Column) -> Column:
    """Within its dates it plays at all times: untimed, or without hours and every day."""
    return untimed(x) | (x["startTime"].isNull() & x["endTime"].isNull() & every_day(x))


def _any_item(placeholders: str, outer, inner) -> Column:
    """Some placeholder satisfies ``outer`` and one of its items ``inner``."""
    return _yes(F.exists(placeholders, lambda p: outer(p) & _yes(F.exists(p["items"], inner))))


def widget_coverage(presentations: DataFrame, day: dt.date, key: str = "presentationId",
                    placeholders: str = "placeholders") -> DataFrame:
    """``key`` and three marks: has_items (in a displayable placeholder), shows (one of them is displayable
    on ``day``), covered (one of these plays at all times)."""
    def seen(p: Column) -> Column:
        return displayable(p, day) & visible(p)
    return presentations.select(
        key, _any_item(placeholders, seen, lambda i: F.lit(True)).alias("has_items"),
        _any_item(placeholders, seen, lambda i: displayable(i, day)).alias("shows"),
        _any_item(placeholders, seen, lambda i: displayable(i, day) & always_on(i)).alias("covered"))


def no_content(coverage: DataFrame) -> DataFrame:
    """Presentations with items of which none is displayable on the day."""
    return coverage.where(F.col("has_items") & ~F.col("shows"))


def content_gaps(coverage: DataFrame) -> DataFrame:
    """Presentations that show something on the day, but nothing at all times."""
    return coverage.where(F.col("shows") & ~F.col("covered"))
