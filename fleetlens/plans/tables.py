"""Driver-table access and the bindings of reference roles to them (FIXTURES §C).

Roles: device = ``events.user_id``; event name = ``events.event_type`` with
configuration = 'view', error = 'error', start = 'signup', complete =
'purchase'; event details = ``events.props``; version = the integer ``k`` in
``props``; company = ``customer`` (company id = ``c_custkey``, industry =
``c_mktsegment``, parent = ``c_nationkey``); change log = ``orders`` per
``o_custkey`` ordered by ``o_orderkey``; request URL = ``pages.url``.
The default evaluation date ``AS_OF`` is 2024-01-31 (the events cover 2024-01-01..30);
``registry.jobs(day)`` gives all jobs as of another day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2024, 1, 31)
YESTERDAY = AS_OF - dt.timedelta(days=1)


def set_as_of(day: dt.date) -> None:
    """Evaluation date of the plan modules imported after this call (see ``registry.jobs``)."""
    global AS_OF, YESTERDAY
    AS_OF, YESTERDAY = day, day - dt.timedelta(days=1)


def tbl(spark: SparkSession, d: str, name: str, *cols: str | Column) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return df.select(*cols) if cols else df


def version_of(props: str = "props") -> Column:
    """Release number carried in the event payload (the ``k`` of ``{"k": n}``)."""
    return F.regexp_extract(F.col(props), r"(\d+)", 1).try_cast("int")


VERSION_SQL = "cast(nullif(regexp_extract(props, '(\\d+)', 1), '') as integer)"


def device_events(spark: SparkSession, d: str) -> DataFrame:
    """Events in the reference's device-event shape."""
    return tbl(spark, d, "events").select(
        "event_id", F.col("user_id").alias("display_id"), F.col("event_type").alias("event"),
        F.col("props").alias("event_details"), "ts", F.to_date("ts").alias("date"), "value",
        version_of().alias("version"))


DEVICE_EVENTS_SQL = f"""(select event_id, user_id as display_id, event_type as event, props as event_details,
 ts, cast(ts as date) as date, value, {VERSION_SQL} as version from events)"""
