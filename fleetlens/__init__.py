"""fleetlens: fleet / product-event analytics expressed as Spark DataFrame jobs.

Layout
------
sources/    readers (date-range scans, shard families, schema registry) and sinks
functions/  Column -> Column helpers (strings, regex, URL cleanup, dates, buckets)
operators/  reusable DataFrame -> DataFrame operators (latest row, rollup splice,
            daily reliability, pivots, semi/anti/as-of/lookback joins, ...)
plans/      report jobs built from the operators plus the query registry
streaming/  Structured Streaming form of the late-data daily rollup
"""

from fleetlens.session import build_session, ensure_session  # noqa: F401

__all__ = ["build_session", "ensure_session"]
