"""R03 daily reliability, conditional distinct counts, R13 funnels, R14 top errors.

The reference computes "distinct devices in total" and "distinct devices that
failed" as two scans, two distinct-count aggregations and a left join (and up
to nine of them in one view).  :func:`distinct_counts` does any number of such
conditional distinct counts in one pass and two cheap aggregations:

1. ``groupBy(keys, id)`` with ``max(flag_i)``: map-side partial aggregation
   collapses the rows of a hot id or a hot day before the shuffle;
2. ``groupBy(keys)`` with ``sum(flag_i)`` over the (keys, id) pairs.

This avoids Spark's ``Expand`` for multiple ``count(DISTINCT ...)`` (one copy of
every row per distinct aggregate).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.columns import pct_ok


def distinct_counts(df: DataFrame, keys: str | Sequence[str], id_col: str | Column,
                    flags: Mapping[str, Column]) -> DataFrame:
    """Per ``keys``: number of distinct non-NULL ids whose rows satisfy each flag.

    Keys whose rows have no id stay, with counts of 0 (as with ``count(distinct id)``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    base = df.select(*keys, idc.alias("__id"),
                     *[(F.coalesce(c, F.lit(False)) & idc.isNotNull()).cast("int").alias(f"__f_{n}") for n, c in flags.items()])
    per_id = (base.groupBy(*keys, "__id")
                  .agg(*[F.max(f"__f_{n}").alias(f"__f_{n}") for n in flags]))
    return per_id.groupBy(*keys).agg(*[F.sum(f"__f_{n}").cast("long").alias(n) for n in flags])


def daily_reliability(df: DataFrame, id_col: str, failed: Column, *, date_col: str = "date",
                      total: Column | None = None, scale: float | None = 100.0,
                      total_name: str = "total", failed_name: str = "failed",
                      ratio_name: str | None = "pct") -> DataFrame:
    """Per date distinct ids in total and failed, failed defaulting to 0, ratio.

    Equivalent to ``total LEFT JOIN failed USING (date)``: a date with failures
    but no qualifying total row does not appear.
    """
    flags = {total_name: total if total is not None else F.lit(True), failed_name: failed}
    out = distinct_counts(df, date_col, id_col, flags).where(F.col(total_name) > 0)
    if ratio_name is not None and scale is not None:
        out = out.withColumn(ratio_name, F.round(pct_ok(total_name, failed_name, scale), 6))
    return out


def first_event_dates(events: DataFrame, entity: str, event_col: str, steps: Sequence[str],
                      ts_col: str = "ts") -> DataFrame:
    """First date of each step per entity (A10 conditional min), one aggregation."""
    return events.groupBy(entity).agg(*[
        F.min(F.when(F.col(event_col) == s, F.to_date(F.col(ts_col)))).alias(f"first_{s}") for s in steps])


def funnel(entities: DataFrame, events: DataFrame, *, entity: str, cohort_col: str,
           event_col: str, steps: Sequence[str], ts_col: str = "ts") -> DataFrame:
    """Per cohort, entities registered and entities that reached each step.

    ``entities`` holds (entity, cohort); a step counts when the entity has an
    event of that name (any time).  One pass over events.
    """
    reached = events.groupBy(entity).agg(*[
        F.max((F.col(event_col) == s).cast("int")).alias(f"has_{s}") for s in steps])
    j = entities.join(reached, entity, "left")
    return distinct_counts(j, cohort_col, entity, {
        "registered": F.lit(True), **{f"reached_{s}": F.col(f"has_{s}") == 1 for s in steps}})


def top_errors(df: DataFrame, detail: Column, id_col: str, *, detail_len: int = K.TOP_ERROR_DETAIL_LENGTH,
               extra: Sequence[str] = ()) -> DataFrame:
    """Distinct devices per truncated error detail (``SUBSTR(d, 1, n)``), most first.

    The truncation is the report's own grouping key, not an input cap.
    """
    d = F.substring(detail, 1, detail_len).alias("details")
    return (df.select(*extra, d, F.col(id_col).alias("__id"))
              .groupBy(*extra, "details").agg(F.count_distinct("__id").alias("display_count")))


def interval_uptime(heartbeats: DataFrame, event_log: DataFrame, errors: DataFrame, keys: Sequence[str], *,
                    ts_col: str = "ts", width_seconds: int = 300) -> DataFrame:
    """R85 core: one row per (interval, *keys) seen in the heartbeats or the event
    log (``UNION DISTINCT``), with ``up`` = no error of the same interval and keys.

    ``errors`` are event-log rows already restricted to known error codes.  The
    status join is plain equality on every key, so rows with a NULL key never
    match an error and count as up (the reference's behaviour, Z17).  Errors are
    pre-aggregated per interval key before the join.
    """
    from fleetlens.functions.timeutil import epoch_bucket
    iv = epoch_bucket(ts_col, width_seconds).alias("interval")
    cols = [iv, *[F.col(k) for k in keys]]
    seen = heartbeats.select(*cols).union(event_log.select(*cols)).distinct()
    err = errors.select(*cols).groupBy("interval", *keys).agg(F.count(F.lit(1)).alias("__errors"))
    j = seen.join(err, ["interval", *keys], "left")
    return j.select("interval", *keys, (F.coalesce(F.col("__errors"), F.lit(0)) == 0).alias("up"))
