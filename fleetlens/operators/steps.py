"""Step matching: starts paired with the outcome that follows them, and first dates of milestones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.operators.joins import next_event


def match_steps(events: DataFrame, key: str, *, start: Column, completed: Column, failed: Column, ts: str = "ts",
                tie: str | None = None) -> DataFrame:
    """Every start of ``key`` with its outcome: key, ts, outcome, outcome_ts.

    A start is paired with the next event of its key, in time order, that is a start, a completion or
    a failure: ``completed`` or ``failed`` with that event's time, ``repeated`` if the key starts again
    first, ``open`` if nothing follows.  An outcome without a start before it pairs with none.  Events
    of one time are taken in the order of ``tie`` (give a unique one).  An event that satisfies
    several conditions counts as the first of failed, completed, start.  Rows without a key or a
    time take no part.  Works bucket by bucket in time: no task sorts a whole key.
    """
    kind = F.when(failed, "failed").when(completed, "completed").when(start, "start")
    x = (events.withColumn("__kind", kind).where(F.col("__kind").isNotNull() & F.col(key).isNotNull() & F.col(ts).isNotNull())
         .select(key, ts, *([tie] if tie else []), "__kind"))
    paired = next_event(x, key, ts=ts, tie=tie, cols=["__kind"], prefix="__n_").where(F.col("__kind") == "start")
    nxt = F.col("__n___kind")
    outcome = F.when(nxt.isNull(), "open").when(nxt == "start", "repeated").otherwise(nxt)
    return paired.select(key, ts, outcome.alias("outcome"),
                         F.when(nxt.isin("completed", "failed"), F.col(f"__n_{ts}")).alias("outcome_ts"))


def daily_funnel(events: DataFrame, id_col: str, date_col: str, *, start: Column, done: Column, needs: Column | None = None,
                 spoiled: Column | None = None) -> DataFrame:
    """date, starts, completions: distinct ids per day that start, and that complete.

    A completion counts on an id-day with a row of ``needs`` (if given) and without one of ``spoiled``
    (if given).  Days without a start are left out; completions are NULL on a day without any.  One
    aggregation per id-day and one per day.
    """
    flag = lambda c: F.max(F.coalesce(c, F.lit(False)).cast("int"))
    per = events.groupBy(id_col, date_col).agg(
        flag(start).alias("s"), flag(done).alias("c"), (flag(needs) if needs is not None else F.lit(1)).alias("n"),
        (flag(spoiled) if spoiled is not None else F.lit(0)).alias("x"))
    known = F.col(id_col).isNotNull()
    good = known & (F.col("c") == 1) & (F.col("n") == 1) & (F.col("x") == 0)
    out = per.groupBy(date_col).agg(F.count_if(known & (F.col("s") == 1)).alias("starts"), F.count_if(good).alias("completions"),
                                    F.max("s").alias("any"))
    return out.where(F.col("any") == 1).select(date_col, "starts", F.nullif("completions", F.lit(0)).alias("completions"))


def first_dates(sources: Mapping[str, DataFrame], entity: str, milestones: Mapping[str, tuple[str, Column]], ts: str = "ts") -> DataFrame:
    """entity and, for each milestone, the first time at which one of its source's rows satisfies its condition.

    ``sources``: name -> rows with ``entity`` and ``ts``; ``milestones``: name -> (source, condition
    on that source's columns).  Every source is read once and reduced to one row per entity (partial
    aggregation first) before they meet in one aggregation, so a hot entity is small before the shuffle.
    """
    parts = None
    for name, rows in sources.items():
        own = {m: c for m, (s, c) in milestones.items() if s == name}
        part = rows.groupBy(entity).agg(*[F.min(F.when(c, F.col(ts))).alias(m) for m, c in own.items()])
        parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
    return parts.groupBy(entity).agg(*[F.min(m).alias(m) for m in milestones])


def cohort_counts(entities: DataFrame, cohort: Column, counts: Mapping[str, str], name: str = "cohort") -> DataFrame:
    """Per cohort, the entities (one row each) and those that reached each milestone: count name -> milestone column."""
    return entities.groupBy(cohort.alias(name)).agg(F.count(F.lit(1)).alias("cnt_registered"),
                                                    *[F.count(c).alias(n) for n, c in counts.items()])
