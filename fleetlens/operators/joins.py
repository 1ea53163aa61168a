"""Join family: semi/anti (J07-J13), null-aware NOT IN (J09), calendar range join
(J17), lookback join (J18/R12), as-of join (J19) and next-event (W01).

Range joins and per-entity ordered scans are bucketed by
``(key, floor(epoch(ts) / bucket))`` and run their ordered window per (key,
bucket): a key holding a third of all rows is split into as many tasks as it
has buckets.  What crosses a bucket boundary is handled exactly:

* bounded look-back (``lookback_count``): a right row is copied into the few
  following buckets its window reaches, so one range-frame window per
  partition sees every match -- one shuffle, no join;
* unbounded look-back / look-ahead (``asof_join``, ``next_event``): a
  per-(key, bucket) *summary* (one row per non-empty bucket, so its per-key
  window is bounded by the time span, not by the row count) carries the last
  right row / first next row across buckets and is equi-joined back.

No pair of rows is ever materialised, so a window holding many matches costs
nothing extra, and results are exact (no caps).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.timeutil import epoch_micros

# Default bucket: one hour.  Results are exact for any width; the width only
# trades per-task size (rows of one key in one bucket) against the per-key
# summary length (non-empty buckets of one key over the time span).  With a
# key holding a third of 100 TB over two years, hour buckets keep a task near
# 2 GB where day buckets would put ~45 GB in one task.
BUCKET_SECONDS = 3_600


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


# ----------------------------------------------------------------- semi / anti
def semi(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` with a match; composite keys, no string concat."""
    keys = _keys(keys)
    return left.join(right.select(*keys), keys, "left_semi")


def anti(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a match (``NOT EXISTS``; NULL keys never match)."""
    keys = _keys(keys)
    return left.join(right.select(*keys), keys, "left_anti")


def semi_any(left: DataFrame, rights: Sequence[DataFrame], key: str) -> DataFrame:
    """J12 ``key IN A OR key IN B``: one semi-join against the distinct union of key sets."""
    ks = rights[0].select(key)
    for r in rights[1:]:
        ks = ks.union(r.select(key))
    return left.join(ks.distinct(), key, "left_semi")


def not_in(left: DataFrame, right: DataFrame, left_col: str, right_col: str | None = None) -> DataFrame:
    """J09 SQL ``left_col NOT IN (SELECT right_col ...)`` with its NULL semantics.

    * a NULL in the subquery makes the predicate NULL for every row: empty result;
    * a NULL probe value is dropped unless the subquery is empty.

    Built from a shuffled ``left_anti`` plus a one-row guard, instead of Spark's
    null-aware anti join, which needs the whole subquery broadcast.
    """
    rc = right_col or left_col
    keys = right.select(F.col(rc).alias("__k"))
    guard = keys.agg(F.count(F.lit(1)).alias("__n"),
                     F.count_if(F.col("__k").isNull()).alias("__nulls"))
    kept = left.join(keys.where(F.col("__k").isNotNull()).distinct(),
                     left[left_col] == F.col("__k"), "left_anti")
    return (kept.crossJoin(F.broadcast(guard))  # one row, size proven
                .where((F.col("__nulls") == 0) & (F.col(left_col).isNotNull() | (F.col("__n") == 0)))
                .drop("__n", "__nulls"))


# ----------------------------------------------------------------- J17 calendar
def join_calendar(points: DataFrame, calendar: DataFrame, point_col: str, start_col: str, end_col: str,
                  *, grain: str | None = None) -> DataFrame:
    """Attach every period ``[start, end)`` containing the point.

    With ``grain`` ('week' = Monday weeks, 'month') the periods are the calendar's
    own truncation, so the theta join becomes an equi-join on the truncated key
    (hash join, no nested loop).  Otherwise each period is expanded into the days
    it touches (from its start's day to the day of its last instant; the fan-out
    is the period's length in days) and joined on the point's day, then the exact
    bounds decide.  It is an equi-join at every size; AQE picks its strategy.
    """
    p = F.col(point_col)
    if grain is not None:
        key = (F.to_date(F.date_trunc("week", p)) if grain == "week" else F.trunc(F.to_date(p), "month"))
        cal = calendar.withColumn("__pk", F.col(start_col).cast("date"))
        j = points.withColumn("__pk", key).join(cal, "__pk", "inner").drop("__pk")
        return j.where((p >= F.col(start_col)) & (p < F.col(end_col)))
    last = F.to_date(F.col(end_col).cast("timestamp_ntz") - F.expr("interval 1 microsecond"))
    days = (calendar.where(F.col(start_col) < F.col(end_col))
            .withColumn("__day", F.explode(F.sequence(F.to_date(start_col), last))))
    j = points.withColumn("__day", F.to_date(p)).join(days, "__day", "inner").drop("__day")
    return j.where((p >= F.col(start_col)) & (p < F.col(end_col)))


# ----------------------------------------------------------------- bucketed scans
def _bucket(ts: Column, bucket_seconds: int) -> Column:
    return F.floor(epoch_micros(ts) / (bucket_seconds * 1_000_000)).cast("long")


def asof_join(left: DataFrame, right: DataFrame, key: str, *, left_ts: str = "ts", right_ts: str = "ts",
              right_cols: Sequence[str], tie: str | None = None, strict: bool = True,
              prefix: str = "r_", bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Each left row with the latest right row of the same key before it.

    ``strict`` means ``right.ts < left.ts`` (the reference), else ``<=``.  Among
    right rows with the same ts the larger ``tie`` wins.  Left rows without an
    earlier right row keep NULLs (left outer semantics).  Output: left columns
    plus ``prefix + c`` for ``c`` in ``[right_ts] + right_cols``.
    """
    lcols = left.columns
    rsel = [right_ts] + [c for c in right_cols if c != right_ts]
    tie_col = F.col(tie) if tie else F.lit(0)
    # kind orders rows at equal ts: strict -> left first (right at same ts not visible)
    lk, rk = (0, 1) if strict else (1, 0)
    nowhere = [F.lit(None).cast(right.schema[c].dataType).alias(prefix + c) for c in rsel]
    keyless = left.where(F.col(key).isNull()).select(*lcols, *nowhere)  # NULL keys match nothing: no window for them
    L = left.where(F.col(key).isNotNull()).select(F.col(key).alias("__k"), F.col(left_ts).alias("__t"), F.lit(lk).alias("__kind"),
                    F.lit(None).cast("long").alias("__tie"),
                    F.struct(*[F.col(c) for c in lcols]).alias("__l"),
                    F.lit(None).cast(right.select(F.struct(*rsel)).schema[0].dataType).alias("__r"))
    R = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(key).alias("__k"), F.col(right_ts).alias("__t"), F.lit(rk).alias("__kind"),
        tie_col.cast("long").alias("__tie"),
        F.lit(None).cast(left.select(F.struct(*lcols)).schema[0].dataType).alias("__l"),
        F.struct(*[F.col(c) for c in rsel]).alias("__r"))
    U = L.unionByName(R).withColumn("__b", _bucket(F.col("__t"), bucket_seconds))
    w = (Window.partitionBy("__k", "__b").orderBy("__t", "__kind", "__tie")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    windowed = U.withColumn("__in", F.last("__r", ignorenulls=True).over(w))
    scanned = windowed.where(F.col("__kind") == lk)
    # carry: latest right row of any earlier bucket, aggregated from the windowed
    # rows (already clustered by key and bucket, so the aggregation adds no shuffle)
    summ = (windowed.where(F.col("__kind") == rk)
              .groupBy("__k", "__b").agg(F.max(F.struct("__t", "__tie", "__r")).alias("__s"))
              .select("__k", "__b", F.lit(0).alias("__p"), F.col("__s.__r").alias("__r")))
    probes = (scanned.select("__k", "__b").distinct()
              .select("__k", "__b", F.lit(-1).alias("__p"), F.lit(None).cast(summ.schema["__r"].dataType).alias("__r")))
    wc = (Window.partitionBy("__k").orderBy("__b", "__p")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (probes.unionByName(summ)
             .withColumn("__c", F.last("__r", ignorenulls=True).over(wc))
             .where(F.col("__p") == -1).select("__k", "__b", "__c"))
    # probe (-1) sorts before its own bucket's summary (0): only strictly earlier buckets count
    j = scanned.join(carry, ["__k", "__b"], "left")
    best = F.coalesce(F.col("__in"), F.col("__c"))
    return j.select(*[F.col("__l")[c].alias(c) for c in lcols],
                    *[best[c].alias(prefix + c) for c in rsel]).unionByName(keyless)


def lookback_count(left: DataFrame, right: DataFrame, key: str, window_seconds: int, *,
                   left_ts: str = "ts", right_ts: str = "ts", name: str = "matches",
                   bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """For each left row, the number of right rows of the same key with
    ``left.ts - window < right.ts <= left.ts``.

    A left join on that condition produces ``max(matches, 1)`` rows per left
    row (the fan-out of Z15); ``matches > 0`` is the 0/1 flag of R12.

    Plan: one shuffle on (key, bucket) and one range-frame window.  A right row
    can only match left rows of its own bucket and of the buckets its window
    reaches into (at most ``ceil(window / bucket)`` more), so it is copied into
    those; each left row then counts the right rows of its own partition whose
    time lies in ``(ts - window, ts]``.  No pair is materialised, no join is
    needed, and a hot key is split over its buckets.
    """
    lcols = left.columns
    win_us = window_seconds * 1_000_000
    bsz = bucket_seconds * 1_000_000
    keyless = left.where(F.col(key).isNull()).select(*lcols, F.lit(0).cast("long").alias(name))  # they match nothing
    L = left.where(F.col(key).isNotNull()).select(F.col(key).alias("__k"), epoch_micros(F.col(left_ts)).alias("__t"), F.lit(0).alias("__w"),
                    F.struct(*[F.col(c) for c in lcols]).alias("__l"))
    L = L.withColumn("__b", F.floor(F.col("__t") / bsz).cast("long"))
    rt = epoch_micros(F.col(right_ts))
    R = (right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull())
         .select(F.col(key).alias("__k"), rt.alias("__t"), F.lit(1).alias("__w"),
                 F.lit(None).cast(L.schema["__l"].dataType).alias("__l"),
                 # own bucket up to the bucket holding the last instant it can be matched from
                 F.explode(F.sequence(F.floor(rt / bsz).cast("long"),
                                      F.floor((rt + F.lit(win_us - 1)) / bsz).cast("long"))).alias("__b")))
    U = L.unionByName(R)
    w = (Window.partitionBy("__k", "__b").orderBy("__t")
         .rangeBetween(-(win_us - 1), Window.currentRow))   # (ts - window, ts], ties included
    counted = U.withColumn("__n", F.sum("__w").over(w)).where(F.col("__l").isNotNull())
    return counted.select(*[F.col("__l")[c].alias(c) for c in lcols], F.col("__n").cast("long").alias(name)).unionByName(keyless)


def expand_matches(df: DataFrame, count_col: str) -> DataFrame:
    """Reproduce the left join's row multiplicity (``max(n, 1)`` copies) when a
    report really counts joined rows (Z15 ``fanout="keep"``)."""
    return df.withColumn("__rep", F.explode(F.array_repeat(F.lit(1), F.greatest(F.col(count_col), F.lit(1))
                                                           .cast("int")))).drop("__rep")


def next_event(df: DataFrame, key: str, *, ts: str = "ts", tie: str | None = None,
               cols: Sequence[str] = (), prefix: str = "next_",
               bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """W01 ``LEAD(x, 1) OVER (PARTITION BY key ORDER BY ts, tie)`` without one
    task per key: lead within (key, bucket), and for each bucket's last row the
    first row of the next non-empty bucket of that key."""
    order = [ts] + ([tie] if tie else [])
    payload = list(dict.fromkeys(order + list(cols)))
    # rows without a time come first, as in the window's ascending order
    b = F.coalesce(_bucket(F.col(ts), bucket_seconds), F.lit(-(1 << 62)).cast("long"))
    # NULL keys form one group, as in PARTITION BY: join on (is-null flag, non-null stand-in)
    kt = df.schema[key].dataType.simpleString()
    stand_in = F.lit("") if kt == "string" else F.lit(0).cast(kt)
    base = (df.withColumn("__b", b).withColumn("__kn", F.col(key).isNull())
              .withColumn("__kk", F.coalesce(F.col(key), stand_in)))
    gk = ["__kn", "__kk"]
    w = Window.partitionBy(*gk, "__b").orderBy(*order)
    packed = F.struct(*[F.col(c) for c in payload])
    scanned = base.withColumn("__nx", F.lead(packed, 1).over(w))
    firsts = base.groupBy(*gk, "__b").agg(F.min(packed).alias("__f"))
    wn = Window.partitionBy(*gk).orderBy("__b")
    carry = firsts.withColumn("__c", F.lead("__f", 1).over(wn)).select(*gk, "__b", "__c")
    j = scanned.join(carry, [*gk, "__b"], "left")
    nxt = F.coalesce(F.col("__nx"), F.col("__c"))
    return j.select(*df.columns, *[nxt[c].alias(prefix + c) for c in payload])
