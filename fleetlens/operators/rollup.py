"""R02 incremental rollup splice, R04 pivoted metric dashboards.

The reference keeps a materialised daily rollup and each run unions a freshly
recomputed recent window with the stored rows older than the window (late data
inside the window is thus picked up).  Here the stored rollup is any
DataFrame (normally a Parquet table partitioned by date) and writing back uses
dynamic partition overwrite, so a re-run replaces only the window's days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.sources.sinks import write_partitions


def splice_rollup(fresh: DataFrame, history: DataFrame, date_col: str, cutoff: dt.date) -> DataFrame:
    """``fresh ∪ history[date < cutoff]`` aligned by column name.

    Rows of ``fresh`` at or after ``cutoff`` win; the stored rows of those dates
    are dropped (partition pruning when history is date-partitioned).
    """
    old = history.where(F.col(date_col) < F.lit(cutoff)).select(*fresh.columns)
    return fresh.unionByName(old)


def refresh_rollup(fresh: DataFrame, path: str, date_col: str) -> None:
    """Write the recomputed window back; idempotent under retries."""
    write_partitions(fresh, path, partition_col=date_col)


def pivot_metrics(series: Mapping[str, DataFrame], date_col: str = "date", value_col: str = "value",
                  spine: DataFrame | None = None) -> DataFrame:
    """Several (date, value) series side by side, one column per series name.

    Union the tagged series once and pivot with an explicit value list (no
    extra job to discover the pivot values).  Each series must hold at most one
    row per date; ``max`` keeps the pivot deterministic.  With ``spine`` the
    result is left-joined onto the driving dates (dates missing from a series
    give NULL), otherwise every date of any series appears.
    """
    names = list(series)
    tagged = [df.select(F.col(date_col).alias(date_col), F.lit(n).alias("__metric"),
                        F.col(value_col).cast("double").alias("__v")) for n, df in series.items()]
    wide = (reduce(DataFrame.unionByName, tagged)
            .groupBy(date_col).pivot("__metric", names).agg(F.max("__v")))
    if spine is None:
        return wide
    return spine.select(date_col).join(wide, date_col, "left")


def latest_n_dates(df: DataFrame, n: int, date_col: str = "date") -> DataFrame:
    """O05 made explicit: the rows of the ``n`` most recent dates."""
    top = df.select(date_col).distinct().orderBy(F.col(date_col).desc()).limit(n)
    return df.join(F.broadcast(top), date_col, "left_semi")


def tag_union(frames: Sequence[tuple[str, DataFrame]], tag: str = "source") -> DataFrame:
    """N homogeneous sources stacked by name with a source tag."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [df.withColumn(tag, F.lit(name)) for name, df in frames])


def one_scan_union(df: DataFrame, sources: Mapping[str, "F.Column"], cols: Sequence[str | "F.Column"], *,
                   distinct: bool = True) -> DataFrame:
    """U01/U02 when the logical sources are slices of one physical table.

    ``UNION [DISTINCT]`` of ``df.where(p_i).select(cols)`` for disjoint slices is
    one scan filtered by ``p_1 OR ... OR p_n``: the table is read once instead of
    once per branch.  (Overlapping slices under UNION ALL would need the tag
    form of :func:`tag_union`.)
    """
    cond = reduce(lambda a, b: a | b, list(sources.values()))
    out = df.where(cond).select(*cols)
    return out.distinct() if distinct else out


def pivot_long(df: DataFrame, name_col: str, names: Sequence[str], *, date_col: str = "date",
               value_col: str = "value") -> DataFrame:
    """R04 when the series are slices of one long (date, name, value) table:
    a single pivot over it, instead of splitting it into one DataFrame per name
    (which would replay the table's whole plan once per series)."""
    return (df.select(date_col, name_col, F.col(value_col).cast("double").alias("__v"))
              .groupBy(date_col).pivot(name_col, list(names)).agg(F.max("__v")))
