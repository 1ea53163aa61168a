"""Table access: a path catalog plus the date-range readers of the event tables.

Event tables are expected in one of two layouts:

* one directory table hive-partitioned by ``event_date`` (the target layout;
  ``df.write.partitionBy("event_date")``), or
* a plain Parquet table with a ``ts`` column (the driver's test tables).

Every reader turns its date bounds into literal predicates on the partition
column (partition pruning) *and* on ``ts`` (Parquet row-group pruning), so
Catalyst pushes both into the scan.  Bounds are computed in Python from an
explicit ``as_of``; no job calls ``current_date()``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DateLike = dt.date | str


def as_date(d: DateLike) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d)[:10])


def day_start(d: DateLike) -> Column:
    """Midnight of ``d`` as a TIMESTAMP_NTZ literal (type of the event ``ts``)."""
    return F.lit(dt.datetime.combine(as_date(d), dt.time())).cast("timestamp_ntz")


def ts_literal(t: dt.datetime | str) -> Column:
    if isinstance(t, str):
        t = dt.datetime.fromisoformat(t)
    return F.lit(t).cast("timestamp_ntz")


class Catalog:
    """Name -> Parquet location.  ``table(name, cols)`` prunes columns at the scan."""

    def __init__(self, spark: SparkSession, root: str, layout: str = "{root}/{name}.parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layout = layout

    def path(self, name: str) -> str:
        return self.layout.format(root=self.root, name=name)

    def table(self, name: str, cols: Iterable[str | Column] | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.select(*cols) if cols else df


# --------------------------------------------------------------------------- S01-S06
def read_events(df: DataFrame, start: DateLike | None, end: DateLike, *, ts_col: str = "ts",
                date_col: str = "event_date", half_open: bool = False) -> DataFrame:
    """Rows whose day lies in [start, end] (or [start, end) if half_open); no lower bound if start is None.

    On a table partitioned by ``date_col`` the predicate on it prunes partitions;
    the ``ts`` range prunes row groups either way.
    """
    d0, d1 = None if start is None else as_date(start), as_date(end)
    stop = d1 if half_open else d1 + dt.timedelta(days=1)
    cond = F.col(ts_col) < day_start(stop)
    if d0 is not None:
        cond = (F.col(ts_col) >= day_start(d0)) & cond
    if date_col in df.columns:
        last = stop - dt.timedelta(days=1)
        cond = cond & (F.col(date_col) <= F.lit(last))
        if d0 is not None:
            cond = cond & (F.col(date_col) >= F.lit(d0))
    return df.where(cond)


def read_suffix_range(df: DataFrame, suffix_from: str, suffix_to: str, *, ts_col: str = "ts") -> DataFrame:
    """``_TABLE_SUFFIX BETWEEN 'YYYYMMDD' AND 'YYYYMMDD'`` on a date-sharded family."""
    p = lambda s: dt.date(int(s[:4]), int(s[4:6]), int(s[6:8]))
    return read_events(df, p(suffix_from), p(suffix_to), ts_col=ts_col).withColumn(
        "table_suffix", F.date_format(F.col(ts_col), "yyyyMMdd"))


def read_partition_time(df: DataFrame, start: DateLike, end: DateLike, *, ts_col: str = "ts") -> DataFrame:
    """Ingestion-time partitions ``>= start AND < end`` (half open)."""
    return read_events(df, start, end, ts_col=ts_col, half_open=True)


def read_ts_between(df: DataFrame, t0: dt.datetime, t1: dt.datetime, *, ts_col: str = "ts") -> DataFrame:
    """Closed ``ts BETWEEN t0 AND t1`` (includes the end instant)."""
    return df.where(F.col(ts_col).between(ts_literal(t0), ts_literal(t1)))


def shard_paths(root: str, prefix: str, start: DateLike, end: DateLike) -> list[str]:
    """Paths of a ``prefixYYYYMMDD`` shard family between two dates, generated not listed."""
    d0, d1 = as_date(start), as_date(end)
    n = (d1 - d0).days + 1
    return [f"{root.rstrip('/')}/{prefix}{(d0 + dt.timedelta(days=i)):%Y%m%d}" for i in range(max(n, 0))]


def read_shards(spark: SparkSession, root: str, prefix: str, start: DateLike, end: DateLike) -> DataFrame:
    """S01 over a physically sharded layout: one scan over the generated path list.

    Days without a shard are skipped (one metadata call per day of the range on
    the driver, no listing of the family); each row gets its shard date so
    downstream code can treat it like a partition column.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def exists(p: str) -> bool:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        return hp.getFileSystem(conf).exists(hp)

    paths = [p for p in shard_paths(root, prefix, start, end) if exists(p)]
    if not paths:
        raise FileNotFoundError(f"no {prefix}YYYYMMDD shard under {root} between {start} and {end}")
    return (spark.read.parquet(*paths)
            .withColumn("event_date", F.to_date(F.regexp_extract(F.input_file_name(), r"(\d{8})", 1), "yyyyMMdd")))


def read_matching(frames: dict[str, DataFrame], predicate: Callable[[str], bool],
                  tag: str = "table_id") -> DataFrame:
    """S03 ``TABLE_QUERY``: union (by name) of every table whose id satisfies ``predicate``."""
    picked = [df.withColumn(tag, F.lit(name)) for name, df in sorted(frames.items()) if predicate(name)]
    if not picked:
        raise ValueError("no table matches")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), picked)


def shard_id(prefix: str, ts_col: str = "ts") -> Column:
    """Id of the daily shard an event belongs to (``prefixYYYYMMDD``)."""
    return F.concat(F.lit(prefix), F.date_format(F.col(ts_col), "yyyyMMdd"))
