"""Idempotent sinks.

The reference appends one day per scheduled run (``INSERT INTO t SELECT``).  A
plain append duplicates rows when a run is retried; writing with
``partitionOverwriteMode=dynamic`` replaces exactly the partitions present in
the new data, so a re-run (or a task retry after executor loss) converges to
the same table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, partition_col: str = "date",
                     columns: list[str] | None = None) -> None:
    """Replace the partitions ``df`` covers; other partitions stay untouched."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    if columns is not None:  # explicit column list of INSERT INTO t(cols)
        df = df.select(*columns)
    # whole days to a writer where they are small; AQE splits a day above the advisory partition size
    (df.hint("rebalance", partition_col)
       .write.mode("overwrite").partitionBy(partition_col).parquet(path))


def append_snapshot(df: DataFrame, path: str, run_time: dt.datetime, ts_col: str = "ts") -> None:
    """Stamp a KPI row with the run time and store it under its run-time partition.

    The partition is the run timestamp itself, so re-running the same scheduled
    instant overwrites its own row instead of adding a second one.
    """
    stamped = (df.withColumn(ts_col, F.lit(run_time).cast("timestamp_ntz"))
                 .withColumn("run_id", F.lit(run_time.strftime("%Y%m%dT%H%M%S"))))
    write_partitions(stamped, path, partition_col="run_id")
