"""The jobs that splice a fresh window over a stored rollup (R02, T06 and the reports built on them).

A job registers how its daily rows are computed for a range of days.  It runs in two ways:

* ``run_rollup(spark, sf_dir, root, name)``, the scheduled way: the table under ``root`` is
  refreshed for the job's window only and read back;
* as a registered query, without a folder of its own: the days before the window are stored
  once per session and input under the session's shared folder, and the query splices the
  fresh window over that table.

Either way the events scan of a run covers the window alone.  Rows without a time belong to no
day and are in no rollup.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fleetlens.operators.rollup import splice_rollup
from fleetlens.plans.registry import query
from fleetlens.plans.tables import YESTERDAY, tbl
from fleetlens.session import has_shared_folder, shared_folder
from fleetlens.sources.rollups import RollupTable

#: Rows of the days ``first`` (None: from the start) to ``last``.
Compute = Callable[[SparkSession, str, dt.date | None, dt.date], DataFrame]


@dataclass(frozen=True)
class Rollup:
    name: str
    compute: Compute
    start: dt.date
    end: dt.date
    date_col: str


ROLLUPS: dict[str, Rollup] = {}


def rollup(name: str, sql: str, *, start: dt.date, end: dt.date = YESTERDAY, date_col: str = "date"):
    """Register ``compute`` as a stored rollup and its splice as query ``name``."""
    def deco(compute: Compute) -> Compute:
        r = ROLLUPS[name] = Rollup(name, compute, start, end, date_col)

        def job(spark: SparkSession, sf_dir: str) -> DataFrame:
            return spliced(spark, sf_dir, r)
        job.__name__, job.__doc__, job.__module__ = compute.__name__, compute.__doc__, compute.__module__
        query(name, sql)(job)
        return compute
    return deco


def input_key(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input's files: the same text only for the same files."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(sf_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for table in fs.listStatus(root):
        inside = fs.listStatus(table.getPath())  # a file lists itself
        found += [f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in inside]
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:24]


def history_table(spark: SparkSession, sf_dir: str, r: Rollup) -> RollupTable:
    """The session's stored days before the window, filled at first use."""
    root = (f"{shared_folder(spark)}/rollups/{spark.sparkContext.applicationId}/{input_key(spark, sf_dir)}/"
            f"{r.name}/before={r.start}")
    table = RollupTable(spark, root, r.date_col)
    if table.covered_until() is None:
        last = r.start - dt.timedelta(days=1)
        table.store(r.compute(spark, sf_dir, None, last), None, last)
    return table


def spliced(spark: SparkSession, sf_dir: str, r: Rollup) -> DataFrame:
    """The window over the stored days; a session without a shared folder has nowhere to keep them and computes them anew."""
    fresh = r.compute(spark, sf_dir, r.start, r.end)
    if has_shared_folder(spark):
        history = history_table(spark, sf_dir, r).read(before=r.start)
    else:
        history = r.compute(spark, sf_dir, None, r.start - dt.timedelta(days=1))
    return splice_rollup(fresh, history, r.date_col, r.start)


def run_rollup(spark: SparkSession, sf_dir: str, root: str, name: str) -> DataFrame:
    """Refresh the stored rollup ``<root>/<name>`` for the job's window and return all its days.

    ``registry.jobs(day)`` has the set of another evaluation date (module ``plans.rollups`` of that set).
    """
    r = ROLLUPS[name]
    table = RollupTable(spark, f"{root.rstrip('/')}/{name}", r.date_col)
    table.refresh(lambda first, last: r.compute(spark, sf_dir, first, last), r.start, r.end)
    return table.read()


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tbl(spark, sf_dir, "events")
