"""Stored daily rollups: a day-partitioned table that runs refresh window by window.

Layout: ``<root>/run=<number>.<first day>.<last day>.<id>/<date_col>=<day>/*.parquet`` and, once
the run's files are all written, ``<root>/run=.../_COMMITTED`` with the run's schema.  A
day belongs to the last committed run whose window holds it, so

* creating the marker swaps all days of a window at once, also days that have no row any more;
* a reader takes one listing and sees whole runs only; files of a failed run are never read;
* a retried run, or two at once over one window, end in the rows of one of them.

Reading is one scan: which run owns which days is a predicate on the two partition
columns, which Spark resolves to a list of folders while it plans.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKER = "_COMMITTED"
RUN = "run"
#: First day of a window without lower bound.
EVER = dt.date(1, 1, 1)
#: Runs with days of their own beyond which ``refresh`` joins all into one.
MANY = 64
_DAY = dt.timedelta(days=1)


@dataclass(frozen=True, order=True)
class Run:
    number: int
    start: dt.date
    end: dt.date
    ident: str

    @property
    def name(self) -> str:
        return f"{self.number:08d}.{self.start}.{self.end}.{self.ident}"

    @staticmethod
    def parse(folder: str) -> Run | None:
        key, _, value = folder.partition("=")
        parts = value.split(".")
        if key != RUN or len(parts) != 4:
            return None
        return Run(int(parts[0]), dt.date.fromisoformat(parts[1]), dt.date.fromisoformat(parts[2]), parts[3])


def owned_days(runs: list[Run]) -> list[tuple[Run, dt.date, dt.date]]:
    """(run, first, last) of the stretches of days that each run owns: those no later run holds."""
    out: list[tuple[Run, dt.date, dt.date]] = []
    for run in sorted(runs):
        left = []
        for owner, first, last in out:
            if last < run.start or first > run.end:
                left.append((owner, first, last))
                continue
            if first < run.start:
                left.append((owner, first, run.start - _DAY))
            if last > run.end:
                left.append((owner, run.end + _DAY, last))
        out = [*left, (run, run.start, run.end)]
    return sorted(out, key=lambda x: x[1])


def _within(day: str, first: dt.date, last: dt.date) -> Column:
    upto = F.col(day) <= F.lit(last)
    return upto if first == EVER else (F.col(day) >= F.lit(first)) & upto


class RollupTable:
    """One stored rollup.  ``root`` is a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, date_col: str = "date"):
        self.spark, self.root, self.date_col = spark, root.rstrip("/"), date_col
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _folders(self) -> list[Run]:
        if not self._fs.exists(self._path(self.root)):
            return []
        found = (Run.parse(f.getPath().getName()) for f in self._fs.listStatus(self._path(self.root)) if f.isDirectory())
        return sorted(r for r in found if r)

    def _folder(self, run: Run) -> str:
        return f"{self.root}/{RUN}={run.name}"

    def runs(self) -> list[Run]:
        """Committed runs, earliest first."""
        return [r for r in self._folders() if self._fs.exists(self._path(f"{self._folder(r)}/{MARKER}"))]

    def covered_until(self) -> dt.date | None:
        """Last day that a committed run holds, None for an empty table."""
        return max((r.end for r in self.runs()), default=None)

    def _schema(self, run: Run) -> T.StructType:
        stream = self._fs.open(self._path(f"{self._folder(run)}/{MARKER}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return T.StructType.fromJson(json.loads(text))

    def store(self, rows: DataFrame, start: dt.date | None, end: dt.date) -> Run:
        """Replace the days ``start`` (None: the first ever) to ``end`` by ``rows``.

        Rows of other days, or without a day, are an error of the caller and are left out.
        """
        start = start or EVER
        run = Run(max((r.number for r in self._folders()), default=0) + 1, start, end, uuid.uuid4().hex[:8])
        inside = rows.where(_within(self.date_col, start, end))
        (inside.hint("rebalance", self.date_col)  # a few files a day; AQE splits large days
         .write.partitionBy(self.date_col).parquet(self._folder(run)))
        out = self._fs.create(self._path(f"{self._folder(run)}/{MARKER}"), False)
        try:
            out.write(bytearray(rows.schema.json().encode()))
        finally:
            out.close()
        return run

    def read(self, before: dt.date | None = None) -> DataFrame:
        """All rows, or those of days before ``before``: one scan of the folders that own these days."""
        runs = self.runs()
        if not runs:
            raise LookupError(f"no committed run in {self.root}")
        owned = owned_days(runs)
        schema = self._schema(runs[-1])
        names = schema.fieldNames()
        stored = T.StructType([f for f in schema.fields if f.name != self.date_col])
        paths = [self._folder(r) for r in dict.fromkeys(r for r, _, _ in owned)]
        scan = (self.spark.read.schema(stored.add(RUN, "string").add(self.date_col, "date"))
                .option("basePath", self.root).parquet(*paths))
        own = F.lit(False)
        for run, first, last in owned:
            own = own | ((F.col(RUN) == run.name) & _within(self.date_col, first, last))
        if before is not None:
            own = own & (F.col(self.date_col) < F.lit(before))
        return scan.where(own).select(*names)

    def compact(self) -> Run | None:
        """All owned days as one new run (the old ones stay until ``vacuum``)."""
        runs = self.runs()
        if not runs:
            return None
        return self.store(self.read(), min(r.start for r in runs), max(r.end for r in runs))

    def vacuum(self, keep: int = 2) -> list[Run]:
        """Delete committed runs that own no day and are not among the last ``keep``; returns them.

        Readers that planned before the last ``keep`` runs were committed may still need them.
        """
        runs = self.runs()
        needed = {r for r, _, _ in owned_days(runs)} | set(runs[-keep:])
        gone = [r for r in runs if r not in needed]
        for r in gone:
            self._fs.delete(self._path(self._folder(r)), True)
        return gone

    def refresh(self, compute, start: dt.date, end: dt.date) -> Run:
        """Recompute the days ``start`` to ``end`` by ``compute(first, last)`` and store them.

        An empty table is first filled with all earlier days (``compute(None, start - 1 day)``); days
        that no run holds since the last one are computed along with the window.
        """
        until = self.covered_until()
        if until is None:
            self.store(compute(None, start - _DAY), None, start - _DAY)
        elif until < start - _DAY:
            start = until + _DAY
        run = self.store(compute(start, end), start, end)
        if len(owned_days(self.runs())) > MANY:
            run = self.compact()
        return run
