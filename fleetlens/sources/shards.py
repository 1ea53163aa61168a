"""Date-sharded table families: the shards of a folder, found by one listing.

A family is a set of tables ``<prefix><YYYYMMDD>`` under one root, whose columns may have grown over
time.  The catalogue lists the folder once; choosing shards by id, suffix or date happens on that
list, and the chosen ones are read in one scan under the family's schema.  Nothing here runs a Spark
job: neither the listing nor the schema looks into the data.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.sources.catalog import DateLike, as_date, day_start
from fleetlens.sources.schemas import EVENT_SCHEMAS

_NAME = re.compile(r"(.*?)(\d{8})(?:\.parquet)?$")


@dataclass(frozen=True, order=True)
class Shard:
    table_id: str
    prefix: str
    day: dt.date
    path: str

    @property
    def suffix(self) -> str:
        return f"{self.day:%Y%m%d}"


def shard_of(path: str) -> Shard | None:
    """The shard that a folder or file is by its name, None for any other name."""
    m = _NAME.fullmatch(path.rstrip("/").rpartition("/")[2])
    if not m:
        return None
    try:
        day = dt.datetime.strptime(m[2], "%Y%m%d").date()
    except ValueError:
        return None
    return Shard(m[1] + m[2], m[1], day, path)


class ShardCatalog:
    """Shards under ``root``.  ``schemas``: prefix -> the family's schema (or its name in the registry)."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType | str]):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas = {p: EVENT_SCHEMAS[s] if isinstance(s, str) else s for p, s in schemas.items()}
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        listing = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hadoop)
        found = (shard_of(f.getPath().toString()) for f in listing)
        self.shards = sorted(s for s in found if s and s.prefix in self.schemas)

    def between(self, prefix: str, start: DateLike, end: DateLike) -> list[Shard]:
        """Shards of a family from ``start`` to ``end``; days without a shard are no error."""
        return [s for s in self.shards if s.prefix == prefix and as_date(start) <= s.day <= as_date(end)]

    def matching(self, predicate: Callable[[str], bool]) -> list[Shard]:
        """Shards of any family whose table id satisfies ``predicate``."""
        return [s for s in self.shards if predicate(s.table_id)]

    def read(self, shards: Iterable[Shard], columns: Iterable[str] | None = None, tag: str = "table_id",
             day: str = "event_date") -> DataFrame:
        """The rows of ``shards`` with their table id and day; columns that a shard or a family lacks are NULL.

        One scan per family.  No shard gives an empty table of the families' columns.
        """
        by: dict[str, list[Shard]] = {}
        for s in sorted(shards):
            by.setdefault(s.prefix, []).append(s)
        parts = []
        for prefix in by or self.schemas:
            own = by.get(prefix, [])
            schema = self.schemas[prefix]
            if columns is not None:
                schema = T.StructType([f for f in schema.fields if f.name in set(columns)])
            loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
            if own:
                name = F.regexp_extract(F.col("_metadata.file_path"), rf"/([^/]*?\d{{8}})(?:\.parquet)?(?:/[^/]*)?$", 1)
                df = self.spark.read.schema(loose).parquet(*[s.path for s in own]).withColumn(tag, name)
            else:
                df = self.spark.createDataFrame([], loose).withColumn(tag, F.lit(None).cast("string"))
            parts.append(df.withColumn(day, F.to_date(F.right(tag, F.lit(8)), "yyyyMMdd")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out


# ------------------------------------------------------------------ families that are day ranges of one table
def matching_days(prefix: str, first: DateLike, last: DateLike, predicate: Callable[[str], bool]) -> list[tuple[dt.date, dt.date]]:
    """Stretches of days in [first, last] whose table ids (``prefixYYYYMMDD``) satisfy ``predicate``."""
    d, end, out = as_date(first), as_date(last), []
    while d <= end:
        if predicate(f"{prefix}{d:%Y%m%d}"):
            if out and out[-1][1] == d - dt.timedelta(days=1):
                out[-1] = (out[-1][0], d)
            else:
                out.append((d, d))
        d += dt.timedelta(days=1)
    return out


def read_matching_days(df: DataFrame, prefix: str, days: list[tuple[dt.date, dt.date]], ts_col: str = "ts",
                       tag: str = "table_id") -> DataFrame:
    """Rows of those days in one scan (the stretches become pushed ranges of ``ts_col``), with their table ids."""
    cond: Column = F.lit(False)
    for first, last in days:
        cond = cond | ((F.col(ts_col) >= day_start(first)) & (F.col(ts_col) < day_start(last + dt.timedelta(days=1))))
    return df.where(cond).withColumn(tag, F.concat(F.lit(prefix), F.date_format(ts_col, "yyyyMMdd")))
