"""Rule tables: classifications given as rows (name, conditions), all applied in one scan.

A report family (widget kinds, failure branches, error lists, deprecations) differs between its
members only in predicates.  Here each member is a ``Rule``; a job applies all rules to every row
in one pass and carries the rule's name through one aggregation, instead of one scan per member.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``name``; ``used``: rows that show use; ``failed``: failure branches, any of which makes a failure."""
    name: str
    used: str
    failed: tuple[str, ...] = ()

    def failure(self) -> str:
        return " or ".join(f"({b})" for b in self.failed) or "false"


def _flag(cond: str) -> Column:
    return F.max(F.coalesce(F.expr(cond), F.lit(False)).cast("int"))


def daily_rule_counts(events: DataFrame, rules: Sequence[Rule], id_col: str, date_col: str = "date",
                      eligible: Column | None = None, name: str = "kind") -> DataFrame:
    """name, date, total_count, failed_count per rule and day: ids that used it, and those of them that failed.

    ``eligible``: condition on rows; only ids with such a row (on any day) count.  One aggregation per
    id-day holds the flags of all rules (a hot id or day is reduced before the shuffle); the rules' names
    come in afterwards, on one row per id-day.  Rows without an id take no part.
    """
    flags = []
    for i, r in enumerate(rules):
        flags += [_flag(r.used).alias(f"u{i}"), _flag(r.failure()).alias(f"f{i}")]
    per = events.where(F.col(id_col).isNotNull()).groupBy(id_col, date_col).agg(
        *flags, *([F.max(F.coalesce(eligible, F.lit(False)).cast("int")).alias("__ok")] if eligible is not None else []))
    if eligible is not None:
        ids = per.groupBy(id_col).agg(F.max("__ok").alias("__ok")).where("__ok = 1").select(id_col)
        per = per.join(ids, id_col, "left_semi")
    each = F.array(*[F.struct(F.lit(r.name).alias("n"), F.col(f"u{i}").alias("u"), F.col(f"f{i}").alias("f")) for i, r in enumerate(rules)])
    x = per.select(date_col, F.explode(F.filter(each, lambda e: e["u"] == 1)).alias("e"))
    return x.groupBy(F.col("e.n").alias(name), date_col).agg(F.count(F.lit(1)).alias("total_count"),
                                                             F.sum("e.f").cast("long").alias("failed_count"))


def matched(rows: DataFrame, rules: Sequence[Rule], name: str = "kind", branch: str = "used") -> DataFrame:
    """``rows`` once for each rule whose ``used`` (or, with branch="failed", failure) condition they satisfy."""
    conds = [F.when(F.expr(r.used if branch == "used" else r.failure()), F.lit(r.name)) for r in rules]
    return rows.withColumn(name, F.explode(F.filter(F.array(*conds), lambda x: x.isNotNull())))


def matrix(rows: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """One row per key with a column per rule: the rule's name if any row of the key satisfies it, and their number ``items``."""
    g = rows.groupBy(key).agg(*[_flag(r.used).alias(f"__{i}") for i, r in enumerate(rules)])
    n = sum((F.col(f"__{i}") for i in range(len(rules))), F.lit(0))
    return g.select(key, *[F.when(F.col(f"__{i}") == 1, F.lit(r.name)).alias(r.name) for i, r in enumerate(rules)],
                    n.cast("long").alias("items")).where(F.col("items") > 0)
