"""Nested data: R07 hierarchy expansion, R08 licensed displays, J21 array unnest,
R15 cost allocation, R16 snapshot diff.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import total_licenses


def unnest(df: DataFrame, array_col: str, alias: str, *, outer: bool = False, with_offset: str | None = None) -> DataFrame:
    """Row x its own array.  Inner (an empty/NULL array drops the
    row) unless ``outer``; ``with_offset`` adds the 0-based position."""
    if with_offset:
        fn = F.posexplode_outer if outer else F.posexplode
        return df.select("*", fn(array_col).alias(with_offset, alias))
    fn = F.explode_outer if outer else F.explode
    return df.select("*", fn(array_col).alias(alias))


def expand_hierarchy(h: DataFrame, id_col: str, ancestors_col: str, *, root: str | None = None,
                     parent_of: DataFrame | None = None, parent_id_col: str = "parent_id") -> DataFrame:
    """``(company_id, sub_company_id)`` for every ancestor in the array plus
    the (id, id) self pair.  With ``root`` and ``parent_of`` (id -> parent) only
    companies that are direct children of ``root`` are kept as the grouping
    company.  Every pair is one exploded element: no self join of the tree."""
    pairs = (h.select(F.explode(ancestors_col).alias("company_id"), F.col(id_col).alias("sub_company_id"))
             .unionByName(h.select(F.col(id_col).alias("company_id"), F.col(id_col).alias("sub_company_id")))
             .distinct())
    if root is not None and parent_of is not None:
        children = parent_of.where(F.col(parent_id_col) == F.lit(root)).select(F.col(id_col).alias("company_id"))
        pairs = pairs.join(children, "company_id", "left_semi")
    return pairs


def licensed_displays(subs: DataFrame, *, company_col: str, plan_company_col: str, status_col: str,
                      assigned_col: str, license_args: Sequence[str],
                      license_count: Callable[..., Column] = total_licenses) -> DataFrame:
    """The first ``n`` displays of each subscription's assigned-display array
    are licensed, ``n`` = licence count.  Own plan rows are licensed by the
    company itself; rows whose plan belongs to another (parent) company are
    licensed by that company.  Output: companyId, displayId, licensedBy,
    planSubscriptionStatus (distinct)."""
    n = license_count(*[F.col(c) for c in license_args])
    ex = subs.select(F.col(company_col).alias("companyId"), F.col(plan_company_col).alias("planCompanyId"),
                     F.col(status_col).alias("planSubscriptionStatus"), n.alias("__n"),
                     F.posexplode(assigned_col).alias("__pos", "displayId"))
    lic = ex.where(F.col("__pos") < F.col("__n"))
    by = F.when(F.col("planCompanyId").isNull() | (F.col("planCompanyId") == F.col("companyId")),
                F.col("companyId")).otherwise(F.col("planCompanyId"))
    return lic.select("companyId", "displayId", by.alias("licensedBy"), "planSubscriptionStatus").distinct()


def allocate_cost(units: DataFrame, unit_col: str, total_cost: DataFrame, cost_col: str,
                  *, by: Sequence[str] = (), total_units_col: str | None = None, out: str = "cost") -> DataFrame:
    """``cost = units / total_units * total_cost``.

    ``total_cost`` holds one row per ``by`` group; with no ``by`` it is one row
    and broadcast (size proven), otherwise AQE chooses the join.  Total units are summed from
    ``units`` unless given on ``total_cost``.
    """
    by = list(by)
    tot = total_cost
    if total_units_col is None:
        su = units.groupBy(*by).agg(F.sum(unit_col).alias("__tu"))
        tot = tot.join(su, by, "inner") if by else tot.crossJoin(su)
        total_units_col = "__tu"
    share = F.try_divide(F.col(unit_col).cast("double"), F.col(total_units_col).cast("double")) * F.col(cost_col)
    # one row overall: broadcast (size proven); one row per group: let AQE choose
    j = units.join(tot, by, "left") if by else units.crossJoin(F.broadcast(tot))
    return j.withColumn(out, share).drop("__tu")


def snapshot_diff(snapshots: DataFrame, date_col: str, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows of the latest snapshot that are new or differ from the previous one.

    The latest two snapshot dates come from one small aggregation over the
    distinct dates; then one aggregation per key picks the row of each of the
    two dates (keys are unique within a snapshot), so the snapshots are read
    twice in total and never self-joined.  The comparison is NULL-safe (NULL
    vs value counts as a change).
    """
    keys, cols = list(keys), list(cols)
    dates = snapshots.select(date_col).distinct()
    d1 = dates.agg(F.max(date_col).alias("__d1"))
    d0 = dates.crossJoin(F.broadcast(d1)).where(F.col(date_col) < F.col("__d1")).agg(F.max(date_col).alias("__d0"))
    bounds = d1.crossJoin(d0)  # one row
    row = F.struct(*[F.col(c) for c in cols])
    both = (snapshots.crossJoin(F.broadcast(bounds))
            .where((F.col(date_col) == F.col("__d1")) | (F.col(date_col) == F.col("__d0")))
            .groupBy(*keys).agg(F.max(F.when(F.col(date_col) == F.col("__d1"), row)).alias("__cur"),
                                F.max(F.when(F.col(date_col) == F.col("__d0"), row)).alias("__prev")))
    cur = both.where(F.col("__cur").isNotNull())
    changed = F.col("__prev").isNull()
    for c in cols:
        changed = changed | ~F.col("__cur")[c].eqNullSafe(F.col("__prev")[c])
    return cur.where(changed).select(*keys, *[F.col("__cur")[c].alias(c) for c in cols])


def licensed_assignments(assignments: DataFrame, subs: DataFrame, *, company_col: str, display_col: str,
                         order: Sequence[str], plan_company_col: str, status_col: str, license_args: Sequence[str],
                         license_count: Callable[..., Column] = total_licenses, salts: int = 256) -> DataFrame:
    """R08 when assignments are rows (company, display, assignment order) rather
    than an array column: the first ``n`` assignments of each company, ``n`` its
    licence count, picked by the salted two-phase top-n (no array per company,
    no one task per company).  Same output as :func:`licensed_displays`."""
    from fleetlens.operators.latest import first_n_per_key
    s = subs.select(F.col(company_col).alias("companyId"), F.col(plan_company_col).alias("planCompanyId"),
                    F.col(status_col).alias("planSubscriptionStatus"),
                    license_count(*[F.col(c) for c in license_args]).alias("__n"))
    a = assignments.select(F.col(company_col).alias("companyId"), F.col(display_col).alias("displayId"), *order)
    j = a.join(s, "companyId")  # one subscription row per company
    lic = first_n_per_key(j, "companyId", list(order), F.col("__n"), salts=salts)
    by = F.when(F.col("planCompanyId").isNull() | (F.col("planCompanyId") == F.col("companyId")),
                F.col("companyId")).otherwise(F.col("planCompanyId"))
    return lic.select("companyId", "displayId", by.alias("licensedBy"), "planSubscriptionStatus").distinct()
