"""R01 latest row per entity, R06 production entities, J06 latest-by self-join.

Change logs keep every version of an entity; "current" is the row with the
largest ``id`` (or ``ts``) per entity.

Scale notes
-----------
``rank() over (partition by key)`` would put every version of a hot entity in
one task.  Instead:

* ``ties="keep"``: aggregate ``max(order)`` per key (map-side partial
  aggregation collapses a hot key early) and semi-join back on
  ``(key, order)`` -- the join key includes the order column, so the hot
  key's rows spread over many shuffle partitions.
* ``ties="one"``: a single aggregation ``max(struct(order, row))`` per key;
  deterministic (largest row wins among equal orders), no join at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def latest_by(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
              ties: str = "keep") -> DataFrame:
    """Rows holding the maximum ``order`` per ``keys``.

    ``ties="keep"`` returns every row that reaches the maximum (the reference's
    group-max-then-join); ``ties="one"`` returns exactly one row per key.
    Rows with a NULL in any order column never qualify, in either mode (as with ``= max(...)``).
    """
    keys, order = _names(keys), _names(order)
    known = F.lit(True)
    for c in order:
        known = known & F.col(c).isNotNull()
    df = df.where(known)
    if ties == "one":
        rest = [c for c in df.columns if c not in keys and c not in order]
        packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest]).alias("__r")
        best = df.groupBy(*keys).agg(F.max(packed).alias("__r"))
        return best.select(*keys, *[F.col("__r")[c].alias(c) for c in order + rest]).select(*df.columns)
    if ties != "keep":
        raise ValueError("ties must be 'keep' or 'one'")
    mx_cols = [f"__mx{i}" for i in range(len(order))]
    if len(order) == 1:
        mx = df.groupBy(*keys).agg(F.max(order[0]).alias(mx_cols[0]))
    else:
        m = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__m"))
        mx = m.select(*keys, *[F.col("__m")[c].alias(n) for c, n in zip(order, mx_cols)])
    cond = [df[k] == mx[k] for k in keys] + [df[o] == mx[n] for o, n in zip(order, mx_cols)]
    return df.join(mx, cond, "left_semi")


def production(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], *,
               pre: Column | None = None, post: Column | None = None, ties: str = "keep") -> DataFrame:
    """Latest version of each entity of the production app.

    ``pre`` filters the change log (e.g. ``appId``), ``post`` the current rows
    (e.g. ``isTest = false``).  Filters go to the scan via Catalyst.
    """
    src = df.where(pre) if pre is not None else df
    cur = latest_by(src, keys, order, ties=ties)
    return cur.where(post) if post is not None else cur


def first_n_per_key(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], n: Column | int, *,
                    pos_col: str = "pos", salts: int = 256) -> DataFrame:
    """Rows among the first ``n`` of their key by ``order`` (``n`` may differ per
    row's key), with their 0-based position -- exact, and without one task per key.

    Phase 1 ranks inside (key, salt) groups, salt = hash(order) mod ``salts``, so a
    key holding a third of all rows is sorted by ``salts`` tasks; only each
    group's first ``n`` survive.  Phase 2 splits a key's candidates into ranges of
    ``order`` at up to ``salts`` values taken evenly from its first salt group, ranks
    inside each range and adds the number of candidates in earlier ranges; so even
    where ``n`` is near the key's size (nothing is pruned) no task ranks a whole key.
    Give a unique ``order`` for a deterministic result.
    """
    keys, order = _names(keys), _names(order)
    nn = F.lit(n) if isinstance(n, int) else n
    salted = df.withColumn("__n", nn).withColumn("__s", F.pmod(F.xxhash64(*order), F.lit(salts)))
    w1 = Window.partitionBy(*keys, "__s").orderBy(*order)
    cand = salted.withColumn("__r", F.row_number().over(w1)).where(F.col("__r") <= F.col("__n"))
    o = F.struct(*[F.col(c) for c in order])
    first_salt = cand.where(F.col("__s") == 0)
    step = F.ceil(F.col("__m") / F.lit(salts))
    sizes = first_salt.groupBy(*keys).agg(F.count(F.lit(1)).alias("__m")).toDF(*[f"__k{i}" for i in range(len(keys))], "__m")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    # at most ``salts`` values per key: every step-th of the salt group's rows
    marks = (first_salt.join(sizes, same).where(F.col("__r") % step == 0)
             .groupBy(*[F.col(f"__k{i}") for i in range(len(keys))]).agg(F.collect_list(o).alias("__marks")))
    ranged = (cand.join(marks, same, "left")
              .withColumn("__b", F.coalesce(F.size(F.filter("__marks", lambda x: x <= o)), F.lit(0)))
              .drop("__marks", *[f"__k{i}" for i in range(len(keys))]))
    per = ranged.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    ahead = per.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__b2"),
                       F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__ahead"))
    w2 = Window.partitionBy(*keys, "__b").orderBy(*order)
    ranked = (ranged.withColumn("__in", F.row_number().over(w2) - 1).join(ahead, same & (F.col("__b") == F.col("__b2")))
              .withColumn(pos_col, (F.col("__in") + F.col("__ahead")).cast("int")).where(F.col(pos_col) < F.col("__n")))
    return ranked.select(*df.columns, pos_col)
