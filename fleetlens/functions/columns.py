"""Column -> Column helpers for the string, regex, null and array idioms of the views.

All are compositions of built-in Spark expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ----------------------------------------------------------------- predicates P05-P12
def is_true(c: ColumnOrName) -> Column:
    """``x IS TRUE`` (NULL -> false)."""
    return _c(c).eqNullSafe(F.lit(True))


def is_not_true(c: ColumnOrName) -> Column:
    """``x IS NOT TRUE`` (NULL -> true)."""
    return ~_c(c).eqNullSafe(F.lit(True))


def is_false(c: ColumnOrName) -> Column:
    """``x IS FALSE`` (NULL -> false)."""
    return _c(c).eqNullSafe(F.lit(False))


def not_like(c: ColumnOrName, pattern: str) -> Column:
    """``NOT LIKE``: NULL input stays NULL, so ``where`` drops it like SQL does."""
    return ~_c(c).like(pattern)


# ----------------------------------------------------------------------- regex F01-F03
def regexp_extract_or_null(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """first capture group; NULL when the pattern does not match.

    Spark's ``regexp_extract`` returns '' on no match; the reference returns NULL
    and '' only when the group itself matched empty.
    """
    c = _c(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def url_param(c: ColumnOrName, name: str) -> Column:
    """R05 helper: value of query parameter ``name`` of a request URL, NULL if absent."""
    return regexp_extract_or_null(c, rf"[?&]{name}=([^&#]*)")


# ----------------------------------------------------------------------- UDF surface X01-X03
def clean_up_event_app(c: ColumnOrName) -> Column:
    """``"<kind>: <name> ID: <id>"`` -> ``"<kind>: <id>"`` (greedy), others unchanged."""
    c = _c(c)
    return F.when(c.like("%: % ID: %"), F.regexp_replace(c, r":\s.+\sID: ", ": ")).otherwise(c)


def url_decode(c: ColumnOrName) -> Column:
    """Decode ``%XX`` runs as UTF-8; ``+`` stays ``+``; a stray ``%`` is dropped;
    '' becomes NULL; invalid UTF-8 becomes U+FFFD.

    Built from ``try_url_decode`` (which would turn '+' into a space, hence the
    ``%2B`` escape first).
    """
    c = _c(c)
    cleaned = F.regexp_replace(F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", ""), r"\+", "%2B")
    return F.nullif(F.try_url_decode(cleaned), F.lit(""))


def total_licenses(plan_status: ColumnOrName, plan_period_end: ColumnOrName, plan_trial_expiry: ColumnOrName,
                   pro_status: ColumnOrName, pro_period_end: ColumnOrName, plan_pro_count: ColumnOrName,
                   pro_count: ColumnOrName) -> Column:
    """X03 default licence count.

    The reference only shows the call and its argument order; its body is not
    available.  This default (our assumption) adds the two counts; jobs accept
    any replacement with the same signature.
    """
    return F.coalesce(_c(plan_pro_count), F.lit(0)) + F.coalesce(_c(pro_count), F.lit(0))


# ----------------------------------------------------------------------- arithmetic F15/F16
def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: float = 1.0) -> Column:
    """Float division, NULL when the denominator is 0 or NULL."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return r * F.lit(scale) if scale != 1.0 else r


def pct_ok(total: ColumnOrName, failed: ColumnOrName, scale: float = 100.0) -> Column:
    """``(total - ifnull(failed, 0)) / total * scale``."""
    t = _c(total)
    return safe_ratio(t - F.coalesce(_c(failed), F.lit(0)), t, scale)


def r(c: ColumnOrName, digits: int = 6) -> Column:
    """Round a double for reporting (stable across engines' summation order)."""
    return F.round(_c(c).cast("double"), digits)


# ----------------------------------------------------------------------- arrays F17-F22
def element_at0(arr: ColumnOrName, i: int) -> Column:
    """F17 ``arr[OFFSET(i)]`` (0-based); NULL past the end."""
    return F.get(_c(arr), i)


def array_length_or_null(arr: ColumnOrName) -> Column:
    """F19 ``ARRAY_LENGTH``: NULL for a NULL array."""
    a = _c(arr)
    return F.when(a.isNotNull(), F.size(a))


def among_first(arr: ColumnOrName, value: ColumnOrName, n: int) -> Column:
    """F22 ``arrayIndexOf(arr, x) < n``: x occurs within the first n elements."""
    pos = F.array_position(_c(arr), _c(value))  # 1-based, 0 when absent
    return (pos > 0) & (pos <= n)


def concat_if_not(cond: ColumnOrName, arr: ColumnOrName, *others: ColumnOrName) -> Column:
    """F18 ``ARRAY_CONCAT(IF(c, [], a), ...)``."""
    a = _c(arr)
    empty = F.filter(a, lambda _: F.lit(False))  # [] of a's element type
    return F.concat(F.when(_c(cond), empty).otherwise(a), *[_c(o) for o in others])


def sorted_distinct_join(c: ColumnOrName, sep: str = ",") -> Column:
    """A12 ``STRING_AGG(DISTINCT x, sep)`` with a defined (sorted) order."""
    return F.array_join(F.array_sort(F.collect_set(_c(c))), sep)


def sorted_join(c: ColumnOrName, sep: str = ",") -> Column:
    """A13 ``GROUP_CONCAT(x)``; the reference order is unspecified, we sort."""
    return F.array_join(F.array_sort(F.collect_list(_c(c))), sep)


def ordered_join(piece: ColumnOrName, pos: ColumnOrName, sep: str = "") -> Column:
    """A14 ``STRING_AGG(x, sep ORDER BY pos)``."""
    arr = F.array_sort(F.collect_list(F.struct(_c(pos).alias("p"), _c(piece).alias("v"))))
    return F.array_join(F.transform(arr, lambda s: s["v"]), sep)


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """P13 ordered rule list (searched CASE, first match wins)."""
    out = None
    for cond, val in rules:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(d) if out is not None else d
