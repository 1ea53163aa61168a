"""Module and widget dashboards, activity ratios and display counts in their full shapes (R22, R23, R71, R72, R75, R106, R123).

Bindings.  Modules: the eight are the payload's whole part modulo 8, each with errors of its own; a module's
current version is the release line of its last event.  Activity: electron entries = 'view' and 'click' events
outside the beta channel (updates: values under 20), second player = 'signup' events outside it, local
storage = 'error' events; companies of displays = customer nations.  Subscriptions: months of orders, as
R106; a cancellation is a finished order ('F').
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import timeutil as TU
from fleetlens.operators.nested import snapshot_diff
from fleetlens.operators.reliability import distinct_counts
from fleetlens.operators.rules import Rule
from fleetlens.plans.dataflow import BETA_LIKE
from fleetlens.plans.kinds import STABLE_SQL
from fleetlens.plans.registry import ORACLE, query
from fleetlens.plans.reports import D, W3_START, W5_START, W7_START, ev, k_col, q
from fleetlens.plans.rollups import ROLLUPS, rollup, spliced
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl
from fleetlens.sources import catalog as cat

SS = SparkSession
r6 = C.r

# ------------------------------------------------------------------ R71, R72: eight modules
MODULE = "cast(floor(value) as bigint) % 8"
MODULES = [Rule("content", "0", ("event_type = 'error'",)), Rule("licensing", "1", ("event_type = 'error' and value > 50",)),
           Rule("local_messaging", "2", ("event_type = 'click' and value < 40", "event_type = 'error'")),
           Rule("display_control", "3", ("event_type = 'error' and k % 2 = 0",)), Rule("system_metrics", "4", ("event_type in ('error', 'click')",)),
           Rule("local_storage", "5", ("event_type = 'error' and value < 70",)), Rule("watchdog", "6", ("event_type like '%err%'",)),
           Rule("second_os", "7", ("upper(event_type) like '%ERROR%' and not (value > 90) and props not like '%\"k\": 7_}'",))]


def module_rows(e: DataFrame, every: DataFrame) -> DataFrame:
    """module, date, user_id, bad: displays of each module on its current release line, and whether they failed.

    ``every``: the events that tell the current lines; one row per module (eight) comes of them.
    """
    m = F.expr(MODULE)
    lines = every.where(F.col("k").isNotNull() & F.col("value").isNotNull()).groupBy(m.alias("module")).agg(
        F.max_by(F.floor(F.col("k") / 10), F.struct("ts", "event_id")).alias("current"))
    x = e.withColumn("module", m).withColumn("line", F.floor(F.col("k") / 10))
    on = x.join(F.broadcast(lines), "module").where(F.col("line") == F.col("current"))  # eight rows
    bad: Column = F.lit(False)
    for r in MODULES:
        bad = bad | ((F.col("module") == int(r.used)) & F.coalesce(F.expr(r.failure()), F.lit(False)))
    return on.where(F.col("user_id").isNotNull()).groupBy("module", "date", "user_id").agg(F.max(bad.cast("int")).alias("bad"))


def _module_sql(r: Rule) -> str:
    return f"""(with w as (select * from {q(W5_START, AS_OF)} where {MODULE} = {r.used} and user_id is not null),
 cur as (select k // 10 as line from {q(None, AS_OF)} where {MODULE} = {r.used} and k is not null order by ts desc, event_id desc limit 1),
 x as (select * from w where k // 10 = (select line from cur))
 select t.date, round((t.n - coalesce(f.n, 0)) / t.n * 100, 6) as pct from (select date, count(distinct user_id) as n from x group by 1) t
 left join (select date, count(distinct user_id) as n from x where {r.failure()} group by 1) f on f.date = t.date)"""


def module_percentages(spark: SS, d: str) -> DataFrame:
    """module, date, pct over the last five days, all modules in one scan."""
    every = cat.read_events(ev(spark, d), None, YESTERDAY).withColumn("k", k_col())
    rows = module_rows(cat.read_events(every, W5_START, YESTERDAY), every)
    return rows.groupBy("module", "date").agg(r6((F.count(F.lit(1)) - F.sum("bad")) / F.count(F.lit(1)) * 100).alias("pct"))


@query("R72b_module_dashboard_full", "select c.date, c.pct as content, " + ", ".join(f"m{r.used}.pct as {r.name}" for r in MODULES[1:])
       + f" from {_module_sql(MODULES[0])} c " + " ".join(f"left join {_module_sql(r)} m{r.used} on m{r.used}.date = c.date" for r in MODULES[1:]))
def r72b(spark: SS, d: str) -> DataFrame:
    """Reliability of all eight modules side by side, on the days of the content module."""
    g = module_percentages(spark, d).groupBy("date").agg(
        *[F.max(F.when(F.col("module") == int(r.used), F.col("pct"))).alias(r.name) for r in MODULES])
    return g.where(F.col("content").isNotNull()).orderBy(F.col("date").desc())


@query("R71c_watchdog_reliability", f"select * from {_module_sql(MODULES[6])}")
def r71c(spark: SS, d: str) -> DataFrame:
    """Watchdog reliability on its current version."""
    return module_percentages(spark, d).where(F.col("module") == 6).select("date", "pct")


@query("R71d_second_os_reliability", f"select * from {_module_sql(MODULES[7])}")
def r71d(spark: SS, d: str) -> DataFrame:
    """Reliability of the second system's player: its errors but for the excluded ones, on its current version."""
    return module_percentages(spark, d).where(F.col("module") == 7).select("date", "pct")


# ------------------------------------------------------------------ R22, R23: stable displays, widget dashboard
def _usage_sql(d0: dt.date | None, d1: dt.date) -> str:
    w = f"(select * from {q(d0, d1)} where user_id is not null and user_id in (select user_id from {q(d0, d1)} where {STABLE_SQL}))"
    return f"""(select u.date as usage_date, u.n as "usageCount", coalesce(e.n, 0) as "errorCount", round(1 - coalesce(e.n, 0) / u.n, 6) as "Reliability",
 coalesce(s.n, 0) as "componentUsageCount" from (select date, count(distinct user_id) as n from {w} group by 1) u
 left join (select date, count(distinct user_id) as n from {w} where event_type = 'error' and value > 40 group by 1) e on e.date = u.date
 left join (select date, count(distinct user_id) as n from {w} where event_type = 'view' and value > 50 group by 1) s on s.date = u.date)"""


@rollup("R22b_reliability_of_stable_displays", f"""
select * from {_usage_sql(W3_START, AS_OF)} union all select * from {_usage_sql(None, W3_START)} where usage_date < date '{W3_START}'""",
        start=W3_START, date_col="usage_date")
def r22b(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Usage, errors and component usage per day of stable displays: three days spliced over the stored ones."""
    w = cat.read_events(ev(spark, d), first, last).where(F.col("user_id").isNotNull())
    stable = w.where(F.expr(STABLE_SQL)).select("user_id").distinct()
    x = w.join(stable, "user_id", "left_semi")
    c = distinct_counts(x, "date", "user_id", {
        "usageCount": F.lit(True), "errorCount": F.expr("event_type = 'error' and value > 40"),
        "componentUsageCount": F.expr("event_type = 'view' and value > 50")})
    return c.select(F.col("date").alias("usage_date"), "usageCount", "errorCount",
                    r6(1 - F.col("errorCount") / F.col("usageCount")).alias("Reliability"), "componentUsageCount")


SHOWN = ["calendar", "image_file", "image_folder", "video_file", "video_folder"]


@query("R23b_widget_dashboard", f"""
with s as (select * from ({ORACLE["R20b_widget_kinds"]}) where date between date '{W7_START}' and date '{AS_OF}' and total_count > 1)
select c.date, {', '.join(f"(select round((total_count - failed_count) / total_count, 6) from s where s.kind = '{k}' and s.date = c.date) as {k}_r" for k in SHOWN)}
from s c where c.kind = '{SHOWN[0]}'""")
def r23b(spark: SS, d: str) -> DataFrame:
    """Reliability of the widgets side by side over a week, from their stored daily stats, on the days of the first."""
    s = spliced(spark, d, ROLLUPS["R20b_widget_kinds"]).where(
        F.col("date").between(F.lit(W7_START), F.lit(AS_OF)) & (F.col("total_count") > 1))
    rel = r6((F.col("total_count") - F.col("failed_count")) / F.col("total_count"))
    g = s.groupBy("date").agg(*[F.max(F.when(F.col("kind") == k, rel)).alias(f"{k}_r") for k in SHOWN])
    return g.where(F.col(f"{SHOWN[0]}_r").isNotNull()).orderBy(F.col("date").desc())


# ------------------------------------------------------------------ R75: activity of three sources
ENTRY = f"(event_type in ('view', 'click') and props not like '{BETA_LIKE}')"
ACTIVE = f"(({ENTRY} and value < 20) or (event_type = 'signup' and value < 5 and props not like '{BETA_LIKE}'))"
LOCAL = "(event_type = 'error' and value > 80)"
SPAN = 30


def _ratio_sql(day: dt.date) -> str:
    def companies(first: dt.date) -> str:
        w = q(first, day + D(days=1))
        return (f"(select count(distinct c_nationkey) from customer where c_custkey in (select user_id from {w} where {ACTIVE} union all "
                f"select user_id from {w} where {LOCAL} and user_id in (select user_id from {w} where {ENTRY})))")
    return (f"select date '{day}' as date, {companies(day)} as daily_active_companies, {companies(day - D(days=SPAN - 1))} as monthly_active_companies")


_DAYS = [AS_OF - D(days=n) for n in range(1, 4)]


@query("R75b_active_company_ratio_full", f"""
select *, round(daily_active_companies / monthly_active_companies, 6) as daily_monthly_active_company_ratio
from ({' union all '.join(_ratio_sql(x) for x in _DAYS)}) where monthly_active_companies > 0""")
def r75b(spark: SS, d: str) -> DataFrame:
    """Companies active on a day and in the thirty days up to it, for the last three days: displays of two players,
    and those of local storage that the first player has seen in the same span.

    One aggregation per display and day, then one per display and report day (a display-day reaches at most
    three report days), then one per company.
    """
    first, last = _DAYS[-1], _DAYS[0]
    w = cat.read_events(ev(spark, d), first - D(days=SPAN - 1), last).where(F.col("user_id").isNotNull())
    flag = lambda c: F.max(F.coalesce(F.expr(c), F.lit(False)).cast("int"))
    per = w.groupBy("user_id", "date").agg(flag(ACTIVE).alias("a"), flag(LOCAL).alias("l"), flag(ENTRY).alias("e"))
    a, z = F.greatest("date", F.lit(first)), F.least(F.date_add("date", SPAN - 1), F.lit(last))
    x = per.where((F.col("a") + F.col("l") + F.col("e") > 0) & (a <= z)).withColumn("rd", F.explode(F.sequence(a, z)))
    today = (F.col("date") == F.col("rd")).cast("int")
    g = x.groupBy("user_id", "rd").agg(*[F.max(n).alias(n) for n in "ale"], *[F.max(F.col(n) * today).alias(f"t{n}") for n in "ale"])
    act = lambda p: (F.col(f"{p}a") == 1) | ((F.col(f"{p}l") == 1) & (F.col(f"{p}e") == 1))
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey")
    y = g.select("user_id", "rd", act("").alias("month"), act("t").alias("day")).where("month").join(c, F.col("user_id") == c.c_custkey)
    out = distinct_counts(y, "rd", "c_nationkey", {"daily_active_companies": F.col("day"), "monthly_active_companies": F.col("month")})
    return out.select(F.col("rd").alias("date"), "daily_active_companies", "monthly_active_companies",
                      r6(F.col("daily_active_companies") / F.col("monthly_active_companies")).alias("daily_monthly_active_company_ratio"))


# ------------------------------------------------------------------ R106: with cancellations
@query("R106b_subscription_changes_full", """
with s as (select cast(date_trunc('month', o_orderdate) as date) as collectionDate, o_custkey as companyId, o_orderpriority as subscriptionId,
 o_orderpriority as name, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as status, min(o_orderdate) as startDate, max(o_orderdate) as renewalDate,
 max(case when o_orderstatus = 'F' then o_orderdate end) as cancellationDate,
 arg_max(case when o_totalprice > 200000 then 'price' else 'other' end, (o_orderdate, o_orderkey)) filter (where o_orderstatus = 'F') as cancellationReason,
 round(sum(o_totalprice), 2) as amount from orders group by 1, 2, 3),
l as (select * from s where collectionDate = (select max(collectionDate) from s)),
p as (select * from s where collectionDate = (select max(collectionDate) from s where collectionDate < (select max(collectionDate) from s)))
select l.companyId, l.subscriptionId, l.name, l.status, l.startDate, l.renewalDate, l.cancellationDate, l.cancellationReason, l.amount
from l left join p on l.companyId = p.companyId and l.subscriptionId = p.subscriptionId where p.companyId is null or l.name is distinct from p.name
 or l.status is distinct from p.status or l.startDate is distinct from p.startDate or l.renewalDate is distinct from p.renewalDate
 or l.cancellationDate is distinct from p.cancellationDate or l.cancellationReason is distinct from p.cancellationReason or l.amount is distinct from p.amount""")
def r106b(spark: SS, d: str) -> DataFrame:
    """Subscriptions of the latest snapshot that are new or changed, cancellation date and reason among the compared fields."""
    o = tbl(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderpriority")
    ended = F.col("o_orderstatus") == "F"
    at = F.struct("o_orderdate", "o_orderkey")
    reason = F.when(F.col("o_totalprice") > 200000, "price").otherwise("other")
    s = o.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("collectionDate"), F.col("o_custkey").alias("companyId"),
                  F.col("o_orderpriority").alias("subscriptionId")).agg(
        F.first("o_orderpriority").alias("name"), F.max_by("o_orderstatus", at).alias("status"), F.min("o_orderdate").alias("startDate"),
        F.max("o_orderdate").alias("renewalDate"), F.max(F.when(ended, F.col("o_orderdate"))).alias("cancellationDate"),
        F.max_by(reason, F.when(ended, at)).alias("cancellationReason"), F.round(F.sum("o_totalprice"), 2).alias("amount"))
    return snapshot_diff(s, "collectionDate", ["companyId", "subscriptionId"],
                         ["name", "status", "startDate", "renewalDate", "cancellationDate", "cancellationReason", "amount"])


# ------------------------------------------------------------------ R123: windows of two years and ninety days
W2Y_START, W90_START = dt.date(AS_OF.year - 2, AS_OF.month, min(AS_OF.day, 28)), AS_OF - D(days=90)


@query("R123d_weekly_display_count_two_years", f"""
select year(ts)::bigint as year, ceil(dayofyear(ts) / 7)::bigint as week, count(distinct user_id) as displays
from {q(W2Y_START, AS_OF)} where event_type = 'view' group by 1, 2""")
def r123d(spark: SS, d: str) -> DataFrame:
    """Displays that asked for content, per week of the last two years."""
    e = cat.read_events(ev(spark, d), W2Y_START, YESTERDAY).where(F.col("event_type") == "view")
    return e.groupBy(F.year("ts").cast("long").alias("year"), TU.ceil_week("ts").alias("week")).agg(F.count_distinct("user_id").alias("displays"))


@query("R123e_daily_display_counts_ninety_days", f"""
select date, count(distinct user_id) as displays, count(distinct case when event_type in ('view', 'click') then user_id end) as core,
 count(distinct case when event_type in ('signup', 'purchase') then user_id end) as client from {q(W90_START, AS_OF)} where user_id is not null group by 1""")
def r123e(spark: SS, d: str) -> DataFrame:
    """Displays per day of the last ninety, and those seen by the core and by the clients."""
    e = cat.read_events(ev(spark, d), W90_START, YESTERDAY).where(F.col("user_id").isNotNull())
    return distinct_counts(e, "date", "user_id", {
        "displays": F.lit(True), "core": F.col("event_type").isin("view", "click"), "client": F.col("event_type").isin("signup", "purchase")})
