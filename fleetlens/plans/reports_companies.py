"""Report jobs: companies, schedules, billing, storage (R100-R112) and request-log
analytics (R120-R125).

Bindings as in ``reports.py``; additionally for the nested schedule data:
displays = customers (display id ``c_custkey``, company ``c_nationkey``);
schedules = orders (company = the nation of the ordering customer, schedule
distributes to all when priority is '1-URGENT', else to the ordering
customer's display); content items = the order's line items (presentation id
``l_partkey`` when ``l_returnflag = 'N'``, to all when ``l_linestatus = 'O'``,
else to display ``l_suppkey``); placeholders of a presentation (order) = its
line items (visible when ``l_linestatus = 'O'``, time-defined when
``l_returnflag <> 'N'``, valid from ``l_shipdate - 60 days`` to ``l_shipdate``).
Request log = events (latency/pending = value, instance and version = k).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions import columns as C
from fleetlens.functions import timeutil as TU
from fleetlens.operators import joins as J
from fleetlens.operators.nested import snapshot_diff
from fleetlens.operators.reliability import funnel
from fleetlens.operators.rollup import one_scan_union
from fleetlens.plans.dataflow import r08
from fleetlens.plans.registry import query
from fleetlens.plans.rollups import rollup
from fleetlens.plans.reports_uptime import BILLING_SQL, billing_export
from fleetlens.plans.reports import W3_START, W7_START, ev, k_col, q
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl
from fleetlens.sources import catalog as cat

SS = SparkSession
r6 = C.r
D = dt.timedelta
NOW = dt.datetime.combine(AS_OF, dt.time())
W30_START = AS_OF - D(days=30)
FIRST_WEEK = AS_OF - D(days=AS_OF.weekday(), weeks=15)  # 16 weeks ending with the as-of week


# =========================================================== R100-R101 active companies
def activity(spark: SS, d: str) -> DataFrame:
    """Company activity from four sources (display contact, login, subscription,
    purchase); company = the device's customer.  Only production, non-test
    companies count: an existence-only join to that key set (J07, semi join)."""
    e = ev(spark, d)
    t = F.col("event_type")
    srcs = {"display_contact": t == "view", "login": t == "signup", "subscription": t == "purchase",
            "purchase": (t == "click") & (F.col("value") > 50)}
    u = one_scan_union(e, srcs, [F.col("user_id").alias("companyId"), "ts"], distinct=False)  # disjoint: UNION ALL
    companies = tbl(spark, d, "customer", "c_custkey", "c_acctbal").where(F.col("c_acctbal") >= 0) \
        .select(F.col("c_custkey").alias("companyId"))
    return J.semi(u, companies, "companyId")


ACTIVITY_SQL = """(select a.user_id as companyId, a.ts from (select user_id, ts from events where event_type in ('view', 'signup', 'purchase')
 or (event_type = 'click' and value > 50)) a where a.user_id in (select c_custkey from customer where c_acctbal >= 0))"""


@query("R100_weekly_active_companies", f"""
select distinct strftime(cast(date_trunc('week', ts) as date) + interval 7 day - interval 1 microsecond, '%d-%b') as weekOf,
 cast(date_trunc('week', ts) as date) as startDate, cast(date_trunc('week', ts) as date) + 7 as endDate, companyId
from {ACTIVITY_SQL} where ts >= timestamp '{FIRST_WEEK}'""")
def r100(spark: SS, d: str) -> DataFrame:
    a = activity(spark, d)
    a = a.where(F.col("ts") >= cat.day_start(FIRST_WEEK))
    s, e = TU.period_bounds("ts", "WEEK")
    cal = a.select(s.alias("startDate"), e.alias("endDate")).distinct()
    j = J.join_calendar(a, cal, "ts", "startDate", "endDate", grain="week")
    return j.select(TU.period_label("startDate", "WEEK", "dd-MMM").alias("weekOf"), "startDate", "endDate",
                    "companyId").distinct()


@query("R101_monthly_active_companies", """
select distinct strftime(cast(date_trunc('month', ts) as date) + interval 1 month - interval 1 microsecond, '%b-%y') as month, cast(date_trunc('month', ts) as date) as startDate,
 cast(date_trunc('month', ts) + interval 1 month as date) as endDate, companyId from """ + ACTIVITY_SQL + """
where ts >= timestamp '2023-08-01'""")
def r101(spark: SS, d: str) -> DataFrame:
    a = activity(spark, d).where(F.col("ts") >= cat.day_start("2023-08-01"))
    s, e = TU.period_bounds("ts", "MONTH")
    return a.select(TU.period_label(s, "MONTH", "MMM-yy").alias("month"), s.alias("startDate"), e.alias("endDate"),
                    "companyId").distinct()


@query("R101b_active_companies_by_month", f"""
select year(ts)::bigint as year, month(ts)::bigint as month, count(distinct companyId) as companies from {ACTIVITY_SQL} group by 1, 2""")
def r101b(spark: SS, d: str) -> DataFrame:
    a = activity(spark, d)
    return a.groupBy(F.year("ts").cast("long").alias("year"), F.month("ts").cast("long").alias("month")) \
        .agg(F.count_distinct("companyId").alias("companies"))


# =========================================================== R102-R107
NONTEST_SQL = "(select c_custkey from customer where c_acctbal >= 0)"


def _nontest_companies(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "customer", "c_custkey", "c_acctbal").where(F.col("c_acctbal") >= 0) \
        .select(F.col("c_custkey").alias("user_id"))


@query("R102_todays_displays", f"""
select user_id as displayId, user_id as companyId, max(ts) as lastConnectionTime, count(ts) as numberOfConnections
from {q(YESTERDAY, AS_OF)} where event_type = 'view' and user_id in {NONTEST_SQL} group by 1, 2""")
def r102(spark: SS, d: str) -> DataFrame:
    """Today's connecting displays (display requests of the last day) of non-test
    companies (existence join), with last connection and number of connections."""
    e = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY).where(F.col("event_type") == "view")
    x = J.semi(e, _nontest_companies(spark, d), "user_id")
    return x.groupBy(F.col("user_id").alias("displayId"), F.col("user_id").alias("companyId")) \
        .agg(F.max("ts").alias("lastConnectionTime"), F.count("ts").alias("numberOfConnections"))


# Binding (R102b): company creation = first signup, first payment = first purchase;
# window = the 30 days of data (the view's 2 days would hold no creation here).
@query("R102b_activation_conversion_kpi", f"""
with firsts as (select user_id, min(date) filter (where event_type = 'signup') as created,
  min(date) filter (where event_type = 'purchase') as first_paid from {q()} group by 1),
conn as (select distinct user_id from {q(W30_START, AS_OF)} where event_type = 'view' and user_id in {NONTEST_SQL}),
created as (select user_id from firsts where created >= date '{W30_START}' and created < date '{AS_OF}'),
u as (select count(distinct created.user_id) as totalCreated, count(distinct conn.user_id) as totalActivatedDisplays
  from created left join conn on conn.user_id = created.user_id),
p as (select count(distinct user_id) as madeFirstPurchase from firsts where first_paid >= date '{W30_START}' and first_paid < date '{AS_OF}'),
t as (select count(distinct user_id) as total from conn)
select u.totalActivatedDisplays as activatedDisplays, coalesce(p.madeFirstPurchase, 0) as madeFirstPurchase, u.totalCreated,
 round(u.totalActivatedDisplays / u.totalCreated, 6) as activationRatio, round(coalesce(p.madeFirstPurchase, 0) / t.total, 6) as customerConversionRatio
from u, p, t""")
def r102b(spark: SS, d: str) -> DataFrame:
    """Activation and conversion KPI row: companies created in the window, those whose
    display connected, companies paying for the first time, and the two ratios.
    Each part is a one-row aggregate; they are cross joined (size proven)."""
    e = ev(spark, d)
    firsts = e.groupBy("user_id").agg(F.min(F.when(F.col("event_type") == "signup", F.col("date"))).alias("created"),
                                      F.min(F.when(F.col("event_type") == "purchase", F.col("date"))).alias("first_paid"))
    in_win = lambda c: (F.col(c) >= F.lit(W30_START)) & (F.col(c) < F.lit(AS_OF))
    conn = J.semi(cat.read_events(e, W30_START, YESTERDAY).where(F.col("event_type") == "view").select("user_id").distinct(),
                  _nontest_companies(spark, d), "user_id")
    created = firsts.where(in_win("created")).select("user_id")
    u = created.join(conn.withColumn("c", F.lit(True)), "user_id", "left").agg(
        F.count(F.lit(1)).alias("totalCreated"), F.count_if(F.col("c").isNotNull()).alias("activatedDisplays"))
    p = firsts.where(in_win("first_paid")).agg(F.count(F.lit(1)).alias("madeFirstPurchase"))
    t = conn.agg(F.count(F.lit(1)).alias("total"))
    k = u.crossJoin(p).crossJoin(t)
    return k.select("activatedDisplays", "madeFirstPurchase", "totalCreated",
                    r6(C.safe_ratio("activatedDisplays", "totalCreated")).alias("activationRatio"),
                    r6(C.safe_ratio("madeFirstPurchase", "total")).alias("customerConversionRatio"))


@query("R103_registration_funnel_weekly", f"""
with ent as (select user_id, min(ts) as first_ts from events where event_type = 'signup' group by 1),
ent2 as (select user_id, (floor((dayofyear(first_ts) + dayofweek(date_trunc('year', first_ts)) + 1 - 2) / 7) + 1)::bigint as cohort from ent),
r as (select user_id, max(case when event_type = 'view' then 1 else 0 end) as has_view, max(case when event_type = 'purchase' then 1 else 0 end) as has_purchase
 from events group by 1)
select cohort, count(distinct ent2.user_id) as registered, count(distinct case when has_view = 1 then ent2.user_id end) as reached_view,
 count(distinct case when has_purchase = 1 then ent2.user_id end) as reached_purchase from ent2 left join r on r.user_id = ent2.user_id group by 1""")
def r103(spark: SS, d: str) -> DataFrame:
    e = tbl(spark, d, "events")
    ent = e.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.min("ts").alias("first_ts")) \
        .select("user_id", TU.legacy_week("first_ts").alias("cohort"))
    return funnel(ent, e, entity="user_id", cohort_col="cohort", event_col="event_type", steps=["view", "purchase"])


@query("R104_customer_journey", f"""
with f as (select user_id, min(date) filter (where event_type = 'signup') as signup_date, min(date) filter (where event_type = 'view') as first_view,
 min(date) filter (where event_type = 'purchase') as first_purchase from {q()} group by 1)
select f.user_id, c.c_mktsegment as industry, f.signup_date, f.first_view, datediff('day', f.signup_date, f.first_view)::bigint as days_to_view,
 f.first_purchase, datediff('day', f.signup_date, f.first_purchase)::bigint as days_to_purchase
from f left join customer c on c.c_custkey = f.user_id""")
def r104(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    f = e.groupBy("user_id").agg(*[F.min(F.when(F.col("event_type") == t, F.col("date"))).alias(n) for t, n in
                                   [("signup", "signup_date"), ("view", "first_view"), ("purchase", "first_purchase")]])
    c = tbl(spark, d, "customer", "c_custkey", "c_mktsegment")
    j = f.join(c, f.user_id == c.c_custkey, "left")
    return j.select("user_id", F.col("c_mktsegment").alias("industry"), "signup_date", "first_view",
                    F.datediff("first_view", "signup_date").cast("long").alias("days_to_view"), "first_purchase",
                    F.datediff("first_purchase", "signup_date").cast("long").alias("days_to_purchase"))


# Binding: registration = 'signup', company creation = 'purchase', the one host = tags below 90.
@query("R105_signups_daily", f"""
select date as date_ts, sum(case when event_type = 'signup' then 1 else 0 end)::bigint as cnt_user_registered,
 sum(case when event_type = 'purchase' then 1 else 0 end)::bigint as cnt_company_created, count(event_type) as total
from {q(AS_OF - D(days=366), AS_OF + D(days=1))} where event_type in ('signup', 'purchase') and k < 90 group by 1""")
def r105(spark: SS, d: str) -> DataFrame:
    """Sign-up events per day over the last year for one host: registrations, company
    creations and both together (event counts, not distinct users)."""
    e = cat.read_events(ev(spark, d), AS_OF - D(days=366), AS_OF)
    e = e.where(F.col("event_type").isin("signup", "purchase") & (k_col() < 90))
    return e.groupBy(F.col("date").alias("date_ts")).agg(
        F.sum(F.when(F.col("event_type") == "signup", 1).otherwise(0)).cast("long").alias("cnt_user_registered"),
        F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).cast("long").alias("cnt_company_created"),
        F.count("event_type").alias("total"))


# Binding (R106): subscription snapshots = orders per month (collectionDate), company
# = customer, subscription = order priority; name = priority, status = the latest
# order status, start / renewal = first / last order date, amount = total price.
@query("R106_subscription_changes", """
with s as (select cast(date_trunc('month', o_orderdate) as date) as collectionDate, o_custkey as companyId,
 o_orderpriority as subscriptionId, o_orderpriority as name, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as status,
 min(o_orderdate) as startDate, max(o_orderdate) as renewalDate, round(sum(o_totalprice), 2) as amount from orders group by 1, 2, 3),
d1 as (select max(collectionDate) as d from s), d0 as (select max(collectionDate) as d from s where collectionDate < (select d from d1)),
cur as (select * from s where collectionDate = (select d from d1)), prev as (select * from s where collectionDate = (select d from d0))
select cur.companyId, cur.subscriptionId, cur.name, cur.status, cur.startDate, cur.renewalDate, cur.amount
from cur left join prev on cur.companyId = prev.companyId and cur.subscriptionId = prev.subscriptionId
where prev.companyId is null or cur.name is distinct from prev.name or cur.status is distinct from prev.status
 or cur.startDate is distinct from prev.startDate or cur.renewalDate is distinct from prev.renewalDate
 or cur.amount is distinct from prev.amount""")
def r106(spark: SS, d: str) -> DataFrame:
    """Subscriptions of the latest snapshot that are new or changed against the
    previous snapshot (keys company + subscription; NULL-safe comparison)."""
    o = tbl(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice", "o_orderpriority")
    s = o.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("collectionDate"), F.col("o_custkey").alias("companyId"),
                  F.col("o_orderpriority").alias("subscriptionId")) \
        .agg(F.first("o_orderpriority").alias("name"),
             F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status"),
             F.min("o_orderdate").alias("startDate"), F.max("o_orderdate").alias("renewalDate"),
             F.round(F.sum("o_totalprice"), 2).alias("amount"))
    return snapshot_diff(s, "collectionDate", ["companyId", "subscriptionId"],
                         ["name", "status", "startDate", "renewalDate", "amount"])


@query("R107_licensed_displays_active_plans", """
with subs as (select c_custkey as companyId, case when c_mktsegment = 'AUTOMOBILE' then c_nationkey else c_custkey end as planCompanyId,
 c_mktsegment as planSubscriptionStatus, case when c_acctbal > 0 then floor(c_acctbal / 2000) end as planProCount from customer),
ord as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as pos from orders)
select distinct s.companyId, o.o_orderkey as displayId, s.planCompanyId as licensedBy, s.planSubscriptionStatus
from subs s join ord o on o.o_custkey = s.companyId where o.pos < coalesce(s.planProCount, 0)
and s.planSubscriptionStatus in ('AUTOMOBILE', 'BUILDING', 'MACHINERY')""")
def r107(spark: SS, d: str) -> DataFrame:
    return r08(spark, d).where(F.col("planSubscriptionStatus").isin("AUTOMOBILE", "BUILDING", "MACHINERY"))


# =========================================================== R108-R110 nested schedules
def displays(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "customer", F.col("c_custkey").alias("displayId"), F.col("c_nationkey").alias("companyId"))


def scheduled_presentations(spark: SS, d: str, only: DataFrame | None = None) -> DataFrame:
    """Presentation items of the schedules, from the items as they come (one row each): they are not nested first.

    ``only``: a small relation of presentationId; other items are left out before they meet their schedules.
    """
    o = tbl(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    li = tbl(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    items = li.where((F.col("l_returnflag") == "N") & F.col("l_partkey").isNotNull()).withColumn(
        "presentationId", F.col("l_partkey").cast("string"))
    if only is not None:
        items = J.semi(items, F.broadcast(only), "presentationId")
    x = items.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(displays(spark, d), F.col("o_custkey") == F.col("displayId"))
    s_all, ci_all = F.col("o_orderpriority") == "1-URGENT", F.col("l_linestatus") == "O"
    return x.select(F.col("o_orderkey").alias("scheduleId"), "companyId", "presentationId",
                    (s_all & ci_all).alias("distributeToAll"),
                    F.concat(C.concat_if_not(s_all, F.array("o_custkey")), C.concat_if_not(ci_all, F.array("l_suppkey"))).alias("distribution"))


SCHED_SQL = """(select o.o_orderkey as scheduleId, c.c_nationkey as companyId, cast(l.l_partkey as varchar) as presentationId,
 (o.o_orderpriority = '1-URGENT' and l.l_linestatus = 'O') as distributeToAll,
 list_concat(case when o.o_orderpriority = '1-URGENT' then [] else [o.o_custkey] end,
             case when l.l_linestatus = 'O' then [] else [l.l_suppkey] end) as distribution
 from orders o join customer c on c.c_custkey = o.o_custkey join lineitem l on l.l_orderkey = o.o_orderkey where l.l_returnflag = 'N')"""


@query("R108_presentations_on_displays", f"""
select distinct presentationId, unnest(distribution) as displayId, null::bigint as companyId from {SCHED_SQL}
 where distributeToAll = false and len(distribution) > 0
union all select distinct presentationId, null::bigint, companyId from {SCHED_SQL} where distributeToAll = true""")
def r108(spark: SS, d: str, only: DataFrame | None = None) -> DataFrame:
    """(presentation, display) for explicit distributions; for "distribute to all"
    one (presentation, company) row standing for every display of the company
    (expanding it is a join with the display list; it is not materialised here).

    ``only``: as for ``scheduled_presentations``."""
    p = scheduled_presentations(spark, d, only)
    # one pass: explicit rows explode their distribution; company-wide rows explode
    # a single NULL display (no second scan of the schedules for a union branch)
    to_all = F.col("distributeToAll")
    targets = F.when(to_all, F.array(F.lit(None).cast("long"))).otherwise(F.col("distribution"))
    x = p.where(to_all | (F.size("distribution") > 0)).select(
        "presentationId", F.explode(targets).alias("displayId"),
        F.when(to_all, F.col("companyId")).cast("long").alias("companyId"))
    return x.distinct()


@query("R108b_presentation_reach", f"""
with pairs as (select presentationId, unnest(distribution) as displayId from {SCHED_SQL} where distributeToAll = false and len(distribution) > 0
 union select p.presentationId, c.c_custkey from {SCHED_SQL} p join customer c on c.c_nationkey = p.companyId where p.distributeToAll = true)
select presentationId, count(distinct displayId) as displays from pairs group by 1""")
def r108b(spark: SS, d: str) -> DataFrame:
    """Distinct displays each presentation reaches, without expanding company-wide rows:
    company sizes for the company-wide part plus explicit displays outside those companies."""
    r = r108(spark, d)
    disp = displays(spark, d)
    # every R108 row placed in its company: company-wide rows carry it, explicit
    # rows get their display's company (one row per display -> plain equi-join)
    x = r.join(disp.select("displayId", F.col("companyId").alias("dcomp")), "displayId", "left") \
        .select("presentationId", "displayId", F.coalesce("companyId", "dcomp").alias("comp"),
                F.col("companyId").isNotNull().alias("all"))
    per = x.groupBy("presentationId", "comp").agg(F.max(F.col("all").cast("int")).alias("all"),
                                                  F.count_distinct("displayId").alias("explicit"))
    size = disp.groupBy(F.col("companyId").alias("comp")).agg(F.count(F.lit(1)).alias("n"))
    j = per.join(size, "comp", "left")
    reached = F.when(F.col("all") == 1, F.coalesce("n", F.lit(0))).otherwise(F.col("explicit"))
    return j.groupBy("presentationId").agg(F.sum(reached).cast("long").alias("displays"))


PL_AS_OF = dt.date(1998, 6, 1)


def placeholders(spark: SS, d: str) -> DataFrame:
    """The placeholders of every presentation, one row each (a line item is one).

    Binding of the recurrence: hours are set from quantity 30 on, the kind follows the
    supplier, the interval the line number, the days the tax.
    """
    li = tbl(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus", "l_quantity",
             "l_suppkey", "l_tax")
    kind = F.element_at(F.array(F.lit(None).cast("string"), F.lit("Daily"), F.lit("Weekly"), F.lit("Monthly")),
                        (F.col("l_suppkey") % 4 + 1).cast("int"))
    hours = F.col("l_quantity") >= 30
    return li.select(
        F.col("l_orderkey").alias("presentationId"), F.col("l_linenumber").alias("id"),
        (F.col("l_returnflag") != "N").alias("timeDefined"),
        F.date_sub(F.to_date("l_shipdate"), 60).alias("startDate"), F.to_date("l_shipdate").alias("endDate"),
        F.when(F.col("l_linestatus") == "O", F.lit(True)).alias("visibility"),
        F.when(hours, "08:00:00").alias("startTime"), F.when(hours, "17:00:00").alias("endTime"),
        kind.alias("recurrenceType"), (F.col("l_linenumber") % 2 + 1).alias("recurrenceFrequency"),
        F.when(F.col("l_tax") < 0.04, 7).otherwise(5).alias("recurrenceDays"))


PL_SQL = """(select l_orderkey as presentationId, l_linenumber as id, l_returnflag <> 'N' as timeDefined,
 cast(l_shipdate as date) - 60 as startDate, cast(l_shipdate as date) as endDate, case when l_linestatus = 'O' then true end as visibility,
 case when l_quantity >= 30 then '08:00:00' end as startTime, case when l_quantity >= 30 then '17:00:00' end as endTime,
 [null, 'Daily', 'Weekly', 'Monthly'][(l_suppkey % 4 + 1)::int] as recurrenceType, l_linenumber % 2 + 1 as recurrenceFrequency,
 case when l_tax < 0.04 then 7 else 5 end as recurrenceDays from lineitem)"""


def shown_sql(day: dt.date) -> str:
    """Whether a placeholder row can be seen on ``day`` (SQL)."""
    return (f"(coalesce(visibility, true) and (not coalesce(timeDefined, false) "
            f"or date '{day}' between coalesce(startDate, date '{day}') and coalesce(endDate, date '{day}')))")


def none_showing(rows: DataFrame, showing, key: str = "presentationId") -> DataFrame:
    """Keys none of whose rows satisfies ``showing`` (NULL counts as not showing)."""
    g = rows.groupBy(key).agg(F.max(F.coalesce(showing, F.lit(False)).cast("int")).alias("__any"))
    return g.where(F.col("__any") == 0).select(key)


def in_dates(day: dt.date) -> Column:
    """``day`` lies between startDate and endDate; a missing bound is open."""
    t = F.lit(day)
    return t.between(F.coalesce("startDate", t), F.coalesce("endDate", t))


def untimed() -> Column:
    return ~F.coalesce("timeDefined", F.lit(False))


def _showing(asof: dt.date) -> Column:
    return F.coalesce("visibility", F.lit(True)) & (untimed() | in_dates(asof))


def _plays_always() -> Column:
    """No time restriction within its dates: untimed, or without hours and recurring every day."""
    each = F.col("recurrenceFrequency") == 1
    daily = (F.col("recurrenceType").isNull() | ((F.col("recurrenceType") == "Daily") & each)
             | ((F.col("recurrenceType") == "Weekly") & each & (F.col("recurrenceDays") == 7)))
    return untimed() | (F.col("startTime").isNull() & F.col("endTime").isNull() & daily)


@query("R109_presentations_with_no_content", f"""
select presentationId from {PL_SQL} group by presentationId having not bool_or({shown_sql(PL_AS_OF)})""")
def r109(spark: SS, d: str) -> DataFrame:
    pl = placeholders(spark, d)
    # NOT EXISTS over the same relation == no showing row in the presentation's group:
    # one aggregation, the placeholders are read once
    return none_showing(pl, _showing(PL_AS_OF))


@query("R109b_presentations_with_content_gaps", f"""
with shown as (select *, case when not coalesce(timeDefined, false) then 1
  when startTime is not null or endTime is not null then 0 when recurrenceType is null then 1
  when recurrenceFrequency <> 1 then 0 when recurrenceType = 'Daily' then 1
  when recurrenceType = 'Weekly' and recurrenceDays = 7 then 1 else 0 end as always
 from {PL_SQL} where {shown_sql(PL_AS_OF)})
select presentationId from shown group by presentationId having max(always) = 0""")
def r109b(spark: SS, d: str) -> DataFrame:
    """Gaps: presentations that show something on the day, but nothing that plays at all times."""
    return none_showing(placeholders(spark, d).where(_showing(PL_AS_OF)), _plays_always())


@query("R110_displays_with_white_screen", f"""
with bad as (select cast(presentationId as varchar) as presentationId from {PL_SQL} group by 1 having not bool_or({shown_sql(PL_AS_OF)}))
select distinct unnest(s.distribution) as displayId from {SCHED_SQL} s where s.distributeToAll = false and len(s.distribution) > 0
 and s.presentationId in (select presentationId from bad)
union select c.c_custkey from customer c where c.c_nationkey in (select s.companyId from {SCHED_SQL} s
 where s.distributeToAll = true and s.presentationId in (select presentationId from bad))""")
def r110(spark: SS, d: str) -> DataFrame:
    bad = r109(spark, d).select(F.col("presentationId").cast("string").alias("presentationId"))
    r = J.semi(r108(spark, d), bad, "presentationId")
    explicit = r.where(F.col("displayId").isNotNull()).select("displayId")
    comps = r.where(F.col("companyId").isNotNull()).select("companyId")
    company_wide = J.semi(displays(spark, d), comps, "companyId").select("displayId")
    return explicit.union(company_wide).distinct()


# =========================================================== R111-R112 billing / storage
# Binding (R111): the billing export of R90; the project list = the three return flags.
PROJECTS = ["A", "N", "R"]
COST_BY_PROJECT_SQL = f"""(select projectId as project_id, date, sum(cost) as total_cost from {BILLING_SQL}
 where projectId in ({', '.join(f"'{p}'" for p in PROJECTS)}) group by 1, 2)"""


def _cost_by_project(spark: SS, d: str) -> DataFrame:
    b = billing_export(spark, d).where(F.col("projectId").isin(*PROJECTS))
    return b.groupBy(F.col("projectId").alias("project_id"), "date").agg(F.sum("cost").alias("total_cost"))


@query("R111_cost_by_date_and_project", f"select project_id, date, round(total_cost, 6) as total_cost from {COST_BY_PROJECT_SQL}")
def r111(spark: SS, d: str) -> DataFrame:
    return _cost_by_project(spark, d).withColumn("total_cost", r6("total_cost"))


@query("R111b_project_cost_columns", f"""
with c as {COST_BY_PROJECT_SQL},
counts as (select date, count(distinct user_id) as total_display_count from {q()} group by 1)
select d.date, counts.total_display_count, round(sum(c.total_cost), 6) as total_cost,
 {', '.join(f"round(max(case when c.project_id = '{p}' then c.total_cost end), 6) as cost_{p}" for p in PROJECTS)}
from (select distinct date from c) d join c on c.date = d.date left join counts on counts.date = d.date
where d.date < date '{YESTERDAY}' group by 1, 2""")
def r111b(spark: SS, d: str) -> DataFrame:
    """Per day: the day's display count (installer-type total), the total cost and one
    column per project (pivot of the long table), days before yesterday."""
    c = _cost_by_project(spark, d).where(F.col("date") < F.lit(YESTERDAY))
    wide = c.groupBy("date").pivot("project_id", PROJECTS).agg(F.max("total_cost"))
    tot = c.groupBy("date").agg(F.sum("total_cost").alias("total_cost"))
    counts = ev(spark, d).groupBy("date").agg(F.count_distinct("user_id").alias("total_display_count"))
    j = tot.join(wide, "date").join(counts, "date", "left")
    return j.select("date", "total_display_count", r6("total_cost").alias("total_cost"),
                    *[r6(p).alias(f"cost_{p}") for p in PROJECTS])


# Binding (R112): storage access log = events with time_micros = epoch micros of ts,
# sc_bytes = bytes(payload) x 100, bucket = installer bucket for signup / purchase,
# referer carries 'type=sharedschedule' when value > 50.
def storage_log(spark: SS, d: str) -> DataFrame:
    e = tbl(spark, d, "events")
    return e.select("ts", TU.epoch_micros("ts").alias("time_micros"), (F.octet_length("props") * 100).alias("sc_bytes"),
                    F.when(F.col("event_type").isin("signup", "purchase"), "install-versions").otherwise("storage")
                    .alias("cs_bucket"),
                    F.concat(F.lit("https://apps/?"), F.when(F.col("value") > 50, "type=sharedschedule").otherwise("type=other"))
                    .alias("cs_referer"))


STORAGE_SQL = """(select ts, epoch_us(ts) as time_micros, strlen(props) * 100 as sc_bytes,
 case when event_type in ('signup', 'purchase') then 'install-versions' else 'storage' end as cs_bucket,
 'https://apps/?' || case when value > 50 then 'type=sharedschedule' else 'type=other' end as cs_referer from events)"""
NOW_90 = dt.datetime.combine(AS_OF - D(days=90), dt.time())


def _since(log: DataFrame, start: dt.datetime) -> DataFrame:
    """``time_micros > start`` on the integer column (converted once, Z24), plus the
    ts bound so the scan prunes row groups."""
    return log.where((F.col("ts") > TU.as_of_ts(start)) & (F.col("time_micros") > F.lit(int(start.replace(
        tzinfo=dt.timezone.utc).timestamp() * 1_000_000))))


@query("R112_storage_bandwidth", f"""
select cast(make_timestamp(time_micros) as date) as date, cast(sum(sc_bytes) as bigint) as bandwidth, count(*) as requests
from {STORAGE_SQL} where time_micros > epoch_us(timestamp '{NOW_90}') group by 1""")
def r112(spark: SS, d: str) -> DataFrame:
    log = _since(storage_log(spark, d), NOW_90)
    return log.groupBy(F.to_date(TU.from_epoch_micros("time_micros")).alias("date")) \
        .agg(F.sum("sc_bytes").cast("long").alias("bandwidth"), F.count(F.lit(1)).alias("requests"))


@query("R112b_installer_storage_by_referer", f"""
select cast(make_timestamp(time_micros) as date) as date, cast(sum(sc_bytes) as bigint) as bandwidth
from {STORAGE_SQL} where time_micros > epoch_us(timestamp '{NOW_90}') and cs_bucket = 'install-versions' group by 1""")
def r112b(spark: SS, d: str) -> DataFrame:
    log = _since(storage_log(spark, d), NOW_90).where(F.col("cs_bucket") == "install-versions")
    return log.groupBy(F.to_date(TU.from_epoch_micros("time_micros")).alias("date")) \
        .agg(F.sum("sc_bytes").cast("long").alias("bandwidth"))


@query("R112c_shared_schedule_storage", f"""
select cast(make_timestamp(time_micros) as date) as date, cast(sum(sc_bytes) as bigint) as bandwidth, count(*) as requests
from {STORAGE_SQL} where cast(ts as date) between date '{AS_OF - D(days=7)}' and date '{AS_OF}'
 and cs_referer like '%type=sharedschedule%' group by 1""")
def r112c(spark: SS, d: str) -> DataFrame:
    log = cat.read_events(storage_log(spark, d), AS_OF - D(days=7), AS_OF).where(F.col("cs_referer").like("%type=sharedschedule%"))
    return log.groupBy(F.to_date(TU.from_epoch_micros("time_micros")).alias("date")) \
        .agg(F.sum("sc_bytes").cast("long").alias("bandwidth"), F.count(F.lit(1)).alias("requests"))


# =========================================================== R120-R125 request log
def _requests(spark: SS, d: str, hours: int) -> DataFrame:
    e = tbl(spark, d, "events").where(F.col("ts") > TU.as_of_ts(NOW - D(hours=hours)))
    return e.withColumn("k", k_col())


REQ_SQL = lambda h: f"(select *, cast(nullif(regexp_extract(props, '(\\d+)', 1), '') as integer) as k from events where ts > timestamp '{NOW - D(hours=h)}')"


@query("R120_load_one_minute_with_top_version", f"""
with r as (select *, floor((epoch_us(timestamp '{NOW}') - epoch_us(ts)) / 60000000)::bigint as one_minute_prior_interval_group
 from {REQ_SQL(1)}),
stats as (select one_minute_prior_interval_group, round(sum(coalesce(value, 0)), 6) as pending_time, max(ts) as latest_time_in_interval,
 sum(k) / 1000 as gigacycles, round(sum(value), 6) as latency, count(distinct k) as instances,
 count(distinct case when event_type = 'view' then user_id end) as display_count, count(*) as request_count from r group by 1),
v as (select one_minute_prior_interval_group, cast(k // 10 as varchar) as viewer_version, count(*) as n from r where event_type = 'view' group by 1, 2),
top as (select one_minute_prior_interval_group, viewer_version from (select *, rank() over (partition by one_minute_prior_interval_group
 order by n desc) as rk from v) where rk = 1)
select stats.*, top.viewer_version as noisiest_viewer from stats left join top using (one_minute_prior_interval_group)""")
def r120(spark: SS, d: str) -> DataFrame:
    """Last hour of requests per one-minute group before the evaluation time, with the
    most frequent viewer version among display requests (ties kept, LEFT JOIN)."""
    r = _requests(spark, d, 1).withColumn("one_minute_prior_interval_group", TU.now_bucket("ts", NOW, 60_000_000))
    g = "one_minute_prior_interval_group"
    stats = r.groupBy(g).agg(
        r6(F.sum(F.coalesce("value", F.lit(0.0)))).alias("pending_time"), F.max("ts").alias("latest_time_in_interval"),
        (F.sum("k") / 1000).alias("gigacycles"), r6(F.sum("value")).alias("latency"),
        F.count_distinct("k").alias("instances"),
        F.count_distinct(F.when(F.col("event_type") == "view", F.col("user_id"))).alias("display_count"),
        F.count(F.lit(1)).alias("request_count"))
    v = r.where(F.col("event_type") == "view").groupBy(g, F.floor(F.col("k") / 10).cast("string").alias("viewer_version")) \
        .agg(F.count(F.lit(1)).alias("n"))
    # per-group partitions hold one row per version: bounded
    top = v.withColumn("rk", F.rank().over(Window.partitionBy(g).orderBy(F.col("n").desc()))).where("rk = 1")
    return stats.join(top.select(g, F.col("viewer_version").alias("noisiest_viewer")), g, "left")


@query("R120b_load_ten_minutes", f"""
select floor((epoch_us(timestamp '{NOW}') - epoch_us(ts)) / 600000000)::bigint as idx, count(*) as requests,
 count(distinct user_id) as displays, round(avg(value), 6) as latency from {REQ_SQL(10)} group by 1""")
def r120b(spark: SS, d: str) -> DataFrame:
    r = _requests(spark, d, 10)
    return r.groupBy(TU.now_bucket("ts", NOW, 600_000_000).alias("idx")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_distinct("user_id").alias("displays"), r6(F.avg("value")).alias("latency"))


@query("R121_daily_cycles_instances", f"""
with r as (select *, floor((epoch_us(timestamp '{NOW}') - epoch_us(ts)) / 1000000 / 60 / 15) as ago from {q(AS_OF - D(days=90), AS_OF)}),
quarter as (select ago, max(date) as date, count(distinct k) as inst from r group by 1)
select d.date, d.daily_teracycles, d.display_count, d.pending_time, round(i.inst, 6) as avg_fifteen_min_instance_count from
 (select date, round(sum(k) / 1000000, 6) as daily_teracycles, count(distinct user_id) as display_count,
  round(sum(coalesce(value, 0)), 6) as pending_time from r group by 1) d
 left join (select date, avg(inst) as inst from quarter group by 1) i on i.date = d.date""")
def r121(spark: SS, d: str) -> DataFrame:
    """Last 90 days; quarters of an hour are counted back from the evaluation instant, and a
    quarter belongs to the day of its latest request."""
    r = cat.read_events(ev(spark, d), AS_OF - D(days=90), YESTERDAY).withColumn("k", k_col())
    ago = F.floor((TU.epoch_micros(TU.as_of_ts(NOW)) - TU.epoch_micros("ts")) / 1_000_000 / 60 / 15)
    per = r.groupBy("date").agg(r6(F.sum("k") / 1_000_000).alias("daily_teracycles"), F.count_distinct("user_id").alias("display_count"),
                                r6(F.sum(F.coalesce("value", F.lit(0.0)))).alias("pending_time"))
    quarter = r.groupBy(ago.alias("ago"), "k").agg(F.max("date").alias("date")).groupBy("ago").agg(
        F.max("date").alias("date"), F.count("k").alias("inst"))
    inst = quarter.groupBy("date").agg(r6(F.avg("inst")).alias("avg_fifteen_min_instance_count"))
    return per.join(inst, "date", "left")


def _display_costs(e: DataFrame) -> DataFrame:
    """R122 cost model of the request log, one pass of conditional counts per day.

    Bindings: cache miss = 'click' with value > 90, display request = 'view',
    channel update = 'signup', request latency = value (seconds).  The formula
    is the view's, including its quirk (Z20): the gets cost tests the cache-miss
    count but prices channel updates.  The view inner-joins the four per-day
    counts, so a day missing any of them is dropped (re-imposed by the filter).
    """
    g = e.groupBy("date").agg(
        F.count_if((F.col("event_type") == "click") & (F.col("value") > 90)).alias("cache_miss"),
        F.count_if(F.col("event_type") == "view").alias("display_requests"),
        F.count_if(F.col("event_type") == "signup").alias("channel_updates"),
        (F.sum("value") / 60 / 60).alias("instance_hours"),
        F.count_distinct("user_id").alias("displays"))
    g = g.where((F.col("cache_miss") > 0) & (F.col("display_requests") > 0) & (F.col("channel_updates") > 0))
    rate = K.DATASTORE_PRICE_PER_100K / 100000
    puts = F.col("display_requests") * K.PUTS_PER_DISPLAY_REQUEST + F.col("channel_updates")
    gets_cost = F.when(F.col("cache_miss") < K.DATASTORE_FREE_TIER, F.lit(0.0)) \
        .otherwise((F.col("channel_updates") - K.DATASTORE_FREE_TIER) * rate)
    puts_cost = F.when(puts < K.DATASTORE_FREE_TIER, F.lit(0.0)).otherwise((puts - K.DATASTORE_FREE_TIER) * rate)
    total = gets_cost + puts_cost + F.col("instance_hours") * K.INSTANCE_HOUR_PRICE
    reindex = (F.col("display_requests") * K.REINDEX_PER_DISPLAY_REQUEST
               + F.col("channel_updates") * K.REINDEX_PER_CHANNEL_UPDATE)
    return g.select("date", r6(total).alias("total_cost"), r6(total / F.col("displays")).alias("cost_per_display"),
                    reindex.cast("long").alias("reindex_count"))


COST_SQL = lambda d0, d1: f"""(select date, round(gets + puts + ih * {K.INSTANCE_HOUR_PRICE}, 6) as total_cost,
 round((gets + puts + ih * {K.INSTANCE_HOUR_PRICE}) / displays, 6) as cost_per_display,
 cast(dr * {K.REINDEX_PER_DISPLAY_REQUEST} + cu * {K.REINDEX_PER_CHANNEL_UPDATE} as bigint) as reindex_count from
 (select *, case when cm < {K.DATASTORE_FREE_TIER} then 0.0 else (cu - {K.DATASTORE_FREE_TIER}) * {K.DATASTORE_PRICE_PER_100K} / 100000 end as gets,
  case when dr * {K.PUTS_PER_DISPLAY_REQUEST} + cu < {K.DATASTORE_FREE_TIER} then 0.0
   else (dr * {K.PUTS_PER_DISPLAY_REQUEST} + cu - {K.DATASTORE_FREE_TIER}) * {K.DATASTORE_PRICE_PER_100K} / 100000 end as puts from
 (select date, count(*) filter (where event_type = 'click' and value > 90) as cm, count(*) filter (where event_type = 'view') as dr,
  count(*) filter (where event_type = 'signup') as cu, sum(value) / 60 / 60 as ih, count(distinct user_id) as displays
  from {q(d0, d1)} group by 1) where cm > 0 and dr > 0 and cu > 0))"""  # noqa: E731


@rollup("R122_display_costs", f"""
select * from {COST_SQL(W3_START, AS_OF)} union all select * from {COST_SQL(None, W3_START)} where date < date '{W3_START}'""", start=W3_START)
def r122(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    return _display_costs(cat.read_events(ev(spark, d), first, last))


NOISY_CALLS = K.NOISY_CALLS_PER_DAY


@query("R123_display_counts", f"""
with per as (select date, user_id, count(*) as calls, max(case when event_type in ('view', 'click') then 1 else 0 end) as core,
 max(case when event_type in ('signup', 'purchase') then 1 else 0 end) as client, max(case when k >= 50 then 1 else 0 end) as v3 from {q(extra="user_id is not null")} group by 1, 2)
select date, count(*) as displays, count(*) filter (where core = 1) as core, count(*) filter (where client = 1) as client,
 count(*) filter (where calls > {NOISY_CALLS}) as noisy, count(*) filter (where v3 = 1) as v3_callers from per group by 1""")
def r123(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).where(F.col("user_id").isNotNull()).withColumn("k", k_col())
    per = e.groupBy("date", "user_id").agg(
        F.count(F.lit(1)).alias("calls"), F.max(F.col("event_type").isin("view", "click").cast("int")).alias("core"),
        F.max(F.col("event_type").isin("signup", "purchase").cast("int")).alias("client"),
        F.max((F.col("k") >= 50).cast("int")).alias("v3"))
    return per.groupBy("date").agg(F.count(F.lit(1)).alias("displays"), F.count_if(F.col("core") == 1).alias("core"),
                                   F.count_if(F.col("client") == 1).alias("client"),
                                   F.count_if(F.col("calls") > NOISY_CALLS).alias("noisy"),
                                   F.count_if(F.col("v3") == 1).alias("v3_callers"))


@query("R123b_weekly_display_count", f"""
select year(ts)::bigint as year, ceil(dayofyear(ts) / 7)::bigint as week, count(distinct user_id) as displays from {q()} group by 1, 2""")
def r123b(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy(F.year("ts").cast("long").alias("year"), TU.ceil_week("ts").alias("week")) \
        .agg(F.count_distinct("user_id").alias("displays"))


@query("R124_calls_per_display", f"""
select (year(ts) * 366 + dayofyear(ts))::bigint as day_of_year, month(ts)::bigint as month, day(ts)::bigint as day,
 count(*) filter (where event_type = 'view') as viewer_calls,
 count(distinct case when event_type = 'view' then user_id end) as display_count,
 round(count(*) filter (where event_type = 'view') / count(distinct case when event_type = 'view' then user_id end), 6) as avg_calls_per_display
from {q(AS_OF - D(days=91), AS_OF)} group by 1, 2, 3 having count(*) filter (where event_type = 'view') > 0""")
def r124(spark: SS, d: str) -> DataFrame:
    """Display-request calls per day over 91 days, distinct calling displays and the
    average; the view's day key is year * 366 + day of year."""
    e = cat.read_events(ev(spark, d), AS_OF - D(days=91), YESTERDAY)
    view = F.col("event_type") == "view"
    keys = [(F.year("ts") * 366 + F.dayofyear("ts")).cast("long").alias("day_of_year"),
            F.month("ts").cast("long").alias("month"), F.dayofmonth("ts").cast("long").alias("day")]
    g = e.groupBy(*keys).agg(F.count_if(view).alias("viewer_calls"),
                             F.count_distinct(F.when(view, F.col("user_id"))).alias("display_count"))
    return g.where(F.col("viewer_calls") > 0).withColumn(
        "avg_calls_per_display", r6(C.safe_ratio("viewer_calls", "display_count")))


@query("R124b_noisy_displays_today", f"""
select user_id, count(*) as calls from {q(YESTERDAY, AS_OF)} group by 1 having count(*) > {K.NOISY_CALLS_PER_HOUR} * (hour(timestamp '{NOW - D(hours=1)}') + 1)""")
def r124b(spark: SS, d: str) -> DataFrame:
    """Displays above 20 calls per hour so far today: threshold 20 x (hour + 1) at the evaluation time."""
    e = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY)
    budget = K.NOISY_CALLS_PER_HOUR * (F.hour(TU.as_of_ts(NOW - D(hours=1))) + 1)
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("calls")).where(F.col("calls") > budget)


@query("R124c_channel_activity", f"""
select cast(year(ts) as varchar) || '-' || lpad(cast(month(ts) as varchar), 2, '0') || '-' || lpad(cast(day(ts) as varchar), 2, '0') as day,
 count(*) as channel_calls from {q()} where event_type = 'signup' group by 1""")
def r124c(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).where(F.col("event_type") == "signup")
    return e.groupBy(TU.date_from_parts(F.year("ts"), F.month("ts"), F.dayofmonth("ts")).alias("day")) \
        .agg(F.count(F.lit(1)).alias("channel_calls"))


@query("R125_viewer_versions_today", f"""
select cast(k as varchar) as viewer_version, ts from {q(YESTERDAY, AS_OF)} where event_type = 'view'""")
def r125(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY).where(F.col("event_type") == "view")
    return e.select(k_col().cast("string").alias("viewer_version"), "ts")


@query("R125b_viewer_activity_by_event", f"""
select event_type as event, 'channel:' || substr(props, 1, 6) as details, count(*) as n from {q(W7_START, AS_OF)} group by 1, 2""")
def r125b(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), W7_START, YESTERDAY)
    return e.groupBy(F.col("event_type").alias("event"),
                     F.concat(F.lit("channel:"), F.substring("props", 1, 6)).alias("details")).agg(F.count(F.lit(1)).alias("n"))
