"""Report jobs: template / segment usage (R40-R45) and devices.

Bindings as in ``reports.py``; additionally: template id = release ``k`` of a
'view' event; preview device = ``user_id`` 0; simple templates = k in (1, 2);
OS of a device = fixed mapping of its company's industry.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import joins as J
from fleetlens.operators.latest import latest_by, production
from fleetlens.operators.reliability import distinct_counts
from fleetlens.operators.rollup import one_scan_union
from fleetlens.plans.registry import query
from fleetlens.plans.rollups import rollup
from fleetlens.plans.reports import W3_START, W7_START, ev, k_col, q
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl
from fleetlens.sources import catalog as cat
from fleetlens.sources.schemas import conform

SS = SparkSession
r6 = C.r
D = dt.timedelta
W30_START = AS_OF - D(days=30)
SEGMENT = "BUILDING"

# Binding: industry -> OS string reported by that company's players.
OS_BY_INDUSTRY = {"AUTOMOBILE": "Windows 10", "BUILDING": "Ubuntu 20.04", "MACHINERY": "raspbian",
                  "HOUSEHOLD": "Windows 7", "FURNITURE": "Mac OS X"}
OS_SQL = "case c_mktsegment " + " ".join(f"when '{k}' then '{v}'" for k, v in OS_BY_INDUSTRY.items()) + " end"


def os_of(seg: Column) -> Column:
    out = None
    for k, v in OS_BY_INDUSTRY.items():
        out = F.when(seg == k, v) if out is None else out.when(seg == k, v)
    return out


def templates(e: DataFrame, *, exclude_simple: bool = True) -> DataFrame:
    """Template loads: configuration events of real devices (the preview sentinel
    excluded) with their template; optionally without the two simple templates."""
    t = e.where((F.col("event_type") == "view") & ~F.col("user_id").isin(0)).withColumn("template_id", k_col()) \
        .withColumn("template_name", F.concat(F.lit("template-"), F.col("template_id").cast("string")))
    return t.where(~F.col("template_id").isin(1, 2)) if exclude_simple else t


TPL_SQL = "event_type = 'view' and user_id not in (0) and k not in (1, 2)"
LOAD_SQL = "event_type = 'view' and user_id not in (0)"


def _customers(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "customer", F.col("c_custkey").alias("user_id"))


@query("R40_template_usage_on_date", f"""
select count(distinct user_id) as numberOfDisplays, 'template-' || cast(k as varchar) as template_name
from {q(YESTERDAY, AS_OF)} where {LOAD_SQL} group by 2""")
def r40(spark: SS, d: str) -> DataFrame:
    t = templates(cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY), exclude_simple=False)
    return t.groupBy("template_name").agg(F.count_distinct("user_id").alias("numberOfDisplays"))


@query("R40b_template_usage_by_company", f"""
select count(distinct c.c_custkey) as numberOfCompanies, t.template_name from
 (select user_id, 'template-' || cast(k as varchar) as template_name from {q(W30_START, AS_OF + D(days=1))} where {LOAD_SQL} group by 1, 2) t
 join customer c on c.c_custkey = t.user_id group by 2""")
def r40b(spark: SS, d: str) -> DataFrame:
    """Companies (through the displays' companies, inner join) per template over 30 days."""
    t = templates(cat.read_events(ev(spark, d), W30_START, AS_OF), exclude_simple=False) \
        .select("user_id", "template_name").distinct()
    return J.semi(t, _customers(spark, d), "user_id").groupBy("template_name") \
        .agg(F.count_distinct("user_id").alias("numberOfCompanies"))


@query("R40c_template_companies_total", f"""
select count(distinct c.c_custkey) as numberOfCompanies from
 (select user_id from {q(W30_START, AS_OF + D(days=1))} where {TPL_SQL} group by 1) t join customer c on c.c_custkey = t.user_id""")
def r40c(spark: SS, d: str) -> DataFrame:
    t = templates(cat.read_events(ev(spark, d), W30_START, AS_OF)).select("user_id").distinct()
    return J.semi(t, _customers(spark, d), "user_id").agg(F.count_distinct("user_id").alias("numberOfCompanies"))


@query("R40d_template_usage_monthly", f"""
select count(distinct user_id) as numberOfDisplays, 'template-' || cast(k as varchar) as template_name, strftime(ts, '%b-%y') as date
from {q(AS_OF - D(days=366), AS_OF + D(days=1))} where {LOAD_SQL} group by 2, 3""")
def r40d(spark: SS, d: str) -> DataFrame:
    t = templates(cat.read_events(ev(spark, d), AS_OF - D(days=366), AS_OF), exclude_simple=False)
    return t.groupBy("template_name", F.date_format("ts", "MMM-yy").alias("date")) \
        .agg(F.count_distinct("user_id").alias("numberOfDisplays"))


def _tpl_rows(spark: SS, d: str, start: dt.date | None, end: dt.date) -> DataFrame:
    t = templates(cat.read_events(ev(spark, d), start, end))
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey")
    return t.join(c, t.user_id == c.c_custkey).select(
        "date", "template_id", F.col("user_id").alias("display_id"), F.col("c_nationkey").alias("company_id")).distinct()


TPL_ROWS_SQL = lambda d0, d1: f"""(select distinct e.date, e.k as template_id, e.user_id as display_id, c.c_nationkey as company_id
 from {q(d0, d1)} e join customer c on c.c_custkey = e.user_id where {TPL_SQL.replace('user_id', 'e.user_id')})"""  # noqa: E731


@rollup("R41_html_template_rollup", f"""
select * from {TPL_ROWS_SQL(YESTERDAY, AS_OF)} union all select * from {TPL_ROWS_SQL(None, YESTERDAY)} where date < date '{YESTERDAY}'""", start=YESTERDAY)
def r41(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    return _tpl_rows(spark, d, first, last)


@query("R41b_template_counts_by_period", f"""
with r as {TPL_ROWS_SQL(W30_START, AS_OF)}
select 'day' as period, date as period_start, template_id, count(distinct display_id) as displays, count(distinct company_id) as companies from r group by 2, 3
union all select 'week', cast(date_trunc('week', date) as date), template_id, count(distinct display_id), count(distinct company_id)
 from r where date >= date '{W7_START}' group by 2, 3
union all select 'month', cast(date_trunc('month', date) as date), template_id, count(distinct display_id), count(distinct company_id)
 from r group by 2, 3""")
def r41b(spark: SS, d: str) -> DataFrame:
    r = _tpl_rows(spark, d, W30_START, YESTERDAY)
    # each row counts for its day, its week (last 7 days only) and its month: one
    # pass with a fixed 3x fan-out instead of three aggregations over r
    periods = F.array(
        F.struct(F.lit("day").alias("period"), F.col("date").alias("period_start")),
        F.struct(F.lit("week").alias("period"),
                 F.when(F.col("date") >= F.lit(W7_START), F.to_date(F.date_trunc("week", "date"))).alias("period_start")),
        F.struct(F.lit("month").alias("period"), F.trunc("date", "month").alias("period_start")))
    x = r.select("template_id", "display_id", "company_id", F.explode(periods).alias("p")) \
        .where(F.col("p.period_start").isNotNull())
    return x.groupBy(F.col("p.period").alias("period"), F.col("p.period_start").alias("period_start"), "template_id") \
        .agg(F.count_distinct("display_id").alias("displays"), F.count_distinct("company_id").alias("companies"))


def _segment_daily(spark: SS, d: str, start: dt.date | None, end: dt.date) -> DataFrame:
    e = cat.read_events(ev(spark, d), start, end)
    seg = tbl(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment").where(F.col("c_mktsegment") == SEGMENT)
    x = e.join(seg, e.user_id == seg.c_custkey)
    using = (F.col("event_type") == "view") & (k_col() < 50)
    a = distinct_counts(x, "date", "user_id", {"displays": F.lit(True), "displays_using": using})
    b = distinct_counts(x, "date", "c_nationkey", {"companies": F.lit(True), "companies_using": using})
    return a.join(b, "date").select("date", "companies", "companies_using", "displays", "displays_using",
                                    r6(C.safe_ratio("companies_using", "companies")).alias("ratio"))


SEG_DAILY_SQL = lambda d0, d1: f"""(select e.date, count(distinct c.c_nationkey) as companies,
 count(distinct case when e.event_type = 'view' and e.k < 50 then c.c_nationkey end) as companies_using,
 count(distinct e.user_id) as displays, count(distinct case when e.event_type = 'view' and e.k < 50 then e.user_id end) as displays_using,
 round(count(distinct case when e.event_type = 'view' and e.k < 50 then c.c_nationkey end) / count(distinct c.c_nationkey), 6) as ratio
 from {q(d0, d1)} e join customer c on c.c_custkey = e.user_id where c.c_mktsegment = '{SEGMENT}' group by 1)"""  # noqa: E731


@rollup("R42_segment_template_adoption", f"""
select * from {SEG_DAILY_SQL(W3_START, AS_OF)} union all select * from {SEG_DAILY_SQL(None, W3_START)} where date < date '{W3_START}'""", start=W3_START)
def r42(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    return _segment_daily(spark, d, first, last)


def PROD_COMPANIES_SQL_FN(segment: str) -> str:
    return ("(select o_custkey as companyId from orders where o_orderpriority <> '5-LOW' and (o_custkey, o_orderkey) in "
            "(select o_custkey, max(o_orderkey) from orders where o_orderpriority <> '5-LOW' group by 1) and o_orderstatus <> 'P' "
            f"and o_custkey in (select c_custkey from customer where c_mktsegment = '{segment}'))")


@query("R43_recommended_templates_in_segment", f"""
with rec as (select k as template, min(date) as start_date, max(date) as end_date from {q()} where event_type = 'purchase' group by 1),
x as (select date, user_id as company_id, k, event_type from {q()} where user_id not in (0)
  and user_id in (select companyId from {PROD_COMPANIES_SQL_FN('BUILDING')})
  and (event_type = 'view' or (event_type = 'click' and (case when k < 50 then 'stable' else 'beta' end) in ('beta', 'stable')))),
y as (select x.date, x.company_id from x join rec on rec.template = x.k and x.date between rec.start_date and rec.end_date)
select date, count(distinct company_id) as number_of_companies from y group by 1""")
def r43(spark: SS, d: str) -> DataFrame:
    """Segment companies per day that used a template recommended on that day: legacy
    template loads ('view') and content events ('click', rollout stage beta or
    stable), union all; companies restricted to the production segment companies."""
    e = ev(spark, d).withColumn("template_id", k_col())
    # recommended templates with their validity period: one row per template (bounded catalogue)
    rec = e.where(F.col("event_type") == "purchase").groupBy("template_id").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"))
    k12 = production_companies(spark, d, [SEGMENT]).select(F.col("companyId").alias("user_id"))
    stage = F.when(F.col("template_id") < 50, "stable").otherwise("beta")
    legacy = e.where((F.col("event_type") == "view") & ~F.col("user_id").isin(0))
    html = e.where((F.col("event_type") == "click") & stage.isin("beta", "stable") & ~F.col("user_id").isin(0))
    used = J.semi(legacy.select("date", "user_id", "template_id").unionByName(html.select("date", "user_id", "template_id")),
                  k12, "user_id")
    j = used.join(rec, "template_id").where(F.col("date").between(F.col("start_date"), F.col("end_date")))
    return j.groupBy("date").agg(F.count_distinct("user_id").alias("number_of_companies"))


# Binding (R44): company change log = orders per customer (latest = max order key),
# production = priority other than '5-LOW', test = latest status 'P'; industry =
# the customer's segment; the three "education" industries = BUILDING, FURNITURE,
# MACHINERY.  Display change log = events per device (latest = max (ts, id)):
# status = latest event kind, name = 'display-<id>', creation = first signup day.
K12_INDUSTRIES = ["BUILDING", "FURNITURE", "MACHINERY"]
PROD_COMPANIES_SQL = """(select o_custkey as companyId from orders where o_orderpriority <> '5-LOW'
 and (o_custkey, o_orderkey) in (select o_custkey, max(o_orderkey) from orders where o_orderpriority <> '5-LOW' group by 1)
 and o_orderstatus <> 'P')"""


def production_companies(spark: SS, d: str, industries: list[str]) -> DataFrame:
    o = tbl(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    cur = production(o, "o_custkey", "o_orderkey", pre=F.col("o_orderpriority") != "5-LOW",
                     post=F.col("o_orderstatus") != "P", ties="one")
    seg = tbl(spark, d, "customer", "c_custkey", "c_mktsegment").where(F.col("c_mktsegment").isin(*industries)) \
        .select(F.col("c_custkey").alias("companyId"))
    return J.semi(cur.select(F.col("o_custkey").alias("companyId")), seg, "companyId")


@query("R44_segment_entity_list", f"""
select companyId from {PROD_COMPANIES_SQL} where companyId in (select c_custkey from customer where c_mktsegment = '{SEGMENT}')""")
def r44(spark: SS, d: str) -> DataFrame:
    """Segment companies: latest production, non-test companies of the industry."""
    return production_companies(spark, d, [SEGMENT])


@query("R44b_segment_displays", f"""
with latest as (select user_id as displayId, arg_max(event_type, (ts, event_id)) as status from events group by 1),
created as (select user_id as displayId, min(cast(ts as date)) as creationDate from events where event_type = 'signup' group by 1)
select l.displayId, l.displayId as companyId, 'display-' || cast(l.displayId as varchar) as name, c.creationDate, l.status
from latest l left join created c on c.displayId = l.displayId
where l.displayId in (select companyId from {PROD_COMPANIES_SQL}
 where companyId in (select c_custkey from customer where c_mktsegment in ({', '.join(f"'{i}'" for i in K12_INDUSTRIES)})))""")
def r44b(spark: SS, d: str) -> DataFrame:
    """Latest production displays of the education-industry companies."""
    e = ev(spark, d)
    latest = latest_by(e.select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"], ties="one") \
        .select(F.col("user_id").alias("displayId"), F.col("event_type").alias("status"))
    created = e.where(F.col("event_type") == "signup").groupBy(F.col("user_id").alias("displayId")) \
        .agg(F.min("date").alias("creationDate"))
    k12 = production_companies(spark, d, K12_INDUSTRIES).select(F.col("companyId").alias("displayId"))
    x = J.semi(latest, k12, "displayId").join(created, "displayId", "left")
    return x.select("displayId", F.col("displayId").alias("companyId"),
                    F.concat(F.lit("display-"), F.col("displayId").cast("string")).alias("name"), "creationDate", "status")


def latest_config(e: DataFrame) -> DataFrame:
    """Latest configuration ('view') row per device (one row; ts then event id)."""
    cfg = e.where(F.col("event_type") == "view").select("user_id", "ts", "event_id", "value", k_col().alias("k"))
    return latest_by(cfg, "user_id", ["ts", "event_id"], ties="one")


LATEST_CFG_SQL = f"""(select user_id, value, k from (select user_id, value, k, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
 from {q()} where event_type = 'view' and ts is not null and event_id is not null) where rn = 1)"""


# Binding (R45): product of a configuration = 'pro' + its release tag; the recommended
# products are a literal relation built by rule (tags 50-99).
RECOMMENDED_PRODUCTS = [f"pro{k}" for k in range(50, 100)]


@query("R45_recommended_player_pct", f"""
with seg as (select c_custkey as user_id from customer where c_mktsegment = '{SEGMENT}' and c_acctbal >= 0),
running as (select distinct user_id from {q(W7_START, AS_OF)} where event_type in ('signup', 'purchase', 'view', 'click')
  and user_id in (select user_id from seg)),
rec as (select 'pro' || cast(range as varchar) as productname from range(50, 100)),
cfg as (select user_id, 'pro' || cast(k as varchar) as product_name from (select *, row_number() over
  (partition by user_id order by ts desc, event_id desc) as rn from {q()} where event_type = 'view') where rn = 1),
recommended as (select user_id from running where user_id in (select user_id from cfg where product_name in (select productname from rec)))
select (select count(*) from running) as total_k12_displays, (select count(*) from recommended) as recommended_k12_displays,
 round(100.0 * (select count(*) from recommended) / nullif((select count(*) from running), 0), 6) as pct,
  timestamp '{AS_OF} 06:00:00' as ts""")
def r45(spark: SS, d: str) -> DataFrame:
    """Share of the segment's recently running displays whose latest configuration is a
    recommended product (literal relation, semi join), stamped with the run time (S11)."""
    e = ev(spark, d)
    seg = tbl(spark, d, "customer", "c_custkey", "c_mktsegment", "c_acctbal") \
        .where((F.col("c_mktsegment") == SEGMENT) & (F.col("c_acctbal") >= 0)).select(F.col("c_custkey").alias("user_id"))
    families = {"installer": F.col("event_type").isin("signup", "purchase"), "player": F.col("event_type").isin("view", "click")}
    running = J.semi(one_scan_union(cat.read_events(e, W7_START, YESTERDAY), families, ["user_id"]), seg, "user_id")
    rec = spark.createDataFrame([(p,) for p in RECOMMENDED_PRODUCTS], "product_name string")
    cfg = latest_config(e).select("user_id", F.concat(F.lit("pro"), F.col("k").cast("string")).alias("product_name"))
    on_rec = cfg.join(F.broadcast(rec), "product_name", "left_semi")  # literal relation: 50 rows
    recommended = J.semi(running, on_rec, "user_id")
    kpi = running.agg(F.count(F.lit(1)).alias("total_k12_displays")).crossJoin(
        recommended.agg(F.count(F.lit(1)).alias("recommended_k12_displays")))  # one row each
    return kpi.select("total_k12_displays", "recommended_k12_displays",
                      r6(C.safe_ratio("recommended_k12_displays", "total_k12_displays", 100.0)).alias("pct"),
                      F.lit(dt.datetime.combine(AS_OF, dt.time(6))).cast("timestamp_ntz").alias("ts"))


# =========================================================== R50-R62 devices
# Binding (R50): request log = every event (display id only on display requests, 'view');
# viewer events = 'click'; installer events = 'signup' / 'purchase'.
@query("R50_active_displays", f"""
select display_id, date from (
 select case when event_type = 'view' then user_id end as display_id, date from {q(AS_OF - D(days=5), AS_OF + D(days=1))}
 union select user_id, date from {q(AS_OF - D(days=5), AS_OF + D(days=1))} where event_type = 'click'
 union select user_id, date from {q(AS_OF - D(days=5), AS_OF + D(days=1))} where event_type in ('signup', 'purchase'))
group by display_id, date""")
def r50(spark: SS, d: str) -> DataFrame:
    """Recently running displays: (display, day) pairs of three overlapping sources,
    UNION DISTINCT, over the last 5 days and today.  One scan: each row emits the
    ids of the branches it belongs to (the request-log branch emits NULL for
    non-display requests, as the view's extraction does), then one distinct."""
    e = cat.read_events(ev(spark, d), AS_OF - D(days=5), AS_OF)
    t = F.col("event_type")
    branches = F.array(
        F.struct(F.lit(True).alias("emit"), F.when(t == "view", F.col("user_id")).alias("id")),
        F.struct((t == "click").alias("emit"), F.col("user_id").alias("id")),
        F.struct(t.isin("signup", "purchase").alias("emit"), F.col("user_id").alias("id")))
    x = e.select("date", F.explode(F.filter(branches, lambda b: b["emit"])).alias("b"))
    return x.select(F.col("b.id").alias("display_id"), "date").distinct()


@query("R50b_active_displays_union_all", f"""
select user_id as displayID from {q(AS_OF - D(days=4), AS_OF)} where event_type in ('signup', 'purchase')
union all select user_id from events where ts between timestamp '{AS_OF - D(days=4)}' and timestamp '{AS_OF}'
 and event_type in ('view', 'click')""")
def r50b(spark: SS, d: str) -> DataFrame:
    """Active display ids of the last 4 days from the installer family and the second-OS
    player family (closed range to today's midnight), UNION ALL: one row per event."""
    e = tbl(spark, d, "events")
    inst = cat.read_events(e, AS_OF - D(days=4), YESTERDAY).where(F.col("event_type").isin("signup", "purchase"))
    chrome = cat.read_ts_between(e, dt.datetime.combine(AS_OF - D(days=4), dt.time()), dt.datetime.combine(AS_OF, dt.time())) \
        .where(F.col("event_type").isin("view", "click"))
    return inst.select(F.col("user_id").alias("displayID")).union(chrome.select(F.col("user_id").alias("displayID")))


# Binding (R51): a display is created at its first signup; non-test companies only and
# not the house company (customer 0); the creation window is the 30 days of data
# (the view's 5 days would contain no creation here).
HOUSE_COMPANY = 0


@query("R51_display_activation", f"""
with added as (select user_id, min(date) as date from {q()} where event_type = 'signup' group by 1),
recent as (select * from added where date >= date '{W30_START}' and date <= date '{AS_OF}'
  and user_id in (select c_custkey from customer where c_acctbal >= 0 and c_custkey <> {HOUSE_COMPANY})),
active as (select distinct user_id, date from {q(W30_START, AS_OF)} where event_type = 'view')
select a.date, a.added, b.active from (select date, count(distinct user_id) as added from recent group by 1) a
left join (select r.date, count(distinct r.user_id) as active from recent r
  where r.user_id in (select user_id from active where active.date = r.date) group by 1) b on a.date = b.date""")
def r51(spark: SS, d: str) -> DataFrame:
    """Displays added per creation day and, of those, the ones with a configuration that
    same day (correlated IN on the day -> semi join on (display, day))."""
    e = ev(spark, d)
    companies = tbl(spark, d, "customer", "c_custkey", "c_acctbal") \
        .where((F.col("c_acctbal") >= 0) & (F.col("c_custkey") != HOUSE_COMPANY)).select(F.col("c_custkey").alias("user_id"))
    added = e.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.min("date").alias("date"))
    recent = J.semi(added.where(F.col("date").between(F.lit(W30_START), F.lit(AS_OF))), companies, "user_id")
    active = cat.read_events(e, W30_START, YESTERDAY).where(F.col("event_type") == "view").select("user_id", "date")
    act = J.semi(recent, active, ["user_id", "date"])
    rows = recent.withColumn("a", F.lit(False)).unionByName(act.withColumn("a", F.lit(True)))
    c = distinct_counts(rows, "date", "user_id", {"added": ~F.col("a"), "active": F.col("a")})
    return c.where(F.col("added") > 0).select("date", "added", F.nullif("active", F.lit(0)).alias("active"))


@query("R52_display_info_rollup", f"""
with conn as (select user_id, max(date) as connectionTime, max(case when event_type = 'click' then 1 else 0 end) = 1 as useChannel
 from {q(YESTERDAY, AS_OF)} group by 1),
cfg as {LATEST_CFG_SQL}
select cast(conn.user_id as varchar) as displayId, conn.connectionTime, c.c_nationkey as companyId, {OS_SQL} as os,
 'player' as pn, cast(cfg.k as varchar) as pv, cfg.value > 50 as offline_subscription, conn.useChannel
from conn left join cfg on cfg.user_id = conn.user_id left join customer c on c.c_custkey = conn.user_id""")
def r52(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    conn = cat.read_events(e, YESTERDAY, YESTERDAY).groupBy("user_id").agg(
        F.max("date").alias("connectionTime"), F.max((F.col("event_type") == "click").cast("int")).alias("ch"))
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    j = conn.join(latest_config(e), "user_id", "left").join(c, conn.user_id == c.c_custkey, "left")
    return j.select(F.col("user_id").cast("string").alias("displayId"), "connectionTime",
                    F.col("c_nationkey").alias("companyId"), os_of(F.col("c_mktsegment")).alias("os"),
                    F.lit("player").alias("pn"), F.col("k").cast("string").alias("pv"),
                    (F.col("value") > 50).alias("offline_subscription"), (F.col("ch") == 1).alias("useChannel"))


# Binding: installer classes.  Request-log rows (installer events and clicks) are
# classed directly, first rule wins; configuration rows ('view') are classed by
# their release / payload, first rule wins.
REQUEST_CLASSES = [
    ("v3", "event_type = 'signup' and k >= 50"),
    ("v2", "event_type = 'signup'"),
    ("v1", "event_type = 'purchase' and k < 30"),
    ("second_os", "event_type = 'click' and value < 10"),
]
CONFIG_CLASSES = [
    ("packaged_app", "k < 20"),
    ("android", "k >= 80"),
    ("oem", "value > 90"),
]
INSTALLER_CLASSES = [n for n, _ in REQUEST_CLASSES] + [n for n, _ in CONFIG_CLASSES]


def _case(rules, default="null"):
    return "case " + " ".join(f"when {c} then '{n}'" for n, c in rules) + f" else {default} end"


REQ_CLS_SQL = _case(REQUEST_CLASSES)
CFG_CLS_SQL = f"case when event_type = 'view' then {_case(CONFIG_CLASSES)} end"


def installer_class_rows(e: DataFrame, every: DataFrame) -> DataFrame:
    """(date, display, request class, config class, class of the display's latest config in ``every``).

    A configuration row only puts its display in its class when the display's
    latest configuration is not of another class, so a display may be in
    several classes (a request-log class and a config class)."""
    classed = lambda df: df.withColumn("k", k_col()).withColumn("cfg_cls", F.expr(CFG_CLS_SQL))
    # one row per (display, day, classes) before the join: a display's repeated events meet its configuration once
    x = classed(e).withColumn("req_cls", F.expr(REQ_CLS_SQL)).select("date", "user_id", "req_cls", "cfg_cls").distinct()
    latest = latest_by(classed(every.where(F.col("event_type") == "view")).select("user_id", "ts", "event_id", "cfg_cls"),
                       "user_id", ["ts", "event_id"], ties="one").select("user_id", F.col("cfg_cls").alias("latest_cls"))
    return x.join(latest, "user_id", "left")


def _cfg_flag(name: str) -> Column:
    return (F.col("cfg_cls") == name) & (F.col("latest_cls").isNull() | (F.col("latest_cls") == name))


@rollup("R53_installer_type_counts", f"""
with x as (select *, {REQ_CLS_SQL} as req_cls, {CFG_CLS_SQL} as cfg_cls from {q(None, AS_OF)}),
latest as (select user_id, cfg_cls as latest_cls from (select user_id, cfg_cls, row_number() over
 (partition by user_id order by ts desc, event_id desc) as rn from x where event_type = 'view') where rn = 1),
j as (select x.date, x.user_id, x.req_cls, x.cfg_cls, l.latest_cls from x left join latest l on l.user_id = x.user_id)
select date, count(distinct user_id) as total,
 {', '.join(f"count(distinct case when req_cls = '{n}' then user_id end) as {n}" for n, _ in REQUEST_CLASSES)},
 {', '.join(f"count(distinct case when cfg_cls = '{n}' and (latest_cls is null or latest_cls = '{n}') then user_id end) as {n}" for n, _ in CONFIG_CLASSES)},
 count(distinct user_id) - count(distinct case when req_cls is not null
  or (cfg_cls is not null and (latest_cls is null or latest_cls = cfg_cls)) then user_id end) as third_party
from j group by 1""", start=YESTERDAY)
def r53(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """All classes in one two-level aggregation over one pass of (display, class) rows,
    instead of one scan per class; classes may overlap."""
    e = ev(spark, d)
    x = installer_class_rows(cat.read_events(e, first, last), cat.read_events(e, None, YESTERDAY))
    flags = {"total": F.lit(True)}
    flags.update({n: F.col("req_cls") == n for n, _ in REQUEST_CLASSES})
    flags.update({n: _cfg_flag(n) for n, _ in CONFIG_CLASSES})
    flags["__classified"] = F.col("req_cls").isNotNull() | (
        F.col("cfg_cls").isNotNull() & (F.col("latest_cls").isNull() | (F.col("latest_cls") == F.col("cfg_cls"))))
    out = distinct_counts(x, "date", "user_id", flags)
    return out.withColumn("third_party", F.col("total") - F.col("__classified")).drop("__classified")


OS_CATEGORY_RULES = [("windows", "%windows%"), ("linux", "%ubuntu%"), ("linux", "%linux%"), ("pi", "%raspbian%")]
OSCAT_SQL = "case " + " ".join(f"when lower(os) like '{p}' then '{c}'" for c, p in OS_CATEGORY_RULES) + " else 'other' end"


def _v3_by_os(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("k", k_col()).where((F.col("event_type") == "signup") & (F.col("k") >= 50))
    c = tbl(spark, d, "customer", "c_custkey", "c_mktsegment")
    x = e.join(c, e.user_id == c.c_custkey).withColumn("os", os_of(F.col("c_mktsegment")))
    cat_ = C.first_match([(F.lower("os").like(p), c_) for c_, p in OS_CATEGORY_RULES], "other")
    per = x.groupBy("date", "os").agg(F.count_distinct("user_id").alias("n"))  # per OS first (A18)
    return per.groupBy("date", cat_.alias("category")).agg(F.sum("n").cast("long").alias("displays"))


V3_OS_SQL = f"""(select date, {OSCAT_SQL} as category, cast(sum(n) as bigint) as displays from
 (select e.date, {OS_SQL} as os, count(distinct e.user_id) as n from {q()} e join customer c on c.c_custkey = e.user_id
  where e.event_type = 'signup' and e.k >= 50 group by 1, 2) group by 1, 2)"""


@query("R54_v3_by_os_category", f"select * from {V3_OS_SQL}")
def r54(spark: SS, d: str) -> DataFrame:
    return _v3_by_os(spark, d)


@query("R54b_v3_by_os_category_wide", f"""
select date, cast(sum(displays) as bigint) as total, {', '.join(f"cast(coalesce(sum(displays) filter (where category = '{c}'), 0) as bigint) as {c}" for c in ['windows', 'linux', 'pi'])}
from {V3_OS_SQL} group by 1""")
def r54b(spark: SS, d: str) -> DataFrame:
    long = _v3_by_os(spark, d)
    cats = ["windows", "linux", "pi"]
    w = long.groupBy("date").pivot("category", cats).agg(F.sum("displays"))
    tot = long.groupBy("date").agg(F.sum("displays").cast("long").alias("total"))
    return tot.join(w, "date").select("date", "total", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in cats])


# Binding (R55): installer download = 'click' with value > 50; started / beginning
# install = 'signup'; install complete = 'purchase'.
@query("R55_installer_metrics", f"""
with dl as (select date, count(*) as download_count from {q(AS_OF - D(days=366), AS_OF)}
  where event_type = 'click' and value > 50 group by 1),
se as (select event_id, user_id, ts, date, event_type from {q(AS_OF - D(days=31), AS_OF)} where event_type in ('signup', 'purchase')),
n as (select *, lead(event_type) over w as nt, lead(ts) over w as nts from se window w as (partition by user_id order by ts, event_id)),
dur as (select date, avg(case when event_type = 'signup' and nt = 'purchase' then (epoch_us(nts) - epoch_us(ts)) / 1e6 end) as d
  from n group by 1),
st as (select date, count(distinct user_id) as starts from {q(AS_OF - D(days=366), AS_OF)} where event_type = 'signup' group by 1),
co as (select date, count(distinct user_id) as completions from {q(AS_OF - D(days=366), AS_OF)} where event_type = 'purchase' group by 1),
sc as (select st.date, st.starts, co.completions from st left join co on co.date = st.date)
select dl.date, dl.download_count, round(dur.d, 6) as avg_duration_seconds, sc.starts, sc.completions
from dl left join dur on dur.date = dl.date left join sc on sc.date = dl.date""")
def r55(spark: SS, d: str) -> DataFrame:
    """Installer metrics per day: downloads, mean install duration (start to the
    display's next event when that is a completion), displays starting and
    completing installs; all left-joined onto the download days."""
    e = ev(spark, d)
    year = cat.read_events(e, AS_OF - D(days=366), YESTERDAY)
    dl = year.where((F.col("event_type") == "click") & (F.col("value") > 50)).groupBy("date") \
        .agg(F.count(F.lit(1)).alias("download_count"))
    se = cat.read_events(e, AS_OF - D(days=31), YESTERDAY).where(F.col("event_type").isin("signup", "purchase")) \
        .select("event_id", "user_id", "ts", "date", "event_type")
    n = J.next_event(se, "user_id", ts="ts", tie="event_id", cols=["event_type"])
    from fleetlens.functions.timeutil import micros_between
    secs = F.when((F.col("event_type") == "signup") & (F.col("next_event_type") == "purchase"),
                  micros_between("next_ts", "ts") / 1e6)
    dur = n.groupBy("date").agg(r6(F.avg(secs)).alias("avg_duration_seconds"))
    sc = distinct_counts(year, "date", "user_id", {"starts": F.col("event_type") == "signup",
                                                   "completions": F.col("event_type") == "purchase"})
    sc = sc.where(F.col("starts") > 0).select("date", "starts", F.nullif("completions", F.lit(0)).alias("completions"))
    return dl.join(dur, "date", "left").join(sc, "date", "left") \
        .select("date", "download_count", "avg_duration_seconds", "starts", "completions")


def _install_funnel(w: DataFrame) -> DataFrame:
    """R56 for one window: displays beginning an install ('signup') and, of those
    display-days, the ones completing it ('purchase'), both on the current
    installer release line (scalar subquery).  Completions stay NULL on a day
    without any (left join).  The view's temporary-id filter (ids like '0.%')
    has no counterpart on integer device ids and is not bound."""
    x = w.where(F.col("event_type").isin("signup", "purchase")).withColumn("line", F.floor(k_col() / 10))
    cur = x.where(F.col("event_type") == "signup").agg(F.max("line").alias("__cur"))  # one row
    onv = x.crossJoin(F.broadcast(cur)).where(F.col("line") == F.col("__cur"))
    keys = ["user_id", "date"]
    starts = onv.where(F.col("event_type") == "signup").select(*keys)
    done = J.semi(onv.where(F.col("event_type") == "purchase").select(*keys), starts, keys)
    rows = starts.withColumn("s", F.lit(True)).unionByName(done.withColumn("s", F.lit(False)))
    c = distinct_counts(rows, "date", "user_id", {"starts": F.col("s"), "completions": ~F.col("s")})
    return c.where(F.col("starts") > 0).select("date", "starts", F.nullif("completions", F.lit(0)).alias("completions"))


FUNNEL_SQL = lambda d0, d1: f"""(with x as (select *, k // 10 as line from {q(d0, d1)} where event_type in ('signup', 'purchase')),
 onv as (select * from x where line = (select max(line) from x where event_type = 'signup')),
 s as (select distinct user_id, date from onv where event_type = 'signup'),
 a as (select date, count(distinct user_id) as starts from s group by 1),
 b as (select c.date, count(distinct c.user_id) as completions from onv c where c.event_type = 'purchase'
       and exists (select 1 from s where s.user_id = c.user_id and s.date = c.date) group by 1)
 select a.date, a.starts, b.completions from a left join b on a.date = b.date)"""  # noqa: E731


@rollup("R56_install_funnel", f"""
select * from {FUNNEL_SQL(W3_START, AS_OF)} union all select * from {FUNNEL_SQL(None, W3_START)} where date < date '{W3_START}'""", start=W3_START)
def r56(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    return _install_funnel(cat.read_events(ev(spark, d), first, last))


def installer_events(spark: SS, d: str, day: dt.date) -> DataFrame:
    """The installer event table of one day, conformed to its registered schema.
    Binding: installer rows = signup / purchase / error; 'all closed' = purchase;
    installer version text = '20' + two-digit k.  The views' "today" is the last
    day with data (the day before the evaluation date)."""
    e = cat.read_events(tbl(spark, d, "events"), day, day).where(F.col("event_type").isin("signup", "purchase", "error"))
    x = e.select(F.col("event_type").alias("event"), F.col("props").alias("event_details"),
                 F.col("user_id").cast("string").alias("display_id"),
                 F.concat(F.lit("20"), F.lpad(k_col().cast("string"), 2, "0")).alias("installer_version"), "ts")
    return conform(x, "installer_events")


INSTALLER_SQL = f"""(select event_type as event, props as event_details, cast(user_id as varchar) as display_id, null::varchar as ip,
 null::varchar as os, '20' || lpad(cast(k as varchar), 2, '0') as installer_version, ts from {q(YESTERDAY, AS_OF)}
 where event_type in ('signup', 'purchase', 'error'))"""


@query("R57_installer_errors", f"select * from {INSTALLER_SQL} where event = 'error' order by ts desc")
def r57(spark: SS, d: str) -> DataFrame:
    i = installer_events(spark, d, YESTERDAY)
    return i.where(F.col("event") == "error").orderBy(F.col("ts").desc())


@query("R57b_unfinished_runs", f"""
select display_id, ts, event, installer_version, os, ip, event_details from {INSTALLER_SQL}
where display_id is not null and display_id not in (select display_id from {INSTALLER_SQL} where event = 'purchase')""")
def r57b(spark: SS, d: str) -> DataFrame:
    """Installer rows of displays that never logged 'all closed' that day (NOT IN, null-aware)."""
    i = installer_events(spark, d, YESTERDAY)
    closed = i.where(F.col("event") == "purchase").select("display_id")
    rows = i.where(F.col("display_id").isNotNull())
    return J.not_in(rows, closed, "display_id").select("display_id", "ts", "event", "installer_version", "os", "ip",
                                                        "event_details")


@query("R57c_combined_event_listing", f"""
select event_id, event_type as event, coalesce(installer_version, player_version) as version from (
 select event_id, event_type, cast(k as varchar) as installer_version, null as player_version from {q(YESTERDAY, AS_OF)} where event_type in ('signup', 'purchase')
 union all select event_id, event_type, null, cast(k as varchar) from {q(YESTERDAY, AS_OF)} where event_type in ('view', 'click'))""")
def r57c(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY).withColumn("k", k_col().cast("string"))
    inst = e.where(F.col("event_type").isin("signup", "purchase")).select("event_id", "event_type",
                                                                         F.col("k").alias("installer_version"))
    nat = e.where(F.col("event_type").isin("view", "click")).select("event_id", "event_type",
                                                                   F.col("k").alias("player_version"))
    u = inst.unionByName(nat, allowMissingColumns=True)
    return u.select("event_id", F.col("event_type").alias("event"),
                    F.coalesce("installer_version", "player_version").alias("version"))


@query("R57d_version_counts", f"""
select installer_version, count(installer_version) as count from
 (select max(installer_version) as installer_version, display_id from {INSTALLER_SQL} group by display_id) group by 1""")
def r57d(spark: SS, d: str) -> DataFrame:
    """Displays per installer version, each display at its highest version text."""
    per = installer_events(spark, d, YESTERDAY).groupBy("display_id").agg(F.max("installer_version").alias("installer_version"))
    return per.groupBy("installer_version").agg(F.count("installer_version").alias("count"))


def _module_stats(e: DataFrame, start: dt.date | None, end: dt.date) -> DataFrame:
    """R58 for one window.  Bindings: installer rows = all events on the current
    release line (scalar subquery); failure branches: (1) errors with value > 90
    (restart / launch / certificate errors); (2) 'view' rows loading the viewer
    (payload tag 9x) on a display-day without a viewer startup ('signup') --
    composite-key anti join; (3) watchdog module-down ('click' with value > 95)
    on a display-day present in the window -- composite-key semi join."""
    w = cat.read_events(e, start, end)
    x = w.withColumn("line", F.floor(k_col() / 10))
    cur = x.agg(F.max("line").alias("__cur"))  # scalar subquery: one row
    alld = x.crossJoin(F.broadcast(cur)).where((F.col("line") == F.col("__cur"))
                                               & C.not_like(F.col("user_id").cast("string"), "0.%"))
    keys = ["user_id", "date"]
    b1 = alld.where((F.col("event_type") == "error") & (F.col("value") > 90)).select(*keys)
    startups = w.where(F.col("event_type") == "signup").select(*keys)
    b2 = J.anti(alld.where((F.col("event_type") == "view") & F.col("props").like('{"k": 9%')).select(*keys),
                startups, keys)
    b3 = J.semi(w.where((F.col("event_type") == "click") & (F.col("value") > 95)).select(*keys),
                alld.select(*keys), keys)
    rows = alld.select(*keys, F.lit(True).alias("t"), F.lit(False).alias("f")) \
        .unionByName(b1.union(b2).union(b3).select(*keys, F.lit(False).alias("t"), F.lit(True).alias("f")))
    out = distinct_counts(rows, "date", "user_id", {"total_count": F.col("t"), "failed_count": F.col("f")})
    return out.where(F.col("total_count") > 0)


MODULE_STATS_SQL = lambda d0, d1: f"""(with w as (select * from {q(d0, d1)}),
 x as (select *, k // 10 as line from w),
 alld as (select * from x where line = (select max(line) from x) and cast(user_id as varchar) not like '0.%'),
 failed as (select date, user_id from alld where event_type = 'error' and value > 90
  union all select a.date, a.user_id from alld a where a.event_type = 'view' and a.props like '{{"k": 9%'
   and not exists (select 1 from w s where s.event_type = 'signup' and s.user_id = a.user_id and s.date = a.date)
  union all select c.date, c.user_id from w c where c.event_type = 'click' and c.value > 95
   and exists (select 1 from alld a where a.user_id = c.user_id and a.date = c.date))
 select t.date, t.total_count, coalesce(f.failed_count, 0) as failed_count
 from (select date, count(distinct user_id) as total_count from alld group by 1) t left join
 (select date, count(distinct user_id) as failed_count from failed group by 1) f on t.date = f.date)"""  # noqa: E731


@rollup("R58_player_module_stats", f"""
select * from {MODULE_STATS_SQL(W3_START, AS_OF)} union all select * from {MODULE_STATS_SQL(None, W3_START)} where date < date '{W3_START}'""", start=W3_START)
def r58(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    return _module_stats(ev(spark, d), first, last)


def _unsupported(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    cfg = latest_config(e).where(F.col("k") < 20)          # packaged-app player
    active = cat.read_events(e, W7_START, YESTERDAY).where(
        ~((F.col("event_type") == "click") & (F.col("value") < 10))).select("user_id").distinct()  # not second OS
    c = tbl(spark, d, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    x = cfg.join(active, "user_id").join(c, F.col("user_id") == c.c_custkey)
    return x.withColumn("os", os_of(F.col("c_mktsegment")))


UNSUP_SQL = f"""(select cfg.user_id, c.c_name, c.c_nationkey, {OS_SQL} as os from {LATEST_CFG_SQL} cfg
 join (select distinct user_id from {q(W7_START, AS_OF)} where not (event_type = 'click' and value < 10)) a on a.user_id = cfg.user_id
 join customer c on c.c_custkey = cfg.user_id where cfg.k < 20)"""


@query("R59_unsupported_display_counts", f"""
select u.c_nationkey as company_id, n.n_name as company_name, u.os, count(*) as displays
from {UNSUP_SQL} u join nation n on n.n_nationkey = u.c_nationkey group by 1, 2, 3""")
def r59(spark: SS, d: str) -> DataFrame:
    x = _unsupported(spark, d)
    n = tbl(spark, d, "nation", "n_nationkey", "n_name")
    g = x.groupBy(F.col("c_nationkey").alias("company_id"), "os").agg(F.count(F.lit(1)).alias("displays"))
    return g.join(F.broadcast(n), g.company_id == n.n_nationkey).select(
        "company_id", F.col("n_name").alias("company_name"), "os", "displays")


@query("R59b_unsupported_display_details", f"select user_id as display_id, c_name as display_name, os from {UNSUP_SQL}")
def r59b(spark: SS, d: str) -> DataFrame:
    return _unsupported(spark, d).select(F.col("user_id").alias("display_id"), F.col("c_name").alias("display_name"), "os")


# Binding (R60): active today = display requests, component requests and player updates
# ('view', 'click', 'purchase') of the last day, under one alias (Z02: the view's
# branches alias the id differently; the evident intent is a common alias);
# cache events = configuration rows, version = k.
CACHE_SQL = f"""(with active as (select distinct user_id as display_id from {q(YESTERDAY, AS_OF)}
  where event_type in ('view', 'click', 'purchase') and user_id is not null),
 c as (select user_id, ts, k from {q()} where event_type = 'view'),
 latest as (select distinct c.user_id, c.k as cache_version from c
  join (select user_id, max(ts) as m from c group by 1) l on l.user_id = c.user_id and l.m = c.ts)
 select distinct a.display_id, latest.cache_version from active a left join latest on latest.user_id = a.display_id)"""


def _cache_versions(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    srcs = {"display": F.col("event_type") == "view", "components": F.col("event_type") == "click",
            "update": F.col("event_type") == "purchase"}
    active = one_scan_union(cat.read_events(e, YESTERDAY, YESTERDAY).where(F.col("user_id").isNotNull()), srcs,
                            [F.col("user_id").alias("display_id")])
    cache = e.where(F.col("event_type") == "view").select("user_id", "ts", k_col().alias("cache_version"))
    latest = latest_by(cache, "user_id", "ts", ties="keep").select(F.col("user_id").alias("display_id"),
                                                                   "cache_version").distinct()
    return active.join(latest, "display_id", "left").distinct()


@query("R60_cache_version_per_display", f"select * from {CACHE_SQL}")
def r60(spark: SS, d: str) -> DataFrame:
    return _cache_versions(spark, d)


@query("R60b_cache_version_histogram", f"select cache_version, count(distinct display_id) as displays from {CACHE_SQL} group by 1")
def r60b(spark: SS, d: str) -> DataFrame:
    return _cache_versions(spark, d).groupBy("cache_version").agg(F.count_distinct("display_id").alias("displays"))


def _cache_rel(c: DataFrame, installer: DataFrame) -> DataFrame:
    """R61 for one window: displays whose cache reported up ('view') against displays
    with a cache error (minus excluded details) or an installer cache restart
    (legacy comma union by name); a date needs an up report (OUTER JOIN = left)."""
    up = c.where((F.col("event") == "view") & (F.col("display_id") != "no-displayId"))
    cache_err = c.where((F.col("event") == "error") & (F.col("display_id") != "no-displayId")
                        & (F.col("event_details") != '{"k": 0}') & C.not_like("event_details", '{"k": 1_}'))
    errs = cache_err.select("display_id", "date").unionByName(installer.select("display_id", "date"))
    rows = up.select("display_id", "date", F.lit(True).alias("t"), F.lit(False).alias("f")) \
        .unionByName(errs.select("display_id", "date", F.lit(False).alias("t"), F.lit(True).alias("f")))
    out = distinct_counts(rows, "date", "display_id", {"totalNumberOfDisplays": F.col("t"), "errorCount": F.col("f")})
    out = out.where(F.col("totalNumberOfDisplays") > 0)
    return out.select(F.col("date").alias("total_date"), "totalNumberOfDisplays", "errorCount",
                      r6(C.safe_ratio(F.col("totalNumberOfDisplays") - F.col("errorCount"), "totalNumberOfDisplays"))
                      .alias("Reliability"))


CACHE_REL_SQL = lambda d0, d1: f"""(with c as (select event_type as event, props as event_details, cast(user_id as varchar) as display_id,
  cast(cast(strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as timestamp) as date) as date from {q(d0, d1)}),
 inst as (select cast(user_id as varchar) as display_id, date from {q(d0, d1)} where event_type = 'click' and value > 95),
 t as (select date, count(distinct display_id) as n from c where event = 'view' and display_id != 'no-displayId' group by 1),
 e as (select date, count(distinct display_id) as n from (select display_id, date from c where event = 'error'
  and display_id != 'no-displayId' and event_details <> '{{"k": 0}}' and event_details not like '{{"k": 1_}}'
  union all select display_id, date from inst) group by 1)
 select t.date as total_date, t.n as totalNumberOfDisplays, coalesce(e.n, 0) as errorCount,
  round((t.n - coalesce(e.n, 0)) / t.n, 6) as Reliability from t left join e on t.date = e.date)"""  # noqa: E731


@rollup("R61_cache_daily_reliability", f"""
select * from {CACHE_REL_SQL(YESTERDAY, AS_OF + D(days=1))} union all select * from {CACHE_REL_SQL(None, YESTERDAY)} where total_date < date '{YESTERDAY}'""", start=YESTERDAY, end=AS_OF, date_col="total_date")
def r61(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Cache reliability for yesterday and today, spliced over the stored days.  The
    cache family keeps ``ts`` as text (schema registry); it is parsed at read."""
    def cache(events: DataFrame) -> DataFrame:
        c = conform(events.select(
            F.col("event_type").alias("event"), F.col("props").alias("event_details"),
            F.col("user_id").cast("string").alias("display_id"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")), "cache_events_v2")
        return c.withColumn("date", F.to_date(F.to_timestamp_ntz("ts")))

    def restarts(events: DataFrame) -> DataFrame:
        return events.where((F.col("event_type") == "click") & (F.col("value") > 95)) \
            .select(F.col("user_id").cast("string").alias("display_id"), "date")

    # date bounds on the raw scan (pruning), before the text timestamps are parsed
    w = cat.read_events(ev(spark, d), first, last)
    return _cache_rel(cache(w), restarts(w))


# Binding (R62): recurring revenue = open orders ('O') of the evaluation month number
# (the view compares the month only); licensed = latest configuration value > 50;
# connected uptime sample = view / click with value < 95.
@query("R62_company_displays_mrr", f"""
with mrr as (select o_custkey as companyId, sum(o_totalprice) as mrr from orders where o_orderstatus = 'O'
  and month(o_orderdate) = {AS_OF.month} group by 1),
co as (select c.c_custkey as companyId, c.c_name as companyName, c.c_mktsegment as companyIndustry,
  coalesce(m.mrr, 0) as companyMRR from customer c left join mrr m on m.companyId = c.c_custkey where c.c_acctbal >= 0),
cfg as {LATEST_CFG_SQL},
dd as (select distinct user_id from events),
cd as (select co.companyName, co.companyId, co.companyIndustry, dd.user_id as displayId, co.companyMRR,
  case co.companyIndustry {' '.join(f"when '{k}' then '{v}'" for k, v in OS_BY_INDUSTRY.items())} end as os, cfg.value > 50 as licensed
  from dd left join co on co.companyId = dd.user_id left join cfg on cfg.user_id = dd.user_id where cfg.user_id is not null)
select cd.companyName, cd.companyId, cd.companyIndustry, cd.displayId, round(cd.companyMRR, 2) as companyMRR, cd.os, cd.licensed,
 max(e.ts) as lastActiveDate
from cd left join events e on e.user_id = cd.displayId where e.event_type in ('view', 'click') and e.value < 95
group by 1, 2, 3, 4, 5, 6, 7""")
def r62(spark: SS, d: str) -> DataFrame:
    """Displays with their company, industry, recurring revenue (0 without), OS,
    licensed flag and last connected sample; displays without a configuration or
    without a connected sample drop out, as in the view."""
    e = ev(spark, d)
    o = tbl(spark, d, "orders", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    mrr = o.where((F.col("o_orderstatus") == "O") & (F.month("o_orderdate") == AS_OF.month)) \
        .groupBy(F.col("o_custkey").alias("companyId")).agg(F.sum("o_totalprice").alias("mrr"))
    co = tbl(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal").where(F.col("c_acctbal") >= 0) \
        .select(F.col("c_custkey").alias("companyId"), F.col("c_name").alias("companyName"),
                F.col("c_mktsegment").alias("companyIndustry"))
    co = co.join(mrr, "companyId", "left").withColumn("companyMRR", F.coalesce("mrr", F.lit(0.0))).drop("mrr")
    cfg = latest_config(e).select("user_id", (F.col("value") > 50).alias("licensed"))
    displays = e.select(F.col("user_id").alias("displayId")).distinct()
    cd = displays.join(co, displays.displayId == co.companyId, "left") \
        .join(cfg, F.col("displayId") == cfg.user_id, "inner").drop("user_id")
    last = e.where(F.col("event_type").isin("view", "click") & (F.col("value") < 95)) \
        .groupBy(F.col("user_id").alias("displayId")).agg(F.max("ts").alias("lastActiveDate"))
    return cd.join(last, "displayId", "inner").select(
        "companyName", "companyId", "companyIndustry", "displayId", F.round("companyMRR", 2).alias("companyMRR"),
        os_of(F.col("companyIndustry")).alias("os"), "licensed", "lastActiveDate")
