"""Dataflow operators R01-R16 as jobs over the driver tables (bindings in tables.py)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import joins as J
from fleetlens.operators.latest import latest_by, production
from fleetlens.operators.nested import allocate_cost, expand_hierarchy, licensed_assignments, snapshot_diff
from fleetlens.operators.reliability import daily_reliability, distinct_counts, funnel, top_errors
from fleetlens.operators.rollup import one_scan_union, pivot_metrics
from fleetlens.plans.registry import query
from fleetlens.plans.rollups import rollup
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl, version_of
from fleetlens.sources import catalog as cat

SS = SparkSession
r6 = C.r
CUTOFF = AS_OF - dt.timedelta(days=3)  # fresh window = the last 3 days


def ev(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "events")


@query("R01_latest_by", """
select o_custkey, o_orderkey, o_orderstatus, o_totalprice from orders
where (o_custkey, o_orderkey) in (select o_custkey, max(o_orderkey) from orders group by 1)""")
def r01(spark: SS, d: str) -> DataFrame:
    o = tbl(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return latest_by(o, "o_custkey", "o_orderkey", ties="one")


def _daily_error_users(e: DataFrame) -> DataFrame:
    return distinct_counts(e.withColumn("date", F.to_date("ts")), "date", "user_id",
                           {"users": F.lit(True), "errors": F.col("event_type") == "error"})


@rollup("R02_splice_rollup", f"""
with fresh as (select cast(ts as date) as date, count(distinct user_id) as users,
  count(distinct case when event_type = 'error' then user_id end) as errors from events
  where ts >= timestamp '{CUTOFF}' and ts < timestamp '{AS_OF}' group by 1),
hist as (select cast(ts as date) as date, count(distinct user_id) as users,
  count(distinct case when event_type = 'error' then user_id end) as errors from events
  where ts < timestamp '{CUTOFF}' group by 1)
select * from fresh union all select * from hist where date < date '{CUTOFF}'""", start=CUTOFF)
def r02(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    return _daily_error_users(cat.read_events(ev(spark, d), first, last))


@query("R03_daily_reliability", """
with t as (select cast(ts as date) as date, count(distinct user_id) as total from events group by 1),
f as (select cast(ts as date) as date, count(distinct user_id) as failed from events where event_type = 'error' group by 1)
select t.date, t.total, coalesce(f.failed, 0) as failed, round((t.total - coalesce(f.failed, 0)) / t.total * 100, 6) as pct
from t left join f on t.date = f.date""")
def r03(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("date", F.to_date("ts"))
    return daily_reliability(e, "user_id", F.col("event_type") == "error")


@query("R04_pivot_metrics", """
with spine as (select distinct cast(ts as date) as date from events),
g as (select cast(ts as date) as date, count(distinct user_id) filter (where event_type = 'error') as error,
 count(distinct user_id) filter (where event_type = 'view') as "view",
 count(distinct user_id) filter (where event_type = 'purchase' and value > 50) as purchase from events group by 1)
select s.date, cast(nullif(g.error, 0) as double) as error, cast(nullif(g."view", 0) as double) as "view",
 cast(nullif(g.purchase, 0) as double) as purchase from spine s left join g on s.date = g.date""")
def r04(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("date", F.to_date("ts"))

    def series(cond):
        return e.where(cond).groupBy("date").agg(F.count_distinct("user_id").alias("value"))

    spine = e.select("date").distinct()
    return pivot_metrics({"error": series(F.col("event_type") == "error"),
                          "view": series(F.col("event_type") == "view"),
                          "purchase": series((F.col("event_type") == "purchase") & (F.col("value") > 50))},
                         spine=spine)


@query("R05_parse_request_url", """
select page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) as host,
case when regexp_matches(url, '^https?://[^/]+/([a-z]{2})/') then regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) end as lang,
case when regexp_matches(url, '/(\\d+)') then regexp_extract(url, '/(\\d+)', 1) end as id,
case when regexp_matches(url, '[?&]page=([^&#]*)') then regexp_extract(url, '[?&]page=([^&#]*)', 1) end as page,
case when regexp_matches(url, '[?&]utm_source=([^&#]*)') then regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) end as utm_source
from pages""")
def r05(spark: SS, d: str) -> DataFrame:
    u = F.col("url")
    return tbl(spark, d, "pages", "page_id", "url").select(
        "page_id", F.regexp_extract(u, r"^https?://([^/?#]+)", 1).alias("host"),
        C.regexp_extract_or_null(u, r"^https?://[^/]+/([a-z]{2})/").alias("lang"),
        C.regexp_extract_or_null(u, r"/(\d+)").alias("id"),
        C.url_param(u, "page").alias("page"), C.url_param(u, "utm_source").alias("utm_source"))


@query("R06_production_entities", """
with src as (select * from orders where o_orderpriority <> '5-LOW'),
cur as (select * from src where (o_custkey, o_orderkey) in (select o_custkey, max(o_orderkey) from src group by 1))
select o_custkey, o_orderkey, o_orderstatus from cur where o_orderstatus <> 'P'""")
def r06(spark: SS, d: str) -> DataFrame:
    o = tbl(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    cur = production(o, "o_custkey", "o_orderkey", pre=F.col("o_orderpriority") != "5-LOW",
                     post=F.col("o_orderstatus") != "P")
    return cur.select("o_custkey", "o_orderkey", "o_orderstatus")


def _hierarchy(spark: SS, d: str) -> DataFrame:
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey")
    n = tbl(spark, d, "nation", "n_nationkey", "n_regionkey")  # 25 rows, fixed
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    return j.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
                    F.array(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")),
                            F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))).alias("ancestorId"))


@query("R07_expand_hierarchy", """
with h as (select 'C' || cast(c_custkey as varchar) as id, 'N' || cast(n_nationkey as varchar) as nat,
 'R' || cast(n_regionkey as varchar) as reg from customer join nation on c_nationkey = n_nationkey)
select nat as company_id, id as sub_company_id from h union select reg, id from h union select id, id from h""")
def r07(spark: SS, d: str) -> DataFrame:
    return expand_hierarchy(_hierarchy(spark, d), "id", "ancestorId")


@query("R08_licensed_displays", """
with subs as (select c_custkey as companyId, case when c_mktsegment = 'AUTOMOBILE' then c_nationkey else c_custkey end as planCompanyId,
 c_mktsegment as planSubscriptionStatus, case when c_acctbal > 0 then floor(c_acctbal / 2000) end as planProCount from customer),
ord as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as pos from orders)
select distinct s.companyId, o.o_orderkey as displayId, s.planCompanyId as licensedBy, s.planSubscriptionStatus
from subs s join ord o on o.o_custkey = s.companyId where o.pos < coalesce(s.planProCount, 0)""")
def r08(spark: SS, d: str) -> DataFrame:
    """Assignments are order rows per customer (by order date, then key): the salted
    top-n keeps a customer with a third of all orders from landing in one task."""
    o = tbl(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    subs = c.select(
        "c_custkey", F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.col("c_nationkey").cast("long"))
        .otherwise(F.col("c_custkey")).alias("plan_company"), F.col("c_mktsegment").alias("status"),
        F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") / 2000)).alias("plan_pro_count"),
        F.lit(None).cast("long").alias("pro_count"), F.lit(None).cast("string").alias("na"))
    return licensed_assignments(o.withColumnRenamed("o_custkey", "c_custkey"), subs, company_col="c_custkey",
                                display_col="o_orderkey", order=["o_orderdate", "o_orderkey"],
                                plan_company_col="plan_company", status_col="status",
                                license_args=["na", "na", "na", "na", "na", "plan_pro_count", "pro_count"])


def _enriched(spark: SS, d: str) -> DataFrame:
    """Endpoint rows with company, parent, network, version and licence status."""
    e = ev(spark, d).withColumn("version", version_of())
    per = (e.groupBy(F.to_date("ts").alias("date"), "user_id")
             .agg(F.count(F.lit(1)).alias("events"), F.max("version").alias("player_version")))
    c = tbl(spark, d, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    n = tbl(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")   # fixed 25 rows
    rg = tbl(spark, d, "region", "r_regionkey", "r_name")                  # fixed 5 rows
    j = (per.join(c, per.user_id == c.c_custkey, "left")
            .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey, "left")
            .join(F.broadcast(rg), F.col("n_regionkey") == rg.r_regionkey, "left"))
    lic = F.when(F.col("c_acctbal") > 0, "licensed").when(F.col("c_acctbal").isNotNull(), "unlicensed")
    return j.select("date", "user_id", "events", F.col("c_name").alias("company"), F.col("n_name").alias("parent"),
                    F.col("r_name").alias("network"), "player_version", lic.alias("licence"))


ENRICHED_SQL = f"""(with per as (select cast(ts as date) as date, user_id, count(*) as events,
 max(cast(nullif(regexp_extract(props, '(\\d+)', 1), '') as integer)) as player_version from events group by 1, 2)
select per.date, per.user_id, per.events, c.c_name as company, n.n_name as parent, r.r_name as network, per.player_version,
 case when c.c_acctbal > 0 then 'licensed' when c.c_acctbal is not null then 'unlicensed' end as licence
from per left join customer c on per.user_id = c.c_custkey left join nation n on c.c_nationkey = n.n_nationkey
left join region r on n.n_regionkey = r.r_regionkey)"""


@query("R09_enrich_endpoint", f"select * from {ENRICHED_SQL}")
def r09(spark: SS, d: str) -> DataFrame:
    return _enriched(spark, d)


BETA_LIKE = '%"k": 1_}'  # release tags 10-19 are the beta channel


def stable_devices(e: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Non-beta devices seen by either player family in [start, end]."""
    w = cat.read_events(e, start, end).where(C.not_like("props", BETA_LIKE))
    families = {"installer": F.col("event_type").isin("signup", "purchase"),
                "player": F.col("event_type").isin("view", "click")}
    return one_scan_union(w, families, ["user_id"])


STABLE_SQL = f"""(select user_id from events where ts >= timestamp '{CUTOFF}' and ts < timestamp '{AS_OF}'
 and props not like '%"k": 1_}}' and event_type in ('signup', 'purchase')
 union select user_id from events where ts >= timestamp '{CUTOFF}' and ts < timestamp '{AS_OF}'
 and props not like '%"k": 1_}}' and event_type in ('view', 'click'))"""


@query("R10_stable_devices", f"select user_id from {STABLE_SQL}")
def r10(spark: SS, d: str) -> DataFrame:
    return stable_devices(ev(spark, d), CUTOFF, YESTERDAY)


def failed_and_configured(e: DataFrame, failed: "F.Column", configured: "F.Column") -> DataFrame:
    """(device, date) pairs with a failing event on a day the device also logged configuration."""
    e = e.withColumn("date", F.to_date("ts"))
    cfg = e.where(configured).select("user_id", "date")
    return J.semi(e.where(failed).select("user_id", "date"), cfg, ["user_id", "date"]).distinct()


@query("R11_failed_and_configured", """
select distinct user_id, cast(ts as date) as date from events e where event_type = 'error' and props not like '%"k": 9_}'
and exists (select 1 from events c where c.event_type = 'view' and c.user_id = e.user_id and cast(c.ts as date) = cast(e.ts as date))""")
def r11(spark: SS, d: str) -> DataFrame:
    return failed_and_configured(ev(spark, d), (F.col("event_type") == "error") & C.not_like("props", '%"k": 9_}'),
                                 F.col("event_type") == "view")


@query("R12_event_within_lookback_flag", """
select v.event_id, case when exists (select 1 from events e where e.user_id = v.user_id and e.event_type = 'error'
 and e.ts <= v.ts and e.ts > v.ts - interval 6 hour) then 1 else 0 end as whitescreen
from events v where v.event_type = 'view'""")
def r12(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    views = e.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    errs = e.where(F.col("event_type") == "error").select("user_id", "ts")
    n = J.lookback_count(views, errs, "user_id", 6 * 3600, name="n")
    return n.select("event_id", (F.col("n") > 0).cast("int").alias("whitescreen"))


@query("R13_incremental_funnel", """
with ent as (select user_id, min(cast(ts as date)) as cohort from events where event_type = 'signup' group by 1),
r as (select user_id, max(case when event_type = 'view' then 1 else 0 end) as has_view,
 max(case when event_type = 'click' then 1 else 0 end) as has_click,
 max(case when event_type = 'purchase' then 1 else 0 end) as has_purchase from events group by 1)
select cohort, count(distinct ent.user_id) as registered,
 count(distinct case when has_view = 1 then ent.user_id end) as reached_view,
 count(distinct case when has_click = 1 then ent.user_id end) as reached_click,
 count(distinct case when has_purchase = 1 then ent.user_id end) as reached_purchase
from ent left join r on ent.user_id = r.user_id group by 1""")
def r13(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    ent = e.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.min(F.to_date("ts")).alias("cohort"))
    return funnel(ent, e, entity="user_id", cohort_col="cohort", event_col="event_type",
                  steps=["view", "click", "purchase"])


@query("R14_top_errors", f"""
select substr(props, 1, 200) as details, count(distinct user_id) as display_count from events
where event_type = 'error' and cast(ts as date) = date '{YESTERDAY}' group by 1""")
def r14(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY).where(F.col("event_type") == "error")
    return top_errors(e, F.col("props"), "user_id").orderBy(F.col("display_count").desc(), "details")


@query("R15_allocate_cost", """
with units as (select cast(ts as date) as date, user_id, count(*) as units from events group by 1, 2),
pool as (select cast(ts as date) as date, sum(value) filter (where event_type = 'purchase') as cost,
 count(*) as total_units from events group by 1)
select u.date, u.user_id, u.units, round(u.units / p.total_units * p.cost, 6) as cost from units u join pool p on u.date = p.date""")
def r15(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("date", F.to_date("ts"))
    units = e.groupBy("date", "user_id").agg(F.count(F.lit(1)).alias("units"))
    pool = e.groupBy("date").agg(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("pool"))
    out = allocate_cost(units, "units", pool, "pool", by=["date"])  # pool: one row per day
    return out.select("date", "user_id", "units", r6("cost").alias("cost"))


def _snapshots(e: DataFrame) -> DataFrame:
    return (e.groupBy(F.to_date("ts").alias("collectionDate"), "user_id")
             .agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"),
                  F.count(F.lit(1)).alias("amount")))


@query("R16_snapshot_diff", """
with s as (select cast(ts as date) as collectionDate, user_id, arg_max(event_type, (ts, event_id)) as status, count(*) as amount
 from events group by 1, 2),
d1 as (select max(collectionDate) as d from s), d0 as (select max(collectionDate) as d from s where collectionDate < (select d from d1)),
cur as (select * from s where collectionDate = (select d from d1)), prev as (select * from s where collectionDate = (select d from d0))
select cur.user_id, cur.status, cur.amount from cur left join prev on cur.user_id = prev.user_id
where prev.user_id is null or cur.status is distinct from prev.status or cur.amount is distinct from prev.amount""")
def r16(spark: SS, d: str) -> DataFrame:
    return snapshot_diff(_snapshots(ev(spark, d)), "collectionDate", ["user_id"], ["status", "amount"])


@rollup("T06_late_data_reread", f"""
with fresh as (select cast(ts as date) as date, count(distinct user_id) as users,
  count(distinct case when event_type = 'error' then user_id end) as errors from events
  where ts >= timestamp '{YESTERDAY}' and ts < timestamp '{AS_OF}' group by 1),
hist as (select cast(ts as date) as date, count(distinct user_id) as users,
  count(distinct case when event_type = 'error' then user_id end) as errors from events
  where ts < timestamp '{YESTERDAY}' group by 1)
select * from fresh union all select * from hist where date < date '{YESTERDAY}'""", start=YESTERDAY)
def t06(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Recompute the last N = 1 day (late events included) and splice it over the stored rollup."""
    return _daily_error_users(cat.read_events(ev(spark, d), first, last))
