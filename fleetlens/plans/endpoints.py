"""Daily endpoint summaries with all their keys and dimensions.

Binding of the endpoint logs (see ``tables.py`` for the roles): the event log is all events,
heartbeats are 'view' and 'click' events, viewer heartbeats 'view' events; the endpoint is
the user; its type, browser, system, schedule, presentation, placeholder and component follow
from the user and the release number ``k``, the error code is ``k``.  Change logs: displays,
schedules, companies and hierarchies are orders (version = order key; production = priority other
than '5-LOW', hierarchies: status other than 'P'), presentations are line items; parents are the
customer numbered as the nation, networks the direct children of customer ``ROOT``.  Licences are
those of R08 (order key = display), 'MACHINERY' plans are suspended.  Error definitions are the
parts (even sizes relate to uptime).  Download log: pages, URLs built from the page.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators.dimensions import ATTACHED, EndpointDimensions, company_rows, current, endpoint_rows
from fleetlens.operators.latest import latest_by
from fleetlens.operators.reliability import interval_uptime
from fleetlens.plans.dataflow import r08
from fleetlens.plans.registry import ORACLE, query
from fleetlens.plans.reports import D, ev, q
from fleetlens.plans.reports_uptime import CLEAN_APP_SQL, HEARTBEATS_PER_DAY, _endpoint_logs
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl
from fleetlens.sources import catalog as cat

SS = SparkSession
r6 = C.r
ROOT = 19
SUSPENDED = "MACHINERY"
W30_START = AS_OF - D(days=30)
#: Error definitions that are broadcast at most; a longer list is joined without a hint.
MOST_DEFINITIONS = 100_000

ENDPOINT = ["endpointId", "endpointType", "browserVersion", "osVersion"]
CONTENT = ["scheduleId", "presentationId", "placeholderId", "componentId", "scheduleItemUrl"]
APP = ["eventApp", "eventAppVersion"]

_LOG = {
    "endpointId": "user_id",
    "endpointType": "case when k % 11 = 0 then 'Unknown' when k % 3 = 0 then 'SharedSchedule' else 'Display' end",
    "browserVersion": "'Chrome ' || cast(k // 50 as varchar)",
    "osVersion": "'os-' || cast(k % 2 as varchar)",
    "scheduleId": "cast((user_id * 7 + k // 50) % 150 as bigint)",
    "presentationId": "cast((user_id + k // 34) % 200 as bigint)",
    "placeholderId": "'ph-' || cast(k % 2 as varchar)",
    "componentId": "'component-' || cast(k // 50 as varchar)",
    "scheduleItemUrl": "'https://items.example.com/' || cast(user_id % 5 as varchar)",
}


def _spark(sql: str) -> str:
    return sql.replace("k // 50", "k div 50").replace("k // 34", "k div 34").replace("varchar", "string")


def endpoint_log(e: DataFrame) -> DataFrame:
    """Events as endpoint log rows: date, ts, event_type and the keys above."""
    x = _endpoint_logs(e)
    return x.select("date", "ts", "event_type", *[F.expr(_spark(v)).alias(n) for n, v in _LOG.items()], *APP,
                    F.col("k").alias("eventErrorCode"))


def log_sql(d0: dt.date, d1: dt.date) -> str:
    cols = ", ".join(f"{v} as {n}" for n, v in _LOG.items())
    return (f"(select date, ts, event_type, {cols}, {CLEAN_APP_SQL} as eventApp, cast(k // 10 as varchar) as eventAppVersion, "
            f"k as eventErrorCode from {q(d0, d1)})")


# ------------------------------------------------------------------ dimensions
def _orders(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")


def company_log(spark: SS, d: str) -> DataFrame:
    c = tbl(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    o = current(_orders(spark, d), "o_custkey", "o_orderkey", F.col("o_orderpriority") != "5-LOW")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_custkey").alias("companyId"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("companyIndustry"),
        F.col("c_nationkey").cast("long").alias("parentId"))


def hierarchy_log(spark: SS, d: str) -> DataFrame:
    o = current(_orders(spark, d), "o_custkey", "o_orderkey", F.col("o_orderstatus") != "P")
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey")
    n = tbl(spark, d, "nation", "n_nationkey", "n_regionkey")
    return (o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)  # 25 rows, fixed
            .select(F.col("c_custkey").alias("companyId"),
                    F.array(F.col("c_nationkey").cast("long"), F.col("n_regionkey").cast("long")).alias("ancestorId")))


def dimensions(spark: SS, d: str) -> EndpointDimensions:
    """The run's endpoint dimensions from the change logs (R06), ancestors (R07) and licences."""
    o = _orders(spark, d)
    live = F.col("o_orderpriority") != "5-LOW"
    displays = current(o, "o_custkey", "o_orderkey", live).select(
        F.col("o_custkey").alias("displayId"), F.floor(F.col("o_custkey") / 2).cast("long").alias("companyId"))
    schedules = current(o.withColumn("scheduleId", F.expr("o_orderkey div 10")), "scheduleId", "o_orderkey", live).select(
        "scheduleId", F.col("o_custkey").alias("scheduleCompanyId"))
    li = tbl(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_linestatus", "l_orderkey", "l_linenumber")
    presentations = (current(li, "l_partkey", ["l_orderkey", "l_linenumber", "l_suppkey", "l_linestatus"],
                             F.col("l_linestatus") == "O")
                     .select(F.col("l_partkey").alias("presentationId"), F.col("l_suppkey").alias("templateId")))
    config = _endpoint_logs(cat.read_events(ev(spark, d), None, YESTERDAY)).where(F.col("event_type") == "view")
    versions = latest_by(config.select("user_id", "ts", "k"), "user_id", "ts", ties="keep").select(
        F.col("user_id").alias("displayId"), F.concat(F.lit("player "), F.col("k").cast("string")).alias("playerVersion")).distinct()
    licences = r08(spark, d).select("displayId", "planSubscriptionStatus")
    return EndpointDimensions(endpoint_rows(displays, versions, licences, SUSPENDED), schedules, presentations,
                              company_rows(company_log(spark, d), hierarchy_log(spark, d), ROOT))


DIMS_SQL = f"""lic as ({ORACLE["R08_licensed_displays"].replace("with subs as", "with lsubs as").replace("from subs s", "from lsubs s")}),
 ord as (select * from orders),
 companies as (select c.c_custkey as companyId, c.c_name as name, c.c_mktsegment as companyIndustry, c.c_nationkey::bigint as parentId
  from customer c join ord o on o.o_custkey = c.c_custkey join (select max(o_orderkey) as id, o_custkey from ord group by 2) m
  on m.id = o.o_orderkey and m.o_custkey = o.o_custkey where o.o_orderpriority <> '5-LOW'),
 displays as (select o.o_custkey as displayId, (o.o_custkey // 2)::bigint as companyId from ord o
  join (select max(o_orderkey) as id, o_custkey from ord group by 2) m on m.id = o.o_orderkey where o.o_orderpriority <> '5-LOW'),
 schedules as (select o.o_orderkey // 10 as scheduleId, o.o_custkey as companyId from ord o
  join (select max(o_orderkey) as id from ord group by o_orderkey // 10) m on m.id = o.o_orderkey where o.o_orderpriority <> '5-LOW'),
 presentations as (select l_partkey as presentationId, l_suppkey as templateId from (select *, row_number() over (partition by l_partkey
  order by l_orderkey desc, l_linenumber desc, l_suppkey desc, l_linestatus desc) as rn from lineitem) where rn = 1 and l_linestatus = 'O'),
 hier as (select c.c_custkey as companyId, unnest([c.c_nationkey, n.n_regionkey, c.c_custkey])::bigint as ancestorId
  from customer c join nation n on n.n_nationkey = c.c_nationkey join ord o on o.o_custkey = c.c_custkey
  join (select max(o_orderkey) as id, o_custkey from ord group by 2) m on m.id = o.o_orderkey where o.o_orderstatus <> 'P'),
 networks as (select distinct h.ancestorId as companyId, h.companyId as subCompanyId, c.name, c.companyIndustry
  from hier h join companies c on c.companyId = h.ancestorId where c.parentId = {ROOT}),
 versions as (select distinct user_id as displayId, 'player ' || cast(k as varchar) as playerVersion from {q(None, AS_OF)}
  where event_type = 'view' and (user_id, ts) in (select user_id, max(ts) from events where event_type = 'view'
  and ts < timestamp '{AS_OF}' group by 1))"""
DIM_COLS_SQL = f"""case when l.displayId is null then 'Unlicensed' when l.planSubscriptionStatus <> '{SUSPENDED}' then 'Licensed'
 else 'Suspended' end as licenseStatus, v.playerVersion, c.companyId, c.name as companyName, c.companyIndustry,
 p.companyId as parentCompanyId, p.name as parentCompanyName, n.companyId as networkCompanyId, n.name as networkCompanyName,
 n.companyIndustry as networkCompanyIndustry"""
DIM_JOINS_SQL = """left join companies c on c.companyId = x.companyId left join companies p on p.companyId = c.parentId
 left join networks n on n.subCompanyId = c.companyId left join versions v on v.displayId = x.endpointId
 left join lic l on l.displayId = x.endpointId"""
WITH_COMPANY_SQL = """case x.endpointType when 'Display' then d.companyId else s.companyId end as companyId"""
COMPANY_JOINS_SQL = "left join displays d on d.displayId = x.endpointId left join schedules s on s.scheduleId = x.scheduleId"


@query("R09b_endpoint_dimensions", f"""
with {DIMS_SQL}, every as (select displayId from displays union select displayId from versions union select displayId from lic),
x as (select e.displayId as endpointId, 'Display' as endpointType, d.companyId from every e left join displays d on d.displayId = e.displayId)
select x.endpointId, {DIM_COLS_SQL} from x {DIM_JOINS_SQL}""")
def r09b(spark: SS, d: str) -> DataFrame:
    """Every known display with its whole dimensions, as its rows of any summary get them."""
    dims = dimensions(spark, d)
    rows = dims.endpoints.select(F.col("displayId").alias("endpointId")).distinct().select(
        "endpointId", F.lit("Display").alias("endpointType"), F.lit(None).cast("long").alias("scheduleId"))
    return dims.attach(rows).select("endpointId", *ATTACHED)


# ------------------------------------------------------------------ R87: daily errors
ERROR_KEYS = ["date", *ENDPOINT, "viewerVersion", *CONTENT, *APP, "eventErrorCode"]


def error_counts(log: DataFrame) -> DataFrame:
    """Log rows per the fourteen keys (the viewer version is that of the row's app)."""
    return (log.withColumn("viewerVersion", F.when(F.col("event_type") == "view", F.col("eventAppVersion")))
            .groupBy(*ERROR_KEYS).agg(F.count(F.lit(1)).alias("errorCount")))


def error_counts_sql(d0: dt.date, d1: dt.date) -> str:
    keys = ", ".join(ERROR_KEYS)
    return (f"(select {keys}, count(*) as errorCount from (select *, case when event_type = 'view' then eventAppVersion end as "
            f"viewerVersion from {log_sql(d0, d1)}) group by {', '.join(str(i + 1) for i in range(len(ERROR_KEYS)))})")


def daily_errors(spark: SS, d: str, first: dt.date, last: dt.date, dims: EndpointDimensions | None = None) -> DataFrame:
    log = endpoint_log(cat.read_events(ev(spark, d), first, last))
    return (dims or dimensions(spark, d)).attach(error_counts(log)).select(*ERROR_KEYS, *ATTACHED, "errorCount")


def daily_errors_sql(d0: dt.date, d1: dt.date) -> str:
    keys = ", ".join(f"x.{k}" for k in ERROR_KEYS)
    return f"""with {DIMS_SQL}, e as (select * from {error_counts_sql(d0, d1)}),
x as (select x.*, {WITH_COMPANY_SQL} from e x {COMPANY_JOINS_SQL})
select {keys}, {DIM_COLS_SQL}, x.errorCount from x {DIM_JOINS_SQL}"""


@query("R87b_daily_errors_full", daily_errors_sql(YESTERDAY, AS_OF))
def r87b(spark: SS, d: str) -> DataFrame:
    """Yesterday's log rows per endpoint, versions, content, app and code, with all dimensions."""
    return daily_errors(spark, d, YESTERDAY, YESTERDAY)


# ------------------------------------------------------------------ R89: causes, from the error definitions
def error_definitions(spark: SS, d: str) -> DataFrame:
    """code, message, description, solution, isRelatedToUptime: a maintained list, one row per code."""
    return tbl(spark, d, "part", F.col("p_partkey").alias("code"), F.col("p_name").alias("message"),
               F.col("p_type").alias("description"), F.col("p_brand").alias("solution"),
               F.when(F.col("p_size") % 2 == 0, "Y").otherwise("N").alias("isRelatedToUptime"))


DEFS_SQL = """(select p_partkey as code, p_name as message, p_type as description, p_brand as solution,
 case when p_size % 2 = 0 then 'Y' else 'N' end as isRelatedToUptime from part)"""


def bounded(definitions: DataFrame, most: int = MOST_DEFINITIONS) -> DataFrame:
    """The list, broadcast if it has at most ``most`` rows (counted up to there)."""
    return F.broadcast(definitions) if definitions.limit(most + 1).count() <= most else definitions


CAUSE_KEYS = ["date", "endpointId", "endpointType", *APP, "companyId", "companyName", "companyIndustry", "parentCompanyId",
              "parentCompanyName", "networkCompanyId", "networkCompanyName", "networkCompanyIndustry", "eventErrorCode"]


@query("R89d_app_downtime_causes", f"""
with e as (select {', '.join(CAUSE_KEYS)}, sum(errorCount)::bigint as errorCount from ({daily_errors_sql(W30_START, AS_OF)})
 where endpointType <> 'Unknown' and companyId is not null group by {', '.join(str(i + 1) for i in range(len(CAUSE_KEYS)))})
select distinct e.* exclude (errorCount), f.message, f.description, f.solution, e.errorCount
from e join {DEFS_SQL} f on f.code = e.eventErrorCode where f.isRelatedToUptime = 'Y'""")
def r89d(spark: SS, d: str) -> DataFrame:
    """Downtime causes by app over 30 days: uptime-related codes with message, description and solution."""
    defs = error_definitions(spark, d).where(F.col("isRelatedToUptime") == "Y").drop("isRelatedToUptime")
    log = endpoint_log(cat.read_events(ev(spark, d), W30_START, YESTERDAY)).where(F.col("endpointType") != "Unknown")
    # counted per schedule first: the company may hang on it
    per = log.groupBy("date", "endpointId", "endpointType", *APP, "scheduleId", "eventErrorCode").agg(
        F.count(F.lit(1)).alias("errorCount"))
    known = per.join(bounded(defs), F.col("eventErrorCode") == F.col("code")).drop("code")
    out = dimensions(spark, d).attach(known).where(F.col("companyId").isNotNull())
    return out.groupBy(*CAUSE_KEYS, "message", "description", "solution").agg(F.sum("errorCount").alias("errorCount"))


# ------------------------------------------------------------------ R86: daily usage
MENTION = ["date", *ENDPOINT, "viewerVersion"]
USED = ["scheduleId", "presentationId", "componentId", "scheduleItemUrl"]


@query("R86b_daily_usage_full", f"""
with {DIMS_SQL}, log as (select * from {log_sql(YESTERDAY, AS_OF)} where event_type in ('view', 'click')),
m as (select distinct date, endpointId, endpointType, browserVersion, osVersion, eventAppVersion as viewerVersion from log where event_type = 'view'),
h as (select date, endpointId, scheduleId, presentationId, placeholderId, componentId, scheduleItemUrl, eventApp, eventAppVersion,
 count(*) as n from log group by 1, 2, 3, 4, 5, 6, 7, 8, 9),
x as (select m.*, h.scheduleId, h.presentationId, h.componentId, h.scheduleItemUrl, h.eventApp, h.eventAppVersion, pr.templateId,
 case m.endpointType when 'Display' then d.companyId else s.companyId end as companyId, round(h.n / {HEARTBEATS_PER_DAY}, 6) as usage
 from m left join displays d on d.displayId = m.endpointId left join h on h.date = m.date and h.endpointId = m.endpointId
 left join schedules s on s.scheduleId = h.scheduleId left join presentations pr on pr.presentationId = h.presentationId)
select {', '.join('x.' + c for c in [*MENTION, *USED, 'templateId', *APP])}, {DIM_COLS_SQL}, x.usage from x {DIM_JOINS_SQL}""")
def r86b(spark: SS, d: str) -> DataFrame:
    """Yesterday's usage: each kind of viewer that an endpoint reported beside each content and app it ran,
    heartbeats as a share of a full day, with template and dimensions."""
    return daily_usage(spark, d)


def daily_usage(spark: SS, d: str, dims: EndpointDimensions | None = None) -> DataFrame:
    log = endpoint_log(cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY)).where(F.col("event_type").isin("view", "click"))
    mentions = log.where(F.col("event_type") == "view").withColumn("viewerVersion", F.col("eventAppVersion")).select(*MENTION).distinct()
    counts = log.groupBy("date", "endpointId", *CONTENT, *APP).agg(F.count(F.lit(1)).alias("n")).drop("placeholderId")
    rows = mentions.join(counts, ["date", "endpointId"], "left")
    return (dims or dimensions(spark, d)).attach(rows, template=True).select(
        *MENTION, *USED, "templateId", *APP, *ATTACHED, r6(F.col("n") / HEARTBEATS_PER_DAY).alias("usage"))


# ------------------------------------------------------------------ R85: daily uptime
UP_KEYS = ["date", *ENDPOINT, "viewerVersion", *CONTENT]


def daily_uptime(spark: SS, d: str, dims: EndpointDimensions | None = None) -> DataFrame:
    """Endpoint rows (no app) and app rows of yesterday beside every kind of viewer heartbeat of the endpoint."""
    log = endpoint_log(cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY))
    codes = bounded(error_definitions(spark, d).select(F.col("code").alias("eventErrorCode")))
    errors = log.join(codes, "eventErrorCode", "left_semi")
    beats = log.where(F.col("event_type").isin("view", "click"))
    up = interval_uptime(beats, log, errors, ["endpointId", *APP])
    # both levels from one count per app: an endpoint's intervals are the sum of its apps'
    per = up.groupBy("endpointId", *APP).agg(F.count(F.lit(1)).alias("n"), F.count_if("up").alias("good"))
    # an app without name or version has no match between its own counts (plain equality), so it counts as down
    named = F.col("eventApp").isNotNull() & F.col("eventAppVersion").isNotNull()
    apps = per.select("endpointId", *APP, F.when(named, F.col("good") / F.col("n")).otherwise(0.0).alias("uptimePercentage"))
    whole = per.groupBy("endpointId").agg((F.sum("good") / F.sum("n")).alias("uptimePercentage")).select(
        "endpointId", F.lit(None).cast("string").alias("eventApp"), F.lit(None).cast("string").alias("eventAppVersion"), "uptimePercentage")
    mentions = log.where(F.col("event_type") == "view").withColumn("viewerVersion", F.col("eventAppVersion")).select(*UP_KEYS).distinct()
    rows = mentions.join(whole.unionByName(apps), "endpointId")
    return (dims or dimensions(spark, d)).attach(rows, template=True).select(
        *[c for c in UP_KEYS if c != "placeholderId"], "templateId", *APP, *ATTACHED, r6("uptimePercentage").alias("uptimePercentage"))


@query("R85c_daily_uptime_full", f"""
with {DIMS_SQL}, log as (select *, to_timestamp((floor(epoch(ts))::bigint // 300) * 300)::timestamp as iv from {log_sql(YESTERDAY, AS_OF)}),
m as (select distinct date, endpointId, endpointType, browserVersion, osVersion, eventAppVersion as viewerVersion, scheduleId, presentationId,
 placeholderId, componentId, scheduleItemUrl from log where event_type = 'view'),
er as (select iv, endpointId, eventApp, eventAppVersion, count(eventErrorCode) as errorCount from log join {DEFS_SQL} f on f.code = eventErrorCode
 group by 1, 2, 3, 4),
i as (select iv, endpointId, eventApp, eventAppVersion from log where event_type in ('view', 'click') union
 select iv, endpointId, eventApp, eventAppVersion from log),
ud as (select i.*, coalesce(er.errorCount, 0) = 0 as up from i left join er on er.iv = i.iv and er.endpointId = i.endpointId
 and er.eventApp = i.eventApp and er.eventAppVersion = i.eventAppVersion),
ta as (select endpointId, eventApp, eventAppVersion, count(*) as n from ud group by 1, 2, 3),
ua as (select endpointId, eventApp, eventAppVersion, count(*) as n from ud where up group by 1, 2, 3),
te as (select endpointId, count(*) as n from ud group by 1), ue as (select endpointId, count(*) as n from ud where up group by 1),
u as (select te.endpointId, '' as eventApp, '' as eventAppVersion, coalesce(ue.n, 0) / te.n as pct from te left join ue on ue.endpointId = te.endpointId
 union all select ta.endpointId, ta.eventApp, ta.eventAppVersion, coalesce(ua.n, 0) / ta.n from ta left join ua on ua.endpointId = ta.endpointId
 and ua.eventApp = ta.eventApp and ua.eventAppVersion = ta.eventAppVersion),
x as (select m.*, u.eventApp, u.eventAppVersion, u.pct, pr.templateId, case m.endpointType when 'Display' then d.companyId else s.companyId end
 as companyId from m join u on u.endpointId = m.endpointId left join displays d on d.displayId = m.endpointId
 left join schedules s on s.scheduleId = m.scheduleId left join presentations pr on pr.presentationId = m.presentationId)
select {', '.join('x.' + c for c in UP_KEYS if c != 'placeholderId')}, x.templateId, nullif(x.eventApp, '') as eventApp,
 nullif(x.eventAppVersion, '') as eventAppVersion, {DIM_COLS_SQL}, round(x.pct, 6) as uptimePercentage from x {DIM_JOINS_SQL}""")
def r85c(spark: SS, d: str) -> DataFrame:
    """Yesterday's uptime of endpoints and of their apps, with content, template and dimensions."""
    return daily_uptime(spark, d)


# ------------------------------------------------------------------ R50: active displays, heartbeat form
@query("R50c_active_displays_by_heartbeat", f"""
select date, endpointId as displayId from {log_sql(AS_OF - D(days=7), AS_OF)} where endpointType = 'Display' and event_type = 'view'
union select date, endpointId from {log_sql(AS_OF, AS_OF + D(days=1))} where endpointType = 'Display' and event_type in ('view', 'click')""")
def r50c(spark: SS, d: str) -> DataFrame:
    """Displays of the last seven days of the daily uptime table (an endpoint is in it with a viewer heartbeat)
    and of today's heartbeats: one scan, one distinct."""
    log = endpoint_log(cat.read_events(ev(spark, d), AS_OF - D(days=7), AS_OF)).where(F.col("endpointType") == "Display")
    seen = (F.col("event_type") == "view") | ((F.col("event_type") == "click") & (F.col("date") == F.lit(AS_OF)))
    return log.where(seen).select("date", F.col("endpointId").alias("displayId")).distinct()
