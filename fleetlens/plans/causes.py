"""Reports that join several logs in full.

Bindings beyond those of ``endpoints``, ``coverage`` and ``kinds``: shared-schedule errors are the events of five
days outside the beta channel, with the schedule of the endpoint log; segment companies are 'BUILDING' customers,
active displays those of R50's seven days; template loads are 'view' events up to 50 without two templates, HTML
templates the stored rows of R41; the packaged player is 'player-1'.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import timeutil as TU
from fleetlens.operators import joins as J
from fleetlens.operators.coverage import content_gaps, widget_coverage
from fleetlens.operators.dimensions import current
from fleetlens.operators.latest import latest_by
from fleetlens.operators.reliability import distinct_counts
from fleetlens.plans.coverage import DAY as SCHEDULE_DAY
from fleetlens.plans.coverage import _items_sql, presentations
from fleetlens.plans.dataflow import BETA_LIKE
from fleetlens.plans.endpoints import _LOG, _spark
from fleetlens.plans.kinds import _RESOURCE
from fleetlens.plans.registry import query
from fleetlens.plans.reports import D, W5_START, W7_START, ev, k_col, q
from fleetlens.plans.reports_companies import SCHED_SQL, r108
from fleetlens.plans.reports_uptime import DISPLAY_UPTIME_SQL, UPTIME_WS_SQL, _display_uptime, uptime_samples
from fleetlens.plans.rollups import rollup
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl
from fleetlens.sources import catalog as cat

SS = SparkSession
SEGMENT = "BUILDING"
SEGMENT_SQL = f"(select c_custkey from customer where c_mktsegment = '{SEGMENT}')"


def segment(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "customer", "c_custkey", "c_nationkey", "c_name", "c_mktsegment", "c_acctbal").where(F.col("c_mktsegment") == SEGMENT)


# ------------------------------------------------------------------ R35: shared-schedule errors with the latest schedule's company
_SS_SQL = f"""(select x.date, x.event_id, x.user_id as instance_id, x.scheduleId, s.companyId, x.event_type from
 (select *, {_LOG['scheduleId']} as scheduleId from {q(W5_START, AS_OF)} where props not like '{BETA_LIKE}') x left join
 (select o.o_orderkey // 10 as scheduleId, o.o_custkey as companyId from orders o join (select max(o_orderkey) as id from orders
  group by o_orderkey // 10) m on m.id = o.o_orderkey) s on s.scheduleId = x.scheduleId)"""


def _schedule_events(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), W5_START, YESTERDAY).where(C.not_like("props", BETA_LIKE)).withColumn("k", k_col())
    x = e.select("date", "event_id", F.col("user_id").alias("instance_id"), F.expr(_spark(_LOG["scheduleId"])).alias("scheduleId"), "event_type")
    o = tbl(spark, d, "orders", "o_orderkey", "o_custkey").withColumn("scheduleId", F.expr("o_orderkey div 10"))
    s = current(o, "scheduleId", "o_orderkey").select("scheduleId", F.col("o_custkey").alias("companyId"))
    return x.join(s, "scheduleId", "left")


@query("R35c_shared_schedule_events_with_company", f"select date, event_id, instance_id, scheduleId, companyId from {_SS_SQL}")
def r35c(spark: SS, d: str) -> DataFrame:
    """Shared-schedule events of five days with the company of their schedule's latest version."""
    return _schedule_events(spark, d).select("date", "event_id", "instance_id", "scheduleId", "companyId")


@query("R35d_shared_schedule_usage_and_errors", f"""
with x as (select * from {_SS_SQL}), e as (select * from x where event_type = 'error'),
ee as (select date, count(distinct instance_id) as "endpointsWithErrors" from e group by 1),
ce as (select date, count(distinct companyId) as "companiesWithErrors" from e group by 1),
tc as (select date, count(distinct companyId) as "totalCompanies" from x group by 1),
te as (select date, count(distinct instance_id) as "totalEndpoints" from x group by 1)
select * from ee left join ce using (date) left join tc using (date) left join te using (date) where date between date '{W5_START}' and date '{YESTERDAY}'""")
def r35d(spark: SS, d: str) -> DataFrame:
    """Endpoints and companies with errors, and in all, per day with an error; one pass for each of the two ids."""
    x = _schedule_events(spark, d).withColumn("bad", F.col("event_type") == "error")
    ends = distinct_counts(x, "date", "instance_id", {"endpointsWithErrors": F.col("bad"), "totalEndpoints": F.lit(True)})
    firms = distinct_counts(x, "date", "companyId", {"companiesWithErrors": F.col("bad"), "totalCompanies": F.lit(True)})
    days = x.where("bad").select("date").distinct()
    return days.join(ends, "date").join(firms, "date", "left").select(
        "date", "endpointsWithErrors", F.coalesce("companiesWithErrors", F.lit(0)).alias("companiesWithErrors"),
        F.coalesce("totalCompanies", F.lit(0)).alias("totalCompanies"), "totalEndpoints")


# ------------------------------------------------------------------ R42: segment adoption from both template sources
LOADED = "(event_type = 'view' and k < 50 and k not in (7, 13))"
HTML = "(event_type = 'view' and k >= 40 and value > 30)"


def _adoption_sql(d0: dt.date | None, d1: dt.date) -> str:
    active = f"(select distinct user_id from {q(W7_START, AS_OF)} where event_type in ('view', 'click') and user_id in {SEGMENT_SQL})"
    return f"""(select date, (select count(*) from {active}) as displays, (select count(distinct c_nationkey) from customer where c_custkey in {active}) as companies,
 count(distinct user_id) as displays_using, count(distinct c_nationkey) as companies_using from
 (select date, user_id from {q(d0, d1)} where {LOADED} union all select date, user_id from {q(d0, d1)} where {HTML}) t
 join customer on c_custkey = t.user_id where t.user_id in {active} group by 1)"""


@rollup("R42b_segment_adoption_of_both_sources", f"""
select * from {_adoption_sql(YESTERDAY, AS_OF)} union all select * from {_adoption_sql(None, YESTERDAY)} where date < date '{YESTERDAY}'""", start=YESTERDAY)
def r42b(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Active displays and companies of the segment, and those that used a template of either kind, per day."""
    e = ev(spark, d).withColumn("k", k_col())
    seg = segment(spark, d).select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    on = cat.read_events(e, W7_START, YESTERDAY).where(F.col("event_type").isin("view", "click")).select("user_id").distinct()
    active = seg.join(on, "user_id", "left_semi")
    totals = active.agg(F.count(F.lit(1)).alias("displays"), F.count_distinct("c_nationkey").alias("companies"))  # one row
    used = cat.read_events(e, first, last).where(F.expr(f"{LOADED} or {HTML}")).select("date", "user_id").distinct().join(active, "user_id")
    g = used.groupBy("date").agg(F.count_distinct("user_id").alias("displays_using"), F.count_distinct("c_nationkey").alias("companies_using"))
    return g.crossJoin(F.broadcast(totals)).select("date", "displays", "companies", "displays_using", "companies_using")


# ------------------------------------------------------------------ R59: unsupported displays of both sources
W30_START = AS_OF - D(days=30)
PACKAGED, OTHER_OS = "player-1", "%cros%"


def _param(name: str, signs: str, head: str = "[A-Za-z0-9-]+\\?sig") -> Column:
    return C.regexp_extract_or_null(F.col("resource"), rf"/v2/viewer/display/{head}.*&{name}=([{signs}]+)")


def _unsupported_rows(spark: SS, d: str) -> DataFrame:
    """displayId, companyId, os of displays on the packaged player, from request parameters and latest configurations."""
    w = cat.read_events(ev(spark, d), W30_START, YESTERDAY).withColumn("k", k_col())
    text = F.expr(_RESOURCE.replace("varchar", "string").replace("k // 25", "k div 25"))
    asked = w.where("event_type = 'click'").select(text.alias("resource")).select(
        C.regexp_extract_or_null(F.col("resource"), r"/v2/viewer/display/([A-Za-z0-9-]+)").alias("displayId"),
        _param("os", "A-Za-z0-9:-").alias("os"), _param("pn", "A-Za-z0-9-", "").alias("pn"))
    display = F.col("user_id").cast("string").alias("displayId")
    config = cat.read_events(ev(spark, d), None, YESTERDAY).withColumn("k", k_col()).where("event_type = 'signup' and user_id is not null").select(
        display, "ts", F.concat(F.lit("os "), (F.col("k") % 4).cast("string")).alias("os"),
        F.concat(F.lit("player-"), (F.col("k") % 3).cast("string")).alias("pn"))
    seen = w.where("event_type = 'view' and value > 50").select(display).distinct().join(
        latest_by(config, "displayId", "ts", ties="keep").drop("ts"), "displayId")
    both = asked.unionByName(seen).where((F.col("pn") == PACKAGED) & F.col("os").isNotNull() & ~F.col("os").like(OTHER_OS)).select(
        "displayId", "os").distinct()
    c = tbl(spark, d, "orders", F.col("o_custkey").cast("string").alias("displayId"), F.expr("o_custkey div 2").alias("companyId")).distinct()
    return both.join(c, "displayId")


_UNSUPPORTED_SQL = f"""(with w as (select * from {q(W30_START, AS_OF)}), r as (select {_RESOURCE} as resource from w where event_type = 'click'),
 a as (select regexp_extract(resource, '/v2/viewer/display/([A-Za-z0-9-]+)', 1) as displayId,
  nullif(regexp_extract(resource, '/v2/viewer/display/[A-Za-z0-9-]+\\?sig.*&os=([A-Za-z0-9:-]+)', 1), '') as os,
  nullif(regexp_extract(resource, '/v2/viewer/display/.*&pn=([A-Za-z0-9-]+)', 1), '') as pn from r where resource is not null),
 cfg as (select cast(user_id as varchar) as displayId, ts, 'os ' || cast(k % 4 as varchar) as os, 'player-' || cast(k % 3 as varchar) as pn
  from {q(None, AS_OF)} where event_type = 'signup' and user_id is not null),
 s as (select distinct cast(user_id as varchar) as displayId from w where event_type = 'view' and value > 50),
 u as (select displayId, os, pn from a union select c.displayId, c.os, c.pn from cfg c join s on s.displayId = c.displayId
  where (c.displayId, c.ts) in (select displayId, max(ts) from cfg group by 1)),
 c as (select distinct cast(o_custkey as varchar) as displayId, o_custkey // 2 as companyId from orders)
 select distinct u.displayId, c.companyId, u.os from u join c on c.displayId = u.displayId where u.pn = '{PACKAGED}' and u.os not like '{OTHER_OS}')"""


@query("R59c_unsupported_counts_of_both_sources", f"""
select n.c_name as companyName, u.companyId, u.os, count(distinct u.displayId) as unsupportedDisplayCount
from {_UNSUPPORTED_SQL} u left join customer n on n.c_custkey = u.companyId group by 1, 2, 3""")
def r59c(spark: SS, d: str) -> DataFrame:
    """Displays on the packaged player per company and system, other than the excluded system."""
    g = _unsupported_rows(spark, d).groupBy("companyId", "os").agg(F.count_distinct("displayId").alias("unsupportedDisplayCount"))
    n = tbl(spark, d, "customer", F.col("c_custkey").alias("companyId"), F.col("c_name").alias("companyName"))
    return g.join(n, "companyId", "left").select("companyName", "companyId", "os", "unsupportedDisplayCount").orderBy(
        F.col("unsupportedDisplayCount").desc(), "companyId", "os")


# ------------------------------------------------------------------ R82: worst performers with their configuration
@query("R82b_worst_performers_with_versions", f"""
with cfg as (select user_id, ts, 'os ' || cast(k % 4 as varchar) as os_description, 'player-' || cast(k % 3 as varchar) as player_name,
 cast(k // 10 as varchar) as installer_version, cast(k as varchar) as player_version from {q(None, AS_OF)} where event_type = 'view')
select u.user_id as display_id, u.uptime_pct, c.os_description, c.player_name, c.installer_version, c.player_version
from {DISPLAY_UPTIME_SQL} u left join (select distinct user_id, os_description, player_name, installer_version, player_version from cfg
 where (user_id, ts) in (select user_id, max(ts) from cfg group by 1)) c on c.user_id = u.user_id where u.date = date '{YESTERDAY}'""")
def r82b(spark: SS, d: str) -> DataFrame:
    """Yesterday's uptime of every display with system, player and versions of its latest configuration, least first."""
    u = _display_uptime(ev(spark, d)).where(F.col("date") == F.lit(YESTERDAY))
    e = cat.read_events(ev(spark, d), None, YESTERDAY).where(F.col("event_type") == "view").withColumn("k", k_col())
    c = latest_by(e.select("user_id", "ts", "k"), "user_id", "ts", ties="keep").select(
        F.col("user_id").alias("of"), F.concat(F.lit("os "), (F.col("k") % 4).cast("string")).alias("os_description"),
        F.concat(F.lit("player-"), (F.col("k") % 3).cast("string")).alias("player_name"),
        F.expr("cast(k div 10 as string)").alias("installer_version"), F.col("k").cast("string").alias("player_version")).distinct()
    return u.join(c, F.col("user_id") == F.col("of"), "left").select(
        F.col("user_id").alias("display_id"), "uptime_pct", "os_description", "player_name", "installer_version", "player_version"
    ).orderBy("uptime_pct", "display_id")


# ------------------------------------------------------------------ R84: white screens caused by gaps in widget schedules
@query("R84b_white_screens_by_widget_gaps", f"""
with {_items_sql()}, g as (select cast(presentationId as varchar) as presentationId from gaps),
pd as (select distinct s.presentationId, unnest(s.distribution) as displayId from {SCHED_SQL} s where s.distributeToAll = false and len(s.distribution) > 0
 union select distinct s.presentationId, c.c_custkey from {SCHED_SQL} s join customer c on c.c_nationkey = s.companyId where s.distributeToAll),
shown as (select distinct pd.displayId, pd.presentationId from pd join g on g.presentationId = pd.presentationId),
t as (select user_id, count(ts) as incidentCount from {UPTIME_WS_SQL} where showingContent = 1 and connectedToMS = 1 and whitescreenDetected = 1
 and user_id in (select displayId from shown) group by 1)
select distinct lpad(cast(day(date '{AS_OF}') as varchar), 2, ' ') || strftime(date '{AS_OF}', '-%b-%Y') as date, 'Open' as status, c.c_name as "companyName",
 c.c_custkey as "companyId", t.user_id as "displayId", 'presentation ' || s.presentationId as "presentationName", 'Proactive Support' as request,
 'White screen appeared ' || cast(t.incidentCount as varchar) || ' times in the last 7 days due to gaps in widget schedule. Content and schedule should be reviewed.' as summary,
 t.incidentCount as "incidentCount"
from t join customer c on c.c_custkey = t.user_id join shown s on s.displayId = t.user_id where c.c_mktsegment = '{SEGMENT}' and c.c_acctbal >= 0""")
def r84b(spark: SS, d: str) -> DataFrame:
    """Segment displays with white screens whose presentations have gaps in their widget schedules, with a line for
    support per display and presentation.

    Company-wide presentations meet the displays that had an incident, never all displays of a company.
    """
    bad = content_gaps(widget_coverage(presentations(spark, d), SCHEDULE_DAY)).select(F.col("presentationId").cast("string").alias("presentationId"))
    on = r108(spark, d, bad)
    u = uptime_samples(ev(spark, d)).where("showingContent = 1 and connectedToMS = 1 and whitescreenDetected = 1")
    seg = segment(spark, d).where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("user_id"), "c_name", F.col("c_nationkey").cast("long").alias("of"))
    hit = u.groupBy("user_id").agg(F.sum("w").alias("incidentCount")).join(seg, "user_id")
    own = hit.join(on.where(F.col("displayId").isNotNull()).select(F.col("displayId").alias("user_id"), "presentationId"), "user_id")
    wide = hit.join(on.where(F.col("companyId").isNotNull()).select(F.col("companyId").alias("of"), "presentationId"), "of")
    day = F.lit(AS_OF)
    cols = [F.concat(TU.day_space_padded(day), F.date_format(day, "-MMM-yyyy")).alias("date"), F.lit("Open").alias("status"),
            F.col("c_name").alias("companyName"), F.col("user_id").alias("companyId"), F.col("user_id").alias("displayId"),
            F.concat(F.lit("presentation "), "presentationId").alias("presentationName"), F.lit("Proactive Support").alias("request"),
            F.concat(F.lit("White screen appeared "), F.col("incidentCount").cast("string"),
                     F.lit(" times in the last 7 days due to gaps in widget schedule. Content and schedule should be reviewed.")).alias("summary"),
            "incidentCount"]
    return own.select(*cols).union(wide.select(*cols)).distinct()
