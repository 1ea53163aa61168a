"""Daily cost by endpoint, with bytes attributed by the keys in request URLs (R88), and the storage splits (R112).

Binding of the download log: one request per page, bytes = length of its HTML; request URL and
referer are put together from the page so that each of the reference's six ways to name an
endpoint occurs: own parameters, a display's viewer page as the encoded parent of the request or
of its referer, a shared schedule's in the same two places, and signed URLs.  Cost pools as in R88:
downloads = purchase values, stream inserts = 0.01 per sign-up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators.dimensions import ATTACHED, EndpointDimensions
from fleetlens.operators.latest import latest_by
from fleetlens.plans.endpoints import (COMPANY_JOINS_SQL, DIM_COLS_SQL, DIM_JOINS_SQL, DIMS_SQL, WITH_COMPANY_SQL, dimensions,
                                       endpoint_log, log_sql)
from fleetlens.plans.registry import query
from fleetlens.plans.reports import D, ev, q
from fleetlens.plans.reports_companies import NOW_90, STORAGE_SQL, _since, storage_log
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl
from fleetlens.functions import timeutil as TU
from fleetlens.sources import catalog as cat

SS = SparkSession
r6 = C.r
#: Hosts (with path) of the viewer pages, as they stand in a request's parent.
VIEWER_HOSTS = ("://viewer.example.com", "://widgets.example.com/viewer")
KEYS = ["endpointId", "endpointType", "scheduleId"]

_ID = "cast(page_id % 150 as varchar)"
_PARENT = "'https%3A%2F%2Fviewer.example.com%2F%3Ftype%3D{kind}%26id%3D' || {id}"
_URI_SQL = f"""case page_id % 7
 when 0 then 'https://storage.example.com/o?a=1&endpointId=' || {_ID} || '&endpointType=' || case when page_id % 2 = 0 then 'Display' else 'SharedSchedule' end
  || '&scheduleId=' || cast((page_id % 150) * 7 % 150 as varchar) || '#f'
 when 1 then 'https://storage.example.com/o?parent=' || {_PARENT.format(kind='display', id=_ID)} || '&x=1'
 when 3 then 'https://storage.example.com/o?viewerId=' || {_ID} || '&env=' || case page_id % 4 when 0 then 'Embed' when 1 then 'extension'
  when 2 then 'apps_store' else 'none' end || '&parent=' || {_PARENT.format(kind='sharedschedule', id=_ID)}
 when 5 then 'https://storage.example.com/o?displayId=' || {_ID} || '&GoogleAccessId=a&Signature=b&Expires=1'
 else url end"""
_REFERER_SQL = f"""case page_id % 7
 when 2 then 'https://pages.example.com/?parent=' || {_PARENT.format(kind='display', id=_ID)}
 when 4 then 'https://pages.example.com/?viewerId=' || {_ID} || '&viewerEnv=APPS_x&parent=' || {_PARENT.format(kind='sharedschedule', id=_ID)}
 when 5 then 'https://pages.example.com/?parent=' || {_PARENT.format(kind='display', id=_ID)}
 else url end"""
LOG_SQL = f"(select {_URI_SQL} as cs_uri, {_REFERER_SQL} as cs_referer, length(html) as sc_bytes from pages)"


def download_log(spark: SS, d: str) -> DataFrame:
    p = tbl(spark, d, "pages", "page_id", "url", "html")
    text = lambda s: F.expr(s.replace("varchar", "string"))
    return p.select(text(_URI_SQL).alias("cs_uri"), text(_REFERER_SQL).alias("cs_referer"), F.length("html").cast("long").alias("sc_bytes"))


def _part(url: Column, name: str) -> Column:
    """What follows ``name=`` up to the next parameter or fragment; NULL without it."""
    return C.regexp_extract_or_null(url, rf"{name}=([^?&#]*)")


def attributed(log: DataFrame) -> DataFrame:
    """Log rows once for each source that names their endpoint: source, endpointId, endpointType, scheduleId, sc_bytes.

    Sources: ``own`` parameters; ``display`` and ``schedule`` by the parent of the request,
    ``display_referer`` and ``schedule_referer`` by that of the referer; ``signed`` URLs.
    """
    uri, ref = F.col("cs_uri"), F.col("cs_referer")

    def on_viewer(url: Column) -> Column:
        plain = C.url_decode(url)
        hit = F.lit(False)
        for host in VIEWER_HOSTS:
            hit = hit | plain.contains(host)
        return hit & ~plain.contains("ype=sharedschedule")

    def parent_id(url: Column) -> Column:
        return _part(C.url_decode(_part(url, "parent")), "id")

    def kind(url: Column) -> Column:
        env, viewer = F.lower(_part(url, "env")), F.lower(_part(url, "viewerEnv"))
        return (F.when((env == "embed") | (viewer == "embed"), "Embed").when((env == "extension") | (viewer == "extension"), "Extension")
                .when(env.contains("apps_") | viewer.contains("apps_"), "InApp").otherwise("URL"))

    def source(name: str, cond: Column, endpoint: Column, kind_: Column, schedule: Column) -> Column:
        return F.when(cond, F.struct(F.lit(name).alias("source"), endpoint.alias("endpointId"), kind_.alias("endpointType"),
                                     schedule.alias("scheduleId")))

    display, none = F.lit("Display"), F.lit("")
    has = lambda name: uri.contains(f"{name}=")
    found = F.array(
        source("own", has("endpointId") & has("endpointType") & has("scheduleId"), _part(uri, "endpointId"), _part(uri, "endpointType"),
               _part(uri, "scheduleId")),
        source("display", on_viewer(uri), parent_id(uri), display, none),
        source("display_referer", on_viewer(ref), parent_id(ref), display, none),
        source("schedule", C.url_decode(uri).contains("ype=sharedschedule"), _part(uri, "viewerId"), kind(uri), parent_id(uri)),
        source("schedule_referer", C.url_decode(ref).contains("ype=sharedschedule"), _part(ref, "viewerId"), kind(ref), parent_id(ref)),
        source("signed", has("GoogleAccessId") & has("Signature") & has("Expires"), _part(uri, "displayId"), display, none))
    hits = F.filter(found, lambda x: x.isNotNull())
    return log.select("sc_bytes", F.explode(hits).alias("hit")).select("hit.*", "sc_bytes")


def endpoint_costs(log: DataFrame, downloads: DataFrame, pools: DataFrame) -> DataFrame:
    """endpointId (text), endpointType, scheduleId (text), direct, legacy, indirect: costs of every key that is
    downloaded to, logged or heard from; legacy once for each distinct older attribution of the endpoint.

    ``log``: endpoint log rows; ``pools``: one row totalDownloadCost, totalStreamInsertCost.
    Keys that hold a NULL match nothing and cost nothing, as plain equality has it.
    """
    by_source = attributed(downloads).groupBy("source", *KEYS).agg(F.sum("sc_bytes").alias("bytes"))
    own = F.col("source") == "own"
    beat = F.col("event_type").isin("view", "click")
    inserts = log.groupBy(F.col("endpointId").cast("string").alias("endpointId"), "endpointType",
                          F.col("scheduleId").cast("string").alias("scheduleId")).agg(
        (F.count(F.lit(1)) + F.count_if(beat)).alias("inserts"))
    # downloads, log inserts and heartbeat inserts aligned on the three keys by one aggregation
    nothing = F.lit(None).cast("long")
    keyed = (by_source.where(own).select(*KEYS, "bytes", nothing.alias("inserts"))
             .unionByName(inserts.select(*KEYS, nothing.alias("bytes"), "inserts"))
             .groupBy(*KEYS).agg(F.sum("bytes").alias("bytes"), F.sum("inserts").alias("inserts")))
    whole = F.lit(True)
    for k in KEYS:
        whole = whole & F.col(k).isNotNull()
    legacy = (by_source.where(~own).select(F.col("endpointId").alias("of"), "endpointType", "scheduleId", "bytes").distinct()
              .select("of", F.col("bytes").alias("legacyBytes")))
    totals = (downloads.agg(F.sum("sc_bytes").alias("totalDownloaded"))
              .crossJoin(log.agg((F.count(F.lit(1)) + F.count_if(beat)).alias("totalInserts"))).crossJoin(pools))  # one row
    x = keyed.join(legacy, F.col("endpointId") == F.col("of"), "left").crossJoin(F.broadcast(totals))

    def share(units: Column, cost: str, total: str) -> Column:
        return F.coalesce(F.try_divide(units.cast("double") * F.col(cost).cast("double"), F.col(total).cast("double")), F.lit(0.0))
    return x.select(*KEYS, share(F.when(whole, F.col("bytes")), "totalDownloadCost", "totalDownloaded").alias("direct"),
                    share(F.col("legacyBytes"), "totalDownloadCost", "totalDownloaded").alias("legacy"),
                    share(F.coalesce(F.when(whole, F.col("inserts")), F.lit(0)), "totalStreamInsertCost", "totalInserts").alias("indirect"))


def cost_pools(spark: SS, d: str) -> DataFrame:
    day = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY)
    return day.agg(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("totalDownloadCost"),
                   (F.count_if(F.col("event_type") == "signup") * F.lit(0.01)).alias("totalStreamInsertCost"))


def daily_costs(spark: SS, d: str, dims: EndpointDimensions | None = None) -> DataFrame:
    log = endpoint_log(cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY))
    costs = endpoint_costs(log, download_log(spark, d), cost_pools(spark, d)).select(
        F.lit(YESTERDAY).alias("date"), F.col("endpointId").try_cast("long").alias("endpointId"), "endpointType",
        F.col("scheduleId").try_cast("long").alias("scheduleId"), "direct", "legacy", "indirect")
    beats = log.where(F.col("event_type").isin("view", "click"))
    last = latest_by(beats, "endpointId", "ts", ties="keep").where(F.col("event_type") == "view").select(
        "endpointId", "browserVersion", "osVersion", F.col("eventAppVersion").alias("viewerVersion")).distinct()
    rows = costs.join(last, "endpointId", "left")
    return (dims or dimensions(spark, d)).attach(rows).select(
        "date", *KEYS, "browserVersion", "osVersion", "viewerVersion", *ATTACHED,
        r6(F.col("direct") + F.col("legacy")).alias("dailyDirectCost"), r6("indirect").alias("dailyIndirectCost"))


def _p(url: str, name: str) -> str:
    return f"case when regexp_matches({url}, '{name}=([^?&#]*)') then regexp_extract({url}, '{name}=([^?&#]*)', 1) end"


def _viewer(url: str) -> str:
    hosts = " or ".join(f"contains(url_decode({url}), '{h}')" for h in VIEWER_HOSTS)
    return f"({hosts}) and not contains(url_decode({url}), 'ype=sharedschedule')"


def _parent(url: str) -> str:
    return _p(f"url_decode({_p(url, 'parent')})", "id")


def _kind(url: str) -> str:
    e, v = f"lower({_p(url, 'env')})", f"lower({_p(url, 'viewerEnv')})"
    return (f"case when {e} = 'embed' or {v} = 'embed' then 'Embed' when {e} = 'extension' or {v} = 'extension' then 'Extension' "
            f"when contains({e}, 'apps_') or contains({v}, 'apps_') then 'InApp' else 'URL' end")


def _legacy(where: str, endpoint: str, kind: str = "'Display'", schedule: str = "''") -> str:
    return f"select {endpoint} as e, {kind} as t, {schedule} as s, sum(sc_bytes) as bytes from dl where {where} group by 1, 2, 3"


@query("R88b_daily_cost_full", f"""
with {DIMS_SQL}, dl as (select * from {LOG_SQL}), log as (select * from {log_sql(YESTERDAY, AS_OF)}),
own as (select {_p('cs_uri', 'endpointId')} as e, {_p('cs_uri', 'endpointType')} as t, {_p('cs_uri', 'scheduleId')} as s, sum(sc_bytes) as bytes
 from dl where contains(cs_uri, 'endpointId=') and contains(cs_uri, 'endpointType=') and contains(cs_uri, 'scheduleId=') group by 1, 2, 3),
li as (select cast(endpointId as varchar) as e, endpointType as t, cast(scheduleId as varchar) as s, count(*) as n from log group by 1, 2, 3),
hi as (select cast(endpointId as varchar) as e, endpointType as t, cast(scheduleId as varchar) as s, count(*) as n from log
 where event_type in ('view', 'click') group by 1, 2, 3),
keys as (select e, t, s from own union select e, t, s from li union select e, t, s from hi),
legacy as ({_legacy(_viewer('cs_uri'), _parent('cs_uri'))} union {_legacy(_viewer('cs_referer'), _parent('cs_referer'))}
 union {_legacy("contains(url_decode(cs_uri), 'ype=sharedschedule')", _p('cs_uri', 'viewerId'), _kind('cs_uri'), _parent('cs_uri'))}
 union {_legacy("contains(url_decode(cs_referer), 'ype=sharedschedule')", _p('cs_referer', 'viewerId'), _kind('cs_referer'), _parent('cs_referer'))}
 union {_legacy("contains(cs_uri, 'GoogleAccessId=') and contains(cs_uri, 'Signature=') and contains(cs_uri, 'Expires=')", _p('cs_uri', 'displayId'))}),
pool as (select sum(value) filter (where event_type = 'purchase') as dc, count(*) filter (where event_type = 'signup') * 0.01::double as ic from {q(YESTERDAY, AS_OF)}),
tot as (select (select sum(sc_bytes) from dl) as tb, (select count(*) from log) + (select count(*) from log where event_type in ('view', 'click')) as ti),
det as (select distinct endpointId, browserVersion, osVersion, eventAppVersion as viewerVersion from log where event_type = 'view' and
 (endpointId, ts) in (select endpointId, max(ts) from log where event_type in ('view', 'click') group by 1)),
co as (select try_cast(k.e as bigint) as endpointId, k.t as endpointType, try_cast(k.s as bigint) as scheduleId,
 coalesce(o.bytes::double * dc::double / tb::double, 0) + coalesce(l.bytes::double * dc::double / tb::double, 0) as direct,
 coalesce((coalesce(li.n, 0) + coalesce(hi.n, 0))::double * ic / ti::double, 0) as indirect
 from keys k cross join tot cross join pool left join own o on o.e = k.e and o.t = k.t and o.s = k.s left join legacy l on l.e = k.e
 left join li on li.e = k.e and li.t = k.t and li.s = k.s left join hi on hi.e = k.e and hi.t = k.t and hi.s = k.s),
x as (select x.*, {WITH_COMPANY_SQL} from co x {COMPANY_JOINS_SQL})
select date '{YESTERDAY}' as date, x.endpointId, x.endpointType, x.scheduleId, det.browserVersion, det.osVersion, det.viewerVersion, {DIM_COLS_SQL},
 round(x.direct, 6) as dailyDirectCost, round(x.indirect, 6) as dailyIndirectCost
from x left join det on det.endpointId = x.endpointId {DIM_JOINS_SQL}""")
def r88b(spark: SS, d: str) -> DataFrame:
    """Yesterday's direct and indirect cost per endpoint, type and schedule, with versions and dimensions."""
    return daily_costs(spark, d)


@query("R112d_client_storage", f"""
select cast(make_timestamp(time_micros) as date) as date, cast(sum(sc_bytes) as bigint) as bandwidth
from {STORAGE_SQL} where time_micros > epoch_us(timestamp '{NOW_90}') and ts < timestamp '{AS_OF + D(days=1)}'
 and cs_bucket <> 'install-versions' group by 1""")
def r112d(spark: SS, d: str) -> DataFrame:
    """Bytes a day that clients took: every bucket but the installers'."""
    log = _since(cat.read_events(storage_log(spark, d), None, AS_OF), NOW_90).where(F.col("cs_bucket") != "install-versions")
    return log.groupBy(F.to_date(TU.from_epoch_micros("time_micros")).alias("date")).agg(F.sum("sc_bytes").cast("long").alias("bandwidth"))
