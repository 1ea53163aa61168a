"""Report families as rule tables (R20/R21 widget kinds, R24 error lists, R25, R36) and merged display records.

Bindings.  A widget's configuration is the release number modulo 11 (``KINDS``): 'view' rows report it,
'error' rows and, for videos, short 'click' rows are its failures.  Deprecated items are the release numbers
up to 40.  Display records: request log = 'click' events with a URL put together from the event, viewer
log = 'view' events, configurations = 'signup' events, channel log = a text line per 'error' event.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import joins as J
from fleetlens.operators.latest import latest_by
from fleetlens.operators.rules import Rule, daily_rule_counts, matched, matrix
from fleetlens.plans.dataflow import BETA_LIKE
from fleetlens.plans.registry import query
from fleetlens.plans.reports import W3_START, ev, k_col, q
from fleetlens.plans.rollups import rollup
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl
from fleetlens.sources import catalog as cat

SS = SparkSession
STABLE_SQL = f"(props not like '{BETA_LIKE}' and event_type in ('signup', 'purchase', 'view', 'click'))"


def _kind(i: int, name: str, *, video: bool = False, excluded: str = "") -> Rule:
    error = f"event_type = 'error' and k % 11 = {i}" + (f" and not ({excluded})" if excluded else "")
    return Rule(name, f"event_type = 'view' and k % 11 = {i}",
                (error, f"event_type = 'click' and value < 20 and k % 11 = {i}") if video else (error,))


#: Four widget kinds with one failure branch, three with two.
WIDGETS = [_kind(0, "calendar"), _kind(1, "image_file", excluded="value < 10"), _kind(2, "image_folder"),
           _kind(3, "image_other", excluded="value > 95"), _kind(4, "video_file", video=True),
           _kind(5, "video_folder", video=True), _kind(6, "video_other", video=True)]
#: The eleven error lists of R24: the widgets' and four further components'.
LISTS = [*WIDGETS, _kind(7, "rss"), _kind(8, "spreadsheet"), _kind(9, "text"), _kind(10, "social")]


def _events(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    return cat.read_events(ev(spark, d), first, last).withColumn("k", k_col())


def _kinds_sql(d0: dt.date | None, d1: dt.date) -> str:
    w = f"(select * from {q(d0, d1)} where user_id is not null)"
    stable = f"(select user_id from {w} where {STABLE_SQL})"
    parts = []
    for r in WIDGETS:
        used = f"(select distinct user_id, date from {w} where {r.used} and user_id in {stable})"
        bad = f"(select distinct user_id, date from {w} where {r.failure()})"
        parts.append(f"select '{r.name}' as kind, u.date, count(*) as total_count, count(b.user_id) as failed_count "
                     f"from {used} u left join {bad} b on b.user_id = u.user_id and b.date = u.date group by 2")
    return "(" + " union all ".join(parts) + ")"


@rollup("R20b_widget_kinds", f"""
select * from {_kinds_sql(W3_START, AS_OF)} union all select * from {_kinds_sql(None, W3_START)} where date < date '{W3_START}'""", start=W3_START)
def r20b(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Configured and failing displays per widget kind and day, of stable displays: seven kinds in one scan."""
    return daily_rule_counts(_events(spark, d, first, last), WIDGETS, "user_id", eligible=F.expr(STABLE_SQL))


def _lists_sql() -> str:
    w = f"(select * from {q(YESTERDAY, AS_OF)} where user_id in (select user_id from {q(YESTERDAY, AS_OF)} where {STABLE_SQL}))"
    return " union all ".join(
        f"select '{r.name}' as list, substr(props, 1, 200) as details, event_type as event, count(distinct user_id) as display_count from {w} "
        f"where ({r.failure()}) and user_id in (select user_id from {w} where {r.used}) group by 2, 3" for r in LISTS)


@query("R24b_error_lists", _lists_sql())
def r24b(spark: SS, d: str) -> DataFrame:
    """Yesterday's errors of each list on stable displays that were configured for it: eleven lists in one scan."""
    w = _events(spark, d, YESTERDAY, YESTERDAY)
    w = J.semi(w, w.where(F.expr(STABLE_SQL)).select("user_id"), "user_id")
    bad = matched(w, LISTS, "list", "failed")
    used = matched(w, LISTS, "list").select("user_id", "list").distinct()
    return (J.semi(bad, used, ["user_id", "list"])
            .groupBy("list", F.substring("props", 1, 200).alias("details"), F.col("event_type").alias("event"))
            .agg(F.count_distinct("user_id").alias("display_count")))


@query("R25b_unsupported_media", f"""
select distinct user_id as display_id, props as file_url from {q(YESTERDAY, AS_OF)} where event_type = 'error' and k % 11 in (4, 5) and value > 20""")
def r25b(spark: SS, d: str) -> DataFrame:
    """Displays and files of stored videos that yesterday could not be played."""
    w = _events(spark, d, YESTERDAY, YESTERDAY).where("event_type = 'error' and k % 11 in (4, 5) and value > 20")
    return w.select(F.col("user_id").alias("display_id"), F.col("props").alias("file_url")).distinct()


DEPRECATED = [Rule(f"item_{n:02d}", f"k = {n}") for n in range(41)]


@query("R36b_deprecated_items", f"""
with x as (select user_id as display_id, {', '.join(f"max(case when {r.used} then '{r.name}' end) as {r.name}" for r in DEPRECATED)},
 count(distinct k) as items from {q(YESTERDAY, AS_OF)} where k between 0 and 40 and user_id is not null group by 1)
select x.display_id, c.c_nationkey as company_id, x.* exclude (display_id) from x left join customer c on c.c_custkey = x.display_id""")
def r36b(spark: SS, d: str) -> DataFrame:
    """Displays that showed deprecated items yesterday, a column for each of 41 items, most items first."""
    w = _events(spark, d, YESTERDAY, YESTERDAY).where(F.col("k").between(0, 40) & F.col("user_id").isNotNull())
    m = matrix(w.withColumnRenamed("user_id", "display_id"), DEPRECATED, "display_id")
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey")
    return (m.join(c, m.display_id == c.c_custkey, "left")
            .select("display_id", F.col("c_nationkey").alias("company_id"), *[r.name for r in DEPRECATED], "items")
            .orderBy(F.col("items").desc(), "display_id"))


# ------------------------------------------------------------------ R52: merged display records
_RESOURCE = ("'/v2/viewer/display/' || cast(user_id as varchar) || '?sig=' || cast(k as varchar)"
             " || case when k % 5 = 0 then '' else '&os=' || case k % 3 when 0 then 'win:10' when 1 then 'linux' else 'cros-1' end end"
             " || case when k % 7 = 0 then '' else '&pn=player-' || cast(k % 2 as varchar) end || '&pv=' || cast(k // 25 as varchar) || '&x=1'")
_LINE = "case when k % 2 = 0 then 'Display: ' || cast(user_id as varchar) || ' (channelId: 7)' else 'no display' end"
INFO = ["displayId", "connectionTime", "companyId", "os", "pn", "pv", "offline_subscription", "useChannel"]


def _param(url: Column, name: str, signs: str) -> Column:
    return C.regexp_extract_or_null(url, rf"/v2/viewer/display/[A-Za-z0-9-]+\?sig.*&{name}=([{signs}]+)")


def merge_displays(requests: DataFrame, viewers: DataFrame, configurations: DataFrame) -> DataFrame:
    """displayId, date, os, pn, pv, offline_subscription of both sources, one row per distinct record and day.

    ``requests``: resource, date (the display and its parameters stand in the URL); ``viewers``: displayId,
    date; ``configurations``: displayId, ts and the fields, of which the latest of each display counts
    (all of them at its latest time).  Records without os, pn or pv are left out.
    """
    url = F.col("resource")
    asked = requests.select(C.regexp_extract_or_null(url, r"/v2/viewer/display/([A-Za-z0-9-]+)").alias("displayId"), "date",
                            _param(url, "os", "A-Za-z0-9:-").alias("os"), _param(url, "pn", "A-Za-z0-9-").alias("pn"),
                            _param(url, "pv", "A-Za-z0-9-").alias("pv"), F.lit(None).cast("boolean").alias("offline_subscription"))
    latest = latest_by(configurations, "displayId", "ts", ties="keep").drop("ts")
    seen = viewers.select("displayId", "date").distinct().join(latest, "displayId")
    both = asked.unionByName(seen.select("displayId", "date", "os", "pn", "pv", "offline_subscription"))
    return both.where(F.col("os").isNotNull() & F.col("pn").isNotNull() & F.col("pv").isNotNull()).distinct()


def _info_sql(d0: dt.date | None, d1: dt.date) -> str:
    part = lambda n, s: (f"case when regexp_matches(resource, '/v2/viewer/display/[A-Za-z0-9-]+\\?sig.*&{n}=([{s}]+)') then "  # noqa: E731
                         f"regexp_extract(resource, '/v2/viewer/display/[A-Za-z0-9-]+\\?sig.*&{n}=([{s}]+)', 1) end")
    return f"""(with w as (select * from {q(d0, d1)}), cfg as (select cast(user_id as varchar) as displayId, ts, 'os ' || cast(k % 4 as varchar) as os,
  'player-c' as pn, cast(k as varchar) as pv, value > 50 as offline_subscription from {q(None, AS_OF)} where event_type = 'signup' and user_id is not null),
 last as (select * from cfg where (displayId, ts) in (select displayId, max(ts) from cfg group by 1)),
 req as (select {_RESOURCE} as resource, date from w where event_type = 'click'),
 dr as (select regexp_extract(resource, '/v2/viewer/display/([A-Za-z0-9-]+)', 1) as displayId, date, {part('os', 'A-Za-z0-9:-')} as os,
  {part('pn', 'A-Za-z0-9-')} as pn, {part('pv', 'A-Za-z0-9-')} as pv, null::boolean as offline_subscription from req where resource is not null
  union select v.displayId, v.date, c.os, c.pn, c.pv, c.offline_subscription
  from (select distinct cast(user_id as varchar) as displayId, date from w where event_type = 'view') v join last c on c.displayId = v.displayId),
 dc as (select distinct date, nullif(regexp_extract({_LINE}, 'Display: ([A-Za-z0-9:-]+) \\(channelId:', 1), '') as displayId from w where event_type = 'error'),
 d1 as (select distinct cast(o_custkey as varchar) as displayId, o_custkey // 2 as companyId from orders where o_orderpriority <> '5-LOW'),
 c1 as (select max(o_orderkey) as id, o_custkey as companyId from orders where o_orderpriority <> '5-LOW' group by 2),
 c2 as (select o_orderkey as id from orders where o_orderpriority <> '5-LOW' and o_orderstatus <> 'P')
 select distinct dr.displayId, dr.date as connectionTime, c1.companyId, dr.os, dr.pn, dr.pv, dr.offline_subscription, dc.displayId is not null as useChannel
 from dr join d1 on d1.displayId = dr.displayId join c1 on c1.companyId = d1.companyId join c2 on c2.id = c1.id
 left join dc on dc.displayId = dr.displayId and dc.date = dr.date where dr.os is not null and dr.pn is not null and dr.pv is not null)"""


@rollup("R52b_display_records", f"""
select * from {_info_sql(YESTERDAY, AS_OF)} union all select * from {_info_sql(None, YESTERDAY)} where connectionTime < date '{YESTERDAY}'""",
        start=YESTERDAY, date_col="connectionTime")
def r52b(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Display records of the request log's parameters and of viewers with their latest configuration, for production
    displays of live companies, with the use of channels; yesterday's spliced over the stored ones."""
    w = _events(spark, d, first, last)
    text = lambda s: F.expr(s.replace("varchar", "string").replace("k // 25", "k div 25"))
    display = F.col("user_id").cast("string").alias("displayId")
    config = _events(spark, d, None, YESTERDAY).where("event_type = 'signup' and user_id is not null").select(
        display, "ts", F.concat(F.lit("os "), (F.col("k") % 4).cast("string")).alias("os"), F.lit("player-c").alias("pn"),
        F.col("k").cast("string").alias("pv"), (F.col("value") > 50).alias("offline_subscription"))
    rows = merge_displays(w.where("event_type = 'click'").select(text(_RESOURCE).alias("resource"), "date"),
                          w.where("event_type = 'view'").select(display, "date"), config)
    channels = w.where("event_type = 'error'").select(
        C.regexp_extract_or_null(text(_LINE), r"Display: ([A-Za-z0-9:-]+) \(channelId:").alias("displayId"), "date",
        F.lit(True).alias("channel")).where(F.col("displayId").isNotNull() & (F.col("displayId") != "")).distinct()
    o = tbl(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus").where(F.col("o_orderpriority") != "5-LOW")
    displays = o.select(F.col("o_custkey").cast("string").alias("displayId"), F.expr("o_custkey div 2").alias("companyId")).distinct()
    live = latest_by(o, "o_custkey", "o_orderkey", ties="one").where(F.col("o_orderstatus") != "P").select(F.col("o_custkey").alias("companyId"))
    out = J.semi(rows.join(displays, "displayId"), live, "companyId").join(channels, ["displayId", "date"], "left")
    return out.select("displayId", F.col("date").alias("connectionTime"), "companyId", "os", "pn", "pv", "offline_subscription",
                      F.coalesce("channel", F.lit(False)).alias("useChannel"))
