"""Report jobs: module reliability (R70-R79), uptime and endpoint summaries.

Bindings as in ``reports.py``; additionally: uptime samples = 'view' and
'click' events (showing = value > 20, connected = value < 95, scheduled =
k < 80); white screen = an 'error' of the same device within the lookback
window (6 h instead of 5 min so matches exist); heartbeats = all events;
release line = k div 10.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions import columns as C
from fleetlens.functions import timeutil as TU
from fleetlens.operators import joins as J
from fleetlens.operators.reliability import daily_reliability, distinct_counts, interval_uptime
from fleetlens.plans.dataflow import BETA_LIKE, ENRICHED_SQL, _enriched
from fleetlens.plans.registry import query
from fleetlens.plans.rollups import rollup
from fleetlens.plans.reports import W3_START, W5_START, W7_START, ev, k_col, q
from fleetlens.plans.reports_devices import OS_SQL, os_of
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl
from fleetlens.sources import catalog as cat

SS = SparkSession
r6 = C.r
D = dt.timedelta
LOOKBACK_S = 6 * 3600
HEARTBEATS_PER_DAY = K.HEARTBEATS_PER_DAY


# =========================================================== R70-R79 module reliability
def deletion_log(e: DataFrame) -> DataFrame:
    """Deleted entities with their kind (binding as J22: yesterday's signups)."""
    return (cat.read_events(e, YESTERDAY, YESTERDAY).where(F.col("event_type") == "signup")
            .select("user_id", F.when(F.col("value") > 50, "Display").otherwise("Company").alias("kind")).distinct())


def module_reliability(e: DataFrame, module: Column, failed_module: Column, watchdog_down: Column,
                       deleted: DataFrame | None = None) -> DataFrame:
    """Per date pct of the module's devices on its current release line without
    a failure.  Failures = module errors of devices not deleted as displays (J22
    left join on the deletion log) UNION watchdog module-down events naming the
    current version (not limited to the module's own device-days, as in the view)."""
    line = F.floor(k_col() / 10)
    m = e.where(module).withColumn("line", line)
    cur = m.agg(F.max("line").alias("__cur"))  # scalar subquery: one row
    onv = m.crossJoin(F.broadcast(cur)).where(F.col("line") == F.col("__cur"))
    errs = onv.where(failed_module)
    if deleted is not None:
        errs = errs.join(deleted, "user_id", "left").where(F.col("kind").isNull() | (F.col("kind") != "Display"))
    downs = e.where(watchdog_down).withColumn("line", line).crossJoin(F.broadcast(cur)) \
        .where(F.col("line") == F.col("__cur"))
    keys = ["user_id", "date"]
    rows = onv.select(*keys, F.lit(True).alias("t"), F.lit(False).alias("f")) \
        .unionByName(errs.select(*keys).union(downs.select(*keys)).select(*keys, F.lit(False).alias("t"),
                                                                          F.lit(True).alias("f")))
    return daily_reliability(rows, "user_id", F.col("f"), total=F.col("t"), total_name="devices", failed_name="failed")


MODULE_SQL = f"""(with w as (select * from {q(W5_START, AS_OF)}),
 m as (select *, k // 10 as line from w where event_type = 'purchase'),
 cur as (select max(line) as v from m),
 onv as (select * from m where line = (select v from cur)),
 del as (select distinct user_id, case when value > 50 then 'Display' else 'Company' end as kind from events
  where event_type = 'signup' and cast(ts as date) = date '{YESTERDAY}'),
 errs as (select onv.date, onv.user_id from onv left join del on del.user_id = onv.user_id
  where (del.kind is null or del.kind <> 'Display') and onv.value < 5),
 downs as (select date, user_id from w where event_type = 'error' and value > 95 and k // 10 = (select v from cur)),
 bad as (select * from errs union select * from downs)
 select t.date, t.devices, coalesce(b.failed, 0) as failed, round((t.devices - coalesce(b.failed, 0)) / t.devices * 100, 6) as pct
 from (select date, count(distinct user_id) as devices from onv group by 1) t
 left join (select date, count(distinct user_id) as failed from bad group by 1) b on t.date = b.date)"""


@query("R70_module_reliability_current_version", f"select * from {MODULE_SQL}")
def r70(spark: SS, d: str) -> DataFrame:
    ev_all = ev(spark, d)
    e = cat.read_events(ev_all, W5_START, YESTERDAY)
    return module_reliability(e, F.col("event_type") == "purchase", F.col("value") < 5,
                              (F.col("event_type") == "error") & (F.col("value") > 95), deleted=deletion_log(ev_all))


VIEWER_CRASH_SQL = f"""(select t.date, round((t.n - coalesce(f.n, 0)) / t.n * 100, 6) as pct from
 (select date, count(distinct user_id) as n from {q(W5_START, AS_OF)} group by 1) t left join
 (select date, count(distinct user_id) as n from {q(W5_START, AS_OF)} where event_type = 'click' and value > 97 group by 1) f on t.date = f.date)"""


@query("R71b_viewer_crash_reliability", f"select * from {VIEWER_CRASH_SQL}")
def r71b(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), W5_START, YESTERDAY)
    return daily_reliability(e, "user_id", (F.col("event_type") == "click") & (F.col("value") > 97)).select("date", "pct")


@query("R72_module_reliability_dashboard", f"""
with c as (select t.date, round((t.n - coalesce(f.n, 0)) / t.n * 100, 6) as pct from
 (select date, count(distinct user_id) as n from {q(W5_START, AS_OF)} group by 1) t left join
 (select date, count(distinct user_id) as n from {q(W5_START, AS_OF)} where event_type = 'error' group by 1) f on t.date = f.date)
select c.date, c.pct as content, v.pct as viewer_crash, l.pct as licensing
from c left join {VIEWER_CRASH_SQL} v on v.date = c.date left join {MODULE_SQL} l on l.date = c.date""")
def r72(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), W5_START, YESTERDAY)
    # content and viewer-crash reliability share their device totals: one pass for both
    both = distinct_counts(e, "date", "user_id", {
        "n": F.lit(True), "content_bad": F.col("event_type") == "error",
        "crash_bad": (F.col("event_type") == "click") & (F.col("value") > 97)})
    both = both.select("date", r6(C.pct_ok("n", "content_bad")).alias("content"),
                       r6(C.pct_ok("n", "crash_bad")).alias("viewer_crash"))
    lic = module_reliability(e, F.col("event_type") == "purchase", F.col("value") < 5,
                             (F.col("event_type") == "error") & (F.col("value") > 95), deleted=deletion_log(ev(spark, d)))
    return both.join(lic.select("date", F.col("pct").alias("licensing")), "date", "left")


@query("R73_module_versions_from_manifest", f"""
select event_type as name, arg_max(k, (ts, event_id)) as version from {q()} group by 1""")
def r73(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("k", k_col())
    # the manifest: one row holding array<struct<name, version>> (bounded by the module count)
    latest = e.groupBy("event_type").agg(F.max_by("k", F.struct("ts", "event_id")).alias("version"))
    manifest = latest.agg(F.collect_list(F.struct(F.col("event_type").alias("name"), "version")).alias("modules"))
    return manifest.select(F.explode("modules").alias("m")).select("m.name", "m.version")


# Binding (R74): installer family = signup / purchase, player family = view / click
# (both non-beta), local-storage events = errors; an update event = value above 75.
UPDATE_SQL = "value > 75"


def _update_freq(w: DataFrame, *, displays: bool = False) -> DataFrame:
    """Content updates per display and day: update events of the two player families
    and of local storage (for displays seen by either family), over the displays
    seen by the families; days need both (inner join).  ``displays`` counts the
    distinct updated displays instead of the update events (second view)."""
    nonbeta = C.not_like("props", BETA_LIKE)
    ent = w.where(nonbeta & F.col("event_type").isin("signup", "purchase", "view", "click"))
    local = J.semi(w.where(F.col("event_type") == "error"), ent.select("user_id").distinct(), "user_id")
    upd = ent.select("date", "user_id", "value").unionByName(local.select("date", "user_id", "value")) \
        .where(F.expr(UPDATE_SQL))
    disp = ent.groupBy("date").agg(F.count_distinct("user_id").alias("display_count"))
    if displays:
        total = upd.groupBy("date").agg(F.count_distinct("user_id").alias("updated_count"))
        return total.join(disp, "date").select(
            "date", "updated_count", "display_count",
            r6(C.safe_ratio("updated_count", "display_count")).alias("displays_with_update_per_day"))
    total = upd.groupBy("date").agg(F.count(F.lit(1)).alias("total_updates"))
    j = total.join(disp, "date")
    return j.select("date", "total_updates", "display_count",
                    r6(C.safe_ratio("total_updates", "display_count")).alias("updates_per_display"))


UPD_SQL = lambda d0, d1: f"""(with w as (select * from {q(d0, d1)}),
 ent as (select * from w where props not like '{BETA_LIKE}' and event_type in ('signup', 'purchase', 'view', 'click')),
 local as (select * from w where event_type = 'error' and user_id in (select user_id from ent)),
 t as (select date, count(*) as total_updates from (select date, value from ent union all select date, value from local)
  where {UPDATE_SQL} group by 1),
 dsp as (select date, count(distinct user_id) as display_count from ent group by 1)
 select t.date, t.total_updates, dsp.display_count, round(t.total_updates / dsp.display_count, 6) as updates_per_display
 from t join dsp on t.date = dsp.date)"""  # noqa: E731


@rollup("R74_content_update_frequency", f"""
select * from {UPD_SQL(W3_START, AS_OF)} union all select * from {UPD_SQL(None, W3_START)} where date < date '{W3_START}'""", start=W3_START)
def r74(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    return _update_freq(cat.read_events(ev(spark, d), first, last))


UPD_DISPLAYS_SQL = lambda d0, d1: f"""(with w as (select * from {q(d0, d1)}),
 ent as (select * from w where props not like '{BETA_LIKE}' and event_type in ('signup', 'purchase', 'view', 'click')),
 local as (select * from w where event_type = 'error' and user_id in (select user_id from ent)),
 t as (select date, count(distinct user_id) as updated_count from (select date, user_id, value from ent
  union all select date, user_id, value from local) where {UPDATE_SQL} group by 1),
 dsp as (select date, count(distinct user_id) as display_count from ent group by 1)
 select t.date, t.updated_count, dsp.display_count, round(t.updated_count / dsp.display_count, 6) as displays_with_update_per_day
 from t join dsp on t.date = dsp.date)"""  # noqa: E731


@rollup("R74b_content_displays_with_update", f"""
select * from {UPD_DISPLAYS_SQL(W3_START, AS_OF)} union all select * from {UPD_DISPLAYS_SQL(None, W3_START)} where date < date '{W3_START}'""", start=W3_START)
def r74b(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    return _update_freq(cat.read_events(ev(spark, d), first, last), displays=True)


@query("R75_daily_monthly_active_ratio", f"""
with u as (select distinct e.date, c.c_nationkey as company from {q(None, AS_OF)} e join customer c on c.c_custkey = e.user_id
 where e.event_type = 'purchase'),
days as (select distinct date from u where date >= date '{W3_START}')
select days.date, count(distinct case when u.date = days.date then u.company end) as dau,
 count(distinct u.company) as mau, round(count(distinct case when u.date = days.date then u.company end) / count(distinct u.company), 6) as ratio
from days join u on u.date between days.date - interval 29 day and days.date group by 1""")
def r75(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), None, YESTERDAY).where(F.col("event_type") == "purchase")
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey")
    u = e.join(c, e.user_id == c.c_custkey).select("date", F.col("c_nationkey").alias("company")).distinct()
    # each (company, day) counts for the report days within 29 days after it; only the
    # report window's days are generated (fan-out <= window length, here 3)
    first = F.greatest(F.col("date"), F.lit(W3_START))
    last = F.least(F.date_add("date", 29), F.lit(YESTERDAY))
    reach = u.where(first <= last).select("company", "date", F.explode(F.sequence(first, last)).alias("rd"))
    days = u.where(F.col("date") >= F.lit(W3_START)).select(F.col("date").alias("rd")).distinct()
    x = reach.join(days, "rd")
    g = distinct_counts(x, "rd", "company", {"dau": F.col("date") == F.col("rd"), "mau": F.lit(True)})
    return g.select(F.col("rd").alias("date"), "dau", "mau", r6(C.safe_ratio("dau", "mau")).alias("ratio"))


def _metrics(e: DataFrame) -> DataFrame:
    """System metrics binding: cpu_usage = value / 100, memory_usage = k / 100 (fractions),
    free_disk = value * 1024 (MB); rows missing a metric are dropped as in the view."""
    m = e.withColumn("year", F.year("ts").cast("long")).withColumn("week", TU.legacy_week("ts")) \
        .withColumn("cpu_usage", F.col("value") / 100).withColumn("memory_usage", k_col() / 100) \
        .withColumn("free_disk", F.col("value") * 1024)
    return m.where(F.col("cpu_usage").isNotNull() & F.col("memory_usage").isNotNull() & F.col("free_disk").isNotNull())


def _metric_aggs() -> list[Column]:
    return [F.count_distinct("user_id").alias("count"), F.round(F.avg("cpu_usage") * 100).alias("avgCPUUsage"),
            F.round(F.avg("memory_usage") * 100).alias("avgMemUsage"), F.round(F.avg("free_disk") / 1024).alias("freeDiskGB")]


METRICS_SQL = ("count(distinct user_id) as count, round(avg(value / 100) * 100) as avgCPUUsage, "
               "round(avg(k / 100) * 100) as avgMemUsage, round(avg(value * 1024) / 1024) as freeDiskGB")
#: Rows without a metric are no measurement, as in the view.
METRIC_ROWS_SQL = f"(select * from {q(None, AS_OF)} where value is not null and k is not null)"
LWEEK_SQL = "(floor((dayofyear(ts) + dayofweek(date_trunc('year', ts)) + 1 - 2) / 7) + 1)::bigint"


@query("R76_weekly_system_metrics", f"""
select year(ts)::bigint as year, {LWEEK_SQL} as week, {METRICS_SQL} from {METRIC_ROWS_SQL} group by 1, 2 order by 1 desc, 2 desc limit {K.WEEKLY_METRICS_ROWS}""")
def r76(spark: SS, d: str) -> DataFrame:
    m = _metrics(cat.read_events(ev(spark, d), None, YESTERDAY))
    return m.groupBy("year", "week").agg(*_metric_aggs()).orderBy(F.col("year").desc(), F.col("week").desc()) \
        .limit(K.WEEKLY_METRICS_ROWS)


@query("R76b_weekly_metrics_by_platform", f"""
select year(ts)::bigint as year, {LWEEK_SQL} as week, case when event_type in ('view', 'click') then 'player' when event_type = 'error' then 'watchdog' else 'installer' end as platform,
 {METRICS_SQL} from {METRIC_ROWS_SQL} group by 1, 2, 3""")
def r76b(spark: SS, d: str) -> DataFrame:
    m = _metrics(cat.read_events(ev(spark, d), None, YESTERDAY))
    t = F.col("event_type")
    plat = C.first_match([(t.isin("view", "click"), "player"), (t == "error", "watchdog")], "installer")
    return m.groupBy("year", "week", plat.alias("platform")).agg(*_metric_aggs())


# Binding: the nine daily counters of the player reliability view.
PLAYER_COUNTERS = {
    "total": "true",
    "startups": "event_type = 'signup'",
    "scheduled_reboots": "event_type = 'signup' and value < 10",
    "modern": "k >= 50",
    "from_reboot": "event_type = 'signup' and value >= 10 and value < 30",
    "graceful": "event_type = 'purchase'",
    "multiple_ungraceful": "event_type = 'error' and value > 80",
    "v3": "event_type = 'signup' and k >= 50",
    "v2": "event_type = 'signup' and k < 50",
}


@rollup("R77_player_reliability_stats", f"""
select date, {', '.join(f"count(distinct case when {c} then user_id end) as {n}" for n, c in PLAYER_COUNTERS.items())}
from {q(None, AS_OF)} group by 1 having {' and '.join(f"count(distinct case when {c} then user_id end) > 0" for c in PLAYER_COUNTERS.values())}""", start=W3_START)
def r77(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Nine counters in one scan and one two-level aggregation.  The view inner-joins
    nine per-date scans, so a day missing from any branch (a zero counter) is
    dropped; the filter re-imposes exactly that."""
    e = cat.read_events(ev(spark, d), first, last).withColumn("k", k_col())
    out = distinct_counts(e, "date", "user_id", {n: F.expr(c) for n, c in PLAYER_COUNTERS.items()})
    return out.where(reduce(lambda a, b: a & b, [F.col(n) > 0 for n in PLAYER_COUNTERS]))


UNGRACEFUL = "(event_type = 'signup' and value >= 30)"
# Binding (R78): ungraceful startups = signups whose payload is not the graceful tag
# band 1x, plus watchdog restarts (errors above 95); installer version text = '20' + 2-digit k.
RESTARTS_SQL = "((event_type = 'signup' and props not like '%\"k\": 1_}') or (event_type = 'error' and value > 95))"
INSTALLER_VERSION_SQL = "'20' || lpad(cast(k as varchar), 2, '0')"


def _multi_unreliable(e: DataFrame) -> DataFrame:
    x = e.withColumn("k", k_col())
    restarts = (((F.col("event_type") == "signup") & C.not_like("props", '%"k": 1_}'))
                | ((F.col("event_type") == "error") & (F.col("value") > 95)))
    installer_v3 = F.col("event_type").isin("signup", "purchase") & \
        (F.concat(F.lit("20"), F.lpad(F.col("k").cast("string"), 2, "0")) > F.lit("2015"))  # text compare
    per = x.where(F.col("user_id").isNotNull()).groupBy("date", "user_id").agg(
        F.count_if(restarts).alias("startupCount"), F.max(installer_v3.cast("int")).alias("v3"))
    return per.where((F.col("v3") == 1) & (F.col("startupCount") > 2)).groupBy(F.col("date").alias("ddate")) \
        .agg(F.count(F.lit(1)).alias("ungracefulMultiStartRecentDisplayCount"))


MULTI_SQL = lambda d0, d1: f"""(with x as (select * from {q(d0, d1)} where user_id is not null),
 s as (select date, user_id, count(*) as startupCount from x where {RESTARTS_SQL} group by 1, 2),
 v as (select distinct date, user_id from x where event_type in ('signup', 'purchase') and {INSTALLER_VERSION_SQL} > '2015')
 select s.date as ddate, count(distinct s.user_id) as ungracefulMultiStartRecentDisplayCount
 from s left join v on v.date = s.date and v.user_id = s.user_id where v.date is not null and s.startupCount > 2 group by 1)"""  # noqa: E731


@rollup("R78_multiple_unreliable_starts", f"""
select * from {MULTI_SQL(W3_START, AS_OF)} union all select * from {MULTI_SQL(None, W3_START)} where ddate < date '{W3_START}'""", start=W3_START, date_col="ddate")
def r78(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Displays per day with more than two ungraceful startups (two event families)
    that also ran a v3 installer that day; last 3 days spliced over history.  One
    (day, display) aggregation instead of the two scans and the left join."""
    return _multi_unreliable(cat.read_events(ev(spark, d), first, last))


@query("R78b_consistently_ungraceful_displays", f"""
with per as (select date, user_id, count(*) filter (where {UNGRACEFUL}) as ungraceful from {q()} group by 1, 2),
noisy as (select user_id, count(*) as days_noisy, cast(sum(ungraceful) as bigint) as startups from per where ungraceful > 1 group by 1),
items as (select user_id, array_to_string(list_sort(list_distinct(list(case when event_type in ('click', 'signup') then event_type end))), ',') as deprecated
 from {q(W7_START, AS_OF)} group by 1)
select n.user_id as display_id, c.c_name as company, n.days_noisy, n.startups, i.deprecated
from noisy n left join customer c on c.c_custkey = n.user_id left join items i on i.user_id = n.user_id""")
def r78b(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    per = e.groupBy("date", "user_id").agg(F.count_if(F.expr(UNGRACEFUL)).alias("ungraceful"))
    noisy = per.where(F.col("ungraceful") > 1).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("days_noisy"), F.sum("ungraceful").cast("long").alias("startups"))
    items = cat.read_events(e, W7_START, YESTERDAY).groupBy("user_id").agg(C.sorted_distinct_join(
        F.when(F.col("event_type").isin("click", "signup"), F.col("event_type"))).alias("deprecated"))
    c = tbl(spark, d, "customer", "c_custkey", "c_name")
    j = noisy.join(c, noisy.user_id == c.c_custkey, "left").join(items, "user_id", "left")
    return j.select(F.col("user_id").alias("display_id"), F.col("c_name").alias("company"), "days_noisy", "startups",
                    "deprecated")


@query("R79_restart_reliability_12_day_periods", f"""
with u as (select event_type as successful_restart, null::bigint as display_id,
  floor(datediff('day', date, date '{AS_OF}') / 12)::bigint as periods_ago from {q(AS_OF - D(days=365), AS_OF)}
  where event_type = 'signup' and value >= 10 and value < 30
 union all select null, user_id, floor(datediff('day', date, date '{AS_OF}') / 12)::bigint from {q(AS_OF - D(days=365), AS_OF)}
  where event_type = 'view')
select count(successful_restart) as successful_restart_count, count(distinct display_id) as display_count,
 round(count(successful_restart) / count(distinct display_id), 6) as reliable_percentage,
 timestamp '{AS_OF}' - to_days(12 * periods_ago) as period
from u group by periods_ago""")
def r79(spark: SS, d: str) -> DataFrame:
    """Restart reliability per 12-day period over a year: successful restarts (startups
    from restart) against distinct displays calling the core, from the two sources
    unioned by name (legacy comma union)."""
    e = cat.read_events(ev(spark, d), AS_OF - D(days=365), YESTERDAY)
    periods = TU.day_period("ts", AS_OF, 12).alias("periods_ago")
    restarts = e.where((F.col("event_type") == "signup") & (F.col("value") >= 10) & (F.col("value") < 30)) \
        .select(F.col("event_type").alias("successful_restart"), periods)
    calls = e.where(F.col("event_type") == "view").select(F.col("user_id").alias("display_id"), periods)
    u = restarts.unionByName(calls, allowMissingColumns=True)
    g = u.groupBy("periods_ago").agg(F.count("successful_restart").alias("successful_restart_count"),
                                     F.count_distinct("display_id").alias("display_count"))
    return g.select("successful_restart_count", "display_count",
                    r6(C.safe_ratio("successful_restart_count", "display_count")).alias("reliable_percentage"),
                    F.timestamp_add("DAY", -12 * F.col("periods_ago"), TU.as_of_ts(AS_OF)).alias("period"))


# =========================================================== R80-R84 uptime
@query("R80_uptime_events_past_days", f"""
select event_id, ts, user_id, event_type, value, props from events where ts >= timestamp '{AS_OF - D(days=4)}' and ts < timestamp '{AS_OF}'""")
def r80(spark: SS, d: str) -> DataFrame:
    return cat.read_events(tbl(spark, d, "events"), AS_OF - D(days=4), YESTERDAY)


def uptime_samples(e: DataFrame) -> DataFrame:
    """Scheduled uptime samples of the past 7 days with 0/1 showing, connected
    and white screen.  White screens come from two sources (union all); the
    lookback left join's fan-out (Z15), once per white screen in a sample's window,
    is the weight ``w`` of the sample: reports sum weights, no copy is made."""
    w = cat.read_partition_time(e, AS_OF - D(days=7), AS_OF)
    s = w.where(F.col("event_type").isin("view", "click") & (k_col() < 80)) \
        .select("event_id", "user_id", "ts", "date", "value")
    ws = w.where((F.col("event_type") == "error") & (F.col("value") > 50)).select("user_id", "ts") \
        .unionByName(w.where((F.col("event_type") == "click") & (F.col("value") < 5)).select("user_id", "ts"))
    n = J.lookback_count(s, ws, "user_id", LOOKBACK_S, name="__ws")
    return n.select("event_id", "user_id", "ts", "date",
                    (F.col("value") > 20).cast("int").alias("showingContent"),
                    (F.col("value") < 95).cast("int").alias("connectedToMS"),
                    (F.col("__ws") > 0).cast("int").alias("whitescreenDetected"), F.greatest("__ws", F.lit(1)).alias("w"))


UPTIME_WS_SQL = f"""(with w as (select * from {q(AS_OF - D(days=7), AS_OF)}),
 s as (select * from w where event_type in ('view', 'click') and k < 80),
 ws as (select user_id, ts from w where event_type = 'error' and value > 50
        union all select user_id, ts from w where event_type = 'click' and value < 5)
 select s.event_id, s.user_id, s.ts, s.date, (s.value > 20)::int as showingContent, (s.value < 95)::int as connectedToMS,
  case when ws.user_id is not null then 1 else 0 end as whitescreenDetected
 from s left join ws on ws.ts <= s.ts and ws.ts > s.ts - interval 6 hour and ws.user_id = s.user_id)"""


@query("R81_uptime_with_whitescreen", f"select ts, user_id as display_id, showingContent, connectedToMS, whitescreenDetected from {UPTIME_WS_SQL}")
def r81(spark: SS, d: str) -> DataFrame:
    u = J.expand_matches(uptime_samples(ev(spark, d)), "w")  # the rows themselves are the result here
    return u.select("ts", F.col("user_id").alias("display_id"), "showingContent", "connectedToMS", "whitescreenDetected")


@query("R81b_average_uptime_pct", f"""
select date, round(sum(case when showingContent = 1 and connectedToMS = 1 and whitescreenDetected = 0 then 1 else 0 end) / count(ts), 6) as average_uptime_pct,
 round(sum(showingContent) / count(ts), 6) as rendererPct, round(sum(connectedToMS) / count(ts), 6) as networkPct,
 round(1 - sum(whitescreenDetected) / count(ts), 6) as whitescreenPct
from {UPTIME_WS_SQL} group by 1""")
def r81b(spark: SS, d: str) -> DataFrame:
    """Per day over the (fanned-out) samples: uptime, renderer, network and white-screen-free shares."""
    u = uptime_samples(ev(spark, d))
    ok = ((F.col("showingContent") == 1) & (F.col("connectedToMS") == 1) & (F.col("whitescreenDetected") == 0)).cast("int")
    n, w = F.sum("w"), F.col("w")
    return u.groupBy("date").agg(r6(F.sum(ok * w) / n).alias("average_uptime_pct"),
                                 r6(F.sum(F.col("showingContent") * w) / n).alias("rendererPct"),
                                 r6(F.sum(F.col("connectedToMS") * w) / n).alias("networkPct"),
                                 r6(1 - F.sum(F.col("whitescreenDetected") * w) / n).alias("whitescreenPct"))


DISPLAY_UPTIME_SQL = f"""(select date, user_id, count(*) as samples,
 round(avg(case when showingContent = 1 and whitescreenDetected = 0 then 1 else 0 end) * 100, 6) as uptime_pct
 from {UPTIME_WS_SQL} group by 1, 2)"""


def _display_uptime(e: DataFrame) -> DataFrame:
    u = uptime_samples(e)
    ok = ((F.col("showingContent") == 1) & (F.col("whitescreenDetected") == 0)).cast("int")
    return u.groupBy("date", "user_id").agg(F.sum("w").alias("samples"),
                                            r6(F.sum(ok * F.col("w")) / F.sum("w") * 100).alias("uptime_pct"))


@query("R81c_daily_uptime_per_display", f"select * from {DISPLAY_UPTIME_SQL}")
def r81c(spark: SS, d: str) -> DataFrame:
    return _display_uptime(ev(spark, d))


@query("R81d_segment_average_uptime", f"""
select u.date, round(avg(u.uptime_pct), 6) as segment_uptime_pct from {DISPLAY_UPTIME_SQL} u
join customer c on c.c_custkey = u.user_id where c.c_mktsegment = 'BUILDING' group by 1""")
def r81d(spark: SS, d: str) -> DataFrame:
    u = _display_uptime(ev(spark, d))
    seg = tbl(spark, d, "customer", "c_custkey", "c_mktsegment").where(F.col("c_mktsegment") == "BUILDING")
    return u.join(seg, u.user_id == seg.c_custkey).groupBy("date").agg(r6(F.avg("uptime_pct")).alias("segment_uptime_pct"))


@query("R82_worst_performers_yesterday", f"""
select u.user_id as display_id, u.uptime_pct, {OS_SQL} as os, c.c_mktsegment as industry,
 case when c.c_mktsegment = 'BUILDING' then 0 else 1 end as segment_rank
from {DISPLAY_UPTIME_SQL} u left join customer c on c.c_custkey = u.user_id
where u.date = date '{YESTERDAY}' and u.uptime_pct < 99""")
def r82(spark: SS, d: str) -> DataFrame:
    u = _display_uptime(ev(spark, d)).where(F.col("date") == F.lit(YESTERDAY))
    c = tbl(spark, d, "customer", "c_custkey", "c_mktsegment")
    j = u.where(F.col("uptime_pct") < 99).join(c, u.user_id == c.c_custkey, "left")
    rk = F.when(F.col("c_mktsegment") == "BUILDING", 0).otherwise(1)
    return j.select(F.col("user_id").alias("display_id"), "uptime_pct", os_of(F.col("c_mktsegment")).alias("os"),
                    F.col("c_mktsegment").alias("industry"), rk.alias("segment_rank")) \
        .orderBy("segment_rank", "uptime_pct", "display_id")


NETERR_SQL = "(event_type = 'error' and value < 40)"


def _disconnections(spark: SS, d: str) -> DataFrame:
    """Samples of the last 2 days, shown, disconnected, without white screen, once per network error
    (one per display and instant, of the last 7 days) in their look-back window."""
    e = ev(spark, d)
    u = uptime_samples(e).where(F.col("date") >= F.lit(AS_OF - D(days=2)))
    net = cat.read_events(e, AS_OF - D(days=7), YESTERDAY).where(F.expr(NETERR_SQL)).select("user_id", "ts").distinct()
    down = u.where((F.col("showingContent") == 1) & (F.col("connectedToMS") == 0) & (F.col("whitescreenDetected") == 0))
    n = J.lookback_count(down, net, "user_id", LOOKBACK_S, name="__net").where(F.col("__net") > 0)
    return n.groupBy("date", "user_id").agg(F.sum("__net").alias("incidents"))


DISCONN_SQL = f"""(select u.date, u.user_id, count(*) as incidents from {UPTIME_WS_SQL} u join
 (select distinct user_id, ts from {q(AS_OF - D(days=7), AS_OF)} where {NETERR_SQL}) n
 on n.user_id = u.user_id and n.ts <= u.ts and n.ts > u.ts - interval 6 hour
 where u.showingContent = 1 and u.connectedToMS = 0 and u.whitescreenDetected = 0 and u.date >= date '{AS_OF - D(days=2)}'
 group by 1, 2)"""


@query("R83_downtime_disconnection_with_issue", f"""
select x.date, x.user_id as display_id, x.incidents, c.c_name as company_name, c.c_mktsegment as industry
from {DISCONN_SQL} x left join customer c on c.c_custkey = x.user_id where c.c_mktsegment = 'BUILDING'""")
def r83(spark: SS, d: str) -> DataFrame:
    x = _disconnections(spark, d)
    c = tbl(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    return x.join(c.where(F.col("c_mktsegment") == "BUILDING"), x.user_id == c.c_custkey).select(
        "date", F.col("user_id").alias("display_id"), "incidents", F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"))


@query("R84_whitescreen_support_list", f"""
with ws as (select date, user_id, count(*) as incidentCount from {UPTIME_WS_SQL} where whitescreenDetected = 1 group by 1, 2)
select lpad(cast(day(ws.date) as varchar), 2, ' ') || strftime(ws.date, '-%b-%Y') as date_text,
 case when c.c_acctbal > 0 then 'active' else 'inactive' end as status, c.c_name as companyName, c.c_nationkey as companyId,
 ws.user_id as displayId, 'presentation-' || cast(ws.user_id as varchar) as presentationName,
 'schedule gap' as request, c.c_name || ': ' || cast(ws.incidentCount as varchar) || ' white screen incident(s) on ' || strftime(ws.date, '%Y-%m-%d') as summary,
 ws.incidentCount
from ws join customer c on c.c_custkey = ws.user_id""")
def r84(spark: SS, d: str) -> DataFrame:
    u = uptime_samples(ev(spark, d))
    ws = u.where(F.col("whitescreenDetected") == 1).groupBy("date", "user_id").agg(F.sum("w").alias("incidentCount"))
    c = tbl(spark, d, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    j = ws.join(c, ws.user_id == c.c_custkey)
    return j.select(
        F.concat(TU.day_space_padded("date"), F.date_format("date", "-MMM-yyyy")).alias("date_text"),
        F.when(F.col("c_acctbal") > 0, "active").otherwise("inactive").alias("status"),
        F.col("c_name").alias("companyName"), F.col("c_nationkey").alias("companyId"), F.col("user_id").alias("displayId"),
        F.concat(F.lit("presentation-"), F.col("user_id").cast("string")).alias("presentationName"),
        F.lit("schedule gap").alias("request"),
        F.concat("c_name", F.lit(": "), F.col("incidentCount").cast("string"), F.lit(" white screen incident(s) on "),
                 F.date_format("date", "yyyy-MM-dd")).alias("summary"),
        "incidentCount")


# =========================================================== R85-R91 endpoint summaries
# Binding of the endpoint logs: heartbeats = 'view' / 'click' events, event log =
# all events, app = the X01-cleaned app string of R87, app version = release line,
# error definitions = the codes (k) of 'error' events with value above 10.
APP_SQL = "(case when value > 50 then 'Widget: ' || event_type || ' ID: ' || cast(k as varchar) else event_type end)"
CLEAN_APP_SQL = f"(case when {APP_SQL} like '%: % ID: %' then regexp_replace({APP_SQL}, ':\\s.+\\sID: ', ': ') else {APP_SQL} end)"


def _endpoint_logs(e: DataFrame) -> DataFrame:
    k = k_col()
    app = F.when(F.col("value") > 50, F.concat(F.lit("Widget: "), "event_type", F.lit(" ID: "), k.cast("string"))) \
        .otherwise(F.col("event_type"))
    return e.withColumn("k", k).withColumn("eventApp", C.clean_up_event_app(app)) \
        .withColumn("eventAppVersion", F.floor(F.col("k") / 10).cast("string"))


def _uptime_rows(spark: SS, d: str) -> DataFrame:
    e = _endpoint_logs(ev(spark, d))
    day = cat.read_events(e, YESTERDAY, YESTERDAY)
    defs = e.where((F.col("event_type") == "error") & (F.col("value") > 10)).select(F.col("k").alias("code")).distinct()
    errors = day.where(F.col("event_type") == "error").join(defs, F.col("k") == defs.code, "left_semi")
    keys = ["user_id", "eventApp", "eventAppVersion"]
    return interval_uptime(day.where(F.col("event_type").isin("view", "click")), day, errors, keys)


UPTIME_ROWS_SQL = f"""(with x as (select *, {CLEAN_APP_SQL} as eventApp, cast(k // 10 as varchar) as eventAppVersion,
  to_timestamp((floor(epoch(ts))::bigint // 300) * 300)::timestamp as interval from {q()}),
 d as (select * from x where date = date '{YESTERDAY}'),
 defs as (select distinct k as code from x where event_type = 'error' and value > 10),
 iv as (select interval, user_id, eventApp, eventAppVersion from d where event_type in ('view', 'click')
        union select interval, user_id, eventApp, eventAppVersion from d),
 er as (select interval, user_id, eventApp, eventAppVersion, count(*) as n from d join defs on d.k = defs.code
        where d.event_type = 'error' group by 1, 2, 3, 4)
 select iv.*, coalesce(er.n, 0) = 0 as up from iv left join er on iv.interval = er.interval and iv.user_id = er.user_id
  and iv.eventApp = er.eventApp and iv.eventAppVersion = er.eventAppVersion)"""


@query("R85_endpoint_uptime", f"""
with u as (select user_id, count(*) as intervals, count(*) filter (where up) as up_intervals from {UPTIME_ROWS_SQL} group by 1)
select u.user_id, u.intervals, u.up_intervals, round(u.up_intervals / u.intervals, 6) as uptime, x.company, x.parent, x.network, x.licence
from u left join (select * from {ENRICHED_SQL} where date = date '{YESTERDAY}') x on x.user_id = u.user_id""")
def r85(spark: SS, d: str) -> DataFrame:
    """Endpoint uptime: up (interval, app, version) rows over all such rows (Z18), with dimensions."""
    rows = _uptime_rows(spark, d)
    u = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("intervals"), F.count_if("up").alias("up_intervals"))
    dims = _enriched(spark, d).where(F.col("date") == F.lit(YESTERDAY)).select("user_id", "company", "parent", "network",
                                                                            "licence")
    return u.join(dims, "user_id", "left").select("user_id", "intervals", "up_intervals",
                                                  r6(C.safe_ratio("up_intervals", "intervals")).alias("uptime"),
                                                  "company", "parent", "network", "licence")


@query("R85b_endpoint_app_uptime", f"""
select user_id, eventApp, eventAppVersion, count(*) as intervals, count(*) filter (where up) as up_intervals,
 round(count(*) filter (where up) / count(*), 6) as uptime from {UPTIME_ROWS_SQL} group by 1, 2, 3""")
def r85b(spark: SS, d: str) -> DataFrame:
    rows = _uptime_rows(spark, d)
    g = rows.groupBy("user_id", "eventApp", "eventAppVersion").agg(
        F.count(F.lit(1)).alias("intervals"), F.count_if("up").alias("up_intervals"))
    return g.withColumn("uptime", r6(C.safe_ratio("up_intervals", "intervals")))


@query("R86_daily_usage", f"""
with x as (select *, {CLEAN_APP_SQL} as eventApp, cast(k // 10 as varchar) as eventAppVersion from {q(YESTERDAY, AS_OF)}),
mentions as (select distinct date, user_id from x where event_type in ('view', 'click')),
counts as (select date, user_id, eventApp, eventAppVersion, count(*) as heartbeats from x group by 1, 2, 3, 4)
select m.date, m.user_id, c.eventApp, c.eventAppVersion, c.heartbeats, round(c.heartbeats / {HEARTBEATS_PER_DAY}, 6) as usage,
 d.company, d.parent, d.network, d.licence
from mentions m left join counts c on c.date = m.date and c.user_id = m.user_id
left join (select * from {ENRICHED_SQL} where date = date '{YESTERDAY}') d on d.user_id = m.user_id""")
def r86(spark: SS, d: str) -> DataFrame:
    """Daily usage: endpoints mentioned by viewer heartbeats, their heartbeat counts per
    (app, version) as a share of a full day (288 five-minute heartbeats), with dimensions."""
    day = _endpoint_logs(cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY))
    mentions = day.where(F.col("event_type").isin("view", "click")).select("date", "user_id").distinct()
    counts = day.groupBy("date", "user_id", "eventApp", "eventAppVersion").agg(F.count(F.lit(1)).alias("heartbeats"))
    dims = _enriched(spark, d).where(F.col("date") == F.lit(YESTERDAY)).select("user_id", "company", "parent",
                                                                            "network", "licence")
    u = mentions.join(counts, ["date", "user_id"], "left").join(dims, "user_id", "left")
    return u.select("date", "user_id", "eventApp", "eventAppVersion", "heartbeats",
                    r6(F.col("heartbeats") / HEARTBEATS_PER_DAY).alias("usage"), "company", "parent", "network",
                    "licence")


@query("R87_daily_errors", f"""
with x as (select *, {CLEAN_APP_SQL} as eventApp, cast(k // 10 as varchar) as eventAppVersion from {q(YESTERDAY, AS_OF)}),
e as (select date, user_id, eventApp, eventAppVersion, k as eventErrorCode, count(*) as errorCount from x group by 1, 2, 3, 4, 5)
select e.*, d.company, d.parent, d.network, d.licence
from e left join (select * from {ENRICHED_SQL} where date = date '{YESTERDAY}') d on d.user_id = e.user_id""")
def r87(spark: SS, d: str) -> DataFrame:
    """Daily event-log counts per endpoint, cleaned app (X01), app version and code, with dimensions."""
    day = _endpoint_logs(cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY))
    e = day.groupBy("date", "user_id", "eventApp", "eventAppVersion", F.col("k").alias("eventErrorCode")) \
        .agg(F.count(F.lit(1)).alias("errorCount"))
    dims = _enriched(spark, d).where(F.col("date") == F.lit(YESTERDAY)).select("user_id", "company", "parent",
                                                                            "network", "licence")
    return e.join(dims, "user_id", "left")


# Binding of the cost inputs (yesterday): downloads = 'click' events of size
# bytes(props) * 100; download cost pool = purchase values; stream-insert cost
# pool = 0.01 per signup; log inserts = all events, heartbeat inserts = view/click.
HB = "event_type in ('view', 'click')"


@query("R88_daily_cost_attribution", f"""
with d as (select *, case when event_type = 'click' then strlen(props) * 100 end as dl from {q(YESTERDAY, AS_OF)}),
per as (select date, user_id, sum(dl) as downloadedBytes, count(*) as logInserts, count(*) filter (where {HB}) as hbInserts
 from d group by 1, 2),
tot as (select sum(value) filter (where event_type = 'purchase') as totalDownloadCost, sum(dl) as totalDownloaded,
 count(*) filter (where event_type = 'signup') * 0.01 as totalStreamInsertCost, count(*) as totalLogInserts,
 count(*) filter (where {HB}) as totalHeartbeatInserts from d)
select per.date, per.user_id,
 round(coalesce(cast(per.downloadedBytes as double) * tot.totalDownloadCost / tot.totalDownloaded, 0.0), 6) as dailyDirectCost,
 round(coalesce(cast(per.logInserts + per.hbInserts as double) * cast(tot.totalStreamInsertCost as double)
  / (tot.totalLogInserts + tot.totalHeartbeatInserts), 0.0), 6) as dailyIndirectCost,
 x.company, x.parent, x.network, x.licence
from per cross join tot left join (select * from {ENRICHED_SQL} where date = date '{YESTERDAY}') x on x.user_id = per.user_id""")
def r88(spark: SS, d: str) -> DataFrame:
    """Daily cost per endpoint: direct = its download bytes' share of the download
    cost, indirect = its log and heartbeat inserts' share of the stream-insert
    cost (0 when it has none), with dimensions.  The totals are one row.  The
    reference's extra legacy download sources (URL-parsed storage logs) have no
    counterpart in the test tables and are not bound."""
    day = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY) \
        .withColumn("dl", F.when(F.col("event_type") == "click", F.octet_length("props") * 100))
    hb = F.col("event_type").isin("view", "click")
    per = day.groupBy("date", "user_id").agg(F.sum("dl").alias("downloadedBytes"), F.count(F.lit(1)).alias("logInserts"),
                                              F.count_if(hb).alias("hbInserts"))
    tot = day.agg(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("totalDownloadCost"),
                  F.sum("dl").alias("totalDownloaded"),
                  (F.count_if(F.col("event_type") == "signup") * 0.01).alias("totalStreamInsertCost"),
                  F.count(F.lit(1)).alias("totalLogInserts"), F.count_if(hb).alias("totalHeartbeatInserts"))
    c = per.crossJoin(F.broadcast(tot))  # one row: size proven
    direct = F.try_divide(F.col("downloadedBytes").cast("double") * F.col("totalDownloadCost"), F.col("totalDownloaded"))
    indirect = F.try_divide((F.col("logInserts") + F.col("hbInserts")).cast("double") * F.col("totalStreamInsertCost"),
                            F.col("totalLogInserts") + F.col("totalHeartbeatInserts"))
    dims = _enriched(spark, d).where(F.col("date") == F.lit(YESTERDAY)).select("user_id", "company", "parent",
                                                                            "network", "licence")
    out = c.select("date", "user_id", r6(F.coalesce(direct, F.lit(0.0))).alias("dailyDirectCost"),
                   r6(F.coalesce(indirect, F.lit(0.0))).alias("dailyIndirectCost"))
    return out.join(dims, "user_id", "left").select("date", "user_id", "dailyDirectCost", "dailyIndirectCost",
                                                    "company", "parent", "network", "licence")


def _daily_uptime_all(spark: SS, d: str, start: dt.date, end: dt.date) -> DataFrame:
    """The dailyUptime table over a date range: the R85 interval model per day."""
    e = _endpoint_logs(ev(spark, d))
    w = cat.read_events(e, start, end)
    defs = e.where((F.col("event_type") == "error") & (F.col("value") > 10)).select(F.col("k").alias("code")).distinct()
    errors = w.where(F.col("event_type") == "error").join(defs, F.col("k") == defs.code, "left_semi")
    rows = interval_uptime(w.where(F.col("event_type").isin("view", "click")), w, errors,
                           ["user_id", "eventApp", "eventAppVersion"])
    per = rows.groupBy(F.to_date("interval").alias("date"), "user_id").agg(
        F.count(F.lit(1)).alias("intervals"), F.count_if("up").alias("up_intervals"))
    return per.withColumn("uptimePercentage", r6(C.safe_ratio("up_intervals", "intervals")))


def _enriched_dims(spark: SS, d: str) -> DataFrame:
    return _enriched(spark, d).select("date", "user_id", "company", "parent", "network")


UPTIME_ALL_SQL = f"""(with x as (select *, {CLEAN_APP_SQL} as eventApp, cast(k // 10 as varchar) as eventAppVersion,
  to_timestamp((floor(epoch(ts))::bigint // 300) * 300)::timestamp as interval from {q()}),
 d as (select * from x where date between date '{AS_OF - D(days=30)}' and date '{YESTERDAY}'),
 defs as (select distinct k as code from x where event_type = 'error' and value > 10),
 iv as (select interval, user_id, eventApp, eventAppVersion from d where event_type in ('view', 'click')
        union select interval, user_id, eventApp, eventAppVersion from d),
 er as (select interval, user_id, eventApp, eventAppVersion, count(*) as n from d join defs on d.k = defs.code
        where d.event_type = 'error' group by 1, 2, 3, 4),
 r as (select iv.*, coalesce(er.n, 0) = 0 as up from iv left join er on iv.interval = er.interval and iv.user_id = er.user_id
  and iv.eventApp = er.eventApp and iv.eventAppVersion = er.eventAppVersion)
 select cast(interval as date) as date, user_id, count(*) as intervals, count(*) filter (where up) as up_intervals,
  round(count(*) filter (where up) / count(*), 6) as uptimePercentage from r group by 1, 2)"""


@query("R89_endpoint_uptime_view", f"""
select distinct u.date, u.user_id as endpointId, x.company as companyName, x.parent as parentCompanyName,
 x.network as networkCompanyName, u.uptimePercentage
from {UPTIME_ALL_SQL} u join {ENRICHED_SQL} x on x.user_id = u.user_id and x.date = u.date where x.company is not null""")
def r89(spark: SS, d: str) -> DataFrame:
    """The endpoint uptime view over the last 30 days of the daily uptime table
    (endpoint level, known company), read distinct as the view does."""
    u = _daily_uptime_all(spark, d, AS_OF - D(days=30), YESTERDAY)
    x = _enriched_dims(spark, d).where(F.col("company").isNotNull())
    return u.join(x, ["date", "user_id"]).select(
        "date", F.col("user_id").alias("endpointId"), F.col("company").alias("companyName"),
        F.col("parent").alias("parentCompanyName"), F.col("network").alias("networkCompanyName"), "uptimePercentage").distinct()


@query("R89b_downtime_causes", f"""
with x as (select *, {CLEAN_APP_SQL} as eventApp from {q(AS_OF - D(days=30), AS_OF)}),
e as (select date, user_id, k as eventErrorCode, count(*) as errorCount from x group by 1, 2, 3),
defs as (select distinct k as code, 'code ' || cast(k as varchar) as message, k < 50 as isRelatedToUptime from {q()}),
ee as (select e.date, e.user_id, e.eventErrorCode, sum(e.errorCount) as errorCount from e join {ENRICHED_SQL} d
  on d.user_id = e.user_id and d.date = e.date where d.company is not null group by 1, 2, 3)
select distinct ee.date, ee.user_id as endpointId, ee.eventErrorCode, defs.message, cast(ee.errorCount as bigint) as errorCount
from ee join defs on defs.code = ee.eventErrorCode where defs.isRelatedToUptime""")
def r89b(spark: SS, d: str) -> DataFrame:
    """Downtime causes: the daily error table (event-log counts per endpoint and code)
    of the last 30 days for endpoints with a known company, joined to the error
    definitions related to uptime."""
    e = ev(spark, d).withColumn("k", k_col())
    daily = cat.read_events(e, AS_OF - D(days=30), YESTERDAY).groupBy("date", "user_id", F.col("k").alias("eventErrorCode")) \
        .agg(F.count(F.lit(1)).alias("errorCount"))
    known = _enriched_dims(spark, d).where(F.col("company").isNotNull()).select("date", "user_id")
    ee = J.semi(daily, known, ["date", "user_id"]).groupBy("date", "user_id", "eventErrorCode") \
        .agg(F.sum("errorCount").cast("long").alias("errorCount"))
    # error definitions: one row per code (bounded code catalogue); no broadcast hint, AQE decides
    defs = e.select(F.col("k").alias("eventErrorCode"), F.concat(F.lit("code "), F.col("k").cast("string")).alias("message"),
                    (F.col("k") < 50).alias("isRelatedToUptime")).distinct()
    return ee.join(defs, "eventErrorCode").where(F.col("isRelatedToUptime")).select(
        "date", F.col("user_id").alias("endpointId"), "eventErrorCode", "message", "errorCount").distinct()


# Binding (R90): billing export = all line items, their
# ship day mapped onto the event period (1998-10-01 -> 2024-01-01), cost =
# extended price x discount, project = return flag, service = line status, SKU =
# supplier; endpoint-infrastructure projects = a literal relation ('A', 'N').
LI_D0 = dt.date(1998, 10, 1)
BILL_BASE = dt.date(2024, 1, 1)
INFRA_PROJECTS = ["A", "N"]


def billing_export(spark: SS, d: str) -> DataFrame:
    """Every line item; each report bounds the mapped days itself."""
    li = tbl(spark, d, "lineitem", "l_shipdate", "l_returnflag", "l_linestatus", "l_suppkey", "l_extendedprice", "l_discount")
    day = F.date_add(F.lit(BILL_BASE), F.datediff(F.to_date("l_shipdate"), F.lit(LI_D0)))
    return li.select(day.alias("date"), F.col("l_returnflag").alias("projectId"), F.col("l_linestatus").alias("service"),
                     F.col("l_suppkey").cast("string").alias("SKU"),
                     (F.col("l_extendedprice") * F.col("l_discount")).alias("cost"))


BILLING_SQL = f"""(select cast(date '{BILL_BASE}' + cast(datediff('day', date '{LI_D0}', cast(l_shipdate as date)) as integer) as date) as date,
 l_returnflag as projectId, l_linestatus as service, cast(l_suppkey as varchar) as SKU, l_extendedprice * l_discount as cost
 from lineitem)"""
INFRA_SQL = f"""(select date, projectId, service, SKU, sum(cost) as dailyCost from {BILLING_SQL}
 where projectId in (select * from (values {', '.join(f"('{p}')" for p in INFRA_PROJECTS)}))
 and date between date '{AS_OF - D(days=60)}' and date '{AS_OF}' and date <= date '{YESTERDAY}' group by 1, 2, 3, 4)"""


def _infra_costs(spark: SS, d: str) -> DataFrame:
    b = billing_export(spark, d)
    infra = spark.createDataFrame([(p,) for p in INFRA_PROJECTS], "projectId string")  # literal relation
    b = b.join(F.broadcast(infra), "projectId", "left_semi") \
        .where(F.col("date").between(F.lit(AS_OF - D(days=60)), F.lit(YESTERDAY)))
    return b.groupBy("date", "projectId", "service", "SKU").agg(F.sum("cost").alias("dailyCost"))


@query("R90_cost_last_60_days", f"select date, projectId, service, SKU, round(dailyCost, 6) as dailyCost from {INFRA_SQL}")
def r90(spark: SS, d: str) -> DataFrame:
    """Infrastructure cost per day, project, service and SKU over 60 days (projects
    restricted to the endpoint-infrastructure ones)."""
    return _infra_costs(spark, d).withColumn("dailyCost", r6("dailyCost"))


def _daily_costs(e: DataFrame) -> DataFrame:
    """The R88 cost model for every day of ``e`` (per-day totals)."""
    x = e.withColumn("dl", F.when(F.col("event_type") == "click", F.octet_length("props") * 100))
    hb = F.col("event_type").isin("view", "click")
    per = x.groupBy("date", "user_id").agg(F.sum("dl").alias("downloadedBytes"), F.count(F.lit(1)).alias("logInserts"),
                                            F.count_if(hb).alias("hbInserts"))
    tot = x.groupBy("date").agg(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("tdc"),
                                F.sum("dl").alias("tdl"), (F.count_if(F.col("event_type") == "signup") * 0.01).alias("tsc"),
                                F.count(F.lit(1)).alias("tli"), F.count_if(hb).alias("thb"))
    c = per.join(tot, "date")  # one row per day on the right
    direct = F.try_divide(F.col("downloadedBytes").cast("double") * F.col("tdc"), F.col("tdl"))
    indirect = F.try_divide((F.col("logInserts") + F.col("hbInserts")).cast("double") * F.col("tsc"), F.col("tli") + F.col("thb"))
    return c.select("date", "user_id", F.coalesce(direct, F.lit(0.0)).alias("downloadCost"),
                    F.coalesce(indirect, F.lit(0.0)).alias("loggingCost"))


@query("R90b_infrastructure_cost_per_endpoint", f"""
with x as (select *, case when event_type = 'click' then strlen(props) * 100 end as dl from {q(AS_OF - D(days=60), AS_OF)}),
per as (select date, user_id, sum(dl) as downloadedBytes, count(*) as logInserts, count(*) filter (where {HB}) as hbInserts
 from x group by 1, 2),
tot as (select date, sum(value) filter (where event_type = 'purchase') as tdc, sum(dl) as tdl,
 count(*) filter (where event_type = 'signup') * 0.01 as tsc, count(*) as tli, count(*) filter (where {HB}) as thb from x group by 1),
cost as (select per.date, per.user_id, coalesce(cast(per.downloadedBytes as double) * tot.tdc / tot.tdl, 0.0) as downloadCost,
 coalesce(cast(per.logInserts + per.hbInserts as double) * cast(tot.tsc as double) / (tot.tli + tot.thb), 0.0) as loggingCost
 from per join tot on tot.date = per.date),
infra as (select date, sum(dailyCost) as total from {INFRA_SQL} group by 1),
usage as (select distinct date, user_id from x where {HB}),
ipe as (select i.date, i.total / count(distinct u.user_id) as infrastuctureCost from infra i join usage u on u.date = i.date
 group by i.date, i.total)
select cost.date, cost.user_id as endpointId, d.company as companyName, round(cost.downloadCost, 6) as downloadCost,
 round(cost.loggingCost, 6) as loggingCost, round(ipe.infrastuctureCost, 6) as infrastuctureCost
from cost join ipe on ipe.date = cost.date left join {ENRICHED_SQL} d on d.user_id = cost.user_id and d.date = cost.date""")
def r90b(spark: SS, d: str) -> DataFrame:
    """Daily endpoint cost over 60 days: download and logging cost shares plus the day's
    infrastructure cost divided by the day's usage endpoints (inner join on day)."""
    e = cat.read_events(ev(spark, d), AS_OF - D(days=60), YESTERDAY)
    cost = _daily_costs(e)
    infra = _infra_costs(spark, d).groupBy("date").agg(F.sum("dailyCost").alias("total"))
    usage = e.where(F.col("event_type").isin("view", "click")).groupBy("date").agg(F.count_distinct("user_id").alias("n"))
    ipe = infra.join(usage, "date").select("date", (F.col("total") / F.col("n")).alias("infrastuctureCost"))
    dims = _enriched(spark, d).select("date", "user_id", F.col("company").alias("companyName"))
    j = cost.join(ipe, "date").join(dims, ["date", "user_id"], "left")
    return j.select("date", F.col("user_id").alias("endpointId"), "companyName", r6("downloadCost").alias("downloadCost"),
                    r6("loggingCost").alias("loggingCost"), r6("infrastuctureCost").alias("infrastuctureCost"))


@query("R91_template_usage_by_display", f"""
with x as (select *, {CLEAN_APP_SQL} as eventApp from {q(AS_OF - D(days=7), AS_OF)})
select distinct date, user_id as displayId, substr(eventApp, 9) as templateId from x where eventApp like 'Widget: %'""")
def r91(spark: SS, d: str) -> DataFrame:
    """Templates shown per display and day over 7 days, cut from the cleaned app name of
    the usage rows (binding: app names 'Widget: <id>' instead of 'HTML Template: <id>')."""
    u = _endpoint_logs(cat.read_events(ev(spark, d), AS_OF - D(days=7), YESTERDAY))
    return u.where(F.col("eventApp").like("Widget: %")).select(
        "date", F.col("user_id").alias("displayId"), F.expr("substr(eventApp, 9)").alias("templateId")).distinct()
