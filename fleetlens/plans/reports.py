"""Report jobs over the driver tables.

Bindings (see ``tables.py``): device = ``user_id``; configuration = 'view',
error = 'error', start = 'signup', complete = 'purchase', other = 'click';
details = ``props``; release ``k`` = the number in ``props`` (beta channel =
tags 10-19, release line = k div 10); company of a device = customer
``c_custkey = user_id``; company group = ``c_nationkey``; industry =
``c_mktsegment`` (segment = 'BUILDING'); evaluation date 2024-01-31.

Each job's oracle is built by a small SQL template where several jobs share a
shape; the Spark side always goes through the library operators.
"""

from __future__ import annotations

import datetime as dt
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions import columns as C
from fleetlens.operators import joins as J
from fleetlens.operators.reliability import daily_reliability, distinct_counts, top_errors
from fleetlens.operators.rollup import pivot_long
from fleetlens.plans.dataflow import BETA_LIKE
from fleetlens.plans.registry import query
from fleetlens.plans.rollups import rollup
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl, version_of
from fleetlens.sources import catalog as cat

SS = SparkSession
r6 = C.r
D = dt.timedelta
W3_START = AS_OF - D(days=3)   # fresh window of the rollup views
W5_START = AS_OF - D(days=5)
W7_START = AS_OF - D(days=7)


def ev(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "events").withColumn("date", F.to_date("ts"))


def q(d0: dt.date | None = None, d1: dt.date | None = None, extra: str = "") -> str:
    """SQL event source with date bounds [d0, d1) and derived columns."""
    conds = []
    if d0:
        conds.append(f"ts >= timestamp '{d0}'")
    if d1:
        conds.append(f"ts < timestamp '{d1}'")
    if extra:
        conds.append(extra)
    where = (" where " + " and ".join(conds)) if conds else ""
    return ("(select *, cast(ts as date) as date, cast(nullif(regexp_extract(props, '(\\d+)', 1), '') as integer) as k "
            f"from events{where})")


def k_col() -> Column:
    return version_of()


# =========================================================== widget / component reliability
def widget_stats(e: DataFrame, start: dt.date | None, end: dt.date, failed: Column) -> DataFrame:
    """R20/R21 core for one window: configured devices vs configured devices that failed,
    restricted to stable (non-beta) devices of either player family.

    One scan and one (device, day) aggregation of flags; the stable-device set is
    derived from that same aggregate (its shuffle is reused), so the window's
    events are read once instead of once per sub-query of the view.
    """
    w = cat.read_events(e, start, end).where(~F.col("user_id").isin(0))
    stable_row = C.not_like("props", BETA_LIKE) & F.col("event_type").isin("signup", "purchase", "view", "click")
    per = w.groupBy("user_id", "date").agg(
        F.max((F.col("event_type") == "view").cast("int")).alias("cfg"),
        F.max(F.coalesce(failed, F.lit(False)).cast("int")).alias("bad"),
        F.max(F.coalesce(stable_row, F.lit(False)).cast("int")).alias("st"))
    stable = per.groupBy("user_id").agg(F.max("st").alias("st")).where(F.col("st") == 1)
    x = per.join(stable.select("user_id"), "user_id", "left_semi")
    out = x.groupBy("date").agg(F.sum("cfg").cast("long").alias("total_count"),
                                F.sum(F.col("cfg") * F.col("bad")).cast("long").alias("failed_count"))
    return out.where(F.col("total_count") > 0)


def widget_stats_sql(d0: dt.date | None, d1: dt.date, failed: str) -> str:
    stable = (f"(select user_id from {q(d0, d1)} where props not like '{BETA_LIKE}' and event_type in ('signup','purchase') "
              f"union select user_id from {q(d0, d1)} where props not like '{BETA_LIKE}' and event_type in ('view','click'))")
    alld = f"(select * from {q(d0, d1)} where user_id not in (0) and user_id in {stable})"
    return f"""(select a.date, a.total_count, coalesce(b.failed_count, 0) as failed_count from
 (select date, count(distinct user_id) as total_count from {alld} where event_type = 'view' group by 1) a left join
 (select date, count(distinct user_id) as failed_count from {alld} x where ({failed}) and exists
   (select 1 from {alld} c where c.event_type = 'view' and c.user_id = x.user_id and c.date = x.date) group by 1) b
 on a.date = b.date)"""


def _spliced_widget_sql(failed: str) -> str:
    fresh = widget_stats_sql(W3_START, AS_OF, failed)
    hist = widget_stats_sql(None, W3_START, failed)
    return f"select * from {fresh} union all select * from {hist} where date < date '{W3_START}'"


R20_FAIL_SQL = "event_type = 'error' and props not like '%\"k\": 4_}'"


@rollup("R20_widget_stats_spliced", _spliced_widget_sql(R20_FAIL_SQL), start=W3_START)
def r20(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    return widget_stats(ev(spark, d), first, last, (F.col("event_type") == "error") & C.not_like("props", '%"k": 4_}'))


R21_FAIL_SQL = "(event_type = 'error' and value > 50) or (event_type = 'click' and value < 5 and k >= 20)"


@rollup("R21_widget_stats_multi_branch", _spliced_widget_sql(R21_FAIL_SQL), start=W3_START)
def r21(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    c = F.col
    branch_error = (c("event_type") == "error") & (c("value") > 50)
    branch_player = (c("event_type") == "click") & (c("value") < 5) & (k_col() >= 20)
    return widget_stats(ev(spark, d), first, last, branch_error | branch_player)


@query("R22_daily_reliability_with_usage", f"""
with u as (select date, count(distinct user_id) as usageCount from {q()} group by 1),
e as (select date, count(distinct user_id) as errorCount from {q()} where event_type = 'error' group by 1),
s as (select date, count(distinct user_id) as componentUsageCount from {q()} where event_type = 'view' and value > 50 group by 1)
select u.usageCount, coalesce(e.errorCount, 0) as errorCount,
 round(1 - coalesce(e.errorCount, 0) / u.usageCount, 6) as Reliability, strftime(u.date, '%Y-%m-%d') as usage_date,
 coalesce(s.componentUsageCount, 0) as componentUsageCount
from u left join e on u.date = e.date left join s on u.date = s.date""")
def r22(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    rel = distinct_counts(e, "date", "user_id", {
        "usageCount": F.lit(True), "errorCount": F.col("event_type") == "error",
        "componentUsageCount": (F.col("event_type") == "view") & (F.col("value") > 50)})
    return rel.select("usageCount", "errorCount",
                      r6(1 - C.safe_ratio("errorCount", "usageCount")).alias("Reliability"),
                      F.date_format("date", "yyyy-MM-dd").alias("usage_date"), "componentUsageCount")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("R23_widget_reliability_dashboard", f"""
with x as (select e.date, c.c_mktsegment as fam, count(distinct e.user_id) as total,
  count(distinct case when e.event_type = 'error' then e.user_id end) as failed
 from {q(W7_START, AS_OF)} e join customer c on c.c_custkey = e.user_id group by 1, 2),
r as (select date, fam, (total - failed) / total as rel from x where total > 1),
spine as (select distinct date from r where fam = 'BUILDING')
select s.date, {', '.join(f"max(case when r.fam = '{f}' then round(r.rel, 6) end) as {f.lower()}" for f in SEGMENTS)}
from spine s left join r on r.date = s.date group by 1""")
def r23(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), W7_START, YESTERDAY)
    c = tbl(spark, d, "customer", "c_custkey", "c_mktsegment")
    x = e.join(c, e.user_id == c.c_custkey).withColumn("fam", F.col("c_mktsegment"))
    cnt = distinct_counts(x, ["date", "fam"], "user_id", {"total": F.lit(True), "failed": F.col("event_type") == "error"})
    rel = cnt.where(F.col("total") > 1).withColumn("value", r6(C.safe_ratio(F.col("total") - F.col("failed"), "total")))
    wide = pivot_long(rel.withColumn("fam", F.lower("fam")), "fam", [f.lower() for f in SEGMENTS])
    # the driving family's dates are the spine: exactly the pivot rows where it has a value
    return wide.where(F.col("building").isNotNull())


@query("R24_top_errors_by_day", f"""
select count(distinct x.user_id) as display_count, substr(x.props, 1, 200) as details, x.event_type as event
from {q(YESTERDAY, AS_OF)} x where x.event_type in ('error', 'click') and x.value > 60 and exists
 (select 1 from {q(YESTERDAY, AS_OF)} c where c.event_type = 'view' and c.user_id = x.user_id) group by 2, 3""")
def r24(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY)
    cfg = e.where(F.col("event_type") == "view").select("user_id", "date")
    bad = J.semi(e.where(F.col("event_type").isin("error", "click") & (F.col("value") > 60)), cfg, ["user_id", "date"])
    out = top_errors(bad, F.col("props"), "user_id", extra=["event_type"]).withColumnRenamed("event_type", "event")
    return out.select("display_count", "details", "event").orderBy(F.col("display_count").desc(), "details", "event")


@query("R25_affected_files", f"""
select distinct x.props as file_url, x.user_id as display_id from {q(W3_START, AS_OF)} x
where x.event_type = 'error' and x.value > 95 and exists
 (select 1 from {q(W3_START, AS_OF)} c where c.event_type = 'view' and c.user_id = x.user_id and c.date = x.date)""")
def r25(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), W3_START, YESTERDAY)
    cfg = e.where(F.col("event_type") == "view").select("user_id", "date")
    bad = J.semi(e.where((F.col("event_type") == "error") & (F.col("value") > 95)), cfg, ["user_id", "date"])
    return bad.select(F.col("props").alias("file_url"), F.col("user_id").alias("display_id")).distinct()


@query("R26_started_never_finished", f"""
with s as (select distinct user_id, date from {q()} where event_type = 'signup'),
ok as (select distinct user_id, date from {q()} where event_type = 'purchase'),
bad as (select * from s where not exists (select 1 from ok where ok.user_id = s.user_id and ok.date = s.date))
select a.date, a.attempted, coalesce(b.never_finished, 0) as never_finished,
 round((a.attempted - coalesce(b.never_finished, 0)) / a.attempted, 6) as reliability
from (select date, count(distinct user_id) as attempted from s group by 1) a
left join (select date, count(distinct user_id) as never_finished from bad group by 1) b on a.date = b.date""")
def r26(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    starts = e.where(F.col("event_type") == "signup").select("user_id", "date")
    done = e.where(F.col("event_type") == "purchase").select("user_id", "date")
    never = J.anti(starts, done, ["user_id", "date"])
    both = starts.withColumn("f", F.lit(False)).unionByName(never.withColumn("f", F.lit(True)))
    rel = daily_reliability(both, "user_id", F.col("f"), total=~F.col("f"), scale=1.0,
                            total_name="attempted", failed_name="never_finished", ratio_name="reliability")
    return rel


STAGE = "case when k < 50 then 'stable' else 'beta' end"
LEVEL = "case when value > 90 then 'error' when value > 70 then 'warning' else 'info' end"


def _stage_level(e: DataFrame) -> DataFrame:
    k = k_col()
    return e.withColumn("k", k).withColumn("rollout_stage", F.when(F.col("k") < 50, "stable").otherwise("beta")) \
        .withColumn("level", F.when(F.col("value") > 90, "error").when(F.col("value") > 70, "warning").otherwise("info"))


@query("R27_component_daily_stats", f"""
with x as (select distinct date, {STAGE} as rollout_stage, event_type as component, user_id, {LEVEL} as level from {q()})
select date, rollout_stage, component, count(*) as total_count, count(*) filter (where level <> 'info') as failed_count
from x group by 1, 2, 3""")
def r27(spark: SS, d: str) -> DataFrame:
    x = _stage_level(ev(spark, d)).select("date", "rollout_stage", F.col("event_type").alias("component"),
                                          "user_id", "level").distinct()
    return x.groupBy("date", "rollout_stage", "component").agg(
        F.count(F.lit(1)).alias("total_count"), F.count_if(F.col("level") != "info").alias("failed_count"))


@query("R27b_component_errors_and_warnings", f"""
select date, {STAGE} as rollout_stage, {LEVEL} as level, event_type as component, props as event, count(*) as n
from {q()} where {LEVEL} <> 'info' group by all""")
def r27b(spark: SS, d: str) -> DataFrame:
    x = _stage_level(ev(spark, d)).where(F.col("level") != "info")
    out = x.groupBy("date", "rollout_stage", "level", F.col("event_type").alias("component"),
                    F.col("props").alias("event")).agg(F.count(F.lit(1)).alias("n"))
    sev = F.when(F.col("level") == "error", 0).when(F.col("level") == "warning", 1).otherwise(2)
    return out.orderBy(F.col("date").desc(), sev, F.col("n").desc())


@query("R28_component_version_usage", f"""
select {STAGE} as rollout_stage, event_type as component, k as version, count(distinct user_id) as displays
from {q(W7_START, AS_OF)} group by 1, 2, 3""")
def r28(spark: SS, d: str) -> DataFrame:
    x = _stage_level(cat.read_events(ev(spark, d), W7_START, YESTERDAY))
    return x.groupBy("rollout_stage", F.col("event_type").alias("component"), F.col("k").alias("version")) \
        .agg(F.count_distinct("user_id").alias("displays"))


def _component_reliability(spark: SS, d: str) -> DataFrame:
    s = r27(spark, d)
    return s.withColumn("Reliability", r6(C.safe_ratio(F.col("total_count") - F.col("failed_count"), "total_count")))


COMP_REL_SQL = f"""(select *, round((total_count - failed_count) / total_count, 6) as Reliability from
 (select date, rollout_stage, component, count(*) as total_count, count(*) filter (where level <> 'info') as failed_count
  from (select distinct date, {STAGE} as rollout_stage, event_type as component, user_id, {LEVEL} as level from {q()})
  group by 1, 2, 3))"""


@query("R29_component_reliability_series", f"select * from {COMP_REL_SQL}")
def r29(spark: SS, d: str) -> DataFrame:
    return _component_reliability(spark, d)


COMPONENTS = ["click", "error", "purchase", "signup", "view"]


@query("R29b_component_reliability_stable_pivot", f"""
with r as (select * from {COMP_REL_SQL} where rollout_stage = 'stable'),
top as (select distinct date from r order by date desc limit 7)
select t.date, {', '.join(f"max(case when r.component = '{c}' then r.Reliability end) as {c}" for c in COMPONENTS)}
from top t left join r on r.date = t.date group by 1""")
def r29b(spark: SS, d: str) -> DataFrame:
    r = _component_reliability(spark, d).where(F.col("rollout_stage") == "stable")
    wide = pivot_long(r, "component", COMPONENTS, value_col="Reliability")  # one row per date
    return wide.orderBy(F.col("date").desc()).limit(7)  # the view's latest 7 dates (top-k is the feature)


def _not_test(spark: SS, d: str, e: DataFrame) -> DataFrame:
    """Drop devices of test companies (negative account balance)."""
    test = tbl(spark, d, "customer", "c_custkey", "c_acctbal").where(F.col("c_acctbal") < 0) \
        .select(F.col("c_custkey").alias("user_id"))
    return J.anti(e, test, "user_id")


NOT_TEST_SQL = "user_id not in (select c_custkey from customer where c_acctbal < 0)"


@query("R30_social_reliability", f"""
with t as (select date, count(distinct user_id) as displays from {q(extra=NOT_TEST_SQL)} group by 1),
er as (select date, count(distinct user_id) as errors from (
  select date, user_id from {q(extra=NOT_TEST_SQL)} where event_type = 'error'
  union select date, user_id from {q(extra=NOT_TEST_SQL)} where event_type = 'click' and value > 97) group by 1)
select t.date, t.displays, coalesce(er.errors, 0) as errors, round(1 - coalesce(er.errors, 0) / t.displays, 6) as reliability
from t left join er on t.date = er.date""")
def r30(spark: SS, d: str) -> DataFrame:
    e = _not_test(spark, d, ev(spark, d))
    failed = (F.col("event_type") == "error") | ((F.col("event_type") == "click") & (F.col("value") > 97))
    return daily_reliability(e, "user_id", failed, scale=1.0, total_name="displays", failed_name="errors",
                             ratio_name=None).withColumn("reliability", r6(1 - C.safe_ratio("errors", "displays")))


@query("R30b_social_usage_by_month", f"""
select strftime(date, '%Y-%m') as month, count(distinct user_id) as displays from {q(extra=NOT_TEST_SQL)} group by 1""")
def r30b(spark: SS, d: str) -> DataFrame:
    e = _not_test(spark, d, ev(spark, d))
    return e.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.count_distinct("user_id").alias("displays"))


@query("R31_unlicensed_usage_asof", """
with x as (select e.event_id, cast(e.ts as date) as date, e.user_id,
  (select v.value > 50 from events v where v.user_id = e.user_id and v.event_type = 'view' and v.ts < e.ts
   order by v.ts desc, v.event_id desc limit 1) as offline_subscription
 from events e where e.event_type = 'error' and e.value > 75)
select date, count(distinct user_id) as displays from x where offline_subscription = false group by 1""")
def r31(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    unauth = e.where((F.col("event_type") == "error") & (F.col("value") > 75)).select("event_id", "user_id", "ts", "date")
    cfg = e.where(F.col("event_type") == "view").select("user_id", "ts", F.col("event_id").alias("cid"),
                                                       (F.col("value") > 50).alias("offline_subscription"))
    j = J.asof_join(unauth, cfg, "user_id", right_cols=["offline_subscription"], tie="cid", prefix="cfg_")
    return j.where(C.is_false("cfg_offline_subscription")).groupBy("date") \
        .agg(F.count_distinct("user_id").alias("displays"))


# Binding (R32): the provider's text log of a day is one line per event that is no view.
TEXT_LOG_SQL = f"""(select cast(ts as date) as date, 'level=' || event_type || ' code=' || coalesce(cast(k as varchar), '-')
 || ' companyId: ' || lpad(cast(user_id as varchar), 36, '0') || ', ' || props as line from {q(YESTERDAY, AS_OF)} where event_type <> 'view')"""


@query("R32_text_log_reliability", f"""
with total as (select date, count(distinct lpad(cast(user_id as varchar), 36, '0')) as n from {q(W3_START, AS_OF)} where event_type = 'view' group by 1),
failed as (select date, count(distinct substr(regexp_replace(line, '.*companyId: ([^,]*),.*', '\\1'), 1, 36)) as n from {TEXT_LOG_SQL}
 where lower(line) like '%error%' and line not like '%code=4 %' and line like '%companyId: %' group by 1)
select total.date, total.n as total_count, coalesce(failed.n, 0) as failed_count,
 round((total.n - coalesce(failed.n, 0)) / total.n, 6) as Reliability
from total left join failed on failed.date = total.date""")
def r32(spark: SS, d: str) -> DataFrame:
    """Companies using the component in 3 days against companies in yesterday's error lines of the
    provider's text log (ids cut from the text, known authentication errors left out); a fraction."""
    company = F.lpad(F.col("user_id").cast("string"), 36, "0")
    total = cat.read_events(ev(spark, d), W3_START, YESTERDAY).where(F.col("event_type") == "view") \
        .groupBy("date").agg(F.count_distinct(company).alias("total_count"))
    log = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY).where(F.col("event_type") != "view").select(
        "date", F.concat(F.lit("level="), "event_type", F.lit(" code="), F.coalesce(k_col().cast("string"), F.lit("-")),
                         F.lit(" companyId: "), company, F.lit(", "), "props").alias("line"))
    bad = log.where(F.lower("line").like("%error%") & ~F.col("line").like("%code=4 %") & F.col("line").like("%companyId: %"))
    cut = F.substring(F.regexp_replace("line", ".*companyId: ([^,]*),.*", "$1"), 1, 36)
    failed = bad.groupBy("date").agg(F.count_distinct(cut).alias("failed"))
    return total.join(failed, "date", "left").withColumn("failed_count", F.coalesce("failed", F.lit(0))).select(
        "date", "total_count", "failed_count",
        r6(C.safe_ratio(F.col("total_count") - F.col("failed_count"), F.col("total_count"))).alias("Reliability"))


RESP = "case when event_type = 'click' then null else value > 10 end"


def _uptime_samples(e: DataFrame) -> DataFrame:
    resp = F.when(F.col("event_type") == "click", F.lit(None).cast("boolean")).otherwise(F.col("value") > 10)
    return e.withColumn("responding", resp).withColumn("error", F.col("event_type") == "error")


def _uptime_aggs() -> list[Column]:
    n = F.count(F.lit(1))
    ok = F.sum((C.is_true("responding") & C.is_not_true("error")).cast("int"))
    return [r6(ok / n * 100).alias("day_uptime_pct"),
            r6(F.sum(C.is_true("responding").cast("int")) / n * 100).alias("responding_pct"),
            r6(F.sum(C.is_not_true("error").cast("int")) / n * 100).alias("no_error_pct")]


def _uptime_window(e: DataFrame) -> DataFrame:
    """The view's 30 days, both ends included."""
    return cat.read_ts_between(e, dt.datetime.combine(AS_OF - D(days=30), dt.time()), dt.datetime.combine(AS_OF, dt.time()))


UPTIME_WINDOW_SQL = q(extra=f"ts between timestamp '{AS_OF - D(days=30)}' and timestamp '{AS_OF}'")


UPTIME_SQL = f"""round(sum(case when ({RESP}) is true and (event_type = 'error') is not true then 1 else 0 end) / count(*) * 100, 6) as day_uptime_pct,
 round(sum(case when ({RESP}) is true then 1 else 0 end) / count(*) * 100, 6) as responding_pct,
 round(sum(case when (event_type = 'error') is not true then 1 else 0 end) / count(*) * 100, 6) as no_error_pct"""


@query("R33_daily_uptime", f"select date, {UPTIME_SQL} from {UPTIME_WINDOW_SQL} group by 1")
def r33(spark: SS, d: str) -> DataFrame:
    return _uptime_samples(_uptime_window(ev(spark, d))).groupBy("date").agg(*_uptime_aggs())


@query("R33b_daily_uptime_per_type", f"select date, {STAGE} as component_type, {UPTIME_SQL} from {UPTIME_WINDOW_SQL} group by 1, 2")
def r33b(spark: SS, d: str) -> DataFrame:
    x = _stage_level(_uptime_samples(_uptime_window(ev(spark, d)))).withColumnRenamed("rollout_stage", "component_type")
    return x.groupBy("date", "component_type").agg(*_uptime_aggs())


SCHEDULE_ERROR_SQL = "value > 90"   # binding: an error row of a widget table
W8_START = AS_OF - D(days=7)         # suffixes from 7 days ago through today


def _uptime(usage: str, errors: str) -> Column:
    return F.when(F.col(usage) > 0, r6((F.col(usage) - F.col(errors)) / F.col(usage)))


@query("R34_shared_schedule_uptime_wide", f"""
with x as (select * from {q(W8_START, AS_OF + D(days=1))} where user_id is not null),
a as (select count(distinct user_id) as activeSharedSchedules,
 count(distinct case when {SCHEDULE_ERROR_SQL} then user_id end) as sharedScheduleErrors,
 {', '.join(f"count(distinct case when event_type = '{t}' then user_id end) as {t}Usage, count(distinct case when event_type = '{t}' and {SCHEDULE_ERROR_SQL} then user_id end) as {t}Errors" for t in COMPONENTS)}
 from x)
select case when activeSharedSchedules > 0 then round((activeSharedSchedules - sharedScheduleErrors) / activeSharedSchedules, 6) end as sharedScheduleUptime,
 {', '.join(f"case when {t}Usage > 0 then round(({t}Usage - {t}Errors) / {t}Usage, 6) end as {t}Uptime, {t}Usage, {t}Errors" for t in COMPONENTS)}
from a""")
def r34(spark: SS, d: str) -> DataFrame:
    """Shared-schedule KPI row over the widget tables (one per event kind): distinct
    schedules using / failing each, the union of all as the overall figures, uptimes.
    The view's 28 scans (instances and errors per table) are one scan here, and
    the unions distinct are distinct counts over the same rows."""
    e = cat.read_events(ev(spark, d), W8_START, AS_OF).where(F.col("user_id").isNotNull()).withColumn("all", F.lit(1))
    t, err = F.col("event_type"), F.expr(SCHEDULE_ERROR_SQL)
    flags = {"activeSharedSchedules": F.lit(True), "sharedScheduleErrors": err}
    for c in COMPONENTS:
        flags[f"{c}Usage"] = t == c
        flags[f"{c}Errors"] = (t == c) & err
    wide = distinct_counts(e, "all", "user_id", flags)  # one scan, one row
    out = [_uptime("activeSharedSchedules", "sharedScheduleErrors").alias("sharedScheduleUptime")]
    for c in COMPONENTS:
        out += [_uptime(f"{c}Usage", f"{c}Errors").alias(f"{c}Uptime"), F.col(f"{c}Usage"), F.col(f"{c}Errors")]
    return wide.select(*out)


@query("R35_schedule_errors_with_company", f"""
with x as (select e.date, e.user_id, e.event_type, c.c_nationkey as company_id
 from {q(W5_START, AS_OF)} e left join customer c on c.c_custkey = e.user_id)
select date, count(distinct user_id) as endpoints, count(distinct company_id) as companies,
 count(distinct case when event_type = 'error' then user_id end) as endpoints_with_errors,
 count(distinct case when event_type = 'error' then company_id end) as companies_with_errors from x group by 1""")
def r35(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), W5_START, YESTERDAY)
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey")
    x = e.join(c, e.user_id == c.c_custkey, "left").withColumn("company_id", F.col("c_nationkey"))
    err = F.col("event_type") == "error"
    a = distinct_counts(x, "date", "user_id", {"endpoints": F.lit(True), "endpoints_with_errors": err})
    b = distinct_counts(x, "date", "company_id", {"companies": F.lit(True), "companies_with_errors": err})
    return a.join(b, "date", "left").select("date", "endpoints", F.coalesce("companies", F.lit(0)).alias("companies"),
                                            "endpoints_with_errors",
                                            F.coalesce("companies_with_errors", F.lit(0)).alias("companies_with_errors"))


# Binding: deprecated content items -> the event kind that reveals them.
DEPRECATED = {"legacy_click": "click", "legacy_signup": "signup"}


@query("R36_deprecated_content_matrix", f"""
with x as (select e.user_id, c.c_nationkey, e.event_type from {q(W7_START, AS_OF)} e left join customer c on c.c_custkey = e.user_id)
select user_id as display_id, min(c_nationkey) as company_id,
 {', '.join(f"max(case when event_type = '{v}' then '{k}' end) as {k}" for k, v in DEPRECATED.items())}
from x group by 1""")
def r36(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), W7_START, YESTERDAY)
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey")
    g = e.join(c, e.user_id == c.c_custkey, "left").groupBy(F.col("user_id").alias("display_id")).agg(
        F.min("c_nationkey").alias("company_id"), F.collect_set("event_type").alias("__seen"))  # <= 5 kinds
    cols = [F.when(F.array_contains("__seen", v), F.lit(k)).alias(k) for k, v in DEPRECATED.items()]
    n = sum(F.array_contains("__seen", v).cast("int") for v in DEPRECATED.values())
    return g.select("display_id", "company_id", *cols, n.alias("__n")).orderBy(F.col("__n").desc()).drop("__n")


PRICE_PER_100MB = K.LOG_STORAGE_PRICE_PER_100MB
FIXED_BYTES = sum(K.LOG_ROW_FIXED_BYTES.values())
# Binding: platform = event kind, source = payload band; the variable-size fields
# present are the event name and its details (the other optional fields are NULL).
SOURCE_SQL = "case when value > 50 then 'widget' else 'player' end"


def _log_rows(e: DataFrame) -> DataFrame:
    row_bytes = (F.lit(FIXED_BYTES) + F.octet_length("event_type")
                 + F.octet_length(F.coalesce(F.col("props"), F.lit(""))))
    return e.select("date", F.col("event_type").alias("platform"),
                    F.when(F.col("value") > 50, "widget").otherwise("player").alias("source"),
                    (F.floor(row_bytes / 1024) + 1).alias("kb"))  # whole KB per row, as DIV(bytes, 1024) + 1


def _table_stats(e: DataFrame) -> DataFrame:
    return _log_rows(e).groupBy("date", "platform", "source").agg(F.sum("kb").cast("long").alias("size_kb")) \
        .withColumn("cost_per_100mb", F.lit(PRICE_PER_100MB))


STATS_SQL = lambda d0, d1: f"""(select date, event_type as platform, {SOURCE_SQL} as source,
 cast(sum((({FIXED_BYTES} + strlen(event_type) + strlen(coalesce(props, ''))) // 1024) + 1) as bigint) as size_kb,
 cast({PRICE_PER_100MB} as double) as cost_per_100mb from {q(d0, d1)} group by 1, 2, 3)"""  # noqa: E731


@rollup("R37b_log_table_stats", f"""
select * from {STATS_SQL(YESTERDAY, AS_OF)} union all select * from {STATS_SQL(None, YESTERDAY)} where date < date '{YESTERDAY}'""",
        start=YESTERDAY)
def r37(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Size of yesterday's log rows per (platform, source), spliced over the stored stats."""
    return _table_stats(cat.read_events(ev(spark, d), first, last))


# cost text: exact decimal of size_kb * price / (1024 * 100), half-up at 10 decimals, from
# integer arithmetic (a double's binary value would make engines round ties differently)
_UNITS = Fraction(str(PRICE_PER_100MB)) * 10 ** 10 / (1024 * 100)   # 1e-10 units per KB
_NUM, _DEN = _UNITS.numerator, _UNITS.denominator
COST_TEXT_SQL = (f"(cast((size_kb * {2 * _NUM} + {_DEN}) // {2 * _DEN} // 10000000000 as varchar) || '.' || "
                 f"lpad(cast((size_kb * {2 * _NUM} + {_DEN}) // {2 * _DEN} % 10000000000 as varchar), 10, '0'))")


def cost_text(size_kb: Column) -> Column:
    units = F.expr(f"({size_kb._jc.toString()} * {2 * _NUM} + {_DEN}) div {2 * _DEN}")
    return F.concat(F.expr(f"{units._jc.toString()} div 10000000000").cast("string"), F.lit("."),
                    F.lpad((units % 10_000_000_000).cast("string"), 10, "0"))


@query("R37_log_table_cost", f"""
with stats as (select date, platform, source, size_kb, size_kb * cost_per_100mb / (1024 * 100) as cost from {STATS_SQL(None, AS_OF)})
select s.date, s.platform, s.source, s.size_kb, s.cost, {COST_TEXT_SQL.replace('size_kb', 's.size_kb')} as cost_string,
 round(s.size_kb / t.size_kb, 6) as participation_percentage
from stats s join (select date, sum(size_kb) as size_kb from stats group by 1) t on s.date = t.date""")
def r37b(spark: SS, d: str) -> DataFrame:
    """Cost per (date, platform, source), its 10-decimal text and its share of the day's size."""
    st = _table_stats(cat.read_events(ev(spark, d), None, YESTERDAY))
    st = st.withColumn("cost", F.col("size_kb") * F.col("cost_per_100mb") / (1024 * 100))
    tot = st.groupBy("date").agg(F.sum("size_kb").alias("__t"))  # one row per day
    return st.join(tot, "date").select(
        "date", "platform", "source", "size_kb", "cost",  # same IEEE operations as the SQL: identical doubles
        cost_text(F.col("size_kb")).alias("cost_string"),
        r6(F.col("size_kb") / F.col("__t")).alias("participation_percentage"))


# =========================================================== flagship: module content reliability
@query("R71_content_reliability", f"""
with x as (select * from {q(W5_START, AS_OF)})
select t.date, round((t.total - coalesce(f.errors, 0)) / t.total * 100, 6) as pct from
 (select date, count(distinct user_id) as total from x group by 1 having date <= date '{AS_OF}') t left join
 (select date, count(distinct user_id) as errors from x where event_type = 'error' group by 1) f on t.date = f.date""")
def r71(spark: SS, d: str) -> DataFrame:
    """Content (white-screen) reliability over the last 5 days: the minimum slice."""
    e = cat.read_partition_time(ev(spark, d), W5_START, AS_OF)
    rel = daily_reliability(e, "user_id", F.col("event_type") == "error")
    return rel.where(F.col("date") <= F.lit(AS_OF)).select("date", "pct").orderBy(F.col("date").desc())
