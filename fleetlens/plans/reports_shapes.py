"""Further output shapes of inventory rows that span several reference views
(R28, R30, R35, R76, R89, R102, R112).  Bindings as in ``reports.py``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions import columns as C
from fleetlens.functions import timeutil as TU
from fleetlens.operators import joins as J
from fleetlens.operators.reliability import distinct_counts, interval_uptime
from fleetlens.plans.registry import query
from fleetlens.plans.reports_companies import NOW, in_dates, none_showing, untimed
from fleetlens.plans.reports import NOT_TEST_SQL, W7_START, _not_test, ev, k_col, q
from fleetlens.plans.reports_uptime import (CLEAN_APP_SQL, LWEEK_SQL, METRIC_ROWS_SQL, METRICS_SQL, _endpoint_logs, _metric_aggs,
                                             _metrics)
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl
from fleetlens.sources import catalog as cat

SS = SparkSession
r6 = C.r
D = dt.timedelta


@query("R28b_component_presentation_usage", f"""
select c.c_nationkey as company_id, e.event_type as component, e.k // 10 as template, e.k as presentation,
 count(distinct e.user_id) as displays from {q(W7_START, AS_OF)} e join customer c on c.c_custkey = e.user_id group by 1, 2, 3, 4""")
def r28b(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), W7_START, YESTERDAY).withColumn("k", k_col())
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey")
    x = e.join(c, e.user_id == c.c_custkey)
    return x.groupBy(F.col("c_nationkey").alias("company_id"), F.col("event_type").alias("component"),
                     F.floor(F.col("k") / 10).cast("int").alias("template"), F.col("k").alias("presentation")) \
        .agg(F.count_distinct("user_id").alias("displays"))


@query("R30c_social_usage_by_day", f"""
select cast(year(date) as varchar) || '-' || lpad(cast(month(date) as varchar), 2, '0') || '-' || lpad(cast(day(date) as varchar), 2, '0') as usage_date,
 count(distinct user_id) as displays from {q(extra=NOT_TEST_SQL)} group by 1""")
def r30c(spark: SS, d: str) -> DataFrame:
    e = _not_test(spark, d, ev(spark, d))
    day = TU.date_from_parts(F.year("date"), F.month("date"), F.dayofmonth("date"))
    return e.groupBy(day.alias("usage_date")).agg(F.count_distinct("user_id").alias("displays"))


@query("R35b_schedule_usage_and_error_count", f"""
with u as (select date, count(distinct user_id) as usage from {q(W7_START, AS_OF)} group by 1),
e as (select date, count(distinct user_id) as errors from {q(W7_START, AS_OF)} where event_type = 'error' group by 1)
select date, usage, errors from u join e using (date)""")
def r35b(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), W7_START, YESTERDAY)
    c = distinct_counts(e, "date", "user_id", {"usage": F.lit(True), "errors": F.col("event_type") == "error"})
    return c.where(F.col("errors") > 0)  # JOIN USING (date): days without errors drop


@query("R76c_weekly_metrics_fixed_fleet", f"""
select year(ts)::bigint as year, {LWEEK_SQL} as week, {METRICS_SQL}
from {METRIC_ROWS_SQL} where user_id in (select c_custkey from customer where c_mktsegment = 'BUILDING') group by 1, 2""")
def r76c(spark: SS, d: str) -> DataFrame:
    fleet = tbl(spark, d, "customer", "c_custkey", "c_mktsegment").where(F.col("c_mktsegment") == "BUILDING") \
        .select(F.col("c_custkey").alias("user_id"))
    m = _metrics(J.semi(cat.read_events(ev(spark, d), None, YESTERDAY), fleet, "user_id"))
    return m.groupBy("year", "week").agg(*_metric_aggs())


@query("R89c_endpoint_app_uptime_view", f"""
with x as (select *, {CLEAN_APP_SQL} as eventApp, cast(k // 10 as varchar) as eventAppVersion,
  to_timestamp((floor(epoch(ts))::bigint // 300) * 300)::timestamp as interval from {q()}),
 d as (select * from x where date between date '{AS_OF - D(days=30)}' and date '{YESTERDAY}'),
 defs as (select distinct k as code from x where event_type = 'error' and value > 10),
 iv as (select interval, user_id, eventApp, eventAppVersion from d where event_type in ('view', 'click')
        union select interval, user_id, eventApp, eventAppVersion from d),
 er as (select interval, user_id, eventApp, eventAppVersion, count(*) as n from d join defs on d.k = defs.code
        where d.event_type = 'error' group by 1, 2, 3, 4),
 r as (select iv.*, coalesce(er.n, 0) = 0 as up from iv left join er on iv.interval = er.interval and iv.user_id = er.user_id
  and iv.eventApp = er.eventApp and iv.eventAppVersion = er.eventAppVersion)
select distinct cast(interval as date) as date, user_id as endpointId, eventApp, eventAppVersion,
 round(count(*) filter (where up) / count(*), 6) as uptimePercentage
from r where eventApp is not null group by 1, 2, 3, 4""")
def r89c(spark: SS, d: str) -> DataFrame:
    """The app-level rows of the daily uptime table (eventApp present) over 30 days."""
    e = _endpoint_logs(ev(spark, d))
    w = cat.read_events(e, AS_OF - D(days=30), YESTERDAY)
    defs = e.where((F.col("event_type") == "error") & (F.col("value") > 10)).select(F.col("k").alias("code")).distinct()
    errors = w.where(F.col("event_type") == "error").join(defs, F.col("k") == defs.code, "left_semi")
    rows = interval_uptime(w.where(F.col("event_type").isin("view", "click")), w, errors,
                           ["user_id", "eventApp", "eventAppVersion"])
    g = rows.where(F.col("eventApp").isNotNull()).groupBy(
        F.to_date("interval").alias("date"), F.col("user_id").alias("endpointId"), "eventApp", "eventAppVersion") \
        .agg(r6(F.count_if("up") / F.count(F.lit(1))).alias("uptimePercentage"))
    return g.distinct()


@query("R102c_display_creation_ratio", f"""
with first_signup as (select user_id, min(ts) as created from events where event_type = 'signup' group by 1),
new as (select * from first_signup where created >= timestamp '{AS_OF - D(days=30)}' and created < timestamp '{AS_OF}')
select count(*) as new_companies, count(*) filter (where exists (select 1 from events v where v.event_type = 'view'
 and v.user_id = new.user_id and v.ts >= new.created)) as with_display,
 round(count(*) filter (where exists (select 1 from events v where v.event_type = 'view' and v.user_id = new.user_id
 and v.ts >= new.created)) / nullif(count(*), 0), 6) as ratio from new""")
def r102c(spark: SS, d: str) -> DataFrame:
    e = tbl(spark, d, "events")
    new = e.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.min("ts").alias("created")) \
        .where((F.col("created") >= cat.day_start(AS_OF - D(days=30))) & (F.col("created") < cat.day_start(AS_OF)))
    # a connected display after creation <=> the device's last view is not before it (one row per device)
    last_view = e.where(F.col("event_type") == "view").groupBy("user_id").agg(F.max("ts").alias("lv"))
    x = new.join(last_view, "user_id", "left").withColumn("ok", F.coalesce(F.col("lv") >= F.col("created"), F.lit(False)))
    k = x.agg(F.count(F.lit(1)).alias("new_companies"), F.count_if("ok").alias("with_display"))
    return k.select("new_companies", "with_display", r6(C.safe_ratio("with_display", "new_companies")).alias("ratio"))


def placeholder_items(spark: SS, d: str) -> DataFrame:
    """Presentations (orders) -> placeholders (line items) -> widget items: two
    items per placeholder, nested as array<struct<..., items array<struct>>>."""
    li = tbl(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax", "l_shipdate")
    day = F.to_date("l_shipdate")
    items = F.array(
        F.struct(F.concat(F.lit("d"), F.col("l_partkey").cast("string")).alias("name"),
                 (F.col("l_discount") > 0.05).alias("timeDefined"), F.date_sub(day, 30).alias("startDate"),
                 day.alias("endDate")),
        F.struct(F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("name"),
                 (F.col("l_tax") > 0.04).alias("timeDefined"), day.alias("startDate"),
                 F.date_add(day, 30).alias("endDate")))
    return li.select(F.col("l_orderkey").alias("presentationId"), F.explode(items).alias("it")).select("presentationId", "it.*")


ITEMS_SQL = """(select l_orderkey as presentationId, 'd' || cast(l_partkey as varchar) as name, l_discount > 0.05 as timeDefined,
 cast(l_shipdate as date) - 30 as startDate, cast(l_shipdate as date) as endDate from lineitem
 union all select l_orderkey, 't' || cast(l_partkey as varchar), l_tax > 0.04, cast(l_shipdate as date), cast(l_shipdate as date) + 30 from lineitem)"""
ITEMS_AS_OF = dt.date(1998, 6, 1)


@query("R109c_no_content_due_to_widget_schedule", f"""
select presentationId from (select presentationId, timeDefined and not (startDate <= date '{ITEMS_AS_OF}' and endDate >= date '{ITEMS_AS_OF}') as hidden
 from {ITEMS_SQL}) group by presentationId having min(case when hidden then 1 else 0 end) = 1""")
def r109c(spark: SS, d: str) -> DataFrame:
    """Presentations none of whose widget items plays on the evaluation date (nested explode + NOT EXISTS)."""
    it = placeholder_items(spark, d)
    return none_showing(it, untimed() | in_dates(ITEMS_AS_OF))


@query("R124d_api_call_counts_last_hour", f"""
select user_id, count(*) as calls, cast(sum(k) as bigint) as cycles, count(*) filter (where value > 90) as loading_requests
from {q(extra=f"ts > timestamp '{NOW - D(hours=1)}'")} group by 1""")
def r124d(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).where(F.col("ts") > TU.as_of_ts(NOW - D(hours=1))).withColumn("k", k_col())
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("calls"), F.sum("k").cast("long").alias("cycles"),
                                    F.count_if(F.col("value") > 90).alias("loading_requests"))


@query("R123c_core_client_noisy_display_counts", f"""
with core as (select date, count(distinct user_id) as core_displays from {q(AS_OF - D(days=45), AS_OF)} where event_type = 'view' group by 1),
clients as (select date, count(distinct user_id) as client_displays from (
  select date, user_id from {q(AS_OF - D(days=45), AS_OF)} where event_type = 'click'
  union all select date, user_id from {q(AS_OF - D(days=45), AS_OF)} where event_type = 'signup') group by 1),
noise as (select date, count(*) as noisy_displays from (select date, user_id, count(*) as n from {q(AS_OF - D(days=45), AS_OF)}
  where event_type = 'view' group by 1, 2 having count(*) > {K.NOISY_CALLS_PER_DAY}) group by 1)
select core.date, core.core_displays, clients.client_displays, noise.noisy_displays
from core left join clients on clients.date = core.date left join noise on noise.date = core.date""")
def r123c(spark: SS, d: str) -> DataFrame:
    """Per day over 45 days: displays calling the core (display requests), client
    displays (two client event sources, unioned), and noisy displays (> 480
    display requests).  One scan, one (day, display) aggregation; the view's left
    joins give NULL for a day without clients or noisy displays (``nullif``)."""
    e = cat.read_events(ev(spark, d), AS_OF - D(days=45), YESTERDAY)
    view = F.col("event_type") == "view"
    known = F.col("user_id").isNotNull()  # a NULL id is no display, but its requests make a group of the noisy count
    per = e.groupBy("date", "user_id").agg(
        F.max(view.cast("int")).alias("core"), F.max(F.col("event_type").isin("click", "signup").cast("int")).alias("client"),
        F.count_if(view).alias("requests"))
    g = per.groupBy("date").agg(F.sum(F.when(known, F.col("core")).otherwise(0)).cast("long").alias("core_displays"),
                                F.max("core").alias("any_core"), F.max("client").alias("any_client"),
                                F.sum(F.when(known, F.col("client")).otherwise(0)).cast("long").alias("client_displays"),
                                F.count_if(F.col("requests") > K.NOISY_CALLS_PER_DAY).alias("noisy_displays"))
    return g.where(F.col("any_core") == 1).select(
        "date", "core_displays", F.when(F.col("any_client") == 1, F.col("client_displays")).alias("client_displays"),
        F.nullif("noisy_displays", F.lit(0)).alias("noisy_displays"))
