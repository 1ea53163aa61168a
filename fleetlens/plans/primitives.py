"""Primitive operators of SURVEY §2.1-2.11 as jobs over the driver tables.

Each job exercises one relational primitive through the library's readers and
helpers; its oracle is the same computation in DuckDB SQL.  Integer outputs
are BIGINT, doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import timeutil as TU
from fleetlens.operators import joins as J
from fleetlens.operators.latest import latest_by
from fleetlens.operators.reliability import distinct_counts
from fleetlens.operators.rollup import latest_n_dates, tag_union
from fleetlens.plans.registry import query
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl, version_of
from fleetlens.sources import catalog as cat
from fleetlens.sources import shards
from fleetlens.sources.schemas import conform

SS = SparkSession
r6 = C.r


def ev(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "events")


# =============================================================== 2.1 sources
@query("S01_read_events_range", """
select event_id, user_id, event_type, cast(ts as date) as event_date from events
where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-13'""")
def s01(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), "2024-01-10", "2024-01-12")
    return e.select("event_id", "user_id", "event_type", F.to_date("ts").alias("event_date"))


@query("S02_suffix_range", """
select event_id, strftime(ts, '%Y%m%d') as table_suffix from events
where strftime(ts, '%Y%m%d') between '20240110' and '20240112'""")
def s02(spark: SS, d: str) -> DataFrame:
    return cat.read_suffix_range(ev(spark, d), "20240110", "20240112").select("event_id", "table_suffix")


@query("S03_read_matching", """
select event_id, 'events_' || strftime(ts, '%Y%m%d') as table_id from events
where ('events_' || strftime(ts, '%Y%m%d')) like '%2024011%' and year(ts) in (2024, 2023)""")
def s03(spark: SS, d: str) -> DataFrame:
    """The family's daily tables are day ranges of ``events``; the days come from the predicate, not from the data."""
    years = (AS_OF.year - 1, AS_OF.year)
    days = shards.matching_days("events_", dt.date(years[0], 1, 1), dt.date(years[1], 12, 31),
                                lambda t: "2024011" in t and int(t[7:11]) in years)
    return shards.read_matching_days(ev(spark, d), "events_", days).select("event_id", "table_id")


@query("S04_partition_time_half_open", """
select user_id, event_type, cast(ts as date) as date from events
where ts >= timestamp '2024-01-26' and ts < timestamp '2024-01-31'""")
def s04(spark: SS, d: str) -> DataFrame:
    e = cat.read_partition_time(ev(spark, d), AS_OF - dt.timedelta(days=5), AS_OF)
    return e.select("user_id", "event_type", F.to_date("ts").alias("date"))


@query("S05_ts_between_closed", """
select event_id, ts from events where ts between timestamp '2024-01-20 00:00:00' and timestamp '2024-01-21 00:00:00'""")
def s05(spark: SS, d: str) -> DataFrame:
    return cat.read_ts_between(ev(spark, d), dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 21)) \
              .select("event_id", "ts")


@query("S06_single_shard", """
select event_id, user_id from events where cast(ts as date) = date '2024-01-15'""")
def s06(spark: SS, d: str) -> DataFrame:
    return cat.read_events(ev(spark, d), "2024-01-15", "2024-01-15").select("event_id", "user_id")


@query("S07_entity_scan", """
select c_custkey, c_name from customer where c_mktsegment = 'BUILDING' and c_acctbal >= 0""")
def s07(spark: SS, d: str) -> DataFrame:
    c = cat.Catalog(spark, d).table("customer", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])
    return c.where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") >= 0)).select("c_custkey", "c_name")


@query("S08_view_over_view", """
with active as (select cast(ts as date) as date, count(distinct user_id) as users from events group by 1),
errs as (select cast(ts as date) as date, count(distinct user_id) as errored from events where event_type = 'error' group by 1)
select a.date, a.users, coalesce(e.errored, 0) as errored from active a left join errs e on a.date = e.date""")
def s08(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    e.createOrReplaceTempView("fl_events")
    spark.sql("create or replace temp view fl_daily_active as select to_date(ts) as date, "
              "count(distinct user_id) as users from fl_events group by 1")
    spark.sql("create or replace temp view fl_daily_errors as select to_date(ts) as date, "
              "count(distinct user_id) as errored from fl_events where event_type = 'error' group by 1")
    return spark.sql("select a.date, a.users, coalesce(e.errored, 0) as errored "
                     "from fl_daily_active a left join fl_daily_errors e on a.date = e.date")


@query("S09_inline_literal_relation", """
with seg(segment) as (select 'BUILDING' union all select 'MACHINERY')
select s.segment, count(c.c_custkey) as companies from seg s join customer c on c.c_mktsegment = s.segment group by 1""")
def s09(spark: SS, d: str) -> DataFrame:
    seg = spark.createDataFrame([("BUILDING",), ("MACHINERY",)], "segment string")
    c = tbl(spark, d, "customer", "c_custkey", "c_mktsegment")
    return (c.join(F.broadcast(seg), c.c_mktsegment == seg.segment)  # two literal rows
             .groupBy("segment").agg(F.count("c_custkey").alias("companies")))


@query("S10_daily_append_rows", """
select cast(ts as date) as date, user_id, count(*) as events, count(*) filter (where event_type = 'error') as errors
from events where cast(ts as date) = date '2024-01-30' group by 1, 2""")
def s10(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY)
    out = (e.groupBy(F.to_date("ts").alias("date"), "user_id")
            .agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "error").alias("errors")))
    return out.select("date", "user_id", "events", "errors")  # INSERT INTO t(cols) order


@query("S11_snapshot_with_run_time", """
select count(distinct user_id) as users, count(distinct case when event_type = 'purchase' then user_id end) as buyers,
round(100.0 * count(distinct case when event_type = 'purchase' then user_id end) / count(distinct user_id), 6) as pct,
timestamp '2024-01-31 06:00:00' as ts from events""")
def s11(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    kpi = e.agg(F.count_distinct("user_id").alias("users"),
                F.count_distinct(F.when(F.col("event_type") == "purchase", F.col("user_id"))).alias("buyers"))
    return kpi.select("users", "buyers", F.round(C.safe_ratio("buyers", "users", 100.0), 6).alias("pct"),
                      TU.as_of_ts(dt.datetime(2024, 1, 31, 6)).alias("ts"))


@query("S12_conform_installer_family", """
select event_type as event, props as event_details, cast(user_id as varchar) as display_id,
cast(null as varchar) as ip, cast(null as varchar) as os, cast(null as varchar) as installer_version, ts,
cast(ts as date) as event_date from events""")
def s12(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).select(F.col("event_type").alias("event"), F.col("props").alias("event_details"),
                            F.col("user_id").alias("display_id"), "ts")
    return conform(e, "installer_events").withColumn("event_date", F.to_date("ts"))


@query("S13_conform_viewer_family", """
select event_type as event, props as event_details, cast(user_id as varchar) as display_id,
cast(regexp_extract(props, '(\\d+)', 1) as varchar) as viewer_version, ts from events""")
def s13(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).select(F.col("event_type").alias("event"), F.col("props").alias("event_details"),
                            F.col("user_id").alias("display_id"),
                            F.regexp_extract("props", r"(\d+)", 1).alias("viewer_version"), "ts")
    return conform(e, "viewer_events")


# =============================================================== 2.2 projections / predicates
@query("P01_project_alias_compute", """
select user_id as display_id, event_type as event, round(value * 2, 6) as doubled from events""")
def p01(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select(F.col("user_id").alias("display_id"), F.col("event_type").alias("event"),
                               r6(F.col("value") * 2).alias("doubled"))


@query("P02_star_plus_derived", """
select cast(ts as date) as date, * from events""")
def p02(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select(F.to_date("ts").alias("date"), "*")


@query("P03_nested_field", """
select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events
where cast(json_extract_string(props, '$.k') as integer) > 50""")
def p03(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).select("event_id", F.from_json("props", "k int").alias("p"))
    return e.where(F.col("p.k") > 50).select("event_id", F.col("p.k").alias("k"))


@query("P04_boolean_precedence", """
select event_id from events
where (event_type = 'error' or value > 90) and not (user_id <> 5 and value < 1) and event_type <> 'signup'""")
def p04(spark: SS, d: str) -> DataFrame:
    c = F.col
    return ev(spark, d).where(((c("event_type") == "error") | (c("value") > 90))
                              & ~((c("user_id") != 5) & (c("value") < 1))
                              & (c("event_type") != "signup")).select("event_id")


@query("P05_like_not_like", """
select doc_id, source, lang from documents where source like 'src1_' and lang not like 'e%'""")
def p05(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "documents", "doc_id", "source", "lang") \
        .where(F.col("source").like("src1_") & C.not_like("lang", "e%"))


@query("P06_contains", """
select page_id from pages where contains(url, '?page=') or contains(url, 'blog.')""")
def p06(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "pages", "page_id", "url") \
        .where(F.col("url").contains("?page=") | F.col("url").contains("blog.")).select("page_id")


@query("P07_regexp_contains", """
select page_id from pages where regexp_matches(url, '^https://[a-z]+\\.example\\.(com|net)/')""")
def p07(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "pages", "page_id", "url") \
        .where(F.col("url").rlike(r"^https://[a-z]+\.example\.(com|net)/")).select("page_id")


@query("P08_starts_ends_is_false", """
select page_id from pages where starts_with(url, 'https') and (ends_with(url, '/') is false)""")
def p08(spark: SS, d: str) -> DataFrame:
    u = F.col("url")
    return tbl(spark, d, "pages", "page_id", "url") \
        .where(u.startswith("https") & C.is_false(u.endswith("/"))).select("page_id")


@query("P09_in_not_in_lists", """
select event_id from events where event_type in ('error', 'view') and user_id not in (1, 2, 3, 5, 8, 13)""")
def p09(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).where(F.col("event_type").isin("error", "view")
                              & ~F.col("user_id").isin(1, 2, 3, 5, 8, 13)).select("event_id")


@query("P10_between", """
select o_orderkey from orders where o_orderdate between timestamp '1996-01-01' and timestamp '1996-03-31'
and strftime(o_orderdate, '%Y%m%d') between '19960115' and '19960320'""")
def p10(spark: SS, d: str) -> DataFrame:
    o = tbl(spark, d, "orders", "o_orderkey", "o_orderdate")
    return o.where(F.col("o_orderdate").between(cat.ts_literal("1996-01-01"), cat.ts_literal("1996-03-31"))
                   & F.date_format("o_orderdate", "yyyyMMdd").between("19960115", "19960320")).select("o_orderkey")


@query("P11_null_tests", """
select case when regexp_matches(url, '[?&]page=([^&#]*)') then 'has_page' else 'no_page' end as kind,
count(*) as pages from pages group by 1""")
def p11(spark: SS, d: str) -> DataFrame:
    p = tbl(spark, d, "pages", "url").withColumn("pg", C.url_param("url", "page"))
    return p.groupBy(F.when(F.col("pg").isNotNull(), "has_page").when(F.col("pg").isNull(), "no_page")
                     .alias("kind")).agg(F.count(F.lit(1)).alias("pages"))


@query("P12_three_valued_tests", """
with t as (select cast(ts as date) as date, case when event_type = 'click' then null else value > 50 end as ok from events)
select date, count(*) filter (where ok is true) as n_true, count(*) filter (where ok is not true) as n_not_true,
count(*) filter (where ok is false) as n_false from t group by 1""")
def p12(spark: SS, d: str) -> DataFrame:
    t = ev(spark, d).select(F.to_date("ts").alias("date"),
                            F.when(F.col("event_type") == "click", F.lit(None).cast("boolean"))
                            .otherwise(F.col("value") > 50).alias("ok"))
    return t.groupBy("date").agg(F.count_if(C.is_true("ok")).alias("n_true"),
                                 F.count_if(C.is_not_true("ok")).alias("n_not_true"),
                                 F.count_if(C.is_false("ok")).alias("n_false"))


@query("P13_ordered_rules", """
select page_id, case when contains(url, 'spam') then 'spam' when starts_with(url, 'https://blog.') then 'blog'
when starts_with(url, 'https') then 'secure' when contains(url, '?') then 'query' else 'other' end as category from pages""")
def p13(spark: SS, d: str) -> DataFrame:
    u = F.col("url")
    cat_ = C.first_match([(u.contains("spam"), "spam"), (u.startswith("https://blog."), "blog"),
                          (u.startswith("https"), "secure"), (u.contains("?"), "query")], "other")
    return tbl(spark, d, "pages", "page_id", "url").select("page_id", cat_.alias("category"))


@query("P14_simple_case", """
select event_id, case event_type when 'error' then 3 when 'purchase' then 2 when 'signup' then 1 else 0 end as severity
from events""")
def p14(spark: SS, d: str) -> DataFrame:
    t = F.col("event_type")
    sev = F.when(t == "error", 3).when(t == "purchase", 2).when(t == "signup", 1).otherwise(0)
    return ev(spark, d).select("event_id", sev.alias("severity"))


@query("P15_nested_if", """
select o_orderkey, if(o_orderstatus = 'F', 'paid', if(o_orderstatus = 'O', 'open', 'partial')) as status from orders""")
def p15(spark: SS, d: str) -> DataFrame:
    s = F.col("o_orderstatus")
    return tbl(spark, d, "orders", "o_orderkey", "o_orderstatus").select(
        "o_orderkey", F.when(s == "F", "paid").otherwise(F.when(s == "O", "open").otherwise("partial")).alias("status"))


@query("P16_filter_on_alias", """
select * from (select user_id, round(value * 10, 6) as v from events) where v > 900""")
def p16(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("user_id", r6(F.col("value") * 10).alias("v")).where(F.col("v") > 900)


@query("P17_version_string_compare", """
select event_id, strftime(ts, '%Y.%m.%d.%H.%M') as version from events
where length(strftime(ts, '%Y.%m.%d.%H.%M')) = 16 and strftime(ts, '%Y.%m.%d.%H.%M') > '2024.01.15.12.00'""")
def p17(spark: SS, d: str) -> DataFrame:
    v = F.date_format("ts", "yyyy.MM.dd.HH.mm")
    return ev(spark, d).select("event_id", v.alias("version")) \
        .where((F.length("version") == 16) & (F.col("version") > "2024.01.15.12.00"))


@query("P18_latest_version_filter", """
select event_id, user_id from events
where cast(nullif(regexp_extract(props, '(\\d+)', 1), '') as integer) =
 (select max(cast(nullif(regexp_extract(props, '(\\d+)', 1), '') as integer)) from events)""")
def p18(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("version", version_of())
    cur = e.agg(F.max("version").alias("__cur"))  # one row
    return e.crossJoin(F.broadcast(cur)).where(F.col("version") == F.col("__cur")).select("event_id", "user_id")


# =============================================================== 2.3 joins
@query("J01_inner_equi", """
select o.o_orderkey, c.c_name from orders o join customer c on o.o_custkey = c.c_custkey
where o.o_orderstatus = 'O'""")
def j01(spark: SS, d: str) -> DataFrame:
    o = tbl(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus").where(F.col("o_orderstatus") == "O")
    c = tbl(spark, d, "customer", "c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name")


@query("J02_left_single_key", """
with spine as (select distinct cast(ts as date) as date from events),
errs as (select cast(ts as date) as date, count(*) as errors from events where event_type = 'error' and value > 45 group by 1)
select s.date, coalesce(e.errors, 0) as errors from spine s left join errs e on s.date = e.date""")
def j02(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    spine = e.select(F.to_date("ts").alias("date")).distinct()
    errs = (e.where((F.col("event_type") == "error") & (F.col("value") > 45))
             .groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("errors")))
    return spine.join(errs, "date", "left").select("date", F.coalesce("errors", F.lit(0)).alias("errors"))


@query("J03_left_composite_key", """
with v as (select user_id, cast(ts as date) as date, count(*) as views from events where event_type = 'view' group by 1, 2),
e as (select user_id, cast(ts as date) as date, count(*) as errors from events where event_type = 'error' group by 1, 2)
select v.user_id, v.date, v.views, coalesce(e.errors, 0) as errors from v left join e on v.user_id = e.user_id and v.date = e.date""")
def j03(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("date", F.to_date("ts"))
    v = e.where(F.col("event_type") == "view").groupBy("user_id", "date").agg(F.count(F.lit(1)).alias("views"))
    x = e.where(F.col("event_type") == "error").groupBy("user_id", "date").agg(F.count(F.lit(1)).alias("errors"))
    return v.join(x, ["user_id", "date"], "left").select("user_id", "date", "views",
                                                       F.coalesce("errors", F.lit(0)).alias("errors"))


@query("J04_bare_outer_as_left", """
with up as (select cast(ts as date) as date, count(distinct user_id) as up from events where event_type = 'view' group by 1),
down as (select cast(ts as date) as date, count(distinct user_id) as down from events where event_type = 'error' and value > 90 group by 1)
select up.date, up.up, coalesce(down.down, 0) as down from up left join down on up.date = down.date""")
def j04(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("date", F.to_date("ts"))
    up = e.where(F.col("event_type") == "view").groupBy("date").agg(F.count_distinct("user_id").alias("up"))
    dn = e.where((F.col("event_type") == "error") & (F.col("value") > 90)).groupBy("date") \
          .agg(F.count_distinct("user_id").alias("down"))
    return up.join(dn, "date", "left").select("date", "up", F.coalesce("down", F.lit(0)).alias("down"))


@query("J05_join_using", """
with a as (select cast(ts as date) as date, count(*) as n_events from events group by 1),
b as (select cast(ts as date) as date, count(distinct user_id) as n_users from events group by 1)
select date, n_events, n_users from a join b using (date)""")
def j05(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("date", F.to_date("ts"))
    a = e.groupBy("date").agg(F.count(F.lit(1)).alias("n_events"))
    b = e.groupBy("date").agg(F.count_distinct("user_id").alias("n_users"))
    return a.join(b, on="date").select("date", "n_events", "n_users")


@query("J06_latest_by_self_join_ties", """
select o.o_custkey, o.o_orderkey, o.o_orderdate from orders o
join (select o_custkey, max(o_orderdate) as m from orders group by 1) x on o.o_custkey = x.o_custkey and o.o_orderdate = x.m""")
def j06(spark: SS, d: str) -> DataFrame:
    o = tbl(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    return latest_by(o, "o_custkey", "o_orderdate", ties="keep")


@query("J07_existence_semi", """
select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'O' group by 1)""")
def j07(spark: SS, d: str) -> DataFrame:
    c = tbl(spark, d, "customer", "c_custkey", "c_name")
    ok = tbl(spark, d, "orders", "o_custkey", "o_orderstatus").where(F.col("o_orderstatus") == "O") \
        .select(F.col("o_custkey").alias("c_custkey"))
    return J.semi(c, ok, "c_custkey")


@query("J08_in_subquery", """
select event_id from events where user_id in (select user_id from events where event_type = 'purchase' and value > 95)""")
def j08(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    buyers = e.where((F.col("event_type") == "purchase") & (F.col("value") > 95)).select("user_id")
    return J.semi(e.select("event_id", "user_id"), buyers, "user_id").select("event_id")


@query("J09_not_in_null_aware", """
select event_id from events where user_id not in
 (select case when value > 99.9 then null else user_id end from events where event_type = 'purchase' and cast(ts as date) = date '2024-01-30')""")
def j09(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    sub = cat.read_events(e, YESTERDAY, YESTERDAY).where(F.col("event_type") == "purchase") \
        .select(F.when(F.col("value") > 99.9, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"))
    return J.not_in(e.select("event_id", "user_id"), sub, "user_id").select("event_id")


@query("J10_correlated_in", """
select e.event_id from events e where e.event_type = 'error' and e.user_id in
 (select v.user_id from events v where v.event_type = 'view' and cast(v.ts as date) = cast(e.ts as date))""")
def j10(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("date", F.to_date("ts"))
    views = e.where(F.col("event_type") == "view").select("user_id", "date")
    return J.semi(e.where(F.col("event_type") == "error"), views, ["user_id", "date"]).select("event_id")


@query("J11_correlated_not_exists", """
select c.c_custkey from customer c where not exists
 (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderstatus = 'F' and o.o_totalprice > 100000)""")
def j11(spark: SS, d: str) -> DataFrame:
    c = tbl(spark, d, "customer", "c_custkey")
    big = tbl(spark, d, "orders", "o_custkey", "o_orderstatus", "o_totalprice") \
        .where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)) \
        .select(F.col("o_custkey").alias("c_custkey"))
    return J.anti(c, big, "c_custkey")


@query("J12_in_disjunction", """
select event_id from events where user_id in (select user_id from events where event_type = 'purchase' and value > 98)
 or user_id in (select user_id from events where event_type = 'signup' and value < 1)""")
def j12(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    a = e.where((F.col("event_type") == "purchase") & (F.col("value") > 98))
    b = e.where((F.col("event_type") == "signup") & (F.col("value") < 1))
    return J.semi_any(e.select("event_id", "user_id"), [a, b], "user_id").select("event_id")


@query("J13_composite_semi_anti", """
with cfg as (select distinct user_id, cast(ts as date) as date from events where event_type = 'view')
select 'semi' as kind, count(*) as n from events e where e.event_type = 'error' and exists
 (select 1 from cfg where cfg.user_id = e.user_id and cfg.date = cast(e.ts as date))
union all
select 'anti' as kind, count(*) as n from events e where e.event_type = 'error' and not exists
 (select 1 from cfg where cfg.user_id = e.user_id and cfg.date = cast(e.ts as date))""")
def j13(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("date", F.to_date("ts"))
    cfg = e.where(F.col("event_type") == "view").select("user_id", "date")
    errs = e.where(F.col("event_type") == "error")
    s = J.semi(errs, cfg, ["user_id", "date"]).agg(F.count(F.lit(1)).alias("n")).select(F.lit("semi").alias("kind"), "n")
    a = J.anti(errs, cfg, ["user_id", "date"]).agg(F.count(F.lit(1)).alias("n")).select(F.lit("anti").alias("kind"), "n")
    return s.unionByName(a)


@query("J14_scalar_subquery_share", """
select event_id, round(value / (select sum(value) from events where event_type = 'purchase') * 100, 6) as share
from events where event_type = 'purchase'""")
def j14(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).where(F.col("event_type") == "purchase")
    tot = e.agg(F.sum("value").alias("__tot"))  # one row
    return e.crossJoin(F.broadcast(tot)).select("event_id", r6(F.col("value") / F.col("__tot") * 100).alias("share"))


@query("J15_cross_join_one_row_aggs", """
select a.users, b.orders, c.customers from (select count(distinct user_id) as users from events) a,
(select count(*) as orders from orders) b, (select count(*) as customers from customer) c""")
def j15(spark: SS, d: str) -> DataFrame:
    a = ev(spark, d).agg(F.count_distinct("user_id").alias("users"))
    b = tbl(spark, d, "orders", "o_orderkey").agg(F.count(F.lit(1)).alias("orders"))
    c = tbl(spark, d, "customer", "c_custkey").agg(F.count(F.lit(1)).alias("customers"))
    return a.crossJoin(b).crossJoin(c)


@query("J16_left_join_on_true", """
select a.total, b.recommended from (select count(distinct user_id) as total from events) a
left join (select count(distinct user_id) as recommended from events where event_type = 'purchase') b on true""")
def j16(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    a = e.agg(F.count_distinct("user_id").alias("total"))
    b = e.where(F.col("event_type") == "purchase").agg(F.count_distinct("user_id").alias("recommended"))
    return a.join(b, F.lit(True), "left")


@query("J17_calendar_range_join", """
with cal as (select distinct cast(date_trunc('week', o_orderdate) as date) as start_date,
 cast(date_trunc('week', o_orderdate) as date) + interval 7 day as end_date from orders)
select cal.start_date, count(*) as orders from orders o join cal
 on o.o_orderdate >= cal.start_date and o.o_orderdate < cal.end_date group by 1""")
def j17(spark: SS, d: str) -> DataFrame:
    o = tbl(spark, d, "orders", "o_orderkey", "o_orderdate")
    s, e = TU.period_bounds("o_orderdate", "week")
    cal = o.select(s.alias("start_date"), e.alias("end_date")).distinct()
    j = J.join_calendar(o, cal, "o_orderdate", "start_date", "end_date", grain="week")
    return j.groupBy("start_date").agg(F.count(F.lit(1)).alias("orders"))


# 25 overlapping periods that are no truncation: each nation's starts at 06:00 and ends at noon or later
@query("J17b_calendar_period_join", """
with p as (select n_nationkey, timestamp '1995-01-01 06:00:00' + to_days((n_nationkey * 41)::integer) as starts,
 timestamp '1995-01-01 12:00:00' + to_days((n_nationkey * 41 + 20 * (n_nationkey % 9) + 1)::integer) as ends from nation)
select p.n_nationkey, count(*) as orders, round(sum(o_totalprice), 2) as total from orders o
join p on o.o_orderdate >= p.starts and o.o_orderdate < p.ends group by 1""")
def j17b(spark: SS, d: str) -> DataFrame:
    day = F.lit(dt.datetime(1995, 1, 1)).cast("timestamp_ntz")
    k = F.col("n_nationkey").cast("int")
    p = tbl(spark, d, "nation", "n_nationkey").select(
        "n_nationkey", (day + F.make_dt_interval(k * 41, F.lit(6))).alias("starts"),
        (day + F.make_dt_interval(k * 41 + 20 * (k % 9) + 1, F.lit(12))).alias("ends"))
    o = tbl(spark, d, "orders", "o_orderdate", "o_totalprice")
    return J.join_calendar(o, p, "o_orderdate", "starts", "ends").groupBy("n_nationkey").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("J18_lookback_join_fanout", """
select e.event_id, e.user_id, count(v.event_id) as matches
from events e left join events v on v.user_id = e.user_id and v.event_type = 'view'
 and v.ts <= e.ts and v.ts > e.ts - interval 6 hour
where e.event_type = 'error' group by 1, 2""")
def j18(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    errs = e.where(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    views = e.where(F.col("event_type") == "view").select("user_id", "ts")
    return J.lookback_count(errs, views, "user_id", 6 * 3600).select("event_id", "user_id", "matches")


@query("J19_asof_join", """
select e.event_id, v.ts as cfg_ts, round(v.value, 6) as cfg_value
from events e left join lateral (select v.ts, v.value from events v where v.user_id = e.user_id
 and v.event_type = 'view' and v.ts < e.ts order by v.ts desc, v.event_id desc limit 1) v on true
where e.event_type = 'error'""")
def j19(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    errs = e.where(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    views = e.where(F.col("event_type") == "view").select("user_id", "ts", "value", F.col("event_id").alias("vid"))
    j = J.asof_join(errs, views, "user_id", right_cols=["value"], tie="vid", strict=True, prefix="cfg_")
    return j.select("event_id", "cfg_ts", r6("cfg_value").alias("cfg_value"))


@query("J20_date_spine_cast_mismatch", """
with spine as (select distinct cast(ts as date) as date from events),
u as (select strftime(ts, '%Y-%m-%d') as usage_date, count(*) as n from events where event_type = 'click' group by 1)
select s.date, coalesce(u.n, 0) as clicks from spine s left join u on cast(u.usage_date as date) = s.date""")
def j20(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    spine = e.select(F.to_date("ts").alias("date")).distinct()
    u = (e.where(F.col("event_type") == "click").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("usage_date"))
          .agg(F.count(F.lit(1)).alias("n")))
    j = spine.join(u, F.to_date(u.usage_date) == spine.date, "left")
    return j.select("date", F.coalesce("n", F.lit(0)).alias("clicks"))


def _order_lines(spark: SS, d: str) -> DataFrame:
    """Orders with their line items as an array<struct> (nested fixture from lineitem)."""
    li = tbl(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(
        F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("lines"))


LINES_SQL = """(select l_orderkey, list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_quantity': l_quantity}
 order by l_linenumber, l_partkey, l_quantity) as lines from lineitem group by 1)"""


@query("J21_array_unnest", f"""
select o.l_orderkey, u.x.l_linenumber as l_linenumber, u.x.l_quantity as l_quantity
from {LINES_SQL} o, (select unnest(o.lines) as x) u""")
def j21(spark: SS, d: str) -> DataFrame:
    o = _order_lines(spark, d)
    x = o.select("l_orderkey", F.explode("lines").alias("x"))
    return x.select("l_orderkey", "x.l_linenumber", "x.l_quantity")


@query("J22_anti_via_left_join_kind", """
with del as (select distinct user_id, case when value > 50 then 'Display' else 'Company' end as kind
 from events where event_type = 'signup' and cast(ts as date) = date '2024-01-30')
select e.event_id from events e left join del on e.user_id = del.user_id
where e.event_type = 'error' and (del.kind is null or del.kind <> 'Display')""")
def j22(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    dele = (cat.read_events(e, YESTERDAY, YESTERDAY).where(F.col("event_type") == "signup")
            .select("user_id", F.when(F.col("value") > 50, "Display").otherwise("Company").alias("kind")).distinct())
    j = e.where(F.col("event_type") == "error").join(dele, "user_id", "left")
    return j.where(F.col("kind").isNull() | (F.col("kind") != "Display")).select("event_id")


@query("J23_self_join_parent", """
select c.c_custkey, c.c_name, p.c_name as parent_name from customer c left join customer p on p.c_custkey = c.c_nationkey""")
def j23(spark: SS, d: str) -> DataFrame:
    c = tbl(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    p = c.select(F.col("c_custkey").alias("p_key"), F.col("c_name").alias("parent_name"))
    return c.join(p, c.c_nationkey == p.p_key, "left").select("c_custkey", "c_name", "parent_name")


# =============================================================== 2.4 aggregations
@query("A01_group_by_keys", """
select l_returnflag, l_linestatus, round(sum(l_quantity), 6) as sum_qty,
round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n from lineitem group by 1, 2""")
def a01(spark: SS, d: str) -> DataFrame:
    li = tbl(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        r6(F.sum("l_quantity")).alias("sum_qty"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),  # money: cents
        F.count(F.lit(1)).alias("n"))


@query("A02_global_aggregate", """
select count(*) as n, round(sum(value), 6) as total, round(avg(value), 6) as mean, min(ts) as first_ts from events""")
def a02(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).agg(F.count(F.lit(1)).alias("n"), r6(F.sum("value")).alias("total"),
                            r6(F.avg("value")).alias("mean"), F.min("ts").alias("first_ts"))


@query("A03_count_star_vs_col", """
select event_type, count(*) as n_rows, count(case when value > 50 then value end) as n_high from events group by 1""")
def a03(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("value") > 50, F.col("value"))).alias("n_high"))


@query("A04_exact_distinct", """
select cast(ts as date) as date, count(distinct user_id) as users from events group by 1""")
def a04(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy(F.to_date("ts").alias("date")).agg(F.count_distinct("user_id").alias("users"))


def distinct_users(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.01):
    """Exact by default; ``approx=True`` gives the HyperLogLog++ estimate."""
    return F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)


@query("A05_distinct_exact_default", """
select date_trunc('month', ts) as month, count(distinct user_id) as companies from events group by 1""")
def a05(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    return e.groupBy(F.date_trunc("month", "ts").cast("timestamp_ntz").alias("month")) \
            .agg(distinct_users(e, "user_id").alias("companies"))


@query("A06_distinct_of_expression", """
select count(distinct regexp_extract(url, '^https?://([^/]+)', 1)) as hosts from pages""")
def a06(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "pages", "url").agg(
        F.count_distinct(F.regexp_extract("url", r"^https?://([^/]+)", 1)).alias("hosts"))


@query("A07_conditional_distinct", """
select cast(ts as date) as date, count(distinct case when event_type = 'purchase' then user_id end) as buyers,
count(distinct case when event_type = 'signup' then user_id end) as signups from events group by 1""")
def a07(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("date", F.to_date("ts"))
    return distinct_counts(e, "date", "user_id", {"buyers": F.col("event_type") == "purchase",
                                                  "signups": F.col("event_type") == "signup"})


@query("A08_conditional_sum", """
select cast(ts as date) as date, cast(sum(case when event_type = 'signup' then 1 else 0 end) as bigint) as signups,
round(sum(case when value is null then 0 else value end), 6) as total from events group by 1""")
def a08(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy(F.to_date("ts").alias("date")).agg(
        F.sum(F.when(F.col("event_type") == "signup", 1).otherwise(0)).cast("long").alias("signups"),
        r6(F.sum(F.coalesce("value", F.lit(0.0)))).alias("total"))


@query("A09_avg_of_interval_distincts", """
with h as (select cast(ts as date) as date, hour(ts) as hr, count(distinct user_id) as users from events group by 1, 2)
select date, round(avg(users), 6) as avg_hourly_users from h group by 1""")
def a09(spark: SS, d: str) -> DataFrame:
    h = ev(spark, d).groupBy(F.to_date("ts").alias("date"), F.hour("ts").alias("hr")) \
        .agg(F.count_distinct("user_id").alias("users"))
    return h.groupBy("date").agg(r6(F.avg("users")).alias("avg_hourly_users"))


@query("A10_min_max_conditional", """
select user_id, min(ts) as first_seen, max(ts) as last_seen, min(case when event_type = 'purchase' then ts end) as first_purchase
from events group by 1""")
def a10(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy("user_id").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
        F.min(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("first_purchase"))


@query("A11_last_value_by_id", """
select user_id, arg_max(event_type, event_id) as last_event from events group by 1""")
def a11(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("last_event"))


@query("A12_string_agg_distinct", """
select user_id, array_to_string(list_sort(list_distinct(list(event_type))), ',') as types from events group by 1""")
def a12(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy("user_id").agg(C.sorted_distinct_join("event_type").alias("types"))


@query("A13_group_concat", """
select l_orderkey, array_to_string(list_sort(list(cast(l_linenumber as varchar))), ',') as lines from lineitem group by 1""")
def a13(spark: SS, d: str) -> DataFrame:
    li = tbl(spark, d, "lineitem", "l_orderkey", "l_linenumber")
    return li.groupBy("l_orderkey").agg(C.sorted_join(F.col("l_linenumber").cast("string")).alias("lines"))


@query("A14_ordered_string_agg", """
with parts as (select page_id, unnest(string_split(url, '/')) as piece,
 generate_subscripts(string_split(url, '/'), 1) as pos from pages)
select page_id, string_agg(piece, '/' order by pos) as rebuilt from parts group by 1""")
def a14(spark: SS, d: str) -> DataFrame:
    p = tbl(spark, d, "pages", "page_id", "url").select("page_id", F.posexplode(F.split("url", "/", -1)).alias("pos", "piece"))
    return p.groupBy("page_id").agg(C.ordered_join("piece", "pos", "/").alias("rebuilt"))


@query("A15_select_distinct", """
select distinct user_id, event_type from events""")
def a15(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("user_id", "event_type").distinct()


@query("A16_group_by_as_distinct", """
select user_id, cast(ts as date) as date from events group by 1, 2""")
def a16(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("user_id", F.to_date("ts").alias("date")).dropDuplicates()


@query("A17_having", """
select cast(ts as date) as date, user_id, count(*) as calls from events group by 1, 2
having count(*) > 20 * (1 + (day(cast(ts as date)) % 2))""")
def a17(spark: SS, d: str) -> DataFrame:
    g = ev(spark, d).groupBy(F.to_date("ts").alias("date"), "user_id").agg(F.count(F.lit(1)).alias("calls"))
    return g.where(F.col("calls") > 20 * (1 + F.dayofmonth("date") % 2))


@query("A18_two_level_aggregate", """
with per as (select user_id, cast(ts as date) as date, count(*) as n from events where event_type = 'error' group by 1, 2)
select date, count(*) as noisy_users, cast(sum(n) as bigint) as errors from per where n > 2 group by 1""")
def a18(spark: SS, d: str) -> DataFrame:
    per = ev(spark, d).where(F.col("event_type") == "error").groupBy("user_id", F.to_date("ts").alias("date")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return per.where(F.col("n") > 2).groupBy("date").agg(F.count(F.lit(1)).alias("noisy_users"),
                                                         F.sum("n").cast("long").alias("errors"))


@query("A19_ratio_null_default", """
with t as (select cast(ts as date) as date, count(*) as total from events group by 1),
e as (select cast(ts as date) as date, count(*) as err from events where event_type = 'error' and value > 80 group by 1)
select t.date, round((t.total - ifnull(e.err, 0)) / t.total * 100, 6) as pct from t left join e on t.date = e.date""")
def a19(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).withColumn("date", F.to_date("ts"))
    t = e.groupBy("date").agg(F.count(F.lit(1)).alias("total"))
    x = e.where((F.col("event_type") == "error") & (F.col("value") > 80)).groupBy("date").agg(F.count(F.lit(1)).alias("err"))
    return t.join(x, "date", "left").select("date", r6(C.pct_ok("total", "err")).alias("pct"))


@query("A20_share_of_total", """
with g as (select cast(ts as date) as date, event_type, sum(value) as v from events group by 1, 2)
select date, event_type, round(v / sum(v) over (partition by date), 6) as share from g""")
def a20(spark: SS, d: str) -> DataFrame:
    g = ev(spark, d).groupBy(F.to_date("ts").alias("date"), "event_type").agg(F.sum("value").alias("v"))
    # totals per date: one row per day; AQE broadcasts it at run time when small
    tot = g.groupBy("date").agg(F.sum("v").alias("__t"))
    return g.join(tot, "date").select("date", "event_type", r6(F.col("v") / F.col("__t")).alias("share"))


@query("A21_bool_to_int_sum", """
select cast(ts as date) as date, cast(sum(cast(value > 50 as integer)) as bigint) as high from events group by 1""")
def a21(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy(F.to_date("ts").alias("date")).agg(
        F.sum((F.col("value") > 50).cast("int")).cast("long").alias("high"))


# =============================================================== 2.5 windows
@query("W01_lead_next_event", """
select event_id, lead(event_id) over w as next_event_id, lead(event_type) over w as next_event_type,
(epoch_us(lead(ts) over w) - epoch_us(ts)) / 1e6 as secs
from events window w as (partition by user_id order by ts, event_id)""")
def w01(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).select("event_id", "user_id", "ts", "event_type")
    n = J.next_event(e, "user_id", ts="ts", tie="event_id", cols=["event_type"])
    secs = TU.micros_between("next_ts", "ts") / 1e6
    return n.select("event_id", "next_event_id", "next_event_type", secs.alias("secs"))


@query("W02_rank_top_per_group", """
with c as (select cast(ts as date) as date, event_type, count(*) as n from events group by 1, 2)
select date, event_type, n from (select *, rank() over (partition by date order by n desc) as rk from c) where rk = 1""")
def w02(spark: SS, d: str) -> DataFrame:
    c = ev(spark, d).groupBy(F.to_date("ts").alias("date"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    # per-date partitions hold one row per event type: bounded, tiny
    w = Window.partitionBy("date").orderBy(F.col("n").desc())
    return c.withColumn("rk", F.rank().over(w)).where(F.col("rk") == 1).drop("rk")


# =============================================================== 2.6 sort / limit
@query("O01_order_by_multi", """
select user_id, event_type, count(*) as n from events group by 1, 2 order by n desc, user_id asc, event_type""")
def o01(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("n").desc(), "user_id", "event_type")


@query("O02_custom_rank_order", """
select event_type, count(*) as n from events group by 1
order by case event_type when 'error' then 0 when 'purchase' then 1 else 2 end, event_type""")
def o02(spark: SS, d: str) -> DataFrame:
    t = F.col("event_type")
    return ev(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.when(t == "error", 0).when(t == "purchase", 1).otherwise(2), t)


@query("O03_order_by_length", """
select page_id, length(url) as url_len from pages order by length(url) desc, page_id""")
def o03(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "pages", "page_id", "url").select("page_id", F.length("url").cast("long").alias("url_len")) \
        .orderBy(F.col("url_len").desc(), "page_id")


@query("O04_top_k", """
select user_id, round(sum(value), 6) as total from events group by 1 order by total desc, user_id limit 10""")
def o04(spark: SS, d: str) -> DataFrame:
    g = ev(spark, d).groupBy("user_id").agg(r6(F.sum("value")).alias("total"))
    return g.orderBy(F.col("total").desc(), "user_id").limit(10)  # TakeOrderedAndProject


@query("O05_latest_n_dates", """
with g as (select cast(ts as date) as date, count(*) as n from events group by 1)
select * from g where date in (select date from g order by date desc limit 7)""")
def o05(spark: SS, d: str) -> DataFrame:
    g = ev(spark, d).groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return latest_n_dates(g, 7)


# =============================================================== 2.7 set operations
@query("U01_union_all", """
select user_id, ts from events where event_type = 'view' union all select user_id, ts from events where event_type = 'click'""")
def u01(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    return e.where(F.col("event_type") == "view").select("user_id", "ts") \
        .union(e.where(F.col("event_type") == "click").select("user_id", "ts"))


@query("U02_union_distinct", """
select user_id, cast(ts as date) as date from events where event_type = 'view'
union select user_id, cast(ts as date) as date from events where event_type = 'click'""")
def u02(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    a = e.where(F.col("event_type") == "view").select("user_id", F.to_date("ts").alias("date"))
    b = e.where(F.col("event_type") == "click").select("user_id", F.to_date("ts").alias("date"))
    return a.union(b).distinct()


@query("U03_union_by_name_null_fill", """
select event_id, user_id, props as event_details, null::double as value from events where event_type = 'signup'
union all select event_id, user_id, null::varchar as event_details, value from events where event_type = 'purchase'""")
def u03(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d)
    a = e.where(F.col("event_type") == "signup").select("event_id", "user_id", F.col("props").alias("event_details"))
    b = e.where(F.col("event_type") == "purchase").select("value", "user_id", "event_id")
    return a.unionByName(b, allowMissingColumns=True)


@query("U04_n_way_tagged_union", """
with u as (select 'orders' as source, o_totalprice as amount from orders
 union all select 'lineitem', l_extendedprice from lineitem
 union all select 'customer', c_acctbal from customer
 union all select 'supplier', s_acctbal from supplier
 union all select 'events', value from events)
select source, count(*) as n, round(sum(amount), 2) as amount from u group by 1""")
def u04(spark: SS, d: str) -> DataFrame:
    srcs = [("orders", "o_totalprice"), ("lineitem", "l_extendedprice"), ("customer", "c_acctbal"),
            ("supplier", "s_acctbal"), ("events", "value")]
    u = tag_union([(t, tbl(spark, d, t, F.col(c).alias("amount"))) for t, c in srcs])
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


# =============================================================== 2.8 date / time
@query("D01_as_of_parameter", """
select date '2024-01-31' as as_of, count(*) as n from events where cast(ts as date) = date '2024-01-31' - interval 1 day""")
def d01(spark: SS, d: str) -> DataFrame:
    e = cat.read_events(ev(spark, d), YESTERDAY, YESTERDAY)
    return e.agg(F.count(F.lit(1)).alias("n")).select(TU.as_of_date(AS_OF).alias("as_of"), "n")


@query("D02_date_of_ts", """select event_id, cast(ts as date) as date from events""")
def d02(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("event_id", F.to_date("ts").alias("date"))


@query("D03_date_add_sub", """
select event_id, cast(cast(ts as date) + interval 3 day as date) as plus3, cast(cast(ts as date) - interval 2 day as date) as minus2,
cast(cast(ts as date) + interval (-0) day as date) as same from events""")
def d03(spark: SS, d: str) -> DataFrame:
    dd = F.to_date("ts")
    return ev(spark, d).select("event_id", F.date_add(dd, 3).alias("plus3"), F.date_sub(dd, 2).alias("minus2"),
                               F.date_add(dd, -0).alias("same"))


@query("D04_legacy_date_add_units", """
select o_orderkey, o_orderdate + interval 1 day as d1, o_orderdate - interval 14 day as w2,
o_orderdate + interval 3 month as m3, o_orderdate - interval 1 year as y1, o_orderdate + interval 5 hour as h5 from orders""")
def d04(spark: SS, d: str) -> DataFrame:
    t = F.col("o_orderdate")
    return tbl(spark, d, "orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey", TU.shift(t, 1, "DAY").alias("d1"), TU.shift(t, -2, "WEEK").alias("w2"),
        TU.shift(t, 3, "MONTH").alias("m3"), TU.shift(t, -1, "YEAR").alias("y1"), TU.shift(t, 5, "HOUR").alias("h5"))


@query("D05_timestamp_sub_minutes", """select event_id, ts - interval 5 minute as ts_minus_5m from events""")
def d05(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("event_id", TU.shift("ts", -5, "MINUTE").alias("ts_minus_5m"))


@query("D06_timestamp_from_date_string", """
select event_id, cast(cast(ts as date) as timestamp) as midnight, cast(strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp) as parsed from events""")
def d06(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select(
        "event_id", F.to_date("ts").cast("timestamp_ntz").alias("midnight"),
        F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("parsed"))


@query("D07_epoch_micros", """
select event_id, epoch_us(ts) as us, make_timestamp(epoch_us(ts)) as back from events""")
def d07(spark: SS, d: str) -> DataFrame:
    us = TU.epoch_micros("ts")
    return ev(spark, d).select("event_id", us.alias("us"), TU.from_epoch_micros(us).alias("back"))


@query("D08_epoch_seconds", """
select event_id, floor(epoch(ts))::bigint as s, to_timestamp(floor(epoch(ts))::bigint)::timestamp as back from events""")
def d08(spark: SS, d: str) -> DataFrame:
    s = TU.epoch_seconds("ts")
    return ev(spark, d).select("event_id", s.alias("s"), TU.from_epoch_seconds(s).alias("back"))


@query("D09_truncate_day_week_month", """
select event_id, cast(date_trunc('day', ts) as date) as day, cast(date_trunc('week', ts) as date) as week,
cast(date_trunc('month', ts) as date) as month from events""")
def d09(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("event_id", F.to_date("ts").alias("day"), TU.week_start_monday("ts").alias("week"),
                               TU.month_start("ts").alias("month"))


@query("D10_field_extraction", """
select o_orderkey, year(o_orderdate)::bigint as y, month(o_orderdate)::bigint as m, day(o_orderdate)::bigint as d,
hour(o_orderdate)::bigint as h, dayofyear(o_orderdate)::bigint as doy from orders""")
def d10(spark: SS, d: str) -> DataFrame:
    t = F.col("o_orderdate")
    return tbl(spark, d, "orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey", F.year(t).cast("long").alias("y"), F.month(t).cast("long").alias("m"),
        F.dayofmonth(t).cast("long").alias("d"), F.hour(t).cast("long").alias("h"),
        F.dayofyear(t).cast("long").alias("doy"))


@query("D11_legacy_week", """
select o_orderkey, (floor((dayofyear(o_orderdate) + dayofweek(date_trunc('year', o_orderdate)) + 1 - 2) / 7) + 1)::bigint as week
from orders""")
def d11(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey", TU.legacy_week("o_orderdate").alias("week"))


@query("D12_ceil_doy_week", """
select o_orderkey, ceil(dayofyear(o_orderdate) / 7)::bigint as week from orders""")
def d12(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey", TU.ceil_week("o_orderdate").alias("week"))


@query("D13_format_date_patterns", """
select o_orderkey, strftime(o_orderdate, '%Y%m%d') as f1, strftime(o_orderdate, '%Y-%m-%d') as f2,
lpad(cast(day(o_orderdate) as varchar), 2, ' ') || strftime(o_orderdate, '-%b-%Y') as f3,
strftime(o_orderdate, '%b-%y') as f4, strftime(o_orderdate, '%d-%b') as f5 from orders""")
def d13(spark: SS, d: str) -> DataFrame:
    t = F.col("o_orderdate")
    return tbl(spark, d, "orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey", F.date_format(t, "yyyyMMdd").alias("f1"), F.date_format(t, "yyyy-MM-dd").alias("f2"),
        F.concat(TU.day_space_padded(t), F.date_format(t, "-MMM-yyyy")).alias("f3"),
        F.date_format(t, "MMM-yy").alias("f4"), F.date_format(t, "dd-MMM").alias("f5"))


@query("D14_datediff_days", """
select user_id, datediff('day', min(ts)::date, max(ts)::date)::bigint as active_days from events group by 1""")
def d14(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy("user_id").agg(
        F.datediff(F.to_date(F.max("ts")), F.to_date(F.min("ts"))).cast("long").alias("active_days"))


@query("D15_ts_diff_micros", """
select event_id, epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(ts) as age_us from events""")
def d15(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("event_id", TU.micros_between(TU.as_of_ts(AS_OF), "ts").alias("age_us"))


@query("D16_period_label", """
select distinct cast(date_trunc('week', o_orderdate) as date) as week_start,
strftime(cast(date_trunc('week', o_orderdate) as date) + interval 7 day - interval 1 microsecond, '%d-%b') as week_of from orders""")
def d16(spark: SS, d: str) -> DataFrame:
    ws = TU.week_start_monday("o_orderdate")
    return tbl(spark, d, "orders", "o_orderdate").select(
        ws.alias("week_start"), TU.period_label(ws, "WEEK", "dd-MMM").alias("week_of")).distinct()


@query("D17_time_of_day_null_test", """
select count(*) filter (where strftime(ts, '%H:%M:%S') is not null) as timed, count(*) filter (where strftime(ts, '%H:%M:%S') < '12:00:00') as morning from events""")
def d17(spark: SS, d: str) -> DataFrame:
    t = F.date_format("ts", "HH:mm:ss")
    return ev(spark, d).agg(F.count_if(t.isNotNull()).alias("timed"), F.count_if(t < "12:00:00").alias("morning"))


# =============================================================== 2.9 scalar functions
@query("F01_regexp_extract_null", """
select page_id, case when regexp_matches(url, '[?&]page=([^&#]*)') then regexp_extract(url, '[?&]page=([^&#]*)', 1) end as page,
case when regexp_matches(url, '[?&]ref=([^&#]*)') then regexp_extract(url, '[?&]ref=([^&#]*)', 1) end as ref from pages""")
def f01(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "pages", "page_id", "url").select(
        "page_id", C.url_param("url", "page").alias("page"), C.url_param("url", "ref").alias("ref"))


@query("F02_regexp_replace_backref", """
select doc_id, md5(regexp_replace(text, '([.!?]) +([A-Z])', '\\1\n\\2', 'g')) as digest,
length(regexp_replace(text, '([.!?]) +([A-Z])', '\\1\n\\2', 'g'))::bigint as n_chars from documents""")
def f02(spark: SS, d: str) -> DataFrame:
    out = F.regexp_replace("text", r"([.!?]) +([A-Z])", "$1\n$2")
    return tbl(spark, d, "documents", "doc_id", "text").select(
        "doc_id", F.md5(out).alias("digest"), F.length(out).cast("long").alias("n_chars"))


@query("F03_regexp_extract_all", """
select page_id, array_to_string(regexp_extract_all(url, '[a-z]+'), ',') as tokens from pages""")
def f03(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "pages", "page_id", "url").select(
        "page_id", F.array_join(F.regexp_extract_all("url", F.lit("[a-z]+"), 0), ",").alias("tokens"))


@query("F04_concat_null_propagating", """
select c_custkey, c_name || '-' || c_mktsegment as label,
case when c_acctbal < 0 then null else c_name end || '!' as maybe from customer""")
def f04(spark: SS, d: str) -> DataFrame:
    c = tbl(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return c.select("c_custkey", F.concat("c_name", F.lit("-"), "c_mktsegment").alias("label"),
                    F.concat(F.when(F.col("c_acctbal") >= 0, F.col("c_name")), F.lit("!")).alias("maybe"))


@query("F05_substr_zero_start", """
select page_id, substr(url, 1, 12) as head, substr(url, 16) as tail from pages""")
def f05(spark: SS, d: str) -> DataFrame:
    # SUBSTR(s, 0, n) behaves as start 1 in the reference and in Spark; emit 1
    return tbl(spark, d, "pages", "page_id", "url").select(
        "page_id", F.substring("url", 1, 12).alias("head"), F.expr("substr(url, 16)").alias("tail"))


@query("F06_left_right_lpad", """
select c_custkey, left(c_name, 4) as l4, right(c_name, 3) as r3, lpad(cast(c_nationkey as varchar), 3, '0') as nat from customer""")
def f06(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "customer", "c_custkey", "c_name", "c_nationkey").select(
        "c_custkey", F.left("c_name", F.lit(4)).alias("l4"), F.right("c_name", F.lit(3)).alias("r3"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("nat"))


@query("F07_lower_upper_trim", """
select c_custkey, lower(c_mktsegment) as seg, upper(c_name) as up, trim('  ' || c_name || ' ') as trimmed from customer""")
def f07(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").select(
        "c_custkey", F.lower("c_mktsegment").alias("seg"), F.upper("c_name").alias("up"),
        F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("trimmed"))


@query("F08_length_vs_bytes", """
select doc_id, length(text)::bigint as chars, strlen(text)::bigint as bytes from documents""")
def f08(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "documents", "doc_id", "text").select(
        "doc_id", F.length("text").cast("long").alias("chars"), F.octet_length("text").cast("long").alias("bytes"))


@query("F09_replace_literal", """select page_id, replace(url, 'example', 'ex') as short_url from pages""")
def f09(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "pages", "page_id", "url").select(
        "page_id", F.replace("url", F.lit("example"), F.lit("ex")).alias("short_url"))


@query("F10_strpos", """select page_id, strpos(url, '?')::bigint as q_pos from pages""")
def f10(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "pages", "page_id", "url").select("page_id", F.instr("url", "?").cast("long").alias("q_pos"))


@query("F11_format_fixed_decimals", """select event_id, printf('%.10f', value) as v10 from events""")
def f11(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("event_id", F.format_string("%.10f", "value").alias("v10"))


@query("F12_hex_roundtrip", """select c_custkey, decode(unhex(hex(c_name))) as name_back from customer""")
def f12(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "customer", "c_custkey", "c_name").select(
        "c_custkey", F.decode(F.unhex(F.hex("c_name")), "UTF-8").alias("name_back"))


@query("F13_safe_casts", """
select event_id, try_cast(substr(props, 7, 2) as integer)::bigint as k2, cast(user_id as varchar) as uid from events""")
def f13(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("event_id", F.substring("props", 7, 2).try_cast("int").cast("long").alias("k2"),
                               F.col("user_id").cast("string").alias("uid"))


@query("F14_ifnull_coalesce_nullif", """
select event_id, coalesce(nullif(event_type, 'click'), 'other') as kind, ifnull(nullif(user_id, 0), -1) as uid from events""")
def f14(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("event_id", F.coalesce(F.nullif("event_type", F.lit("click")), F.lit("other")).alias("kind"),
                               F.ifnull(F.nullif("user_id", F.lit(0)), F.lit(-1)).alias("uid"))


@query("F15_floor_ceil_round_div", """
select event_id, floor(value)::bigint as fl, ceil(value)::bigint as ce, round(value, 1) as r1, user_id // 7 as d7 from events""")
def f15(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("event_id", F.floor("value").cast("long").alias("fl"), F.ceil("value").cast("long").alias("ce"),
                               F.round("value", 1).alias("r1"), F.expr("user_id div 7").alias("d7"))


@query("F16_guarded_division", """
with g as (select user_id, count(*) filter (where event_type = 'error') as errs,
 count(*) filter (where event_type = 'view' and value > 80) as views from events group by 1)
select user_id, round(if(views > 0, errs / views, null), 6) as errs_per_view from g""")
def f16(spark: SS, d: str) -> DataFrame:
    g = ev(spark, d).groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("errs"),
        F.count_if((F.col("event_type") == "view") & (F.col("value") > 80)).alias("views"))
    return g.select("user_id", r6(C.safe_ratio("errs", "views")).alias("errs_per_view"))


@query("F17_array_offset_field", f"""
select l_orderkey, lines[1].l_partkey as first_part, lines[3].l_partkey as third_part from {LINES_SQL}""")
def f17(spark: SS, d: str) -> DataFrame:
    o = _order_lines(spark, d)
    return o.select("l_orderkey", C.element_at0("lines", 0)["l_partkey"].alias("first_part"),
                    C.element_at0("lines", 2)["l_partkey"].alias("third_part"))


@query("F18_array_concat_conditional", f"""
select l_orderkey, len(list_concat(case when len(lines) > 3 then [] else [x.l_partkey for x in lines] end,
 [x.l_linenumber::bigint for x in lines]))::bigint as n from {LINES_SQL}""")
def f18(spark: SS, d: str) -> DataFrame:
    o = _order_lines(spark, d)
    parts = F.transform("lines", lambda x: x["l_partkey"])
    nums = F.transform("lines", lambda x: x["l_linenumber"].cast("long"))
    return o.select("l_orderkey", F.size(C.concat_if_not(F.size("lines") > 3, parts, nums)).cast("long").alias("n"))


@query("F19_array_length_null", f"""
select o.o_orderkey, len(l.lines)::bigint as n_lines from orders o left join {LINES_SQL} l on l.l_orderkey = o.o_orderkey""")
def f19(spark: SS, d: str) -> DataFrame:
    o = tbl(spark, d, "orders", "o_orderkey")
    j = o.join(_order_lines(spark, d), o.o_orderkey == F.col("l_orderkey"), "left")
    return j.select("o_orderkey", C.array_length_or_null("lines").cast("long").alias("n_lines"))


@query("F20_unnest_with_offset", """
select page_id, pos - 1 as pos, piece from (select page_id, unnest(string_split(url, '/')) as piece,
 generate_subscripts(string_split(url, '/'), 1) as pos from pages)""")
def f20(spark: SS, d: str) -> DataFrame:
    p = tbl(spark, d, "pages", "page_id", "url").select("page_id", F.split("url", "/", -1).alias("parts"))
    from fleetlens.operators.nested import unnest
    return unnest(p, "parts", "piece", with_offset="pos").select("page_id", F.col("pos").cast("long").alias("pos"), "piece")


@query("F21_flatten_outer", f"""
select o.o_orderkey, x.l_linenumber as l_linenumber from orders o left join {LINES_SQL} l on l.l_orderkey = o.o_orderkey
left join lateral (select unnest(l.lines) as x) u on true""")
def f21(spark: SS, d: str) -> DataFrame:
    o = tbl(spark, d, "orders", "o_orderkey")
    j = o.join(_order_lines(spark, d), o.o_orderkey == F.col("l_orderkey"), "left")
    return j.select("o_orderkey", F.explode_outer("lines").alias("x")).select("o_orderkey", "x.l_linenumber")


@query("F22_array_index_among_first", f"""
select l_orderkey, coalesce(list_position([x.l_linenumber for x in lines], 2) between 1 and 2, false) as second_line_early from {LINES_SQL}""")
def f22(spark: SS, d: str) -> DataFrame:
    o = _order_lines(spark, d)
    return o.select("l_orderkey", C.among_first(F.transform("lines", lambda x: x["l_linenumber"]), F.lit(2), 2)
                    .alias("second_line_early"))


@query("F23_date_from_parts", """
select event_id, cast(year(ts) as varchar) || '-' || lpad(cast(month(ts) as varchar), 2, '0') || '-' || lpad(cast(day(ts) as varchar), 2, '0') as usage_date from events""")
def f23(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).select("event_id", TU.date_from_parts(F.year("ts"), F.month("ts"), F.dayofmonth("ts")).alias("usage_date"))


# =============================================================== 2.10 buckets
@query("T01_epoch_5min_buckets", """
select to_timestamp((floor(epoch(ts))::bigint // 300) * 300)::timestamp as bucket, count(*) as n from events group by 1""")
def t01(spark: SS, d: str) -> DataFrame:
    return ev(spark, d).groupBy(TU.epoch_bucket("ts", 300).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("T02_now_anchored_buckets", """
select floor((epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(ts)) / 600000000)::bigint as idx, count(*) as n,
count(distinct user_id) as users from events where ts > timestamp '2024-01-31 00:00:00' - interval 10 hour group by 1""")
def t02(spark: SS, d: str) -> DataFrame:
    now = dt.datetime(2024, 1, 31)
    e = ev(spark, d).where(F.col("ts") > TU.as_of_ts(now - dt.timedelta(hours=10)))
    return e.groupBy(TU.now_bucket("ts", now, 600_000_000).alias("idx")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("T03_now_anchored_12_day_period", """
select floor(datediff('day', cast(ts as date), date '2024-01-31') / 12)::bigint as period, count(*) as n,
cast(date '2024-01-31' - interval (12 * floor(datediff('day', cast(ts as date), date '2024-01-31') / 12)::bigint) day as date) as period_date
from events group by 1, 3""")
def t03(spark: SS, d: str) -> DataFrame:
    p = TU.day_period("ts", AS_OF, 12)
    g = ev(spark, d).groupBy(p.alias("period")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("period", "n", F.date_sub(TU.as_of_date(AS_OF), (F.col("period") * 12).cast("int")).alias("period_date"))


@query("T04_trailing_age_filter", """
select user_id, count(*) as n from events where epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(ts) < 3600000000 * 10 group by 1""")
def t04(spark: SS, d: str) -> DataFrame:
    e = ev(spark, d).where(F.col("ts") > TU.as_of_ts(dt.datetime(2024, 1, 30, 14)))
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("T05_period_bounds", """
select cast(date_trunc('month', o_orderdate) as date) as start_date,
cast(date_trunc('month', o_orderdate) + interval 1 month as date) as end_date, count(*) as orders from orders group by 1, 2""")
def t05(spark: SS, d: str) -> DataFrame:
    s, e = TU.period_bounds("o_orderdate", "MONTH")
    return tbl(spark, d, "orders", "o_orderdate").groupBy(s.alias("start_date"), e.alias("end_date")) \
        .agg(F.count(F.lit(1)).alias("orders"))


# =============================================================== 2.11 UDF surface
APP_SQL = "(case when c_acctbal > 0 then c_mktsegment || ': ' || c_name || ' ID: ' || cast(c_custkey as varchar) else c_mktsegment end)"


@query("X01_clean_up_event_app", f"""
select c_custkey, case when {APP_SQL} like '%: % ID: %' then regexp_replace({APP_SQL}, ':\\s.+\\sID: ', ': ') else {APP_SQL} end as event_app
from customer""")
def x01(spark: SS, d: str) -> DataFrame:
    c = tbl(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    app = F.when(F.col("c_acctbal") > 0, F.concat("c_mktsegment", F.lit(": "), "c_name", F.lit(" ID: "),
                                                  F.col("c_custkey").cast("string"))).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", C.clean_up_event_app(app).alias("event_app"))


@query("X02_url_decode", """select page_id, nullif(url_decode(url), '') as decoded from pages""")
def x02(spark: SS, d: str) -> DataFrame:
    return tbl(spark, d, "pages", "page_id", "url").select("page_id", C.url_decode("url").alias("decoded"))


@query("X03_total_licenses_default", """
select c_custkey, (coalesce(case when c_acctbal > 0 then c_nationkey end, 0) + coalesce(case when c_acctbal > 5000 then 1 end, 0))::bigint as licenses
from customer""")
def x03(spark: SS, d: str) -> DataFrame:
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    n = C.total_licenses(F.lit(None), F.lit(None), F.lit(None), F.lit(None), F.lit(None),
                         F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")),
                         F.when(F.col("c_acctbal") > 5000, F.lit(1)))
    return c.select("c_custkey", n.cast("long").alias("licenses"))
