"""Upgrade funnels, upgrade durations, registration funnels and the customer journey (R56, R103, R104).

Bindings.  Upgrades: the start is a 'click' with a value under 20 or a 'signup' above 80, an install is
complete with a 'purchase', an upgrade fails with an 'error' above 90; the module manifest's launcher
line is the newest release line in the window.  Companies: users; creation = first 'signup',
test companies = negative balance, parent = nation, seven steps by event kind and payload; display
activations = 'purchase' events up to 60.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions import timeutil as TU
from fleetlens.operators.steps import cohort_counts, daily_funnel, first_dates, match_steps
from fleetlens.plans.registry import query
from fleetlens.plans.reports import D, W3_START, W7_START, ev, k_col, q
from fleetlens.plans.reports_uptime import LWEEK_SQL
from fleetlens.plans.rollups import rollup
from fleetlens.plans.tables import AS_OF, YESTERDAY, tbl
from fleetlens.sources import catalog as cat

SS = SparkSession
PARENT = 19

# ------------------------------------------------------------------ R56: upgrade funnels
START = "((event_type = 'click' and value < 20) or (event_type = 'signup' and value > 80))"
DONE = "event_type = 'purchase'"
FAILED = "(event_type = 'error' and value > 90)"
LIVE_ID = "cast(user_id as varchar) not like '0.%'"


def _sp(cond: str):
    return F.expr(cond.replace("varchar", "string"))


def _upgrade_sql(d0: dt.date | None, d1: dt.date) -> str:
    w = q(d0, d1)
    return f"""(select a.date, a.starts, b.completions from
 (select date, count(distinct user_id) as starts from {w} where {LIVE_ID} and {START} group by 1) a left join
 (select date, count(distinct user_id) as completions from {w} where {LIVE_ID} and {DONE} and cast(user_id as varchar) || date in
  (select cast(user_id as varchar) || date from {w} where {START}) group by 1) b on a.date = b.date)"""


@rollup("R56b_upgrade_funnel", f"""
select * from {_upgrade_sql(W3_START, AS_OF)} union all select * from {_upgrade_sql(None, W3_START)} where date < date '{W3_START}'""", start=W3_START)
def r56b(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Displays that start an upgrade, and those that complete an install on a day on which they started one."""
    w = cat.read_events(ev(spark, d), first, last).where(_sp(LIVE_ID))
    return daily_funnel(w, "user_id", "date", start=_sp(START), done=_sp(DONE), needs=_sp(START))


def _module_sql(d0: dt.date | None, d1: dt.date) -> str:
    w = q(d0, d1)
    on = f"{LIVE_ID} and k // 10 = (select max(k // 10) from {w})"
    return f"""(select a.date, a.starts, b.completions from
 (select date, count(distinct user_id) as starts from {w} where {on} and {START} group by 1) a left join
 (select date, count(distinct user_id) as completions from {w} where {on} and {DONE} and cast(user_id as varchar) || date not in
  (select cast(user_id as varchar) || date from {w} where user_id is not null and {FAILED}) group by 1) b on a.date = b.date)"""


@rollup("R56c_module_upgrade_funnel", f"""
select * from {_module_sql(W3_START, AS_OF)} union all select * from {_module_sql(None, W3_START)} where date < date '{W3_START}'""", start=W3_START)
def r56c(spark: SS, d: str, first: dt.date | None, last: dt.date) -> DataFrame:
    """Displays on the launcher's release that check for an upgrade, and those that complete an install on a
    day without an upgrade failure (of any release): completed = not failed."""
    w = cat.read_events(ev(spark, d), first, last).withColumn("line", F.floor(k_col() / 10))
    x = w.where(_sp(LIVE_ID)).crossJoin(F.broadcast(w.agg(F.max("line").alias("launcher"))))  # one row
    on = F.col("line") == F.col("launcher")
    return daily_funnel(x, "user_id", "date", start=on & _sp(START), done=on & _sp(DONE), spoiled=_sp(FAILED))


@query("R56d_upgrade_outcomes", f"""
with x as (select *, case when {FAILED} then 'failed' when {DONE} then 'completed' when {START} then 'start' end as kind
 from {q(W7_START, AS_OF)} where user_id is not null),
n as (select *, lead(kind) over (partition by user_id order by ts, event_id) as nk, lead(ts) over (partition by user_id order by ts, event_id) as nt
 from x where kind is not null)
select date, case when nk is null then 'open' when nk = 'start' then 'repeated' else nk end as outcome, count(*) as starts,
 round(avg(case when nk in ('completed', 'failed') then (epoch_us(nt) - epoch_us(ts)) / 1000000.0 end), 3) as avg_seconds
from n where kind = 'start' group by 1, 2""")
def r56d(spark: SS, d: str) -> DataFrame:
    """Upgrade attempts of the last week by outcome: each start with what its display reports next, and how long that took."""
    w = cat.read_events(ev(spark, d), W7_START, YESTERDAY)
    m = match_steps(w, "user_id", start=_sp(START), completed=_sp(DONE), failed=_sp(FAILED), tie="event_id")
    took = (TU.epoch_micros("outcome_ts") - TU.epoch_micros("ts")) / 1000000.0
    return m.groupBy(F.to_date("ts").alias("date"), "outcome").agg(
        F.count(F.lit(1)).alias("starts"), F.round(F.avg(took), 3).alias("avg_seconds"))


# ------------------------------------------------------------------ R103, R104: first dates of all milestones
STEPS = {
    "presentation": "event_type = 'view' and value < 10",
    "player_download": "event_type = 'click' and k < 20",
    "trial": "event_type = 'signup' and value > 80",
    "schedule": "event_type = 'click' and value > 70",
    "display": "event_type = 'view' and k >= 85",
    "subscribed": "event_type = 'purchase' and value > 60",
    "buy_player": "event_type = 'click' and k between 40 and 45",
}
ACTIVATED = "event_type = 'purchase' and value <= 60"
COUNTS = {"cnt_presentation_created": "presentation", "cnt_player_download": "player_download", "cnt_display_activated": "activated",
          "cnt_trial_started": "trial", "cnt_schedule_created": "schedule", "cnt_display_created": "display", "cnt_subscribed": "subscribed"}


def companies(spark: SS, d: str) -> DataFrame:
    """companyId, parentId, industry of companies that are no test."""
    c = tbl(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal").where(F.col("c_acctbal") >= 0)
    return c.select(F.col("c_custkey").alias("companyId"), F.col("c_nationkey").alias("parentId"), F.col("c_mktsegment").alias("industry"))


def milestones(spark: SS, d: str, start: dt.date | None, end: dt.date) -> DataFrame:
    """companyId, created and the first time of each step in [start, end]; creations and activations of any time up to ``end``."""
    e = cat.read_events(ev(spark, d), None, end).withColumn("k", k_col()).select(
        F.col("user_id").alias("companyId"), "ts", "event_type", "value", "k")
    steps = cat.read_events(e, start, end)
    rules = {"created": ("registrations", F.expr("event_type = 'signup'")), "activated": ("activations", F.expr(ACTIVATED)),
             **{n: ("events", F.expr(c)) for n, c in STEPS.items()}}
    firsts = first_dates({"registrations": e.where("event_type = 'signup'"), "activations": e.where(ACTIVATED), "events": steps},
                         "companyId", rules)
    return firsts.where(F.col("created").isNotNull())


def milestones_sql(start: dt.date | None, end: dt.date) -> str:
    steps = ", ".join(f"(select min(ts) from {q(start, end)} e where e.user_id = r.companyId and {c}) as {n}" for n, c in STEPS.items())
    return f"""(select r.*, (select min(ts) from {q(None, end)} e where e.user_id = r.companyId and {ACTIVATED}) as activated, {steps}
 from (select user_id as companyId, min(ts) as created from {q(None, end)} where event_type = 'signup' and user_id is not null group by 1) r)"""


def _counts_sql(cohort: str, start: dt.date, more: str = "") -> str:
    return (f"select {cohort} as ts_registered, count(*) as cnt_registered, {', '.join(f'count({c}) as {n}' for n, c in COUNTS.items())} "
            f"from {milestones_sql(start, AS_OF)} m join customer c on c.c_custkey = m.companyId where c.c_acctbal >= 0 "
            f"and created > timestamp '{start}' {more} group by 1")


W60_START, W180_START = AS_OF - D(days=60), AS_OF - D(days=180)


@query("R103b_registration_funnel_daily", _counts_sql("cast(created as date)", W60_START))
def r103b(spark: SS, d: str) -> DataFrame:
    """Companies registered per day of the last two months, and how many of them reached each of seven steps."""
    m = milestones(spark, d, W60_START, YESTERDAY).where(F.col("created") > cat.day_start(W60_START))
    return cohort_counts(m.join(companies(spark, d), "companyId"), F.to_date("created"), COUNTS, "ts_registered")


@query("R103c_registration_funnel_weekly_direct", _counts_sql(
    f"cast(year(created) as varchar) || '-' || cast({LWEEK_SQL.replace('ts', 'created')} as varchar)", W180_START, f"and c.c_nationkey = {PARENT}"))
def r103c(spark: SS, d: str) -> DataFrame:
    """The same per week over six months, for direct customers only (one parent company)."""
    m = milestones(spark, d, W180_START, YESTERDAY).where(F.col("created") > cat.day_start(W180_START))
    direct = companies(spark, d).where(F.col("parentId") == PARENT)
    week = F.concat_ws("-", F.year("created").cast("string"), TU.legacy_week("created").cast("string"))
    return cohort_counts(m.join(direct, "companyId"), week, COUNTS, "ts_registered")


JOURNEY = {"presentation": "first_presentation", "display": "added_display", "buy_player": "buy_media_player",
           "activated": "first_display_activated", "subscribed": "subscribed"}


@query("R104b_customer_journey_full", f"""
select m.companyId, c.c_nationkey as parentId, c.c_mktsegment as industry, m.created as signup_date,
 {', '.join(f"m.{c} as {n}_date, datediff('day', m.created, m.{c})::bigint as {n}_days" for c, n in JOURNEY.items())}
from {milestones_sql(None, AS_OF)} m join customer c on c.c_custkey = m.companyId where c.c_acctbal >= 0""")
def r104b(spark: SS, d: str) -> DataFrame:
    """Every company's first date of each milestone and the days it took from the sign-up (negative if it came before)."""
    m = milestones(spark, d, None, YESTERDAY).join(companies(spark, d), "companyId")
    cols = []
    for c, n in JOURNEY.items():
        cols += [F.col(c).alias(f"{n}_date"), F.datediff(c, "created").cast("long").alias(f"{n}_days")]
    return m.select("companyId", "parentId", "industry", F.col("created").alias("signup_date"), *cols)
