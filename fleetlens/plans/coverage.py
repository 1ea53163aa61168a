"""Presentations with gaps, and displays with a white screen, due to widget schedules (R109, R110).

Binding: versions of a presentation are orders (version = order key, presentation = order key modulo
997, production = priority other than '5-LOW'); its placeholders are the order's line items (at most
seven, collected by order), with two items each whose dates, hours and recurrence follow from the line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators import joins as J
from fleetlens.operators.coverage import content_gaps, no_content, widget_coverage
from fleetlens.operators.dimensions import current
from fleetlens.plans.registry import query
from fleetlens.plans.reports_companies import PL_AS_OF, SCHED_SQL, displays, r108
from fleetlens.plans.tables import tbl

SS = SparkSession
DAY = PL_AS_OF

_LINE = {
    "timeDefined": "case l_returnflag when 'A' then true when 'R' then false end",
    "startDate": "case when l_linenumber % 5 = 0 then null else cast(l_shipdate as date) - 500 end",
    "endDate": "cast(l_shipdate as date) + 300",
    "visibility": "case when l_linestatus = 'O' then true when l_quantity < 10 then false end",
}
_ITEMS = [{
    "timeDefined": "l_discount > 0.005",
    "startDate": "cast(l_shipdate as date) - 400", "endDate": "case when l_suppkey % 9 = 0 then null else cast(l_shipdate as date) + 400 end",
    "startTime": "case when l_quantity >= 25 then '08:00:00' end", "endTime": "case when l_quantity >= 25 then '17:00:00' end",
    "recurrenceType": "case l_suppkey % 4 when 1 then 'Daily' when 2 then 'Weekly' when 3 then 'Monthly' end",
    "recurrenceFrequency": "l_linenumber % 2 + 1",
    "recurrenceDays": "case when l_tax < 0.04 then 7 else 5 end",
}, {
    "timeDefined": "case when l_tax > 0.005 then true end",
    "startDate": "cast(l_shipdate as date) - 100", "endDate": "cast(l_shipdate as date) + 700",
    "startTime": "'06:30:00'", "endTime": "case when l_partkey % 2 = 0 then '22:00:00' end",
    "recurrenceType": "case when l_partkey % 3 = 0 then 'Daily' else 'Weekly' end",
    "recurrenceFrequency": "1",
    "recurrenceDays": "7",
}]


def presentations(spark: SS, d: str) -> DataFrame:
    """Production presentations, nested: presentationId, placeholders array<struct<..., items array<struct>>>.

    The binding has 997 presentations (1,993 with negative keys) however many orders there are, so their
    current versions are broadcast, and only the lines of these are nested and shuffled.
    """
    def item(rules: dict[str, str]):
        days = F.expr(f"sequence(1, {rules['recurrenceDays']})").alias("recurrenceDaysOfWeek")
        return F.struct(*[F.expr(v).alias(n) for n, v in rules.items() if n != "recurrenceDays"], days)
    o = tbl(spark, d, "orders", "o_orderkey", "o_orderpriority").withColumn("presentationId", F.col("o_orderkey") % 997)
    live = current(o, "presentationId", "o_orderkey", F.col("o_orderpriority") != "5-LOW").select("o_orderkey", "presentationId")
    li = tbl(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate")
    placeholder = F.struct(F.col("l_linenumber").alias("id"), *[F.expr(v).alias(n) for n, v in _LINE.items()],
                           F.array(*[item(i) for i in _ITEMS]).alias("items"))
    x = li.join(F.broadcast(live), F.col("l_orderkey") == F.col("o_orderkey")).select("presentationId", "l_orderkey", placeholder.alias("p"))
    nested = x.groupBy("presentationId", "l_orderkey").agg(F.collect_list("p").alias("placeholders"))  # <= 7 lines per order
    return nested.select("presentationId", "placeholders")


def _items_sql() -> str:
    def cols(rules: dict[str, str], prefix: str) -> str:
        return ", ".join(f"{v} as {prefix}{n}" for n, v in rules.items())
    parts = [f"select pr.presentationId, {cols(_LINE, 'p_')}, {cols(i, 'i_')} from pr join lineitem on l_orderkey = pr.o_orderkey" for i in _ITEMS]
    seen = lambda p: (f"(({p}timeDefined = false or {p}timeDefined is null or ({p}timeDefined = true and ({p}startDate is null or "  # noqa: E731
                      f"date '{DAY}' >= {p}startDate) and ({p}endDate is null or date '{DAY}' <= {p}endDate))))")
    return f"""pr as (select o.o_orderkey % 997 as presentationId, o.o_orderkey from orders o join (select max(o_orderkey) as id from orders
 group by o_orderkey % 997) m on m.id = o.o_orderkey where o.o_orderpriority <> '5-LOW'),
items as ({' union all '.join(parts)}),
dp as (select * from items where {seen('p_')} and (p_visibility = true or p_visibility is null)),
di as (select * from dp where {seen('i_')}),
nothing as (select presentationId from dp where not exists (select 1 from di where di.presentationId = dp.presentationId) group by 1),
gaps as (select presentationId from di where not exists (select 1 from di x where x.presentationId = di.presentationId and (x.i_timeDefined = false
 or x.i_timeDefined is null or (x.i_timeDefined = true and x.i_startTime is null and x.i_endTime is null and (x.i_recurrenceType is null
 or (x.i_recurrenceType = 'Daily' and x.i_recurrenceFrequency = 1)
 or (x.i_recurrenceType = 'Weekly' and x.i_recurrenceFrequency = 1 and x.i_recurrenceDays = 7))))) group by 1)"""


@query("R109d_no_content_by_widget_schedule", f"with {_items_sql()} select presentationId from nothing")
def r109d(spark: SS, d: str) -> DataFrame:
    """Presentations whose visible placeholders hold items, none of which plays on the day."""
    return no_content(widget_coverage(presentations(spark, d), DAY)).select("presentationId")


@query("R109e_content_gaps_by_widget_schedule", f"with {_items_sql()} select presentationId from gaps")
def r109e(spark: SS, d: str) -> DataFrame:
    """Presentations that play something on the day, but nothing at all times."""
    return content_gaps(widget_coverage(presentations(spark, d), DAY)).select("presentationId")


@query("R110b_white_screen_by_widget_schedule", f"""
with {_items_sql()}, bad as (select cast(presentationId as varchar) as presentationId from nothing union all select cast(presentationId as varchar) from gaps)
select distinct unnest(s.distribution) as displayId from {SCHED_SQL} s where s.distributeToAll = false and len(s.distribution) > 0
 and s.presentationId in (select presentationId from bad)
union select c.c_custkey from customer c where c.c_nationkey in (select s.companyId from {SCHED_SQL} s
 where s.distributeToAll = true and s.presentationId in (select presentationId from bad))""")
def r110b(spark: SS, d: str) -> DataFrame:
    """Displays that show such a presentation: one pass over the presentations gives both kinds."""
    c = widget_coverage(presentations(spark, d), DAY)
    bad = c.where(F.col("has_items") & ~F.col("covered")).select(F.col("presentationId").cast("string").alias("presentationId"))
    r = r108(spark, d, bad)
    explicit = r.where(F.col("displayId").isNotNull()).select("displayId")
    companies = r.where(F.col("companyId").isNotNull()).select("companyId")
    return explicit.union(J.semi(displays(spark, d), companies, "companyId").select("displayId")).distinct()
