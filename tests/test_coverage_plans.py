"""Jobs on widget schedules shuffle the lines of current presentations only (R84b, R109d/e, R110b)."""

import datetime as dt

import pytest

from fleetlens.operators import joins as J
from fleetlens.plans.coverage import presentations
from fleetlens.plans.registry import QUERIES, load_all
from fleetlens.plans.reports_companies import r108

load_all()
LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


@pytest.fixture
def tables(spark, tmp_path):
    def save(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    # 1 and 998 are versions of presentation 1; 2 is not in production; 3 comes twice; -5 and the key without a value stay apart
    save("orders", [(1, 7, "1-URGENT"), (998, 7, "2-HIGH"), (2, 7, "5-LOW"), (3, 8, "1-URGENT"), (3, 8, "3-MEDIUM"), (-5, 8, "2-HIGH"),
                    (None, 8, "1-URGENT")], "o_orderkey long, o_custkey long, o_orderpriority string")
    at = dt.datetime(1998, 5, 1)
    lines = [(1, 1), (998, 1), (998, 2), (998, 2), (2, 1), (3, 1), (3, None), (-5, 3), (None, 3), (4, 3)]
    save("lineitem", [(o, p, 9, n, 30.0, 0.0, 0.0, "N", "OF"[n % 2], at) for n, (o, p) in enumerate(lines)], LINE)
    save("customer", [(7, 5), (8, 6)], "c_custkey long, c_nationkey long")
    return str(tmp_path)


@pytest.fixture
def large(spark):
    """Plans as over tables too large for Spark to broadcast by itself."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_lines_of_current_presentations_are_nested(spark, tables, large):
    df = presentations(spark, tables)
    assert "SortMergeJoin" not in plan(df)
    got = {r["presentationId"]: sorted(p["id"] for p in r["placeholders"]) for r in df.collect()}
    assert got == {1: [1, 2, 3], 3: [5, 6], -5: [7]} and df.count() == 3


@pytest.mark.parametrize("name", ["R109d_no_content_by_widget_schedule", "R109e_content_gaps_by_widget_schedule"])
def test_lines_are_not_shuffled_to_be_joined(spark, sf_dir, large, name):
    assert "SortMergeJoin" not in plan(QUERIES[name](spark, sf_dir))


def test_items_are_chosen_before_they_meet_their_schedules(spark, tables, large):
    only = spark.createDataFrame([("1",), ("3",), ("3",), (None,)], "presentationId string")
    df = r108(spark, tables, only)
    assert "BroadcastHashJoin [presentationId" in plan(df)
    key = lambda r: tuple((v is not None, v) for v in r)
    want = J.semi(r108(spark, tables), only, "presentationId").select(*df.columns)
    got = sorted(map(tuple, df.collect()), key=key)
    assert got == sorted(map(tuple, want.collect()), key=key) and {r[0] for r in got} == {"1", "3"}


@pytest.mark.parametrize("name", ["R84b_white_screens_by_widget_gaps", "R110b_white_screen_by_widget_schedule"])
def test_presentations_with_gaps_choose_the_items(spark, sf_dir, large, name):
    assert "BroadcastHashJoin [presentationId" in plan(QUERIES[name](spark, sf_dir))
