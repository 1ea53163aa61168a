"""Step matching, first dates, nested schedule coverage, rule tables and display records against plain loops."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlens.operators.coverage import content_gaps, no_content, widget_coverage
from fleetlens.operators.rules import Rule, daily_rule_counts, matched, matrix
from fleetlens.operators.steps import cohort_counts, daily_funnel, first_dates, match_steps
from fleetlens.plans import registry
from fleetlens.plans.check import compare
from fleetlens.plans.kinds import merge_displays

registry.load_all()
OTHER_DAY = dt.date(2024, 1, 16)
T0 = dt.datetime(2024, 1, 1)
DATED = ["R56b_upgrade_funnel", "R56c_module_upgrade_funnel", "R56d_upgrade_outcomes", "R103b_registration_funnel_daily",
         "R103c_registration_funnel_weekly_direct", "R104b_customer_journey_full", "R20b_widget_kinds", "R24b_error_lists",
         "R25b_unsupported_media", "R36b_deprecated_items", "R52b_display_records", "R112d_client_storage", "R22b_reliability_of_stable_displays",
         "R23b_widget_dashboard", "R71c_watchdog_reliability", "R72b_module_dashboard_full", "R75b_active_company_ratio_full",
         "R123e_daily_display_counts_ninety_days"]


@pytest.mark.parametrize("name", DATED)
def test_jobs_follow_the_evaluation_date(spark, duck, sf_dir, name):
    queries, oracles = registry.jobs(OTHER_DAY)
    got = compare(spark, duck, name, queries[name], oracles[name], sf_dir)
    assert got["ok"], got


# ------------------------------------------------------------------ ordered steps
@pytest.fixture(scope="module")
def attempts():
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        key = "hot" if rng.random() < 0.4 else f"d{rng.randint(0, 9)}"  # repeated starts, equal times, a hot key
        rows.append((i, key, T0 + dt.timedelta(seconds=rng.choice([rng.randint(0, 200_000), 3600 * rng.randint(0, 50)])),
                     rng.choice(["start", "start", "done", "fail", "noise"])))
    return rows + [(9001, None, T0, "start"), (9002, "d1", None, "start"), (9003, "lone", T0, "start"), (9004, "early", T0, "done")]


def test_starts_meet_what_follows_them(spark, attempts):
    by = defaultdict(list)
    for i, k, t, e in attempts:
        if k is not None and t is not None and e != "noise":
            by[k].append((t, i, e))
    want = []
    for k, rows in by.items():
        rows.sort()
        for (t, _, e), nxt in zip(rows, [*rows[1:], None]):
            if e == "start":
                kind = "open" if nxt is None else {"start": "repeated", "done": "completed", "fail": "failed"}[nxt[2]]
                want.append((k, t, kind, nxt[0] if kind in ("completed", "failed") else None))
    df = spark.createDataFrame(attempts, "id long, key string, ts timestamp_ntz, e string").repartition(5)
    got = match_steps(df, "key", start=F.col("e") == "start", completed=F.col("e") == "done", failed=F.col("e") == "fail", tie="id")
    assert got.columns == ["key", "ts", "outcome", "outcome_ts"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert {x[2] for x in want} == {"open", "repeated", "completed", "failed"}


def test_an_event_of_two_kinds_counts_as_its_first(spark):
    df = spark.createDataFrame([(1, "a", T0, "start"), (2, "a", T0 + dt.timedelta(1), "both")], "id long, key string, ts timestamp_ntz, e string")
    got = match_steps(df, "key", start=F.lit(True), completed=F.col("e") == "both", failed=F.col("e") == "both", tie="id").collect()
    assert [r["outcome"] for r in got] == ["failed"]
    assert match_steps(df.limit(0), "key", start=F.lit(True), completed=F.lit(False), failed=F.lit(False)).collect() == []


@pytest.mark.parametrize("needs,spoiled", [(None, None), ("start", None), (None, "fail")])
def test_daily_funnel(spark, attempts, needs, spoiled):
    days = defaultdict(lambda: defaultdict(set))
    for _, k, t, e in attempts:
        if t is not None:
            days[t.date()][k].add(e)
    want = []
    for day, ids in days.items():
        if any("start" in s for s in ids.values()):
            starts = sum("start" in s for k, s in ids.items() if k is not None)
            done = sum("done" in s and (needs is None or needs in s) and spoiled not in s for k, s in ids.items() if k is not None)
            want.append((day, starts, done or None))
    df = spark.createDataFrame(attempts, "id long, key string, ts timestamp_ntz, e string").where("ts is not null").withColumn("date", F.to_date("ts"))
    got = daily_funnel(df, "key", "date", start=F.col("e") == "start", done=F.col("e") == "done",
                       needs=None if needs is None else F.col("e") == needs, spoiled=None if spoiled is None else F.col("e") == spoiled)
    assert sorted(map(tuple, got.collect())) == sorted(want)


# ------------------------------------------------------------------ first dates
def test_first_dates_of_several_sources(spark):
    def day(n):
        return dt.datetime(2024, 1, n)
    a = spark.createDataFrame([(1, day(5), "x"), (1, day(3), "y"), (1, day(2), "x"), (2, day(9), "z"), (None, day(1), "x"), (3, None, "x")],
                              "c long, ts timestamp_ntz, e string")
    b = spark.createDataFrame([(1, day(7)), (4, day(8)), (4, day(6))], "c long, ts timestamp_ntz")
    got = first_dates({"a": a, "b": b}, "c", {"x": ("a", F.col("e") == "x"), "y": ("a", F.col("e") == "y"), "act": ("b", F.lit(True))})
    assert got.columns == ["c", "x", "y", "act"]
    assert {tuple(r) for r in got.collect()} == {(1, day(2), day(3), day(7)), (2, None, None, None), (3, None, None, None),
                                                 (4, None, None, day(6)), (None, day(1), None, None)}
    counts = cohort_counts(got.where("c is not null"), F.col("c") % 2, {"cnt_x": "x", "cnt_act": "act"}).collect()
    assert {tuple(r) for r in counts} == {(1, 2, 1, 1), (0, 2, 0, 1)}


# ------------------------------------------------------------------ nested schedule coverage
DAY = dt.date(2024, 5, 10)
TIMED = "timeDefined: boolean, startDate: date, endDate: date"
ITEM = (f"{TIMED}, startTime: string, endTime: string, recurrenceType: string, recurrenceFrequency: int, "
        "recurrenceDaysOfWeek: array<int>")
SCHEMA = f"presentationId long, placeholders array<struct<{TIMED}, visibility: boolean, items: array<struct<{ITEM}>>>>"


def shown(x):
    return not x[0] or ((x[1] is None or x[1] <= DAY) and (x[2] is None or DAY <= x[2]))


def always(i):
    return not i[0] or (i[3] is None and i[4] is None and (
        i[5] is None or (i[5] == "Daily" and i[6] == 1) or (i[5] == "Weekly" and i[6] == 1 and i[7] is not None and len(i[7]) == 7)))


def test_nested_coverage_equals_plain_loops(spark):
    rng = random.Random(21)
    before, after = DAY - dt.timedelta(3), DAY + dt.timedelta(3)

    def item():
        return (rng.choice([True, True, True, False, None]), rng.choice([None, before, DAY, after]), rng.choice([None, before, DAY, after]),
                rng.choice([None, None, "08:00"]), rng.choice([None, None, "17:00"]), rng.choice([None, "Daily", "Weekly", "Monthly"]),
                rng.choice([1, 1, 2, None]), rng.choice([None, [1, 2, 3], list(range(7))]))

    def placeholder():
        return (rng.choice([True, False, None]), rng.choice([None, before, after]), rng.choice([None, before, after]),
                rng.choice([True, True, False, None]), None if rng.random() < 0.1 else [item() for _ in range(rng.randint(0, 3))])
    rows = [(k, None if rng.random() < 0.05 else [placeholder() for _ in range(rng.randint(0, 3))]) for k in range(1200)]
    none, gaps = set(), set()
    for k, ps in rows:
        seen = [i for p in ps or [] if shown(p) and p[3] is not False for i in p[4] or []]
        playing = [i for i in seen if shown(i)]
        if seen and not playing:
            none.add(k)
        if playing and not any(always(i) for i in playing):
            gaps.add(k)
    assert len(none) > 20 and len(gaps) > 20
    c = widget_coverage(spark.createDataFrame(rows, SCHEMA), DAY)
    assert {r["presentationId"] for r in no_content(c).collect()} == none
    assert {r["presentationId"] for r in content_gaps(c).collect()} == gaps
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan


# ------------------------------------------------------------------ rule tables
RULES = [Rule("a", "e = 'use' and v < 5", ("e = 'bad' and v < 5", "e = 'worse'")), Rule("b", "e = 'use'", ("e = 'bad'",)), Rule("c", "e = 'never'")]


def test_rules_in_one_scan_equal_one_scan_each(spark):
    rng = random.Random(31)
    rows = [(rng.choice(["hot", *"xyz", None]), DAY + dt.timedelta(rng.randint(0, 4)), rng.choice(["use", "bad", "worse", "ok", None]),
             rng.choice([None, *range(10)])) for _ in range(700)] + [("only", DAY, "use", 1)]
    df = spark.createDataFrame(rows, "id string, date date, e string, v int").repartition(4)
    ok = {i for i, _, e, _ in rows if e == "ok"}
    tests = {"a": (lambda e, v: e == "use" and v is not None and v < 5, lambda e, v: e == "bad" and v is not None and v < 5 or e == "worse"),
             "b": (lambda e, v: e == "use", lambda e, v: e == "bad")}
    for eligible, ids in ((None, {i for i, *_ in rows}), (F.col("e") == "ok", ok)):
        want = set()
        for name, (use, bad) in tests.items():
            for day in {r[1] for r in rows}:
                u = {i for i, x, e, v in rows if x == day and i is not None and i in ids and use(e, v)}
                f = {i for i, x, e, v in rows if x == day and i in u and bad(e, v)}
                if u:
                    want.add((name, day, len(u), len(f)))
        assert {tuple(r) for r in daily_rule_counts(df, RULES, "id", eligible=eligible).collect()} == want
    plan = daily_rule_counts(df, RULES, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert sum(1 for r in matched(df, RULES, "kind", "failed").collect()) == sum(
        bad(e, v) for _, _, e, v in rows for _, bad in tests.values())


def test_matrix_names_the_items_of_a_key(spark):
    df = spark.createDataFrame([("x", "use", 1), ("x", "never", 9), ("y", "use", 7), ("z", "ok", 1)], "id string, e string, v int")
    assert {tuple(r) for r in matrix(df, RULES, "id").collect()} == {("x", "a", "b", "c", 3), ("y", None, "b", None, 1)}


# ------------------------------------------------------------------ display records
def test_records_of_both_sources_meet(spark):
    url = "/v2/viewer/display/{}?sig=1&os={}&pn={}&pv={}&z=1"
    requests = spark.createDataFrame([(url.format("d1", "win:10", "p", "1"), DAY), (url.format("d1", "win:10", "p", "1"), DAY),
                                      ("/v2/viewer/display/d2?sig=1&pn=p&pv=1", DAY), ("/v2/other/d3", DAY), (None, DAY),
                                      (url.format("d4", "l", "p", "2"), None)], "resource string, date date")
    viewers = spark.createDataFrame([("d1", DAY), ("d5", DAY), ("d5", DAY), ("d6", DAY), ("d7", DAY), (None, DAY)], "displayId string, date date")
    at = dt.datetime(2024, 5, 1)
    config = spark.createDataFrame([("d1", at, "mac", "q", "3", True), ("d5", at, "old", "q", "3", True), ("d5", at + dt.timedelta(1), "new", "q", "4", None),
                                    ("d5", at + dt.timedelta(1), "new", "q", "5", False), ("d6", at, None, "q", "3", True)],
                                   "displayId string, ts timestamp_ntz, os string, pn string, pv string, offline_subscription boolean")
    got = {tuple(r) for r in merge_displays(requests, viewers, config).collect()}
    assert got == {("d1", DAY, "win:10", "p", "1", None), ("d1", DAY, "mac", "q", "3", True), ("d5", DAY, "new", "q", "4", None),
                   ("d5", DAY, "new", "q", "5", False), ("d4", None, "l", "p", "2", None)}
