"""Operator semantics on in-test fixtures (NULL traps, ties, hot keys) and brute-force checks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import timeutil as TU
from fleetlens.operators import joins as J
from fleetlens.operators.latest import latest_by
from fleetlens.operators.nested import allocate_cost, licensed_displays, snapshot_diff
from fleetlens.operators.reliability import daily_reliability, distinct_counts
from fleetlens.operators.rollup import pivot_metrics, splice_rollup
from fleetlens.sources import catalog as cat
from fleetlens.sources.schemas import SchemaError, conform
from fleetlens.sources.sinks import write_partitions

T0 = dt.datetime(2024, 1, 1)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ------------------------------------------------------------------ J09 NOT IN
def test_not_in_null_in_subquery_empties_result(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    right = spark.createDataFrame([(1,), (None,)], "k long")
    assert J.not_in(left, right, "k").count() == 0


def test_not_in_drops_null_probe_keeps_unmatched(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    right = spark.createDataFrame([(1,)], "k long")
    assert rows(J.not_in(left, right, "k"), "k") == [(2,)]


def test_not_in_empty_subquery_keeps_everything(spark):
    left = spark.createDataFrame([(1,), (None,)], "k long")
    right = spark.createDataFrame([], "k long")
    assert J.not_in(left, right, "k").count() == 2


def test_semi_plus_anti_is_whole(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(0, 100, 3).withColumnRenamed("id", "k")
    assert J.semi(left, right, "k").count() + J.anti(left, right, "k").count() == 100


# ------------------------------------------------------------------ R01 latest_by
def test_latest_by_keeps_ties_and_one(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, "w"), ("b", None, "v")],
                               "k string, v int, p string")
    assert rows(latest_by(df, "k", "v"), "k", "p") == [("a", "y"), ("a", "z"), ("b", "w")]
    one = latest_by(df, "k", "v", ties="one")
    assert rows(one, "k", "p") == [("a", "z"), ("b", "w")]


# ------------------------------------------------------------------ bucketed joins vs brute force
def _events(n, keys, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        # key 0 is hot: a third of all rows
        k = 0 if rnd.random() < 1 / 3 else rnd.choice(keys)
        if rnd.random() < 0.02:
            k = None
        t = T0 + dt.timedelta(seconds=rnd.randrange(0, 5 * 86400, 7))  # coarse grid -> equal timestamps
        out.append((i, k, t, rnd.random() < 0.5, float(rnd.randrange(100))))
    return out


@pytest.fixture(scope="module")
def evdata(spark):
    data = _events(1500, [1, 2, 3, 4, 5], 7)
    df = spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, is_left boolean, v double")
    return data, df


@pytest.mark.parametrize("strict", [True, False])
def test_asof_join_matches_brute_force(evdata, strict):
    data, df = evdata
    L = df.where("is_left").select("id", "k", "ts")
    R = df.where("not is_left").select("k", "ts", "v", F.col("id").alias("rid"))
    got = {r["id"]: (r["r_ts"], r["r_v"]) for r in
           J.asof_join(L, R, "k", right_cols=["v"], tie="rid", strict=strict, bucket_seconds=3 * 3600).collect()}
    rights = [x for x in data if not x[3]]
    for i, k, t, is_left, _ in data:
        if not is_left:
            continue
        cands = [(rt, rid, rv) for rid, rk, rt, _, rv in rights
                 if k is not None and rk == k and (rt < t if strict else rt <= t)]
        exp = (max(cands)[0], max(cands)[2]) if cands else (None, None)
        assert got[i] == exp, (i, k, t)


def test_lookback_count_matches_brute_force(evdata):
    data, df = evdata
    L = df.where("is_left").select("id", "k", "ts")
    R = df.where("not is_left").select("k", "ts")
    w = 5 * 3600
    got = {r["id"]: r["matches"] for r in J.lookback_count(L, R, "k", w, bucket_seconds=86400).collect()}
    rights = [x for x in data if not x[3]]
    for i, k, t, is_left, _ in data:
        if is_left:
            exp = sum(1 for _, rk, rt, _, _ in rights
                      if k is not None and rk == k and t - dt.timedelta(seconds=w) < rt <= t)
            assert got[i] == exp, (i, k, t)


def test_next_event_matches_window_lead(spark, evdata):
    _, df = evdata
    from pyspark.sql import Window
    got = J.next_event(df, "k", ts="ts", tie="id", cols=["v"], bucket_seconds=4 * 3600)
    w = Window.partitionBy("k").orderBy("ts", "id")
    exp = df.select("id", F.lead("id").over(w).alias("n"))
    assert rows(got.select("id", F.col("next_id").alias("n")), "id", "n") == rows(exp, "id", "n")


def test_expand_matches_multiplicity(spark):
    df = spark.createDataFrame([(1, 0), (2, 3)], "id long, matches long")
    assert J.expand_matches(df, "matches").count() == 4


# ------------------------------------------------------------------ reliability / pivot / rollup
def test_distinct_counts_one_pass(spark):
    df = spark.createDataFrame([("d1", 1, True), ("d1", 1, False), ("d1", 2, False), ("d1", None, True),
                                ("d2", 3, True)], "date string, id long, bad boolean")
    out = distinct_counts(df, "date", "id", {"total": F.lit(True), "failed": F.col("bad")})
    assert rows(out, "date", "total", "failed") == [("d1", 2, 1), ("d2", 1, 1)]


def test_daily_reliability_drops_failure_only_dates(spark):
    df = spark.createDataFrame([("d1", 1, "ok"), ("d2", 2, "err")], "date string, id long, e string")
    out = daily_reliability(df, "id", F.col("e") == "err", total=F.col("e") == "ok")
    assert rows(out, "date", "total", "failed", "pct") == [("d1", 1, 0, 100.0)]


def test_pivot_metrics_on_spine(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 20.0)], "date int, value double")
    b = spark.createDataFrame([(2, 5.0)], "date int, value double")
    spine = spark.createDataFrame([(1,), (2,), (3,)], "date int")
    out = pivot_metrics({"a": a, "b": b}, spine=spine)
    assert rows(out, "date", "a", "b") == [(1, 10.0, None), (2, 20.0, 5.0), (3, None, None)]


def test_splice_rollup_rewrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "rollup")
    hist = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in range(1, 6)], "date date, n long")
    write_partitions(hist, path, "date")
    fresh = spark.createDataFrame([(dt.date(2024, 1, 4), 40), (dt.date(2024, 1, 5), 50), (dt.date(2024, 1, 6), 60)],
                                  "date date, n long")
    for _ in range(2):  # a retried run must converge to the same table
        stored = spark.read.parquet(path)
        spliced = splice_rollup(fresh, stored, "date", dt.date(2024, 1, 4))
        assert rows(spliced, "date", "n")[-3:] == [(dt.date(2024, 1, 4), 40), (dt.date(2024, 1, 5), 50),
                                                  (dt.date(2024, 1, 6), 60)]
        write_partitions(fresh, path, "date")
    final = spark.read.parquet(path)
    assert final.count() == 6
    assert rows(final.where("date = '2024-01-04'"), "n") == [(40,)]


# ------------------------------------------------------------------ nested / cost / snapshot
def test_allocate_cost_sums_to_total(spark):
    units = spark.createDataFrame([("d", 1, 3), ("d", 2, 1), ("e", 1, 2)], "date string, id long, u long")
    pool = spark.createDataFrame([("d", 100.0), ("e", 7.0)], "date string, pool double")
    out = allocate_cost(units, "u", pool, "pool", by=["date"])
    tot = {r["date"]: r["s"] for r in out.groupBy("date").agg(F.sum("cost").alias("s")).collect()}
    assert tot == pytest.approx({"d": 100.0, "e": 7.0})


def test_licensed_displays_first_n(spark):
    subs = spark.createDataFrame([(1, 1, "Active", ["a", "b", "c"], 2), (2, 1, "Active", ["d", "e"], 1)],
                                 "c long, p long, s string, arr array<string>, n long")
    subs = subs.withColumn("na", F.lit(None).cast("long"))
    out = licensed_displays(subs, company_col="c", plan_company_col="p", status_col="s", assigned_col="arr",
                            license_args=["na", "na", "na", "na", "na", "n", "na"])
    assert rows(out, "companyId", "displayId", "licensedBy") == [(1, "a", 1), (1, "b", 1), (2, "d", 1)]


def test_snapshot_diff_null_safe(spark):
    s = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (2, "a", "y"), (2, "b", "x"), (2, "c", "z")],
                              "d int, k string, v string")
    assert rows(snapshot_diff(s, "d", ["k"], ["v"]), "k", "v") == [("a", "y"), ("c", "z")]


# ------------------------------------------------------------------ column helpers (Z-traps)
def test_regexp_extract_null_vs_empty(spark):
    df = spark.createDataFrame([("a?page=&x",), ("nothing",)], "u string")
    out = [r[0] for r in df.select(C.url_param("u", "page")).collect()]
    assert out == ["", None]


def test_url_decode_semantics(spark):
    df = spark.createDataFrame([("a%20b+c",), ("50%",), ("",), ("%C3%A9",), ("%FF",)], "u string")
    out = [r[0] for r in df.select(C.url_decode("u")).collect()]
    assert out == ["a b+c", "50", None, "é", "�"]


def test_clean_up_event_app(spark):
    df = spark.createDataFrame([("Widget: Weather ID: 42",), ("plain",)], "a string")
    assert [r[0] for r in df.select(C.clean_up_event_app("a")).collect()] == ["Widget: 42", "plain"]


def test_three_valued_predicates(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    got = df.select(C.is_true("b"), C.is_not_true("b"), C.is_false("b")).collect()
    assert [tuple(r) for r in got] == [(True, False, False), (False, True, True), (False, True, False)]


def test_three_week_definitions(spark):
    # 2017-01-01 is a Sunday, 2016-01-01 a Friday
    df = spark.createDataFrame([(dt.datetime(2017, 1, 1),), (dt.datetime(2017, 1, 8),), (dt.datetime(2016, 1, 2),),
                                (dt.datetime(2016, 1, 3),)], "t timestamp_ntz")
    got = df.select(TU.legacy_week("t"), TU.ceil_week("t"), TU.week_start_monday("t")).collect()
    assert [r[0] for r in got] == [1, 2, 1, 2]
    assert [r[1] for r in got] == [1, 2, 1, 1]
    assert got[0][2] == dt.date(2016, 12, 26)


def test_conform_required_column(spark):
    df = spark.createDataFrame([("x",)], "event string")
    with pytest.raises(SchemaError):
        conform(df, "installer_events")


# ------------------------------------------------------------------ plan properties
def test_date_range_reader_pushes_filters(spark, sf_dir):
    df = cat.read_events(spark.read.parquet(f"{sf_dir}/events.parquet"), "2024-01-10", "2024-01-12") \
        .select("user_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_no_python_udfs_in_registered_jobs(spark, sf_dir):
    from fleetlens.plans.registry import QUERIES, load_all
    load_all()
    for name, job in QUERIES.items():
        plan = job(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan, name


# scans of the event table: one pass for the counters (R53 adds one for each
# display's latest configuration), never one per counter or class
@pytest.mark.parametrize("name,scans", [("R53_installer_type_counts", 2), ("R77_player_reliability_stats", 1),
                                        ("R34_shared_schedule_uptime_wide", 1), ("R50_active_displays", 1)])
def test_one_pass_rewrites_scan_events_once(spark, sf_dir, name, scans):
    from fleetlens.plans.registry import QUERIES, load_all
    load_all()
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == scans, plan


def test_latest_by_has_no_window(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    for ties in ("keep", "one"):
        plan = latest_by(o, "o_custkey", "o_orderkey", ties=ties)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan


def test_first_n_per_key_hot_key_matches_brute_force(spark):
    from fleetlens.operators.latest import first_n_per_key
    rnd = random.Random(3)
    data = [(0 if rnd.random() < 1 / 3 else rnd.randrange(1, 20), i, rnd.randrange(10_000)) for i in range(3000)]
    nmap = {k: (k % 4) * 3 for k in range(20)}  # per-key n, 0 included
    df = spark.createDataFrame([(k, i, o, nmap[k]) for k, i, o in data], "k long, id long, o long, n long")
    got = rows(first_n_per_key(df, "k", ["o", "id"], F.col("n"), salts=8), "k", "id", "pos")
    exp = []
    for k in range(20):
        mine = sorted((o, i) for kk, i, o in data if kk == k)[:nmap[k]]
        exp += [(k, i, p) for p, (o, i) in enumerate(mine)]
    assert got == sorted(exp)


def test_join_calendar_of_overlapping_periods(spark):
    pts = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i)) for i in range(200)],
                                "id long, t timestamp_ntz")
    cal = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=d), dt.date(2024, 1, 1) + dt.timedelta(days=d + 10))
                                 for d in range(0, 60, 5)], "s date, e date")  # overlapping 10-day periods
    got = rows(J.join_calendar(pts, cal, "t", "s", "e"), "id", "s")
    exp = sorted((i, s) for i, t in [(r["id"], r["t"]) for r in pts.collect()]
                 for s, e in [(r["s"], r["e"]) for r in cal.collect()]
                 if dt.datetime.combine(s, dt.time()) <= t < dt.datetime.combine(e, dt.time()))
    assert got == exp
