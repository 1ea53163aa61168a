"""Evaluation date as a parameter, data outside the usual range, and NULL ids and times."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import joins as J
from fleetlens.operators.latest import first_n_per_key, latest_by
from fleetlens.plans import registry
from fleetlens.plans.check import TABLES, compare
from fleetlens.plans.schedule import DAILY_SUMMARIES, run_daily_summaries
from fleetlens.sources.sinks import write_partitions

OTHER_DAY = dt.date(2024, 1, 16)
DATED = ["R85_endpoint_uptime", "R86_daily_usage", "R87_daily_errors", "R88_daily_cost_attribution", "R33_daily_uptime",
         "R32_text_log_reliability", "R20_widget_stats_spliced", "R83_downtime_disconnection_with_issue", "R02_splice_rollup",
         "R121_daily_cycles_instances", "R42_segment_template_adoption", "R37_log_table_cost", "R53_installer_type_counts",
         "R75_daily_monthly_active_ratio", "R76_weekly_system_metrics", "R76b_weekly_metrics_by_platform",
         "R76c_weekly_metrics_fixed_fleet", "R77_player_reliability_stats", "R78_multiple_unreliable_starts", "R61_cache_daily_reliability"]
CHANGED = ["S12_conform_installer_family", "S13_conform_viewer_family", "R52_display_info_rollup", "R76_weekly_system_metrics",
           "R76b_weekly_metrics_by_platform", "R76c_weekly_metrics_fixed_fleet", "R20b_widget_kinds", "R56b_upgrade_funnel",
           "R56d_upgrade_outcomes", "R20_widget_stats_spliced", "R21_widget_stats_multi_branch", "R41_html_template_rollup", "R42_segment_template_adoption",
           "R58_player_module_stats", "R123c_core_client_noisy_display_counts", "R123_display_counts", "R33_daily_uptime",
           "R121_daily_cycles_instances", "W01_lead_next_event", "J18_lookback_join_fanout", "J19_asof_join"]


@pytest.mark.parametrize("name", DATED)
def test_jobs_follow_the_evaluation_date(spark, duck, sf_dir, name):
    queries, oracles = registry.jobs(OTHER_DAY)
    assert oracles[name] != registry.ORACLE[name]
    got = compare(spark, duck, name, queries[name], oracles[name], sf_dir)
    assert got["ok"], got


def test_default_set_is_left_alone(spark):
    before = registry.QUERIES["R33_daily_uptime"]
    registry.jobs(OTHER_DAY)
    registry.load_all()
    assert registry.QUERIES["R33_daily_uptime"] is before and registry.jobs(dt.date(2024, 1, 31))[0] is registry.QUERIES


def test_backfill_stores_the_day_it_computes(spark, sf_dir, tmp_path):
    out = str(tmp_path / "logs")
    for day in (dt.date(2024, 1, 30), dt.date(2024, 1, 15)):
        paths = run_daily_summaries(spark, sf_dir, out, day)
        queries, _ = registry.jobs(day + dt.timedelta(days=1))
        for table, job in DAILY_SUMMARIES.items():
            stored = spark.read.parquet(paths[table]).where(F.col("date") == F.lit(day))
            assert stored.count() == queries[job](spark, sf_dir).count() > 0
    assert {r["date"] for r in spark.read.parquet(paths["dailyUptime"]).select("date").distinct().collect()} == \
        {dt.date(2024, 1, 30), dt.date(2024, 1, 15)}


@pytest.fixture(scope="module")
def changed(spark, sf_dir, tmp_path_factory):
    """sf_dir with some events 45 days earlier (in 2023) and some without a user."""
    root = tmp_path_factory.mktemp("changed")
    for t in TABLES:
        if t != "events":
            os.symlink(f"{sf_dir}/{t}.parquet", root / f"{t}.parquet")
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    early = F.col("event_id") % 7 == 0
    (e.withColumn("ts", F.when(early, F.col("ts") - F.expr("interval 45 days")).otherwise(F.col("ts")))
     .withColumn("user_id", F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("user_id")))
     .write.parquet(str(root / "events.parquet")))
    return str(root)


@pytest.mark.parametrize("name", CHANGED)
def test_early_events_and_null_ids(spark, changed, name):
    got = compare(spark, _duck(changed), name, registry.QUERIES[name], registry.ORACLE[name], changed)
    assert got["ok"], got


def _duck(root):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{root}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def test_calendar_periods_within_days(spark):
    points = spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * k)) for k in range(16)], "id long, t timestamp_ntz")
    periods = [("a", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 12)), ("b", dt.datetime(2024, 1, 2, 6), dt.datetime(2024, 1, 2, 6, 1)),
               ("c", dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 3)), ("d", dt.datetime(2023, 12, 1), dt.datetime(2025, 1, 1)),
               ("e", None, dt.datetime(2024, 1, 3))]
    cal = spark.createDataFrame(periods, "p string, s timestamp_ntz, e timestamp_ntz")
    got = {(r["id"], r["p"]) for r in J.join_calendar(points, cal, "t", "s", "e").collect()}
    want = {(k, p) for k in range(16) for p, s, e in periods
            if s is not None and s <= dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * k) < e}
    assert got == want and J.join_calendar(points, cal, "t", "s", "e").count() == len(want)


def test_latest_by_treats_nulls_alike(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("b", 1, 1, "y"), ("b", 2, None, "z")], "k string, o1 int, o2 int, v string")
    for ties in ("one", "keep"):
        assert [tuple(r) for r in latest_by(df, "k", ["o1", "o2"], ties=ties).collect()] == [("b", 1, 1, "y")]


def test_next_event_of_rows_without_a_time(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 7, None), (2, 7, t), (3, 7, t + dt.timedelta(hours=5)), (4, None, None), (5, None, t)],
                               "id long, k long, ts timestamp_ntz")
    got = {r["id"]: r["next_id"] for r in J.next_event(df, "k", tie="id").collect()}
    assert got == {1: 2, 2: 3, 3: None, 4: 5, 5: None}


def test_null_keys_of_range_joins(spark):
    t = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, None, t), (2, 7, t)], "id long, k long, ts timestamp_ntz")
    right = spark.createDataFrame([(None, t - dt.timedelta(minutes=1), 1), (7, t - dt.timedelta(minutes=2), 2)], "k long, ts timestamp_ntz, v int")
    assert {r["id"]: r["matches"] for r in J.lookback_count(left, right, "k", 300).collect()} == {1: 0, 2: 1}
    assert {r["id"]: r["r_v"] for r in J.asof_join(left, right, "k", right_cols=["v"]).collect()} == {1: None, 2: 2}


@pytest.mark.parametrize("n", [1, 3, 900, 5000])
def test_first_n_of_a_hot_key(spark, n):
    rows = [("hot", (k * 7919) % 2003) for k in range(2003)] + [("b", k) for k in range(5)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k string, o long").repartition(4)
    got = {(r["k"], r["o"], r["pos"]) for r in first_n_per_key(df, "k", "o", n, salts=8).collect()}
    want = set()
    for k in ("hot", "b", None):
        want |= {(k, o, p) for p, o in enumerate(sorted(o for x, o in rows if x == k)[:n])}
    assert got == want


def test_one_day_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(60_000).select(F.lit(dt.date(2024, 1, 1)).alias("date"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_partitions(df.repartition(8), str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(tmp_path / "t" / "date=2024-01-01") if f.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(str(tmp_path / "t")).count() == 60_000
