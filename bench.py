"""Benchmark: run the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each job is timed end to end (plan + full execution) with Spark's ``noop`` sink,
which runs every stage and materialises every result row inside Spark without
converting rows to Python objects on the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "R71_content_reliability", "R03_daily_reliability", "R20_widget_stats_spliced", "R34_shared_schedule_uptime_wide",
    "R53_installer_type_counts", "R77_player_reliability_stats", "R122_display_costs", "J18_lookback_join_fanout",
    "J19_asof_join", "W01_lead_next_event", "R01_latest_by", "R16_snapshot_diff", "R85_endpoint_uptime",
    "A01_group_by_keys", "F02_regexp_replace_backref", "R108_presentations_on_displays",
]


def _naive_forms(spark, d):
    """The reference's multi-scan shapes of four views (one scan + one aggregation
    per counter, joined on date / cross-joined), to compare with the one-pass jobs."""
    from functools import reduce

    from pyspark.sql import functions as F

    from fleetlens.plans.reports import COMPONENTS, ev, k_col
    from fleetlens.plans.reports_uptime import PLAYER_COUNTERS

    def e():
        return ev(spark, d).withColumn("k", k_col())

    def per_date(cond, name):
        return e().where(F.expr(cond)).groupBy("date").agg(F.count_distinct("user_id").alias(name))

    def r77():
        parts = [per_date(c, n) for n, c in PLAYER_COUNTERS.items()]
        return reduce(lambda a, b: a.join(b, "date"), parts)

    def r53():
        from fleetlens.plans.reports_devices import CONFIG_CLASSES, REQUEST_CLASSES, installer_class_rows
        x = lambda: installer_class_rows(ev(spark, d), ev(spark, d))
        tot = x().groupBy("date").agg(F.count_distinct("user_id").alias("total"))
        parts = [x().where(F.col("req_cls") == n).groupBy("date").agg(F.count_distinct("user_id").alias(n))
                 for n, _ in REQUEST_CLASSES]
        parts += [x().where((F.col("cfg_cls") == n) & (F.col("latest_cls").isNull() | (F.col("latest_cls") == n)))
                  .groupBy("date").agg(F.count_distinct("user_id").alias(n)) for n, _ in CONFIG_CLASSES]
        return reduce(lambda a, b: a.join(b, "date", "left"), parts, tot)

    def r34():
        from fleetlens.plans.reports import SCHEDULE_ERROR_SQL, W8_START
        from fleetlens.plans.tables import AS_OF
        from fleetlens.sources import catalog as cat

        def one(cond, name):
            return cat.read_events(e(), W8_START, AS_OF).where(F.expr(cond)) \
                .agg(F.count_distinct("user_id").alias(name))
        parts = [one("true", "activeSharedSchedules"), one(SCHEDULE_ERROR_SQL, "sharedScheduleErrors")]
        for c in COMPONENTS:
            parts += [one(f"event_type = '{c}'", f"{c}Usage"),
                      one(f"event_type = '{c}' and {SCHEDULE_ERROR_SQL}", f"{c}Errors")]
        return reduce(lambda a, b: a.crossJoin(b), parts)

    def r122():
        parts = [e().where(F.expr(c)).groupBy("date").agg(F.count(F.lit(1)).alias(n)) for n, c in
                 [("cache_miss", "event_type = 'click' and value > 90"), ("display_requests", "event_type = 'view'"),
                  ("channel_updates", "event_type = 'signup'")]]
        parts.append(e().groupBy("date").agg((F.sum("value") / 3600).alias("instance_hours")))
        parts.append(e().groupBy("date").agg(F.count_distinct("user_id").alias("displays")))
        return reduce(lambda a, b: a.join(b, "date"), parts)

    from fleetlens.plans.registry import QUERIES
    from fleetlens.plans.rollups import ROLLUPS
    from fleetlens.plans.tables import YESTERDAY

    def whole(n):  # all days from raw events, as the multi-scan form
        return lambda: ROLLUPS[n].compute(spark, d, None, YESTERDAY)
    return {"R77_player_reliability_stats": (whole("R77_player_reliability_stats"), r77),
            "R53_installer_type_counts": (whole("R53_installer_type_counts"), r53),
            "R34_shared_schedule_uptime_wide": (lambda: QUERIES["R34_shared_schedule_uptime_wide"](spark, d), r34),
            "R122_display_costs": (whole("R122_display_costs"), r122)}


def _run(fn) -> float:
    t0 = time.perf_counter()
    fn().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from fleetlens.plans.registry import QUERIES, load_all
    from fleetlens.plans.rollups import ROLLUPS, history_table
    from fleetlens.session import build_session
    load_all()
    spark = build_session(f"local[{cpus}]", app="fleetlens-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "8g"})
    names = [n for n in HEADLINE if n in QUERIES]
    _run(lambda: QUERIES[names[0]](spark, sf_dir))  # warm-up: JVM, codegen caches
    # a daily run finds the earlier days in its stored rollup; filling it is timed apart
    t0 = time.perf_counter()
    for n in names:
        if n in ROLLUPS:
            history_table(spark, sf_dir, ROLLUPS[n])
    fill = round(time.perf_counter() - t0, 3)
    times = {n: _run(lambda n=n: QUERIES[n](spark, sf_dir)) for n in names}
    compare = {}
    for n, (one_pass, naive) in _naive_forms(spark, sf_dir).items():
        compare[n] = {"one_pass": _run(one_pass), "naive_multi_scan": _run(naive)}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_jobs_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "one_pass_vs_naive": compare, "rollup_fill_sec": fill}))
    spark.stop()


if __name__ == "__main__":
    main()
