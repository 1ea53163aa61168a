"""Scheduled daily summaries: run the four daily jobs and
store each in its day-partitioned table; refresh the stored rollups.

The reference appends with ``INSERT INTO``; a retried or re-run schedule would
append twice.  Here every table is written with dynamic partition overwrite,
so running the schedule again for the same day leaves the tables unchanged.

    python -m fleetlens.plans.schedule --sf-dir DIR --out DIR [--date YYYY-MM-DD]
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from fleetlens.plans.registry import modules
from fleetlens.plans.tables import YESTERDAY
from fleetlens.sources.sinks import write_partitions

# Target table -> registered job whose rows it holds.
DAILY_SUMMARIES = {
    "dailyUptime": "R85c_daily_uptime_full",
    "dailyUsage": "R86b_daily_usage_full",
    "dailyErrors": "R87b_daily_errors_full",
    "dailyCost": "R88b_daily_cost_full",
}


def run_daily_summaries(spark: SparkSession, sf_dir: str, out_root: str, run_date: dt.date = YESTERDAY) -> dict[str, str]:
    """Write the summaries of ``run_date`` into ``out_root/<table>`` partitioned by ``date``; returns the paths.

    The jobs run as of the day after, so a backfill computes the day it is stored under.  The
    endpoint dimensions are composed once, stored under ``out_root/dimensions/<run date>`` and read
    from there by all four.
    """
    own, root = modules(run_date + dt.timedelta(days=1)), out_root.rstrip("/")
    endpoints, costs = own["endpoints"], own["costs"]
    dims = endpoints.dimensions(spark, sf_dir).store(f"{root}/dimensions/{run_date}")
    frames = {
        "dailyUptime": endpoints.daily_uptime(spark, sf_dir, dims),
        "dailyUsage": endpoints.daily_usage(spark, sf_dir, dims),
        "dailyErrors": endpoints.daily_errors(spark, sf_dir, run_date, run_date, dims),
        "dailyCost": costs.daily_costs(spark, sf_dir, dims),
    }
    for table, df in frames.items():
        write_partitions(df, f"{root}/{table}", partition_col="date")
    return {table: f"{root}/{table}" for table in frames}


def run_rollups(spark: SparkSession, sf_dir: str, out_root: str, run_date: dt.date = YESTERDAY) -> dict[str, str]:
    """Refresh every stored rollup under ``out_root/rollups`` for the windows that end with ``run_date``; returns the paths."""
    own, root = modules(run_date + dt.timedelta(days=1))["rollups"], f"{out_root.rstrip('/')}/rollups"
    for name in own.ROLLUPS:
        own.run_rollup(spark, sf_dir, root, name)
    return {name: f"{root}/{name}" for name in own.ROLLUPS}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--date", type=dt.date.fromisoformat, default=YESTERDAY)
    a = ap.parse_args(argv)
    from fleetlens.session import build_session
    spark = build_session()
    for run in (run_daily_summaries, run_rollups):
        for table, path in run(spark, a.sf_dir, a.out, a.date).items():
            print(table, path)


if __name__ == "__main__":
    main()
