"""Re-running the scheduled daily summaries is idempotent."""

import os
import tempfile

from fleetlens.plans.registry import QUERIES, load_all
from fleetlens.plans.rollups import ROLLUPS
from fleetlens.plans.schedule import DAILY_SUMMARIES, run_daily_summaries, run_rollups
from fleetlens.sources.rollups import RollupTable

load_all()


def test_daily_summaries_rerun_is_idempotent(spark, sf_dir):
    out = os.path.join(tempfile.mkdtemp(prefix="run-"), "logs")
    first = run_daily_summaries(spark, sf_dir, out)
    counts = {t: spark.read.parquet(p).count() for t, p in first.items()}
    run_daily_summaries(spark, sf_dir, out)  # retried schedule
    assert {t: spark.read.parquet(p).count() for t, p in first.items()} == counts
    for table, job in DAILY_SUMMARIES.items():
        assert counts[table] == QUERIES[job](spark, sf_dir).count()


def test_rollup_refresh_rerun_is_idempotent(spark, sf_dir, tmp_path, monkeypatch):
    names = ["R02_splice_rollup", "R52b_display_records"]
    kept = {n: ROLLUPS[n] for n in names}
    monkeypatch.setattr("fleetlens.plans.rollups.ROLLUPS", kept)
    for again in range(2):  # the second is a retried schedule
        paths = run_rollups(spark, sf_dir, str(tmp_path))
        assert sorted(paths) == names
        for name, path in paths.items():
            table = RollupTable(spark, path, kept[name].date_col)
            assert len(table.runs()) == 2 + again
            assert sorted(map(str, table.read().collect())) == sorted(map(str, QUERIES[name](spark, sf_dir).collect()))
