"""Stored rollups: window refreshes, commits, growing data, and the plans of the jobs on them."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fleetlens.plans import registry
from fleetlens.plans.check import TABLES, compare
from fleetlens.plans.rollups import ROLLUPS, history_table, input_key, run_rollup
from fleetlens.sources.rollups import EVER, MARKER, RollupTable, Run, owned_days

registry.load_all()
DAY = dt.timedelta(days=1)
#: Jobs whose rows of a day follow from that day's events alone.
BY_DAY = ["R02_splice_rollup", "T06_late_data_reread", "R37b_log_table_stats", "R41_html_template_rollup",
          "R42_segment_template_adoption", "R61_cache_daily_reliability", "R77_player_reliability_stats",
          "R78_multiple_unreliable_starts", "R122_display_costs"]


#: What some jobs read besides their window: latest configurations of any age, displays active within a week.
OTHER_SCANS = {"R53_installer_type_counts": "event_type,view", "R52b_display_records": "event_type,signup",
               "R42b_segment_adoption_of_both_sources": "GreaterThanOrEqual(ts,2024-01-24"}


def d(n):
    return dt.date(2024, 1, n)


def rows(spark, *values):
    return spark.createDataFrame(values, "date date, n long")


def content(df):
    return sorted(map(tuple, df.collect()), key=lambda x: tuple((v is not None, v) for v in x))


def test_later_windows_own_their_days():
    a, b, c = Run(1, EVER, d(9), "a"), Run(2, d(10), d(12), "b"), Run(3, d(11), d(13), "c")
    assert owned_days([c, a, b]) == [(a, EVER, d(9)), (b, d(10), d(10)), (c, d(11), d(13))]
    inner = Run(4, d(3), d(4), "d")
    assert owned_days([a, b, c, inner])[:3] == [(a, EVER, d(2)), (inner, d(3), d(4)), (a, d(5), d(9))]


def test_windows_replace_whole_days_and_only_them(spark, tmp_path):
    t = RollupTable(spark, str(tmp_path / "t"))
    assert t.covered_until() is None and t.runs() == []
    with pytest.raises(LookupError):
        t.read()
    t.store(rows(spark, (d(1), 1), (d(2), 2), (d(2), 3)), None, d(2))
    t.store(rows(spark, (d(3), 4), (d(4), 5)), d(3), d(5))
    t.store(rows(spark, (d(4), 6), (d(4), 7), (d(9), 8), (None, 9)), d(4), d(6))  # day 5 has no row; 9 and NULL are outside
    assert content(t.read()) == [(d(1), 1), (d(2), 2), (d(2), 3), (d(3), 4), (d(4), 6), (d(4), 7)]
    assert content(t.read(before=d(4))) == [(d(1), 1), (d(2), 2), (d(2), 3), (d(3), 4)]
    assert t.covered_until() == d(6)
    t.store(rows(spark), d(1), d(1))  # a day whose rows are all gone
    assert d(1) not in {x for x, _ in content(t.read())}
    t.store(rows(spark), d(1), d(6))
    assert content(t.read()) == []


def test_files_of_a_failed_run_are_never_read(spark, tmp_path):
    t = RollupTable(spark, str(tmp_path / "t"))
    t.store(rows(spark, (d(1), 1)), None, d(1))
    before = t.runs()
    failed = t.store(rows(spark, (d(1), 100)), d(1), d(1))
    os.remove(tmp_path / "t" / f"run={failed.name}" / MARKER)
    os.makedirs(tmp_path / "t" / "unrelated")
    assert t.runs() == before and content(t.read()) == [(d(1), 1)]
    again = t.store(rows(spark, (d(1), 2)), d(1), d(1))
    assert again.number > failed.number and content(t.read()) == [(d(1), 2)]


def test_two_runs_over_one_window_end_in_one_of_them(spark, tmp_path):
    t, u = (RollupTable(spark, str(tmp_path / "t")) for _ in range(2))
    t.store(rows(spark, (d(1), 1), (d(2), 1)), d(1), d(2))
    os.rename(tmp_path / "t" / f"run={t.runs()[0].name}", tmp_path / "t" / f"run={Run(1, d(1), d(2), 'zz').name}")
    u.store(rows(spark, (d(1), 2)), d(1), d(2))
    os.rename(tmp_path / "t" / f"run={t.runs()[1].name}", tmp_path / "t" / f"run={Run(1, d(1), d(2), 'aa').name}")
    assert content(t.read()) == [(d(1), 1), (d(2), 1)]


def test_a_planned_reader_keeps_its_snapshot_and_vacuum_drops_what_nobody_owns(spark, tmp_path):
    t = RollupTable(spark, str(tmp_path / "t"))
    for n in range(1, 6):
        t.store(rows(spark, *((d(k), n) for k in range(1, 4))), d(1), d(3))
        if n == 4:
            old = t.read()
    assert content(old) == [(d(k), 4) for k in range(1, 4)]
    assert [r.number for r in t.vacuum(keep=2)] == [1, 2, 3]
    assert content(old) == [(d(k), 4) for k in range(1, 4)] and content(t.read()) == [(d(k), 5) for k in range(1, 4)]
    t.store(rows(spark, (d(4), 9)), d(4), d(4))
    want = content(t.read())
    t.compact()
    t.vacuum(keep=1)
    assert len(t.runs()) == 1 and content(t.read()) == want


def test_reading_prunes_to_the_owned_folders(spark, tmp_path):
    t = RollupTable(spark, str(tmp_path / "t"))
    t.store(rows(spark, *((d(k), 1) for k in range(1, 21))), None, d(20))
    t.store(rows(spark, *((d(k), 2) for k in range(19, 22))), d(19), d(21))
    files = t.read(before=d(3)).inputFiles()
    assert files and all("date=2024-01-0" in f for f in t.read(before=d(3))._jdf.queryExecution().executedPlan().toString().split() if "date=2024" in f)
    plan = t.read(before=d(3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters" in plan


def test_refresh_fills_gaps_and_joins_many_runs(spark, tmp_path, monkeypatch):
    t, asked = RollupTable(spark, str(tmp_path / "t")), []

    def compute(first, last):
        asked.append((first, last))
        days = [d(1) + k * DAY for k in range(31)]
        return rows(spark, *((x, 1) for x in days if (first or EVER) <= x <= last))
    t.refresh(compute, d(5), d(7))
    assert asked == [(None, d(4)), (d(5), d(7))]
    t.refresh(compute, d(12), d(14))  # four runs were missed
    assert asked[-1] == (d(8), d(14)) and content(t.read()) == [(d(k), 1) for k in range(1, 15)]
    monkeypatch.setattr("fleetlens.sources.rollups.MANY", 2)
    t.refresh(compute, d(14), d(16))
    assert len(owned_days(t.runs())) == 1 and content(t.read()) == [(d(k), 1) for k in range(1, 17)]


@pytest.fixture(scope="module")
def growing(spark, sf_dir, tmp_path_factory):
    """The input as it was on three days; some events of a day arrive one or two days later."""
    out = {}
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    late = F.when(F.col("event_id") % 5 == 0, F.date_add(F.to_date("ts"), 2)).when(
        F.col("event_id") % 7 == 0, F.date_add(F.to_date("ts"), 1)).otherwise(F.to_date("ts"))
    for day in (d(20), d(22), d(26)):
        root = tmp_path_factory.mktemp(f"grown{day.day}")
        for t in TABLES:
            if t != "events":
                os.symlink(f"{sf_dir}/{t}.parquet", root / f"{t}.parquet")
        e.where(late < F.lit(day)).write.parquet(str(root / "events.parquet"))
        out[day] = str(root)
    return out


@pytest.mark.parametrize("name", BY_DAY)
def test_runs_on_growing_data_equal_a_recomputation(spark, growing, tmp_path, name):
    """Days within reach of the last runs' windows are as if recomputed; older ones as when they were last in a window."""
    import importlib
    from unittest import mock
    want = {}
    for day, sf in growing.items():
        registry.jobs(day)
        r = ROLLUPS[name]
        start, end = day - (dt.date(2024, 1, 31) - r.start), day - (dt.date(2024, 1, 31) - r.end)
        with mock.patch.dict(ROLLUPS, {name: type(r)(name, r.compute, start, end, r.date_col)}):
            got = run_rollup(spark, sf, str(tmp_path), name)
        table = RollupTable(spark, str(tmp_path / name), r.date_col)
        window = table.runs()[-1]
        for x in [x for x in want if window.start <= x <= window.end]:
            del want[x]
        for row in r.compute(spark, sf, None if not want else window.start, end).collect():
            want.setdefault(row[r.date_col], [])
            if len(table.runs()) == 2 or row[r.date_col] >= window.start:
                want[row[r.date_col]].append(tuple(row))
        assert sorted(map(str, content(got))) == sorted(str(x) for v in want.values() for x in v)
    assert importlib.import_module("fleetlens.plans.rollups").ROLLUPS is ROLLUPS


@pytest.mark.parametrize("name", sorted(ROLLUPS))
def test_raw_events_are_scanned_inside_the_window_only(spark, sf_dir, name):
    r = ROLLUPS[name]
    query = registry.QUERIES[name]
    query(spark, sf_dir)
    shown = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", shown)
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    history = [x for x in scans if "PartitionFilters" in x and "run#" in x]
    raw = [x for x in scans if "events.parquet" in x and "ts#" in x]
    assert len(history) == 1 and raw
    for x in raw:
        if name in OTHER_SCANS and OTHER_SCANS[name] in x:
            continue
        assert f"GreaterThanOrEqual(ts,{r.start}" in x, x


def test_the_sessions_history_follows_the_input(spark, duck, sf_dir, growing):
    r = ROLLUPS["R02_splice_rollup"]
    assert input_key(spark, sf_dir) == input_key(spark, sf_dir) != input_key(spark, growing[d(20)])
    assert len(history_table(spark, sf_dir, r).runs()) == len(history_table(spark, sf_dir, r).runs()) == 1
    from fleetlens.plans.check import duck as connect
    for sf in growing.values():
        got = compare(spark, connect(sf), r.name, registry.QUERIES[r.name], registry.ORACLE[r.name], sf)
        assert got["ok"], got


def test_without_a_shared_folder_the_days_are_computed(spark, duck, sf_dir, monkeypatch):
    monkeypatch.setattr("fleetlens.plans.rollups.has_shared_folder", lambda _: False)
    name = "R78_multiple_unreliable_starts"
    assert compare(spark, duck, name, registry.QUERIES[name], registry.ORACLE[name], sf_dir)["ok"]
    assert "run#" not in registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
