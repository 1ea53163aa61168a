"""Readers over physically sharded / partitioned layouts, schema DDL and sinks."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from fleetlens.sources import catalog as cat
from fleetlens.sources.schemas import create_event_table
from fleetlens.sources.sinks import append_snapshot, write_partitions


def _scratch():
    return tempfile.mkdtemp(prefix="run-")


def test_read_shards_reads_only_the_range(spark, sf_dir):
    root = _scratch()
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    for day in (10, 11, 12, 13):
        d = dt.date(2024, 1, day)
        ev.where(F.to_date("ts") == F.lit(d)).write.parquet(f"{root}/events{d:%Y%m%d}")
    got = cat.read_shards(spark, root, "events", "2024-01-11", "2024-01-14")  # the 14th shard is missing
    exp = ev.where(F.to_date("ts").between(F.lit(dt.date(2024, 1, 11)), F.lit(dt.date(2024, 1, 13))))
    assert got.count() == exp.count()
    assert {r[0] for r in got.select("event_date").distinct().collect()} == {dt.date(2024, 1, d) for d in (11, 12, 13)}
    assert cat.shard_paths(root, "events", "2024-01-11", "2024-01-12")[-1].endswith("events20240112")


def test_partitioned_table_prunes_partitions(spark, sf_dir):
    root = os.path.join(_scratch(), "events")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("event_date", F.to_date("ts"))
    ev.write.partitionBy("event_date").parquet(root)
    df = cat.read_events(spark.read.parquet(root), "2024-01-10", "2024-01-12").select("user_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert df.count() == ev.where("event_date between '2024-01-10' and '2024-01-12'").count()


def test_shards_come_from_one_listing(spark):
    from fleetlens.sources import shards
    root = _scratch()
    old = spark.createDataFrame([(1, "x")], "id long, a string")
    new = spark.createDataFrame([(2, "y", 3.0)], "id long, a string, b double")
    old.write.parquet(f"{root}/events20240109")
    new.write.parquet(f"{root}/events20240110")
    new.write.parquet(f"{root}/installs20240110")
    old.coalesce(1).write.parquet(f"{root}/other20240110")
    os.makedirs(f"{root}/events20249999")
    os.makedirs(f"{root}/_tmp")
    family = "id long, a string, b double, c string"
    from pyspark.sql import types as T
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    c = shards.ShardCatalog(spark, root, {"events": T.StructType.fromDDL(family), "installs": T.StructType.fromDDL("id long, b double")})
    assert [s.table_id for s in c.shards] == ["events20240109", "events20240110", "installs20240110"]
    every = c.read(c.matching(lambda t: t.endswith("0110") or "events" in t))
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs  # neither listing nor planning ran a job
    assert plan.count("FileScan") == 2
    day = dt.date(2024, 1, 10)
    assert sorted(map(tuple, every.select("table_id", "event_date", "id", "a", "b", "c").collect())) == [
        ("events20240109", dt.date(2024, 1, 9), 1, "x", None, None), ("events20240110", day, 2, "y", 3.0, None),
        ("installs20240110", day, 2, None, 3.0, None)]
    assert c.read(c.between("events", "2024-01-10", "2024-02-01"), ["id"]).drop("table_id").collect()[0] == (2, day)
    assert c.read(c.between("events", "2025-01-10", "2025-02-01")).collect() == []


def test_matching_days_are_ranges_of_one_scan(spark, sf_dir):
    from fleetlens.plans import registry
    from fleetlens.sources import shards
    registry.load_all()
    assert shards.matching_days("e_", "2024-01-08", "2024-01-21", lambda t: "2024011" in t or t.endswith("21")) == [
        (dt.date(2024, 1, 10), dt.date(2024, 1, 19)), (dt.date(2024, 1, 21), dt.date(2024, 1, 21))]
    df = registry.QUERIES["S03_read_matching"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(ts,2024-01-10" in plan
    assert shards.read_matching_days(spark.read.parquet(f"{sf_dir}/events.parquet"), "e_", []).count() == 0


def test_rows_without_a_required_value_stay_and_are_listed(spark):
    from pyspark.sql import types as T

    from fleetlens.sources.schemas import conform, violations
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType(), False), T.StructField("c", T.StringType())])
    df = spark.createDataFrame([("1", "x", "y"), ("bad", None, None), (None, "x", "z")], "a string, b string, c string")
    assert conform(df, schema).count() == 3 and conform(df, schema, strict=True).count() == 1
    assert sorted(tuple(r["missing"]) for r in violations(df, schema).collect()) == [("a",), ("a", "b")]


def test_read_matching_unions_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([(2, 3.0)], "id long, b double")
    c = spark.createDataFrame([(9,)], "id long")
    out = cat.read_matching({"events_2024": a, "events_2023": b, "other": c}, lambda n: n.startswith("events_"))
    rows = sorted((r["table_id"], r["id"], r["a"], r["b"]) for r in out.collect())
    assert rows == [("events_2023", 2, None, 3.0), ("events_2024", 1, "x", None)]


def test_create_event_table_ddl(spark):
    loc = os.path.join(_scratch(), "uptime")
    create_event_table(spark, "fl_uptime_events", "uptime_events", loc)
    cols = {f.name: f for f in spark.table("fl_uptime_events").schema.fields}
    assert list(cols)[-1] == "event_date" and "display_id" in cols and "showing" in cols
    spark.sql("DROP TABLE fl_uptime_events")


def test_snapshot_sink_rerun_replaces_its_row(spark):
    path = os.path.join(_scratch(), "kpi")
    kpi = spark.createDataFrame([(10, 4)], "users long, buyers long")
    t = dt.datetime(2024, 1, 31, 6)
    append_snapshot(kpi, path, t)
    append_snapshot(kpi, path, t)                       # retried run
    append_snapshot(kpi, path, t + dt.timedelta(days=1))  # next scheduled run
    assert spark.read.parquet(path).count() == 2


def test_write_partitions_keeps_other_days(spark):
    path = os.path.join(_scratch(), "daily")
    d1 = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "date date, n long")
    write_partitions(d1, path)
    write_partitions(spark.createDataFrame([(dt.date(2024, 1, 2), 20)], "date date, n long"), path)
    got = sorted((r["date"].day, r["n"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (2, 20)]
