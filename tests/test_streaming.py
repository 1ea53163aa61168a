"""The streaming rollup emits, for every closed day, the batch daily reliability."""

import os
import tempfile

from pyspark.sql import functions as F

from fleetlens.operators.reliability import daily_reliability
from fleetlens.session import checkpoint_dir
from fleetlens.streaming.late_rollup import start_rollup


def test_stream_matches_batch_for_closed_days(spark, sf_dir):
    base = checkpoint_dir(spark, default=tempfile.mkdtemp(prefix="fleetlens-ckpt-"))
    run = tempfile.mkdtemp(prefix="run-", dir=base if os.path.isdir(base) else None)
    src, sink, ckpt = (os.path.join(run, n) for n in ("src", "sink", "ckpt"))
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    # arrive in two files: the second holds the oldest week (late data)
    ev.where("ts >= '2024-01-08'").write.parquet(src + "/part1")
    ev.where("ts < '2024-01-08'").write.parquet(src + "/part2")
    q = start_rollup(spark, src + "/*", sink, ckpt, late="1 day")
    q.awaitTermination(300)
    got = {r["date"]: (r["total"], r["failed"]) for r in spark.read.parquet(sink).collect()}
    batch = daily_reliability(ev.withColumn("date", F.to_date("ts")), "user_id", F.col("event_type") == "error")
    exp = {r["date"]: (r["total"], r["failed"]) for r in batch.collect()}
    assert got, "no day was finalised"
    for day, v in got.items():
        assert exp[day] == v, day
    # every day older than the watermark (newest event - 1 day) is final
    newest = max(exp)
    assert all(d in got for d in exp if (newest - d).days >= 2)
