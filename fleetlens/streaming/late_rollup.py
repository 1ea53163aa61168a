"""Structured Streaming form of the late-data daily rollup.

The batch views re-read the last N days on every run and splice them over the
stored rollup so late events are counted.  As a stream the same contract is a
watermark of N days: a day's row is final once no event older than N days
behind the newest event can arrive, and it is emitted exactly then.

Plan: two chained stateful aggregations in append mode

1. per (day, device): ``max(failed)`` -- state is one row per active device-day,
   and map-side partial aggregation collapses a hot device before the shuffle;
2. per day: devices in total and failed -- a distinct count expressed as a
   count over the de-duplicated (day, device) rows (streaming has no exact
   ``count(DISTINCT)``).

The sink rewrites whole day partitions (dynamic overwrite) per micro-batch, so
a replayed batch after a failure gives the same table.  Checkpoints go to the
shared folder named by ``spark.checkpoint.dir`` (see ``session.checkpoint_dir``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetlens.sources.sinks import write_partitions

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def daily_reliability_stream(events: DataFrame, *, failed: Column, late: str = "3 days",
                             id_col: str = "user_id") -> DataFrame:
    """Streaming daily reliability: date, total, failed, pct (final once the watermark passes)."""
    ev = events.select(F.col("ts").cast("timestamp").alias("ets"), F.col(id_col).alias("__id"),
                       failed.cast("int").alias("__f")).where(F.col("__id").isNotNull())
    per_device = (ev.withWatermark("ets", late)
                    .groupBy(F.window("ets", "1 day").alias("w"), "__id")
                    .agg(F.max("__f").alias("__f")))
    daily = (per_device.groupBy(F.window(F.window_time("w"), "1 day").alias("d"))
                       .agg(F.count(F.lit(1)).alias("total"), F.sum("__f").cast("long").alias("failed")))
    return daily.select(F.to_date(F.col("d.start")).alias("date"), "total", "failed",
                        F.round(F.try_divide((F.col("total") - F.col("failed")) * 100.0, F.col("total")), 6).alias("pct"))


def start_rollup(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str, *,
                 late: str = "3 days", available_now: bool = True) -> StreamingQuery:
    """Run the stream from a directory of Parquet event files into a day-partitioned rollup."""
    src = spark.readStream.schema(EVENT_SCHEMA).parquet(source_dir)
    out = daily_reliability_stream(src, failed=F.col("event_type") == "error", late=late)

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_partitions(batch, sink_dir, partition_col="date")

    w = out.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
