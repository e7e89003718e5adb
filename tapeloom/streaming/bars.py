"""Bars and latest captures from streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeloom.operators.latest import latest_bars


def hourly_bars(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Hourly bars of a stream of events (ts, event_id, event_type, value); events later than `late` are dropped by the watermark."""
    e = events.select(F.col("event_type").alias("code"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value").withWatermark("ts", late)
    order = F.struct("ts", "event_id")
    bars = e.groupBy("code", F.window("ts", "1 hour").alias("w")).agg(
        F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count("*").cast("double").alias("volume")
    )
    return bars.select("code", F.col("w.start").alias("event_time"), "open", "high", "low", "close", "volume")


def keep_latest(snapshots: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch's newest captures to path; readers apply latest_bars() over all of it, so a repeated batch changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        latest_bars(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return snapshots.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
