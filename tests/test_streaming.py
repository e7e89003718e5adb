"""Streams give what the batch operators give."""

from pyspark.sql import functions as F

from tapeloom.operators.latest import latest_bars
from tapeloom.streaming.bars import hourly_bars, keep_latest


def test_hourly_bars(spark, tmp_path):
    rows = [(1, "2024-01-01 10:05:00", "a", 3.0), (2, "2024-01-01 10:00:00", "a", 1.0), (3, "2024-01-01 10:59:59", "a", 2.0), (4, "2024-01-01 11:00:00", "b", 9.0)]
    df = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = hourly_bars(stream).writeStream.format("memory").queryName("hourly").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.table("hourly").select("code", "open", "high", "low", "close", "volume").collect())
    assert got == [("a", 1.0, 3.0, 1.0, 2.0, 3.0), ("b", 9.0, 9.0, 9.0, 9.0, 1.0)]


def test_keep_latest(spark, tmp_path):
    rows = [("a", "2024-01-01 10:00:00", "r1", "2024-01-02 00:00:00", 1.0), ("a", "2024-01-01 10:00:00", "r2", "2024-01-03 00:00:00", 2.0), ("b", "2024-01-01 10:00:00", "r1", None, 3.0)]
    df = spark.createDataFrame(rows, "code string, t string, ingestion_run_id string, i string, close double").select(
        "code", F.lit("60m").alias("interval"), F.lit("NONE").alias("adjustment"), F.col("t").cast("timestamp").alias("time_utc"), "ingestion_run_id", F.col("i").cast("timestamp").alias("ingested_at"), "close"
    )
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    keep_latest(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = latest_bars(spark.read.parquet(str(tmp_path / "out")))
    assert sorted((r.code, r.close) for r in got.collect()) == [("a", 2.0), ("b", 3.0)]
