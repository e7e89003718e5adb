"""Market tables derived from the events, orders, part and lineitem tables, for queries without a vendor feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions import market_time as mt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bars(spark: SparkSession, sf_dir: str, code: str, unit: str, interval: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col(code).cast("string").alias("code"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    order = F.struct("ts", "event_id")
    bars = e.groupBy("code", F.date_trunc(unit, "ts").alias("event_time")).agg(
        F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count("*").cast("double").alias("volume")
    )
    return bars.select("*", F.lit(interval).alias("interval"), F.lit("NONE").alias("adjustment"), F.lit("ALL").alias("requested_session"))


def bars60(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars: code, event_time, open, high, low, close, volume, interval, adjustment, requested_session."""
    return _bars(spark, sf_dir, "event_type", "hour", "60m")


def bars1(spark: SparkSession, sf_dir: str, code: str = "event_type") -> DataFrame:
    """Bars of one minute by a column of the events, with date, session and the moment the market knows each."""
    b, t = _bars(spark, sf_dir, code, "minute", "1m"), F.col("event_time")
    return b.withColumns({"market_calendar_date": mt.market_date(t), "session": mt.session_label(t), "market_available_at": mt.available_at(t, F.lit(60)), "archive_available_at": mt.available_at(t, F.lit(60))})


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated rows of three overlapping captures of bars60. Each misses some hours, together they have every bar; the third reports one unit more volume at 13 UTC.

    There are no files, so the hash of a snapshot's bytes is that of its name.
    """
    k = F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("k")
    day = mt.market_date(F.col("event_time"))
    b = bars60(spark, sf_dir).select("*", k).filter((F.hour("event_time") + F.col("k")) % 11 != 0)
    file = F.concat(F.lit("file-"), F.col("k"), F.lit("-"), day.cast("string"))
    return b.select(
        "code",
        F.lit("EQUITY").alias("asset_type"),
        "interval",
        "adjustment",
        F.col("event_time").alias("time_market"),
        F.col("event_time").alias("time_utc"),
        day.alias("market_calendar_date"),
        day.alias("requested_trade_date"),
        "requested_session",
        mt.session_label(F.col("event_time")).alias("session"),
        "open",
        "high",
        "low",
        "close",
        (F.col("volume") + F.when((F.col("k") == 2) & (F.hour("event_time") == 13), 1.0).otherwise(0.0)).alias("volume"),
        F.lit("feed").alias("source"),
        F.lit("1").alias("source_schema_version"),
        F.concat(F.lit("run-"), F.col("k"), F.lit("-"), day.cast("string")).alias("ingestion_run_id"),
        (F.lit("2024-02-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("k"))).alias("ingested_at"),
        file.alias("snapshot_file"),
        F.sha2(F.concat(F.lit("bytes of "), file).cast("binary"), 256).alias("physical_snapshot_hash"),
    )


def bent(captured: DataFrame) -> DataFrame:
    """captures() with every kind of fault that an audit looks for, by the hour and day of a bar; some rows come twice, some a half hour or half a minute late."""
    h, d, t = F.hour("time_utc"), F.dayofmonth("requested_trade_date"), F.col("time_utc")
    late = F.when((h == 11) & (d % 6 == 2), F.lit(1800)).when((h == 18) & (d % 10 == 0), F.lit(30)).otherwise(F.lit(0))
    moved = t + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), late)
    market = F.when((h == 12) & (d % 6 == 3), F.lit(None)).when(d == 26, F.lit(None)).when((h == 14) & (d % 6 == 5), moved + F.expr("interval 1 hour")).otherwise(moved)
    rows = captured.select("*", h.alias("_h"), d.alias("_d"), moved.alias("_t"), market.cast("timestamp").alias("_m")).withColumns({
        "market_calendar_date": F.when((F.col("_h") == 15) & (F.col("_d") % 6 == 0), F.date_add("market_calendar_date", 1)).otherwise(F.col("market_calendar_date")),
        "session": F.when((F.col("_h") == 10) & (F.col("_d") % 6 == 1), F.lit("NIGHT")).otherwise(F.col("session")),
        "adjustment": F.when((F.col("_h") == 17) & (F.col("_d") % 8 == 0), F.lit("QFQ")).otherwise(F.col("adjustment")),
        "volume": F.when((F.col("code") == "view") & (F.col("_d") % 9 == 0), F.lit(None).cast("double")).when((F.col("_h") == 9) & (F.col("_d") % 4 == 0), F.lit(-1.0)).otherwise(F.col("volume")),
        "open": F.when((F.col("_h") == 7) & (F.col("_d") % 3 == 0), F.lit(None).cast("double")).otherwise(F.col("open")),
        "high": F.when((F.col("_h") == 8) & (F.col("_d") % 3 == 0), F.col("low") - 1).otherwise(F.col("high")),
    })
    twice = F.explode(F.when((F.col("_h") == 13) & (F.col("_d") % 6 == 4), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumns({"time_utc": F.col("_t"), "time_market": F.col("_m")}).select("*", twice.alias("_copy")).drop("_h", "_d", "_t", "_m", "_copy")


def runs(captured: DataFrame) -> DataFrame:
    """A run for each capture and day, of every status; some captures have none, some name another session."""
    r = captured.select("ingestion_run_id", "requested_trade_date", "interval", "adjustment", "ingested_at").distinct()
    k, d = F.substring("ingestion_run_id", 5, 1).cast("int"), F.dayofmonth("requested_trade_date")
    status = F.when(k == 0, "SUCCESS").when(k == 1, F.when(d % 8 == 0, "PARTIAL").otherwise("FAILED")).otherwise(F.when(d % 5 == 0, "RUNNING").otherwise("SUCCESS"))
    return r.filter(~((k == 1) & (d % 7 == 0))).select(
        F.col("ingestion_run_id").alias("run_id"),
        "requested_trade_date",
        "interval",
        F.when((k == 0) & (d % 4 == 0), "RTH").otherwise("ALL").alias("session"),
        "adjustment",
        status.alias("status"),
        (F.col("ingested_at") + F.expr("interval 10 minutes")).alias("finished_at"),
    )


def quality(run_rows: DataFrame) -> DataFrame:
    """One quality row for each run; the third capture fails on every third day."""
    k, d = F.substring("run_id", 5, 1).cast("int"), F.dayofmonth("requested_trade_date")
    return run_rows.select("run_id", F.lit("ohlc_consistency").alias("check_name"), F.when((k == 2) & (d % 3 == 0), "FAIL").otherwise("PASS").alias("result"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two captures of a calendar over the days that have orders: the newer covers a middle range and lacks every seventh of a month."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("trade_date")).distinct()
    span = days.agg(F.min("trade_date").alias("first"), F.max("trade_date").alias("last"))
    d = days.join(F.broadcast(span))  # one row
    old = d.select("trade_date", F.col("first").alias("a"), F.col("last").alias("b"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("captured_at"), F.lit("cal-1").alias("ingestion_run_id"))
    new = d.filter((F.dayofmonth("trade_date") != 7) & F.col("trade_date").between(F.date_add("first", 100), F.date_sub("last", 100))).select(
        "trade_date", F.date_add("first", 100).alias("a"), F.date_sub("last", 100).alias("b"), F.lit("2024-02-01 00:00:00").cast("timestamp").alias("captured_at"), F.lit("cal-2").alias("ingestion_run_id")
    )
    kind = F.when((F.col("ingestion_run_id") == "cal-2") & (F.dayofmonth("trade_date") == 1), "MORNING").otherwise("WHOLE")
    return old.unionByName(new).select(
        F.lit("MARKET").alias("scope_type"), F.lit("US").alias("scope_value"), F.lit("US").alias("market"), F.lit(None).cast("string").alias("reference_code"), "trade_date", kind.alias("trade_date_type"),
        F.col("a").alias("requested_start_date"), F.col("b").alias("requested_end_date"), "captured_at", F.lit("feed").alias("source"), F.lit("1").alias("source_schema_version"), "ingestion_run_id",
    )


def trading_days(bars: DataFrame) -> DataFrame:
    """Expected days of the audits: the weekdays on which any bar was captured."""
    return bars.select(F.col("requested_trade_date").alias("trade_date")).distinct().filter(F.weekday("trade_date") < 5)
