"""Arithmetic on date ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions import market_time as mt


def merge_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, start, end: overlapping and day-adjacent ranges of each key joined. Ranges with a null or reversed end are left out.

    Of the ranges that begin on one day only the longest matters, so they are reduced to one for each key and day before anything
    is ordered: what a task orders is bounded by the days of the calendar, however many ranges a key has.
    """
    w = Window.partitionBy(*keys).orderBy("start")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    longest = df.filter(F.col("start") <= F.col("end")).groupBy(*keys, "start").agg(F.max("end").alias("end"))
    rows = longest.withColumn("_new", F.when(F.col("start") <= F.date_add(reach, 1), 0).otherwise(1))
    rows = rows.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def missing_ranges(wanted: DataFrame, merged: DataFrame, keys: list[str]) -> DataFrame:
    """keys, start, end: the parts of each key's wanted range (one row for each key) that no merged range covers. Merged ranges of a key lie a day apart at least, so the calendar bounds their number."""
    have = merged.select(*keys, F.col("start").alias("_a"), F.col("end").alias("_b"))
    rows = wanted.filter(F.col("start") <= F.col("end")).join(have, keys, "left")
    outside = (F.col("_b") < F.col("start")) | (F.col("_a") > F.col("end"))
    rows = rows.withColumns({c: F.when(~F.coalesce(outside, F.lit(False)), F.col(c)) for c in ("_a", "_b")})
    w = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_a"))
    before = F.max("_b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    gap = rows.select(*keys, F.greatest(F.coalesce(F.date_add(before, 1), F.col("start")), F.col("start")).alias("_from"), F.when(F.col("_a").isNotNull(), F.date_sub("_a", 1)).alias("_to"))
    inner = gap.filter(F.col("_from") <= F.col("_to")).select(*keys, F.col("_from").alias("start"), F.col("_to").alias("end"))
    tail = rows.groupBy(*keys).agg(F.max("_b").alias("_b"), F.first("start").alias("_s"), F.first("end").alias("_e"))
    tail = tail.select(*keys, F.coalesce(F.date_add("_b", 1), "_s").alias("start"), F.col("_e").alias("end")).filter(F.col("start") <= F.col("end"))
    return inner.unionByName(tail)


def volatility_coverage(df: DataFrame, start: str, end: str) -> DataFrame:
    """option_code, returned_min_date, returned_max_date, row_count and range_complete: the dates span the weekdays of the request."""
    first, last = mt.next_weekday(F.lit(start).cast("date")), mt.previous_weekday(F.lit(end).cast("date"))
    out = df.groupBy("option_code").agg(F.min("trade_date").alias("returned_min_date"), F.max("trade_date").alias("returned_max_date"), F.count("*").alias("row_count"))
    return out.withColumn("range_complete", F.coalesce((F.col("returned_min_date") <= first) & (F.col("returned_max_date") >= last), F.lit(False)))
