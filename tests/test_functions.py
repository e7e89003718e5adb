"""Column functions on literal rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import codes, identity
from tapeloom.functions import market_time as mt


def values(df):
    return [tuple(r) for r in df.collect()]


def test_session_labels_and_dates(spark):
    rows = [("2024-01-10 08:59:59",), ("2024-01-10 09:00:00",), ("2024-01-10 14:30:00",), ("2024-01-10 21:00:00",), ("2024-01-11 01:00:00",), ("2024-07-10 13:30:00",), (None,)]
    t = F.col("t").cast("timestamp")
    df = spark.createDataFrame(rows, "t string").select(mt.session_label(t).alias("s"), mt.occurrence_date(t, mt.session_label(t)).cast("string").alias("d"))
    assert values(df) == [("OVERNIGHT", "2024-01-09"), ("PRE_MARKET", "2024-01-10"), ("REGULAR", "2024-01-10"), ("AFTER_HOURS", "2024-01-10"), ("OVERNIGHT", "2024-01-10"), ("REGULAR", "2024-07-10"), ("UNKNOWN", None)]


@pytest.mark.parametrize("local,fault", [("2024-03-10 02:30:00", "nonexistent"), ("2024-11-03 01:30:00", "ambiguous"), ("2024-03-10 01:59:00", None), ("2024-03-10 03:00:00", None), ("2024-11-03 00:59:00", None), ("2024-11-03 02:00:00", None)])
def test_clock_changes(spark, local, fault):
    df = spark.createDataFrame([(local,)], "t string")
    assert values(df.select(mt.local_time_fault(F.col("t").cast("timestamp")))) == [(fault,)]
    got = values(df.select(mt.to_instant(F.col("t"), on_bad="null").isNull()))
    assert got == [(fault is not None,)]
    if fault:
        with pytest.raises(Exception, match=fault):
            df.select(mt.to_instant(F.col("t"))).collect()


def test_unreadable_time(spark):
    df = spark.createDataFrame([("soon",), (None,)], "t string")
    assert values(df.select(mt.to_instant(F.col("t"), on_bad="null"))) == [(None,), (None,)]
    with pytest.raises(Exception, match="unreadable"):
        df.select(mt.to_instant(F.col("t"))).collect()


def test_intervals_and_midnight(spark):
    df = spark.createDataFrame([(" 60M ",), ("1m",)], "i string")
    assert values(df.select(mt.interval_seconds(F.col("i")))) == [(3600,), (60,)]
    with pytest.raises(Exception, match="unsupported"):
        spark.createDataFrame([("2h",)], "i string").select(mt.interval_seconds(F.col("i"))).collect()
    days = spark.createDataFrame([("2024-03-09",), ("2024-03-10",)], "d string").select(mt.next_local_midnight(F.col("d").cast("date"), mt.MARKET_ZONE).cast("string"))
    assert values(days) == [("2024-03-10 05:00:00",), ("2024-03-11 04:00:00",)]


def test_chunks_weekdays_periods(spark):
    d = lambda x: F.lit(x).cast("date")
    one = spark.range(1)
    chunks = one.select(F.explode(mt.date_chunks(d("2024-01-01"), d("2024-02-15"))).alias("c")).select(F.col("c.start").cast("string"), F.col("c.end").cast("string"))
    assert values(chunks) == [("2024-01-01", "2024-01-30"), ("2024-01-31", "2024-02-15")]
    assert values(one.select(F.size(mt.date_chunks(d("2024-02-01"), d("2024-01-01"))))) == [(0,)]
    assert values(one.select(mt.next_weekday(d("2024-01-06")).cast("string"), mt.previous_weekday(d("2024-01-07")).cast("string"), mt.next_weekday(d("2024-01-05")).cast("string"))) == [("2024-01-08", "2024-01-05", "2024-01-05")]
    assert values(one.select(*(mt.volatility_period(F.date_sub(d("2024-12-31"), n), d("2024-12-31")) for n in (7, 8, 92, 183, 366)))) == [("WEEK", "MONTH", "QUARTER", "HALF_YEAR", "YEAR")]
    with pytest.raises(Exception, match="look-back"):
        one.select(mt.volatility_period(d("2023-01-01"), d("2024-12-31"))).collect()


def test_codes(spark):
    df = spark.createDataFrame([("us.mu260821c100000",), ("US.MU",), (None,)], "c string")
    assert values(df.select(codes.asset_type(F.col("c")), codes.underlying(F.col("c")))) == [("OPTION", "US.MU"), ("EQUITY", None), ("EQUITY", None)]
    sides = spark.createDataFrame([("a call", None), ("2", None), (None, "US.MU260821P100000"), ("x", "SHORT"), (None, None)], "v string, c string")
    assert values(sides.select(codes.option_side(F.col("v"), F.col("c")))) == [("CALL",), ("PUT",), ("PUT",), (None,), (None,)]
    flags = spark.createDataFrame([(" Yes ",), ("0",), ("maybe",), (None,)], "v string")
    assert values(flags.select(codes.lenient_boolean(F.col("v")))) == [(True,), (False,), (None,), (None,)]
    nums = spark.createDataFrame([("1.5",), ("x",), ("NaN",), ("Infinity",), (None,)], "v string")
    assert values(nums.select(codes.number(F.col("v")))) == [(1.5,), (None,), (None,), (None,), (None,)]


def test_digest_and_content_id(spark):
    own = hashlib.sha256("1=a\x1f~\x1f1=1".encode()).hexdigest()
    assert values(spark.range(1).select(identity.digest(F.lit("a"), F.lit(None).cast("string"), F.lit(1)))) == [(own,)]
    df = spark.createDataFrame([(i, float(i), None if i % 3 else "x") for i in range(200)], "a long, b double, c string")
    one = identity.content_id(df).first()[0]
    assert identity.content_id(df.repartition(7, "b").orderBy(F.desc("a"))).first()[0] == one
    assert identity.content_id(df.union(df.limit(1))).first()[0] != one
    assert identity.content_id(df.withColumn("b", F.when(F.col("a") == 0, F.lit(-0.0)).otherwise(F.col("b")))).first()[0] == one
    assert identity.content_id(df.limit(0)).first()[0]
