"""Passes over an order and interval questions, against brute force on one hot key."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tapeloom.operators import latest, ordered, quality
from tapeloom.operators.coverage_ranges import merge_ranges, missing_ranges

DAY = dt.date(2023, 11, 1)


def days(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def test_latest_calendar_takes_the_newest_capture_that_covers_a_date(spark):
    rng = random.Random(5)
    rows = []
    for k in range(60):
        scope = rng.choice(["US", "US", "HK"])
        a = rng.randrange(-40, 200)
        b = a + rng.choice([0, 1, 6, 30, 31, 90])
        at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(8)) if rng.random() < 0.95 else None
        rows += [("MARKET", scope, "feed", days(d), days(a), days(b), at, f"run-{k:02d}") for d in range(a, b + 1) if rng.random() < 0.8]
    rows += [("MARKET", "US", "feed", days(500), None, None, None, "old"), ("MARKET", "US", "feed", days(7), days(9), days(3), dt.datetime(2030, 1, 1), "reversed")]
    rows += [("MARKET", "US", "feed", dt.date(1970, 1, 2), dt.date(1969, 12, 1), dt.date(1971, 1, 1), None, "early"), ("MARKET", "US", "feed", dt.date(9999, 12, 31), dt.date(1, 1, 1), dt.date(9999, 12, 31), None, "all")]
    schema = "scope_type string, scope_value string, source string, trade_date date, requested_start_date date, requested_end_date date, captured_at timestamp, ingestion_run_id string"
    df = spark.createDataFrame(rows, schema)
    order = lambda r: (r[6] is not None, r[6] or dt.datetime.min, r[7])
    want = []
    for scope, day in {(r[1], r[3]) for r in rows}:
        covering = [r for r in rows if r[1] == scope and (r[4] or r[3]) <= day <= (r[5] or r[3])]
        if covering:
            best = max(covering, key=order)
            want += [r for r in rows if r[1] == scope and r[3] == day and order(r) == order(best)]
    got = [tuple(r) for r in latest.latest_calendar(df).select(*df.columns).collect()]
    key = lambda r: (r[1], r[3], r[7])
    assert sorted(got, key=key) == sorted(want, key=key) and got


def test_dyadic_spans_make_up_their_range(spark):
    pairs = [(a, b) for a in range(0, 40, 3) for b in range(a - 1, 45)] + [(0, (1 << 23) - 1), (5, 1 << 22), (None, 3)]
    rows = spark.createDataFrame(pairs, "a long, b long").select("a", "b", latest._dyadic(F.col("a"), F.col("b")).alias("s")).collect()
    for r in rows:
        spans = sorted((s.span << s.level, (s.span + 1) << s.level) for s in r.s or [])
        assert len(spans) <= 46
        if r.a is None or r.b < r.a:
            assert not spans
        else:
            assert spans[0][0] == r.a and spans[-1][1] == r.b + 1 and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_ranges_of_one_key(spark):
    rng = random.Random(6)
    rows = [(1, days(a), days(a + rng.choice([-1, 0, 2, 9]))) for a in (rng.randrange(900) for _ in range(400))] + [(2, days(3), None), (2, days(3), days(3))]
    df = spark.createDataFrame(rows, "k int, start date, end date").repartition(5)
    covered = {1: set(), 2: set()}
    for k, a, b in rows:
        if b is not None:
            covered[k] |= {a + dt.timedelta(days=i) for i in range((b - a).days + 1)}
    merged = merge_ranges(df, ["k"])
    got = {k: [] for k in covered}
    for r in merged.collect():
        got[r.k].append((r.start, r.end))
    for k, found in got.items():
        found.sort()
        assert {a + dt.timedelta(days=i) for a, b in found for i in range((b - a).days + 1)} == covered[k]
        assert all((y[0] - x[1]).days > 1 for x, y in zip(found, found[1:]))
    wanted = spark.createDataFrame([(1, days(-9), days(920)), (2, days(0), days(9))], "k int, start date, end date")
    gaps = {k: set() for k in covered}
    for r in missing_ranges(wanted, merged, ["k"]).collect():
        gaps[r.k] |= {r.start + dt.timedelta(days=i) for i in range((r.end - r.start).days + 1)}
    for k, (a, b) in {1: (-9, 920), 2: (0, 9)}.items():
        assert gaps[k] == {days(i) for i in range(a, b + 1)} - covered[k]


def test_steps_back_over_ranges(spark):
    """One key has most rows; steps back lie inside ranges and on their edges."""
    rng = random.Random(7)
    rows, want = [], {}
    for key, n in (("hot", 900), (None, 60), ("one", 1), ("rising", 50)):
        values = [None if rng.random() < 0.05 else rng.randrange(100) for _ in range(n)] if key != "rising" else list(range(n))
        want[key] = sum(b < a for a, b in zip(values, values[1:]) if a is not None and b is not None)
        rows += [(key, i, v) for i, v in enumerate(values)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        df = spark.createDataFrame(rows, "k string, seq int, v int").repartition(7)
        back = ordered.steps_back(df, ["k"], F.col("seq"), F.col("v"))
        assert {r.k: r.n for r in back.collect()} == want
        ranges = df.filter("k = 'hot'").repartitionByRange("k", "seq").select(F.spark_partition_id().alias("p")).distinct().count()
        assert ranges > 5  # one key's rows are in many tasks
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert ordered.steps_back(df.limit(0), ["k"], F.col("seq"), F.col("v")).collect() == []


def test_bar_suite_of_a_null_code(spark):
    rows = [(None, 2, 5), (None, 1, 6), ("a", 1, 6), ("a", 2, 5), ("b", 1, 5), ("b", 2, 5)]
    bars = spark.createDataFrame(rows, "code string, ingest_seq int, t int").select("code", "ingest_seq", F.timestamp_seconds("t").alias("time_utc"), *(F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")), F.lit("1m").alias("interval"), F.lit("NONE").alias("adjustment"))
    got = {r.check_name: r.actual for r in quality.bar_quality(bars).collect()}
    assert got["time_monotonic_by_code"] == "1"
