"""Operators on literal frames, case by case."""

import pytest
from pyspark.sql import functions as F

from tapeloom import schemas
from tapeloom.guards import GuardError
from tapeloom.operators import canonical, catalog, coverage, dataset, features, intraday, labels, latest, normalize, pit, quality, samples, splits
from tapeloom.operators.coverage_ranges import merge_ranges, missing_ranges
from tapeloom.plans import batches
from tapeloom.plans.build import BuildSpec, build
from tapeloom.sources import tables


def values(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def minute_bars(spark, n=10, start="2026-07-01 13:30:00", skip=(), code="US.MU"):
    """Canonical one-minute bars of one symbol."""
    rows = [(code, i, 100.0 + i, 101.0 + i, 99.0 + i, 100.5 + i, 10.0 + i) for i in range(n) if i not in skip]
    df = spark.createDataFrame(rows, "code string, i int, open double, high double, low double, close double, volume double")
    t = F.lit(start).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("i"))
    return df.select(
        "code", F.lit("1m").alias("interval"), F.lit("NONE").alias("adjustment"), F.lit("ALL").alias("requested_session"), t.alias("event_time"), F.to_date(t).alias("market_calendar_date"), F.lit("REGULAR").alias("session"),
        (t + F.expr("interval 1 minute")).alias("market_available_at"), (t + F.expr("interval 1 day")).alias("archive_available_at"), "open", "high", "low", "close", "volume",
        F.concat_ws("-", "code", "i").alias("canonical_bar_key"), F.concat_ws("-", F.lit("v"), "code", "i").alias("canonical_row_version_id"),
    )


def raw_bars(spark, rows):
    return spark.createDataFrame(rows, "code string, time_key string, open string, high double, low double, close double, volume double, extra int, ingest_seq long")


def curated(spark, raw, run="r1"):
    return normalize.normalize_bars(raw, trade_date=F.lit("2026-07-01").cast("date"), interval="1M", session="all", adjustment="none", source="s", schema_version="1", run_id=F.lit(run), ingested_at=F.lit("2026-07-02").cast("timestamp"))


def test_normalize_bars(spark):
    raw = raw_bars(spark, [(" us.mu ", "2026-07-01 09:30:00", "x", 2.0, 1.0, 1.5, 5.0, 7, 1)])
    row = curated(spark, raw).first()
    assert (row.code, row.open, row.session, str(row.time_utc), row.interval, row.extra) == ("US.MU", None, "REGULAR", "2026-07-01 13:30:00", "1m", 7)
    assert curated(spark, raw.limit(0)).count() == 0
    with pytest.raises(ValueError, match="missing columns"):
        curated(spark, raw.drop("volume"))


def test_bar_quality_counts(spark):
    rows = [("A", "2026-07-01 09:31:00", "1", 2.0, 1.0, 1.5, 5.0, 0, 1), ("A", "2026-07-01 09:30:00", "1", 0.5, 1.0, 1.5, None, 0, 2), ("A", "2026-07-01 09:30:00", None, 2.0, 1.0, 1.5, -1.0, 0, 3), ("A", "2026-07-01 09:30:00", "nan", 2.0, 1.0, 1.5, 1.0, 0, 4)]
    got = {r.check_name: (r.result, r.actual) for r in quality.bar_quality(curated(spark, raw_bars(spark, rows))).collect()}
    assert got["duplicate_bars"] == ("FAIL", "2") and got["ohlc_consistency"] == ("FAIL", "1") and got["non_negative_volume"] == ("FAIL", "2")
    assert got["time_monotonic_by_code"] == ("FAIL", "1") and got["non_null_prices"] == ("FAIL", "2") and got["non_empty"] == ("PASS", "0")
    assert values(quality.bar_quality(curated(spark, raw_bars(spark, rows)).limit(0))) == [("non_empty", "FAIL", "1")]
    assert values(quality.bar_quality(curated(spark, raw_bars(spark, rows)).drop("close", "code"))) == [("non_empty", "PASS", "0"), ("required_columns", "FAIL", "close, code")]


def test_calendar_withdraws_dates(spark):
    rows = [("2026-07-01", "WHOLE", "2026-01-01", "old"), ("2026-07-02", "WHOLE", "2026-01-01", "old"), ("2026-07-03", "WHOLE", "2026-01-01", "old"), ("2026-07-01", "WHOLE", "2026-02-01", "new"), ("2026-07-02", "MORNING", "2026-02-01", "new")]
    df = spark.createDataFrame(rows, "d string, trade_date_type string, c string, ingestion_run_id string").select(
        F.lit("MARKET").alias("scope_type"), F.lit("US").alias("scope_value"), F.col("d").cast("date").alias("trade_date"), "trade_date_type", F.lit("2026-07-01").cast("date").alias("requested_start_date"),
        F.lit("2026-07-03").cast("date").alias("requested_end_date"), F.col("c").cast("timestamp").alias("captured_at"), F.lit("s").alias("source"), "ingestion_run_id",
    )
    got = values(latest.latest_calendar(df).select(F.col("trade_date").cast("string"), "trade_date_type"), "trade_date")
    assert got == [("2026-07-01", "WHOLE"), ("2026-07-02", "MORNING")]
    with pytest.raises(ValueError):
        latest.load_calendar(df, market="US", code="X")


def test_ranges(spark):
    df = spark.createDataFrame([(1, "2026-01-01", "2026-01-05"), (1, "2026-01-06", "2026-01-07"), (1, "2026-01-10", "2026-01-10"), (1, "2026-01-02", "2026-01-03"), (2, "2026-03-01", "2026-02-01")], "k int, start string, end string")
    df = df.select("k", F.col("start").cast("date"), F.col("end").cast("date"))
    text = lambda x: values(x.select("k", F.col("start").cast("string"), F.col("end").cast("string")), "k", "start")
    merged = merge_ranges(df, ["k"])
    assert text(merged) == [(1, "2026-01-01", "2026-01-07"), (1, "2026-01-10", "2026-01-10")]
    wanted = spark.createDataFrame([(1, "2025-12-30", "2026-01-12"), (2, "2026-01-01", "2026-01-02")], "k int, start string, end string").select("k", F.col("start").cast("date"), F.col("end").cast("date"))
    assert text(missing_ranges(wanted, merged, ["k"])) == [(1, "2025-12-30", "2025-12-31"), (1, "2026-01-08", "2026-01-09"), (1, "2026-01-11", "2026-01-12"), (2, "2026-01-01", "2026-01-02")]
    far = wanted.filter("k = 1").withColumn("start", F.lit("2026-05-01").cast("date")).withColumn("end", F.lit("2026-05-02").cast("date"))
    assert text(missing_ranges(far, merged, ["k"])) == [(1, "2026-05-01", "2026-05-02")]


def test_null_failed_run_fails_no_other(spark):
    q = spark.createDataFrame([(None, "FAIL"), ("a", "PASS")], "run_id string, result string")
    assert coverage.failed_runs(q).count() == 0
    assert [r[0] for r in spark.createDataFrame([(0, 1, 0), (1, 0, 0), (2, 1, 0), (2, 0, 1), (2, 0, 0)], "a int, b int, c int").select(coverage.batch_status(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["FAILED", "SUCCESS", "PARTIAL", "PARTIAL", "SUCCESS"]


def test_segments_restart_on_repeated_label(spark):
    times = ["2026-07-01 13:28:00", "2026-07-01 13:29:00", "2026-07-01 13:30:00", "2026-07-01 13:33:00", "2026-07-01 20:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.lit("A").alias("code"), F.lit("2026-07-01").cast("date").alias("requested_trade_date"), F.col("t").cast("timestamp").alias("time_utc"), F.lit(1.0).alias("open"), F.lit(1.0).alias("close"), F.lit(1.0).alias("volume"))
    got = values(intraday.segments(df, 60).select("segment", "session", "row_count", "gap_count", "missing_bars"), "segment")
    assert got == [(1, "PRE_MARKET", 2, 0, 0), (2, "REGULAR", 2, 1, 2), (3, "AFTER_HOURS", 1, 0, 0)]


def test_conflicts_and_order_independence(spark):
    t = "2026-07-01 13:30:00"
    rows = [("A", t, 1.0, "r1", "2026-07-02", None), ("A", t, 1.0, "r2", "2026-07-03", None), ("B", t, 1.0, "r1", "2026-07-02", None), ("B", t, 2.0, "r2", "2026-07-03", 5.0), ("C", t, 0.0, "r1", "2026-07-02", None), ("C", t, -0.0, "r2", None, None)]
    df = spark.createDataFrame(rows, "code string, t string, close double, ingestion_run_id string, i string, turnover double").select(
        "code", F.col("t").cast("timestamp").alias("time_utc"), F.lit("1m").alias("interval"), F.lit("NONE").alias("adjustment"), "close", "turnover", F.lit("REGULAR").alias("session"), F.lit("2026-07-01").cast("date").alias("market_calendar_date"),
        F.lit("2026-07-01").cast("date").alias("requested_trade_date"), "ingestion_run_id", F.col("ingestion_run_id").alias("snapshot_file"), F.col("i").cast("timestamp").alias("ingested_at"), F.lit("1").alias("source_schema_version"), F.col("t").cast("timestamp").alias("time_market"),
    )
    ranked = canonical.candidates(df)
    assert values(canonical.conflicts(ranked).select("code", "fields")) == [("B", ["close", "turnover"])]
    with pytest.raises(GuardError):
        canonical.require_no_conflicts(ranked)
    assert values(canonical.canonical_bars(ranked).select("code", "ingestion_run_id"), "code") == [("A", "r2"), ("B", "r2"), ("C", "r1")]
    again = canonical.candidates(df.orderBy(F.rand(3)).repartition(3))
    assert values(canonical.resolution(again).selectExpr("selected.ingestion_run_id", "size(discarded)"), "ingestion_run_id") == values(canonical.resolution(ranked).selectExpr("selected.ingestion_run_id", "size(discarded)"), "ingestion_run_id")


def test_gap_off_the_grid_raises(spark):
    bars = minute_bars(spark, 3).withColumn("event_time", F.when(F.col("close") > 102, F.col("event_time") + F.expr("interval 90 seconds")).otherwise(F.col("event_time")))
    with pytest.raises(GuardError, match="grid"):
        canonical.gap_ranges(bars, 60)


def test_build_is_verified_and_reused(spark, tmp_path):
    bars = minute_bars(spark, 10, skip=(4,)).withColumn("canonical_bar_key", F.lit(""))
    from tapeloom.functions import identity

    bars = bars.withColumn("canonical_bar_key", identity.bar_key(F.col("code"), F.col("interval"), F.col("adjustment"), F.col("event_time")))
    gaps = canonical.gap_ranges(bars, 60)
    one = canonical.materialize(spark, bars, gaps, str(tmp_path))
    assert canonical.materialize(spark, bars.orderBy(F.desc("event_time")), gaps, str(tmp_path)) == one
    assert canonical.verified_build(spark, one[1], bars.schema, one[0], 60).count() == 9
    with pytest.raises(ValueError):
        canonical.verified_build(spark, one[1], bars.schema, "other")


SPEC = BuildSpec(
    seconds=60, feature_bars=3, label_bars=2, split=splits.SplitSpec("2026-07-01", "2026-07-02", "2026-07-03"),
    features=(features.FeatureSpec("r", "simple_return", 2), features.FeatureSpec("m", "rolling_mean", 3)), labels=(labels.LabelSpec("f", "forward_return", 2), labels.LabelSpec("up", "maximum_favorable_excursion", 2)),
)


def test_chain_on_ten_bars(spark, tmp_path):
    b = build(minute_bars(spark), SPEC)
    rows = b.rows.orderBy("feature_window_close").collect()
    assert len(rows) == 6  # anchors at positions 2 to 7
    first = rows[0]
    assert first.r == pytest.approx(102.5 / 101.5 - 1) and first.m == pytest.approx(101.5) and first.f == pytest.approx(104.5 / 102.5 - 1) and first.up == pytest.approx(105.0 / 102.5 - 1)
    assert {r.final_split for r in rows} == {"TRAIN"} and str(first.actual_label_end_time) == "2026-07-01 13:35:00"
    assert b.association.filter((F.col("role") == "FEATURE") & (F.col("market_available_at") > F.col("feature_window_close"))).count() == 0
    counts = dataset.diagnostics(b.assigned, b.requests).first()
    assert counts.n_rows == counts.n_assigned + counts.n_purged + counts.n_excluded and counts.n_requests == counts.n_rows + counts.n_without_features
    own, path = dataset.materialize(b.rows, str(tmp_path))
    assert dataset.materialize(b.rows, str(tmp_path)) == (own, path)
    assert dataset.verified(spark, path, own, SPEC.split, b.rows.schema).count() == 6
    assert len(values(dataset.page(b.rows, 1, 2))) == 2
    resolved = features.with_bars(b.association, minute_bars(spark))
    features.require_row_contract(resolved, b.requests)
    labels.require_row_contract(resolved, b.requests)
    with pytest.raises(GuardError):
        features.require_row_contract(resolved.withColumn("market_available_at", F.col("market_available_at") + F.expr("interval 1 day")), b.requests)
    with pytest.raises(GuardError):
        labels.require_row_contract(resolved.withColumn("code", F.lit("X")), b.requests)
    pit.require_pins(b.association, b.association.select("canonical_row_version_id"))
    with pytest.raises(GuardError):
        pit.require_pins(b.association, b.association.select("canonical_row_version_id").limit(1))


def test_gap_breaks_samples_and_windows_are_checked(spark):
    assert build(minute_bars(spark, skip=(4,)), SPEC).requests.count() == 1  # 0-3 is too short, 5-9 has one anchor
    with pytest.raises(ValueError):
        samples.requests(minute_bars(spark), seconds=60, feature_bars=0)


def test_leakage_defences(spark):
    bars = minute_bars(spark)
    late = bars.withColumn("market_available_at", F.col("market_available_at") + F.expr("interval 1 hour"))
    reqs = samples.requests(bars, seconds=60, feature_bars=3, label_bars=2)
    got = {r.role: r for r in pit.diagnostics(pit.candidates(late, reqs), reqs).collect()}
    assert got["FEATURE"].n_selected == 0 and got["FEATURE"].n_not_market_available == 18 and got["LABEL"].n_selected == 0 and got["LABEL"].n_not_market_available == 12
    none = pit.diagnostics(pit.candidates(bars, reqs, "2026-07-01 00:00:00"), reqs).collect()
    assert all(r.n_selected == 0 and r.n_not_archived == r.n_candidates for r in none)


def test_purge_at_the_boundary(spark):
    rows = [("a", "2026-07-02 03:00:00", "COMPLETE", "2026-07-02 03:59:59"), ("b", "2026-07-02 03:00:00", "COMPLETE", "2026-07-02 04:00:00"), ("c", "2026-07-02 03:00:00", "INCOMPLETE", "2026-07-02 05:00:00"), ("d", "2026-07-09 03:00:00", "COMPLETE", None), ("e", "2026-07-04 03:00:00", "COMPLETE", "2026-07-09 04:00:00")]
    df = spark.createDataFrame(rows, "sample_key string, x string, label_status string, y string").select("sample_key", F.col("x").cast("timestamp").alias("feature_window_close"), "label_status", F.col("y").cast("timestamp").alias("actual_label_end_time"))
    out = splits.assigned(df, SPEC.split)
    assert values(out.select("sample_key", "assignment_status", "final_split"), "sample_key") == [("a", "ASSIGNED", "TRAIN"), ("b", "PURGED", None), ("c", "EXCLUDED", None), ("d", "EXCLUDED", None), ("e", "ASSIGNED", "TEST")]
    assert splits.mismatches(out, SPEC.split).count() == 0
    assert splits.mismatches(out.withColumn("final_split", F.lit("TEST")), SPEC.split).count() == 4
    with pytest.raises(ValueError):
        splits.SplitSpec("2026-07-02", "2026-07-01", "2026-07-03")
    with pytest.raises(GuardError):
        splits.require_unique_samples(df.union(df))


def test_feature_faults_raise(spark):
    bars = minute_bars(spark, 4).withColumn("close", F.when(F.col("close") == 100.5, 0.0).otherwise(F.col("close")))
    with pytest.raises(Exception, match="no value"):
        build(bars, BuildSpec(seconds=60, feature_bars=2, label_bars=1, split=SPEC.split, features=(features.FeatureSpec("r", "simple_return", 2),), labels=(labels.LabelSpec("f", "forward_return", 1),))).features.collect()
    with pytest.raises(ValueError, match="window"):
        features.execute(bars, [features.FeatureSpec("r", "simple_return", 1)], 60)


def test_catalog(spark):
    rows = build(minute_bars(spark), SPEC).rows.withColumn("dataset_id", F.lit("d1"))
    e = catalog.entries(rows)
    both = catalog.built([e, e.withColumn("dataset_id", F.lit("d2"))])
    assert [r.dataset_id for r in catalog.search(both, symbol="US.MU", date="2026-07-01", offset=1, limit=5).collect()] == ["d2"]
    assert catalog.search(both, symbol="NO").count() == 0 and catalog.lookup(both, "d1").count() == 1
    assert catalog.snapshot_id(both).first()[0] != catalog.snapshot_id(e).first()[0]
    with pytest.raises(GuardError):
        catalog.built([e, e])


def test_batches_and_sources(spark, tmp_path):
    roots = batches.Roots(*(str(tmp_path / x) for x in ("raw", "curated", "runs", "quality")))
    raw = raw_bars(spark, [("A", f"2026-07-01 09:3{i}:00", "1", 2.0, 1.0, 1.5, 5.0, 0, i) for i in range(5)])
    run = batches.collect_bars(raw, roots, run_id="r1", trade_date="2026-07-01", interval="1m", session="ALL", adjustment="NONE", source="s", schema_version="1").first()
    assert (run.status, run.row_count) == ("SUCCESS", 5)
    bars = tables.read_bars(spark, roots.curated)
    assert bars.count() == 5 and bars.filter("name is null and turnover is null").count() == 5
    files = tables.file_inventory(bars, "curated")
    assert tables.inventory_totals(files).first().n_legacy == 0 and tables.file_hashes(spark, roots.curated).count() == files.count()
    one = files.first().path
    assert tables.read_snapshot(spark, one, "A").count() > 0 and "snapshot_file" in tables.read_bars_with_file(spark, roots.curated).columns
    bad = batches.collect_bars(raw.union(raw), roots, run_id="r2", trade_date="2026-07-01", interval="1m", session="ALL", adjustment="NONE", source="s", schema_version="1").first()
    assert bad.status == "PARTIAL"
    cal = spark.createDataFrame([("2026-07-01", "TradeDateType.MORNING"), ("2026-07-02", "ODD")], "time string, trade_date_type string")
    roots2 = batches.Roots(*(str(tmp_path / x) for x in ("raw2", "cal", "runs2", "quality2")))
    got = batches.collect_calendar(cal, roots2, run_id="c1", market="us", code=None, start="2026-07-01", end="2026-07-03", captured_at=F.lit("2026-07-05").cast("timestamp"), source="s", schema_version="1").first()
    assert got.status == "PARTIAL"  # an unknown type is a warning
    assert tables.read_calendar(spark, roots2.curated).count() == 2


def test_upsert_keeps_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z")], "run_id string, recorded_at int, v string")
    assert values(tables.upsert_latest(df).select("run_id", "v"), "run_id") == [("a", "y"), ("b", "z")]


def test_option_contracts_keep_last(spark):
    raw = spark.createDataFrame([("US.MU260821C100000", "old", "100", "2026-08-21", 1), ("US.MU260821C100000", "new", "bad", "2026-08-21", 2)], "code string, name string, strike_price string, strike_time string, ingest_seq long")
    row = normalize.normalize_option_contracts(raw, underlying_code="US.X", captured_at=F.lit("2026-01-01").cast("timestamp"), source="s", schema_version="1", run_id="r").first()
    assert (row.option_name, row.strike_price, row.underlying_code, row.option_type) == ("new", None, "US.MU", "CALL")


def test_symbols(spark):
    df = spark.createDataFrame([(" mu ",), ("MU",), ("a",)], "symbol string")
    assert values(normalize.symbols(df), "code") == [("A",), ("MU",)]
    with pytest.raises(Exception, match="blank"):
        normalize.symbols(spark.createDataFrame([(" ",)], "symbol string")).collect()


def test_schemas_parse():
    for s in (schemas.CURATED_BARS, schemas.INGESTION_RUNS, schemas.QUALITY_RESULTS, schemas.DATASET_RUNS, schemas.TRADING_CALENDAR, schemas.OPTION_CONTRACTS, schemas.OPTION_VOLATILITY):
        assert schemas.names(s)
