"""Stages of the dataset job, several builds, and features over frames against features over rows."""

import random

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import identity
from tapeloom.guards import GuardError, Stages
from tapeloom.operators import canonical, features, pit, samples
from tapeloom.plans.build import canonical_build, run_builds
from tests.test_jobs import KEY, SPEC, captures, checks, runs, scope, values


def rows_of(spark, lo, hi, name):
    bars = canonical.canonical_bars(canonical.candidates(captures(spark, 10)))
    return bars.filter((F.minute("event_time") >= 30 + lo) & (F.minute("event_time") < 30 + hi)).withColumn("build_id", F.lit(name))


def test_stages_stop_at_the_first_broken_rule(spark, tmp_path):
    stages = Stages(str(tmp_path / "run"))
    assert stages.stored(spark.range(5), "good", {"negative": F.col("id") < 0}).count() == 5
    with pytest.raises(GuardError, match="too large.*'id': 4"):
        stages.stored(spark.range(5), "bad", {"negative": F.col("id") < 0, "too large": F.col("id") > 3, "zero": F.col("id") == 0})
    with pytest.raises(ValueError, match="before"):
        stages.stored(spark.range(5), "good")
    assert stages.stored(spark.range(0), "none", {"any": F.lit(True)}).count() == 0


def test_builds_are_reconciled_by_event(spark):
    first, second = rows_of(spark, 0, 7, "b1"), rows_of(spark, 4, 10, "b2")
    got = samples.reconciled(first.unionByName(second.withColumn("snapshot_file", F.lit("moved"))))
    assert [(r.build_ids, r.n_contents) for r in got.orderBy("event_time").collect()] == [(["b1"], 1)] * 4 + [(["b1", "b2"], 1)] * 3 + [(["b2"], 1)] * 3
    samples.require_reconciled(got)
    for column, value in (("close", F.col("close") + 1), ("canonical_row_version_id", F.lit("v")), ("ingestion_run_id", F.lit("r")), ("archive_available_at", F.lit(None).cast("timestamp")), ("session", F.lit("OVERNIGHT"))):
        with pytest.raises(GuardError, match="differ"):
            samples.require_reconciled(samples.reconciled(first.unionByName(second.withColumn(column, value))))


def test_pins_name_versions_and_sources_of_each_build(spark):
    builds = rows_of(spark, 0, 7, "b1").unionByName(rows_of(spark, 4, 10, "b2")).unionByName(rows_of(spark, 0, 1, "b0"))
    merged = samples.reconciled(builds).drop("n_contents").cache()
    reqs = samples.requests(merged.filter("event_time >= '2026-07-01 13:31:00'"), seconds=60, feature_bars=2, stride=4)
    assoc = pit.association(pit.candidates(merged, reqs)).cache()  # 31, 32, 35, 36, and 39 is too late
    pins = pit.version_pins(assoc, merged).cache()
    assert pins.groupBy("build_id").count().orderBy("build_id").collect() == [("b1", 4), ("b2", 2)]
    pit.require_pins(assoc, pins, merged)
    one = pins.filter("build_id = 'b2'").limit(1)
    for wrong in (pins.exceptAll(one), pins.unionByName(one.withColumn("canonical_row_version_id", F.lit("v"))), pins.withColumn("source_schema_version", F.lit("2")), pins.filter("build_id = 'b1'")):
        with pytest.raises(GuardError, match="pins"):
            pit.require_pins(assoc, wrong, merged)
    ids = spark.createDataFrame([("b0",), ("b1",), ("b2",)], "build_id string")
    assert [(r.build_id, r.n_row_versions, r.ingestion_run_id) for r in pit.build_pins(pins, ids).orderBy("build_id").collect()] == [("b0", 0, None), ("b1", 4, "r1"), ("b2", 2, "r1")]
    gaps = canonical.gap_ranges(merged.filter("minute(event_time) not in (33, 34)"), 60).withColumn("build_id", F.lit("b1"))
    got = {r.build_id: (r.gap_range_count, r.gap_content_id) for r in pit.gap_references(gaps, ids).collect()}
    assert got["b1"] == (1, identity.content_id(gaps.select("gap_id", "missing_bar_count")).first()[0]) and got["b2"] == got["b0"] == (0, None)


def test_a_dataset_of_two_builds(spark, tmp_path):
    """Two canonical builds that overlap; each stage of the job is written once; a build that differs stops it."""
    r = runs(spark, ("r1", "2026-07-01", "SUCCESS"))
    one = canonical_build(captures(spark, 8), r, checks(spark), KEY, 60, str(tmp_path / "a"))
    two = canonical_build(captures(spark, 8, start="2026-07-01 13:38:00", file="f9"), r, checks(spark), KEY, 60, str(tmp_path / "b"))
    before = spark._jsparkSession.sharedState().statusStore().executionsCount()
    out = run_builds(spark, [two, one], KEY, SPEC, *scope(spark), str(tmp_path / "job"))
    jobs = spark._jsparkSession.sharedState().statusStore().executionsCount() - before
    assert sorted(out.stages) == sorted(["bars", "gaps", "scope", "requests", "association", "frames", "features", "labels", "assigned", "rows", "samples", "version_pins", "build_pins", "gap_references", "known_gaps"])
    assert jobs <= 60  # 15 stages, the verified reads of two builds, ids, manifests and the dataset
    assert out.diagnostics.first().n_requests == 12  # 16 bars in a row, windows of three and two
    assert {(x.build_id, x.n_row_versions) for x in out.build_pins.collect()} == {(one.build_id, 8), (two.build_id, 8)}
    assert {(x.build_id, x.gap_range_count) for x in out.gap_references.collect()} == {(one.build_id, 0), (two.build_id, 0)}
    assert out.version_pins.count() == 16 and out.known_gaps.count() == 0
    facts = {x.name: x.value for x in spark.read.parquet(f"{out.path}/manifest").collect()}
    assert facts["association_id"] == out.association_id and {"pins_id", "gap_references_id"} <= facts.keys()
    other = canonical_build(captures(spark, 8, bump=1.0), r, checks(spark), KEY, 60, str(tmp_path / "c"))
    with pytest.raises(GuardError, match="builds differ"):
        run_builds(spark, [one, other], KEY, SPEC, *scope(spark), str(tmp_path / "no"))
    assert not (tmp_path / "no" / "datasets").exists()


SPECS = [features.FeatureSpec(f"{n} {k}", n, k) for n in ("simple_return", "log_return", "rolling_mean", "rolling_std", "rolling_volume_mean", "volume_ratio") for k in (2, 4)] + [features.FeatureSpec("range", "candle_range"), features.FeatureSpec("body", "candle_body")]


@pytest.mark.parametrize("as_of", [None, "2026-07-02 00:00:00"])
def test_frames_are_the_rows_that_samples_select(spark, as_of):
    """Series with gaps, bars off the grid, late and unarchived bars, several days and sessions: frames must give what the selected rows give."""
    rng = random.Random(9)
    base = canonical.canonical_bars(canonical.candidates(captures(spark, 1))).limit(1)
    rows, t = [], 0
    for i in range(260):
        t += rng.choice([60, 60, 60, 60, 60, 60, 60, 60, 120, 90, 3600 * 5])
        rows.append((i, t, rng.uniform(50, 90), rng.choice([0.0, 1.0, 7.0]) + 1, rng.random() < 0.06, rng.choice([0, 0, 0, 0, 0, 0, 1, 2])))
    spec = spark.createDataFrame(rows, "i int, t long, price double, traded double, late boolean, kept int")
    at = F.timestamp_seconds(F.lit(1782907200) + F.col("t"))
    bars = base.drop("event_time", "open", "high", "low", "close", "volume", "market_available_at", "archive_available_at", "market_calendar_date", "canonical_row_version_id", "session").crossJoin(spec).withColumns({
        "event_time": at, "open": F.col("price") - 1, "high": F.col("price") + 2, "low": F.col("price") - 2, "close": F.col("price"), "volume": F.col("traded"), "market_calendar_date": F.to_date(F.from_utc_timestamp(at, "America/New_York")),
        "market_available_at": at + F.when(F.col("late"), F.expr("interval 5 minutes")).otherwise(F.expr("interval 1 minute")), "session": F.when(F.hour(at) < 14, "PRE_MARKET").otherwise("REGULAR"),
        "archive_available_at": F.when(F.col("kept") == 0, F.lit("2026-07-01").cast("timestamp")).when(F.col("kept") == 1, F.lit("2026-07-05").cast("timestamp")), "canonical_row_version_id": F.concat(F.lit("v"), F.col("i")),
    }).withColumn("canonical_bar_key", F.col("canonical_row_version_id")).drop("i", "t", "price", "traded", "late", "kept").cache()
    minutes = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))
    reqs = bars.select("code", "interval", "adjustment", "requested_session", F.col("market_calendar_date").alias("anchor_market_calendar_date"), (F.col("event_time") - minutes(9)).alias("feature_window_start"), (F.col("event_time") + minutes(1)).alias("feature_window_close"),
                       F.lit(None).cast("timestamp").alias("label_window_start"), F.lit(None).cast("timestamp").alias("label_window_close"), F.col("canonical_bar_key").alias("sample_key"))
    # Windows that end between bars, before any bar, and on another date than their anchor's.
    odd = reqs.limit(40).withColumns({"sample_key": F.concat("sample_key", F.lit("+")), "feature_window_close": F.col("feature_window_close") + F.expr("interval 40 seconds")})
    early = reqs.limit(3).withColumns({"sample_key": F.concat("sample_key", F.lit("-")), "feature_window_close": F.col("feature_window_close") - F.expr("interval 100 days"), "feature_window_start": F.col("feature_window_start") - F.expr("interval 100 days")})
    other = reqs.limit(30).withColumns({"sample_key": F.concat("sample_key", F.lit("!")), "anchor_market_calendar_date": F.date_add("anchor_market_calendar_date", 1)})
    reqs = reqs.unionByName(odd).unionByName(early).unionByName(other).cache()
    assoc = pit.association(pit.candidates(bars, reqs, as_of)).cache()
    frames = {}
    got = features.sliding(bars, reqs, assoc, SPECS, 60, as_of, lambda df, name: frames.setdefault(name, df.cache()))
    want = features.execute(features.gathered(assoc, reqs), SPECS, 60)
    plain = lambda df: {(r.sample_key, r.name): (r.status, r.reason_code, r.n, r.value) for r in df.collect()}
    a, b = plain(got.withColumn("n", F.col("n_consumed"))), plain(want.withColumn("n", F.size("consumed")))
    assert a.keys() == b.keys() and len(a) == reqs.count() * len(SPECS)
    for k in a:
        assert a[k][:3] == b[k][:3] and (a[k][3] is None) == (b[k][3] is None) and (a[k][3] is None or a[k][3] == pytest.approx(b[k][3], rel=1e-9, abs=1e-12)), k
    quick = frames["frames"].filter("_whole").count()
    assert 20 < quick < reqs.count() and {x[1] for x in b.values()} >= {None, "INSUFFICIENT_ROWS", "CROSS_MARKET_DATE", "NON_CONTIGUOUS_ROWS"}


def test_frames_raise_where_rows_raise(spark):
    bars = canonical.canonical_bars(canonical.candidates(captures(spark, 6)))
    reqs = samples.requests(bars, seconds=60, feature_bars=3)
    for column, value, name in (("close", F.lit(0.0), "simple_return"), ("close", F.lit(-1.0), "log_return"), ("close", F.lit(None).cast("double"), "rolling_mean"), ("volume", F.lit(0.0), "volume_ratio"), ("high", F.lit(1.0), "candle_range"), ("close", F.lit(float("nan")), "rolling_std")):
        bent = bars.withColumn(column, F.when(F.minute("event_time") <= 32, value).otherwise(F.col(column)))
        assoc = pit.association(pit.candidates(bent, reqs))
        spec = [features.FeatureSpec("x", name, None if name == "candle_range" else 2)]
        with pytest.raises(Exception, match="no value"):
            features.sliding(bent, reqs, assoc, spec, 60).collect()
    # A bar that no window's last two bars hold may have any price.
    odd = bars.withColumn("close", F.when(F.minute("event_time") == 30, 0.0).otherwise(F.col("close")))
    specs = [features.FeatureSpec(x, x, 2) for x in ("simple_return", "log_return", "volume_ratio")]
    assert features.sliding(odd, reqs, pit.association(pit.candidates(odd, reqs)), specs, 60).filter("status = 'COMPLETE'").count() == 12
