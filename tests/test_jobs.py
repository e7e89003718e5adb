"""Whole jobs, stored builds and the rules that stop them."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import identity
from tapeloom.guards import GuardError
from tapeloom.operators import canonical, catalog, coverage, coverage_ranges, dataset, features, intraday, labels, latest, normalize, pit, quality, samples, splits
from tapeloom.plans import batches
from tapeloom.plans.build import BuildSpec, build, require_sound, run
from tapeloom.sources import tables

KEY = coverage.RequestKey(interval="1m")
SPEC = BuildSpec(
    seconds=60, feature_bars=3, label_bars=2, split=splits.SplitSpec("2026-07-01", "2026-07-02", "2026-07-03"),
    features=(features.FeatureSpec("r", "simple_return", 2),), labels=(labels.LabelSpec("f", "forward_return", 2), labels.LabelSpec("d", "forward_direction", 1)),
)


def values(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def captures(spark, n=10, run_id="r1", day="2026-07-01", file="f1", start="2026-07-01 13:30:00", code="A", bump=0.0):
    rows = spark.range(n).select(F.col("id").cast("int").alias("i"))
    t = F.lit(start).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("i"))
    price = F.lit(100.0) + F.col("i")
    return rows.select(
        F.lit(code).alias("code"), F.lit("1m").alias("interval"), F.lit("NONE").alias("adjustment"), F.lit("ALL").alias("requested_session"), t.alias("time_utc"), t.alias("time_market"),
        F.to_date(F.lit(start)).alias("market_calendar_date"), F.lit(day).cast("date").alias("requested_trade_date"), F.lit("REGULAR").alias("session"), price.alias("open"), (price + 1 + bump).alias("high"), (price - 1).alias("low"),
        (price + 0.5 + bump).alias("close"), F.lit(5.0).alias("volume"), F.lit("1").alias("source_schema_version"), F.lit(run_id).alias("ingestion_run_id"), F.lit("2026-07-05").cast("timestamp").alias("ingested_at"), F.lit(file).alias("snapshot_file"),
    )


def runs(spark, *rows):
    df = spark.createDataFrame([(r, d, s) for r, d, s in rows], "run_id string, d string, status string")
    return df.select("run_id", F.col("d").cast("date").alias("requested_trade_date"), F.lit("1m").alias("interval"), F.lit("ALL").alias("session"), F.lit("NONE").alias("adjustment"), "status", F.lit("2026-07-05 01:00:00").cast("timestamp").alias("finished_at"))


def checks(spark, *rows):
    return spark.createDataFrame([(r, x) for r, x in rows] or [("none", "PASS")], "run_id string, result string")


def scope(spark):
    return spark.createDataFrame([("A",)], "code string"), spark.createDataFrame([("2026-07-01",)], "d string").select(F.col("d").cast("date").alias("trade_date"))


def test_the_whole_job(spark, tmp_path):
    good = captures(spark)
    bad = captures(spark, run_id="r2", file="f2", bump=3.0)  # newer or not, its run failed
    out = run(good.unionByName(bad), runs(spark, ("r1", "2026-07-01", "SUCCESS"), ("r2", "2026-07-01", "FAILED")), checks(spark), KEY, SPEC, *scope(spark), str(tmp_path))
    rows = dataset.verified(spark, out.path, out.dataset_id, SPEC.split)
    assert rows.count() == 6 and dict(rows.dtypes)["d"] == "bigint" and rows.agg(F.max("r")).first()[0] == pytest.approx(102.5 / 101.5 - 1, abs=1e-2)
    assert values(out.completion.select("code", "status")) == [("A", "COMPLETE")] and out.diagnostics.first().n_train == 6
    # Failed captures leave no trace, nor do the places of files and rows.
    again = run(good.repartition(3).withColumn("snapshot_file", F.lit("/elsewhere/f1")), runs(spark, ("r1", "2026-07-01", "SUCCESS")), checks(spark), KEY, SPEC, *scope(spark), str(tmp_path / "other"))
    assert again.dataset_id == out.dataset_id


@pytest.mark.parametrize("fault", ["session", "number", "conflict", "quality"])
def test_faults_stop_the_job(spark, tmp_path, fault):
    df, q = captures(spark), checks(spark)
    r = runs(spark, ("r1", "2026-07-01", "SUCCESS"), ("r2", "2026-07-02", "SUCCESS"))
    if fault == "session":
        df = df.withColumn("session", F.lit("OVERNIGHT"))
    if fault == "number":
        df = df.withColumn("close", F.when(F.col("open") != 103, F.col("close")))
    if fault == "conflict":  # another day's snapshot has one of the bars with another price
        df = df.unionByName(captures(spark, 2, "r2", "2026-07-02", "f2", bump=1.0))
    if fault == "quality":
        q = checks(spark, ("r1", "FAIL"))
        assert run(df, r, q, KEY, SPEC, *scope(spark), str(tmp_path)).diagnostics.first().n_requests == 0
        return
    with pytest.raises(GuardError):
        run(df, r, q, KEY, SPEC, *scope(spark), str(tmp_path))
    assert not (tmp_path / "datasets").exists()


def canonical_rows(spark, n=10):
    return canonical.canonical_bars(canonical.candidates(captures(spark, n)))


def test_every_rule_of_a_build(spark):
    bars = canonical_rows(spark).cache()
    b = build(bars, SPEC)
    b = dataclasses.replace(b, **{x: getattr(b, x).cache() for x in ("requests", "association", "features", "labels", "assigned")})
    symbols, dates = scope(spark)
    require_sound(b, bars, symbols, dates)
    late = lambda c: F.col(c) + F.expr("interval 1 day")
    broken = [
        (b, bars.unionByName(bars), symbols, dates),
        (dataclasses.replace(b, requests=b.requests.union(b.requests)), bars, symbols, dates),
        (dataclasses.replace(b, association=b.association.withColumn("market_calendar_date", F.date_add("market_calendar_date", 1))), bars, symbols, dates),
        (dataclasses.replace(b, association=b.association.withColumn("market_available_at", late("market_available_at"))), bars, symbols, dates),
        (dataclasses.replace(b, association=b.association.filter("not (role = 'FEATURE' and position = 1)")), bars, symbols, dates),
        (dataclasses.replace(b, assigned=b.assigned.union(b.assigned)), bars, symbols, dates),
        (dataclasses.replace(b, assigned=b.assigned.withColumn("sample_key", F.lit("x")).limit(1)), bars, symbols, dates),
        (b, bars, symbols.limit(0), dates),
        (b, bars, symbols, dates.limit(0)),
    ]
    for case in broken:
        with pytest.raises(GuardError):
            require_sound(*case)


def test_unfinished_builds_are_written_again(spark, tmp_path):
    bars = canonical_rows(spark, 10).filter("open <> 104")
    ranked = canonical.candidates(captures(spark))
    gaps = canonical.gap_ranges(bars, 60)
    build_id, path = canonical.materialize(spark, bars, gaps, str(tmp_path), ranked)
    assert canonical.verified_build(spark, path, bars.schema, build_id, 60).count() == 9
    # Without the manifest it counts as unfinished; with other bars than the manifest says it is refused.
    spark.range(0).write.mode("overwrite").parquet(f"{path}/manifest")
    with pytest.raises(ValueError, match="manifest"):
        canonical.verified_build(spark, path, bars.schema, build_id)
    assert canonical.materialize(spark, bars, gaps, str(tmp_path), ranked) == (build_id, path)
    kept = spark.createDataFrame(bars.collect(), bars.schema)
    tables.write_canonical(kept.withColumn("close", F.col("close") + 1), f"{path}/bars", mode="overwrite")
    with pytest.raises(ValueError, match="content id"):
        canonical.verified_build(spark, path, bars.schema, build_id)
    tables.write_canonical(kept, f"{path}/bars", mode="overwrite")
    tables.write_gaps(gaps.withColumn("missing_bar_count", F.lit(7).cast("long")), f"{path}/gaps", mode="overwrite")
    with pytest.raises(ValueError, match="gaps"):
        canonical.verified_build(spark, path, bars.schema, build_id, 60)
    assert spark.read.json(f"{path}/resolution").count() == 10


def test_catalog_snapshots(spark, tmp_path):
    rows = build(canonical_rows(spark), SPEC).rows.withColumn("dataset_id", F.lit("d1"))
    e = catalog.entries(rows)
    own, path = catalog.materialize(e, str(tmp_path))
    assert catalog.materialize(e, str(tmp_path)) == (own, path) and catalog.verified(spark, path, own, e.schema).count() == 1
    with pytest.raises(ValueError):
        catalog.verified(spark, path, "other", e.schema)
    assert tables.read_manifest(spark, str(tmp_path / "nowhere")) is None


def test_digests_tell_values_apart(spark):
    one, two = identity.digest(F.lit("a\x1f1=b"), F.lit("c")), identity.digest(F.lit("a"), F.lit("b\x1f1=c"))
    assert spark.range(1).select(one == two).first()[0] is False
    assert spark.range(1).select(identity.digest(F.lit("é"), F.lit("bc"))).first()[0] == identity.text_digest("é", "bc")
    df = spark.range(500)
    ids = [identity.content_id(x, prefix=8).first()[0] for x in (df, df.repartition(7), df.limit(499))]
    assert ids[0] == ids[1] != ids[2]


def test_versions_follow_the_content(spark):
    df = captures(spark, 3)
    ids = lambda x: {r[0] for r in canonical.candidates(x).select("canonical_row_version_id").collect()}
    assert ids(df) == ids(df.withColumn("snapshot_file", F.lit("moved"))) and not ids(df) & ids(df.withColumn("close", F.col("close") + 1))
    assert canonical.source_count(canonical.candidates(df)).first()[0] == 1


def test_inventory_counts_completion_by_request(spark):
    df = captures(spark).unionByName(captures(spark).withColumns({"interval": F.lit("60m"), "ingestion_run_id": F.lit("r9")}))
    r = runs(spark, ("r1", "2026-07-01", "FAILED")).unionByName(runs(spark, ("r9", "2026-07-01", "SUCCESS")).withColumn("interval", F.lit("60m")))
    got = {x.interval: x.n_complete for x in coverage.inventory(df, coverage.completed_by_request(df, r, checks(spark))).collect()}
    assert got == {"1m": 0, "60m": 1} and coverage.inventory_totals(df).first().n_keys == 2


def test_coverage_without_a_calendar(spark):
    symbols, dates = scope(spark)
    states = coverage.item_states(symbols, dates, captures(spark), captures(spark))
    whole = spark.sql("SELECT DATE'2026-07-01' AS start, DATE'2026-07-03' AS end")
    part = spark.sql("SELECT DATE'2026-07-01' AS start, DATE'2026-07-02' AS end")
    assert coverage.audit_totals(states.distinct(), coverage.calendar_gaps(whole, whole)).first().status == "PASS"
    failed = coverage.audit_totals(states, coverage.calendar_gaps(whole, part)).first()
    assert (failed.status, failed.expected_count, failed.calendar_gap_count) == ("FAILED", None, 1)
    starts = symbols.withColumn("start", F.lit("2026-07-01").cast("date"))
    with pytest.raises(GuardError, match="calendar"):
        coverage.backfill_plan(starts, dates, captures(spark), coverage.calendar_gaps(whole, part))


def test_missing_columns_and_empty_batches(spark):
    suites = [
        (quality.option_contract_quality, quality.CONTRACT_COLUMNS, ()),
        (quality.option_volatility_quality, quality.VOLATILITY_COLUMNS, ("2026-01-01", "2026-02-01")),
        (quality.calendar_quality, quality.CALENDAR_COLUMNS, ("2026-01-01", "2026-02-01")),
    ]
    for suite, columns, more in suites:
        df = spark.createDataFrame([("x",)], "other string")
        assert values(suite(df, *more)) == [("non_empty", "PASS", "0"), ("required_columns", "FAIL", ", ".join(sorted(columns)))]
        assert values(suite(df.limit(0), *more)) == [("non_empty", "FAIL", "1")]


def test_snapshot_without_valid_times(spark):
    df = captures(spark, 3).withColumn("time_market", F.lit(None).cast("timestamp"))
    expected = {"interval": "1m", "adjustment": "NONE", "requested_session": "ALL", "source_schema_version": "1"}
    got = {r.check_name: (r.result, r.mismatch_count, r.details) for r in intraday.checks(df, expected, 60).collect()}
    assert got["VALID_TIMESTAMPS"] == ("FAIL", 3, "") and all(got[c] == ("INFO", 0, "NOT_EVALUATED") for c in intraday.TIMED)
    odd = {r.check_name: (r.result, r.details) for r in intraday.checks(captures(spark, 3).withColumn("session", F.lit("X")), expected, 60).collect()}
    assert odd["REQUESTED_SESSION_SCOPE"] == ("FAIL", "X: 3")
    mixed = captures(spark, 6).withColumn("session", F.when(F.minute("time_utc") == 30, "A").when(F.minute("time_utc") == 31, F.lit(None)).when(F.minute("time_utc") < 35, "Z").otherwise("REGULAR"))
    assert {r.check_name: r.details for r in intraday.checks(mixed, expected, 60).collect()}["REQUESTED_SESSION_SCOPE"] == "Z: 3, A: 1, None: 1"
    other = {r.check_name: (r.result, r.details) for r in intraday.checks(mixed, expected | {"requested_session": "ETH"}, 60).collect()}
    assert other["REQUESTED_SESSION_SCOPE"] == ("INFO", "SESSION_SCOPE_NOT_EVALUATED")


def test_latest_runs_break_ties_by_their_columns(spark):
    rows = [("r", 1, {"a": "1", "b": "2"}, "x"), ("r", 1, {"b": "2", "a": "1"}, "y"), ("r", 0, {"z": "9"}, "z"), ("r", None, {"z": "9"}, "zz"), ("s", None, None, None)]
    got = tables.upsert_latest(spark.createDataFrame(rows, "run_id string, recorded_at int, failed_items map<string,string>, status string"))
    assert [(r.run_id, r.status) for r in got.orderBy("run_id").collect()] == [("r", "y"), ("s", None)]


def test_gaps_are_known_at_their_windows_close(spark):
    t = lambda x: F.lit(f"2026-07-01 {x}").cast("timestamp")
    facts = spark.range(1).select(
        F.lit("g").alias("gap_id"), F.lit("A").alias("code"), F.lit("1m").alias("interval"), F.lit("NONE").alias("adjustment"), F.lit("REGULAR").alias("session"),
        t("13:31:00").alias("missing_from_event_time"), t("13:33:00").alias("missing_to_event_time"), t("13:35:00").alias("market_known_at"), t("14:00:00").alias("archive_known_at"),
    )
    reqs = spark.createDataFrame([("early", "13:34:00", "13:34:00", "13:34:30"), ("late", "13:34:00", "13:33:00", "13:36:00")], "sample_key string, a string, b string, c string").select(
        "sample_key", F.lit("A").alias("code"), F.lit("1m").alias("interval"), F.lit("NONE").alias("adjustment"), F.lit("ALL").alias("requested_session"), F.lit("2026-07-01").cast("date").alias("anchor_market_calendar_date"),
        t("13:30:00").alias("feature_window_start"), *(F.concat(F.lit("2026-07-01 "), x).cast("timestamp").alias(y) for x, y in (("a", "feature_window_close"), ("b", "label_window_start"), ("c", "label_window_close"))),
    )
    assert values(pit.known_gaps(facts, reqs)) == [("late", "LABEL", ["g"])]
    assert values(pit.known_gaps(facts, reqs, "2026-07-01 13:59:00")) == []


def test_windows_of_very_different_lengths(spark):
    bars = canonical_rows(spark, 300)
    short, long = (samples.requests(bars, seconds=60, feature_bars=n, label_bars=1) for n in (2, 200))
    reqs = short.union(long)
    got = pit.candidates(bars, reqs).groupBy("sample_key", "role").count().groupBy("role", "count").agg(F.count("*").alias("n"))
    assert values(got, "role", "count") == [("FEATURE", 2, 298), ("FEATURE", 200, 100), ("LABEL", 1, 398)]


def test_guards_of_samples(spark):
    bars = canonical_rows(spark)
    with pytest.raises(GuardError):
        samples.require_unique(bars.union(bars))
    reqs = samples.requests(bars, seconds=60, feature_bars=2)
    with pytest.raises(GuardError):
        samples.require_unique_keys(reqs.union(reqs))
    assert samples.shortfalls(bars, seconds=60, feature_bars=3, label_bars=2).first().asDict() == {"n_segments": 1, "n_short_segments": 0, "n_unlabelled_anchors": 2}


def test_option_batches_and_failed_symbols(spark, tmp_path):
    roots = batches.Roots(*(str(tmp_path / x) for x in ("raw", "curated", "runs", "quality")))
    raw = spark.createDataFrame([("US.MU260821C100000", "n", "CALL", "100", "2026-08-21", "1")], "code string, name string, option_type string, strike_price string, strike_time string, lot_size string")
    row = batches.collect_contracts(raw, roots, run_id="o1", underlying_code="US.MU", captured_at=F.lit("2026-07-01").cast("timestamp"), source="s", schema_version="1").first()
    assert (row.status, row.row_count, row.successful_items, row.failed_items) == ("SUCCESS", 1, ["US.MU"], {}) and len(row.config_hash) == 64 and row.started_at <= row.finished_at
    assert tables.read_option_contracts(spark, roots.curated).count() == 1 and tables.read_raw(spark, roots.raw).first().strike_price == "100"
    vol = spark.createDataFrame([("2026-07-01", "0.5"), ("2026-07-02", "-1")], "timestamp_str string, implied_volatility string")
    roots2 = batches.Roots(*(str(tmp_path / x) for x in ("raw2", "curated2", "runs2", "quality2")))
    row = batches.collect_volatility(vol, roots2, run_id="v1", option_code="O", start="2026-07-01", end="2026-07-02", captured_at=F.lit("2026-07-05").cast("timestamp"), source="s").first()
    assert row.status == "PARTIAL" and tables.read_option_volatility(spark, roots2.curated).count() == 2 and latest.latest_volatility(tables.read_option_volatility(spark, roots2.curated)).count() == 2
    roots3 = batches.Roots(*(str(tmp_path / x) for x in ("raw3", "curated3", "runs3", "quality3")))
    bars = spark.createDataFrame([("A", "2026-07-01 09:30:00", 1.0, 2.0, 1.0, 1.5, 5.0)], "code string, time_key string, open double, high double, low double, close double, volume double")
    some = dict(trade_date="2026-07-01", interval="1m", session="ALL", adjustment="NONE", source="s", schema_version="1")
    row = batches.collect_bars(bars, roots3, run_id="b1", symbols=["A", "B"], **some).first()
    assert (row.status, row.failed_items, row.requested_items) == ("PARTIAL", {"B": "no rows"}, ["A", "B"])
    none = batches.collect_bars(bars.limit(0), roots3, run_id="b2", symbols=["A"], **some).first()
    assert (none.status, none.row_count, none.failed_items) == ("FAILED", 0, {"A": "no rows"})


def days(spark, *texts, name="trade_date"):
    return spark.createDataFrame([(x,) for x in texts], "d string").select(F.col("d").cast("date").alias(name))


def test_states_of_runs(spark):
    """Reasons and completion by the runs' states, in either case of letters."""
    some = (("r1", "2026-07-01", "success"), ("r2", "2026-07-02", "failed"), ("r3", "2026-07-03", "Running"), ("r4", "2026-07-04", "odd"), ("r5", "2026-07-05", "PARTIAL"), ("r6", "2026-07-07", "SUCCESS"))
    bars = captures(spark, 2, "r1")
    for run_id, day in (("r2", "2026-07-02"), ("r3", "2026-07-03"), ("r4", "2026-07-04"), ("r5", "2026-07-05"), ("r6", "2026-07-06"), ("r7", "2026-07-07"), (" ", "2026-07-08")):
        bars = bars.unionByName(captures(spark, 2, run_id, day, file=f"file {run_id}"))
    args = bars, runs(spark, *some), checks(spark, ("r5", "FAIL"), ("r1", "WARN")), KEY
    found = values(coverage.snapshot_reasons(*args).select("requested_trade_date", "reason"), "requested_trade_date")
    assert [r for _, r in found] == [None, "RUN_FAILED", "RUN_RUNNING", "RUN_STATUS_UNKNOWN", "QUALITY_FAIL", "RUN_METADATA_MISMATCH", "ORPHANED_RUN", "RUN_STATUS_UNKNOWN"]
    done = coverage.completed_items(*args)
    assert [str(x.requested_trade_date) for x in done.collect()] == ["2026-07-01"]
    assert coverage.completed_items(*args, days(spark, "2026-07-02")).count() == 0
    assert coverage.present_items(bars, KEY).count() == 8 and coverage.present_items(bars, KEY, days(spark, "2026-07-02")).count() == 1
    assert values(coverage.latest_complete_snapshots(*args).select("snapshot_file", "row_count")) == [("f1", 2)]
    assert coverage.latest_completed_dates(done, "2026-06-30").count() == 0
    states, why = coverage.coverage_state(*args, spark.createDataFrame([("A",), ("B",)], "code string"), days(spark, "2026-07-01", "2026-07-02"))
    assert [s for *_, s in values(states, "code", "trade_date")] == ["COMPLETE", "INCOMPLETE", "MISSING", "MISSING"] and why.count() == 7
    both = spark.createDataFrame([("A",), ("B",)], "code string")
    starts = coverage.incremental_starts(both, done, days(spark, "2026-07-01", "2026-07-02", "2026-07-06"), "2026-06-01", "2026-07-06")
    assert [(c, str(s)) for c, s in values(starts.select("code", "start"), "code")] == [("A", "2026-07-02"), ("B", "2026-06-01")]
    last = coverage.incremental_starts(both, done, days(spark, "2026-07-01", "2026-07-02"), "2026-06-01", "2026-07-01")
    assert values(last.select("code", F.col("start").isNull()), "code")[0] == ("A", True)


def test_filtered_reads(spark):
    bars = captures(spark, 5).unionByName(captures(spark, 5, "r2", bump=1.0))
    newest = latest.latest_bars(bars)
    assert newest.count() == 5 and {r.ingestion_run_id for r in newest.collect()} == {"r2"}  # equal times: the greater run
    part = latest.load_bars(newest, code="A", interval="1m", adjustment="NONE", start="2026-07-01 13:31:00", end="2026-07-01 13:33:00", trade_date="2026-07-01", session="REGULAR")
    assert [str(r.time_utc)[11:16] for r in part.collect()] == ["13:31", "13:32", "13:33"] and latest.head(part, 2).count() == 2
    assert latest.load_bars(newest, session="OVERNIGHT").count() == 0
    rows = spark.createDataFrame([("MARKET", "US", d, a, b) for d, a, b in (("2026-07-01", "2026-07-01", "2026-07-03"), ("2026-07-03", "2026-07-01", "2026-07-03"), ("2026-07-08", "2026-07-06", "2026-07-10"))] + [("CODE", "US", "2026-07-02", "2026-07-02", "2026-07-02")], "scope_type string, scope_value string, d string, a string, b string").select(
        "scope_type", "scope_value", *(F.col(x).cast("date").alias(y) for x, y in (("d", "trade_date"), ("a", "requested_start_date"), ("b", "requested_end_date")))
    )
    assert [str(x) for x, in values(latest.calendar_dates(rows, "MARKET", "US", "2026-07-01", "2026-07-05"), "trade_date")] == ["2026-07-01", "2026-07-03"]
    assert [str(x) for x, in values(latest.dates_after(rows, "MARKET", "US", "2026-07-01"), "trade_date")] == ["2026-07-03", "2026-07-08"]
    assert [(str(a), str(b)) for a, b in values(latest.requested_ranges(rows, "MARKET", "US", "2026-07-03", "2026-07-05"))] == [("2026-07-01", "2026-07-03")]
    assert [str(r.trade_date) for r in latest.load_calendar(rows, code=" us ").collect()] == ["2026-07-02"]
    with pytest.raises(ValueError, match="either"):
        latest.load_calendar(rows, market="US", code="US")
    contracts = spark.createDataFrame([("O", "2026-07-01", "a"), ("O", "2026-07-02", "a"), ("O", "2026-07-02", "b"), ("P", None, "a")], "option_code string, captured_at string, ingestion_run_id string")
    assert values(latest.latest_contracts(contracts), "option_code") == [("O", "2026-07-02", "b"), ("P", None, "a")]


def test_volatility_dates_and_span(spark):
    raw = spark.createDataFrame([(None, "1782864000", "0.5"), ("2026-07-02", "0", "0.6"), (None, "soon", "0.7"), ("2026-07-09", None, "0.8")], "timestamp_str string, timestamp string, impvol string")
    rows = normalize.normalize_option_volatility(raw, option_code="O", start="2026-07-01", end="2026-07-03", source="s", run_id="r")
    assert [(str(d), v) for d, v in values(rows.select("trade_date", "implied_volatility"), "trade_date")] == [("2026-07-01", 0.5), ("2026-07-02", 0.6)]
    span = lambda a, b: coverage_ranges.volatility_coverage(rows, a, b).first()
    assert (span("2026-07-01", "2026-07-02").range_complete, span("2026-07-01", "2026-07-03").range_complete, span("2026-07-01", "2026-07-02").row_count) == (True, False, 2)


def test_gaps_and_their_neighbours(spark):
    bars = canonical_rows(spark, 10).filter(~F.col("event_time").between("2026-07-01 13:33:00", "2026-07-01 13:35:00"))
    gaps = canonical.gap_ranges(bars, 60)
    row = canonical.gap_boundaries(bars, gaps).first()
    assert row.missing_bar_count == 3 and str(row.previous_event_time)[11:16] == "13:32" and str(row.next_event_time)[11:16] == "13:36" and row.previous_canonical_row_version_id != row.next_canonical_row_version_id
    facts = pit.gap_facts(canonical.gap_boundaries(bars, gaps).unionByName(canonical.gap_boundaries(bars, gaps)))
    assert facts.count() == 1 and facts.first().market_known_at == row.next_market_available_at
    with pytest.raises(GuardError):
        pit.gap_facts(canonical.gap_boundaries(bars, gaps).unionByName(canonical.gap_boundaries(bars, gaps).withColumn("missing_to_event_time", F.col("next_event_time"))))
    assert samples.contiguous(bars, 60).groupBy("segment").count().orderBy("segment").collect() == [(1, 3), (2, 4)]


def test_known_gaps_of_any_length(spark):
    """Gaps and windows from seconds to days, against every pair."""
    t = lambda c: F.timestamp_seconds(F.lit(1782864000) + F.col(c))
    gap_rows = [(f"g{i}", i * 7919 % 200000, i * i * 37 % 50000 + (i % 3) * 40) for i in range(40)]
    window_rows = [(f"w{i}", i * 5003 % 200000, 1 + i * i * i % 90000) for i in range(60)]
    facts = spark.createDataFrame(gap_rows, "gap_id string, a long, n long").select(
        "gap_id", F.lit("A").alias("code"), F.lit("1m").alias("interval"), F.lit("NONE").alias("adjustment"), F.lit("REGULAR").alias("session"), t("a").alias("missing_from_event_time"),
        F.timestamp_seconds(F.lit(1782864000) + F.col("a") + F.col("n")).alias("missing_to_event_time"), F.lit("2026-01-01").cast("timestamp").alias("market_known_at"), F.lit("2026-01-01").cast("timestamp").alias("archive_known_at"),
    )
    reqs = spark.createDataFrame(window_rows, "sample_key string, a long, n long").select(
        "sample_key", F.lit("A").alias("code"), F.lit("1m").alias("interval"), F.lit("NONE").alias("adjustment"), F.lit("ALL").alias("requested_session"), F.lit("2026-07-01").cast("date").alias("anchor_market_calendar_date"),
        t("a").alias("feature_window_start"), F.timestamp_seconds(F.lit(1782864000) + F.col("a") + F.col("n")).alias("feature_window_close"), F.lit(None).cast("timestamp").alias("label_window_start"), F.lit(None).cast("timestamp").alias("label_window_close"),
    )
    want = {w: sorted(g for g, a, n in gap_rows if a < b + m and a + n >= b) for w, b, m in window_rows}
    assert {r.sample_key: r.gap_ids for r in pit.known_gaps(facts, reqs).collect()} == {w: g for w, g in want.items() if g}


def test_samples_stay_in_their_scope(spark):
    bars = canonical_rows(spark)
    reqs = samples.requests(bars, seconds=60, feature_bars=2, label_bars=1)
    code, other = (spark.createDataFrame([(c,)], "code string") for c in "AB")
    dataset.require_bound(reqs, code, days(spark, "2026-07-01"), reqs)
    for args in ((other, days(spark, "2026-07-01")), (code, days(spark, "2026-07-02")), (code, days(spark, "2026-07-01"), reqs.withColumn("sample_key", F.lit("x")))):
        with pytest.raises(GuardError):
            dataset.require_bound(reqs, *args)
    used = pit.association(pit.candidates(bars, reqs))
    pit.require_same_day_labels(used)
    with pytest.raises(GuardError):
        pit.require_same_day_labels(used.withColumn("market_calendar_date", F.date_add("market_calendar_date", 1)))
    scope_of = dict(interval="1m", adjustment="NONE", session="ALL")
    assert samples.in_scope(bars, **scope_of, symbols=other).count() == 0 and samples.in_scope(bars, **scope_of, symbols=code, dates=days(spark, "2026-07-01")).count() == bars.count()
    builds = bars.withColumn("build_id", F.lit("b2")).unionByName(bars.withColumn("build_id", F.lit("b1")))
    assert values(samples.merged_builds(builds).select("build_ids").distinct()) == [(["b1", "b2"],)]
    with pytest.raises(GuardError):
        samples.merged_builds(bars.withColumn("build_id", F.lit("b2")).unionByName(bars.withColumns({"build_id": F.lit("b1"), "close": F.col("close") + 1}))).count()


def test_items_of_an_intraday_audit(spark):
    rows = captures(spark, 3).unionByName(captures(spark, 2, "r2", file="f2").withColumn("session", F.lit("OVERNIGHT")))
    chosen = spark.createDataFrame([("A", "r1", "f1")], "code string, ingestion_run_id string, snapshot_file string").withColumn("requested_trade_date", F.lit("2026-07-01").cast("date"))
    counts = intraday.session_counts(rows).first()
    assert (counts.regular, counts.overnight, counts.pre_market) == (3, 2, 0)
    assert intraday.snapshot_rows(rows, chosen).count() == 3


def test_tables_come_back_as_written(spark, tmp_path):
    cal = spark.createDataFrame([("MARKET", "US", "2026-07-01", None, None), ("MARKET", "US", "2026-07-02", "2026-07-01", "2026-07-03")], "scope_type string, scope_value string, d string, a string, b string").select(
        "scope_type", "scope_value", *(F.col(x).cast("date").alias(y) for x, y in (("d", "trade_date"), ("a", "requested_start_date"), ("b", "requested_end_date")))
    )
    tables.write_calendar(cal, str(tmp_path / "cal"))
    got = tables.read_calendar(spark, str(tmp_path / "cal")).select("trade_date", "requested_start_date", "requested_end_date")
    assert [tuple(map(str, r)) for r in values(got, "trade_date")] == [("2026-07-01",) * 3, ("2026-07-02", "2026-07-01", "2026-07-03")]  # old rows cover their own date
    tables.write_raw(captures(spark, 3), str(tmp_path / "raw"), "r9", day="2026-07-01")
    assert tables.read_raw(spark, str(tmp_path / "raw")).filter("by_run = 'r9'").count() == 3
    one = canonical_rows(spark, 4).select("code", F.col("event_time").alias("feature_window_close"), F.col("canonical_bar_key").alias("sample_key"), "close")
    tables.write_dataset(one, str(tmp_path / "set"))
    own = identity.content_id(one).first()[0]
    assert tables.verified_dataset(spark, str(tmp_path / "set"), own).count() == 4
    with pytest.raises(ValueError, match="content id"):
        tables.verified_dataset(spark, str(tmp_path / "set"), "0" * 64)
    assert tables.read_manifest(spark, str(tmp_path / "set")) is None
