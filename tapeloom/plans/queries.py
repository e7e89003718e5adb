"""The registered queries over the driver's tables. Times are returned without a zone, dates and arrays as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions import codes, identity
from tapeloom.functions import market_time as mt
from tapeloom.guards import Stages, work_folder
from tapeloom.operators import canonical, catalog, coverage, dataset, features, intraday, labels, latest, normalize, pit, quality, samples, splits
from tapeloom.operators.coverage_ranges import merge_ranges, missing_ranges, volatility_coverage
from tapeloom.plans import batches
from tapeloom.plans.build import BuildSpec, build
from tapeloom.sources import derived, tables

KEY = coverage.RequestKey()
HOUR = 3600
AS_OF = "2024-02-01 01:30:00"
FEATURES = (
    features.FeatureSpec("simple_return", "simple_return", 3),
    features.FeatureSpec("log_return", "log_return", 3),
    features.FeatureSpec("rolling_mean", "rolling_mean", 3),
    features.FeatureSpec("rolling_std", "rolling_std", 3),
    features.FeatureSpec("rolling_volume_mean", "rolling_volume_mean", 2),
    features.FeatureSpec("volume_ratio", "volume_ratio", 3),
    features.FeatureSpec("candle_range", "candle_range"),
    features.FeatureSpec("candle_body", "candle_body"),
)
LABELS = (
    labels.LabelSpec("forward_return", "forward_return", 2),
    labels.LabelSpec("forward_direction", "forward_direction", 2),
    labels.LabelSpec("favorable", "maximum_favorable_excursion", 2),
    labels.LabelSpec("adverse", "maximum_adverse_excursion", 2),
)
SPEC = BuildSpec(seconds=HOUR, feature_bars=3, label_bars=2, split=splits.SplitSpec("2024-01-12", "2024-01-19", "2024-01-26"), features=FEATURES, labels=LABELS)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    """Register f under its name; its timestamps are returned without a zone, its dates as text."""
    plain = {"timestamp": "timestamp_ntz", "date": "string"}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(spark, sf_dir)
        return df.select(*(F.col(c).cast(plain.get(t, t)) for c, t in df.dtypes))

    QUERIES[f.__name__] = run
    return f


def _nine(c: str):
    """Rounded to nine places, without a negative zero."""
    return features.positive_zero(F.round(c, 9)).alias(c)


# Bars and calendars


@query
def bars_normalized(spark, sf_dir):
    raw = derived.bars60(spark, sf_dir).select("code", F.date_format(mt.market_local(F.col("event_time")), "yyyy-MM-dd HH:mm:ss").alias("time_key"), "open", "high", "low", "close", "volume")
    day = F.to_date("time_key")
    df = normalize.normalize_bars(raw, trade_date=day, interval="60m", session="all", adjustment="none", source="feed", schema_version="1", run_id=F.lit("r"), ingested_at=F.lit("2024-02-01").cast("timestamp"))
    occurred = mt.occurrence_date(F.col("time_utc"), F.col("session"))
    return df.select("code", "asset_type", "interval", "adjustment", "time_utc", "market_calendar_date", "session", "open", "high", "low", "close", "volume", mt.available_at(F.col("time_utc"), mt.interval_seconds(F.col("interval"))).alias("market_available_at"), occurred.alias("occurrence_date"))


@query
def bars_latest(spark, sf_dir):
    return latest.latest_bars(derived.captures(spark, sf_dir)).select("code", "time_utc", "ingestion_run_id", "close", "volume")


@query
def bars_query(spark, sf_dir):
    df = latest.latest_bars(derived.captures(spark, sf_dir))
    return latest.load_bars(df, code="view", interval="60m", adjustment="NONE", start="2024-01-05 00:00:00", end="2024-01-20 12:00:00", session="REGULAR").select("code", "time_utc", "session", "open", "close")


@query
def bars_head(spark, sf_dir):
    return latest.head(latest.load_bars(latest.latest_bars(derived.captures(spark, sf_dir))), 50).select("time_utc", "code", "close")


@query
def bar_quality(spark, sf_dir):
    k = F.substring("ingestion_run_id", 5, 1).cast("long")
    rows = derived.bent(derived.captures(spark, sf_dir)).withColumn("ingest_seq", k * 10**10 + F.unix_seconds("time_utc"))
    return quality.bar_quality(rows)


@query
def calendar_latest(spark, sf_dir):
    return latest.latest_calendar(derived.calendar(spark, sf_dir)).select("trade_date", "trade_date_type", "requested_start_date", "requested_end_date", "captured_at", "ingestion_run_id")


@query
def calendar_query(spark, sf_dir):
    df = latest.latest_calendar(derived.calendar(spark, sf_dir))
    return latest.load_calendar(df, market="us", start="1996-01-01", end="1996-06-30").select("trade_date", "trade_date_type")


@query
def calendar_dates(spark, sf_dir):
    return latest.calendar_dates(latest.latest_calendar(derived.calendar(spark, sf_dir)), "MARKET", "US", "1997-01-01", "1997-12-31")


@query
def calendar_requested_ranges(spark, sf_dir):
    return latest.requested_ranges(derived.calendar(spark, sf_dir), "MARKET", "US", "1995-01-01", "1995-02-01")


@query
def calendar_dates_after(spark, sf_dir):
    return latest.dates_after(latest.latest_calendar(derived.calendar(spark, sf_dir)), "MARKET", "US", "2001-01-15")


@query
def next_trading_dates(spark, sf_dir):
    orders = derived.table(spark, sf_dir, "orders")
    after = orders.groupBy(F.concat(F.lit("c"), F.col("o_custkey")).alias("code")).agg(F.to_date(F.max("o_orderdate")).alias("day"))
    return latest.next_dates(after, latest.latest_calendar(derived.calendar(spark, sf_dir)), "2001-07-20")


@query
def calendar_normalized(spark, sf_dir):
    raw = derived.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").cast("string").alias("time"), F.concat(F.lit("TradeDateType."), "o_orderstatus").alias("trade_date_type"), F.col("o_orderkey").alias("ingest_seq"))
    df = normalize.normalize_calendar(raw, market="us", start="1995-01-01", end="2001-12-31", captured_at=F.lit("2024-01-01").cast("timestamp"), source="feed", schema_version="1", run_id="r")
    return df.select("scope_type", "scope_value", "trade_date", "trade_date_type", "ingest_seq")


@query
def calendar_quality(spark, sf_dir):
    raw = derived.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 50 == 0, "OTHER").otherwise("MARKET").alias("scope_type"), F.when(F.col("o_orderkey") % 60 == 0, " ").otherwise("US").alias("scope_value"),
        F.when(F.col("o_orderkey") % 90 != 0, F.to_date("o_orderdate")).alias("trade_date"), F.when(F.col("o_orderkey") % 70 == 0, "").when(F.col("o_orderkey") % 110 != 0, F.col("o_orderstatus")).alias("trade_date_type"),
        F.lit("feed").alias("source"), F.lit("2024-01-01").cast("timestamp").alias("captured_at"), F.col("o_orderkey").alias("ingest_seq"),
    )
    return quality.calendar_quality(raw, "1995-01-01", "2000-12-31")


@query
def weekday_chunks(spark, sf_dir):
    o = derived.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    chunks = o.select("o_custkey", "a", "b", F.explode(mt.date_chunks(F.col("a"), F.col("b"), 30)).alias("c"))
    return chunks.select("o_custkey", F.col("c.start").alias("start"), F.col("c.end").alias("end"), mt.next_weekday(F.col("c.start")).alias("next_weekday"), mt.previous_weekday(F.col("c.end")).alias("previous_weekday"))


def _order_ranges(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return derived.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 200).alias("k"), day.alias("start"), F.date_add(day, (F.col("o_orderkey") % 20).cast("int")).alias("end"))


@query
def ranges_merged(spark, sf_dir):
    return merge_ranges(_order_ranges(spark, sf_dir), ["k"])


@query
def ranges_missing(spark, sf_dir):
    own = _order_ranges(spark, sf_dir)
    wanted = own.groupBy("k").agg(F.date_sub(F.min("start"), 5).alias("start"), F.date_add(F.max("end"), 5).alias("end"))
    return missing_ranges(wanted, merge_ranges(own, ["k"]), ["k"])


# Options


def _contracts(spark, sf_dir):
    p = derived.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    raw = p.select(
        F.concat(F.lit("US."), F.upper(F.regexp_extract("p_brand", "^([A-Za-z]+)", 1)), F.lit("240119"), F.when(key % 2 == 0, "C").otherwise("P"), F.lpad((key % 500 * 1000).cast("string"), 6, "0")).alias("code"),
        F.col("p_name").alias("name"),
        F.when(key % 7 == 0, F.lit(None)).when(key % 11 == 0, "US.OTHER").otherwise("US.BRAND").alias("owner_stock_code"),
        F.when(key % 3 == 0, "Call").when(key % 3 == 1, "2").alias("option_type"),
        F.when(key % 13 == 0, "n/a").otherwise((key % 500).cast("string")).alias("strike_price"),
        F.when(key % 17 == 0, "soon").otherwise("2024-01-19").alias("strike_time"),
        F.col("p_size").cast("string").alias("lot_size"),
        F.when(key % 5 == 0, "Yes").when(key % 5 == 1, "normal").alias("suspension"),
        key.alias("ingest_seq"),
    )
    at = lambda t: F.lit(t).cast("timestamp")
    # A first delivery of all contracts, and a second with other names and lots.
    again = raw.withColumns({"name": F.upper("name"), "lot_size": (F.col("lot_size").cast("int") + 1).cast("string")})
    first = normalize.normalize_option_contracts(raw, underlying_code="US.X", captured_at=at("2024-01-02"), source="feed", schema_version="1", run_id="o1")
    second = normalize.normalize_option_contracts(again, underlying_code="US.X", captured_at=at("2024-01-03"), source="feed", schema_version="1", run_id="o2")
    return first.unionByName(second)


@query
def option_contracts(spark, sf_dir):
    return _contracts(spark, sf_dir).select("option_code", "option_name", "underlying_code", "option_type", "strike_price", "expiry_date", "lot_size", "suspension", "captured_at")


@query
def option_contracts_latest(spark, sf_dir):
    return latest.latest_contracts(_contracts(spark, sf_dir)).select("option_code", "captured_at", "ingestion_run_id", "option_name")


@query
def option_contract_quality(spark, sf_dir):
    n = F.regexp_extract("option_code", r"(\d{6})$", 1).cast("int") / 1000
    bent = _contracts(spark, sf_dir).withColumns({
        "underlying_code": F.when(n % 19 == 0, " ").otherwise(F.col("underlying_code")), "option_type": F.when(n % 23 == 0, "BOTH").when(n % 29 != 0, F.col("option_type")), "strike_price": F.when(n % 31 == 1, F.lit(float("nan"))).otherwise(F.col("strike_price")),
    })
    blank = bent.filter(n % 37 == 0).withColumn("option_code", F.lit(" "))
    return quality.option_contract_quality(bent.unionByName(blank).unionByName(bent.filter(n % 41 == 0)))


def _volatility(spark, sf_dir):
    raw = derived.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("OPT-"), F.col("l_partkey") % 40).alias("code"), F.to_date("l_shipdate").cast("string").alias("timestamp_str"), F.col("l_discount").cast("string").alias("impvol"), (F.col("l_tax") - 0.01).alias("hv"),
        F.col("l_linenumber").alias("impvol_status"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("ingest_seq"),
    )
    return normalize.normalize_option_volatility(raw, option_code="OPT", start="1996-01-01", end="1996-12-31", source="feed", run_id="v", captured_at=F.lit("2024-01-02").cast("timestamp"))


@query
def option_volatility(spark, sf_dir):
    return _volatility(spark, sf_dir).select("option_code", "trade_date", "implied_volatility", _nine("historical_volatility"), "volatility_status")


@query
def option_volatility_quality(spark, sf_dir):
    rows = _volatility(spark, sf_dir)
    undated = rows.filter("volatility_status = 3").withColumn("trade_date", F.lit(None).cast("date"))
    return quality.option_volatility_quality(rows.unionByName(rows.filter("volatility_status = 1")).unionByName(undated), "1995-12-01", "1996-11-30")


@query
def option_volatility_coverage(spark, sf_dir):
    return volatility_coverage(_volatility(spark, sf_dir), "1996-01-06", "1996-12-29")


@query
def option_volatility_latest(spark, sf_dir):
    first = _volatility(spark, sf_dir)
    second = first.filter("volatility_status < 3").withColumns({"captured_at": F.lit("2024-01-03").cast("timestamp"), "ingestion_run_id": F.lit("w"), "implied_volatility": F.col("implied_volatility") + 1})
    return latest.latest_volatility(first.unionByName(second)).select("option_code", "trade_date", _nine("implied_volatility"), "ingestion_run_id", "captured_at")


@query
def option_code_parts(spark, sf_dir):
    c = F.col("option_code")
    return _contracts(spark, sf_dir).select("option_code", codes.asset_type(c).alias("asset_type"), codes.underlying(c).alias("underlying"), mt.volatility_period(F.date_sub(F.lit("2024-01-19").cast("date"), (F.length(c) * 10).cast("int")), F.lit("2024-01-19").cast("date")).alias("period")).distinct()


# Completion and coverage


def _state(spark, sf_dir):
    bars = derived.captures(spark, sf_dir)
    runs = derived.runs(bars)
    return bars, runs, derived.quality(runs), derived.trading_days(bars)


@query
def failed_runs(spark, sf_dir):
    return coverage.failed_runs(_state(spark, sf_dir)[2])


@query
def completed_items(spark, sf_dir):
    bars, runs, q, days = _state(spark, sf_dir)
    return coverage.completed_items(bars, runs, q, KEY, days)


@query
def present_items(spark, sf_dir):
    bars, _, _, days = _state(spark, sf_dir)
    return coverage.present_items(bars, KEY, days)


@query
def incomplete_reasons(spark, sf_dir):
    bars, runs, q, _ = _state(spark, sf_dir)
    return coverage.incomplete_reasons(bars, runs, q, KEY).withColumn("reasons", F.array_join("reasons", ","))


@query
def latest_complete_snapshots(spark, sf_dir):
    bars, runs, q, _ = _state(spark, sf_dir)
    return coverage.latest_complete_snapshots(bars, runs, q, KEY)


@query
def latest_completed_dates(spark, sf_dir):
    bars, runs, q, _ = _state(spark, sf_dir)
    return coverage.latest_completed_dates(coverage.completed_items(bars, runs, q, KEY), "2024-01-25")


def _items(spark, sf_dir):
    bars, runs, q, days = _state(spark, sf_dir)
    symbols = bars.select("code").union(spark.createDataFrame([("unseen",)], "code string"))
    return coverage.coverage_state(bars, runs, q, KEY, symbols, days)


@query
def coverage_totals(spark, sf_dir):
    whole = spark.sql("SELECT DATE'2024-01-01' AS start, DATE'2024-01-31' AS end")
    states = _items(spark, sf_dir)[0]
    covered = coverage.audit_totals(states, coverage.calendar_gaps(whole, whole)).withColumn("calendar", F.lit("whole"))
    part = spark.sql("SELECT DATE'2024-01-03' AS start, DATE'2024-01-20' AS end")
    return covered.unionByName(coverage.audit_totals(states, coverage.calendar_gaps(whole, part)).withColumn("calendar", F.lit("part")))


@query
def coverage_audit(spark, sf_dir):
    return coverage.coverage_audit(*_items(spark, sf_dir))


@query
def bar_inventory(spark, sf_dir):
    # A second request of the same bars, which no run completes, and legacy rows without a version.
    bars, runs, q, _ = _state(spark, sf_dir)
    other = bars.filter("code = 'view'").withColumn("adjustment", F.lit("QFQ"))
    legacy = bars.filter("code = 'click'").withColumn("source_schema_version", F.lit(None).cast("string"))
    every = bars.unionByName(other).unionByName(legacy)
    return coverage.inventory(every, coverage.completed_by_request(every, runs, q))


@query
def bar_inventory_totals(spark, sf_dir):
    return coverage.inventory_totals(derived.captures(spark, sf_dir))


@query
def backfill_plan(spark, sf_dir):
    bars, runs, q, days = _state(spark, sf_dir)
    starts = bars.select("code").distinct().withColumn("start", F.date_add(F.lit("2024-01-01").cast("date"), F.length("code")))
    return coverage.backfill_plan(starts, days, coverage.completed_items(bars, runs, q, KEY, days))


@query
def incremental_starts(spark, sf_dir):
    bars, runs, q, days = _state(spark, sf_dir)
    return coverage.incremental_starts(bars.select("code"), coverage.completed_items(bars, runs, q, KEY, days), days, "2024-01-01", "2024-01-30")


# Intraday integrity


EXPECTED = {"interval": "60m", "adjustment": "NONE", "requested_session": "ALL", "source_schema_version": "1"}


def _chosen(spark, sf_dir):
    bars, runs, q, _ = _state(spark, sf_dir)
    return coverage.latest_complete_snapshots(bars, runs, q, KEY)


def _audited(spark, sf_dir):
    """The chosen snapshots' rows with faults of every kind."""
    return intraday.snapshot_rows(derived.bent(derived.captures(spark, sf_dir)), _chosen(spark, sf_dir))


@query
def intraday_segments(spark, sf_dir):
    return intraday.segments(_audited(spark, sf_dir), HOUR)


@query
def intraday_gaps(spark, sf_dir):
    return intraday.gaps(_audited(spark, sf_dir), HOUR)


@query
def intraday_gap_details(spark, sf_dir):
    return intraday.gaps(_audited(spark, sf_dir), HOUR, most=2)


@query
def intraday_checks(spark, sf_dir):
    # An item whose snapshot has no row at all stands for an empty file.
    chosen = _chosen(spark, sf_dir).select("code", "requested_trade_date").union(spark.sql("SELECT 'unseen', DATE'2024-01-05'"))
    return intraday.checks(_audited(spark, sf_dir), EXPECTED, HOUR, chosen)


@query
def intraday_sessions(spark, sf_dir):
    return intraday.session_counts(_audited(spark, sf_dir))


@query
def intraday_summary(spark, sf_dir):
    return intraday.audit(derived.bent(derived.captures(spark, sf_dir)), _chosen(spark, sf_dir), _items(spark, sf_dir)[0], EXPECTED, HOUR)[2]


# Canonical reconciliation


def _ranked(spark, sf_dir):
    return canonical.candidates(derived.captures(spark, sf_dir))


def _canonical(spark, sf_dir):
    return canonical.canonical_bars(_ranked(spark, sf_dir))


@query
def canonical_violations(spark, sf_dir):
    rows = derived.captures(spark, sf_dir)
    v = F.dayofmonth("requested_trade_date")
    bent = rows.withColumns({
        "code": F.when(v == 1, " ").otherwise(F.col("code")), "interval": F.when(v == 2, "1m").otherwise(F.col("interval")), "adjustment": F.when(v == 3, "QFQ").otherwise(F.col("adjustment")),
        "time_market": F.when(v == 5, F.lit(None).cast("timestamp")).otherwise(F.col("time_market")), "market_calendar_date": F.when(v == 6, F.date_add("market_calendar_date", 1)).otherwise(F.col("market_calendar_date")),
        "session": F.when((v == 7) | (F.col("volume") == 1), "REGULAR").otherwise(F.col("session")), "open": F.when(F.col("volume") == 2, F.lit(float("nan"))).otherwise(F.col("open")),
        "turnover": F.when(v == 9, F.lit(float("inf"))).when(v == 10, F.lit(1.0)), "time_utc": F.when(v != 4, F.col("time_utc")),
    })
    return canonical.violations(bent, "60m", "NONE").groupBy("violation").agg(F.count("*").alias("n_rows"))


@query
def canonical_from_snapshots(spark, sf_dir):
    """Canonical bars of complete snapshots alone, with the end of their runs as the archive's clock."""
    captured = derived.captures(spark, sf_dir)
    hashes = captured.select(F.col("snapshot_file").alias("path"), F.sha2(F.concat(F.lit("content of "), "snapshot_file").cast("binary"), 256).alias("sha256")).distinct()
    ranked = canonical.candidates(canonical.snapshot_inputs(captured.drop("physical_snapshot_hash"), _chosen(spark, sf_dir), hashes))
    canonical.require_no_conflicts(ranked)
    return canonical.canonical_bars(ranked).select("canonical_bar_key", "canonical_row_version_id", "code", "event_time", "archive_available_at", "close", "ingestion_run_id")


@query
def canonical_bars(spark, sf_dir):
    return _canonical(spark, sf_dir).select("canonical_bar_key", "canonical_row_version_id", "code", "event_time", "market_available_at", "archive_available_at", "open", "high", "low", "close", "volume", "session")


@query
def canonical_conflicts(spark, sf_dir):
    return canonical.conflicts(_ranked(spark, sf_dir)).withColumn("fields", F.array_join("fields", ","))


@query
def canonical_resolution(spark, sf_dir):
    r = canonical.resolution(_ranked(spark, sf_dir))
    return r.select("canonical_bar_key", F.col("selected.ingestion_run_id").alias("selected"), F.array_join(F.transform("discarded", lambda x: x["ingestion_run_id"]), ",").alias("discarded"))


@query
def canonical_provenance(spark, sf_dir):
    return canonical.provenance(_ranked(spark, sf_dir))


@query
def canonical_source_count(spark, sf_dir):
    return canonical.source_count(_ranked(spark, sf_dir))


@query
def canonical_gaps(spark, sf_dir):
    return canonical.gap_ranges(_canonical(spark, sf_dir), HOUR)


def _bounded_gaps(spark, sf_dir):
    bars = _canonical(spark, sf_dir)
    return canonical.gap_boundaries(bars, canonical.gap_ranges(bars, HOUR, check=False))


@query
def canonical_gap_boundaries(spark, sf_dir):
    return _bounded_gaps(spark, sf_dir).select("gap_id", "previous_canonical_row_version_id", "next_canonical_row_version_id", "previous_market_available_at", "next_archive_available_at")


@query
def snapshot_hash_groups(spark, sf_dir):
    return canonical.snapshot_hashes(derived.captures(spark, sf_dir))


@query
def content_ids(spark, sf_dir):
    rows = _canonical(spark, sf_dir).select("code", "session", F.col("canonical_bar_key").alias("key"))
    return identity.content_id(rows)


# Samples, features, labels, splits


def _build(spark, sf_dir):
    return build(_canonical(spark, sf_dir), SPEC)


def _stored_build(spark, sf_dir):
    """The same with every table computed once and stored, for what stands on several of them."""
    return build(_canonical(spark, sf_dir), SPEC, Stages(work_folder(spark, "dataset")))


@query
def scope_bars(spark, sf_dir):
    bars = _canonical(spark, sf_dir)
    days = derived.trading_days(derived.captures(spark, sf_dir))
    codes_ = spark.createDataFrame([("click",), ("view",), ("click",)], "code string")
    return samples.in_scope(bars, interval="60m", adjustment="NONE", session="ALL", symbols=codes_, dates=days).select("code", "event_time", "close")


@query
def merged_builds(spark, sf_dir):
    bars = _canonical(spark, sf_dir).select("code", "event_time", "close", "canonical_row_version_id")
    first, second = bars.filter(F.hour("event_time") < 16).withColumn("build_id", F.lit("b1")), bars.filter(F.hour("event_time") >= 8).withColumn("build_id", F.lit("b2"))
    return samples.merged_builds(first.unionByName(second)).withColumn("build_ids", F.array_join("build_ids", ","))


def _builds(spark, sf_dir):
    """Rows of three overlapping builds: the hours before 16, those from 8 on, and an hour of its own in which nothing else looks at a bar."""
    bars, hour = _canonical(spark, sf_dir), F.hour("event_time")
    part = lambda name, some: bars.filter(some).withColumn("build_id", F.lit(name))
    return part("b1", hour < 16).unionByName(part("b2", hour >= 8)).unionByName(part("b3", hour == 23))


@query
def builds_reconciled(spark, sf_dir):
    # The second build has another low in one hour; where a file lies does not count.
    other = F.when((F.col("build_id") == "b2") & (F.hour("event_time") == 13), F.col("low") - 1).otherwise(F.col("low"))
    moved = F.concat("build_id", F.lit("/"), "snapshot_file")
    merged = samples.reconciled(_builds(spark, sf_dir).withColumns({"low": other, "snapshot_file": moved}))
    return merged.select("canonical_bar_key", F.array_join("build_ids", ",").alias("build_ids"), F.col("n_contents").cast("long").alias("n_contents"), "low")


@query
def build_pins(spark, sf_dir):
    builds = _builds(spark, sf_dir)
    merged = samples.reconciled(builds).drop("n_contents")
    return pit.build_pins(pit.version_pins(build(merged, SPEC).association, merged), builds).withColumn("requested_trade_date", F.col("requested_trade_date").cast("string"))


@query
def gap_references(spark, sf_dir):
    builds = _builds(spark, sf_dir)
    gaps = [canonical.gap_ranges(builds.filter(F.col("build_id") == b), HOUR, check=False).withColumn("build_id", F.lit(b)) for b in ("b1", "b2", "b3")]
    return pit.gap_references(gaps[0].unionByName(gaps[1]).unionByName(gaps[2]), builds)


@query
def sample_ledger(spark, sf_dir):
    # Some symbols and days are out of the scope, and samples of one symbol were lost on the way to their split.
    b, bars = _stored_build(spark, sf_dir), derived.captures(spark, sf_dir)
    symbols, lost = bars.select("code").filter("code <> 'view'"), b.assigned.filter("code <> 'click'")
    return dataset.ledger(b.requests, symbols, derived.trading_days(bars), b.association, b.features, b.labels, lost)


@query
def calendar_gaps(spark, sf_dir):
    rows = derived.calendar(spark, sf_dir).filter("ingestion_run_id = 'cal-2'")
    requested = latest.requested_ranges(rows, "MARKET", "US", "1995-01-01", "2002-01-01")
    wanted = spark.sql("SELECT DATE'1995-01-01' AS start, DATE'2001-12-31' AS end")
    return coverage.calendar_gaps(wanted, requested)


@query
def sample_segments(spark, sf_dir):
    rows = samples.contiguous(_canonical(spark, sf_dir), HOUR)
    return rows.filter("position = 0").select("code", "market_calendar_date", "session", F.col("event_time").alias("first_event_time"), "segment_bars")


@query
def sample_requests(spark, sf_dir):
    return _build(spark, sf_dir).requests


@query
def sample_shortfalls(spark, sf_dir):
    return samples.shortfalls(_canonical(spark, sf_dir), seconds=HOUR, feature_bars=3, label_bars=2)


@query
def sample_requests_apart(spark, sf_dir):
    return samples.requests(_canonical(spark, sf_dir), seconds=HOUR, feature_bars=2, label_bars=1, stride=2).select("sample_key", "code", "feature_window_close", "label_window_close")


@query
def pit_association(spark, sf_dir):
    a = _build(spark, sf_dir).association
    return a.select("sample_key", "role", "position", "canonical_row_version_id", "event_time")


@query
def pit_diagnostics(spark, sf_dir):
    bars = _canonical(spark, sf_dir)
    reqs = samples.requests(bars, seconds=HOUR, feature_bars=3, label_bars=2)
    # Windows that close before their last bar is known.
    reqs = reqs.withColumns({c: F.col(c) - F.expr("interval 30 minutes") for c in ("feature_window_close", "label_window_close")})
    return pit.diagnostics(pit.candidates(bars, reqs, AS_OF), reqs)


@query
def minute_bars(spark, sf_dir):
    return derived.bars1(spark, sf_dir, "user_id").select("code", "event_time", "market_calendar_date", "session", "open", "high", "low", "close", "volume", "market_available_at")


@query
def minute_segments(spark, sf_dir):
    rows = samples.contiguous(derived.bars1(spark, sf_dir), 60)
    return rows.filter("position = 0").select("code", "market_calendar_date", "session", F.col("event_time").alias("first_event_time"), "segment_bars")


@query
def minute_windows(spark, sf_dir):
    # Each bar asks for the half hour up to it and labels of ten minutes; the feature window closes before its last bar is known.
    bars = derived.bars1(spark, sf_dir).withColumns({"canonical_bar_key": F.lit("k"), "canonical_row_version_id": F.lit("v")})
    t, minutes = F.col("event_time"), lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))
    reqs = bars.select(
        F.concat_ws("|", "code", F.unix_seconds(t).cast("string")).alias("sample_key"), *pit.SCOPE, F.col("market_calendar_date").alias("anchor_market_calendar_date"), (t - minutes(29)).alias("feature_window_start"),
        (t + F.expr("interval 30 seconds")).alias("feature_window_close"), (t + minutes(1)).alias("label_window_start"), (t + minutes(11)).alias("label_window_close"),
    )
    found = pit.candidates(bars, reqs).groupBy("sample_key", "role")
    return found.agg(F.count_if(F.col("status") == "SELECTED").alias("n_selected"), F.count_if(F.col("status") == "NOT_MARKET_AVAILABLE").alias("n_late"), F.max(F.when(F.col("status") == "SELECTED", F.col("high"))).alias("highest"))


@query
def pit_known_gaps(spark, sf_dir):
    # Requests of whole days, so that windows hold gaps.
    bars = _canonical(spark, sf_dir)
    day = F.date_trunc("day", "event_time")
    reqs = bars.select("code", "interval", "adjustment", "requested_session", F.to_date("event_time").alias("anchor_market_calendar_date"), day.alias("feature_window_start"), (day + F.expr("interval 20 hours")).alias("feature_window_close"),
                       (day + F.expr("interval 20 hours")).alias("label_window_start"), (day + F.expr("interval 24 hours")).alias("label_window_close")).distinct()
    reqs = reqs.withColumn("sample_key", F.concat_ws("-", "code", "anchor_market_calendar_date"))
    known = pit.known_gaps(pit.gap_facts(_bounded_gaps(spark, sf_dir)), reqs, "2024-02-01 02:30:00")
    return known.withColumn("gap_ids", F.array_join("gap_ids", ","))


@query
def sample_versions(spark, sf_dir):
    return pit.sample_versions(_build(spark, sf_dir).association)


@query
def feature_values(spark, sf_dir):
    return _stored_build(spark, sf_dir).features.select("sample_key", "name", "status", _nine("value"), "n_consumed")


@query
def feature_reasons(spark, sf_dir):
    # Windows of two hours' worth of requests without contiguity, so that all reasons occur.
    bars = _canonical(spark, sf_dir)
    step = F.expr("interval 4 hours")
    t = F.col("event_time")
    reqs = bars.select("code", "interval", "adjustment", "requested_session", F.col("market_calendar_date").alias("anchor_market_calendar_date"), (t - step).alias("feature_window_start"), (t + F.expr("interval 1 hour")).alias("feature_window_close"),
                       F.lit(None).cast("timestamp").alias("label_window_start"), F.lit(None).cast("timestamp").alias("label_window_close"), F.concat_ws("@", "code", F.date_format(t, "yyyyMMddHH")).alias("sample_key"))
    g = features.gathered(features.with_bars(pit.association(pit.candidates(bars, reqs)), bars))
    return features.execute(g, [features.FeatureSpec("r", "simple_return", 4)], HOUR).groupBy("status", "reason_code").agg(F.count("*").alias("n_samples"))


@query
def label_values(spark, sf_dir):
    return _stored_build(spark, sf_dir).labels.select("sample_key", "name", "status", _nine("value"), "end_time")


@query
def label_reasons(spark, sf_dir):
    bars = _canonical(spark, sf_dir)
    t, hours = F.col("event_time"), lambda n: F.expr(f"interval {n} hours")
    reqs = bars.select("code", "interval", "adjustment", "requested_session", F.col("market_calendar_date").alias("anchor_market_calendar_date"), t.alias("feature_window_start"), (t + hours(1)).alias("feature_window_close"),
                       (t + hours(1)).alias("label_window_start"), (t + hours(4)).alias("label_window_close"), F.concat_ws("@", "code", F.date_format(t, "yyyyMMddHH")).alias("sample_key"))
    g = features.gathered(features.with_bars(pit.association(pit.candidates(bars, reqs)), bars))
    out = labels.execute(g, [labels.LabelSpec("f", "forward_return", 3), labels.LabelSpec("x", "maximum_favorable_excursion", 3)], HOUR)
    return out.groupBy("name", "status", "reason_code").agg(F.count("*").alias("n_samples"))


@query
def split_assignments(spark, sf_dir):
    return _stored_build(spark, sf_dir).assigned.select("sample_key", "feature_window_close", "actual_label_end_time", "feature_window_close_date", "nominal_split", "final_split", "assignment_status", "reason_code", "purge_boundary")


@query
def split_counts(spark, sf_dir):
    return splits.split_counts(_stored_build(spark, sf_dir).assigned)


@query
def split_edges(spark, sf_dir):
    """Samples that end near the splits' boundaries, some with incomplete labels, some after the last split."""
    t = F.col("event_time")
    some = _canonical(spark, sf_dir).select(F.concat_ws("@", "code", F.date_format(t, "yyyyMMddHH")).alias("sample_key"), (t + F.expr("interval 1 hour")).alias("feature_window_close"),
                                            F.when(F.hour(t) % 5 == 0, "INCOMPLETE").otherwise("COMPLETE").alias("label_status"), F.when(F.hour(t) % 7 != 0, t + F.expr("interval 6 hours")).alias("actual_label_end_time"))
    return splits.assigned(some, SPEC.split)


@query
def split_mismatches(spark, sf_dir):
    b = _stored_build(spark, sf_dir)
    bent = b.rows.withColumn("final_split", F.when(F.col("code") == "view", "TEST").otherwise(F.col("final_split")))
    return splits.mismatches(bent, SPEC.split).select("sample_key", "code", "final_split")


@query
def dataset_rows(spark, sf_dir):
    names = [s.name for s in (*FEATURES, *LABELS)]
    rows = _stored_build(spark, sf_dir).rows
    own = (F.col(n) if n == "forward_direction" else _nine(n) for n in names)
    return rows.select("code", "sample_key", "feature_window_close", "label_status", *own, "final_split", "assignment_status")


@query
def dataset_completion(spark, sf_dir):
    b = _stored_build(spark, sf_dir)
    bars = derived.captures(spark, sf_dir)
    return dataset.completion(bars.select("code"), derived.trading_days(bars), b.requests, features.sample_status(b.features), labels.sample_status(b.labels))


@query
def dataset_diagnostics(spark, sf_dir):
    b = _stored_build(spark, sf_dir)
    return dataset.diagnostics(b.assigned, b.requests)


def _catalog(spark, sf_dir):
    return catalog.entries(_stored_build(spark, sf_dir).rows.withColumn("dataset_id", F.concat_ws("-", F.lit("ds"), F.to_date("feature_window_close"))))


@query
def catalog_entries(spark, sf_dir):
    e = _catalog(spark, sf_dir)
    return e.withColumns({"symbols": F.array_join("symbols", ","), "dates": F.array_join(F.transform("dates", lambda d: d.cast("string")), ",")})


@query
def catalog_search(spark, sf_dir):
    found = catalog.search(_catalog(spark, sf_dir), symbol="click", offset=2, limit=10)
    return found.select("dataset_id", "row_count", "matched_count")


@query
def catalog_lookup(spark, sf_dir):
    return catalog.lookup(_catalog(spark, sf_dir), "ds-2024-01-10").select("dataset_id", "row_count", "assigned_count")


@query
def dataset_page(spark, sf_dir):
    rows = _stored_build(spark, sf_dir).rows.select("code", "feature_window_close", "sample_key", "label_status")
    return dataset.page(rows.withColumn("feature_window_close", F.date_format("feature_window_close", "yyyy-MM-dd HH:mm:ss")), 5, 20)


# What is written comes back: sinks, verified reads, and what they notice


@query
def stored_bars(spark, sf_dir):
    root = work_folder(spark, "bars")
    tables.write_bars(derived.captures(spark, sf_dir).drop("snapshot_file", "physical_snapshot_hash"), root)
    rows, hashes = tables.read_bars_with_file(spark, root), tables.file_hashes(spark, root)
    read = rows.join(hashes, rows["snapshot_file"] == hashes["path"], "left")
    return read.select("code", "time_utc", "interval", "requested_trade_date", "ingestion_run_id", "close", "volume", "turnover", F.length("sha256").alias("n_digits"))


@query
def stored_calendar(spark, sf_dir):
    root = work_folder(spark, "calendar")
    tables.write_calendar(derived.calendar(spark, sf_dir), root)
    return tables.read_calendar(spark, root).select("trade_date", "trade_date_type", "requested_start_date", "requested_end_date", "captured_at", "ingestion_run_id")


@query
def stored_option_contracts(spark, sf_dir):
    root = work_folder(spark, "contracts")
    tables.write_option_contracts(_contracts(spark, sf_dir), root)
    return tables.read_option_contracts(spark, root).select("option_code", "option_name", "underlying_code", "option_type", "strike_price", "expiry_date", "lot_size", "suspension", "captured_at")


@query
def stored_option_volatility(spark, sf_dir):
    root = work_folder(spark, "volatility")
    tables.write_option_volatility(_volatility(spark, sf_dir), root, "1996-01-01", "1996-12-31")
    return tables.read_option_volatility(spark, root).select("option_code", "trade_date", "implied_volatility", _nine("historical_volatility"), "volatility_status")


@query
def bar_batches(spark, sf_dir):
    """The batches of two days; the second asks for a symbol that has no rows."""
    roots = batches.Roots(*(work_folder(spark, x) for x in ("raw", "curated", "runs", "quality")))
    raw = derived.bars60(spark, sf_dir).select("code", F.date_format(mt.market_local(F.col("event_time")), "yyyy-MM-dd HH:mm:ss").alias("time_key"), "open", "high", "low", "close", "volume")
    for run_id, day, asked in (("r1", "2024-01-10", None), ("r2", "2024-01-11", ["CLICK", "VIEW", "UNSEEN"])):
        some = raw.filter(F.to_date("time_key") == day)
        batches.collect_bars(some, roots, run_id=run_id, trade_date=day, interval="60m", session="ALL", adjustment="NONE", source="feed", schema_version="1", symbols=asked)
    log = tables.upsert_latest(spark.read.parquet(roots.runs))
    return log.select("run_id", "requested_trade_date", "row_count", F.array_join("successful_items", ",").alias("symbols"), F.array_join(F.map_keys("failed_items"), ",").alias("failed"), "status")


def _stored_canonical(spark, sf_dir, name):
    root = work_folder(spark, name)
    ranked = Stages(f"{root}/work").stored(_ranked(spark, sf_dir), "ranked")
    bars = canonical.canonical_bars(ranked)
    return bars, *canonical.materialize(spark, bars, canonical.gap_ranges(bars, HOUR), root, ranked)


@query
def stored_build(spark, sf_dir):
    _, own, path = _stored_canonical(spark, sf_dir, "build")
    read = canonical.verified_build(spark, path, None, own, HOUR)
    return read.select("canonical_bar_key", "canonical_row_version_id", "code", "event_time", "market_available_at", "archive_available_at", "open", "high", "low", "close", "volume", "session")


@query
def stored_build_parts(spark, sf_dir):
    _, own, path = _stored_canonical(spark, sf_dir, "parts")
    read = canonical.verified_parts(spark, path, own, (F.col("code") == "view") & F.col("market_calendar_date").between("2024-01-08", "2024-01-19"))
    return read.select("canonical_bar_key", "code", "event_time", "close")


@query
def stored_build_altered(spark, sf_dir):
    """A build in which every bar of some days of one symbol was changed after it was finished."""
    bars, own, path = _stored_canonical(spark, sf_dir, "altered")
    some = (F.col("code") == "view") & (F.dayofmonth("market_calendar_date") % 5 == 0)
    tables.write_canonical(bars.withColumn("volume", F.when(some, F.col("volume") + 1).otherwise(F.col("volume"))), f"{path}/bars", mode="overwrite")
    return canonical.altered_parts(spark, path, own).groupBy("code", "market_calendar_date").agg(F.sum("n_stored").alias("n_stored"), F.sum("n_found").alias("n_found"))


@query
def catalog_indexed_search(spark, sf_dir):
    """A catalog of datasets by symbol and week: a page of one symbol, one date, both, and one entry by its id."""
    names = F.concat_ws("-", "code", F.weekofyear("feature_window_close").cast("string"))
    _, path = catalog.materialize(catalog.entries(_stored_build(spark, sf_dir).rows.withColumn("dataset_id", names)), work_folder(spark, "catalog"))
    found = [catalog.indexed_search(spark, path, **w) for w in ({"symbol": "click", "offset": 1, "limit": 2}, {"date": "2024-01-10"}, {"symbol": "view", "date": "2024-01-10"})]
    found.append(catalog.indexed_lookup(spark, path, "view-3").withColumn("matched_count", F.lit(None).cast("long")))
    parts = [f.select(F.lit(k).alias("search"), "dataset_id", "row_count", "matched_count") for k, f in zip(("symbol", "date", "both", "id"), found, strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def catalog_of_datasets(spark, sf_dir):
    """Datasets of the first two splits, stored and verified in one scan."""
    rows, root = _stored_build(spark, sf_dir).rows, work_folder(spark, "datasets")
    for split in ("TRAIN", "VALIDATION"):
        dataset.materialize(rows.filter(F.col("final_split") == split), root)
    return catalog.of_datasets(spark, root).select("row_count", F.array_join("symbols", ",").alias("symbols"), "first_close", "last_close", "assigned_count")
