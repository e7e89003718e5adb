"""Which (code, trade date) items are complete, why others are not, and what is left to fetch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.guards import require_empty

#: Why a snapshot is not complete, in the order of priority.
REASONS = ("RUN_STATUS_UNKNOWN", "ORPHANED_RUN", "QUALITY_FAIL", "RUN_FAILED", "RUN_RUNNING", "RUN_METADATA_MISMATCH")


@dataclass(frozen=True)
class RequestKey:
    """What a capture asked for."""

    interval: str = "60m"
    adjustment: str = "NONE"
    session: str = "ALL"
    schema_version: str = "1"

    def rows(self, bars: DataFrame) -> DataFrame:
        return bars.filter(
            (F.col("interval") == self.interval) & (F.col("adjustment") == self.adjustment) & (F.col("requested_session") == self.session) & (F.col("source_schema_version") == self.schema_version)
        )


def failed_runs(quality: DataFrame) -> DataFrame:
    """Runs with a FAIL quality row; null run ids name no run."""
    return quality.filter((F.col("result") == "FAIL") & F.col("run_id").isNotNull()).select("run_id").distinct()


def _good(bars: DataFrame, runs: DataFrame, quality: DataFrame) -> DataFrame:
    """Rows whose run ended well, did not fail quality and asked for just these rows. A null failed run id fails no other run: an anti join, not NOT IN."""
    good = runs.filter(F.upper("status").isin("SUCCESS", "PARTIAL")).join(failed_runs(quality), "run_id", "left_anti")
    good = good.select(F.col("run_id").alias("ingestion_run_id"), "requested_trade_date", "interval", "adjustment", F.col("session").alias("requested_session"), F.col("finished_at").alias("run_finished_at"))
    return bars.join(good, ["ingestion_run_id", "requested_trade_date", "interval", "adjustment", "requested_session"])


def completed_items(bars: DataFrame, runs: DataFrame, quality: DataFrame, key: RequestKey, dates: DataFrame | None = None) -> DataFrame:
    """Distinct complete (code, requested_trade_date), on the given dates (trade_date) if any are given."""
    out = _good(key.rows(bars), runs, quality).select("code", "requested_trade_date").distinct()
    return out if dates is None else out.join(dates.select(F.col("trade_date").alias("requested_trade_date")).distinct(), "requested_trade_date", "left_semi").select("code", "requested_trade_date")


def present_items(bars: DataFrame, key: RequestKey, dates: DataFrame | None = None) -> DataFrame:
    """Distinct (code, requested_trade_date) with any row of the request; on the given dates, so that it compares with completed_items."""
    out = key.rows(bars).select("code", "requested_trade_date").distinct()
    return out if dates is None else out.join(dates.select(F.col("trade_date").alias("requested_trade_date")).distinct(), "requested_trade_date", "left_semi").select("code", "requested_trade_date")


def snapshot_reasons(bars: DataFrame, runs: DataFrame, quality: DataFrame, key: RequestKey) -> DataFrame:
    """code, requested_trade_date, ingestion_run_id and reason (null: complete) of each captured item: the first rule that fits."""
    items = key.rows(bars).select("code", "requested_trade_date", "ingestion_run_id").distinct()
    r = runs.select(F.col("run_id").alias("ingestion_run_id"), F.upper("status").alias("_status"), F.col("requested_trade_date").alias("_d"), F.col("interval").alias("_i"), F.col("session").alias("_s"), F.col("adjustment").alias("_a"))
    bad = failed_runs(quality).select(F.col("run_id").alias("ingestion_run_id"), F.lit(True).alias("_bad"))
    same = F.struct("_d", "_i", "_s", "_a").eqNullSafe(F.struct("requested_trade_date", F.lit(key.interval), F.lit(key.session), F.lit(key.adjustment)))
    reason = (
        F.when(F.coalesce(F.trim("ingestion_run_id"), F.lit("")) == "", "RUN_STATUS_UNKNOWN")
        .when(F.col("_status").isNull(), "ORPHANED_RUN")
        .when(F.col("_bad"), "QUALITY_FAIL")
        .when(F.col("_status") == "FAILED", "RUN_FAILED")
        .when(F.col("_status") == "RUNNING", "RUN_RUNNING")
        .when(~F.col("_status").isin("SUCCESS", "PARTIAL"), "RUN_STATUS_UNKNOWN")
        .when(~same, "RUN_METADATA_MISMATCH")
    )
    return items.join(r, "ingestion_run_id", "left").join(bad, "ingestion_run_id", "left").select("code", "requested_trade_date", "ingestion_run_id", reason.alias("reason"))


def incomplete_reasons(bars: DataFrame, runs: DataFrame, quality: DataFrame, key: RequestKey) -> DataFrame:
    """code, requested_trade_date and reasons: the distinct reasons of an item's snapshots in the order of priority."""
    rank = F.create_map(*(F.lit(x) for i, r in enumerate(REASONS) for x in (r, i)))
    found = snapshot_reasons(bars, runs, quality, key).filter("reason is not null")
    sets = found.groupBy("code", "requested_trade_date").agg(F.array_sort(F.collect_set(F.struct(rank[F.col("reason")].alias("i"), F.col("reason").alias("r")))).alias("x"))
    return sets.select("code", "requested_trade_date", F.transform("x", lambda v: v["r"]).alias("reasons"))


def latest_complete_snapshots(bars: DataFrame, runs: DataFrame, quality: DataFrame, key: RequestKey) -> DataFrame:
    """The chosen file of each complete (code, requested_trade_date). bars needs snapshot_file."""
    good = _good(key.rows(bars), runs, quality)
    files = good.groupBy("code", "requested_trade_date", "ingestion_run_id", "snapshot_file", "run_finished_at").agg(F.max("ingested_at").alias("snapshot_ingested_at"), F.count("*").alias("row_count"))
    w = Window.partitionBy("code", "requested_trade_date").orderBy(F.desc_nulls_last("snapshot_ingested_at"), F.desc_nulls_last("run_finished_at"), F.desc("ingestion_run_id"), F.desc("snapshot_file"))
    return files.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def latest_completed_dates(complete: DataFrame, end) -> DataFrame:
    """code and latest: the last complete date at or before end."""
    return complete.filter(F.col("requested_trade_date") <= F.lit(end).cast("date")).groupBy("code").agg(F.max("requested_trade_date").alias("latest"))


def percentage(part, whole):
    """part of whole in per cent to two places; of nothing: all."""
    return F.when(whole > 0, F.bround(part / whole * 100, 2)).otherwise(F.lit(100.0))


def item_states(symbols: DataFrame, dates: DataFrame, complete: DataFrame, present: DataFrame) -> DataFrame:
    """code, trade_date, state (COMPLETE, INCOMPLETE, MISSING) of every expected item. The product of symbols and dates is the result itself, not a join to be filtered."""
    expected = symbols.select("code").distinct().crossJoin(dates.select("trade_date").distinct())
    c = complete.select("code", F.col("requested_trade_date").alias("trade_date"), F.lit(True).alias("_c"))
    p = present.select("code", F.col("requested_trade_date").alias("trade_date"), F.lit(True).alias("_p"))
    state = F.when(F.col("_c"), "COMPLETE").when(F.col("_p"), "INCOMPLETE").otherwise("MISSING")
    return expected.join(c, ["code", "trade_date"], "left").join(p, ["code", "trade_date"], "left").select("code", "trade_date", state.alias("state"))


def coverage_state(bars: DataFrame, runs: DataFrame, quality: DataFrame, key: RequestKey, symbols: DataFrame, dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_states, incomplete_reasons) of a request: what the audits start from."""
    complete, present = completed_items(bars, runs, quality, key, dates), present_items(bars, key, dates)
    return item_states(symbols, dates, complete, present), incomplete_reasons(bars, runs, quality, key)


def coverage_audit(states: DataFrame, reasons: DataFrame) -> DataFrame:
    """Per code: numbers, dates and reasons of its items, coverage in per cent and status (PASS if all is complete, else WARN)."""
    r = reasons.select("code", F.col("requested_trade_date").alias("trade_date"), "reasons")
    rows = states.join(r, ["code", "trade_date"], "left")
    of = lambda s: F.array_sort(F.collect_list(F.when(F.col("state") == s, F.col("trade_date").cast("string"))))
    why = F.array_sort(F.collect_list(F.when(F.col("state") == "INCOMPLETE", F.concat(F.col("trade_date").cast("string"), F.lit("="), F.coalesce(F.array_join("reasons", "+"), F.lit(""))))))
    done = F.count_if(F.col("state") == "COMPLETE")
    return rows.groupBy("code").agg(
        F.count("*").alias("expected_count"),
        done.alias("complete_count"),
        F.count_if(F.col("state") == "INCOMPLETE").alias("incomplete_count"),
        F.count_if(F.col("state") == "MISSING").alias("missing_count"),
        percentage(done, F.count("*")).alias("coverage_percentage"),
        F.min(F.when(F.col("state") == "COMPLETE", F.col("trade_date"))).alias("first_complete_date"),
        F.max(F.when(F.col("state") == "COMPLETE", F.col("trade_date"))).alias("last_complete_date"),
        F.array_join(why, ",").alias("incomplete_reasons"),
        F.array_join(of("MISSING"), ",").alias("missing_dates"),
        F.when(done == F.count("*"), "PASS").otherwise("WARN").alias("status"),
    )


def audit_totals(states: DataFrame, gaps: DataFrame) -> DataFrame:
    """One row: numbers of items by state, coverage in per cent and status. gaps (from calendar_gaps) leaves the expected items undetermined: any gives FAILED and no numbers."""
    n = lambda s: F.count_if(F.col("state") == s)
    counts = states.agg(F.count("*").alias("expected_count"), n("COMPLETE").alias("complete_count"), n("INCOMPLETE").alias("incomplete_count"), n("MISSING").alias("missing_count"))
    counts = counts.withColumn("coverage_percentage", percentage(F.col("complete_count"), F.col("expected_count")))
    both = counts.join(gaps.agg(F.count("*").alias("calendar_gap_count")))  # one row each
    status = F.when(F.col("calendar_gap_count") > 0, "FAILED").when(F.col("complete_count") == F.col("expected_count"), "PASS").otherwise("WARN")
    known = [F.when(F.col("calendar_gap_count") == 0, F.col(c)).alias(c) for c in counts.columns]
    return both.select(*known, "calendar_gap_count", status.alias("status"))


def require_calendar(gaps: DataFrame) -> None:
    """A plan needs a calendar that covers its whole range."""
    require_empty(gaps, "the calendar does not cover the range")


def calendar_gaps(wanted: DataFrame, requested: DataFrame) -> DataFrame:
    """Parts of a wanted range (one row: start, end) that no requested calendar range covers; any row fails an audit."""
    from tapeloom.operators.coverage_ranges import merge_ranges, missing_ranges

    one = lambda df: df.withColumn("k", F.lit(1))
    return missing_ranges(one(wanted), merge_ranges(one(requested), ["k"]), ["k"]).drop("k")


def completed_by_request(bars: DataFrame, runs: DataFrame, quality: DataFrame) -> DataFrame:
    """Distinct complete (code, requested_trade_date) of every request key at once: completed_items for all keys in one pass."""
    return _good(bars, runs, quality).select("code", "interval", "requested_session", "adjustment", "source_schema_version", "requested_trade_date").distinct()


def inventory(bars: DataFrame, complete: DataFrame) -> DataFrame:
    """Per (code, interval, session, adjustment, version): dates, runs, rows, newest capture, legacy rows (without a version), complete dates.

    complete comes from completed_by_request(): an item is complete for the request that captured it and no other.
    """
    keys = ["code", "interval", "requested_session", "adjustment", "source_schema_version"]
    rows = bars.groupBy(*keys).agg(
        F.min("requested_trade_date").alias("first_date"),
        F.max("requested_trade_date").alias("last_date"),
        F.count_distinct("requested_trade_date").alias("n_dates"),
        F.count_distinct("ingestion_run_id").alias("n_runs"),
        F.count("*").alias("n_rows"),
        F.max("ingested_at").alias("newest"),
        F.count_if(F.col("source_schema_version").isNull()).alias("n_legacy"),
    )
    done = complete.groupBy(*(F.col(c).alias(f"_{c}") for c in keys)).agg(F.count("*").alias("n_complete"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return rows.join(done, same, "left").drop(*(f"_{c}" for c in keys)).withColumn("n_complete", F.coalesce("n_complete", F.lit(0)))


def inventory_totals(bars: DataFrame) -> DataFrame:
    """One row over all bars: rows, symbols, dates, runs, request keys, rows without a version."""
    return bars.agg(
        F.count("*").alias("n_rows"), F.count_distinct("code").alias("n_symbols"), F.count_distinct("requested_trade_date").alias("n_dates"), F.count_distinct("ingestion_run_id").alias("n_runs"),
        F.count_distinct(F.struct("interval", "requested_session", "adjustment", "source_schema_version")).alias("n_keys"), F.count_if(F.col("source_schema_version").isNull()).alias("n_legacy"),
    )


def backfill_plan(symbols: DataFrame, dates: DataFrame, complete: DataFrame, gaps: DataFrame | None = None) -> DataFrame:
    """code, trade_date, action (SKIP what is complete, else FETCH) of every calendar date from each symbol's start (symbols: code, start) on.

    gaps, where given, are the parts of the range that the calendar does not cover; any raises.
    """
    if gaps is not None:
        require_calendar(gaps)
    wanted = symbols.select("code", "start").join(dates.select("trade_date").distinct(), F.col("trade_date") >= F.col("start")).select("code", "trade_date")
    done = complete.select("code", F.col("requested_trade_date").alias("trade_date"), F.lit("SKIP").alias("_done"))
    return wanted.join(done, ["code", "trade_date"], "left").select("code", "trade_date", F.coalesce("_done", F.lit("FETCH")).alias("action"))


def incremental_starts(symbols: DataFrame, complete: DataFrame, dates: DataFrame, bootstrap, end) -> DataFrame:
    """code and start: the trading date after the last complete one, or the bootstrap date; null when nothing is left before end."""
    from tapeloom.operators.latest import next_dates

    last = symbols.select("code").distinct().join(latest_completed_dates(complete, end), "code", "left")
    asked = last.filter("latest is not null").select("code", F.col("latest").alias("day"))
    fresh = last.filter("latest is null").select("code", F.lit(bootstrap).cast("date").alias("start"))
    return next_dates(asked, dates, end).withColumnRenamed("next_date", "start").unionByName(fresh)


def batch_status(n_ok, n_failed, n_bad_quality):
    """FAILED without a success, PARTIAL with a failure or a bad quality row, else SUCCESS."""
    return F.when(n_ok == 0, "FAILED").when((n_failed > 0) | (n_bad_quality > 0), "PARTIAL").otherwise("SUCCESS")
