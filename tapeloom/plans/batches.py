"""Batch jobs over delivered raw tables: stamp, normalize, check, write, record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.identity import text_digest
from tapeloom.operators import normalize, quality
from tapeloom.operators.coverage import batch_status
from tapeloom.sources import tables


@dataclass(frozen=True)
class Roots:
    """Where a batch writes."""

    raw: str
    curated: str
    runs: str
    quality: str


def _record(roots: Roots, run_id: str, started, checks: DataFrame, curated: DataFrame, item: str, requested: list[str] | None, warn_counts: bool, **facts: str) -> DataFrame:
    """Write the quality rows and the run's row; return the run's row.

    Items (symbols, options, scopes) that were requested and have no row failed. No success is FAILED; a failed item or
    a bad quality row is PARTIAL. config_hash is the digest of the parameters.
    """
    checks.select(F.lit(run_id).alias("run_id"), "*").write.mode("append").parquet(roots.quality)
    bad = checks.agg(F.count_if(F.col("result").isin("FAIL", "WARN") if warn_counts else F.col("result") == "FAIL").alias("n_bad"))
    found = curated.agg(F.count("*").alias("row_count"), F.array_sort(F.collect_set(item)).alias("successful_items"))  # the items of one request
    asked = F.array_sort(F.array(*map(F.lit, sorted(set(requested))))) if requested else F.col("successful_items")
    failed = F.array_except("requested_items", "successful_items")
    row = found.withColumn("requested_items", asked).join(bad).select(  # one row each
        F.lit(run_id).alias("run_id"), *(F.lit(v).alias(k) for k, v in facts.items()), F.lit(started).cast("timestamp").alias("started_at"), F.current_timestamp().alias("finished_at"),
        "requested_items", "successful_items", F.map_from_arrays(failed, F.transform(failed, lambda _: F.lit("no rows"))).alias("failed_items"), "row_count",
        batch_status(F.size("successful_items"), F.size(failed), F.col("n_bad")).alias("status"),
        F.lit(text_digest(*(f"{k}={v}" for k, v in sorted(facts.items())))).alias("config_hash"), F.current_timestamp().alias("recorded_at"),
    )
    row.write.mode("append").parquet(roots.runs)
    return tables.upsert_latest(row.sparkSession.read.parquet(roots.runs)).filter(F.col("run_id") == run_id)


def _begin(raw: DataFrame):
    """The session's clock when a batch begins."""
    return raw.sparkSession.sql("SELECT current_timestamp()").first()[0]


def collect_bars(
    raw: DataFrame, roots: Roots, *, run_id: str, trade_date: str, interval: str, session: str, adjustment: str, source: str, schema_version: str, symbols: list[str] | None = None
) -> DataFrame:
    """One capture of bars: the raw rows and the curated rows are appended, checked and recorded. symbols are those that were asked for."""
    started, day = _begin(raw), F.lit(trade_date).cast("date")
    curated = normalize.normalize_bars(
        raw, trade_date=day, interval=interval, session=session, adjustment=adjustment, source=source, schema_version=schema_version, run_id=F.lit(run_id), ingested_at=F.current_timestamp()
    )
    tables.write_bars(raw.withColumns({"interval": F.lit(interval), "requested_trade_date": day, "ingestion_run_id": F.lit(run_id)}), roots.raw)
    tables.write_bars(curated, roots.curated)
    # Filters on the partition columns: only this batch's folder is read.
    mine = raw.sparkSession.read.parquet(roots.curated).filter((F.col("interval") == interval.lower()) & (F.col("requested_trade_date") == day) & (F.col("ingestion_run_id") == run_id))
    checks = quality.bar_quality(mine, "ingest_seq" if "ingest_seq" in mine.columns else "time_key")
    return _record(roots, run_id, started, checks, mine, "code", symbols, False, requested_trade_date=trade_date, interval=interval, session=session, adjustment=adjustment)


def collect_contracts(raw: DataFrame, roots: Roots, *, run_id: str, underlying_code: str, captured_at, source: str, schema_version: str) -> DataFrame:
    """One capture of an option chain."""
    started = _begin(raw)
    curated = normalize.normalize_option_contracts(raw, underlying_code=underlying_code, captured_at=captured_at, source=source, schema_version=schema_version, run_id=run_id)
    tables.write_raw(raw, roots.raw, run_id, by_underlying=underlying_code)
    tables.write_option_contracts(curated, roots.curated)
    day = curated.agg(F.to_date(F.max("captured_at"))).first()[0]
    mine = raw.sparkSession.read.parquet(roots.curated).filter((F.col("capture_date") == F.lit(day)) & (F.col("ingestion_run_id") == run_id))
    return _record(roots, run_id, started, quality.option_contract_quality(mine), mine, "underlying_code", None, True, dataset="option_contracts", underlying_code=underlying_code)


def collect_volatility(raw: DataFrame, roots: Roots, *, run_id: str, option_code: str, start: str, end: str, captured_at, source: str) -> DataFrame:
    """One capture of option volatility over a range."""
    started = _begin(raw)
    curated = normalize.normalize_option_volatility(raw, option_code=option_code, start=start, end=end, source=source, run_id=run_id, captured_at=captured_at)
    tables.write_raw(raw, roots.raw, run_id, by_start=start, by_end=end)
    tables.write_option_volatility(curated, roots.curated, start, end)
    mine = raw.sparkSession.read.parquet(roots.curated).filter((F.col("start_date") == F.lit(start)) & (F.col("end_date") == F.lit(end)) & (F.col("ingestion_run_id") == run_id))
    return _record(roots, run_id, started, quality.option_volatility_quality(mine, start, end), mine, "option_code", None, True, dataset="option_volatility", option_code=option_code, start=start, end=end)


def collect_calendar(raw: DataFrame, roots: Roots, *, run_id: str, market: str | None, code: str | None, start: str, end: str, captured_at, source: str, schema_version: str) -> DataFrame:
    """One capture of a trading calendar."""
    started = _begin(raw)
    curated = normalize.normalize_calendar(raw, market=market, code=code, start=start, end=end, captured_at=captured_at, source=source, schema_version=schema_version, run_id=run_id)
    tables.write_raw(raw, roots.raw, run_id, by_scope=market or code or "", by_start=start, by_end=end)
    tables.write_calendar(curated, roots.curated)
    mine = raw.sparkSession.read.parquet(roots.curated).filter((F.col("by_start") == F.lit(start).cast("date")) & (F.col("by_end") == F.lit(end).cast("date")) & (F.col("ingestion_run_id") == run_id))
    checks = quality.calendar_quality(mine, start, end, "ingest_seq" if "ingest_seq" in mine.columns else "trade_date")
    return _record(roots, run_id, started, checks, mine, "scope_value", None, True, dataset="trading_calendar", scope=market or code or "", start=start, end=end)
