"""Vendor rows to curated rows. 'Keep last' follows ingest_seq where a table has it; without it the choice among equal keys is by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions import codes
from tapeloom.functions import market_time as mt

REQUIRED = ("code", "time_key", "open", "high", "low", "close", "volume")
NUMBERS = ("open", "high", "low", "close", "volume", "turnover", "last_close", "change_rate", "pe_ratio", "turnover_rate")


def keep_last(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key (null keys are equal): the last ingested; of rows that tie, the one whose columns, in their order, are greatest, null least. Columns must be orderable (no maps)."""
    sequence = [F.desc_nulls_last("ingest_seq")] if "ingest_seq" in df.columns else []
    w = Window.partitionBy(*keys).orderBy(*sequence, F.desc_nulls_last(F.struct(*df.columns)))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def normalize_bars(raw: DataFrame, *, trade_date: Column, interval: str, session: str, adjustment: str, source: str, schema_version: str, run_id: Column, ingested_at: Column, on_bad_time: str = "error") -> DataFrame:
    """Curated bars from vendor rows with local start times in time_key.

    Names are upper case, numbers that do not parse are null, other columns of raw follow at the end. A
    missing required column raises at once; a time that a clock change skips or repeats raises when
    rows are read, or is null with on_bad_time='null'. An empty table gives none.
    """
    if gone := [c for c in REQUIRED if c not in raw.columns]:
        raise ValueError(f"missing columns: {gone}")
    code = F.upper(F.trim("code"))
    instant = mt.to_instant(F.col("time_key"), on_bad=on_bad_time)
    out = {
        "code": code,
        "name": F.col("name").cast("string") if "name" in raw.columns else F.lit(None).cast("string"),
        "asset_type": codes.asset_type(code),
        "underlying_code": codes.underlying(code),
        "interval": F.lit(interval.lower()),
        "adjustment": F.lit(adjustment.upper()),
        "time_market": instant,
        "time_utc": instant,
        "market_calendar_date": mt.market_date(instant),
        "requested_trade_date": trade_date,
        "requested_session": F.lit(session.upper()),
        "session": mt.session_label(instant),
        **{n: F.col(n).cast("string").try_cast("double") if n in raw.columns else F.lit(None).cast("double") for n in NUMBERS},
        "source": F.lit(source),
        "source_schema_version": F.lit(schema_version),
        "ingestion_run_id": run_id,
        "ingested_at": ingested_at,
        "time_key": F.col("time_key").cast("string"),
    }
    extras = [c for c in raw.columns if c not in out]
    return raw.select(*(v.alias(k) for k, v in out.items()), *extras)


def _sequence(raw: DataFrame) -> list[str]:
    return ["ingest_seq"] if "ingest_seq" in raw.columns else []


def normalize_option_contracts(raw: DataFrame, *, underlying_code: str, captured_at: Column, source: str, schema_version: str, run_id: str) -> DataFrame:
    """Contracts from vendor rows under any of the known names; the last of each (option_code, captured_at, source)."""
    pick = lambda *names: codes.first_present(raw.columns, list(names))
    code = pick("option_code", "code", "stock_code")
    rows = raw.select(
        code.alias("option_code"),
        pick("option_name", "name", "stock_name").alias("option_name"),
        F.coalesce(F.nullif(pick("underlying_code", "owner_stock_code", "stock_owner", "underlying"), F.lit("")), codes.underlying(code), F.lit(underlying_code)).alias("underlying_code"),
        codes.option_side(pick("option_type", "type"), code).alias("option_type"),
        codes.number(pick("strike_price", "strike")).alias("strike_price"),
        F.to_date(F.try_to_timestamp(pick("expiry_date", "strike_time", "expire_time", "expiration_date"))).alias("expiry_date"),
        codes.number(pick("contract_size", "contract_multiplier")).alias("contract_size"),
        codes.number(pick("lot_size")).alias("lot_size"),
        pick("exchange", "market").alias("exchange"),
        pick("exercise_type").alias("exercise_type"),
        codes.lenient_boolean(pick("suspension", "suspended")).alias("suspension"),
        codes.lenient_boolean(pick("delisting", "delisted")).alias("delisting"),
        captured_at.alias("captured_at"),
        F.lit(source).alias("source"),
        F.lit(schema_version).alias("source_schema_version"),
        F.lit(run_id).alias("ingestion_run_id"),
        *_sequence(raw),
    )
    return keep_last(rows, ["option_code", "captured_at", "source"])


def normalize_option_volatility(raw: DataFrame, *, option_code: str, start: str, end: str, source: str, run_id: str, schema_version: str | None = None, captured_at: Column | None = None) -> DataFrame:
    """Volatility rows inside start..end, dates from text or epoch seconds; the last of each (option_code, trade_date, source)."""
    pick = lambda *names: codes.first_present(raw.columns, list(names))
    day = F.to_date(F.try_to_timestamp(pick("trade_date", "timestamp_str", "date")))
    if "timestamp" in raw.columns:
        day = F.when(pick("trade_date", "timestamp_str", "date").isNotNull(), day).otherwise(F.to_date(F.timestamp_seconds(F.col("timestamp").cast("string").try_cast("double"))))
    rows = raw.select(
        F.coalesce(pick("option_code", "code"), F.lit(option_code)).alias("option_code"),
        day.alias("trade_date"),
        codes.number(pick("implied_volatility", "impvol")).alias("implied_volatility"),
        codes.number(pick("historical_volatility", "history_volatility", "hv")).alias("historical_volatility"),
        codes.number(pick("volatility_premium")).alias("volatility_premium"),
        codes.number(pick("average_implied_volatility", "average_impvol")).alias("average_implied_volatility"),
        codes.number(pick("volatility_status", "impvol_status")).cast("long").alias("volatility_status"),
        pick("analysis").alias("analysis"),
        (captured_at if captured_at is not None else F.lit(None).cast("timestamp")).alias("captured_at"),
        F.lit(source).alias("source"),
        F.lit(schema_version).cast("string").alias("source_schema_version"),
        F.lit(run_id).alias("ingestion_run_id"),
        *_sequence(raw),
    )
    return keep_last(rows.filter(F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))), ["option_code", "trade_date", "source"])


def normalize_calendar(raw: DataFrame, *, start: str, end: str, captured_at: Column, source: str, schema_version: str, run_id: str, market: str | None = None, code: str | None = None) -> DataFrame:
    """Calendar rows of exactly one scope, a market or a code; type names after the last dot; the last of each date and capture."""
    scope_market, scope_code = (x.strip().upper() or None if x else None for x in (market, code))
    if bool(scope_market) == bool(scope_code):
        raise ValueError("give either a market or a code")
    day = codes.first_present(raw.columns, ["trade_date"] if "trade_date" in raw.columns else ["time"])
    kind = F.element_at(F.split(F.col("trade_date_type").cast("string"), r"\."), -1) if "trade_date_type" in raw.columns else F.lit(None).cast("string")
    rows = raw.select(
        F.lit("MARKET" if scope_market else "CODE").alias("scope_type"),
        F.lit(scope_market or scope_code).alias("scope_value"),
        F.lit(scope_market).cast("string").alias("market"),
        F.lit(scope_code).cast("string").alias("reference_code"),
        F.to_date(F.try_to_timestamp(day)).alias("trade_date"),
        kind.alias("trade_date_type"),
        F.lit(start).cast("date").alias("requested_start_date"),
        F.lit(end).cast("date").alias("requested_end_date"),
        captured_at.alias("captured_at"),
        F.lit(source).alias("source"),
        F.lit(schema_version).alias("source_schema_version"),
        F.lit(run_id).alias("ingestion_run_id"),
        *_sequence(raw),
    )
    return keep_last(rows, ["scope_type", "scope_value", "trade_date", "source", "captured_at"])


def symbols(df: DataFrame, column: str = "symbol") -> DataFrame:
    """Distinct trimmed upper-case symbols; a blank or null one raises when rows are read."""
    s = F.upper(F.trim(column))
    bad = F.coalesce(s, F.lit("")) == ""
    return df.select(F.when(bad, F.raise_error(F.lit("blank symbol")).cast("string")).otherwise(s).alias("code")).distinct()
