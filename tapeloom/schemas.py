"""Explicit schemas of the stored tables. Readers use them, so columns that older files lack read as null."""

CURATED_BARS = """code string, name string, asset_type string, underlying_code string, interval string, adjustment string,
time_market timestamp, time_utc timestamp, market_calendar_date date, requested_trade_date date, requested_session string, session string,
open double, high double, low double, close double, volume double, turnover double, last_close double, change_rate double, pe_ratio double,
turnover_rate double, source string, source_schema_version string, ingestion_run_id string, ingested_at timestamp, time_key string, ingest_seq long"""

INGESTION_RUNS = """run_id string, started_at timestamp, finished_at timestamp, requested_trade_date date, requested_symbols array<string>,
interval string, session string, adjustment string, successful_symbols array<string>, failed_symbols map<string,string>, raw_file string,
curated_file string, row_count long, status string, config_hash string"""

QUALITY_RESULTS = "run_id string, check_name string, result string, expected_value string, actual_value string, details string"

DATASET_RUNS = """run_id string, dataset string, started_at timestamp, finished_at timestamp, status string, parameters string,
requested_items array<string>, successful_items array<string>, failed_items map<string,string>, raw_file string, curated_file string,
quality_report string, row_count long, config_hash string"""

TRADING_CALENDAR = """scope_type string, scope_value string, market string, reference_code string, trade_date date, trade_date_type string,
requested_start_date date, requested_end_date date, captured_at timestamp, source string, source_schema_version string, ingestion_run_id string"""

OPTION_CONTRACTS = """option_code string, option_name string, underlying_code string, option_type string, strike_price double, expiry_date date,
contract_size double, lot_size double, exchange string, exercise_type string, suspension boolean, delisting boolean, captured_at timestamp,
source string, source_schema_version string, ingestion_run_id string"""

OPTION_VOLATILITY = """option_code string, trade_date date, implied_volatility double, historical_volatility double, volatility_premium double,
average_implied_volatility double, volatility_status long, analysis string, captured_at timestamp, source string, source_schema_version string,
ingestion_run_id string"""

#: Fields that hold a bar's content; two captures of a bar must agree in all of them.
BAR_VALUES = ("open", "high", "low", "close", "volume", "turnover", "last_close", "change_rate", "pe_ratio", "turnover_rate")
BAR_CLASS = ("market_calendar_date", "session")


def names(schema: str) -> list[str]:
    """Column names of a schema text without nested commas in names."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).names
