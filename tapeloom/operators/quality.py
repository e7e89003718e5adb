"""Quality suites: one pass of conditional aggregates over a batch, returned as rows of check_name, result and actual."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import codes
from tapeloom.operators.coverage_ranges import volatility_coverage
from tapeloom.operators.ordered import steps_back


def _extra(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows over one for each key, null keys equal; one row."""
    return df.groupBy(*keys).agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def _results(counts: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """counts has one row with a number (bad rows) for each check; kinds gives the result of a bad one."""
    rows = [F.struct(F.lit(c).alias("check_name"), F.when(F.col(c) == 0, "PASS").otherwise(k).alias("result"), F.col(c).cast("string").alias("actual")) for c, k in kinds.items()]
    return counts.select(F.inline(F.when(F.col("non_empty") == 0, F.array(*rows)).otherwise(F.array(rows[0]))))


def _unusable(df: DataFrame, required: list[str]) -> DataFrame | None:
    """What a suite says of a batch that lacks required columns: non_empty, and required_columns with their names; None where all are there."""
    missing = sorted(set(required) - set(df.columns))
    if not missing:
        return None
    n = F.count("*")
    empty = F.struct(F.lit("non_empty").alias("check_name"), F.when(n > 0, "PASS").otherwise("FAIL").alias("result"), F.when(n > 0, "0").otherwise("1").alias("actual"))
    lacking = F.struct(F.lit("required_columns").alias("check_name"), F.lit("FAIL").alias("result"), F.lit(", ".join(missing)).alias("actual"))
    return df.agg(F.when(n > 0, F.array(empty, lacking)).otherwise(F.array(empty)).alias("x")).select(F.inline("x"))


def _bad(c: Column) -> Column:
    return F.coalesce(F.count_if(c), F.lit(0))


def _structure() -> tuple[Column, Column]:
    """non_empty and required_columns as numbers of faults, where no column is missing."""
    return F.when(F.count("*") == 0, 1).otherwise(0).alias("non_empty"), F.lit(0).alias("required_columns")


#: The columns that each suite asks for.
BAR_COLUMNS = ["code", "time_utc", "open", "high", "low", "close", "volume"]
CONTRACT_COLUMNS = ["option_code", "underlying_code", "option_type", "strike_price", "expiry_date"]
VOLATILITY_COLUMNS = ["option_code", "trade_date", "implied_volatility"]
CALENDAR_COLUMNS = ["scope_type", "scope_value", "trade_date", "trade_date_type"]


def _no_nan(name: str) -> Column:
    return F.when(~F.isnan(name), F.col(name))


def bar_quality(df: DataFrame, sequence: str = "ingest_seq") -> DataFrame:
    """The bar suite. Duplicates count extra copies; null or NaN prices fail non_null_prices alone; a null volume is invalid; time_monotonic_by_code counts the symbols whose order, by `sequence`, goes back. A batch without rows has one result, one without required columns two."""
    if (bad := _unusable(df, BAR_COLUMNS)) is not None:
        return bad
    o, h, low, c = (_no_nan(x) for x in ("open", "high", "low", "close"))
    wrong = (h < F.greatest(o, c, low)) | (low > F.least(o, c, h))
    back = steps_back(df, ["code"], F.col(sequence), F.col("time_utc")).filter("code is not null")
    counts = (
        df.agg(
            *_structure(),
            _bad(F.coalesce(wrong, F.lit(False))).alias("ohlc_consistency"),
            _bad(F.coalesce(_no_nan("volume") < 0, F.lit(True))).alias("non_negative_volume"),
            _bad(o.isNull() | h.isNull() | low.isNull() | c.isNull()).alias("non_null_prices"),
        )
        .join(_extra(df, ["code", "interval", "adjustment", "time_utc"]).withColumnRenamed("n", "duplicate_bars"))  # one row each
        .join(back.agg(F.count_if(F.col("n") > 0).alias("time_monotonic_by_code")))
    )
    order = ("non_empty", "required_columns", "duplicate_bars", "ohlc_consistency", "non_negative_volume", "time_monotonic_by_code", "non_null_prices")
    return _results(counts, dict.fromkeys(order, "FAIL"))


def option_contract_quality(df: DataFrame) -> DataFrame:
    """The contract suite; a null strike price is not counted as not positive, an underlying that the code contradicts is a warning."""
    if (bad := _unusable(df, CONTRACT_COLUMNS)) is not None:
        return bad
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    stray = codes.underlying(F.col("option_code")) != F.coalesce("underlying_code", F.lit(""))
    counts = df.agg(
        *_structure(),
        _bad(blank("option_code")).alias("option_code_non_empty"),
        _bad(blank("underlying_code")).alias("underlying_code_non_empty"),
        _bad(F.coalesce(~F.col("option_type").isin("CALL", "PUT"), F.lit(True))).alias("option_type_call_or_put"),
        _bad(F.coalesce(_no_nan("strike_price") <= 0, F.lit(False))).alias("strike_price_positive"),
        _bad(F.col("expiry_date").isNull()).alias("expiry_date_valid"),
        _bad(F.coalesce(stray, F.lit(False))).alias("option_underlying_relationship"),
    ).join(_extra(df, ["option_code", "captured_at", "source"]).withColumnRenamed("n", "duplicate_option_contracts"))
    names = ("non_empty", "required_columns", "option_code_non_empty", "underlying_code_non_empty", "option_type_call_or_put", "strike_price_positive", "expiry_date_valid", "duplicate_option_contracts")
    return _results(counts, dict.fromkeys(names, "FAIL") | {"option_underlying_relationship": "WARN"})


def option_volatility_quality(df: DataFrame, start: str, end: str) -> DataFrame:
    """The volatility suite; a date that did not parse fails trade_date_valid alone; incomplete ranges are warnings."""
    if (bad := _unusable(df, VOLATILITY_COLUMNS)) is not None:
        return bad
    numbers = ("implied_volatility", "historical_volatility", "average_implied_volatility")
    negative = [F.coalesce(_no_nan(c) < 0, F.lit(False)) for c in numbers if c in df.columns]
    outside = F.coalesce(~F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False))
    by_code = volatility_coverage(df, start, end)
    whole = volatility_coverage(df.withColumn("option_code", F.lit("all")), start, end)
    counts = (
        df.agg(
            *_structure(),
            _bad(F.col("trade_date").isNull()).alias("trade_date_valid"),
            _bad(reduce(Column.__or__, negative, F.lit(False))).alias("non_negative_volatility"),
            _bad(outside).alias("trade_date_in_requested_range"),
        )
        .join(_extra(df, ["option_code", "trade_date", "source"]).withColumnRenamed("n", "duplicate_option_volatility"))
        .join(whole.agg(_bad(~F.col("range_complete")).alias("requested_range_complete")))
        .join(by_code.agg(_bad(~F.col("range_complete")).alias("requested_range_complete_by_code")))
    )
    fails = ("non_empty", "required_columns", "trade_date_valid", "duplicate_option_volatility", "non_negative_volatility", "trade_date_in_requested_range")
    return _results(counts, dict.fromkeys(fails, "FAIL") | {"requested_range_complete": "WARN", "requested_range_complete_by_code": "WARN"})


def calendar_quality(df: DataFrame, start: str, end: str, sequence: str = "ingest_seq") -> DataFrame:
    """The calendar suite; trade_date_type_known reports the sorted list of unknown types."""
    if (bad := _unusable(df, CALENDAR_COLUMNS)) is not None:
        return bad
    back = steps_back(df, ["scope_type", "scope_value"], F.col(sequence), F.col("trade_date"))
    outside = F.coalesce(~F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False))
    known = ("WHOLE", "MORNING", "AFTERNOON")
    counts = (
        df.agg(
            *_structure(),
            _bad(F.col("trade_date").isNull()).alias("trade_date_valid"),
            _bad(outside).alias("trade_date_in_requested_range"),
            _bad(F.coalesce(~F.col("scope_type").isin("MARKET", "CODE"), F.lit(True))).alias("scope_type_valid"),
            _bad(F.coalesce(F.trim("scope_value") == "", F.lit(True))).alias("scope_value_non_empty"),
            _bad(F.coalesce(F.col("trade_date_type") == "", F.lit(True))).alias("trade_date_type_non_empty"),
            F.array_join(F.array_sort(F.collect_set(F.when(~F.col("trade_date_type").isin(*known), F.col("trade_date_type")))), ", ").alias("unknown"),
        )
        .join(_extra(df, ["scope_type", "scope_value", "trade_date", "source", "captured_at"]).withColumnRenamed("n", "duplicate_trading_calendar"))
        .join(back.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("trade_date_ascending")))
    )
    names = ("non_empty", "required_columns", "trade_date_valid", "trade_date_in_requested_range", "scope_type_valid", "scope_value_non_empty", "duplicate_trading_calendar", "trade_date_ascending", "trade_date_type_non_empty")
    last = counts.filter("non_empty = 0").select(F.lit("trade_date_type_known").alias("check_name"), F.when(F.col("unknown") == "", "PASS").otherwise("WARN").alias("result"), F.when(F.col("unknown") == "", "all known").otherwise(F.col("unknown")).alias("actual"))
    return _results(counts, dict.fromkeys(names, "FAIL")).unionByName(last)
