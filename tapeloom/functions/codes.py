"""Instrument codes and lenient parses of vendor values as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: market, root, six digits of a date, side, strike.
OPTION_CODE = r"^([A-Z]+)\.([A-Z.]+)\d{6}[CP]\d+$"


def asset_type(code: Column) -> Column:
    """OPTION for an option code in any case, else EQUITY."""
    return F.when(F.upper(code).rlike(OPTION_CODE), "OPTION").otherwise("EQUITY")


def underlying(code: Column) -> Column:
    """market.root of an option code; null for others."""
    upper = F.upper(code)
    return F.when(upper.rlike(OPTION_CODE), F.concat_ws(".", F.regexp_extract(upper, OPTION_CODE, 1), F.regexp_extract(upper, OPTION_CODE, 2)))


def option_side(value: Column, code: Column) -> Column:
    """CALL or PUT from a text, a one-letter or number code, or the seventh character from the end of the option code; else null."""
    text = F.upper(F.coalesce(value.cast("string"), F.lit("")))
    mark = F.when(F.length(code) >= 8, F.substring(F.upper(code), -7, 1))
    return (
        F.when(text.contains("CALL") | text.isin("C", "1"), "CALL")
        .when(text.contains("PUT") | text.isin("P", "2"), "PUT")
        .when(mark == "C", "CALL")
        .when(mark == "P", "PUT")
    )


def lenient_boolean(value: Column) -> Column:
    """Yes, no or null from the texts that vendors use."""
    text = F.lower(F.trim(value.cast("string")))
    return F.when(text.isin("true", "1", "yes", "y", "suspended", "delisted"), True).when(text.isin("false", "0", "no", "n", "normal"), False)


def number(value: Column) -> Column:
    """A double; what is no number, or not finite, is null."""
    x = value.cast("string").try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def finite(value: Column) -> Column:
    """Whether a value is a finite number; null is not."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) != float("inf")), F.lit(False))


def first_present(columns: list[str], names: list[str]) -> Column:
    """The first non-null of the named columns that a table has, as text; null if it has none."""
    there = [F.col(n).cast("string") for n in names if n in columns]
    return F.coalesce(*there) if there else F.lit(None).cast("string")
