"""Registered queries against their SQL on the smallest tables, where these are there."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SOME = ("bars_normalized", "bar_quality", "calendar_latest", "ranges_missing", "option_contracts", "incomplete_reasons", "coverage_audit", "intraday_summary", "canonical_conflicts", "canonical_gaps", "content_ids", "pit_known_gaps", "feature_reasons", "label_reasons", "split_counts", "catalog_entries", "bar_inventory", "coverage_totals", "intraday_checks", "canonical_from_snapshots", "builds_reconciled", "build_pins", "gap_references", "sample_ledger", "snapshot_hash_groups", "split_edges", "sample_versions", "pit_diagnostics", "option_contract_quality", "option_volatility_quality", "calendar_quality", "minute_bars", "minute_segments", "minute_windows", "option_contracts_latest", "calendar_normalized", "option_volatility", "stored_bars", "bar_batches", "stored_build_altered")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no tables here")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(rows):
    return sorted((tuple("" if v is None else round(v, 9) if isinstance(v, float) and math.isfinite(v) else str(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", SOME)
def test_same_rows(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    names = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in names)
    want = duck.execute(f"SELECT {quoted} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert plain(df.select(*names).collect()) == plain(want)


def test_every_market_query_has_sql():
    own = {k for k in entry.queries() if not (k.startswith("op") and k[2].isdigit()) and k != "pipeline"}
    assert len(own) == 96 and own <= entry.oracle_sql().keys()


def test_entry_has_rows(spark):
    if not os.path.isdir(SF):
        pytest.skip("no tables here")
    df = entry.entry(spark)
    assert df.count() > 0 and "code" in df.columns
