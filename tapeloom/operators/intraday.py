"""Intraday integrity of complete snapshots: twelve checks, segments, gaps and a summary, all snapshots in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions import market_time as mt

ITEM = ["code", "requested_trade_date"]
SESSIONS = ("OVERNIGHT", "PRE_MARKET", "REGULAR", "AFTER_HOURS")


def snapshot_rows(bars: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of the chosen snapshots; chosen has code, requested_trade_date, ingestion_run_id and snapshot_file."""
    return bars.join(chosen.select(*ITEM, "ingestion_run_id", "snapshot_file"), [*ITEM, "ingestion_run_id", "snapshot_file"])


def _walk():
    """A snapshot's rows in time; rows of one time by their content."""
    return Window.partitionBy(*ITEM).orderBy("time_utc", "open", "close", "volume")


def segmented(rows: DataFrame, seconds: int) -> DataFrame:
    """rows with segment (from 1), delta (seconds since the row before in the segment) and kind of delta (ok, gap, off).

    A segment ends where the session of the market's clock or its date of occurrence changes; the same
    label later in the day is a new segment.
    """
    w = _walk()
    own = mt.session_label(F.col("time_utc"))
    rows = rows.withColumn("own_session", own).withColumn("own_date", mt.occurrence_date(F.col("time_utc"), F.col("own_session")))
    place = F.struct("own_session", "own_date")
    rows = rows.withColumn("_new", F.when(F.lag(place).over(w).eqNullSafe(place), 0).otherwise(1))
    rows = rows.withColumn("segment", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.when(F.col("_new") == 0, F.lag("time_utc").over(w))
    rows = rows.withColumn("previous_time", before).withColumn("delta", F.unix_seconds("time_utc") - F.unix_seconds("previous_time"))
    kind = F.when(F.col("delta").isNull(), "first").when((F.col("delta") <= 0) | (F.col("delta") % seconds != 0), "off").when(F.col("delta") > seconds, "gap").otherwise("ok")
    return rows.withColumn("step", kind).drop("_new")


def segments(rows: DataFrame, seconds: int) -> DataFrame:
    """Per segment: session, first and last time, rows, deltas off the grid, gaps, estimated missing bars."""
    missing = F.when(F.col("step") == "gap", F.floor(F.col("delta") / seconds) - 1).otherwise(0)
    return segmented(rows, seconds).groupBy(*ITEM, "segment").agg(
        F.first("own_session").alias("session"), F.min("time_utc").alias("first_time"), F.max("time_utc").alias("last_time"), F.count("*").alias("row_count"),
        F.count_if(F.col("step") == "off").alias("grid_violations"), F.count_if(F.col("step") == "gap").alias("gap_count"), F.sum(missing).cast("long").alias("missing_bars"),
    )


def gaps(rows: DataFrame, seconds: int, most: int | None = None) -> DataFrame:
    """Every internal gap with its neighbours; with `most`, the first of each item and whether more were left out (truncated)."""
    found = segmented(rows, seconds).filter(F.col("step") == "gap").select(
        *ITEM, "segment", F.col("own_session").alias("session"), "previous_time", F.col("time_utc").alias("next_time"), F.col("delta").alias("delta_seconds"), (F.floor(F.col("delta") / seconds) - 1).alias("missing_bars")
    )
    if most is None:
        return found
    w = Window.partitionBy(*ITEM)
    found = found.withColumn("_n", F.row_number().over(w.orderBy("previous_time", "segment"))).withColumn("truncated", F.count("*").over(w) > most)
    return found.filter(F.col("_n") <= most).drop("_n")


#: Checks that need a valid time.
TIMED = ("TIMEZONE_INSTANT_CONSISTENCY", "MARKET_CALENDAR_DATE_CONSISTENCY", "SESSION_LABEL_CONSISTENCY", "REQUESTED_SESSION_SCOPE", "DUPLICATE_TIMESTAMPS", "MINUTE_BOUNDARY_ALIGNMENT", "DELTA_GRID_ALIGNMENT", "INTERNAL_GAPS")


def checks(rows: DataFrame, expected: dict[str, str], seconds: int, chosen: DataFrame | None = None) -> DataFrame:
    """Per item and check: check_name, result, mismatch_count and details.

    expected has the request key by column. Columns that no row fills count as missing. A row without both its times
    fails VALID_TIMESTAMPS; where no row has them, the checks of TIMED are INFO and NOT_EVALUATED. A duplicate time counts
    all its rows, null times equal. A stored label that the clock does not give, and one that the clock calls UNKNOWN, each count
    once in SESSION_LABEL_CONSISTENCY. details names the labels outside the requested scope with their numbers, most frequent first; a
    scope other than RTH and ALL is not evaluated and says so. The rows are read in one pass. chosen, where
    given, has the items themselves (code, requested_trade_date): one without rows fails NON_EMPTY and has no other check.
    """
    allowed = {"RTH": ("REGULAR",), "ALL": SESSIONS}.get(expected["requested_session"])
    need = ["code", "time_utc", "time_market", "open", "high", "low", "close", "volume", "session", "market_calendar_date"]
    wrong = F.lit(False)
    for name, value in expected.items():
        wrong = wrong | ~F.col(name).cast("string").eqNullSafe(F.lit(value))
    both = F.col("time_utc").isNotNull() & F.col("time_market").isNotNull()
    label = mt.session_label(F.col("time_utc"))
    rows = segmented(rows, seconds).withColumn("_same", F.count("*").over(Window.partitionBy(*ITEM, "time_utc")))
    stray = F.lit(False) if not allowed else ~F.coalesce(F.col("session").isin(*allowed), F.lit(False))
    found = rows.groupBy(*ITEM).agg(
        sum(F.when(F.count(c) == 0, 1).otherwise(0) for c in need).alias("REQUIRED_COLUMNS"),
        F.lit(0).alias("NON_EMPTY"),
        F.count_if(wrong).alias("EXACT_REQUEST_METADATA"),
        F.count_if(~both).alias("VALID_TIMESTAMPS"),
        F.count_if(both & (F.col("time_utc") != F.col("time_market"))).alias("TIMEZONE_INSTANT_CONSISTENCY"),
        F.count_if(both & ~F.col("market_calendar_date").eqNullSafe(mt.market_date(F.col("time_utc")))).alias("MARKET_CALENDAR_DATE_CONSISTENCY"),
        (F.count_if(both & ~F.col("session").eqNullSafe(label)) + F.count_if(both & (label == "UNKNOWN"))).alias("SESSION_LABEL_CONSISTENCY"),
        (F.count_if(~F.coalesce(F.col("session").isin(*allowed), F.lit(False))) if allowed else F.lit(0)).alias("REQUESTED_SESSION_SCOPE"),
        F.count_if(F.col("_same") > 1).alias("DUPLICATE_TIMESTAMPS"),
        F.count_if(F.unix_micros("time_utc") % 60_000_000 != 0).alias("MINUTE_BOUNDARY_ALIGNMENT"),
        F.count_if(F.col("step") == "off").alias("DELTA_GRID_ALIGNMENT"),
        F.count_if(F.col("step") == "gap").alias("INTERNAL_GAPS"),
        F.bool_or(both).alias("timed"),
        F.collect_list(F.when(stray, F.coalesce("session", F.lit("None")))).alias("strays"),  # the bars of one item at most
    )
    names = [c for c in found.columns if c not in (*ITEM, "timed", "strays")]
    counted = F.transform(F.array_distinct("strays"), lambda x: F.struct((-F.size(F.filter("strays", lambda y: y == x))).alias("n"), x.alias("label")))
    found = found.withColumn("labels", F.array_join(F.transform(F.array_sort(counted), lambda x: F.concat_ws(": ", x["label"], (-x["n"]).cast("string"))), ", "))
    if chosen is not None:
        found = chosen.select(*ITEM).distinct().join(found, ITEM, "left").withColumn("NON_EMPTY", F.coalesce("NON_EMPTY", F.lit(1)))

    def row(c):
        bad = F.when(F.col(c) == 0, "PASS").otherwise("WARN" if c == "INTERNAL_GAPS" else "FAIL")
        if c == "REQUESTED_SESSION_SCOPE" and not allowed:
            bad = F.lit("INFO")
        result = F.when(F.col("timed"), bad).otherwise("INFO") if c in TIMED else bad
        count = F.when(F.col("timed"), F.col(c)).otherwise(0) if c in TIMED else F.col(c)
        scope = F.coalesce("labels", F.lit("")) if allowed else F.lit("SESSION_SCOPE_NOT_EVALUATED")
        details = F.when(F.col("timed"), scope) if c == "REQUESTED_SESSION_SCOPE" else F.when(F.col("timed"), "") if c in TIMED else F.lit("")
        return F.struct(F.lit(c).alias("check_name"), result.alias("result"), count.cast("long").alias("mismatch_count"), F.coalesce(details, F.lit("NOT_EVALUATED")).alias("details"))

    every = F.array(*map(row, names))
    return found.select(*ITEM, F.inline(F.when(F.col("NON_EMPTY") == 0, every).otherwise(F.array(row("NON_EMPTY")))))


def session_counts(rows: DataFrame) -> DataFrame:
    """Rows by session of each item, with the first and last time."""
    return rows.groupBy(*ITEM).agg(*(F.count_if(F.col("session") == s).alias(s.lower()) for s in SESSIONS), F.min("time_market").alias("first_time"), F.max("time_market").alias("last_time"))


def summary(states: DataFrame, check_rows: DataFrame, segment_rows: DataFrame) -> DataFrame:
    """One row over all expected items: states, audited items by result, totals, coverage and overall status."""
    worst = check_rows.groupBy(*ITEM).agg(
        F.when(F.bool_or(F.col("result") == "FAIL"), "FAILED").when(F.bool_or(F.col("result") == "WARN"), "WARN").otherwise("PASS").alias("audit"),
        *(F.sum(F.when(F.col("check_name") == c, F.col("mismatch_count"))).alias(c) for c in ("DUPLICATE_TIMESTAMPS", "VALID_TIMESTAMPS", "INTERNAL_GAPS")),
    )
    sizes = segment_rows.groupBy(*ITEM).agg(F.sum("row_count").alias("rows"), F.sum("missing_bars").alias("missing"))
    items = states.join(worst.join(sizes, ITEM, "left").withColumnRenamed("requested_trade_date", "trade_date"), ["code", "trade_date"], "left")
    n = lambda c: F.count_if(c)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    out = items.agg(
        F.count("*").alias("expected_items"), n(F.col("state") == "COMPLETE").alias("complete_items"), n(F.col("state") == "INCOMPLETE").alias("incomplete_items"), n(F.col("state") == "MISSING").alias("missing_items"),
        n(F.col("audit") == "PASS").alias("pass_items"), n(F.col("audit") == "WARN").alias("warn_items"), n(F.col("audit") == "FAILED").alias("fail_items"),
        total("rows").alias("audited_rows"), total("DUPLICATE_TIMESTAMPS").alias("duplicate_timestamps"), total("VALID_TIMESTAMPS").alias("invalid_timestamps"), total("INTERNAL_GAPS").alias("internal_gaps"), total("missing").alias("missing_bars"),
    )
    out = out.withColumn("coverage_percentage", F.when(F.col("expected_items") > 0, F.bround(F.col("complete_items") / F.col("expected_items") * 100, 2)).otherwise(100.0))
    warn = (F.col("warn_items") > 0) | (F.col("incomplete_items") > 0) | (F.col("missing_items") > 0)
    return out.withColumn("status", F.when(F.col("fail_items") > 0, "FAILED").when(warn, "WARN").otherwise("PASS"))


def audit(bars: DataFrame, chosen: DataFrame, states: DataFrame, expected: dict[str, str], seconds: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(checks, segments, summary) of all chosen snapshots, with the items that have none."""
    rows = snapshot_rows(bars, chosen)
    found, parts = checks(rows, expected, seconds, chosen), segments(rows, seconds)
    return found, parts, summary(states, found, parts)
