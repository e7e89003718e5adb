"""Sample requests: windows of contiguous bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions import identity as ids
from tapeloom.guards import require_empty

SERIES = ["code", "interval", "adjustment", "requested_session", "market_calendar_date", "session"]


def merged_builds(builds: DataFrame, key: str = "canonical_row_version_id") -> DataFrame:
    """Rows of several builds (column build_id), one for each key with the sorted build_ids; rows of one key that differ raise."""
    values = [c for c in builds.columns if c != "build_id"]
    d = builds.withColumn("_d", ids.row_digest(builds, values))
    require_empty(d.groupBy(key).agg(F.count_distinct("_d").alias("n")).filter("n > 1"), f"builds differ in rows of one {key}")
    w = Window.partitionBy(key).orderBy("build_id")
    every = d.groupBy(key).agg(F.array_sort(F.collect_set("build_id")).alias("build_ids"))
    return d.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_d", "build_id").join(every, key)


#: Where a snapshot lies says nothing of what a bar is.
MOVABLE = ("snapshot_file",)


def reconciled(builds: DataFrame) -> DataFrame:
    """Rows of several canonical builds (column build_id), one for each canonical_bar_key, with the sorted build_ids that hold it and n_contents.

    n_contents is 1 where all builds agree in every column but build_id and those of MOVABLE: version, values, times and
    sources. Where they differ nothing chooses a winner: call require_reconciled(), or count n_contents > 1 while the result
    is written. One aggregation by key; a key has as many rows as there are builds, and the row of the least build stands.
    """
    values = [c for c in builds.columns if c != "build_id"]
    content = ids.row_digest(builds, [c for c in values if c not in MOVABLE])
    d = builds.select(F.col("canonical_bar_key").alias("_key"), "build_id", F.struct(*values).alias("_row"), content.alias("_d"))
    one = d.groupBy("_key").agg(F.min_by("_row", F.struct("build_id", "_row")).alias("_row"), F.array_sort(F.collect_set("build_id")).alias("build_ids"), F.size(F.collect_set("_d")).alias("n_contents"))
    return one.select("_row.*", "build_ids", "n_contents")


def require_reconciled(merged: DataFrame) -> None:
    require_empty(merged.filter("n_contents > 1").select("canonical_bar_key", "build_ids"), "builds differ in one bar")


def require_unique(bars: DataFrame) -> None:
    """One bar for each event slot."""
    require_empty(bars.groupBy("code", "interval", "adjustment", "requested_session", "event_time").count().filter("count > 1"), "two bars of one event")


def in_scope(bars: DataFrame, *, interval: str, adjustment: str, session: str, symbols: DataFrame | None = None, dates: DataFrame | None = None) -> DataFrame:
    """Bars of the scope; symbols (code) and dates (trade_date) limit it where given."""
    out = bars.filter((F.col("interval") == interval) & (F.col("adjustment") == adjustment) & (F.col("requested_session") == session))
    if symbols is not None:
        out = out.join(symbols.select("code").distinct(), "code", "left_semi")
    if dates is not None:
        out = out.join(dates.select(F.col("trade_date").alias("market_calendar_date")).distinct(), "market_calendar_date", "left_semi").select(*bars.columns)
    return out


def contiguous(bars: DataFrame, seconds: int) -> DataFrame:
    """bars with segment, position in it (from 0) and segment_bars: runs whose bars lie exactly one interval apart."""
    w = Window.partitionBy(*SERIES).orderBy("event_time")
    step = F.unix_seconds("event_time") - F.unix_seconds(F.lag("event_time").over(w))
    rows = bars.withColumn("_new", F.when(step == seconds, 0).otherwise(1))
    rows = rows.withColumn("segment", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
    s = Window.partitionBy(*SERIES, "segment")
    return rows.withColumn("position", F.row_number().over(s.orderBy("event_time")) - 1).withColumn("segment_bars", F.count("*").over(s))


def requests(bars: DataFrame, *, seconds: int, feature_bars: int, label_bars: int = 0, stride: int = 1) -> DataFrame:
    """One request for each anchor: feature window [first bar, anchor + interval), label window the label_bars after it (null without).

    Anchors stand every `stride` bars from position feature_bars - 1 of each segment and have label_bars bars behind
    them in it. Windows that cannot be (feature_bars < 1, label_bars < 0, stride < 1) raise at once.
    """
    if feature_bars < 1 or label_bars < 0 or stride < 1:
        raise ValueError("a request needs feature_bars >= 1, label_bars >= 0 and stride >= 1")
    rows = contiguous(bars, seconds)
    at = F.col("position") - (feature_bars - 1)
    rows = rows.filter((at >= 0) & (at % stride == 0) & (F.col("position") + label_bars < F.col("segment_bars")))
    span = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds * n))
    close = F.col("event_time") + span(1)
    out = rows.select(
        "code", "interval", "adjustment", "requested_session", F.col("market_calendar_date").alias("anchor_market_calendar_date"),
        (F.col("event_time") - span(feature_bars - 1)).alias("feature_window_start"), close.alias("feature_window_close"),
        (close if label_bars else F.lit(None).cast("timestamp")).alias("label_window_start"), (close + span(label_bars) if label_bars else F.lit(None).cast("timestamp")).alias("label_window_close"),
    )
    key = ids.sample_key(*(F.col(c) for c in out.columns))
    return out.select(key.alias("sample_key"), "*")


def shortfalls(bars: DataFrame, *, seconds: int, feature_bars: int, label_bars: int) -> DataFrame:
    """One row: segments, segments too short for a feature window, anchors without enough bars for a label."""
    rows = contiguous(bars, seconds)
    last = F.col("position") == F.col("segment_bars") - 1
    lacking = (F.col("position") >= feature_bars - 1) & (F.col("position") + label_bars >= F.col("segment_bars"))
    return rows.agg(F.count_if(last).alias("n_segments"), F.count_if(last & (F.col("segment_bars") < feature_bars)).alias("n_short_segments"), F.count_if(lacking).alias("n_unlabelled_anchors"))


def require_unique_keys(reqs: DataFrame) -> None:
    require_empty(reqs.groupBy("sample_key").count().filter("count > 1"), "two requests have one key")
