"""Point-in-time assembly: which bar versions a sample may see, by the market's clock and the archive's."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions import identity as ids
from tapeloom.guards import require_empty

SCOPE = ["code", "interval", "adjustment", "requested_session"]
#: What features and labels read of a bar; an association carries it, so the bars need not be joined again.
VALUES = ["open", "high", "low", "close", "volume"]


def _windows(reqs: DataFrame) -> DataFrame:
    """One row for each sample and role with its half-open window."""
    cols = ["sample_key", *SCOPE, "anchor_market_calendar_date", "feature_window_close"]
    feature = reqs.select(*cols, F.lit("FEATURE").alias("role"), F.col("feature_window_start").alias("_from"), F.col("feature_window_close").alias("_to"))
    label = reqs.filter("label_window_start is not null").select(*cols, F.lit("LABEL").alias("role"), F.col("label_window_start").alias("_from"), F.col("label_window_close").alias("_to"))
    return feature.unionByName(label)


def _stretch(t, width):
    """Number of the stretch of 2 ** width seconds that t lies in."""
    return F.floor(F.unix_micros(t) / (F.lit(1_000_000) * F.pow(F.lit(2.0), width))).cast("long")


def _dealt(w: DataFrame) -> DataFrame:
    """Windows with _width and _at, once for each stretch of time they touch: stretches are about as long as the window (the power of two of seconds that is not shorter), so two at most."""
    seconds = F.unix_micros("_to") - F.unix_micros("_from")
    w = w.withColumn("_width", F.greatest(F.ceil(F.log2(F.greatest(seconds, F.lit(1)) / 1_000_000)), F.lit(0)).cast("int"))
    last = _stretch(F.col("_to") - F.expr("interval 1 microsecond"), F.col("_width"))
    return w.withColumn("_at", F.explode(F.sequence(_stretch(F.col("_from"), F.col("_width")), last)))


def candidates(bars: DataFrame, reqs: DataFrame, as_of=None) -> DataFrame:
    """Bars inside each window with status SELECTED, NOT_MARKET_AVAILABLE or NOT_ARCHIVED.

    A bar is dealt to its stretch of each length of window that occurs: an equi-join
    on scope, length and stretch with a filter, whose pairs are at most a few times those that are kept. A bar has one
    stretch of a length, so no pair comes twice. A bar must be known to the market when its window closes, in either
    role; as_of, where given, asks that the archive had the bar by then.
    """
    w = _dealt(_windows(reqs))
    values = [c for c in VALUES if c in bars.columns]
    b = bars.select(*SCOPE, "event_time", "market_available_at", "archive_available_at", "market_calendar_date", "canonical_bar_key", "canonical_row_version_id", *values)
    lengths = w.select(*SCOPE, "_width").distinct()  # a few for each scope
    b = b.join(lengths, SCOPE).withColumn("_at", _stretch(F.col("event_time"), F.col("_width")))
    pairs = w.join(b, [*SCOPE, "_width", "_at"]).filter((F.col("event_time") >= F.col("_from")) & (F.col("event_time") < F.col("_to")))
    late = F.col("market_available_at") > F.col("_to")
    unseen = F.lit(False) if as_of is None else ~F.coalesce(F.col("archive_available_at") <= F.lit(as_of).cast("timestamp"), F.lit(False))
    status = F.when(late, "NOT_MARKET_AVAILABLE").when(unseen, "NOT_ARCHIVED").otherwise("SELECTED")
    return pairs.withColumns({"status": status, "window_from": F.col("_from"), "window_to": F.col("_to")}).drop("_width", "_at", "_from", "_to")


def association(found: DataFrame) -> DataFrame:
    """sample_key, role, position (from 0 by time), bar key and version, times of the selected candidates."""
    w = Window.partitionBy("sample_key", "role").orderBy("event_time", "market_available_at", "canonical_bar_key", "canonical_row_version_id")
    rows = found.filter("status = 'SELECTED'").withColumn("position", (F.row_number().over(w) - 1).cast("long"))
    return rows.select("sample_key", "role", "position", "canonical_bar_key", "canonical_row_version_id", "code", "event_time", "market_available_at", "archive_available_at", "market_calendar_date", "anchor_market_calendar_date", "feature_window_close", *(c for c in ("window_from", "window_to", *VALUES) if c in found.columns))


def row_rules() -> dict:
    """What each row of an association must keep, as conditions under which it does not: it lies in its window, was known to the market when the window closed, and a label lies on the anchor's date."""
    known = F.coalesce(F.col("market_available_at") <= F.col("window_to"), F.col("market_available_at").isNull())
    inside = (F.col("event_time") >= F.col("window_from")) & (F.col("event_time") < F.col("window_to"))
    return {
        "a row breaks its sample's contract": ~F.coalesce(inside & known, F.lit(False)),
        "a label crosses the anchor's market date": (F.col("role") == "LABEL") & ~F.col("market_calendar_date").eqNullSafe(F.col("anchor_market_calendar_date")),
    }


def sample_versions(assoc: DataFrame) -> DataFrame:
    """sample_key and sample_version_id: the versions used, by role and position."""
    used = F.array_sort(F.collect_list(F.struct("role", "position", "canonical_row_version_id")))  # one window's bars
    return assoc.groupBy("sample_key").agg(ids.digest(F.col("sample_key"), F.to_json(used)).alias("sample_version_id"))


def require_same_day_labels(assoc: DataFrame) -> None:
    require_empty(assoc.filter((F.col("role") == "LABEL") & (F.col("market_calendar_date") != F.col("anchor_market_calendar_date"))), "a label crosses the anchor's market date")


def diagnostics(found: DataFrame, reqs: DataFrame) -> DataFrame:
    """Per role: samples, candidates, selected and the two exclusive kinds of exclusion."""
    n = lambda s: F.count_if(F.col("status") == s)
    own = found.groupBy("role").agg(F.count_distinct("sample_key").alias("n_samples"), F.count("*").alias("n_candidates"), n("SELECTED").alias("n_selected"), n("NOT_MARKET_AVAILABLE").alias("n_not_market_available"), n("NOT_ARCHIVED").alias("n_not_archived"))
    return _windows(reqs).groupBy("role").agg(F.count("*").alias("n_windows")).join(own, "role", "left").na.fill(0)


def gap_facts(gaps: DataFrame) -> DataFrame:
    """gap_id with its dimensions and the moments it is known: to the market when the next bar is, to the archive when both bars are. Facts of one gap that differ raise."""
    facts = gaps.select(
        "gap_id", "code", "interval", "adjustment", "session", "missing_from_event_time", "missing_to_event_time",
        F.col("next_market_available_at").alias("market_known_at"), F.greatest("previous_archive_available_at", "next_archive_available_at").alias("archive_known_at"),
    ).distinct()
    require_empty(facts.groupBy("gap_id").count().filter("count > 1"), "builds differ in facts of one gap")
    return facts


def known_gaps(facts: DataFrame, reqs: DataFrame, as_of=None) -> DataFrame:
    """sample_key, role, gap_ids (sorted) of the gaps that overlap a window and were known by its close to the market, and by as_of to the archive; ALL takes every session.

    Gaps meet windows as bars do in candidates(); a gap is dealt to every stretch it touches, about as many as its missing bars at most.
    """
    scope = ["code", "interval", "adjustment"]
    w = _dealt(_windows(reqs))
    g = facts.join(w.select(*scope, "_width").distinct(), scope)  # a few lengths for each scope
    g = g.withColumn("_at", F.explode(F.sequence(_stretch(F.col("missing_from_event_time"), F.col("_width")), _stretch(F.col("missing_to_event_time"), F.col("_width")))))
    pairs = w.join(g, [*scope, "_width", "_at"]).filter((F.col("requested_session") == "ALL") | (F.col("requested_session") == F.col("session")))
    pairs = pairs.filter((F.col("missing_from_event_time") < F.col("_to")) & (F.col("missing_to_event_time") >= F.col("_from")))
    pairs = pairs.filter(F.col("market_known_at") <= F.col("_to"))
    if as_of is not None:
        pairs = pairs.filter(F.col("archive_known_at") <= F.lit(as_of).cast("timestamp"))
    return pairs.groupBy("sample_key", "role").agg(F.array_sort(F.collect_set("gap_id")).alias("gap_ids"))


#: What names the snapshot that a bar came from.
SOURCE = ["ingestion_run_id", "physical_snapshot_hash", "source_schema_version", "requested_trade_date", "requested_session"]


def version_pins(assoc: DataFrame, merged: DataFrame) -> DataFrame:
    """build_id, canonical_row_version_id and the version's source: a row for each used version and each build that holds it. merged comes from samples.reconciled()."""
    used = assoc.select("canonical_row_version_id").distinct()
    own = merged.select("canonical_row_version_id", *(c for c in SOURCE if c in merged.columns), F.explode("build_ids").alias("build_id"))
    return own.join(used, "canonical_row_version_id", "left_semi").select("build_id", "canonical_row_version_id", *own.columns[1:-1])


def build_pins(pins: DataFrame, build_ids: DataFrame) -> DataFrame:
    """A row for each considered build (build_ids) and each source of it that was used, with the number of its versions and an id of them; a build of which nothing was used has one row without a source."""
    source = [c for c in SOURCE if c in pins.columns]
    found = ids.content_ids(pins, ["build_id", *source], ["canonical_row_version_id"])
    every = build_ids.select("build_id").distinct().join(found, "build_id", "left")
    return every.select("build_id", *source, F.coalesce("n_rows", F.lit(0)).alias("n_row_versions"), F.col("content_id").alias("versions_id"))


def gap_references(gaps: DataFrame, build_ids: DataFrame) -> DataFrame:
    """One row for each considered build: gap_range_count and gap_content_id of its gaps (with build_id); no gaps have an id of their own, which is null."""
    found = ids.content_ids(gaps, ["build_id"], ["gap_id", "missing_bar_count"])
    every = build_ids.select("build_id").distinct().join(found, "build_id", "left")
    return every.select("build_id", F.coalesce("n_rows", F.lit(0)).alias("gap_range_count"), F.col("content_id").alias("gap_content_id"))


def require_pins(assoc: DataFrame, pins: DataFrame, merged: DataFrame | None = None) -> None:
    """Stored pins are exactly the versions used, checked both ways in one aggregation; with merged (from samples.reconciled()) for each build, with their sources."""
    if merged is None:
        used, stored = (x.select("canonical_row_version_id").distinct() for x in (assoc, pins))
    else:
        used = version_pins(assoc, merged)
        stored = pins.select(*used.columns).distinct()
    sides = used.withColumn("_side", F.lit(1)).unionByName(stored.withColumn("_side", F.lit(-1)))
    require_empty(sides.groupBy(*used.columns).agg(F.sum("_side").alias("n")).filter("n <> 0"), "pins are not the versions used")
