"""One canonical row for each market event from overlapping captures, with conflicts, discarded sources and gaps."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapeloom import schemas
from tapeloom.functions import identity as ids
from tapeloom.functions import market_time as mt
from tapeloom.functions.codes import finite
from tapeloom.guards import require_empty

GROUP = ["code", "interval", "adjustment", "market_calendar_date", "session"]
SOURCE = ["ingestion_run_id", "snapshot_file"]
#: A part of a stored build: one folder of its bars, whose nodes are stored beside it.
PART = ["interval", "adjustment", "code", "market_calendar_date"]


def _plain(c: str, kind: str):
    """A value as conflicts see it: -0.0 is 0.0."""
    return F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)) if kind == "double" else F.col(c)


def snapshot_inputs(bars: DataFrame, chosen: DataFrame, hashes: DataFrame | None = None) -> DataFrame:
    """Rows of the chosen snapshots with the run's end and, where hashes (path, sha256) are given, the file's hash; null where a file has none."""
    keys = ["code", "requested_trade_date", *SOURCE]
    rows = bars.join(chosen.select(*keys, "run_finished_at"), keys)
    return rows if hashes is None else rows.drop("physical_snapshot_hash").join(hashes.select(F.col("path").alias("snapshot_file"), F.col("sha256").alias("physical_snapshot_hash")), "snapshot_file", "left")


def require_unchanged(before: DataFrame, after: DataFrame) -> None:
    """Two hashings (path, sha256) of the same files: raises with files that changed, came or went between them."""
    both = before.select("path", "sha256", F.lit(1).alias("side")).unionByName(after.select("path", "sha256", F.lit(2).alias("side")))
    met = both.groupBy("path").agg(F.count_distinct("sha256").alias("n_contents"), F.count_distinct("side").alias("n_sides"))
    require_empty(met.filter("n_contents <> 1 or n_sides <> 2"), "a file changed while it was read")


def broken_rule(rows: DataFrame, interval: str, adjustment: str) -> Column:
    """The first rule of the contract of a canonical input that a row breaks, or null."""
    bad_number = ~(finite(F.col("open")) & finite(F.col("high")) & finite(F.col("low")) & finite(F.col("close")) & finite(F.col("volume")))
    optional = F.lit(False)
    for c in schemas.BAR_VALUES[5:]:
        if c in rows.columns:
            optional = optional | (F.col(c).isNotNull() & ~finite(F.col(c)))
    return (
        F.when(F.coalesce(F.trim("code"), F.lit("")) == "", "code")
        .when(~F.col("interval").eqNullSafe(F.lit(interval)), "interval")
        .when(~F.col("adjustment").eqNullSafe(F.lit(adjustment)), "adjustment")
        .when(F.col("time_utc").isNull(), "time_utc")
        .when(~F.col("time_market").eqNullSafe(F.col("time_utc")), "time_market")
        .when(~F.col("market_calendar_date").eqNullSafe(mt.market_date(F.col("time_utc"))), "market_calendar_date")
        .when(~F.col("session").eqNullSafe(mt.session_label(F.col("time_utc"))), "session")
        .when(bad_number, "number")
        .when(optional, "optional number")
    )


def violations(rows: DataFrame, interval: str, adjustment: str) -> DataFrame:
    """Rows that break the contract of a canonical input, each with its first broken rule."""
    return rows.withColumn("violation", broken_rule(rows, interval, adjustment)).filter("violation is not null")


def values_digest(rows: DataFrame) -> Column:
    """Digest of the values in which captures of one bar must agree."""
    return ids.row_digest(rows, [c for c in (*schemas.BAR_VALUES, *schemas.BAR_CLASS) if c in rows.columns])


def candidates(rows: DataFrame) -> DataFrame:
    """rows with canonical_bar_key, canonical_row_version_id and rank (1: the source that wins).

    Newest ingestion wins, then the latest end of the run, the greater run id, the greater hash of the snapshot. That hash is
    physical_snapshot_hash (of the bytes) where rows have it, else the logical hash of the snapshot's rows: where a
    snapshot lies says nothing of what it is, so its path is provenance only.
    """
    if "physical_snapshot_hash" not in rows.columns:
        keys = ["code", "requested_trade_date", *SOURCE]
        rows = rows.join(snapshot_hashes(rows).withColumnRenamed("logical_source_rows_hash", "physical_snapshot_hash"), keys)
    key = ids.bar_key(F.col("code"), F.col("interval"), F.col("adjustment"), F.col("time_utc"))
    rows = rows.withColumn("canonical_bar_key", key)
    version = ids.bar_version(F.col("canonical_bar_key"), F.col("ingestion_run_id"), F.col("physical_snapshot_hash"), F.col("source_schema_version"))
    finished = [F.desc_nulls_last("run_finished_at")] if "run_finished_at" in rows.columns else []
    w = Window.partitionBy("canonical_bar_key").orderBy(F.desc_nulls_last("ingested_at"), *finished, F.desc("ingestion_run_id"), F.desc("physical_snapshot_hash"))
    return rows.withColumn("canonical_row_version_id", version).withColumn("rank", F.row_number().over(w))


def conflicts(ranked: DataFrame) -> DataFrame:
    """canonical_bar_key, code, event_time, n_sources, fields: events whose captures differ, with the sorted names of the differing fields."""
    kinds = dict(ranked.dtypes)
    fields = [c for c in (*schemas.BAR_VALUES, *schemas.BAR_CLASS) if c in kinds]
    # Distinct values with null as one of them; one pass over each key.
    counts = [F.size(F.collect_set(F.struct(_plain(c, kinds[c])))).alias(c) for c in fields]
    found = ranked.groupBy("canonical_bar_key").agg(F.first("code").alias("code"), F.first("time_utc").alias("event_time"), F.count("*").alias("n_sources"), *counts)
    names = F.array_sort(F.filter(F.array(*(F.when(F.col(c) > 1, F.lit(c)) for c in fields)), lambda x: x.isNotNull()))
    return found.select("canonical_bar_key", "code", "event_time", "n_sources", names.alias("fields")).filter(F.size("fields") > 0)


def canonical_bars(ranked: DataFrame) -> DataFrame:
    """The winning row of each event; call require_no_conflicts() first where captures must agree."""
    available = mt.available_at(F.col("time_utc"), mt.interval_seconds(F.col("interval")))
    archived = F.col("run_finished_at") if "run_finished_at" in ranked.columns else F.col("ingested_at")
    won = ranked.filter("rank = 1").withColumn("market_available_at", available).withColumn("archive_available_at", archived)
    return won.withColumnRenamed("time_utc", "event_time").drop("rank", "time_market")


def require_no_conflicts(ranked: DataFrame) -> None:
    require_empty(conflicts(ranked), "captures of one bar differ")


def resolution(ranked: DataFrame) -> DataFrame:
    """canonical_bar_key, selected source and the discarded ones in the order of rank."""
    source = F.struct("rank", *SOURCE)
    grouped = ranked.groupBy("canonical_bar_key").agg(F.array_sort(F.collect_list(source)).alias("s"))  # one entry for each capture of a bar
    return grouped.select("canonical_bar_key", F.element_at("s", 1).alias("selected"), F.slice("s", 2, F.greatest(F.size("s"), F.lit(1))).alias("discarded"))


def source_count(ranked: DataFrame) -> DataFrame:
    """Number of distinct physical sources; one row."""
    return ranked.agg(F.count_distinct("code", "requested_trade_date", *SOURCE).alias("n_sources"))


def provenance(ranked: DataFrame) -> DataFrame:
    """Each source with its rows that were selected and discarded."""
    return ranked.groupBy("code", "requested_trade_date", *SOURCE).agg(F.count_if(F.col("rank") == 1).alias("n_selected"), F.count_if(F.col("rank") > 1).alias("n_discarded"))


def snapshot_hashes(rows: DataFrame) -> DataFrame:
    """Order-independent logical hash of each snapshot's rows, by a two-level tree of digests."""
    keys = ["code", "requested_trade_date", *SOURCE]
    values = [c for c in ("time_utc", *schemas.BAR_VALUES, *schemas.BAR_CLASS) if c in rows.columns]
    d = rows.select(*keys, ids.row_digest(rows, values).alias("d")).withColumn("p", F.substring("d", 1, 2))
    nodes = d.groupBy(*keys, "p").agg(F.sha2(F.concat_ws("", F.array_sort(F.collect_list("d"))), 256).alias("n"))
    return nodes.groupBy(*keys).agg(F.sha2(F.concat_ws("", F.array_sort(F.collect_list(F.concat("p", "n")))), 256).alias("logical_source_rows_hash"))


def gap_ranges(bars: DataFrame, seconds: int, check: bool = True) -> DataFrame:
    """Gaps between neighbours of one group over one interval apart; a distance off the grid raises when `check`."""
    w = Window.partitionBy(*GROUP).orderBy("event_time")
    rows = bars.withColumn("previous_event_time", F.lag("event_time").over(w)).withColumn("_d", F.unix_seconds("event_time") - F.unix_seconds("previous_event_time")).filter(F.col("_d") > seconds)
    if check:
        require_empty(rows.filter(F.col("_d") % seconds != 0).select(*GROUP, "event_time"), "distance of bars is off the interval's grid")
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))
    own = ids.gap_id(*(F.col(c) for c in GROUP), F.col("previous_event_time"), F.col("event_time"))
    return rows.select(
        own.alias("gap_id"), *GROUP, "previous_event_time", F.col("event_time").alias("next_event_time"), (F.col("previous_event_time") + step).alias("missing_from_event_time"),
        (F.col("event_time") - step).alias("missing_to_event_time"), (F.floor(F.col("_d") / seconds) - 1).cast("long").alias("missing_bar_count"),
    )


def gap_boundaries(bars: DataFrame, gaps: DataFrame) -> DataFrame:
    """Each gap with the row versions and availabilities of both its neighbours; a gap without one is left out, so counts must match."""
    b = bars.select(*GROUP, "event_time", "canonical_row_version_id", "market_available_at", "archive_available_at")
    side = lambda n: b.select(*GROUP, *(F.col(c).alias(f"{n}_{c}") for c in ("event_time", "canonical_row_version_id", "market_available_at", "archive_available_at")))
    return gaps.join(side("previous"), [*GROUP, "previous_event_time"]).join(side("next"), [*GROUP, "next_event_time"])


def materialize(spark: SparkSession, bars: DataFrame, gaps: DataFrame, root: str, ranked: DataFrame | None = None) -> tuple[str, str]:
    """Write bars, gaps and (from ranked candidates) the resolution under the id of their content; returns (id, path).

    The nodes of the bars' parts (PART) are stored beside them. The manifest, one row with the content ids and row counts of
    all tables, is written last: a build without it is unfinished and written again, a finished one is verified and used again.
    """
    from tapeloom.sources import tables

    gap_columns = [c for c in gaps.columns if c != "gap_id"]
    nodes = ids.nodes(bars, PART)
    parts = {"bars": ids.content_id(bars).first()[0], "gaps": ids.content_id(gaps, ["gap_id", *gap_columns]).first()[0], "nodes": ids.content_id(nodes).first()[0]}
    chosen = resolution(ranked) if ranked is not None else None
    if chosen is not None:
        parts["resolution"] = ids.content_id(chosen).first()[0]
    build = ids.text_digest(*(f"{k}={v}" for k, v in sorted(parts.items())))
    path = f"{root}/build_id={build}"
    if tables.read_manifest(spark, path) is not None:
        verified_build(spark, path, bars.schema, build)
        return build, path
    tables.write_canonical(bars, f"{path}/bars", mode="overwrite")
    tables.write_gaps(gaps, f"{path}/gaps", mode="overwrite")
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    if chosen is not None:
        tables.write_resolution(chosen, f"{path}/resolution", mode="overwrite")
    tables.write_manifest(spark, path, {f"{k}_id": v for k, v in parts.items()} | {"build_id": build, "bars_schema": bars.schema.json(), "n_bars": str(bars.count()), "n_gaps": str(gaps.count())})
    return build, path


def _manifest(spark: SparkSession, path: str, build: str) -> dict[str, str]:
    """The facts of a finished build; raises unless its ids make up the given one."""
    from tapeloom.sources import tables

    facts = tables.read_manifest(spark, path)
    if facts is None:
        raise ValueError(f"{path} has no manifest: the build was not finished")
    if build != facts["build_id"] or build != ids.text_digest(*(f"{k[:-3]}={v}" for k, v in sorted(facts.items()) if k.endswith("_id") and k != "build_id")):
        raise ValueError(f"{path} is not the build {build}")
    return facts


def _stored_nodes(spark: SparkSession, path: str, facts: dict[str, str]) -> DataFrame:
    """The nodes of a build; raises unless they are those of its manifest."""
    bars = StructType.fromJson(json.loads(facts["bars_schema"]))
    schema = StructType([bars[c] for c in PART]).add("prefix", "string").add("n_rows", "long").add("node", "string")
    nodes = spark.read.schema(schema).parquet(f"{path}/nodes")
    if ids.content_id(nodes).first()[0] != facts["nodes_id"]:
        raise ValueError(f"nodes of {path} are not those of its manifest")
    return nodes


def altered_parts(spark: SparkSession, path: str, build: str) -> DataFrame:
    """PART, prefix, n_stored, n_found: where the bars of a finished build are no longer those that were written, and how many rows lie there."""
    facts = _manifest(spark, path, build)
    schema = StructType.fromJson(json.loads(facts["bars_schema"]))
    bars = spark.read.schema(schema).parquet(f"{path}/bars").select(*schema.names)
    return ids.altered(_stored_nodes(spark, path, facts), ids.nodes(bars, PART), PART)


def verified_parts(spark: SparkSession, path: str, build: str, some: Column) -> DataFrame:
    """The bars of a build in the parts that meet `some`, a condition on columns of PART. Only their folders are read, and only their nodes compared; raises where they differ."""
    facts = _manifest(spark, path, build)
    schema = StructType.fromJson(json.loads(facts["bars_schema"]))
    bars = spark.read.schema(schema).parquet(f"{path}/bars").select(*schema.names).filter(some)
    require_empty(ids.altered(_stored_nodes(spark, path, facts).filter(some), ids.nodes(bars, PART), PART), f"bars of {path} are not those that were written")
    return bars


def verified_build(spark: SparkSession, path: str, schema, build: str, seconds: int | None = None, builder: str = "1") -> DataFrame:
    """Bars of a build, with the given schema or the one of its manifest; raises unless the manifest, the bars' content id (with the parts that differ) and count, their keys and versions, and (with seconds) the gaps, content and spans, are those derived again."""
    facts = _manifest(spark, path, build)
    schema = schema or StructType.fromJson(json.loads(facts["bars_schema"]))
    bars = spark.read.schema(schema).parquet(f"{path}/bars").select(*schema.names)
    found = ids.content_id(bars).first()[0]
    if found != facts["bars_id"] or bars.count() != int(facts["n_bars"]):
        require_empty(altered_parts(spark, path, build), f"content id {found} of {path} is not that of its manifest; parts that differ")
        raise ValueError(f"content id {found} of {path} is not that of its manifest")
    key = ids.bar_key(F.col("code"), F.col("interval"), F.col("adjustment"), F.col("event_time"))
    require_empty(bars.filter(~F.col("canonical_bar_key").eqNullSafe(key)), "stored key is not the recomputed one")
    require_empty(bars.groupBy("canonical_bar_key").count().filter("count > 1"), "a key has two rows")
    if {"ingestion_run_id", "physical_snapshot_hash", "source_schema_version"} <= set(bars.columns):
        version = ids.bar_version(F.col("canonical_bar_key"), F.col("ingestion_run_id"), F.col("physical_snapshot_hash"), F.col("source_schema_version"), builder)
        require_empty(bars.filter(~F.col("canonical_row_version_id").eqNullSafe(version)), "stored version is not the recomputed one")
    if seconds is not None:
        own = gap_ranges(bars, seconds)
        stored = spark.read.schema(own.schema).parquet(f"{path}/gaps").select(*own.columns)
        if "gap_id" not in schema.names and ids.content_id(stored).first()[0] != ids.content_id(own).first()[0]:
            raise ValueError(f"stored gaps of {path} are not the recomputed ones")
    return bars
