"""The dataset job: from captures of bars, or from canonical builds, to a split dataset, stopped by the first rule that does not hold."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions import identity
from tapeloom.guards import Stages, require_empty
from tapeloom.operators import canonical, coverage, dataset, features, labels, pit, samples, splits
from tapeloom.sources import tables


@dataclass(frozen=True)
class BuildSpec:
    """All parameters of a dataset."""

    seconds: int
    feature_bars: int
    label_bars: int
    split: splits.SplitSpec
    stride: int = 1
    features: tuple[features.FeatureSpec, ...] = ()
    labels: tuple[labels.LabelSpec, ...] = ()
    as_of: str | None = None


@dataclass
class Build:
    """The tables of a dataset job; lazy, or stored where build() was given stages."""

    requests: DataFrame
    candidates: DataFrame
    association: DataFrame
    features: DataFrame
    labels: DataFrame
    assigned: DataFrame
    rows: DataFrame


def build(bars: DataFrame, spec: BuildSpec, stages: Stages | None = None) -> Build:
    """bars are canonical rows (operators.canonical.canonical_bars). With stages every table is computed once and stored, and an association that breaks a rule stops the job as it is written."""
    keep = (lambda df, *more: df) if stages is None else stages.stored
    reqs = keep(samples.requests(bars, seconds=spec.seconds, feature_bars=spec.feature_bars, label_bars=spec.label_bars, stride=spec.stride), "requests")
    found = pit.candidates(bars, reqs, spec.as_of)
    assoc = keep(pit.association(found), "association", pit.row_rules(), ["sample_key", "role", "event_time"])
    f = keep(features.sliding(bars, reqs, assoc, list(spec.features), spec.seconds, spec.as_of, None if stages is None else stages.stored), "features")
    y = keep(labels.execute(features.gathered(labels.needed(assoc, spec.seconds), reqs), list(spec.labels), spec.seconds), "labels")
    assigned = keep(splits.assigned(dataset.split_samples(reqs, features.sample_status(f), labels.sample_status(y)), spec.split), "assigned")
    kinds = {s.name: labels.KINDS[s.transform] for s in spec.labels if s.transform in labels.KINDS}
    rows = keep(dataset.rows(assigned, f, y, [s.name for s in spec.features], [s.name for s in spec.labels], kinds), "rows")
    return Build(reqs, found, assoc, f, y, assigned, rows)


def require_sound(b: Build, bars: DataFrame, symbols: DataFrame, dates: DataFrame) -> None:
    """All rules of a build that was not made in stages: one bar for each event, requests unique and inside the scope, every row in its sample's window and known at its close, labels on the anchor's date, each sample once and none lost."""
    samples.require_unique(bars)
    for message, broken in pit.row_rules().items():
        require_empty(b.association.filter(broken).select("sample_key", "role", "event_time"), message)
    features.require_row_contract(b.association, b.requests)
    labels.require_row_contract(b.association, b.requests)
    found = dataset.ledger(b.requests, symbols, dates, b.association, b.features, b.labels, b.assigned)
    n = b.features.select("name").distinct().count(), b.labels.select("name").distinct().count()
    for message, broken in dataset.ledger_rules(*n).items():
        require_empty(found.filter(broken), message)


@dataclass
class Dataset:
    """What a job leaves: the stored dataset, its completion over the scope, one row of balances, what it was made from, and the stages that were written."""

    dataset_id: str
    path: str
    completion: DataFrame
    diagnostics: DataFrame
    association_id: str
    build_pins: DataFrame
    version_pins: DataFrame
    gap_references: DataFrame
    known_gaps: DataFrame
    stages: tuple[str, ...]


@dataclass(frozen=True)
class Canonical:
    """A stored canonical build."""

    build_id: str
    path: str


def canonical_build(captures: DataFrame, runs: DataFrame, quality: DataFrame, key: coverage.RequestKey, seconds: int, root: str, hashes: DataFrame | None = None, files: str | None = None) -> Canonical:
    """The newest complete snapshot of each item, reconciled and stored as one canonical build under root.

    The ranking is computed and written once; while that is done, rows that break the contract of a canonical input and events whose captures
    differ are counted, and the first of either stops the job. Bars, gaps and resolution come from the stored ranking.
    Where files names the folder of the captures' snapshots, their bytes are hashed before they are read and once more
    after the ranking is stored: a file that changed meanwhile, or has no hash, stops the job.
    """
    stages = Stages(f"{root}/work/{uuid.uuid4().hex}")
    if files is not None:
        hashes = stages.stored(tables.file_hashes(captures.sparkSession, files), "files")
    chosen = coverage.latest_complete_snapshots(captures, runs, quality, key)
    inputs = canonical.snapshot_inputs(captures, chosen, hashes)
    ranked = canonical.candidates(inputs.withColumn("_broken", canonical.broken_rule(inputs, key.interval, key.adjustment)))
    same = Window.partitionBy("canonical_bar_key")  # the window of the rank
    content = canonical.values_digest(ranked)
    ranked = ranked.withColumn("_d", content).withColumn("_differs", F.min("_d").over(same) != F.max("_d").over(same)).drop("_d")
    rules = {"a row breaks the contract of canonical bars": F.col("_broken").isNotNull(), "captures of one bar differ": F.col("_differs")}
    if hashes is not None:
        rules["the file of a row was not hashed"] = F.col("physical_snapshot_hash").isNull()
    ranked = stages.stored(ranked, "ranked", rules, ["code", "requested_trade_date", "time_utc", "snapshot_file", "_broken"]).drop("_broken", "_differs")
    if files is not None:
        canonical.require_unchanged(hashes, tables.file_hashes(captures.sparkSession, files))
    bars = canonical.canonical_bars(ranked)
    return Canonical(*canonical.materialize(captures.sparkSession, bars, canonical.gap_ranges(bars, seconds), f"{root}/canonical", ranked))


def run_builds(spark: SparkSession, builds: list[Canonical], key: coverage.RequestKey, spec: BuildSpec, symbols: DataFrame, dates: DataFrame, root: str) -> Dataset:
    """The job from canonical builds on: verified reads, one row for each event over all builds, samples, features, labels, splits, one stored dataset.

    Each stage is computed once, under a folder of this run, and its rules are counted while it is written: builds that
    differ in a bar, rows outside of their windows, samples that are lost, doubled or were never requested. The first
    broken rule stops the job before a dataset is written. Pins of the versions used and of their sources, gap references of
    all builds and the association's id are stored beside the dataset and named in its manifest.
    """
    stages = Stages(f"{root}/work/{uuid.uuid4().hex}")
    every, gaps = [], []
    for b in sorted(set(builds), key=lambda x: x.build_id):
        read = canonical.verified_build(spark, b.path, None, b.build_id, spec.seconds)
        own = F.lit(b.build_id).alias("build_id")
        every.append(read.select(own, "*"))
        found = canonical.gap_ranges(read, spec.seconds)
        gaps.append(canonical.gap_boundaries(read, found).select(own, "*"))
    both = lambda a, b: a.unionByName(b, allowMissingColumns=True)
    merged = stages.stored(samples.reconciled(reduce(both, every)), "bars", {"builds differ in one bar": F.col("n_contents") > 1}, ["canonical_bar_key", "code", "event_time", "build_ids"]).drop("n_contents")
    bounded = stages.stored(reduce(both, gaps), "gaps")
    bars = samples.in_scope(merged, interval=key.interval, adjustment=key.adjustment, session=key.session, symbols=symbols, dates=dates)
    bars = stages.stored(bars, "scope")
    b = build(bars, spec, stages)
    stages.stored(dataset.ledger(b.requests, symbols, dates, b.association, b.features, b.labels, b.assigned), "samples", dataset.ledger_rules(len(spec.features), len(spec.labels)))
    balances = dataset.diagnostics(b.assigned, b.requests)
    uneven = (F.col("n_rows") != F.col("n_assigned") + F.col("n_purged") + F.col("n_excluded")) | (F.col("n_assigned") != F.col("n_train") + F.col("n_validation") + F.col("n_test"))
    require_empty(balances.filter(uneven), "the balances of the dataset do not add up")
    ids = spark.createDataFrame([(x.build_id,) for x in set(builds)], "build_id string")
    versions = stages.stored(pit.version_pins(b.association, merged), "version_pins")
    pins = stages.stored(pit.build_pins(versions, ids), "build_pins")
    references = stages.stored(pit.gap_references(bounded, ids), "gap_references")
    known = stages.stored(pit.known_gaps(pit.gap_facts(bounded), b.requests, spec.as_of), "known_gaps")
    used = identity.content_id(b.association.select("sample_key", "role", "position", "canonical_row_version_id")).first()[0]
    facts = {"association_id": used, "pins_id": identity.content_id(pins).first()[0], "gap_references_id": identity.content_id(references).first()[0]}
    own, path = dataset.materialize(b.rows, f"{root}/datasets", facts)
    done = dataset.completion(symbols, dates, b.requests, features.sample_status(b.features), labels.sample_status(b.labels))
    return Dataset(own, path, done, balances, used, pins, versions, references, known, tuple(stages.names))


def run(captures: DataFrame, runs: DataFrame, quality: DataFrame, key: coverage.RequestKey, spec: BuildSpec, symbols: DataFrame, dates: DataFrame, root: str, hashes: DataFrame | None = None, builds: tuple[Canonical, ...] = (), files: str | None = None) -> Dataset:
    """The whole job under root: a canonical build of the newest complete snapshots (canonical_build), joined with stored builds where some are given, and a dataset of them all (run_builds).

    captures are curated bars with snapshot_file; symbols (code) and dates (trade_date) are the scope.
    """
    own = canonical_build(captures, runs, quality, key, spec.seconds, root, hashes, files)
    return run_builds(captures.sparkSession, [own, *builds], key, spec, symbols, dates, root)
