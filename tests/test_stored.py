"""Stored tables: nodes that say what changed, files of any size, catalogs with postings."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import identity
from tapeloom.guards import GuardError
from tapeloom.operators import canonical, catalog, dataset
from tapeloom.plans.build import build, canonical_build
from tapeloom.sources import tables
from tests.test_jobs import KEY, SPEC, captures, checks, runs, values


def two_codes(spark):
    both = captures(spark).unionByName(captures(spark, code="B", file="f2"))
    return canonical.canonical_bars(canonical.candidates(both))


def test_nodes_make_up_the_content_id(spark):
    df = spark.range(3000).select((F.col("id") % 700).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    nodes = identity.nodes(df, [])
    top = hashlib.sha256("".join(r.prefix + r.node for r in sorted(nodes.collect())).encode()).hexdigest()
    assert top == identity.content_id(df).first()[0] and nodes.agg(F.sum("n_rows")).first()[0] == 3000
    by = identity.nodes(df, ["g"], ["v"])
    ids = {r.g: (r.n_rows, r.content_id) for r in identity.content_ids(df, ["g"], ["v"]).collect()}
    assert ids == {g: (1000, identity.content_id(df.filter(F.col("g").eqNullSafe(F.lit(g))).select("v")).first()[0]) for g in (None, 1, 2)}
    assert identity.altered(by, by, ["g"]).count() == 0
    # A repeated row, a lost one and a group that is new; null is a group like others.
    assert [tuple(r)[0:1] + tuple(r)[2:] for r in identity.altered(by, identity.nodes(df.unionByName(spark.sql("SELECT 7L v, CAST(NULL AS LONG) g")), ["g"], ["v"]), ["g"]).collect()] == [(None, 1, 2)]  # 1407 alone
    gone = identity.altered(by, identity.nodes(df.filter("g is not null"), ["g"], ["v"]), ["g"])
    assert gone.agg(F.sum("n_stored"), F.sum("n_found"), F.count_distinct("g"), F.count("g")).first()[0:4] == (1000, 0, 0, 0)
    assert identity.nodes(df.limit(0), ["g"]).count() == 0


def test_an_altered_part_is_named(spark, tmp_path):
    bars = two_codes(spark).cache()
    own, path = canonical.materialize(spark, bars, canonical.gap_ranges(bars, 60), str(tmp_path))
    assert canonical.altered_parts(spark, path, own).count() == 0
    a, b = (canonical.verified_parts(spark, path, own, F.col("code") == c) for c in "AB")
    assert a.count() == b.count() == 10 and "code#" in a._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    tables.write_canonical(bars.withColumn("close", F.when((F.col("code") == "B") & (F.minute("event_time") == 33), 1.0).otherwise(F.col("close"))), f"{path}/bars", mode="overwrite")
    found = canonical.altered_parts(spark, path, own).groupBy("code", "market_calendar_date").agg(F.sum("n_stored"), F.sum("n_found")).collect()
    assert [(r[0], str(r[1]), r[2] > 0, r[2] == r[3]) for r in found] == [("B", "2026-07-01", True, True)]
    assert canonical.verified_parts(spark, path, own, F.col("code") == "A").count() == 10  # untouched parts verify alone
    with pytest.raises(GuardError, match="'code': 'B'"):
        canonical.verified_parts(spark, path, own, F.col("code") == "B")
    with pytest.raises(GuardError, match="content id.*'code': 'B'"):
        canonical.verified_build(spark, path, bars.schema, own)
    with pytest.raises(ValueError, match="not the build"):
        canonical.altered_parts(spark, path, "0" * 64)
    nodes = spark.createDataFrame(spark.read.parquet(f"{path}/nodes").collect()).withColumn("node", F.lit("x"))
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    with pytest.raises(ValueError, match="nodes"):
        canonical.altered_parts(spark, path, own)


def test_files_of_any_size_are_hashed(spark, tmp_path):
    folder = tmp_path / "a b%20ü"
    folder.mkdir()
    texts = {"none": b"", "short": b"x" * 10, "edge": b"y" * 100, "over": b"z" * 101, "two blocks": bytes(range(256)) * 40_000}
    for name, text in texts.items():
        (folder / name).write_bytes(text)
    for row_bytes in (100, 1 << 30):
        got = {r.path.rsplit("/", 1)[1].replace("%20", " "): (r.size, r.sha256) for r in tables.file_hashes(spark, str(tmp_path), row_bytes).collect()}
        assert got == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in texts.items() if v}
    large = tmp_path / "large"
    with open(large, "wb") as f:
        f.truncate((2 << 30) + 5)  # over what one row can hold; sparse
    whole = hashlib.sha256()
    for _ in range(1 << 8):
        whole.update(bytes(8 << 20))
    whole.update(bytes(5))
    assert [tuple(r)[1:] for r in tables.file_hashes(spark, str(large)).collect()] == [((2 << 30) + 5, whole.hexdigest())]


def test_a_file_that_changes_stops_the_build(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bars")
    tables.write_bars(captures(spark).drop("snapshot_file").coalesce(1), root)
    read = tables.read_bars_with_file(spark, root)
    run = runs(spark, ("r1", "2026-07-01", "SUCCESS"))
    built = canonical_build(read, run, checks(spark), KEY, 60, str(tmp_path / "one"), files=root)
    stored = canonical.verified_build(spark, built.path, None, built.build_id)
    hashes = {r.path: r.sha256 for r in tables.file_hashes(spark, root).collect()}
    assert stored.count() == 10 and {(r.snapshot_file, r.physical_snapshot_hash) for r in stored.collect()} == set(hashes.items())
    own, calls = tables.file_hashes, []

    def later(spark, path):
        calls.append(path)
        if len(calls) == 2:
            spark.createDataFrame(read.drop("snapshot_file").collect(), read.drop("snapshot_file").schema).limit(3).write.mode("append").partitionBy("interval", "requested_trade_date").parquet(path)
        return own(spark, path)

    monkeypatch.setattr(tables, "file_hashes", later)
    with pytest.raises(GuardError, match="changed while"):
        canonical_build(read, run, checks(spark), KEY, 60, str(tmp_path / "two"), files=root)
    other = str(tmp_path / "other")
    tables.write_bars(captures(spark).drop("snapshot_file").coalesce(1), other)
    with pytest.raises(GuardError, match="not hashed"):
        canonical_build(read, run, checks(spark), KEY, 60, str(tmp_path / "three"), files=other)


def many(spark):
    """120 entries: each third has X, each second Y (twice in its list), two dates in four; one has neither symbols nor dates."""
    i = F.col("id")
    return spark.range(120).select(
        F.concat(F.lit("d"), F.lpad(i.cast("string"), 3, "0")).alias("dataset_id"), (i % 4).alias("row_count"),
        F.when(i == 119, F.array().cast("array<string>")).otherwise(F.array(F.when(i % 3 == 0, F.lit("X")), F.when(i % 2 == 0, F.lit("Y")), F.when(i % 2 == 0, F.lit("Y")))).alias("symbols"),
        F.when(i == 119, F.lit(None)).otherwise(F.array(F.date_add(F.lit("2026-07-01").cast("date"), (i % 4).cast("int")))).alias("dates"),
    )


def test_postings_find_what_a_scan_finds(spark, tmp_path):
    e = many(spark)
    own, path = catalog.materialize(e, str(tmp_path), buckets=8)
    assert catalog.verified(spark, path, own, e.schema).count() == 120
    for wanted in ({"symbol": "X"}, {"date": "2026-07-03"}, {"symbol": "Y", "date": "2026-07-03"}, {"symbol": "X", "date": "2026-07-02", "offset": 3, "limit": 4}, {"symbol": "none"}, {"symbol": "2026-07-01"}, {"symbol": "X", "equal": {"row_count": 2}}, {"equal": {"row_count": 3}, "limit": 7}, {}, {"symbol": "X", "offset": 1000}, {"symbol": "Y", "limit": 20_000}):
        got, want = catalog.indexed_search(spark, path, **wanted), catalog.search(e, **wanted)
        assert got.columns == want.columns and got.collect() == want.collect(), wanted
    assert values(catalog.indexed_lookup(spark, path, "d007")) == values(catalog.lookup(e, "d007")) and catalog.indexed_lookup(spark, path, "no").count() == 0
    plan = catalog.indexed_search(spark, path, symbol="X", limit=3)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "kind#" in plan.split("PartitionFilters")[-1] + plan.split("PartitionFilters")[1]
    spark.createDataFrame([("X", "d119", "symbol", 0)], "term string, dataset_id string, kind string, bucket int").write.mode("append").partitionBy("kind", "bucket").parquet(f"{path}/postings")
    with pytest.raises(GuardError, match="postings"):
        catalog.verified(spark, path, own, e.schema)
    with pytest.raises(GuardError, match="dataset_id"):
        catalog.materialize(e.withColumn("dataset_id", F.lit(None).cast("string")), str(tmp_path))
    with pytest.raises(ValueError, match="manifest"):
        catalog.indexed_search(spark, str(tmp_path / "no"), symbol="X")


def test_entries_come_from_verified_datasets(spark, tmp_path):
    rows = build(two_codes(spark), SPEC).rows.cache()
    root = str(tmp_path)
    paths = {c: dataset.materialize(rows.filter(F.col("code") == c), root) for c in "AB"}
    got = {r.dataset_id: (r.row_count, r.symbols) for r in catalog.of_datasets(spark, root).collect()}
    assert got == {own: (rows.filter(F.col("code") == c).count(), [c]) for c, (own, _) in paths.items()}
    spark.range(0).write.mode("overwrite").parquet(f"{paths['A'][1]}/manifest")  # unfinished
    assert [r.symbols for r in catalog.of_datasets(spark, root).collect()] == [["B"]]
    tables.write_dataset(rows.filter("code = 'A'"), f"{paths['B'][1]}/rows", mode="overwrite")
    with pytest.raises(GuardError, match=paths["B"][0]):
        catalog.of_datasets(spark, root)
