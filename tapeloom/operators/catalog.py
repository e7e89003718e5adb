"""A catalog of finished datasets: one row of facts for each."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapeloom.functions.identity import content_id, content_ids
from tapeloom.guards import require_empty


def entries(rows: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Facts of each dataset in rows (dataset rows with a dataset_id): counts, symbols, dates, span."""
    return rows.groupBy(key).agg(
        F.count("*").alias("row_count"),
        F.array_sort(F.collect_set("code")).alias("symbols"),
        F.array_sort(F.collect_set(F.to_date("feature_window_close"))).alias("dates"),
        F.min("feature_window_close").alias("first_close"),
        F.max("feature_window_close").alias("last_close"),
        F.count_if(F.col("assignment_status") == "ASSIGNED").alias("assigned_count"),
    )


def of_datasets(spark: SparkSession, root: str) -> DataFrame:
    """Entries of every finished dataset that dataset.materialize left under root; one scan verifies them all.

    Rows of each dataset must have the content id that names it and be as many as its manifest says, else GuardError names
    the datasets. What has no manifest is unfinished and left out.
    """
    named = F.regexp_extract("_metadata.file_path", "/dataset_id=([0-9a-f]+)/", 1).alias("dataset_id")
    facts = spark.read.schema("name string, value string").parquet(f"{root}/dataset_id=*/manifest").select(named, "name", "value")
    finished = facts.groupBy("dataset_id").agg(F.max(F.when(F.col("name") == "n_rows", F.col("value"))).cast("long").alias("n_manifest"))
    stored = spark.read.parquet(f"{root}/dataset_id=*/rows")
    rows = stored.select(named, *(c for c in stored.columns if c != "dataset_id")).join(finished.select("dataset_id"), "dataset_id", "left_semi")
    found = content_ids(rows, ["dataset_id"], [c for c in rows.columns if c != "dataset_id"])
    wrong = finished.filter("n_manifest > 0").join(found, "dataset_id", "left").filter(~F.col("content_id").eqNullSafe(F.col("dataset_id")) | ~F.col("n_rows").eqNullSafe(F.col("n_manifest")))
    require_empty(wrong, "datasets whose rows are not those of their manifests")
    return entries(rows)


def built(parts: list[DataFrame]) -> DataFrame:
    """The union of entries; a dataset that comes twice raises."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    require_empty(out.groupBy("dataset_id").count().filter("count > 1"), "a dataset comes twice")
    return out


def snapshot_id(catalog: DataFrame) -> DataFrame:
    """One row: the content id of a catalog."""
    return content_id(catalog)


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def postings(catalog: DataFrame) -> DataFrame:
    """kind (symbol or date), term, dataset_id: a row for each symbol and each date of each entry; nulls are no terms."""
    symbols = catalog.select(F.lit("symbol").alias("kind"), F.explode("symbols").alias("term"), "dataset_id")
    dates = catalog.select(F.lit("date").alias("kind"), F.explode(F.transform("dates", lambda d: d.cast("string"))).alias("term"), "dataset_id")
    return symbols.unionByName(dates).filter("term is not null").distinct()


def materialize(catalog: DataFrame, root: str, buckets: int = 64) -> tuple[str, str]:
    """Write a snapshot of a catalog and its postings under the id of its content, its manifest last; a finished one is used again. Returns (id, path).

    Postings lie in folders by kind and hash of the term, entries in folders by hash of their id: a search opens the folders
    of its terms and of its page. Both are dealt out by ranges, so the many postings of one term are many tasks' work. An
    entry without a dataset_id raises.
    """
    from tapeloom.sources import tables

    spark = catalog.sparkSession
    own = snapshot_id(catalog).first()[0]
    path = f"{root}/catalog_id={own}"
    if tables.read_manifest(spark, path) is None:
        require_empty(catalog.filter("dataset_id is null"), "an entry has no dataset_id")
        dealt = lambda df, *keys: df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite")
        dealt(catalog.withColumn("shard", _bucket(F.col("dataset_id"), buckets)), "shard", "dataset_id").partitionBy("shard").parquet(f"{path}/entries")
        dealt(postings(catalog).withColumn("bucket", _bucket(F.col("term"), buckets)), "kind", "bucket", "term", "dataset_id").partitionBy("kind", "bucket").parquet(f"{path}/postings")
        tables.write_manifest(spark, path, {"catalog_id": own, "n_entries": str(catalog.count()), "buckets": str(buckets), "schema": catalog.schema.json()})
    return own, path


def verified(spark: SparkSession, path: str, own: str, schema: StructType) -> DataFrame:
    """The entries of a catalog snapshot; raises unless manifest, content id and number of entries agree, each dataset comes once, and the postings are those of the entries."""
    from tapeloom.sources import tables

    facts = tables.read_manifest(spark, path)
    df = spark.read.schema(schema).parquet(f"{path}/entries").select(*schema.names)
    if facts is None or facts["catalog_id"] != own or int(facts["n_entries"]) != df.count() or snapshot_id(df).first()[0] != own:
        raise ValueError(f"{path} is not a finished catalog {own}")
    stored = _postings(spark, path).select("kind", "term", "dataset_id")
    both = stored.withColumn("n", F.lit(1)).unionByName(postings(df).withColumn("n", F.lit(-1)))
    require_empty(both.groupBy("kind", "term", "dataset_id").agg(F.sum("n").alias("n")).filter("n <> 0"), "postings are not those of the entries")
    return built([df])


def _postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("term string, dataset_id string, kind string, bucket int").parquet(f"{path}/postings")


def _stored(spark: SparkSession, path: str) -> tuple[DataFrame, int, list[str]]:
    """Entries with their shard, number of buckets and the catalog's own columns."""
    from tapeloom.sources import tables

    facts = tables.read_manifest(spark, path)
    if facts is None:
        raise ValueError(f"{path} has no manifest: the catalog was not finished")
    schema = StructType.fromJson(json.loads(facts["schema"]))
    return spark.read.schema(StructType([*schema.fields]).add("shard", "integer")).parquet(f"{path}/entries"), int(facts["buckets"]), schema.names


def indexed_search(spark: SparkSession, path: str, *, symbol: str | None = None, date: str | None = None, equal: dict[str, object] | None = None, offset: int = 0, limit: int = 50) -> DataFrame:
    """What search() returns, from a stored catalog: the postings of the terms are intersected, and the page's entries fetched from their folders.

    Without a term all entries are looked at, as they are for those that must equal values after the postings are met.
    """
    entry, buckets, columns = _stored(spark, path)
    terms = [(k, v) for k, v in (("symbol", symbol), ("date", date)) if v is not None]
    if not terms:
        return search(entry.select(*columns), equal=equal, offset=offset, limit=limit)
    hit = reduce(Column.__or__, ((F.col("kind") == k) & (F.col("bucket") == _bucket(F.lit(v), buckets)) & (F.col("term") == v) for k, v in terms))
    ids = _postings(spark, path).filter(hit).groupBy("dataset_id").agg(F.count("*").alias("_n")).filter(F.col("_n") == len(terms)).select("dataset_id")
    if equal:
        ids = ids.join(entry.filter(reduce(Column.__and__, (F.col(k) == F.lit(v) for k, v in equal.items()))), "dataset_id", "left_semi")
    page = ids.join(ids.agg(F.count("*").alias("matched_count"))).orderBy("dataset_id").offset(offset).limit(limit)  # matched_count is one row
    page = page.withColumn("shard", _bucket(F.col("dataset_id"), buckets))
    # A page of at most 10,000 ids is small whatever the catalog's size; the scan then opens the folders of its ids only.
    found = entry.join(F.broadcast(page) if limit <= 10_000 else page, ["shard", "dataset_id"])
    return found.select(*columns, "matched_count").orderBy("dataset_id")


def indexed_lookup(spark: SparkSession, path: str, dataset_id: str) -> DataFrame:
    """The entry of one dataset, from its folder of a stored catalog."""
    entry, buckets, columns = _stored(spark, path)
    return entry.filter((F.col("shard") == _bucket(F.lit(dataset_id), buckets)) & (F.col("dataset_id") == dataset_id)).select(*columns)


def search(catalog: DataFrame, *, symbol: str | None = None, date: str | None = None, equal: dict[str, object] | None = None, offset: int = 0, limit: int = 50) -> DataFrame:
    """A page of the entries that meet all filters, by dataset_id, with the number of all matches."""
    df = catalog
    for name, value in (equal or {}).items():
        df = df.filter(F.col(name) == F.lit(value))
    if symbol is not None:
        df = df.filter(F.array_contains("symbols", symbol))
    if date is not None:
        df = df.filter(F.array_contains("dates", F.lit(date).cast("date")))
    matched = df.agg(F.count("*").alias("matched_count"))
    return df.join(matched).orderBy("dataset_id").offset(offset).limit(limit)  # matched is one row


def lookup(catalog: DataFrame, dataset_id: str) -> DataFrame:
    return catalog.filter(F.col("dataset_id") == dataset_id)
