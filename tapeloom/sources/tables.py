"""Stored tables: scans with explicit schemas, sinks with fixed layouts, file inventory."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapeloom import schemas
from tapeloom.functions.identity import content_id


def _scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet under path by column name; columns that a file lacks are null, partition columns come from the path."""
    return spark.read.schema(schema).parquet(path)


def read_bars(spark: SparkSession, root: str) -> DataFrame:
    """All curated bar snapshots under root."""
    return _scan(spark, root, schemas.CURATED_BARS)


def read_bars_with_file(spark: SparkSession, root: str) -> DataFrame:
    """Curated bars with the file each row comes from."""
    return read_bars(spark, root).select("*", F.col("_metadata.file_path").alias("snapshot_file"))


def read_snapshot(spark: SparkSession, file: str, code: str) -> DataFrame:
    """Rows of one code in one file with the file's own columns, by time where it has one."""
    rows = spark.read.parquet(file).filter(F.col("code") == code)
    return rows.orderBy("time_utc") if "time_utc" in rows.columns else rows


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """Raw captures of any kind as they were delivered, columns of all files together."""
    return spark.read.option("mergeSchema", "true").parquet(root)


def read_option_contracts(spark: SparkSession, root: str) -> DataFrame:
    return _scan(spark, root, schemas.OPTION_CONTRACTS)


def read_option_volatility(spark: SparkSession, root: str) -> DataFrame:
    return _scan(spark, root, schemas.OPTION_VOLATILITY)


def read_calendar(spark: SparkSession, root: str) -> DataFrame:
    """Calendar rows; rows from before requests were recorded cover their own date."""
    rows = _scan(spark, root, schemas.TRADING_CALENDAR)
    return rows.withColumns({c: F.coalesce(c, "trade_date") for c in ("requested_start_date", "requested_end_date")})


def _append(df: DataFrame, path: str, *parts: str) -> None:
    df.write.mode("append").option("compression", "zstd").partitionBy(*parts).parquet(path)


def write_bars(df: DataFrame, path: str) -> None:
    """Append raw or curated bars by interval and requested date."""
    _append(df, path, "interval", "requested_trade_date")


def write_option_contracts(df: DataFrame, path: str) -> None:
    """Append contracts by underlying and day of capture."""
    _append(df.withColumn("capture_date", F.to_date("captured_at")).withColumn("by_underlying", F.col("underlying_code")), path, "by_underlying", "capture_date")


def write_option_volatility(df: DataFrame, path: str, start: str, end: str) -> None:
    """Append volatility rows by the requested range."""
    _append(df.withColumns({"start_date": F.lit(start), "end_date": F.lit(end)}), path, "start_date", "end_date")


def write_calendar(df: DataFrame, path: str) -> None:
    """Append calendar rows by scope and requested range."""
    parts = {"by_scope": "scope_type", "by_value": "scope_value", "by_start": "requested_start_date", "by_end": "requested_end_date"}
    _append(df.withColumns({k: F.col(v) for k, v in parts.items()}), path, *parts)


def write_raw(df: DataFrame, path: str, run_id: str, **parts: str) -> None:
    """Append delivered rows as they are, by the parameters of the request and the run."""
    by = {**parts, "by_run": run_id}
    _append(df.withColumns({k: F.lit(v) for k, v in by.items()}), path, *by)


def write_canonical(df: DataFrame, path: str, order: tuple[str, ...] = ("event_time", "canonical_bar_key"), mode: str = "errorifexists") -> None:
    """Canonical bars or gaps, one sorted run of rows for each interval, adjustment, code and date."""
    keys = [c for c in ("interval", "adjustment", "code", "market_calendar_date") if c in df.columns]
    df.repartition(*keys).sortWithinPartitions(*keys, *order).write.mode(mode).option("compression", "zstd").partitionBy(*keys).parquet(path)


def write_gaps(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_canonical(df, path, ("previous_event_time", "gap_id"), mode)


def write_resolution(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Selected and discarded sources as JSON lines."""
    df.write.mode(mode).json(path)


def write_manifest(spark: SparkSession, path: str, facts: dict[str, str]) -> None:
    """Say that what lies at path is whole: a table of facts, written after everything else."""
    spark.createDataFrame(sorted(facts.items()), "name string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> dict[str, str] | None:
    """The facts of a finished build, or None where there is none or it was not finished."""
    try:
        rows = spark.read.schema("name string, value string").parquet(f"{path}/manifest").collect()  # a few facts
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return dict(map(tuple, rows)) or None


def write_dataset(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A finished dataset: rows in the order of code, feature_window_close and sample_key over all files."""
    order = ("code", "feature_window_close", "sample_key")
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).option("compression", "zstd").parquet(path)


def verified_dataset(spark: SparkSession, path: str, expected_id: str, schema: StructType | None = None) -> DataFrame:
    """Read a dataset back; raise if its content id is not the expected one."""
    df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    found = content_id(df).first()[0]
    if found != expected_id:
        raise ValueError(f"content id {found} of {path} is not {expected_id}")
    return df


def upsert_latest(rows: DataFrame, key: str = "run_id", order: str = "recorded_at") -> DataFrame:
    """The table that delete-and-insert by key would leave: of an append-only log, each key's latest row; nulls in order lose, ties go to the greater row (columns in the order of their names, maps by their sorted entries)."""
    plain = lambda c, kind: F.array_sort(F.map_entries(c)) if kind.startswith("map") else F.col(c)
    rest = [F.desc_nulls_last(plain(c, kind)) for c, kind in sorted(rows.dtypes) if c not in (key, order)]
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(order), *rest)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def file_inventory(df: DataFrame, layer: str) -> DataFrame:
    """layer, path, size, modified and legacy (the name does not start with part-) of every file that df reads."""
    m = df.select("_metadata.file_path", "_metadata.file_name", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return m.select(F.lit(layer).alias("layer"), F.col("file_path").alias("path"), F.col("file_size").alias("size"), F.col("file_modification_time").alias("modified"), (~F.col("file_name").startswith("part-")).alias("legacy"))


def inventory_totals(files: DataFrame) -> DataFrame:
    """Files, bytes, legacy names, oldest and newest of each layer."""
    return files.groupBy("layer").agg(
        F.count("*").alias("n_files"), F.sum("size").alias("n_bytes"), F.count_if("legacy").alias("n_legacy"), F.min("modified").alias("oldest"), F.max("modified").alias("newest")
    )


def file_hashes(spark: SparkSession, path: str, row_bytes: int = 64 << 20) -> DataFrame:
    """path (as _metadata.file_path has it), size and SHA-256 of every file's bytes under path, whatever its size; empty files are left out, as scans leave them out.

    A file of at most row_bytes is one row of a scan; a longer one is read by its task in blocks, never whole, through the
    file system that its path names (Arrow's local, HDFS or object store systems).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    own = F.col("_metadata.file_path").alias("path")
    short = files.filter(F.col("length") <= row_bytes).select(own, F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    # The scan of lengths reads no content. One file is one row; they are dealt out before they are read.
    long = files.filter(F.col("length") > row_bytes).select(own, F.col("length").alias("size")).repartition("path")
    return short.unionByName(long.mapInPandas(_streamed, "path string, size long, sha256 string"))


def _streamed(batches):
    """SHA-256 of each file of the batches, read in blocks of 8 MiB."""
    import hashlib
    from urllib.parse import unquote, urlsplit

    from pyarrow import fs

    for files in batches:
        digests = []
        for uri in files["path"]:
            parts = urlsplit(uri)
            system, at = (fs.LocalFileSystem(), unquote(parts.path)) if parts.scheme in ("", "file") else fs.FileSystem.from_uri(uri)
            whole = hashlib.sha256()
            with system.open_input_stream(at) as stream:
                while block := stream.read(8 << 20):
                    whole.update(block)
            digests.append(whole.hexdigest())
        yield files.assign(sha256=digests)
