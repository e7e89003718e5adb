"""Content identity: digests of rows, ids of tables, keys of bars, gaps and samples."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "\x1f"
#: Hexadecimal digits of a digest that group it; part of the version of a content id. More digits for tables of more than 10^10 rows keep a group small.
PREFIX = 4


def digest(*values: Column | str) -> Column:
    """SHA-256 of the values' texts, each with its length in front, so that no two lists of values have one text; null has a text of its own."""
    texts = ((F.col(v) if isinstance(v, str) else v).cast("string") for v in values)
    return F.sha2(F.concat_ws(SEPARATOR, *(F.coalesce(F.concat(F.length(t).cast("string"), F.lit("="), t), F.lit("~")) for t in texts)), 256)


def text_digest(*values: str) -> str:
    """digest() of a few texts on the driver."""
    return hashlib.sha256(SEPARATOR.join(f"{len(v)}={v}" for v in values).encode()).hexdigest()


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Digest of a row: name, type and value of each column, -0.0 as 0.0."""
    parts = []
    for name, kind in df.dtypes:
        if columns is None or name in columns:
            value = F.col(f"`{name}`")
            if kind in ("double", "float"):
                value = F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value)
            text = F.to_json(F.struct(value.alias("v"))) if kind.startswith(("array", "map", "struct")) else value.cast("string")
            parts += [F.lit(f"{name}:{kind}"), text]
    return digest(*parts)


def content_id(df: DataFrame, columns: list[str] | None = None, prefix: int = PREFIX) -> DataFrame:
    """One row with content_id: the same for the same rows in any order and partitioning, with repeated rows counted.

    Digests are counted, then hashed per prefix, and the prefixes' hashes by shorter and shorter prefixes (PREFIX digits less
    each time), so no task sees more than one prefix. Ids of different prefix lengths are different ids. prefix is a multiple of PREFIX.
    """
    if prefix < PREFIX or prefix % PREFIX:
        raise ValueError(f"prefix must be a multiple of {PREFIX}, not {prefix}")
    rows = df.select(row_digest(df, columns).alias("d")).groupBy("d").agg(F.count("*").alias("n"))
    leaves = rows.select(F.substring("d", 1, prefix).alias("prefix"), F.concat_ws(":", "d", F.col("n").cast("string")).alias("leaf"))
    nodes = leaves.groupBy("prefix").agg(F.sha2(F.concat_ws("", F.array_sort(F.collect_list("leaf"))), 256).alias("node"))
    for n in range(prefix - PREFIX, PREFIX - 1, -PREFIX):
        inner = nodes.select(F.substring("prefix", 1, n).alias("up"), F.concat("prefix", "node").alias("leaf"))
        nodes = inner.groupBy(F.col("up").alias("prefix")).agg(F.sha2(F.concat_ws("", F.array_sort(F.collect_list("leaf"))), 256).alias("node"))
    return nodes.agg(F.sha2(F.concat_ws("", F.array_sort(F.collect_list(F.concat("prefix", "node")))), 256).alias("content_id"))  # at most 16 ** PREFIX nodes


def nodes(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """by, prefix, n_rows and node: the lower level of the content ids of each group's rows, one row for each prefix of digests that occurs. Null keys are one key.

    Stored beside a table, nodes say which groups and prefixes of it have changed, and a part of its groups can be verified alone.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    named = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]
    rows = df.select(*named, row_digest(df, columns).alias("d")).groupBy(*keys, "d").agg(F.count("*").alias("n"))
    leaves = rows.select(*keys, "n", F.substring("d", 1, PREFIX).alias("prefix"), F.concat_ws(":", "d", F.col("n").cast("string")).alias("leaf"))
    found = leaves.groupBy(*keys, "prefix").agg(F.sum("n").alias("n_rows"), F.sha2(F.concat_ws("", F.array_sort(F.collect_list("leaf"))), 256).alias("node"))
    return found.select(*(F.col(k).alias(c) for c, k in zip(by, keys, strict=True)), "prefix", "n_rows", "node")


def content_ids(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """by, n_rows and content_id of each group's rows in the given columns: what content_id() says of that group alone. Null keys are one key."""
    top = nodes(df, by, columns).groupBy(*by)
    return top.agg(F.sum("n_rows").alias("n_rows"), F.sha2(F.concat_ws("", F.array_sort(F.collect_list(F.concat("prefix", "node")))), 256).alias("content_id"))


def altered(stored: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """by, prefix, n_stored and n_found of the nodes that differ; a node that one side lacks has no rows there. One aggregation over both sides, in which nulls are one key."""
    both = stored.select(*by, "prefix", "n_rows", "node", F.lit(True).alias("_stored")).unionByName(found.select(*by, "prefix", "n_rows", "node", F.lit(False).alias("_stored")))
    side = lambda s: F.coalesce(F.sum(F.when(F.col("_stored") == s, F.col("n_rows"))), F.lit(0))
    met = both.groupBy(*by, "prefix").agg(side(True).alias("n_stored"), side(False).alias("n_found"), F.count("*").alias("_n"), (F.min("node") != F.max("node")).alias("_differs"))
    return met.filter((F.col("_n") != 2) | F.col("_differs")).drop("_n", "_differs")


def instant_text(c: Column) -> Column:
    """An instant to the microsecond, in UTC."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def bar_key(code: Column, interval: Column, adjustment: Column, event_time: Column, kind: str = "MARKET_BARS") -> Column:
    """Key of a market event, whoever captured it."""
    return digest(F.lit(kind), code, interval, adjustment, instant_text(event_time))


def bar_version(key: Column, run: Column, content_hash: Column, schema: Column, builder: str = "1") -> Column:
    """Id of one capture of a bar. content_hash is the hash of the snapshot's bytes or rows: a snapshot that is moved keeps its versions."""
    return digest(key, run, content_hash, schema, F.lit(builder))


def gap_id(code: Column, interval: Column, adjustment: Column, day: Column, session: Column, before: Column, after: Column, kind: str = "MARKET_BARS") -> Column:
    return digest(F.lit("gap"), F.lit(kind), code, interval, adjustment, day, session, instant_text(before), instant_text(after))


def sample_key(code: Column, interval: Column, adjustment: Column, session: Column, day: Column, start: Column, close: Column, label_start: Column, label_close: Column) -> Column:
    """Key of a sample request; null label windows differ from every instant."""
    return digest(code, interval, adjustment, session, day, *(instant_text(x) for x in (start, close, label_start, label_close)))
