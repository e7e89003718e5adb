"""Passes that depend on the order of rows, without one task for each key: ranges of the order and what is carried over their edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def steps_back(df: DataFrame, keys: list[str], order: Column, value: Column) -> DataFrame:
    """keys and n: how often value is less than that of the row before it, among the rows of a key in the given order (null first).

    Rows are dealt out by ranges of keys and order, so a key with many rows is spread over tasks. Each range compares its
    own neighbours and keeps its first and last value; these, one row for each range and key, are then compared over the
    edges. A null value compares with nothing, and null keys are one key.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), order.alias("_o"), value.alias("_v"))
    rows = rows.repartitionByRange(*names, "_o").withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range", *names).orderBy("_o")
    rows = rows.withColumn("_back", F.lag("_v").over(inside) > F.col("_v"))
    at = F.struct("_o")  # a null order is the least
    edges = rows.groupBy("_range", *names).agg(F.count_if("_back").alias("n"), F.min_by(F.struct("_v"), at).alias("first"), F.max_by(F.struct("_v"), at).alias("last"))
    before = F.lag("last").over(Window.partitionBy(*names).orderBy("_range"))
    edges = edges.withColumn("_over", F.coalesce(before["_v"] > F.col("first._v"), F.lit(False)))
    return edges.groupBy(*names).agg(F.sum(F.col("n") + F.col("_over").cast("long")).alias("n")).select(*(F.col(n).alias(k) for k, n in zip(keys, names, strict=True)), "n")
