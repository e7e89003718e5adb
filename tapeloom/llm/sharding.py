"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring has CELLS places. Every shard stands on it at several virtual nodes; a key belongs to the
next virtual node clockwise of its hash. A shard takes its own keys in ring order until it is full;
the keys over that go on clockwise to the next virtual node of a shard that is not. Only the counts
of the cells reach the driver, which turns them into ranges of ranks: rows then find their shard by
cell and rank.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1 << 16
#: Parts in which a cell is numbered, so that no task numbers a whole one.
PARTS = 64


def virtual_nodes(shards: int, copies: int, seed: int = 17) -> list[tuple[int, int]]:
    """(cell, shard) in ring order; a shard's nodes depend on its number alone, and the first shard to ask for a cell has it."""
    taken: dict[int, int] = {}
    for s in range(shards):
        for cell in np.random.default_rng([seed, s]).integers(0, CELLS, copies).tolist():
            taken.setdefault(cell, s)
    return sorted(taken.items())


def ranges(counts: np.ndarray, nodes: list[tuple[int, int]], capacity: list[int]) -> list[tuple[int, int, int, int, int, int]]:
    """(cell, from_rank, to_rank, shard, slot, home) for all keys of all cells: ranks [from, to) of a cell take the slots of shard from slot on; home is the shard they would have on an unbounded ring."""
    cells, left = [c for c, _ in nodes], list(capacity)
    used, out, over = [0] * len(capacity), [], []

    def give(cell, a, n, shard, home):
        out.append((cell, a, a + n, shard, used[shard], home))
        used[shard] += n
        left[shard] -= n

    for cell in np.flatnonzero(counts).tolist():
        at = bisect_left(cells, cell) % len(nodes)
        shard, n = nodes[at][1], int(counts[cell])
        if take := min(n, left[shard]):
            give(cell, 0, take, shard, shard)
        if take < n:
            over.append((cell, take, n - take, at))
    for cell, a, n, at in over:
        home = nodes[at][1]
        while n:
            at = (at + 1) % len(nodes)
            if take := min(n, left[nodes[at][1]]):
                give(cell, a, take, nodes[at][1], home)
                a, n = a + take, n - take
    return out


def ring_cell(key: Column) -> Column:
    """A key's place on the ring, from its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 4), 16, 10).cast("int")


def sharded(docs: DataFrame, shards: int = 24, copies: int = 64) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and home of every row of docs.

    The law is `rows`: a shard may hold its part of the rows and no more, so counts are at most one apart.
    size is the text's UTF-8 bytes and 8; slot counts from 0 in each shard without gaps; home is the shard of
    the unbounded ring. grown_shard is null, as the law does not speak of it.

    A cell's rows are numbered in PARTS parts, by a hash of doc_id, size and checksum, and rows that are equal in these are
    counted before they are shuffled: a doc_id that repeats a million times is neither one task nor one cell's.
    Which shard a row has depends on its rank in its cell only where the shard fills inside that cell; see README
    for the share of rows that one more shard moves.

    docs needs doc_id and text; other columns are not read. Defined results: a null text has no bytes; a null
    doc_id and repeated rows are keys like others (equal rows take any order); an empty table gives none; of a
    text of any length only size and checksum are kept.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # The key is doc_id; rows without one are spread by their text.
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("?"), F.crc32(text).cast("string")))
    rows = docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), ring_cell(key).alias("cell"))
    counts = np.zeros(CELLS, dtype=np.int64)
    for cell, n in docs.select(ring_cell(key).alias("cell")).groupBy("cell").count().collect():  # at most CELLS rows
        counts[cell] = n
    total = int(counts.sum())
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    found = ranges(counts, virtual_nodes(shards, copies), capacity)
    plan = docs.sparkSession.createDataFrame(found, "cell int, from_rank long, to_rank long, shard int, first_slot long, home int")
    equal = rows.groupBy("cell", "doc_id", "size", "text_crc32").agg(F.count("*").alias("n")).withColumn("part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(PARTS)))
    sizes = equal.groupBy("cell", "part").agg(F.sum("n").alias("size"))
    begins = sizes.select("cell", "part", (F.sum("size").over(Window.partitionBy("cell").orderBy("part")) - F.col("size")).alias("begin"))
    inside = F.sum("n").over(Window.partitionBy("cell", "part").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    firsts = equal.withColumn("inside", inside).join(begins, ["cell", "part"])
    ranked = firsts.select("doc_id", "size", "text_crc32", "cell", F.explode(F.sequence(F.col("begin") + F.col("inside"), F.col("begin") + F.col("inside") + F.col("n") - 1)).alias("rank"))
    # The plan has a row for each cell and for each shard that fills inside one: bounded by the ring, not by the rows.
    placed = ranked.join(F.broadcast(plan), "cell").filter((F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("first_slot") + F.col("rank") - F.col("from_rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "home")
