"""Packing of documents into batches of equal token budget, with padding made least.

Dynamic programming over the histogram of the lengths of all documents finds the bucket boundaries
with the least padding; inside each bucket, documents fill batches of budget // boundary places. A
document that no batch can hold goes in pieces.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.common import written

#: Cells per bucket: places are counted by cell, so that no task numbers a whole bucket.
CELLS = 1024


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The at most `buckets` upper bounds, each an occurring length, with the least total padding.

    The padding of a run of lengths meets the quadrangle inequality, so the best place to cut moves up with the end
    of the run: each layer of the program is solved by halves, in time n log n, for any number of lengths.
    """
    n = len(lengths)
    if not n:
        return []
    rows = np.r_[0, np.cumsum(counts, dtype=np.float64)]
    words = np.r_[0, np.cumsum(counts * lengths, dtype=np.float64)]
    cost = np.full(n + 1, np.inf)
    cost[0] = 0.0
    back = np.zeros((buckets + 1, n + 1), dtype=np.int64)
    best, used = (np.inf, 0), 0
    for k in range(1, min(buckets, n) + 1):
        after = np.full(n + 1, np.inf)
        halves = [(1, n, 0, n - 1)]
        while halves:
            low, high, first, last = halves.pop()
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            # One bucket of the lengths i+1 .. j, all padded to lengths[j - 1].
            total = cost[i] + lengths[j - 1] * (rows[j] - rows[i]) - (words[j] - words[i])
            at = int(np.argmin(total))
            after[j], back[k, j] = total[at], i[at]
            if low < j:
                halves.append((low, j - 1, first, int(i[at])))
            if j < high:
                halves.append((j + 1, high, int(i[at]), last))
        cost = after
        if cost[n] < best[0]:
            best, used = (cost[n], k), k
    out, j = [], n
    for k in range(used, 0, -1):
        out.append(int(lengths[j - 1]))
        j = int(back[k, j])
    return out[::-1]


def word_count(text: Column) -> Column:
    """Words of a text: runs without white space; null: none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def pack(docs: DataFrame, length: Column, budget: int = 65_536, max_length: int | None = None, buckets: int = 16) -> DataFrame:
    """doc_id, piece, start, n_tokens, bucket_length, batch, place: every document in pieces of at most max_length tokens, every piece in a batch.

    docs needs doc_id; length gives a row's tokens. batch counts from 0 inside each bucket_length, place
    from 0 inside each batch; a batch has budget // bucket_length places (one at least), all but the last batch
    of a bucket are full. Without max_length pieces have the whole budget, so only what is longer than a batch is
    cut. The driver sees the histogram of lengths, which has at most max_length bins.

    Defined results: a document of no tokens, or of null length, is one piece of no tokens and stands in the
    least bucket; a null doc_id and repeated rows are packed like others; an empty table gives none.
    """
    max_length = max_length or budget
    n = F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0))
    rows = written(docs.select(F.col("doc_id").cast("long"), n.alias("n")), "lengths")  # texts are read and counted once
    pieces = rows.select("doc_id", "n", F.posexplode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(max_length).cast("long"))).alias("piece", "start"))
    pieces = pieces.select("doc_id", F.col("piece").cast("long"), "start", F.least(F.col("n") - F.col("start"), F.lit(max_length)).alias("n_tokens"))
    found = sorted(pieces.groupBy("n_tokens").count().collect())
    bounds = best_boundaries(np.array([r[0] for r in found], dtype=np.int64), np.array([r[1] for r in found], dtype=np.int64), buckets)
    bucket = F.lit(max_length)
    for b in reversed(bounds):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b)).otherwise(bucket)
    cell = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(CELLS))
    dealt = pieces.withColumn("bucket_length", bucket.cast("long")).withColumn("cell", cell)
    # At most buckets * CELLS rows: where each cell begins inside its bucket.
    sizes = dealt.groupBy("bucket_length", "cell").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("bucket_length").orderBy("cell")) - F.col("size")
    begins = sizes.select("bucket_length", "cell", before.alias("begin"))
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("bucket_length", "cell").orderBy("doc_id", "piece", "n_tokens")) - 1).join(F.broadcast(begins), ["bucket_length", "cell"])
    places = F.greatest(F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1))), F.lit(1))
    at = F.col("begin") + F.col("rank")
    return ranked.select("doc_id", "piece", "start", "n_tokens", "bucket_length", F.floor(at / places).cast("long").alias("batch"), F.pmod(at, places).cast("long").alias("place"))
