"""Near-duplicate documents by bottom-k sketches from one hash function.

Each document is a set of hashed word shingles; the k least hashes are its sketch. Inverted lists
of the retained values bring together documents whose sketches overlap; the sketch of the union
estimates their similarity and filters; the Jaccard index of the whole sets decides.

Documents with equal sets are one vertex from the start, so copies never make pairs. A value that
more than ``list_limit`` vertices retain is hot. Below that, each list gives its pairs. A vertex
with a quarter of its sketch hot (the large groups of near copies, and texts with common passages)
also goes to the lists of its least hot values. Those lists are dealt out in blocks of bounded size,
and blocks are compared on the whole sets in one task a pair, which returns only a spanning forest of
the links that it found. First each block meets the leaders, the first block of its list: that
connects a group of near copies, and what is connected need not be compared again. Then only what
is not yet connected with the list's largest part meets the rest. So the work on a group of copies
grows with its size, not its square; no list is cut and no pair that could be a new link is skipped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import chunks, discard, mix, utf8, word_hashes, word_spans, written
from tapeloom.llm.components import components

_ODD = np.random.default_rng(7).integers(1, 2**62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text, its distinct shingles as sorted 64-bit hashes; a text of fewer than width words is one shingle."""
    data, offsets = utf8(texts)
    for a, b in chunks(offsets):
        part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends = word_spans(part, cuts)
        hashes = word_hashes(part, starts, ends)
        first = np.searchsorted(starts, cuts)
        n = len(hashes)
        rolled = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
        for i in range(width):
            rolled += hashes[i : n - width + 1 + i] * _ODD[i] if n >= width else 0
        rolled = mix(rolled).view(np.int64)
        for i in range(b - a):
            lo, hi = int(first[i]), int(first[i + 1])
            if hi - lo >= width:
                yield np.unique(rolled[lo : hi - width + 1])
            elif hi > lo:
                short = np.add.reduce(hashes[lo:hi] * _ODD[: hi - lo], keepdims=True) + _ODD[15:16] * np.uint64(hi - lo)
                yield mix(short).view(np.int64)
            else:
                yield np.zeros(0, dtype=np.int64)


def _digest(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def sketches(docs: DataFrame, width: int, k: int) -> DataFrame:
    """doc_id, n_shingles, digest of the whole set (null: empty) and sketch, the k least hashes."""

    def run(batches):
        for batch in batches:
            n, digests, least = [], [], []
            for values in shingle_sets(batch.column(1), width):
                n.append(len(values))
                digests.append(_digest(values))
                least.append(values[:k])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), _lists(least)], ["doc_id", "n_shingles", "digest", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, sketch array<long>")


def _whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """vertex and members (all hashes) for the vertices of wanted (vertex, digest), made again from the texts."""

    def run(batches):
        seen: set[tuple[int, bytes]] = set()  # the join brings repeated rows together
        for batch in batches:
            sets, keep = list(shingle_sets(batch.column(1), width)), []
            for i, (vertex, digest) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if (vertex, digest) not in seen and _digest(sets[i]) == digest:
                    seen.add((vertex, digest))
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), _lists([sets[i] for i in keep])], ["vertex", "members"])

    texts = docs.select(F.col("doc_id").cast("long").alias("vertex"), "text").join(wanted, "vertex")
    return texts.select("vertex", "text", "digest").mapInArrow(run, "vertex long, members array<long>")


def _forest(percent: int):
    """Links of one block pair: every vertex joined to the least vertex that it reaches inside the block."""

    def run(table: pa.Table) -> pa.Table:
        vertices = table.column("vertex").to_numpy()
        order = np.argsort(vertices, kind="stable")
        members = [np.asarray(x, dtype=np.int64) for x in (table.column("members").take(pa.array(order)).combine_chunks()).to_numpy(zero_copy_only=False)]
        vertices = vertices[order]
        sizes = np.array([len(x) for x in members])
        owner = np.repeat(np.arange(len(members)), sizes)
        values = np.concatenate(members)
        by = np.argsort(values, kind="stable")
        owner, first = owner[by], np.flatnonzero(np.r_[True, np.diff(values[by]) != 0])
        until = np.r_[first[1:], len(values)]
        code = np.empty(len(values), dtype=np.int64)
        code[by] = np.repeat(np.arange(len(first)), until - first)
        at = np.r_[0, np.cumsum(sizes)]
        label = np.arange(len(members))
        for i in range(len(members)):
            own = code[at[i] : at[i + 1]]
            shared = np.bincount(np.concatenate([owner[first[c] : until[c]] for c in own]), minlength=len(members))
            near = np.flatnonzero(100 * shared >= percent * (sizes + sizes[i] - shared))
            old = np.unique(label[near])
            if len(old) > 1:
                label[np.isin(label, old)] = old[0]
        far = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": vertices[far], "b": vertices[label[far]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    k: int = 32,
    list_limit: int = 48,
    hot_lists: int | None = 8,
    block_shingles: int = 500_000,
) -> DataFrame:
    """Group documents whose shingle sets have a Jaccard index of at least percent / 100.

    docs needs doc_id and text; other columns are not read. Returns doc_id, n_shingles (long: size of
    the set), component_id (least doc_id that can be reached over links, itself included) and kept
    (doc_id = component_id), one row per row of docs.

    Defined results: a null, empty or blank text has no shingles and is linked with nothing; a null
    doc_id is linked with nothing, its component_id is null and it is kept; of rows that repeat a
    doc_id each takes the component of its own text, and texts with the same least doc_id are one
    vertex; an empty table gives an empty result. A text of any length is hashed whole, half a megabyte at a time.

    A pair at the threshold is missed if it has no list in common. A retained value of one is retained by the
    other with a chance of 0.8 about. Of two vertices in the hot lists, none of 8 values agrees with a chance of
    0.2 ** 8 = 3e-6; if one of them is not there, three quarters of its sketch are cold, 24 of 32 values, and the other holds
    none of them cold with a chance of 0.2 ** 24 if those are values of both, or if it holds none of them because it has only
    hot values, 0.25 of its set would have to be its own against the 0.2 that the threshold allows. hot_lists = None sends every
    vertex with a hot value to all lists of its hot values, which leaves only the chance that sketches share nothing.
    """
    base = written(sketches(docs, width, k), "sketches")
    nodes = written(
        base.filter("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("vertex"), F.any_value("n_shingles").alias("n"), F.any_value("sketch").alias("sketch")),
        "nodes",
    )
    held = nodes.select("vertex", "n", F.explode("sketch").alias("v"))
    lists = held.groupBy("v").agg(F.count("*").alias("size")).filter("size > 1")
    shared = written(held.join(lists, "v"), "postings")

    # Plain lists: all pairs, then the sketch of the union.
    plain = shared.filter(F.col("size") <= list_limit)
    left, right = plain.select("v", F.col("vertex").alias("a"), F.col("n").alias("na")), plain.select("v", F.col("vertex").alias("b"), F.col("n").alias("nb"))
    pairs = left.join(right, "v").filter((F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))).select("a", "b").distinct()
    side = lambda x: nodes.select(F.col("vertex").alias(x), F.col("sketch").alias(f"s{x}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    met = met.withColumn("u", union).withColumn("both", F.size(F.array_intersect(F.array_intersect("sa", "sb"), "u")))
    near = written(met.filter(F.col("both") >= percent / 200 * F.size("u")).select("a", "b"), "pairs")

    # Vertices with many hot values: the lists of their least hot values, in blocks.
    heavy = shared.filter(F.col("size") > list_limit).groupBy("vertex").agg(F.max("n").alias("n"), F.array_sort(F.collect_set("v")).alias("hot"))  # at most k values
    if hot_lists is not None:
        heavy = heavy.filter(4 * F.size("hot") >= F.least("n", F.lit(k))).withColumn("hot", F.slice("hot", 1, hot_lists))
    heavy = written(heavy.select("vertex", "n", F.explode("hot").alias("v")), "heavy")
    lists = heavy.groupBy("v").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("blocks"), F.count("*").alias("size")).filter("size > 1")
    listed = written(heavy.join(lists, "v").select("vertex", "n", "v", "blocks", F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int").alias("own")), "listed")
    # The first block of a list meets every other, and itself if it is the only one.
    partners = F.when((F.col("own") == 0) & (F.col("blocks") > 1), F.sequence(F.lit(1), F.col("blocks") - 1)).otherwise(F.array("own"))
    dealt = listed.select("vertex", "v", F.lit("first").alias("kind"), F.lit(0).alias("i"), F.explode(partners).alias("j"))

    ends = near.select(F.col("a").alias("vertex")).union(near.select("b")).union(heavy.select("vertex")).distinct()
    wanted = nodes.select("vertex", "digest").join(ends, "vertex", "left_semi")
    sets = written(_whole_sets(docs, wanted, width), "sets")
    side = lambda x: sets.select(F.col("vertex").alias(x), F.col("members").alias(f"m{x}"))
    proven = near.join(side("a"), "a").join(side("b"), "b").withColumn("both", F.size(F.array_intersect("ma", "mb")))
    proven = proven.filter(100 * F.col("both") >= percent * (F.size("ma") + F.size("mb") - F.col("both"))).select("a", "b")
    compared = lambda pairs: pairs.join(sets, "vertex").groupBy("v", "kind", "i", "j").applyInArrow(_forest(percent), "a long, b long")
    roots = components(proven.unionByName(compared(dealt)))

    # Lists of several blocks: what is not connected with the largest part of its list meets all of it.
    several = listed.filter("blocks > 1").join(roots, "vertex", "left").withColumn("root", F.coalesce("root", "vertex"))
    parts = several.groupBy("v", "root").agg(F.sum("n").alias("n")).groupBy("v").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("parts"))
    apart = several.join(parts.filter("parts > 1"), "v").withColumn("open", F.col("root") != F.col("main"))
    apart = written(apart.select("vertex", "v", "n", "open"), "apart")
    if not apart.isEmpty():
        sizes = apart.groupBy("v").agg(*(F.ceil(F.sum(F.when(c, F.col("n")).otherwise(0)) / block_shingles).cast("int").alias(name) for name, c in (("n_open", F.col("open")), ("n_main", ~F.col("open")))))
        own = F.pmod(F.xxhash64("vertex"), F.when(F.col("open"), F.col("n_open")).otherwise(F.col("n_main"))).cast("int")
        spread = apart.join(sizes, "v").withColumn("own", own)
        every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        mutual = spread.filter("open").select("vertex", "v", F.lit("open").alias("kind"), "own", F.explode(every("n_open")).alias("other"))
        mutual = mutual.select("vertex", "v", "kind", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        ahead = spread.filter("open").select("vertex", "v", F.lit("main").alias("kind"), F.col("own").alias("i"), F.explode(every("n_main")).alias("j"))
        behind = spread.filter("not open").select("vertex", "v", F.lit("main").alias("kind"), F.explode(every("n_open")).alias("i"), F.col("own").alias("j"))
        known = roots.select(F.col("vertex").alias("a"), F.col("root").alias("b"))
        roots = components(known.unionByName(compared(mutual.unionByName(ahead).unionByName(behind))))
    discard(shared, near, heavy, listed, apart, sets)  # the links are written

    place = nodes.select("digest", "vertex").join(roots, "vertex", "left").select("digest", F.coalesce("root", "vertex").alias("root"))
    # Empty sets, which have no digest, are linked with nothing and need no join.
    plain = base.select("doc_id", "n_shingles", "digest")
    out = plain.filter("digest is not null").join(place, "digest", "left").unionByName(plain.filter("digest is null").withColumn("root", F.lit(None).cast("long")))
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
