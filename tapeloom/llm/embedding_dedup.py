"""Near-duplicate vectors by a pivot-permutation index.

Reference points (pivots) are a bounded sample of the vectors. A vector is described by its nearest pivots in order;
vectors at a small angle have most of them in common. Inverted lists, one for each set of `width` pivots that a vector has
among its nearest, bring together vectors that share such a set; the number of pivots that two share must reach `need`;
then the cosine decides, in double precision.

Large groups of near copies never meet in lists. A pivot's ball holds the vectors that have it as nearest pivot and lie
within half the largest angle of a link: any two of them are linked, so a ball is counted, not compared. A vector's
angles to all pivots are known, and with the ball's radius say for each other ball whether all of its members are linked
with the vector, or none may be; only for what is between, members and vectors meet in blocks of bounded size. So
links with members of balls are found exactly, by the triangle inequality; what the index may miss are links between
two vectors outside of all balls. Lists of many such vectors are compared in blocks too, each pair in one list only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import discard, written
from tapeloom.llm.components import components

#: Radians by which sums of angles must clear a bound before they decide.
MARGIN = 1e-6
#: Vectors of one side of a compared block.
BLOCK = 1024
#: Pivots at most; the sample that they and the measured recall come from is no larger than twice this.
MOST_PIVOTS = 4096


@dataclass(frozen=True)
class Index:
    """pivots (a unit vector a row), the nearest of them that describe a vector, the pivots that name a list and those that a pair must share."""

    pivots: np.ndarray
    nearest: int
    width: int
    need: int


def unit_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """Which rows are vectors (not null, not zero, all components there and finite), and each as a double-precision unit vector."""
    out: list[np.ndarray | None] = []
    for i in range(len(column)):
        x = column[i]
        values = x.values if x.is_valid else None
        if values is None or values.null_count or not len(values):
            out.append(None)
            continue
        v = values.to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.abs(v).max()
        if not np.isfinite(v).all() or not top:
            out.append(None)
            continue
        v = v / top
        out.append(v / np.sqrt(v @ v) + 0.0)
    return np.array([x is not None for x in out], dtype=bool), out


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, units = unit_vectors(batch.column(1))
        raw = [None if u is None else u.tobytes() for u in units]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([0 if u is None else len(u) for u in units], pa.int32()), pa.array([None if r is None else hashlib.md5(r).digest() for r in raw], pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "dim", "point", "unit"]
        )


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.float64).reshape(len(rows), -1)


def apart(units: np.ndarray, most: int, cosine: float) -> np.ndarray:
    """The first `most` rows that lie below cosine to all rows chosen before."""
    chosen, n = np.empty((min(most, len(units)), units.shape[1])), 0
    for u in units:
        if n == most:
            break
        if not n or (chosen[:n] @ u).max() < cosine:
            chosen[n] = u
            n += 1
    return chosen[:n]


def described(index: Index, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines to all pivots, and the nearest pivots in order."""
    near = units @ index.pivots.T
    k = min(index.nearest, near.shape[1])
    some = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return near, np.take_along_axis(some, np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable"), 1)


def lists_of(index: Index, nearest: np.ndarray) -> np.ndarray:
    """The names of a vector's lists: all sets of `width` of its nearest pivots."""
    rising = np.sort(nearest, axis=1).astype(np.int64)
    names = [reduce(lambda a, i: a * MOST_PIVOTS + rising[:, i], c, np.zeros(len(rising), dtype=np.int64)) for c in combinations(range(rising.shape[1]), min(index.width, rising.shape[1]))]
    return np.stack(names, axis=1)


def measured_recall(index: Index, units: np.ndarray, cosine: float, seed: int = 3) -> float:
    """The share of units that have `need` pivots in common with a vector at exactly this cosine, in a random direction."""
    noise = np.random.default_rng(seed).normal(size=units.shape)
    noise -= (noise * units).sum(axis=1, keepdims=True) * units
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    far = cosine * units + math.sqrt(1 - cosine * cosine) * noise
    a, b = described(index, units)[1], described(index, far)[1]
    return float(np.mean([len(set(x) & set(y)) >= index.need for x, y in zip(a.tolist(), b.tolist(), strict=True)]))


def index_for(n: int, sample: np.ndarray, cosine: float, target_recall: float) -> Index:
    """An index for n vectors from a sample of them.

    width is the least for which at most MOST_PIVOTS pivots keep the mean list at four vectors or fewer, so the pairs grow in
    proportion to n. Then the fewest nearest pivots are taken with which target_recall is reached at the link's least cosine,
    measured on what the sample holds beside the pivots. Where no choice reaches it, the last one, which misses least, is taken.
    """
    for width in range(2, 7):
        pivots = 256
        while pivots < MOST_PIVOTS and n * math.comb(10, width) > 4 * math.comb(pivots, width):
            pivots *= 2
        if n * math.comb(10, width) <= 4 * math.comb(pivots, width):
            break
    chosen = apart(sample[: 2 * pivots], pivots, cosine)
    others = sample[2 * pivots :][:512]
    others = others if len(others) >= 50 else sample[-512:]
    dims = sample.shape[1]
    for nearest, need in [*((k, width + 1) for k in (8, 10, 12)), *((k, width) for k in (10, 12, 16, 20))]:
        index = Index(chosen, min(nearest, len(chosen)), width, need)
        if dims < 2 or measured_recall(index, others, cosine) >= target_recall:
            break
    return index


def _links(a: pa.Table | pa.RecordBatch, cosine: float) -> np.ndarray:
    return np.einsum("ij,ij->i", _matrix(a.column("ua")), _matrix(a.column("ub"))) >= cosine


_COUNTS = "point binary, n long, a long, b long"
_COUNTS_SCHEMA = pa.schema([("point", pa.binary()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _counts(points: list, n: list, a: list, b: list) -> pa.Table:
    """Rows that count links of a point, and rows that link two vertices."""
    return pa.table([pa.array(points + [None] * len(a), pa.binary()), pa.array(n + [None] * len(a), pa.int64()), pa.array([None] * len(n) + a, pa.int64()), pa.array([None] * len(n) + b, pa.int64())], schema=_COUNTS_SCHEMA)


def _meet(cosine: float):
    """One block of a ball's members and one of vectors that may be linked with some of them."""

    def run(table: pa.Table) -> pa.Table:
        inside = table.column("inside").to_numpy(zero_copy_only=False)
        x, z = table.filter(pa.array(~inside)), table.filter(pa.array(inside))
        if not len(x) or not len(z):
            return _counts([], [], [], [])
        near = _matrix(x.column("unit")) @ _matrix(z.column("unit")).T >= cosine
        found = near @ z.column("m").to_numpy()
        # Members of other balls ask for themselves; what is in none asks for both.
        lone = x.column("lone").to_numpy(zero_copy_only=False)
        back = near.T[:, lone] @ x.column("m").to_numpy()[lone]
        i, j = np.flatnonzero(found), np.flatnonzero(back)
        points = [*x.column("point").take(pa.array(i)).to_pylist(), *z.column("point").take(pa.array(j)).to_pylist()]
        ends = z.column("vertex").to_numpy()[near[i].argmax(axis=1)].tolist() if len(i) else []
        return _counts(points, [*found[i].tolist(), *back[j].tolist()], x.column("vertex").to_numpy()[i].tolist(), ends)

    return run


def _within_list(cosine: float):
    """One pair of blocks of a long list. A pair of vectors counts in the least of its common long lists."""

    def run(table: pa.Table) -> pa.Table:
        own, name = table.column("own").to_numpy(), table.column("list")[0].as_py()
        low, high = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        units, m, vertex = _matrix(table.column("unit")), table.column("m").to_numpy(), table.column("vertex").to_numpy()
        near = units @ units.T >= cosine
        np.fill_diagonal(near, False)
        if low != high:
            near &= own[:, None] != own[None, :]
        before = [[x for x in lists if x < name] for lists in table.column("hot").to_pylist()]
        names = {x: k for k, x in enumerate(sorted({x for row in before for x in row}))}
        if names:
            has = np.zeros((len(before), len(names)), dtype=np.float32)
            for row, lists in enumerate(before):
                has[row, [names[x] for x in lists]] = 1
            near &= has @ has.T == 0
        found = near @ m
        label = np.arange(len(near))
        for row in range(len(near)):
            old = np.unique(label[np.flatnonzero(near[row])])
            old = np.union1d(old, label[row])
            if len(old) > 1:
                label[np.isin(label, old)] = old[0]
        i, far = np.flatnonzero(found), np.flatnonzero(label != np.arange(len(label)))
        return _counts(table.column("point").take(pa.array(i)).to_pylist(), found[i].tolist(), vertex[far].tolist(), vertex[label[far]].tolist())

    return run


def _one_size(nodes: DataFrame, cosine: float, target_recall: float, list_limit: int) -> tuple[DataFrame, DataFrame]:
    """(point, n) and (a, b): links counted and links, for nodes (point, vertex, m, unit) of one length."""
    largest = math.acos(cosine)
    total = nodes.count()
    taken = nodes.orderBy(F.xxhash64("point"), "point").limit(2 * MOST_PIVOTS + 512).select("unit").toArrow()
    index = index_for(total, _matrix(taken.column("unit")), cosine, target_recall)
    half = math.cos(max(0.0, largest / 2 - MARGIN))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                part = batch.slice(k, BLOCK)
                near, nearest = described(index, _matrix(part.column("unit")))
                best = near[np.arange(len(near)), nearest[:, 0]]
                ball = best >= half
                lists = [x if not b else [] for x, b in zip(lists_of(index, nearest).tolist(), ball, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in ("point", "vertex", "m", "unit")), pa.array(nearest[:, 0], pa.int32(), mask=~ball), pa.array(np.arccos(np.minimum(best, 1.0))), pa.array(nearest.tolist(), pa.list_(pa.int32())), pa.array(lists, pa.list_(pa.int64()))],
                    ["point", "vertex", "m", "unit", "ball", "angle", "nearest", "lists"],
                )

    known = written(nodes.mapInArrow(describe, "point binary, vertex long, m long, unit binary, ball int, angle double, nearest array<int>, lists array<long>"), "described")
    balls = known.filter("ball is not null").groupBy("ball").agg(F.max("angle").alias("radius"), F.sum("m").alias("total"), F.min("vertex").alias("least"), F.count("*").alias("size"))
    rows = balls.collect()  # a row for each pivot at most
    n_pivots = len(index.pivots)
    radius, inside, least = np.full(n_pivots, -np.inf), np.zeros(n_pivots, dtype=np.int64), np.zeros(n_pivots, dtype=np.int64)
    for r in rows:
        radius[r["ball"]], inside[r["ball"]], least[r["ball"]] = r["radius"], r["total"], r["least"]

    def against_balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each vector and ball of others that is near enough: all of it (its members' count) or some of it (null)."""
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                part = batch.slice(k, BLOCK)
                angle = np.arccos(np.clip(_matrix(part.column("unit")) @ index.pivots.T, -1, 1))
                own = part.column("ball").fill_null(-1).to_numpy()
                possible = angle - radius[None, :] <= largest + MARGIN
                possible[np.flatnonzero(own >= 0), own[own >= 0]] = False
                row, ball = np.nonzero(possible)
                all_ = angle[row, ball] + radius[ball] <= largest - MARGIN
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x).take(at) for x in ("point", "vertex", "m", "unit")), pa.array(own[row] < 0), pa.array(ball.astype(np.int32)), pa.array(inside[ball], mask=~all_), pa.array(least[ball])],
                    ["point", "vertex", "m", "unit", "lone", "ball", "n", "least"],
                )

    touched = written(known.mapInArrow(against_balls, "point binary, vertex long, m long, unit binary, lone boolean, ball int, n long, least long"), "touched")
    counts, links = [], []
    # All of a ball: a number for the vector, and for vectors in no ball a number for every member of the ball.
    whole = touched.filter("n is not null")
    counts.append(whole.select("point", "n"))
    links.append(whole.select(F.col("vertex").alias("a"), F.col("least").alias("b")))
    extra = whole.filter("lone").groupBy("ball").agg(F.sum("m").alias("extra"))
    fixed = balls.join(extra, "ball", "left").select(F.col("ball").alias("of"), "least", (F.col("total") + F.coalesce("extra", F.lit(0))).alias("n"))
    members = known.filter("ball is not null").select("point", "vertex", "m", "unit", "ball").join(F.broadcast(fixed), F.col("ball") == F.col("of"))  # MOST_PIVOTS rows at most
    counts.append(members.select("point", (F.col("n") - F.col("m")).alias("n")))
    links.append(members.select(F.col("vertex").alias("a"), F.col("least").alias("b")))

    # Some of a ball: blocks of its members meet blocks of the vectors.
    asking = touched.filter("n is null")
    asked = {r["ball"]: r["count"] for r in asking.groupBy("ball").count().collect()}  # a row for each pivot at most
    if asked:
        sizes = {r["ball"]: r["size"] for r in rows}
        plan = nodes.sparkSession.createDataFrame([(b, -(-sizes[b] // BLOCK), -(-n // BLOCK)) for b, n in asked.items()], "of int, n_inside int, n_asking int")
        block = lambda n: F.pmod(F.xxhash64("point"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        sides = []
        for side, own, other, is_in in ((members.select("point", "vertex", "m", "unit", F.lit(False).alias("lone"), "ball"), "n_inside", "n_asking", True), (asking.select("point", "vertex", "m", "unit", "lone", "ball"), "n_asking", "n_inside", False)):
            dealt = side.join(F.broadcast(plan), F.col("ball") == F.col("of")).withColumn("own", block(own)).withColumn("other", every(other))
            i, j = ("own", "other") if is_in else ("other", "own")
            sides.append(dealt.select("point", "vertex", "m", "unit", "lone", "ball", F.lit(is_in).alias("inside"), F.col(i).alias("i"), F.col(j).alias("j")))
        met = written(sides[0].unionByName(sides[1]).groupBy("ball", "i", "j").applyInArrow(_meet(cosine), _COUNTS), "met")
        counts.append(met.filter("point is not null").select("point", "n"))
        links.append(met.filter("point is null").select("a", "b"))

    # Vectors in no ball: inverted lists.
    lone = known.filter("ball is null")
    posted = written(lone.select("point", F.explode("lists").alias("list")), "posted")
    lengths = posted.groupBy("list").agg(F.count("*").alias("size")).filter("size > 1")
    posted = posted.join(lengths, "list")
    plain = posted.filter(F.col("size") <= list_limit)
    pairs = plain.select("list", F.col("point").alias("pa")).join(plain.select("list", F.col("point").alias("pb")), "list").filter("pa < pb")
    pairs = pairs.groupBy("pa", "pb").agg(F.count("*").alias("shared")).filter(F.col("shared") >= math.comb(index.need, index.width))
    hot = written(posted.filter(F.col("size") > list_limit), "hot")
    if not hot.isEmpty():
        names = hot.groupBy("point").agg(F.sort_array(F.collect_set("list")).alias("hot"))  # no more than a vector has lists
        lone = lone.join(names, "point", "left")
        blocks = hot.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
        dealt = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("point", "list", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        met = written(dealt.join(lone.select("point", "vertex", "m", "unit", "hot"), "point").groupBy("list", "i", "j").applyInArrow(_within_list(cosine), _COUNTS), "met")
        counts.append(met.filter("point is not null").select("point", "n"))
        links.append(met.filter("point is null").select("a", "b"))
    else:
        lone = lone.withColumn("hot", F.array().cast("array<long>"))
    side = lambda x: lone.select(F.col("point").alias(f"p{x}"), F.col("vertex").alias(f"v{x}"), F.col("m").alias(f"m{x}"), F.col("unit").alias(f"u{x}"), F.col("hot").alias(f"h{x}"))
    met = pairs.join(side("a"), "pa").join(side("b"), "pb").filter(~F.coalesce(F.arrays_overlap("ha", "hb"), F.lit(False)))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(_links(batch, cosine))).select(["pa", "va", "ma", "pb", "vb", "mb"])

    proven = written(met.select("pa", "va", "ma", "ua", "pb", "vb", "mb", "ub").mapInArrow(verify, "pa binary, va long, ma long, pb binary, vb long, mb long"), "proven")
    counts += [proven.select(F.col("pa").alias("point"), F.col("mb").alias("n")), proven.select(F.col("pb").alias("point"), F.col("ma").alias("n"))]
    links.append(proven.select(F.col("va").alias("a"), F.col("vb").alias("b")))
    summed = written(reduce(DataFrame.unionByName, counts).groupBy("point").agg(F.sum("n").alias("n")), "link-counts")
    edges = written(reduce(DataFrame.unionByName, links), "vector-links")
    discard(touched, hot)
    return summed, edges


def near_vectors(vectors: DataFrame, cosine: float = 0.9, target_recall: float = 0.95, list_limit: int = 256) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of vectors (vec_id, embedding): links join vectors whose cosine is at least `cosine`.

    n_links counts the other rows that are linked directly, copies included; component_id is the least vec_id that can be
    reached over links, kept says whether that is the row's own. Every found link is verified in double precision or follows
    from the triangle inequality with a margin of a millionth of a radian. Other columns are not read.

    Every row is indexed. A sample of at most 2 * MOST_PIVOTS + 512 different vectors, those with the least hash, gives the pivots
    and the measured recall; with fewer vectors than that all of them. Links with members of balls are all found; of those
    between two vectors outside of balls at least target_recall at the least cosine, more above it, where index_for() could
    reach that.

    Defined results: null, empty and zero vectors and those with null or non-finite components are linked with nothing;
    vectors of different lengths are not linked; rows with equal vectors are one vertex and count as linked with each other;
    a null vec_id is linked with nothing, its component_id is null and it is kept; of rows that repeat a vec_id each takes the
    links of its own vector; an empty table gives none.
    """
    rows = written(vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_points, "vec_id long, dim int, point binary, unit binary"), "points")
    nodes = written(rows.filter("point is not null and vec_id is not null").groupBy("dim", "point").agg(F.min("vec_id").alias("vertex"), F.count("*").alias("m"), F.first("unit").alias("unit")), "vertices")
    found = [_one_size(nodes.filter(F.col("dim") == d).drop("dim"), cosine, target_recall, list_limit) for (d,) in nodes.select("dim").distinct().collect()]
    plain = rows.select("vec_id", "point")
    if not found:
        return plain.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = reduce(DataFrame.unionByName, [c for c, _ in found])
    roots = components(reduce(DataFrame.unionByName, [e for _, e in found]))
    place = nodes.select("point", "vertex", "m").join(counts, "point", "left").join(roots, "vertex", "left")
    place = place.select(F.col("point").alias("own"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("root", "vertex").alias("component_id"))
    # Rows that are no vectors have no point and need no join.
    is_vector = F.col("point").isNotNull() & F.col("vec_id").isNotNull()
    linked = plain.filter(is_vector).join(place, F.col("point") == F.col("own")).select("vec_id", "n_links", "component_id")
    bare = plain.filter(~is_vector).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(bare).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
