"""Near-duplicate vectors against brute force."""

import math

import numpy as np
import pytest

from tapeloom.llm import embedding_dedup as ed


def near(rng, u, cosine, n):
    """n unit vectors at this cosine from u, in random directions."""
    noise = rng.normal(size=(n, len(u)))
    noise -= (noise @ u)[:, None] * u
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return cosine * u + math.sqrt(1 - cosine * cosine) * noise


def unit(rng, n, dim):
    x = rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def brute_links(vectors, cosine):
    u = np.array([v / np.linalg.norm(v) for v in np.asarray(vectors, dtype=np.float64)])
    links = u @ u.T >= cosine
    np.fill_diagonal(links, False)
    return links


def brute_components(links):
    root = np.arange(len(links))
    while True:
        new = np.array([min(root[i], *root[links[i]]) if links[i].any() else root[i] for i in range(len(links))])
        if (new == root).all():
            return root
        root = new


def run(spark, vectors, **more):
    rows = [(i, [float(x) for x in v], 3, b"x") for i, v in enumerate(vectors)]
    got = sorted(ed.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, point binary"), **more).collect())
    assert [r.vec_id for r in got] == list(range(len(rows)))
    return np.array([r.n_links for r in got]), np.array([r.component_id for r in got]), [r.kept for r in got]


def test_groups_balls_and_borderline_links(spark):
    """Tight groups, groups with radii at which only some of two balls is linked, chains, copies, and vectors by themselves."""
    rng = np.random.default_rng(1)
    parts = [unit(rng, 700, 24)]
    for base, c, n in zip(unit(rng, 12, 24), [0.999, 0.99, 0.98, 0.97, 0.96, 0.95, 0.95, 0.93, 0.93, 0.91, 0.9, 0.9], [150, 90, 60, 60, 60, 40, 40, 30, 20, 20, 10, 10], strict=True):
        parts.append(near(rng, base, c, n))
    step = unit(rng, 1, 24)[0]
    for _ in range(20):
        step = near(rng, step, 0.93, 1)[0]
        parts.append(step[None, :])
    parts.append(np.repeat(parts[1][:1], 30, axis=0))
    vectors = np.vstack(parts)
    vectors = (vectors[rng.permutation(len(vectors))] * rng.uniform(0.1, 50, (len(vectors), 1))).astype(np.float32)
    links = brute_links(vectors, 0.9)
    n, component, kept = run(spark, vectors)
    assert (n <= links.sum(axis=1)).all()  # none below the threshold
    assert n.sum() >= 0.97 * links.sum()
    want = brute_components(links)
    assert (component >= want).all() and (component == want).mean() > 0.97
    assert kept == (component == np.arange(len(vectors))).tolist()


@pytest.mark.parametrize("limit", [3, 256])
def test_long_lists_in_blocks(spark, limit, monkeypatch):
    """Without balls, links come from lists alone: from pairs, or from blocks where lists are long; each link counts once."""
    monkeypatch.setattr(ed, "MARGIN", 1.0)  # no vector is that near to a pivot, none is sure of a whole ball
    monkeypatch.setattr(ed, "BLOCK", 64)
    rng = np.random.default_rng(2)
    vectors = np.vstack([unit(rng, 300, 16), *(near(rng, b, 0.97, 60) for b in unit(rng, 5, 16))])
    links = brute_links(vectors, 0.9)
    n, component, _ = run(spark, vectors, list_limit=limit)
    assert (n <= links.sum(axis=1)).all()
    assert n.sum() >= 0.97 * links.sum()
    assert (component == brute_components(links)).mean() > 0.98


def test_measured_recall_meets_its_target():
    rng = np.random.default_rng(4)
    for n, dim in ((3_000, 64), (3_000, 12), (400, 64)):
        sample = unit(rng, n, dim)
        index = ed.index_for(1_000_000, sample, 0.9, 0.95)
        fresh = unit(rng, 2000, dim)
        assert ed.measured_recall(index, fresh, 0.9, seed=9) >= 0.93
        assert ed.measured_recall(index, fresh, 0.95, seed=9) >= 0.97


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [0.0, -3.0]), (11, [1e30, 1e-30]), (None, [1.0, 0.0]), (12, [-0.0, -1e-30]), (2, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in ed.near_vectors(df).collect()), key=str)
    want = [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (11, 3, 1, False), (10, 1, 10, True), (12, 1, 10, False), (None, 0, None, True), *((i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9))]
    assert got == sorted(want, key=str)
    assert ed.near_vectors(df.limit(0)).collect() == []
    assert ed.near_vectors(df.filter("vec_id = 3")).collect() == [(3, 0, 3, True)]
