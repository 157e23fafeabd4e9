"""Whitening and exact search against brute force."""

import math
from fractions import Fraction

import numpy as np
import pytest

from plantlake.llm import voronoi_join, whitening
from plantlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, rank int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA).repartition(3)


def awkward(size=6, n=150):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.3, size).astype(np.float32).tolist()) for i in range(n)]
    rows += [(20, rows[3][1]), (None, rows[5][1]), (None, rows[5][1]), (300, rows[0][1]), (301, rows[0][1]), (302, None), (303, []), (304, [1.0, None] + [0.0] * (size - 2)),
             (305, [NAN] + [0.0] * (size - 1)), (306, [-INF] + [0.0] * (size - 1)), (307, [0.5] * (size - 1)), (-20, rows[2][1]), (320, [0.0] * size)]
    return rows


def fit_for(rows, size):
    return [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]


def check_whitening(got, rows, size, components=8):
    used = fit_for(rows, size)
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in used], object)
    n, sums = len(x), x.sum(axis=0)
    centred = n * x - sums
    want = sorted((str(i), n, int(sum(d * d for d in row))) for (i, _), row in zip(used, centred))
    for c in range(1, min(components, size) + 1):
        assert sorted((str(r.vec_id), r.n, int(r.deviation)) for r in got if r.component == c) == want
    assert len(got) == n * min(components, size)
    cov = np.array([[float(Fraction(int(a @ b), n ** 3)) for b in centred.T] for a in centred.T])
    values, vectors = np.linalg.eigh(cov)
    return values[::-1], vectors[:, ::-1], centred.astype(float) / n


def test_whitening(spark):
    rows, size = awkward(), 6
    got = whitening.whitened(frame(spark, rows)).collect()
    values, vectors, flat = check_whitening(got, rows, size)
    for c in range(size):
        own = flat @ vectors[:, c] / math.sqrt(values[c])
        mine = np.array(sorted(r.whitened for r in got if r.component == c + 1))
        assert np.allclose(mine, np.sort(own), atol=1e-9) or np.allclose(mine, np.sort(-own), atol=1e-9)
        assert {round(r.explained, 9) for r in got if r.component == c + 1} == {round(values[c] / values.sum(), 9)}
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_of_little(spark):
    """One row, constant columns, no rows, huge entries."""
    got = whitening.whitened(frame(spark, [(1, [0.5, 0.25])])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(got, key=lambda r: r.component)] == [
        (1, 1, 1, 0, None, None, None), (1, 2, 1, 0, None, None, None)]
    flat = whitening.whitened(frame(spark, [(k, [0.1 * k, 3.0]) for k in range(5)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and flat[0].identity_error < 1e-9
    assert whitening.whitened(frame(spark, [(1, None), (2, [])])).count() == 0
    huge = [(1, [3e38, 1.0]), (2, [-3e38, 1.0]), (3, [1e12, 2.0]), (4, [1e15, -7.0])]
    big = whitening.whitened(frame(spark, huge), scale=1).collect()
    x = [[max(min(math.floor(np.float32(c)), 1 << 62), -(1 << 62)) + 100000 for c in v] for _, v in huge]
    sums = [sum(c) for c in zip(*x)]
    want = {i + 1: sum((4 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in big} == {k: v if v < 10 ** 38 else None for k, v in want.items()}


@pytest.mark.parametrize("spread", [1, 1000, 1 << 40, (1 << 62) - 1])
def test_scatter(spread):
    rng = np.random.default_rng(1)
    x = rng.integers(-spread, spread, (130, 3))
    n, sums, products = whitening.scatter([x[:70], x[70:]], 3)
    wide = x.astype(object)
    assert n == 130 and sums.tolist() == wide.sum(axis=0).tolist() and products.tolist() == np.triu(wide.T @ wide).tolist()


def brute_search(rows, size, k, every=20, scale=64):
    used = [(i, tuple(math.floor(scale * np.float64(np.float32(c))) for c in v)) for i, v in fit_for(rows, size)]
    queries = {}
    for i, v in used:
        if i is not None and i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = set()
    for q, v in queries.items():
        best = sorted((-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for i, w in used if i != q)[:k]
        out |= {(q, rank + 1, None if missing else i, -s) for rank, (s, missing, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("pivots, slices", [(1, 4_000_000), (5, 60), (40, 4_000_000)])
def test_search(spark, monkeypatch, pivots, slices):
    monkeypatch.setattr(voronoi_join, "SLICE", slices)
    monkeypatch.setattr(voronoi_join, "BLOCK_BYTES", 96)
    rows = awkward()
    got = [tuple(r) for r in voronoi_join.nearest(frame(spark, rows), k=7, pivots=pivots).collect()]
    assert set(got) == brute_search(rows, 6, 7) and len(got) == len(set(got))


def test_search_of_little(spark):
    assert voronoi_join.nearest(frame(spark, [])).count() == 0
    assert voronoi_join.nearest(frame(spark, [(1, [1.0]), (None, [2.0])])).count() == 0
    assert [tuple(r) for r in voronoi_join.nearest(frame(spark, [(0, [1.0]), (1, [2.0])])).collect()] == [(0, 1, 1, 64 * 128)]
    assert voronoi_join.nearest(frame(spark, [(0, [1.0])])).count() == 0
    huge = [(0, [3e38, -3e38]), (20, [1e30, 1.0]), (3, [-2e38, 5.0])]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in voronoi_join.nearest(frame(spark, huge)).collect()}
    assert got == {(0, 1): (20, (1 << 63) - 1), (0, 2): (3, -(1 << 63)), (20, 1): (0, (1 << 63) - 1), (20, 2): (3, -(1 << 63))}


def test_search_copies(spark):
    """Most rows are one vector, and one id has many rows."""
    rng = np.random.default_rng(2)
    rows = [(i, [0.5, 0.5, -0.25]) for i in range(400)] + [(400 + i, rng.normal(0, 1, 3).astype(np.float32).tolist()) for i in range(200)]
    rows += [(0, rng.normal(0, 1, 3).astype(np.float32).tolist()) for _ in range(300)]
    got = {tuple(r) for r in voronoi_join.nearest(frame(spark, rows), k=20, pivots=4).collect()}
    assert got == brute_search(rows, 3, 20)


def test_search_prunes_clusters(spark, monkeypatch):
    """With clusters, vectors that no query of a cell can want stay out of its tasks."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (8, 16))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    rows = [(i, (10 * centres[i % 8] + rng.normal(0, 0.02, 16)).astype(np.float32).tolist()) for i in range(800)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    seen = {}
    real = voronoi_join.summarised
    monkeypatch.setattr(voronoi_join, "summarised", lambda *a: seen.setdefault("cells", real(*a)))
    got = {tuple(r) for r in voronoi_join.nearest(data, k=5, pivots=32).collect()}
    assert got == brute_search(rows, 16, 5)
    cells, x = seen["cells"], np.floor(64 * np.array([v for _, v in rows]))
    live = np.flatnonzero(cells.queries)
    kept = sum((cells.most(i, x) >= cells.floors[i]).sum() for i in live)
    assert kept < 0.5 * len(live) * len(x) and not cells.reachable()[live].all()


def test_given_tables(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op11_whitening"](spark, SF).collect()
    check_whitening(got, rows, len(rows[0][1]))
    assert got[0].identity_error <= 1e-4
    assert {tuple(r) for r in QUERIES["op12_voronoi_join"](spark, SF).collect()} == brute_search(rows, len(rows[0][1]), 20)
