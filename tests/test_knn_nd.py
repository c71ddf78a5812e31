"""k-NN on several features against numpy over all pairs."""

import math
import random

import numpy as np
import pytest

from questa.operators import knn_nd


def brute(train, query, k):
    """train (id, x, y), query x -> mean y by (distance, id); None without."""
    ok = [(i, x, y) for i, x, y in train if all(v is not None and math.isfinite(v) for v in (*x, y if y is not None else math.nan))]
    if not ok or any(v is None or not math.isfinite(v) for v in query):
        return None
    near = sorted((sum((a - b) ** 2 for a, b in zip(x, query)), i, y) for i, x, y in ok)[:k]
    return sum(y for *_, y in near) / len(near)


def check(spark, train, queries, k, width):
    cols = ", ".join(f"x{j} double" for j in range(width))
    t = spark.createDataFrame([(i, *x, y) for i, x, y in train], f"id long, {cols}, y double").repartition(4)
    q = spark.createDataFrame([(n, *x) for n, x in enumerate(queries)], f"id long, {cols}").repartition(3)
    got = {r.id: r.pred for r in knn_nd.knn_regress(t, q, [f"x{j}" for j in range(width)], "y", "id", k).collect()}
    assert len(got) == len(queries)
    for n, x in enumerate(queries):
        want = brute(train, x, k)
        assert got[n] == (pytest.approx(want, rel=1e-12) if want is not None else None), (n, x)


@pytest.mark.parametrize("shells", [40, 100_000])
def test_matches_all_pairs_on_scattered_and_crowded_points(spark, monkeypatch, shells):
    monkeypatch.setattr(knn_nd, "SHELL_ROWS", shells)
    monkeypatch.setattr(knn_nd, "CHUNK_QUERIES", 50)
    rng = random.Random(3)
    train = [(i, tuple(rng.gauss(0, 10) for _ in range(3)), rng.random()) for i in range(400)]
    train += [(1000 + i, (1.0, 2.0, 3.0), rng.random()) for i in range(300)]            # one point for a third of all rows
    train += [(2000 + i, (50 + rng.random() / 100, 50.0, 50.0), rng.random()) for i in range(300)]  # a crowded cell
    train += [(3000, (None, 1.0, 1.0), 1.0), (3001, (1.0, math.nan, 1.0), 1.0), (3002, (1.0, 1.0, math.inf), 1.0),
              (3003, (1.0, 2.0, 3.0), None)]
    queries = [tuple(rng.gauss(0, 12) for _ in range(3)) for _ in range(120)] + [(1.0, 2.0, 3.0)] * 120
    queries += [(50.005, 50.0, 50.0)] * 60 + [(1e6, -1e6, 0.0), (None, 0.0, 0.0), (math.nan, 0.0, 0.0), (-0.0, 0.0, 0.0)]
    check(spark, train, queries, 5, 3)


def test_ties_go_to_the_smaller_id(spark):
    grid = [(float(a), float(b)) for a in range(12) for b in range(12)]
    rng = random.Random(4)
    ids = rng.sample(range(10_000), len(grid))
    check(spark, [(i, x, float(i)) for i, x in zip(ids, grid)], grid + [(a + 0.5, b + 0.5) for a, b in grid], 4, 2)


def test_few_or_no_training_rows(spark):
    check(spark, [(1, (0.0,), 2.0), (2, (5.0,), 4.0)], [(1.0,), (None,)], 5, 1)
    check(spark, [], [(1.0, 2.0)], 5, 2)
    check(spark, [(1, (0.0,), 2.0)], [], 5, 1)


def test_queries_reach_few_buckets():
    """The bounds leave out most cells of scattered points, and none that holds a neighbour."""
    rng = np.random.default_rng(0)
    points, pivots = rng.normal(size=(4000, 2)), rng.normal(size=(60, 2))
    d = np.sqrt(knn_nd.squared(points, pivots))
    cell = d.argmin(axis=1)
    b = knn_nd.Buckets(pivots, [[]] * 60, np.full(60, np.inf))
    for c in range(60):
        far = d[cell == c, c]
        b.least[c], b.largest[c] = (far.min(), far.max()) if len(far) else (np.inf, -np.inf)

    class Held:
        value = b
    import pyarrow as pa
    nth = np.sort(knn_nd.squared(points[:200], points), axis=1)[:, :5]
    near = pa.array([[{"d": v, "id": 0, "y": 0.0} for v in row] for row in nth],
                    pa.list_(pa.struct([("d", pa.float64()), ("id", pa.int64()), ("y", pa.float64())])))
    asked = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(points[:200].tolist()), pa.array(cell[:200].astype(np.int32)),
                                        pa.array(np.full(200, 1e9)), near], ["_k_row", "x", "bucket", "limit", "near"])
    visits = {(r, c) for out in knn_nd._others(Held, 5)(iter([asked])) for r, c in zip(out["_k_row"].to_pylist(), out["bucket"].to_pylist())}
    order = np.argsort(knn_nd.squared(points[:200], points), axis=1)[:, :5]
    for r in range(200):
        assert {(r, int(c)) for c in cell[order[r]] if c != cell[r]} <= visits
    assert len(visits) < 200 * 3


def test_work_per_query_does_not_grow_with_the_rows_of_a_bucket(monkeypatch):
    import pyarrow as pa
    cells, plain = [], knn_nd.squared

    def counted(a, b):
        cells.append(len(a) * len(b))
        return plain(a, b)
    monkeypatch.setattr(knn_nd, "squared", counted)
    rng = np.random.default_rng(1)
    at, asked = rng.normal(size=(20_000, 2)), rng.normal(size=(2000, 2))

    def batch(points, known):
        n = len(points)
        place = pa.array(np.arange(n))
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array(np.zeros(n, np.int32)), "chunk": pa.array(np.zeros(n, np.int32)), "known": [known] * n,
            "x": pa.array(points.tolist()), "id": place if known else pa.nulls(n, pa.int64()),
            "y": pa.array(points[:, 0]) if known else pa.nulls(n, pa.float64()),
            "_k_row": pa.nulls(n, pa.int64()) if known else place, "limit": pa.array(np.full(n, np.inf))})
    out = list(knn_nd._nearest(5)(iter([batch(at, True), batch(asked[:900], False), batch(asked[900:], False)])))
    got = [[r["id"] for r in near] for b in out for near in b["near"].to_pylist()]
    assert got == np.argsort(plain(asked, at), axis=1, kind="stable")[:, :5].tolist()
    assert sum(cells) < len(at) * len(asked) / 5


@pytest.mark.parametrize("box", [1, 4, 64])
@pytest.mark.parametrize("k", [1, 5, 90])
def test_boxes_leave_out_no_neighbour(monkeypatch, box, k):
    monkeypatch.setattr(knn_nd, "BOX_ROWS", box)
    monkeypatch.setattr(knn_nd, "FEW_BOXES", 2)
    monkeypatch.setattr(knn_nd, "GROUP_QUERIES", 7)
    monkeypatch.setattr(knn_nd, "CELLS", 500)
    rng = np.random.default_rng(2)
    grid = np.stack(np.meshgrid(np.arange(14.0), np.arange(14.0)), -1).reshape(-1, 2)  # many equal distances
    rows = rng.permutation(np.concatenate([grid, np.repeat(grid[:1], 40, axis=0), rng.normal(size=(60, 2)) * 1e6,
                                           [[1e200, -1e200], [0.0, 1e-300]]]))
    for at in (rows, rows[:3]):
        asked = np.concatenate([grid[::9], grid[:20] + 0.5, np.repeat(rows[:1], 30, axis=0), rng.normal(size=(20, 2)) * 1e6])
        with np.errstate(over="ignore"):
            d = knn_nd.squared(asked, at)
            for worst in (np.full(len(asked), np.inf), rng.choice([0.0, 1.0, 9.0, 1e12], len(asked))):
                row, col, dist = knn_nd.Boxes(at).nearest(asked, worst, k)
                for r in range(len(asked)):
                    order = np.argsort(d[r], kind="stable")[:k]
                    order = order[d[r, order] <= worst[r]]
                    assert col[row == r].tolist() == order.tolist() and dist[row == r].tolist() == d[r, order].tolist()
