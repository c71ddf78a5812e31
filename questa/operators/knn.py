"""Exact k-nearest-neighbour regression on one numeric feature (O-46).

In one dimension the k nearest training rows of a query are among the k just
left of it and the k at or right of it.  So one sort by (x, id) is enough:

1. The rows are range-partitioned and sorted by (x, id) into the shared
   checkpoint folder (``order.sorted_checkpoint``); rows that already come out
   of such a sort (row positions) are used as they are.
2. One pass reports at most 3k training rows of each partition (its first k,
   and the k nearest to its right end with and without its largest x).  From
   these the driver makes each partition's halo: the k training rows that
   follow it, and those before it that its queries can need.
3. One Arrow pass per partition finds every query's neighbours among its own
   rows and the halo by binary search and takes their mean.

Distance ties go to the smaller x, then the smaller id.  To the left of a query a
run of equal x counts from its smallest id, so the left halo holds the first
k rows of such a run, however many partitions it spans.  There are no pairs, no
join and one shuffle of the rows; a hot x is split by the id in the sort key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .order import sorted_checkpoint

_PID, _X, _Y = "_k_pid", "_k_x", "_k_y"
#: Queries handled at a time within a partition.
_CHUNK = 1 << 16
_SUMMARY = "pid int, target int, first boolean, at long, x double, y double"

Row = tuple[int, int, float, float]  # partition, place in it, x, y


def knn_regress_1d(train: DataFrame, query: DataFrame, x: str, y: str, id_col: str,
                   k: int = 5, out: str = "pred", partitions: int | None = None) -> DataFrame:
    """``query`` plus ``out`` = mean ``y`` of its ``k`` nearest training rows.

    ``id_col`` must be unique within ``train``.  Training rows whose x or y is
    null or NaN are left out; a query without x, or without any training row,
    gets a null prediction."""
    rows = (train.select(F.col(x).cast("double").alias("x"), F.col(id_col).alias("id"),
                         F.col(y).cast("double").alias("y"),
                         F.lit(None).cast(query.schema).alias("row"))
            .unionByName(query.select(F.col(x).cast("double").alias("x"), F.col(id_col).alias("id"),
                                      F.lit(None).cast("double").alias("y"),
                                      F.struct(*[query[c] for c in query.columns]).alias("row"))))
    ck = sorted_checkpoint(rows, ["x", "id"], partitions)
    done = knn_sorted(ck, "x", [("y", F.lit(True), "pred")], k).filter(F.col("row").isNotNull())
    return done.select("row.*", F.col("pred").alias(out))


def knn_sorted(rows: DataFrame, x: str, targets: Sequence[tuple[str, Column, str]],
               k: int = 5) -> DataFrame:
    """``rows`` plus, per target (y column, training-row condition, output
    column), the mean y of each row's ``k`` nearest training rows.

    ``rows`` must stand in (x, id) order over its partitions, as
    ``sorted_checkpoint`` or ``row_position`` leave them; this is checked."""
    ship_package(rows.sparkSession)
    tagged = rows.select("*", F.spark_partition_id().alias(_PID), F.col(x).cast("double").alias(_X),
                         *[F.when(cond, F.col(y).cast("double")).alias(f"{_Y}{i}")
                           for i, (y, cond, _) in enumerate(targets)])
    n = len(targets)
    ends = tagged.select(_PID, _X, *[f"{_Y}{i}" for i in range(n)]).mapInArrow(_ends(n, k), _SUMMARY)
    halos = rows.sparkSession.sparkContext.broadcast(_halos(ends.collect(), n, k))
    schema = T.StructType(rows.schema.fields + [T.StructField(o, T.DoubleType()) for _, _, o in targets])
    return tagged.mapInArrow(_predict(halos, [o for _, _, o in targets], k), schema)


def _columns(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def _doubles(table: pa.Table, name: str) -> np.ndarray:
    """A column with NaN for null."""
    return table[name].to_numpy().astype(np.float64)


def _nearest_left(xs: np.ndarray) -> np.ndarray:
    """Places in (x descending, id ascending) order."""
    return np.argsort(-xs, kind="stable")


def _ends(n: int, k: int):
    """The training rows of a partition that others can need, and its first
    and last x (target -1) for the check of the order."""
    def run(batches):
        table = _columns(batches)
        if table is None:
            return
        x, pid = _doubles(table, _X), table[_PID][0].as_py()
        rows = []
        seen = x[~np.isnan(x)]
        if len(seen):
            if np.any(np.diff(seen) < 0):
                raise ValueError("the rows are not sorted by x")
            rows += [(pid, -1, True, 0, seen[0], 0.0), (pid, -1, False, 0, seen[-1], 0.0)]
        for i in range(n):
            y = _doubles(table, f"{_Y}{i}")
            at = np.flatnonzero(~np.isnan(x) & ~np.isnan(y))
            if not len(at):
                continue
            xs = x[at]
            left = _nearest_left(xs)
            top = len(at) - int(np.searchsorted(xs, xs[-1], "left"))  # rows with the largest x
            last = np.unique(np.concatenate((left[:k], left[top:top + k])))
            for first, places in ((True, at[:k]), (False, at[last])):
                rows += [(pid, i, first, int(p), float(x[p]), float(y[p])) for p in places]
        names = [c.split()[0] for c in _SUMMARY.split(", ")]
        types = [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)] if rows else
                                         [pa.array([], t) for t in types], names)
    return run


def _trim(pool: list[Row], k: int) -> list[Row]:
    """Of rows in order: the k nearest to the right end, with and without the
    largest x."""
    near = sorted(pool, key=lambda r: (-r[2], r[0], r[1]))
    below = [r for r in near if r[2] < near[0][2]] if near else []
    return sorted({*near[:k], *below[:k]})


def _halos(ends, n: int, k: int) -> dict[int, list[tuple[list[Row], list[Row]]]]:
    """Per partition and target: the rows before and after it that its queries
    can need.  At most 3k rows of each partition come in."""
    span = {}
    for r in ends:
        if r.target < 0:
            span.setdefault(r.pid, [0.0, 0.0])[0 if r.first else 1] = r.x
    order = sorted(span)
    if any(span[a][1] > span[b][0] for a, b in zip(order, order[1:])):
        raise ValueError("the partitions are not in the order of x")
    halos = {p: [([], []) for _ in range(n)] for p in order}
    for i in range(n):
        first, last = {p: [] for p in order}, {p: [] for p in order}
        for r in ends:
            if r.target == i:
                (first if r.first else last)[r.pid].append((r.pid, r.at, r.x, r.y))
        before: list[Row] = []
        for p in order:
            halos[p][i] = (before, [])
            before = _trim(before + last[p], k)
        after: list[Row] = []
        for p in reversed(order):
            halos[p][i] = (halos[p][i][0], after)
            after = sorted(first[p] + after)[:k]
    return halos


def neighbour_means(xs: np.ndarray, ys: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
    """Mean y of the k nearest of the training rows (in (x, id) order) for
    each query x; NaN without x or training row."""
    m = len(xs)
    out = np.full(len(q), np.nan)
    if not m:
        return out
    left, steps = _nearest_left(xs), np.arange(k)
    for lo in range(0, len(q), _CHUNK):
        x = q[lo:lo + _CHUNK]
        r = np.searchsorted(xs, x, "left")
        right = r[:, None] + steps
        back = (m - r)[:, None] + steps
        cand = np.concatenate((np.where(right < m, right, m),
                               np.where(back < m, left[np.minimum(back, m - 1)], m)), axis=1)
        cand.sort(axis=1)  # (x, id) order; m stands for none and comes last
        d = np.abs(np.append(xs, np.nan)[cand] - x[:, None])
        near = np.take_along_axis(cand, np.argsort(d, axis=1, kind="stable")[:, :k], axis=1)
        mean = np.append(ys, 0.0)[near].sum(axis=1) / (near < m).sum(axis=1)
        out[lo:lo + _CHUNK] = np.where(np.isnan(x), np.nan, mean)
    return out


def _predict(halos, outs: list[str], k: int):
    def run(batches):
        table = _columns(batches)
        if table is None:
            return
        x = _doubles(table, _X)
        own = halos.value.get(table[_PID][0].as_py())
        done = table.select([c for c in table.column_names if not c.startswith("_k_")])
        for i, out in enumerate(outs):
            y = _doubles(table, f"{_Y}{i}")
            ok = ~np.isnan(x) & ~np.isnan(y)
            before, after = own[i] if own else ([], [])
            xs, ys = (np.concatenate(([r[c] for r in before], v[ok], [r[c] for r in after]))
                      for c, v in ((2, x), (3, y)))
            pred = neighbour_means(xs, ys, x, k)
            done = done.append_column(out, pa.array(pred, pa.float64(), mask=np.isnan(pred)))
        yield from done.to_batches(max_chunksize=_CHUNK)
    return run
