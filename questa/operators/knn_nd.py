"""Exact k-nearest-neighbour regression on several numeric features (O-46b).

Euclidean distance, ties by the smaller id.  There is no table of pairs:

1. Of rows at one point only the k smallest ids can ever be neighbours; the
   others go first (limited in every partition before the shuffle), so copies
   of a point cost nothing.
2. At most MAX_PIVOTS training points, drawn by a hash of the id, are pivots.  Every row
   belongs to the cell of its nearest pivot.  A cell of more than SHELL_ROWS
   rows is cut into shells by the distance from its pivot; a cell or shell is a
   *bucket* with a least and a largest such distance.
3. Each query first meets the training rows of its own bucket.  The k-th
   distance found, or a bound by the pivots if there are fewer than k, is the
   radius of what can still be better.  A task lays a bucket's rows into boxes
   of at most BOX_ROWS, and a group of near queries looks only into the boxes
   that its radius reaches, so a fuller bucket costs a query hardly more.
4. By the triangle inequality, and by the plane between two pivots, a
   query is copied only to those other buckets that its radius can reach.
5. Of a query's candidates, at most k from every bucket it met, the k nearest
   are averaged.

A bucket's queries are dealt out in chunks of CHUNK_QUERIES, so neither a crowded
cell nor a point that a third of all queries share falls to one task.  The driver
holds the pivots and one line per bucket; SHELL_ROWS grows with the table once
there would be more than MAX_BUCKETS.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package

MAX_PIVOTS = 512
SHELL_ROWS = 100_000
MAX_BUCKETS = 200_000
CHUNK_QUERIES = 500_000
#: Distances worked out at a time.
CELLS = 1 << 21
#: Rows of a box, queries that look for boxes together, and boxes that they meet without a closer look.
BOX_ROWS = 64
GROUP_QUERIES = 64
FEW_BOXES = 16
#: Room for rounding in the bounds, in parts of the lengths compared.
SLACK = 1e-9


def knn_regress(train: DataFrame, query: DataFrame, xs: Sequence[str], y: str, id_col: str, k: int = 5,
                out: str = "pred") -> DataFrame:
    """``query`` plus ``out`` = mean ``y`` of its ``k`` nearest training rows by
    the features ``xs``.

    ``id_col`` must be unique within ``train``.  Training rows with a feature or
    y that is null, NaN or infinite are left out; a query with such a feature, or without any
    training row, gets a null prediction.  Repeated queries get a row each.  With
    fewer than ``k`` training rows all of them count."""
    spark = train.sparkSession
    ship_package(spark)
    point = lambda df: F.array(*[df[c].cast("double") + F.lit(0.0) for c in xs])
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    usable = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    first = W.partitionBy("x").orderBy("id")
    known = (train.select(point(train).alias("x"), train[id_col].alias("id"), train[y].cast("double").alias("y"))
             .filter(usable & finite("y")).withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k).drop("n"))
    known = materialize(known)
    n = known.count()
    asked = materialize(query.withColumn("_k_row", F.monotonically_increasing_id()))
    if not n:
        return asked.drop("_k_row").withColumn(out, F.lit(None).cast("double"))
    pivots = _pivots(known, min(MAX_PIVOTS, isqrt(n) // 2 + 1, max(1, n // k)))
    placed = materialize(known.mapInArrow(_place(pivots), T.StructType(
        known.schema.fields + [T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())])))
    buckets = _buckets(placed, pivots, max(SHELL_ROWS, n // MAX_BUCKETS + 1), k)
    rows = materialize(placed.mapInArrow(_bucket(spark.sparkContext.broadcast(buckets)), T.StructType(
        [*known.schema.fields, T.StructField("far", T.DoubleType()), T.StructField("bucket", T.IntegerType())])))
    for r in rows.groupBy("bucket").agg(F.min("far").alias("a"), F.max("far").alias("b")).collect():
        buckets.least[r.bucket], buckets.largest[r.bucket] = r.a, r.b
    held = spark.sparkContext.broadcast(buckets)

    questions = asked.select("_k_row", point(asked).alias("x")).filter(usable)
    near = T.ArrayType(T.StructType([T.StructField("d", T.DoubleType()), T.StructField("id", known.schema["id"].dataType),
                                     T.StructField("y", T.DoubleType())]))
    ask = T.StructType([T.StructField("_k_row", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType())),
                        T.StructField("bucket", T.IntegerType()), T.StructField("limit", T.DoubleType())])
    found = T.StructType([*ask.fields, T.StructField("near", near)])
    own = materialize(_meet(rows, questions.mapInArrow(_own(held), ask), found, k))
    more = _meet(rows, own.mapInArrow(_others(held, k), ask), found, k)
    best = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
    done = (own.select("_k_row", "near").unionByName(more.select("_k_row", "near")).groupBy("_k_row")
            .agg(best.alias("near")).select("_k_row", (F.aggregate("near", F.lit(0.0), lambda a, r: a + r["y"])
                                                       / F.size("near")).alias(out)))
    return asked.join(done, "_k_row", "left").drop("_k_row")


def _pivots(known: DataFrame, count: int) -> np.ndarray:
    """``count`` training points, whatever the partitioning."""
    rows = known.select("x", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(count).collect()
    return np.unique(np.array([r.x for r in rows], np.float64), axis=0)


def _points(batch, width: int) -> np.ndarray:
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and ``b``; each cell is summed in
    the order of the features, so it is the same in every block."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def _sliced(batches, cells_per_row: int):
    step = max(1, CELLS // max(cells_per_row, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _place(pivots):
    def run(batches):
        for batch in _sliced(batches, len(pivots)):
            d = squared(_points(batch, pivots.shape[1]), pivots)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(np.sqrt(d[np.arange(len(d)), cell]))],
                [*batch.schema.names, "cell", "far"])
    return run


class Buckets:
    """Pivots, where the shells of each cell are cut, and per bucket its cell
    and the least and largest distance from its pivot (empty: least > largest).
    ``kth``: within this distance of the pivot are k rows of the cell."""

    def __init__(self, pivots: np.ndarray, cuts: list[list[float]], kth: np.ndarray):
        self.pivots, self.cuts, self.kth = pivots, [np.array(c) for c in cuts], kth
        self.first = np.concatenate(([0], np.cumsum([len(c) + 1 for c in cuts]))).astype(np.int64)
        self.cell = np.repeat(np.arange(len(cuts)), np.diff(self.first))
        self.least, self.largest = np.full(self.first[-1], np.inf), np.full(self.first[-1], -np.inf)
        self.apart = np.sqrt(squared(pivots, pivots))

    def of(self, cell: np.ndarray, far: np.ndarray) -> np.ndarray:
        out = self.first[cell]
        for c in np.unique(cell):
            if len(self.cuts[c]):
                of = cell == c
                out[of] += np.searchsorted(self.cuts[c], far[of], "left")
        return out


def _buckets(placed: DataFrame, pivots: np.ndarray, shell_rows: int, k: int) -> Buckets:
    counts = {r.cell: r.n for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = -(-max(counts.values()) // shell_rows)
    cuts: list[list[float]] = [[] for _ in pivots]
    if most > 1:
        shares = [i / most for i in range(1, most)]
        for r in placed.groupBy("cell").agg(F.percentile_approx("far", shares, 100 * most).alias("at")).collect():
            shells = -(-counts[r.cell] // shell_rows)
            cuts[r.cell] = sorted({r.at[most * i // shells - 1] for i in range(1, shells)})
    inner = W.partitionBy("cell").orderBy("far")
    kth = np.full(len(pivots), np.inf)
    for r in (placed.select("cell", "far", F.row_number().over(inner).alias("n")).filter(F.col("n") <= k)
              .groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect()):
        if r.n == k:
            kth[r.cell] = r.far
    buckets = Buckets(pivots, cuts, kth)
    return buckets


def _bucket(held):
    def run(batches):
        for batch in batches:
            cell = batch["cell"].to_numpy().astype(np.int64)
            bucket = held.value.of(cell, batch["far"].to_numpy())
            kept = [c for c in batch.schema.names if c != "cell"]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(bucket.astype(np.int32))], [*kept, "bucket"])
    return run


def _asked(batch, rows: np.ndarray, bucket: np.ndarray, limit: np.ndarray):
    rows = pa.array(rows)
    return pa.RecordBatch.from_arrays([batch["_k_row"].take(rows), batch["x"].take(rows), pa.array(bucket.astype(np.int32)),
                                       pa.array(limit)], ["_k_row", "x", "bucket", "limit"])


def _own(held):
    """Every query with the bucket it falls into, and the radius that pivots
    alone allow."""
    def run(batches):
        b = held.value
        for batch in _sliced(batches, len(b.pivots)):
            d = np.sqrt(squared(_points(batch, b.pivots.shape[1]), b.pivots))
            cell = d.argmin(axis=1)
            yield _asked(batch, np.arange(len(d)), b.of(cell, d[np.arange(len(d)), cell]), (d + b.kth).min(axis=1))
    return run


def _others(held, k: int):
    """Every query once for each other bucket that its radius reaches."""
    def run(batches):
        b = held.value
        least, largest = np.minimum.reduceat(b.least, b.first[:-1]), np.maximum.reduceat(b.largest, b.first[:-1])
        shells = np.diff(b.first)
        for batch in _sliced(batches, len(b.pivots)):
            d = np.sqrt(squared(_points(batch, b.pivots.shape[1]), b.pivots))
            rows = np.arange(len(d))
            limit = batch["limit"].to_numpy().copy()
            sizes = np.diff(batch["near"].offsets.to_numpy())
            full = sizes == k
            last = batch["near"].flatten().field("d").to_numpy()[np.cumsum(sizes)[full] - 1]
            limit[full] = np.minimum(limit[full], np.sqrt(last))
            mine = d.argmin(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (d ** 2 - d[rows, mine][:, None] ** 2) / (2 * b.apart[mine])
            plane[rows, mine] = 0
            reach = limit[:, None] + SLACK * (d + limit[:, None] + np.maximum(largest, 0))
            at, cell = np.nonzero((plane - SLACK * (d + b.apart[mine]) <= reach) & (d - largest <= reach) & (least - d <= reach))
            far, reach = d[at, cell], reach[at, cell]
            each = np.repeat(np.arange(len(at)), shells[cell])  # the shells of the cells that are reached
            bucket = np.arange(len(each)) - np.repeat(np.cumsum(shells[cell]) - shells[cell] - b.first[cell], shells[cell])
            at, far, reach = at[each], far[each], reach[each]
            ok = (far - b.largest[bucket] <= reach) & (b.least[bucket] - far <= reach) & (bucket != batch["bucket"].to_numpy()[at])
            at, bucket = at[ok], bucket[ok]
            for lo in range(0, len(at), 1 << 16):
                some = slice(lo, lo + (1 << 16))
                yield _asked(batch, at[some], bucket[some], limit[at[some]])
    return run


def _meet(rows: DataFrame, asked: DataFrame, found: T.StructType, k: int) -> DataFrame:
    """Queries with up to ``k`` nearest rows of their bucket."""
    asked = materialize(asked)
    many = asked.groupBy("bucket").count().filter(F.col("count") > CHUNK_QUERIES)
    chunks = many.select("bucket", F.ceil(F.col("count") / CHUNK_QUERIES).cast("int").alias("chunks"))
    nothing = F.lit(None)
    left = rows.join(F.broadcast(chunks), "bucket", "left").select(  # one line per CHUNK_QUERIES queries at most
        "bucket", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)).alias("chunk"),
        F.lit(True).alias("known"), "x", "id", "y", nothing.cast("long").alias("_k_row"), nothing.cast("double").alias("limit"))
    right = asked.join(F.broadcast(chunks), "bucket", "left").select(
        "bucket", F.pmod(F.xxhash64("_k_row"), F.coalesce("chunks", F.lit(1))).cast("int").alias("chunk"),
        F.lit(False).alias("known"), "x", nothing.cast(rows.schema["id"].dataType).alias("id"),
        nothing.cast("double").alias("y"), "_k_row", "limit")
    both = left.unionByName(right).repartition("bucket", "chunk").sortWithinPartitions("bucket", "chunk", F.desc("known"), "id")
    return both.mapInArrow(_nearest(k), found)


def _nearest(k: int):
    def run(batches):
        key, parts, table, boxes = None, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            width = len(batch["x"][0])
            bucket, chunk = (batch[c].to_numpy().astype(np.int64) for c in ("bucket", "chunk"))
            known = batch["known"].to_numpy(zero_copy_only=False)
            step = (np.diff(bucket) != 0) | (np.diff(chunk) != 0) | (np.diff(known.astype(np.int8)) != 0)
            edges = [0, *(np.flatnonzero(step) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                part = batch.slice(lo, hi - lo)
                if (bucket[lo], chunk[lo]) != key:
                    key, parts, table, boxes = (bucket[lo], chunk[lo]), [], None, None
                if known[lo]:
                    parts.append(part.select(["x", "id", "y"]))
                    continue
                if parts and boxes is None:
                    table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    boxes = Boxes(_points(table, width))
                yield _k_nearest(part, boxes, table, k, width)
    return run


def _halves(points: np.ndarray, most: int) -> list[np.ndarray]:
    """The places of ``points`` in parts of near ones: halved along the longest
    side until a part has at most ``most`` (and, if it was halved, no less than
    half as many)."""
    left, out = [np.arange(len(points))], []
    while left:
        rows = left.pop()
        if len(rows) <= most:
            out.append(rows)
            continue
        some = points[rows]
        half = len(rows) // 2
        order = np.argpartition(some[:, np.argmax(some.max(axis=0) - some.min(axis=0))], half)
        left += [rows[order[:half]], rows[order[half:]]]
    return out


class Boxes:
    """A bucket's rows (in the order of their ids) laid into boxes of near ones."""

    def __init__(self, at: np.ndarray):
        parts = _halves(at, BOX_ROWS)
        self.rows, self.at = np.concatenate(parts), at[np.concatenate(parts)]
        self.first = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        self.least, self.largest = (f.reduceat(self.at, self.first[:-1], axis=0) for f in (np.minimum, np.maximum))

    def gaps(self, points: np.ndarray) -> np.ndarray:
        """Per box no more than the squared distance of any of its rows to any of
        ``points``, also as rounded: summed as in :func:`squared`."""
        low, high = points.min(axis=0), points.max(axis=0)
        out = np.zeros(len(self.least))
        for j in range(points.shape[1]):
            out += np.maximum(np.maximum(self.least[:, j] - high[j], low[j] - self.largest[:, j]), 0) ** 2
        return out

    def meet(self, points: np.ndarray, boxes: np.ndarray):
        """Distances of some ``points`` at a time to all rows in ``boxes``."""
        at = [np.arange(self.first[b], self.first[b + 1]) for b in np.flatnonzero(boxes)]
        if at:
            at = np.concatenate(at)
            step = max(1, CELLS // len(at))
            for lo in range(0, len(points), step):
                yield lo, self.rows[at], squared(points[lo:lo + step], self.at[at])

    def nearest(self, points: np.ndarray, worst: np.ndarray, k: int):
        """Point, row and squared distance, by point, of the k nearest rows no farther
        than ``worst`` (squared); of equal ones the earlier rows."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        holds = (BOX_ROWS + 1) // 2  # any box of several
        for group in _halves(points, GROUP_QUERIES):
            some, most = points[group], worst[group]
            gap = self.gaps(some)
            boxes = gap <= most.max()
            if np.count_nonzero(boxes) > max(FEW_BOXES, need := -(-k // holds)):
                for lo, _, d in self.meet(some, gap <= np.partition(gap, need - 1)[need - 1]):
                    most[lo:lo + len(d)] = np.minimum(most[lo:lo + len(d)], np.partition(d, k - 1, axis=1)[:, k - 1])
                boxes = gap <= most.max()
            for lo, cols, d in self.meet(some, boxes):
                m = min(k, len(cols)) - 1
                row, col = np.nonzero(d <= np.minimum(most[lo:lo + len(d)], np.partition(d, m, axis=1)[:, m])[:, None])
                dist, col = d[row, col], cols[col]
                order = np.lexsort((col, dist, row))
                row, col, dist = row[order], col[order], dist[order]
                kept = np.arange(len(row)) - np.searchsorted(row, row) < k
                found.append((group[lo + row[kept]], col[kept], dist[kept]))
        row, col, dist = (np.concatenate(f) for f in zip(*found))
        order = np.argsort(row, kind="stable")
        return row[order], col[order], dist[order]


def _k_nearest(asked, boxes: Boxes | None, table, k: int, width: int):
    if boxes:
        row, col, dist = boxes.nearest(_points(asked, width), (asked["limit"].to_numpy() * (1 + SLACK)) ** 2, k)
        ids, ys = table["id"].take(pa.array(col)), table["y"].take(pa.array(col))
    else:
        row, dist, ids, ys = np.zeros(0, int), np.zeros(0), asked["id"].slice(0, 0), asked["y"].slice(0, 0)
    offsets = pa.array(np.searchsorted(row, np.arange(asked.num_rows + 1)).astype(np.int32))
    near = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(dist), ids, ys], ["d", "id", "y"]))
    return pa.RecordBatch.from_arrays([asked["_k_row"], asked["x"], asked["bucket"], asked["limit"], near],
                                      ["_k_row", "x", "bucket", "limit", "near"])
