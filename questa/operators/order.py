"""Global order without a single-partition window (O-07, O-37, O-38, §2.12).

``Window.orderBy`` without ``partitionBy`` moves every row into one task.
Instead:

* ``row_position`` / ``prefix_sum``: range-partition on the full order key
  (Spark samples the composite key, so a hot leading value is split by the
  tie-break columns), sort within partitions and checkpoint to the shared
  checkpoint folder so partition contents are fixed even if executors are
  lost.  One small job counts (or sums) each partition; offsets (one number
  per partition) are broadcast back.  Positions then come from
  ``monotonically_increasing_id`` (JVM only, no shuffle); weighted running
  sums from an Arrow-batched ``mapInPandas`` pass (no shuffle either).
* ``hash_split``: a keyed md5 threshold, repeatable and shuffle-free.
* ``exact_split_rows``: the same for rows without a unique key; rows that are
  alike in everything are told apart by their place in a written copy.
* ``exact_split``: the k-th smallest hash is found by a prefix histogram and
  an ``offset`` inside one bucket, so no global sort is needed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_PID, _MID = "_q_pid", "_q_mid"


def _cols(order_cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_cols]


def sorted_checkpoint(df: DataFrame, order_cols: Sequence[str | Column],
                      partitions: int | None = None) -> DataFrame:
    """Range-partition + sort within partitions, then a reliable checkpoint.

    Without ``partitions`` the range shuffle is sized by AQE (it merges only
    adjacent ranges, so partition order stays range order).  The order must
    be total (end with a unique column) for positions to be deterministic."""
    cols = _cols(order_cols)
    ranged = (df.repartitionByRange(int(partitions), *cols) if partitions
              else df.repartitionByRange(*cols))
    return materialize(ranged.sortWithinPartitions(*cols))


def _offsets(tagged: DataFrame, agg: Column,
             with_total: bool = False) -> list[tuple[int, int | float]]:
    """(partition id, sum of all earlier partitions); one row per partition.
    With ``with_total`` a last (-1, grand total) entry is appended."""
    rows = sorted(tagged.groupBy(_PID).agg(agg.alias("t")).collect(), key=lambda r: r[0])
    out, acc = [], 0
    for r in rows:
        out.append((int(r[0]), acc))
        acc += r["t"] or 0
    if with_total:
        out.append((-1, acc))
    return out


def row_position(df: DataFrame, order_cols: Sequence[str | Column], out: str = "pos",
                 partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order_cols`` order
    (the global ``row_number``), without a single-partition window (O-07)."""
    ck = sorted_checkpoint(df, order_cols, partitions)
    tagged = ck.select("*", F.spark_partition_id().alias(_PID),
                       F.monotonically_increasing_id().alias(_MID))
    offsets = _offsets(tagged, F.count(F.lit(1)))
    spark = df.sparkSession
    off_df = spark.createDataFrame(offsets, T.StructType([
        T.StructField(_PID, T.IntegerType()), T.StructField("_q_off", T.LongType())]))
    within = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    # the offset table has one row per partition: a proven size bound
    return (tagged.join(F.broadcast(off_df), _PID)
            .withColumn(out, F.col("_q_off") + within + F.lit(1))
            .drop(_PID, _MID, "_q_off"))


def prefix_sum(df: DataFrame, order_cols: Sequence[str | Column], weight: str,
               out: str = "cum", inclusive: bool = True,
               partitions: int | None = None) -> DataFrame:
    """Add ``out`` = running sum of ``weight`` in ``order_cols`` order (rows
    frame, inclusive of the current row unless ``inclusive=False``).  Null
    weights count as 0.  Integers give a long, decimals an exact decimal of the
    same scale, other weights a double."""
    return prefix_sum_total(df, order_cols, weight, out, inclusive, partitions)[0]


def prefix_sum_total(df: DataFrame, order_cols: Sequence[str | Column], weight: str,
                     out: str = "cum", inclusive: bool = True,
                     partitions: int | None = None) -> tuple[DataFrame, int | float]:
    """:func:`prefix_sum` plus the grand total of the weights (known from the
    per-partition totals, so no extra pass)."""
    ck = sorted_checkpoint(df, order_cols, partitions)
    tagged = ck.select("*", F.spark_partition_id().alias(_PID))
    sums = _offsets(tagged, F.sum(F.col(weight)), with_total=True)
    total = sums.pop()[1]
    wtype = df.schema[weight].dataType
    integral = isinstance(wtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    decimal = isinstance(wtype, T.DecimalType)
    out_type = (T.LongType() if integral else T.DecimalType(38, wtype.scale) if decimal
                else T.DoubleType())
    # each row carries its partition's offset (broadcast join of one row per
    # partition: streams the sorted rows in order, no shuffle, and keeps the
    # offsets out of the task closures)
    cast = int if integral else Decimal if decimal else float
    off_df = df.sparkSession.createDataFrame([(p, cast(o)) for p, o in sums], T.StructType([
        T.StructField(_PID, T.IntegerType()), T.StructField("_q_off", out_type)]))
    tagged = tagged.join(F.broadcast(off_df), _PID)
    schema = T.StructType([f for f in ck.schema.fields] + [T.StructField(out, out_type)])
    drop = [_PID, "_q_off"]

    def run(batches):
        running = None
        for pdf in batches:
            if pdf.empty:
                continue
            if running is None:
                running = pdf["_q_off"].iloc[0]
            if decimal:  # exact: Python decimals, as the JVM sends them
                w = pdf[weight].map(lambda x: Decimal(0) if x is None or x != x else x).astype(object)
                cs = pd.Series(list(accumulate(w)), index=w.index, dtype=object) + running
            else:
                w = pdf[weight].fillna(0)
                w = w.astype("int64") if integral else w.astype("float64")
                cs = w.cumsum() + running
            running = cs.iloc[-1]
            pdf = pdf.drop(columns=drop)
            pdf[out] = cs if inclusive else cs - w
            yield pdf

    return tagged.mapInPandas(run, schema), total


# ------------------------------------------------------------------- splits

def _threshold_hex(frac: float) -> str | None:
    """8-hex-digit threshold for a fraction of the md5 space, None for all."""
    if frac >= 1:
        return None
    return format(max(0, int(round(frac * 2 ** 32))), "08x")


def key_hash(key: str | Column, salt: str = "") -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(salt), k.cast("string")))


def hash_split(df: DataFrame, key: str, frac: float = 0.75, salt: str = "",
               out: str = "split", labels: tuple[str, str] = ("train", "valid")) -> DataFrame:
    """Repeatable random split (O-37): a row goes to ``labels[0]`` when the
    first 8 hex digits of md5(salt || key) fall below ``frac`` of the hash
    space.  No shuffle, independent of partitioning, same rows in SQL."""
    thr = _threshold_hex(frac)
    if thr is None:
        return df.withColumn(out, F.lit(labels[0]))
    h8 = F.substring(key_hash(key, salt), 1, 8)
    return df.withColumn(out, F.when(h8 < F.lit(thr), F.lit(labels[0])).otherwise(F.lit(labels[1])))


def _kth_smallest(hashed: DataFrame, key: str, k: int, hist: list[tuple[str, int]],
                  max_bucket_rows: int = 1_000_000) -> tuple[str, object]:
    """(hash, key) of the k-th smallest (hash, key), 1-based.  ``hist`` is the
    histogram of 4-hex-digit hash prefixes; the bucket holding rank k is
    refined with longer prefixes until it holds at most ``max_bucket_rows``
    rows (each refinement is one more filtered pass), then one row is taken
    with ``offset`` inside it: that final ordered take gathers only the
    bucket's rows, a bounded amount, in one task."""
    plen, rest = 4, hashed
    while True:
        acc = 0
        for b, c in hist:
            if acc + c >= k:
                break
            acc += c
        k -= acc
        pcol = F.substring("_h", 1, plen)
        if b is None:
            raise ValueError(f"{key!r} has null values, which cannot be split by rank")
        rest = rest.filter(pcol == F.lit(b))
        if c <= max_bucket_rows:
            row = rest.select("_h", key).orderBy("_h", key).offset(k - 1).limit(1).collect()[0]
            return row[0], row[1]
        if plen >= 32:  # all rows left have the same hash, so the same key
            row = rest.select("_h", key).limit(1).collect()[0]
            return row[0], row[1]
        plen += 4
        pcol = F.substring("_h", 1, plen)
        hist = sorted((r[0], r[1]) for r in rest.groupBy(pcol.alias("b")).count().collect())


def exact_split(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42,
                out: str = "split", labels: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Seeded split with an exact test size ceil(test_frac * n) (O-38): the
    test rows are the ones with the smallest (md5(seed:key), key).  The cut
    must fall on a unique, non-null key, else a ValueError is raised."""
    hashed = df.withColumn("_h", key_hash(key, f"{seed}:"))
    # one pass: 4-hex-digit prefix histogram (at most 65536 rows), n is its total
    # (a null key hashes to null: that bucket sorts last, as NULLS LAST does)
    hist = sorted(((r[0], r[1]) for r in hashed.groupBy(F.substring("_h", 1, 4).alias("b"))
                   .count().collect()), key=lambda bc: (bc[0] is None, bc[0] or ""))
    n = sum(c for _, c in hist)
    t = math.ceil(test_frac * n)
    if t <= 0:
        return df.withColumn(out, F.lit(labels[0]))
    if t >= n:
        return df.withColumn(out, F.lit(labels[1]))
    h_star, k_star = _kth_smallest(hashed.select("_h", key), key, t, hist)
    at_cut = hashed.filter((F.col("_h") == F.lit(h_star)) & (F.col(key) == F.lit(k_star)))
    if at_cut.offset(1).limit(1).count():
        raise ValueError(f"key {key!r} is not unique ({k_star!r}); the split would not have the exact size")
    is_test = (F.col("_h") < F.lit(h_star)) | ((F.col("_h") == F.lit(h_star)) & (F.col(key) <= F.lit(k_star)))
    return (hashed.withColumn(out, F.when(is_test, F.lit(labels[1])).otherwise(F.lit(labels[0])))
            .drop("_h"))


def exact_split_rows(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42, out: str = "split",
                     labels: tuple[str, str] = ("train", "test"), within: Sequence[str] | None = None) -> DataFrame:
    """Seeded split of *rows* with an exact test size ceil(test_frac * n): keys
    may repeat or be null (O-38).

    The test rows are those with the smallest (md5(seed:key), md5(seed:row)), where
    the row's text holds the key and the columns ``within`` (all others by default), a
    null apart from any text.  Rows that are equal in both hashes at the cut are
    dealt by their place, so the split of a key goes through it; which of several
    equal rows go to the test part makes no difference.  A key's rows thus stay
    together except at the cut.  An empty table stays empty."""
    cols = [key, *(within if within is not None else [c for c in df.columns if c != key])]
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    by_key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    by_row = F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws("\x1f", *[part(c) for c in cols])))
    hist = _row_hist(df, by_key, by_row, 4)
    n = sum(c for _, c, _ in hist)
    t = math.ceil(test_frac * n)
    if t <= 0 or t >= n:
        return df.withColumn(out, F.lit(labels[0] if t <= 0 else labels[1]))
    cut_key, cut_row, below, at = _cut_rows(df, by_key, by_row, t, hist)
    test, train = F.lit(labels[1]), F.lit(labels[0])
    apart = F.when(by_key < cut_key, test).when(by_key > cut_key, train)  # rows of other keys need no second hash
    if below + at == t:  # no run of equal rows is cut
        return df.withColumn(out, apart.when(by_row <= cut_row, test).otherwise(train))
    at_cut = (by_key == cut_key) & (by_row == cut_row)
    clear = df.filter(~at_cut).withColumn(out, apart.when(by_row < cut_row, test).otherwise(train))
    alike = materialize(df.filter(at_cut)).select(
        "*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MID))
    offsets = alike.sparkSession.createDataFrame(_offsets(alike, F.count(F.lit(1))), f"{_PID} int, _q_off long")
    place = F.col("_q_off") + F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    alike = (alike.join(F.broadcast(offsets), _PID)  # one row per partition
             .withColumn(out, F.when(place < t - below, test).otherwise(train)).drop(_PID, _MID, "_q_off"))
    return clear.unionByName(alike)


def _row_hist(rows: DataFrame, by_key: Column, by_row: Column, plen: int) -> list[tuple[str, int, bool]]:
    """(prefix, rows, whether all of them seem alike) by the first ``plen`` of the 64
    digits of both hashes, ascending.  Up to 32 digits only the key's hash is worked
    out, and alike means of one key; then it means equal rows."""
    prefix = F.substring(by_key, 1, plen) if plen <= 32 else F.concat(by_key, F.substring(by_row, 1, plen - 32))
    mark = F.xxhash64(by_key if plen <= 32 else by_row)
    counted = rows.groupBy(prefix.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(mark).alias("lo"), F.max(mark).alias("hi"))
    hist = sorted((r.b, r.n, r.lo == r.hi) for r in counted.collect())
    return hist


def _cut_rows(df: DataFrame, by_key: Column, by_row: Column, k: int, hist: list[tuple[str, int, bool]],
              max_bucket_rows: int = 65_536) -> tuple[str, str, int, int]:
    """Both hashes of the k-th smallest row, 1-based, with the numbers of rows below
    and at them.  ``hist`` is :func:`_row_hist` of 4 digits; the bucket that holds
    rank k is counted again by more digits.  A bucket of one key goes on with the
    rows' hashes, and one of equal rows, or of at most ``max_bucket_rows``, with all
    digits, so the passes do not become more as keys or rows repeat more often."""
    plen, below = 4, 0
    while True:
        for b, c, alike in hist:
            if below + c >= k:
                break
            below += c
        if plen == 64:
            return b[:32], b[32:], below, c
        inside = by_key.startswith(b[:32])
        if plen > 32:
            inside = inside & by_row.startswith(b[32:])
        plen = 64 if c <= max_bucket_rows or (alike and plen > 32) else 36 if alike else plen + 4
        hist = _row_hist(df.filter(inside), by_key, by_row, plen)
