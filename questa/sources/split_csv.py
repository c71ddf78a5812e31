"""Multi-line CSV files read in many ranges (O-01).

Spark reads a CSV file whose answers may hold line breaks in one task, since a
line break alone does not say where a record ends.  It is known once the quotes
before it are counted: a line starts a record if their number is even.  So the
files are read as plain lines, which Spark splits at any size, in two passes:

1. every range (a split of a file) reports its number of quotes, modulo 2, and how
   many records start in it if it begins outside and if it begins inside quotes.
   The driver adds these up, one line per range, in the order of file names and
   offsets: now each range's beginning is known, and the number of its first record;
2. every range puts its lines together to records.  A record that goes on in the
   next range leaves pieces; only those are shuffled, by the record's number.

Records are then parsed by Spark's own CSV expression with the options of
:func:`survey_csv.csv_options`.  A record's number is its place in the order of
file names and lines, whatever the ranges, so it also is the file order.

Quotes must enclose whole fields and be doubled within them, as pandas and
:func:`survey_csv.write_csv` write them.  Lines end with a line feed or with
carriage return and line feed.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .survey_csv import csv_options

_RANGE = "file string, start long, size long, odd boolean, outside long, inside long"
_PIECE = T.StructType([T.StructField("row", T.LongType()), T.StructField("file", T.StringType()),
                       T.StructField("start", T.LongType()), T.StructField("whole", T.BooleanType()),
                       T.StructField("text", T.StringType())])


class Range(NamedTuple):
    """How a range begins: within quotes or not, and the number of the first
    record that starts in it.  ``header`` is that of its file's header, which is
    also the number of the last record before the file."""
    inside: bool
    row: int
    header: int


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("size"), "value")


def _parts(batches):
    """(file, start, size, lines) of consecutive lines of one range."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file = batch["file"].dictionary_encode().indices.to_numpy()
        start = batch["start"].to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(start) != 0) | (np.diff(file) != 0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            yield batch["file"][lo].as_py(), int(start[lo]), batch["size"][lo].as_py(), batch["value"].slice(lo, hi - lo)


def _odd_before(lines, inside: bool) -> tuple[np.ndarray, bool]:
    """Of each line, whether it begins within quotes; and whether the next will."""
    odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
    after = (np.cumsum(odd) + inside) & 1
    return np.append(inside, after[:-1]).astype(bool), bool(after[-1])


def _measure(batches):
    done: list[tuple] = []
    for file, start, size, lines in _parts(batches):
        if not done or done[-1][:2] != (file, start):
            done.append((file, start, size, False, 0, 0))
        *key, odd, outside, inside = done[-1]
        within, after = _odd_before(lines, odd)
        done[-1] = (*key, after, outside + int((~within).sum()), inside + int(within.sum()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["file", "start", "size", "odd", "outside", "inside"])


def _begins(ranges) -> dict[tuple[str, int], tuple[int, Range]]:
    """(size, beginning) of each range, from what all ranges measured."""
    out, row, file, inside, header = {}, 0, None, False, 0
    for r in sorted(ranges, key=lambda r: (r.file, r.start)):
        if r.file != file:
            file, inside, row = r.file, False, row - 1
            header = row
        out[r.file, r.start] = (r.size, Range(inside, row, header))
        row += r.inside if inside else r.outside
        inside ^= r.odd
    return out


def _pieces(held):
    """Records, and the pieces of those that a range does not hold whole."""
    def run(batches):
        key, open_lines, row, begin = None, [], 0, None
        out: list[tuple] = []

        def close(ended: bool):
            if row != begin.header:
                text, whole = "\n".join(open_lines), ended and row >= begin.row
                out.append((row, *key, whole, text[:-1] if whole and text.endswith("\r") else text))
            open_lines.clear()

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(
                zip(*out), [pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string()])], _PIECE.names)
            out.clear()
            return made

        inside = False
        for file, start, size, lines in _parts(batches):
            if (file, start) != key:
                if open_lines:
                    close(not inside)
                key, known = (file, start), held.value.get((file, start))
                if known is None or known[0] != size:
                    raise RuntimeError(f"{file} was split differently in the second pass; set "
                                       "spark.sql.files.maxPartitionBytes so that it does not depend on the executors")
                begin = known[1]
                inside, row = begin.inside, begin.row - 1
            within, inside = _odd_before(lines, inside)
            for line, goes_on in zip(lines.to_pylist(), within):
                if not goes_on:
                    if open_lines:
                        close(True)
                    row += 1
                open_lines.append(line)
            if len(out) >= 4096:
                yield batch()
        if open_lines:
            close(not inside)
        if out:
            yield batch()
    return run


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(row, text) of every record but the headers; ``row`` rises in the order
    of file names and lines.  Empty records are left out."""
    ship_package(spark)
    measured = _lines(spark, path).mapInArrow(_measure, _RANGE).collect()  # one line per range
    begins = _begins(measured)
    held = spark.sparkContext.broadcast(begins)
    lines = _lines(spark, path)
    whole = lines.mapInArrow(_pieces(held), _PIECE).filter("whole").select("row", "text")
    # ranges that begin or end within quotes: only their lines are read again
    cut = [(r.file, r.start) for r in measured
           if begins[r.file, r.start][1].inside or r.odd]
    if cut:
        marked = spark.createDataFrame(cut, "file string, start long")
        of = lines.join(F.broadcast(marked), ["file", "start"], "left_semi").select("file", "start", "size", "value")
        texts = F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda p: p["text"])
        pieces = of.mapInArrow(_pieces(held), _PIECE).filter("NOT whole").groupBy("row").agg(
            F.regexp_replace(F.array_join(texts, "\n"), "\r\\z", "").alias("text"))
        whole = whole.unionByName(pieces)
    return whole.filter(F.col("text") != "")


def read_csv_split(spark: SparkSession, path: str | list[str], row_col: str | None = None) -> DataFrame:
    """A header CSV file, or folder of such files, as text columns under its
    header names, like ``spark.read.csv`` with line breaks in fields, but read
    in ranges; ``row_col`` adds the number of each record in file order, from 1.

    The first file's header names the columns of all files.  A file that is empty
    or holds a header only gives no row; a record that is too short is padded with nulls."""
    names = spark.read.options(**csv_options()).csv(path).columns
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in csv_options().items() if k != "header"}
    parsed = read_records(spark, path).select("row", F.from_csv("text", schema.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    number = [(F.col("row") + 1).alias(row_col)] if row_col else []
    return parsed.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)], *number)
