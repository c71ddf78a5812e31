"""SimHash near-duplicates by a segment-popcount embedding.

1. Every text gets a 64-bit fingerprint (numpy inside an Arrow UDF).
2. Equal fingerprints are collapsed by a grouped minimum, so a hot group of
   copies is one node from here on.
3. A fingerprint is mapped to the bit counts of its segments.  The Manhattan
   distance of two such vectors never exceeds the Hamming distance.  Counts
   are written in unary, so the distance is one XOR and one bit count.
4. Grid range-join: the vector is cut into ``max_bits // 2 + 1`` parts.  If
   the whole distance is at most ``max_bits``, some part differs by at most 1.
   Each vector is stored in its own cell of every part and looks up that cell
   and (those with an even sum only: neighbours differ in parity) the cells one
   step away.  The equi-join on the cell keeps pairs within the Manhattan
   bound and then within the exact Hamming distance.
5. Connected components of the links (``graph.components``).  Rows get the
   component of their fingerprint by a join that deals no hot fingerprint, and
   no large component, to one task (``join_split``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_split, stored

SEED = 42
SEGMENT_BITS = 2
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Shingles hashed at a time, so that a very long text needs little memory.
_BLOCK = 1 << 16


def simhash(text: bytes | None, shingle: int) -> int:
    """Fingerprint of one UTF-8 text (null or no word: 0)."""
    words = text.translate(_LOWER).split() if isinstance(text, bytes) else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, _BLOCK):
        hi = min(n, lo + _BLOCK)
        h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), SEED)
                         for i in range(lo, hi)), dtype="<u8", count=hi - lo)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(key, fp): the signed 64-bit fingerprint of every row's whole text.
    Null text counts as empty; other columns are ignored."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([simhash(t, shingle) for t in s], dtype="int64")

    return docs.select(docs[key], fp(docs[text].cast("string").cast("binary")).alias("fp"))


def unary_counts(fps: np.ndarray, width: int = SEGMENT_BITS) -> np.ndarray:
    """Per segment of ``width`` bits: its bit count in unary (low bits set),
    packed in place.  XOR + bit count of two results is the Manhattan distance
    of the two count vectors."""
    out = np.zeros_like(fps)
    for lo in range(0, 64, width):
        count = np.bitwise_count((fps >> np.uint64(lo)) & np.uint64((1 << width) - 1)).astype(np.uint64)
        out |= ((np.uint64(1) << count) - np.uint64(1)) << np.uint64(lo)
    return out


def _parts(max_bits: int, width: int) -> list[tuple[int, int]]:
    """(first bit, end bit) of each part: whole segments, as even as can be."""
    n, segments = max_bits // 2 + 1, 64 // width
    cuts = [width * (segments * i // n) for i in range(n)] + [64]
    return list(zip(cuts, cuts[1:]))


def _mask(lo: int, hi: int) -> np.uint64:
    return np.uint64(((1 << (hi - lo)) - 1) << lo)


_CELLS = "part int, cell long, fp long, code long, near int"


def _frame(parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, int]]) -> pd.DataFrame:
    """Rows of (part, cells, fingerprints, codes, near) in one frame."""
    n = [len(p[1]) for p in parts]
    long = lambda k: np.concatenate([p[k] for p in parts]).view(np.int64)
    return pd.DataFrame({"part": np.repeat(np.array([p[0] for p in parts], np.int32), n), "cell": long(1),
                         "fp": long(2), "code": long(3),
                         "near": np.repeat(np.array([p[4] for p in parts], np.int32), n)})


def _cells(max_bits: int, width: int, near: bool):
    """Each part's own cell; with ``near``, for vectors whose part has an even
    sum, also every cell at Manhattan distance 1: one segment's count one up or
    one down."""
    def run(batches):
        for pdf in batches:
            fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            code = unary_counts(fp, width)
            out = []
            for i, (lo, hi) in enumerate(_parts(max_bits, width)):
                cell = code & _mask(lo, hi)
                out.append((i, cell, fp, code, 0))
                even = np.bitwise_count(cell) % 2 == 0
                for at in range(lo, hi, width) if near else ():
                    count = np.bitwise_count(cell & _mask(at, at + width)).astype(np.uint64)
                    for bit, ok in ((count, count < width), (count - np.uint64(1), count > 0)):
                        take = even & ok
                        step = np.uint64(1) << (np.uint64(at) + bit[take])
                        out.append((i, cell[take] ^ step, fp[take], code[take], 1))
            yield _frame(out)
    return run


def links(nodes: DataFrame, max_bits: int = 3, width: int = SEGMENT_BITS) -> DataFrame:
    """(a, b): every pair of different fingerprints (column ``fp``, distinct)
    at Hamming distance of at most ``max_bits``, at least once each."""
    s = nodes.mapInPandas(_cells(max_bits, width, near=False), _CELLS).drop("near").alias("s")
    p = nodes.mapInPandas(_cells(max_bits, width, near=True), _CELLS).alias("p")
    apart = lambda c: F.bit_count(F.col(f"p.{c}").bitwiseXOR(F.col(f"s.{c}")))
    hit = ((F.col("p.part") == F.col("s.part")) & (F.col("p.cell") == F.col("s.cell"))
           & ((F.col("p.near") == 1) | (F.col("p.fp") < F.col("s.fp")))
           & (apart("code") <= max_bits) & (apart("fp") <= max_bits))
    return p.join(s, hit).select(F.col("p.fp").alias("a"), F.col("s.fp").alias("b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(key, fingerprint, component_id), one row per input row.

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id is
    the smallest key reachable over links.  Texts without a word (and null
    texts) have fingerprint zero and link like any other.  A row with a null
    key gets the component of its text (null if no member has a key).
    Repeated rows each get their own result row; an empty table gives none.
    """
    fps = stored(fingerprints(docs, key, text, shingle).withColumnRenamed(key, "id"), "fp")
    nodes = stored(fps.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")), "fp-nodes")
    found = components_of(nodes.select("fp"), max_bits)
    linked = stored(found.join(nodes, found["node"] == nodes["fp"]).select("fp", "root", "low"), "linked")
    lows = linked.groupBy("root").agg(F.min("low").alias("component"), F.count(F.lit(1)).alias("members"))
    of_node = join_split(linked.select("fp", "root"), stored(lows, "roots"), "root", "members").select("fp", "component")
    classes = nodes.join(of_node, "fp", "left").select(
        "fp", "n", F.when(F.col("component").isNotNull(), F.col("component"))
        .otherwise(F.col("low")).alias("component_id"))
    return join_split(fps, stored(classes, "classes"), "fp", "n").select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id")


def components_of(nodes: DataFrame, max_bits: int) -> DataFrame:
    from .graph import components
    return components(links(nodes, max_bits), "a", "b")
