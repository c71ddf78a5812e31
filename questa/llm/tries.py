"""Compressed radix tries over byte strings, and shuffles of texts dealt by
adaptive prefixes.

A :class:`Trie` keeps one node per branching point; an inserted key ends in a
node whose ``held`` dict belongs to its caller.  :func:`prefix_cuts` lets every
task insert its texts into tries and report, after each CUTS-th part of their
bytes, the shortest prefix that parts the next text from the one before.  Long
shared beginnings so get long prefixes, unlike ones short prefixes.  The cuts of
all tasks, in order, with running weights, give the bounds of ranges of about
equal bytes; :func:`bucket_of` finds a text's range.
"""

from __future__ import annotations

import random
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import prefix_sum_total

#: A task's trie is emptied when it holds this many bytes.
TRIE_BYTES = 32 << 20
#: Prefixes reported per filled trie.
CUTS = 64
#: Wanted bytes of distinct texts in a range.
RANGE_BYTES = 64 << 20
#: The bounds of all ranges, which go to every task, take at most this; beyond
#: it ranges get wider.
BOUND_BYTES = 64 << 20


class Node:
    __slots__ = ("label", "below", "held")

    def __init__(self, label: bytes):
        self.label, self.below, self.held = label, {}, None


def shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the common beginning of ``label`` and ``key[at:]``, which
    differ somewhere in the label."""
    low, high = 0, 1
    while key.startswith(label[:high], at) and high < len(label):
        low, high = high, high * 2
    high = min(high, len(label))
    while high - low > 1:
        mid = (low + high) // 2
        if key.startswith(label[low:mid], at + low):
            low = mid
        else:
            high = mid
    return low


class Trie:
    """Keys with a dict each; ``size`` counts the bytes of new labels."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def insert(self, key: bytes) -> dict:
        """The dict at ``key``'s terminal; a new key gets an empty one."""
        node, at = self.root, 0
        while at < len(key):
            child = node.below.get(key[at])
            if child is None:
                child = node.below[key[at]] = Node(key[at:])
                self.size += len(key) - at + 200
                node = child
                break
            if not key.startswith(child.label, at):
                n = shared(child.label, key, at)
                mid = Node(child.label[:n])
                child.label = child.label[n:]
                mid.below[child.label[0]] = child
                node.below[key[at]] = child = mid
            at += len(child.label)
            node = child
        if node.held is None:
            node.held = {}
        return node.held

    def terminals(self) -> Iterator[tuple[bytes, int, dict]]:
        """(key, length of the beginning shared with the key before, dict) in
        byte order."""
        stack: list[tuple[Node, bytes, int]] = [(self.root, b"", 0)]
        last = 0
        while stack:
            node, path, depth = stack.pop()
            last = min(last, depth)
            if node.held is not None:
                key = path + node.label
                yield key, last, node.held
                last = len(key)
            key = path + node.label if node.below else b""
            for byte in sorted(node.below, reverse=True):
                stack.append((node.below[byte], key, len(key)))


def _cuts(batches):
    step_at = random.Random(TaskContext.get().partitionId()).random()

    def report(trie):
        prefixes, weights, total, since = [], [], 0, 0
        step = max(1, sum(len(k) + 200 for k, _, _ in trie.terminals()) // CUTS)
        due = step_at * step
        for key, same, _ in trie.terminals():
            if total >= due:
                prefixes.append(key[:same + 1])
                weights.append(since)
                due, since = total - total % step + step + step_at * step, 0
            total += len(key) + 200
            since += len(key) + 200
        return pa.RecordBatch.from_arrays([pa.array(prefixes, pa.binary()), pa.array(weights, pa.int64())],
                                          ["prefix", "weight"])

    trie = Trie()
    for batch in batches:
        for key in batch.column(0):
            trie.insert(key.as_py())
            if trie.size > TRIE_BYTES:
                yield report(trie)
                trie = Trie()
    yield report(trie)


def prefix_cuts(texts: DataFrame) -> list[bytes]:
    """Sorted bounds of ranges of the one binary column of ``texts``.  There
    are as many ranges as shuffle partitions, or as RANGE_BYTES ask for."""
    spark = texts.sparkSession
    cuts = texts.mapInArrow(_cuts, "prefix binary, weight long").groupBy("prefix").agg(F.sum("weight").alias("weight"))
    summed, total = prefix_sum_total(cuts, ["prefix"], "weight", "upto")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (total or 0) // RANGE_BYTES + 1)
    step = max(1, (total or 0) // ranges)
    while True:
        bounds = summed.filter(F.floor(F.col("upto") / step) > F.floor((F.col("upto") - F.col("weight")) / step)).select(
            "prefix")
        if (bounds.agg(F.sum(F.length("prefix") + 40)).first()[0] or 0) <= BOUND_BYTES:
            return sorted(bytes(r[0]) for r in bounds.toLocalIterator())
        step *= 2


def bucket_of(bounds: list[bytes], key: bytes) -> int:
    """The range of ``key``: equal keys share it."""
    return bisect_right(bounds, key)
