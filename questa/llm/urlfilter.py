"""URL filters with a Bloom filter cascade.

Every url gives a few keys: its host, and for each label count and path length
that occurs in the rules, the last labels of its host plus the start of its
path.  All keys of the corpus are the universe.  Level 0 of a cascade is a Bloom
filter of the listed keys; level 1 holds the unlisted keys that pass level 0,
level 2 the listed keys that pass level 1, and so on until a level has no false
positive.  For keys of the universe membership is then exact, and a url is
judged without a join.

The levels' bits are made by grouped ORs and broadcast; their size follows the
number of listed keys and is checked against MAX_BYTES (a longer list is looked
up by a join instead, with the same result).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: All levels together may take this much memory per worker.
MAX_BYTES = 64 << 20


@dataclass(frozen=True)
class Rule:
    """``host/path`` with its verdict; fits the host and its subdomains where
    the url's path starts with the rule's."""
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


# ---------------------------------------------------------------------- urls

def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidates(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Keys that a rule fitting this url can have: array of (key, host part)."""
    labels = sorted({r.host.count(".") + 1 for r in rules})
    lengths = sorted({len(r.path) for r in rules})
    out = []
    for k in labels:
        tail = F.substring_index(host, ".", -k)
        for n in lengths:
            out.append(F.when(F.length(path) >= n, F.concat(tail, F.substring(path, 1, n))))
    return F.array_distinct(F.array_compact(F.array(*out))) if out else F.array().cast("array<string>")


# ------------------------------------------------------------------- cascade

@dataclass
class Level:
    words: np.ndarray
    hashes: int

    def has(self, h: np.ndarray, step: np.ndarray) -> np.ndarray:
        m = np.uint64(len(self.words) * 64)
        ok = np.ones(len(h), bool)
        for i in range(self.hashes):
            bit = (h + np.uint64(i) * step) % m
            ok &= (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return ok


def _pair(h: np.ndarray, g: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First bit and step of each key at a level: levels fail independently."""
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2 ** 64)
    h, g = h ^ salt, g ^ (salt >> np.uint64(7))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    g = (g ^ (g >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32)), g | np.uint64(1)


@dataclass
class Cascade:
    levels: list[Level]

    def listed(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Whether keys of the universe (by their two hashes) are listed."""
        inside = np.zeros(len(h), bool)
        open_ = np.arange(len(h))
        for i, level in enumerate(self.levels):
            passed = level.has(*_pair(h[open_], g[open_], i))
            inside[open_[~passed]] = i % 2 == 1
            open_ = open_[passed]
        inside[open_] = len(self.levels) % 2 == 1
        return inside


def build(universe: DataFrame) -> Cascade | None:
    """Cascade of a universe (h, g, listed), one row per key; None if the bits
    would take more than MAX_BYTES."""
    sizes = {r["listed"]: r["count"] for r in universe.groupBy("listed").count().collect()}
    n, others = sizes.get(True, 0), sizes.get(False, 0)
    levels: list[Level] = []
    if not n:
        return Cascade(levels)
    rate = min(0.5, max(2.0 ** -20, n * math.sqrt(0.5) / max(others, 1)))
    side, left = True, universe
    while n:
        k = max(1, round(-math.log2(rate)))
        words = max(1, math.ceil(n * k / math.log(2) / 64))
        if 8 * (words + sum(len(x.words) for x in levels)) > MAX_BYTES:
            return None
        levels.append(Level(_bits(left.filter(F.col("listed") == side), words, k, len(levels)), k))
        left = _passing(left, side, levels[-1], len(levels) - 1)
        n = left.filter(F.col("listed") != side).count()
        side, rate = not side, 0.5
    return Cascade(levels)


def _bits(keys: DataFrame, words: int, k: int, level: int) -> np.ndarray:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h, step = _pair(*(pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("h", "g")), level)
            for i in range(k):
                bit = (h + np.uint64(i) * step) % np.uint64(words * 64)
                yield pd.DataFrame({"word": (bit >> np.uint64(6)).astype(np.int64),
                                    "bits": (np.uint64(1) << (bit & np.uint64(63))).view(np.int64)})
    got = (keys.select("h", "g").mapInPandas(run, "word long, bits long")
           .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())  # at most ``words`` rows
    out = np.zeros(words, np.uint64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out


def _passing(keys: DataFrame, side: bool, level: Level, number: int) -> DataFrame:
    """The encoded side whole, and of the other side what passes the level."""
    held = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h, step = _pair(*(pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("h", "g")), number)
            yield pdf[(pdf["listed"] == side).to_numpy() | held.value.has(h, step)]
    return stored(keys.mapInPandas(run, keys.schema), "cascade")


# -------------------------------------------------------------------- verdict

def membership(keys: DataFrame, listed: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``column`` (array of keys of the universe) narrowed to the
    listed ones, in the same order.  ``keys``: all keys of the corpus (key),
    distinct; ``listed``: the listed keys (key), any number of times."""
    one = F.lit(1)
    marked = keys.join(listed.select("key", F.lit(True).alias("listed")).distinct(), "key", "left").select(
        F.xxhash64("key").alias("h"), F.xxhash64(one, "key").alias("g"),
        F.coalesce("listed", F.lit(False)).alias("listed"))
    cascade = build(stored(marked, "universe"))
    if cascade is None:
        return _by_join(listed, rows, column)
    held = rows.sparkSession.sparkContext.broadcast(cascade)

    @F.pandas_udf("array<boolean>")
    def test(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hs, gs in batches:
            n = hs.map(len).to_numpy()
            flat = [np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64).view(np.uint64) for x in (hs, gs)]
            found = held.value.listed(*flat)
            yield pd.Series(np.split(found, np.cumsum(n)[:-1]) if len(n) else [], dtype=object)

    flags = test(F.transform(column, lambda k: F.xxhash64(k)),
                 F.transform(column, lambda k: F.xxhash64(one, k)))
    return rows.withColumn("flags", flags).withColumn(
        column, F.filter(column, lambda k, i: F.col("flags")[i])).drop("flags")


def _by_join(listed: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """The same by a join on the distinct key arrays, for very long lists."""
    sets = rows.select(column).distinct().select(column, F.posexplode(column).alias("at", "key"))
    found = (sets.join(listed.select("key").distinct(), "key").groupBy(column)
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "key"))), lambda s: s["key"]).alias("found")))
    return rows.join(found, column, "left").withColumn(
        column, F.coalesce("found", F.array().cast("array<string>"))).drop("found")


def judge(pages: DataFrame, rules: Sequence[Rule], listed_hosts: DataFrame | None = None,
          key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict), one row per input row.

    ``rule``: the longest fitting rule's key (ties: the longer host), null if
    none fits.  ``verdict``: that rule's; else block if the host is among
    ``listed_hosts`` (column ``host``), else allow.  Null urls and urls without
    ``://`` have an empty host and path, which no rule fits."""
    spark = pages.sparkSession
    u = pages[url].cast("string")
    rows = pages.select(pages[key].alias("_id"), host_of(u).alias("host"), path_of(u).alias("path"))
    rows = rows.withColumn("keys", F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(
        F.concat(F.array(F.col("host")), candidates(F.col("host"), F.col("path"), rules))))
    keys = rows.select(F.explode("keys").alias("key")).distinct()
    listed = spark.createDataFrame([(r.key,) for r in rules], "key string")
    if listed_hosts is not None:
        listed = listed.union(listed_hosts.select(F.col("host").alias("key")))
    hit = membership(keys, listed, rows, "keys")
    # the first key is the host itself if that is listed; the others are rules
    order = F.array_sort(F.filter("keys", lambda k: F.contains(k, F.lit("/"))), lambda a, b: F.when(
        F.length(a) != F.length(b), F.length(b) - F.length(a)).otherwise(
        F.length(F.substring_index(b, "/", 1)) - F.length(F.substring_index(a, "/", 1))))
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.verdict)]) if rules else None
    rule = F.try_element_at(order, F.lit(1))
    other = F.when(F.array_contains("keys", F.col("host")), "block").otherwise("allow")
    return hit.withColumn("rule", rule).select(
        F.col("_id").alias(key), "host", "path", "rule",
        F.coalesce(verdicts[F.col("rule")] if rules else F.lit(None).cast("string"), other).alias("verdict"))


#: Words in a host's labels that list it.
HOST_WORDS = ("bet", "bets", "casino", "jackpot", "lottery", "pills", "poker", "porn", "viagra", "xxx")


def hosts_with_words(pages: DataFrame, words: Sequence[str] = HOST_WORDS, url: str = "url") -> DataFrame:
    """(host): the hosts of the corpus that have one of ``words`` between dots
    or hyphens."""
    host = host_of(pages[url].cast("string"))
    hit = F.arrays_overlap(F.split(F.col("host"), r"[.-]"), F.array(*[F.lit(w) for w in words]))
    return pages.select(host.alias("host")).distinct().filter(hit)
