"""Byte-level BPE encoding and decoding by merge replay.

A block of documents is one corpus: its distinct pre-tokens that are not known
yet are laid out as one array of bytes, an inverted index maps the ranks of
token pairs to the positions where they stand, and all merges are applied in
rank order, many words at a time in numpy.  A merge touches only its two
neighbours: their old pairs go stale and their new pairs enter the index.
Every word gets exactly the merges of the word-by-word definition: the lowest
rank first, the leftmost of equals.

Results are kept for a task's later blocks (up to ``HELD_WORDS`` words; the
whole store is dropped when full, which changes no result).  There is no
shuffle: each task encodes its own rows.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words whose ids a task keeps.  Words of more than LONG code points are
#: merged one by one and not kept.
HELD_WORDS = 250_000
LONG = 128
#: Fewer new words than this are merged one by one: setting up an index over
#: all of them costs more.  The ids are the same.
FEW = 128
#: Code points of text that make up one block.
BLOCK = 1 << 21


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as f:
        pairs = [(int(b), base64.b64decode(a)) for a, b in (line.split() for line in f if line.strip())]
    tokens = [b""] * (max(r for r, _ in pairs) + 1)
    for r, t in pairs:
        tokens[r] = t
    return tokens


def latin_pattern(pattern: str) -> str:
    """``pattern`` with its letter, number and space classes spelt out for the
    code points below 256, which the plain ``re`` module matches faster."""
    def members(cls: str) -> str:
        ok = regex.compile(cls).match
        return "".join(f"\\x{c:02x}" for c in range(256) if ok(chr(c)))

    out, inside = [], False
    for part in re.split(r"(\\p\{[LN]\}|\\[sS]|\[\^?|\])", pattern):
        if part.startswith("["):
            inside = True
        elif part == "]":
            inside = False
        elif part == r"\S":
            part = f"[^{members(chr(92) + 's')}]"
        elif part.startswith("\\"):
            part = members(part) if inside else f"[{members(part)}]"
        out.append(part)
    return "".join(out)


class MergeReplay:
    """Ranks of byte sequences, and the ids of words made with them."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens) if t}
        self.find_any = regex.compile(pattern).findall
        self.find_latin = re.compile(latin_pattern(pattern)).findall
        self.byte = [self.rank[bytes([i])] for i in range(256)]
        self.pairs: dict[int, int] = {}
        self.table = None
        #: word -> [its packed ids, how many they are]
        self.known: dict[str, list] = {}

    def find(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return self.find_any(text)
        return self.find_latin(text)

    def pair_rank(self, a: int, b: int) -> int:
        """Rank of the token that ``a`` and ``b`` merge into, or -1."""
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            got = self.pairs[key] = self.rank.get(self.tokens[a] + self.tokens[b], -1)
        return got

    def pair_table(self) -> tuple[np.ndarray, np.ndarray]:
        """Every pair of tokens that merges: sorted keys, and their ranks."""
        if self.table is None:
            keys, ranks = [], []
            for t, r in self.rank.items():
                for k in range(1, len(t)):
                    a, b = self.rank.get(t[:k]), self.rank.get(t[k:])
                    if a is not None and b is not None:
                        keys.append(a << 32 | b)
                        ranks.append(r)
            order = np.argsort(np.asarray(keys, np.int64))
            self.table = np.asarray(keys, np.int64)[order], np.asarray(ranks, np.int64)[order]
        return self.table

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (-1: none, also where a side is not a token)."""
        keys, ranks = self.pair_table()
        key = a << 32 | b
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (keys[at] == key), ranks[at], -1)

    def replay(self, words: list[bytes]) -> tuple[bytes, np.ndarray]:
        """Packed ids of all words one after the other, and where each ends
        (in ids).

        The index holds positions by range of ranks.  Ranges are worked off
        from low to high; within one, each round merges the lowest pair (by
        rank, then place) of every word that has one there, so each word sees
        its merges in rank order.  New pairs go into the index by their rank,
        or back into the round if it is not beyond the range.
        """
        n_bytes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(n_bytes + 1)  # position of the wall after each word
        word = np.repeat(np.arange(len(words) + 1), np.append(n_bytes + 1, 1))
        word[1:] = word[:-1].copy()  # a wall stands before, between and after words
        ids = np.full(len(word), -1, np.int64)
        inner = np.ones(len(word), bool)
        inner[0] = inner[ends] = False
        ids[inner] = np.asarray(self.byte)[np.frombuffer(b"".join(words), np.uint8)]
        left, right = np.arange(len(ids)) - 1, np.arange(len(ids)) + 1
        here = np.append(self.look_up(ids[:-1], ids[1:]), -1)
        edges = np.unique(np.geomspace(32, len(self.tokens), 56).astype(np.int64))
        index: list[list[np.ndarray]] = [[] for _ in range(len(edges) + 1)]

        def put(at: np.ndarray) -> None:
            where = np.searchsorted(edges, here[at], side="right")
            order = np.argsort(where, kind="stable")
            at, where = at[order], where[order]
            cut = np.flatnonzero(np.diff(where)) + 1
            for part in np.split(at, cut):
                if len(part):
                    index[int(np.searchsorted(edges, here[part[0]], side="right"))].append(part)

        put(np.flatnonzero(here >= 0))
        for k in range(len(index)):
            end = edges[k] if k < len(edges) else len(self.tokens)
            at = np.concatenate(index[k]) if index[k] else np.zeros(0, np.int64)
            while len(at):
                rank = here[at]
                live = (rank >= 0) & (rank < end)  # else merged away, or another pair by now
                at, rank = at[live], rank[live]
                order = np.lexsort((at, rank, word[at]))
                at = at[order]
                first = np.ones(len(at), bool)
                first[1:] = word[at[1:]] != word[at[:-1]]
                i, rest = at[first], at[~first]
                r, j = here[i], right[i]
                ids[i], ids[j], here[j] = r, -2, -1
                after = right[j]
                right[i], left[after] = after, i
                before = left[i]
                here[i] = self.look_up(r, ids[after])
                here[before] = np.where(ids[before] >= 0, self.look_up(ids[before], r), -1)
                fresh = np.concatenate((i, before))
                rank = here[fresh]
                soon = (rank >= 0) & (rank < end)
                put(fresh[rank >= end])
                at = np.concatenate((rest, fresh[soon]))
        kept = ids >= 0
        return ids[kept].astype("<u4").tobytes(), np.cumsum(kept)[ends]

    def replay_one(self, text: bytes) -> list[int]:
        """The same merges for one word, position by position: postings by
        rank, ranks in a heap, places in order within a rank."""
        ids = list(map(self.byte.__getitem__, text))
        n = len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        rank = self.pair_rank
        here = [rank(a, b) for a, b in zip(ids, ids[1:])] + [-1]
        index: dict[int, list[int]] = {}
        for i, r in enumerate(here):
            if r >= 0:
                index.setdefault(r, []).append(i)
        heap = list(index)
        heapq.heapify(heap)

        def put(i: int, r: int) -> None:
            here[i] = r
            if r in index:
                index[r].append(i)
            elif r >= 0:
                index[r] = [i]
                heapq.heappush(heap, r)

        while heap:
            r = heapq.heappop(heap)
            at = index.pop(r)
            at.sort()
            for k, i in enumerate(at):
                if here[i] != r:  # merged away, or another pair by now
                    continue
                j = right[i]
                here[j], ids[i], ids[j] = -1, r, -2
                right[i] = j = right[j]
                if j < n:
                    left[j] = i
                h = left[i]
                put(i, rank(r, ids[j]) if j < n else -1)
                if h >= 0:
                    put(h, rank(ids[h], r))
                if 0 <= here[i] <= r or h >= 0 and 0 <= here[h] <= r:
                    for i in at[k + 1:]:  # a lower pair has come up: that one first
                        if here[i] == r:
                            put(i, r)
                    break
        return [x for x in ids if x >= 0]

    def block(self, texts: Iterable[str], words: bool = True) -> list[tuple[list[str], list[list]]]:
        """Each text's pre-tokens (if asked for) and, for each, its entry
        [packed ids, number of ids]; one replay for the words not known yet."""
        if len(self.known) > HELD_WORDS:
            self.known = {}
        known, new = self.known, []

        def add(word: str) -> list:
            new.append(word)
            entry = known[word] = [b"", 0]
            return entry

        get = known.get
        out = []
        for t in texts:
            ws = self.find(t)
            out.append((ws if words else [], [get(w) or add(w) for w in ws]))
        few = len(new) < FEW
        for w in new:
            if few or len(w) > LONG:
                ids = self.replay_one(w.encode("utf-8", "surrogatepass"))
                known[w][:] = struct.pack(f"<{len(ids)}I", *ids), len(ids)
                if len(w) > LONG:  # not kept; its texts hold the entry
                    del known[w]
        new = [] if few else [w for w in new if len(w) <= LONG]
        if new:
            packed, ends = self.replay([w.encode("utf-8", "surrogatepass") for w in new])
            lo = 0
            for w, hi in zip(new, ends.tolist()):
                known[w][:] = packed[4 * lo:4 * hi], hi - lo
                lo = hi
        return out

    def encode_block(self, texts: Iterable[str]) -> list[bytes]:
        """The packed ids of each text."""
        return [b"".join([e[0] for e in entries]) for _, entries in self.block(texts, words=False)]

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in blocks of about BLOCK code points."""
        block, size = [], 0
        for t in texts:
            block.append(t if isinstance(t, str) else "")
            size += len(block[-1])
            if size >= BLOCK:
                yield from self.encode_block(block)
                block, size = [], 0
        yield from self.encode_block(block)

    def decode(self, packed: bytes | None) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed or b"", "<u4").tolist()))


_MADE: dict[tuple[str, str], MergeReplay] = {}


def replay_of(path: str, pattern: str) -> MergeReplay:
    """One per worker process and vocabulary."""
    if (path, pattern) not in _MADE:
        _MADE[path, pattern] = MergeReplay(load_ranks(path), pattern)
    return _MADE[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(key, ids): token ids of every row's whole text as packed little-endian
    unsigned 32-bit integers.  Null text counts as empty (no ids); special
    tokens are ordinary text.  ``path`` must be readable on every executor."""

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = replay_of(path, pattern)
        try:
            for s in batches:
                yield pd.Series(list(own.encode(s)), dtype=object)
        finally:
            own.known = {}  # an idle worker holds no words

    return docs.select(docs[key], ids(docs[text].cast("string")).alias("ids"))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids",
           out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its packed ids (null: empty) as ``out``."""

    @F.pandas_udf("binary")
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = replay_of(path, pattern)
        for s in batches:
            yield pd.Series([own.decode(x if isinstance(x, (bytes, bytearray)) else b"") for x in s], dtype=object)

    return encoded.withColumn(out, back(encoded[ids]))


def _both(path: str, pattern: str):
    """Batches of texts to frames of ids and decoded bytes, which leave as soon as
    about BLOCK bytes of them are there."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def frame(rows):
            return pd.DataFrame(rows, columns=["ids", "decoded"], dtype=object)

        own = replay_of(path, pattern)
        try:
            for s in batches:
                rows, size = [], 0
                for ids in own.encode(s):
                    rows.append((ids, own.decode(ids)))
                    size += len(rows[-1][1])
                    if size >= BLOCK:
                        yield frame(rows)
                        rows, size = [], 0
                yield frame(rows)
        finally:
            own.known = {}  # an idle worker holds no words
    return run


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """(key, ids, decoded): :func:`encode` and then :func:`decode` of its ids, one
    after the other in the same Python worker, so that a task holds one and the
    ids need not be written between the two."""

    @F.pandas_udf("ids binary, decoded binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _both(path, pattern)(batches)

    return docs.select(docs[key], both(docs[text].cast("string")).alias("_both")).select(key, "_both.ids", "_both.decoded")


def digests(decoded: DataFrame, key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256, *carry) of encoded, decoded
    rows."""
    return decoded.select(key, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"), *carry)
