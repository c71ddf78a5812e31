"""Edit-aware token counts.

Each document is kept as pre-tokens under a segment tree: a leaf holds a run of
pre-tokens (its text, their lengths and token counts), inner nodes hold sums of
code points and tokens.  An edit finds its place by descending the sums, cuts
the old pre-tokens from a little before it, and splits and counts anew until a
boundary of the old split is met again behind the edit.  The pattern looks at
most two characters past a match and never back, so from there on the old
pre-tokens stand.  Only the sums on the paths to touched leaves change.

Counts come from the merge replay of ``bpe``; documents are independent, so
there is no shuffle beyond the one that brings edits to their documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import MergeReplay, replay_of

#: Pre-tokens in a new leaf; a leaf that grows beyond eight times this is split
#: by rebuilding its tree.
LEAF = 64
#: Code points that a match may have looked at beyond its end, at most.
LOOK = 3
#: Code points split at first behind an edit; doubled until the split agrees.
AHEAD = 64


class Leaf:
    """A run of pre-tokens: text, lengths in code points, token counts."""
    __slots__ = ("text", "lengths", "counts")

    def __init__(self, text: str, lengths: list[int], counts: list[int]):
        self.text, self.lengths, self.counts = text, lengths, counts


class CountTree:
    """A document's pre-tokens and the sums over them."""

    def __init__(self, replay: MergeReplay, words: list[str], counts: list[int]):
        self.replay = replay
        self.encoded = 0
        self._build(words, counts)

    @classmethod
    def of(cls, replay: MergeReplay, text: str) -> CountTree:
        return next(trees(replay, [text]))

    def _build(self, words: list[str], counts: list[int]) -> None:
        self.leaves = [Leaf("".join(words[i:i + LEAF]), [len(w) for w in words[i:i + LEAF]], counts[i:i + LEAF])
                       for i in range(0, len(words), LEAF)] or [Leaf("", [], [])]
        size = 1
        while size < len(self.leaves):
            size *= 2
        self.size = size
        self.chars, self.tokens = [0] * (2 * size), [0] * (2 * size)
        for i, leaf in enumerate(self.leaves):
            self.chars[size + i], self.tokens[size + i] = len(leaf.text), sum(leaf.counts)
        for i in range(size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _update(self, leaf: int) -> None:
        i = self.size + leaf
        self.chars[i], self.tokens[i] = len(self.leaves[leaf].text), sum(self.leaves[leaf].counts)
        i //= 2
        while i:
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
            i //= 2

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds code point ``at``, and where it starts."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at >= start + self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return min(i - self.size, len(self.leaves) - 1), start

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(leaf.text for leaf in self.leaves)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace code points ``start`` to ``end`` (both cut to the text) by
        ``new`` and bring the sums up to date."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        # the first pre-token whose match may have looked at ``start``
        first, base = self._find(max(0, start - LOOK))
        leaf, keep, at = self.leaves[first], 0, base
        while keep < len(leaf.lengths) and at + leaf.lengths[keep] + LOOK <= start:
            at += leaf.lengths[keep]
            keep += 1
        begin = at
        # old text from there on, taken in as far as the split needs it
        last, tail, ahead = first, leaf.text[begin - base:], AHEAD
        bounds, where = [], begin
        for n in leaf.lengths[keep:]:
            where += n
            bounds.append(where)
        while True:
            while len(tail) < end - begin + ahead and last + 1 < len(self.leaves):
                last += 1
                tail += self.leaves[last].text
                for n in self.leaves[last].lengths:
                    where += n
                    bounds.append(where)
            whole = last + 1 >= len(self.leaves)
            shift = len(new) - (end - start)
            fresh = tail[:start - begin] + new + tail[end - begin:]
            old = {b + shift for b in bounds if b >= end}
            ((found, entries),) = self.replay.block([fresh])
            words, pos, met = [], begin, None
            for w in found:
                if not whole and pos + len(w) + LOOK > begin + len(fresh):
                    break  # its match may depend on text not taken in yet
                words.append(w)
                pos += len(w)
                if pos >= start + len(new) and pos in old:
                    met = pos
                    break
            if met is not None or whole:
                break
            ahead *= 2
        counts = [e[1] for e in entries[:len(words)]]
        self.encoded += len(words)
        stop = begin + len(tail) if met is None else met - shift  # old code point from which all stands
        kept_len, kept_n, where = leaf.lengths[:keep], leaf.counts[:keep], begin
        rest_len, rest_n = [], []
        for k in range(first, last + 1):
            skip = keep if k == first else 0
            for n, c in zip(self.leaves[k].lengths[skip:], self.leaves[k].counts[skip:]):
                if where >= stop:
                    rest_len.append(n)
                    rest_n.append(c)
                where += n
        text = leaf.text[:begin - base] + "".join(words) + tail[stop - begin:]
        self.leaves[first] = Leaf(text, kept_len + [len(w) for w in words] + rest_len, kept_n + counts + rest_n)
        self._update(first)
        for k in range(first + 1, last + 1):
            self.leaves[k] = Leaf("", [], [])
            self._update(k)
        if len(self.leaves[first].lengths) > 8 * LEAF:
            words, counts = [], []
            for x in self.leaves:
                p = 0
                for n in x.lengths:
                    words.append(x.text[p:p + n])
                    p += n
                counts += x.counts
            self._build(words, counts)


def edited_counts(docs: DataFrame, edits: DataFrame, path: str, pattern: str, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(key, n_tokens, n_chars, n_edits, n_tokens_after, n_chars_after,
    n_reencoded), one row per row of ``docs``.

    ``edits`` (key, seq, start, stop, new): applied to their document by
    ``seq`` (ties: by the other columns), each in code points of the text as it
    is then; out-of-range places are cut to the text, a null ``start`` is the
    beginning, a null ``stop`` equals ``start``, a null ``new`` is empty.  Edits
    of unknown or null keys are ignored.  Null text counts as empty.  Repeated
    documents each get all edits of their key.  ``n_reencoded``: pre-tokens
    split and counted anew by the edits."""
    lists = (edits.filter(F.col(key).isNotNull())
             .select(F.col(key).alias("_k"), edit(*[F.col(c) for c in ("seq", "start", "stop", "new")]).alias("e"))
             .groupBy("_k").agg(F.array_sort(F.collect_list("e")).alias("edits")))
    rows = docs.select(docs[key].alias("_k"), docs[text].cast("string").alias("text")).join(lists, "_k", "left")
    return count_rows(rows, path, pattern).withColumnRenamed("_k", key)


def edit(seq: Column, start: Column, stop: Column, new: Column) -> Column:
    """One edit as a struct, nulls as in :func:`edited_counts`."""
    return F.struct(F.coalesce(seq.cast("long"), F.lit(0)).alias("seq"),
                    F.coalesce(start.cast("long"), F.lit(0)).alias("start"),
                    F.coalesce(stop, start, F.lit(0)).cast("long").alias("stop"),
                    F.coalesce(new.cast("string"), F.lit("")).alias("new"))


def counts_with_own_edits(docs: DataFrame, edits: Sequence[Column], path: str, pattern: str, key: str = "doc_id",
                          text: str = "text") -> DataFrame:
    """:func:`edited_counts` for edits made from each row itself (:func:`edit`
    columns over ``docs``, in order): every row gets its own, whatever ids repeat
    or are null, and nothing is shuffled."""
    rows = docs.select(docs[key].alias("_k"), docs[text].cast("string").alias("text"), F.array(*edits).alias("edits"))
    return count_rows(rows, path, pattern).withColumnRenamed("_k", key)


COUNTS = ("n_tokens long, n_chars long, n_edits long, n_tokens_after long, n_chars_after long, "
          "n_reencoded long")


def count_rows(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """The counting pass over (_k, text, edits) rows; see edited_counts."""

    @F.pandas_udf(COUNTS)
    def count(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        replay = replay_of(path, pattern)
        try:
            for texts, edits in batches:
                out = []
                for tree, own in zip(trees(replay, texts), edits):
                    row = [tree.n_tokens, tree.n_chars, 0 if own is None else len(own)]
                    for e in () if own is None else own:
                        tree.edit(e["start"], e["stop"], e["new"])
                    out.append((*row, tree.n_tokens, tree.n_chars, tree.encoded))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in COUNTS.split(", ")])
        finally:
            replay.known = {}

    return rows.select("_k", count("text", "edits").alias("c")).select("_k", "c.*")


def trees(replay: MergeReplay, texts: Iterable) -> Iterator[CountTree]:
    """A tree of each text (null: empty); a block of texts shares a replay."""
    block, size = [], 0

    def done():
        for words, entries in replay.block(block):
            yield CountTree(replay, words, [e[1] for e in entries])

    for t in texts:
        block.append(t if isinstance(t, str) else "")
        size += len(block[-1])
        if size >= 1 << 20:
            yield from done()
            block, size = [], 0
    yield from done()
