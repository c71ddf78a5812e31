"""Language identification with a bit-sliced Bloom filter of n-grams.

Learning counts, over all labelled texts, in how many texts of each language
an n-gram occurs (counted per partition in numpy, then a grouped sum).  An
n-gram belongs to every language where its rate is at least ``SHARE`` of its
highest rate.  The filter has ``slots`` words; bit ``l`` of a word belongs to
language ``l``, so ANDing the words of an n-gram's ``HASHES`` slots returns all
languages that contain it at once.  A text is decided by the bit counts per
language, corrected for the false positives expected from each language's
fill.  The number of slots follows the n-grams of the fullest language, so that
its fill stays at ``FILL``; a filter over ``FILTER_BYTES`` is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

NGRAMS = (3, 4)
HASHES = 3
#: Least number of slots, the highest share of them that a language fills, and
#: the largest filter that is broadcast (4 million n-grams of a language, up to
#: 64 languages).
SLOTS = 1 << 19
FILL = 0.3
FILTER_BYTES = 1 << 28
#: Slots that the driver gets in one row.
_BLOCK = 1 << 12
#: An n-gram belongs to languages where its rate is this share of its best.
SHARE = 0.25
#: N-grams seen in fewer labelled texts are left out (typing errors).
MIN_TEXTS = 2
MAX_LANGUAGES = 4096
UNDETERMINED = "und"
#: Code points handled at a time; a longer text is cut with an overlap.
PIECE = 1 << 18
_CHUNK = 1 << 18
#: Partial counts held by a task before they are handed on, and rows of a frame
#: that it hands on.
_HELD = 1 << 18
_SENT = 1 << 16

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


def _grams(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams in ``codes`` (0 stands for no letter) and their
    start positions: windows with a letter and without two neighbouring
    non-letters."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gap = codes == 0
    pair = np.concatenate(([0], np.cumsum(gap[1:] & gap[:-1])))
    at = np.flatnonzero(pair[n - 1:n - 1 + m] == pair[:m])
    h = np.full(len(at), n, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[at + k]
    return _mix(h), at


def _pieces(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of (codes, row of each code): lower-cased letters, 0 for anything
    else, each text between two zeros; long texts are cut with an overlap of
    the longest n-gram less one, marked by the row -1 so nothing counts twice."""
    letters, over = _letters(), max(NGRAMS) - 1
    codes, rows, held = [], [], 0
    for r, t in enumerate(texts):
        if not isinstance(t, str):  # null
            continue
        t = t.lower()
        for lo in range(0, len(t), PIECE):
            c = np.frombuffer(t[max(0, lo - over):lo + PIECE].encode("utf-32-le", "replace"), np.uint32)
            c = np.where(letters[c], c, 0).astype(np.uint64)
            if not lo:
                c = np.concatenate(([np.uint64(0)], c))
            if lo + PIECE >= len(t):
                c = np.concatenate((c, [np.uint64(0)]))
            codes += [c, np.zeros(2, np.uint64)]
            rows.append((r, len(c) + 2, min(lo, over)))
            held += len(c) + 2
            if held >= _CHUNK:
                yield np.concatenate(codes), rows
                codes, rows, held = [], [], 0
    if rows:
        yield np.concatenate(codes), rows


def gram_rows(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-gram hashes, row of each) over an iterable of texts, in chunks."""
    for codes, rows in _pieces(texts):
        row = np.repeat([r for r, _, _ in rows], [n for _, n, _ in rows])
        starts = np.cumsum([0] + [n for _, n, _ in rows[:-1]])
        for n in NGRAMS:
            h, at = _grams(codes, n)
            # windows of one piece, and not those that the piece before has counted
            piece = np.searchsorted(starts, at, side="right") - 1
            end = at - starts[piece] + n
            new = (end > np.asarray([o for _, _, o in rows])[piece]) & (end <= np.asarray([m - 2 for _, m, _ in rows])[piece])
            yield h[new], row[at][new]


def _counts(languages: list[str]):
    """Partition pass: (lang, gram, n) texts of each language with a gram."""
    number = {x: i for i, x in enumerate(languages)}

    def flush(parts):
        lang, gram, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((gram, lang))
        lang, gram, n = lang[order], gram[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], (lang[1:] != lang[:-1]) | (gram[1:] != gram[:-1]))))
        return lang[first], gram[first], np.add.reduceat(n, first)

    def frames(part):
        for lo in range(0, len(part[0]), _SENT):
            lang, gram, n = (x[lo:lo + _SENT] for x in part)
            yield pd.DataFrame({"l": lang, "gram": gram.view(np.int64), "n": n})

    def run(batches):
        parts, held = [], 0
        for pdf in batches:
            lang = pdf["lang"].map(number).to_numpy(np.int32)
            for h, row in gram_rows(pdf["text"]):
                if not len(h):
                    continue
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                own = np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
                h, of = h[own], lang[row[own]]
                parts.append(flush([(of, h, np.ones(len(h), np.int64))]))
                held += len(parts[-1][0])
                if held >= _HELD:
                    parts = [flush(parts)]
                    held = len(parts[0][0])
                    if held >= _HELD:
                        yield from frames(parts[0])
                        parts, held = [], 0
        if parts:
            yield from frames(flush(parts))
    return run


def _slots(h: np.ndarray, slots: int) -> list[np.ndarray]:
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(slots - 1)).astype(np.int64) for i in range(HASHES)]


@dataclass
class LanguageFilter:
    """``words[s, w]``: languages 64w..64w+63 of slot ``s``."""
    languages: list[str]
    words: np.ndarray

    def false_rates(self) -> np.ndarray:
        """Per language: chance that an unseen n-gram passes all its slots."""
        bits = [(self.words[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                for i in range(len(self.languages))]
        return np.array([float(b.mean()) ** HASHES for b in bits])

    def judge(self, texts) -> tuple[list[str], list[float]]:
        """(language, score) of each text; see :func:`identify`."""
        texts, k = list(texts), len(self.languages)
        hits, total = np.zeros((k, len(texts))), np.zeros(len(texts))
        for h, row in gram_rows(texts):
            total += np.bincount(row, minlength=len(texts))
            mask = None
            for s in _slots(h, len(self.words)):
                mask = self.words[s] if mask is None else mask & self.words[s]
            for i in range(k):
                has = (mask[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) == 1
                hits[i] += np.bincount(row[has], minlength=len(texts))
        false = self.false_rates()[:, None] if k else np.zeros((0, 1))
        true = np.clip((hits - total * false) / np.maximum(1 - false, 1e-9), 0, None)
        letters = _letters()
        langs, scores = [], []
        for j, t in enumerate(texts):
            spoken = isinstance(t, str) and any(letters[ord(c)] for c in t)
            if not spoken or not k:
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            best = int(np.argmax(true[:, j]))
            langs.append(self.languages[best])
            scores.append(float(true[best, j] / true[:, j].sum()) if true[best, j] > 0 else 0.0)
        return langs, scores


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang",
          slots: int = SLOTS) -> LanguageFilter:
    """Filter learnt from all rows with a text and a non-null language, of at
    least ``slots`` slots (a power of two)."""
    rows = labelled.select(labelled[text].cast("string").alias("text"),
                           labelled[lang].cast("string").alias("lang")).filter(
        "text IS NOT NULL AND lang IS NOT NULL")
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    n_texts = {r["lang"]: r["count"] for r in sizes}
    languages = sorted(n_texts)
    width = max(1, -(-len(languages) // 64))
    if not languages:
        return LanguageFilter(languages, np.zeros((slots, width), np.uint64))
    weight = F.element_at(F.array(*[F.lit(1.0 / n_texts[x]) for x in languages]), F.col("l") + 1)
    seen = (rows.mapInPandas(_counts(languages), "l int, gram long, n long")
            .groupBy("gram", "l").agg(F.sum("n").alias("n"))
            .groupBy("gram").agg(F.sum("n").alias("texts"), F.max(F.col("n") * weight).alias("best"),
                                 F.collect_list(F.struct("l", (F.col("n") * weight).alias("rate"))).alias("of"))
            .filter(F.col("texts") >= MIN_TEXTS)
            .select("gram", "best", F.explode("of").alias("o"))
            .filter(F.col("o.rate") >= SHARE * F.col("best")).select("gram", F.col("o.l").alias("l")))

    seen = stored(seen, "grams")
    fullest = seen.groupBy("l").count().agg(F.max("count")).first()[0] or 0
    while 1 - np.exp(-HASHES * fullest / slots) > FILL:
        slots *= 2
    if slots * width * 8 > FILTER_BYTES:
        raise ValueError(f"{len(languages)} languages with up to {fullest} n-grams need a filter of {slots * width * 8} bytes")
    words = np.zeros((slots, width), np.uint64)

    def to_slots(batches):
        for pdf in batches:
            h, lang = pdf["gram"].to_numpy(np.int64).view(np.uint64), pdf["l"].to_numpy(np.int32)
            for s in _slots(h, slots):
                yield pd.DataFrame({"slot": s, "word": lang // 64,
                                    "bits": (np.uint64(1) << (lang % 64).astype(np.uint64)).view(np.int64)})

    filled = (seen.mapInPandas(to_slots, "slot long, word int, bits long")
              .groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")))
    def pack(key, pdf):
        block = np.zeros((min(_BLOCK, slots), width), np.uint64)
        block[pdf["slot"].to_numpy() % _BLOCK, pdf["word"].to_numpy()] = pdf["bits"].to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame({"block": [key[0]], "words": [block.tobytes()]})

    got = (filled.groupBy(F.shiftright("slot", _BLOCK.bit_length() - 1).alias("block"))
           .applyInPandas(pack, "block long, words binary").toArrow())  # at most FILTER_BYTES
    for block, held in zip(got["block"].to_pylist(), got["words"]):
        at = block * _BLOCK
        words[at:at + _BLOCK] = np.frombuffer(held.as_buffer(), np.uint64).reshape(-1, width)
    return LanguageFilter(languages, words)


def identify(docs: DataFrame, model: LanguageFilter, key: str = "doc_id", text: str = "text",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, *carry, lang_pred, score), one row per input row.

    ``lang_pred`` is the language with the highest corrected count (ties: the
    first by name), ``und`` if the text is null or has no letter or nothing was
    learnt.  ``score`` is its share of all corrected counts, 0 without any."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((model.languages, model.words))

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = LanguageFilter(*held.value)
        for s in batches:
            langs, scores = own.judge(s)
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return (docs.select(docs[key], *[docs[c] for c in carry],
                        judge(docs[text].cast("string")).alias("judged"))
            .select(key, *carry, "judged.lang_pred", "judged.score"))


def held_out(docs: DataFrame, key: str = "doc_id"):
    """The rows kept from learning: crc32 of the key as text, mod 3, is 1
    (false for a null key, which is not learnt from either)."""
    return F.coalesce(F.crc32(docs[key].cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_id(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                ) -> DataFrame:
    """(key, held_out, lang_pred, score): learnt from the rows that are not
    held out, applied to all.  An empty table gives an empty result."""
    model = learn(docs.filter(docs[key].isNotNull() & ~held_out(docs, key)), text, lang)
    out = identify(docs, model, key, text)
    return out.select(key, held_out(out, key).alias("held_out"), "lang_pred", "score")
