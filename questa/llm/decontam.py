"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies: every document is cut into passages of ``PASSAGE``
   words; a pass over all of them counts in how many passages each word bucket
   occurs (numpy per partition, then a grouped sum).
2. Randomised SVD of the benchmark's TF-IDF passages: with a random matrix W
   (made from the words' hashes, so it needs no exchange) the partitions of the
   benchmark give parts of ``A'AW``, a grouped sum adds them, and its QR gives an
   orthonormal basis Q of the leading right singular space.  Cosines do not
   change under rotation, so the last rotation to singular vectors is left out.
3. Candidate search: passages fall into classes by length.  For each class the
   documents' windows of that many words, starting every quarter of it, are
   folded into the latent space and compared with all passages of the class in
   blocks (a stated query set against all rows).  Only pairs with enough weight
   and cosine go on; there is no other way to a result.
4. Verification: longest common subsequence of words between the passage and
   the text around the window (bit-parallel); below COPY but not below
   PARAPHRASE the shared words must carry COPY of the passage's weight, and the
   answer, the item's last sentence, must be there as well.

Words are runs of letters, digits and marks; in scripts written without spaces
every character is a word.  The benchmark's passages are made in tasks and
handled in blocks of about BLOCK_WORDS words, so what is broadcast (vocabulary,
basis, passages) has a fixed bound whatever the items' lengths; more blocks mean
more passes over the documents.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Words of a passage; passages start every half passage.
PASSAGE = 32
HALF = PASSAGE // 2
#: Buckets of the word counts (2 MB of doubles).
BUCKETS = 1 << 18
RANK = 96
COPY = 0.6
PARAPHRASE = 0.4
ANSWER = 0.8
#: Length classes of passages: the windows they are looked up with.  Windows
#: start every quarter of their width, so one of them is off by an eighth at most.
WIDTHS = (1, 2, 4, 6, 8, 12, 16, 24, PASSAGE)
#: Share of a passage's weight that a window's known words must reach: what the
#: verification asks of the text, less an eighth for the window's place.
ENERGY = PARAPHRASE * 7 / 8
#: Cosine of candidates: a window with COPY of the passage's words, an eighth
#: off its place, has 0.525 among foreign words of the same weight.
COSINE = 0.5
#: Shorter passages (of whole items) must be there in full.
SHORT = 5
BLOCK_WORDS = 1 << 15
#: A longer answer cannot stand within two passages on both sides of a window.
ANSWER_WORDS = int(5 * PASSAGE / ANSWER)
_BYTES = 1 << 20

#: Code points of scripts without spaces between words (Thai and
#: Lao, Myanmar, Khmer, kana and their extensions, Han and its extensions).
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF),
            (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))
_KINDS: list[np.ndarray] = []
# bytes between words of every script
_GAP = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_PRIME = np.uint64(0x100000001B3)
_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of the hash's base and of its inverse modulo 2**64."""
    if not _POWERS:
        inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
        for base in (_PRIME, inverse):
            p = np.full(_BYTES + 2, base, np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=np.uint64))
    return _POWERS


def _kinds() -> np.ndarray:
    """Per code point: 0 between words, 1 part of a word, 2 a word by itself."""
    if not _KINDS:
        kind = np.fromiter((unicodedata.category(chr(c))[0] in "LNM" for c in range(0x110000)), np.uint8, 0x110000)
        for lo, hi in UNSPACED:
            kind[lo:hi + 1] *= 2
        _KINDS.append(kind)
    return _KINDS[0]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _hash_words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word in at most _BYTES code points."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = _kinds()[codes]
    codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    run = np.concatenate(([False], kind == 1, [False]))
    alone = kind == 2
    start = np.flatnonzero(run[1:-1] & ~run[:-2] | alone)
    end = np.flatnonzero(run[1:-1] & ~run[2:] | alone) + 1
    up, down = _powers()
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(np.where(kind > 0, codes, 0) * up[:len(codes)], dtype=np.uint64)))
    return _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)), start


def _cut(text: bytes) -> int:
    """Where to end the first piece of a longer text: behind its last gap, else
    before its last character."""
    piece = np.frombuffer(text[:_BYTES], np.uint8)
    for ends in (np.flatnonzero(_GAP[piece]) + 1, np.flatnonzero((piece & 0xC0) != 0x80)):
        if len(ends) and ends[-1]:
            return int(ends[-1])
    return len(piece)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts one after the other, and each text's offset
    (one more than texts).  Texts are UTF-8; long ones go in pieces cut where
    no word is."""
    out: list[np.ndarray] = []
    counts = np.zeros(len(texts), np.int64)
    held: list[str] = []
    rows: list[int] = []

    def flush() -> None:
        if held:
            h, start = _hash_words(" ".join(held))
            at = np.cumsum([0] + [len(t) + 1 for t in held[:-1]])
            n = np.bincount(np.searchsorted(at, start, side="right") - 1, minlength=len(held))
            np.add.at(counts, rows, n)
            out.append(h)
            held.clear()
            rows.clear()

    size = 0
    for i, t in enumerate(texts):
        while t:
            if size + len(t) + 1 > _BYTES:
                flush()
                size = 0
            cut = len(t) if len(t) < _BYTES else _cut(t)
            held.append(t[:cut].decode("utf-8", "replace"))
            rows.append(i)
            size += cut + 1
            t = t[cut:]
    flush()
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(counts)))


def _batches(series_iter) -> Iterator[tuple]:
    """Column batches cut into runs of a few megabytes of text."""
    for keys, texts in series_iter:
        texts = [t if isinstance(t, bytes) else b"" for t in texts]
        lo = size = 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= 2 * _BYTES:
                yield keys[lo:i + 1], texts[lo:i + 1]
                lo, size = i + 1, 0
        if lo < len(texts):
            yield keys[lo:], texts[lo:]


# ----------------------------------------------------------- corpus statistics

def passage_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Weight (inverse passage frequency) of each word bucket, over all
    passages of all documents."""

    def run(batches):
        df, n = np.zeros(BUCKETS, np.int64), 0
        for _, texts in _batches((p.index, p["text"]) for p in batches):
            h, at = word_hashes(texts)
            count = np.diff(at)
            cells = -(-count // PASSAGE)
            place = np.arange(len(h)) - np.repeat(at[:-1], count)
            passage = np.repeat(np.cumsum(cells) - cells, count) + place // PASSAGE
            key = (passage.astype(np.uint64) << np.uint64(18)) | (h & np.uint64(BUCKETS - 1))
            key.sort()
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            df += np.bincount((key[first] & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
            n += int(cells.sum())
        used = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": np.append(used, -1), "n": np.append(df[used], n)})

    rows = docs.select(F.lower(docs[text].cast("string")).cast("binary").alias("text"))
    got = (rows.mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
           .toArrow())  # at most BUCKETS + 1 rows
    bucket, count = got["bucket"].to_numpy(), got["n"].to_numpy()
    df, n = np.zeros(BUCKETS), float(count[bucket < 0].sum())
    df[bucket[bucket >= 0]] = count[bucket >= 0]
    return np.maximum(np.log((1 + n) / (1 + df)), 0.01)


# --------------------------------------------------------------- the benchmark

def passages_of(n: int) -> list[tuple[int, int]]:
    """(start, end) of the passages of ``n`` words: whole if short, else every
    HALF words with the last ending at the end."""
    if n <= PASSAGE:
        return [(0, n)] if n else []
    return [(s, s + PASSAGE) for s in range(0, n - PASSAGE, HALF)] + [(n - PASSAGE, n)]


def _random_rows(h: np.ndarray, rank: int) -> np.ndarray:
    """Rows of the random matrix: normal numbers made from the word's hash."""
    j = np.arange(rank, dtype=np.uint64)[None, :]
    bits = [_mix(h[:, None] * np.uint64(2 * s + 3) + j * np.uint64(0x9E3779B97F4A7C15) + np.uint64(s)) for s in (1, 2)]
    u, v = ((b >> np.uint64(11)).astype(np.float64) + 0.5 for b in bits)
    return np.sqrt(-2 * np.log(u / 2 ** 53)) * np.cos(2 * np.pi * v / 2 ** 53)


def answer_of(text: str) -> str:
    """What must be there of a paraphrased item: what follows its last question
    mark, else its last sentence with at least three words, else all."""
    after = re.split(r"[?\uff1f]", text)[-1]
    if after.strip() and after != text:
        return after
    for part in reversed(re.split(r"(?<=[.!?])\s+|(?<=[\u3002\uff01])|\n", text)):
        if len(word_hashes([part.encode("utf-8", "replace")])[0]) >= 3:
            return part
    return text


_PASSAGES = "item long, body long, start long, words array<long>, answer array<long>"


def passages(items: DataFrame) -> DataFrame:
    """(item, body, start, words, answer): the passages of ``items`` (item,
    body, text) with the hashes of their words; an answer over ANSWER_WORDS is
    left empty, as nothing can hold it."""

    def run(batches):
        for pdf in batches:
            for item, body, t in zip(pdf["item"], pdf["body"], pdf["text"]):
                h = word_hashes([t.encode("utf-8", "replace")])[0].view(np.int64)
                a = word_hashes([answer_of(t).encode("utf-8", "replace")])[0].view(np.int64)
                a = a if len(a) <= ANSWER_WORDS else a[:0]
                cuts = passages_of(len(h))
                for lo in range(0, len(cuts), 1024):
                    some = cuts[lo:lo + 1024]
                    yield pd.DataFrame({"item": item, "body": body, "start": [s for s, _ in some],
                                        "words": [h[s:e] for s, e in some], "answer": [a] * len(some)})

    return items.mapInPandas(run, _PASSAGES)


def basis(passages: DataFrame, idf: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, Q): orthonormal basis of the leading latent space of the
    TF-IDF ``passages`` by randomised SVD."""
    held = passages.sparkSession.sparkContext.broadcast(idf)

    def run(batches):
        idf = held.value
        for pdf in batches:
            for words in pdf["words"]:
                terms, n = np.unique(np.asarray(words, np.int64).view(np.uint64), return_counts=True)
                w = n * idf[(terms & np.uint64(BUCKETS - 1)).astype(np.int64)]
                w = w / np.linalg.norm(w)
                z = np.outer(w, w @ _random_rows(terms, rank))
                yield pd.DataFrame({"term": np.repeat(terms.view(np.int64), rank),
                                    "j": np.tile(np.arange(rank), len(terms)), "z": z.ravel()})

    got = (passages.select("words").mapInPandas(run, "term long, j long, z double").groupBy("term", "j")
           .agg(F.sum("z").alias("z")).toArrow())  # at most BLOCK_WORDS * rank rows
    terms, row = np.unique(got["term"].to_numpy().view(np.uint64), return_inverse=True)
    z = np.zeros((len(terms), rank))
    z[row, got["j"].to_numpy()] = got["z"].to_numpy()
    return terms, np.linalg.qr(z)[0] if len(terms) else z


@dataclass
class Passages:
    """A block of the benchmark, as the documents' pass needs it."""
    terms: np.ndarray      # sorted word hashes
    weight: np.ndarray     # their idf
    basis: np.ndarray      # terms x rank, float32, times idf
    latent: np.ndarray     # passages x rank, unit length, float32
    energy: np.ndarray     # weight of each passage: sum of squared idf
    origin: list[tuple]    # (item, body, first word in it) of each passage
    words: list[list[int]]  # term numbers of each passage
    answer: list[list[int]]  # term numbers of each passage's item's answer

    @property
    def classes(self) -> list[tuple[int, np.ndarray]]:
        """(width, its passages) of each length class that has any."""
        size = np.array([len(w) for w in self.words])
        ids = [np.flatnonzero((size > lo) & (size <= w)) for lo, w in zip((0, *WIDTHS), WIDTHS)]
        return [(w, of) for w, of in zip(WIDTHS, ids) if len(of)]

    @property
    def places(self) -> list[dict[int, int]]:
        """:func:`places_of` each passage."""
        if not hasattr(self, "_places"):
            self._places = [places_of(w) for w in self.words]
        return self._places

    @property
    def table(self) -> np.ndarray:
        """Whether a term has these low bits."""
        if not hasattr(self, "_table"):
            self._table = np.zeros(BUCKETS, bool)
            self._table[(self.terms & np.uint64(BUCKETS - 1)).astype(np.int64)] = True
        return self._table

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Term number of each word hash, -1 if the block doesn't have it."""
        maybe = np.flatnonzero(self.table[(h & np.uint64(BUCKETS - 1)).astype(np.int64)])
        out = np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, h[maybe]), len(self.terms) - 1)
        hit = self.terms[at] == h[maybe]
        out[maybe[hit]] = at[hit]
        return out


def prepare(rows: list[tuple], terms: np.ndarray, q: np.ndarray, idf: np.ndarray) -> Passages:
    """The block of the passages ``rows`` (as of :func:`passages`)."""
    hashes = lambda words: np.asarray(words, np.int64).view(np.uint64)
    known = np.unique(np.concatenate([terms, *(hashes(r[4]) for r in rows)]))
    weight = idf[(known & np.uint64(BUCKETS - 1)).astype(np.int64)]
    folded = np.zeros((len(known), q.shape[1]), np.float32)  # words of answers only: no direction
    folded[np.searchsorted(known, terms)] = q * weight[np.searchsorted(known, terms)][:, None]
    words = [np.searchsorted(known, hashes(r[3])) for r in rows]
    latent = np.array([folded[w].sum(axis=0) for w in words], np.float32).reshape(-1, q.shape[1])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    return Passages(known, weight, folded, latent, np.array([(weight[w] ** 2).sum() for w in words]),
                    [tuple(r[:3]) for r in rows], [w.tolist() for w in words],
                    [np.searchsorted(known, hashes(r[4])).tolist() for r in rows])


# ------------------------------------------------------------------ the search

def places_of(a: list[int]) -> dict[int, int]:
    """One bit per place of each word."""
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    return places


def lcs(a: list[int], b: list[int], places: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence; ``places`` are those of ``a``."""
    places = places or places_of(a)
    full = (1 << len(a)) - 1
    row = full
    for p in filter(None, map(places.get, b)):
        u = row & p
        row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def _windows(at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the windows of ``width`` words that start every
    quarter width and end with their text."""
    step, count = max(1, width // 4), np.diff(at)
    windows = np.where(count > 0, 1 + np.maximum(-(-(count - width) // step), 0), 0)
    text = np.repeat(np.arange(len(count)), windows)
    start = at[:-1][text] + step * (np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows))
    return text, start, np.minimum(start + width, at[1:][text])


def _verified(block: Passages, number: np.ndarray, at: np.ndarray, t: int, start: int, end: int, p: int,
              half: int) -> tuple | None:
    """(lcs, passage words, kind) if the text around the window holds the passage."""
    passage = block.words[p]
    near = number[max(at[t], start - half):min(at[t + 1], end + half)]
    near = near[near >= 0].tolist()
    common, m = lcs(passage, near, block.places[p]), len(passage)
    if common >= (COPY * m if m >= SHORT else m):
        return common, m, "copy"
    if common >= PARAPHRASE * m and m >= SHORT:
        answer, shared = block.answer[p], set(passage) & set(near)
        weight = sum(block.weight[x] ** 2 for x in passage if x in shared)
        far = number[max(at[t], start - 2 * PASSAGE):min(at[t + 1], end + 2 * PASSAGE)]
        if len(answer) >= 3 and weight >= COPY * block.energy[p] and lcs(answer, far[far >= 0].tolist()) >= ANSWER * len(answer):
            return common, m, "paraphrase"
    return None


def _next(at: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Where the text of each place ends."""
    return at[np.minimum(np.searchsorted(at, place, side="right"), len(at) - 1)]


def _folded(block: Passages, number: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of the basis over the known words of each piece."""
    out = np.zeros((len(begin), block.basis.shape[1]), np.float32)
    for j in range(int((end - begin).max(initial=0))):
        own = np.where(begin + j < end, number[np.minimum(begin + j, len(number) - 1)], -1)
        some = np.flatnonzero(own >= 0)
        out[some] += block.basis[own[some]]
    return out


def search(block: Passages, h: np.ndarray, at: np.ndarray) -> Iterator[tuple]:
    """(text number, item, body, passage start, cosine, lcs, passage words, kind)
    of every verified pair of a text's window and a benchmark passage."""
    if not len(block.words) or not len(h):
        return
    number = block.numbers(h)
    square = np.concatenate(([0], np.cumsum(np.where(number >= 0, block.weight[number] ** 2, 0))))
    for width, ids in block.classes:
        text, start, end = _windows(at, width)
        energy, least, latent = square[end] - square[start], ENERGY * block.energy[ids], block.latent[ids].T
        maybe = np.flatnonzero(energy >= least.min())
        step = max(1, width // 4)
        for lo in range(0, len(maybe), 1024):
            w = maybe[lo:lo + 1024]
            # pieces of ``step`` words, each folded once, then summed by window
            piece = start[w][:, None] + step * np.arange(width // step)
            piece = np.minimum(piece, end[w][:, None])  # behind the text's end: empty
            begin, of = np.unique(piece, return_inverse=True)
            vec = _folded(block, number, begin, np.minimum(begin + step, _next(at, begin)))[of.reshape(piece.shape)]
            vec[piece == end[w][:, None]] = 0
            vec = vec.sum(axis=1)
            vec /= np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-12)
            cosine = vec @ latent
            for i, c in zip(*np.nonzero((cosine >= COSINE) & (energy[w][:, None] >= least))):
                k, p = w[i], ids[c]
                got = _verified(block, number, at, text[k], start[k], end[k], p, max(1, width // 2))
                if got:
                    yield int(text[k]), *block.origin[p], float(cosine[i, c]), *got


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[DataFrame]:
    """The passages of the distinct items, in blocks of about BLOCK_WORDS words
    dealt by hash."""
    rows = benchmark.select(benchmark[key].cast("long").alias("item"), F.lower(benchmark[text].cast("string")).alias("text"))
    rows = rows.filter("item IS NOT NULL AND text IS NOT NULL").distinct().select(
        "item", F.xxhash64("text").alias("body"), "text")
    cut = stored(passages(rows), "passages")
    blocks = -(-cut.count() * PASSAGE // BLOCK_WORDS)
    block = F.pmod(F.xxhash64("item", "body", "start"), F.lit(blocks))
    for b in range(blocks):
        yield cut.filter(block == b)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", rank: int = RANK) -> DataFrame:
    """(key, item_key, passages, cosine, lcs_share, kind): one row per document
    and benchmark item of which a passage was found.

    ``passages``: benchmark passages found (of all texts with that item's id);
    ``cosine`` and ``lcs_share``: the highest; ``kind``: copy if any was found as
    one, else paraphrase.  Null texts and items are empty, rows with a null key
    are left out, repeated rows count once, empty tables give an empty result;
    very long texts are read whole, in pieces."""
    spark = docs.sparkSession
    schema = (f"{key} long, {item_key} long, body long, start long, cosine double, lcs long, words long, kind string")
    fields = [f.split() for f in schema.split(", ")]
    names = [name for name, _ in fields]
    found = idf = None
    for part in _blocks(benchmark, item_key, item_text):
        if idf is None:
            idf = passage_frequencies(docs, text)
        rows = [tuple(r) for r in part.toLocalIterator()]  # about BLOCK_WORDS words
        if not rows:
            continue
        terms, q = basis(part, idf, min(rank, len(rows)))
        held = spark.sparkContext.broadcast(prepare(rows, terms, q, idf))

        def run(batches, held=held):
            block = held.value
            for keys, texts in _batches((p[key], p["text"]) for p in batches):
                keys = keys.to_numpy()
                rows = [(keys[t], *rest) for t, *rest in search(block, *word_hashes(texts))]
                yield pd.DataFrame(rows, columns=names)

        rows = docs.filter(docs[key].isNotNull()).select(
            docs[key].cast("long").alias(key), F.lower(docs[text].cast("string")).cast("binary").alias("text"))
        hits = rows.mapInPandas(run, schema)
        found = hits if found is None else found.union(hits)
    if found is None:  # not from a list: that would start Python workers of its own
        found = spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in fields])
    found = stored(found, "leaks")
    return found.groupBy(key, item_key).agg(
        F.count_distinct("body", "start").alias("passages"), F.max("cosine").alias("cosine"),
        F.max(F.col("lcs") / F.col("words")).alias("lcs_share"), F.min("kind").alias("kind"))
