"""Chi-square divergence of the term distributions of sources.

Every (lang, source) group has a smoothed distribution over the terms its
language keeps.  The divergence of two groups is a sum over all kept terms, most
of which neither holds.  It is taken apart into

* what the sum would be if the groups shared no term: the terms of one against
  the *zero baseline* of the other.  Terms of equal count give equal summands, so
  this comes from each group's histogram of counts;
* a correction for each term that both hold.  These are accumulated row by row
  in Gustavson's manner: a group walks its terms through the term-major index
  and scatters the corrections of all peers that hold them into a dense
  accumulator with one cell a peer.  No pair of postings is ever a row of a table:
  tasks hand on one sum per (group, peer) and block of the index.

All numbers are integers and every sum is exact: the shares of a group add up to
SCALE and its number of terms, V, so a sum of gains stays below (SCALE + V)^2.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import join_per_group
from .common import stored, text_of

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
#: Counted terms a task holds before it hands them on, and words it counts at a time.
HELD_TERMS = 500_000
WAITING_WORDS = 400_000
#: Postings of the term-major index worked on at a time (whole terms).
BLOCK_POSTINGS = 200_000
#: Corrections scattered at a time.
SCATTER = 1 << 20

_LETTERS = bytes((c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32) for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of letters and of characters beyond
    ASCII, A-Z in lower case."""
    return text.translate(_LETTERS).split()


class _Numbers(dict):
    """Terms, numbered as they come."""

    def __missing__(self, term):
        self[term] = n = len(self)
        return n


class _Counts:
    """Counts of one language's terms: by source, and in how many texts."""

    def __init__(self):
        self.terms, self.sources = _Numbers(), _Numbers()
        self.docs = np.zeros(0, np.int64)
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)  # term and source, sorted
        self.waiting: list[tuple[int, np.ndarray]] = []
        self.words = 0

    def add(self, source: str, found: list[bytes]) -> None:
        ids = np.fromiter(map(self.terms.__getitem__, found), np.int64, len(found))
        self.waiting.append((self.sources[source], ids))
        self.words += len(found)
        if self.words > WAITING_WORDS:
            self.settle()

    def settle(self) -> None:
        """Counts what waits."""
        if not self.words:
            self.waiting.clear()
            return
        length = [len(ids) for _, ids in self.waiting]
        text = np.repeat(np.arange(len(length)) << 32, length)
        once, n = np.unique(text | np.concatenate([ids for _, ids in self.waiting]), return_counts=True)
        term = once & 0xFFFFFFFF
        self.docs = np.pad(self.docs, (0, len(self.terms) - len(self.docs))) + np.bincount(term, minlength=len(self.terms))
        source = np.array([s for s, _ in self.waiting], np.int64)[once >> 32]
        keys, counts = np.append(self.keys, term << 32 | source), np.append(self.n, n)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        self.keys, self.n = keys[first], np.add.reduceat(counts[order], first)
        self.waiting.clear()
        self.words = 0

    def batches(self, lang: str):
        """A row per term, with the counts of its sources."""
        self.settle()
        terms = pa.array(list(self.terms), pa.binary()).cast(pa.string())
        sources = pa.array(list(self.sources), pa.string())
        starts = np.append(np.flatnonzero(np.diff(self.keys >> 32, prepend=-1)), len(self.keys))
        for at in range(0, len(starts) - 1, 1 << 14):
            of = starts[at:at + (1 << 14) + 1]
            cells = slice(of[0], of[-1])
            offsets = pa.array((of - of[0]).astype(np.int32))
            m = len(of) - 1
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * m, pa.string()), terms.slice(at, m), pa.array(self.docs[at:at + m]),
                pa.ListArray.from_arrays(offsets, sources.take(pa.array(self.keys[cells] & 0xFFFFFFFF))),
                pa.ListArray.from_arrays(offsets, pa.array(self.n[cells]))], names=["lang", "term", "docs", "sources", "n"])


def _whole_terms(batches, fold=None):
    """Batches sorted by (term, lang) as tables of about BLOCK_POSTINGS rows that
    hold each term whole; a longer run of one term is made shorter by ``fold``."""
    def last_start(batch):
        same = np.ones(batch.num_rows, bool)
        for name in ("term", "lang"):
            same &= pc.equal(batch[name], batch[name][batch.num_rows - 1]).to_numpy(zero_copy_only=False)
        return 0 if same.all() else len(same) - int(np.argmin(same[::-1]))

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = last_start(batch)
        if size + cut > BLOCK_POSTINGS:
            if cut:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held, size, batch = [], 0, batch.slice(cut)
            elif fold:
                held = fold(pa.Table.from_batches(held)).to_batches()
                size = sum(b.num_rows for b in held)
        held.append(batch)
        size += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _runs(table: pa.Table) -> np.ndarray:
    """Numbers of the (term, lang) runs of a sorted table."""
    new = np.zeros(table.num_rows, bool)
    for name in ("term", "lang"):
        column = table[name].combine_chunks()
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.cumsum(new)


def _flat(batches):
    for batch in batches:
        row = pc.list_parent_indices(batch["n"])
        docs = np.zeros(len(row), np.int64)  # a term's texts stand with its first source
        docs[np.unique(row.to_numpy(), return_index=True)[1]] = batch["docs"].to_numpy()
        yield pa.RecordBatch.from_arrays([
            batch["lang"].take(row), batch["term"].take(row), pa.array(docs), pc.list_flatten(batch["sources"]),
            pc.list_flatten(batch["n"])], names=["lang", "term", "docs", "source", "n"])


def _folded(table: pa.Table) -> pa.Table:
    """One row per term, language and source, still in order."""
    run = _runs(table)
    names = table["source"].combine_chunks().dictionary_encode()
    key = run << 32 | names.indices.to_numpy().astype(np.int64)
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    some = table.take(pa.array(order[first]))
    for name in ("docs", "n"):
        some = some.set_column(some.schema.get_field_index(name), name, pa.array(
            np.add.reduceat(table[name].to_numpy()[order], first)))
    return some


def _merge(min_docs: int):
    def run(batches):
        for table in _whole_terms(_flat(batches), _folded):
            table = _folded(table)
            runs = _runs(table)
            first = np.flatnonzero(np.diff(runs, prepend=-1))
            docs, total = (np.add.reduceat(table[c].to_numpy(), first)[runs] for c in ("docs", "n"))
            table = table.append_column("lang_n", pa.array(total)).filter(pa.array(docs >= min_docs))
            yield from table.select(["lang", "source", "term", "n", "lang_n"]).combine_chunks().to_batches(1 << 16)
    return run


def _count(batches):
    counts: dict[str, _Counts] = {}

    def emptied():
        for lang in list(counts):
            yield from counts.pop(lang).batches(lang)

    for batch in batches:
        for text, lang, source in zip(*(c.to_pylist() for c in batch.columns)):
            counts.setdefault(lang, _Counts()).add(source, terms_of(text))
        if sum(len(c.terms) + len(c.keys) // 8 for c in counts.values()) > HELD_TERMS:
            yield from emptied()
    yield from emptied()


def smoothed(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total), exact for counts of any size."""
    wide = F.call_function("div", (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"),
                           total.cast("decimal(20,0)"))
    return F.lit(1) + F.when(count < 2 ** 63 // SCALE - 1, F.call_function("div", (count + 1) * F.lit(SCALE).cast("long"), total)
                             ).otherwise(wide)


def gain(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """Two stored tables: kept terms (lang, source, term, n, p, q0, term_p), and
    groups (lang, source, total, terms, kept, p0).

    ``n`` is the count of the term in the group, ``p`` its smoothed share there,
    ``term_p`` that in the whole language, ``q0``/``p0`` the group's share of a
    term it lacks.  ``total`` is N + V, ``terms`` how many terms the group holds
    and ``kept`` how many the language keeps.  Null texts, languages and sources
    count as empty strings; a group without a kept term is still a group."""
    blank = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    rows = docs.select(text_of(docs, text).cast("binary").alias("text"), blank(lang).alias("lang"),
                       blank(source).alias("source"))
    found = rows.mapInArrow(_count, "lang string, term string, docs long, sources array<string>, n array<long>")
    counts = stored(found.repartition("term", "lang").sortWithinPartitions("term", "lang").mapInArrow(
        _merge(min_docs), "lang string, source string, term string, n long, lang_n long"), "counts")
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("terms"))
    langs = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_distinct("term").alias("kept"))
    zero = F.lit(0).cast("long")
    groups = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
    groups = join_per_group(groups, langs, ["lang"], "left").select(
        "lang", "source", F.coalesce("terms", zero).alias("terms"), F.coalesce("kept", zero).alias("kept"),
        (F.coalesce("n", zero) + F.coalesce("kept", zero)).alias("total"),
        (F.coalesce("lang_total", zero) + F.coalesce("kept", zero)).alias("lang_total"))
    groups = stored(groups.withColumn("p0", F.when(F.col("total") > 0, smoothed(zero, F.col("total")))), "groups")
    shares = join_per_group(counts, groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", smoothed(F.col("n"), F.col("total")).alias("p"), "p0",
        smoothed(F.col("lang_n"), F.col("lang_total")).alias("term_p"))
    return shares, groups


def _gain(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def row_accumulation(row_of: np.ndarray, term_of: np.ndarray, p: np.ndarray, p0: np.ndarray, starts: np.ndarray,
                     rows: int):
    """Gustavson's method on one block of the index.

    The postings stand in term order: ``row_of`` is the group's number, ``term_of``
    the term's, ``starts`` where each term's postings start (one more at the end).
    Yields, group by group, its number and the accumulator of ``rows`` sums."""
    by_row = np.argsort(row_of, kind="stable")
    bounds = np.searchsorted(row_of[by_row], np.arange(rows + 1))
    width = np.diff(starts)
    for g in range(rows):
        mine = by_row[bounds[g]:bounds[g + 1]]
        peers = np.zeros(rows, np.int64)
        reach = np.cumsum(width[term_of[mine]])
        at = 0
        while at < len(mine):  # as many of the group's terms as SCATTER allows
            to = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + SCATTER, "right")))
            some = mine[at:to]
            n = width[term_of[some]]
            ends = np.cumsum(n)
            other = np.arange(ends[-1]) + np.repeat(starts[term_of[some]] - (ends - n), n)
            own = np.repeat(some, n)
            a, a0, b, b0 = p[own], p0[own], p[other], p0[other]
            np.add.at(peers, row_of[other], _gain(a, b) - _gain(a, b0) - _gain(a0, b) + _gain(a0, b0))
            at = to
        yield g, peers


def _accumulate(batches):
    """Batches of postings sorted by (lang, term) to sums per (group, peer)."""
    out = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def done(table):
        table = table.combine_chunks()
        for lang in table["lang"].unique().to_pylist():
            part = table.filter(pc.equal(table["lang"], lang))
            names = part["source"].combine_chunks().dictionary_encode()
            row_of = names.indices.to_numpy().astype(np.int64)
            runs = _runs(part)
            starts = np.append(np.flatnonzero(np.diff(runs, prepend=-1)), len(runs))
            p, p0 = (part[c].to_numpy().astype(np.int64) for c in ("p", "p0"))
            sources = names.dictionary
            for g, sums in row_accumulation(row_of, runs, p, p0, starts, len(sources)):
                sums[g] = 0
                peers = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(peers), pa.string()), pa.array([sources[g].as_py()] * len(peers), pa.string()),
                    sources.take(pa.array(peers)), pa.array(sums[peers], pa.int64())], schema=out)

    for table in _whole_terms(batches):
        yield from done(table)


def pair_values(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the divergence of each group from each
    other source of its language, over all kept terms."""
    index = shares.select("lang", "term", "source", "p", "p0").repartition("term", "lang").sortWithinPartitions("term", "lang")
    both = index.mapInArrow(_accumulate, "lang string, source string, item string, value long")
    peers = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("terms").alias("item_terms"))
    mine = groups.select("lang", "source", "p0", "terms", "kept")
    pairs = join_per_group(mine, peers, ["lang"]).filter("source != item")
    neither = pairs.select("lang", "source", "item", F.when(
        F.col("kept") > 0, gain(F.col("p0"), F.col("q0")) * (F.col("kept") - F.col("terms") - F.col("item_terms"))
    ).otherwise(0).alias("value"))
    # a group's terms against its peers' baselines, and its baseline against theirs
    levels = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("z"))
    alone = join_per_group(levels, others, ["lang"]).filter("source != item").groupBy("lang", "source", "item").agg(
        F.sum(gain(F.col("p"), F.col("z")) * F.col("times")).alias("value"),
        F.sum(gain(F.col("z"), F.col("p")) * F.col("times")).alias("back"))
    alone = alone.select(F.inline(F.array(
        F.struct("lang", "source", "item", "value"),
        F.struct("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))))
    return (neither.unionByName(alone).unionByName(both)
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def term_values(shares: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value): the terms a group uses more than its
    language does, by their share of the divergence from it; at least the
    ``top`` first of each group, with ties.

    How many terms reach each power of two tells from where on they can
    be among the first, so that only these are sorted."""
    rows = shares.filter(F.col("p") > F.col("term_p")).select(
        "lang", "source", F.col("term").alias("item"), gain(F.col("p"), F.col("term_p")).alias("value"))
    level = F.length(F.bin("value"))
    above = W.partitionBy("lang", "source").orderBy(F.desc("level"))
    least = (rows.groupBy("lang", "source", level.alias("level")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("n", F.sum("n").over(above) - F.col("n")).filter(F.col("n") < top)
             .groupBy("lang", "source").agg(F.min("level").alias("level")))
    return join_per_group(rows, least, ["lang", "source"]).filter(level >= F.col("level")).drop("level")


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
               top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): all ``pair`` rows and the first
    ``top`` ``term`` rows of every group, largest value first, ties by the item's
    bytes.

    An empty table gives no row; a language with one source no ``pair`` row; a
    language that keeps no term only ``pair`` rows of value 0."""
    shares, groups = term_counts(docs, text, lang, source)
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                                            F.row_number().over(order).alias("rank"))
    return ranked(pair_values(shares, groups), "pair").unionByName(
        ranked(term_values(shares, top), "term").filter(F.col("rank") <= top))


#: The same report in DuckDB SQL, over all pairs of groups and terms.
DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
occurrences AS (SELECT lang, source, row, unnest(terms) AS term FROM d),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM occurrences GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
counts AS (
  SELECT o.lang, o.source, o.term, count(*)::HUGEINT AS n
  FROM occurrences o JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(max(v), 0) AS v, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
  FROM (SELECT x.lang, x.source, x.term, x.n, x.p, 1 + (1000000000 * (k.n + 1)) // (l.total + l.v) AS q
        FROM dense x JOIN kept k USING (lang, term) JOIN langs l USING (lang))
  WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (FROM pairs UNION ALL FROM terms))
WHERE part = 'pair' OR rank <= 200
"""
