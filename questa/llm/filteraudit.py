"""Audit of how corpus filters interact.

Five filters judge every document; :func:`filter_masks` says which of them it
fails, whichever come first.  Four look at the text alone.  The fifth, E, asks
for an identical text with a smaller id anywhere in the table and is answered by
radix tries:

1. each task inserts its texts into a compressed trie whose terminals hold the
   ids.  Ids above a terminal's smallest are duplicates already and go on without
   their text, so a text leaves a task once, however many copies it has there;
2. the rest is dealt by adaptive text prefixes (``tries.prefix_cuts``), so that
   the texts behind a common beginning are split as well;
3. each range is one trie again, and its terminals' smallest ids decide.

The masks are then reduced to counts by part, mask and label, at most 32 masks a
part and label, and :func:`audit` replays all 120 orders on those counts.
"""

from __future__ import annotations

from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import join_per_group
from .common import stored, text_of
from .tries import TRIE_BYTES, Trie, bucket_of, prefix_cuts

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
_CAPITALS = bytes(range(65, 91))
_MARKS = b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))
_DEALT = pa.schema([("bucket", pa.int32()), ("text", pa.binary()), ("id", pa.int64()), ("part", pa.string()),
                    ("mask", pa.string()), ("n", pa.int64())])
_MASKS = "id long, part string, mask string, n long"
_NO_ID = 1 << 63  # above every id


def text_mask(text: bytes) -> str:
    """The letters of A to D that a text (UTF-8) fails."""
    words = text.split()
    points = len(text.translate(None, _CONTINUED))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (("A" if len(words) < MIN_WORDS else "")
            + ("B" if 100 * len(set(words)) < MIN_DISTINCT * len(words) else "")
            + ("C" if 100 * capitals > MAX_CAPITALS * points else "")
            + ("D" if len(text.translate(None, _MARKS)) < len(text) else ""))


def _batches(rows: list[tuple], schema: pa.Schema):
    """Record batches of a bounded size."""
    start = size = 0
    for i, row in enumerate(rows, 1):
        size += 100 + (len(row[1] or b"") if schema is _DEALT else 0)
        if size > 4 << 20 or i == len(rows):
            columns = zip(*rows[start:i])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            start, size = i, 0


def _id(value: int) -> int | None:
    return None if value == _NO_ID else value


def _deal(bounds):
    def emptied(trie):
        rows = []
        for i, (text, _, ids) in enumerate(trie.terminals()):
            first, mask, bucket = min(ids)[0], text_mask(text), bucket_of(bounds.value, text)
            for k, ((doc, part), n) in enumerate(ids.items()):
                if doc == first:
                    rows.append((bucket, text, _id(doc), part, mask, n))
                else:  # spread: these need no range any more
                    rows.append((bucket + k, None, _id(doc), part, mask + "E", n))
        return _batches(rows, _DEALT)

    def run(batches):
        trie, rows = Trie(), 0
        for batch in batches:
            for doc, text, part in zip(*(c.to_pylist() for c in batch.columns)):
                ids = trie.insert(text)
                key = (_NO_ID if doc is None else doc, part)
                ids[key] = ids.get(key, 0) + 1
                rows += 1
                if trie.size + 200 * rows > TRIE_BYTES:
                    yield from emptied(trie)
                    trie, rows = Trie(), 0
        yield from emptied(trie)
    return run


def _decide(batches):
    schema = pa.schema([_DEALT.field(n) for n in ("id", "part", "mask", "n")])
    trie = Trie()
    for batch in batches:
        done = []
        for _, text, doc, part, mask, n in zip(*(c.to_pylist() for c in batch.columns)):
            if text is None:
                done.append((doc, part, mask, n))
                continue
            ids = trie.insert(text)
            key = (_NO_ID if doc is None else doc, part, mask)
            ids[key] = ids.get(key, 0) + n
        yield from _batches(done, schema)
    done = []
    for _, _, ids in trie.terminals():
        first = min(ids)[0]
        done += [(_id(doc), part, mask if doc == first else mask + "E", n) for (doc, part, mask), n in ids.items()]
        if len(done) >= 4096:
            yield from _batches(done, schema)
            done = []
    yield from _batches(done, schema)


def filter_masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id, part, mask, n): ``n`` rows of that id and part fail exactly the
    filters whose letters stand in ``mask``.

    A null text counts as empty, a null part as the empty string.  A row is a
    duplicate (E) if a row with a smaller id has the same text; equal ids are not
    smaller than each other, and a null id is larger than any other.  Texts
    are compared whole.  Other columns are not read; an empty table gives none."""
    rows = docs.select(docs[key].cast("long").alias("id"), text_of(docs, text).cast("binary").alias("text"),
                       F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"))
    bounds = prefix_cuts(rows.select("text"))
    held = docs.sparkSession.sparkContext.broadcast(bounds)
    dealt = rows.mapInArrow(_deal(held), "bucket int, text binary, id long, part string, mask string, n long")
    return dealt.repartitionById(len(bounds) + 1, F.pmod(F.col("bucket"), F.lit(len(bounds) + 1))).mapInArrow(
        _decide, _MASKS)


def label_flags(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(id, good, toxic) per labelled id; of repeated labels one that says so
    is enough."""
    flag = lambda c: F.coalesce(F.max((labels[c] == 1).cast("int")), F.lit(0))
    return (labels.filter(labels[key].isNotNull()).groupBy(labels[key].cast("long").alias("id"))
            .agg(flag("quality").alias("good"), flag("toxic").alias("toxic")))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step, with the counts of
    documents kept after the step, removed by it, failing its filter but removed
    before (redundant), failing its filter only, labelled good or toxic among the
    removed, and the filter's removals over all orders (``shapley``).

    Rows are judged as in :func:`filter_masks`; documents without a label count as
    neither good nor toxic.  Repeated rows count one by one."""
    masks = filter_masks(docs, key, text, part).groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    flagged = join_per_group(masks, label_flags(labels, key), ["id"], "left")
    counts = stored(flagged.groupBy("part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
                                    F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(F.sum("n").alias("n")), "masks")
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    replayed = (counts.withColumn("filter_order", F.explode(orders))
                .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
                .withColumn("letter", F.substr("filter_order", F.col("step"), F.lit(1)))
                .withColumn("fails", F.contains("mask", "letter"))
                .withColumn("before", F.substr("filter_order", F.lit(1), F.col("step") - 1))
                .withColumn("gone", F.length(F.call_function("translate", "mask", "before", F.lit("")))
                            < F.length("mask")))
    total = lambda cond, name: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias(name)
    here = F.col("fails") & ~F.col("gone")
    steps = replayed.groupBy("part", "filter_order", "step", "letter").agg(
        total(~F.col("fails") & ~F.col("gone"), "kept"), total(here, "removed"),
        total(F.col("fails") & F.col("gone"), "redundant"), total(F.col("mask") == F.col("letter"), "unique_fails"),
        total(here & (F.col("good") == 1), "good_lost"), total(here & (F.col("toxic") == 1), "toxic_lost"))
    return (steps.withColumn("shapley", F.sum("removed").over(W.partitionBy("part", "letter")))
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                    "toxic_lost", "shapley"))


#: The same report in DuckDB SQL.
AUDIT_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
labelled AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
first AS (SELECT text, min(doc_id) AS doc_id FROM t GROUP BY text),
m AS (
  SELECT t.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(t.text, '[A-Z]')) > 10 * length(t.text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN t.doc_id > first.doc_id THEN 'E' ELSE '' END AS mask
  FROM t JOIN first USING (text) LEFT JOIN labelled ON labelled.doc_id = t.doc_id),
counts AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, s::INTEGER AS step, substr(filter_order, s::INTEGER, 1) AS letter,
         '[' || substr(filter_order, 1, s::INTEGER - 1) || '0]' AS before
  FROM orders, range(1, 6) r(s)),
judged AS (
  SELECT c.*, s.*, contains(mask, letter) AS fails, regexp_matches(mask, before) AS gone FROM counts c, steps s),
summed AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = letter), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (fails AND NOT gone AND good = 1), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (fails AND NOT gone AND toxic = 1), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM summed
"""
