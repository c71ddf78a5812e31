"""License notices in texts, found by diagonal voting, DataFrame functions only.

Every text's words are hashed in rolling runs of two and of five.  All runs are
joined with the runs of the templates; equal words are then asked for, so a hash decides nothing.  A match
of run ``i`` in the text and run ``t`` in the template votes for the diagonal
``i - t``.  Votes are counted by diagonal; diagonals at most GAP apart, where
words were put in or left out, are merged; and the words of the template that
the merged votes cover verify the span.

The templates are a bounded constant (MAX_TEMPLATE_WORDS is checked) and the only
side that is broadcast.  A text is read once, whole; its runs meet the templates
where they are, and only matches and one row a text are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import text_of

#: What stands between words, after A-Z are lower-cased.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words in a run: of templates shorter than LONG, and of the others.
SHORT, LONG = 2, 5
#: Diagonals this far apart may belong to one span.
GAP = 3
#: Share of a template's words that a span has to cover, and largest share of
#: foreign words in it.
COVERED = 0.8
MAX_TEMPLATE_WORDS = 100_000


class Template(NamedTuple):
    """``exact``: only unaltered, and a *base* place; else a notice that may be
    altered a little."""
    label: str
    text: str
    exact: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(BREAKS, self.text.translate(str.maketrans(UPPER, LOWER))) if w]

    @property
    def run(self) -> int:
        return SHORT if self.exact or len(self.words) < LONG else LONG


#: Names of licenses.
PHRASES = (Template("gpl", "gnu general public license", True), Template("apache", "apache license", True),
           Template("cc-by", "cc by", True), Template("mit", "mit license", True))
#: Wording of common license notices.
NOTICES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                           "except in compliance with the License."),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                    "rights to this work"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                    "General Public License as published by the Free Software Foundation"),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                    "fee is hereby granted"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                    "associated documentation files, to deal in the Software without restriction"),
    Template("mit", "Released under the MIT License"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)
TEMPLATES = PHRASES + NOTICES
_NONE = -1  # the template of a text's own row


def folded_words(text: Column) -> Column:
    """The words of a text, A-Z in lower case.  The only two other characters
    whose lower case has an ASCII letter are set aside first."""
    kept_apart = F.replace(F.replace(text, F.lit("\u0130"), F.lit("\u0131")), F.lit("\u212a"), F.lit("\u03ba"))
    return F.array_remove(F.split(F.lower(kept_apart), BREAKS), "")


def with_runs(rows: DataFrame) -> DataFrame:
    """A row per place of ``words`` and size of run: ``place`` (words from 1),
    ``long`` and ``hash`` of the run that starts there (shorter at the end).
    Place 0 is a row's mark, with hash 0.  The words then start with an empty one."""
    marked = rows.withColumn("words", F.concat(F.array(F.lit("")), "words"))
    # outer: no filter on the array's size, which would split the text again
    each = marked.select("*", F.posexplode_outer("words").alias("place", "word"))
    ahead = [F.get("words", F.col("place") + i) for i in range(1, LONG)]
    mark = F.col("place") == 0
    hashes = F.array(F.when(mark, 0).otherwise(F.xxhash64("word", *ahead[:SHORT - 1])),
                     F.when(~mark, F.xxhash64("word", *ahead)))
    return each.select("*", F.posexplode_outer(hashes).alias("long", "hash")).withColumn("long", F.col("long") == 1)


def _run_text(run: Column) -> Column:
    return F.array_join(F.slice("words", F.col("place") + 1, run), " ")


def _template_runs(spark, templates: Sequence[Template]) -> DataFrame:
    """(hash, template, at, run, run_text, length, label, exact)"""
    if sum(len(t.words) for t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"the templates have over {MAX_TEMPLATE_WORDS} words")
    short = [t for t in templates if len(t.words) < SHORT]
    if short:
        raise ValueError(f"templates of fewer than {SHORT} words: {short}")
    rows = [(i, t.words, t.run, len(t.words), t.label, t.exact) for i, t in enumerate(templates)]
    made = with_runs(spark.createDataFrame(
        rows, "template int, words array<string>, run int, length int, label string, exact boolean"))
    runs = made.filter((F.col("place") > 0) & (F.col("long") == (F.col("run") == LONG))
                       & (F.col("place") + F.col("run") <= F.col("length") + 1)).select(
        "hash", "template", (F.col("place") - 1).alias("at"), "run", _run_text(F.col("run")).alias("run_text"), "length",
        "label", "exact")
    mark = spark.range(1).select(
        F.lit(0).cast("long").alias("hash"), F.lit(_NONE).alias("template"), F.lit(0).alias("at"), F.lit(0).alias("run"),
        F.lit("").alias("run_text"), F.lit(0).alias("length"), F.lit("").alias("label"), F.lit(False).alias("exact"))
    return runs.unionByName(mark)


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text",
          templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per text and merged diagonals, and one without a template per text:
    (row, id, n_words, template, label, exact, start, stop, covered, length).

    ``start`` and ``stop`` count words from 0; ``covered`` of the template's
    ``length`` words are found.  For ``exact`` templates only whole places count,
    one row each.  ``row`` tells rows of one id apart."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("id"),
                       folded_words(text_of(docs, text)).alias("words"))
    found = with_runs(rows.withColumn("n_words", F.size("words").cast("long")))
    met = found.join(F.broadcast(_template_runs(docs.sparkSession, templates)), "hash")
    mark = F.col("template") == _NONE
    same = (F.when(mark | (F.col("place") == 0), mark & (F.col("place") == 0))
            .when(F.col("long") != (F.col("run") == LONG), False).otherwise(_run_text(F.col("run")) == F.col("run_text")))
    votes = (met.filter(same).withColumn("start", F.greatest(F.col("place") - 1, F.lit(0)))
             .select("row", "id", "n_words", "template", "label", "exact", "length", "run", "at", "start")
             .repartition("row"))
    of = ["row", "id", "n_words", "template", "label", "exact", "length", "run"]
    lines = (votes.withColumn("diagonal", F.col("start") - F.col("at")).groupBy(*of, "diagonal")
             .agg(F.collect_set("at").alias("ats"))
             .filter(~F.col("exact") | (F.size("ats") == F.col("length") - F.col("run") + 1)))
    along = W.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(along) > GAP)
    merged = (lines.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
              .withColumn("span", F.sum("new").over(along)).groupBy(*of, "span")
              .agg(F.min(F.col("diagonal") + F.array_min("ats")).alias("start"),
                   F.max(F.col("diagonal") + F.array_max("ats") + F.col("run")).alias("stop"),
                   F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats")))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "ats", lambda t: F.sequence(t, F.greatest(t + F.col("run") - 1, t))))))
    return merged.withColumn("covered", F.when(mark, 0).otherwise(covered)).select(
        "row", "id", "n_words", "template", "label", "exact", "start", "stop", "covered", "length")


def licenses(docs: DataFrame, key: str = "doc_id", text: str = "text",
             templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of
    every row, whatever other columns it has.

    Texts are read whole and in A-Z lower case; a null text counts as empty, has
    no place, empty labels and score 0.  Repeated and null ids give a row each.
    ``n_base`` places of exact templates start between ``first_word`` and
    ``last_word``.  ``labels`` adds those of notices of which a span covers
    COVERED of the words, with at most the same share of foreign words in it.
    ``score`` is the largest share of any template that a span covers.  An empty
    table gives no row."""
    base = F.col("exact")
    share = F.col("covered") / F.col("length")
    verified = (F.col("length") > 0) & (F.col("covered") >= F.col("length") * COVERED) & (
        (F.col("stop") - F.col("start")) * COVERED <= F.col("length"))
    joined = lambda cond: F.array_join(F.sort_array(F.collect_set(F.when(cond, F.col("label")))), ",")
    at = F.when(base, F.col("start").cast("long"))
    return spans(docs, key, text, templates).groupBy("row", "id", "n_words").agg(
        F.count(at).alias("n_base"), F.min(at).alias("first_word"), F.max(at).alias("last_word"),
        joined(base).alias("base_labels"), joined(base | verified).alias("labels"),
        F.coalesce(F.max(F.when(F.col("length") > 0, share)), F.lit(0.0)).alias("score")).select(
        F.col("id").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _sql_runs() -> str:
    return ", ".join(f"({i}, {t.run}, {at}, '{' '.join(t.words[at:at + t.run])}', {len(t.words)}, '{t.label}', {t.exact})"
                     for i, t in enumerate(TEMPLATES) for at in range(len(t.words) - t.run + 1))


#: The same report in DuckDB SQL, on the runs' words instead of their hashes.
LICENSE_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
tpl(template, run, spot, run_text, length, label, exact) AS (VALUES {_sql_runs()}),
places AS (SELECT row, words, unnest(range(len(words))) AS i FROM d),
votes AS (
  SELECT p.row, t.*, p.i - t.spot AS diagonal
  FROM (SELECT row, i, {SHORT} AS run, array_to_string(words[i + 1:i + {SHORT}], ' ') AS run_text FROM places
        WHERE i + {SHORT} <= len(words)
        UNION ALL
        SELECT row, i, {LONG}, array_to_string(words[i + 1:i + {LONG}], ' ') FROM places
        WHERE i + {LONG} <= len(words)) p
  JOIN tpl t USING (run, run_text)),
lines AS (
  SELECT row, template, length, label, exact, run, diagonal, list(spot) AS ats FROM votes GROUP BY ALL
  HAVING NOT exact OR len(list(spot)) = length - run + 1),
marked AS (
  SELECT *, CASE WHEN exact OR coalesce(diagonal - lag(diagonal) OVER along, {GAP + 1}) > {GAP} THEN 1 ELSE 0 END AS new
  FROM lines WINDOW along AS (PARTITION BY row, template ORDER BY diagonal)),
spanned AS (
  SELECT *, sum(new) OVER (PARTITION BY row, template ORDER BY diagonal) AS span FROM marked),
cells AS (
  SELECT row, template, length, label, exact, span, diagonal, unnest(ats) AS spot, run FROM spanned),
words_of AS (
  SELECT row, template, length, label, exact, span, diagonal + spot AS start, diagonal + spot + run AS stop,
         unnest(range(spot, spot + run)) AS word FROM cells),
found AS (
  SELECT row, template, length, label, exact, min(start) AS start, max(stop) AS stop, count(DISTINCT word) AS covered
  FROM words_of GROUP BY row, template, length, label, exact, span),
by_row AS (
  SELECT row, count(*) FILTER (exact) AS n_base, min(start) FILTER (exact) AS first_word,
         max(start) FILTER (exact) AS last_word,
         list_sort(list(DISTINCT label) FILTER (exact)) AS base_labels,
         list_sort(list(DISTINCT label) FILTER (exact OR (covered >= length * {COVERED}::DOUBLE
                   AND (stop - start) * {COVERED}::DOUBLE <= length))) AS labels,
         max(covered::DOUBLE / length) AS score
  FROM found GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(base_labels, ','), '') AS base_labels,
       coalesce(array_to_string(labels, ','), '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN by_row USING (row)
"""
