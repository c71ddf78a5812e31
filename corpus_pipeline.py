"""A corpus pipeline: from ``documents`` to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``documents``.  Rows are judged one by one, by a number that
each stage gives them: a repeated or a null ``doc_id`` changes nothing.  Columns
that ``documents`` does not have are carried along, whatever their names, up to the
last stage.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questa.llm import bpe, decontam, langid, secrets, simhash
from questa.llm.common import ROW, numbered, read_table, ready, stored, without_ids


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def carrying(stage):
    """A stage that sees only the columns of ``documents`` by their names: others,
    whatever they are called, pass through it under names of its own."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner = [c if c in COLUMNS else f"_carried{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*inner), sf_dir).toDF(*docs.columns)
    return run


@carrying
def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter, or of
    which no n-gram is known in any language, go."""
    ready(spark)
    model = langid.learn(docs.filter(docs["doc_id"].isNotNull() & ~langid.held_out(docs)))
    judged = langid.identify(docs.select(*docs.columns, docs["text"].alias("_text"), docs["doc_id"].alias("_id")),
                             model, "_id", "_text", tuple(docs.columns))
    known = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") > 0)
    return judged.filter(known | F.lit(not model.languages)).select(*docs.columns)


@carrying
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the one with the smallest id (rows without
    an id come last, the first of equal ids stays)."""
    ready(spark)
    rows = numbered(docs, "near-rows")
    order = F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("id"), F.col(ROW).alias("row"))
    classes = simhash.near_duplicates(rows.withColumn("_order", order), "_order")
    more = classes.filter("_order.row != component_id.row").select(F.col("_order.row").alias(ROW))
    return without_ids(rows, more, ROW).select(*docs.columns)


@carrying
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, or a paraphrase, go."""
    ready(spark)
    rows = numbered(docs, "leak-rows")
    leaks = decontam.contaminated(rows, read_table(spark, sf_dir, "benchmark"), ROW)
    return without_ids(rows, leaks.select(ROW), ROW).select(*docs.columns)


@carrying
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; every reported secret is replaced by a mark, and
    n_chars follows the text."""
    ready(spark)
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(
        *docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each document, encoded
    and decoded in one pass over the rows, in which a task holds one Python worker
    (an executor keeps its workers for all that follows)."""
    ready(spark)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(bpe.round_trip(docs.select(*COLUMNS), path, pattern), carry=("ids",))


STAGES = [
    ("language_id", keep_identified),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("byte_bpe", encode_tokens),
]

#: Learnt models, fingerprints of XXH64 bits and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
