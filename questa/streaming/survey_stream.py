"""Incremental survey ingestion with Structured Streaming.

Survey answers that arrive as new CSV files in a folder go through the same
plan as the batch tables: select questions by header name, NA tokens to
null, complete cases, recodes and the multi-select cost (all stateless
row-level expressions), then either

* ``start_cleaned_sink``: append the cleaned worth rows to Parquet, with the
  checkpoint in the shared checkpoint folder (exactly-once file sink), or
* ``start_cheaper_counts``: keep running cheaper-option counts (a stateful
  aggregate, complete output mode).

Stream sources need a schema; it is taken from the header of the files
already present (all columns as text) and enforced by name
(``enforceSchema=false``), so a reordered or different header fails loudly
instead of binding columns by position.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.codebooks import PANDAS_NA_TOKENS, SHORT_NAMES
from ..functions.expr import na_tokens_to_null
from ..plans.cleaning import cleaned_worth, decision
from ..session import scratch_path
from ..sources.survey_csv import csv_options


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """All-text schema from the header row of the CSV files under ``path``."""
    cols = spark.read.options(**csv_options()).csv(path).columns
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def read_survey_stream(spark: SparkSession, path: str, schema: T.StructType | None = None,
                       columns: Mapping[str, str] = SHORT_NAMES,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    schema = schema or header_schema(spark, path)
    reader = spark.readStream.schema(schema).options(**csv_options()).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(path)
    tokens = list(PANDAS_NA_TOKENS)
    return raw.select(*[na_tokens_to_null(F.col("`" + h.replace("`", "``") + "`"), tokens).alias(s)
                        for s, h in columns.items()])


def cleaned_worth_stream(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Streaming cleaned worth rows plus the decision columns.  Ids are taken
    as unique (a stream cannot be checked globally; deduplicate upstream with
    ``dropDuplicatesWithinWatermark`` if needed)."""
    return decision(cleaned_worth(read_survey_stream(spark, path, **kw), key_unique=True))


def start_cleaned_sink(spark: SparkSession, src: str, out: str,
                       checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    stream = cleaned_worth_stream(spark, src)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", out)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start()


def start_cheaper_counts(spark: SparkSession, src: str, query_name: str = "cheaper_counts",
                         checkpoint: str | None = None,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Running counts per cheaper option into an in-memory table (for a
    dashboard); the aggregation state is two rows, kept across micro-batches
    in the checkpoint's state store."""
    stream = cleaned_worth_stream(spark, src, max_files_per_trigger=max_files_per_trigger)
    counts = stream.groupBy("cheaper_option").agg(F.count(F.lit(1)).alias("count"))
    return (counts.writeStream.format("memory").queryName(query_name).outputMode("complete")
            .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-counts"))
            .trigger(availableNow=True).start())
