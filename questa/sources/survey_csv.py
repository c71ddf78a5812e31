"""Survey CSV source and sink (O-01, O-02).

The survey arrives as one wide CSV whose header row holds the question texts.
We read every answer as text (no ``inferSchema`` pass, no positional schema:
Spark binds a user schema by position, which silently picks wrong columns of
a wide file), select the questions we need by header name, rename them to
short names and turn pandas' NA tokens into nulls.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codebooks import PANDAS_NA_TOKENS, SHORT_NAMES
from ..functions.expr import na_tokens_to_null


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def csv_options(multiline: bool = True) -> dict:
    """The one CSV contract of the batch reader, the stream and the sink: a
    header, doubled quotes, blanks and line breaks inside answers kept.  A
    record that is too short is padded with nulls (as pandas does); surplus
    fields of a long one are left out."""
    return {"header": True, "escape": '"', "multiLine": multiline, "mode": "PERMISSIVE",
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_survey_csv(spark: SparkSession, path: str,
                    columns: Mapping[str, str] = SHORT_NAMES,
                    na_tokens: Iterable[str] = PANDAS_NA_TOKENS,
                    multiline: bool | str = True, row_order_col: str | None = None) -> DataFrame:
    """Read a header CSV and return ``columns`` (short name -> header text)
    as string columns, NA tokens mapped to null.

    ``multiline`` handles quoted newlines inside answers; it makes each file
    a single split.  With ``"split"`` large files are read in many ranges all
    the same (:mod:`split_csv`); False is for files of one record per line.

    ``row_order_col`` adds the file order of each record.  With ``"split"`` it
    is the record's number in the order of file names and lines, over any number
    of files.  Else it is taken right after the scan with
    ``monotonically_increasing_id``, which follows the file order of one file
    only, as a scan packs several files by size.  The original analysis' row
    positions follow this order.
    """
    if multiline == "split":
        from .split_csv import read_csv_split
        raw = read_csv_split(spark, path, row_order_col)
        return _answers(raw, columns, na_tokens, [F.col(row_order_col)] if row_order_col else [])
    raw = spark.read.options(**csv_options(multiline)).csv(path)
    return _answers(raw, columns, na_tokens,
                    [F.monotonically_increasing_id().alias(row_order_col)] if row_order_col else [])


def _answers(raw: DataFrame, columns: Mapping[str, str], na_tokens: Iterable[str], order: list[Column]) -> DataFrame:
    # header text -> column as read (a byte-order mark may precede the first header)
    by_text = {c.lstrip("\ufeff"): c for c in raw.columns}
    missing = [h for h in columns.values() if h not in by_text]
    if missing:
        raise ValueError(f"survey file lacks questions: {missing}")
    tokens = list(na_tokens)
    return raw.select(*[na_tokens_to_null(F.col(_quoted(by_text[header])), tokens).alias(short)
                        for short, header in columns.items()], *order)


def to_questionnaire(df: DataFrame, columns: Mapping[str, str] = SHORT_NAMES) -> DataFrame:
    """Rename short names back to question texts (the wide-file header)."""
    return df.select(*[F.col(short).alias(header) for short, header in columns.items()
                       if short in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a header CSV folder (one part file per partition; never funnel
    the table through one task with ``coalesce(1)``).  Quotes are doubled
    inside quoted fields, as pandas writes them.

    ``mode="overwrite"`` replaces the folder as a whole: the rows are written
    beside it, and only when all are there is the old folder put aside, the
    new one put in its place and the old one dropped.  A write that fails
    leaves the old table, which ``df`` may itself read; if the program ends
    between the two renames, :func:`restore` (called by the next overwrite)
    brings the old folder back."""
    if mode != "overwrite":
        df.write.mode(mode).options(**csv_options()).csv(path)
        return
    spark, path = df.sparkSession, path.rstrip("/")
    restore(spark, path)
    fs, of = _file_system(spark, path)
    staged, aside = of(f"{path}.staged-{uuid.uuid4().hex[:12]}"), of(path + ".aside")
    try:
        df.write.options(**csv_options()).csv(staged.toString())
        if not fs.exists(of(f"{staged.toString()}/_SUCCESS")):
            raise OSError(f"{staged.toString()} is not complete")
        if fs.exists(of(path)) and not fs.rename(of(path), aside):
            raise OSError(f"cannot put {path} aside")
        if not fs.rename(staged, of(path)):
            restore(spark, path)
            raise OSError(f"cannot put the new rows in {path}")
        fs.delete(aside, True)
    finally:
        fs.delete(staged, True)


def restore(spark: SparkSession, path: str) -> None:
    """Undo an overwrite that ended between its two renames, or drop what a
    finished one left."""
    fs, of = _file_system(spark, path.rstrip("/"))
    aside = of(path.rstrip("/") + ".aside")
    if fs.exists(aside):
        if fs.exists(of(path)):
            fs.delete(aside, True)
        elif not fs.rename(aside, of(path)):
            raise OSError(f"cannot bring {path} back")


def _file_system(spark: SparkSession, path: str):
    """The file system that Spark itself uses for ``path``, and its paths."""
    of = spark._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark._jsc.hadoopConfiguration()), of


def read_csv_strings(spark: SparkSession, path: str,
                     na_tokens: Iterable[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """Read a header CSV folder written by :func:`write_csv`: every column as
    text under its header name, NA tokens mapped to null."""
    raw = spark.read.options(**csv_options()).csv(path)
    tokens = list(na_tokens)
    return raw.select(*[na_tokens_to_null(F.col(_quoted(c)), tokens).alias(c) for c in raw.columns])
