"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path, ship_package

#: A list of ids is broadcast up to this many rows (16 MB of longs).
BROADCAST_IDS = 1_000_000
#: Rows that pass to a Python worker at a time.
BATCH_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ready(spark: SparkSession) -> None:
    """What the operators need of a session: the shared folder, this package on
    the executors, and Arrow batches of few rows, as texts can be long (a value
    other than Spark's default is left as it is)."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it
    back: cuts the lineage, and a lost executor re-reads it."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The column of :func:`numbered`.
ROW = "_doc_row"


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a unique number per row in ROW, written with the rows, so
    that it stays the same however often they are read."""
    return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), name)


def text_of(df: DataFrame, col: str) -> Column:
    """The column as text; null counts as the empty text."""
    return F.coalesce(df[col].cast("string"), F.lit(""))


def without_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``ids`` (one column, same
    name).  Rows with a null key stay.  The id list is broadcast while a count
    shows at most BROADCAST_IDS rows, else both sides are shuffled on the key."""
    ids = ids.filter(F.col(key).isNotNull()).distinct()
    n = ids.limit(BROADCAST_IDS + 1).count()
    return docs.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, key, "left_anti")


#: A key is hot if it holds more than this share of all rows; so at most HOT are.
HOT = 1024


def join_split(rows: DataFrame, classes: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` joined with ``classes`` (one row per ``key``, with the number
    ``n`` of rows that have it), without dealing a hot key to one task: the at
    most HOT keys with over 1/HOT of all rows are broadcast, the others are
    shuffled.  Rows with a null or unknown key are dropped; ``n`` goes."""
    total = classes.agg(F.sum(n)).first()[0] or 0
    hot = F.broadcast(classes.filter(F.col(n) * HOT > total).drop(n))
    rest = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(classes.filter(F.col(n) * HOT <= total).drop(n), key))
