"""Recode by a codebook *table* (O-19 for codebooks too large for a CASE).

A codebook of at most ``max_rows`` rows is broadcast.  Beyond that both sides are
shuffled on the label, and labels of more than ``hot_rows`` rows, known to the
codebook or not, are salted: each gets one salt per ``hot_rows`` rows, and its
codebook row one copy per salt.  Rows without a label are salted at random; they
match nothing.  So no task gets more than about ``hot_rows`` rows of one label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import BROADCAST_MAX_ROWS, assert_unique_key

HOT_ROWS = 1_000_000
#: Copies of hot codebook rows, at most (the salts of all hot labels).
MAX_SALTS = 100_000
_LABEL, _CODE, _SALT, _SALTS = "_r_label", "_r_code", "_r_salt", "_r_salts"


def recode_join(df: DataFrame, col: str, codebook: DataFrame, label: str = "label", value: str = "value",
                unmatched: str = "pass", out: str | None = None, max_rows: int = BROADCAST_MAX_ROWS,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with ``out`` (``col`` itself if not given) = the codebook's value
    of each label, as ``expr.recode`` gives for a small codebook.

    ``unmatched``: ``"pass"`` keeps the label as text, ``"null"`` gives null,
    ``"error"`` fails the job and names the label.  A null label stays null.  Labels
    must be unique in the codebook, else a ValueError is raised; a codebook row
    without a label is left out.  No row is lost or repeated."""
    if unmatched not in ("pass", "null", "error"):
        raise ValueError(f"unmatched must be pass, null or error, not {unmatched!r}")
    out = out or col
    codes = codebook.select(codebook[label].cast("string").alias(_LABEL), codebook[value].cast("string").alias(_CODE),
                            F.lit(True).alias("_r_known")).filter(F.col(_LABEL).isNotNull())
    assert_unique_key(codes, _LABEL)
    rows = df.withColumn(_LABEL, df[col].cast("string"))
    if codes.limit(max_rows + 1).count() <= max_rows:
        joined = rows.join(F.broadcast(codes), _LABEL, "left")
    else:
        joined = _salted(rows, codes, hot_rows)
    text = F.col(_LABEL)
    if unmatched == "pass":
        missing = text
    elif unmatched == "null":
        missing = F.lit(None).cast("string")
    else:
        missing = F.when(text.isNotNull(), F.raise_error(F.concat(F.lit(f"unknown label for {col}: "), text)).cast("string"))
    recoded = F.when(F.col("_r_known"), F.col(_CODE)).otherwise(missing)
    names = df.columns if out in df.columns else [*df.columns, out]
    return joined.select(*[recoded.alias(out) if c == out else F.col(c) for c in names])


def _salted(rows: DataFrame, codes: DataFrame, hot_rows: int) -> DataFrame:
    counts = rows.filter(F.col(_LABEL).isNotNull()).groupBy(_LABEL).count()
    while True:  # as many salts as the hot labels need, within what may be broadcast
        hot = counts.filter(F.col("count") > hot_rows).select(
            _LABEL, F.ceil(F.col("count") / hot_rows).cast("int").alias(_SALTS))
        found = hot.agg(F.sum(_SALTS)).first()[0] or 0
        if found <= MAX_SALTS:
            break
        hot_rows *= 2
    if found:
        hot = F.broadcast(hot)  # at most MAX_SALTS rows
        rows, codes = rows.join(hot, _LABEL, "left"), codes.join(hot, _LABEL, "left")
    else:
        rows, codes = (d.withColumn(_SALTS, F.lit(None).cast("int")) for d in (rows, codes))
    spread = F.xxhash64(F.monotonically_increasing_id())
    salt = (F.when(F.col(_LABEL).isNull(), spread)  # no code has such a salt and label
            .when(F.col(_SALTS).isNotNull(), F.pmod(spread, F.col(_SALTS))).otherwise(0))
    copies = codes.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(_SALTS, F.lit(1)) - 1)))
    # a null label would keep its rows together: they get an empty one, and a salt of their own
    keyed = rows.withColumn(_SALT, salt.cast("long")).withColumn("_r_key", F.coalesce(_LABEL, F.lit("")))
    copies = copies.select(F.col(_LABEL).alias("_r_key"), _SALT, _CODE, "_r_known")
    joined = keyed.join(copies, ["_r_key", _SALT], "left")
    return joined.withColumn("_r_known", F.col("_r_known") & F.col(_LABEL).isNotNull())
