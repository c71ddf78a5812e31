"""Complete cases and key joins (O-05, O-06, O-20, O-21, O-22).

The original analysis projects one two-column frame per question, drops rows
with a missing answer and inner-joins the frames on the respondent id.  When
all questions live in one table with a unique id that is exactly one scan and
one ``isNotNull`` filter, which Catalyst pushes into the Parquet scan.
Catalyst does not remove the self-joins on its own, hence this operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null_all(cols: Sequence[str]) -> Column:
    """``c1 IS NOT NULL AND c2 IS NOT NULL ...``; unlike ``na.drop`` this is
    pushed to the Parquet scan as ``IsNotNull`` filters."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def assert_unique_key(df: DataFrame, key: str) -> None:
    """Fail if any key value occurs twice.  One aggregate over the key column
    only (pruned scan, partial aggregation); returns at most one row."""
    dup = (df.filter(F.col(key).isNotNull()).groupBy(key).count()
           .filter(F.col("count") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"key {key!r} is not unique (e.g. {dup[0][key]!r} occurs "
                         f"{dup[0]['count']} times); complete cases are undefined")


def complete_cases(df: DataFrame, key: str, answers: Sequence[str],
                   key_unique: bool | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Rows whose key and every answer in ``answers`` are present (O-21).

    Equivalent to per-question ``dropna`` + inner joins on the key when the
    key is unique.  ``key_unique=None`` verifies that with one aggregate job;
    pass ``True`` for a declared primary key.  Duplicate keys are refused:
    the join form would emit every pair of a key's rows.  ``carry`` columns
    (e.g. the file order) are kept without a null check.
    """
    if key_unique is None:
        assert_unique_key(df, key)
    elif key_unique is False:
        raise ValueError("complete_cases needs a unique key; deduplicate first")
    cols = [key, *answers]
    return df.select(*cols, *carry).filter(not_null_all(cols))


def join_answers(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner equi-join of per-question frames on ``key`` (O-20), for answers
    that come from different tables.  Each frame must have a unique key (so
    no row pairs are emitted); nulls are dropped first (O-06)."""
    out = None
    for f in frames:
        f = f.filter(not_null_all(f.columns))
        out = f if out is None else out.join(f, key, "inner")
    return out


BROADCAST_MAX_ROWS = 100_000


def join_per_group(big: DataFrame, per_group: DataFrame, on: Sequence[str],
                   how: str = "inner", max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join a one-row-per-group table back to row-level data.

    The per-group table is counted first (it is small and usually cached);
    within ``max_rows`` it is broadcast, so a hot group costs nothing extra.
    Beyond that it is a shuffle join, where AQE splits skewed partitions."""
    n = per_group.limit(max_rows + 1).count()
    side = F.broadcast(per_group) if n <= max_rows else per_group
    return big.join(side, list(on), how)
