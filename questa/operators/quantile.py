"""Exact quantiles per group without holding a group in one place.

Spark's exact ``percentile``/``median`` keep a value->count map per group,
which grows with the distinct values of a hot group.  Here rows are counted
per (group, value), the counts get running sums in (group, value) order (a
range shuffle, so a group is split over many tasks), and the rows whose running
count crosses the wanted ranks give the quantile.  A hot value is one row.
Linear interpolation between the two neighbouring order statistics, as numpy's
default quantile does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_per_group, not_null_all
from .order import prefix_sum


def exact_quantile(df: DataFrame, group_cols: Sequence[str], value: str, q: float = 0.5,
                   out: str = "quantile") -> DataFrame:
    """(group..., out, n) with the exact ``q`` quantile of ``value`` per group
    (rows with a null group or value are left out)."""
    g = list(group_cols)
    single = not g
    if single:  # one group: a constant key
        df, g = df.withColumn("_g", F.lit(0)), ["_g"]
    base = df.select(*g, F.col(value).cast("double").alias("_v")).filter(not_null_all([*g, "_v"]))
    counts = base.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    cum = prefix_sum(counts, [*g, "_v"], "_c", out="_before", inclusive=False)
    per = cum.groupBy(*g).agg(F.min("_before").alias("_first"), F.sum("_c").alias("n"))
    h = (F.col("n") - 1) * F.lit(q)
    per = per.select(*g, "n", (h - F.floor(h)).alias("_frac"),
                     (F.col("_first") + F.floor(h)).alias("_k1"), (F.col("_first") + F.ceil(h)).alias("_k2"))
    ranked = join_per_group(cum, per, g)
    holds = lambda k: (F.col("_before") <= F.col(k)) & (F.col(k) < F.col("_before") + F.col("_c"))
    res = (ranked.filter(holds("_k1") | holds("_k2")).groupBy(*g).agg(
        F.max(F.when(holds("_k1"), F.col("_v"))).alias("_v1"),
        F.max(F.when(holds("_k2"), F.col("_v"))).alias("_v2"),
        F.first("_frac").alias("_frac"), F.first("n").alias("n")))
    res = res.select(*g, (F.col("_v1") + F.col("_frac") * (F.col("_v2") - F.col("_v1"))).alias(out), "n")
    return res.drop("_g") if single else res
