"""Properties of the order primitives, splits and jitter; plan checks."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from questa.operators.order import exact_split, hash_split, prefix_sum, row_position
from questa.functions.expr import recode
from questa.functions.codebooks import SPEND_CODEBOOK
from questa.plans import cleaning, correlation
from questa.plans.catalog import QUERIES
from questa.sources.tables import derived_survey, read_table


def _customer(spark, sf_dir):
    return read_table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_nationkey")


@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_row_position_equals_global_row_number(spark, sf_dir, partitions):
    cust = _customer(spark, sf_dir)
    got = row_position(cust, ["c_nationkey", "c_custkey"], partitions=partitions)
    want = cust.withColumn("pos", F.row_number().over(Window.orderBy("c_nationkey", "c_custkey")))
    assert sorted(got.select("c_custkey", "pos").collect()) == sorted(
        want.select("c_custkey", "pos").collect())


def test_prefix_sum_equals_window_with_hot_value(spark):
    rows = [(0.0 if i % 3 else float(i), i, i % 7) for i in range(600)]   # 2/3 share one value
    df = spark.createDataFrame(rows, "x double, id long, w long")
    got = prefix_sum(df, ["x", "id"], "w", out="cum", partitions=6)
    w = Window.orderBy("x", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("cum", F.sum("w").over(w))
    assert sorted(got.select("id", "cum").collect()) == sorted(want.select("id", "cum").collect())
    excl = prefix_sum(df, ["x", "id"], "w", out="cum", inclusive=False, partitions=3)
    assert sorted(excl.select("id", "cum").collect()) == sorted(
        want.select("id", (F.col("cum") - F.col("w")).alias("cum")).collect())


def test_hash_split_is_repartition_invariant_and_exhaustive(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders", "o_orderkey")
    a = hash_split(orders, "o_orderkey", 0.75, salt="s")
    b = hash_split(orders.repartition(7), "o_orderkey", 0.75, salt="s")
    assert sorted(a.collect()) == sorted(b.collect())
    counts = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert sum(counts.values()) == orders.count()
    assert 0.65 < counts["train"] / orders.count() < 0.85


@pytest.mark.parametrize("frac", [0.2, 0.5, 0.013])
def test_exact_split_has_exact_size(spark, sf_dir, frac):
    orders = read_table(spark, sf_dir, "orders", "o_orderkey")
    n = orders.count()
    s = exact_split(orders, "o_orderkey", frac, seed=42)
    assert s.filter(F.col("split") == "test").count() == math.ceil(frac * n)
    s2 = exact_split(orders.repartition(5), "o_orderkey", frac, seed=42)
    assert sorted(s.collect()) == sorted(s2.collect())


def test_keyed_normal_jitter_mean_sd_and_repeatability(spark):
    from questa.functions.expr import keyed_normal
    df = spark.range(40000).select(F.col("id"), (0.1 * keyed_normal("id", 11)).alias("j"))
    row = df.agg(F.avg("j").alias("m"), F.stddev("j").alias("s"),
                 F.avg((F.abs(F.col("j")) < 0.1).cast("double")).alias("one_sd")).first()
    assert abs(row.m) < 0.003 and abs(row.s - 0.1) < 0.003
    assert abs(row.one_sd - 0.6827) < 0.01              # normal shape
    again = df.repartition(7).select("id", "j")
    assert sorted(df.collect()) == sorted(again.collect())


def test_recode_is_idempotent(spark, sf_dir):
    s = derived_survey(spark, sf_dir).filter(F.col("spend").isNotNull())
    once = s.select(recode("spend", SPEND_CODEBOOK).alias("x"))
    twice = once.select(recode("x", SPEND_CODEBOOK).alias("x"))
    assert sorted(once.collect()) == sorted(twice.collect())


# ----------------------------------------------------------------- plans

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_complete_cases_is_one_scan_with_pushed_filters(spark, sf_dir):
    df = cleaning.cleaned_correlation(derived_survey(spark, sf_dir), key_unique=True)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the methods join is eliminated: correlation reads orders only, once
    assert "l_orderkey" not in plan and "p_type" not in plan
    assert plan.count("Relation [") == 1
    scan = _plan(df)
    assert "IsNotNull(o_orderkey)" in scan


def test_brewing_cost_has_no_python(spark, sf_dir):
    df = cleaning.cleaned_worth(derived_survey(spark, sf_dir), key_unique=True)
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _row_scale_single_partition(plan: str) -> list[str]:
    """Single-partition exchanges that move rows (not one partial-aggregate
    row per task, which is how every global aggregate merges)."""
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            if "partial_" not in child:
                bad.append(line.strip())
    return bad


def test_no_single_partition_exchange_in_order_dependent_ops(spark, sf_dir):
    for name in ("row_position", "prefix_sum", "knn5", "knn5_home", "mannwhitney_u",
                 "exact_split", "levene_w"):
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        assert _row_scale_single_partition(_plan(df)) == [], name


def test_curve_grid_is_inclusive(spark, sf_dir):
    fit = correlation.fit_correlation(derived_survey(spark, sf_dir))
    pts = sorted(correlation.curve(fit).collect())
    xs = [p.x for p in pts]
    lo, hi = fit.data.agg(F.min("spent_assumptions"), F.max("spent_assumptions")).first()
    assert len(xs) == 100 and xs[0] == lo and xs[-1] == hi
    assert np.all(np.diff(xs) > 0)


def test_hot_value_is_split_across_range_partitions(spark):
    """A third of the rows share one order value; the composite (value, id)
    range partitioning still spreads them over several balanced tasks."""
    from questa.operators.order import sorted_checkpoint
    n = 30000
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0.0))
                               .otherwise(F.col("id").cast("double")).alias("x"))
    ck = sorted_checkpoint(df, ["x", "id"], partitions=8)
    sizes = [r["count"] for r in ck.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * n / 8
    pos = row_position(df, ["x", "id"], partitions=8)
    hot = pos.filter(F.col("x") == 0).agg(F.min("pos"), F.max("pos")).first()
    assert (hot[0], hot[1]) == (1, n // 3)


def test_exact_split_refines_large_buckets(spark, sf_dir):
    """With a tiny bucket bound the k-th hash is found through refined
    prefixes; the result equals the direct one."""
    from questa.operators import order
    orders = read_table(spark, sf_dir, "orders", "o_orderkey")
    hashed = orders.withColumn("_h", order.key_hash("o_orderkey", "42:"))
    hist = sorted((r[0], r[1]) for r in hashed.groupBy(F.substring("_h", 1, 4).alias("b"))
                  .count().collect())
    n = sum(c for _, c in hist)
    for k in (1, 7, n // 2, n):
        direct = order._kth_smallest(hashed.select("_h", "o_orderkey"), "o_orderkey", k, hist)
        refined = order._kth_smallest(hashed.select("_h", "o_orderkey"), "o_orderkey", k, hist,
                                      max_bucket_rows=0)
        want = hashed.orderBy("_h", "o_orderkey").offset(k - 1).first()
        assert direct == refined == (want["_h"], want["o_orderkey"])
