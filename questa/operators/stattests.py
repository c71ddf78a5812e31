"""Distribution tests (O-52, O-53, O-54).

Each test makes its data pass(es) in Spark and ends in a one-row (or
one-row-per-group) table of statistics; the formulas are column
expressions, the p-values included (``functions.special``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.special import EXACT_U_MAX, f_sf, rank_sum_tail, rank_sum_tail_closed, two_sided_normal_p
from ..session import materialize, ship_package
from .joins import join_per_group
from .order import prefix_sum
from .quantile import exact_quantile


# ------------------------------------------------------------ normality

def skew_z(n: Column, g1: Column) -> Column:
    """D'Agostino skewness z from the population skewness ``g1``."""
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)
             / ((n - 2) * (n + 5) * (n + 7) * (n + 9)))
    w2 = F.lit(-1.0) + F.sqrt(2.0 * (beta2 - 1))
    delta = F.lit(1.0) / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2.0 / (w2 - 1))
    y = F.when(y == 0, F.lit(1.0)).otherwise(y)
    return delta * F.asinh(y / alpha)


def kurtosis_z(n: Column, excess: Column) -> Column:
    """Anscombe-Glynn kurtosis z from the population excess kurtosis."""
    b2 = excess + 3.0
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - e) / F.sqrt(varb2)
    sb1 = (6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
           * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + F.sqrt(1.0 + 4.0 / (sb1 * sb1)))
    term1 = 1.0 - 2.0 / (9.0 * a)
    denom = 1.0 + x * F.sqrt(2.0 / (a - 4.0))
    term2 = F.signum(denom) * F.when(denom != 0, F.cbrt((1.0 - 2.0 / a) / F.abs(denom)))
    return (term1 - term2) / F.sqrt(2.0 / (9.0 * a))


def normaltest(df: DataFrame, value: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """D'Agostino-Pearson K² test per group (O-52): one aggregate pass
    (count, population skewness and excess kurtosis), then formulas.
    p = exp(-K²/2), the chi-square(2) tail.  Null below 8 observations.  Rows
    with a null group or value are left out."""
    g = list(group_cols)
    v = F.col(value).cast("double")
    agg = (df.filter(v.isNotNull()).na.drop(subset=g or [value]).groupBy(*g)
           .agg(F.count(F.lit(1)).alias("n"), F.skewness(v).alias("skew"),
                F.kurtosis(v).alias("kurt")))
    n = F.col("n").cast("double")
    ok = F.col("n") >= 8
    z1 = F.when(ok, skew_z(n, F.col("skew")))
    z2 = F.when(ok, kurtosis_z(n, F.col("kurt")))
    out = agg.select(*g, "n", z1.alias("skew_z"), z2.alias("kurt_z"))
    k2 = F.col("skew_z") * F.col("skew_z") + F.col("kurt_z") * F.col("kurt_z")
    return out.select("*", k2.alias("k2")).withColumn("pvalue", F.exp(-F.col("k2") / 2.0))


# ----------------------------------------------------------------- Levene

def levene_stat(df: DataFrame, value: str, group: str) -> DataFrame:
    """Levene/Brown-Forsythe W with median centring (O-53), one row:
    (k, n, w, df1, df2).  Medians are exact (see ``exact_quantile``).  Rows
    with a null group or value are left out."""
    v = F.col(value).cast("double")
    base = df.select(F.col(group).alias("_g"), v.alias("_v")).filter(
        F.col("_v").isNotNull() & F.col("_g").isNotNull())
    med = materialize(exact_quantile(base, ["_g"], "_v", 0.5, out="_med").select("_g", "_med"))
    z = join_per_group(base, med, ["_g"]).select("_g", F.abs(F.col("_v") - F.col("_med")).alias("_z"))
    per = z.groupBy("_g").agg(F.count(F.lit(1)).alias("ni"), F.avg("_z").alias("zi"),
                              (F.var_pop("_z") * F.count(F.lit(1))).alias("ssi"))
    per = materialize(per)
    # the mean first (one number), then squares around it: nothing cancels
    mean = per.agg(F.sum(F.col("ni") * F.col("zi")) / F.sum("ni")).first()[0]
    off = F.col("zi") - F.lit(mean).cast("double")
    tot = per.agg(F.count(F.lit(1)).alias("k"), F.sum("ni").alias("n"),
                  F.sum(F.col("ni") * off * off).alias("between"), F.sum("ssi").alias("within"))
    k, n = F.col("k").cast("double"), F.col("n").cast("double")
    between = F.col("between")
    # one group, or no spread inside the groups: undefined, null (not an error)
    w = F.try_divide((n - k) * between, (k - 1) * F.col("within"))
    return tot.select(F.col("k"), F.col("n"), w.alias("w"), (k - 1).alias("df1"), (n - k).alias("df2"))


def levene(df: DataFrame, value: str, group: str) -> DataFrame:
    stat = levene_stat(df, value, group)
    return stat.withColumn("pvalue", f_sf(F.col("w"), F.col("df1"), F.col("df2")))


# ---------------------------------------------------------- Mann-Whitney

def mannwhitney_stat(df: DataFrame, value: str, group: str, a: str, b: str,
                     partitions: int | None = None) -> DataFrame:
    """Two-sided Mann-Whitney U with tie correction and continuity
    correction (O-54), one row: (n1, n2, u1, u, tie_term, z, exact_case).

    Ties are aggregated first (one row per distinct value), midranks come
    from a prefix sum over the distinct values, and rank sums are exact
    decimal sums.  ``exact_case`` flags inputs for which the library would
    use the exact distribution (a sample of at most 8 and no ties)."""
    v = F.col(value).cast("double")
    base = df.filter(F.col(group).isin(a, b) & v.isNotNull()).select(
        F.col(group).alias("_g"), v.alias("_v"))
    per_value = base.groupBy("_v").agg(
        F.sum(F.when(F.col("_g") == a, 1).otherwise(0)).cast("long").alias("c1"),
        F.count(F.lit(1)).alias("t"))
    cum = prefix_sum(per_value, ["_v"], "t", out="before", inclusive=False, partitions=partitions)
    dec = "decimal(38,0)"
    twice_rank = (F.col("before") * 2 + F.col("t") + 1).cast(dec)
    sums = cum.agg(
        F.sum(F.col("c1").cast(dec)).alias("n1"),
        F.sum(F.col("t").cast(dec)).alias("nn"),
        F.sum(F.col("c1").cast(dec) * twice_rank).alias("r1x2"),
        F.sum(F.col("t").cast(dec) * F.col("t").cast(dec) * F.col("t").cast(dec)
              - F.col("t").cast(dec)).alias("tie_term"),
        F.max("t").alias("max_t"))
    n1 = F.col("n1").cast("double")
    nn = F.col("nn").cast("double")
    n2 = nn - n1
    u1 = F.col("r1x2").cast("double") / 2.0 - n1 * (n1 + 1) / 2.0
    out = sums.select(n1.alias("n1"), n2.alias("n2"), u1.alias("u1"),
                      F.col("tie_term").cast("double").alias("tie_term"),
                      nn.alias("nn"), F.col("max_t"))
    u = F.greatest(F.col("u1"), F.col("n1") * F.col("n2") - F.col("u1"))
    sd = F.sqrt(F.col("n1") * F.col("n2") / 12.0
                * ((F.col("nn") + 1) - F.try_divide(F.col("tie_term"),
                                                    F.col("nn") * (F.col("nn") - 1))))
    # an empty sample or all values tied: z undefined, null (not an error)
    z = F.try_divide(u - F.col("n1") * F.col("n2") / 2.0 - 0.5, sd)
    exact = (F.least(F.col("n1"), F.col("n2")) <= 8) & (F.col("max_t") <= 1)
    return out.select("n1", "n2", "u1", u.alias("u"), "tie_term", z.alias("z"),
                      exact.alias("exact_case"))


def mannwhitney(df: DataFrame, value: str, group: str, a: str, b: str,
                partitions: int | None = None) -> DataFrame:
    """:func:`mannwhitney_stat` with ``pvalue``: exact where ``exact_case`` is
    set, else from ``z``.  The exact tail is counted in the JVM while U has at
    most EXACT_U_MAX values, in Python's integers (one row) beyond."""
    ship_package(df.sparkSession)
    stat = mannwhitney_stat(df, value, group, a, b, partitions)
    m, n = F.least("n1", "n2"), F.greatest("n1", "n2")
    exact = F.col("exact_case") & (m >= 1)
    counted = exact & (m * n <= EXACT_U_MAX)

    @F.udf("double")
    def closed(wanted, m, n, u):
        return rank_sum_tail_closed(int(m), int(n), int(u)) if wanted else None

    large = closed(exact & ~counted, m, n, F.ceil("u"))
    return stat.withColumn("pvalue", F.when(
        counted, F.least(F.lit(1.0), 2 * rank_sum_tail(m, n, F.ceil("u")))).when(
        exact, F.least(F.lit(1.0), 2 * large)).otherwise(two_sided_normal_p(F.col("z"))))


def long_form(df: DataFrame, cols: Sequence[str], group: str = "g", value: str = "v") -> DataFrame:
    """Stack columns into (group, value) rows, e.g. two cost columns into
    one two-sample table."""
    return df.select(*cols).unpivot([], list(cols), group, value)
