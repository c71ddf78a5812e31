"""Degree-2 polynomial ridge regression and R² (O-24, O-29, O-30, O-42..O-45).

The model is the chain mean-impute -> min-max scale -> [1, t, t²] -> ridge
with intercept.  Fitting is two aggregate passes over the training rows:
imputation mean and min/max, then the centred second moments of (t, t², y)
with Spark's stable ``var_pop``/``covar_pop``.  The 2x2 ridge system is
solved on the driver from those nine numbers (the bias column is constant,
so centring gives it coefficient 0).  Predicting is a column expression.

``mllib_ridge_pipeline`` is the same model as an MLlib ``Pipeline``; MLlib
scales the penalty by the label's standard deviation, so sklearn's alpha maps
to ``regParam = alpha / n * sd_pop(y)`` with ``standardization=False``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import safe_sqrt
from .features import MeanImputer, MinMax


@dataclass(frozen=True)
class RidgePoly2:
    x: str
    impute_mean: float
    scale: MinMax
    intercept: float
    coef: tuple[float, float, float]   # bias, t, t^2
    n_train: int
    alpha: float

    def features(self, x: str | Column | None = None) -> Column:
        col = F.col(x or self.x) if not isinstance(x, Column) else x
        return self.scale.expr(F.coalesce(col.cast("double"), F.lit(float(self.impute_mean))))

    def predict(self, x: str | Column | None = None) -> Column:
        t = self.features(x)
        b0, b1, b2 = self.coef
        return (F.lit(self.intercept) + F.lit(b0) + F.lit(b1) * t + F.lit(b2) * t * t)

    def as_rows(self) -> list[tuple[str, float]]:
        return [("n_train", float(self.n_train)), ("impute_mean", self.impute_mean),
                ("x_min", self.scale.lo), ("x_max", self.scale.hi),
                ("coef_bias", self.coef[0]), ("coef_t", self.coef[1]),
                ("coef_t2", self.coef[2]), ("intercept", self.intercept)]


def fit_ridge_poly2(train: DataFrame, x: str, y: str, alpha: float = 1.0) -> RidgePoly2:
    train = train.filter(F.col(y).isNotNull())
    # one pass: the imputation mean lies inside [min, max] of the present
    # values, so min/max of the imputed column equal those of the raw one
    st = train.agg(F.avg(x).alias("m"), F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    imp = MeanImputer({x: st["m"]})
    xi = imp.expr(x)
    scale = MinMax(st["lo"], st["hi"])
    t = scale.expr(xi)
    rows = (train.select(t.alias("t"), F.col(y).cast("double").alias("y"))
            .select("y", "t", (F.col("t") * F.col("t")).alias("t2")))
    n, intercept, b1, b2 = fit_ridge_2(rows, "t", "t2", "y", alpha)
    return RidgePoly2(x, imp.means[x], scale, intercept, (0.0, b1, b2), n, alpha)


def fit_ridge_2(rows: DataFrame, one: str, two: str, y: str, alpha: float) -> tuple[int, float, float, float]:
    """(rows, intercept, slope of ``one``, slope of ``two``) of a ridge fit on two
    columns, the intercept not penalised; one pass, rows without a target do
    not count."""
    m = (rows.filter(F.col(y).isNotNull())
         .select(F.col(y).cast("double").alias("y"), F.col(one).alias("t"), F.col(two).alias("t2"))
         .agg(F.count(F.lit(1)).alias("n"), F.avg("t").alias("mt"), F.avg("t2").alias("mt2"),
              F.avg("y").alias("my"), F.var_pop("t").alias("v11"), F.var_pop("t2").alias("v22"),
              F.covar_pop("t", "t2").alias("v12"), F.covar_pop("t", "y").alias("c1"),
              F.covar_pop("t2", "y").alias("c2"))
         .first())
    n = m["n"]
    if not n:
        raise ValueError("no training rows")
    a11 = n * m["v11"] + alpha
    a22 = n * m["v22"] + alpha
    a12 = n * m["v12"]
    r1, r2 = n * m["c1"], n * m["c2"]
    det = a11 * a22 - a12 * a12
    b1 = (a22 * r1 - a12 * r2) / det
    b2 = (a11 * r2 - a12 * r1) / det
    return n, m["my"] - b1 * m["mt"] - b2 * m["mt2"], b1, b2


def r2_by_group(df: DataFrame, y: str, pred: str, group: str) -> DataFrame:
    """R² per group in one pass (O-45): 1 - SSE/SST, with the library rule
    for a constant target (1 if predictions are exact, else 0); ``r`` is the
    square root, null for a negative R² (O-29)."""
    yy = F.col(y).cast("double")
    agg = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((yy - F.col(pred)) * (yy - F.col(pred))).alias("sse"),
        (F.var_pop(yy) * F.count(F.lit(1))).alias("sst"))
    r2 = (F.when(F.col("sst") > 0, F.lit(1.0) - F.col("sse") / F.col("sst"))
          .when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return agg.select(group, "n", r2.alias("r2")).withColumn("r", safe_sqrt("r2"))


def curve_grid(spark: SparkSession, lo: float, hi: float, n: int = 100) -> DataFrame:
    """``n`` evenly spaced points over [lo, hi], inclusive (O-30)."""
    step = (hi - lo) / (n - 1) if n > 1 else 0.0
    return spark.range(n).select(
        F.col("id").cast("int").alias("i"),
        F.when(F.col("id") == n - 1, F.lit(float(hi)))
         .otherwise(F.lit(float(lo)) + F.col("id") * F.lit(step)).alias("x"))


def mllib_ridge_pipeline(n_train: int, sd_y_pop: float, alpha: float = 1.0,
                         x: str = "x", y: str = "y") -> Pipeline:
    """The same chain as an MLlib Pipeline (O-43): Imputer -> assembler ->
    degree-2 expansion of the min-max scaled input -> LinearRegression with
    an L2 penalty equivalent to ridge ``alpha``.  Min-max scaling is applied
    by the caller as a column (MLlib's MinMaxScaler maps constants to 0.5)."""
    reg = alpha / n_train * sd_y_pop
    return Pipeline(stages=[
        Imputer(strategy="mean", inputCols=[x], outputCols=[f"{x}_imp"]),
        VectorAssembler(inputCols=[f"{x}_imp"], outputCol="x_vec"),
        PolynomialExpansion(degree=2, inputCol="x_vec", outputCol="features"),
        LinearRegression(featuresCol="features", labelCol=y, regParam=reg, elasticNetParam=0.0,
                         standardization=False, solver="normal", fitIntercept=True),
    ])
