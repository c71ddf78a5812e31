"""The correlation analysis: cups/day against spend/day.

cleaned table (O-35) -> 75/25 keyed split (O-37) -> polynomial ridge fit on
the training rows (O-39..O-43) -> R and R² on both splits (O-45, O-29) ->
chart data: 100-point fitted curve (O-30, O-44), jittered points (O-31) and
2-D binned counts of the scatter (O-04).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import keyed_normal
from ..operators.order import hash_split
from ..operators.regression import RidgePoly2, curve_grid, fit_ridge_poly2, r2_by_group
from .cleaning import cleaned_correlation

SPLIT_SALT = "correlation"
X, Y = "spent_assumptions", "cup_assumptions"


@dataclass
class CorrelationFit:
    data: DataFrame          # id, cup_assumptions, spent_assumptions, split
    model: RidgePoly2


def split_correlation(survey: DataFrame, key_unique: bool | None = True,
                      salt: str = SPLIT_SALT) -> DataFrame:
    return hash_split(cleaned_correlation(survey, key_unique=key_unique), "id", 0.75, salt=salt)


def fit_correlation(survey: DataFrame, alpha: float = 1.0, key_unique: bool | None = True,
                    salt: str = SPLIT_SALT) -> CorrelationFit:
    data = split_correlation(survey, key_unique, salt)
    model = fit_ridge_poly2(data.filter(F.col("split") == "train"), X, Y, alpha)
    return CorrelationFit(data, model)


def coefficients(fit: CorrelationFit) -> DataFrame:
    spark = fit.data.sparkSession
    return spark.createDataFrame(fit.model.as_rows(), "metric string, value double")


def r2_table(fit: CorrelationFit) -> DataFrame:
    scored = fit.data.select(Y, "split", fit.model.predict(X).alias("pred"))
    return r2_by_group(scored, Y, "pred", "split")


def curve(fit: CorrelationFit, n: int = 100) -> DataFrame:
    """Fitted curve over [min X, max X] of all rows (train and validation)."""
    row = fit.data.agg(F.min(X).alias("lo"), F.max(X).alias("hi")).first()
    grid = curve_grid(fit.data.sparkSession, row["lo"], row["hi"], n)
    return grid.select("i", "x", fit.model.predict(F.col("x")).alias("y"))


def jitter(fit: CorrelationFit, sd: float = 0.1, seed: int = 7) -> DataFrame:
    """Scatter points with Gaussian jitter of sd ``sd`` on y (O-31).  The
    draw is keyed by (seed, respondent id), so it is repeatable and does not
    depend on partitioning (the original drew unseeded)."""
    return fit.data.select("id", F.col(X).alias("x"),
                           (F.col(Y) + F.lit(sd) * keyed_normal("id", seed)).alias("y"))


def scatter_bins(data: DataFrame, x: str, y: str, wx: float, wy: float) -> DataFrame:
    """2-D binned counts of a scatter (O-04): what a plot of a huge table
    draws, computed with partial aggregation instead of shipping points."""
    return (data.groupBy(F.floor(F.col(x) / wx).cast("long").alias("bx"),
                         F.floor(F.col(y) / wy).cast("long").alias("by"))
            .agg(F.count(F.lit(1)).alias("n")))


def chart_series(fit: CorrelationFit, n: int = 100) -> DataFrame:
    """Plot-ready long table (series, x, y): the data points and the fitted
    curve (O-04).  The points are the whole table; a renderer facing a huge
    table draws ``scatter_bins`` instead."""
    pts = fit.data.select(F.lit("data").alias("series"), F.col(X).alias("x"),
                          F.col(Y).cast("double").alias("y"))
    fitted = curve(fit, n).select(F.lit("fit").alias("series"), "x", "y")
    return pts.unionByName(fitted)
