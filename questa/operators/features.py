"""Feature preparation (O-18, O-39, O-40, O-41, O-47).

Each scaler is fitted with one global aggregate (partial per task, a single
tiny merge) on the training rows and applied as a column expression, so
fitting costs one pass and applying costs nothing extra.  Conventions follow
the original analysis' library defaults: population standard deviation, and
a constant column maps to 0 (not MLlib's 0.5).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


@dataclass(frozen=True)
class MeanImputer:
    means: dict

    @staticmethod
    def fit(df: DataFrame, cols: Sequence[str]) -> "MeanImputer":
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return MeanImputer({c: row[c] for c in cols})

    def expr(self, col: str) -> Column:
        m = self.means[col]
        return F.coalesce(F.col(col).cast("double"), F.lit(m).cast("double"))


@dataclass(frozen=True)
class MinMax:
    lo: float
    hi: float

    @staticmethod
    def fit(df: DataFrame, col: str | Column) -> "MinMax":
        row = df.agg(F.min(_c(col)).alias("lo"), F.max(_c(col)).alias("hi")).first()
        return MinMax(row["lo"], row["hi"])

    def expr(self, col: str | Column) -> Column:
        x = _c(col).cast("double")
        if self.lo is None or self.hi is None:
            return F.lit(None).cast("double")
        rng = self.hi - self.lo
        if rng == 0:
            return x - F.lit(float(self.lo))
        return (x - F.lit(float(self.lo))) / F.lit(float(rng))


@dataclass(frozen=True)
class Standardizer:
    """(x - mean) / population sd, fitted on training rows (O-47)."""
    stats: dict

    @staticmethod
    def fit(df: DataFrame, cols: Sequence[str]) -> "Standardizer":
        aggs = []
        for c in cols:
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        return Standardizer({c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols})

    def expr(self, col: str) -> Column:
        m, s = self.stats[col]
        x = F.col(col).cast("double") - F.lit(float(m))
        return x if not s else x / F.lit(float(s))


def poly2_terms(t: Column) -> list[Column]:
    """[1, t, t^2]: the degree-2 expansion with bias column (O-41)."""
    return [F.lit(1.0), t, t * t]


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Stack numeric columns into an MLlib vector column (O-18); nulls are an
    error, as in a numpy stack."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)
