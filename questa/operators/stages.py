"""The analysis steps as stages of a Spark ML ``Pipeline`` (O-43): recode, cost,
min-max scaling with degree-2 terms, exact ridge.  Each can be saved and loaded,
alone or in a fitted chain, and each is one projection; fitting costs one or two
aggregates."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codebooks import DAYS_PER_YEAR
from ..functions.expr import recode, strict_cast
from .cost import cost_map, multiselect_cost_inline
from .features import MeanImputer, MinMax
from .regression import fit_ridge_2


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Parameters are set by keyword, and read by name."""

    def __init__(self, **values):
        super().__init__()
        for name, value in values.items():
            if value is not None:
                self.set(self.getParam(name), value)

    def value(self, name: str):
        return self.getOrDefault(self.getParam(name))


def _param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc)


class Recode(_Stage, Transformer):
    """``outputCol`` = the value of each label, cast strictly to ``to`` and divided by
    ``per``; labels that the mapping lacks are cast as they are."""
    inputCol, outputCol = _param("inputCol", "text column"), _param("outputCol", "new column")
    mapping, to = _param("mapping", "label -> value"), _param("to", "type of the values")
    per = _param("per", "divisor")

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, mapping: dict | None = None,
                 to: str = "int", per: float = 1.0):
        super().__init__(inputCol=inputCol, outputCol=outputCol, mapping=mapping, to=to, per=per)

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.value("inputCol")
        number = strict_cast(recode(c, self.value("mapping")), self.value("to"), name=c)
        per = self.value("per")
        return df.withColumn(self.value("outputCol"), number if per == 1 else number / F.lit(per))


class MultiselectCost(_Stage, Transformer):
    """``outputCol`` = the daily cost of the dearest of the chosen options."""
    optionsCol, quantityCol = _param("optionsCol", "chosen options"), _param("quantityCol", "uses a day")
    outputCol, costs = _param("outputCol", "new column"), _param("costs", "option -> [upfront, per use]")
    days = _param("days", "days that the upfront cost is spread over")

    def __init__(self, optionsCol: str | None = None, quantityCol: str | None = None, outputCol: str = "brewing_cost",
                 costs: dict | None = None, days: float = DAYS_PER_YEAR):
        super().__init__(optionsCol=optionsCol, quantityCol=quantityCol, outputCol=outputCol, costs=costs, days=days)

    def _transform(self, df: DataFrame) -> DataFrame:
        costs = cost_map({k: tuple(v) for k, v in self.value("costs").items()})
        return multiselect_cost_inline(df, self.value("optionsCol"), self.value("quantityCol"), costs, self.value("days"),
                                       self.value("outputCol"))


class _Poly2Params(_Stage):
    inputCol = _param("inputCol", "numeric column")
    outputCols = _param("outputCols", "columns of the scaled value and its square")


class MinMaxPoly2(_Poly2Params, Estimator):
    """Learns the mean (for missing values), minimum and maximum of a column."""

    def __init__(self, inputCol: str | None = None, outputCols: list[str] | None = None):
        super().__init__(inputCol=inputCol, outputCols=outputCols)

    def _fit(self, df: DataFrame) -> "MinMaxPoly2Model":
        c = self.value("inputCol")
        mean, lo, hi = df.agg(F.avg(c), F.min(c), F.max(c)).first()
        if mean is None:
            raise ValueError(f"no value of {c!r} to fit")
        return MinMaxPoly2Model(c, self.value("outputCols"), float(mean), float(lo), float(hi))


class MinMaxPoly2Model(_Poly2Params, Model):
    mean, lo, hi = _param("mean", "for missing values"), _param("lo", "scaled to 0"), _param("hi", "scaled to 1")

    def __init__(self, inputCol: str | None = None, outputCols: list[str] | None = None, mean: float | None = None,
                 lo: float | None = None, hi: float | None = None):
        super().__init__(inputCol=inputCol, outputCols=outputCols, mean=mean, lo=lo, hi=hi)

    def _transform(self, df: DataFrame) -> DataFrame:
        c, (one, two) = self.value("inputCol"), self.value("outputCols")
        t = MinMax(self.value("lo"), self.value("hi")).expr(MeanImputer({c: self.value("mean")}).expr(c))
        return df.withColumn(one, t).withColumn(two, F.col(one) * F.col(one))


class _RidgeParams(_Stage):
    inputCols, labelCol = _param("inputCols", "the two features"), _param("labelCol", "target")
    predictionCol = _param("predictionCol", "new column")


class Ridge2(_RidgeParams, Estimator):
    """Exact ridge regression on two features, the intercept not penalised."""
    alpha = _param("alpha", "weight of the squared coefficients")

    def __init__(self, inputCols: list[str] | None = None, labelCol: str | None = None, predictionCol: str = "prediction",
                 alpha: float = 1.0):
        super().__init__(inputCols=inputCols, labelCol=labelCol, predictionCol=predictionCol, alpha=alpha)

    def _fit(self, df: DataFrame) -> "Ridge2Model":
        one, two = self.value("inputCols")
        _, b0, b1, b2 = fit_ridge_2(df, one, two, self.value("labelCol"), self.value("alpha"))
        return Ridge2Model([one, two], self.value("labelCol"), self.value("predictionCol"), [b0, b1, b2])


class Ridge2Model(_RidgeParams, Model):
    coefficients = _param("coefficients", "intercept and both slopes")

    def __init__(self, inputCols: list[str] | None = None, labelCol: str | None = None, predictionCol: str = "prediction",
                 coefficients: list[float] | None = None):
        super().__init__(inputCols=inputCols, labelCol=labelCol, predictionCol=predictionCol, coefficients=coefficients)

    def _transform(self, df: DataFrame) -> DataFrame:
        (one, two), (b0, b1, b2) = self.value("inputCols"), self.value("coefficients")
        return df.withColumn(self.value("predictionCol"), F.lit(b0) + F.lit(b1) * F.col(one) + F.lit(b2) * F.col(two))
