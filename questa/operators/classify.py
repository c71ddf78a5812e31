"""Binary classifier on two numeric features (O-43, O-48..O-51).

The original trains a perceptron with no hidden layer and a logistic output
unit, i.e. L2-regularised logistic regression on standardised features.
Here: population-sd standardisation fitted on the training rows (a column
expression), an MLlib ``Pipeline`` of ``VectorAssembler`` and
``LogisticRegression`` (L-BFGS, distributed gradient per iteration), and
accuracy as one aggregate over the held-out predictions.

The L2 weight follows the original's defaults: alpha 1e-4 applied per
mini-batch of min(200, n) rows, i.e. ``regParam = 1e-4 / min(200, n)`` on
the mean log-loss.  It must stay > 0: the two classes are separated by a
line in these features, so the unpenalised optimum is at infinity.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import Standardizer


def default_reg(n_train: int, alpha: float = 1e-4, batch: int = 200) -> float:
    return alpha / max(1, min(batch, n_train))


def logistic_pipeline(features: Sequence[str], label: str = "label", reg: float = 5e-7,
                      max_iter: int = 100, tol: float = 1e-6) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"),
        LogisticRegression(featuresCol="features", labelCol=label, regParam=reg,
                           elasticNetParam=0.0, standardization=False, maxIter=max_iter,
                           tol=tol, family="binomial"),
    ])


def mlp_classifier(n_features: int, seed: int = 42) -> MultilayerPerceptronClassifier:
    """The 16-8 perceptron the original constructs (and then replaces before
    training); offered for completeness.  MLlib's hidden units are sigmoid
    and it has no L2 term, so it is not the same model."""
    return MultilayerPerceptronClassifier(layers=[n_features, 16, 8, 2], maxIter=500,
                                          seed=seed, featuresCol="features", labelCol="label")


@dataclass
class ClassifierResult:
    model: PipelineModel
    scaler: Standardizer
    predictions: DataFrame   # test rows with label and prediction
    n_train: int


def train_and_predict(df: DataFrame, features: Sequence[str], label: str = "label",
                      split: str = "split", train_value: str = "train",
                      test_value: str = "test", reg: float | None = None,
                      carry: Sequence[str] = ()) -> ClassifierResult:
    train_rows = df.filter(F.col(split) == train_value)
    scaler = Standardizer.fit(train_rows, features)
    cols = [scaler.expr(c).alias(c) for c in features]
    prepared = df.select(*cols, F.col(label).cast("double").alias("label"), F.col(split), *carry)
    train = prepared.filter(F.col(split) == train_value).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_train = train.count()
        model = logistic_pipeline(features, "label",
                                  reg if reg is not None else default_reg(n_train)).fit(train)
    finally:
        train.unpersist()
    test = prepared.filter(F.col(split) == test_value)
    return ClassifierResult(model, scaler, model.transform(test), n_train)


def predicted_classes(res: ClassifierResult, key: str) -> DataFrame:
    """(key, label, predicted, margin) of every test row (O-50): ``predicted`` is
    1 if the margin, the log of the odds, is above 0.  ``key`` must be among the
    columns that ``train_and_predict`` carried."""
    return res.predictions.select(key, F.col("label").cast("int").alias("label"),
                                  F.col("prediction").cast("int").alias("predicted"),
                                  F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("margin"))


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of correct predictions (O-51), one row."""
    return pred.agg(F.count(F.lit(1)).alias("n_test"),
                    F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0))
                    .alias("accuracy"))
