"""The "is home brewing worth it" analysis.

cleaned worth table (O-36) -> decision columns (O-34) -> for each daily cost
(home, outside): row position (O-07) as the feature, 75/25 keyed split,
5-NN regression and R² (O-45, O-46), means (O-23) -> classifier on the two
costs with a seeded exact 80/20 split (O-38, O-47..O-51) -> distribution
tests on the two costs (O-52..O-54).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import Standardizer
from ..operators.classify import train_and_predict
from ..operators.knn import knn_sorted
from ..operators.order import exact_split, hash_split, row_position
from ..operators.regression import r2_by_group
from ..session import materialize
from .cleaning import cleaned_worth, decision

TEST_SEED = 42
FILE_ORDER = "_file_row"
KNN_SALTS = {"brewing_cost": "worth-home", "outside_cost": "worth-outside"}


def decision_table(survey: DataFrame, key_unique: bool | None = True,
                   materialized: bool = False, order_col: str | None = None) -> DataFrame:
    """Cleaned worth rows with the decision columns.  ``materialized`` writes
    it once to the checkpoint folder: its lineage (lines joined to parts,
    aggregated per order, joined to orders) is the expensive part, and the
    multi-pass analyses below scan it several times."""
    d = decision(cleaned_worth(survey, key_unique=key_unique, order_col=order_col))
    return materialize(d) if materialized else d


def split_decision(d: DataFrame, seed: int = TEST_SEED) -> DataFrame:
    """``split`` in {train, test}: exactly ceil(0.2 n) test rows chosen by a
    seeded hash (O-38)."""
    return exact_split(d, "id", 0.2, seed=seed)


def decision_split(survey: DataFrame, key_unique: bool | None = True,
                   seed: int = TEST_SEED) -> DataFrame:
    return split_decision(decision_table(survey, key_unique, materialized=True), seed)


KNN_COLUMNS = ("id", "brewing_cost", "outside_cost")


def with_positions(df: DataFrame, order: str = "id",
                   columns: tuple[str, ...] | None = KNN_COLUMNS) -> DataFrame:
    """Row position 1..n as the regression feature.  The original used the
    order of its joined frame, i.e. the file order of the complete cases:
    pass ``order=FILE_ORDER`` for a survey read with
    ``read_survey_csv(..., row_order_col=FILE_ORDER)``.  The default orders
    by respondent id.  Only ``columns`` are carried through the sort (all
    when None); the order column breaks no ties as it is unique."""
    if columns is not None:
        df = df.select(*dict.fromkeys([*columns, order]))
    return row_position(df, [order, "id"] if order != "id" else ["id"], out="pos")


def knn_fit_predict(positioned: DataFrame, target: str, k: int = 5,
                    salt: str | None = None) -> DataFrame:
    """(id, pos, y, split, pred): 5-NN on the row position, trained on the
    75% split and evaluated on every row (for the curve and both R²).
    ``positioned`` is what ``with_positions`` gives: its rows stand in the
    order of their positions, so no target sorts them again."""
    salt = salt if salt is not None else KNN_SALTS.get(target, target)
    data = hash_split(positioned.select("id", "pos", F.col(target).alias("y")), "id", 0.75,
                      salt=salt)
    return knn_sorted(data, "pos", [("y", F.col("split") == "train", "pred")], k)


def knn_r2(pred: DataFrame) -> DataFrame:
    return r2_by_group(pred, "y", "pred", "split")


def classify(survey: DataFrame, key_unique: bool | None = True, reg: float | None = None):
    """Logistic classifier of ``result`` on (outside_cost, brewing_cost),
    trained on the seeded 80% split, scored on the 20% (O-48..O-51)."""
    return classify_decision(decision_table(survey, key_unique, materialized=True), reg)


CLASSIFIER_FEATURES = ["outside_cost", "brewing_cost"]


def classify_decision(d: DataFrame, reg: float | None = None, carry: tuple[str, ...] = ()):
    return train_and_predict(split_decision(d), CLASSIFIER_FEATURES, "label", "split", reg=reg, carry=carry)


def standardized_split(survey: DataFrame, key_unique: bool | None = True) -> DataFrame:
    """(id, split, label, outside_cost, brewing_cost): the classifier's rows, costs
    standardised on the training rows."""
    d = decision_split(survey, key_unique)
    scaler = Standardizer.fit(d.filter(F.col("split") == "train"), CLASSIFIER_FEATURES)
    return d.select("id", "split", "label", *[scaler.expr(c).alias(c) for c in CLASSIFIER_FEATURES])


def means(decision_df: DataFrame) -> DataFrame:
    """Mean daily cost at home and outside (O-23) as (metric, value)."""
    row = decision_df.agg(F.avg("brewing_cost").alias("mean_brewing_cost"),
                          F.avg("outside_cost").alias("mean_outside_cost"))
    return row.unpivot([], ["mean_brewing_cost", "mean_outside_cost"], "metric", "value")
