"""questa: survey analytics on Spark.

Reads wide questionnaire tables, keeps complete cases, recodes banded
answers, prices multi-select answers against a cost table and compares
respondents; on top: polynomial ridge regression, exact 1-D k-NN regression,
a logistic classifier, repeatable splits and distribution tests, each as a
distributed DataFrame or MLlib job.
"""

import sys as _sys

try:  # ship our functions to Python workers by value (no package install needed)
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

from .functions.expr import recode, split_multiselect, strict_cast  # noqa: E402
from .operators.classify import accuracy, train_and_predict  # noqa: E402
from .operators.cost import multiselect_cost, other_average  # noqa: E402
from .operators.features import MeanImputer, MinMax, Standardizer  # noqa: E402
from .operators.joins import complete_cases  # noqa: E402
from .operators.knn import knn_regress_1d  # noqa: E402
from .operators.order import (exact_split, hash_split, prefix_sum,  # noqa: E402
                              row_position)
from .operators.quantile import exact_quantile  # noqa: E402
from .operators.regression import fit_ridge_poly2, r2_by_group  # noqa: E402
from .operators.stattests import levene, mannwhitney, normaltest  # noqa: E402
from .session import ensure_checkpoint_dir, materialize  # noqa: E402
from .sources.survey_csv import read_survey_csv, write_csv  # noqa: E402

__all__ = [
    "recode", "split_multiselect", "strict_cast", "accuracy", "train_and_predict",
    "multiselect_cost", "other_average", "MeanImputer", "MinMax", "Standardizer",
    "complete_cases", "knn_regress_1d", "exact_split", "hash_split", "prefix_sum",
    "row_position", "exact_quantile", "fit_ridge_poly2", "r2_by_group", "levene",
    "mannwhitney", "normaltest", "ensure_checkpoint_dir", "materialize",
    "read_survey_csv", "write_csv",
]
