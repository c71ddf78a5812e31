"""Tidy result tables (O-03): every printed number of an analysis as rows
(analysis, metric, value), built by ``unionByName`` of small aggregates."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.classify import accuracy
from ..operators.stattests import levene, long_form, mannwhitney, normaltest
from . import correlation, worth
from .cleaning import value_counts


def tidy(df: DataFrame, analysis: str, metrics: list[str], prefix_col: str | None = None) -> DataFrame:
    """Unpivot metric columns into (analysis, metric, value)."""
    out = df.unpivot([prefix_col] if prefix_col else [], metrics, "metric", "value")
    metric = (F.concat_ws(":", F.col(prefix_col).cast("string"), F.col("metric"))
              if prefix_col else F.col("metric"))
    return out.select(F.lit(analysis).alias("analysis"), metric.alias("metric"),
                      F.col("value").cast("double").alias("value"))


def worth_report(survey: DataFrame | None = None, d: DataFrame | None = None,
                 pos: DataFrame | None = None, threads: int = 4) -> DataFrame:
    """All printed worth results; pass an already materialized decision table
    ``d`` (and its positions ``pos``) to reuse them.

    The analyses are independent and each runs eager jobs while its plan is
    built (checkpoints, fits, histograms), so they are built from a few
    driver threads: Spark schedules concurrent jobs side by side, which
    keeps executors busy while one analysis waits on a small job."""
    d = d if d is not None else worth.decision_table(survey, materialized=True)
    pos = pos if pos is not None else worth.with_positions(d)
    two = long_form(d, ["outside_cost", "brewing_cost"], "g", "v")

    def means():
        return worth.means(d).select(F.lit("worth").alias("analysis"), "metric", "value")

    def knn(target, name):
        return tidy(worth.knn_r2(worth.knn_fit_predict(pos, target)), name, ["r2", "r"], "split")

    def counts():
        c = value_counts(d, "cheaper_option")
        return tidy(c.withColumn("count", F.col("count").cast("double")), "cheaper_option",
                    ["count"], "cheaper_option")

    def classifier():
        return tidy(accuracy(worth.classify_decision(d).predictions), "classifier", ["accuracy"])

    builders = [
        means,
        lambda: knn("brewing_cost", "knn_home"),
        lambda: knn("outside_cost", "knn_outside"),
        counts,
        classifier,
        lambda: tidy(normaltest(two, "v", ["g"]), "normaltest", ["pvalue"], "g"),
        lambda: tidy(levene(two, "v", "g"), "levene", ["w", "pvalue"]),
        lambda: tidy(mannwhitney(two, "v", "g", "outside_cost", "brewing_cost"), "mannwhitney",
                     ["u1", "pvalue"]),
    ]
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        parts = list(pool.map(lambda build: build(), builders))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def correlation_report(survey: DataFrame | None = None,
                       fit: correlation.CorrelationFit | None = None) -> DataFrame:
    fit = fit if fit is not None else correlation.fit_correlation(survey)
    coefs = correlation.coefficients(fit).select(
        F.lit("ridge").alias("analysis"), "metric", "value")
    r2 = tidy(correlation.r2_table(fit), "ridge", ["r2", "r"], "split")
    return coefs.unionByName(r2)
