"""Command line: run an analysis on a survey CSV.

    python -m questa correlation --survey survey.csv --out results/
    python -m questa worth --survey survey.csv --out results/

The CSV is parsed once, into the shared checkpoint folder; every step reads that
copy.  Large files are read in ranges, whatever line breaks their answers hold.

Writes the cleaned table as CSV (``correlation.csv/`` or ``worth.csv/``,
folders of part files), the chart data as Parquet, and the metrics table
(analysis, metric, value) as CSV; prints the metrics.  Uses the active
session settings (``spark-submit`` conf) or a local session when run
directly.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from .plans import cleaning, correlation, worth
from .plans.report import correlation_report, worth_report
from .session import ensure_checkpoint_dir, materialize
from .sources.survey_csv import read_survey_csv, write_csv


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName("questa")
    if "SPARK_HOME" not in os.environ and not os.environ.get("PYSPARK_SUBMIT_ARGS"):
        builder = builder.master("local[*]").config("spark.ui.enabled", "false")
    return builder.getOrCreate()


def run_correlation(spark: SparkSession, survey_path: str, out: str, multiline: bool | str = "split") -> None:
    survey = materialize(read_survey_csv(spark, survey_path, multiline=multiline))
    cleaning.export_correlation(survey, f"{out}/correlation.csv")
    fit = correlation.fit_correlation(survey, key_unique=None)
    correlation.curve(fit).write.mode("overwrite").parquet(f"{out}/chart_curve")
    correlation.jitter(fit).write.mode("overwrite").parquet(f"{out}/chart_jitter")
    correlation.scatter_bins(fit.data, correlation.X, correlation.Y, 0.5, 1.0) \
        .write.mode("overwrite").parquet(f"{out}/chart_bins")
    report = correlation_report(fit=fit)
    rows = report.collect()          # a few metric rows; computed once
    write_csv(spark.createDataFrame(rows, report.schema), f"{out}/correlation_metrics")
    for r in rows:
        print(f"{r.analysis:12s} {r.metric:24s} {r.value}")


def run_worth(spark: SparkSession, survey_path: str, out: str, multiline: bool | str = "split") -> None:
    # the k-NN feature is the row position in file order, as in the original
    survey = materialize(read_survey_csv(spark, survey_path, multiline=multiline,
                                         row_order_col=worth.FILE_ORDER))
    cleaning.export_worth(survey, f"{out}/worth.csv")
    d = worth.decision_table(survey, key_unique=None, materialized=True,
                             order_col=worth.FILE_ORDER)
    pos = worth.with_positions(d, order=worth.FILE_ORDER)
    for target, name in (("brewing_cost", "home"), ("outside_cost", "outside")):
        worth.knn_fit_predict(pos, target).write.mode("overwrite").parquet(f"{out}/chart_knn_{name}")
    cleaning.value_counts(d, "cheaper_option").write.mode("overwrite").parquet(f"{out}/chart_bars")
    report = worth_report(d=d, pos=pos)
    rows = report.collect()
    write_csv(spark.createDataFrame(rows, report.schema), f"{out}/worth_metrics")
    for r in rows:
        print(f"{r.analysis:14s} {r.metric:36s} {r.value}")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="questa")
    p.add_argument("analysis", choices=["correlation", "worth"])
    p.add_argument("--survey", required=True, help="survey CSV (header row of question texts)")
    p.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    p.add_argument("--single-line", action="store_true",
                   help="no answer holds a line break: no quotes need to be counted")
    p.add_argument("--one-task", action="store_true",
                   help="quotes may stand within unquoted answers: each file is read by one task")
    a = p.parse_args(argv)
    spark = _session()
    ensure_checkpoint_dir(spark)
    run = run_correlation if a.analysis == "correlation" else run_worth
    run(spark, a.survey, a.out, multiline=False if a.single_line else True if a.one_task else "split")


if __name__ == "__main__":
    main()
