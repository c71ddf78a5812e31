"""The command-line analyses run on a survey CSV with question headers."""

from questa.__main__ import run_correlation, run_worth
from questa.sources.survey_csv import read_csv_strings, to_questionnaire, write_csv
from questa.sources.tables import derived_survey


def test_cli_analyses(spark, sf_dir, tmp_path, capsys):
    src = str(tmp_path / "survey")
    write_csv(to_questionnaire(derived_survey(spark, sf_dir)), src)
    out = str(tmp_path / "out")
    run_correlation(spark, src, out)
    run_worth(spark, src, out)
    printed = capsys.readouterr().out
    assert "coef_t2" in printed and "mannwhitney" in printed
    corr = read_csv_strings(spark, out + "/correlation.csv")
    assert corr.columns == ["id", "cup_assumptions", "spent_assumptions"]
    assert corr.count() > 0
    assert spark.read.parquet(out + "/chart_curve").count() == 100
    assert spark.read.parquet(out + "/chart_bars").count() == 2
    metrics = read_csv_strings(spark, out + "/worth_metrics")
    assert metrics.filter("metric = 'accuracy'").count() == 1


def test_single_line_reading_gives_the_same(spark, sf_dir, tmp_path, capsys):
    src = str(tmp_path / "survey")
    write_csv(to_questionnaire(derived_survey(spark, sf_dir)), src)
    run_correlation(spark, src, str(tmp_path / "a"))
    whole = capsys.readouterr().out
    run_correlation(spark, src, str(tmp_path / "b"), multiline=False)
    assert capsys.readouterr().out == whole


def test_worth_report_threads_do_not_change_results(spark, sf_dir):
    from questa.plans import worth
    from questa.plans.report import worth_report
    d = worth.decision_table(derived_survey(spark, sf_dir), materialized=True)
    pos = worth.with_positions(d)
    one = {(r.analysis, r.metric): r.value for r in worth_report(d=d, pos=pos, threads=1).collect()}
    four = {(r.analysis, r.metric): r.value for r in worth_report(d=d, pos=pos, threads=4).collect()}
    assert one.keys() == four.keys() and len(one) == 19
    for k in one:
        assert one[k] == four[k] or abs(one[k] - four[k]) <= 1e-9 * max(1.0, abs(one[k])), k
