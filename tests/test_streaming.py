"""Streaming ingestion gives the batch answer."""

from pyspark.sql import functions as F

from questa.plans import cleaning
from questa.sources.survey_csv import to_questionnaire, write_csv
from questa.sources.tables import derived_survey
from questa.streaming import start_cheaper_counts, start_cleaned_sink


def test_stream_matches_batch(spark, sf_dir, tmp_path):
    s = derived_survey(spark, sf_dir)
    wide = to_questionnaire(s)
    src = str(tmp_path / "src")
    write_csv(wide.filter(F.col("Submission ID") < "5"), src + "/batch=1")
    write_csv(wide.filter(F.col("Submission ID") >= "5"), src + "/batch=2")
    q = start_cleaned_sink(spark, src, str(tmp_path / "sink"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "sink"))
    batch = cleaning.decision(cleaning.cleaned_worth(s, key_unique=True))
    cols = ["id", "cup_assumptions", "eq_assumptions", "result", "cheaper_option"]
    assert sorted(streamed.select(*cols).collect()) == sorted(batch.select(*cols).collect())

    c = start_cheaper_counts(spark, src, "cheaper_counts_test", str(tmp_path / "ckpt2"),
                             max_files_per_trigger=1)
    c.awaitTermination()
    assert len(c.recentProgress) >= 2          # several micro-batches, state carried over
    got = {r.cheaper_option: r["count"] for r in spark.table("cheaper_counts_test").collect()}
    want = {r.cheaper_option: r["count"] for r in cleaning.value_counts(batch, "cheaper_option").collect()}
    assert got == want
