"""Cases found in review: sizes, nulls, repeats and texts that must not change
a result."""

import math
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from questa.functions.codebooks import SHORT_NAMES
from questa.functions.special import erfc, f_sf, two_sided_normal_p
from questa.operators.cost import multiselect_cost
from questa.operators.order import exact_split, prefix_sum
from questa.operators.quantile import exact_quantile
from questa.operators.stattests import mannwhitney
from questa.sources.survey_csv import csv_options, read_csv_strings, read_survey_csv, write_csv
from questa.sources.tables import read_table
from questa.streaming.survey_stream import read_survey_stream


def test_cost_paths_agree_on_repeats_nulls_and_large_tables(spark):
    rows = [("1", "a, b", 2), ("1", "b", 3), (None, "a, zz", 1), (None, "a", 1), ("2", None, 4),
            ("3", "zz", 1), ("3", "zz", 1), ("4", "", 1), ("5", "a, b", None)]
    df = spark.createDataFrame(rows, "id string, methods string, cups int")
    table = [("a", 365.0, 1.0), ("b", 365.0, 2.0), (None, 9.0, 9.0), (None, 8.0, 8.0), ("n", None, None)]
    table += [(f"m{i}", 1.0, 1.0) for i in range(257)]
    dim = spark.createDataFrame(table, "method string, upfront double, per_use double")
    got = [sorted(multiselect_cost(df, "methods", "cups", dim, inline_max_rows=n).collect(), key=str)
           for n in (0, 256, 1000)]
    assert got[0] == got[1] == got[2] and len(got[0]) == len(rows)
    assert {r.brewing_cost for r in got[0] if r.id == "1"} == {3.0, 7.0}


def test_identical_samples_have_p_one(spark):
    df = spark.createDataFrame([(g, float(v)) for g in "ab" for v in range(1, 11)], "g string, v double")
    assert mannwhitney(df, "v", "g", "a", "b").first().pvalue == 1.0


def test_tails(spark):
    row = spark.range(1).select(
        f_sf(F.lit(1.0), F.lit(1.0), F.lit(1e10)).alias("a"), f_sf(F.lit(1.0), F.lit(1.0), F.lit(1e13)).alias("b"),
        f_sf(F.lit(2.5), F.lit(2.0), F.lit(27.0)).alias("c"), f_sf(F.lit(None), F.lit(2.0), F.lit(27.0)).alias("d"),
        *[erfc(F.lit(t)).alias(f"e{i}") for i, t in enumerate((-1.0, 0.0, 1.9, 2.1, 6.0))],
        two_sided_normal_p(F.lit(-0.04)).alias("p")).first()
    assert row.a == pytest.approx(0.3173105, abs=1e-7) and row.b == pytest.approx(0.3173105, abs=1e-7)
    assert row.c == pytest.approx(0.1008988, abs=1e-7) and row.d is None and row.p == 1.0
    for i, t in enumerate((-1.0, 0.0, 1.9, 2.1, 6.0)):
        assert row[f"e{i}"] == pytest.approx(math.erfc(t), rel=1e-12)


def test_csv_keeps_texts_in_batch_sink_and_stream(spark, tmp_path):
    texts = [" a, ", 'say "x"', "two\nlines", "b", " "]
    rows = [tuple([str(i)] + [t] * (len(SHORT_NAMES) - 1)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in SHORT_NAMES))
    wide = df.select(*[F.col(c).alias(h) for c, h in SHORT_NAMES.items()])
    path = str(tmp_path / "csv")
    write_csv(wide.coalesce(1), path)
    want = sorted(tuple(r) for r in df.collect())
    assert sorted(tuple(r) for r in read_survey_csv(spark, path).collect()) == want
    assert len(read_csv_strings(spark, path).collect()) == len(texts)
    q = (read_survey_stream(spark, path).writeStream.format("memory").queryName("csv_texts")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("csv_texts").collect()) == want


def test_short_record_is_padded(spark, tmp_path):
    os.makedirs(tmp_path / "s")
    (tmp_path / "s" / "x.csv").write_text("a,b\n1,2\n3\n")
    assert sorted(map(tuple, spark.read.options(**csv_options()).csv(str(tmp_path / "s")).collect())) == [
        ("1", "2"), ("3", None)]


def test_exact_split_refuses_what_it_cannot_cut(spark):
    same = spark.createDataFrame([(7,)] * 8, "k long")
    with pytest.raises(ValueError, match="not unique"):
        exact_split(same, "k", 0.5)
    nulls = spark.createDataFrame([(1,), (None,), (None,), (None,)], "k long")
    with pytest.raises(ValueError, match="null"):
        exact_split(nulls, "k", 0.75)
    assert exact_split(nulls, "k", 0.25).filter("split = 'test'").count() == 1


def test_prefix_sum_keeps_decimals(spark):
    df = spark.createDataFrame([(1, Decimal("12345678901234567.89")), (2, Decimal("0.01")), (3, None)],
                               "i int, w decimal(20,2)")
    got = [r.cum for r in prefix_sum(df, ["i"], "w").orderBy("i").collect()]
    assert got == [Decimal("12345678901234567.89"), Decimal("12345678901234567.90"), Decimal("12345678901234567.90")]


def test_rewritten_table_is_read_anew(spark, tmp_path):
    spark.range(3).selectExpr("id AS a", "id AS b").write.parquet(str(tmp_path / "t.parquet"))
    assert read_table(spark, str(tmp_path), "t").columns == ["a", "b"]
    spark.range(3).selectExpr("id AS a", "id AS c").write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
    assert read_table(spark, str(tmp_path), "t").columns == ["a", "c"]


def test_quantile_leaves_null_groups_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 5.0), ("b", None)], "g string, v double")
    assert [(r.g, r.quantile, r.n) for r in exact_quantile(df, ["g"], "v").collect()] == [("a", 1.5, 2)]
