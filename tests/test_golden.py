"""Worked values and edge rows (FIXTURES §D, SURVEY §2.5/§2.7)."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from questa.functions.codebooks import CUPS_CODEBOOK, SPEND_CODEBOOK
from questa.functions.expr import cheaper_label, recode, result_label, safe_sqrt, strict_cast
from questa.operators.cost import fixed_cost_table, multiselect_cost, other_average
from questa.operators.features import MinMax, Standardizer
from questa.operators.joins import complete_cases
from questa.operators.regression import r2_by_group
from questa.sources.survey_csv import read_survey_csv


def _cost(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id string, methods string, cups int")
    out = multiselect_cost(df, "methods", "cups", fixed_cost_table(spark), **kw)
    return {r["id"]: r["brewing_cost"] for r in out.collect()}


def test_other_is_mean_of_the_rest(spark):
    t = {r["method"]: (r["upfront"], r["per_use"]) for r in fixed_cost_table(spark).collect()}
    assert t["Other"][0] == pytest.approx(912.51 / 9)
    assert t["Other"][1] == pytest.approx(10.41275 / 9)
    assert len(t) == 10


def test_other_average_without_others_is_zero(spark):
    dim = spark.createDataFrame([("Other", 5.0)], "k string, v double")
    assert other_average(dim, "k", ["v"]).collect()[0]["v"] == 0.0


@pytest.mark.parametrize("inline", [True, False])
def test_brewing_cost_worked_values(spark, inline):
    rows = [("a", "Espresso, Pour over", 3),
            ("b", "Instant coffee, Coffee extract (e.g. Cometeer)", 2),
            ("c", "Coffee extract (e.g. Cometeer), Instant coffee", 2),
            ("d", "Siphon", 4),
            ("e", "Pour over, ", 1),
            ("f", "Espresso", 0),
            ("g", None, 2)]
    got = _cost(spark, rows, **({} if inline else {"inline_max_rows": 0}))
    assert got["a"] == pytest.approx(289.99 / 365 + 0.4975 * 3)
    assert got["a"] == pytest.approx(2.286993, abs=1e-6)
    assert got["b"] == pytest.approx(0.152)
    assert got["c"] == pytest.approx(11.295)
    assert got["d"] == 0.0
    assert got["e"] == pytest.approx(48.84 / 365 + 1.30875)
    assert got["f"] == pytest.approx(289.99 / 365)
    assert got["g"] == 0.0


def test_decision_tie_goes_home(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (1.0, 2.0)], "o double, b double")
    rows = df.select(result_label("o", "b").alias("r"), cheaper_label("o", "b").alias("c")).collect()
    assert [(r.r, r.c) for r in rows] == [
        ("inside", "Brewing at Home is Cheaper"),
        ("outside", "Brewing at Home is Cheaper"),
        ("inside", "Buying Outside is Cheaper")]


def test_recode_and_strict_cast(spark):
    df = spark.createDataFrame([("Less than 1",), ("More than 4",), ("3",), (None,)], "c string")
    got = [r[0] for r in df.select(strict_cast(recode("c", CUPS_CODEBOOK), "int")).collect()]
    assert got == [0, 5, 3, None]


@pytest.mark.parametrize("value", ["about $5", "2.0"])
def test_strict_cast_fails_loudly(spark, value):
    df = spark.createDataFrame([(value,)], "c string")
    with pytest.raises(PySparkException, match="cannot cast"):
        df.select(strict_cast(recode("c", SPEND_CODEBOOK), "int", name="spend")).collect()


def test_lenient_and_error_recodes(spark):
    df = spark.createDataFrame([("about $5",)], "c string")
    assert df.select(strict_cast(recode("c", SPEND_CODEBOOK), "int", on_error="null")).first()[0] is None
    assert df.select(recode("c", SPEND_CODEBOOK, unmatched="null")).first()[0] is None
    with pytest.raises(PySparkException, match="unknown label"):
        df.select(recode("c", SPEND_CODEBOOK, unmatched="error")).collect()


def test_recode_refuses_order_dependent_chain():
    with pytest.raises(ValueError):
        recode("c", {"a": "b", "b": "c"})


def test_complete_cases_drop_nulls_and_refuse_duplicates(spark):
    df = spark.createDataFrame([("1", "x", "y"), ("2", None, "y"), ("3", "x", None)],
                               "id string, a string, b string")
    assert [r.id for r in complete_cases(df, "id", ["a", "b"]).collect()] == ["1"]
    dup = spark.createDataFrame([("1", "x"), ("1", "z")], "id string, a string")
    with pytest.raises(ValueError, match="not unique"):
        complete_cases(dup, "id", ["a"])


def test_survey_csv_na_tokens_quotes_and_newlines(spark, tmp_path):
    p = tmp_path / "survey.csv"
    p.write_text('Submission ID,"Q, with comma",Other\n'
                 'r1,NA,"x ""y""\nz"\n'
                 'r2,None,plain\n'
                 'r3,n/a,\n'
                 'r4,ok,"a,b"\n')
    df = read_survey_csv(spark, str(p), {"id": "Submission ID", "q": "Q, with comma",
                                         "o": "Other"})
    rows = {r.id: (r.q, r.o) for r in df.collect()}
    assert rows == {"r1": (None, 'x "y"\nz'), "r2": (None, "plain"), "r3": (None, None),
                    "r4": ("ok", "a,b")}


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    mm = MinMax.fit(df, "x")
    st = Standardizer.fit(df, ["x"])
    rows = df.select(mm.expr("x").alias("m"), st.expr("x").alias("s")).collect()
    assert all(r.m == 0.0 and r.s == 0.0 for r in rows)


def test_negative_r2_gives_null_r(spark):
    df = spark.createDataFrame([("v", 1.0, 3.0), ("v", 2.0, -3.0), ("v", 3.0, 9.0)],
                               "g string, y double, p double")
    row = r2_by_group(df, "y", "p", "g").first()
    assert row.r2 < 0 and row.r is None
    assert df.select(safe_sqrt(F.lit(-1.0))).first()[0] is None
    assert df.select(safe_sqrt(F.lit(4.0))).first()[0] == 2.0
    assert not math.isnan(row.r2)


def test_mlp_factory_trains(spark):
    """The 16-8 perceptron (constructed but never trained by the original)
    is available as an MLlib estimator."""
    from pyspark.ml.feature import VectorAssembler
    from questa.operators.classify import mlp_classifier
    rows = [(float(i % 7), float(i % 5), float(i % 7 > i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = mlp_classifier(2).setMaxIter(50).fit(df)
    assert model.transform(df).select("prediction").count() == 200


def test_generic_lookup_argmax_and_null_guard(spark):
    from questa.functions.expr import (first_argmax, literal_map, lookup, null_guard,
                                       split_multiselect)
    m = literal_map({"a": 1.0, "b": 3.0, "c": 3.0})
    df = spark.createDataFrame([("a, b, c",), ("c, b",), ("z",), (None,)], "s string")
    rows = df.select(first_argmax(split_multiselect("s"), m).alias("best"),
                     lookup(F.lit("z"), m, 7.0).alias("miss"),
                     null_guard("s", F.lit(1.0)).alias("g")).collect()
    assert [r.best for r in rows] == ["b", "c", "z", None]
    assert all(r.miss == 7.0 for r in rows)
    assert [r.g for r in rows] == [1.0, 1.0, 1.0, 0.0]


def test_survey_reader_names_missing_questions(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("Submission ID,Other\nr1,x\n")
    with pytest.raises(ValueError, match="lacks questions"):
        read_survey_csv(spark, str(p))


def test_join_answers_equals_complete_cases(spark):
    from questa.operators.joins import join_answers
    df = spark.createDataFrame([("1", "x", "y"), ("2", None, "y"), ("3", "x", None), ("4", "u", "v")],
                               "id string, a string, b string")
    joined = join_answers([df.select("id", "a"), df.select("id", "b")], "id")
    assert sorted(joined.collect()) == sorted(complete_cases(df, "id", ["a", "b"]).collect())


def test_constant_cost_map_equals_spark_other_average(spark):
    from questa.operators.cost import fill_other
    from questa.functions.codebooks import METHOD_PER_USE_COST, METHOD_UPFRONT_COST
    table = {r.method: (r.upfront, r.per_use) for r in fixed_cost_table(spark).collect()}
    up, pu = fill_other(METHOD_UPFRONT_COST), fill_other(METHOD_PER_USE_COST)
    for k, (u, p) in table.items():
        assert u == pytest.approx(up[k], rel=1e-12) and p == pytest.approx(pu[k], rel=1e-12)


def test_survey_reader_ignores_byte_order_mark(spark, tmp_path):
    p = tmp_path / "bom.csv"
    p.write_bytes("﻿Submission ID,Q\nr1,a\n".encode("utf-8"))
    df = read_survey_csv(spark, str(p), {"id": "Submission ID", "q": "Q"})
    assert [tuple(r) for r in df.collect()] == [("r1", "a")]


def test_positions_follow_file_order(spark, tmp_path):
    """Read with a file-order column, the k-NN positions are the ranks of the
    complete cases in file order (the original's row positions), not ids."""
    from questa.plans import worth
    header = ('"Submission ID","How many cups of coffee do you typically drink per day?",'
              '"In total, much money do you typically spend on coffee in a month?",'
              '"Approximately how much have you spent on coffee equipment in the past 5 years?",'
              '"How do you brew coffee at home?"\n')
    rows = ['z9,2,<$20,$20-$50,Pour over\n', 'a1,1,$20-$40,$50-$100,Espresso\n',
            'm5,,<$20,$20-$50,Pour over\n', 'b2,3,>$100,Less than $20,French press\n']
    p = tmp_path / "s.csv"
    p.write_text(header + "".join(rows))
    survey = read_survey_csv(spark, str(p), row_order_col=worth.FILE_ORDER)
    d = worth.decision_table(survey, key_unique=None, order_col=worth.FILE_ORDER)
    pos = {r.id: r.pos for r in worth.with_positions(d, order=worth.FILE_ORDER).collect()}
    assert pos == {"z9": 1, "a1": 2, "b2": 3}          # m5 is not a complete case
    by_id = {r.id: r.pos for r in worth.with_positions(d).collect()}
    assert by_id == {"a1": 1, "b2": 2, "z9": 3}


@pytest.mark.parametrize("inline_max_rows", [256, 0])
def test_cost_table_with_repeated_option_is_refused(spark, inline_max_rows):
    dim = spark.createDataFrame([("Espresso", 1.0, 1.0), ("Espresso", 2.0, 2.0)],
                                "method string, upfront double, per_use double")
    df = spark.createDataFrame([("1", "Espresso", 1)], "id string, methods string, cups int")
    with pytest.raises(ValueError, match="repeated"):
        multiselect_cost(df, "methods", "cups", dim,
                         inline_max_rows=inline_max_rows).collect()
