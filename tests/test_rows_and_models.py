"""Codebook joins, splits of rows, the perceptron and predicted classes."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from questa.functions.expr import recode
from questa.operators import mlp, order
from questa.operators.classify import predicted_classes, train_and_predict
from questa.operators.order import exact_split_rows
from questa.operators.recode import recode_join


# ------------------------------------------------------------------ recode

def test_recode_join_gives_the_rows_of_the_case_form(spark):
    labels = ["hot"] * 900 + [f"l{i % 40}" for i in range(80)] + ["unknown"] * 60 + [None] * 50 + ["", "x"]
    df = spark.createDataFrame([(i, v, "kept") for i, v in enumerate(labels)], "id long, a string, _r_label string").repartition(4)
    mapping = {"hot": "HOT", "": "empty", **{f"l{i}": f"v{i}" for i in range(0, 40, 2)}}
    codes = spark.createDataFrame([*mapping.items(), (None, "null label")], "label string, value string")
    plain = df.drop("_r_label")
    for unmatched in ("pass", "null"):
        want = Counter(map(tuple, plain.withColumn("a", recode("a", mapping, unmatched)).collect()))
        for max_rows, hot in ((100, 1000), (0, 1000), (0, 50), (0, 7)):
            got = recode_join(plain, "a", codes, unmatched=unmatched, max_rows=max_rows, hot_rows=hot)
            assert got.columns == plain.columns and Counter(map(tuple, got.collect())) == want
    extra = recode_join(plain, "a", codes, out="b", max_rows=0).where("a = 'hot'").select("b").distinct().collect()
    assert [r.b for r in extra] == ["HOT"]
    with pytest.raises(Exception, match="unknown label for a"):
        recode_join(plain, "a", codes, unmatched="error").collect()
    with pytest.raises(ValueError, match="not unique"):
        recode_join(plain, "a", codes.union(codes))


def test_recode_join_spreads_a_hot_label(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("a"))
    codes = spark.createDataFrame([("hot", "HOT")], "label string, value string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = recode_join(df, "a", codes, max_rows=0, hot_rows=1000).withColumn("p", F.spark_partition_id())
        most = out.groupBy("p").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert most < 9000 and out.filter("a = 'HOT'").count() == 18_000


# ------------------------------------------------------------------- split

@pytest.mark.parametrize("rows", [
    [(1, "a")] * 8, [(None, None)] * 8, [(i, None) for i in range(25)], [(1, "a")] * 5 + [(1, "b")] * 5 + [(2, None)] * 7 + [(None, "")],
    [(i % 3, str(i)) for i in range(50)], [(7, "x")], []])
def test_split_of_rows_has_the_exact_size(spark, rows):
    df = spark.createDataFrame(rows, "k long, v string").repartition(3)
    for share in (0.0, 0.2, 0.5, 1.0):
        got = exact_split_rows(df, "k", share).collect()
        assert sum(r.split == "test" for r in got) == math.ceil(share * len(rows))
        assert Counter((r.k, r.v) for r in got) == Counter(rows)
        again = exact_split_rows(df.repartition(1), "k", share).collect()
        assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_split_of_rows_keeps_keys_together_but_at_the_cut(spark):
    df = spark.createDataFrame([(i % 10, i) for i in range(200)], "k long, v long")
    got = exact_split_rows(df, "k", 0.33).collect()
    sides = {k: {r.split for r in got if r.k == k} for k in range(10)}
    assert sum(len(s) == 2 for s in sides.values()) <= 1


@pytest.mark.parametrize("most", [3, 65_536])
def test_split_of_rows_takes_the_smallest_hashes(spark, monkeypatch, most):
    monkeypatch.setattr(order._cut_rows, "__defaults__", (most,))
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, None]), rng.choice("abc") + str(rng.randrange(40))) for _ in range(150)]
    rows += [(i, None) for i in range(10, 40)] + [(1, "a0")] * 20
    md5 = lambda text: hashlib.md5(f"42:{text}".encode()).hexdigest()
    said = lambda v: "-" if v is None else f"={v}"
    ranked = sorted(rows, key=lambda r: (md5("" if r[0] is None else r[0]), md5(said(r[0]) + "\x1f" + said(r[1]))))
    df = spark.createDataFrame(rows, "k long, v string").repartition(3)
    for share in (0.02, 0.3, 0.77):
        got = Counter((r.k, r.v) for r in exact_split_rows(df, "k", share).filter("split = 'test'").collect())
        assert got == Counter(ranked[:math.ceil(share * len(rows))])


def test_split_of_rows_takes_no_more_passes_for_keys_of_many_rows(spark):
    df = spark.range(2_200_000).select((F.col("id") % 2).alias("k"), "id")
    sc = spark.sparkContext
    sc.setJobGroup("split-passes", "")
    try:
        exact_split_rows(df, "k", 0.2)
        jobs = sc.statusTracker().getJobIdsForGroup("split-passes")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) <= 9


# -------------------------------------------------------------- perceptron

def numpy_steps(x, y, model, steps, rate=0.001, alpha=0.001):
    w, b = [np.array(v) for v in model.weights], [np.array(v) for v in model.biases]
    m, v, losses = [np.zeros_like(a) for a in w + b], [np.zeros_like(a) for a in w + b], []
    for t in range(1, steps + 1):
        acts = [x]
        for i in range(len(w)):
            z = acts[-1] @ w[i] + b[i]
            acts.append(np.maximum(z, 0) if i < len(w) - 1 else 1 / (1 + np.exp(-z)))
        p = acts[-1][:, 0]
        losses.append(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) + alpha * sum((a ** 2).sum() for a in w) / (2 * len(x)))
        d, gw, gb = (p - y)[:, None], [None] * len(w), [None] * len(w)
        for i in reversed(range(len(w))):
            gw[i], gb[i] = (acts[i].T @ d + alpha * w[i]) / len(x), d.mean(axis=0)
            d = (d @ w[i].T) * (acts[i] > 0)
        for i, (a, g) in enumerate(zip(w + b, gw + gb)):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            a -= rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * m[i] / (np.sqrt(v[i]) + 1e-8)
    return w, b, losses


def test_three_training_steps_match_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 2))
    y = (x[:, 0] > x[:, 1] * 0.5).astype(float)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)] + [(None, 1.0, 1), (1.0, 1.0, None)],
                               "f double, g double, label int")
    start = mlp.Perceptron.start(2)
    assert [len(b) for b in start.biases] == [16, 8, 1] and start == mlp.Perceptron.start(2)
    model, losses = mlp.fit(df, ["f", "g"], steps=3, rate=0.01, start=start)
    w, b, want = numpy_steps(x, y, start, 3, rate=0.01)
    assert losses == pytest.approx(want, rel=1e-9)
    for a, c in zip(model.weights + model.biases, w + b):
        assert np.allclose(a, c, rtol=1e-7, atol=1e-10)
    scores = [r.score for r in mlp.score(df.limit(150), model, ["f", "g"]).collect()]
    z = np.maximum(np.maximum(x @ w[0] + b[0], 0) @ w[1] + b[1], 0) @ w[2] + b[2]
    assert sorted(scores) == pytest.approx(sorted((1 / (1 + np.exp(-z[:, 0]))).tolist()), rel=1e-6)
    with pytest.raises(ValueError, match="no complete"):
        mlp.fit(df.limit(0), ["f", "g"], steps=1)


# ----------------------------------------------------------------- classes

def test_predicted_classes_follow_the_margin(spark):
    rows = [(i, float(i % 10), float(i % 7), int(i % 10 > i % 7), "test" if i % 4 == 0 else "train") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int, split string")
    got = predicted_classes(train_and_predict(df, ["a", "b"], carry=("id",)), "id").collect()
    assert sorted(r.id for r in got) == [i for i in range(200) if i % 4 == 0]
    assert all(r.predicted == (r.margin > 0) and r.label == rows[r.id][3] for r in got)
    assert sum(r.predicted == r.label for r in got) >= 45


# ------------------------------------------------------------ row functions

def test_row_function_types_nulls_and_errors(spark):
    from questa.operators.row_function import apply_rows
    df = spark.createDataFrame([(1, 4.0, "a"), (2, None, None), (3, 0.0, "c")], "id long, v double, s string").repartition(2)

    def fn(row, factor):
        return (None if row["v"] is None else factor / row["v"], [row["s"]] * 2)
    got = {r.id: tuple(r) for r in apply_rows(df, fn, ["v", "s"], "q double, l array<string>", {"factor": 2}, "null").collect()}
    assert got[1] == (1, 4.0, "a", 0.5, ["a", "a"], None) and got[2] == (2, None, None, None, [None, None], None)
    assert got[3][3:5] == (None, None) and got[3][5].startswith("ZeroDivisionError")
    with pytest.raises(Exception, match="failed for id = 3: ZeroDivisionError"):
        apply_rows(df, fn, ["v", "s"], "q double, l array<string>", {"factor": 2}, key="id").collect()
    with pytest.raises(Exception, match="the function failed for"):
        apply_rows(df, lambda row: "text", ["v"], "q double").collect()
    with pytest.raises(ValueError, match="exist already"):
        apply_rows(df, fn, ["v"], "s string")
    many = apply_rows(spark.range(1000), lambda row: row["id"] * 2, ["id"], "d long", batch_rows=7)
    assert many.filter("d != id * 2").count() == 0 and many.count() == 1000
    assert apply_rows(df.limit(0), lambda row: 1 / 0, ["v"], "q double").count() == 0


# ---------------------------------------------------------------- overwrite

def test_a_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    import os
    from questa.sources import survey_csv
    path = str(tmp_path / "t")
    survey_csv.write_csv(spark.range(5).select("id"), path)
    bad = spark.range(100, 140, 1, 4).select(F.when(F.col("id") == 139, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        survey_csv.write_csv(bad, path)
    rows = lambda: sorted(int(r.id) for r in survey_csv.read_csv_strings(spark, path).collect())
    assert rows() == [0, 1, 2, 3, 4] and os.listdir(tmp_path) == ["t"]
    os.rename(path, path + ".aside")  # the program ended between the renames
    survey_csv.restore(spark, path)
    assert rows() == [0, 1, 2, 3, 4]
    survey_csv.write_csv(survey_csv.read_csv_strings(spark, path).filter("id > 2"), path)
    assert rows() == [3, 4] and os.listdir(tmp_path) == ["t"]


# ------------------------------------------------------------------- chains

def test_cost_stage_survives_saving(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from questa.operators import stages
    df = spark.createDataFrame([("2", "a, b"), ("Less than 1", "b"), ("3", "z"), ("1", None)], "cups string, methods string")
    chain = Pipeline(stages=[stages.Recode("cups", "n", {"Less than 1": "0"}),
                             stages.MultiselectCost("methods", "n", "cost", {"a": [365.0, 1.0], "b": [730.0, 0.5]})]).fit(df)
    chain.save(str(tmp_path / "chain"))
    loaded = PipelineModel.load(str(tmp_path / "chain"))
    want = [(2, 3.0), (0, 2.0), (3, 0.0), (1, 0.0)]
    assert [(r.n, r.cost) for r in loaded.transform(df).collect()] == want == [(r.n, r.cost) for r in chain.transform(df).collect()]
    with pytest.raises(ValueError, match="no value"):
        stages.MinMaxPoly2("n", ["t", "t2"]).fit(loaded.transform(df).limit(0))
