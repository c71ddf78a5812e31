"""Numeric cross-checks against numpy brute force and published examples."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from questa.functions.special import rank_sum_tail_closed
from questa.operators.knn import knn_regress_1d, knn_sorted
from questa.operators.quantile import exact_quantile
from questa.operators.regression import fit_ridge_poly2
from questa.operators.stattests import levene, mannwhitney, mannwhitney_stat, normaltest


def _frame(spark, groups):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    return spark.createDataFrame(rows, "g string, v double")


def test_ridge_matches_numpy_solve(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 5, 300)
    y = 1 + 0.5 * x - 0.2 * x ** 2 + rng.normal(0, 0.3, 300)
    x[::17] = np.nan
    df = spark.createDataFrame([(None if np.isnan(a) else float(a), float(b)) for a, b in zip(x, y)],
                               "x double, y double")
    m = fit_ridge_poly2(df, "x", "y", alpha=1.0)
    xi = np.where(np.isnan(x), np.nanmean(x), x)
    t = (xi - xi.min()) / (xi.max() - xi.min())
    Z = np.column_stack([t, t * t])
    Zc, yc = Z - Z.mean(0), y - y.mean()
    w = np.linalg.solve(Zc.T @ Zc + np.eye(2), Zc.T @ yc)
    b0 = y.mean() - Z.mean(0) @ w
    assert m.coef[1] == pytest.approx(w[0], rel=1e-9)
    assert m.coef[2] == pytest.approx(w[1], rel=1e-9)
    assert m.intercept == pytest.approx(b0, rel=1e-9)


def _knn_brute(tx, ty, tid, qx, k):
    out = []
    for q in qx:
        order = sorted(range(len(tx)), key=lambda i: (abs(tx[i] - q), tx[i], tid[i]))[:k]
        out.append(np.mean([ty[i] for i in order]))
    return out


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_knn_matches_brute_force_with_ties(spark, partitions):
    rng = np.random.default_rng(3)
    n = 400
    x = rng.integers(0, 40, n).astype(float)          # heavy duplicate x values
    y = rng.normal(0, 1, n)
    ids = np.arange(n)
    train = ids[rng.random(n) < 0.6]
    df = spark.createDataFrame([(int(i), float(a), float(b)) for i, a, b in zip(ids, x, y)],
                               "id long, x double, y double")
    tr = df.filter(F.col("id").isin([int(i) for i in train]))
    got = {r.id: r.pred for r in knn_regress_1d(tr, df, "x", "y", "id", k=5,
                                                 partitions=partitions).collect()}
    want = _knn_brute(x[train], y[train], train, x, 5)
    for i, w in zip(ids, want):
        assert got[int(i)] == pytest.approx(w, abs=1e-12)


def test_exact_quantile_matches_numpy(spark):
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(0, 1, 1001), "b": rng.integers(0, 5, 800), "c": [7.0]}
    df = _frame(spark, groups)
    got = {r.g: r.quantile for r in exact_quantile(df, ["g"], "v", 0.5).collect()}
    for g, vs in groups.items():
        assert got[g] == pytest.approx(float(np.median(vs)), abs=1e-12)
    got = exact_quantile(df, [], "v", 0.3).first()["quantile"]
    allv = np.concatenate([np.asarray(v, dtype=float) for v in groups.values()])
    assert got == pytest.approx(float(np.quantile(allv, 0.3)), abs=1e-12)


def test_normaltest_published_examples(spark):
    df = _frame(spark, {"a": range(1, 9), "b": [2, 8, 0, 4, 1, 9, 9, 0],
                        "c": [1, 2, 3, 4, 5, 6, 7, 8000], "d": range(0, 20), "e": range(5)})
    got = {r.g: r for r in normaltest(df, "v", ["g"]).collect()}
    assert got["a"].skew_z == pytest.approx(1.0108049, abs=1e-6)
    assert got["b"].skew_z == pytest.approx(0.4462639, abs=1e-6)
    assert got["c"].skew_z == pytest.approx(3.5717735, abs=1e-6)
    assert got["d"].kurt_z == pytest.approx(-1.7058104, abs=1e-6)
    assert got["e"].pvalue is None          # fewer than 8 observations
    k2 = got["d"].skew_z ** 2 + got["d"].kurt_z ** 2
    assert got["d"].pvalue == pytest.approx(np.exp(-k2 / 2))


def test_levene_published_example(spark):
    df = _frame(spark, {
        "a": [8.88, 9.12, 9.04, 8.98, 9.00, 9.08, 9.01, 8.85, 9.06, 8.99],
        "b": [8.88, 8.95, 9.29, 9.44, 9.15, 9.58, 8.36, 9.18, 8.67, 9.05],
        "c": [8.95, 9.12, 8.95, 8.85, 9.03, 8.84, 9.07, 8.98, 8.86, 8.98]})
    row = levene(df, "v", "g").first()
    assert row.w == pytest.approx(7.584953, abs=1e-6)
    assert row.pvalue == pytest.approx(0.0024315, abs=1e-7)


def test_mannwhitney_published_example(spark):
    df = _frame(spark, {"x": [19, 22, 16, 29, 24], "y": [20, 11, 17, 12]})
    row = mannwhitney(df, "v", "g", "x", "y").first()
    assert row.u1 == 17 and row.u == 17
    assert row.pvalue == pytest.approx(1 / 9, abs=1e-12)   # exact: no ties, small samples
    assert row.exact_case


def test_mannwhitney_stays_exact_beside_a_large_sample(spark):
    def plain(m, n, u):  # arrangements by U: those with and those without the largest value in the small sample
        ways = {0: np.array([1] + [0] * (m * n), object)}
        for i in range(1, m + 1):  # Gaussian binomial, factor by factor
            c = ways[0].copy()
            c[n + i:] -= ways[0][:len(c) - n - i] if n + i < len(c) else 0
            for j in range(i, len(c)):
                c[j] += c[j - i]
            ways[0] = c
        return sum(ways[0][u:]) / math.comb(m + n, m)

    for m, n in ((1, 5), (2, 9), (3, 3), (5, 7), (8, 8), (8, 40), (7, 300)):
        for u in {0, 1, m * n // 2, m * n * 2 // 3, m * n - 1, m * n}:
            assert rank_sum_tail_closed(m, n, u) == pytest.approx(plain(m, n, u), rel=1e-14)
    assert rank_sum_tail_closed(8, 10 ** 9, 8 * 10 ** 9) == pytest.approx(math.factorial(8) / 1e72, rel=1e-6)
    for n in (10_000, 10_001):
        df = spark.range(n).selectExpr("'a' AS g", "CAST(id AS double) AS v").union(
            spark.range(1).selectExpr("'b' AS g", "1e9 AS v"))
        row = mannwhitney(df, "v", "g", "a", "b").first()
        assert row.exact_case and row.pvalue == pytest.approx(2 / (n + 1), rel=1e-12)


def test_mannwhitney_u_matches_pairwise_count_with_ties(spark):
    rng = np.random.default_rng(9)
    a = rng.integers(0, 12, 300).astype(float)
    b = rng.integers(3, 15, 250).astype(float)
    df = _frame(spark, {"a": a, "b": b})
    row = mannwhitney_stat(df, "v", "g", "a", "b", partitions=4).first()
    u1 = sum((ai > bj) + 0.5 * (ai == bj) for ai in a for bj in b)
    assert row.u1 == pytest.approx(u1)
    _, t = np.unique(np.concatenate([a, b]), return_counts=True)
    assert row.tie_term == pytest.approx(float(np.sum(t ** 3 - t)))
    assert not row.exact_case


def test_exact_quantile_with_hot_median_value(spark):
    vals = [5.0] * 3000 + [float(i) for i in range(6000)]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    got = exact_quantile(df, ["g"], "v", 0.5).first()["quantile"]
    assert got == float(np.median(vals))
    got = exact_quantile(df, ["g"], "v", 0.37).first()["quantile"]
    assert got == pytest.approx(float(np.quantile(vals, 0.37)), abs=1e-12)


def test_logistic_matches_newton(spark):
    """MLlib logistic regression (standardization off) minimises mean
    log-loss + reg/2 * |w|^2; compare with a numpy Newton solve."""
    from questa.operators.classify import logistic_pipeline
    rng = np.random.default_rng(21)
    n = 400
    X = np.column_stack([rng.normal(0, 1, n), rng.normal(0, 3, n)])
    p = 1 / (1 + np.exp(-(0.8 * X[:, 0] - 0.3 * X[:, 1] + 0.2)))
    y = (rng.random(n) < p).astype(float)
    lam = 0.3
    w = np.zeros(3)                        # intercept, w1, w2
    A = np.column_stack([np.ones(n), X])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-A @ w))
        grad = A.T @ (mu - y) / n + lam * np.r_[0, w[1:]]
        H = (A.T * (mu * (1 - mu))) @ A / n + lam * np.diag([0, 1, 1])
        w -= np.linalg.solve(H, grad)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(X, y)],
                               "a double, b double, label double")
    lr = logistic_pipeline(["a", "b"], "label", reg=lam, tol=1e-10).fit(df).stages[-1]
    assert lr.intercept == pytest.approx(w[0], abs=1e-5)
    assert list(lr.coefficients) == pytest.approx(list(w[1:]), abs=1e-5)


def test_degenerate_tests_give_null_not_errors(spark):
    one = _frame(spark, {"a": range(10)})
    assert levene(one, "v", "g").first().w is None
    row = mannwhitney(one, "v", "g", "a", "b").first()
    assert row.z is None and row.pvalue is None
    tied = _frame(spark, {"a": [1.0] * 5, "b": [1.0] * 5})
    assert levene(tied, "v", "g").first().w is None
    assert mannwhitney(tied, "v", "g", "a", "b").first().z is None


def test_knn_null_feature_and_target(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (2, 2.0, None), (3, 3.0, 30.0), (4, None, 40.0),
                                (5, 4.0, 50.0)], "id long, x double, y double")
    got = {r.id: r.pred for r in knn_regress_1d(df, df, "x", "y", "id", k=2).collect()}
    assert got[4] is None                      # no feature, no prediction
    assert got[1] == pytest.approx(20.0)       # neighbours 1 and 3 (2 has no target)
    assert got[5] == pytest.approx(40.0)


@pytest.mark.parametrize("hot", [0.0, 0.5, 0.9])
@pytest.mark.parametrize("train_share", [0.7, 0.02])
def test_knn_with_a_hot_value(spark, hot, train_share):
    rng = np.random.default_rng(8)
    n = 300
    x = np.where(rng.random(n) < hot, 150.0, rng.permutation(n).astype(float))
    y = rng.normal(0, 1, n)
    train = np.arange(n)[rng.random(n) < train_share]
    df = spark.createDataFrame([(int(i), float(a), float(b)) for i, a, b in zip(range(n), x, y)],
                               "id long, x double, y double").repartition(5)
    tr = df.filter(F.col("id").isin([int(i) for i in train]))
    got = {r.id: r.pred for r in knn_regress_1d(tr, df, "x", "y", "id", k=5, partitions=9).collect()}
    want = _knn_brute(x[train], y[train], train, x, 5)
    for i, w in zip(range(n), want):
        assert got[i] == pytest.approx(w, abs=1e-12)


def test_knn_refuses_rows_out_of_order(spark):
    df = spark.createDataFrame([(3.0, 1.0), (1.0, 2.0)], "x double, y double").coalesce(1)
    with pytest.raises(Exception, match="not sorted"):
        knn_sorted(df, "x", [("y", F.lit(True), "pred")], 1)
