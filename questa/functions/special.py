"""Special functions for p-values, as JVM column expressions.

Spark has no ``erfc``, log-gamma or incomplete beta.  Here they are sums and
continued fractions written with ``aggregate`` over ``sequence``, so that a plan
that turns statistics into p-values runs no Python.  Every input is a double
column; a null input gives null.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY = 1e-300
_HALF_LOG_2PI = 0.5 * math.log(2 * math.pi)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _series(z: Column) -> Column:
    """Stirling's correction 1/(12z) - 1/(360z^3) + ... for z of 8 or more."""
    w = 1 / (z * z)
    return (F.lit(1 / 12) - w * (F.lit(1 / 360) - w * (F.lit(1 / 1260) - w * (
        F.lit(1 / 1680) - w * F.lit(1 / 1188))))) / z


def _base(z: Column) -> Column:
    return (z - 0.5) * F.log(z) - z + _HALF_LOG_2PI


def stirling_gap(z: Column) -> Column:
    """lgamma(z) less its leading Stirling terms, for z > 0, without
    cancellation for large z."""
    product = z
    for i in range(1, 8):
        product = product * (z + i)
    small = _base(z + 8) + _series(z + 8) - F.log(product) - _base(z)
    return F.when(z >= 8, _series(z)).otherwise(small)


def log_gamma(z: Column) -> Column:
    """ln Gamma(z) for z > 0."""
    z = z.cast("double")
    return _base(z) + stirling_gap(z)


def _log_front(a: Column, b: Column, x: Column, y: Column) -> Column:
    """ln(x^a y^b / B(a, b)), y = 1 - x: near the mode it is a small
    difference of large terms, so each is taken relative to the mode."""
    s = a + b
    return (a * F.log1p((b * x - a * y) / a) + b * F.log1p((a * y - b * x) / b)
            + 0.5 * F.log(a / s * b / (2 * math.pi)) + stirling_gap(s) - stirling_gap(a) - stirling_gap(b))


def _away(v: Column) -> Column:
    return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta (modified Lentz).  Its
    length grows with sqrt(max(a, b)); fails if that was not enough."""
    steps = (F.lit(200) + F.ceil(8 * F.sqrt(F.greatest(a, b)))).cast("int")
    d0 = 1 / _away(1 - (a + b) * x / (a + 1))
    state = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"), F.lit(False).alias("done"))

    def step(s: Column, m: Column) -> Column:
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))

        def half(s: Column, n: Column) -> Column:
            return _let(F.struct(_away(1 + n / s["c"]).alias("c"), (1 / _away(1 + n * s["d"])).alias("d")),
                        lambda t: F.struct(t["c"], t["d"], (s["h"] * t["c"] * t["d"]).alias("h"),
                                           (F.abs(t["c"] * t["d"] - 1) < 1e-15).alias("done")))
        return F.when(s["done"], s).otherwise(_let(half(s, even), lambda t: half(t, odd)))

    return F.aggregate(F.sequence(F.lit(1), steps), state, step, lambda s: F.when(s["done"], s["h"]).otherwise(
        F.raise_error(F.lit("the incomplete beta did not converge")).cast("double")))


def beta_inc(a: Column, b: Column, x: Column, y: Column | None = None) -> Column:
    """Regularised incomplete beta I_x(a, b) for a, b > 0.  ``y`` is 1 - x;
    pass it where x is close to 1 and the difference would lose digits."""
    a, b, x = a.cast("double"), b.cast("double"), x.cast("double")
    y = 1 - x if y is None else y.cast("double")
    args = F.struct(a.alias("a"), b.alias("b"), x.alias("x"), y.alias("y"))

    def body(v: Column) -> Column:
        direct = F.exp(_log_front(v["a"], v["b"], v["x"], v["y"])) * _fraction(v["a"], v["b"], v["x"]) / v["a"]
        mirror = F.exp(_log_front(v["b"], v["a"], v["y"], v["x"])) * _fraction(v["b"], v["a"], v["y"]) / v["b"]
        return (F.when(v["x"].isNull() | v["a"].isNull() | v["b"].isNull(), F.lit(None).cast("double"))
                .when((v["a"] <= 0) | (v["b"] <= 0) | F.isnan(v["x"]), F.lit(float("nan")))
                .when(v["x"] <= 0, F.lit(0.0)).when(v["y"] <= 0, F.lit(1.0))
                .when(v["x"] <= (v["a"] + 1) / (v["a"] + v["b"] + 2), direct).otherwise(1 - mirror))
    return _let(args, body)


def f_sf(w: Column, d1: Column, d2: Column) -> Column:
    """P(F(d1, d2) > w)."""
    w, d1, d2 = w.cast("double"), d1.cast("double"), d2.cast("double")
    total = d2 + d1 * w
    return (F.when(w.isNull() | d1.isNull() | d2.isNull(), F.lit(None).cast("double"))
            .when(w <= 0, F.lit(1.0))
            .otherwise(beta_inc(d2 / 2, d1 / 2, d2 / total, d1 * w / total)))


def erfc(t: Column) -> Column:
    """Complementary error function: its series near 0, a continued fraction
    (evaluated from the end) further out."""
    u = F.abs(t.cast("double"))

    def near(u: Column) -> Column:
        total = F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.struct(u.alias("term"), u.alias("sum")),
                            lambda s, n: _let(s["term"] * 2 * u * u / (2 * n + 1),
                                              lambda q: F.struct(q.alias("term"), (s["sum"] + q).alias("sum"))),
                            lambda s: s["sum"])
        return 1 - F.lit(2 / math.sqrt(math.pi)) * F.exp(-u * u) * total

    def far(u: Column) -> Column:
        tail = F.aggregate(F.sequence(F.lit(120), F.lit(1)), u, lambda s, n: u + n / 2.0 / s)
        return F.exp(-u * u) / math.sqrt(math.pi) / tail

    whole = _let(u, lambda u: F.when(u.isNull(), F.lit(None).cast("double")).when(u < 2, near(u)).otherwise(far(u)))
    return F.when(t < 0, 2 - whole).otherwise(whole)


def two_sided_normal_p(z: Column) -> Column:
    """min(1, erfc(z / sqrt 2)): twice the upper tail, so 1 for a negative z
    (as a continuity correction can make it)."""
    return F.when(z.isNotNull(), F.least(F.lit(1.0), erfc(z / math.sqrt(2.0))))


#: Exact rank-sum tails are counted in the JVM up to this many values of U, and
#: by :func:`rank_sum_tail_closed` beyond.
EXACT_U_MAX = 10_000


def rank_sum_tail(m: Column, n: Column, u: Column) -> Column:
    """P(U >= u) for samples of ``m`` and ``n`` values without ties, by
    counting: the number of arrangements with a given U is a coefficient of
    prod (1 - q^(n+i)) / (1 - q^i), i = 1..m.  ``m`` should be the smaller."""
    n, top = n.cast("int"), (m * n - u).cast("int")
    start = F.transform(F.sequence(F.lit(0), top), lambda j: F.when(j == 0, 1.0).otherwise(0.0))

    def factor(c: Column, i: Column) -> Column:
        less = F.transform(c, lambda x, j: x - F.when(j >= n + i, F.get(c, j - n - i)).otherwise(0.0))
        return _let(less, lambda d: F.transform(d, lambda x, j: F.aggregate(
            F.sequence(j % i, j, i), F.lit(0.0), lambda s, k: s + F.get(d, k))))

    count = F.aggregate(F.aggregate(F.sequence(F.lit(1), m.cast("int")), start, factor),
                        F.lit(0.0), lambda s, x: s + x)
    ways = F.aggregate(F.sequence(F.lit(1), m.cast("int")), F.lit(1.0), lambda s, i: s * (n + i) / i)
    return F.when(top < 0, F.lit(0.0)).otherwise(count / ways)


def rank_sum_tail_closed(m: int, n: int, u: int) -> float:
    """:func:`rank_sum_tail` in exact integers, with work that depends on ``m``
    (at most 8) only.  The arrangements with at most t = m n - u pairs are the
    coefficient of q^t in prod (1 - q^(n+i)) / ((1 - q) prod (1 - q^i)); with
    all factors below brought to 1 - q^period, it is a sum of binomials."""
    top, period = m * n - u, math.lcm(*range(1, m + 1))
    if top < 0:
        return 0.0
    upper = [1]
    for i in (1, *range(1, m + 1)):  # times (1 - q^period) / (1 - q^i)
        old = upper + [0] * (period - i)
        upper = old[:]
        for j in range(i, len(upper)):
            upper[j] += upper[j - i] - (old[j - period] if j >= period else 0)
    shifts = {0: 1}
    for i in range(1, m + 1):
        for at, sign in list(shifts.items()):
            shifts[at + n + i] = shifts.get(at + n + i, 0) - sign
    ways = 0
    for at, sign in shifts.items():
        t = top - at
        if t >= 0:
            ways += sign * sum(upper[j] * math.comb((t - j) // period + m, m)
                               for j in range(t % period, min(t + 1, len(upper)), period))
    return ways / math.comb(m + n, m)
