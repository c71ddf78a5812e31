"""SQL fragments shared by the DuckDB oracle queries (generated from the same
codebooks the Spark side uses, so the two cannot drift apart)."""

from __future__ import annotations

from collections.abc import Mapping

from ..functions.codebooks import (CUPS_CODEBOOK, EQUIP_CODEBOOK, METHOD_PER_USE_COST,
                                   METHOD_UPFRONT_COST, SPEND_CODEBOOK)
from ..sources.tables import SURVEY_SQL_CTE


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_recode(col: str, mapping: Mapping[str, str]) -> str:
    whens = " ".join(f"WHEN {col} = {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {col} END)"


def cups_sql(col: str = "cups", to: str = "INTEGER") -> str:
    return f"CAST({case_recode(col, CUPS_CODEBOOK)} AS {to})"


def spend_sql(col: str = "spend") -> str:
    return f"(CAST(CAST({case_recode(col, SPEND_CODEBOOK)} AS INTEGER) AS DOUBLE) / 30)"


def equip_sql(col: str = "equip") -> str:
    return f"CAST({case_recode(col, EQUIP_CODEBOOK)} AS INTEGER)"


def cost_values_sql() -> str:
    """(method, upfront, per_use) with Other = mean of the others."""
    keys = [k for k in METHOD_UPFRONT_COST if k != "Other"]
    rows = ", ".join(f"({q(k)}, CAST({float(METHOD_UPFRONT_COST[k])!r} AS DOUBLE), "
                     f"CAST({float(METHOD_PER_USE_COST.get(k, 0))!r} AS DOUBLE))" for k in keys)
    return f"""
cost_base(method, upfront, per_use) AS (VALUES {rows}),
cost_table AS (
  SELECT method, upfront, per_use FROM cost_base
  UNION ALL SELECT 'Other', coalesce(avg(upfront), 0), coalesce(avg(per_use), 0) FROM cost_base)"""


WITH_SURVEY = "WITH " + SURVEY_SQL_CTE

# worth: complete cases, recodes and the brewing cost of the dearest method
WORTH_CTE = SURVEY_SQL_CTE + "," + cost_values_sql() + f""",
worth_base AS (
  SELECT id, methods, {cups_sql()} AS cup_assumptions, {spend_sql()} AS spent_assumptions,
         {equip_sql()} AS eq_assumptions
  FROM survey
  WHERE id IS NOT NULL AND cups IS NOT NULL AND spend IS NOT NULL AND equip IS NOT NULL
    AND methods IS NOT NULL),
worth_opts AS (
  SELECT id, unnest(string_split(methods, ', ')) AS opt,
         unnest(range(1, len(string_split(methods, ', ')) + 1)) AS pos
  FROM worth_base),
worth_best AS (
  SELECT id, upfront, per_use FROM (
    SELECT o.id, c.upfront, c.per_use,
           row_number() OVER (PARTITION BY o.id ORDER BY coalesce(c.upfront, 0) DESC, o.pos) AS rn
    FROM worth_opts o LEFT JOIN cost_table c ON c.method = o.opt) WHERE rn = 1),
worth AS (
  SELECT w.id, w.methods, w.cup_assumptions, w.spent_assumptions, w.eq_assumptions,
         coalesce(b.upfront, 0) / 365 + coalesce(b.per_use, 0) * w.cup_assumptions AS brewing_cost
  FROM worth_base w JOIN worth_best b ON b.id = w.id),
decision AS (
  SELECT *, CASE WHEN outside_cost > brewing_cost THEN 'outside' ELSE 'inside' END AS result,
         CASE WHEN outside_cost < brewing_cost THEN 'Buying Outside is Cheaper'
              ELSE 'Brewing at Home is Cheaper' END AS cheaper_option,
         CASE WHEN outside_cost > brewing_cost THEN 1 ELSE 0 END AS label
  FROM (SELECT *, cup_assumptions * spent_assumptions AS outside_cost FROM worth))
"""

CORRELATION_CTE = SURVEY_SQL_CTE + f""",
correlation AS (
  SELECT id, {cups_sql(to='DOUBLE')} AS cup_assumptions, {spend_sql()} AS spent_assumptions
  FROM survey WHERE id IS NOT NULL AND cups IS NOT NULL AND spend IS NOT NULL)
"""

# correlation fit: keyed split, imputation, min-max, centred moments, 2x2 ridge solve
CORRELATION_FIT_CTE = CORRELATION_CTE + """,
sp AS (SELECT *, CASE WHEN substr(md5(concat('correlation', id)), 1, 8) < 'c0000000'
                      THEN 'train' ELSE 'valid' END AS split FROM correlation),
tr AS (SELECT * FROM sp WHERE split = 'train' AND cup_assumptions IS NOT NULL),
f1 AS (SELECT avg(spent_assumptions) AS mu FROM tr),
f2 AS (SELECT min(coalesce(spent_assumptions, mu)) AS lo, max(coalesce(spent_assumptions, mu)) AS hi
       FROM tr, f1),
tt AS (SELECT cup_assumptions AS y,
              CASE WHEN hi > lo THEN (coalesce(spent_assumptions, mu) - lo) / (hi - lo)
                   ELSE coalesce(spent_assumptions, mu) - lo END AS t
       FROM tr, f1, f2),
m AS (SELECT count(*) AS n, avg(t) AS mt, avg(t * t) AS mt2, avg(y) AS my, var_pop(t) AS v11,
             var_pop(t * t) AS v22, covar_pop(t, t * t) AS v12, covar_pop(t, y) AS c1,
             covar_pop(t * t, y) AS c2 FROM tt),
s AS (SELECT *, n * v11 + 1.0 AS a11, n * v22 + 1.0 AS a22, n * v12 AS a12, n * c1 AS r1,
             n * c2 AS r2 FROM m),
b AS (SELECT *, (a22 * r1 - a12 * r2) / (a11 * a22 - a12 * a12) AS b1,
             (a11 * r2 - a12 * r1) / (a11 * a22 - a12 * a12) AS b2 FROM s),
model AS (SELECT n, mu, lo, hi, b1, b2, my - b1 * mt - b2 * mt2 AS b0 FROM b, f1, f2),
scored AS (
  SELECT sp.*, CASE WHEN hi > lo THEN (coalesce(spent_assumptions, mu) - lo) / (hi - lo)
                    ELSE coalesce(spent_assumptions, mu) - lo END AS t
  FROM sp, model),
pred AS (SELECT scored.*, b0 + b1 * t + b2 * t * t AS yhat FROM scored, model)
"""

# worth decision with the seeded exact 80/20 split
WORTH_SPLIT_CTE = WORTH_CTE + """,
dsplit AS (
  SELECT *, CASE WHEN rn <= ceil(CAST(0.2 AS DOUBLE) * cnt) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY md5(concat('42:', id)), id) AS rn,
               count(*) OVER () AS cnt FROM decision))
"""


# logistic classifier on the standardised costs by Newton steps (equal training
# rows are counted once); b0 is not penalised
NEWTON_STEPS = 60
CLASSIFIER_CTE = f"""
lg_st AS (SELECT avg(outside_cost) AS mo, stddev_pop(outside_cost) AS so, avg(brewing_cost) AS mb,
                 stddev_pop(brewing_cost) AS sb FROM dsplit WHERE split = 'train'),
lg_z AS (SELECT split, label, (outside_cost - mo) / CASE WHEN so > 0 THEN so ELSE 1 END AS x1,
                (brewing_cost - mb) / CASE WHEN sb > 0 THEN sb ELSE 1 END AS x2 FROM dsplit, lg_st),
lg_pts AS (SELECT x1, x2, label, CAST(count(*) AS DOUBLE) AS c FROM lg_z WHERE split = 'train'
           GROUP BY x1, x2, label),
lg_n AS (SELECT sum(c) AS n, 0.0001::DOUBLE / least(200, sum(c)) AS lam FROM lg_pts),
lg_fit(i, b0, b1, b2) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT i + 1,
         b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - g2 * h12) + h02 * (g1 * h12 - g2 * h11)) / det,
         b1 - (h00 * (g1 * h22 - g2 * h12) - g0 * (h01 * h22 - h02 * h12) + h02 * (h01 * g2 - h02 * g1)) / det,
         b2 - (h00 * (h11 * g2 - h12 * g1) - h01 * (h01 * g2 - h02 * g1) + g0 * (h01 * h12 - h02 * h11)) / det
  FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h02 * h12)
                  + h02 * (h01 * h12 - h02 * h11) AS det FROM (
    SELECT i, b0, b1, b2, sum(e) / n AS g0, sum(e * x1) / n + lam * b1 AS g1, sum(e * x2) / n + lam * b2 AS g2,
           sum(w) / n AS h00, sum(w * x1) / n AS h01, sum(w * x2) / n AS h02, sum(w * x1 * x1) / n + lam AS h11,
           sum(w * x1 * x2) / n AS h12, sum(w * x2 * x2) / n + lam AS h22
    FROM (SELECT f.*, x1, x2, n, lam, c * (p - label) AS e, c * p * (1 - p) AS w
          FROM (SELECT f.*, x1, x2, label, c, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p
                FROM lg_fit f, lg_pts) f, lg_n)
    GROUP BY i, b0, b1, b2, n, lam))
  WHERE i < {NEWTON_STEPS}),
lg_acc AS (SELECT CAST((SELECT n FROM lg_n) AS BIGINT) AS n_train, count(*) AS n_test,
                  avg(CASE WHEN (b0 + b1 * x1 + b2 * x2 > 0) = (label = 1) THEN 1.0 ELSE 0.0 END) AS accuracy
           FROM lg_z, lg_fit WHERE split = 'test' AND i = {NEWTON_STEPS})"""


def knn_r2_sql(name: str, target: str, salt: str, k: int = 5) -> str:
    """CTEs up to ``{name}_r(split, r2)``: k-NN of ``target`` on the row
    position by training ranks, of which a query needs k on each side."""
    return f"""
{name}_d AS (SELECT id, row_number() OVER (ORDER BY id) AS x, {target} AS y,
                    CASE WHEN substr(md5(concat('{salt}', id)), 1, 8) < 'c0000000'
                         THEN 'train' ELSE 'valid' END AS split FROM decision),
{name}_q AS (SELECT *, CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) OVER (ORDER BY x) AS BIGINT) AS upto FROM {name}_d),
{name}_t AS (SELECT x, y, upto AS rank FROM {name}_q WHERE split = 'train'),
{name}_s AS (SELECT id, x, y, split, unnest(range(upto - {k}, upto + {k} + 1)) AS rank FROM {name}_q),
{name}_p AS (SELECT id, any_value(split) AS split, any_value(y) AS y, avg(ty) AS yhat FROM (
               SELECT s.id, s.split, s.y, t.y AS ty,
                      row_number() OVER (PARTITION BY s.id ORDER BY abs(t.x - s.x), t.x) AS rn
               FROM {name}_s s JOIN {name}_t t ON t.rank = s.rank) WHERE rn <= {k} GROUP BY id),
{name}_g AS (SELECT split, sum((y - yhat) * (y - yhat)) AS sse, var_pop(y) * count(*) AS sst
             FROM {name}_p GROUP BY split),
{name}_r AS (SELECT split, CASE WHEN sst > 0 THEN 1 - sse / sst WHEN sse = 0 THEN 1.0 ELSE 0.0 END AS r2
             FROM {name}_g)"""


def normaltest_sql(base: str, group: str) -> str:
    """D'Agostino-Pearson K² per group from a CTE ``base(g, v)``."""
    return f"""
nt_base AS (SELECT g, v FROM {base} WHERE v IS NOT NULL),
nt_mu AS (SELECT g, avg(v) AS m FROM nt_base GROUP BY g),
nt_mom AS (SELECT b.g, count(*) AS n, avg(power(v - m, 2)) AS m2, avg(power(v - m, 3)) AS m3,
                  avg(power(v - m, 4)) AS m4 FROM nt_base b JOIN nt_mu u ON u.g = b.g GROUP BY b.g),
nt_st AS (SELECT g, n, CAST(n AS DOUBLE) AS x, m3 / power(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS ex
          FROM nt_mom),
nt_s1 AS (SELECT *, g1 * sqrt((x + 1) * (x + 3) / (6.0 * (x - 2))) AS y0,
                 3.0 * (x * x + 27 * x - 70) * (x + 1) * (x + 3)
                   / ((x - 2) * (x + 5) * (x + 7) * (x + 9)) AS beta2,
                 ex + 3 AS b2, 3.0 * (x - 1) / (x + 1) AS e,
                 24.0 * x * (x - 2) * (x - 3) / ((x + 1) * (x + 1) * (x + 3) * (x + 5)) AS varb2,
                 6.0 * (x * x - 5 * x + 2) / ((x + 7) * (x + 9))
                   * sqrt(6.0 * (x + 3) * (x + 5) / (x * (x - 2) * (x - 3))) AS sb1
          FROM nt_st),
nt_s2 AS (SELECT *, -1 + sqrt(2 * (beta2 - 1)) AS w2, (b2 - e) / sqrt(varb2) AS kx,
                 6 + 8.0 / sb1 * (2.0 / sb1 + sqrt(1 + 4.0 / (sb1 * sb1))) AS a FROM nt_s1),
nt_s3 AS (SELECT *, 1 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2 / (w2 - 1)) AS alpha,
                 CASE WHEN y0 = 0 THEN 1.0 ELSE y0 END AS yy,
                 1 - 2.0 / (9 * a) AS term1, 1 + kx * sqrt(2.0 / (a - 4)) AS denom FROM nt_s2),
nt_z AS (SELECT g, n,
                CASE WHEN n >= 8 THEN delta * asinh(yy / alpha) END AS skew_z,
                CASE WHEN n >= 8 THEN (term1 - sign(denom) * CASE WHEN denom <> 0
                     THEN cbrt((1 - 2.0 / a) / abs(denom)) END) / sqrt(2.0 / (9 * a)) END AS kurt_z
         FROM nt_s3)
SELECT g AS {group}, n, round(skew_z, 6) AS skew_z, round(kurt_z, 6) AS kurt_z,
       round(skew_z * skew_z + kurt_z * kurt_z, 6) AS k2,
       round(exp(-(skew_z * skew_z + kurt_z * kurt_z) / 2), 6) AS pvalue
FROM nt_z"""


def levene_sql(base: str) -> str:
    return f"""
lv_base AS (SELECT g, v FROM {base} WHERE v IS NOT NULL),
lv_med AS (SELECT g, quantile_cont(v, 0.5) AS md FROM lv_base GROUP BY g),
lv_z AS (SELECT b.g, abs(v - md) AS z FROM lv_base b JOIN lv_med m ON m.g = b.g),
lv_per AS (SELECT g, count(*) AS ni, avg(z) AS zi, var_pop(z) * count(*) AS ssi FROM lv_z GROUP BY g),
lv_tot AS (SELECT count(*) AS k, CAST(sum(ni) AS BIGINT) AS n, sum(ni * zi) AS sz,
                  sum(ni * zi * zi) AS szz, sum(ssi) AS within FROM lv_per)
SELECT k, n, round((CAST(n AS DOUBLE) - k) / (k - 1) * (szz - sz * sz / n) / within, 6) AS w,
       CAST(k - 1 AS DOUBLE) AS df1, CAST(n - k AS DOUBLE) AS df2
FROM lv_tot"""


def _unrounded(sql: str) -> str:
    """A statistic's SQL without its rounding to 6 digits, to compute on."""
    return sql.replace(", 6)", ", 15)")


def simpson(f: str, top: str, steps: int = 4000) -> str:
    """Simpson's rule for the SQL expression ``f`` of ``t`` over 0..``top``."""
    return (f"(SELECT sum(wt * ({f})) * {top} / {steps} / 3 FROM (SELECT i * {top} / {steps} AS t, "
            f"CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS wt "
            f"FROM range({steps + 1}) AS r(i)))")


def levene_p_sql(base: str) -> str:
    """Statistic and p: 1 less the integral of the density of sqrt(F)."""
    density = ("2 * exp(lgamma((df1 + df2) / 2) - lgamma(df1 / 2) - lgamma(df2 / 2) + df1 / 2 * ln(df1 / df2)"
               " - (df1 + df2) / 2 * ln(1 + df1 / df2 * t * t)) * power(t, df1 - 1)")
    return (f"lv_w AS (WITH {_unrounded(levene_sql(base))})\nSELECT k, n, round(w, 6) AS w, df1, df2, round(1 - "
            + simpson(density, "sqrt(w)") + ", 5) AS pvalue FROM lv_w")


def mannwhitney_p_sql(base: str, a: str, b: str) -> str:
    """Statistic and p: twice the upper normal tail, at most 1."""
    area = simpson("exp(-t * t / 2) / sqrt(2 * pi())", "abs(z)")
    return (f"mw_all AS (WITH {_unrounded(mannwhitney_sql(base, a, b))})\nSELECT n1, n2, round(u1, 6) AS u1, round(u, 6) AS u, tie_term, round(z, 6) AS z, exact_case, "
            f"round(least(1, CASE WHEN z < 0 THEN 1 ELSE 1 - 2 * {area} END), 5) AS pvalue FROM mw_all")


def mannwhitney_sql(base: str, a: str, b: str) -> str:
    return f"""
mw_base AS (SELECT g, v FROM {base} WHERE v IS NOT NULL AND g IN ({q(a)}, {q(b)})),
mw_pv AS (SELECT v, sum(CASE WHEN g = {q(a)} THEN 1 ELSE 0 END) AS c1, count(*) AS t
          FROM mw_base GROUP BY v),
mw_cr AS (SELECT *, coalesce(sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 AS cb FROM mw_pv),
mw_s AS (SELECT CAST(sum(c1) AS DOUBLE) AS n1, CAST(sum(t) AS DOUBLE) AS nn,
                CAST(sum(c1 * (2 * cb + t + 1)) AS DOUBLE) AS r1x2,
                CAST(sum(t * t * t - t) AS DOUBLE) AS tie_term, max(t) AS max_t FROM mw_cr),
mw_u AS (SELECT n1, nn - n1 AS n2, r1x2 / 2 - n1 * (n1 + 1) / 2 AS u1, tie_term, nn, max_t FROM mw_s),
mw_z AS (SELECT *, greatest(u1, n1 * n2 - u1) AS u FROM mw_u)
SELECT n1, n2, round(u1, 6) AS u1, round(u, 6) AS u, tie_term,
       round((u - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * ((nn + 1) - tie_term / (nn * (nn - 1)))), 6) AS z,
       (least(n1, n2) <= 8 AND max_t <= 1) AS exact_case
FROM mw_z"""


EVENTS_BASE = "ev_base AS (SELECT event_type AS g, value AS v FROM events)"
WORTH_LONG = """worth_long AS (
  SELECT 'outside_cost' AS g, outside_cost AS v FROM decision
  UNION ALL SELECT 'brewing_cost' AS g, brewing_cost AS v FROM decision)"""

# the worth CTEs without the shared survey CTEs (to combine with another analysis)
WORTH_PARTS = WORTH_CTE[len(SURVEY_SQL_CTE) + 1:]
