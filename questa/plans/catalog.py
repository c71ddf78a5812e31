"""Registered queries: one callable per operator group of the survey
analysis, each with a DuckDB oracle (where SQL can express it).

Every query reads the scale-factor tables (the survey is derived from
``orders``/``lineitem``/``part``) so its work grows with them.  Doubles are
rounded to 6 decimals on both sides: the two engines sum in different
orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mlp, stages
from ..operators.classify import accuracy, predicted_classes
from ..operators.cost import fixed_cost_table, multiselect_cost, other_average
from ..operators.features import MeanImputer, Standardizer, poly2_terms
from ..operators.knn import knn_regress_1d
from ..operators.knn_nd import knn_regress
from ..operators.regression import curve_grid, mllib_ridge_pipeline, r2_by_group
from ..operators.stattests import (levene, levene_stat, long_form, mannwhitney,
                                   mannwhitney_stat, normaltest)
from ..functions.codebooks import CUPS_CODEBOOK, DAYS_PER_MONTH, DAYS_PER_YEAR, SPEND_CODEBOOK
from ..operators.joins import complete_cases, join_answers
from ..operators.order import exact_split, exact_split_rows, hash_split, prefix_sum, row_position
from ..operators.recode import recode_join
from ..operators.row_function import apply_rows
from ..sources.survey_csv import (read_csv_strings, read_survey_csv, to_questionnaire,
                                  write_csv)
from ..sources.tables import derived_survey, read_table
from ..session import scratch_path
from . import cleaning, correlation, worth
from .report import correlation_report, worth_report
from .sqlfrag import (CLASSIFIER_CTE, NEWTON_STEPS, CORRELATION_CTE, CORRELATION_FIT_CTE, cost_values_sql, EVENTS_BASE, WITH_SURVEY,
                      WORTH_CTE, WORTH_LONG, WORTH_PARTS, WORTH_SPLIT_CTE, cups_sql, equip_sql,
                      knn_r2_sql, levene_p_sql, levene_sql, mannwhitney_p_sql, mannwhitney_sql, normaltest_sql, spend_sql)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def positive_zero_rounds(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB rounds a
    tiny negative to -0.0 where Spark gives 0.0, and adding +0.0 turns -0.0
    into 0.0 without changing any other value."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = positive_zero_rounds(sql[j + len(key):k - 1])
        out.append(f"{sql[i:j]}(round({inner}) + 0.0)")
        i = k


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = positive_zero_rounds(sql)
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived_survey(spark, sf_dir)


# ---------------------------------------------------------------- ETL queries

@register("cheaper_option_counts", "WITH " + WORTH_CTE + """
SELECT cheaper_option, count(*) AS "count" FROM decision GROUP BY cheaper_option""")
def q_cheaper_option_counts(spark, sf_dir):
    return cleaning.cheaper_option_counts(survey(spark, sf_dir), key_unique=True)


@register("complete_cases", WITH_SURVEY + """
SELECT id, cups, spend, equip, methods FROM survey
WHERE id IS NOT NULL AND cups IS NOT NULL AND spend IS NOT NULL AND equip IS NOT NULL
  AND methods IS NOT NULL""")
def q_complete_cases(spark, sf_dir):
    # verifies key uniqueness itself (one aggregate over the id column)
    return complete_cases(survey(spark, sf_dir), "id", ["cups", "spend", "equip", "methods"])


@register("recode_bands", WITH_SURVEY + f"""
SELECT id, {cups_sql()} AS cup_assumptions, round({spend_sql()}, 6) AS spent_assumptions,
       {equip_sql()} AS eq_assumptions
FROM survey WHERE id IS NOT NULL AND cups IS NOT NULL AND spend IS NOT NULL AND equip IS NOT NULL""")
def q_recode_bands(spark, sf_dir):
    cc = complete_cases(survey(spark, sf_dir), "id", ["cups", "spend", "equip"], key_unique=True)
    return cc.select("id", cleaning.cups_per_day().alias("cup_assumptions"),
                     r6(cleaning.spend_per_day()).alias("spent_assumptions"),
                     cleaning.equipment_cost().alias("eq_assumptions"))


@register("cleaned_correlation", "WITH " + CORRELATION_CTE + """
SELECT id, cup_assumptions, round(spent_assumptions, 6) AS spent_assumptions FROM correlation""")
def q_cleaned_correlation(spark, sf_dir):
    df = cleaning.cleaned_correlation(survey(spark, sf_dir), key_unique=True)
    return df.select("id", "cup_assumptions", r6("spent_assumptions").alias("spent_assumptions"))


@register("cleaned_worth", "WITH " + WORTH_CTE + """
SELECT id, cup_assumptions, round(spent_assumptions, 6) AS spent_assumptions, eq_assumptions,
       round(brewing_cost, 6) AS brewing_cost FROM worth""")
def q_cleaned_worth(spark, sf_dir):
    df = cleaning.cleaned_worth(survey(spark, sf_dir), key_unique=True)
    return df.select("id", "cup_assumptions", r6("spent_assumptions").alias("spent_assumptions"),
                     "eq_assumptions", r6("brewing_cost").alias("brewing_cost"))


@register("brewing_cost", "WITH " + WORTH_CTE + """
SELECT id, methods, cup_assumptions, round(brewing_cost, 6) AS brewing_cost FROM worth""")
def q_brewing_cost(spark, sf_dir):
    s = survey(spark, sf_dir)
    cc = complete_cases(s, "id", ["cups", "spend", "equip", "methods"], key_unique=True)
    df = multiselect_cost(
        cc.select("id", "methods", cleaning.cups_per_day().alias("cup_assumptions")),
        "methods", "cup_assumptions", fixed_cost_table(spark))
    return df.select("id", "methods", "cup_assumptions", r6("brewing_cost").alias("brewing_cost"))


def _cost_of_row(row, upfront, per_use):
    """A user's row function: the dearest method's cost a day."""
    dearest = max(row["methods"].split(", "), key=lambda m: upfront.get(m, 0))
    return upfront.get(dearest, 0) / DAYS_PER_YEAR + per_use.get(dearest, 0) * row["cup_assumptions"]


@register("row_function", "WITH " + WORTH_CTE + """
SELECT id, round(brewing_cost, 6) AS brewing_cost FROM worth""")
def q_row_function(spark, sf_dir):
    """The same cost by a Python function of the row with bound tables."""
    cc = complete_cases(survey(spark, sf_dir), "id", ["cups", "spend", "equip", "methods"], key_unique=True)
    costs = {r.method: (r.upfront, r.per_use) for r in fixed_cost_table(spark).toLocalIterator()}
    upfront, per_use = ({m: float(c[i]) for m, c in costs.items()} for i in (0, 1))
    rows = cc.select("id", "methods", cleaning.cups_per_day().alias("cup_assumptions"))
    done = apply_rows(rows, _cost_of_row, ["methods", "cup_assumptions"], "brewing_cost double", key="id",
                      params={"upfront": upfront, "per_use": per_use})
    return done.select("id", r6("brewing_cost").alias("brewing_cost"))


@register("brewing_cost_join", "WITH " + WORTH_CTE + """
SELECT id, methods, cup_assumptions, round(brewing_cost, 6) AS brewing_cost FROM worth""")
def q_brewing_cost_join(spark, sf_dir):
    """Same answer through the distributed path used for large cost tables."""
    s = survey(spark, sf_dir)
    cc = complete_cases(s, "id", ["cups", "spend", "equip", "methods"], key_unique=True)
    df = multiselect_cost(
        cc.select("id", "methods", cleaning.cups_per_day().alias("cup_assumptions")),
        "methods", "cup_assumptions", fixed_cost_table(spark),
        inline_max_rows=0)
    return df.select("id", "methods", "cup_assumptions", r6("brewing_cost").alias("brewing_cost"))


@register("brewing_cost_nullable", WITH_SURVEY + ",\n" + cost_values_sql() + f""",
opts AS (SELECT id, unnest(string_split(methods, ', ')) AS opt,
                unnest(range(1, len(string_split(methods, ', ')) + 1)) AS pos
         FROM survey WHERE methods IS NOT NULL),
best AS (SELECT id, upfront, per_use FROM (
           SELECT o.id, c.upfront, c.per_use,
                  row_number() OVER (PARTITION BY o.id ORDER BY coalesce(c.upfront, 0) DESC, o.pos) AS rn
           FROM opts o LEFT JOIN cost_table c ON c.method = o.opt) WHERE rn = 1)
SELECT s.id, round(CASE WHEN s.methods IS NULL THEN 0.0 ELSE coalesce(b.upfront, 0) / {DAYS_PER_YEAR}
                        + coalesce(b.per_use, 0) * {cups_sql("s.cups")} END, 6) AS brewing_cost
FROM survey s LEFT JOIN best b ON b.id = s.id WHERE s.cups IS NOT NULL""")
def q_brewing_cost_nullable(spark, sf_dir):
    """Null answers reach the null guard (O-17): priced 0."""
    rows = survey(spark, sf_dir).filter(F.col("cups").isNotNull()).select(
        "id", "methods", cleaning.cups_per_day().alias("cup_assumptions"))
    return multiselect_cost(rows, "methods", "cup_assumptions", fixed_cost_table(spark)).select(
        "id", r6("brewing_cost").alias("brewing_cost"))


@register("join_answers", WITH_SURVEY + """
SELECT a.id, a.cups, b.spend FROM survey a JOIN survey b ON a.id = b.id
WHERE a.cups IS NOT NULL AND b.spend IS NOT NULL""")
def q_join_answers(spark, sf_dir):
    """Answers of two tables joined on the respondent (O-20)."""
    s = survey(spark, sf_dir)
    return join_answers([s.select("id", "cups"), s.select("id", "spend")], "id")


@register("cost_decision", "WITH " + WORTH_CTE + """
SELECT id, round(outside_cost, 6) AS outside_cost, round(brewing_cost, 6) AS brewing_cost,
       result, cheaper_option, label FROM decision""")
def q_cost_decision(spark, sf_dir):
    d = cleaning.decision(cleaning.cleaned_worth(survey(spark, sf_dir), key_unique=True))
    return d.select("id", r6("outside_cost").alias("outside_cost"),
                    r6("brewing_cost").alias("brewing_cost"), "result", "cheaper_option", "label")


@register("other_average", """
WITH dim AS (
  SELECT CASE WHEN p_type LIKE 'PROMO%' THEN 'Other' ELSE CAST(p_partkey AS VARCHAR) END AS item,
         p_retailprice AS upfront, CAST(p_size AS DOUBLE) / 100 AS per_use FROM part)
SELECT item, round(upfront, 6) AS upfront, round(per_use, 6) AS per_use FROM dim
WHERE item <> 'Other'
UNION ALL
SELECT 'Other', round(coalesce(avg(upfront), 0), 6), round(coalesce(avg(per_use), 0), 6)
FROM dim WHERE item <> 'Other'""")
def q_other_average(spark, sf_dir):
    """``part`` read as a cost table: promo parts are the unspecified "Other"
    entry, whose costs become the mean of all other parts (O-26)."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_type", "p_retailprice", "p_size")
    dim = part.select(
        F.when(F.col("p_type").startswith("PROMO"), F.lit("Other"))
         .otherwise(F.col("p_partkey").cast("string")).alias("item"),
        F.col("p_retailprice").alias("upfront"),
        (F.col("p_size").cast("double") / 100).alias("per_use"))
    out = other_average(dim, "item", ["upfront", "per_use"])
    return out.select("item", r6("upfront").alias("upfront"), r6("per_use").alias("per_use"))


@register("survey_csv_roundtrip", WITH_SURVEY + """
SELECT id, cups, spend, equip, methods FROM survey""")
def q_survey_csv_roundtrip(spark, sf_dir):
    """Write the survey as a wide CSV with question-text headers (O-02) and
    read it back by header name with NA tokens mapped to null (O-01)."""
    path = scratch_path(spark, "survey-csv")
    write_csv(to_questionnaire(survey(spark, sf_dir)), path)
    return read_survey_csv(spark, path)


@register("survey_csv_split", WITH_SURVEY + """
SELECT id, cups, spend, equip, replace(methods, ', ', ',' || chr(10) || ' "x" ') AS methods,
       row_number() OVER (ORDER BY id) AS file_row FROM survey""")
def q_survey_csv_split(spark, sf_dir):
    """Questionnaire CSVs whose answers hold line breaks and quotes, written
    in the order of the ids and read in ranges, with the file order."""
    path = scratch_path(spark, "survey-split-csv")
    broken = survey(spark, sf_dir).withColumn("methods", F.replace("methods", F.lit(", "), F.lit(',\n "x" ')))
    write_csv(to_questionnaire(broken.repartitionByRange("id").sortWithinPartitions("id")), path)
    back = read_survey_csv(spark, path, multiline="split", row_order_col="file_row")
    return back.withColumn("id", F.col("id").cast(broken.schema["id"].dataType))


@register("csv_roundtrip", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey",
                      "c_acctbal", "c_mktsegment")
    write_csv(cust, path)
    back = read_csv_strings(spark, path)
    return back.select(F.col("c_custkey").cast("bigint"), "c_name",
                       F.col("c_nationkey").cast("int"), F.col("c_acctbal").cast("double"),
                       "c_mktsegment")


@register("csv_overwrite", """
SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0""")
def q_csv_overwrite(spark, sf_dir):
    """An exported table replaced by a part of itself."""
    path = scratch_path(spark, "customer-overwrite")
    write_csv(read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal"), path)
    write_csv(read_csv_strings(spark, path).filter(F.col("c_acctbal").cast("double") > 0), path)
    return read_csv_strings(spark, path).select(F.col("c_custkey").cast("bigint"), "c_name")


# ------------------------------------------------------------ order & splits

@register("row_position", """
SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS pos FROM customer""")
def q_row_position(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_acctbal")
    return row_position(cust, ["c_acctbal", "c_custkey"]).select("c_custkey", "pos")


@register("prefix_sum", """
SELECT l_orderkey, l_linenumber,
       sum(l_quantity) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_qty
FROM lineitem""")
def q_prefix_sum(spark, sf_dir):
    # (orderkey, linenumber) repeats in this data; the extra columns make the order total
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    li = read_table(spark, sf_dir, "lineitem", *order, "l_quantity")
    return (prefix_sum(li, order, "l_quantity", out="running_qty")
            .select("l_orderkey", "l_linenumber", "running_qty"))


@register("hash_split", """
SELECT o_orderkey, CASE WHEN substr(md5(concat('s', CAST(o_orderkey AS VARCHAR))), 1, 8) < 'c0000000'
                        THEN 'train' ELSE 'valid' END AS split
FROM orders""")
def q_hash_split(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders", "o_orderkey")
    return hash_split(orders, "o_orderkey", 0.75, salt="s")


@register("exact_split", """
SELECT o_orderkey, CASE WHEN rn <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT o_orderkey,
             row_number() OVER (ORDER BY md5(concat('42:', CAST(o_orderkey AS VARCHAR))), o_orderkey) AS rn,
             count(*) OVER () AS n
      FROM orders)""")
def q_exact_split(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders", "o_orderkey")
    return exact_split(orders, "o_orderkey", 0.2, seed=42)


@register("exact_split_rows", """
SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN rn <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) OVER () AS n,
             row_number() OVER (ORDER BY md5(concat('42:', l_linenumber)), md5(concat('42:', '=', l_linenumber, chr(31), '=',
                 l_orderkey, chr(31), '=', l_returnflag))) AS rn
      FROM lineitem)""")
def q_exact_split_rows(spark, sf_dir):
    """Exact split of the order lines by line number: seven keys for all rows."""
    lines = read_table(spark, sf_dir, "lineitem", "l_linenumber", "l_orderkey", "l_returnflag")
    return exact_split_rows(lines, "l_linenumber", 0.2, seed=42, within=["l_orderkey", "l_returnflag"])


@register("recode_join", """
SELECT l_orderkey, l_linenumber, coalesce(p_type, CAST(l_partkey AS VARCHAR)) AS part
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 3 > 0) ON l_partkey = p_partkey""")
def q_recode_join(spark, sf_dir):
    """Part numbers recoded by a codebook of two thirds of the parts, by the
    shuffled form for codebooks of any size."""
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    codes = read_table(spark, sf_dir, "part", "p_partkey", "p_type").filter("p_partkey % 3 > 0")
    return recode_join(lines, "l_partkey", codes, "p_partkey", "p_type", out="part", max_rows=0).select(
        "l_orderkey", "l_linenumber", "part")


# ------------------------------------------------------- features & ridge

@register("mean_impute", WITH_SURVEY + f"""
SELECT id, round(coalesce(c, avg(c) OVER ()), 6) AS cups_imputed
FROM (SELECT id, {cups_sql(to='DOUBLE')} AS c FROM survey)""")
def q_mean_impute(spark, sf_dir):
    """Recoded cups/day of every respondent; unanswered ones get the mean."""
    s = survey(spark, sf_dir).select("id", cleaning.cups_per_day(to="double").alias("c"))
    imp = MeanImputer.fit(s, ["c"])
    return s.select("id", r6(imp.expr("c")).alias("cups_imputed"))


@register("minmax_scale", "WITH " + CORRELATION_FIT_CTE + """
SELECT id, split, round(t, 6) AS t FROM scored""")
def q_minmax_scale(spark, sf_dir):
    fit = correlation.fit_correlation(survey(spark, sf_dir))
    return fit.data.select("id", "split", r6(fit.model.features()).alias("t"))


@register("poly2", "WITH " + CORRELATION_FIT_CTE + """
SELECT id, 1.0::DOUBLE AS bias, round(t, 6) AS t, round(t * t, 6) AS t2 FROM scored""")
def q_poly2(spark, sf_dir):
    fit = correlation.fit_correlation(survey(spark, sf_dir))
    one, t, t2 = poly2_terms(fit.model.features())
    return fit.data.select("id", one.alias("bias"), r6(t).alias("t"), r6(t2).alias("t2"))


@register("standardize", "WITH " + WORTH_SPLIT_CTE + """,
st AS (SELECT avg(outside_cost) AS mo, stddev_pop(outside_cost) AS so, avg(brewing_cost) AS mb,
              stddev_pop(brewing_cost) AS sb FROM dsplit WHERE split = 'train')
SELECT id, split,
       round(CASE WHEN so > 0 THEN (outside_cost - mo) / so ELSE outside_cost - mo END, 6) AS z_outside,
       round(CASE WHEN sb > 0 THEN (brewing_cost - mb) / sb ELSE brewing_cost - mb END, 6) AS z_brewing
FROM dsplit, st""")
def q_standardize(spark, sf_dir):
    d = worth.decision_split(survey(spark, sf_dir))
    std = Standardizer.fit(d.filter(F.col("split") == "train"), ["outside_cost", "brewing_cost"])
    return d.select("id", "split", r6(std.expr("outside_cost")).alias("z_outside"),
                    r6(std.expr("brewing_cost")).alias("z_brewing"))


_RIDGE_METRICS_SQL = """
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'n_train' AS metric, CAST(n AS DOUBLE) AS value FROM model
  UNION ALL SELECT 'impute_mean', mu FROM model
  UNION ALL SELECT 'x_min', lo FROM model
  UNION ALL SELECT 'x_max', hi FROM model
  UNION ALL SELECT 'coef_bias', 0.0 FROM model
  UNION ALL SELECT 'coef_t', b1 FROM model
  UNION ALL SELECT 'coef_t2', b2 FROM model
  UNION ALL SELECT 'intercept', b0 FROM model)"""


@register("ridge_poly2", "WITH " + CORRELATION_FIT_CTE + _RIDGE_METRICS_SQL)
def q_ridge_poly2(spark, sf_dir):
    fit = correlation.fit_correlation(survey(spark, sf_dir))
    return correlation.coefficients(fit).select("metric", r6("value").alias("value"))


@register("ridge_r2", "WITH " + CORRELATION_FIT_CTE + """,
g AS (SELECT split, count(*) AS n, sum((cup_assumptions - yhat) * (cup_assumptions - yhat)) AS sse,
             var_pop(cup_assumptions) * count(*) AS sst FROM pred GROUP BY split),
r AS (SELECT split, n, CASE WHEN sst > 0 THEN 1 - sse / sst WHEN sse = 0 THEN 1.0 ELSE 0.0 END AS r2 FROM g)
SELECT split, n, round(r2, 6) AS r2, round(CASE WHEN r2 >= 0 THEN sqrt(r2) END, 6) AS r FROM r""")
def q_ridge_r2(spark, sf_dir):
    fit = correlation.fit_correlation(survey(spark, sf_dir))
    return correlation.r2_table(fit).select("split", "n", r6("r2").alias("r2"), r6("r").alias("r"))


@register("ridge_curve", "WITH " + CORRELATION_FIT_CTE + """,
rng AS (SELECT min(spent_assumptions) AS glo, max(spent_assumptions) AS ghi FROM sp),
grid AS (SELECT CAST(i AS INTEGER) AS i,
                CASE WHEN i = 99 THEN ghi ELSE glo + i * ((ghi - glo) / 99) END AS x
         FROM range(100) r(i), rng),
gt AS (SELECT i, x, CASE WHEN hi > lo THEN (coalesce(x, mu) - lo) / (hi - lo)
                         ELSE coalesce(x, mu) - lo END AS t FROM grid, model)
SELECT i, round(x, 6) AS x, round(b0 + b1 * t + b2 * t * t, 6) AS y FROM gt, model""")
def q_ridge_curve(spark, sf_dir):
    fit = correlation.fit_correlation(survey(spark, sf_dir))
    return correlation.curve(fit).select("i", r6("x").alias("x"), r6("y").alias("y"))


@register("ridge_chain", ORACLE_SQL["ridge_curve"])
def q_ridge_chain(spark, sf_dir):
    """The fitted curve by a chain of stages (recode, scale, ridge) that was
    fitted on the raw answers, saved and loaded again."""
    s = complete_cases(survey(spark, sf_dir), "id", ["cups", "spend"], key_unique=True)
    split = hash_split(s, "id", 0.75, salt=correlation.SPLIT_SALT)
    chain = Pipeline(stages=[stages.Recode("cups", "cups_a_day", CUPS_CODEBOOK, "double"),
                             stages.Recode("spend", "spend_a_day", SPEND_CODEBOOK, per=DAYS_PER_MONTH),
                             stages.MinMaxPoly2("spend_a_day", ["t", "t2"]), stages.Ridge2(["t", "t2"], "cups_a_day")])
    path = scratch_path(spark, "ridge-chain")
    chain.fit(split.filter(F.col("split") == "train")).save(path)
    loaded = PipelineModel.load(path)
    lo, hi = loaded.stages[1].transform(split).agg(F.min("spend_a_day"), F.max("spend_a_day")).first()
    grid = curve_grid(spark, lo, hi).withColumn("spend_a_day", F.col("x"))
    fitted = PipelineModel(stages=loaded.stages[2:]).transform(grid)
    return fitted.select("i", r6("x").alias("x"), r6("prediction").alias("y"))


@register("ridge_mllib", "WITH " + CORRELATION_FIT_CTE + """
SELECT metric, round(value, 4) AS value FROM (
  SELECT 'coef_t' AS metric, b1 AS value FROM model
  UNION ALL SELECT 'coef_t2', b2 FROM model
  UNION ALL SELECT 'intercept', b0 FROM model)""")
def q_ridge_mllib(spark, sf_dir):
    """The ridge fit as an MLlib Pipeline (O-43); same coefficients."""
    fit = correlation.fit_correlation(survey(spark, sf_dir))
    m = fit.model
    train = fit.data.filter(F.col("split") == "train").select(
        m.scale.expr(F.col(correlation.X)).alias("x"), F.col(correlation.Y).cast("double").alias("y"))
    sd = train.agg(F.stddev_pop("y")).first()[0]
    model = mllib_ridge_pipeline(m.n_train, sd, m.alpha).fit(train)
    lr = model.stages[-1]
    rows = [("coef_t", float(lr.coefficients[0])), ("coef_t2", float(lr.coefficients[1])),
            ("intercept", float(lr.intercept))]
    return spark.createDataFrame(rows, "metric string, value double").select(
        "metric", F.round("value", 4).alias("value"))


@register("scatter_bins", "WITH " + CORRELATION_CTE + """
SELECT CAST(floor(spent_assumptions / 0.5) AS BIGINT) AS bx, CAST(floor(cup_assumptions / 1.0) AS BIGINT) AS by,
       count(*) AS n FROM correlation GROUP BY 1, 2""")
def q_scatter_bins(spark, sf_dir):
    data = cleaning.cleaned_correlation(survey(spark, sf_dir), key_unique=True)
    return correlation.scatter_bins(data, correlation.X, correlation.Y, 0.5, 1.0)


def _keyed_normal_sql(key: str, seed: int) -> str:
    u = [f"((('0x' || substr(md5(concat('{seed}:', {key})), {start}, 8))::BIGINT + 0.5) / 4294967296)"
         for start in (1, 9)]
    return f"(sqrt(-2 * ln({u[0]})) * cos({2.0 * 3.141592653589793!r} * {u[1]}))"


@register("jitter", "WITH " + CORRELATION_CTE + f"""
SELECT id, round(spent_assumptions, 6) AS x,
       round(cup_assumptions + 0.1 * {_keyed_normal_sql('id', 7)}, 6) AS y
FROM correlation""")
def q_jitter(spark, sf_dir):
    """Jittered scatter points: y plus a keyed N(0, 0.1²) draw (O-31)."""
    fit = correlation.fit_correlation(survey(spark, sf_dir))
    return correlation.jitter(fit).select("id", r6("x").alias("x"), r6("y").alias("y"))


# -------------------------------------------------------------------- k-NN

_KNN_CUSTOMER_SQL = """
WITH c AS (
  SELECT c_custkey, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y,
         CASE WHEN substr(md5(concat('knn', CAST(c_custkey AS VARCHAR))), 1, 8) < 'c0000000'
              THEN 'train' ELSE 'valid' END AS split
  FROM customer),
tr AS (SELECT * FROM c WHERE split = 'train'),
nb AS (
  SELECT q.c_custkey, q.split, q.y, t.y AS ty,
         row_number() OVER (PARTITION BY q.c_custkey
                            ORDER BY abs(t.x - q.x), t.x, t.c_custkey) AS rn
  FROM c q, tr t),
pred AS (SELECT c_custkey, split, any_value(y) AS y, avg(ty) AS pred FROM nb WHERE rn <= 5
         GROUP BY c_custkey, split)"""


@register("knn5", _KNN_CUSTOMER_SQL + """
SELECT c_custkey, split, round(pred, 6) AS pred FROM pred""")
def q_knn5(spark, sf_dir):
    """5-NN regression of nation key on account balance (one real-valued
    feature with distance ties), exact, against a brute-force oracle."""
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_nationkey")
    data = hash_split(cust.select("c_custkey", F.col("c_acctbal").alias("x"),
                                  F.col("c_nationkey").cast("double").alias("y")),
                      "c_custkey", 0.75, salt="knn")
    pred = knn_regress_1d(data.filter(F.col("split") == "train"), data, "x", "y", "c_custkey", k=5)
    return pred.select("c_custkey", "split", r6("pred").alias("pred"))


@register("knn_nd", """
WITH o AS (
  SELECT o_orderkey, o_custkey, date_diff('day', DATE '1992-01-01', o_orderdate::DATE) AS day,
         CAST(left(o_orderpriority, 1) AS INTEGER) * 100 AS priority, o_totalprice,
         CASE WHEN substr(md5(concat('nd', CAST(o_orderkey AS VARCHAR))), 1, 8) < 'c0000000'
              THEN 'train' ELSE 'valid' END AS split
  FROM orders),
nb AS (
  SELECT q.o_orderkey, t.o_totalprice AS ty,
         row_number() OVER (PARTITION BY q.o_orderkey ORDER BY (t.o_custkey - q.o_custkey) ** 2
             + (t.day - q.day) ** 2 + (t.priority - q.priority) ** 2, t.o_orderkey) AS rn
  FROM (SELECT * FROM o WHERE split = 'valid') q, (SELECT * FROM o WHERE split = 'train') t)
SELECT o_orderkey, round(avg(ty), 6) AS pred FROM nb WHERE rn <= 5 GROUP BY o_orderkey""")
def q_knn_nd(spark, sf_dir):
    """5-NN regression of an order's price on customer number, day and
    priority (with distance ties), exact, against all pairs."""
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    data = hash_split(orders.select("o_orderkey", "o_custkey", "o_totalprice",
                                    F.date_diff("o_orderdate", F.lit("1992-01-01").cast("date")).alias("day"),
                                    (F.left("o_orderpriority", F.lit(1)).cast("int") * 100).alias("priority")),
                      "o_orderkey", 0.75, salt="nd")
    pred = knn_regress(data.filter(F.col("split") == "train"), data.filter(F.col("split") == "valid"),
                       ["o_custkey", "day", "priority"], "o_totalprice", "o_orderkey", k=5)
    return pred.select("o_orderkey", r6("pred").alias("pred"))


@register("knn5_r2", _KNN_CUSTOMER_SQL + """,
g AS (SELECT split, count(*) AS n, sum((y - pred) * (y - pred)) AS sse,
             var_pop(y) * count(*) AS sst FROM pred GROUP BY split),
r AS (SELECT split, n, CASE WHEN sst > 0 THEN 1 - sse / sst WHEN sse = 0 THEN 1.0 ELSE 0.0 END AS r2 FROM g)
SELECT split, n, round(r2, 6) AS r2, round(CASE WHEN r2 >= 0 THEN sqrt(r2) END, 6) AS r FROM r""")
def q_knn5_r2(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_nationkey")
    data = hash_split(cust.select("c_custkey", F.col("c_acctbal").alias("x"),
                                  F.col("c_nationkey").cast("double").alias("y")),
                      "c_custkey", 0.75, salt="knn")
    pred = knn_regress_1d(data.filter(F.col("split") == "train"), data, "x", "y", "c_custkey", k=5)
    return r2_by_group(pred, "y", "pred", "split").select(
        "split", "n", r6("r2").alias("r2"), r6("r").alias("r"))


def _knn_worth_sql(target: str, salt: str) -> str:
    return "WITH " + WORTH_CTE + f""",
pos AS (SELECT id, row_number() OVER (ORDER BY id) AS x, {target} AS y,
               CASE WHEN substr(md5(concat('{salt}', id)), 1, 8) < 'c0000000'
                    THEN 'train' ELSE 'valid' END AS split FROM decision),
tr AS (SELECT * FROM pos WHERE split = 'train'),
nb AS (
  SELECT q.id, q.split, q.y, t.y AS ty,
         row_number() OVER (PARTITION BY q.id ORDER BY abs(t.x - q.x), t.x, t.id) AS rn
  FROM pos q, tr t),
pred AS (SELECT id, split, any_value(y) AS y, avg(ty) AS pred FROM nb WHERE rn <= 5
         GROUP BY id, split)
SELECT id, split, round(y, 6) AS y, round(pred, 6) AS pred FROM pred"""


@register("knn5_home", _knn_worth_sql("brewing_cost", "worth-home"))
def q_knn5_home(spark, sf_dir):
    """5-NN of the home brewing cost on the respondent's row position,
    trained on a 75% split, predicted for every respondent."""
    pos = worth.with_positions(worth.decision_table(survey(spark, sf_dir)))
    pred = worth.knn_fit_predict(pos, "brewing_cost")
    return pred.select("id", "split", r6("y").alias("y"), r6("pred").alias("pred"))


@register("knn5_outside", _knn_worth_sql("outside_cost", "worth-outside"))
def q_knn5_outside(spark, sf_dir):
    pos = worth.with_positions(worth.decision_table(survey(spark, sf_dir)))
    pred = worth.knn_fit_predict(pos, "outside_cost")
    return pred.select("id", "split", r6("y").alias("y"), r6("pred").alias("pred"))


# ------------------------------------------------------------------ tests

def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events", "event_type", "value")


def _worth_long(spark, sf_dir, materialized=False):
    d = worth.decision_table(survey(spark, sf_dir), materialized=materialized)
    return long_form(d, ["outside_cost", "brewing_cost"], "g", "v")


def _round_cols(df, cols):
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("normaltest", "WITH " + EVENTS_BASE + "," + normaltest_sql("ev_base", "event_type"))
def q_normaltest(spark, sf_dir):
    nt = normaltest(_events(spark, sf_dir), "value", ["event_type"])
    return _round_cols(nt, ["skew_z", "kurt_z", "k2", "pvalue"])


@register("worth_normaltest", "WITH " + WORTH_CTE + "," + WORTH_LONG + ","
          + normaltest_sql("worth_long", "g"))
def q_worth_normaltest(spark, sf_dir):
    """Normality of the outside and home daily costs (the original test)."""
    nt = normaltest(_worth_long(spark, sf_dir), "v", ["g"])
    return _round_cols(nt, ["skew_z", "kurt_z", "k2", "pvalue"])


@register("levene_w", "WITH " + EVENTS_BASE + "," + levene_sql("ev_base"))
def q_levene_w(spark, sf_dir):
    return _round_cols(levene_stat(_events(spark, sf_dir), "value", "event_type"), ["w"])


@register("worth_levene_w", "WITH " + WORTH_CTE + "," + WORTH_LONG + "," + levene_sql("worth_long"))
def q_worth_levene_w(spark, sf_dir):
    return _round_cols(levene_stat(_worth_long(spark, sf_dir, True), "v", "g"), ["w"])


def _levene_p(df, value, group):
    return _round_cols(levene(df, value, group), ["w"]).withColumn("pvalue", F.round("pvalue", 5))


def _mannwhitney_p(df, *args):
    return _round_cols(mannwhitney(df, *args), ["u1", "u", "z"]).withColumn("pvalue", F.round("pvalue", 5))


@register("levene_p", "WITH " + WORTH_CTE + "," + WORTH_LONG + "," + levene_p_sql("worth_long"))
def q_levene_p(spark, sf_dir):
    """Levene's test with its F-distribution p-value (oracle: Simpson sums)."""
    return _levene_p(_worth_long(spark, sf_dir, True), "v", "g")


@register("events_levene_p", "WITH " + EVENTS_BASE + "," + levene_p_sql("ev_base"))
def q_events_levene_p(spark, sf_dir):
    return _levene_p(_events(spark, sf_dir), "value", "event_type")


@register("mannwhitney_u", "WITH " + WORTH_CTE + "," + WORTH_LONG + ","
          + mannwhitney_sql("worth_long", "outside_cost", "brewing_cost"))
def q_mannwhitney_u(spark, sf_dir):
    mw = mannwhitney_stat(_worth_long(spark, sf_dir), "v", "g", "outside_cost", "brewing_cost")
    return _round_cols(mw, ["u1", "u", "z"])


@register("events_mannwhitney_u", "WITH " + EVENTS_BASE + ","
          + mannwhitney_sql("ev_base", "click", "view"))
def q_events_mannwhitney_u(spark, sf_dir):
    mw = mannwhitney_stat(_events(spark, sf_dir), "value", "event_type", "click", "view")
    return _round_cols(mw, ["u1", "u", "z"])


@register("mannwhitney_p", "WITH " + WORTH_CTE + "," + WORTH_LONG + ","
          + mannwhitney_p_sql("worth_long", "outside_cost", "brewing_cost"))
def q_mannwhitney_p(spark, sf_dir):
    """U test with its p-value (oracle: Simpson sums)."""
    return _mannwhitney_p(_worth_long(spark, sf_dir), "v", "g", "outside_cost", "brewing_cost")


@register("events_mannwhitney_p", "WITH " + EVENTS_BASE + "," + mannwhitney_p_sql("ev_base", "click", "view"))
def q_events_mannwhitney_p(spark, sf_dir):
    return _mannwhitney_p(_events(spark, sf_dir), "value", "event_type", "click", "view")


# ------------------------------------------------------- classifier & report

@register("worth_means", "WITH " + WORTH_CTE + """
SELECT 'mean_brewing_cost' AS metric, round(avg(brewing_cost), 6) AS value FROM decision
UNION ALL SELECT 'mean_outside_cost', round(avg(outside_cost), 6) FROM decision""")
def q_worth_means(spark, sf_dir):
    return worth.means(worth.decision_table(survey(spark, sf_dir))).select(
        "metric", r6("value").alias("value"))


@register("logistic_accuracy", "WITH RECURSIVE " + WORTH_SPLIT_CTE + "," + CLASSIFIER_CTE + """
SELECT n_train, n_test, round(accuracy, 6) AS accuracy FROM lg_acc""")
def q_logistic_accuracy(spark, sf_dir):
    """Held-out accuracy of the logistic classifier (oracle: Newton steps)."""
    res = worth.classify(survey(spark, sf_dir))
    return accuracy(res.predictions).select(F.lit(res.n_train).cast("long").alias("n_train"), "n_test",
                                            r6("accuracy").alias("accuracy"))


@register("predicted_classes", "WITH RECURSIVE " + WORTH_SPLIT_CTE + "," + CLASSIFIER_CTE + f"""
SELECT id, label::INTEGER AS label, CASE WHEN b0 + b1 * (outside_cost - mo) / CASE WHEN so > 0 THEN so ELSE 1 END
       + b2 * (brewing_cost - mb) / CASE WHEN sb > 0 THEN sb ELSE 1 END > 0 THEN 1 ELSE 0 END AS predicted
FROM dsplit, lg_st, lg_fit WHERE split = 'test' AND i = {NEWTON_STEPS}""")
def q_predicted_classes(spark, sf_dir):
    """The class of every held-out row (oracle: Newton steps)."""
    d = worth.decision_table(survey(spark, sf_dir), True, materialized=True)
    return predicted_classes(worth.classify_decision(d, carry=("id",)), "id").select("id", "label", "predicted")


_MLP = mlp.Perceptron.start(2)


@register("mlp_scores", "WITH " + WORTH_SPLIT_CTE + """,
lg_st AS (SELECT avg(outside_cost) AS mo, stddev_pop(outside_cost) AS so, avg(brewing_cost) AS mb,
                 stddev_pop(brewing_cost) AS sb FROM dsplit WHERE split = 'train'),
lg_z AS (SELECT id, split, (outside_cost - mo) / CASE WHEN so > 0 THEN so ELSE 1 END AS x1,
                (brewing_cost - mb) / CASE WHEN sb > 0 THEN sb ELSE 1 END AS x2 FROM dsplit, lg_st),
""" + ",\n".join(mlp.score_sql(_MLP, ["x1", "x2"], "lg_z", ["id", "split"])) + """
SELECT id, split, round(score, 6) AS score FROM mlp3""")
def q_mlp_scores(spark, sf_dir):
    """Forward pass of the 16-8 perceptron from its fixed start weights."""
    rows = worth.standardized_split(survey(spark, sf_dir))
    return mlp.score(rows, _MLP, worth.CLASSIFIER_FEATURES, carry=["id", "split"]).select("id", "split", r6("score").alias("score"))


@register("worth_report", "WITH RECURSIVE " + WORTH_SPLIT_CTE + "," + ",".join((
    CLASSIFIER_CTE, WORTH_LONG, knn_r2_sql("kh", "brewing_cost", worth.KNN_SALTS["brewing_cost"]),
    knn_r2_sql("ko", "outside_cost", worth.KNN_SALTS["outside_cost"]))) + f""",
t_norm AS (WITH {normaltest_sql("worth_long", "g")}),
t_lev AS (WITH {levene_p_sql("worth_long")}),
t_mw AS (WITH {mannwhitney_p_sql("worth_long", "outside_cost", "brewing_cost")})
SELECT 'worth' AS analysis, 'mean_brewing_cost' AS metric, round(avg(brewing_cost), 5) AS value FROM decision
UNION ALL SELECT 'worth', 'mean_outside_cost', round(avg(outside_cost), 5) FROM decision
UNION ALL SELECT 'knn_home', split || ':r2', round(r2, 5) FROM kh_r
UNION ALL SELECT 'knn_home', split || ':r', round(CASE WHEN r2 >= 0 THEN sqrt(r2) END, 5) FROM kh_r
UNION ALL SELECT 'knn_outside', split || ':r2', round(r2, 5) FROM ko_r
UNION ALL SELECT 'knn_outside', split || ':r', round(CASE WHEN r2 >= 0 THEN sqrt(r2) END, 5) FROM ko_r
UNION ALL SELECT 'cheaper_option', cheaper_option || ':count', CAST(count(*) AS DOUBLE) FROM decision
          GROUP BY cheaper_option
UNION ALL SELECT 'classifier', 'accuracy', round(accuracy, 5) FROM lg_acc
UNION ALL SELECT 'normaltest', g || ':pvalue', round(pvalue, 5) FROM t_norm
UNION ALL SELECT 'levene', 'w', round(w, 5) FROM t_lev
UNION ALL SELECT 'levene', 'pvalue', round(pvalue, 5) FROM t_lev
UNION ALL SELECT 'mannwhitney', 'u1', round(u1, 5) FROM t_mw
UNION ALL SELECT 'mannwhitney', 'pvalue', round(pvalue, 5) FROM t_mw""")
def q_worth_report(spark, sf_dir):
    """Every printed result of the worth analysis as one tidy table
    (analysis, metric, value) (O-03): means, k-NN R² per split, class
    counts, classifier accuracy and the four test p-values, to 5 decimals."""
    return worth_report(survey(spark, sf_dir)).withColumn("value", F.round("value", 5))


@register("correlation_report", "WITH " + CORRELATION_FIT_CTE + """,
g AS (SELECT split, count(*) AS n, sum((cup_assumptions - yhat) * (cup_assumptions - yhat)) AS sse,
             var_pop(cup_assumptions) * count(*) AS sst FROM pred GROUP BY split),
r AS (SELECT split, CASE WHEN sst > 0 THEN 1 - sse / sst WHEN sse = 0 THEN 1.0 ELSE 0.0 END AS r2 FROM g)
SELECT 'ridge' AS analysis, metric, value FROM (""" + _RIDGE_METRICS_SQL + """)
UNION ALL SELECT 'ridge', split || ':r2', round(r2, 6) FROM r
UNION ALL SELECT 'ridge', split || ':r', round(CASE WHEN r2 >= 0 THEN sqrt(r2) END, 6) FROM r""")
def q_correlation_report(spark, sf_dir):
    """Printed results of the correlation analysis as (analysis, metric,
    value): coefficients, intercept, R² and R on both splits (O-03)."""
    rep = correlation_report(survey(spark, sf_dir))
    return rep.select("analysis", "metric", r6("value").alias("value"))


# --------------------------------------------------------------- streaming

@register("stream_cheaper_option_counts", "WITH " + WORTH_CTE + """
SELECT cheaper_option, count(*) AS "count" FROM decision GROUP BY cheaper_option""")
def q_stream_cheaper_option_counts(spark, sf_dir):
    """The flagship result through the streaming path: the survey is written
    as CSV files in two arrival batches, a file-source stream cleans and
    prices them into a Parquet sink (exactly-once, checkpointed in the
    shared folder), and the counts are read from that sink."""
    from ..operators.order import hash_split as _hs
    from ..streaming import start_cleaned_sink
    src = scratch_path(spark, "stream-src")
    s = to_questionnaire(survey(spark, sf_dir))
    q = s.columns[0]
    parts = _hs(s, q, 0.25, salt="arrival", labels=("a", "b"))
    write_csv(parts.filter(F.col("split") == "a").drop("split"), src + "/batch=1")
    write_csv(parts.filter(F.col("split") == "b").drop("split"), src + "/batch=2")
    sink = scratch_path(spark, "stream-sink")
    query = start_cleaned_sink(spark, src, sink)
    query.awaitTermination()
    out = spark.read.parquet(sink)
    return cleaning.value_counts(out, "cheaper_option")


# ------------------------------------------------------------ CSV exports

@register("correlation_csv", "WITH " + CORRELATION_CTE + """
SELECT id, CAST(cup_assumptions AS INTEGER) AS cup_assumptions,
       round(spent_assumptions, 6) AS spent_assumptions FROM correlation""")
def q_correlation_csv(spark, sf_dir):
    """Export the cleaned correlation table as CSV (numbers as text) and
    read it back (O-02, O-15)."""
    path = scratch_path(spark, "correlation-csv")
    cleaning.export_correlation(survey(spark, sf_dir), path, key_unique=True)
    back = read_csv_strings(spark, path)
    return back.select("id", F.col("cup_assumptions").cast("int").alias("cup_assumptions"),
                       r6(F.col("spent_assumptions").cast("double")).alias("spent_assumptions"))


@register("worth_csv", "WITH " + WORTH_CTE + """
SELECT id, cup_assumptions, round(spent_assumptions, 6) AS spent_assumptions, eq_assumptions,
       round(brewing_cost, 6) AS brewing_cost FROM worth""")
def q_worth_csv(spark, sf_dir):
    """Export the cleaned worth table as CSV and read it back (O-02)."""
    path = scratch_path(spark, "worth-csv")
    cleaning.export_worth(survey(spark, sf_dir), path, key_unique=True)
    back = read_csv_strings(spark, path)
    return back.select("id", F.col("cup_assumptions").cast("int").alias("cup_assumptions"),
                       r6(F.col("spent_assumptions").cast("double")).alias("spent_assumptions"),
                       F.col("eq_assumptions").cast("int").alias("eq_assumptions"),
                       r6(F.col("brewing_cost").cast("double")).alias("brewing_cost"))


@register("chart_points", "WITH " + CORRELATION_FIT_CTE + """,
rng AS (SELECT min(spent_assumptions) AS glo, max(spent_assumptions) AS ghi FROM sp),
grid AS (SELECT CASE WHEN i = 99 THEN ghi ELSE glo + i * ((ghi - glo) / 99) END AS x
         FROM range(100) r(i), rng),
gt AS (SELECT x, CASE WHEN hi > lo THEN (coalesce(x, mu) - lo) / (hi - lo)
                      ELSE coalesce(x, mu) - lo END AS t FROM grid, model)
SELECT 'data' AS series, round(spent_assumptions, 6) AS x, round(cup_assumptions, 6) AS y FROM sp
UNION ALL
SELECT 'fit', round(x, 6), round(b0 + b1 * t + b2 * t * t, 6) FROM gt, model""")
def q_chart_points(spark, sf_dir):
    """Scatter points and fitted curve of the correlation plot as one
    (series, x, y) table (O-04)."""
    fit = correlation.fit_correlation(survey(spark, sf_dir))
    return correlation.chart_series(fit).select("series", r6("x").alias("x"), r6("y").alias("y"))


@register("metrics_report", "WITH " + CORRELATION_FIT_CTE.rstrip() + ",\n" + WORTH_PARTS.strip() + """,
g AS (SELECT split, count(*) AS n, sum((cup_assumptions - yhat) * (cup_assumptions - yhat)) AS sse,
             var_pop(cup_assumptions) * count(*) AS sst FROM pred GROUP BY split),
r AS (SELECT split, CASE WHEN sst > 0 THEN 1 - sse / sst WHEN sse = 0 THEN 1.0 ELSE 0.0 END AS r2 FROM g)
SELECT 'ridge' AS analysis, metric, value FROM (""" + _RIDGE_METRICS_SQL + """)
UNION ALL SELECT 'ridge', split || ':r2', round(r2, 6) FROM r
UNION ALL SELECT 'ridge', split || ':r', round(CASE WHEN r2 >= 0 THEN sqrt(r2) END, 6) FROM r
UNION ALL SELECT 'worth', 'mean_brewing_cost', round(avg(brewing_cost), 6) FROM decision
UNION ALL SELECT 'worth', 'mean_outside_cost', round(avg(outside_cost), 6) FROM decision""")
def q_metrics_report(spark, sf_dir):
    """The SQL-checkable printed results of both analyses in one tidy table
    (analysis, metric, value): ridge coefficients, R and R² per split, and
    the mean daily costs (O-03, O-23)."""
    s = survey(spark, sf_dir)
    corr = correlation_report(s)
    means = worth.means(worth.decision_table(s)).select(
        F.lit("worth").alias("analysis"), "metric", "value")
    return corr.unionByName(means).select("analysis", "metric", r6("value").alias("value"))
