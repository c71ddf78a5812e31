"""Parquet tables of a scale-factor folder, and the survey derived from them.

The driver's data holds no survey, so a survey of the same shape is derived
from ``orders``, ``lineitem`` and ``part`` (one respondent per order).  The
derivation is a plain DataFrame plan: column-pruned scans, one join of
``lineitem`` with ``part`` (AQE picks broadcast or sort-merge from runtime
sizes), one partial/final ``bit_or`` aggregate per order, one left join with
orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A parquet table, pruned to ``columns``."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


# Rules of the derived survey (test-data design, not survey content).
_CUPS_BY_PRIORITY = {"1-URGENT": "More than 4", "2-HIGH": "3", "5-LOW": "Less than 1"}
_SPEND_BANDS = [(80000, "<$20"), (160000, "$20-$40"), (240000, "$40-$60"),
                (320000, "$60-$80"), (400000, "$80-$100")]
_SPEND_TOP = ">$100"
_EQUIP_BY_CUSTKEY_MOD8 = {1: "More than $1,000", 2: "$500-$1000", 3: "$300-$500",
                          4: "$100-$300", 5: "$50-$100", 6: "$20-$50", 7: "Less than $20"}
_METHOD_BY_LINENUMBER = {7: "Other", 6: "Siphon"}
_METHOD_BY_TYPE_PREFIX = [("STANDARD", "French press"), ("ECONOMY", "Instant coffee"),
                          ("MEDIUM", "Pour over"), ("PROMO", "Coffee extract (e.g. Cometeer)"),
                          ("SMALL", "Pod/capsule machine (e.g. Keurig/Nespresso)"),
                          ("LARGE", "Espresso")]


def _cups_expr() -> F.Column:
    prio, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    e = F.when(prio == "3-MEDIUM", F.when(status == "F", F.lit("1")).otherwise(F.lit("2")))
    for k, v in _CUPS_BY_PRIORITY.items():
        e = e.when(prio == k, F.lit(v))
    return e


def _spend_expr() -> F.Column:
    price = F.col("o_totalprice")
    e = F.when(price.isNull(), F.lit(None).cast("string"))
    for bound, label in _SPEND_BANDS:
        e = e.when(price < bound, F.lit(label))
    return e.otherwise(F.lit(_SPEND_TOP))


def _equip_expr() -> F.Column:
    m = F.col("o_custkey") % 8
    e = None
    for k, v in _EQUIP_BY_CUSTKEY_MOD8.items():
        e = F.when(m == k, F.lit(v)) if e is None else e.when(m == k, F.lit(v))
    return e


def _method_labels() -> list[str]:
    """Every method label the derivation can produce, in ascending order."""
    return sorted(set(_METHOD_BY_LINENUMBER.values()) | {v for _, v in _METHOD_BY_TYPE_PREFIX})


def _method_code_expr(labels: list[str]) -> F.Column:
    """Index of the line's method in ``labels`` (null if none applies)."""
    code = {v: i for i, v in enumerate(labels)}
    ln, ptype = F.col("l_linenumber"), F.col("p_type")
    e = None
    for k, v in _METHOD_BY_LINENUMBER.items():
        e = F.when(ln == k, F.lit(code[v])) if e is None else e.when(ln == k, F.lit(code[v]))
    for prefix, v in _METHOD_BY_TYPE_PREFIX:
        e = e.when(ptype.startswith(prefix), F.lit(code[v]))
    return e


def order_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(okey, methods): distinct methods of an order's lines, sorted, joined
    by ', '.  The set is aggregated as a bitmask of method codes with
    ``bit_or`` (8 bytes of state per order, partial aggregation map-side, so
    a hot order costs nothing), then decoded in label order; ``array_join``
    skips the nulls of absent methods."""
    labels = _method_labels()
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber")
    parts = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    per_line = (lines.join(parts, lines.l_partkey == parts.p_partkey, "inner")
                .select(F.col("l_orderkey").alias("okey"),
                        _method_code_expr(labels).alias("code"))
                .filter(F.col("code").isNotNull()))
    masks = per_line.groupBy("okey").agg(
        F.bit_or(F.expr("shiftleft(CAST(1 AS BIGINT), code)")).alias("mask"))
    present = [F.when(F.col("mask").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(label))
               for i, label in enumerate(labels)]
    return masks.select("okey", F.array_join(F.array(*present), ", ").alias("methods"))


def derived_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey with short names (id, cups, spend, equip, methods), all text,
    one row per order; unanswered questions are null."""
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                        "o_totalprice", "o_orderpriority")
    answers = orders.select(
        F.col("o_orderkey").alias("okey"),
        F.col("o_orderkey").cast("string").alias("id"),
        _cups_expr().alias("cups"),
        _spend_expr().alias("spend"),
        _equip_expr().alias("equip"))
    return (answers.join(order_methods(spark, sf_dir), "okey", "left")
            .select("id", "cups", "spend", "equip", "methods"))


# The same derivation in SQL, for the DuckDB oracle (views: orders, lineitem, part).
SURVEY_SQL_CTE = """
survey_line_methods AS (
  SELECT l.l_orderkey AS okey,
         CASE WHEN l.l_linenumber = 7 THEN 'Other'
              WHEN l.l_linenumber = 6 THEN 'Siphon'
              WHEN p.p_type LIKE 'STANDARD%' THEN 'French press'
              WHEN p.p_type LIKE 'ECONOMY%' THEN 'Instant coffee'
              WHEN p.p_type LIKE 'MEDIUM%' THEN 'Pour over'
              WHEN p.p_type LIKE 'PROMO%' THEN 'Coffee extract (e.g. Cometeer)'
              WHEN p.p_type LIKE 'SMALL%' THEN 'Pod/capsule machine (e.g. Keurig/Nespresso)'
              WHEN p.p_type LIKE 'LARGE%' THEN 'Espresso' END AS method
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
survey_order_methods AS (
  SELECT okey, string_agg(DISTINCT method, ', ' ORDER BY method) AS methods
  FROM survey_line_methods WHERE method IS NOT NULL GROUP BY okey),
survey AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id,
         CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN CASE WHEN o.o_orderstatus = 'F' THEN '1' ELSE '2' END
              WHEN o.o_orderpriority = '1-URGENT' THEN 'More than 4'
              WHEN o.o_orderpriority = '2-HIGH' THEN '3'
              WHEN o.o_orderpriority = '5-LOW' THEN 'Less than 1' END AS cups,
         CASE WHEN o.o_totalprice IS NULL THEN NULL
              WHEN o.o_totalprice < 80000 THEN '<$20'
              WHEN o.o_totalprice < 160000 THEN '$20-$40'
              WHEN o.o_totalprice < 240000 THEN '$40-$60'
              WHEN o.o_totalprice < 320000 THEN '$60-$80'
              WHEN o.o_totalprice < 400000 THEN '$80-$100'
              ELSE '>$100' END AS spend,
         CASE o.o_custkey % 8 WHEN 1 THEN 'More than $1,000' WHEN 2 THEN '$500-$1000'
              WHEN 3 THEN '$300-$500' WHEN 4 THEN '$100-$300' WHEN 5 THEN '$50-$100'
              WHEN 6 THEN '$20-$50' WHEN 7 THEN 'Less than $20' END AS equip,
         m.methods
  FROM orders o LEFT JOIN survey_order_methods m ON m.okey = o.o_orderkey)
"""
