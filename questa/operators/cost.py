"""Cost tables and multi-select cost (O-22, O-26, O-27, O-28, O-32, O-33).

``multiselect_cost`` prices a multi-select answer: split the options, pick the
option with the highest *primary* cost (first option wins ties, unknown
options cost 0), then ``primary / amortize + secondary * quantity`` for that
same option.  A small cost table (the normal case: ten methods) is inlined as
constant maps, so the whole thing is one codegen'd projection with no join
and no shuffle.  A large table is joined to the distinct answers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codebooks import (DAYS_PER_YEAR, METHOD_PER_USE_COST, METHOD_SEPARATOR,
                                   METHOD_UPFRONT_COST, OTHER_KEY)
from ..functions.expr import split_multiselect
from .joins import join_per_group

# A constant map lookup scans its keys linearly, so inlining pays only for
# small tables (measured: faster than the join path at 10-100 entries, 20x
# slower at 9,000); larger tables take the shuffle join path.
INLINE_MAX_ROWS = 256


def other_average(dim: DataFrame, key: str, values: Sequence[str],
                  other_key: str = OTHER_KEY) -> DataFrame:
    """Set the ``other_key`` entry to the mean of all other entries, per value
    column, or 0 when there are none; the entry is added if absent (O-26).

    A global aggregate (partial per task, one tiny final) unioned with the
    non-"Other" rows; no join."""
    is_other = F.col(key).eqNullSafe(F.lit(other_key))
    rest = dim.filter(~is_other).select(key, *[F.col(v).cast("double").alias(v) for v in values])
    avg_row = rest.agg(*[F.coalesce(F.avg(v), F.lit(0.0)).alias(v) for v in values])
    avg_row = avg_row.select(F.lit(other_key).alias(key), *values)
    return rest.unionByName(avg_row)


def fill_other(table: Mapping[str, float], other_key: str = OTHER_KEY) -> dict[str, float]:
    """Dictionary form of :func:`other_average` for a constant table: the
    "Other" entry becomes the mean of the other entries (0 if none)."""
    rest = [float(v) for k, v in table.items() if k != other_key]
    out = {k: float(v) for k, v in table.items() if k != other_key}
    out[other_key] = sum(rest) / len(rest) if rest else 0.0
    return out


def fixed_cost_map(upfront: Mapping[str, float] = METHOD_UPFRONT_COST,
                   per_use: Mapping[str, float] = METHOD_PER_USE_COST) -> Column:
    """The brew-method cost table with "Other" filled, as a constant map
    column for the inline path (no job needed to build it)."""
    up, pu = fill_other(upfront), fill_other(per_use)
    keys = list(up) + [k for k in pu if k not in up]
    return cost_map({k: (up.get(k, 0.0), pu.get(k, 0.0)) for k in keys})


def fixed_cost_table(spark: SparkSession,
                     upfront: Mapping[str, float] = METHOD_UPFRONT_COST,
                     per_use: Mapping[str, float] = METHOD_PER_USE_COST) -> DataFrame:
    """The brew-method cost table (method, upfront, per_use) with "Other"
    filled by :func:`other_average` (O-33)."""
    keys = list(upfront)
    for k in per_use:
        if k not in upfront:
            keys.append(k)
    rows = [(k, float(upfront.get(k, 0.0)), float(per_use.get(k, 0.0))) for k in keys]
    dim = spark.createDataFrame(rows, "method string, upfront double, per_use double")
    return other_average(dim, "method", ["upfront", "per_use"])


def _bounded_rows(dim: DataFrame, limit: int):
    rows = dim.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def multiselect_cost_inline(df: DataFrame, options_col: str, qty_col: str, costs: Column,
                            amortize: float = DAYS_PER_YEAR, out: str = "brewing_cost",
                            sep: str = METHOD_SEPARATOR) -> DataFrame:
    """Inline path with a constant cost map (see :func:`cost_map`)."""
    best = "_best_costs"
    return (df.withColumn(best, dearest_option_costs(options_col, costs, sep))
            .withColumn(out, cost_from_best(options_col, qty_col, best, amortize))
            .drop(best))


def multiselect_cost(df: DataFrame, options_col: str, qty_col: str, dim: DataFrame,
                     key: str = "method", primary: str = "upfront",
                     secondary: str = "per_use", amortize: float = DAYS_PER_YEAR,
                     out: str = "brewing_cost", sep: str = METHOD_SEPARATOR,
                     inline_max_rows: int = INLINE_MAX_ROWS) -> DataFrame:
    """Add ``out`` = cost of the dearest option (O-32), one row per input row;
    0 when the answer is null (the original analysis' null guard).

    The cost table is inlined when it has at most ``inline_max_rows`` rows
    (checked with a bounded ``limit`` collect), else joined; both give the
    same rows.  A null option in the table is ignored, a null cost counts as
    0, a repeated option is refused.
    """
    dim = dim.filter(F.col(key).isNotNull()).select(
        F.col(key), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in (primary, secondary)])
    rows = _bounded_rows(dim, inline_max_rows)
    if rows is not None:
        if len(rows) != len({r[0] for r in rows}):
            raise ValueError(f"cost table has repeated {key!r} values; one cost per option")
        costs = cost_map({r[0]: (r[1], r[2]) for r in rows})
        return multiselect_cost_inline(df, options_col, qty_col, costs, amortize, out, sep)
    dup = dim.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"cost table has repeated {key!r} values (e.g. {dup[0][key]!r})")
    return multiselect_cost_join(df, options_col, qty_col, dim, key, primary, secondary,
                                 amortize, out, sep)


def cost_map(table: Mapping[str, tuple[float, float]]) -> Column:
    """Constant ``map<string, struct<p double, s double>>`` of a small table."""
    items = []
    for k, (p, s) in table.items():
        items += [F.lit(k), F.struct(F.lit(float(p)).alias("p"), F.lit(float(s)).alias("s"))]
    return F.create_map(*items)


def dearest_option_costs(options_col: str, costs: Column, sep: str = METHOD_SEPARATOR) -> Column:
    """Costs (struct p, s) of the option with the highest primary cost; the
    first option wins ties and unknown options score 0 (Python ``max`` with a
    ``dict.get(m, 0)`` key).  Null costs when the winner is unknown."""
    scored = F.transform(split_multiselect(options_col, sep), lambda m, i: F.struct(
        F.coalesce(costs[m]["p"], F.lit(0.0)).alias("score"),
        (-i).alias("neg_pos"),
        costs[m].alias("costs")))
    return F.array_max(scored)["costs"]


def cost_from_best(options_col: str, qty_col: str, best_col: str,
                   amortize: float = DAYS_PER_YEAR) -> Column:
    """primary / amortize + secondary * quantity; 0 for a null answer."""
    best = F.col(best_col)
    cost = (F.coalesce(best["p"], F.lit(0.0)) / F.lit(float(amortize))
            + F.coalesce(best["s"], F.lit(0.0)) * F.col(qty_col))
    return F.when(F.col(options_col).isNull(), F.lit(0.0)).otherwise(cost)


def multiselect_cost_join(df: DataFrame, options_col: str, qty_col: str, dim: DataFrame,
                          key: str, primary: str, secondary: str, amortize: float,
                          out: str, sep: str) -> DataFrame:
    """Path for large cost tables.  The winning option depends on the answer
    alone, so each *distinct* answer is exploded and priced once (the table is
    broadcast while a count shows it is small, else shuffled), and the rows
    get their answer's result back by a left join: no row key is needed and
    no rows are merged."""
    text, best = "_cost_answer", "_best_costs"
    answers = df.select(F.col(options_col).alias(text)).filter(F.col(text).isNotNull()).distinct()
    options = answers.select(text, F.posexplode(split_multiselect(text, sep)).alias("_pos", "_opt"))
    costs = dim.select(F.col(key).alias("_opt"), F.struct(F.col(primary).alias("p"),
                                                          F.col(secondary).alias("s")).alias("_c"))
    scored = join_per_group(options, costs, ["_opt"], how="left")
    won = scored.groupBy(text).agg(F.max_by(
        F.struct("_c"), F.struct(F.coalesce(F.col("_c.p"), F.lit(0.0)), -F.col("_pos"))).alias("_w"))
    won = won.select(text, F.col("_w._c").alias(best))
    rows = df.withColumn(text, F.col(options_col))
    return (join_per_group(rows, won, [text], how="left")
            .withColumn(out, cost_from_best(options_col, qty_col, best, amortize))
            .select(*df.columns, out))
