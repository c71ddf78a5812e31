"""Column-level building blocks (all JVM-side expressions, no Python UDFs).

Each function returns a ``Column`` so it composes inside one codegen'd
projection: recoding, strict casts, NA tokens, labels, multi-select splitting,
literal lookups and a first-wins argmax over an array.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codebooks import (CHEAPER_HOME, CHEAPER_OUTSIDE, PANDAS_NA_TOKENS,
                        RESULT_INSIDE, RESULT_OUTSIDE)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------- nulls

def na_tokens_to_null(col: str | Column, tokens: Iterable[str] = PANDAS_NA_TOKENS) -> Column:
    """Text equal to one of ``tokens`` becomes null (pandas ``read_csv`` rule)."""
    c = _c(col)
    return F.when(~c.isin(list(tokens)), c)


def null_guard(test: str | Column, expr: Column, default: float = 0.0) -> Column:
    """``expr`` where ``test`` is not null, else ``default`` (O-17)."""
    return F.when(_c(test).isNull(), F.lit(default)).otherwise(expr)


# -------------------------------------------------------------------- recode

def check_recode_chain(mapping: Mapping[str, str]) -> None:
    """A chain of "replace k by v" steps equals one CASE only if no output
    value is also an input key (otherwise a later step rewrites an earlier
    result)."""
    clash = set(mapping) & set(mapping.values())
    if clash:
        raise ValueError(f"recode chain is order dependent; values reused as keys: {sorted(clash)}")


def recode(col: str | Column, mapping: Mapping[str, str], unmatched: str = "pass",
           name: str = "value") -> Column:
    """Replace exact labels by values in a single CASE (O-19).

    unmatched: ``"pass"`` keeps the original text (as the original analysis does),
    ``"null"`` gives null, ``"error"`` fails the job naming the label.
    """
    check_recode_chain(mapping)
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    if expr is None:
        return c
    if unmatched == "pass":
        return expr.otherwise(c)
    if unmatched == "null":
        return expr
    if unmatched == "error":
        bad = F.raise_error(F.concat(F.lit(f"unknown label for {name}: "), c))
        return expr.when(c.isNull(), F.lit(None)).otherwise(bad.cast("string"))
    raise ValueError(f"unmatched must be pass, null or error, not {unmatched!r}")


def strict_cast(col: str | Column, to: str, name: str = "value",
                on_error: str = "error") -> Column:
    """Cast text to a number; malformed text fails the job (O-13, O-16).

    ``int`` accepts only integer text (``'2.0'`` is an error, as Python's
    ``int()`` decides).  Independent of the session's ANSI setting because it
    goes through ``try_cast`` and raises explicitly.  ``on_error="null"``
    is the lenient form.
    """
    c = _c(col)
    cast = c.try_cast(to)
    if on_error == "null":
        return cast
    if on_error != "error":
        raise ValueError("on_error must be 'error' or 'null'")
    bad = F.raise_error(F.concat(F.lit(f"cannot cast {name} to {to}: "), c.cast("string")))
    return F.when(c.isNotNull() & cast.isNull(), bad.cast(to)).otherwise(cast)


# -------------------------------------------------------------------- labels

def result_label(outside: str | Column, brewing: str | Column) -> Column:
    """``outside`` when outside cost is strictly higher, else ``inside`` (O-10)."""
    return F.when(_c(outside) > _c(brewing), F.lit(RESULT_OUTSIDE)).otherwise(F.lit(RESULT_INSIDE))


def cheaper_label(outside: str | Column, brewing: str | Column) -> Column:
    """Display label; strict ``<``, a tie counts as home (O-11)."""
    return (F.when(_c(outside) < _c(brewing), F.lit(CHEAPER_OUTSIDE))
            .otherwise(F.lit(CHEAPER_HOME)))


def binary_label(col: str | Column, positive: str) -> Column:
    """1 when equal to ``positive`` else 0 (O-12); not frequency-ordered like
    ``StringIndexer``."""
    return F.when(_c(col) == F.lit(positive), F.lit(1)).otherwise(F.lit(0))


# ----------------------------------------------------------------- numerics

def safe_sqrt(col: str | Column) -> Column:
    """Square root, null for negative input (Python would raise) (O-29)."""
    c = _c(col)
    return F.when(c >= 0, F.sqrt(c))


# -------------------------------------------------------------- multiselect

def split_multiselect(col: str | Column, sep: str = ", ") -> Column:
    """Split a multi-select answer into its options, keeping empty trailing
    options like Python's ``str.split`` (O-28).  ``sep`` is literal text."""
    return F.split(_c(col), "\\Q" + sep + "\\E", -1)


def literal_map(mapping: Mapping[str, float]) -> Column:
    """A constant ``map<string,double>`` for small lookup tables."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(float(v))]
    return F.create_map(*items)


def lookup(key: str | Column, mapping: Column, default: float = 0.0) -> Column:
    """``dict.get(key, default)`` against a map column (O-22)."""
    return F.coalesce(mapping[_c(key)], F.lit(default))


def first_argmax(options: Column, score_map: Column, default: float = 0.0) -> Column:
    """The option with the highest looked-up score; the first one wins ties
    (Python ``max(key=...)``) (O-27).  Null for a null array."""
    scored = F.transform(options, lambda m, i: F.struct(
        F.coalesce(score_map[m], F.lit(default)).alias("score"),
        (-i).alias("neg_pos"),
        m.alias("option")))
    return F.array_max(scored)["option"]


# ------------------------------------------------------------ keyed random

def _unit_from_hex(hex8: Column) -> Column:
    """8 hex digits -> a uniform value strictly inside (0, 1)."""
    return (F.conv(hex8, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 32))


def keyed_normal(key: str | Column, seed: int | str = 0) -> Column:
    """A standard normal draw determined by (seed, key): Box-Muller on two
    uniforms taken from md5(seed:key).  Unlike ``randn`` it does not depend
    on partitioning, so a recomputed or repartitioned table gets the same
    values, and SQL engines can reproduce it."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
    u1 = _unit_from_hex(F.substring(h, 1, 8))
    u2 = _unit_from_hex(F.substring(h, 9, 8))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * 3.141592653589793) * u2)
