"""The two cleaned survey tables and the cost decision (O-34, O-35, O-36).

Each is one lazy DataFrame plan: pruned scan -> IsNotNull filters (pushed to
the scan) -> one projection holding every recode, cast and cost expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codebooks import (CUPS_CODEBOOK, DAYS_PER_MONTH, EQUIP_CODEBOOK,
                                   RESULT_OUTSIDE, SPEND_CODEBOOK)
from ..functions.expr import binary_label, cheaper_label, recode, result_label, strict_cast
from ..operators.cost import fixed_cost_map, multiselect_cost, multiselect_cost_inline
from ..operators.joins import complete_cases
from ..sources.survey_csv import write_csv


def cups_per_day(col: str = "cups", to: str = "int") -> F.Column:
    return strict_cast(recode(col, CUPS_CODEBOOK), to, name="cups")


def spend_per_day(col: str = "spend") -> F.Column:
    """Monthly band -> band centre (strict int) -> per day (O-08)."""
    return strict_cast(recode(col, SPEND_CODEBOOK), "int", name="spend") / F.lit(DAYS_PER_MONTH)


def equipment_cost(col: str = "equip") -> F.Column:
    return strict_cast(recode(col, EQUIP_CODEBOOK), "int", name="equip")


def _carry(survey: DataFrame, order_col: str | None) -> list[str]:
    return [order_col] if order_col and order_col in survey.columns else []


def cleaned_correlation(survey: DataFrame, key_unique: bool | None = None,
                        order_col: str | None = None) -> DataFrame:
    """(id, cup_assumptions double, spent_assumptions double) (O-35), plus
    ``order_col`` (the file order) when the survey has it."""
    carry = _carry(survey, order_col)
    cc = complete_cases(survey, "id", ["cups", "spend"], key_unique=key_unique, carry=carry)
    return cc.select("id", *carry, cups_per_day(to="double").alias("cup_assumptions"),
                     spend_per_day().alias("spent_assumptions"))


def cleaned_worth(survey: DataFrame, key_unique: bool | None = None,
                  cost_table: DataFrame | None = None, order_col: str | None = None) -> DataFrame:
    """(id, cup_assumptions int, spent_assumptions double, eq_assumptions int,
    brewing_cost double) (O-36), plus ``order_col`` when the survey has it."""
    carry = _carry(survey, order_col)
    cc = complete_cases(survey, "id", ["cups", "spend", "equip", "methods"], key_unique=key_unique,
                        carry=carry)
    recoded = cc.select("id", "methods", *carry,
                        cups_per_day().alias("cup_assumptions"),
                        spend_per_day().alias("spent_assumptions"),
                        equipment_cost().alias("eq_assumptions"))
    if cost_table is None:   # the fixed ten-method table: a constant map
        priced = multiselect_cost_inline(recoded, "methods", "cup_assumptions", fixed_cost_map())
    else:
        priced = multiselect_cost(recoded, "methods", "cup_assumptions", cost_table,
                                  out="brewing_cost")
    return priced.select("id", *carry, "cup_assumptions", "spent_assumptions", "eq_assumptions",
                         "brewing_cost")


def decision(worth: DataFrame) -> DataFrame:
    """Outside cost, the two labels and the 0/1 class (O-09..O-12, O-34).
    Outside cost multiplies cups/day by the daily *total* spend, as the
    original analysis does."""
    outside = (F.col("cup_assumptions") * F.col("spent_assumptions")).alias("outside_cost")
    d = worth.select("*", outside)
    return d.select("*",
                    result_label("outside_cost", "brewing_cost").alias("result"),
                    cheaper_label("outside_cost", "brewing_cost").alias("cheaper_option")
                    ).withColumn("label", binary_label("result", RESULT_OUTSIDE))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Category frequencies, most frequent first, ties by label (O-25)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)))


def cheaper_option_counts(survey: DataFrame, key_unique: bool | None = None) -> DataFrame:
    """The headline result: how many respondents find each option cheaper."""
    return value_counts(decision(cleaned_worth(survey, key_unique=key_unique)), "cheaper_option")


def export_correlation(survey: DataFrame, path: str, key_unique: bool | None = None) -> None:
    """Write the cleaned correlation table as CSV (O-02); the daily spend is
    written as text of the double, as the original export does (O-15)."""
    df = cleaned_correlation(survey, key_unique=key_unique)
    write_csv(df.select("id", F.col("cup_assumptions").cast("int").cast("string")
                        .alias("cup_assumptions"),
                        F.col("spent_assumptions").cast("string").alias("spent_assumptions")),
              path)


def export_worth(survey: DataFrame, path: str, key_unique: bool | None = None) -> None:
    """Write the cleaned worth table as CSV (O-02)."""
    write_csv(cleaned_worth(survey, key_unique=key_unique), path)
