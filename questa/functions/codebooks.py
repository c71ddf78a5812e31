"""Codebooks, cost tables and labels of the coffee survey.

Everything in the block below is a FIXED VALUE: it must equal the values the
original analysis used, or the cleaned tables and every number computed from
them change.  They are written out plainly, in the order the analysis lists
them.  Nothing else in the library hard-codes survey content.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (survey questions, codebooks, cost tables, labels, constants)
# ---------------------------------------------------------------------------

QUESTION_ID = "Submission ID"
QUESTION_CUPS = "How many cups of coffee do you typically drink per day?"
QUESTION_SPEND = "In total, much money do you typically spend on coffee in a month?"
QUESTION_EQUIP = "Approximately how much have you spent on coffee equipment in the past 5 years?"
QUESTION_METHODS = "How do you brew coffee at home?"

# cups per day: band label -> numeric text; other labels (digits) pass through
CUPS_CODEBOOK = {
    "Less than 1": "0",
    "More than 4": "5",
}

# money spent on coffee per month: band label -> band centre (dollars)
SPEND_CODEBOOK = {
    "<$20": "10",
    "$20-$40": "30",
    "$40-$60": "50",
    "$60-$80": "70",
    "$80-$100": "90",
    ">$100": "150",
}

# equipment spend over the past 5 years: band label -> assumed dollars
EQUIP_CODEBOOK = {
    "More than $1,000": "1250",
    "$500-$1000": "750",
    "$300-$500": "400",
    "$100-$300": "200",
    "$50-$100": "75",
    "$20-$50": "35",
    "Less than $20": "10",
}

# brew method -> upfront equipment cost (dollars); "Other" is replaced by the
# mean of the other entries before use
METHOD_UPFRONT_COST = {
    "Espresso": 289.99,
    "Coffee brewing machine (e.g. Mr. Coffee)": 190.85,
    "Coffee extract (e.g. Cometeer)": 0,
    "Pod/capsule machine (e.g. Keurig/Nespresso)": 89.99,
    "Pour over": 48.84,
    "French press": 32.99,
    "Cold brew": 59.98,
    "Instant coffee": 0,
    "Bean-to-cup machine": 199.87,
    "Other": 0,
}

# brew method -> additional cost per cup (dollars); "Other" as above
METHOD_PER_USE_COST = {
    "Espresso": 0.4975,
    "Coffee brewing machine (e.g. Mr. Coffee)": 0.4975,
    "Coffee extract (e.g. Cometeer)": 5.6475,
    "Pod/capsule machine (e.g. Keurig/Nespresso)": 0.893,
    "Pour over": 1.30875,
    "French press": 0.4975,
    "Cold brew": 0.4975,
    "Instant coffee": 0.076,
    "Bean-to-cup machine": 0.4975,
    "Other": 0,
}

OTHER_KEY = "Other"
METHOD_SEPARATOR = ", "
DAYS_PER_MONTH = 30
DAYS_PER_YEAR = 365

RESULT_OUTSIDE = "outside"
RESULT_INSIDE = "inside"
CHEAPER_OUTSIDE = "Buying Outside is Cheaper"
CHEAPER_HOME = "Brewing at Home is Cheaper"

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

# Tokens a pandas CSV reader turns into missing values by default (public
# pandas behaviour).  Spark's CSV reader only maps one token, so the survey
# reader applies this list itself.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Short column names used inside the library, and the question each stands for.
SHORT_NAMES = {
    "id": QUESTION_ID,
    "cups": QUESTION_CUPS,
    "spend": QUESTION_SPEND,
    "equip": QUESTION_EQUIP,
    "methods": QUESTION_METHODS,
}
