"""Quality rules with risk-controlled thresholds, DataFrame functions only.

The base rules need no data.  Further rules measure a share of each text on a
grid of LEVELS steps and reject what reaches a cutoff.  Cutoffs are certified on
labelled holdouts.  For each stratum and rule they are tried in a fixed order, from
the highest down: the good texts that a cutoff would reject are counted, and it
stands if an exact binomial bound says that the chance of a false rejection is below
ALPHA / rules; at the first that fails the sequence ends.  A fixed sequence needs no
correction for the cutoffs in it, so each has confidence DELTA / (strata * rules)
(Bonferroni over the sequences).  So with probability 1 - DELTA every stratum loses
less than ALPHA of its good texts to all rules together.  Among certified cutoffs a
rule takes the one that rejects the most bad texts beyond good ones (of equal ones
the highest), or none.  With four strata some 1,850 good texts without a false
rejection suffice.  Labels of all rows count; what is collected nowhere grows with
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.special import beta_inc
from ..operators.joins import join_per_group
from .common import stored, text_of

SPACES = r"[\x20\x09-\x0D]+"
ALPHA = 0.02
DELTA = 0.05
LEVELS = 50
#: Rules: (name, what is measured); a text is rejected from a cutoff upwards.
RULES = ("symbols", "dup_lines", "repeats", "long_words", "capitals", "exclaims")


def base_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, *carry, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_capitals, n_exclaims, base_failed) of every
    row's whole text (null: empty)."""
    t = F.col("_text")
    rows = docs.select(docs[key].alias("_id"), *[docs[c].alias(f"_c_{c}") for c in carry],
                       text_of(docs, text).alias("_text"))
    line_words = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns({
        "_words": F.filter(F.split(t, SPACES), lambda w: w != ""),
        "_lines": line_words,
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_capitals": F.regexp_count(t, F.lit("[A-Z]")).cast("long"),
        "n_exclaims": F.regexp_count(t, F.lit("!")).cast("long"),
        "word_chars": F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long"),
    }).drop("_text")
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_grams": F.when(F.size("_words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))),
    }).drop("_words", "_lines")
    rows = rows.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"),
        F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))).drop("_grams")
    # windows whose hash stands beside an equal one, by place
    twice = F.filter("_sorted", lambda s, k: (F.get("_sorted", k - 1)["g"] == s["g"]).eqNullSafe(True)
                     | (F.get("_sorted", k + 1)["g"] == s["g"]).eqNullSafe(True))
    rows = rows.withColumn("_at", F.sort_array(F.transform(twice, lambda s: s["i"]))).drop("_sorted")
    covered = F.aggregate(F.col("_at"), F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
                          lambda s, i: F.struct((i + 3).alias("end"), (s["n"] + F.least(F.lit(3), i + 3 - s["end"])).alias("n")),
                          lambda s: s["n"])
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_at")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(F.col("_id").alias(key), *[F.col(f"_c_{c}").alias(c) for c in carry], "n_words", "word_chars",
                       "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_exclaims",
                       failed.alias("base_failed"))


def levels() -> Column:
    """The rules' measures on the grid 0..LEVELS, in the order of RULES."""
    def on_grid(top: Column, bottom: Column, full: float) -> Column:
        share = F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
        return F.least(F.lit(LEVELS), F.floor(share * (LEVELS / full) + 1e-9)).cast("int")
    c = F.col
    return F.array(on_grid(c("n_symbols"), c("n_words"), 2.0), on_grid(c("n_dup_lines"), c("n_lines"), 1.0),
                   on_grid(c("n_repeat_words"), c("n_words"), 1.0), on_grid(c("word_chars"), c("n_words"), 25.0),
                   on_grid(c("n_capitals"), c("word_chars"), 1.0), on_grid(c("n_exclaims"), c("n_words"), 2.0))


def binomial_cdf(k: Column, n: Column, p: Column) -> Column:
    """P(X <= k) for X ~ Binomial(n, p)."""
    k, n, p = k.cast("double"), n.cast("double"), p.cast("double")
    return F.when(k < 0, F.lit(0.0)).when(k >= n, F.lit(1.0)).otherwise(beta_inc(n - k, k + 1, 1 - p, p))


def certified(seen: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(_s, rule, cut): the cutoff of each stratum and rule that has one.  ``seen``
    (_s, rule, level, good, bad): labelled texts of each kind by level.

    The counts of rejected good texts only grow down the sequence, and the bound
    with them: what passes the bound is what stands before the first failure.
    Levels that no text has change nothing, so they need no row."""
    # a cutoff rejects all levels from it on: sums over at most LEVELS + 1 rows
    up = W.partitionBy("_s", "rule").orderBy(F.desc("level"))
    whole = W.partitionBy("_s", "rule")
    tried = seen.select("_s", "rule", "level", F.sum("good").over(up).alias("k"), F.sum("bad").over(up).alias("hits"),
                        F.sum("good").over(whole).alias("n")).filter("level > 0 AND hits > k AND n > 0")
    strata = seen.select("_s").distinct().count()  # a number: sequences are strata x rules
    bound = binomial_cdf(F.col("k"), F.col("n"), F.lit(alpha / len(RULES)))
    held = tried.filter(bound <= delta / max(1, strata * len(RULES)))
    return held.groupBy("_s", "rule").agg(F.max_by("level", F.struct(F.col("hits") - F.col("k"), F.col("level"))).alias("cut"))


def cutoffs(counts: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang",
            quality: str = "quality") -> DataFrame:
    """(stratum, cuts): certified cutoffs per stratum, an array in the order of
    RULES (null: none).  ``counts`` as base_counts gives it, with the stratum;
    ``labels`` (key, quality): 1 good, 0 bad, null and conflicting labels of a
    key left out.  A null stratum is a stratum.  Without labels: no rows."""
    label = (labels.filter(F.col(key).isNotNull() & F.col(quality).isNotNull()).groupBy(F.col(key).alias("_k"))
             .agg(F.min(quality).alias("lo"), F.max(quality).alias("hi")).filter("lo = hi")
             .select("_k", (F.col("lo") == 1).alias("good")))
    rows = counts.filter(~F.col("base_failed")).select(F.col(key).alias("_k"), F.col(stratum).alias("_s"),
                                                       levels().alias("lv")).join(label, "_k")
    seen = (rows.select("_s", "good", F.posexplode("lv").alias("rule", "level")).groupBy("_s", "rule", "level")
            .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")))
    best = certified(seen)
    pick = [F.max(F.when(F.col("rule") == i, F.col("cut"))) for i in range(len(RULES))]
    return best.groupBy("_s").agg(F.array(*pick).alias("cuts")).withColumnRenamed("_s", stratum)


def judge(counts: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """``counts`` with ``rule`` (the first rule that rejects, else null) and
    ``kept``: not base_failed and no rule rejects."""
    marked = counts.withColumn("_s", F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("")))
    table = cuts.select(F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("")).alias("_s"), "cuts")
    joined = join_per_group(marked, table, ["_s"], how="left")
    over = F.transform(F.arrays_zip(levels().alias("v"), F.col("cuts")), lambda z: F.coalesce(z["v"] >= z["cuts"], F.lit(False)))
    names = F.array(*[F.lit(r) for r in RULES])
    first = F.array_position(F.coalesce(over, F.array(F.lit(False))), True)
    rule = F.when(first > 0, F.get(names, (first - 1).cast("int")))
    return joined.withColumn("rule", rule).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()).drop("_s", "cuts")


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
            stratum: str = "lang") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, rule, kept), one row per row of ``docs``; cutoffs from
    ``labels`` (see :func:`cutoffs`).  Null texts count as empty, very long ones
    are measured whole, an empty table gives an empty result, repeated rows and
    null keys are judged like any row."""
    counts = stored(base_counts(docs, key, text, (stratum,)), "quality")
    out = judge(counts, cutoffs(counts, labels, key, stratum), stratum)
    return out.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "rule", "kept")
