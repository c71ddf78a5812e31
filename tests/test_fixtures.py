"""The survey derived from the sf0.01 tables has the figures FIXTURES §C
publishes for it."""

import os

import pytest
from pyspark.sql import functions as F

from questa.operators.joins import complete_cases
from questa.operators.order import hash_split
from questa.sources.tables import derived_survey

SF001 = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF001), reason="sf0.01 tables not present")
def test_derived_survey_matches_fixture_figures(spark):
    s = derived_survey(spark, SF001)
    row = s.agg(F.count(F.lit(1)).alias("n"), F.count("cups").alias("cups"),
                F.count("spend").alias("spend"), F.count("equip").alias("equip"),
                F.count("methods").alias("methods"),
                F.countDistinct("methods").alias("distinct_methods")).first()
    assert tuple(row) == (15000, 11980, 15000, 13157, 14743, 255)
    cc = complete_cases(s, "id", ["cups", "spend", "equip", "methods"])
    assert cc.count() == 10354
    counts = {r.methods: r["count"] for r in s.groupBy("methods").count().collect()}
    assert counts["Coffee extract (e.g. Cometeer), Siphon"] == 139
    assert counts["Instant coffee, Siphon"] == 112
    assert counts["Coffee extract (e.g. Cometeer), Instant coffee"] == 92
    assert counts["Siphon"] == 206
    kept = hash_split(s, "id", 0.75, salt="s").filter(F.col("split") == "train").count()
    assert kept == 11357
