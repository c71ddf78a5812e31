"""Property tests: the multi-select cost (both paths) and the recode against
a direct Python statement of their semantics, on generated answers."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from questa.functions.codebooks import METHOD_PER_USE_COST, METHOD_UPFRONT_COST, SPEND_CODEBOOK
from questa.functions.expr import recode
from questa.operators.cost import fill_other, fixed_cost_table, multiselect_cost

UP, PU = fill_other(METHOD_UPFRONT_COST), fill_other(METHOD_PER_USE_COST)
OPTIONS = list(METHOD_UPFRONT_COST) + ["Siphon", "", "Aeropress"]


def model_cost(answer, cups):
    if answer is None:
        return 0.0
    opts = answer.split(", ")
    best = opts[0]
    for o in opts[1:]:
        if UP.get(o, 0) > UP.get(best, 0):
            best = o
    return UP.get(best, 0) / 365 + PU.get(best, 0) * cups


answers = st.one_of(st.none(), st.lists(st.sampled_from(OPTIONS), min_size=1, max_size=5)
                    .map(", ".join))
rows = st.lists(st.tuples(answers, st.integers(0, 6)), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows)
def test_multiselect_cost_matches_model(spark, rows):
    data = [(str(i), a, c) for i, (a, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "id string, methods string, cups int")
    dim = fixed_cost_table(spark)
    inline = {r.id: r.brewing_cost for r in
              multiselect_cost(df, "methods", "cups", dim).collect()}
    joined = {r.id: r.brewing_cost for r in
              multiselect_cost(df, "methods", "cups", dim, inline_max_rows=0).collect()}
    for i, a, c in data:
        want = model_cost(a, c)
        assert abs(inline[i] - want) < 1e-9
        assert abs(joined[i] - want) < 1e-9


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(labels=st.lists(st.one_of(st.none(), st.sampled_from(list(SPEND_CODEBOOK) + ["x", "$5"])),
                       min_size=1, max_size=20))
def test_recode_passes_unmatched_through(spark, labels):
    df = spark.createDataFrame([(v,) for v in labels], "c string")
    got = [r[0] for r in df.select(recode("c", SPEND_CODEBOOK)).collect()]
    assert got == [SPEND_CODEBOOK.get(v, v) if v is not None else None for v in labels]
