"""The corpus pipeline: stages, their effect, and the guard of the entry."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from questa.llm import secrets
from questa.llm.common import ready, stored

from .test_operators import PATH, PATTERN, brute_fingerprint, encoder, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    ready(spark)
    rng = random.Random(4)
    item = prose(random.Random(77), 40)
    docs = [(i, prose(rng, rng.randint(30, 120)), "en", "s") for i in range(60)]
    docs += [(100, docs[0][1], "en", "s"), (101, docs[1][1].upper(), "en", "s"), (102, "12 34 !!", "en", "s"), (103, None, None, None),
             (104, prose(rng, 30) + " " + item + " " + prose(rng, 30), "en", "s"), (105, prose(rng, 40) + " token = abcdef123456 ok", "en", "s")]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(*d, len(d[1]) if d[1] else None) for d in docs], SCHEMA).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), docs


def test_run_equals_brute_force(spark, folder):
    path, docs = folder
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    gone = {100, 101, 102, 103, 104}
    seen = {}
    for d, t, *_ in docs:
        if t and d not in gone:
            assert all((brute_fingerprint(t) ^ f).bit_count() > 3 for f in seen.values())
            seen[d] = brute_fingerprint(t)
    assert set(got) == {d for d, *_ in docs} - gone
    enc = encoder()
    for d, t, *_ in docs:
        if d in got:
            t = re.sub("token = abcdef123456", "[secret]", t)
            ids = np.array(enc.encode_ordinary(t), "<u4")
            assert got[d].n_tokens == len(ids) and got[d].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
            assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert PATH and PATTERN


def test_stages_keep_columns_and_take_empty_tables(spark, folder):
    path, _ = folder
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, path)
        assert out.count() == 0
        assert name == "byte_bpe" or out.columns == empty.columns


def test_a_task_of_the_last_stage_holds_one_python_worker(spark, folder):
    path, docs = folder
    out = corpus_pipeline.encode_tokens(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\b(?:ArrowEvalPython|MapInPandas|BatchEvalPython)\b", plan)) == 1
    assert out.count() == len(docs)


def test_the_last_stage_reads_its_rows_once_and_writes_none(spark, folder, monkeypatch):
    path, docs = folder
    stores = []
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, name: stores.append(name) or stored(df, name))
    out = corpus_pipeline.encode_tokens(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not stores and plan.count("FileScan") == 1 and f"{path}/documents.parquet"[:40] in plan
    assert {r.doc_id for r in out.collect()} == {d[0] for d in docs}


def test_entry_registers_every_operator():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if re.match(r"op\d+_", x)} and "pipeline" in names


def test_rows_without_an_id_are_judged_like_any_other(spark, folder):
    path, docs = folder
    item, leak = prose(random.Random(77), 40), dict((d, t) for d, t, *_ in docs)[104]
    assert item in leak
    null = lambda *texts: spark.createDataFrame([(None, t, "en", "s", len(t)) for t in texts], SCHEMA)
    out = corpus_pipeline.redact_secrets(spark, null("a secret=abcdefgh", "é token=abcdef12 z"), path)
    assert sorted((r.text, r.n_chars) for r in out.collect()) == [("a [secret]", 10), ("é [secret] z", 12)]
    assert [r.text for r in corpus_pipeline.drop_contaminated(spark, null(leak, docs[3][1]), path).collect()] == [docs[3][1]]
    assert [r.text for r in corpus_pipeline.drop_near_duplicates(spark, null(*[docs[3][1]] * 3), path).collect()] == [docs[3][1]]


def test_rows_that_share_an_id_are_judged_one_by_one(spark, folder):
    path, docs = folder
    texts = [docs[i][1] for i in range(4)]
    make = lambda rows: spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], SCHEMA)
    out = corpus_pipeline.redact_secrets(spark, make([(7, "token=abcdef12 a"), (7, "b is here token=abcdef12"), (7, "c")]), path)
    assert sorted(r.text for r in out.collect()) == ["[secret] a", "b is here [secret]", "c"]
    rows = [(1, texts[0]), (1, texts[0]), (2, texts[0]), (2, texts[1]), (3, texts[1]), (None, texts[1]), (None, texts[2])]
    out = corpus_pipeline.drop_near_duplicates(spark, make(rows), path)
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == sorted([(1, texts[0]), (2, texts[1]), (0, texts[2])])
    leak = dict((d, t) for d, t, *_ in docs)[104]
    out = corpus_pipeline.drop_contaminated(spark, make([(5, leak), (5, texts[3])]), path)
    assert [r.text for r in out.collect()] == [texts[3]]
    found = secrets.find_secrets(make([(7, "token=abcdef12 a"), (7, "c")]))
    with pytest.raises(Exception, match="repeated doc_id"):
        secrets.redact(make([(7, "token=abcdef12 a"), (7, "c")]), found).collect()


def test_extra_columns_of_any_name_pass_every_stage(spark, folder):
    path, docs = folder
    extra = ("score", "lang_pred", "_doc_row", "judged", "_text", "_id", "_order", "component_id", "spans", "_k", "_spans", "row")
    schema = SCHEMA + "".join(f", {c} string" for c in extra)
    table = spark.createDataFrame([(*d, len(d[1]) if d[1] else None, *extra) for d in docs], schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, path)
        assert out.count() > 0
        if name != "byte_bpe":
            assert out.columns == table.columns and [tuple(r) for r in out.select(*extra).distinct().collect()] == [extra]
