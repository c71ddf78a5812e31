"""Filter audit, license scans and source divergence against brute force, and on
awkward rows: nulls, empty and very long texts, repeated rows and ids, empty tables,
columns with clashing names."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from questa.llm import divergence, filteraudit, licenses, tries
from questa.llm.common import ready

DOCS = ("doc_id long, text string, lang string, source string, row long, id long, part string, mask string, n long, "
        "words string, hash long, place int, template int, term string, value long, item string, rank int, bucket int")
LABELS = "doc_id long, quality int, toxic int, good int, id string"


@pytest.fixture(scope="module", autouse=True)
def session(spark):
    ready(spark)


def make_docs(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 14) for r in rows], DOCS)


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]


AWKWARD = [(1, None, None, None), (2, "", "en", ""), (3, " \n\t ", "en", "a"), (4, "x", None, "b"), (4, "x", None, "b"),
           (None, "x", "en", None), (None, "x", "en", "c"), (5, "漢字 🙂 \x00 É é" * 30, "de", "a"),
           (6, "a" * 70_000, "en", "a"), (7, "12 34 !!", "en", "a"), (4, "other text of a repeated id", "en", "b")]


# ------------------------------------------------------------------- tries

def test_tries_hold_each_key_once_in_byte_order():
    rng = random.Random(1)
    keys = {bytes(rng.choices(b"ab\x00\xff", k=rng.randint(0, 9))) for _ in range(400)} | {b"a" * n for n in range(30)}
    keys |= {b"z" * 5000 + bytes([i]) for i in range(20)}
    trie = tries.Trie()
    for _ in range(2):
        for i, key in enumerate(sorted(keys, key=hash)):
            held = trie.insert(key)
            held[key] = held.get(key, 0) + 1
    found = list(trie.terminals())
    assert [k for k, _, _ in found] == sorted(keys)
    assert all(held == {key: 2} for key, _, held in found)
    for (a, _, _), (b, same, _) in zip(found, found[1:]):
        assert a[:same] == b[:same] and (same == len(a) or a[same] != b[same])


def test_cuts_split_texts_behind_a_common_beginning(spark, monkeypatch):
    texts = [b"shared beginning " * 40 + str(i).encode() * 30 for i in range(300)] + [b"same"] * 50
    bounds = tries.prefix_cuts(spark.createDataFrame([(bytearray(t),) for t in texts], "t binary").repartition(4))
    dealt = Counter(tries.bucket_of(bounds, t) for t in texts[:300])
    assert bounds == sorted(set(bounds)) and len(dealt) >= 4 and max(dealt.values()) < 150


# ------------------------------------------------------------------- audit

def brute_masks(rows):
    first = {}
    for i, text, *_ in rows:
        key = float("inf") if i is None else i
        first[text or ""] = min(key, first.get(text or "", key))
    out = []
    for i, text, lang, _ in rows:
        text = text or ""
        w = words_of(text)
        mask = (("A" if len(w) < 100 else "") + ("B" if 100 * len(set(w)) < 80 * len(w) else "")
                + ("C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else "")
                + ("D" if re.search("[#$%&*|]", text) else "")
                + ("E" if (float("inf") if i is None else i) > first[text] else ""))
        out.append((i, lang or "", mask))
    return out


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    masks = brute_masks(rows)
    want = {}
    for part in {p for _, p, _ in masks}:
        shapley = Counter()
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                left = [(i, m) for i, p, m in masks if p == part and not set(m) & set(order[:step - 1])]
                gone = [i for i, m in left if letter in m]
                shapley[letter] += len(gone)
                want[part, "".join(order), step] = (
                    len(left) - len(gone), len(gone), sum(p == part and letter in m and bool(set(m) & set(order[:step - 1]))
                                                          for _, p, m in masks),
                    sum(p == part and m == letter for _, p, m in masks), sum(i in good for i in gone),
                    sum(i in toxic for i in gone))
        for (p, order, step), row in list(want.items()):
            if p == part:
                want[p, order, step] = (*row[:6], shapley[order[step - 1]])
    return want


def test_audit_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(filteraudit, "TRIE_BYTES", 20_000)  # several tries a task
    rng = random.Random(5)
    word = lambda: rng.choice(["Abc", "de", "fgh", "IJ", "k|", "l#", "mno", "pq"]) + str(rng.randrange(60))
    texts = [" ".join(word() for _ in range(rng.choice([3, 99, 100, 101, 150]))) for _ in range(25)]
    rows = AWKWARD + [(rng.randint(8, 90), rng.choice(texts), rng.choice(["en", "de", None]), "s") for _ in range(150)]
    labels = [(rng.randint(1, 60), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)] + [(None, 1, 1)]
    docs = make_docs(spark, rows).repartition(3)
    masks = Counter()
    for r in filteraudit.filter_masks(docs).collect():
        masks[r.id, r.part, r["mask"]] += r.n
    assert masks == Counter(brute_masks(rows))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filteraudit.audit(
        docs, spark.createDataFrame([(*x, 5, "x") for x in labels], LABELS)).collect()}
    assert got == brute_audit(rows, labels)


def test_audit_of_empty_tables(spark):
    none, labels = make_docs(spark, []), spark.createDataFrame([], LABELS)
    assert filteraudit.audit(none, labels).count() == 0
    assert filteraudit.audit(make_docs(spark, AWKWARD), labels).agg(F.sum("good_lost"), F.count("*")).first() == (0, 1800)


# ---------------------------------------------------------------- licenses

def brute_places(words):
    return [(i, t.label) for t in licenses.PHRASES for i in range(len(words)) if words[i:i + len(t.words)] == t.words]


def license_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def test_base_places_match_brute_force_and_notices_are_found(spark):
    rng = random.Random(8)
    filler = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "of", "the", "İ", "licenKe", "x9"]
    rows = [*AWKWARD, (20, "Kind CC—BY, MIT\nLicense.", "en", ""), (21, "cc by " * 5000, "en", "")]
    rows += [(100 + i, " ".join(rng.choice(filler) for _ in range(rng.randint(0, 60))), "en", "") for i in range(60)]
    notices = {}
    for i, t in enumerate(licenses.NOTICES):
        words = t.text.split()
        if len(words) > 20:  # two words more and one word less
            words[5:5] = ["kindly", "and"]
            del words[-4]
        body = " ".join(rng.choice(filler[8:]) for _ in range(30))
        rows.append((300 + i, f"{body} {' '.join(words).upper()} {body}", "en", ""))
        notices[300 + i] = t.label
    got = Counter()
    for r in licenses.licenses(make_docs(spark, rows + rows[-1:])).collect():
        got[tuple(r)[:6]] += 1
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        if r.doc_id in notices:
            assert notices[r.doc_id] in r.labels.split(",") and r.score >= 0.8
        if r.n_base:
            assert r.score == 1.0
    want = Counter()
    for i, text, *_ in rows + rows[-1:]:
        words = license_words(text)
        at = sorted(brute_places(words))
        want[i, len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None,
             ",".join(sorted({label for _, label in at}))] += 1
    assert got == want
    assert licenses.licenses(make_docs(spark, [])).count() == 0


def test_far_apart_pieces_of_a_notice_are_no_span(spark):
    words = licenses.NOTICES[2].text.split()
    cut = len(words) // 2
    apart = " ".join(words[:cut] + ["far"] * 40 + words[cut:])
    first, near = licenses.licenses(make_docs(spark, [(1, apart, "en", ""), (2, " ".join(words), "en", "")])).orderBy("doc_id").collect()
    assert first.labels == "" and 0 < first.score < 0.8 and near.labels == "bsd" and near.score == 1.0
    with pytest.raises(ValueError, match="fewer than 2"):
        licenses.spans(make_docs(spark, []), templates=[licenses.Template("x", "one")])


# -------------------------------------------------------------- divergence

def brute_divergence(rows, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = Counter()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        share = {}
        for s in {s for g, s in groups if g == lang} | {None}:
            c = {t: sum(counts[lang, x][t] for g, x in groups if g == lang and s in (None, x)) for t in kept}
            total = sum(c.values()) + len(kept)
            share[s] = {t: (1 + 10 ** 9 * (n + 1) // total, n) for t, n in c.items()}
        mine = share[source]
        pairs = [(-sum((p - share[s][t][0]) ** 2 // share[s][t][0] for t, (p, _) in mine.items()), s.encode(), s)
                 for s in share if s is not None and s != source]
        terms = [(-((p - share[None][t][0]) ** 2 // share[None][t][0]), t.encode(), t)
                 for t, (p, n) in mine.items() if n and p > share[None][t][0]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            for rank, (value, _, item) in enumerate(found, 1):
                out[lang, source, part, item, -value, rank] += 1
    return out


@pytest.mark.parametrize("top, held", [(200, 500_000), (3, 1)])
def test_divergence_matches_brute_force(spark, monkeypatch, top, held):
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    rng = random.Random(top)
    words = ["Alpha", "beta", "Gamma", "étude", "漢字", "don't", "x1y", "zz", "Zz"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = AWKWARD + [(9 + i, " ".join(rng.choices(words, k=rng.randint(0, 25))), rng.choice(["en", "de", None]),
                       rng.choice(["a", "b", "c", "é", None])) for i in range(120)]
    rows += [(500, "alone", "xx", "a"), (501, "", "yy", "a"), (502, None, "yy", "b")]
    got = Counter(map(tuple, divergence.divergence(make_docs(spark, rows).repartition(3), top=top).collect()))
    assert got == brute_divergence(rows, top)
    assert divergence.divergence(make_docs(spark, [])).count() == 0


def test_blocks_of_whole_terms_give_the_same_sums(monkeypatch):
    import pyarrow as pa
    rng = random.Random(2)
    rows = sorted({(f"t{rng.randrange(60)}", rng.choice("ab"), f"s{rng.randrange(9)}"): (rng.randint(1, 10 ** 8), rng.randint(1, 99))
                   for _ in range(700)}.items())
    table = pa.table({"lang": [k[1] for k, _ in rows], "term": [k[0] for k, _ in rows], "source": [k[2] for k, _ in rows],
                      "p": [v[0] for _, v in rows], "p0": [v[1] for _, v in rows]})

    def sums(block, scatter):
        monkeypatch.setattr(divergence, "BLOCK_POSTINGS", block)
        monkeypatch.setattr(divergence, "SCATTER", scatter)
        out = Counter()
        for b in divergence._accumulate(iter(table.to_batches(max_chunksize=7))):
            for lang, source, item, value in zip(*(c.to_pylist() for c in b.columns)):
                out[lang, source, item] += value
        return {k: v for k, v in out.items() if v}
    want = Counter()
    gain = lambda p, q: (p - q) ** 2 // q
    for (t, lang, s), (p, p0) in rows:
        for (t2, lang2, s2), (q, q0) in rows:
            if (t, lang) == (t2, lang2) and s != s2:
                want[lang, s, s2] += gain(p, q) - gain(p, q0) - gain(p0, q) + gain(p0, q0)
    want = {k: v for k, v in want.items() if v}
    assert sums(10, 5) == sums(1 << 20, 1 << 20) == want


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(0, 1), (5, 7), (2 ** 40, 2 ** 41), (9 * 10 ** 17, 10 ** 18), (9_223_372_034, 9_223_372_037)]
    got = spark.createDataFrame(cases, "n long, total long").select(divergence.smoothed(F.col("n"), F.col("total"))).collect()
    assert [r[0] for r in got] == [1 + 10 ** 9 * (n + 1) // total for n, total in cases]
