"""The llm operators against brute force, and on awkward rows: nulls, empty
texts, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import random
import re
import time
from collections import Counter
from fractions import Fraction
from math import comb

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from questa.llm import bpe, common, decontam, graph, html, langid, quality, secrets, simhash, tokencounts, urlfilter, warc
from questa.llm.common import ready, without_ids
from questa.session import scratch_path

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
DOCS = "doc_id long, text string, lang string, fp long, ids string, base string, weak string, spans string"
WORDS = [a + b for a in ("ka", "lo", "mi", "ter", "un", "vos") for b in ("ra", "ne", "sti", "ol", "ux", "")]


@pytest.fixture(scope="module", autouse=True)
def session(spark):
    ready(spark)


def make_docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x", "x", "x", "x") for i, t, lang in rows], DOCS)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


AWKWARD = [(1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, "x", None), (4, "x", None), (None, "x", "en"),
           (5, "漢字 🙂 \x00 é" * 3, "de"), (6, "a" * 70_000, "en"), (7, "12 34 !!", "en")]


def rows_of(df):
    return Counter(map(tuple, df.collect()))


# ------------------------------------------------------------------ SimHash

def brute_fingerprint(text, n=3):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", t) if x]
    sh = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def test_fingerprints_and_components_match_brute_force(spark):
    rng = random.Random(3)
    rows, i = [*AWKWARD], 10
    for _ in range(25):
        text = prose(rng, rng.randint(1, 60))
        for _ in range(rng.randint(1, 4)):
            words = text.split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            rows.append((i, " ".join(words), "en"))
            i += 1
    got = simhash.near_duplicates(make_docs(spark, rows)).collect()
    fp = [brute_fingerprint(t) for _, t, _ in rows]
    parent = {f: f for f in fp}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    low = {}
    for (d, _, _), f in zip(rows, fp):
        if d is not None:
            low[root(f)] = min(d, low.get(root(f), d))
    want = Counter((d, f"{f:016x}", low.get(root(f))) for (d, _, _), f in zip(rows, fp))
    assert Counter(map(tuple, got)) == want
    assert simhash.near_duplicates(make_docs(spark, [])).count() == 0


@pytest.mark.parametrize("max_bits,width", [(0, 2), (1, 4), (3, 1), (3, 2), (3, 8), (5, 2)])
def test_links_are_complete(spark, max_bits, width):
    rng = random.Random(max_bits * 10 + width)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for _ in range(4):
            for _ in range(rng.randint(1, 4)):
                b ^= 1 << rng.randrange(64)
            fps.add(b)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    nodes = spark.createDataFrame(signed, "fp long").repartition(3)
    got = {frozenset((r.a % 2 ** 64, r.b % 2 ** 64)) for r in simhash.links(nodes, max_bits, width).collect()}
    want = {frozenset((a, b)) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= max_bits}
    assert got == want


def test_hot_keys_are_split_and_give_the_same_rows(spark, monkeypatch):
    rows = [(i, 7 if i % 3 else i) for i in range(90)] + [(90, None), (91, -5)]
    table = spark.createDataFrame(rows, "id long, k long")
    classes = table.filter("k IS NOT NULL AND k >= 0").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
    want = Counter((i, k, min(x for x, y in rows if y == k)) for i, k in rows if k is not None and k >= 0)
    for hot in (1, 2, 1024):  # none, the one that holds two thirds, all
        monkeypatch.setattr(common, "HOT", hot)
        assert rows_of(common.join_split(table, classes, "k", "n").select("id", "k", "low")) == want
    assert common.join_split(table.limit(0), classes.limit(0), "k", "n").count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 201)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# -------------------------------------------------------------- language ID

def test_language_id_is_accurate_and_total(spark):
    rng = random.Random(5)
    parts = {"aa": ["ka", "lo", "mi", "ter"], "bb": ["zu", "kei", "sch", "ung"], "cc": ["ción", "os", "arr", "ez"]}
    rows = [(i, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(2, 80))), lang)
            for i in range(400) for lang in [rng.choice(list(parts))]]
    docs = make_docs(spark, [(i + 100, t, lang) for i, t, lang in rows] + AWKWARD)
    got = langid.language_id(docs).collect()
    truth = {i + 100: lang for i, _, lang in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == docs.count() and len(held) > 80
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    pred = {r.doc_id: r.lang_pred for r in got}
    assert [pred[i] for i in (1, 2, 3, 7)] == ["und"] * 4 and pred[4] != "und"
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert langid.language_id(make_docs(spark, [])).count() == 0
    assert {r.lang_pred for r in langid.language_id(make_docs(spark, [(1, "abc", None)])).collect()} == {"und"}



def test_the_filter_grows_with_the_n_grams(spark, monkeypatch):
    rng = random.Random(9)
    many = [" ".join("".join(rng.choices("abcdefghijklm", k=7)) for _ in range(60)) for _ in range(80)]
    few = [" ".join(rng.choice(["nopq", "qrst", "tuvw"]) for _ in range(60)) for _ in range(80)]
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(t, "aa") for t in many for _ in (0, 1)] + [(t, "zz") for t in few])]
    model = langid.learn(make_docs(spark, rows), slots=1 << 10)
    assert model.false_rates().max() <= langid.FILL ** langid.HASHES * 1.05
    assert model.judge(few[:5] + many[:5])[0] == ["zz"] * 5 + ["aa"] * 5
    wide = [(1000 + i, few[0], f"l{i}") for i in range(140)]  # three words a slot
    broad = langid.learn(make_docs(spark, rows + wide), slots=1 << 10)
    assert broad.words.shape[1] == 3 and broad.judge(many[:5])[0] == ["aa"] * 5
    monkeypatch.setattr(langid, "FILTER_BYTES", 1 << 12)
    with pytest.raises(ValueError, match="need a filter of"):
        langid.learn(make_docs(spark, rows), slots=1 << 10)


def test_counts_are_handed_on_in_small_frames(monkeypatch):
    rng = random.Random(8)
    pdf = lambda: pd.DataFrame({"text": [prose(rng, 200) for _ in range(20)], "lang": ["de", "en"] * 10})
    batches = [pdf(), pdf()]
    total = lambda frames: pd.concat(frames).groupby(["l", "gram"])["n"].sum()
    whole = total(langid._counts(["de", "en"])(iter(batches)))
    assert len(whole) > 200
    for held, sent in ((1 << 18, 64), (100, 64)):
        monkeypatch.setattr(langid, "_HELD", held)
        monkeypatch.setattr(langid, "_SENT", sent)
        frames = list(langid._counts(["de", "en"])(iter(batches)))
        assert max(map(len, frames)) <= sent and total(frames).equals(whole)


def test_long_texts_count_like_short_ones(monkeypatch):
    text = prose(random.Random(1), 300) + "  12, " + prose(random.Random(2), 300)
    whole = Counter(h for hs, _ in langid.gram_rows([text]) for h in hs.tolist())
    monkeypatch.setattr(langid, "PIECE", 37)
    monkeypatch.setattr(langid, "_CHUNK", 100)
    assert Counter(h for hs, _ in langid.gram_rows([text]) for h in hs.tolist()) == whole


# --------------------------------------------------------------------- BPE

def encoder():
    import base64

    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def mixed_texts(n=250):
    rng = random.Random(7)
    letters = "aaabcdeeinth  '\n\t0189é ßœ漢🙂.!?-²\x1c\x85\xa0"
    return (["".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(n)]
            + ["a" * 3000, "the" * 200, "", "  ", "<|endoftext|>", "x" * 129])


@pytest.mark.parametrize("long", [0, 3, 128])
def test_merge_replay_equals_the_library(monkeypatch, long):
    monkeypatch.setattr(bpe, "LONG", long)
    monkeypatch.setattr(bpe, "BLOCK", 5000)
    monkeypatch.setattr(bpe, "HELD_WORDS", 500)
    replay, enc, texts = bpe.MergeReplay(bpe.load_ranks(PATH), PATTERN), encoder(), mixed_texts()
    for t, ids in zip(texts, replay.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(t), t
        assert replay.decode(ids) == t.encode()


def test_latin_pattern_splits_alike():
    fast, slow = re.compile(bpe.latin_pattern(PATTERN)).findall, regex.compile(PATTERN).findall
    rng = random.Random(9)
    for _ in range(300):
        t = "".join(chr(rng.randrange(256)) for _ in range(60))
        assert fast(t) == slow(t)


def test_bpe_query_columns(spark):
    enc, rows = encoder(), AWKWARD + [(20 + i, t, "en") for i, t in enumerate(mixed_texts(30))]
    got = bpe.digests(bpe.decode(bpe.encode(make_docs(spark, rows), PATH, PATTERN), PATH, PATTERN))

    def want(d, t):
        ids = np.array(enc.encode_ordinary(t or ""), "<u4")
        return d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()
    assert rows_of(got) == Counter(want(d, t) for d, t, _ in rows)


def test_a_round_trip_is_encode_then_decode(spark, monkeypatch):
    rows = AWKWARD + [(20 + i, t, "en") for i, t in enumerate(mixed_texts(30))] + [(None, "a b", "en"), (20, "a b", "de")]
    docs = make_docs(spark, rows)
    two, one = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN), bpe.round_trip(docs, PATH, PATTERN)
    assert one.dtypes == two.dtypes and rows_of(one) == rows_of(two) and one.count() == len(rows)
    enc, batches = encoder(), [pd.Series([t for _, t, _ in rows], dtype=object), pd.Series([], dtype=object)]
    for block in (1, 1000, 1 << 21):  # frames of any size: the same rows in the same order
        monkeypatch.setattr(bpe, "BLOCK", block)
        got = pd.concat(bpe._both(PATH, PATTERN)(iter(batches)))
        assert [np.frombuffer(x, "<u4").tolist() for x in got["ids"]] == [enc.encode_ordinary(t or "") for _, t, _ in rows]
        assert list(got["decoded"]) == [(t or "").encode() for _, t, _ in rows]
    assert not bpe.replay_of(PATH, PATTERN).known


# ------------------------------------------------------------- token counts

@pytest.mark.parametrize("few", [0, 128])
def test_edits_keep_counts_right(monkeypatch, few):
    monkeypatch.setattr(bpe, "FEW", few)
    rng, enc = random.Random(11), encoder()
    replay = bpe.MergeReplay(bpe.load_ranks(PATH), PATTERN)
    for t in mixed_texts(60) + [" " * 900 + "x", "a\n" * 800]:
        tree = tokencounts.CountTree.of(replay, t)
        for _ in range(5):
            a = rng.randint(-2, len(t) + 3)
            b = a + rng.choice((0, 0, 1, 3, 150))
            new = "".join(rng.choices("ab  '\n1é", k=rng.choice((0, 1, 5, 200))))
            s = min(max(a, 0), len(t))
            t = t[:s] + new + t[min(max(b, s), len(t)):]
            tree.edit(a, b, new)
            assert tree.text() == t and tree.n_tokens == len(enc.encode_ordinary(t)) and tree.n_chars == len(t)


def test_rows_of_one_id_get_their_own_edits(spark):
    texts = ["one two\nthree", "four", None, "", "five six seven eight\nnine " * 9]
    docs = spark.createDataFrame([(i, t, "en", "s") for i in (1, None) for t in texts * 5], "doc_id long, text string, lang string, source string")
    edit = tokencounts.edit(F.lit(1), F.lit(0), F.instr("text", "\n"), F.lit("x "))
    got = Counter(map(tuple, tokencounts.counts_with_own_edits(docs, [edit], PATH, PATTERN).collect()))
    enc, want = encoder(), Counter()
    for i in (1, None):
        for t in texts * 5:
            t = t or ""
            after = "x " + t[t.find("\n") + 1:]
            want[i, len(enc.encode_ordinary(t)), len(t), 1, len(enc.encode_ordinary(after)), len(after)] += 1
    assert Counter({k[:6]: 0 for k in got}) + Counter(k[:6] for k in got.elements()) == want


def test_edited_counts_table(spark):
    docs = make_docs(spark, AWKWARD)
    edits = spark.createDataFrame([(4, 2, 1, 1, " more"), (4, 1, None, None, "one "), (2, 1, 5, 9, None),
                                   (99, 1, 0, 0, "z"), (None, 1, 0, 0, "z")],
                                  "doc_id long, seq int, start long, stop long, new string")
    got = tokencounts.edited_counts(docs, edits, PATH, PATTERN).collect()
    enc, text = encoder(), {1: "", 2: "", 4: "o morene x"}
    assert len(got) == len(AWKWARD)
    for r in got:
        if r.doc_id in text:
            assert r.n_chars_after == len(text[r.doc_id]) and r.n_tokens_after == len(enc.encode_ordinary(text[r.doc_id]))


# --------------------------------------------------------------------- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- ad --><div class="ad">Buy now</div>
<div class="cookie-notice">We use cookies &amp; more.</div><article><h1>Big   title</h1><p><b>First &lt;para&gt;&nbsp;one.<br>
<p>Second <i>para</i>graph
with a line.</p><ul><li>Point.</li></ul></article><aside>See also this</aside><form><label>Mail</label><input name=q>
<button>Send</button></form><div id="comments"><p>Nice text, thanks for it!</p></div><footer>&copy; 2020 Us</footer></body>"""


def test_main_text_of_a_page_and_awkward_ones(spark):
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (None, "u", "<p"), (5, "u", "a < b <!-- open"), (5, "u", "a < b <!-- open")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    sample = spark.createDataFrame([(i, "<article>" + "".join(f"<p>{prose(random.Random(i * 9 + k), 20)}</p>" for k in range(6))
                                     + "</article>") for i in range(60)], "page_id long, html string")
    model = html.learn(sample)
    got = {(r.page_id, r.text) for r in html.extract(pages, model).collect()}
    assert (1, "Big title First <para> one. Second paragraph with a line. Point.") in got
    assert (2, "") in got and (3, "") in got and len(html.extract(pages, model).collect()) == len(rows)
    assert html.extract(pages.limit(0), html.learn(pages.limit(0))).count() == 0


def slow_tokens(page):
    """The same tokens from a state machine that reads one character at a time."""
    out, text, i, n = [], "", 0, len(page)
    space = " \n\t"
    while i < n:
        c = page[i]
        name_at = i + 2 if page[i + 1:i + 2] == "/" else i + 1
        first = page[name_at:name_at + 1]
        starts = c == "<" and first.isascii() and first.isalpha()
        if c != "<" or not (starts or page[i + 1:i + 2] in ("/", "!", "?") and page[i + 1:i + 2]):
            text, i = text + c, i + 1
            continue
        if text:
            out.append(text)
            text = ""
        if not starts:
            mark = "-->" if page[i:i + 4] == "<!--" else ">"
            i = i + 4 if mark == "-->" else i
            while i < n and page[i:i + len(mark)] != mark:
                i += 1
            i += len(mark)
            continue
        i, name, attributes = name_at, "", []
        while i < n and page[i] not in space + "/>":
            name, i = name + page[i], i + 1
        while i < n and page[i] != ">":
            if page[i] in space + "/":
                i += 1
                continue
            key, value = page[i], ""
            i += 1
            while i < n and page[i] not in space + "/>=":
                key, i = key + page[i], i + 1
            k = i
            while k < n and page[k] in space:
                k += 1
            if page[k:k + 1] == "=":
                i = k + 1
                while i < n and page[i] in space:
                    i += 1
                if page[i:i + 1] in ("'", '"') and page[i:i + 1]:
                    quote = page[i] if page[i] in page[i + 1:] else ">"
                    i += 1
                    while i < n and page[i] != quote:
                        value, i = value + page[i], i + 1
                    i += quote != ">"
                else:
                    while i < n and page[i] not in space + ">":
                        value, i = value + page[i], i + 1
            attributes.append((key, value))
        out.append((name, attributes))
        i += 1
    return out + ([text] if text else [])


def test_tokens_match_a_plain_state_machine():
    rng = random.Random(11)
    pieces = ["<p", "<b>", "</p>", "</", "<", ">", "/", "=", " ", "'", '"', "class=x", " id='a b'", "it's", "text", "<!--", "-->", "<!d", "\n", "é"]
    for _ in range(3000):
        page = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 25)))
        got, want = [], []
        for t in html.tokens(page):
            t = t if isinstance(t, str) else (t.name, t.attributes)
            if isinstance(t, str) and got and isinstance(got[-1], str):
                t = got.pop() + t
            got.append(t)
        for t in slow_tokens(page):
            t = t if not isinstance(t, str) or not want or not isinstance(want[-1], str) else want.pop() + t
            want.append(t)
        assert got == want, page


def test_quotes_in_values_lose_no_text_and_hostile_pages_are_linear():
    texts = lambda page: [b.text for b in html.blocks(page)]
    assert texts("<article><p>One.</p><p title=don't>Two words.</p><p>Three it's four.</p></article><p>end</p>") == [
        "One.", "Two words.", "Three it's four.", "end"]
    assert texts('<div class="x>One</div><p>Two</p>') == ["One", "Two"]
    model, start = html.ChainModel(), time.monotonic()
    for page in ('<a x=1 "' + "<b x " * 60_000 + "'", "<b>" * 60_000 + "</i>" * 60_000, "<div>" * 60_000 + "x",
                 "<b>" * 40_000 + "<div></div>" * 20_000, "<i><div>" + "<b>" * 60_000 + "</i>" * 60_000):
        model.decode(html.features(html.blocks(page)))
    assert time.monotonic() - start < 30


def test_viterbi_finds_the_best_labels():
    rng = np.random.default_rng(4)
    model = html.ChainModel(rng.normal(size=(html.WIDTH, 2)), rng.normal(size=(2, 2)))
    for n in (1, 2, 5):
        rows = [(tuple(rng.integers(0, html.WIDTH, 2).tolist()), rng.integers(0, html.WIDTH, 1).tolist()) for _ in range(n)]
        s = model.scores(rows)
        best = max(range(2 ** n), key=lambda m: sum(s[i][m >> i & 1] for i in range(n))
                   + sum(model.move[m >> i & 1][m >> i + 1 & 1] for i in range(n - 1)))
        assert model.decode(rows) == [best >> i & 1 for i in range(n)]


# --------------------------------------------------------------------- WARC

def test_warc_round_trip(spark):
    big, rows = "é" * 700, [(1, "http://a/\r\nX: y", "s"), (2, None, "s"), (3, "u", None), (9, "v", "")]
    rows += [(i, f"u{i}", big) for i in (4, 7, 5)] + [(7, "again", big), (None, "n", big), (8, "w", "z" * 999), (10, "w", "z" * 999)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.round_trip(pages.repartition(3), scratch_path(spark, "t")).collect()
    def want(i, h):
        b = (h or "").encode()
        revisit = h == big and i != 7
        return i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", 7 if revisit else None
    assert Counter((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == Counter(
        want(i, h) for i, _, h in rows)
    assert all(r.payload is None if r.record_type == "revisit" else len(r.payload) == r.payload_bytes for r in got)
    assert warc.round_trip(pages.limit(0), scratch_path(spark, "t")).count() == 0


def test_warc_salted_join_gives_the_same_plan(spark, monkeypatch):
    pages = spark.createDataFrame([(i, "u", "y" * 1200) for i in range(30)], "page_id long, url string, html string")
    one = rows_of(warc.plan(pages).drop("payload"))
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    assert rows_of(warc.plan(pages).drop("payload")) == one


# ---------------------------------------------------------------------- URLs

RULES = (urlfilter.Rule("net", "/", "block"), urlfilter.Rule("example.net", "/en/", "allow"),
         urlfilter.Rule("example.com", "/de/", "block"), urlfilter.Rule("org", "/fr/", "allow"))


def brute_url(u, listed):
    host = path = ""
    if u is not None and "://" in u:
        rest = u.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in RULES if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.key), len(r.host)), default=None)
    return host, path, best and best.key, best.verdict if best else "block" if host in listed else "allow"


@pytest.mark.parametrize("max_bytes", [64 << 20, 0])
def test_url_verdicts(spark, monkeypatch, max_bytes):
    monkeypatch.setattr(urlfilter, "MAX_BYTES", max_bytes)
    rng = random.Random(6)
    urls = [None, "", "nothing", "://", "http://", "http://NET", "http://net/", "x://a.net", "http://a.net?/en/", "http://EXAMPLE.net/en/x",
            "http://xexample.net/en/", "http://example.com/de", "http://example.com/de/", "a\nb://q.org/fr/?x", "http://.net/", "http://a..net/en/"]
    urls += [f"http://{rng.choice(('a', 'casino-win', 'b.c', 'WWW'))}.example.{rng.choice(('net', 'com', 'org'))}/"
             f"{rng.choice(('en', 'de', 'fr', ''))}/{rng.randrange(30)}" for _ in range(150)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = sorted(map(tuple, urlfilter.judge(pages, RULES, urlfilter.hosts_with_words(pages)).collect()))
    listed = {h for u in urls for h in [brute_url(u, ())[0]] if set(re.split("[.-]", h)) & set(urlfilter.HOST_WORDS)}
    assert got == [(i, *brute_url(u, listed)) for i, u in enumerate(urls)]
    assert urlfilter.judge(pages.limit(0), RULES).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(6000).select(F.xxhash64("id").alias("h"), F.xxhash64(F.lit(1), "id").alias("g"),
                                    (F.col("id") % 7 == 0).alias("listed"))
    cascade = urlfilter.build(keys)
    got = keys.toPandas()
    found = cascade.listed(got["h"].to_numpy().view(np.uint64), got["g"].to_numpy().view(np.uint64))
    assert len(cascade.levels) > 1 and (found == got["listed"].to_numpy()).all()


# ------------------------------------------------------------------- secrets

def brute_base(t):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets_base_and_links(spark):
    key, hexed, mixed = "AKIA" + "B2" * 8, "0f" * 13, "aB3" * 9
    texts = ["🙂 secret: token: abcdefgh TOKEN='xyz123' " + hexed, f"{key} {key[:19]}", "password=abc", "api_key == zzzzzz", "a" * 23, "f" * 30,
             f"login: bob9 then {mixed} end", f"{mixed} alone", "https://x.io login=bob9", f"https://x.io user_id=bob9 {mixed}",
             f"login=bob9{' ' * 300}{mixed}", f"https://h.io:80 {key}", ""]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(100, None, None), (None, texts[6], None), (6, texts[6], "en")]
    found = secrets.find_secrets(make_docs(spark, rows)).collect()
    names = secrets.KINDS
    by = {}
    for r in found:
        by.setdefault(r.doc_id, [names[s.rank] for s in r.spans])
    for i, t in enumerate(texts):
        assert [tuple(s) for r in found if r.doc_id == i for s in r.base][:len(brute_base(t))] == brute_base(t)
    assert by[6] == ["identifier", "secret"] and by[7] == [] and by[8] == [] and by[None] == by[6]
    assert by[9] == ["endpoint", "identifier", "secret"] and by[10] == [] and by[11] == ["access"]
    assert len(found) == len(rows)
    d = {r.doc_id: r for r in secrets.digests(secrets.find_secrets(make_docs(spark, rows))).collect()}
    assert d[5].spans == "hex:0:30" and d[5].n_hex == 1 and d[12].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secrets.find_secrets(make_docs(spark, [])).count() == 0


def brute_linked(t):
    """(spans, links) by all pairs of parts."""
    base, parts = brute_base(t), []
    for rank, (kind, pattern, group, least) in enumerate(secrets.BASE + secrets.WEAK):
        if rank >= 3:
            for m in re.finditer(pattern, t):
                mixed = kind != "secret" or all(re.search(x, m[0]) for x in ("[a-z]", "[A-Z]", "[0-9]"))
                if len(m[group]) >= least and mixed and not any(b[0] < m.end() and m.start() < b[2] for b in base):
                    parts.append((m.start(), rank, m.end()))
    parts = sorted(base + parts)
    ends = [m.start() for m in re.finditer(r"\n[\x20\t\r]*\n", t)]
    role = {k: [secrets.KINDS.index(x) for x in v] for k, v in secrets._ROLES.items()}

    def near(i, kind):
        p, best = parts[i], None
        for j, q in enumerate(parts):
            away = p[0] - q[2] if j < i else q[0] - p[2]
            scope = not any(min(p[0], q[0]) <= e < max(p[0], q[0]) for e in ends)
            if j != i and q[1] in role[kind] and away <= secrets.REACH and scope:
                # of those before the one that ends last, of those behind the first
                rank = (away, j > i, -q[0] if j < i else q[0], -q[2] if j < i else q[2])
                best = min(best, (rank, (q[0], q[2]))) if best else (rank, (q[0], q[2]))
        return best[1] if best else None

    spans, links = [], []
    for i, p in enumerate(parts):
        got = [near(i, k) for k in ("identifier", "secret", "endpoint")]
        kind = secrets.KINDS[p[1]]
        if p[1] < 3 or kind == "identifier" and got[1] or kind == "secret" and (got[0] or got[2]) or kind == "endpoint" and got[0] and got[1]:
            spans.append(p)
            if p[1] in role["secret"] and (got[0] or got[2]):
                links.append(((p[0], p[2]), got[0], got[2]))
    return spans, links


def test_secrets_links_match_all_pairs(spark):
    rng = random.Random(31)
    bits = ["login=bob9", "aB3" * 8, "https://h.io:80", "AKIA" + "B2" * 8, "password=abcdef1", "0f" * 12, "plain words", "\n\n", "\n \t\n",
            "é🙂", " " * 90, "x" * 170, "user_id: ann", "https://é", "token=https://a.b", "-"]
    texts = [rng.choice([" ", "", "\n"]).join(rng.choices(bits, k=rng.randint(0, 60))) for _ in range(150)]
    got = {r.doc_id: r for r in secrets.find_secrets(make_docs(spark, [(i, t, "en") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        spans, links = brute_linked(t)
        assert [tuple(s) for s in got[i].base] == brute_base(t)
        assert [tuple(s) for s in got[i].spans] == spans, t
        assert [tuple(x and tuple(x) for x in link) for link in got[i].links] == links, t


def test_secrets_of_very_long_texts(spark):
    one = "0a" * 13 + " login=bob9 é " + "aB3" * 8 + "\n\n"
    n = 5000
    docs = make_docs(spark, [(1, one * n, "en"), (2, "x" * 500_000, "en"), (3, "f" * 500_000, "en")])
    t0 = time.time()
    found = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    text = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert time.time() - t0 < 90
    assert [tuple(s) for s in found[1].spans] == [(k * len(one) + a, r, k * len(one) + b) for k in range(n) for a, r, b in brute_linked(one)[0]]
    assert text == {1: "[secret] [secret] é [secret]\n\n" * n, 2: "x" * 500_000, 3: "[secret]"} and not found[2].spans


def test_redacted_needs_no_shuffle(spark):
    out = secrets.redacted(make_docs(spark, [(1, "é token=abcdef12 end", "en"), (1, None, None), (None, "secret=abcdefgh", "en")]))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows_of(out.select("doc_id", "text")) == Counter([(1, "é [secret] end"), (1, None), (None, "[secret]")])


def test_redaction(spark):
    docs = make_docs(spark, [(1, "é token=abcdef12 end", "en"), (2, "clean", "en"), (3, None, "en"), (None, "secret=abcdefgh", "en")])
    out = secrets.redact(docs, secrets.find_secrets(docs))
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "é [secret] end", 2: "clean", 3: None, None: "secret=abcdefgh"}


# ------------------------------------------------------------------- quality

def brute_quality(t):
    t = t or ""
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", t) if x]
    g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n, covered = Counter(g), set()
    for i, x in enumerate(g):
        covered |= {i, i + 1, i + 2} if n[x] > 1 else set()
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_quality_base_matches_brute_force(spark):
    rng = random.Random(8)
    rows = AWKWARD + [(100 + i, "".join(rng.choices("ab #\n\t\x0b|", k=rng.randint(0, 400))), "en") for i in range(80)]
    rows += [(300, "one two three " * 60, "en"), (301, "a a a a", "en"), (302, " ".join(f"w{i}" for i in range(60)), "en")]
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality(make_docs(spark, rows), empty)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r.doc_id, *[r[c] for c in cols]) for r in got.collect()) == Counter((d, *brute_quality(t)) for d, t, _ in rows)
    assert all(r.kept is not r.base_failed for r in got.collect())
    assert quality.quality(make_docs(spark, []), empty).count() == 0


def test_cutoffs_respect_the_exact_bound(spark):
    good = [(i, "en", 0, 0, True) for i in range(3000)]
    rows = [(i, "en", 100, 500, 0, 0, 0, 10, 0, 0, False) for i in range(3000)]
    rows += [(3000 + i, "en", 100, 500, 150, 0, 0, 10, 0, 0, False) for i in range(200)]
    rows += [(4000 + i, None, 100, 500, 150, 0, 0, 10, 0, 0, False) for i in range(50)]
    counts = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                         "n_repeat_words long, n_lines long, n_capitals long, n_exclaims long, base_failed boolean")
    labels = spark.createDataFrame([(r[0], int(r[0] < 3000)) for r in rows] + [(0, None), (None, 1)], "doc_id long, quality int")
    cuts = {r.lang: r.cuts for r in quality.cutoffs(counts, labels).collect()}
    assert list(cuts) == ["en"] and cuts["en"][0] is not None and cuts["en"][1:] == [None] * 5
    kept = {r.doc_id: r.kept for r in quality.judge(counts, quality.cutoffs(counts, labels)).collect()}
    assert all(kept[i] for i in range(3000)) and not any(kept[3000 + i] for i in range(200)) and kept[4000]
    p, n = quality.ALPHA / len(quality.RULES), 3000
    tried = 2 * len(quality.RULES)
    assert sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(1)) <= quality.DELTA / tried
    assert len(good) == n


def test_binomial_tail_is_exact(spark):
    cases = [(k, n, p) for n in (1, 7, 300, 2000) for k in (-1, 0, 1, 3, n // 2, n - 1, n, n + 1) for p in (0.004, 0.3, 0.9)]
    got = spark.createDataFrame(cases, "k long, n long, p double").select(quality.binomial_cdf(F.col("k"), F.col("n"), F.col("p")).alias("c"))
    for (k, n, p), r in zip(cases, got.collect()):
        want = sum(comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(min(k, n) + 1)) if n < 2000 else None
        assert want is None or abs(r.c - float(want)) <= 1e-9 * max(float(want), 1e-3)


def test_certified_cutoffs_keep_their_promise(spark):
    """Many strata whose good texts reach level 30 at a rate just over what is allowed: a
    cutoff at or below 30 may be certified in few of them only."""
    rng, n, strata = np.random.default_rng(5), 3000, 60
    p = 1.3 * quality.ALPHA / len(quality.RULES)
    rows = []
    for s in range(strata):
        high = rng.random(n) < p
        rows += [(f"s{s}", True, 30 if h else 0, int(c)) for h, c in ((True, high.sum()), (False, n - high.sum()))]
        rows.append((f"s{s}", False, 30, 500))
    seen = spark.createDataFrame(rows, "s string, good boolean, level int, n long").select(
        F.col("s").alias("_s"), F.lit(0).alias("rule"), "level",
        F.when(F.col("good"), F.col("n")).otherwise(0).alias("good"), F.when(~F.col("good"), F.col("n")).otherwise(0).alias("bad"))
    seen = seen.groupBy("_s", "rule", "level").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    for budget, most in ((quality.DELTA, 0), (0.05 * strata * len(quality.RULES), 12)):
        wrong = quality.certified(seen, delta=budget).filter("cut <= 30").count()
        assert wrong <= most  # by chance: under 5 % of the whole table; under 5 % of the strata (3, twelve would be 5 sigma)


# ------------------------------------------------------------ decontamination

def test_lcs_matches_the_plain_table():
    rng = random.Random(2)
    for _ in range(100):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(0, 20))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            old = row[:]
            for j, y in enumerate(b):
                row[j + 1] = old[j] + 1 if x == y else max(row[j], old[j + 1])
        assert decontam.lcs(a, b) == row[-1]


def test_word_hashes_do_not_depend_on_place_or_pieces(monkeypatch):
    texts = [b"One two,three", b"", b"two \xc3\xa9t\xc3\xa9 one", b"x" * 50 + b" " + b"two " * 30]
    h, at = decontam.word_hashes(texts)
    monkeypatch.setattr(decontam, "_BYTES", 64)
    h2, at2 = decontam.word_hashes(texts)
    assert at.tolist() == at2.tolist() == [0, 3, 3, 6, 37] and (h == h2).all()
    assert h[0] == h[5] and h[1] == h[3] == h[7] and len(set(h.tolist())) == 5


def test_planted_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 9)))
    common = [word() for _ in range(40)]
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.5 else word() for _ in range(n))
    items = [(i, text(rng.randint(8, 90)) + ".") for i in range(30)] + [(90, None), (91, ""), (None, "x y z")]
    rows, want = [*AWKWARD], set()
    for i in range(120):
        body = text(rng.randint(5, 200))
        if i % 3 == 0:
            k, item = items[i // 3 % 30]
            cut = rng.randint(0, len(body))
            body = body[:cut] + " " + item.upper().replace(" ", "\n ", 3) + " " + body[cut:]
            want.add((100 + i, k))
        rows.append((100 + i, body, "en"))
    k, item = items[0]
    words = item.split()
    rows.append((999, " ".join(w if j % 6 else "zzzz" for j, w in enumerate(words)), "en"))  # a light rewording
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contaminated(make_docs(spark, rows + rows[-1:]), bench).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert want <= found and found - want <= {(999, 0)} and (999, 0) in found
    monkey = decontam.BLOCK_WORDS
    try:
        decontam.BLOCK_WORDS = 200  # several blocks give the same pairs
        again = {(r.doc_id, r.item_id) for r in decontam.contaminated(make_docs(spark, rows), bench).collect()}
    finally:
        decontam.BLOCK_WORDS = monkey
    assert again == found
    assert decontam.contaminated(make_docs(spark, []), bench).count() == 0
    assert decontam.contaminated(make_docs(spark, rows), bench.limit(0)).count() == 0


def _passage_rows(items):
    """What ``decontam.passages`` makes of (id, text)."""
    rows = []
    for k, t in items:
        h, a = (decontam.word_hashes([x.encode()])[0].view(np.int64) for x in (t, decontam.answer_of(t)))
        rows += [(k, 0, s, h[s:e], a) for s, e in decontam.passages_of(len(h))]
    return rows


def test_latent_search_recalls_what_plain_lcs_finds_anywhere():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.sample(vocabulary, n))) for i, n in enumerate([3, 6, 9, 14, 20, 32, 32, 40, 50] * 4)]
    texts, held = [], []
    for i, (k, item) in enumerate(items * 3):  # the words around are the benchmark's own, every place on the grid occurs
        words, around = item.split(), rng.choices(vocabulary, k=120)
        for j in rng.sample(range(len(words)), len(words) * 3 // 10 if len(words) >= 20 else 0):
            words[j] = rng.choice(vocabulary)
        at = 30 + i % 16
        texts.append(" ".join(around[:at] + words + around[at:]).encode())
        held.append((i, k))
    rows = _passage_rows(items)
    terms = np.unique(np.concatenate([r[3] for r in rows]).view(np.uint64))
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(len(terms), decontam.RANK)))[0]
    block = decontam.prepare(rows, terms, q, np.full(decontam.BUCKETS, 3.0))
    h, at = decontam.word_hashes(texts)
    got = {(t, *origin) for t, *origin, _, _, _, _ in decontam.search(block, h, at)}
    assert set(held) <= {(t, k) for t, k, _, _ in got}
    number, exact = block.numbers(h), set()
    for width, of in block.classes:  # no candidate search at all
        for t, start, end in zip(*decontam._windows(at, width)):
            for p in of:
                if decontam._verified(block, number, at, t, start, end, p, max(1, width // 2)):
                    exact.add((t, *block.origin[p]))
    assert got <= exact and len(got) >= 0.9 * len(exact)
    block.latent[:] = 0  # there is no other way to a result
    assert not list(decontam.search(block, h, at))


@pytest.mark.parametrize("items", [0, 1])
def test_the_search_starts_no_second_kind_of_python_workers(spark, monkeypatch, items):
    tables = [common.stored(spark.createDataFrame([(1, prose(random.Random(9), 40))], f"{key} long, text string"), key)
              for key in ("doc_id", "item_id")]
    plans, store = [], decontam.stored

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return store(df, name)
    monkeypatch.setattr(decontam, "stored", watched)
    got = decontam.contaminated(tables[0], tables[1].limit(items))
    assert [(r.doc_id, r.item_id, r.kind) for r in got.collect()] == [(1, 1, "copy")] * items
    assert dict(got.dtypes) == {"doc_id": "bigint", "item_id": "bigint", "passages": "bigint", "cosine": "double",
                                "lcs_share": "double", "kind": "string"}
    assert [name for name, _ in plans] == ["passages", "leaks"]
    assert not [p for _, p in plans if "ExistingRDD" in p]  # rows from a list pass through workers of RDDs


def test_words_without_spaces_and_repeated_item_ids(spark):
    zh = "\u5929\u5730\u7384\u9ec4\u5b87\u5b99\u6d2a\u8352\u65e5\u6708\u76c8\u6603\u8fb0\u5bbf\u5217\u5f20\u5bd2\u6765\u6691\u5f80"
    before, behind = "\u4eca\u65e5\u8bfb\u4e66", "\u4ee5\u540e\u518d\u8bf4"
    plain = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    bench = spark.createDataFrame([(1, zh), (2, f"\u201c{plain}\u201d"), (2, "one id two texts six words each"), (3, "")],
                                  "item_id long, text string")
    docs = make_docs(spark, [(1, before + zh + behind, "zh"), (2, plain.replace("beta ", "beta\u2014"), "en"),
                             (3, f"{plain} and one id two texts six words each", "en"), (4, before + behind, "zh"), (5, None, None)])
    got = {(r.doc_id, r.item_id): r.passages for r in decontam.contaminated(docs, bench).collect()}
    assert got == {(1, 1): 1, (2, 2): 1, (3, 2): 2}
    assert decontam.word_hashes([zh.encode()])[1].tolist() == [0, 20]


def test_words_by_code_point():
    one = lambda t: decontam.word_hashes([t.encode()])[0].tolist()
    assert one("\u201calpha beta\u2014gamma\u201d") == one('"alpha beta-gamma"') == one("alpha, beta gamma")
    assert one("\u5929 \u5730") == one("\u5929\u5730") and len(one("a\u5929b")) == 3
    assert decontam.answer_of("\u4ec0\u4e48\u662f\u5929\uff1f\u5730\u7684\u4e0a\u9762") == "\u5730\u7684\u4e0a\u9762"


def test_without_ids_keeps_null_keys(spark, monkeypatch):
    docs = make_docs(spark, AWKWARD)
    ids = spark.createDataFrame([(4,), (None,), (4,), (77,)], "doc_id long")
    want = Counter(r for r in map(tuple, docs.collect()) if r[0] != 4)
    assert rows_of(without_ids(docs, ids, "doc_id").select(*docs.columns)) == want
