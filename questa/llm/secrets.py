"""Secret scans with multipart credential linking, DataFrame functions only.

Strong findings (the base kinds) stand alone.  Weak candidates, parts of a
credential that mean little alone (an account name, a mixed-case token, an
endpoint), are reported only where complementary parts co-occur.  A scope is a
paragraph, what stands between two blank lines; the parts of a scope are joined by
interval, each part's interval widened by ``REACH`` code points, in one sweep over
a text's parts in order of place.  A weak identifier needs a secret near it, a weak
secret needs an identifier or an endpoint, and an endpoint needs both.  Every
reported secret comes with the identifier and the endpoint nearest to it.

A match's place is the length of all gaps (``split``) and matches
(``regexp_extract_all``) before it, so texts are scanned by the JVM's regular
expressions alone.  All is done inside the text's own row: nothing is exploded,
shuffled or stored.  Running sums and maxima go in blocks of about the square root
of a text's parts, so a text with very many of them costs little more than its
length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.special import _let
from .common import text_of

#: Parts of one credential are at most this many code points apart.
REACH = 160

# Kinds in their order, with pattern, group that must be long
# enough, and its least length.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
WEAK = (
    ("identifier", r"""(?i)(user_?name|user_?id|client_?id|key_?id|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 2, 3),
    ("secret", r"[A-Za-z0-9+/]{20,}", 0, 20),
    ("endpoint", r"https?://[A-Za-z0-9.-]+(:[0-9]+)?", 0, 0),
)
KINDS = tuple(k for k, *_ in BASE + WEAK)
#: Roles: what each kind is a part of.
IDENTIFIERS, SECRETS, ENDPOINTS = ("access", "identifier"), ("assign", "hex", "secret"), ("endpoint",)

#: What ends a scope, and its rank among the parts.
_SCOPE, _SCOPE_RANK = r"\n[\x20\t\r]*\n", len(KINDS)

_SPAN = "struct<start:long,rank:int,stop:long>"
#: A part: its span in code points and its bytes.
_PART = "struct<start:long,rank:int,stop:long,from:long,to:long>"
#: Lists up to this long are summed in one block.
_BLOCK = 32
_FAR = 1 << 60


def _running(values: Column, zero: Column, plus: Callable[[Column, Column], Column]) -> Column:
    """For each element, the sum of the elements before it (``plus`` must be
    associative).  An array that grows is copied at each step, so long lists go
    in blocks of about the square root of their length."""
    def states(block: Column, first: Column) -> Column:
        return F.aggregate(F.slice(block, F.lit(1), F.size(block) - 1), F.array(first),
                           lambda seen, x: F.concat(seen, F.array(plus(F.element_at(seen, -1), x))))

    def blocks(v: Column, size: Column) -> Column:
        last = F.floor((F.size(v) - 1) / size).cast("int")
        cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(v, i * size + 1, size))
        return _let(cut, lambda parts: _let(
            states(F.transform(parts, lambda p: F.aggregate(p, zero, lambda x, y: plus(x, y))), zero),
            lambda firsts: F.flatten(F.transform(parts, lambda p, i: states(p, F.get(firsts, i))))))

    return _let(values, lambda v: F.when(F.size(v) == 0, F.slice(F.array(zero), 1, 0))
                .when(F.size(v) <= _BLOCK, states(v, zero))
                .otherwise(_let(F.ceil(F.sqrt(F.size(v))).cast("int"), lambda size: blocks(v, size))))


def _size(s: Column) -> Column:
    return F.struct(F.length(s).cast("long").alias("c"), F.octet_length(s).cast("long").alias("b"))


def _matches(text: Column, rank: int, pattern: str, fit: Callable[[Column], Column]) -> Column:
    """The matches of ``pattern`` and the gaps around them by size in code points
    and bytes, and which matches count."""
    sizes = "array<struct<c:long,b:long>>"
    # the arrays are made only for texts that have a match at all
    found = F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return _let(found, lambda m: F.struct(
        F.lit(rank).alias("rank"), F.transform(m, _size).cast(sizes).alias("m"),
        F.when(F.size(m) > 0, F.transform(F.split(text, pattern, -1), _size)).cast(sizes).alias("g"),
        F.when(F.size(m) > 0, fit(m)).cast("array<boolean>").alias("fit")))


def _kind(text: Column, rank: int) -> Column:
    """The matches of a kind; those count that are long enough."""
    kind, pattern, group, least = (BASE + WEAK)[rank]

    def fit(found: Column) -> Column:
        if kind == "secret":  # a mixed token: lower case, upper case and digit
            return F.transform(found, lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]"))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
        return F.transform(values, lambda m: F.length(m) >= least)
    return _matches(text, rank, pattern, fit)


def _placed(kinds: Column) -> Column:
    """The matches that count of each element of ``kinds`` as parts, in order."""
    def add(x: Column, y: Column) -> Column:
        return F.struct((x["c"] + y["c"]).alias("c"), (x["b"] + y["b"]).alias("b"))

    def place(k: Column, before: Column) -> Column:
        every = F.transform(k["m"], lambda m, i: _let(add(F.get(before, i), F.get(k["g"], i)), lambda at: F.struct(
            at["c"].alias("start"), k["rank"].alias("rank"), (at["c"] + m["c"]).alias("stop"),
            at["b"].alias("from"), (at["b"] + m["b"]).alias("to"))))
        return F.filter(every, lambda p, i: F.get(k["fit"], i))

    zero = F.struct(F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("b"))
    return F.transform(kinds, lambda k: _let(_running(
        F.transform(k["m"], lambda m, i: add(m, F.get(k["g"], i))), zero, add), lambda before: place(k, before))).cast(f"array<array<{_PART}>>")


def _is(p: Column, kinds: tuple[str, ...]) -> Column:
    return p["rank"].isin([KINDS.index(k) for k in kinds])


def _clear(parts: Column) -> Column:
    """``parts`` in order, without the weak ones that overlap a base one: one
    that starts before ends behind their start, or one behind starts before
    their end."""
    base = lambda p: p["rank"] < len(BASE)
    low = F.lit(-_FAR).cast("long")
    ends = lambda ps: F.transform(ps, lambda p: F.when(base(p), p["stop"]).otherwise(low))
    starts = lambda ps: F.transform(F.reverse(ps), lambda p: F.when(base(p), -p["start"]).otherwise(low))
    return _let(parts, lambda ps: _let(
        F.transform(F.array(ends(ps), starts(ps)), lambda v: _running(v, low, F.greatest)),
        lambda side: F.filter(ps, lambda p, i: base(p) | (
            (F.get(F.get(side, 0), i) <= p["start"]) & (-F.get(F.get(side, 1), F.size(ps) - 1 - i) >= p["stop"])))))


_ROLES = {"identifier": IDENTIFIERS, "secret": SECRETS, "endpoint": ENDPOINTS}


def _state(of: Callable[[str], Column], scope: Column) -> Column:
    """The nearest part of each role on one side, and the nearest scope's end."""
    return F.struct(*[of(r).cast("struct<a:long,b:long>").alias(r) for r in _ROLES], scope.cast("long").alias("scope"))


def _near(parts: Column) -> Column:
    """Each part with the nearest part of each role in its scope within REACH
    (of two equally near, the one before), null if there is none."""
    none = _state(lambda r: F.lit(None), F.lit(-_FAR))
    further = lambda x, y: F.struct(*[F.greatest(x[c], y[c]).alias(c) for c in (*_ROLES, "scope")])
    ends = lambda p: p["rank"] == _SCOPE_RANK

    def side(ps: Column, first: str, second: str, sign: int) -> Column:
        return F.transform(ps, lambda p: _state(
            lambda r: F.when(_is(p, _ROLES[r]), F.struct((sign * p[first]).alias("a"), (sign * p[second]).alias("b"))),
            F.when(ends(p), sign * p[first]).otherwise(-_FAR)))

    def nearest(p: Column, left: Column, right: Column, role: str) -> Column:
        a, b = left[role], right[role]  # (stop, start) before, (-start, -stop) behind
        near_a = (a["b"] >= left["scope"]) & (p["start"] - a["a"] <= REACH)
        near_b = (-b["a"] < -right["scope"]) & (-b["a"] - p["stop"] <= REACH)
        before = F.struct(a["b"].alias("start"), a["a"].alias("stop"))
        behind = F.struct((-b["a"]).alias("start"), (-b["b"]).alias("stop"))
        sure_a, sure_b = F.coalesce(near_a, F.lit(False)), F.coalesce(near_b, F.lit(False))
        return (F.when(sure_a & (~sure_b | (p["start"] - a["a"] <= -b["a"] - p["stop"])), before)
                .when(sure_b, behind))

    def joined(ps: Column, left: Column, right: Column) -> Column:
        return F.transform(ps, lambda p, i: _let(F.get(left, i), lambda x: _let(
            F.get(right, F.size(ps) - 1 - i), lambda y: F.struct(p.alias("p"), *[nearest(p, x, y, r).alias(r) for r in _ROLES]))))

    return _let(parts, lambda ps: _let(F.transform(
        F.array(side(ps, "stop", "start", 1), side(F.reverse(ps), "start", "stop", -1)), lambda v: _running(v, none, further)),
        lambda sides: joined(ps, F.get(sides, 0), F.get(sides, 1))))


def _scanned(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` under the names of _inner, with _base and _parts (all reported
    parts, with what is near them), each in order."""
    rows = docs.toDF(*_inner(docs))
    rows = rows.withColumn("_text", text_of(rows, rows.columns[docs.columns.index(text)]))
    t, n = F.col("_text"), len(BASE)
    scopes = _matches(t, _SCOPE_RANK, _SCOPE, lambda found: F.transform(found, lambda m: F.lit(True)))
    rows = rows.withColumn("_found", _placed(F.array(*[_kind(t, i) for i in range(len(KINDS))], scopes)))
    parts = [F.get("_found", F.lit(i)) for i in range(len(KINDS) + 1)]
    rows = rows.withColumns({"_base": F.sort_array(F.concat(*parts[:n])), "_all": F.sort_array(F.concat(*parts[:-1])),
                             "_scopes": parts[-1]}).drop("_found")
    alone = F.transform("_base", lambda p: F.struct(p.alias("p"), *[F.lit(None).cast("struct<start:long,stop:long>").alias(r) for r in _ROLES]))
    kind = lambda x, k: x["p"]["rank"] == KINDS.index(k)
    i, s, e = (lambda x, r=r: x[r].isNotNull() for r in _ROLES)
    linked = F.filter(_near(F.sort_array(F.concat(_clear(F.col("_all")), "_scopes"))), lambda x: (
        (x["p"]["rank"] < n) | kind(x, "identifier") & s(x) | kind(x, "secret") & (i(x) | e(x)) | kind(x, "endpoint") & i(x) & s(x)))
    return rows.withColumn("_parts", F.when(F.size("_all") > 1, linked).otherwise(alone)).drop("_all", "_scopes", "_text")


def _inner(docs: DataFrame) -> list[str]:
    """Names under which the columns of ``docs`` clash with none of this module's."""
    return [f"_c{i}" for i in range(len(docs.columns))]


def _span(p: Column) -> Column:
    return F.struct(p["start"].alias("start"), p["rank"].alias("rank"), p["stop"].alias("stop"))


def _cuts() -> Column:
    return F.transform("_parts", lambda x: F.struct(x["p"]["from"].alias("from"), x["p"]["to"].alias("to")))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans, links, cuts), one row per row of ``docs``: the base
    spans, and all reported spans (base and linked weak ones), each ordered by
    start, then kind; the linked credentials (secret, identifier, endpoint; one
    per reported secret with an identifier or an endpoint near it, the missing
    part null); the bytes of the reported spans, for :func:`redact`.

    Places count code points, ends are exclusive.  Null texts count as empty, an
    empty table gives an empty result; repeated rows and null keys are treated
    like any row; other columns may have any name.  Very long texts are scanned
    whole, with work that follows their length and their number of parts."""
    k = _inner(docs)[docs.columns.index(key)]
    secret = F.filter("_parts", lambda x: _is(x["p"], SECRETS) & (x["identifier"].isNotNull() | x["endpoint"].isNotNull()))
    links = F.transform(secret, lambda x: F.struct(
        F.struct(x["p"]["start"].alias("start"), x["p"]["stop"].alias("stop")).alias("secret"), x["identifier"].alias("identifier"),
        x["endpoint"].alias("endpoint")))
    return _scanned(docs, text).select(
        F.col(k).alias(key), F.transform("_base", _span).alias("base"),
        F.transform("_parts", lambda x: _span(x["p"])).alias("spans"), links.alias("links"), _cuts().alias("cuts"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:stop``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, links).  Links as
    ``identifier>secret>endpoint``, each ``start:stop`` or empty."""
    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    def part(s: Column) -> Column:
        return F.coalesce(F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string")), F.lit(""))

    counts = [count(i).alias(f"n_{k}") for i, (k, *_) in enumerate(BASE)]
    links = F.transform("links", lambda x: F.concat_ws(">", part(x["identifier"]), part(x["secret"]), part(x["endpoint"])))
    return found.select(key, *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"), F.array_join(links, ",").alias("links"))


def redact(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text",
           mark: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` (overlapping
    spans by one mark), all columns kept.  ``found`` as find_secrets returns it
    for the same table.  ``key`` must tell the rows apart: a repeated key is an
    error, rows with a null key are not matched and stay as they are.  This
    joins the texts with their findings; :func:`redacted` needs neither a key
    nor a join."""
    hit = found.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), F.first("cuts").alias("_cuts"))
    repeated = F.raise_error(F.lit(f"redact: repeated {key}, use redacted")).cast("array<struct<from:long,to:long>>")
    hit = hit.select("_k", F.when(F.col("_n") > 1, repeated).otherwise(F.col("_cuts")).alias("_cuts"))
    inner = _inner(docs)
    at = dict(zip(docs.columns, inner))
    joined = docs.toDF(*inner).join(hit, F.col(at[key]) == F.col("_k"), "left")
    return joined.withColumn(at[text], _cut(F.col(at[text]), F.col("_cuts"), mark)).select(*inner).toDF(*docs.columns)


def redacted(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret of every row replaced by ``mark``
    (overlapping spans by one mark), one row per row, all columns kept whatever
    their names.  A row is found and cut in one pass, nothing is shuffled; a
    null text stays null."""
    inner = _inner(docs)
    own = inner[docs.columns.index(text)]
    rows = _scanned(docs, text).withColumn("_cuts", _cuts())
    return rows.withColumn(own, _cut(F.col(own), F.col("_cuts"), mark)).select(*inner).toDF(*docs.columns)


def _cut(text: Column, cuts: Column, mark: str) -> Column:
    """``text`` without its bytes in ``cuts`` (from, to; ordered by from): what
    stands between them is taken from the text's bytes, so no part of the text
    is walked twice."""
    def between(data: Column, start: Column, stop: Column) -> Column:
        return F.substring(data, (start + 1).cast("int"), (stop - start).cast("int")).cast("string")

    def clean(data: Column, seen: Column) -> Column:
        pieces = F.transform(cuts, lambda c, i: F.when(
            c["from"] >= F.get(seen, i), F.concat(between(data, F.get(seen, i), c["from"]), F.lit(mark))).otherwise(""))
        end = F.array_max(F.transform(cuts, lambda c: c["to"]))
        return F.array_join(F.concat(pieces, F.array(between(data, end, F.octet_length(data).cast("long")))), "")

    ends = F.transform(cuts, lambda c: c["to"])
    whole = _let(text.cast("string").cast("binary"), lambda data: _let(
        _running(ends, F.lit(0).cast("long"), F.greatest), lambda seen: clean(data, seen)))
    return F.when(F.size(cuts) > 0, whole).otherwise(text.cast("string"))
