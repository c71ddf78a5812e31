"""Main-text extraction from HTML with a linear-chain CRF over leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, each
with the path of its open ancestors.  Blocks get ancestor, attribute and text
features; a two-label linear chain (0 boilerplate, 1 main text), decoded by
Viterbi, says which blocks make up the article.  The decoded blocks are joined
in page order.

Training pages: a bounded sample of the given pages is re-rendered in several
layouts whose blocks have known labels (``labelled_pages``).  The fit is a
plain gradient ascent on the conditional likelihood over that sample; decoding
runs inside an Arrow UDF, page by page, without a shuffle.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
BLOCK_TAGS = frozenset((
    "address article aside blockquote body br button caption center dd details dialog dir div dl "
    "dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html iframe legend li main menu nav noscript ol option p pre search section select summary "
    "table tbody td textarea tfoot th thead title tr ul").split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT_TAGS = frozenset("script style noscript template svg math iframe object canvas title head".split())
#: Elements whose content is raw: only their own end tag ends them.
RAW_TAGS = frozenset(("script", "style", "textarea", "title", "iframe", "noscript", "template"))

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: An attribute's name with what stands before it, and its equals sign.
_ATTRIBUTE = re.compile(r"([\s/]*)([^\s/>][^\s/>=]*)?(\s*=\s*)?")
_UNQUOTED = re.compile(r"[^\s>]*")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW_TAGS}
_WORDS = re.compile(r"[a-z]+")
_ENDS = re.compile(r"[.!?…:]['\"»”)]*$")


@dataclass
class Block:
    """A leaf block: its text, the kinds of open elements around it, and the
    features of that place (shared by the blocks of one element)."""
    text: str
    path: frozenset[str]
    place: tuple[int, ...]
    linked: int = 0
    inputs: int = 0
    label: int = 0


#: Feature space: names are hashed to this many weights per label.
WIDTH = 1 << 12


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % WIDTH


class _Open(NamedTuple):
    """An open element, with what it and its ancestors add up to.  Sets that
    an element does not change are its parent's own, so depth costs nothing."""
    tag: str
    path: frozenset[str] = frozenset()
    around: frozenset[int] = frozenset((_slot("bias"),))
    inner: str = ""    # the innermost block element
    under: str | None = None  # the element below the first article
    place: tuple[int, ...] = ()
    silent: bool = False
    link: bool = False


def _place(around: frozenset[int], inner: str, under: str | None) -> tuple[int, ...]:
    names = [f"tag={inner}"] + ([f"under={under}"] if under is not None else [])
    return tuple(sorted(around.union(map(_slot, names))))


_ROOT = _Open("", place=_place(frozenset((_slot("bias"),)), "", None))
#: Elements that an opening tag of the same kind ends.
_REPEATED = frozenset(("p", "li", "td", "tr", "dt", "dd", "option"))
_INLINE_END = frozenset(("p", "li", "a", "b", "i"))


def _marks(attributes: list[tuple[str, str]]) -> tuple[list[str], bool]:
    """Word tokens of class, id and role, and whether the element is hidden."""
    tokens, hidden = [], False
    for name, value in attributes:
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style":
            hidden = hidden or "display:none" in "".join(value.lower().split())
        elif name in ("class", "id", "role"):
            tokens += _WORDS.findall(value.lower())
    return tokens, hidden


class Tag(NamedTuple):
    name: str
    attributes: list[tuple[str, str]]
    end: bool
    closed: bool  # ends in a slash of its own


def tokens(page: str) -> Iterator[str | Tag]:
    """Text pieces and tags in page order; every character is read a bounded
    number of times.

    Attributes are read as the HTML standard says: a quote opens a value only
    right behind the equals sign.  A value whose quote is never closed ends with
    the tag's ``>``.  Comments and declarations give nothing; an unended one, or an
    unended raw element, runs to the end of the page.  A ``<`` before anything
    that starts no markup is text."""
    last = {quote: page.rfind(quote) for quote in "\"'"}
    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            yield page[at:]
            return
        if start > at:
            yield page[at:start]
        if page.startswith("<!--", start):
            at = page.find("-->", start + 4)
            if at < 0:
                return
            at += 3
            continue
        end = page.startswith("</", start)
        name = _NAME.match(page, start + 1 + end)
        if name is None:
            if end or page[start + 1:start + 2] in ("!", "?"):
                at = page.find(">", start) + 1
                if not at:
                    return
            else:
                yield "<"
                at = start + 1
            continue
        at, attributes, closed = name.end(), [], False
        while at < size and page[at] != ">":
            m = _ATTRIBUTE.match(page, at)
            at, value = m.end(), ""
            if m[2] is None:  # only what stands before the end
                closed = m[1].endswith("/")
                continue
            if m[3] and at < size:
                quote = page[at]
                if quote in "\"'":
                    stop = page.find(quote, at + 1) if at < last[quote] else -1
                    if stop >= 0:
                        value, at = page[at + 1:stop], stop + 1
                    else:
                        stop = page.find(">", at)
                        stop = size if stop < 0 else stop
                        value, at = page[at + 1:stop], stop
                else:
                    value = _UNQUOTED.match(page, at)[0]
                    at += len(value)
            attributes.append((m[2], value))
        at += 1
        tag = name[0].lower()
        yield Tag(tag, attributes, end, closed)
        if tag in RAW_TAGS and not end:
            stop = _RAW_END[tag].search(page, at)
            if stop is None:
                return
            at = page.find(">", stop.end()) + 1
            yield Tag(tag, [], True, False)
            if not at:
                return


class _Stack:
    """Open elements, with the places of each kind and of the block elements."""

    def __init__(self):
        self.open: list[_Open] = [_ROOT]
        self.of: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.holders: list[int] = []  # block elements other than p

    def push(self, element: _Open) -> None:
        k, tag = len(self.open), element.tag
        self.open.append(element)
        self.of.setdefault(tag, []).append(k)
        if tag in BLOCK_TAGS:
            self.blocks.append(k)
            if tag != "p":
                self.holders.append(k)

    def cut(self, k: int) -> None:
        while len(self.open) > k:
            tag = self.open.pop().tag
            self.of[tag].pop()
            if tag in BLOCK_TAGS:
                self.blocks.pop()
                if tag != "p":
                    self.holders.pop()

    def close(self, tag: str) -> None:
        """An end tag: an inline or paragraph end doesn't cross its container."""
        places = self.of.get(tag)
        if places and not (tag in _INLINE_END and self.holders and self.holders[-1] > places[-1]):
            self.cut(places[-1])

    def make_room(self, tag: str) -> None:
        """End what the start of ``tag`` ends: its like, or an open paragraph."""
        like = tag if tag in _REPEATED else "p"
        while self.blocks and self.open[self.blocks[-1]].tag in (like, "p"):
            self.cut(self.blocks[-1])
            if like == "p":
                return


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in page order (null, empty: none), in time linear
    in the page.

    Unclosed elements are closed where their parent ends, ``p`` and ``li``
    also by the next of their kind; stray end tags are left out."""
    if not isinstance(page, str) or not page:
        return []
    out: list[Block] = []
    stack, texts = _Stack(), []
    linked = inputs = 0

    def flush() -> None:
        text = " ".join(entities.unescape("".join(texts)).split())
        if text:
            o = stack.open[-1]
            out.append(Block(text, o.path, o.place, min(linked, len(text)), inputs))
        texts.clear()

    for token in tokens(page):
        o = stack.open[-1]
        if isinstance(token, str):
            if not o.silent:
                texts.append(token)
                if o.link:
                    linked += len(token)
            continue
        tag = token.name
        block = tag in BLOCK_TAGS
        if block:
            if texts:
                flush()
            linked = inputs = 0
        if token.end:
            stack.close(tag)
            continue
        inputs += tag in ("input", "textarea")
        if tag in VOID_TAGS or token.closed and tag not in RAW_TAGS:
            continue
        if block:
            stack.make_room(tag)
            o = stack.open[-1]
        marks, hidden = _marks(token.attributes) if token.attributes else ((), False)
        new = {_slot(f"mark={m}") for m in marks}
        path, inner, under = o.path, o.inner, o.under
        if block:
            new.add(_slot(f"in={tag}"))
            if tag not in path:
                path = path | {tag}
            inner = tag
            under = tag if under == "" else "" if under is None and tag == "article" else under
        around = o.around if new <= o.around else o.around | new
        same = around is o.around and inner == o.inner and under == o.under
        stack.push(_Open(tag, path, around, inner, under, o.place if same else _place(around, inner, under),
                         o.silent or hidden or tag in SILENT_TAGS or tag in RAW_TAGS, o.link or tag == "a"))
    if texts:
        flush()
    return out


# ----------------------------------------------------------------- features

_LENGTH = [_slot(f"length={i}") for i in range(8)]
_LINKED = [_slot(f"linked={i}") for i in range(3)]
_ENDED = [_slot(f"ended={i}") for i in range(2)]
_INPUT = _slot("input")


def features(bs: list[Block]) -> list[tuple[tuple[int, ...], list[int]]]:
    """Indices of the features each block has: of its place, and its own."""
    out = []
    for b in bs:
        share = b.linked / len(b.text)
        row = [_LENGTH[min(b.text.count(" ") + 1, 64).bit_length()],
               _LINKED[0 if share < 0.1 else 1 if share < 0.6 else 2],
               _ENDED[bool(_ENDS.search(b.text[-8:]))]]
        if b.inputs:
            row.append(_INPUT)
        out.append((b.place, row))
    return out


@dataclass
class ChainModel:
    """Weights of a two-label linear chain."""
    state: np.ndarray = field(default_factory=lambda: np.zeros((WIDTH, 2)))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def scores(self, rows: list[tuple[tuple[int, ...], list[int]]]) -> np.ndarray:
        places = {id(p): p for p, _ in rows}  # a place is summed once, however many blocks it has
        summed = {k: self.state[list(p)].sum(axis=0) for k, p in places.items()}
        flat = np.fromiter((x for _, r in rows for x in r), np.int64)
        starts = np.cumsum([0] + [len(r) for _, r in rows[:-1]])
        return np.add.reduceat(self.state[flat], starts, axis=0) + np.array([summed[id(p)] for p, _ in rows])

    def decode(self, rows: list[tuple[tuple[int, ...], list[int]]]) -> list[int]:
        """Viterbi: the most likely labels (ties: boilerplate)."""
        if not rows:
            return []
        (s00, s01), (s10, s11) = self.move.tolist()
        score = self.scores(rows).tolist()
        a, b = score[0]
        back = []
        for x, y in score[1:]:
            from0, from1 = a + s01 < b + s11, a + s00 < b + s10
            back.append((int(from1), int(from0)))
            a, b = max(a + s00, b + s10) + x, max(a + s01, b + s11) + y
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def fit(pages: list[list[Block]], rounds: int = 60, rate: float = 0.5, decay: float = 1e-3) -> ChainModel:
    """Conditional likelihood by gradient ascent with per-weight step sizes."""
    model = ChainModel()
    data = [([[*place, *own] for place, own in features(p)], np.array([b.label for b in p])) for p in pages if p]
    if not data:
        return model
    width = max(len(y) for _, y in data)
    n = len(data)
    flat = np.concatenate([np.fromiter((x for r in rows for x in r), np.int64) for rows, _ in data])
    owner = np.concatenate([np.repeat(i * width + np.arange(len(rows)), [len(r) for r in rows])
                            for i, (rows, _) in enumerate(data)])
    real = np.zeros((n, width), bool)
    gold = np.zeros((n, width), np.int64)
    for i, (_, y) in enumerate(data):
        real[i, :len(y)], gold[i, :len(y)] = True, y
    truth = np.eye(2)[gold] * real[..., None]
    pairs = real[:, 1:]
    gold_move = np.zeros((2, 2))
    np.add.at(gold_move, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
    square_s, square_m = np.full((WIDTH, 2), 1e-6), np.full((2, 2), 1e-6)
    for _ in range(rounds):
        s = np.zeros((n * width, 2))
        np.add.at(s, owner, model.state[flat])
        s = s.reshape(n, width, 2)
        fwd, bwd = np.zeros_like(s), np.zeros_like(s)
        fwd[:, 0] = s[:, 0]
        for t in range(1, width):
            step = np.logaddexp.reduce(fwd[:, t - 1, :, None] + model.move, axis=1) + s[:, t]
            fwd[:, t] = np.where(real[:, t, None], step, fwd[:, t - 1])
        total = np.logaddexp.reduce(fwd[:, -1], axis=1)
        for t in range(width - 2, -1, -1):
            step = np.logaddexp.reduce(model.move + (s[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
            bwd[:, t] = np.where(real[:, t + 1, None], step, 0)
        here = np.exp(fwd + bwd - total[:, None, None]) * real[..., None]
        joint = np.exp(fwd[:, :-1, :, None] + model.move + (s + bwd)[:, 1:, None, :]
                       - total[:, None, None, None]) * pairs[..., None, None]
        grad = np.zeros((WIDTH, 2))
        np.add.at(grad, flat, (truth - here).reshape(-1, 2)[owner])
        grad = grad / n - decay * model.state
        move = (gold_move - joint.sum((0, 1))) / n - decay * model.move
        square_s += grad ** 2
        square_m += move ** 2
        model.state = model.state + rate * grad / np.sqrt(square_s)
        model.move = model.move + rate * move / np.sqrt(square_m)
    return model


# ----------------------------------------------------------- labelled pages

_MENU_MARKS = ("menu", "nav", "navbar", "topbar", "breadcrumb", "links", "toc", "pagination", "tags", "share", "social")
_SIDE_MARKS = ("sidebar", "aside", "widget", "related", "recommended", "promo", "popular")
_NOTICE_MARKS = ("notice", "cookie", "consent", "banner", "alert", "popup", "modal", "newsletter", "subscribe", "gdpr")
_AD_MARKS = ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "adsense", "promoted")
_COMMENT_MARKS = ("comment", "comments", "reply", "replies", "discussion", "disqus", "responses", "reader")
_MAIN_MARKS = ("content", "post", "entry", "body", "story", "text", "main", "article")


def labelled_page(texts: list[str], rng: random.Random) -> tuple[str, list[int]]:
    """A page in a random layout made of ``texts``, and the label of each of
    its leaf blocks.  Paragraphs of the article and of the boilerplate are
    drawn from the same texts, so only place and form tell them apart."""
    words = " ".join(texts).split() or ["text"]
    parts: list[str] = []
    labels: list[int] = []
    esc = entities.escape

    def some(n: int) -> str:
        at = rng.randrange(len(words))
        return " ".join((words * 2)[at:at + n])

    def put(markup: str, text: str, label: int) -> None:
        if text.strip():
            parts.append(markup.replace("{}", esc(text)))
            labels.append(label)

    def box(marks, tag: str, inner) -> None:
        mark = rng.choice(marks)
        attribute = rng.choice((f' class="{mark}"', f' id="{mark}"', f' class="{mark} box-{rng.randrange(9)}"'))
        parts.append(f"<{tag}{attribute}>")
        inner()
        parts.append(f"</{tag}>")

    def menu() -> None:
        for _ in range(rng.randint(2, 7)):
            put('<li><a href="/x">{}</a></li>', some(rng.randint(1, 3)), 0)

    def lines(tag: str = "p"):
        def inner() -> None:
            for _ in range(rng.randint(1, 3)):
                put(f"<{tag}>{{}}</{tag}>", some(rng.randint(3, 40)), 0)
        return inner

    def bare() -> None:
        put("{}", some(rng.randint(3, 30)), 0)

    def form() -> None:
        parts.append("<form>")
        put("<label>{}</label><input name=q>", some(rng.randint(1, 5)), 0)
        put("<button>{}</button>", some(rng.randint(1, 2)), 0)
        parts.append("</form>")

    def extra() -> None:
        kind = rng.randrange(8)
        if kind == 0:
            box(_AD_MARKS, "div", rng.choice((bare, lines())))
        elif kind == 1:
            box(_NOTICE_MARKS, "div", rng.choice((bare, lines())))
        elif kind == 2:
            form()
        elif kind == 3:
            parts.append("<aside>")
            rng.choice((bare, lines(), menu))()
            parts.append("</aside>")
        elif kind == 4:
            box(_SIDE_MARKS, rng.choice(("div", "section")), rng.choice((lines(), menu)))
        elif kind == 5:
            box(_MENU_MARKS, rng.choice(("div", "ul")), menu)
        elif kind == 6:
            parts.append(f"<!-- {some(2)} -->")
        else:
            box(_NOTICE_MARKS, "div", lines("span"))

    def comments() -> None:
        box(_COMMENT_MARKS, rng.choice(("div", "section", "ol", "ul")),
            rng.choice((lines(), lines("li"), lines("div"))))

    def article() -> None:
        if rng.random() < 0.9:
            put(f"<h{rng.choice((1, 1, 2))}>{{}}</h1>", some(rng.randint(3, 12)), 1)
        for i in range(rng.randint(1, 14)):
            text = rng.choice(texts) if rng.random() < 0.7 else some(rng.randint(1, 80))
            put(rng.choice(("<p>{}</p>",) * 6 + ("<p>{}", "<p><b>{}<br>", "<h2>{}</h2>", "<blockquote>{}</blockquote>",
                                                 "<ul><li>{}</li></ul>", "<p><a href='/y'>{}</a></p>", "<div>{}</div>")),
                text, 1)
            if rng.random() < 0.06:
                rng.choice((extra, extra, comments))()

    parts.append("<!DOCTYPE html><html><head><title>t</title><script>var a='<p>';</script></head><body>")
    if rng.random() < 0.8:
        top = rng.choice(("nav", "header", "div"))
        if top == "div":
            box(_MENU_MARKS, "div", menu)
        else:
            parts.append(f"<{top}><ul>")
            menu()
            parts.append(f"</ul></{top}>")
    for _ in range(rng.randint(0, 3)):
        extra()
    holder = rng.choice(("article", "article", "article", "main", "div"))
    parts.append(f"<{holder}>" if holder != "div" else f'<div class="{rng.choice(_MAIN_MARKS)}">')
    article()
    if rng.random() < 0.25:
        comments()
    parts.append(f"</{holder}>")
    for _ in range(rng.randint(0, 2)):
        rng.choice((extra, comments))()
    if rng.random() < 0.8:
        parts.append("<footer>")
        rng.choice((bare, lines(), menu))()
        parts.append("</footer>")
    parts.append("</body></html>")
    return "".join(parts), labels


def labelled_pages(samples: list[str], layouts: int = 3, seed: int = 1) -> list[list[Block]]:
    """Blocks with labels of ``layouts`` layouts for each sampled page."""
    rng, out = random.Random(seed), []
    for page in samples:
        texts = [b.text[:2000] for b in blocks(page) if "p" in b.path] or ["Text."]
        for _ in range(layouts):
            markup, labels = labelled_page(texts[:40], rng)
            got = blocks(markup)
            if len(got) == len(labels):
                for b, label in zip(got, labels):
                    b.label = label
                out.append(got)
    return out


#: Pages that the training layouts are made of (the first by hash of the url
#: and id), at most; and code points taken of each.
TRAINING_PAGES = 120
TRAINING_CHARS = 20_000


def learn(pages: DataFrame, key: str = "page_id", html: str = "html",
          n: int = TRAINING_PAGES) -> ChainModel:
    """A model for these pages, from at most ``n`` sampled ones; without any
    page, from fixed words."""
    h = F.substring(pages[html].cast("string"), 1, TRAINING_CHARS)
    hashes = pages.filter(pages[html].isNotNull()).select(F.xxhash64(pages[key]).alias("k"), F.xxhash64(h).alias("d"))
    # first which pages, by their hashes alone, then only those
    chosen = hashes.distinct().orderBy("k", "d").limit(n).collect()
    if not chosen:
        return fit(labelled_pages(["<p>Some words of text.</p>"] * 40))
    wanted = F.struct(F.xxhash64(pages[key]).alias("k"), F.xxhash64(h).alias("d"))
    rows = (pages.select(wanted.alias("w"), h.alias("h")).filter(F.col("w").isin(
        [F.struct(F.lit(r.k).alias("k"), F.lit(r.d).alias("d")) for r in chosen]))
        .groupBy("w").agg(F.min("h").alias("h")).collect())  # at most n rows of TRAINING_CHARS code points
    return fit(labelled_pages([r["h"] for r in sorted(rows, key=lambda r: tuple(r["w"]))]))


def main_text(page: str | None, model: ChainModel) -> str:
    bs = blocks(page)
    return " ".join(b.text for b, keep in zip(bs, model.decode(features(bs))) if keep)


def extract(pages: DataFrame, model: ChainModel, key: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """(key, url, text): the main text of every row's whole html (null or
    empty: the empty text).  Repeated rows each give a row."""
    held = pages.sparkSession.sparkContext.broadcast((model.state, model.move))

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = ChainModel(*held.value)
        for s in batches:
            yield pd.Series([main_text(x, own) for x in s], dtype=object)

    return pages.select(pages[key], pages[url], text(pages[html].cast("string")).alias("text"))
