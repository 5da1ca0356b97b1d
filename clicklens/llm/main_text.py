"""Main text of web pages: a recurrent labeller of text blocks.

A page is cut into leaf blocks (runs of text between block-level tags), each
with its tag path (open elements with their class and id words) and its text.
A bidirectional LSTM reads the blocks of the whole page, as hashed tag-path
and word vectors with a few ratios, and gives each block the probability that
it belongs to the article; kept blocks are joined by line breaks.

The labeller is trained on page layouts with known labels, filled with the
words of a bounded sample of the given pages (``SAMPLE_PAGES``): articles of
many kinds of markup among menus, headers, footers, sidebars, notices,
adverts, forms, related links and reader comments. Training is seeded, so
reruns agree.

Scripts, styles and other raw elements are never blocks. One that is not closed
inside its parent loses its tag alone, so that the page's text stays; scripts,
styles, titles and text areas run to the page's end. Character references
are decoded, white space in a block becomes one space, empty blocks go. Cutting
takes time linear in the page, and a page of more than ``BATCH_BLOCKS`` blocks is
scored in parts, so that broken or endless markup is bounded in time and memory.

Defined cases: a null page is empty and has no text; text without markup is
one block; broken markup is read to its end; repeated rows are all returned;
an empty table gives no rows (and trains on built-in words). ``extract`` keeps
the input's other columns and replaces one named like its result.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements of HTML that stand inside a line of text, that have no content, and whose content is not text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template title textarea svg math iframe object select".split())
#: Of these, text to the closing tag, or to the page's end; elements that a slash closes; the others hold elements.
RAW_TEXT, FOREIGN = frozenset("script style title textarea".split()), frozenset("svg math".split())
#: A start tag of the first kind ends an open element of the second, up to the nearest of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>", re.S
)
_ATTR = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")

PATH_DIMS, WORD_DIMS, RATIOS = 192, 48, 8
DIMS = PATH_DIMS + WORD_DIMS + RATIOS
HIDDEN = 20
SAMPLE_PAGES = 400
#: Characters of a sampled page, from its start, and of a block of it, that training layouts are filled from.
SAMPLE_CHARS, SAMPLE_BLOCK_CHARS = 20_000, 600
TRAIN_PAGES, EPOCHS, SEED = 600, 14, 7
#: Blocks of a batch of pages that are scored together; a longer page is scored in parts of as many.
BATCH_BLOCKS = 8192


_START = re.compile(r"(<!--)|<(/?)([a-zA-Z][^\s/>]*+)|<[!?][^>]*+>")
_QUOTED = re.compile("[>\"']")
_IFRAME = re.compile(r"<(/?)iframe(?=[\s/>])[^>]*+>", re.I)


@dataclass
class Tag:
    start: int
    end: int
    name: str  # empty: a comment or declaration
    closing: bool
    attributes: str


class Tags:
    """Finds a page's tags, in time linear in the page.

    A tag ends at the first ``>`` outside its quotes, or at the first ``>`` if
    there is none outside. The pattern finds that out by reading on, at worst to
    the page's end; the first time that it does so in vain, the ends of all
    further tags are worked out in one pass from the end.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        #: Behind the last ``>`` only a comment can begin.
        self.last = page.rfind(">") + 1
        self.marks: list[int] | None = None
        self.ends: list[int] = []

    def next(self, at: int) -> Tag | None:
        if self.marks is None:
            m = _TAG.search(self.page, at, self.last)
            if m is None:
                return self._comment(self.page.find("<!--", max(at, self.last)))
            if m[5] is None:
                if m[2] is None and m[0].startswith("<!--"):
                    return self._comment(m.start())
                return Tag(m.start(), m.end(), (m[2] or "").lower(), bool(m[1]), m[3] or "")
            self._work_out()
        m = _START.search(self.page, at, self.last)
        if m is None:
            return self._comment(self.page.find("<!--", max(at, self.last)))
        if m[1]:
            return self._comment(m.start())
        if m[3] is None:
            return Tag(m.start(), m.end(), "", False, "")
        place = bisect_left(self.marks, m.end())
        end = self.ends[place] if place < len(self.ends) else -1
        if end < 0:
            end = self.page.find(">", m.end())
        return Tag(m.start(), end + 1, m[3].lower(), bool(m[2]), self.page[m.end() : end])

    def _comment(self, start: int) -> Tag | None:
        if start < 0:
            return None
        end = self.page.find("-->", start + 4)
        return Tag(start, len(self.page) if end < 0 else end + 3, "", False, "")

    def _work_out(self) -> None:
        """``ends``: of each quote or ``>``, where a tag ends that is read up to there outside quotes (-1: nowhere)."""
        self.marks = [m.start() for m in _QUOTED.finditer(self.page)]
        self.ends = [-1] * len(self.marks)
        plain = double = single = -1  # the end from here on, read outside quotes or inside either kind
        for i in range(len(self.marks) - 1, -1, -1):
            c = self.page[self.marks[i]]
            if c == ">":
                plain = self.marks[i]
            elif c == '"':
                plain, double = double, plain
            else:
                plain, single = single, plain
            self.ends[i] = plain


def _raw_text_end(page: str, name: str, at: int) -> int:
    end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
    return end.end() if end else len(page)


def _raw_ends(tags: Tags) -> dict[int, int]:
    """Where the raw elements that are closed inside their parents end, by the place after their start tags."""
    page = tags.page
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    held: dict[str, int] = {}
    at = 0
    while tag := tags.next(at):
        at, name = tag.end, tag.name
        # Tags that may be left out or stand across others end no parent.
        if not name or name in INLINE or name in VOID or name == "p":
            continue
        if tag.closing:
            if held.get(name):
                while True:
                    top, start = stack.pop()
                    held[top] -= 1
                    if top == name:
                        break
                if name in RAW:
                    ends[start] = at
        elif name in RAW_TEXT:
            at = _raw_text_end(page, name, at)
        elif name == "iframe":
            end = _IFRAME.search(page, at, tags.last)
            if end and end[1]:
                ends[at] = at = end.end()
        elif not (name in FOREIGN and tag.attributes.rstrip().endswith("/")):
            stack.append((name, at))
            held[name] = held.get(name, 0) + 1
    return ends


@dataclass(eq=False)
class Element:
    """An open element: its name with its class and id words, and what it takes over from those around it."""

    around: Element | None
    names: tuple[str, ...]
    depth: int  # names up to here
    bits: int  # hashed names up to here

    @staticmethod
    def within(around: Element | None, names: list[str]) -> Element:
        bits = around.bits if around else 0
        for n in names:
            bits |= 1 << _place(n) % PATH_DIMS
        return Element(around, tuple(names), (around.depth if around else 0) + len(names), bits)


@dataclass
class Block:
    element: Element | None
    text: str
    linked: int  # characters inside links

    @property
    def path(self) -> tuple[str, ...]:
        parts, e = [], self.element
        while e:
            parts.append(e.names)
            e = e.around
        return tuple(n for names in reversed(parts) for n in names)


class Open:
    """The open elements, with the places of each name, so that no tag searches the whole stack."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, Element]] = []
        self.places: dict[str, list[int]] = {}
        self.solid: list[int] = []  # of elements that stand in no line

    @property
    def top(self) -> Element | None:
        return self.stack[-1][1] if self.stack else None

    def links(self) -> int:
        return len(self.places.get("a", ()))

    def push(self, name: str, names: list[str]) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name not in INLINE:
            self.solid.append(len(self.stack))
        self.stack.append((name, Element.within(self.top, names)))

    def pop_to(self, at: int) -> None:
        while len(self.stack) > at:
            name, _ = self.stack.pop()
            self.places[name].pop()
            if name not in INLINE:
                self.solid.pop()

    def close(self, name: str) -> None:
        """An end tag ends the nearest element of its name; one of a line does so inside its block only."""
        found = self.places.get(name)
        if found and not (name in INLINE and self.solid and self.solid[-1] > found[-1]):
            self.pop_to(found[-1])

    def make_room(self, name: str) -> None:
        """Ends what the start tag of a block ends: a paragraph it stands in, or elements of ``CLOSES``."""
        if name not in CLOSES:
            if self.solid and self.stack[self.solid[-1]][0] == "p":
                self.pop_to(self.solid[-1])
            return
        ended, within = CLOSES[name]
        barrier = max((self.places[n][-1] for n in within if self.places.get(n)), default=-1)
        lowest = len(self.stack)
        for n in ended | {"p"}:
            found = self.places.get(n, [])
            i = bisect_right(found, barrier)
            if i < len(found):
                lowest = min(lowest, found[i])
        self.pop_to(lowest)


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order."""
    if not page:
        return []
    out: list[Block] = []
    open_ = Open()
    tags = Tags(page)
    parts: list[str] = []
    linked = 0
    raw_ends: dict[int, int] | None = None

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(open_.top, text, linked))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if open_.links():
                linked += len(text)

    at = 0
    while tag := tags.next(at):
        add(page[at : tag.start])
        at, name = tag.end, tag.name
        if not name:
            continue
        inline = name in INLINE
        if not inline:
            end_block()
        elif name == "br":
            parts.append(" ")
        if tag.closing:
            open_.close(name)
            continue
        if name in RAW_TEXT:
            at = _raw_text_end(page, name, at)
            continue
        if name in RAW:
            if name not in FOREIGN or not tag.attributes.rstrip().endswith("/"):
                raw_ends = _raw_ends(tags) if raw_ends is None else raw_ends
                at = raw_ends.get(at, at)
            continue
        if name in VOID:
            continue
        if not inline:
            open_.make_room(name)
        names = [name]
        for a in _ATTR.findall(tag.attributes):
            names += [f".{w}" for w in _NAME.findall("".join(a).lower())]
        open_.push(name, names)
    add(page[at:])
    end_block()
    return out


# -------------------------------------------------------------------- vectors

_PLACES: dict[str, int] = {}


def _place(key: str) -> int:
    found = _PLACES.get(key)
    if found is None:
        if len(_PLACES) > 200_000:
            _PLACES.clear()
        found = _PLACES[key] = zlib.crc32(key.encode("utf-8", "surrogatepass"))
    return found


def vectors(blocks: list[Block], first: int = 0, total: int | None = None) -> np.ndarray:
    """One row per block: hashed tag path, hashed words, ratios.

    The blocks may be a part of a page of ``total`` blocks, from its ``first`` on.
    """
    n = len(blocks)
    total = n if total is None else total
    x = np.zeros((n, DIMS), np.float32)
    tops = [b.element for b in blocks]
    lasts = [1 << _place("last:" + (e.names[-1] if e else "")) % PATH_DIMS for e in tops]
    bits = b"".join(((e.bits if e else 0) | last).to_bytes(PATH_DIMS // 8, "little") for e, last in zip(tops, lasts, strict=True))
    x[:, :PATH_DIMS] = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").reshape(n, PATH_DIMS)
    words = [b.text.lower().split() for b in blocks]
    counts = np.array([len(w) for w in words])
    places = np.fromiter((_place(w) for ws in words for w in ws), np.int64, int(counts.sum()))
    owner = np.repeat(np.arange(n), counts)
    signs = np.where(places >> 16 & 1, 1.0, -1.0)
    bag = np.bincount(owner * WORD_DIMS + places % WORD_DIMS, signs, n * WORD_DIMS).reshape(n, WORD_DIMS)
    x[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = bag / np.sqrt(np.maximum(counts, 1))[:, None] * 0.5
    length = np.array([len(b.text) for b in blocks])
    r = x[:, PATH_DIMS + WORD_DIMS :]
    r[:, 0] = np.minimum(1, np.log1p(length) / 8)
    r[:, 1] = np.minimum(1, np.array([b.linked for b in blocks]) / np.maximum(length, 1))
    r[:, 2] = counts < 4
    r[:, 3] = [b.text[-1] in ".!?…:;\"”" for b in blocks]
    r[:, 4] = np.arange(first, first + n) / max(1, total)
    r[:, 5] = min(1, total / 100)
    r[:, 6] = [min(1, (e.depth if e else 0) / 12) for e in tops]
    r[:, 7] = 1
    return x


# ---------------------------------------------------------------------- model


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Labeller:
    """Two LSTMs, forward and backward, and a logistic layer over both states."""

    w: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def new(rng: np.random.Generator) -> Labeller:
        w = {}
        for d in "fb":
            w[f"x{d}"] = rng.normal(0, 0.15, (DIMS, 4 * HIDDEN))
            w[f"h{d}"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
            w[f"c{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        w["o"], w["oc"] = rng.normal(0, 0.15, 2 * HIDDEN), np.zeros(1)
        return Labeller({k: v.astype(np.float32) for k, v in w.items()})

    def _pass(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool, state: tuple[np.ndarray, np.ndarray] | None = None):
        """States (steps, pages, HIDDEN) of one direction, from ``state`` on; ``mask`` is 0 past a page's end."""
        steps, pages, _ = x.shape
        z_all = x @ self.w[f"x{d}"] + self.w[f"c{d}"]
        h, c = state or (np.zeros((pages, HIDDEN), np.float32),) * 2
        out, trace = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = z_all[t] + h @ self.w[f"h{d}"]
            i, f, o = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN : 2 * HIDDEN]), _sigmoid(z[:, 2 * HIDDEN : 3 * HIDDEN])
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c_new = (f * c + i * g) * m
            tc = np.tanh(c_new)
            h_new = o * tc * m
            if keep:
                trace.append((t, h, c, i, f, o, g, tc, m))
            h, c = h_new, c_new
            out[t] = h
        return out, trace, (h, c)

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._pass(d, x, mask, False)[0] for d in "fb"], axis=2)
        return _sigmoid(both @ self.w["o"] + self.w["oc"])

    def page_scores(self, blocks: list[Block], step: int) -> np.ndarray:
        """Scores of one page of any length; ``step`` blocks at a time stand as vectors, the state goes on."""
        both = np.zeros((len(blocks), 2 * HIDDEN), np.float32)
        starts = range(0, len(blocks), step)
        for k, (d, order) in enumerate((("f", starts), ("b", reversed(starts)))):
            state = None
            for at in order:
                x = vectors(blocks[at : at + step], at, len(blocks))[:, None]
                out, _, state = self._pass(d, x, np.ones((len(x), 1), np.float32), False, state)
                both[at : at + step, k * HIDDEN : (k + 1) * HIDDEN] = out[:, 0]
        return _sigmoid(both @ self.w["o"] + self.w["oc"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        (hf, tf, _), (hb, tb, _) = self._pass("f", x, mask, True), self._pass("b", x, mask, True)
        both = np.concatenate([hf, hb], axis=2)
        err = (_sigmoid(both @ self.w["o"] + self.w["oc"]) - y) * mask / max(1, mask.sum())
        g = {"o": np.einsum("tp,tph->h", err, both), "oc": np.array([err.sum()])}
        for d, trace, dh_all in (("f", tf, err[..., None] * self.w["o"][:HIDDEN]), ("b", tb, err[..., None] * self.w["o"][HIDDEN:])):
            dh = dc = np.zeros_like(trace[0][1])
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            gh = np.zeros_like(self.w[f"h{d}"])
            for t, h, c, i, f, o, gg, tc, m in reversed(trace):
                dht = (dh + dh_all[t]) * m
                dct = (dc + dht * o * (1 - tc * tc)) * m
                dz = np.concatenate([dct * gg * i * (1 - i), dct * c * f * (1 - f), dht * tc * o * (1 - o), dct * i * (1 - gg * gg)], axis=1)
                dz_all[t] = dz
                gh += h.T @ dz
                dh, dc = dz @ self.w[f"h{d}"].T, dct * f
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            g |= {f"x{d}": x.reshape(-1, DIMS).T @ flat, f"h{d}": gh, f"c{d}": flat.sum(axis=0)}
        return g


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), DIMS), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


def train(pages: list[tuple[np.ndarray, np.ndarray]]) -> Labeller:
    """Adam over shuffled batches of (vectors, labels)."""
    rng = np.random.default_rng(SEED)
    model = Labeller.new(rng)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(pages))
        for at in range(0, len(order), 24):
            batch = [pages[i] for i in order[at : at + 24]]
            x, mask = padded([b[0] for b in batch])
            y = np.zeros_like(mask)
            for k, b in enumerate(batch):
                y[: len(b[1]), k] = b[1]
            # Names that were never met must not decide alone: some path bits are left out.
            x[..., :PATH_DIMS] *= rng.random((1, x.shape[1], PATH_DIMS)) > 0.08
            step += 1
            rate = 0.02 * (0.8 if epoch < EPOCHS // 2 else 0.2)
            for k, g in model.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model.w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model


# -------------------------------------------------------------- labelled pages

#: Markup of articles and of what surrounds them, as (opening tags, item tag).
ARTICLES = (
    ("<article>", "p"), ("<main>", "p"), ("<main><article>", "p"), ('<div class="content">', "p"), ('<div id="content">', "p"),
    ('<div class="post-body">', "p"), ('<div class="entry-content">', "p"), ('<div class="article-body">', "div"), ('<section class="story">', "p"),
    ('<div id="main"><div class="text">', "p"), ('<article class="post">', "p"), ("<div><div>", "p"), ("<td>", "p"), ('<div role="main">', "p"),
    ('<article class="article"><section>', "p"),
)
AROUND = {
    "menu": ("<nav><ul>", '<ul class="menu">', '<div id="nav"><ul>', '<div class="navbar"><ul>', '<nav class="breadcrumb"><ul>', '<div class="topmenu">', '<div role="navigation"><ul>'),
    "header": ("<header>", '<div id="header">', '<div class="site-header">', '<div class="masthead">', '<div class="banner">', '<header class="page-header">'),
    "footer": ("<footer>", '<div id="footer">', '<div class="site-footer">', '<footer class="legal">', '<div class="copyright">'),
    "sidebar": ("<aside>", '<div class="sidebar">', '<div id="sidebar">', '<aside class="widget">', '<div class="related-posts"><ul>', '<div class="widget recent"><ul>', '<section class="related">'),
    "notice": ('<div class="cookie-notice">', '<div class="notice">', '<div id="cookie-banner">', '<div class="newsletter">', '<div class="alert message">', '<div class="consent">', '<div class="popup modal">', '<div role="alert">'),
    "advert": ('<div class="ad">', '<div class="ads">', '<div class="advert">', '<div id="ad-top">', '<div class="sponsored">', '<aside class="promo">', '<div class="banner-ad">', '<div class="advertisement">'),
    "form": ("<form>", '<form class="search">', '<form id="login">', '<div class="subscribe"><form>'),
    "comments": ('<div class="comments">', '<section id="comments">', '<div id="disqus-comments"><div class="comment">', '<ol class="comment-list">', '<div class="reader-comments">', '<section class="comments discussion">', '<div class="responses">'),
}
_WORDS = "the of and a to in is was that it for on with as by at from or an be this which are not have had but one all".split()


def _closing(opening: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<([a-z0-9]+)", opening)))


def labelled_page(rng: np.random.Generator, texts: list[str], words: list[str]) -> tuple[list[Block], np.ndarray]:
    """A random layout filled with ``texts`` and ``words``; label 1 for blocks of the article."""
    pick = lambda options: options[int(rng.integers(len(options)))]
    some = lambda lo, hi: " ".join(pick(words) for _ in range(int(rng.integers(lo, hi))))
    marks: list[str] = []
    labels = {"1": 1.0, "0": 0.0}

    def put(kind: int, text: str) -> str:
        marks.append(str(kind))
        return f"{text or 'x'}"

    def body(kind: str) -> str:
        opening = pick(AROUND[kind])
        if kind == "menu" or opening.endswith("<ul>") or kind == "sidebar" and rng.random() < 0.5:
            items = [f"<li><a href='/x'>{put(0, some(1, 4))}</a></li>" for _ in range(int(rng.integers(2, 9)))]
            inner = "".join(items) if "<ul" in opening else f"<ul>{''.join(items)}</ul>"
        elif kind == "form":
            inner = f"<label>{put(0, some(1, 4))}</label><input>"
        elif kind in ("comments", "notice", "advert", "sidebar"):
            tag = pick(("p", "div", "li", "h3", ""))
            n = int(rng.integers(1, 6)) if kind == "comments" else int(rng.integers(1, 3))
            parts = [put(0, pick(texts) if rng.random() < 0.6 else some(2, 14)) for _ in range(n if tag else 1)]
            inner = "".join(f"<{tag}>{p}</{tag}>" if tag else p for p in parts)
        else:
            tag = pick(("p", "div", "", "h1" if kind == "header" else "p"))
            text = put(0, ("&copy; " if kind == "footer" and rng.random() < 0.6 else "") + (pick(texts) if rng.random() < 0.4 else some(1, 12)))
            inner = f"<{tag}>{text}</{tag}>" if tag else text
        return f"{opening}{inner}{_closing(opening)}"

    def article() -> str:
        opening, item = pick(ARTICLES)
        out = []
        if rng.random() < 0.8:
            tag = pick(("h1", "h1", "h2"))
            out.append(f"<{tag}>{put(1, some(1, 12))}</{tag}>")
        for _ in range(int(rng.integers(1, 12))):
            r = rng.random()
            text = pick(texts) if r < 0.75 else some(1, 5) if r < 0.9 else some(5, 60)
            r = rng.random()
            if r < 0.72:
                out.append(f"<{item}>{put(1, text)}</{item}>")
            elif r < 0.8:
                out.append(f"<p><b>{put(1, text)}<br>")
            elif r < 0.86:
                out.append(f"<h2>{put(1, some(1, 6))}</h2>")
            elif r < 0.92:
                out.append("<ul>" + "".join(f"<li>{put(1, some(2, 12))}</li>" for _ in range(int(rng.integers(1, 4)))) + "</ul>")
            elif r < 0.96:
                out.append(f"<blockquote><p>{put(1, text)}</p></blockquote>")
            else:
                out.append(f"<p>{put(1, text)} <a href='/y'>{some(1, 4)}</a> {some(1, 4)}</p>")
            if rng.random() < 0.06:
                out.append(body(pick(("advert", "notice", "sidebar"))))
        if rng.random() < 0.15:
            out.append(body("comments"))
        return f"{opening}{''.join(out)}{_closing(opening)}"

    before = [k for k in ("notice", "header", "menu", "advert", "form", "sidebar") if rng.random() < 0.5]
    after = [k for k in ("comments", "sidebar", "advert", "form", "menu", "footer", "notice") if rng.random() < 0.4]
    page = "".join(body(k) for k in before) + article() + "".join(body(k) for k in after)
    if rng.random() < 0.3:
        page = f'<div class="{pick(("wrapper", "page", "container", "site"))}">{page}</div>'
    blocks = blocks_of(f"<html><body>{page}</body></html>")
    if len(blocks) != len(marks):
        raise ValueError("a layout's blocks differ from its labels")
    return blocks, np.array([labels[m] for m in marks], np.float32)


def fit(pages: DataFrame, html: str = "html") -> Labeller:
    """Trains on layouts filled with the text of at most ``SAMPLE_PAGES`` pages, those of the lowest hashes."""
    # A hash thins the pages before the lowest are taken: each task sends its own lowest to the driver.
    rate = min(1.0, 3 * SAMPLE_PAGES / max(1, pages.count()))
    h = F.xxhash64(*pages.columns)
    thin = pages.filter(F.col(html).isNotNull() & (F.pmod(h, F.lit(1 << 30)) <= int(rate * (1 << 30))))
    part = thin.select(F.substring(F.col(html), 1, SAMPLE_CHARS).alias("html"), h.alias("h"))
    rows = part.orderBy("h", "html").limit(SAMPLE_PAGES).collect()
    texts = sorted({entities.escape(b.text[:SAMPLE_BLOCK_CHARS]) for r in rows for b in blocks_of(r["html"])})
    words = sorted({w for t in texts for w in t.split()})[:: max(1, len(texts) // 2000)] or _WORDS
    rng = np.random.default_rng(SEED)
    made = [labelled_page(rng, texts or _WORDS, words) for _ in range(TRAIN_PAGES)]
    return train([(vectors(b), y) for b, y in made])


def extract(pages: DataFrame, model: Labeller, html: str = "html", result: str = "text") -> DataFrame:
    """``pages`` without the html column, with the main text as ``result``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in pages.columns if c not in (html, result)]
    rows = pages.select(*keep, F.col(html).alias("_html"))
    schema = pages.select(*keep, F.lit("").alias(result)).schema

    def kept(group: list[tuple[int, list[Block]]], out: list[str]) -> None:
        if len(group) == 1 and len(group[0][1]) > BATCH_BLOCKS:
            i, blocks = group[0]
            out[i] = "\n".join(b.text for b, s in zip(blocks, shared.value.page_scores(blocks, BATCH_BLOCKS), strict=True) if s > 0.5)
            return
        xs = [vectors(b) for _, b in group]
        x, mask = padded(xs)
        p = shared.value.scores(x, mask)
        for k, (i, blocks) in enumerate(group):
            out[i] = "\n".join(b.text for b, s in zip(blocks, p[: len(blocks), k], strict=True) if s > 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                out = [""] * part.num_rows
                cut = [(i, blocks_of(h)) for i, h in enumerate(part.column(part.num_columns - 1).to_pylist())]
                cut = sorted((c for c in cut if c[1]), key=lambda c: len(c[1]))
                group: list[tuple[int, list[Block]]] = []
                for c in cut:  # pages of like length go together
                    if group and (len(group) + 1) * len(c[1]) > BATCH_BLOCKS:
                        kept(group, out)
                        group = []
                    group.append(c)
                if group:
                    kept(group, out)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(out, pa.string())], schema.names)

    return rows.mapInArrow(run, schema)
