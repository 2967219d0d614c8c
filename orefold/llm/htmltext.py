"""Main text of web pages: a linear-chain conditional random field over the blocks of the page.

A page is cut into blocks, the text between the starts and ends of block elements; inline tags belong to the text. Each block
has features of its ancestors (tag names, words of their class, id and role) and of its text (length, share of
link text, punctuation, place). The field has one weight per feature, for main text against the rest, and weights for
neighbouring labels; it is trained by its likelihood's gradient (forward-backward) and decoded by Viterbi.

Labelled pages are of two kinds: layouts written down here with a label on each part (``layouts``), and a bounded sample of the
given pages (``SAMPLE`` rows by a hash) that mark their article themselves, whose blocks get labels from that markup.

Cases: null, empty or tagless html: without a tag the whole is one block and kept if the field says so; a page
without main blocks has empty text; scripts, styles, comments, form controls and head titles are no blocks at all;
unclosed tags end with their parent, unclosed elements without text of their own with the next block, and a head
with the first element or text that can't stand in it; repeated pages are extracted one by one; only the named columns are read.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .base import slices

SAMPLE = 400

# FIXED: element names of HTML.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
SILENT = frozenset("script style noscript template title textarea select button iframe object svg math canvas audio video head datalist".split())
RAW = frozenset("script style textarea title iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK - {"body", "html", "head"}
_NOT_MAIN = frozenset("nav aside footer form".split())
_NAMED = frozenset("article main nav aside footer header form".split())
_UNLIKE = frozenset("ad ads advert comment comments sidebar cookie notice".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())

_NAME_END = re.compile(r"[\s/>]|\Z")
_SPECIAL = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""(class|id|role|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z]+|\d+")


class Node:
    """An open block element: what it adds to the features of what stands in it. ``fresh``: features of its ancestors' kind that no ancestor has."""

    __slots__ = ("article", "broken", "fresh", "gold", "marked", "named", "parent", "tag")

    def __init__(self, parent: Node | None, tag: str, words: tuple[str, ...], gold: int | None, fresh: list[str]):
        self.parent, self.tag, self.fresh = parent, tag, fresh
        self.gold = gold if gold is not None or parent is None else parent.gold
        self.article = tag in ("article", "main") or (parent is not None and parent.article)
        self.broken = (parent is not None and parent.broken) or (self.article and tag in _NOT_MAIN)
        self.marked = (parent is not None and parent.marked) or not _UNLIKE.isdisjoint(words)
        self.named = (parent.named if parent else frozenset()) | (_NAMED & {tag})

    def own(self) -> list[str]:
        """Features that are the element's alone, not handed on."""
        return [f"tag {self.tag}", f"pair {self.parent.tag if self.parent else ''} {self.tag}"]


class Stack:
    """Open elements by place and by name, so that the last one of a name is found at once."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.values: list = []
        self.places: dict[str, list[int]] = {}

    def __len__(self) -> int:
        return len(self.names)

    def push(self, name: str, value: object) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.values.append(value)

    def last(self, name: str) -> int | None:
        found = self.places.get(name)
        return found[-1] if found else None

    def top(self) -> str | None:
        return self.names[-1] if self.names else None

    def cut(self, k: int) -> list:
        """Takes off what stands from place k on."""
        for name in reversed(self.names[k:]):
            self.places[name].pop()
        gone = self.values[k:]
        del self.names[k:], self.values[k:]
        return gone


class Block:
    __slots__ = ("links", "node", "text")

    def __init__(self, text: str, links: int, node: Node | None):
        self.text, self.links, self.node = text, links, node

    @property
    def gold(self) -> int | None:
        return self.node.gold if self.node else None


class Ends:
    """Where tags end, for a whole page at once: from each quote on, the ``>`` that comes when quoted text is passed over."""

    def __init__(self, page: str):
        self.page = page
        self.at = [m.start() for m in _SPECIAL.finditer(page)]
        n = len(self.at)
        self.end = [-1] * (n + 1)
        self.plain = [-1] * (n + 1)  # the next > whatever is quoted
        following = {'"': n, "'": n}
        for k in range(n - 1, -1, -1):
            c = page[self.at[k]]
            if c == ">":
                self.end[k] = self.plain[k] = self.at[k]
            else:
                shut = following[c]
                self.end[k] = self.end[shut + 1] if shut < n else -1
                self.plain[k] = self.plain[k + 1]
                following[c] = k
        self.name_from, self.name_to = 0, 0

    def of(self, start: int, quoted: bool) -> int:
        """The end of a tag whose name or mark ends at ``start``; -1: none."""
        k = bisect.bisect_left(self.at, start)
        return (self.end if quoted else self.plain)[k]

    def name(self, start: int) -> int:
        """Where the name ends that begins at ``start``; names within one another are looked at once."""
        if not self.name_from <= start < self.name_to:
            self.name_from, self.name_to = start, _NAME_END.search(self.page, start).start()
        return self.name_to


def tags(page: str) -> list[tuple[int, int, str, bool, str]]:
    """Start and end in the page, name, whether it is an end tag, attributes; a comment has no name, what RAW elements hold is part of their tag.

    One pass; what doesn't end is text. A ``>`` in a quoted value doesn't end a tag, unless the quotes never close.
    """
    out: list[tuple[int, int, str, bool, str]] = []
    ends, at = Ends(page), page.find("<")
    while at >= 0:
        follow = page[at + 1 : at + 2]
        skip_to = at + 1
        if page.startswith("<!--", at):
            shut = page.find("-->", at + 4)
            skip_to = shut + 3 if shut >= 0 else len(page)
            out.append((at, skip_to, "", False, ""))
        elif follow in ("!", "?"):
            end = ends.of(at + 2, False)
            if end >= 0:
                skip_to = end + 1
                out.append((at, skip_to, "", False, ""))
        else:
            first = at + 2 if follow == "/" else at + 1
            if page[first : first + 1].isascii() and page[first : first + 1].isalpha():
                stop = ends.name(first)
                end = ends.of(stop, True)
                end = ends.of(stop, False) if end < 0 else end
                if end >= 0:
                    name, skip_to = page[first:stop].lower(), end + 1
                    if name in RAW and follow != "/":
                        shut = _RAW_END[name].search(page, skip_to)
                        skip_to = shut.end() if shut else len(page)
                    out.append((at, skip_to, name, follow == "/", page[stop:end]))
        at = page.find("<", skip_to)
    return out


_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}


def _opens_silence(name: str, attributes: str) -> bool:
    return name in SILENT and name not in RAW and not (name in ("svg", "math") and attributes.endswith("/"))


def _unclosed(found: list[tuple[int, int, str, bool, str]]) -> set[int]:
    """Which tags start a silent element that ends with its parent or the page, not by its own end tag."""
    out: set[int] = set()
    stack = Stack()

    def cut(k: int) -> None:
        out.update(i for i in stack.cut(k) if found[i][2] in SILENT)

    for i, (_, _, name, closing, attributes) in enumerate(found):
        if name == "head" or name in VOID or not (name in BLOCK or name in SILENT):
            continue
        at = stack.last(name) if closing or name in ("button", "select") else None
        if closing:
            if at is not None:
                cut(at + 1)
                stack.cut(at)
        else:
            if at is not None:  # a button can't stand in a button
                cut(at)
            if name in BLOCK or _opens_silence(name, attributes):
                stack.push(name, i)
    cut(0)
    return out


def blocks(page: str | None) -> list[Block]:
    """Blocks in page order; ``node`` is the innermost open block element of each."""
    out: list[Block] = []
    if not page:
        return out
    stack = Stack()
    held: dict[str, int] = {}  # features of the open elements, and how many have each
    parts: list[tuple[str, bool]] = []
    anchors, at = 0, 0
    quiet: int | None = None  # place in the stack of the first silent element
    loose: int | None = None  # and of the first that has no end tag

    def cut(k: int) -> None:
        nonlocal quiet, loose
        for node in stack.cut(k):
            for f in node.fresh:
                del held[f]
        quiet = None if quiet is not None and quiet >= k else quiet
        loose = None if loose is not None and loose >= k else loose

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = sum(len(p) for p, a in parts if a)
                whole = sum(len(p) for p, _ in parts)
                depth = len(stack) if quiet is None else quiet
                out.append(Block(text, round(10 * linked / whole), stack.values[depth - 1] if depth else None))
            parts.clear()

    found = tags(page)
    unclosed = _unclosed(found)
    for i, (start, end, name, closing, attributes) in enumerate(found):
        if start > at:
            if stack.top() == "head" and not page[at:start].isspace():
                cut(len(stack) - 1)
            if quiet is None:
                parts.append((page[at:start], anchors > 0))
        at = end
        if not name or (name in RAW and not closing):
            continue
        if not closing and name not in IN_HEAD and stack.top() == "head":
            cut(len(stack) - 1)
        if loose is not None and name in BLOCK and name not in ("option", "hr"):
            cut(loose)
        if name == "body" and not closing and quiet is not None:
            cut(quiet)
        silences = not closing and _opens_silence(name, attributes)
        if name == "br":
            parts.append((" ", False))
        elif name == "a":
            anchors = max(0, anchors - 1) if closing else anchors + 1
        elif name in BLOCK or name in SILENT:
            if name in BLOCK:
                flush()
            if closing:
                k = stack.last(name)
                if k is not None:
                    cut(k)
            elif name not in VOID and (name in BLOCK or silences):
                if (name in CLOSES_P and stack.top() == "p") or (name == "li" and stack.top() == "li"):
                    cut(len(stack) - 1)
                if name == "li" and stack.top() == "li":
                    cut(len(stack) - 1)
                words, gold = (), None
                if attributes:
                    own = [(k.lower(), a or b or c or "") for k, a, b, c in _ATTRIBUTE.findall(attributes)]
                    words = tuple(sorted({w for k, v in own if k != "data-label" for w in _PART.findall(v.lower())}))
                    gold = next((int(v) for k, v in own if k == "data-label"), None)
                if silences:
                    quiet = len(stack) if quiet is None else quiet
                    loose = len(stack) if loose is None and i in unclosed else loose
                fresh = [f for f in (f"in {name}", *(f"word {w}" for w in words)) if f not in held]
                held.update(dict.fromkeys(fresh, 1))
                stack.push(name, Node(stack.values[-1] if len(stack) else None, name, words, gold, fresh))
                if name in BLOCK:
                    anchors = 0
    if at < len(page) and stack.top() == "head" and not page[at:].isspace():
        cut(len(stack) - 1)
    if at < len(page) and quiet is None:
        tail = page[at:]
        opens = _OPEN_TAIL.search(tail, tail.rfind(">") + 1)
        parts.append((tail[: opens.start()] if opens else tail, anchors > 0))
    flush()
    return out


_OPEN_TAIL = re.compile(r"<[a-zA-Z/!]")


def inherited(node: Node | None) -> list[str]:
    """Features that a block has from the elements around it."""
    out = []
    up = node
    while up is not None:
        out += up.fresh
        up = up.parent
    return sorted(out)


def alone(node: Node | None) -> list[str]:
    return [*(node.own() if node else []), "named " + " ".join(sorted(node.named) if node else [])]


def of_text(page: list[Block], i: int) -> list[str]:
    b = page[i]
    words = b.text.count(" ") + 1
    return [
        f"words {min(8, int(math.log2(words)))}",
        f"links {0 if not b.links else 1 if b.links < 4 else 2 if b.links < 8 else 3}",
        f"stop {b.text[-1] in '.!?:;'}",
        f"sign {'©' in b.text or '|' in b.text}",
        f"first {i == 0}",
        f"last {i == len(page) - 1}",
    ]


def features(page: list[Block]) -> list[list[str]]:
    """All features of each block, for training."""
    cache: dict[int, list[str]] = {}
    out = []
    for i, b in enumerate(page):
        own = cache.get(id(b.node))
        if own is None:
            own = cache[id(b.node)] = [*inherited(b.node), *alone(b.node)]
        out.append([*own, *of_text(page, i)])
    return out


class Field:
    """Labels 0 and 1; ``weights`` speak for label 1, ``move[a, b]`` for b after a, ``start`` and ``end`` for the ends."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, move: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.names, self.weights, self.move, self.start, self.end = names, weights, move, start, end

    def weigh(self, own: list[str]) -> float:
        get, w = self.names.get, self.weights
        return float(sum(w[k] for k in map(get, own) if k is not None))

    def speak(self, page: list[Block]) -> list[float]:
        """What each block's features say for label 1. An element's share is its parent's and what it adds, so each element is looked at once."""
        share: dict[int, float] = {id(None): 0.0}
        own: dict[int, float] = {}
        out = []
        for i, b in enumerate(page):
            chain, up = [], b.node
            while id(up) not in share:
                chain.append(up)
                up = up.parent
            for node in reversed(chain):
                share[id(node)] = share[id(node.parent)] + self.weigh(node.fresh)
            if id(b.node) not in own:
                own[id(b.node)] = share[id(b.node)] + self.weigh(alone(b.node))
            out.append(own[id(b.node)] + self.weigh(of_text(page, i)))
        return out

    def decode(self, page: list[float]) -> list[int]:
        """Viterbi over what each block says for label 1; ties go to label 1."""
        move = self.move.tolist()
        best, back = [], []
        for i, u in enumerate(page):
            if not i:
                best = [float(self.start[0]), float(self.start[1] + u)]
                continue
            step, new = [], []
            for b in (0, 1):
                zero, one = best[0] + move[0][b], best[1] + move[1][b]
                step.append(int(one >= zero))
                new.append(max(zero, one) + (u if b else 0.0))
            best = new
            back.append(step)
        if not page:
            return []
        label = int(best[1] + self.end[1] >= best[0] + self.end[0])
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], *, rounds: int = 200, rate: float = 1.0, decay: float = 1e-4) -> Field:
    """Maximum likelihood with a quadratic penalty, by AdaGrad over all pages at once."""
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    for own, _ in pages:
        for block in own:
            for f in block:
                names.setdefault(f, len(names))
    n, t = len(pages), max((len(p[0]) for p in pages), default=1)
    gold, mask = np.zeros((n, t), int), np.zeros((n, t), bool)
    where, which = [], []
    for i, (own, labels) in enumerate(pages):
        gold[i, : len(own)], mask[i, : len(own)] = labels, True
        for j, block in enumerate(own):
            where += [i * t + j] * len(block)
            which += [names[f] for f in block]
    where, which = np.array(where, int), np.array(which, int)
    size = mask.sum(1)
    theta = np.zeros(len(names) + 8)  # weights, move, start, end
    seen = np.full(len(theta), 1e-6)
    rows = np.arange(n)
    for _ in range(rounds):
        w, move, start, end = theta[: len(names)], theta[len(names) : -4].reshape(2, 2), theta[-4:-2], theta[-2:]
        unary = np.zeros((n, t, 2))
        unary[:, :, 1] = np.bincount(where, weights=w[which], minlength=n * t).reshape(n, t)
        fore, hind = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        fore[:, 0] = start + unary[:, 0]
        for k in range(1, t):
            step = np.logaddexp(fore[:, k - 1, 0, None] + move[0], fore[:, k - 1, 1, None] + move[1]) + unary[:, k]
            fore[:, k] = np.where(mask[:, k, None], step, fore[:, k - 1])
        hind[rows, size - 1] = end
        for k in range(t - 2, -1, -1):
            nxt = unary[:, k + 1] + hind[:, k + 1]
            step = np.logaddexp(move[:, 0] + nxt[:, 0, None], move[:, 1] + nxt[:, 1, None])
            hind[:, k] = np.where((mask[:, k + 1])[:, None], step, np.where((size - 1 == k)[:, None], end, 0))
        z = np.logaddexp(*(fore[rows, size - 1] + end).T)
        p = np.exp(fore + hind - z[:, None, None]) * mask[:, :, None]
        grad = np.zeros_like(theta)
        grad[: len(names)] = np.bincount(which, weights=((gold - p[:, :, 1]) * mask).reshape(-1)[where], minlength=len(names))
        both = mask[:, 1:]
        pair = np.exp(fore[:, :-1, :, None] + move + (unary + hind)[:, 1:, None, :] - z[:, None, None, None]) * both[:, :, None, None]
        moved = np.zeros((2, 2))
        np.add.at(moved, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        grad[len(names) : -4] = (moved - pair.sum((0, 1))).reshape(-1)
        grad[-4:-2] = np.bincount(gold[:, 0], minlength=2) - p[:, 0].sum(0)
        grad[-2:] = np.bincount(gold[rows, size - 1], minlength=2) - p[rows, size - 1].sum(0)
        grad = grad / n - decay * theta
        seen += grad**2
        theta = theta + rate * grad / np.sqrt(seen)
    return Field(names, theta[: len(names)].copy(), theta[len(names) : -4].reshape(2, 2).copy(), theta[-4:-2].copy(), theta[-2:].copy())


def layouts(count: int = 360) -> list[str]:
    """Pages of many layouts, whose elements say in data-label which text is main (1) and which isn't (0)."""
    r = np.random.default_rng(7)
    pick = lambda *x: x[r.integers(len(x))]

    def words(n: int) -> str:
        return " ".join("".join(pick("ta", "re", "no", "li", "su", "en", "or", "mi") for _ in range(r.integers(1, 4))) for _ in range(n))

    def sentence(n: int) -> str:
        return words(n).capitalize() + pick(".", ".", ".", "!", "?")

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{words(1)}">{words(int(r.integers(1, 4)))}</a></li>' for _ in range(n))

    def paragraph() -> str:
        kind, size = r.integers(12), int(r.integers(1, 60))
        if kind == 0:
            return f"<h{r.integers(2, 5)}>{words(int(r.integers(1, 8)))}</h2>"
        if kind == 1:
            return "<ul>" + "".join(f"<li>{sentence(int(r.integers(1, 12)))}</li>" for _ in range(3)) + "</ul>"
        if kind == 2:
            return f"<blockquote>{sentence(size)}</blockquote>"
        if kind == 3:
            return f"<p>{words(3)} <a href='/x'>{words(2)}</a> {sentence(size)}</p>"
        if kind == 4:
            return f"<table><tr><td>{words(2)}</td><td>{words(1)}</td></tr></table>"
        if kind == 5:
            return f"<pre>{words(size)}</pre>"
        return f"<p>{sentence(size)}"

    out = []
    for _ in range(count):
        named = r.random() < 0.7
        top, page = [], []
        if r.random() < 0.8:
            top.append(pick(f"<nav data-label=0><ul>{links(5)}</ul></nav>", f"<div class='{pick('menu', 'main-menu', 'navbar', 'nav', 'topnav')}' data-label=0><ul>{links(5)}</ul></div>", f"<ul id='{pick('menu', 'navigation', 'breadcrumb')}' data-label=0>{links(4)}</ul>"))
        if r.random() < 0.6:
            top.append(pick(f"<header data-label=0><p>{words(3)}</p></header>", f"<div class='{pick('header', 'site-header', 'masthead', 'top-bar')}' data-label=0>{words(4)}</div>"))
        if r.random() < 0.5:
            top.append(f"<div class='{pick('cookie', 'cookie-notice', 'notice', 'consent banner', 'gdpr-popup', 'alert')}' data-label=0>{sentence(int(r.integers(5, 25)))}</div>")
        advert = lambda: f"<div class='{pick('ad', 'ads', 'advert', 'banner ad', 'sponsored', 'promo')}' data-label=0>{sentence(int(r.integers(3, 25)))}</div>"
        if r.random() < 0.6:
            top.append(advert())
        body = [pick(f"<h1>{words(int(r.integers(1, 9)))}</h1>", f"<header><h1>{words(5)}</h1></header>" if named else f"<h1>{words(5)}</h1>", "")]
        for _ in range(int(r.integers(1, 14))):
            body.append(paragraph())
            if r.random() < 0.05:
                body.append(advert())
        if r.random() < 0.15:
            body.append(f"<aside data-label=0>{pick('<p>', '')}{sentence(8)}</aside>")
        if r.random() < 0.15:
            body.append(f"<div class='{pick('share', 'social', 'related', 'related-posts')}' data-label=0><ul>{links(3)}</ul></div>")
        one = lambda: pick(f"<div class='comment'><p>{sentence(int(r.integers(1, 30)))}</p></div>", f"<p>{sentence(int(r.integers(1, 30)))}</p>", f"<ul><li>{sentence(4)}</li></ul>")
        name = pick("comments", "comment-list", "comment", "reader-comments", "discussion", "replies")
        talk = f"<div {pick('class', 'id')}='{name}' data-label=0>{pick(f'<h3>{words(1)}</h3>', '')}{''.join(one() for _ in range(int(r.integers(1, 4))))}</div>"
        inside = r.random() < 0.4
        if inside:
            body.append(talk)
        bare = r.random() < 0.3  # a page of little else than its text
        if bare:
            top = top[:1] if r.random() < 0.3 else []
        wrap = "div" if bare and r.random() < 0.3 else pick("article", "article", "main") if named else f"div {pick('class', 'id')}='{pick('content', 'article', 'post', 'entry-content', 'main', 'story', 'article-body', 'page-content')}'"
        if r.random() < 0.2:
            body.append(f"<p>{words(1)}</p>" if r.random() < 0.5 else f"<form data-label=0><label>{words(2)}</label><input></form><p>{words(2)}</p>")
        page.append(f"<{wrap} data-label=1>{''.join(body)}</{wrap.split()[0]}>")
        if not inside and r.random() < 0.4:
            page.append(talk)
        if bare:
            out.append(f"<body>{''.join(top + page)}" if r.random() < 0.5 else "".join(top + page))
            continue
        if r.random() < 0.4:
            page.append(pick(f"<aside data-label=0><p>{sentence(9)}</p><ul>{links(3)}</ul></aside>", f"<div class='{pick('sidebar', 'widget', 'side', 'rail', 'newsletter', 'subscribe')}' data-label=0><p>{sentence(9)}</p><ul>{links(3)}</ul></div>"))
        if r.random() < 0.4:
            page.append(f"<form action='/s' data-label=0><label>{words(2)}</label><input name=q><p>{sentence(6)}</p></form>")
        if r.random() < 0.8:
            page.append(pick(f"<footer data-label=0>&copy; {words(2)} {sentence(8)}</footer>", f"<div class='{pick('footer', 'copyright', 'legal', 'bottom')}' data-label=0><p>{sentence(8)}</p></div>"))
        out.append(f"<html><head><title>{words(4)}</title></head><body>{''.join(top + page)}</body></html>")
    return out


def own_label(b: Block) -> int:
    """Of a page that marks its article: inside it, and in none of the parts that aren't text of it."""
    return int(b.node is not None and b.node.article and not b.node.broken and not b.node.marked)


def train(pages: DataFrame, *, html_col: str = "html", key_col: str = "page_id", sample: int = SAMPLE) -> Field:
    n = pages.select(key_col).count()
    few = pages.where(F.pmod(F.xxhash64(F.col(key_col), F.lit(3)), F.lit(1_000_000)) < math.ceil(1e6 * min(1.0, sample / max(n, 1)))).select(F.col(html_col).alias("html"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            found = [blocks(p) for p in batch.column("html").to_pylist()]
            found = [b for b in found if any(x.node is not None and x.node.article for x in b)]
            f, y = [features(b) for b in found], [[own_label(x) for x in b] for b in found]
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.list_(pa.list_(pa.string()))), pa.array(y, pa.list_(pa.int32()))], names=["f", "y"])

    got = sorted((r["y"], r["f"]) for r in few.mapInArrow(label, "f array<array<string>>, y array<int>").toLocalIterator())
    known = [(f, y) for y, f in got]
    for page in layouts():
        b = blocks(page)
        known.append((features(b), [x.gold or 0 for x in b]))
    return fit(known)


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, y in zip(found, field.decode(field.speak(found)), strict=True) if y)


def extract(pages: DataFrame, field: Field, *keep: Column, html_col: str = "html") -> DataFrame:
    """The kept columns, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(field)
    own = pages.select(*keep, F.col(html_col).alias("__html"))
    names = own.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__html"):
            texts = [main_text(p, shared.value) for p in batch.column("__html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])

    return own.mapInArrow(run, StructType([*own.schema.fields[:-1], *StructType.fromDDL("text string, n_chars bigint").fields]))
