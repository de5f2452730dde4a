"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks (text between block-level
tags), each with its tag path (tags, their classes and ids) and its words. A
bidirectional LSTM in numpy reads a vector per block - the hashed tag path,
the hashed words, and a few measures - and labels every block with the whole
page as context. The main text is the blocks labelled as article.

The labeller is trained here on pages that a seeded grammar writes:
``PAGES_TO_FIT`` labelled pages in a dozen layouts, with and without telling
tag names. That number is the bound of the labelled sample; training is the
same in every run and takes seconds. Every page of the table is read whole.

Blocks: character references are decoded, white space inside a block becomes
one space, blocks are trimmed, empty ones left out, the others joined by two
line feeds in page order. Scripts, styles, comments, the head, and the
controls of forms hold no text; one of these without an end tag is passed by
and what follows it is read, but a script, style, title or textarea then takes
the rest of the page.

Cases: null or empty html has empty text; html that is cut short or has
stray ends is read as far as it goes; text outside any tag is a block; null
and repeated ids stay rows of their own; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import html as html_lib
import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, over_batches

PAGES_TO_FIT = 800
HIDDEN = 16
PATH_DIMS = 96
WORD_DIMS = 32
MEASURES = 6
DIMS = PATH_DIMS + WORD_DIMS + MEASURES
#: Blocks that one pass of the network takes at once.
LOT = 1 << 15

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)"
                    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|([^<]+|<)", re.S)
_CLASS = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")
# HTML element names by the role that the standard gives them.
_SILENT = frozenset("script style noscript template head title svg canvas object iframe select textarea button option datalist".split())
_RAW = frozenset("script style title textarea".split())  # nothing but their end tag is read in them
_NOT_NESTED = frozenset("head noscript iframe select button option datalist".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
                    " span strike strong sub sup time tt u var wbr".split())


class Block:
    """A leaf: its path (names), its text, and how much of it is links."""

    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple, text: str, linked: float):
        self.path, self.text, self.linked = path, text, linked


@lru_cache(maxsize=65536)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """A tag's name and the words of its classes, ids and role."""
    out = [tag]
    for value in _CLASS.findall(attributes):
        out += ["." + w for w in _NAME.findall(value.lower())]
    return tuple(out)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in its order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    endless: set[str] = set()  # silent tags without an end tag from here on
    linked = links = 0

    def close() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html_lib.unescape("".join(parts))).strip()
        if text:
            out.append(Block(tuple(n for t, n in stack if t not in _INLINE), text, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        cdata, slash, tag, attributes, text = m.groups()
        if text is not None or cdata is not None:
            parts.append(text if text is not None else cdata)
            linked += len(parts[-1]) * (links > 0)
            continue
        if not tag:
            continue
        tag = tag.lower()
        if tag in _SILENT and not slash:
            if tag not in _INLINE:
                close()
            if not attributes.rstrip().endswith("/"):
                stop = None if tag in endless else re.compile(rf"<(/?){re.escape(tag)}\b[^>]*(?:>|$)" if tag in _NOT_NESTED else
                                                              rf"<(/){re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(page, at)
                if not stop:
                    endless.add(tag)
                if stop and stop[1]:
                    at = stop.end()
                elif tag in _RAW:
                    at = end
            continue
        if tag in _INLINE:
            if tag in ("br", "img", "wbr"):
                parts.append(" " if tag == "br" else "")
            elif tag == "a":
                links = max(0, links + (-1 if slash else 1))
            continue
        close()
        links = 0
        if slash:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in _VOID:
            if stack and stack[-1][0] == tag and tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                stack.pop()
            elif stack and stack[-1][0] == "p":
                stack.pop()
            stack.append((tag, _names(tag, attributes)))
    close()
    return out


@lru_cache(maxsize=200_000)
def _bucket(word: str, dims: int) -> int:
    return zlib.crc32(word.encode()) % dims


@lru_cache(maxsize=65536)
def _path_vector(path: tuple) -> np.ndarray:
    """The hashed names of a tag path; the last tag counts by itself too."""
    v = np.zeros(PATH_DIMS, np.float32)
    for names in path:
        for n in names:
            v[_bucket(n, PATH_DIMS - 16)] = 1
    if path:
        v[PATH_DIMS - 16 + _bucket(path[-1][0], 16)] = 1
    return v


def vectors(page: list[Block]) -> np.ndarray:
    """A row of ``DIMS`` numbers for each block of a page."""
    x = np.zeros((len(page), DIMS), np.float32)
    for k, b in enumerate(page):
        words = b.text.lower().split()
        x[k, :PATH_DIMS] = _path_vector(b.path)
        at = [_bucket(w, WORD_DIMS) for w in words]
        n = np.bincount(at, minlength=WORD_DIMS)
        x[k, PATH_DIMS:PATH_DIMS + WORD_DIMS] = n / np.sqrt((n * n).sum())
        stops = sum(map(b.text.count, ".!?"))
        x[k, PATH_DIMS + WORD_DIMS:] = (np.log1p(len(words)) / 3, b.linked, min(stops, 10) / 5, k / len(page),
                                        1 - k / len(page), min(1.0, len(page) / 100))
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, one in each direction, and a logistic output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.w = {}
        for way in "fb":
            self.w["x" + way] = rng.normal(0, 0.15, (DIMS, 4 * h)).astype(np.float32)
            self.w["h" + way] = rng.normal(0, 0.2, (h, 4 * h)).astype(np.float32)
            bias = np.zeros(4 * h, np.float32)
            bias[h:2 * h] = 1  # remember at first
            self.w["c" + way] = bias
        self.w["o"] = rng.normal(0, 0.2, (2 * h, 1)).astype(np.float32)
        self.w["d"] = np.zeros(1, np.float32)

    def _way(self, x: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """Hidden states over the steps of ``x`` (steps, lanes, DIMS)."""
        steps, lanes, _ = x.shape
        n = HIDDEN
        h, c = np.zeros((lanes, n), np.float32), np.zeros((lanes, n), np.float32)
        out = np.empty((steps, lanes, n), np.float32)
        into = (x.reshape(-1, DIMS) @ self.w["x" + way] + self.w["c" + way]).reshape(steps, lanes, 4 * n)
        for t in range(steps):
            z = into[t] + h @ self.w["h" + way]
            s = _sigmoid(z[:, :3 * n])
            i, f, o, g = s[:, :n], s[:, n:2 * n], s[:, 2 * n:], np.tanh(z[:, 3 * n:])
            before, last = c, h
            c = f * c + i * g
            h = o * np.tanh(c)
            out[t] = h
            if keep is not None:
                keep.append((i, f, o, g, before, c, last))
        return out

    def chances(self, x: np.ndarray, mask: np.ndarray, keep: tuple | None = None) -> np.ndarray:
        """The chance of article for (steps, lanes); ``mask`` is 1 where a
        lane has a block. Lanes are reversed within their own length."""
        turned = _turned(x, mask)
        f = self._way(x, "f", keep and keep[0])
        b = self._way(turned, "b", keep and keep[1])
        both = np.concatenate((f, _turned(b, mask)), axis=2)
        if keep is not None:
            keep[2].append(both)
        return _sigmoid(both @ self.w["o"] + self.w["d"])[:, :, 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss, back through time."""
        keep: tuple[list, list, list] = ([], [], [])
        p = self.chances(x, mask, keep)
        both, n = keep[2][0], HIDDEN
        d = ((p - y) * mask / mask.sum())[:, :, None].astype(np.float32)
        grad = {"o": (both * d).sum((0, 1))[:, None], "d": d.sum((0, 1))}
        back = d @ self.w["o"].T
        for way, into, inputs, past in (("f", back[:, :, :n], x, keep[0]),
                                        ("b", _turned(back[:, :, n:], mask), _turned(x, mask), keep[1])):
            dh, dc = np.zeros(into.shape[1:], np.float32), np.zeros(into.shape[1:], np.float32)
            dz = np.empty((*into.shape[:2], 4 * n), np.float32)
            gh = np.zeros_like(self.w["h" + way])
            for t in range(len(into) - 1, -1, -1):
                i, f, o, g, before, c, last = past[t]
                dh = dh + into[t]
                th = np.tanh(c)
                dc = dc + dh * o * (1 - th * th)
                dz[t] = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)), axis=1)
                gh += last.T @ dz[t]
                dh, dc = dz[t] @ self.w["h" + way].T, dc * f
            grad["x" + way] = inputs.reshape(-1, DIMS).T @ dz.reshape(-1, 4 * n)
            grad["h" + way], grad["c" + way] = gh, dz.sum((0, 1))
        return grad

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 12, lot: int = 25, rate: float = 0.01) -> Labeller:
        """Adam over lots of pages (vectors, labels) of like length."""
        pages = sorted(pages, key=lambda p: len(p[1]))
        lots = [_padded(pages[i:i + lot]) for i in range(0, len(pages), lot)]
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        rng, step, top = np.random.default_rng(11), 0, rate
        for _ in range(rounds):
            for k in rng.permutation(len(lots)):
                step += 1
                rate = top * (1.02 - step / (rounds * len(lots)))
                for name, g in self.gradients(*lots[k]).items():
                    m[name] = 0.9 * m[name] + 0.1 * g
                    s[name] = 0.99 * s[name] + 0.01 * g * g
                    self.w[name] = self.w[name] - (rate * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(s[name] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is article."""
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        out: list = [np.zeros(0, bool)] * len(pages)
        at = 0
        while at < len(order):
            lot = [order[at]]
            at += 1
            while at < len(order) and len(pages[order[at]]) * (len(lot) + 1) <= LOT:
                lot.append(order[at])
                at += 1
            x, mask, _ = _padded([(pages[i], None) for i in lot])
            if len(x):
                p = self.chances(x, mask)
                for lane, i in enumerate(lot):
                    out[i] = p[: len(pages[i]), lane] >= 0.5
        return out


def _padded(pages: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max((len(x) for x, _ in pages), default=0)
    x = np.zeros((steps, len(pages), DIMS), np.float32)
    mask, y = np.zeros((steps, len(pages)), np.float32), np.zeros((steps, len(pages)), np.float32)
    for lane, (v, labels) in enumerate(pages):
        x[: len(v), lane] = v
        mask[: len(v), lane] = 1
        if labels is not None:
            y[: len(v), lane] = labels
    return x, mask, y


def _turned(x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Each lane backwards within its own length."""
    steps = np.arange(len(mask))[:, None]
    size = mask.sum(axis=0).astype(np.int64)[None, :]
    back = np.where(steps < size, size - 1 - steps, steps)
    return np.take_along_axis(x, back[:, :, None], axis=0)


# ---- the labelled pages ----

# Words that pages use outside their articles.
_AROUND = {
    "nav": "home about contact news products services login register menu search blog help shop".split(),
    "footer": "copyright rights reserved privacy policy terms imprint contact all company".split(),
    "ad": "advertisement sponsored buy now offer sale discount free shipping deal click".split(),
    "cookie": "we use cookies to improve your experience accept settings consent this site".split(),
    "comments": "reply thanks great post i agree comment says ago likes report nice".split(),
    "aside": "related popular recent posts tags categories archive subscribe newsletter follow us share".split(),
    "form": "email name password subscribe submit sign up your message send".split(),
}
_PLACES = {  # tag, and names that classes and ids give
    "nav": (("nav", ""), ("div", "menu"), ("ul", "navigation"), ("div", "navbar"), ("div", "breadcrumb")),
    "header": (("header", ""), ("div", "header"), ("div", "masthead")),
    "footer": (("footer", ""), ("div", "footer"), ("div", "site-footer")),
    "ad": (("div", "ad"), ("div", "advert"), ("aside", "sponsored"), ("div", "promo"), ("div", "banner-ad")),
    "cookie": (("div", "cookie-notice"), ("div", "consent"), ("section", "notice"), ("div", "cookie-banner")),
    "comments": (("section", "comments"), ("div", "comment-list"), ("div", "reader-comments"), ("ol", "comments")),
    "aside": (("aside", ""), ("div", "sidebar"), ("div", "related"), ("div", "widget"), ("div", "share")),
    "form": (("form", ""), ("form", "signup"), ("form", "newsletter")),
    "main": (("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "entry-content"), ("div", "")),
}


class _Writer:
    """Writes labelled pages from a seeded grammar."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        syllables = [c + v for c in "bdfgklmnprstvwzé" for v in ("a", "e", "i", "o", "u", "en", "er", "ou")]
        self.words = ["".join(self.rng.choices(syllables, k=self.rng.randint(1, 4))) for _ in range(4000)]

    def prose(self, low: int, high: int) -> str:
        r, out = self.rng, []
        while len(out) < r.randint(low, high):
            s = r.choices(self.words, k=r.randint(1, 14))
            out += [s[0].capitalize(), *s[1:-1], s[-1] + r.choice("...?!")]
        style = r.random()  # a fifth of all prose is poor: marks after each word, capitals, one word again and again
        if style < 0.06:
            out = [w + r.choice(("%%%", "&amp;&amp;&amp;", "***", "###", "$$$")) for w in out]
        elif style < 0.14:
            out = [w + r.choice((" |", " |", " -", " *", " &middot;")) for w in out[:1]] + [w + " |" for w in out[1:]]
        elif style < 0.17:
            out = [w.upper() + "!!" for w in out]
        elif style < 0.2:
            out = [out[0]] * len(out)
        return " ".join(out)

    def around(self, kind: str) -> str:
        """A short text of a kind of place: its own words or any."""
        r = self.rng
        if r.random() < 0.5:
            return self.prose(1, 25 if kind in ("ad", "comments", "footer", "aside") else 6)
        return " ".join(r.choices(_AROUND[kind], k=r.randint(1, 8))).capitalize()

    def place(self, kind: str, inside: str) -> str:
        tag, name = self.rng.choice(_PLACES[kind])
        mark = f' {self.rng.choice(("class", "id"))}="{name}"' if name else ""
        return f"<{tag}{mark}>{inside}</{tag}>"

    def part(self, kind: str) -> str:
        r = self.rng
        if kind == "nav":
            items = "".join(f'<li><a href="/x">{r.choice(self.words + _AROUND["nav"])}</a></li>' for _ in range(r.randint(2, 9)))
            return self.place("nav", f"<ul>{items}</ul>")
        if kind == "header":
            return self.place("header", f"<h1>{self.around('nav')}</h1>" if r.random() < 0.5 else f"<div>{self.around('nav')}</div>")
        if kind == "footer":
            return self.place("footer", f"&copy; {self.around('footer')}" if r.random() < 0.6 else f"<p>&copy; {self.around('footer')}</p>" * r.randint(1, 2))
        if kind == "comments":
            return self.place("comments", "<h3>Comments</h3>" * r.randint(0, 1) + "".join(
                f'<div class="comment"><p>{self.prose(2, 40)}</p></div>' if r.random() < 0.6 else f'<li class="comment">{self.around("comments")}</li>'
                for _ in range(r.randint(1, 5))))
        if kind == "form":
            return self.place("form", f"<label>{self.around('form')}</label><input><p>{self.around('form')}</p>")
        return self.place(kind, self.around(kind) if r.random() < 0.5 else "".join(f"<p>{self.around(kind)}</p>" for _ in range(r.randint(1, 4))))

    def article(self) -> str:
        r = self.rng
        out = [f"<h{r.randint(1, 2)}>{self.prose(2, 9)}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice((r.randint(1, 6), r.randint(2, 14), r.randint(8, 40)))):
            x = r.random()
            if x < 0.78:
                mark = r.choice(("", "", "<b>", "<i>"))
                low, high = r.choice(((1, 2), (1, 8), (5, 40), (20, 90), (20, 90)))
                out.append(f"<p>{mark}{self.prose(low, high)}" + r.choice(("</p>", "</p>", "</p>", "<br>")))
            elif x < 0.8:
                out.append(f"<h2>{self.prose(1, 6)}</h2>")
            elif x < 0.88:
                out.append("<ul>" + "".join(f"<li>{self.prose(1, 12)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif x < 0.92:
                out.append(f"<blockquote>{self.prose(3, 25)}</blockquote>")
            elif x < 0.95:
                out.append("<table>" + "".join(f"<tr><td>{self.prose(1, 3)}</td><td>{self.prose(1, 3)}</td></tr>" for _ in range(2)) + "</table>")
            else:
                out.append(f"<pre>{self.prose(2, 12)}</pre>")
        if r.random() < 0.4:  # articles may end in a word or two, of any kind
            out += [f"<p>{r.choice((self.prose(1, 2), self.prose(1, 8), r.choice(self.words + sum(_AROUND.values(), [])).capitalize() + '.'))}</p>"
                    for _ in range(r.randint(1, 2))]
        return "".join(out)

    def page(self) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and labels of the blocks of a page."""
        r = self.rng
        before = [k for k in ("cookie", "header", "nav", "ad", "aside", "form") if r.random() < (0.8 if k == "nav" else 0.35)]
        after = [k for k in ("ad", "comments", "aside", "form", "cookie", "nav", "footer") if r.random() < (0.8 if k == "footer" else 0.3)]
        inner = [k for k in ("ad", "comments", "aside") if r.random() < 0.12]
        body = self.article()
        tag, name = r.choice(_PLACES["main"])
        tag_open = f'<{tag} class="{name}">' if name else f"<{tag}>"
        pieces = [(self.part(k), 0) for k in before] + [(tag_open, 0), (body, 1)]
        pieces += [(self.part(k), 0) for k in inner] + [(f"</{tag}>", 0)] + [(self.part(k), 0) for k in after]
        if r.random() < 0.25:
            pieces = [('<div class="wrapper">', 0), *pieces, ("</div>", 0)]
        if r.random() < 0.05:  # a bare text
            pieces = [(r.choice((body, self.prose(3, 40), f"<p>{self.prose(3, 40)}</p>")), 1)]
        whole, labels = "<html><body>", []
        for text, label in pieces:
            whole += text
            now = len(blocks(whole))
            labels += [label] * (now - len(labels))
        page = blocks(whole + "</body></html>")
        return vectors(page), np.array(labels[: len(page)], np.float32)


@lru_cache(maxsize=1)
def fitted() -> Labeller:
    """The trained labeller: the same in every run."""
    writer = _Writer(3)
    return Labeller().fit([p for p in (writer.page() for _ in range(PAGES_TO_FIT)) if len(p[1])])


def texts(pages: list[str], labeller: Labeller) -> list[str]:
    """The main text of each page."""
    cut = [blocks(p) for p in pages]
    labels = labeller.label([vectors(p) for p in cut])
    return ["\n\n".join(b.text for b, yes in zip(p, keep) if yes) for p, keep in zip(cut, labels)]


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    held = pages.sparkSession.sparkContext.broadcast(fitted().w)
    base = pages.select(col(id_col).alias("page_id"), col(url_col).cast("string").alias("url"),
                        F.coalesce(col(html_col).cast("string"), F.lit("")).alias("html"))
    kind = base.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller()
        labeller.w = held.value
        for b in batches:
            found = texts(b.column("html").to_pylist(), labeller)
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(found, pa.string()),
                                              pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return over_batches(base, run, f"page_id {kind}, url string, text string, n_chars long")
