"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the page.

Each block is content or not. Its features are the tags it is in, the words of their classes and ids, and how its text looks:
words, links, stops, place in the page. Neighbours are tied by transition weights. The field is trained by its exact
conditional likelihood (forward and backward sums) and decoded by Viterbi.

Labelled pages. Training takes at most `TRAIN_PAGES` pages, those with the smallest hash of their id (one for each id), in two ways. Pages with just
one `<article>` with text, which is not itself one of these, are labelled by it: blocks in it are content, except in menus, asides,
footers, forms, adverts and comments.
These pages are learnt a second time without their telling elements and without class and id words, so that the field knows content by
its text and place too. And their blocks are set anew into `COMPOSED` pages of various layouts, most without telling tags, whose labels are known by
construction. All pages are then read whole; broken markup is text, and a long page takes time in proportion to its length.

Null and empty pages, and pages without content, have the empty text. Repeated rows and extra columns stay; an
empty table gives an empty result, and a field is then trained on built-in words alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from random import Random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import smallest_hashes
from sluice.llm.fitting import minimised
from sluice.llm.html_blocks import Block, blocks

TRAIN_PAGES, COMPOSED, SEED = 300, 500, 11
_NOT_CONTENT = set(
    "nav aside footer form ad ads advert sponsor comment comments related share newsletter cookie".split()
)
_STEPS = 80


@lru_cache(maxsize=20_000)
def path_features(path: tuple[str, ...]) -> tuple[str, ...]:
    found = {}
    for element in path:
        tag, *words = element.split(".")
        if tag not in ("html", "body"):
            found[f"in {tag}"] = None
        for w in words:
            found[f"word {w}"] = None
    leaf = path[-1].split(".")[0] if path else ""
    found[f"leaf {leaf}"] = None
    return tuple(found)


def text_features(block: Block, place: int, count: int) -> list[str]:
    text = block.text
    words, links = text.count(" ") + 1, 3 * block.link_chars // max(1, len(text))
    stops = text.count(".") + text.count("!") + text.count("?")
    size = words.bit_length() if words < 64 else 7
    found = [f"words {size}", f"links {links}", f"stops {min(3, stops)}", f"commas {min(2, text.count(','))}"]
    if text[-1] in ".!?\"'”»":
        found.append("ends")
    if "©" in text or "|" in text or "·" in text:
        found.append("marks")
    if sum(map(text.count, "0123456789")) * 4 > len(text):
        found.append("digits")
    if place < 2:
        found.append(f"from start {place}")
    if count - place <= 2:
        found.append(f"from end {count - place}")
    return found


@dataclass(frozen=True)
class Field:
    """`weights` speak for content; `steps[a, b]` for label b after a; `first[a]` for label a of the first block."""

    weights: dict[str, float]
    steps: np.ndarray
    first: np.ndarray

    def content(self, page: list[Block]) -> list[bool]:
        """The most likely labels, by Viterbi."""
        if not page:
            return []
        known, (s00, s01), (s10, s11) = self.weights, *self.steps.tolist()
        no, yes = self.first.tolist()
        came: list[tuple[bool, bool]] = []
        by_path: dict[tuple[str, ...], float] = {}
        for k, block in enumerate(page):
            score = by_path.get(block.path)
            if score is None:
                score = by_path[block.path] = sum(known.get(f, 0.0) for f in path_features(block.path))
            score += sum(known.get(f, 0.0) for f in text_features(block, k, len(page)))
            if k:
                came.append((yes + s10 > no + s00, yes + s11 > no + s01))
                no, yes = max(no + s00, yes + s10), max(no + s01, yes + s11)
            yes += score
        label = yes > no
        labels = [label]
        for from_no, from_yes in reversed(came):
            label = from_yes if label else from_no
            labels.append(label)
        return labels[::-1]

    def text(self, html: str | None) -> str:
        page = blocks(html)
        return " ".join(b.text for b, keep in zip(page, self.content(page)) if keep)

    def column(self, html: Column) -> Column:
        @F.pandas_udf("string")
        def extracted(pages: pd.Series) -> pd.Series:
            return pd.Series([self.text(p) for p in pages], dtype=object)

        return extracted(html)


def fit(pages: list[tuple[list[Block], list[bool]]], penalty: float = 0.5) -> Field:
    """The field for labelled pages."""
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    ids, starts = [], []
    for page, _ in pages:
        for k, block in enumerate(page):
            starts.append(len(ids))
            ids += [names.setdefault(f, len(names)) for f in (*path_features(block.path), *text_features(block, k, len(page)))]
    sizes = np.array([len(p) for p, _ in pages])
    longest = int(sizes.max())
    real = np.arange(longest) < sizes[:, None]
    label = np.zeros(real.shape, int)
    label[real] = np.concatenate([y for _, y in pages])
    ids, starts = np.array(ids), np.array(starts)
    per_block = np.diff(np.append(starts, len(ids)))
    n, rows = len(names), np.arange(len(pages))

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        weights, steps, first = w[:n], w[n : n + 4].reshape(2, 2), w[n + 4 :]
        score = np.zeros((*real.shape, 2))
        score[real, 1] = np.add.reduceat(weights[ids], starts)
        ahead = np.zeros_like(score)
        ahead[:, 0] = first + score[:, 0]
        for k in range(1, longest):
            into = np.logaddexp.reduce(ahead[:, k - 1, :, None] + steps, axis=1) + score[:, k]
            ahead[:, k] = np.where(real[:, k, None], into, ahead[:, k - 1])
        total = np.logaddexp.reduce(ahead[rows, -1], axis=1)
        behind = np.zeros_like(score)
        for k in range(longest - 2, -1, -1):
            out = np.logaddexp.reduce(steps + (score[:, k + 1] + behind[:, k + 1])[:, None, :], axis=2)
            behind[:, k] = np.where(real[:, k + 1, None], out, 0.0)
        share = np.exp(ahead + behind - total[:, None, None]) * real[..., None]
        pair = np.exp(
            ahead[:, :-1, :, None] + steps + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ) * real[:, 1:, None, None]
        seen = np.zeros((2, 2))
        np.add.at(seen, (label[:, :-1][real[:, 1:]], label[:, 1:][real[:, 1:]]), 1)
        first_seen = np.bincount(label[:, 0], minlength=2)
        value = total.sum() - (score[real, 1] * label[real]).sum() - (seen * steps).sum() - first_seen @ first
        off = share[real, 1] - label[real]
        slope = np.concatenate([
            np.bincount(ids, np.repeat(off, per_block), n), (pair.sum((0, 1)) - seen).ravel(), share[:, 0].sum(0) - first_seen,
        ])
        return value + penalty * (w @ w) / 2, slope + penalty * w

    w = minimised(loss, np.zeros(n + 6), _STEPS)
    return Field({f: float(w[k]) for f, k in names.items()}, w[n : n + 4].reshape(2, 2), w[n + 4 :])


def train(pages: DataFrame, html: str = "html", page_id: str = "page_id", most: int = TRAIN_PAGES) -> Field:
    """The field for a table of pages; at most `most` of them come to the driver."""
    whole = pages.filter(F.col(html).isNotNull()).select(F.col(page_id).alias("id"), F.col(html).alias("html"))
    chosen = smallest_hashes(whole.select("id").distinct(), "id", most).select(F.col("id").alias("chosen"))
    one_each = whole.join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("chosen"))).groupBy("id")
    chosen = one_each.agg(F.min("html").alias("html")).orderBy("id").select("html")
    found = [blocks(r[0]) for r in chosen.collect()]
    known = [p for p in map(labelled, found) if p]
    return fit(known + [(plain(page), labels) for page, labels in known] + composed(found, COMPOSED, SEED))


def plain(page: list[Block]) -> list[Block]:
    """The page as if its elements had no telling tags and no names."""
    return [Block(b.text, tuple(map(plain_element, b.path)), b.link_chars) for b in page]


def plain_element(element: str) -> str:
    tag = element.split(".")[0]
    return "div" if tag in _TELLING else tag


def labelled(page: list[Block]) -> tuple[list[Block], list[bool]] | None:
    """A page with its labels, if its tags tell them."""
    inside = [[k for k, e in enumerate(b.path) if e.split(".")[0] == "article"] for b in page]
    if len({b.article for b in page if b.article}) != 1 or max(map(len, inside)) > 1:
        return None
    labels = [bool(k) and not any(_NOT_CONTENT.intersection(e.split(".")) for e in b.path[k[0] :]) for b, k in zip(page, inside)]
    return (page, labels) if any(labels) else None


_PROSE = [
    "The committee met on Tuesday to discuss the plan, and most members agreed.", "It was late when the boat came in. Nobody had waited.",
    "Prices rose by three per cent last year, more than in any year before.", "She asked for the book again, but the shop had closed.",
]
_SHORT = ["Home", "About us", "Contact", "News", "Sports", "Read more", "Log in", "Next", "Archive", "Subscribe"]
#: Names that pages give to what is not content, by kind.
_KINDS = {
    "nav": ["nav", "menu", "navbar", "navigation", "breadcrumb", "topnav", "mainmenu"],
    "header": ["header", "masthead", "site header", "banner", "logo", "branding", "top"],
    "footer": ["footer", "site footer", "copyright", "bottom", "colophon", "legal"],
    "aside": ["sidebar", "aside", "widget", "rail", "related", "recommended", "popular", "side column", "tags", "share", "social"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "ad slot", "adsbygoogle"],
    "notice": ["cookie notice", "cookie", "consent", "notice", "alert", "gdpr", "popup", "modal", "overlay", "paywall"],
    "form": ["search", "newsletter", "subscribe", "signup", "login", "contact form"],
    "comments": ["comments", "comment list", "comment", "replies", "responses", "discussion", "reader comments", "disqus thread"],
}
_CONTENT = ["article", "content", "post", "entry content", "main", "story", "article body", "post body", "text", "page"]
_TELLING = frozenset("article main section nav header footer aside form".split())
_TAGS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}


def composed(pages: list[list[Block]], count: int, seed: int) -> list[tuple[list[Block], list[bool]]]:
    """Pages of various layouts from the texts of others, labelled by construction."""
    r = Random(seed)
    texts = [b.text for p in pages for b in p]
    prose = [t for t in texts if t.count(" ") >= 7] + _PROSE
    short = [t for t in texts if t.count(" ") < 4 and len(t) < 60] + _SHORT * 20
    return [_composed(r, prose, short) for _ in range(count)]


def _named(r: Random, kind: str) -> str:
    """An opening element of this kind, by its tag, by a class or an id, or by none of them."""
    names = r.choice(_KINDS[kind]) if r.random() < 0.9 else ""
    tag = _TAGS.get(kind, "div") if r.random() < 0.5 else r.choice(["div", "div", "section"])
    return ".".join([tag, *names.split()])


def _composed(r: Random, prose: list[str], short: list[str]) -> tuple[list[Block], list[bool]]:
    out: list[tuple[Block, bool]] = []
    root = ("html", "body") + (("div.wrapper",) if r.random() < 0.4 else ())

    def sentence() -> str:
        words = r.choice(prose).split()
        n = r.choice([3, 8, 15, 30, 60, 120])
        return " ".join(words[:n]) + ("" if r.random() < 0.1 else ".")

    def words() -> str:
        return " ".join(r.choice(short).split()[: r.randint(1, 3)])

    def add(path: tuple[str, ...], text: str, linked: float, content: bool) -> None:
        if text:
            out.append((Block(text, path, int(linked * len(text))), content))

    def boilerplate(kind: str, at: tuple[str, ...]) -> None:
        here = (*at, _named(r, kind))
        if kind == "nav":
            for _ in range(r.randint(2, 9)):
                add((*here, "ul", "li"), words(), 1, False)
        elif kind == "comments":
            if r.random() < 0.6:
                add((*here, r.choice(["h2", "h3", "div"])), "Comments", 0, False)
            for _ in range(r.randint(1, 6)):
                one = (*here, r.choice(["div.comment", "li", "li.comment", "div", "article.comment"]))
                add((*one, r.choice(["div.author", "div.meta", "div", "h4"])), words(), r.choice([0, 1]), False)
                add((*one, "p"), sentence(), 0, False)
        elif kind == "form":
            for _ in range(r.randint(1, 3)):
                add((*here, r.choice(["div", "p", "button", "fieldset", "label"])), r.choice([words(), sentence()]), 0, False)
        elif kind == "aside":
            add((*here, "h3"), words(), 0, False)
            for _ in range(r.randint(1, 6)):
                add((*here, "ul", "li"), r.choice([words(), sentence()]), r.choice([1, 1, 0]), False)
        elif kind == "footer":
            line = f"© {words()} · {r.choice([sentence(), words()])}"
            add((*here, *r.choice([(), ("p",), ("div",)])), line, r.choice([0, 0, 0.5]), False)
        else:
            for _ in range(r.randint(1, 2)):
                add((*here, *r.choice([(), ("p",), ("div",), ("h2",)])), r.choice([sentence(), words()]), r.choice([0, 0, 1]), False)

    for kind in ("notice", "header", "nav", "ad"):
        if r.random() < (0.35 if kind == "notice" else 0.6):
            boilerplate(kind, root)
    if r.random() < 0.2:
        boilerplate("aside", root)
    tag = r.choice(["article", "article", "main", "div", "div", "section"])
    names = r.choice(_CONTENT).split() if tag in ("div", "section") or r.random() < 0.5 else []
    article = (*root, *(("main",) if r.random() < 0.3 else ()), ".".join([tag, *names]))
    if r.random() < 0.7:
        add((*article, r.choice(["h1", "h1", "h2"])), " ".join(r.choice(prose).split()[: r.randint(2, 10)]), 0, True)
    for _ in range(r.randint(1, 14)):
        chance = r.random()
        if chance < 0.05:
            add((*article, "h2"), words(), 0, True)
        elif chance < 0.1:
            add((*article, "blockquote", "p"), sentence(), 0, True)
        elif chance < 0.15:
            for _ in range(r.randint(2, 4)):
                add((*article, "ul", "li"), sentence(), 0, True)
        elif chance < 0.23:
            boilerplate(r.choice(["ad", "ad", "aside", "form", "notice"]), article)
        else:
            add((*article, *r.choice([("p",), ("p",), ("p",), (), ("div",)])), sentence(), r.choice([0, 0, 0, 0.2]), True)
    for kind in ("comments", "aside", "ad", "form", "nav", "footer"):
        if r.random() < (0.85 if kind == "footer" else 0.35):
            boilerplate(kind, article if kind == "comments" and r.random() < 0.3 else root)
    return [b for b, _ in out], [y for _, y in out]
