"""Main text of web pages: a chain CRF over the leaf blocks, trained on labelled pages and decoded by Viterbi.

The labelled pages are laid out here from templates, with the label of every block known: articles with and without semantic tags,
between menus, headers, footers, sidebars, notices, adverts, forms and reader comments, some of their tags left
open. Features speak of ancestors and of the text's shape only, never of its words, so they hold for any language.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.crf import ChainCrf, fit
from tallyloom.llm.encoder import batches_of_text
from tallyloom.llm.html_blocks import KINDS, LeafBlock, leaf_blocks

TRAINING_PAGES = 700
_TAGS = ["p", "h1", "h2", "h3", "li", "td", "th", "dd", "dt", "div", "blockquote", "pre", "figcaption", "body", "section", "article", "footer"]
_COMMON = {f"h{n}": "h3" for n in (4, 5, 6)} | {"": "body", "html": "body", "main": "section"}
_OUTSIDE = ["menu", "header", "footer", "sidebar", "form", "notice", "advert", "comments", "social", "hidden"]


def block_features(blocks: list[LeafBlock]) -> np.ndarray:
    """One row of numbers for each block of a page."""
    rows, last = [], max(1, len(blocks) - 1)
    inside = 1 << KINDS.index("article") | 1 << KINDS.index("main")
    outside = sum(1 << KINDS.index(k) for k in _OUTSIDE)
    has_inside = any(b.kinds & inside for b in blocks)
    for place, block in enumerate(blocks):
        text, size = block.text, len(block.text)
        words = text.count(" ") + 1
        tag = _COMMON.get(block.tag, block.tag)
        ends = text[-1:] in ".!?…。\"'”»)"
        rows.append(
            [
                *(block.kinds >> i & 1 for i in range(len(KINDS))),
                *(block.near >> i & 1 for i in range(len(KINDS))),
                *(tag == t for t in _TAGS),
                block.kinds & outside != 0, block.kinds & outside == 0, has_inside and not block.kinds & inside,
                np.log1p(words), words <= 3, words > 15, ends, block.link_characters / size,
                block.link_characters >= 0.9 * size, min(3, (text.count(",") + text.count(".")) / words), "©" in text or "(c)" in text.lower(),
                place == 0, place == last, place / last, min(size / words, 20),
            ]
        )
    return np.array(rows, dtype=np.float64).reshape(len(blocks), 2 * len(KINDS) + len(_TAGS) + 15)


class _Layout:
    """One labelled page: markup, and for each block its text and whether it is the article's."""

    def __init__(self, rng: random.Random):
        self.rng, self.parts, self.labels = rng, [], []
        self.made = 0

    def words(self, low: int, high: int, stop: bool = True) -> str:
        rng = self.rng
        out = ["".join(rng.choice(["an", "th", "el", "or", "é", "ßu", "qui", "en", "a", "í"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        self.made += 1
        out[0] = f"{out[0].capitalize()}{self.made}"  # no two blocks of a page alike
        for i in range(6, len(out), 9):
            out[i] += rng.choice([",", ".", ""])
        return " ".join(out) + (rng.choice([".", ".", ".", "!", "?"]) if stop else "")

    def raw(self, markup: str) -> None:
        self.parts.append(markup)

    def block(self, tag: str, text: str, main: bool, inner: str = "{}", attributes: str = "", closed: bool = True) -> None:
        self.labels.append((text, main))
        self.raw(f"<{tag}{attributes}>" + inner.format(text) + (f"</{tag}>" if closed else ""))

    def some(self, *choices):
        return self.rng.choice(choices)

    def links(self, low: int, high: int, wrapper: str = "ul") -> None:
        self.raw(f"<{wrapper}>")
        for _ in range(self.rng.randint(low, high)):
            self.block("li" if wrapper == "ul" else "p", self.words(1, 4, False), False, '<a href="/x">{}</a>')
        self.raw(f"</{wrapper}>")

    def outside(self, kind: str) -> None:
        rng, some = self.rng, self.some
        tag = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside"}.get(kind, "div")
        word = some(*{
            "menu": ["menu", "navbar", "breadcrumbs", "pagination"], "header": ["header", "masthead", "site-header"], "footer": ["footer", "site-footer", "copyright"],
            "sidebar": ["sidebar", "widget", "related-posts", "trending"], "advert": ["ad", "ads", "advert", "sponsored", "promo-box"],
            "notice": ["cookie-notice", "consent", "newsletter", "alert", "popup"], "comments": ["comments", "comment-list", "replies"],
            "social": ["share", "social-links", "byline", "post-meta"],
        }.get(kind, ["x"]))
        semantic = tag != "div" and rng.random() < 0.6
        attributes = "" if semantic and rng.random() < 0.6 else f' {some("class", "id")}="{word}"'
        tag = tag if semantic else some("div", "section", "div")
        if kind == "form":
            self.raw('<form action="/s">')
            self.block(some("label", "p", "div"), self.words(1, 5, False), False)
            self.raw('<input name="q"><textarea>x</textarea>')
            self.block(some("button", "p"), self.words(1, 2, False), False)
            self.raw("</form>")
            return
        self.raw(f"<{tag}{attributes}>")
        if kind == "menu":
            self.links(2, 9)
        elif kind == "comments":
            if rng.random() < 0.6:
                self.block(some("h2", "h3"), self.words(1, 3, False), False)
            inner = some("li", "div", "article")
            for _ in range(rng.randint(1, 5)):
                self.raw(f'<{inner} class="{some("comment", "reply", "comment-body")}">')
                if rng.random() < 0.5:
                    self.block(some("p", "div"), self.words(1, 3, False), False)
                    self.raw("<hr>")
                self.block("p", self.words(3, 45), False)
                self.raw(f"</{inner}>")
        elif kind == "sidebar":
            self.block(some("h2", "h3", "p"), self.words(1, 4, False), False)
            self.links(2, 6) if rng.random() < 0.6 else self.block("p", self.words(5, 40), False)
        elif kind in ("header", "footer") and rng.random() < 0.5:
            self.block(some("h1", "h2", "p", "div"), self.words(1, 5, False), False)
            if rng.random() < 0.5:
                self.links(1, 5)
        else:
            lead = some("&copy; ", "") if kind == "footer" else ""
            for _ in range(some(1, 1, 2)):
                text = self.words(2, 25, rng.random() < 0.7)
                self.labels.append((("© " if lead else "") + text, False))
                self.raw(f"{lead}{text}" if rng.random() < 0.5 else f"<p>{lead}{text}</p>")
                self.raw("<hr>")
        self.raw(f"</{tag}>")

    def article(self) -> None:
        rng, some = self.rng, self.some
        outer = some("article", "article", "article", "main", "div", "div", "section", "none")
        attributes = "" if outer in ("article", "main") and rng.random() < 0.7 else some('', ' class="post"', ' id="content"', ' class="entry-content"', ' class="story"')
        if outer != "none":
            self.raw(f"<{outer}{attributes}>")
        if rng.random() < 0.85:
            self.block(some("h1", "h1", "h2"), self.words(1, 9, rng.random() < 0.3), True)
        if rng.random() < 0.15:
            self.outside("social")
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6, 9, 14])):
            draw = rng.random()
            if draw < 0.72:
                text = self.words(*some((1, 4), (3, 20), (15, 80), (15, 80)))
                self.block("p", text, True, some("{}", "{}", "{}", "<b>{}<br>", "<b>{}</b>", '<a href="/y">{}</a>' if rng.random() < 0.1 else "{}", "<em>{}</em> "), closed=rng.random() < 0.85)
            elif draw < 0.79:
                self.block(some("h2", "h3"), self.words(1, 6, False), True)
            elif draw < 0.85:
                wrapper = some("ul", "ol")
                self.raw(f"<{wrapper}>")
                for _ in range(rng.randint(1, 5)):
                    self.block("li", self.words(1, 18, rng.random() < 0.5), True, closed=rng.random() < 0.8)
                self.raw(f"</{wrapper}>")
            elif draw < 0.90:
                self.raw("<blockquote>")
                self.block("p", self.words(5, 30), True)
                self.raw("</blockquote>")
            elif draw < 0.93:
                self.raw("<table><tr>")
                for _ in range(rng.randint(2, 4)):
                    self.block(some("td", "th"), self.words(1, 4, False), True)
                self.raw("</tr></table>")
            elif draw < 0.96:
                self.raw("<figure><img src=x>")
                self.block("figcaption", self.words(2, 12), True)
                self.raw("</figure>")
            else:
                self.outside(some("advert", "form", "notice", "sidebar"))
        if outer != "none":
            self.raw(f"</{outer}>")


def labelled_page(seed: int) -> tuple[str, list[tuple[str, bool]]]:
    """A page laid out by chance, and its blocks' texts in order, each with whether it belongs to the article."""
    rng = random.Random(seed)
    page = _Layout(rng)
    page.raw("<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a='<p>x</p>';</script></head><body>")
    for kind, chance in (("notice", 0.2), ("header", 0.4), ("menu", 0.75), ("advert", 0.4), ("form", 0.15), ("sidebar", 0.15)):
        if rng.random() < chance:
            page.outside(kind)
    page.article()
    for kind, chance in (("social", 0.2), ("comments", 0.35), ("sidebar", 0.35), ("form", 0.15), ("advert", 0.25), ("footer", 0.8), ("notice", 0.15)):
        if rng.random() < chance:
            page.outside(kind)
    if rng.random() < 0.85:
        page.raw("</body></html>")
    return "".join(page.parts), page.labels


@lru_cache
def trained_model(pages: int = TRAINING_PAGES) -> ChainCrf:
    """The model fitted on so many labelled pages; the same for the same number."""
    rows, labels, lengths = [], [], []
    for seed in range(pages):
        page, marks = labelled_page(seed)
        blocks = leaf_blocks(page)
        by_text = dict(marks)
        if not blocks:
            continue
        rows.append(block_features(blocks))
        labels += [by_text.get(b.text, False) for b in blocks]
        lengths.append(len(blocks))
    return fit(np.vstack(rows), np.array(labels, dtype=np.float64), np.array(lengths), penalty=1e-3)


def main_texts(model: ChainCrf, pages: list[str]) -> list[str]:
    """The main text of each page: the blocks that Viterbi labels so, two line breaks between them."""
    found = [leaf_blocks(p) for p in pages]
    lengths = np.array([len(b) for b in found], dtype=np.int64)
    if not lengths.sum():
        return ["" for _ in pages]
    labels = model.viterbi(np.vstack([block_features(b) for b in found if b]), lengths)
    out, at = [], 0
    for blocks in found:
        out.append("\n\n".join(b.text for b, label in zip(blocks, labels[at : at + len(blocks)]) if label))
        at += len(blocks)
    return out


def extract(pages: DataFrame, model: ChainCrf | None = None, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page, in one pass without a shuffle.

    Null and empty pages, and pages without a main block, have an empty text. Null and repeated ids and null addresses
    are kept as they are; other columns are not read.
    """
    model = model or trained_model()

    def read(batches):
        for batch in batches:
            for start, texts in batches_of_text(batch.column(2), 1_000_000):
                found = main_texts(model, texts)
                own = [batch.column(i).slice(start, len(texts)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names)

    rows = pages.select(id_column, url_column, F.col(html_column))
    names = [id_column, url_column, "text", "n_chars"]
    kinds = [f.dataType.simpleString() for f in rows.schema][:2]
    return rows.mapInArrow(read, f"{id_column} {kinds[0]}, {url_column} {kinds[1]}, text string, n_chars long")
