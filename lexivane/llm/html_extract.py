"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes its leaf blocks in order. A block's features are the tags above it, words
of their class, id and role, its length, punctuation, share of link text and place, and
the same of its neighbours; the field is trained on labelled pages and decoded by Viterbi.
The labelled pages are composed here: articles in several containers and mark-up styles
among menus, headers, adverts, notices, side bars, forms, related links, share buttons,
reader comments and footers, with and without telling names, in made-up words, every
block labelled as it is written.

Defined results: null or empty html and pages without main blocks have the empty text;
blocks are judged alike whether or not mark-up hides them; repeated rows and ids keep their rows; an
empty table gives an empty result; other columns are kept, whatever their names. White
space within a block is one space, blocks are trimmed and joined by two line ends.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexivane.llm.bpe import slices
from lexivane.llm.common import bounded_batches, free_name, tidied
from lexivane.llm.html_blocks import Block, blocks
from lexivane.llm.quality import _fit_chain

PAGES, SEED = 500, 4
MARK = ""

TAGS = "html body main article section div header footer nav aside form table tr td th ul ol li dl dt dd p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address details summary button label select option fieldset legend dialog menu caption center hr".split()
#: Names that pages give to parts of them; a block has a group if a class, id or role above it has one of its words.
GROUPS = {
    "ad": "ad ads adv advert advertisement adsbygoogle adslot sponsor sponsored promo promotion banner teaser",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog paywall warning announcement toast",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pager pagination toc skip topbar",
    "side": "side sidebar aside widget rail complementary",
    "top": "header masthead logo branding hero top",
    "foot": "footer foot bottom copyright legal contentinfo colophon",
    "comment": "comment comments commentlist reply replies respond discussion disqus reviews",
    "share": "share sharing social follow buttons tools actions",
    "related": "related recommended recommendations more popular trending similar readnext latest",
    "form": "form search login signup newsletter subscribe subscription",
    "meta": "meta byline author date tags tag category categories info",
    "main": "article content main post entry story body text maincontent articlebody page",
}
#: Tags whose content is seldom main text, wherever they stand.
APART = frozenset("nav aside footer form dialog button select".split())
_group_of = {w: g for g, words in GROUPS.items() for w in words.split()}
_groups, _tag_at = list(GROUPS), {t: i for i, t in enumerate(TAGS)}
_group_at = {g: i for i, g in enumerate(_groups)}


ROWS = 4096
_OWN = 2 * len(TAGS) + len(_groups) + 23
_known = frozenset(_group_of)


def blocks_of(page: str | None) -> list[Block]:
    return blocks(page, _known)


def _own(found: list[Block], start: int, stop: int, in_article: bool) -> np.ndarray:
    """The features of the blocks from start to stop themselves."""
    n, t, g = len(found), len(TAGS), len(_groups)
    own = np.zeros((stop - start, _OWN), np.float64)
    for i in range(start, stop):
        row, b = own[i - start], found[i]
        e = b.element
        for tag in e.tags:
            if tag in _tag_at:
                row[_tag_at[tag]] = 1
        if e.tag in _tag_at:
            row[t + _tag_at[e.tag]] = 1
        names = {_group_of[w] for w in e.words if w in _group_of}
        for name in names:
            row[2 * t + _group_at[name]] = 1
        chars, words = len(b.text), b.text.count(" ") + 1
        share = b.linked / max(1, chars)
        inside = "article" in e.tags or "main" in e.tags
        k = 2 * t + g
        row[k + min(5, int(np.log2(words)))] = 1
        row[k + 6] = share > 0.9
        row[k + 7] = 0.3 < share <= 0.9
        row[k + 8] = 0 < share <= 0.3
        row[k + 9] = share == 0
        row[k + 10] = b.text[-1] in ".!?…:;。\"”»"
        row[k + 11] = words > 12 and b.text.count(".") > 1
        row[k + 12] = b.text[0] in "©®|»«·•" or "©" in b.text or "·" in b.text
        row[k + 13] = i < 0.1 * n
        row[k + 14] = i >= 0.9 * n
        row[k + 15] = in_article and inside
        row[k + 16] = in_article and not inside
        row[k + 17] = b.links > 2
        row[k + 18] = e.depth <= 2
        row[k + 19] = b.text.isupper()
        row[k + 20] = e.articles > 1
        beside = not APART.isdisjoint(e.tags) or bool(names - {"main"})
        row[k + 21] = row[k + 15] and not beside and not row[k + 20]
        row[k + 22] = beside
    return own


def features(found: list[Block]) -> np.ndarray:
    """One row of features per block: a constant, its own, those of its neighbours, and whether it is the first or last."""
    n = len(found)
    own = _own(found, 0, n, _has_article(found))
    before, after = np.zeros_like(own), np.zeros_like(own)
    ends = np.zeros((n, 2))
    if n:
        before[1:], after[:-1] = own[:-1], own[1:]
        ends[0, 0] = ends[-1, 1] = 1
    near = slice(len(TAGS), None)
    return np.column_stack([np.ones(n), own, before[:, near], after[:, near], ends])


def _has_article(found: list[Block]) -> bool:
    return any("article" in b.element.tags or "main" in b.element.tags for b in found)


def potentials(found: list[Block], weights: np.ndarray) -> np.ndarray:
    """features(found) @ weights, with the features of ROWS blocks in memory at a time."""
    n, near = len(found), _OWN - len(TAGS)
    own, before, after = weights[1 : 1 + _OWN], weights[1 + _OWN : 1 + _OWN + near], weights[1 + _OWN + near : 1 + _OWN + 2 * near]
    out, in_article = np.full(n, weights[0]), _has_article(found)
    out[0] += weights[-2]
    out[-1] += weights[-1]
    for start in range(0, n, ROWS):
        stop = min(n, start + ROWS)
        x = _own(found, start, stop, in_article)
        out[start:stop] += x @ own
        last = min(n, stop + 1)
        out[start + 1 : last] += (x[:, len(TAGS) :] @ before)[: last - start - 1]
        first = max(1, start)
        out[first - 1 : stop - 1] += (x[:, len(TAGS) :] @ after)[first - start :]
    return out


def viterbi(potential: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """The likeliest labels of one chain: potential of 1 against 0, pair[before, after]."""
    n = len(potential)
    if not n:
        return np.zeros(0, np.int64)
    back = np.zeros((n, 2), np.int64)
    a = np.array([0.0, potential[0]])
    for i in range(1, n):
        options = a[:, None] + pair
        back[i] = options.argmax(axis=0)
        a = options.max(axis=0) + np.array([0.0, potential[i]])
    out = np.zeros(n, np.int64)
    out[-1] = int(a.argmax())
    for i in range(n - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


# ---- labelled pages -----------------------------------------------------------------
class _Writer:
    """Composes one page at random; main text carries MARK at the start of each block."""

    def __init__(self, rng: random.Random):
        self.r = rng
        self.syllables = rng.choice(["th er on an re he in ed nd ha at en es of or nt ea ti to it", "en er ch ei te in nd ie ge un au st be sch zu ver", "le de re en on ou ai qu es ment eau é ch ti", "do ra ar la es ci os ca ue re lo de mi ta ción ñ"]).split()
        self.named = rng.random() < 0.75
        self.closed = rng.random() < 0.7
        self.html5 = rng.random() < 0.65

    def word(self):
        return "".join(self.r.choice(self.syllables) for _ in range(self.r.randint(1, 4)))

    def words(self, a, b):
        return " ".join(self.word() for _ in range(self.r.randint(a, b))).capitalize()

    def sentences(self, a, b):
        return " ".join(self.words(3, 22) + self.r.choice(".....!?") for _ in range(self.r.randint(a, b)))

    def el(self, tag, inner, *names, close=True):
        marks = ""
        if self.named and names:
            name = self.r.choice(names)
            marks = f' {self.r.choice(["class", "class", "id"])}="{name}"' if name else ""
        elif names and self.r.random() < 0.5:
            marks = f' class="c{self.r.randint(1, 999)}"'
        return f"<{tag}{marks}>{inner}" + (f"</{tag}>" if close else "")

    def part(self, html5, fallback, inner, *names):
        return self.el(html5 if self.html5 else fallback, inner, *(("",) if self.html5 and self.r.random() < 0.5 else names))

    def links(self, a, b, tag="ul"):
        items = [f'<a href="/{self.word()}">{self.words(1, 4)}</a>' for _ in range(self.r.randint(a, b))]
        if tag == "ul":
            return "<ul>" + "".join(f"<li>{x}" + ("</li>" if self.closed else "") for x in items) + "</ul>"
        return self.r.choice([" | ", " ", " · "]).join(items)

    def ad(self):
        inner = self.r.choice([self.sentences(1, 1), self.words(1, 6), f'<a href="#">{self.words(2, 8)}</a>', "<p>" + self.sentences(1, 2) + "</p>"])
        return self.el(self.r.choice(["div", "div", "aside", "ins", "section"]) if self.named else "div", inner, "ad", "ads", "advert", "ad-slot", "sponsored", "promo banner")

    def notice(self):
        inner = self.r.choice(["<p>" + self.sentences(1, 3) + "</p><button>" + self.words(1, 2) + "</button>", self.sentences(1, 2) + ' <a href="#">' + self.words(1, 3) + "</a>"])
        return self.el(self.r.choice(["div", "section", "dialog"]), inner, "cookie-notice", "cookie-banner", "consent", "alert", "notice", "modal popup")

    def menu(self):
        return self.part("nav", "div", self.links(3, 9, self.r.choice(["ul", "ul", ""])), "nav", "menu", "navbar", "navigation", "breadcrumbs")

    def head(self):
        inner = self.r.choice([f'<a href="/">{self.words(1, 3)}</a>', self.el("h1", self.words(1, 3), "logo", "site-title"), f"<p>{self.words(2, 6)}</p>", self.words(1, 4), f"<p>{self.sentences(1, 1)}</p>"])
        return self.part("header", "div", inner + (self.menu() if self.r.random() < 0.5 else ""), "header", "masthead", "topbar")

    def foot(self):
        inner = self.r.choice([f"&copy; {self.word()}.example &middot; {self.sentences(1, 1)}", f"<p>&copy; 20{self.r.randint(10, 25)} {self.words(1, 4)}</p>" + self.links(2, 6, self.r.choice(["ul", ""])), "<p>" + self.sentences(1, 3) + "</p>", self.links(3, 8, "")])
        return self.part("footer", "div", inner, "footer", "site-footer", "copyright", "legal")

    def side(self):
        parts = [self.r.choice([lambda: f"<h3>{self.words(1, 4)}</h3>" + self.links(3, 8), self.ad, self.form, lambda: f"<p>{self.sentences(1, 2)}</p>", lambda: f"<h4>{self.words(1, 3)}</h4><p>{self.sentences(1, 2)}</p>"])() for _ in range(self.r.randint(1, 3))]
        return self.part("aside", "div", "".join(parts), "sidebar", "side", "widget", "rail")

    def form(self):
        inner = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>" + (f"<p>{self.sentences(1, 1)}</p>" if self.r.random() < 0.5 else "") + (f"<select><option>{self.words(1, 2)}<option>{self.words(1, 2)}</select>" if self.r.random() < 0.3 else "")
        return self.el("form", inner, "search", "newsletter", "login", "subscribe")

    def share(self):
        return self.el("div", self.links(2, 5, self.r.choice(["ul", ""])), "share", "social", "share-buttons")

    def related(self):
        inner = f"<h3>{self.words(1, 3)}</h3>" + self.r.choice([self.links(3, 6), "".join(f'<div><a href="#">{self.words(4, 10)}</a><p>{self.sentences(1, 1)}</p></div>' for _ in range(self.r.randint(2, 4)))])
        return self.el(self.r.choice(["section", "div", "aside"]), inner, "related", "recommended", "more-stories")

    def comments(self):
        one = lambda: self.r.choice(["li", "div", "article"])
        kind = one()
        items = "".join(self.el(kind, f"<b>{self.words(1, 2)}</b> " + self.r.choice([f"<p>{self.sentences(1, 5)}</p>", self.sentences(1, 3)]), "comment", "comment-body", "reply") for _ in range(self.r.randint(1, 6)))
        named, self.named = self.named, True
        out = self.el(self.r.choice(["section", "div"] + (["ol"] if kind == "li" else [])), f"<h3>{self.words(1, 3)}</h3>" + items + (self.form() if self.r.random() < 0.4 else ""), "comments", "comment-list", "commentlist", "discussion")
        self.named = named
        return out

    def inline(self, text):
        words = text.split(" ")
        for _ in range(self.r.randint(0, 2)):
            i = self.r.randrange(len(words))
            words[i] = self.r.choice(["<b>{}</b>", "<i>{}</i>", '<a href="#">{}</a>', "<em>{}</em>", "<span>{}</span>", "<code>{}</code>"]).format(words[i])
        if len(words) > 6 and self.r.random() < 0.1:
            words[len(words) // 2] += "<br>"
        return " ".join(words)

    def article(self):
        r = self.r
        end = "" if not self.closed and r.random() < 0.7 else "</p>"
        out = []
        if r.random() < 0.85:
            out.append(f"<h1>{MARK}{self.words(2, 14)}</h1>")
        if r.random() < 0.3:
            out.append(self.el("p", f"{MARK}{self.sentences(1, 2)}", "lead", "intro") + "")
        opened = "<b>" if r.random() < 0.3 else ""
        for i in range(r.randint(1, 9)):
            x = r.random()
            if x < 0.14 and i:  # main text needn't look like prose
                text = r.choice([self.words(1, 5), self.words(1, 4) + ".", f"&copy; {self.words(2, 6)}", f"{self.words(1, 3)} · {self.words(1, 3)}", f"+1 ({r.randint(100, 999)}) {r.randint(100, 999)}-{r.randint(1000, 9999)} {self.words(1, 9)}", f'<a href="#">{self.words(2, 6)}</a>', f"{self.word()}@{self.word()}.example"])
                out.append(f"<p>{MARK}{text}{end}")
            elif x < 0.72 or i == 0:
                out.append(f"<p>{MARK}{opened}{self.inline(self.sentences(1, 7))}{end}")
                opened = ""
            elif x < 0.8:
                out.append(f"<h2>{MARK}{self.words(1, 7)}</h2>")
            elif x < 0.86:
                tag = r.choice(["ul", "ol"])
                out.append(f"<{tag}>" + "".join(f"<li>{MARK}{self.inline(r.choice([self.words(2, 9), self.sentences(1, 2)]))}</li>" for _ in range(r.randint(2, 5))) + f"</{tag}>")
            elif x < 0.9:
                out.append(f"<blockquote><p>{MARK}{self.sentences(1, 3)}</p></blockquote>")
            elif x < 0.93:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{MARK}{self.words(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif x < 0.95:
                out.append(f"<pre>{MARK}{self.words(4, 20)}</pre>")
            elif x < 0.97:
                out.append(f"<figure><img src=x><figcaption>{MARK}{self.words(3, 12)}</figcaption></figure>")
            else:
                out.append(self.ad())
            if r.random() < 0.05:
                out.append(r.choice([self.ad, self.share, self.notice])())
        inner = "".join(out)
        if r.random() < 0.12:
            inner += self.comments()
        if r.random() < 0.1:
            inner += self.share()
        x = r.random()
        if self.html5 and x < 0.75:
            inner = f"<article>{inner}</article>" if r.random() < 0.8 else self.el("article", inner, "post", "entry", "story")
            return f"<main>{inner}</main>" if r.random() < 0.35 else inner
        if x < 0.85:
            inner = self.el("div", inner, "content", "post", "entry-content", "article-body", "main", "story")
            return self.el("div", inner, "main", "page", "wrapper") if r.random() < 0.5 else inner
        return inner

    def page(self):
        r = self.r
        maybe = lambda p, f: f() if r.random() < p else ""
        body = [maybe(0.3, self.notice), maybe(0.6, self.head), maybe(0.7, self.menu), maybe(0.5, self.ad)]
        middle = [self.article()]
        if r.random() < 0.45:
            middle.insert(r.choice([0, 1]), self.side())
        if r.random() < 0.1:
            middle = ["<table><tr>" + "".join(f"<td>{x}</td>" for x in middle) + "</tr></table>"]
        after = [maybe(0.25, self.share), maybe(0.3, self.related), maybe(0.35, self.comments), maybe(0.25, self.form), maybe(0.25, self.ad), maybe(0.85, self.foot), maybe(0.15, self.notice)]
        scripts = '<script>var t="</p>";track(1)</script>' if r.random() < 0.5 else ""
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 9)}</title><style>p{{margin:0}}</style>{scripts}</head><body>" + "".join(body + middle + after) + ("</body></html>" if self.closed else "")


def labelled_pages(n: int = PAGES, seed: int = SEED) -> list[tuple[str, list[int]]]:
    """Composed pages and the label of each of their blocks (1: main text)."""
    out = []
    for i in range(n):
        marked = _Writer(random.Random(f"{seed}/{i}")).page()
        out.append((marked.replace(MARK, ""), [int(MARK in b.text) for b in blocks_of(marked)]))
    return out


class Model:
    def __init__(self, weights: np.ndarray, pair: np.ndarray):
        self.weights, self.pair = weights, pair

    def main_blocks(self, page: str | None) -> list[str]:
        found = blocks_of(page)
        if not found:
            return []
        labels = viterbi(potentials(found, self.weights), self.pair)
        return [b.text for b, y in zip(found, labels) if y]


@lru_cache(maxsize=4)
def train(n: int = PAGES, seed: int = SEED) -> Model:
    x, y, at = [], [], [0]
    for page, labels in labelled_pages(n, seed):
        found = blocks_of(page)
        if len(found) != len(labels) or not found:
            continue
        x.append(features(found))
        y += labels
        at.append(at[-1] + len(found))
    weights, pair = _fit_chain(np.concatenate(x), np.array(y), np.array(at))
    return Model(weights, pair)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars", model: Model | None = None) -> DataFrame:
    """pages with the main text of each whole page and its number of code points."""
    model = model or train()
    text_col, chars_col = free_name(pages, text_col), free_name(pages, chars_col)
    bounded_batches(pages.sparkSession)
    schema = T.StructType([*pages.schema.fields, T.StructField(text_col, T.StringType(), False), T.StructField(chars_col, T.LongType(), False)])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, html_col, 1_000_000):
                found = ["\n\n".join(model.main_blocks(h)) for h in batch.column(batch.schema.get_field_index(html_col)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names=[*batch.schema.names, text_col, chars_col])

    return pages.mapInArrow(tidied(run), schema)
