"""HTML as a sequence of leaf blocks: lenient parsing for text extraction, in time and memory linear in the page.

A block is a run of inline content within block-level structure. Block elements end the
run that is open, as do table cells, list items and headings; all other elements, unknown
ones, formulas and the fallback content of objects and `noscript` included, flow within a
line, and a line break is white space inside a block. Scripts, styles, titles, frames, text
areas, templates and drawings (with all that is nested in them), comments and declarations
give no text. End tags are optional where HTML says so, stray end tags are passed over, a
bare `<` is text. Character references are decoded.

Elements are linked to their parents and hold what the elements above them sum up to, so a
block only points at its element, however deep that is.
"""

from __future__ import annotations

import html
import re
from collections import Counter

#: Fixed values of HTML: elements that end a run of inline content.
BLOCKS = frozenset("address article aside blockquote body button caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html input label legend li listing main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup, up to their end tag; of the last the content is text.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
LITERAL = frozenset(["xmp"])
#: Elements that give no text and can hold others of their kind.
SKIPPED = frozenset("template svg".split())
#: Families of elements that end each other within a scope: those that end, and the scope's own elements.
FAMILIES = ((frozenset(["li"]), frozenset("ul ol menu".split())), (frozenset("dt dd".split()), frozenset(["dl"])), (frozenset("td th".split()), frozenset("tr table".split())), (frozenset(["tr"]), frozenset(["table"])), (frozenset("thead tbody tfoot".split()), frozenset(["table"])), (frozenset(["option"]), frozenset(["select"])))
_families_of = {t: [i for i, (own, scope) in enumerate(FAMILIES) if t in own or t in scope] for own, scope in FAMILIES for t in own | scope}
_ends_in = {t: i for i, (own, _) in enumerate(FAMILIES) for t in own}

# An attribute's quotes count only at the start of its value, so an apostrophe inside an unquoted value is a letter.
_token = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s\"'>][^\s>]*+)?)*+)(?:>|\Z)", re.S)
_attribute = re.compile(r"([^\s=/\"'>]+)\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s\"'>][^\s>]*))")
_spaces = re.compile(r"\s+")
_ends: dict[str, re.Pattern] = {}
_nested: dict[str, re.Pattern] = {}


class Element:
    """A block element: its tag, parent, depth, the tags and name words at and above it, and how many articles it is in."""

    __slots__ = ("tag", "parent", "depth", "tags", "words", "articles", "nearest")

    def __init__(self, tag: str, parent: "Element | None", words: frozenset):
        self.tag, self.parent = tag, parent
        if parent is None:
            self.depth, self.tags, self.words, self.articles, self.nearest = 0, frozenset(), frozenset(), 0, (None,) * len(FAMILIES)
            return
        self.depth = parent.depth + 1
        # Sets are shared with the parent unless there is something new, so that depth costs no memory but the elements.
        self.tags = parent.tags if tag in parent.tags else parent.tags | {tag}
        self.words = parent.words if words <= parent.words else parent.words | words
        self.articles = parent.articles + (tag == "article")
        self.nearest = parent.nearest
        if tag in _families_of:
            near = list(parent.nearest)
            for i in _families_of[tag]:
                near[i] = self
            self.nearest = tuple(near)


class Block:
    """One leaf block: its text, the element that holds it, and the characters inside links and their number."""

    __slots__ = ("text", "element", "linked", "links")

    def __init__(self, text: str, element: Element, linked: int, links: int):
        self.text, self.element, self.linked, self.links = text, element, linked, links


def _names(attributes: str, known: frozenset | None) -> frozenset:
    """The words of class, id, role and the like; of those known only, so that what elements hold is bounded."""
    if "=" not in attributes:
        return frozenset()
    words = set()
    for name, a, b, c in _attribute.findall(attributes):
        if name.lower() in ("class", "id", "role", "itemprop", "aria-label"):
            words.update(w for w in re.split(r"[^a-z0-9]+", (a or b or c).lower()) if w and (known is None or w in known))
    return frozenset(words)


def _skip(page: str, at: int, tag: str) -> int:
    """Where the content of a skipped element ends that began at `at`; at once if it never does."""
    if tag not in _nested:
        _nested[tag] = re.compile(rf"<(/?){tag}(?=[\s/>])([^>]*)>", re.I)
    depth, to = 1, at
    while depth:
        m = _nested[tag].search(page, to)
        if not m:
            return at
        to = m.end()
        if m[1]:
            depth -= 1
        elif not m[2].endswith("/"):
            depth += 1
    return to


def blocks(page: str | None, known: frozenset | None = None) -> list[Block]:
    """The leaf blocks of a page in order; those without text are left out. known: the name words to keep, None for all."""
    page = page or ""
    out: list[Block] = []
    here = Element("", None, frozenset())
    opened: Counter = Counter()
    text: list[str] = []
    linked = links = depth_a = 0
    unended: set[str] = set()

    def end():
        nonlocal linked, links
        if text:
            joined = _spaces.sub(" ", "".join(text)).strip()
            if joined:
                out.append(Block(joined, here, linked, links))
            text.clear()
        linked = links = 0

    def add(piece: str, literal: bool = False):
        nonlocal linked
        if piece:
            piece = piece if literal else html.unescape(piece)
            text.append(piece)
            if depth_a:
                linked += len(piece.strip())

    def close_to(element: Element):
        """End what is open up to and with the element."""
        nonlocal here, depth_a
        end()
        depth_a = 0
        while True:
            gone, here = here, here.parent
            opened[gone.tag] -= 1
            if gone is element:
                return

    at, n = 0, len(page)
    while at < n:
        m = _token.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m.group(1):
            tag = m.group(1).lower()
            if tag == "br":
                text.append(" ")
            elif tag == "a":
                depth_a = max(0, depth_a - 1)
            elif tag in BLOCKS:
                if opened[tag]:
                    gone = here
                    while gone.tag != tag:
                        gone = gone.parent
                    close_to(gone)
                elif tag == "p":
                    end()
        elif m.group(2):
            tag, attributes = m.group(2).lower(), m.group(3) or ""
            if tag == "br":
                text.append(" ")
            elif tag in RAW:
                if tag not in _ends:
                    _ends[tag] = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I)
                stop = _ends[tag].search(page, at)
                if tag in LITERAL:
                    end()
                    add(page[at : stop.start() if stop else n], True)
                    end()
                at = stop.end() if stop else n
            elif tag in SKIPPED:
                if not attributes.endswith("/") and tag not in unended:
                    to = _skip(page, at, tag)
                    if to == at:
                        unended.add(tag)  # no end from here on: it isn't looked for again
                    at = to
            elif tag not in BLOCKS:
                if tag == "a":
                    links += 1
                    depth_a += 1
            else:
                end()
                depth_a = 0  # inline elements left open don't reach into the next block
                if here.tag == "p":
                    close_to(here)
                if tag in _ends_in:
                    near = here.nearest[_ends_in[tag]]
                    if near is not None and near.tag in FAMILIES[_ends_in[tag]][0] and opened[near.tag]:
                        close_to(near)
                if tag not in VOID and not attributes.endswith("/"):
                    here = Element(tag, here, _names(attributes, known))
                    opened[tag] += 1
    end()
    return out
