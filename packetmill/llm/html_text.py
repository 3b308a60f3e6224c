"""Main text of web pages by two passes over their blocks.

A page is read tag by tag into blocks: the text between two tags that start or end a paragraph,
heading, list item, cell and the like, with character references decoded and white space made one
space. Pass 1 decides what it can: blocks inside navigation, footers, side bars, forms and elements
whose class, id or role says advert, notice, menu or comment are boilerplate, and so are blocks
that are mostly links; long blocks with enough stop words are text. Pass 2 gives each block left
undecided, mostly short ones, the label of its nearest decided neighbours: if both sides agree,
theirs, else that of the nearer one in words, text winning a tie. Inside an article (or main)
element neighbours count only if they belong to it too, and a block without any is text.

A page of which nothing would be left is looked at again: where no block has the stop words of a
listed language, long blocks with few links are text; and a form, or an element whose class only hints at
boilerplate, does not count as such if it holds an article, or most of the page's words in several texts.

Defined cases: a null or blank page has the empty text; unclosed elements end with their parent; a
link that is not closed before the next one is none; a comment, script or tag that the page's end
cuts off is dropped; quotes in a tag count after an equals sign only; equal blocks are all kept.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetmill.llm.common import unpack

LONG_WORDS = 15
STOP_SHARE = 0.08
LINK_SHARE = 0.5
LONG_CHARACTERS = 80  # of a block in a script that may not part words by blanks
WRAPPED_BLOCKS = 3    # text blocks in a wrapper that tell a page's body from a notice

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
a an and are as at be by for from has have he in is it its not of on or she that the they this to was were which will with you
als auch auf aus bei das dass dem den der des die ein eine einem einen einer es für hat ich im ist mit nach nicht sich sie sind und von war
zu zum zur
au aux avec ce ces cette dans de des du elle en est et il la le les leur mais ne nous ou par pas plus pour qui que se sur un une vous
al como con de del el ella en es esta fue ha la las lo los más no o para pero por que se su sus un una y ya
""".split())

RAW = ("script", "style", "noscript", "template", "iframe", "svg", "math", "object", "textarea", "select", "title", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""
a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup
time tt u var wbr
""".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form button menu dialog head".split())
ROOM_TAGS = frozenset("article main".split())
_HINT_WORDS = frozenset("""
ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright
disclaimer footer header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related
replies respond reply share sharing sidebar social sponsor sponsored subscribe toolbar widget gdpr
""".split())
# Names that speak of the layout around something: has-sidebar is no side bar.
_LAYOUT_WORDS = frozenset("no has with without layout".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_INSIDE = r"(?:[^>\"'=]+|=\s*(?:\"[^\"]*\"|'[^']*')?|[\"'])*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b" + _INSIDE + r">.*?(?:</(?P=raw)\s*[^>]*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>" + _INSIDE + r")(?:>|\Z)|<[!?/](?:[^>]*)(?:>|\Z)",
    re.S | re.I)
_ANCHOR = re.compile(r"<(/?)a(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORDS_OF_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Mark:
    """An element that is boilerplate by its kind or name, and the next one around it."""

    parent: Mark | None
    weak: bool            # a form, or an element whose name only hints at it
    bad: bool = True
    words: int = 0        # in all blocks within
    texts: int = 0        # long blocks with stop words within
    has_room: bool = False


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    mark: Mark | None     # the innermost marked element around it
    room: int             # number of the article or main element around it, 0 for none
    good: bool | None = None

    @property
    def boilerplate(self) -> bool:
        return self.mark is not None and self.mark.bad


class Blocks(list):
    """The blocks of a page in order, and its marked elements, outer ones before inner ones."""

    def __init__(self):
        super().__init__()
        self.marks: list[Mark] = []


def _marked(tag: str, attributes: str, room: int) -> bool | None:
    """Whether an element is boilerplate: True if only weakly so, False if surely, None if not."""
    if tag != "form" and (tag in BOILERPLATE_TAGS or (tag == "header" and not room)):
        return False
    weak = True if tag == "form" else None
    if "=" not in attributes and "hidden" not in attributes.lower():
        return weak
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in _ROLES:
            return False
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return False
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return False
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            for part in value.split():
                words = {w.lower() for w in _WORDS_OF_NAME.findall(part)}
                if words & _HINT_WORDS and not words & _LAYOUT_WORDS:
                    weak = True
    return weak


def blocks(page: str) -> Blocks:
    """The non-empty blocks of a page in order."""
    out = Blocks()
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, Mark | None, int]] = [("", None, 0)]  # tag, mark, room
    open_tags: Counter[str] = Counter()
    rooms, in_link = 0, False
    anchors = [(m.start(), bool(m[1])) for m in _ANCHOR.finditer(page)]
    # Links do not nest: one that another follows before its end was never closed.
    closed = {at for (at, end), (_, next_end) in zip(anchors, anchors[1:]) if next_end and not end}

    def end_block() -> None:
        # References are decoded piece by piece, so that a cut tag never makes one.
        text = " ".join("".join(parts).split())
        if text:
            _, mark, room = stack[-1]
            out.append(Block(text, len(text.split(" ")), len(" ".join(linked).split()), mark, room))
        parts.clear()
        linked.clear()

    def add(raw: str) -> None:
        if raw:
            text = html.unescape(raw)
            parts.append(text)
            if in_link:
                linked.append(text)

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m["raw"]:
                parts.append(" ")
            continue
        if not m[0].endswith(">"):
            continue  # cut off by the end of the page
        attributes = m["attributes"]
        if tag == "a":
            in_link = not m["close"] and not attributes.endswith("/") and m.start() in closed
        if tag == "br":
            parts.append(" ")
            continue
        if tag in INLINE and _marked(tag, attributes, stack[-1][2]) is None and not (m["close"] and open_tags[tag]):
            continue
        end_block()
        if tag in VOID:
            continue
        if m["close"]:
            while open_tags[tag]:
                last = stack.pop()[0]
                open_tags[last] -= 1
                if last == tag:
                    break
        elif not attributes.endswith("/"):
            if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack[-1][0] == tag:
                open_tags[stack.pop()[0]] -= 1  # these end where the next one starts
            _, mark, room = stack[-1]
            if tag in ROOM_TAGS and not room:
                rooms += 1
                room = rooms
                if mark is not None:
                    mark.has_room = True
            weak = _marked(tag, attributes, room)
            if weak is not None:
                mark = Mark(mark, weak)
                out.marks.append(mark)
            stack.append((tag, mark, room))
            open_tags[tag] += 1
    add(page[at:])
    end_block()
    return out


def _is_text(block: Block) -> bool:
    """A long block with enough stop words."""
    if block.words < LONG_WORDS:
        return False
    stops = sum(w.strip(".,;:!?\"'()").lower() in STOP_WORDS for w in block.text.split(" "))
    return stops >= STOP_SHARE * block.words


def _decide(found: list[Block], texts: list[bool]) -> list[bool | None]:
    """Pass 1: text, boilerplate, or None."""
    few_links = [b.link_words <= LINK_SHARE * b.words for b in found]
    decided = [False if b.boilerplate or not few else text or None for b, few, text in zip(found, few_links, texts)]
    if True not in decided and not any(b.room and not b.boilerplate for b in found):
        # No listed language: length alone has to tell.
        decided = [True if d is None and (b.words >= LONG_WORDS or len(b.text) >= LONG_CHARACTERS) else d for b, d in zip(found, decided)]
    return decided


def _unwrap(found: Blocks, texts: list[bool]) -> bool:
    """Clear weak marks around an article or around most of the page in several texts; whether there are any."""
    for b, text in zip(found, texts):
        if b.mark is not None:
            b.mark.words += b.words
            b.mark.texts += text
    for mark in reversed(found.marks):
        if mark.parent is not None:
            mark.parent.words += mark.words
            mark.parent.texts += mark.texts
            mark.parent.has_room |= mark.has_room
    half = sum(b.words for b in found) / 2
    cleared = False
    for mark in found.marks:
        if mark.weak and (mark.has_room or (mark.words > half and mark.texts >= WRAPPED_BLOCKS)):
            mark.bad, cleared = False, True
        mark.bad = mark.bad or (mark.parent is not None and mark.parent.bad)
    return cleared


def classify(found: Blocks) -> Blocks:
    """Label all blocks; a second time without wrappers that would take the whole page with them."""
    texts = [_is_text(b) for b in found]
    _label(found, texts)
    if not any(b.good for b in found) and _unwrap(found, texts):
        _label(found, texts)
    return found


def _label(found: Blocks, texts: list[bool]) -> None:
    """Pass 1, then neighbours for the blocks that it leaves open."""
    decided = _decide(found, texts)
    n = len(found)

    def nearest(step: int) -> list[tuple[bool, int, int] | None]:
        """For every block the nearest decided one on a side: its label, the words between, its room."""
        out: list = [None] * n
        last, gap = {}, {}  # by room, and under None over all rooms
        for i in (range(n) if step > 0 else range(n - 1, -1, -1)):
            room = found[i].room or None
            out[i] = (last[room], gap[room]) if room in last else None
            for key in {room, None}:
                if key and found[i].boilerplate:
                    continue  # an advert inside an article says nothing about the text beside it
                if decided[i] is not None:
                    last[key], gap[key] = decided[i], 0
                elif key in last:
                    gap[key] += found[i].words
        return out

    for i, (before, after) in enumerate(zip(nearest(1), nearest(-1))):
        if decided[i] is not None:
            found[i].good = decided[i]
        elif before is None and after is None:
            found[i].good = bool(found[i].room)
        elif before is None or after is None:
            found[i].good = (before or after)[0]
        elif before[0] == after[0]:
            found[i].good = before[0]
        else:
            near, far = sorted([before, after], key=lambda x: x[1])
            found[i].good = near[0] or near[1] == far[1]


def main_text(page: str | None) -> str:
    return " ".join(b.text for b in classify(blocks(page or "")) if b.good)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Every input row with ``text``, the main text, and ``n_chars``, its code points."""

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return column.map(main_text)

    packed = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), text(F.coalesce(html_col, F.lit(""))).alias("text"))
    return unpack(packed, F.col("text"), F.char_length("text").cast("long").alias("n_chars"))
