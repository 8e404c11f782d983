"""Main text of web pages by two passes of block rules."""

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MAX_LINK_DENSITY = 0.2
SHORT = 70
LONG = 200
LOW_STOP_WORDS = 0.12
HIGH_STOP_WORDS = 0.2

# Common function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """
    the of and to in a is that it for on was be with as this by at are an from or not but have has he they you we his her
    de la le les des et que un une du en pour par sur dans est au pas qui ce il elle plus ne se avec
    der die das und den von zu mit sich ist im ein eine nicht auf dem er sie es für auch wie aus bei
    el los las del y se por con no una su al lo como más pero sus
    """.split()
)
# Elements that begin or end a block, that hold no article, and that hold nothing.
_BLOCKS = frozenset(
    """
    address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
    section select summary table tbody td tfoot th thead title tr ul
    """.split()
)
_NO_CONTAINER = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote".split())
_OUTSIDE = frozenset("aside button dialog footer form head label menu nav search select textarea title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ARTICLE = frozenset(("article", "main"))
# Words in class, id or role that name what stands beside an article.
_BESIDE = frozenset(
    """
    ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent gdpr notice notices alert popup
    modal menu nav navbar navigation breadcrumb breadcrumbs sidebar widget footer masthead topbar share sharing social
    related recommended newsletter subscribe signup login search comment comments reply replies disqus respond pagination
    pager toolbar copyright contentinfo complementary
    """.split()
)
# Parts of a class that say what a page has or lacks, or the state it is in, not what the element is.
_STATES = frozenset("has no not with without free open closed enabled disabled hidden off on is".split())
# These name an article's own parts when they stand in one.
_BESIDE_OUTSIDE = frozenset(("header",))

_TAG_NAME = re.compile(r"<(/?)([a-z][a-z0-9:-]*)", re.I)
# Elements whose content is no text of the page.
_SWALLOWED = frozenset("script style noscript template svg iframe object".split())
_SWALLOWED_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _SWALLOWED}
_QUOTE_OR_END = re.compile(r"""[>"']""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    link_chars: int
    beside: bool
    in_article: bool
    container: int
    element: int
    label: str = ""


# How an element is named as beside the article: not, by a part of a class, by a whole class, or by its tag.
_NOT, _IN_PART, _WHOLE, _TAG = range(4)


def _beside(tag: str, attributes: str, in_article: bool) -> int:
    if tag in _OUTSIDE or tag == "header" and not in_article:
        return _TAG
    if tag in ("html", "body", "main", "header") or not attributes:
        return _NOT
    named = _NOT
    for found in _NAMES.finditer(attributes):
        for name in (found[1] or found[2] or found[3] or "").lower().split():
            parts = _PART.findall(name)
            if not _STATES.intersection(parts) and any(
                part in _BESIDE or part in _BESIDE_OUTSIDE and not in_article for part in parts
            ):
                named = max(named, _WHOLE if len(parts) == 1 else _IN_PART)
    return named


@dataclass
class _Element:
    """An element, the one around it, how it is named, and whether it holds the page's article or main part."""

    around: int
    named: int
    holds: str = ""


def _sides(elements: list[_Element]) -> list[bool]:
    """Of each element, whether it is beside the article.

    A part of a class does not outweigh an ``<article>`` that the element is or holds; a whole class does, as cards in a
    ``sidebar`` are articles too.  Nothing but its tag and place outweighs that an element holds ``<main>``.
    """
    out: list[bool] = []
    for element in elements:
        least = {"": _IN_PART, "article": _WHOLE, "main": _TAG}[element.holds]
        out.append(element.named >= least or element.around >= 0 and out[element.around])
    return out


def _tag_end(page: str, at: int, failed: set[int]) -> int:
    """Where the tag ends whose attributes begin at ``at``: the first ``>`` outside quotes; -1 if a quote is left open.

    ``failed`` are places outside quotes from which no end was found, so that none is tried twice.
    """
    tried = []
    while at not in failed:
        tried.append(at)
        found = _QUOTE_OR_END.search(page, at)
        if found and found[0] == ">":
            return found.start()
        close = page.find(found[0], found.end()) if found else -1
        if close < 0:
            break
        at = close + 1
    failed.update(tried)
    return -1


def _markup(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, tag, slash, attributes) of tags; comments, declarations and swallowed elements have no tag name.

    A ``<`` that begins none of these, or that no ``>`` follows, is text.  The page is walked once.
    """
    at, last = 0, page.rfind(">")
    failed: set[int] = set()
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            at = len(page) if close < 0 else close + 3
            yield start, at, "", "", ""
        elif start > last:  # only a comment needs no ">"
            at = page.find("<!--", start)
            if at < 0:
                return
        elif not (name := _TAG_NAME.match(page, start)):
            at = start + 1
            if page[start + 1] in "!?/":
                close = page.find(">", start + 2)
                if close >= 0:
                    at = close + 1
                    yield start, at, "", "", ""
        else:
            slash, tag = name[1], name[2].lower()
            close = page.find(">", name.end())
            swallows = tag in _SWALLOWED and not slash and (page[name.end()] in "/>" or page[name.end()].isspace())
            if swallows and not (tag == "svg" and page[close - 1] == "/"):
                found = _SWALLOWED_END[tag].search(page, close + 1)
                at = found.end() if found else len(page)
                yield start, at, "", "", ""
                continue
            outside = _tag_end(page, name.end(), failed)
            close = outside if outside >= 0 else close
            at = close + 1
            yield start, at, tag, slash, page[name.end() : close]


def blocks_of(page: str) -> list[Block]:
    """Text between block elements, without markup, scripts and styles, in page order.

    White space inside a block is one space.  Two line breaks in a row end a block.  A paragraph or list item that is not
    closed ends where the next begins; any other element ends with its own end tag or with one around it.
    """
    out: list[Block] = []
    elements: list[_Element] = []
    # of each open element: tag, whether it or one around it is an article, its number, and that of its container
    stack: list[tuple[str, bool, int, int]] = []
    open_tags: Counter[str] = Counter()
    open_blocks: list[int] = []  # their depths
    text: list[str] = []
    links = link_depth = breaks = 0
    at = 0

    def end_block() -> None:
        nonlocal links, breaks
        string = " ".join(html.unescape("".join(text)).split())
        if string:
            inside, element, container = stack[-1][1:] if stack else (False, -1, 0)
            out.append(Block(string, links, False, inside, container, element))
        text.clear()
        links = breaks = 0

    def add(string: str) -> None:
        nonlocal links, breaks
        if string:
            text.append(string)
            if not string.isspace():
                breaks = 0
                if link_depth:
                    links += len(string.strip())

    def close_from(depth: int) -> None:
        for tag, *_ in stack[depth:]:
            open_tags[tag] -= 1
        del stack[depth:]
        while open_blocks and open_blocks[-1] >= depth:
            open_blocks.pop()

    for start, end, tag, closing, attributes in _markup(page):
        add(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "br":
            breaks += 1
            end_block() if breaks == 2 else text.append(" ")
            continue
        if tag in _BLOCKS:
            end_block()
        if tag == "a":
            link_depth = 0 if closing else 1
        if closing:
            if open_tags[tag]:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                close_from(depth)
        elif tag not in _VOID and not attributes.endswith("/"):
            if tag in _BLOCKS:
                # a paragraph holds no block; a list item ends where the next one begins
                nearest = stack[open_blocks[-1]][0] if open_blocks else ""
                if nearest == "p" or nearest == tag == "li":
                    close_from(open_blocks[-1])
            inside, around, container = stack[-1][1:] if stack else (False, -1, 0)
            marks = tag in _ARTICLE
            if marks and (not inside or tag == "main"):
                for _, _, number, _ in reversed(stack):
                    if elements[number].holds >= tag:
                        break  # so do those around it
                    elements[number].holds = tag
            elements.append(_Element(around, _beside(tag, attributes, inside or marks), tag if marks else ""))
            number = len(elements) - 1
            if tag in _BLOCKS:
                open_blocks.append(len(stack))
                container = container if tag in _NO_CONTAINER else number + 1
            open_tags[tag] += 1
            stack.append((tag, inside or marks, number, container))
    add(page[at:])
    end_block()
    sides = _sides(elements)
    for block in out:
        block.beside = block.element >= 0 and sides[block.element]
    return out


def first_pass(block: Block, has_article: bool) -> str:
    """``good``, ``bad``, or ``short`` for what the block itself does not decide.

    Blocks beside the article are bad: those in menus, forms and so on, and all outside the article where the page marks one.
    Of the others, those with many links or a copyright sign are bad and those below 70 characters undecided.  The share
    of stop words decides the rest: prose is good.  What has few is bad, but undecided inside a marked article, where
    a table, a formula or another language may stand.
    """
    if block.beside or has_article and not block.in_article:
        return "bad"
    length = len(block.text)
    if block.link_chars > MAX_LINK_DENSITY * length or "\N{COPYRIGHT SIGN}" in block.text and not block.in_article:
        return "short" if block.in_article and block.link_chars < length else "bad"
    if length < SHORT:
        return "short"
    words = _WORD.findall(block.text.lower())
    density = sum(word in STOP_WORDS for word in words) / max(1, len(words))
    if density >= HIGH_STOP_WORDS or density >= LOW_STOP_WORDS and length >= LONG:
        return "good"
    return "short" if density >= LOW_STOP_WORDS or block.in_article else "bad"


def second_pass(blocks: list[Block]) -> None:
    """Undecided blocks take the label of the nearest decided neighbour, by the text between.

    Blocks inside a marked article look at each other only, as do those outside; neighbours in the same element come before
    others.  Of two equally near ones that differ, good wins.  Where none is decided, blocks inside a marked article are good
    and others bad.
    """
    n = len(blocks)
    before: list[tuple[int, int] | None] = [None] * n
    after: list[tuple[int, int] | None] = [None] * n
    for order, side in ((range(n), before), (range(n - 1, -1, -1), after)):
        near: dict[tuple[str, int | bool], tuple[int, int]] = {}
        place = 0
        for i in order:
            block = blocks[i]
            if block.label == "short":
                same, any_ = near.get(("element", block.container)), near.get(("zone", block.in_article))
                chosen = same or any_
                if chosen:
                    side[i] = (place - chosen[1] + (0 if same else 1 << 40), chosen[0])
            place += len(block.text)
            if block.label != "short":
                near["element", block.container] = near["zone", block.in_article] = (i, place)
    decided = [block.label for block in blocks]
    for i, block in enumerate(blocks):
        if block.label == "short":
            sides = [x for x in (before[i], after[i]) if x]
            if sides:
                least = min(sides)[0]
                block.label = "good" if any(d == least and decided[j] == "good" for d, j in sides) else "bad"
            else:
                block.label = "good" if block.in_article else "bad"


def main_text(page: str | None) -> str:
    """The page's article: its good blocks in page order with an empty line between; empty if there is none."""
    blocks = blocks_of(page or "")
    has_article = any(block.in_article and not block.beside for block in blocks)
    for block in blocks:
        block.label = first_pass(block, has_article)
    second_pass(blocks)
    return "\n\n".join(block.text for block in blocks if block.label == "good")


def _extract(column: str, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(column)]
        made = {
            "text": pa.array(texts, type=pa.string()),
            "n_chars": pa.array([len(text) for text in texts], type=pa.int64()),
        }
        yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(n) for n in names], names)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """The pages with ``text`` and ``n_chars``, its code points, in place of the markup.

    A NULL or empty page, or one without an article, has an empty text.  Pages are independent: repeated ones give equal
    rows, and an empty table an empty one.  Columns of the two names are replaced; other columns stay as they are.
    """
    kept = pages.drop("text", "n_chars")
    schema = kept.drop(column).withColumns({"text": F.lit(None).cast("string"), "n_chars": F.lit(None).cast("long")}).schema
    names = schema.names
    return kept.mapInArrow(lambda batches: _extract(column, names, batches), schema)
