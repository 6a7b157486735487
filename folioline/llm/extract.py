"""Main text of web pages: two-pass block rules.

A page becomes blocks of text, cut at block elements. What stands in parts that are never text (menus, scripts,
forms, notices, comments, ...) is bad. The first pass decides the rest by length, link density and the
density of stop words; short blocks and those in between stay open. In the second pass they inherit from the nearest
decided neighbours. Where a page marks its article, only the blocks in it are candidates, unless good blocks stand outside
of it alone. Articles within parts that class, id or role bar are barred with them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folioline.session import ship_package

# Elements, in the terms of HTML, and words of class and id attributes.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
section summary table tbody td tfoot th thead title tr ul""".split())
BARRED = frozenset("""aside button canvas datalist dialog footer form head iframe map menu nav noscript object select
svg template""".split())
RAW = frozenset("title script style textarea xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never opened or closed by accident: an unclosed barred element ends where one of these begins or its parent ends.
LANDMARKS = frozenset("article main".split())
#: Barred elements in which an article is not the page's, closed or not.
NEVER_HOLD = frozenset("aside dialog template noscript svg iframe object".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BARRED_NAMES = frozenset("""ad ads advert advertisement advertising adverts adbox banner banners breadcrumb breadcrumbs comment
comments commentlist consent cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter
notice notices notification overlay pager pagination popup popups promo promoted promotion related respond share sharing
sidebar sidebars signup social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
BARRED_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation
search toolbar""".split())
#: Frequent words of the languages that are told apart.
STOP_WORDS = frozenset("""a an and are as at be by for from has have he in is it not of on or that the this to was were
which with der die das den dem des ein eine und in im ist sich mit von zu auf für nicht als auch es an werden aus le la les
un une des du de et en est que qui dans pour par pas sur au aux avec ce il ne el los las una y o del se con para por no su
al lo como más""".split())

SHORT_CHARS, LONG_CHARS = 70, 200
STOP_LOW, STOP_HIGH = 0.1, 0.2
LINKS_HIGH = 0.5

GOOD, BAD, OPEN = 1, 0, None

_TOKEN = re.compile(r"""<(?:!--(?:>|->|.*?(?:-->|--!>|\Z))|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)
    |(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)(?:>|\Z))""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
_NAME = re.compile(r"[a-z]+")


class _Block:
    __slots__ = ("parts", "linked", "heading")

    def __init__(self, heading: bool):
        self.parts: list[str] = []
        self.linked = 0
        self.heading = heading

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def _barred_by_attributes(name: str, attributes: str) -> bool:
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key == "role" and value in BARRED_ROLES:
            return True
        # compounds such as "article-comment-count" are barred by any of their words
        if key in ("class", "id") and name not in LANDMARKS and not BARRED_NAMES.isdisjoint(_NAME.findall(value)):
            return True
    return False


def _blocks(page: str) -> tuple[list[_Block], list[bool], bool]:
    """Blocks outside barred parts in page order, whether each is in an article, and whether there is one."""
    blocks: list[_Block] = []
    inside: list[bool] = []
    opened: list[str] = []       # landmarks that are open
    barred, depth = "", 0        # the barred element that is open, and how often its name is
    barred_at = -1               # where it begins, if its element barred it; -1 if its attributes did
    held: list[str] = []         # landmarks that are open within the barred element
    closed: dict[str, set[int]] = {}
    only_headings = 0            # depth within headers of an article
    heading, link = False, 0
    current: _Block | None = None
    found_landmark = False
    at, end = 0, len(page)

    def add(text: str) -> None:
        nonlocal current
        if not text or barred or (only_headings and not heading):
            return
        if current is None:
            if not text.strip():
                return
            current = _Block(heading)
            blocks.append(current)
            inside.append(bool(opened))
        current.parts.append(text)
        if link:
            current.linked += len(text)

    while at < end:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        token = _TOKEN.match(page, start)
        if not token:  # a sign, not a tag
            add(page[at:start + 1])
            at = start + 1
            continue
        add(page[at:start])
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name, closing = name.lower(), bool(token[1])
        if name == "br":
            add(" ")
            continue
        if name in RAW and not closing:
            close = _RAW_END[name].search(page, at)
            at = close.start() if close else end
            continue
        if name in BLOCKS:
            current = None
        if name in LANDMARKS:
            if closing:
                if barred and name in held:
                    del held[len(held) - 1 - held[::-1].index(name):]
                elif barred in LANDMARKS and name == barred:
                    barred = ""
                elif name in opened:
                    del opened[len(opened) - 1 - opened[::-1].index(name):]
                    barred, only_headings, held = "", 0, []
            elif barred and not _ends_at_article(page, barred, barred_at, closed):
                held.append(name)
            elif "article" in opened and _barred_by_attributes("", token[3]):
                # a comment or the like on the article around it
                barred, depth, barred_at, held, link = name, 1, -1, [], 0
            else:
                found_landmark = True
                barred, only_headings, held = "", 0, []
                opened.append(name)
            continue
        if name == "body":
            barred, depth, held = "", 0, []
            continue
        if barred:
            if name == barred:
                depth += -1 if closing else 1
                if depth == 0:
                    barred, held = "", []
            continue
        if name == "header" and opened:
            only_headings = max(0, only_headings + (-1 if closing else 1))
            continue
        if name in HEADINGS:
            heading = not closing
        elif name == "a":
            link = 0 if closing else 1
        if closing or name in VOID:
            continue
        by_attributes = bool(token[3].strip()) and _barred_by_attributes(name, token[3])
        if name in BARRED or name == "header" or by_attributes:
            if not token[3].rstrip().endswith("/"):
                barred, depth, barred_at, held = name, 1, -1 if by_attributes else start, []
                link = 0
    return blocks, inside, found_landmark


def _ends_at_article(page: str, barred: str, at: int, closed: dict[str, set[int]]) -> bool:
    """Menus and the like that are never closed end at an article, and a form may hold one; what attributes bar, never does."""
    if at < 0 or barred in NEVER_HOLD:
        return False
    if barred == "form":
        return True
    if barred not in closed:
        closed[barred] = _closed(page, barred)
    return at not in closed[barred]


def _closed(page: str, name: str) -> set[int]:
    """Where the elements of a name begin that have an end."""
    opened, found = [], set()
    for tag in re.finditer(rf"<(/?){name}(?=[\s/>])", page, re.I):
        if not tag[1]:
            opened.append(tag.start())
        elif opened:
            found.add(opened.pop())
    return found


def main_text(page: str | None) -> str:
    """The article of one page: blocks joined by an empty line. Null and empty pages give an empty text."""
    if not page:
        return ""
    blocks, inside, marked = _blocks(page)
    kept = [(b, t, i) for b, i in zip(blocks, inside) if (t := b.text())]
    marked = marked and any(inside)
    if marked:
        own = [(_first_pass(b, t, i), i) for b, t, i in kept]
        # teasers and comments are marked as articles too
        marked = (GOOD, True) in own or (GOOD, False) not in own
    if marked:
        kept = [x for x in kept if x[2]]
    labels = [_first_pass(b, t, marked) for b, t, _ in kept]
    return "\n\n".join(t for (_, t, _), good in zip(kept, _second_pass(labels)) if good)


def _first_pass(block: _Block, text: str, marked: bool):
    """Good, bad or open. Headings never decide; in a marked article only link lists are bad."""
    if block.heading:
        return OPEN
    links = block.linked / max(1, len("".join(block.parts)))
    if links > LINKS_HIGH and not (marked and len(text) < SHORT_CHARS):
        return BAD
    if len(text) < SHORT_CHARS:
        return OPEN
    words = text.lower().split()
    stops = sum(w.strip(".,;:!?") in STOP_WORDS for w in words) / len(words)
    if stops >= STOP_HIGH or (stops >= STOP_LOW and len(text) >= LONG_CHARS):
        return GOOD
    # text of an unknown language has no stop words either, so their lack alone decides nothing
    return OPEN


def _second_pass(labels: list) -> list[bool]:
    """Open blocks take the label of the nearest decided one; if two are equally near, or none is there, they stay."""
    n = len(labels)
    before: list[tuple[int, int] | None] = [None] * n
    after: list[tuple[int, int] | None] = [None] * n
    last = None
    for i in range(n):
        last = (i, labels[i]) if labels[i] is not OPEN else last
        before[i] = last
    last = None
    for i in range(n - 1, -1, -1):
        last = (i, labels[i]) if labels[i] is not OPEN else last
        after[i] = last
    out = []
    for i in range(n):
        b, a = before[i], after[i]
        if labels[i] is not OPEN:
            out.append(bool(labels[i]))
        elif b is None or a is None:
            near = b or a
            out.append(True if near is None else bool(near[1]))
        elif i - b[0] == a[0] - i:
            out.append(bool(b[1]) or bool(a[1]))
        else:
            out.append(bool(b[1] if i - b[0] < a[0] - i else a[1]))
    return out


def extract(pages: DataFrame, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default ``page_id``, ``url``), ``text`` and ``n_chars`` (code points) for each page.

    Each page by itself, in Arrow batches; repeated rows give repeated results.
    """
    ship_package(pages.sparkSession)
    keep = keep or ["page_id", "url"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                batch.columns[1:] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*keep, "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["text string", "n_chars long"])
    return pages.select(F.col(html_column).alias("_html"), *keep).mapInArrow(run, schema)
