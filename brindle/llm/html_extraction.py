"""Main text of web pages by two passes of rules over blocks.

A page is cut into blocks at block elements. Pass one decides what it can: blocks inside menus, forms, adverts, notices,
comments and the like, told by element, role or class, and blocks full of links are left out; long blocks with a fair share of
stop words are main text, and so are longer blocks without links inside an article. Pass two gives the other
blocks, mostly short ones, the label of the nearest decided neighbour; a heading looks to what follows it.

Character references are decoded run by run, white space inside a block becomes one space, and blocks are joined by a line feed
in page order. NULL and empty pages give an empty text. Repeated rows are extracted each, and other columns are
ignored, whatever their names. Very long pages are read whole, in time that grows with their length, tags without an end
or a beginning included. A block as near to one neighbour as to another of the other label goes by whether it is in the
article.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Generator, Iterable, Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from brindle.llm.words import slices

LONG, MEDIUM = 120, 50  # characters
FAIR_STOP, HIGH_STOP = 0.12, 0.25  # shares of stop words
MANY_LINKS = 0.5  # share of a block's characters that stand in links

#: Stop words of the languages that pages are written in. Fixed values.
STOP_WORDS = frozenset(
    "the of and to in is that for it as with was on are this be by at from or an a have not he his they you we but which "
    "der die und das den von zu mit sich des auf ist nicht dem ein eine als auch es an werden aus er hat dass sie nach im "
    "le la les et des du une un est que pour dans qui au sur pas de en il ne se ce plus par avec son elle "
    "el los las y del por con para su al lo como mas o pero sus una si sobre este".split()
)
#: Elements whose content is no running text of the page.
DROPPED = frozenset("head title script style noscript template iframe svg canvas object embed math audio video map".split())
#: Elements that hold something other than the article.
ASIDE = frozenset("nav footer aside form select button textarea menu dialog label option fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
CLOSES = {  # an opening tag of the first kind ends an open one of the others
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
HOLDS = frozenset("ul ol dl table select body article section div".split())  # these are not left by such an end
#: Words in a class, id or role that tell what is not the article, whatever it holds.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "popup modal newsletter subscribe subscription signup login comment comments reply replies disqus respond share sharing "
    "social related recommended widget hidden contentinfo complementary".split()
)
#: Words that tell so too, but may also stand on the frame around an article, which is then left in.
FRAME_MARKS = frozenset(
    "banner notice notices overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar footer "
    "header masthead topbar skip alert search dialog copyright form tags tagcloud toc".split()
)
FRAME, OUTSIDE = 1, 2

VAIN = 4  # times a page's length that is looked through for quotes that never end
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_QUOTED = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_NAME = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s+")


def tokens(html: str) -> Generator[tuple[int, int, str, bool, str], int | None, None]:
    """Tags of a page: where each begins and ends, its name ("" for comments and the like), whether it is an end tag, and
    its attributes. A caller may send the place to go on from.

    One pass: nothing is looked for behind the last `>`, and a page whose quotes do not end is read as if they were none
    once `VAIN` times its length was looked through in vain.
    """
    at, vain, last = 0, 0, html.rfind(">")
    while 0 <= (begin := html.find("<", at)) < last:
        at = begin + 1
        after = html[begin + 1 : begin + 2]
        name, is_end, attributes = "", False, ""
        if html.startswith("<!--", begin):
            stop = html.find("-->", begin + 4)
            end = len(html) if stop < 0 else stop + 3
        elif found := _TAG.match(html, begin):
            is_end, name, inner = bool(found[1]), found[2], found.end()
            quoted = _QUOTED.match(html, inner) if vain <= VAIN * len(html) else None
            if not quoted:
                vain += len(html) - inner
            end = quoted.end() if quoted else html.find(">", inner) + 1
            if not end:
                return
            attributes = html[inner : end - 1]
        elif after in ("!", "?", "/"):
            end = html.find(">", at) + 1
        else:
            continue
        resumed = yield begin, end, name.lower(), is_end, attributes
        at = max(end, resumed or 0)
    if (begin := html.find("<!--", at)) >= 0:  # a comment without an end
        yield begin, len(html), "", False, ""


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    outside: bool  # inside something that is not the article
    article: bool
    heading: bool
    label: bool | None = None


def _outside(tag: str, attributes: str) -> int:
    """0, FRAME or OUTSIDE, by what an opening tag says of its content."""
    if tag in ASIDE:
        return OUTSIDE
    worst = 0
    for name, value in _NAME.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            marks = re.split(r"[^a-z]+", value)
            worst = max(worst, 0 if FRAME_MARKS.isdisjoint(marks) else FRAME, 0 if MARKS.isdisjoint(marks) else OUTSIDE)
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            worst = OUTSIDE
    return worst


def blocks(html: str) -> list[Block]:
    """The blocks of a page that have text, in page order."""
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    stack: list[tuple[str, int, bool]] = []  # tag, outside, article
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements of each name in the stack
    outside, article = 0, False
    links = heading = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                out.append(Block(text, min(linked, len(text)), outside > 0, article, bool(heading)))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(unescape(text))  # each run by itself: a reference does not go on behind a tag
            if links:
                linked += len(parts[-1])

    def pop(to: int) -> None:
        nonlocal outside, article, links, heading
        for tag, _, _ in stack[to:]:
            places[tag].pop()
            links -= tag == "a"
            heading -= tag[0] == "h" and tag[1:].isdigit()
        del stack[to:]
        outside, article = stack[-1][1:] if stack else (0, False)

    def innermost(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    at, found, go_on = 0, tokens(html), None
    while True:
        try:
            begin, end, tag, is_end, attributes = found.send(go_on)
        except StopIteration:
            break
        add(html[at:begin])
        at, go_on = end, None
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            parts.append(" ")
        if is_end:
            if places.get(tag):
                pop(places[tag][-1])
            continue
        if tag in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{tag}\b", re.I).search(html, at)
            stop = html.find(">", close.end()) if close else -1
            at = go_on = stop + 1 if stop >= 0 else len(html)
            continue
        if tag in BLOCKS and places.get("p"):
            pop(places["p"][-1])
        if tag in CLOSES and (inner_most := innermost(CLOSES[tag])) > innermost(HOLDS):
            pop(inner_most)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        inner = article or tag in ("article", "main")
        own = 0 if tag in ("body", "html") else _outside(tag, attributes)
        if tag in DROPPED or tag == "header" and not article:
            own = OUTSIDE
        around = 0 if outside == FRAME and tag in ("article", "main") else outside
        places[tag].append(len(stack))
        stack.append((tag, max(around, own), inner))
        outside, article = stack[-1][1:]
        links += tag == "a"
        heading += tag[0] == "h" and tag[1:].isdigit()
    add(html[at:])
    flush()
    return out


def _decide(block: Block) -> bool | None:
    """Pass one: main text, not main text, or not known yet."""
    n = len(block.text)
    if block.outside or block.linked > MANY_LINKS * n:
        return False
    words = _WORD.findall(block.text.lower())
    stop = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if n >= LONG and stop >= FAIR_STOP or n >= MEDIUM and stop >= HIGH_STOP and block.linked < 0.2 * n:
        return True
    return True if block.article and n >= MEDIUM and not block.linked and not block.heading else None


def classify(found: list[Block]) -> None:
    """Label the blocks: pass one, then pass two for those that are left."""
    for b in found:
        b.label = _decide(b)
    decided = [b.label for b in found]
    usable = [k for k, x in enumerate(decided) if x is not None and not found[k].outside]
    before: list[int | None] = []
    last = None
    for k in range(len(found)):
        before.append(last)
        last = k if decided[k] is not None and not found[k].outside else last
    after: list[int | None] = []
    last = None
    for k in range(len(found) - 1, -1, -1):
        after.append(last)
        last = k if decided[k] is not None and not found[k].outside else last
    after.reverse()
    for k, b in enumerate(found):
        if decided[k] is not None:
            continue
        # A neighbour inside the article says nothing of a block outside of it, and the other way round.
        near = [j for j in (before[k], after[k]) if j is not None and found[j].article == b.article]
        if not near:
            b.label = b.article or not usable and not any(x.article for x in found)
        elif b.heading and after[k] in near:
            b.label = decided[after[k]]
        else:
            nearest = min(abs(j - k) for j in near)
            labels = {decided[j] for j in near if abs(j - k) == nearest}
            b.label = labels.pop() if len(labels) == 1 else b.article


def main_text(html: str) -> str:
    found = blocks(html)
    classify(found)
    return "\n".join(b.text for b in found if b.label)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, pages in slices(batches, "html"):
        texts = [main_text(p.decode("utf-8", "replace")) if p else "" for p in pages]
        yield pa.RecordBatch.from_arrays(
            [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points of the text) of every page."""
    id_type = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        _texts, f"page_id {id_type}, url string, text string, n_chars bigint"
    )
