"""HTML extraction by two passes of block rules.

A page is cut into blocks at block-level tags. Pass one adds up a block's evidence: its length, its stop-word density,
minus its link density, and a prior from its elements and their class and id names. Evidence of GOOD or more makes it
text, BAD or less makes it boilerplate; between the two it stays undecided. Pass two lets each undecided block inherit
the label of the nearest decided one: of its own zone (the innermost element with a strong mark), else of the page. Where
a block before and a block after are as near, a heading goes with what follows, other blocks with what they follow. A
zone without decided blocks goes by the sign of its evidence. Text blocks are joined in page order.

Names are a prior, so weak ones (tags, meta, review, ..) lose against prose, and a name counts only as a whole word of
class or id or as its head (site-footer, sidebar-left), never as a part of another (side-effects). Menus, forms, comments
and the like are prose at times, which no text rule can tell from the article's; their prior outweighs length and density.

Null and empty pages have the empty text. Broken markup is read as far as it goes: unclosed elements end with the page,
unclosed tags before the next one, stray closing tags are ignored. Long pages are read whole, in time that grows with
their length (test_html_text doubles broken pages four times). Ties are settled as said.
Repeated rows give repeated results; an empty table gives an empty one. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, table

#: Frequent function words of the languages in view.
STOP_WORDS = frozenset(
    """the of and to in a is that it was for on are as with be by at this from or an not have but which you they his her he she we
    der die das und in den von zu ist mit im nicht ein eine auf für dem des sich als auch es an werden aus er hat dass sie nach bei
    de la le les et des en un une du que qui dans est pour par sur au pas plus avec ce ne se son il elle
    el los las y que del se por con para una su al lo como más pero sus no es""".split()
)
#: Elements whose content isn't shown as text, those read as raw text, and those of menus, forms and margins.
SILENT = frozenset("script style noscript template svg iframe object audio video head title".split())
RAW = frozenset("script style noscript template textarea title iframe".split())
BOILER = frozenset("nav footer aside form menu dialog button fieldset label select option textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong
    sub sup time tt u var wbr br math mi mn mo ms mrow msup msub mfrac msqrt""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words that, as a whole name or the head of one, mark what isn't the article; comments; weak ones; the article.
AWAY = frozenset(
    """ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent
    gdpr notice notices alert popup modal overlay sidebar sidebars widget widgets share sharing social breadcrumb breadcrumbs
    menu nav navbar navigation footer masthead topbar toolbar subscribe subscription newsletter signup login search pagination
    pager skip complementary contentinfo outbrain taboola recommendations related""".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond replies".split())
WEAK = frozenset("tag tags meta legal disclaimer copyright review reviews teaser header reply side".split())
ARTICLE = frozenset("article content post entry story main articlebody postbody text".split())
#: Words that a name may add to its head without changing what it marks.
FORM_WORDS = frozenset(
    """list box wrap wrapper container area section block bar links form inner outer panel item items content body thread
    top bottom left right main site page global header banner cookie post posts articles stories article author unit slot
    text message primary secondary footer comment row col grid group entry default large small""".split()
)
NOT_A_MARK = frozenset("has no with without is not".split())
NAMES = re.compile(r"""\b(class|id|role|aria-hidden|hidden|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']++|"[^"]*"|'[^']*')*+)>"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)(?:>|(?=<)|\Z)|[^<]+|<""",
    re.S,
)  # outside quotes a tag ends at the next <, so one that isn't closed is not looked for to the end of the page
WORD = re.compile(r"\w+")

#: Evidence from which a block is text, and down to which it is boilerplate.
GOOD, BAD = 2.0, -2.0
#: Priors: within an article element, an away mark, a weak mark, and outside the article of a page that marks one.
IN_ARTICLE, IN_AWAY, IN_WEAK, OUTSIDE = 1.5, -5.0, -2.0, -3.0
LINKED = 3.0
#: Words from which a block is of medium or great length, and stop-word densities that count as low, some and high.
MEDIUM, LONG = 15, 40
STOPS = (0.03, 0.1, 0.2)


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    prior: float
    #: The innermost strongly marked element, by number; 0 is the page.
    zone: int
    #: Whether that is an article, and whether an article element stands in an element with an away name.
    article: bool
    lifted: bool
    heading: bool


@dataclass(slots=True)
class _Open:
    """An open block element, with what holds within it."""

    name: str
    prior: float
    zone: int
    article: bool
    lifted: bool
    away: str


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page with what their elements say about them."""
    found: list[Block] = []
    stack = [_Open("", 0.0, 0, False, False, "")]
    opened: Counter[str] = Counter()
    zones = links = linked = 0
    text: list[str] = []

    def end() -> None:
        nonlocal linked
        if text:
            line = " ".join(unescape("".join(text)).split())
            if line:
                top = stack[-1]
                found.append(Block(line, linked, top.prior, top.zone, top.article, top.lifted, any(x.name in HEADINGS for x in stack[-3:])))
            text.clear()
        linked = 0

    at, size = 0, len(html)
    while at < size:
        m = TOKEN.match(html, at)
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            if html[m.start()] != "<" or at - m.start() == 1:
                text.append(m[0])
                if links:
                    linked += len(m[0].strip())
            continue
        name, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            elif name == "br":
                text.append(" ")
            continue
        end()
        if closing:
            links = 0
            while opened[name]:  # what stands within it ends with it
                top = stack.pop().name
                opened[top] -= 1
                if top == name:
                    break
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = close.end() if close else size
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th") and stack[-1].name == name:
            opened[stack.pop().name] -= 1  # these end where the next one begins
        zones += 1
        opened[name] += 1
        stack.append(_entered(stack[-1], name, attributes, zones))
    end()
    return found


def _entered(outer: _Open, name: str, attributes: str, number: int) -> _Open:
    """What holds within a block element."""
    mark = _mark(name, attributes, outer.article)
    if mark in ("away", "comments", "element"):
        return _Open(name, IN_AWAY, number, False, False, "element" if outer.away == "element" else mark)
    if mark == "article":
        if not outer.away:
            return _Open(name, IN_ARTICLE, number, True, False, "")
        if outer.away == "away" and name in ("article", "main"):  # a wrapper's name may mean another part of it
            return _Open(name, IN_ARTICLE, number, False, True, "")
    if mark == "weak":
        return _Open(name, outer.prior + IN_WEAK, outer.zone, outer.article, outer.lifted, outer.away)
    return _Open(name, outer.prior, outer.zone, outer.article, outer.lifted, outer.away)


def _mark(name: str, attributes: str, inside: bool) -> str:
    """What an element and its names say: element, away, comments, weak, article, or nothing."""
    if name in BOILER or name in SILENT or (name == "header" and not inside):
        return "element"
    own = [(a.lower(), x or y or z) for a, x, y, z in NAMES.findall(attributes)] if attributes else []
    hides = lambda a, v: a == "hidden" or a == "aria-hidden" and v.lower() == "true" or a == "style" and re.search(r"display\s*:\s*none", v, re.I)
    if any(hides(a, v) for a, v in own) or re.search(r"\shidden(?:\s|$)", attributes):
        return "element"
    if name in ("html", "body") or name in HEADINGS:
        return ""
    marks = {_said(x) for a, v in own if a in ("class", "id", "role") for x in v.split()}
    if name in ("article", "main"):
        return "comments" if "comments" in marks else "article"
    return next((x for x in ("comments", "away", "article", "weak") if x in marks), "")


def _said(name: str) -> str:
    """What one class, id or role says."""
    parts = [x.lower() for x in re.split(r"[-_:]+|(?<=[a-z])(?=[A-Z])", name) if x]
    if not parts or NOT_A_MARK.intersection(parts):
        return ""
    rest = [x for x in parts if not x.isdigit()]
    for kind, words in (("comments", COMMENTS), ("away", AWAY), ("weak", WEAK), ("article", ARTICLE)):
        # the name's head, or its first word where the others only say what form it has
        if rest and (rest[-1] in words and all(x in FORM_WORDS or x in words for x in rest[:-1]) or rest[0] in words and all(x in FORM_WORDS for x in rest[1:])):
            return kind
    return ""


def text_evidence(block: Block) -> float:
    """What length, stop words and links say about a block."""
    words = WORD.findall(block.text.lower())
    n = max(len(words), len(block.text) // 8)  # scripts without spaces have few words
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    length = 1.5 if n >= LONG else 0.75 if n >= MEDIUM else 0.0
    density = 1.5 if stops >= STOPS[2] else 0.75 if stops >= STOPS[1] else -0.75 if stops < STOPS[0] and n >= MEDIUM else 0.0
    if n < MEDIUM // 2:
        density = 0.0  # a word or two tell nothing
    owned = -LINKED if n < LONG and re.match(r"(?:©|\(c\)|copyright\b)", block.text, re.I) else 0.0
    return length + density - LINKED * min(1.0, block.linked / len(block.text)) + owned


def first_pass(blocks: list[Block]) -> tuple[list[float], list[bool | None]]:
    """The evidence of each block, and whether it is text where that is told from itself and its elements."""
    has_article = any(b.article for b in blocks)
    evidence = []
    for b in blocks:
        prior = b.prior
        if b.lifted and has_article:
            prior = IN_AWAY
        elif has_article and not b.article and prior > IN_AWAY / 2:
            prior += OUTSIDE
        evidence.append(prior + text_evidence(b))
    return evidence, [True if e >= GOOD else False if e <= BAD else None for e in evidence]


def _nearest(labels: list[bool | None], heading: bool, i: int, places: list[int]) -> bool | None:
    """The label of the decided block nearest to place i."""
    k = bisect(places, i)
    before, after = (places[k - 1] if k else None), (places[k] if k < len(places) else None)
    if before is None or after is None:
        one = after if before is None else before
        return None if one is None else labels[one]
    near = before if i - before < after - i or (i - before == after - i and not heading) else after
    if heading and not labels[near] and labels[after]:
        near = after  # a heading goes with what it heads
    return labels[near]


def second_pass(blocks: list[Block], evidence: list[float], labels: list[bool | None]) -> list[bool]:
    """Undecided blocks inherit from the nearest decided ones."""
    everywhere = [i for i, x in enumerate(labels) if x is not None]
    by_zone: dict[int, list[int]] = {}
    for i in everywhere:
        by_zone.setdefault(blocks[i].zone, []).append(i)
    any_text = any(labels[i] for i in everywhere)
    out = []
    for i, (b, label) in enumerate(zip(blocks, labels, strict=True)):
        if label is None:
            label = _nearest(labels, b.heading, i, by_zone.get(b.zone, []))
        if label is None and not b.zone and any_text:
            label = _nearest(labels, b.heading, i, everywhere)
        out.append(evidence[i] >= 0 if label is None else label)
    return out


def main_text(html: str | None) -> str:
    blocks = blocks_of(html or "")
    keep = second_pass(blocks, *first_pass(blocks))
    return " ".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row."""

    def extract(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(it):
            text = pa.array([main_text(h) for h in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), text], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string").alias("url"), "html").mapInArrow(extract, f"page_id {kind}, url string, text string")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
