"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# Frequent function words of the languages served.
STOP_WORDS = frozenset("""
a about after all also an and any are as at be because been but by can could did do for from had has
have he her his how i if in into is it its me more my no not of on one or our out she so some such than
that the their them then there these they this to up was we were what when which who will with would you your
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais mes mon ne
nous on ou par pas plus pour qu que qui sa sans se ses son sont sur un une vos vous été être
al como con cuando de del desde donde el ella en entre era es esta este esto fue ha hay la las lo los me mi
muy más no nos o para pero por porque que qué se sin sobre son su sus también un una uno y ya
aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer es für
hat ich ihr im in ist kann mit nach nicht noch nur oder sein sich sie sind so und uns vom von vor war was wie
wird zu zum zur über
""".split())

# Elements whose content is never text, and those whose blocks are never part of an article.
SILENT = frozenset("script style noscript template svg math head title iframe object canvas select textarea button".split())
ASIDE = frozenset("nav aside footer form menu dialog fieldset".split())
ARTICLE = frozenset(["article", "main"])
BLOCK = frozenset("""
address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section
summary table tbody td tfoot th thead tr ul br
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id or role that name what is not the article.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adbox|banner|sponsor(?:ed)?|promo(?:tion)?|comments?|disqus|replies|"
    r"sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|cookies?|consent|gdpr|notices?|"
    r"alerts?|popup|modal|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommended|"
    r"widget|toolbar|pagination|pager|tags?|copyright|legal|disclaimer|skip|search|complementary|contentinfo)(?:$|[\s_-])")

# Names of what readers have written; nothing makes it the article.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|replies)(?:$|[\s_-])")

LONG, SHORT = 140, 50
STOP_HIGH, STOP_LOW = 0.22, 0.12
MOST_LINKS = 0.33

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
# Classes that say what stands beside or about an element, not what it is.
_ABOUT = ("has-", "no-", "with-", "without-", "tag-", "not-")
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|$)|'([^']*)(?:'|$)|([^\s>\"']+)))?")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_CLOSE = {name: re.compile(rf"</{name}\b[^>]*(?:>|$)", re.I) for name in ("script", "style")}
_WORD = re.compile(r"\w+")
_SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    text: str
    # Characters and number of its links.
    linked: int
    links: int
    heading: bool
    article: bool
    aside: bool
    # Items of lists, and cells of tables.
    item: bool
    cell: bool


class Inside(NamedTuple):
    name: str
    silent: bool
    aside: bool
    article: bool
    link: bool
    heading: bool
    # Places of the elements around whose class, id or role names what is not the article.
    named: tuple[int, ...]
    item: bool = False
    cell: bool = False


_OUTSIDE = Inside("", False, False, False, False, False, ())


def _attributes(text: str) -> tuple[bool, bool, bool]:
    """Whether attributes hide an element, whether they name what is not the article, and comments."""
    hidden = named = comments = False
    for match in _ATTRIBUTE.finditer(text):
        name, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value.strip() == "true") or (
                name == "style" and _NONE.search(value)):
            hidden = True
        elif name in ("class", "id", "role"):
            tokens = [token for token in value.split() if not token.startswith(_ABOUT)]
            named = named or any(map(NAMED.search, tokens))
            comments = comments or any(map(COMMENTS.search, tokens))
    return hidden, named, comments


def _cleared(blocks: list[Block], around: list[tuple[int, ...]], articles: list[tuple[int, ...]]) -> set[int]:
    """The named elements whose names don't count, since they hold the article: those around the articles
    with the fewest of them, or in pages that mark none, those with most of the text."""
    if articles:
        fewest = min(map(len, articles))
        return {place for chain in articles if len(chain) == fewest for place in chain}
    sizes: Counter[int] = Counter()
    for block, chain in zip(blocks, around):
        if not block.aside:
            sizes.update(dict.fromkeys(chain, len(block.text)))
    total = sum(len(block.text) for block in blocks if not block.aside)
    return {place for place, size in sizes.items() if 2 * size > total}


def blocks_of(html: str) -> list[Block]:
    """Blocks of a page in order: the texts between block elements, references decoded, white space
    made one space, without empty ones."""
    found: list[Block] = []
    around: list[tuple[int, ...]] = []
    articles: list[tuple[int, ...]] = []
    places = 0
    parts: list[tuple[str, bool]] = []
    # Open elements with what holds inside them.
    open_: list[Inside] = []
    count: Counter[str] = Counter()

    def inside() -> Inside:
        return open_[-1] if open_ else _OUTSIDE

    def close_block() -> None:
        if parts:
            text = _SPACE.sub(" ", "".join(t for t, _ in parts)).strip()
            if text:
                linked = [len(_SPACE.sub(" ", t).strip()) for t, link in parts if link]
                here = inside()
                found.append(Block(text, sum(linked), sum(map(bool, linked)), here.heading, here.article, here.aside,
                                   here.item, here.cell))
                around.append(here.named)
            parts.clear()

    def close_from(place: int) -> None:
        for element in open_[place:]:
            count[element.name] -= 1
        del open_[place:]

    at, end = 0, len(html)
    while at < end:
        token = _TOKEN.search(html, at)
        stop = token.start() if token else end
        if stop > at and not inside().silent:
            parts.append((unescape(html[at:stop]), inside().link))
        if not token:
            break
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        if name in BLOCK and not inside().silent:
            close_block()
        if token[1]:
            if count[name]:
                close_from(max(i for i, e in enumerate(open_) if e.name == name))
            continue
        if name in ("p", "li", "dd", "dt", "option", "tr", "td", "th") and count[name]:
            place = _ended_by(open_, name)
            if place is not None:
                close_from(place)
        attributes = token[3]
        if name in VOID or attributes.endswith("/"):
            continue
        if name in ("script", "style"):
            closing = _CLOSE[name].search(html, at)
            at = closing.end() if closing else end
            continue
        here = inside()
        hidden, names, comments = _attributes(attributes) if attributes else (False, False, False)
        comments = comments and name not in ("html", "body")
        aside = name in ASIDE or (name == "header" and not here.article) or comments
        named = (*here.named, places) if names and name not in ("html", "body", "main") else here.named
        if named is not here.named:
            places += 1
        silent = here.silent or name in SILENT or hidden
        if name in ARTICLE and not silent and not here.aside and not aside:
            articles.append(named)
        open_.append(Inside(name, silent, here.aside or aside, here.article or name in ARTICLE,
                            here.link or name == "a", here.heading or name in HEADING, named,
                            here.item or name == "li", here.cell or name in ("td", "th")))
        count[name] += 1
    close_block()
    cleared = _cleared(found, around, articles)
    return [block._replace(aside=block.aside or not cleared.issuperset(chain)) if chain else block
            for block, chain in zip(found, around)]


def _ended_by(open_: list[Inside], name: str) -> int | None:
    """The paragraph or item that was never closed and ends where the next one begins."""
    fence = {"p": BLOCK - {"p"}, "li": {"ul", "ol", "menu"}}.get(name, {"table", "dl", "select", "tr"} - {name})
    for i in range(len(open_) - 1, -1, -1):
        if open_[i].name == name:
            return i
        if open_[i].name in fence:
            return None
    return None


def first_pass(block: Block) -> str:
    """``good``, ``bad``, ``near`` (likely good) or ``short``, by link density, length and density of stop words.
    The mark of an article is one more sign: it raises what the words say by one step."""
    length = len(block.text)
    if block.aside:
        return "bad"
    if block.linked > MOST_LINKS * length and not block.heading:
        # Inside of an article only lists of links are none of it, not a sentence with a long link.
        return "bad" if not block.article or block.item or block.links > 1 else "near"
    if "©" in block.text[:80] and length < LONG:
        return "short"
    if length < SHORT:
        return "bad" if block.linked and not block.article else "short"
    words = _WORD.findall(block.text.lower())
    stops = sum(word in STOP_WORDS for word in words) / max(1, len(words))
    if stops >= STOP_HIGH:
        return "good" if block.article or length > LONG else "near"
    if stops >= STOP_LOW:
        return "good" if block.article else "near"
    return "near" if block.article else "short" if block.cell else "bad"


def classify(blocks: list[Block]) -> list[bool]:
    """Whether each block is main text. Blocks that the first pass leaves open inherit from the
    nearest decided neighbours: both good make it good and both bad bad; between the two, a likely
    good one and a heading before text stay. In pages that mark their article, blocks outside are
    bad, and blocks inside have no bad neighbours outside; likely good ones among them stay."""
    marked = any(b.article and not b.aside for b in blocks)
    kinds = ["bad" if marked and not b.article else first_pass(b) for b in blocks]
    keep = [kind == "good" for kind in kinds]
    decided = [kind in ("good", "bad") for kind in kinds]
    before, after = _nearest(blocks, decided, keep), _nearest(blocks[::-1], decided[::-1], keep[::-1])[::-1]
    for i, kind in enumerate(kinds):
        if decided[i]:
            continue
        sides = [side for side in (before[i], after[i]) if side is not None]
        if blocks[i].article:
            keep[i] = kind == "near" or not sides or any(sides)
        elif not sides:
            keep[i] = kind == "near"
        elif all(sides):
            keep[i] = len(sides) == 2 or kind == "near" or blocks[i].heading
        elif any(sides):
            keep[i] = kind == "near" or (blocks[i].heading and after[i] is True)
    return keep


def _nearest(blocks: list[Block], decided: list[bool], keep: list[bool]) -> list[bool | None]:
    """For each block, whether the last decided one before it on its side of the article's border is
    kept. Blocks that are out for the element they stand in say nothing about others."""
    last: dict[bool, bool | None] = {True: None, False: None}
    out = []
    for block, known, kept in zip(blocks, decided, keep):
        out.append(last[block.article])
        if known and not block.aside:
            last[block.article] = kept
    return out


def main_text(html: str | None) -> str:
    blocks = blocks_of(html or "")
    return " ".join(b.text for b, keep in zip(blocks, classify(blocks)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; ``n_chars`` counts code points.

    A null or empty page, and one without main text, has an empty text. Elements left open end with
    the page. Repeated rows give a row each; an empty table gives none; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
