"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block-level tags. In the first pass a block is judged
by where it stands (menus, footers, asides, forms, adverts, comments and the like are
never main text; with an article element on the page, neither is anything outside it)
and by link density, length and stop-word density; on a page that no list of stop words
fits, by link density and length alone. Blocks that are too short to tell stay
ambiguous; in the second pass they inherit the label of the nearest decided neighbours,
and inside an article count as main text unless both disagree. Of linked blocks inside
an article only lists of links, two or more wholly linked blocks in a row that aren't
paragraphs, are furniture. A link holds the blocks within it. Articles named as cards are
main text only of a page that has no other. Where nothing on a page is main text, its
ambiguous blocks are.

Text is decoded, white space within a block becomes one space, blocks are joined by one
space in page order. Null, empty and text-less pages give an empty text. Markup that
isn't closed ends with the page or its container. Ids may be null or repeated: there is
one row per input row. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 64

#: Comments, raw-text elements with their content, tags, other declarations.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|object|title|textarea|select|button|canvas)\b"
    r"(?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9-]*)([^<>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
# Tags that bound blocks, containers that are never main text, and names that say so.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot"
    " th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold the page or its main text, whatever their names say.
WHOLE = frozenset("html body main article".split())
#: Tags whose end may be left out: the next one of the same name ends them.
OPEN_ENDED = frozenset("p li dt dd tr td th option".split())
NEVER = frozenset("nav footer aside form menu dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|sponsor(?:ed)?|promo(?:tion)?s?|sidebar|menu|nav(?:bar|igation)?"
    r"|breadcrumbs?|footer|masthead|topbar|comments?|reply|replies|respond|discussion|disqus|cookies?|consent|gdpr|notice|notices|alert|popup"
    r"|modal|overlay|newsletter|subscri(?:be|ption)|signup|login|social|share|sharing|related|recommend(?:ed|ations?)?|teasers?"
    r"|widgets?|pagination|pager|toolbar|skip|legal|disclaimer|copyright|hidden)(?:$|[\s_-])",
    re.I,
)
#: Of those names, some that an article's own parts may bear, and words that go with them where they mean furniture.
TOPICS = frozenset("share sharing social discussion menu alert skip reply respond legal".split())
FITTINGS = frozenset(
    "area bar block box button buttons container content form group icon icons inner item items links list main media"
    " article entry page panel post section site text this title tools top wrap wrapper".split()
)
CARD_NAME = re.compile(r"(?:^|[\s_-])(?:cards?|teasers?|tiles?|previews?)(?:$|[\s_-])", re.I)
#: Tags whose start ends an open paragraph.
ENDS_P = BLOCKS - frozenset("body br caption dd dt html li option tbody td tfoot th thead tr".split())
#: The next start or end of a link, and what is left of a tag at the end of a page.
LINK_TAG, CUT_TAG = re.compile(r"<(/?)a(?=[\s>/])", re.I), re.compile(r"<(?:/?[a-zA-Z]|[!?])")
BAD_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
MAIN_NAME = re.compile(r"(?:^|\s)(?:article-?body|entry-?content|post-?content|main-?content|article-?content)(?:$|\s)", re.I)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
STOP_WORDS = frozenset(
    "the of and to in a is that it for on was with as by at be this are from or an have not but they which you one had"
    " der die das und ist von zu den mit des im auf für nicht ein eine als auch dem sich es er sie werden aus bei wird"
    " le la les de des et est un une que qui dans en du pour pas au sur par plus ce ne se sont avec il elle ou son"
    " el los las del y que en un una es por con para se no al lo su como más o pero sus fue ha si sobre este".split()
)
#: Characters: a block below SHORT says little, one from LONG on needs few stop words.
SHORT, LONG = 70, 200
LINKED, STOPS_LOW, STOPS_HIGH = 0.33, 0.15, 0.3
#: Letters a word has at most, on average, in a text of words.
LETTERS = 30
#: A page with a smaller share of stop words outside links is in a language without a list.
STOPS_FIT = 0.2
#: Letters of scripts that write a word with one or two of them, and how many of others they count as.
WIDE, WIDTH = re.compile(r"[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\U00020000-\U0003ffff]"), 3
GOOD, BAD, UNSURE = "good", "bad", "unsure"


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    place: str  # "main", "card", "plain", or "never"
    heading: bool
    paragraph: bool = False


class _Open(NamedTuple):
    tag: str
    place: str


def _furniture(names: str, inside: bool) -> bool:
    """Whether class names or an id say that an element isn't main text; ``inside`` an article a topic alone doesn't."""
    if not BAD_NAME.search(names):
        return False
    for name in names.lower().split() if inside else ():
        parts = [x for x in re.split("[_-]+", name) if x]
        bad = [x for x in parts if BAD_NAME.fullmatch(x)]
        if any(x not in TOPICS for x in bad) or bad and bad != ["legal"] and all(x in FITTINGS or x in bad for x in parts):
            return True
    return not inside


def _place(tag: str, attributes: str, above: str) -> str:
    """Where the content of an element stands, given where the element does."""
    if above == "never" or tag in NEVER:
        return "never"
    if attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            value, name = "".join(values), name.lower()
            if name in ("class", "id") and tag not in WHOLE and _furniture(value, above in ("main", "heading")):
                return "never"
            if name in ("class", "id") and tag == "article" and CARD_NAME.search(value):
                return "card"
            if name == "role" and value.lower() in BAD_ROLE or name == "hidden" or name == "aria-hidden" and value == "true":
                return "never"
            if name in ("class", "id", "itemprop") and MAIN_NAME.search(value) or name == "role" and value == "main":
                above = "main"
    if tag in ("article", "main"):
        return "card" if above == "card" else "main"
    if tag == "header":
        return "heading" if above == "main" else "never"
    return above


def blocks(html: str) -> list[Block]:
    """The blocks of a page that hold text, in order."""
    out: list[Block] = []
    stack: list[_Open] = []
    parts: list[str] = []
    # "depth": how many elements were open where the link starts; "short": its end tag is missing
    state = {"linked": 0, "link": 0, "heading": False, "depth": 0, "short": False}

    def close() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            place = stack[-1].place if stack else "plain"
            heading = state["heading"]
            if place == "heading":  # a header inside an article holds its title, and other things
                place = "main" if heading else "never"
            out.append(Block(text, state["linked"], place, heading, bool(stack) and stack[-1].tag == "p"))
        parts.clear()
        state["linked"] = 0

    def add(text: str) -> None:
        if text:
            parts.append(text)
            if state["link"]:
                state["linked"] += len(text)

    at = 0
    for m in MARKUP.finditer(html):
        add(html[at : m.start()])
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            if m[1] and m[1].lower() in ("button", "select", "textarea"):
                close()
            continue
        ends, attributes = m[2] or m[5], m[4] if m[3] else m[7]
        if tag in BLOCKS:
            close()
            if state["short"] and not ends:
                state["link"] = 0
            if not ends and tag in ENDS_P and stack and stack[-1].tag == "p":
                stack.pop()
        if tag == "a":
            follows = None if ends else LINK_TAG.search(html, at)
            state |= {"link": 0 if ends else 1, "depth": len(stack), "short": not (follows and follows[1])}
        if tag in HEADINGS:
            state["heading"] = not ends
        if ends:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)
            if depth is not None:
                del stack[depth:]
                if depth < state["depth"]:
                    state["link"] = 0
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in OPEN_ENDED and stack and stack[-1].tag == tag:
                stack.pop()
            if len(stack) < state["depth"]:
                state["link"] = 0
            place = _place(tag, attributes, stack[-1].place if stack else "plain")
            if tag in BLOCKS or place == "never":
                if place == "never" and tag not in BLOCKS:
                    close()
                stack.append(_Open(tag, place))
    add(html[at:] if not CUT_TAG.match(html, at) else "")
    close()
    return out


def _stops(text: str) -> tuple[int, int]:
    """How many words are stop words, and how many there are."""
    words = text.lower().split()
    return sum(w.strip(".,;:!?*#%$&") in STOP_WORDS for w in words), len(words)


def _linked(block: Block) -> bool:
    return block.linked > LINKED * len(block.text)


def listed(page: list[Block]) -> bool:
    """Whether the stop words fit the language of a page."""
    found = [_stops(b.text) for b in page if b.place != "never" and not _linked(b)]
    return sum(s for s, _ in found) >= STOPS_FIT * sum(n for _, n in found)


def first_pass(block: Block, fits: bool = True) -> str:
    """A block's label by itself; ``fits``: whether the stop words fit its page."""
    if block.place == "never":
        return BAD
    if _linked(block):
        return UNSURE if block.place == "main" else BAD
    n, wide = len(block.text), 0 if fits else len(WIDE.findall(block.text))
    if n + (WIDTH - 1) * wide < SHORT or block.heading:
        return UNSURE
    found, words = _stops(block.text)
    if not fits and (n <= LETTERS * words or 2 * wide >= n):
        return GOOD
    stops = found / max(1, words)
    if stops >= STOPS_HIGH or n >= LONG and stops >= STOPS_LOW:
        return GOOD
    if block.place == "main":
        return GOOD if n >= LONG else UNSURE
    return UNSURE if stops >= STOPS_LOW else BAD


def labels(page: list[Block]) -> list[str]:
    """Final labels of the blocks of a page."""
    if any(b.place == "main" for b in page):
        page = [b if b.place == "main" else b._replace(place="never") for b in page]
    elif any(b.place == "card" for b in page):
        apart = [b._replace(place="never") if b.place == "card" else b for b in page]
        fits = listed(apart)
        if any(first_pass(b, fits) == GOOD for b in apart):
            page = apart
        else:
            return labels([b._replace(place="main") if b.place == "card" else b for b in page])
    fits = listed(page)
    first = [first_pass(b, fits) for b in page]
    lists = [b.place == "main" and not b.heading and not b.paragraph and b.linked >= len(b.text) for b in page]
    for i in range(1, len(page)):
        if lists[i - 1] and lists[i]:
            first[i - 1] = first[i] = BAD
    decided = [i for i, x in enumerate(first) if x != UNSURE]
    final, k = [], 0  # k: how many decided blocks stand before i
    for i, own in enumerate(first):
        if own != UNSURE:
            final.append(own)
            k += 1
            continue
        before = decided[k - 1] if k else None
        after = decided[k] if k < len(decided) else None
        if page[i].place == "main":
            # Furniture around the article says nothing about a short block inside it.
            inside = [j for j in (before, after) if j is not None and page[j].place == "main"]
            final.append(BAD if len(inside) == 2 and all(first[j] == BAD for j in inside) else GOOD)
            continue
        near = [(abs(i - j), first[j]) for j in (before, after) if j is not None]
        if page[i].heading and after is not None:
            near = [(0, first[after])]  # a heading belongs to what follows
        final.append(min(near)[1] if near else BAD)
    if GOOD not in final:
        return [GOOD if x == UNSURE else BAD for x in first]
    return final


def main_text(html: str | None) -> str:
    """The main text of a page."""
    page = blocks(html or "")
    return " ".join(b.text for b, label in zip(page, labels(page)) if label == GOOD)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                own = batch.slice(i, SLICE)
                found = [main_text(h) for h in own.column("html").to_pylist()]
                columns = [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
                yield pa.record_batch([own.column("page_id"), own.column("url"), *columns], names)

    names = ["page_id", "url", "text", "n_chars"]
    id_type = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(texts, f"page_id {id_type}, url string, text string, n_chars bigint")
