"""Main text of web pages by two passes of block rules.

A tolerant scanner turns the markup into blocks: text between block-level tags,
with how much of it is links and which structural elements are around it. Words in
class, id and role, and forms, frame an element only as far as its text agrees: one
that holds most of the page's long blocks is no frame, nor is one inside the
article that is mostly long blocks, nor a long paragraph; comments and adverts are
frames unless the page has hardly anything else. The document, its body and
headings are never framed by such words. The
first pass classifies each block by itself: blocks inside menus, headers, footers,
sidebars, forms, notices, adverts and comments, and blocks made of links, are
boilerplate; blocks with enough words and stop words are text; short blocks stay
open. The second pass gives an open block the label of its nearest decided
neighbours: both agree, or the nearer one decides, and on a tie text wins. What is
in a menu, footer or advert has no say in that. An open block without any decided
neighbour is text. Where the page marks its
article, only blocks inside the mark can be text, and there an open block needs
no neighbour; a mark inside a frame, or without text while there is text
outside, is none.

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined in page order by a line feed. Nothing else is
dropped or shortened. A null or empty page, and one without text, gives an empty
string. Rows are independent: repeated rows and repeated or null ids give
repeated results, an empty table an empty result; other columns do not matter.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmatch.llm.common import pick, pieces

# Element names by what they do to the text.
HIDDEN = frozenset("script style noscript template svg math iframe object embed canvas audio video map head title "
                   "textarea select option datalist button".split())
RAW = frozenset("script style textarea title iframe noscript".split())
FRAME = frozenset("nav header footer aside menu dialog".split())
SOFT_FRAME = frozenset("form fieldset".split())  # these also stand around whole pages
NEVER_NAMED = frozenset("html body h1 h2 h3 h4 h5 h6".split())  # words in class, id and role say nothing about these
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
                  "section summary table tbody td tfoot th thead tr ul caption br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id and role that mark what is around the article.
FRAME_WORDS = frozenset("""ad ads advert adverts advertisement advertising advertorial banner sponsor sponsored promo
    promotion nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer foot colophon
    sidebar side aside widget widgets related recommended recommendations trending popular share sharing social
    follow newsletter subscribe subscription signup login signin form search cookie cookies consent gdpr notice
    notices alert popup modal overlay comment comments disqus replies reply respond discussion pagination pager
    toolbar tags tagcloud copyright legal disclaimer complementary contentinfo skip""".split())
# Of these, what can be long text and still not the article's.
FIRM_WORDS = frozenset("""ad ads advert adverts advertisement advertorial sponsor sponsored promo promotion comment comments
    disqus replies reply respond discussion""".split())
# A name with one of these is about the state or the topic of what it names: has-sidebar, comments-open.
STATE_WORDS = frozenset("has no not with without enabled disabled open closed on off".split())
# These too, but not beside a word for adverts: ad-type-banner.
TOPIC_WORDS = frozenset("category tag type format".split())
AD_WORDS = frozenset("ad ads advert adverts advertisement advertorial sponsor sponsored promo promotion".split())
# Frequent function words of the languages the rules know.
STOP_WORDS = frozenset("""a an and are as at be been but by for from had has have he her his i if in into is it its
    me my no not of on or our she so that the their them then there these they this to was we were what when which
    who will with would you your
    au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais mes ne nos notre
    nous ou par pas pour qu que qui sa sans se ses son sont sur un une vos vous y
    aber als am auch auf aus bei bin bis da das dass dem den der des die dies diese doch du durch ein eine einem
    einen einer eines er es für haben hat ich ihr im ist kann mit nach nicht noch nur oder sich sie sind so um und
    uns unter vom von vor war was wie wir wird zu zum zur über
    al como con del el ella ellos era esta este esto fue ha hay las lo los más muy nada o para pero por se si sin
    sobre su sus también te tiene todo tu una uno ya
    che con da dei del della di e gli il in la le lo nel non per più se si sono un una
    dat een en het ik in is met niet op te van voor zijn
    ao com da das do dos e em na no nas nos o os ou para por que se sem um uma""".split())

LINK_DENSITY = 0.5     # share of a block's letters inside links, from which it is boilerplate
LONG_WORDS = 12        # words from which a block can be text by itself
STOP_DENSITY = 0.15    # stop words per word that a long block needs for it
VERY_LONG_WORDS = 40   # words from which it is text whatever its stop words

_TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*))")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
# Quotes hold a value only right after the sign; elsewhere they are characters like others.
_TAG_REST = re.compile(r"(?>[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+>")
_WORDS = re.compile(r"[^\W_]+").findall
_NAME_WORDS = re.compile(r"[a-z]+").findall
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    linked: int     # letters of it inside links
    framed: bool    # inside a menu, footer, advert, ...
    article: bool   # inside the mark of the article
    frame: int = -1  # the innermost frame around it that its text can outvote


# What frames an element: nothing, its name or being hidden, or words that text can outvote.
FREE, HARD, SOFT, FIRM, PARAGRAPH = range(5)


@dataclass
class Frame:
    """An element that may be a frame, by its words."""

    outer: int      # the next one around it
    kind: int
    inside: bool    # inside the mark of the article
    dense: int = 0  # words in long blocks
    words: int = 0


def _frames(name: str, rest: str, inside: bool = False) -> int:
    """What the element frames; inside the article's mark a header is the article's own."""
    if name in FRAME:
        return HARD
    kind = SOFT if name in SOFT_FRAME else FREE
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id", "role") and name not in NEVER_NAMED:
            for token in value.split():
                words = set(_NAME_WORDS(token))
                if inside:
                    words.discard("header")
                about = STATE_WORDS if words & AD_WORDS else STATE_WORDS | TOPIC_WORDS
                if about.isdisjoint(words) and not FRAME_WORDS.isdisjoint(words):
                    kind = max(kind, SOFT if FIRM_WORDS.isdisjoint(words) else FIRM)
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            return HARD
    return PARAGRAPH if kind and name == "p" else kind


def blocks_of(page: str) -> list[Block]:
    """The blocks in page order; blank ones are left out."""
    found: list[Block] = []
    frames_met: list[Frame] = []
    frame = -1
    parts: list[str] = []
    linked = 0
    # Open elements: name, whether it frames, whether it marks the article, whether it hides, the frame around it.
    stack: list[tuple[str, bool, bool, bool, int]] = []
    opened: Counter[str] = Counter()  # how many of each name the stack has
    framed = article = hidden = links = 0

    def close_block() -> None:
        nonlocal parts, linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                found.append(Block(text, linked, framed > 0, article > 0, frame))
        parts, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not hidden:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked += sum(map(len, text.split()))

    def drop(depth: int) -> None:
        """Close the elements from this depth on."""
        nonlocal framed, article, hidden, links, frame
        if depth < len(stack):
            frame = stack[depth][4]
        for name, frames, marks, hides, _ in stack[depth:]:
            framed -= frames
            article -= marks
            hidden -= hides
            links -= name == "a"
            opened[name] -= 1
        del stack[depth:]

    at, end = 0, len(page)
    while at < end:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        add(page[at:tag.start()])
        comment, declaration, closing, name = tag.groups()
        if comment:
            empty = 1 if page.startswith(">", tag.end()) else 2 if page.startswith("->", tag.end()) else 0
            close = page.find("-->", tag.end())
            at = tag.end() + empty if empty else end if close < 0 else close + 3
            continue
        rest = _TAG_REST.match(page, tag.end())
        if rest is None:  # a tag that never ends: up to the next bracket, or the end
            close = page.find(">", tag.end())
            stop = end if close < 0 else close + 1
        else:
            stop = rest.end()
        attributes = page[tag.end():stop]
        at = stop
        if declaration:
            continue
        name = name.lower()
        if name in BLOCK:
            close_block()
        if closing:
            if opened[name]:
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    depth -= 1
                drop(depth)
            continue
        if name in VOID or attributes.endswith("/>"):
            continue
        if name in RAW:  # nothing inside is markup
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end if close is None else close.start()
        if name in ("p", "li", "td", "tr", "th", "dt", "dd", "option", "a"):  # these end an open one before them
            same = {"td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(name, (name,))
            for depth in range(len(stack) - 1, -1, -1) if any(opened[other] for other in same) else ():
                if stack[depth][0] in same:
                    drop(depth)
                    break
                if stack[depth][0] in BLOCK:
                    break
        marks = name in ("article", "main") or 'itemprop="articlebody"' in attributes.lower()
        kind = _frames(name, attributes, article > 0)
        # Inside the article a header element is the article's own heading, and all paragraphs are its text.
        frames = kind == HARD and not marks and not (article > 0 and name == "header")
        hides = name in HIDDEN
        stack.append((name, frames, marks, hides, frame))
        if kind in (SOFT, FIRM) or (kind == PARAGRAPH and not article):
            frames_met.append(Frame(frame, kind, article > 0))
            frame = len(frames_met) - 1
        opened[name] += 1
        framed += frames
        article += marks
        hidden += hides
        links += name == "a"
    close_block()
    _outvote(found, frames_met)
    return found


TEXT, OPEN, BOILERPLATE = 1, 0, -1


def _outvote(blocks: list[Block], frames: list[Frame]) -> None:
    """Settle which of the frames are some, and with them which blocks are framed."""
    if not frames:
        return
    dense = free = 0  # words in long blocks, words outside all frames
    for block in blocks:
        if not block.framed:
            words = len(_WORDS(block.text))
            long = words if classify(block) == TEXT else 0
            dense += long
            if block.frame < 0:
                free += words
            else:
                frames[block.frame].dense += long
                frames[block.frame].words += words
    for frame in reversed(frames):  # what is around comes first
        if frame.outer >= 0:
            frames[frame.outer].dense += frame.dense
            frames[frame.outer].words += frame.words
    around: list[bool] = []
    firm: list[bool] = []
    for frame in frames:
        if frame.kind == FIRM:
            holds = frame.dense == dense and frame.dense > 2 * free
        elif frame.kind == PARAGRAPH or (frame.inside and 2 * frame.dense >= frame.words):
            holds = frame.dense > 0
        else:
            holds = 2 * frame.dense > dense and (frame.dense >= VERY_LONG_WORDS or not free)
        around.append(not (holds and dense) or (frame.outer >= 0 and around[frame.outer]))
        firm.append(frame.kind == FIRM or (frame.outer >= 0 and firm[frame.outer]))
    if dense and not free and all(block.framed or around[block.frame] for block in blocks):
        # Everything is in frames that each hold too little: the one with most of the text is none.
        most = max(range(len(frames)), key=lambda i: (frames[i].kind != FIRM, frames[i].dense, -i))
        while most >= 0:
            around[most] = False
            most = frames[most].outer
        for i, frame in enumerate(frames):
            if frame.outer >= 0 and around[i]:
                around[i] = frame.kind == FIRM or 2 * frame.dense < frame.words or around[frame.outer]
    for block in blocks:
        if block.frame >= 0:
            block.framed = block.framed or around[block.frame]
            block.article = block.article and not firm[block.frame]


def classify(block: Block) -> int:
    """The first pass: a block by itself."""
    if block.framed:
        return BOILERPLATE
    letters = sum(map(len, block.text.split()))
    if block.linked >= LINK_DENSITY * letters:
        return BOILERPLATE if block.linked else OPEN
    words = _WORDS(block.text.lower())
    if len(words) >= VERY_LONG_WORDS:
        return TEXT
    if len(words) >= LONG_WORDS and sum(w in STOP_WORDS for w in words) >= STOP_DENSITY * len(words):
        return TEXT
    return OPEN


def settle(labels: list[int]) -> list[int]:
    """The second pass: open blocks take the label of the nearest decided neighbours."""
    n = len(labels)
    before, after = [None] * n, [None] * n
    last = None
    for i in range(n):
        if labels[i] != OPEN:
            last = i
        before[i] = last
    last = None
    for i in range(n - 1, -1, -1):
        if labels[i] != OPEN:
            last = i
        after[i] = last
    settled = []
    for i, label in enumerate(labels):
        if label == OPEN:
            left, right = before[i], after[i]
            if left is None or right is None:
                near = left if right is None else right
                label = TEXT if near is None else labels[near]
            elif i - left == right - i:
                label = max(labels[left], labels[right])
            else:
                label = labels[left if i - left < right - i else right]
        settled.append(label)
    return settled


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = [block for block in blocks_of(page) if not block.framed]
    labels = [classify(block) for block in blocks]
    marked = any(block.article for block in blocks)
    if marked:
        marked = TEXT not in labels or any(block.article and label == TEXT for block, label in zip(blocks, labels))
    if marked:
        labels = [label for block, label in zip(blocks, labels) if block.article]
        blocks = [block for block in blocks if block.article]
    if marked:
        labels = [TEXT if label == OPEN else label for label in labels]
    return "\n".join(block.text for block, label in zip(blocks, settle(labels)) if label == TEXT)


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every row."""
    def run(batches):
        for batch in pieces(batches, "html"):
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    rows = pick(df, {"page_id": id_col, "url": url_col, "html": html_col})
    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, "
                                f"url {rows.schema['url'].dataType.simpleString()}, text string")


def page_digest(df: DataFrame) -> DataFrame:
    """The contract's row per page."""
    return extract_text(df).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
