"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags. The first pass decides blocks by
marks of their ancestors (navigation, forms, adverts, comments and the like),
link density, length and the density of stop words; short blocks, and long ones
without stop words, stay open. The second pass gives each open block the label
of its nearest decided neighbours. Where a page has an article container, blocks
outside of it are not part of the text and open blocks inside lean to it.

Defined results: NULL or empty html gives an empty text; a page without any
block that is kept gives an empty text; markup that is never closed ends with
its parent or the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from spanledger.llm.batches import map_batches

SHORT, LONG, LINKS, STOPS_HIGH, STOPS_LOW = 70, 200, 0.33, 0.30, 0.15

# Element names of the HTML standard, by their role.
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|svg|math|iframe|object|canvas|audio|video|select|button"
DROPPED = frozenset("nav aside footer form menu dialog fieldset search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Words in class and id that name a role.
BOILER = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner sidebar side widget widgets "
    "menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments "
    "commentlist respond reply replies disqus discussion pagination pager paging copyright legal disclaimer toolbar tags taglist hidden".split()
)
CONTENT = frozenset("article content main post entry story maincontent articlebody postcontent entrycontent".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

# Frequent words of four languages.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on are as with his they at be this from have or by one had not but what all were when we there "
    "can an your which their said if do will each about how up out them then she many some so these would other into has more her two like "
    "le la les des et en un une du de que qui dans pour pas sur avec est au ce il elle ne se son plus par nous vous mais ou si leur y sont "
    "der die das und den von zu mit sich dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am noch wie "
    "el los las y en del se por con no su para al lo como o pero sus ya este porque esta entre cuando muy sin sobre me hasta hay".split()
)

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_MARK = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_CLOSING = re.compile(r"^\s*(?:©|\(c\)\s|copyright\b)|\ball rights reserved\b", re.I)


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    boiler: bool = False
    content: bool = False
    heading: bool = False
    text: str = ""


def _role(name: str, attrs: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element marks its content as boilerplate, and whether as article."""
    boiler, content = name in DROPPED or (name == "header" and not inside), name in ("article", "main")
    if "=" in attrs or "hidden" in attrs:
        for m in _MARK.finditer(attrs):
            kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if kind in ("class", "id"):
                for group in value.split():
                    words = re.split(r"[-_\d]+", group)
                    boiler |= not BOILER.isdisjoint(words)
                    content |= "".join(words) in CONTENT
            elif kind == "role":
                boiler |= value in ROLES
                content |= value in ("main", "article")
            elif kind == "style":
                boiler |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
            else:
                boiler |= kind == "hidden" and not m[2] or value == "true"
    return boiler, content and not boiler


def blocks(html: str) -> list[Block]:
    """The blocks of a page in its order, each with its text, linked characters and marks."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # element, boilerplate, article: with what its ancestors say
    now = Block()
    breaks = 0

    def close() -> None:
        nonlocal now
        now.text = " ".join("".join(now.parts).split())
        if now.text:
            out.append(now)
        top = stack[-1] if stack else ("", False, False)
        now = Block(boiler=top[1], content=top[2], heading=any(x[0] in HEADINGS for x in stack[-3:]))

    def leave(name: str) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                del stack[k:]
                return
            if name == "p" and stack[k][0] in BREAKS:
                return

    at = 0
    for m in _MARKUP.finditer(html):
        if m.start() > at:
            piece = unescape(html[at : m.start()])
            now.parts.append(piece)
            if any(x[0] == "a" for x in stack):
                now.linked += len(piece.strip())
            breaks = 0 if piece.strip() else breaks
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["end"] or m["end2"]:
            leave(name)
        else:
            if name in BREAKS:
                while stack and stack[-1][0] in ("p", "b", "i", "em", "strong", "span", "a", "u", "font") and any(x[0] == "p" for x in stack):
                    stack.pop()
                if name in ("li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == name:
                    stack.pop()
            if name not in VOID and not (m["attrs"] or m["attrs2"] or "").endswith("/"):
                _, boiler, content = stack[-1] if stack else ("", False, False)
                own = _role(name, m["attrs"] or m["attrs2"] or "", content)
                stack.append((name, boiler or own[0], content or own[1]))
        breaks = breaks + 1 if name == "br" else breaks
        if name in BREAKS or (name == "br" and breaks > 1):
            close()
        elif name == "br":
            now.parts.append(" ")
    if at < len(html):
        now.parts.append(unescape(html[at:]))
    close()
    return out


def _stops(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def _leans(b: Block) -> bool:
    """Whether an open block reads like a sentence: a decided article block on either side is enough then."""
    return not b.linked and _stops(b.text) >= STOPS_LOW


def _first_pass(b: Block, container: bool) -> bool | None:
    """True for text, False for boilerplate, None while it is open."""
    if b.boiler or (container and not b.content):
        return False
    links = b.linked / len(b.text)
    if links > LINKS:
        return False
    stops = _stops(b.text)
    if not container and len(b.text) < LONG and _CLOSING.search(b.text):
        return False
    if len(b.text) < SHORT or b.heading:
        return False if b.linked and not container and not b.heading else None
    if container or stops >= STOPS_HIGH or (len(b.text) >= LONG and stops >= STOPS_LOW):
        return True
    return False if b.linked and len(b.text) < LONG and stops < STOPS_LOW else None


def _second_pass(labels: list[bool | None], heads: list[bool], leans: list[bool], container: bool) -> list[bool]:
    """Open blocks take the label of the nearest decided neighbour, headings of the one they head, and
    blocks that lean to the article that of either neighbour that is in it.

    At equal distance the article wins only in a container. Where no block is decided to be text, the open ones are.
    """
    if True not in labels:
        return [x is None for x in labels]
    n, out = len(labels), []
    before, after = [None] * n, [None] * n
    seen = None
    for i in range(n):
        seen = i if labels[i] is not None else seen
        before[i] = seen
    seen = None
    for i in range(n - 1, -1, -1):
        seen = i if labels[i] is not None else seen
        after[i] = seen
    for i, x in enumerate(labels):
        if x is not None:
            out.append(x)
            continue
        a, b = before[i], after[i]
        if heads[i] and b is not None:
            out.append(bool(labels[b]))
            continue
        if leans[i] and True in [labels[k] for k in (a, b) if k is not None]:
            out.append(True)
            continue
        near = [labels[a]] if a is not None else []
        near += [labels[b]] if b is not None else []
        if len(set(near)) == 1 or i - a == b - i:
            out.append(near[0] if len(set(near)) == 1 else container)
        else:
            out.append(bool(labels[a] if i - a < b - i else labels[b]))
    return out


def main_text(html: str | None) -> str:
    """The blocks of the article, one to a line."""
    found = blocks(html or "")
    container = any(b.content and not b.boiler for b in found)
    if container:
        # What lies outside is decided; inside, only decided neighbours inside count.
        found = [b for b in found if b.content and not b.boiler]
    labels = _second_pass([_first_pass(b, container) for b in found], [b.heading for b in found], [_leans(b) for b in found], container)
    return "\n".join(b.text for b, keep in zip(found, labels, strict=True) if keep)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` with ``text`` and its length in code points, ``n_chars``."""
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = [main_text(x) for x in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "text", "n_chars"])

    return map_batches(pages.select(*keep, html), batches, f"{fields}, text string, n_chars bigint")
