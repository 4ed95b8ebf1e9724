"""Main text of web pages by block rules in two passes.

Pass one cuts a page into blocks at block-level tags and decides each by its place, length, link density and stop-word
density. Pass two lets the blocks that are too short or unclear to tell take over what their nearest decided neighbours
are.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.llm.common import per_batch

# Names from the HTML standard.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr ul noscript".split()
)
RAW_TAGS = frozenset("script style title textarea template iframe svg video audio canvas".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN_TAGS = frozenset(("article", "main"))
SIDE_TAGS = frozenset("nav footer aside form button select dialog menu noscript search optgroup option head".split())

#: Words in class, id and role that name parts beside the main text, and words that name the main text.
SIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header legal login masthead menu modal nav navbar navigation newsletter notice pagination "
    "pager popup promo promoted promotion recommended register related respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription toolbar widget alert alertdialog complementary contentinfo".split()
)
MAIN_WORDS = frozenset("article body content entry main post story text".split())
REPLY_WORDS = frozenset("comment comments disqus respond".split())

#: Frequent words of four languages.
STOP_WORDS = frozenset(
    "a about an and are as at be been but by for from had has have he her his i in is it its not of on or she that the "
    "their there they this to was we were which who will with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour que qui sa "
    "se ses son sont sur un une vous y été "
    "als am auch auf aus bei bin das dass dem den der des die ein eine einem einen einer er es für hat ich ihr im ist man "
    "mit nach nicht noch sein sich sie sind so und uns unter vom von vor war was wie wir zu zum zur über "
    "al como con cuando del desde el ella ellos era es esta este ha hay las lo los más me mi muy no para pero por sin "
    "sobre su sus también te todo una uno yo".split()
)

SHORT, LONG = 70, 200  # characters
FEW_STOPS, MANY_STOPS, SOME_LINKS, MANY_LINKS = 0.20, 0.30, 0.2, 0.5  # shares

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+[^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_WORD_CUT = re.compile(r"[^a-z0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: float  # share of characters in links
    main: bool  # inside an article or main element
    side: bool  # inside a part beside the main text


def _named(rest: str) -> set[str]:
    words: set[str] = set()
    for m in _ATTRIBUTE.finditer(rest):
        words.update(_WORD_CUT.split((m[2] or m[3] or m[4] or "").lower()))
    return words


def blocks(page: str) -> list[Block]:
    """The blocks with text, in page order. Unclosed tags, comments and scripts run to where a browser would end them
    or to the end of the page."""
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []
    # open block tags, each with whether it stands in a part of replies, in a main part, and beside the main text of that
    open_: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]
    n_open: Counter[str] = Counter()
    link = False

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                inside = sum(len("".join(t.split())) for t, is_link in parts if is_link)
                _, reply, main, side = open_[-1]
                out.append(Block(text, inside / max(1, len(text.replace(" ", ""))), main, reply or side))
            parts = []

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None or m.start() > at:
            upto = m.start() if m else n
            parts.append((html.unescape(page[at:upto]), link))
            if m is None:
                break
        at = m.end()
        if not (name := (m["name"] or "").lower()):
            continue
        if m["close"]:
            if name == "a":
                link = False
            if name in BLOCK_TAGS:
                flush()
                while n_open[name]:
                    last = open_.pop()[0]
                    n_open[last] -= 1
                    if last == name:
                        break
            continue
        if name in RAW_TAGS:
            if name != "svg" or not m["rest"].endswith("/"):
                end = re.compile(rf"</{name}(?![a-zA-Z0-9])[^>]*>?", re.IGNORECASE).search(page, at)
                at = end.end() if end else n
            continue
        if name == "a":
            link = True
        elif name == "br":
            parts.append((" ", link))
        if name in BLOCK_TAGS:
            flush()
            link = False
            if name in VOID_TAGS:
                continue
            words = _named(m["rest"]) if "=" in m["rest"] else set()
            if words & REPLY_WORDS and name not in ("body", "html", "main"):
                kind = "reply"
            elif name in MAIN_TAGS or "main" in words and name in ("div", "section") and not words & SIDE_WORDS:
                kind = "main"
            elif name in SIDE_TAGS or name == "header" and not open_[-1][2]:
                kind = "side"
            elif name not in ("body", "html") and (
                words & SIDE_WORDS and not words & MAIN_WORDS or m["rest"] and _HIDDEN.search(m["rest"])
            ):
                kind = "side"
            else:
                kind = ""
            if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and open_[-1][0] == name:
                open_.pop()
                n_open[name] -= 1
            _, reply, main, side = open_[-1]
            open_.append((name, reply or kind == "reply", main or kind == "main", kind != "main" and (side or kind == "side")))
            n_open[name] += 1
    flush()
    return out


def decide(found: list[Block]) -> list[bool]:
    """Which blocks are main text.

    Pass one. Parts beside the main text are not, and blocks made of links are only where they stand in an article or main
    element and their neighbours are. Outside of an article, short notices of
    copyright are not either. Long blocks with many stop words are. Few stop words only make a block unclear, since it may
    be a table, code or of another language; with some links too it is not main text, unless in an article or main element.
    Pass two. Unclear blocks are main text if the nearest decided block before or after them, in the same kind of place,
    is; if there is none, they are if they stand in an article or main element. On a page without any of these, unclear
    blocks of some length count as decided main text, and all of them where none is of some length.
    """
    verdict: list[bool | None] = []
    for b in found:
        words = _WORD.findall(b.text.lower())
        stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
        if b.side or b.linked > MANY_LINKS and not b.main:
            verdict.append(False)
        elif b.linked > MANY_LINKS:
            verdict.append(None)
        elif not b.main and len(b.text) < LONG and ("©" in b.text or "all rights reserved" in b.text.lower()):
            verdict.append(False)
        elif len(b.text) < SHORT:
            verdict.append(None)
        elif stops >= MANY_STOPS or b.main and stops >= FEW_STOPS and len(b.text) >= LONG:
            verdict.append(True)
        elif b.main or stops >= FEW_STOPS or b.linked <= SOME_LINKS:
            verdict.append(None)
        else:
            verdict.append(False)

    if not any(v or v is None and b.main for v, b in zip(verdict, found, strict=True)):
        least = SHORT if any(v is None and len(b.text) >= SHORT for v, b in zip(verdict, found, strict=True)) else 0
        verdict = [True if v is None and len(b.text) >= least else v for v, b in zip(verdict, found, strict=True)]

    def sweep(order: range) -> dict[int, bool]:
        seen: dict[int, bool] = {}
        last: dict[bool, bool] = {}
        for i in order:
            if verdict[i] is None:
                if found[i].main in last:
                    seen[i] = last[found[i].main]
            elif not found[i].side:
                last[found[i].main] = verdict[i]
        return seen

    before, after = sweep(range(len(found))), sweep(range(len(found) - 1, -1, -1))
    return [
        v if v is not None else any(near) if (near := [x[i] for x in (before, after) if i in x]) else found[i].main
        for i, v in enumerate(verdict)
    ]


def main_text(page: str) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, good in zip(found, decide(found), strict=True) if good)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each page, one narrow pass.

    Null or empty pages and pages without main text have the empty text. Repeated rows are kept; other columns of
    ``pages`` are not read.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def of(batch: pa.RecordBatch) -> dict:
        texts = [main_text(x) if x else "" for x in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts,
                "n_chars": [len(t) for t in texts]}

    run = per_batch(of, schema)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batches)

    columns = (F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return pages.select(*columns).mapInArrow(start, "page_id long, url string, text string, n_chars long")
