"""HTML extraction by tag-path ratios."""

from __future__ import annotations

import html
import math
import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
BLOCK = set(
    "address article aside blockquote body br center caption dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
# A start tag of the first kind ends an open element of the second kind.
ENDS = {
    **dict.fromkeys(BLOCK - {"br", "option", "legend"}, {"p"}),
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
}
# An element of the first kind is not ended from inside one of these.
SCOPE = {"ul", "ol", "dl", "table", "article", "section", "div", "body", "main", "blockquote", "td", "th", "nav", "aside"}

# Elements, roles and words in class and id that mark what is no article.
NEVER = set(
    "head script style noscript template nav footer aside form button select option textarea input label fieldset "
    "dialog menu search iframe object embed canvas svg math audio video map xmp noembed noframes datalist".split()
)
ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside footer masthead topbar toolbar "
    "notice notices alert cookie cookies consent gdpr disclaimer popup modal overlay "
    "comment comments disqus reply replies respond discussion "
    "share sharing social related recommended recommendations newsletter subscribe subscription signup login search "
    "widget form skip copyright".split()
)
# Marks that an article's own sections, headings and paragraphs hardly bear; the others may be what they speak of.
CLEAR = set(
    "ad ads adv advert adverts adsense sponsored promo nav navbar breadcrumb breadcrumbs pagination pager sidebar "
    "masthead topbar toolbar comments disqus newsletter signup popup widget".split()
)
# Classes, and ids, of the containers inside an article that hold what is no part of it.
BESIDE = set(
    "comment comments respond reply replies cookie cookies consent gdpr advertisement advertising sponsor share sharing "
    "related recommended recommendations subscribe subscription".split()
)
BESIDE_ID = set("comment comments respond replies cookie cookies consent gdpr advertisement advertising".split())
TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
NEIGHBOUR = set("with without has have no not".split())
UNMARKED = 0.4
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？]")

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
WORD = re.compile(r"[a-z]+")
ARTICLE = re.compile(r"article(\.|\Z)")
EXPLICIT = re.compile(r"(article|main)(\.|\Z)")
HEADING = re.compile(r"h[1-6](\.|\Z)")
PIECE = re.compile(r"(p|h[1-6]|pre|blockquote|li|ul|ol|td|tr|tbody|table|dl|dd)(\.|\Z)")


class Block(NamedTuple):
    path: tuple[str, ...]  # tags from the root, with their classes, to the block's element
    text: str
    linked: int  # characters inside links
    furniture: bool  # inside an element that is no article by name, role or class


class _Open(NamedTuple):
    name: str
    step: str
    furniture: bool


def _opened(name: str, attrs: str, inside: list[_Open]) -> _Open:
    step, furniture = name, name in NEVER
    if name == "header":
        furniture = not any(o.name in ("article", "main") for o in inside)
    if attrs:
        in_article = any(o.name in ("article", "main") for o in inside)
        given: dict[str, str] = {}
        for key, *values in ATTRIBUTE.findall(attrs):
            given.setdefault(key.lower(), next(filter(None, values), "").lower())
        furniture |= "hidden" in given or given.get("role", "") in ROLES
        step += "".join("." + token for token in given.get("class", "").split())
        marks: set[str] = set()
        clear = False
        for key in ("class", "id"):
            tokens = [WORD.findall(token) for token in given.get(key, "").split()]
            # "with-sidebar" names a neighbour, not the element itself.
            words = {w for token in tokens if token and token[0] not in NEIGHBOUR for w in token}
            marks |= words
            # A heading's or paragraph's id is made from what it says.
            clear |= bool(words & CLEAR) and not (key == "id" and name in TEXT)
            clear |= bool(words & (BESIDE if key == "class" else BESIDE_ID)) and name not in TEXT
        if name not in ("html", "body", "article", "main"):
            few = in_article or name in TEXT
            furniture |= clear or len(marks & MARKS) > few
            furniture |= "header" in marks and not in_article and name not in TEXT
    return _Open(name, step, furniture or (bool(inside) and inside[-1].furniture))


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; a few forgiving rules stand in for a full HTML parser.

    Block elements and line breaks part blocks. Unclosed paragraphs, list
    items and cells end where the next begins, unmatched end tags are ignored,
    unclosed comments and raw elements run to the end of the page.
    """
    out: list[Block] = []
    stack: list[_Open] = []
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            upto = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name in BLOCK), -1) + 1
            furniture = bool(stack) and stack[-1].furniture
            out.append(Block(tuple(o.step for o in stack[:upto]), joined, min(linked, len(joined)), furniture))
        text.clear()
        linked = 0

    def add(raw: str, decode: bool = True) -> None:
        nonlocal linked
        if raw:
            raw = html.unescape(raw) if decode and "&" in raw else raw
            text.append(raw)
            if any(o.name == "a" for o in stack):
                linked += len(raw)

    def close_to(i: int) -> None:
        del stack[i:]

    at = 0
    while match := TOKEN.search(page, at):
        add(page[at : match.start()])
        at = match.end()
        if match["cdata"] is not None:
            add(match["cdata"], decode=False)
        if match["name"] is None:
            continue
        name = match["name"].lower()
        if match["close"]:
            i = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), -1)
            if name in BLOCK:
                flush()
            elif i >= 0 and stack[i].furniture and not (i and stack[i - 1].furniture):
                flush()
            if i >= 0:
                close_to(i)
            continue
        if name in BLOCK:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name in ENDS.get(name, ()):
                    close_to(i)
                    break
                if stack[i].name in SCOPE:
                    break
        opened = _opened(name, match["attrs"], stack)
        if opened.furniture and not (stack and stack[-1].furniture):
            flush()
        if name in RAW_END:
            end = RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not match["attrs"].endswith("/"):
            stack.append(opened)
    add(page[at:])
    flush()
    return out


def path_scores(found: list[Block]) -> dict[tuple[str, ...], float]:
    """The fused ratio of each tag path.

    A path's text ratio is its unlinked characters per block, its punctuation
    ratio its marks per block; both are smoothed along the page over each
    block and its neighbours, averaged by path, and multiplied. A path without
    any mark of its own has only ``UNMARKED`` of what its neighbours lend it.
    """
    of_path: dict[tuple[str, ...], list[float]] = defaultdict(lambda: [0, 0, 0])
    for b in found:
        sums = of_path[b.path]
        sums[0] += 1
        sums[1] += len(b.text) - b.linked
        sums[2] += 0 if b.linked else len(PUNCTUATION.findall(b.text))
    ratio = [(of_path[b.path][1] / of_path[b.path][0], of_path[b.path][2] / of_path[b.path][0]) for b in found]
    smooth: dict[tuple[str, ...], list[float]] = defaultdict(list)
    for i, b in enumerate(found):
        near = [(ratio[j], 2 if j == i else 1) for j in (i - 1, i, i + 1) if 0 <= j < len(found)]
        weight = sum(w for _, w in near)
        chars = sum(r[0] * w for r, w in near) / weight
        marks = sum(r[1] * w for r, w in near) / weight
        own = (of_path[b.path][1] > 0) * (1 if of_path[b.path][2] else UNMARKED)
        smooth[b.path].append(math.log1p(chars) * (1 + math.log1p(marks)) * own)
    return {p: sum(v) / len(v) for p, v in smooth.items()}


def main_text(page: str | None) -> str:
    """The article of a page: its blocks, each with single spaces, joined by two line ends; empty if there is none.

    Furniture (menus, headers, footers, forms and the like, by element, role or
    class) is set aside. Of the other blocks the paths whose score reaches half
    of the mean over characters are content. Where ``article`` elements hold
    half of the content's characters, the article is all that stands in them;
    else, where ``main`` and ``article`` hold nine tenths, all that stands in
    these. Without such elements the ratios decide: the article reaches, inside
    the deepest element around all content, from the first block of content, or
    the headings right before it, to the last. Short paragraphs and headings
    between stay, blocks that are mostly links don't.
    """
    found = [b for b in blocks(page or "") if not b.furniture]
    if not found:
        return ""
    score = path_scores(found)
    total = sum(len(b.text) for b in found)
    threshold = sum(score[b.path] * len(b.text) for b in found) / total / 2
    content = [i for i, b in enumerate(found) if score[b.path] >= threshold and score[b.path] > 0]
    if not content:
        return ""
    chars = sum(len(found[i].text) for i in content)
    for explicit, share in ((ARTICLE, 0.5), (EXPLICIT, 0.9)):
        inside = [any(explicit.match(step) for step in b.path) for b in found]
        if sum(len(found[i].text) for i in content if inside[i]) >= share * chars:
            return "\n\n".join(b.text for b, within in zip(found, inside, strict=True) if within)
    around = tuple(os.path.commonprefix([found[i].path for i in content]))
    while around and PIECE.match(around[-1]):
        around = around[:-1]  # a single kind of block: its container may also hold the heading
    first, last = content[0], content[-1]
    while first and HEADING.match(found[first - 1].path[-1] if found[first - 1].path else ""):
        first -= 1
    kept = set(content)
    return "\n\n".join(
        b.text
        for i, b in enumerate(found[first : last + 1], first)
        if b.path[: len(around)] == around and (i in kept or 2 * b.linked < len(b.text))
    )


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(id, url, text, n_chars)``: the main text of every page, from its whole HTML.

    Each page is worked on alone, in one pass without a shuffle. NULL or empty
    HTML gives an empty text; so does a page of furniture alone. Repeated rows
    and NULL ids or urls pass through. Other columns are left out.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p) for p in b["html"].to_pylist()]
            columns = [b["id"], b["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text", "n_chars"])

    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    plain = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return plain.mapInArrow(read, f"id {id_type}, url {url_type}, text string, n_chars long").toDF(
        id_col, url_col, "text", "n_chars"
    )
