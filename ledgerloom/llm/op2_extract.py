"""Main text of HTML pages by minimum cut.

A page is read into text blocks with the open elements around them. A small classifier turns each block's
surroundings and text into a cost of calling it content or boilerplate: the block's capacities to the two
terminals. Names of classes and ids are evidence and no proof: words of layout state (`no-sidebar`,
`comments-open`, `login-page`) say nothing, and an element that holds most of the page, or mostly one article,
or without which no paragraph is left, condemns nothing. Blocks that follow each other, and blocks in one container, are joined by smoothness edges whose
capacity falls with the DOM distance. The minimum cut (Dinic's maximum flow) parts content from the rest.

Null and empty pages have an empty text. Character references are decoded, white space inside a block
becomes one space, blocks are joined by one space in page order. Comments, quotes and raw-text elements
without end run to the end of the page; other silent elements without end tag run to the next block tag, so
the text after them stays. Repeated rows get equal texts; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names and the words of class and id attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template title svg iframe object select textarea button".split())
RAW_TEXT = frozenset("script style textarea title".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOT_CONTENT = frozenset("nav aside footer menu dialog form".split())
CONTENT = frozenset("article main".split())
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner "
    "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs toolbar footer foot masthead topbar header "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login form search share sharing social related recommended recommendations widget pagination pager tags legal "
    "copyright disclaimer".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond responses discussion".split())
GOOD_WORDS = frozenset("article content main post entry story text body articlebody postbody".split())
# A class name that begins or ends so tells how a page is laid out and not what the element is.
STATE_FIRST = frozenset("no non not has have with without is hide hidden show js".split())
STATE_LAST = frozenset("open closed on off enabled disabled active inactive allowed page layout true false".split())
# What an element says of all it holds.
COMMENTS, BOILERPLATE, NAMED_SO, CONTENT_NAMED, CONTENT_ELEMENT = -3, -2, -1, 1, 2

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    path: tuple[tuple[str, int], ...] = ()
    # The elements around with something to say, outermost first: their number and what they say.
    verdicts: tuple[tuple[int, int], ...] = ()
    text: str = ""


def _named(attributes: str) -> set[str]:
    """The words of class, id and role, without names of layout state and of an article's own header."""
    words: set[str] = set()
    for m in _NAMED.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = [w.lower() for w in _WORDS.findall(name)]
            if len(parts) > 1 and (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST):
                continue
            if "header" in parts and GOOD_WORDS.intersection(parts):
                parts.remove("header")
            words.update(parts)
    return words


def _verdict(name: str, attributes: str) -> int:
    if name in {"html", "body"}:
        return 0
    words = _named(attributes)
    if words & COMMENT_WORDS:
        return COMMENTS
    if name in NOT_CONTENT:
        return NAMED_SO if name == "form" else BOILERPLATE
    if words & BAD_WORDS:
        return 0 if name in CONTENT else NAMED_SO
    if name in CONTENT:
        return CONTENT_ELEMENT
    return CONTENT_NAMED if words & GOOD_WORDS else 0


def _raw_end(page: str, name: str, at: int) -> int:
    end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
    return end.end() if end else len(page)


def _silent_end(page: str, name: str, at: int) -> int:
    """Where a silent element ends: behind its end tag if that comes before the end of the block around it.

    Without one it ends at the first block tag.
    """
    depth = 1
    inside: list[str] = []
    boundary = -1
    while tag := _TAG.search(page, at):
        at = tag.end()
        found = (tag[2] or tag[5] or "").lower()
        if found in BLOCKS and boundary < 0:
            boundary = tag.start()
        if tag[1] or tag[4]:
            if found == name:
                depth -= 1
                if not depth:
                    return at
            elif found in inside:
                while inside.pop() != found:
                    pass
            elif found in BLOCKS:
                break
        elif not (tag[3] or tag[6] or "").endswith("/"):
            if found == name:
                depth += 1
            elif found in RAW_TEXT:
                at = _raw_end(page, found, at)
            elif found in BLOCKS and found not in VOID:
                inside.append(found)
    return boundary if boundary >= 0 else len(page)


def read_blocks(page: str) -> list[Block]:
    """Text blocks in page order with the block elements around them, innermost last."""
    blocks: list[Block] = []
    stack: list[tuple[str, int, int]] = []
    last_end: dict[str, int] = {}
    current = Block()
    serial = links = at = 0

    def close() -> None:
        nonlocal current
        text = " ".join("".join(current.pieces).split())
        if text:
            current.text = text
            around = [s for s in stack if s[0] in BLOCKS]
            current.path = tuple((s[0], s[1]) for s in around)
            current.verdicts = tuple((s[1], s[2]) for s in stack if s[2])
            blocks.append(current)
        current = Block()

    def say(raw: str) -> None:
        if raw:
            text = html.unescape(raw)
            current.pieces.append(text)
            if links:
                current.linked += len(text.strip())

    def next_block(at: int) -> int:
        while tag := _TAG.search(page, at):
            name = (tag[2] or tag[5] or "").lower()
            if name in BLOCKS:
                return tag.start()
            at = tag.end()
            if name in RAW_TEXT and not (tag[1] or tag[4]):
                at = _raw_end(page, name, at)
        return len(page)

    while True:
        tag = _TAG.search(page, at)
        say(page[at : tag.start()] if tag else page[at:])
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name or name == "head":  # what a head holds is silent by itself, and its end tag may be left out
            continue
        if name == "br":
            current.pieces.append(" ")
        if tag[1] or tag[4]:
            if name in BLOCKS:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    links -= sum(s[0] == "a" for s in stack[i:])
                    del stack[i:]
                    break
                if name not in BLOCKS and stack[i][0] in BLOCKS:
                    break
            continue
        attributes = tag[3] or tag[6] or ""
        if name in SILENT:
            if not attributes.endswith("/"):
                if name in RAW_TEXT:
                    at = _raw_end(page, name, at)
                else:
                    if name not in last_end:
                        last_end[name] = page.lower().rfind(f"</{name}")
                    if last_end[name] >= at:
                        at = _silent_end(page, name, at)
                    else:
                        at = next_block(at)
            continue
        if name in BLOCKS:
            close()
            # These end themselves where the next one or any block begins.
            if stack and name in {"li", "dt", "dd", "tr", "td", "th", "p"} | BLOCKS:
                own = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
                ends = own.get(name, set()) | {"p"}
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        links -= sum(s[0] == "a" for s in stack[i:])
                        del stack[i:]
                    elif stack[i][0] in BLOCKS:
                        break
        if name in VOID or attributes.endswith("/"):
            continue
        serial += 1
        verdict = _verdict(name, attributes)
        if name == "header" and not any(s[2] > 0 for s in stack):
            verdict = BOILERPLATE
        stack.append((name, serial, verdict))
        links += name == "a"
    close()
    return blocks


def evidence(block: Block, unheard: frozenset[int] | set[int] = frozenset()) -> float:
    """Above zero: what it costs to call the block boilerplate; below: to call it content.

    `unheard` are elements whose names are not believed.
    """
    said = [verdict for element, verdict in block.verdicts if element not in unheard]
    if COMMENTS in said:
        return -8.0
    if any(verdict < 0 for verdict in said):
        return -6.0
    if CONTENT_ELEMENT in said:
        return 6.0
    name = block.path[-1][0] if block.path else ""
    share = min(1.0, block.linked / len(block.text))
    score = min(len(block.text), 200) / 100 - 3.0 * share
    score += 0.5 if name in HEADINGS or name in {"p", "pre", "blockquote"} else 0.0
    score -= 1.0 if len(block.text) < 40 and not re.search(r"[.!?:;]", block.text) else 0.0
    # An element that calls itself content is believed for all but links.
    return score - 0.3 + (3.0 * (1 - share) if said else 0.0)


def disbelieved(blocks: list[Block]) -> set[int]:
    """Elements that call themselves boilerplate and cannot be: by what they hold."""
    total = sum(len(b.text) for b in blocks)
    held: Counter[int] = Counter()
    articles: dict[int, Counter[int]] = {}
    names: dict[int, int] = {}
    for block in blocks:
        for i, (element, verdict) in enumerate(block.verdicts):
            held[element] += len(block.text)
            if verdict < 0:
                names[element] = verdict
                inside = articles.setdefault(element, Counter())
                if any(kind == CONTENT_ELEMENT for _, kind in block.verdicts[:i]):
                    continue  # a box inside an article may well hold another one
                for inner, kind in block.verdicts[i + 1 :]:
                    if kind == CONTENT_ELEMENT:
                        inside[inner] += len(block.text)
    out = {
        e for e, verdict in names.items()
        if verdict == NAMED_SO and (2 * held[e] > total or 2 * max(articles[e].values(), default=0) >= held[e])
    }
    # Whole pages in what is named after comments or boilerplate: the largest name is dropped first.
    large = sorted((e for e in names if names[e] != BOILERPLATE and 2 * held[e] > total), key=lambda e: (-held[e], e))
    for element in large:
        if any(evidence(b, out) > 0 for b in blocks):
            break
        out.add(element)
    return out


def _nearness(a: Block, b: Block) -> float:
    """Capacity between two blocks: 1.5 in one container, halved with every step apart."""
    shared = 0
    for x, y in zip(a.path[:-1], b.path[:-1], strict=False):
        if x != y:
            break
        shared += 1
    steps = max(len(a.path), len(b.path)) - 1 - shared
    return 1.5 / 2 ** max(steps, 0)


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source when the flow from it to the sink is maximal."""
    n = len(costs)
    source, sink = n, n + 1
    graph: list[list[list]] = [[] for _ in range(n + 2)]

    def join(u: int, v: int, there: float, back: float) -> None:
        graph[u].append([v, there, len(graph[v])])
        graph[v].append([u, back, len(graph[u]) - 1])

    for i, cost in enumerate(costs):
        join(source, i, cost, 0.0) if cost > 0 else join(i, sink, -cost, 0.0)
    for u, v, capacity in edges:
        join(u, v, capacity, capacity)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v, capacity, _ in graph[u]:
                if capacity > tiny and level[v] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        while True:  # one augmenting path of the level graph after another
            path: list[tuple[int, int]] = []
            u = source
            while u != sink:
                while at[u] < len(graph[u]):
                    v, capacity, _ = graph[u][at[u]]
                    if capacity > tiny and level[v] == level[u] + 1:
                        break
                    at[u] += 1
                else:
                    if not path:
                        break
                    u, _ = path.pop()
                    at[u] += 1
                    continue
                path.append((u, at[u]))
                u = v
            if u != sink:
                break
            pushed = min(graph[a][k][1] for a, k in path)
            for a, k in path:
                edge = graph[a][k]
                edge[1] -= pushed
                graph[edge[0]][edge[2]][1] += pushed


def main_text(page: str) -> str:
    blocks = read_blocks(page)
    edges = [(i, i + 1, _nearness(a, b)) for i, (a, b) in enumerate(zip(blocks, blocks[1:], strict=False))]
    last: dict[tuple[str, int], int] = {}
    for i, block in enumerate(blocks):
        container = block.path[-2] if len(block.path) > 1 else ("", 0)
        if last.get(container, i - 1) < i - 1:
            edges.append((last[container], i, 0.5))
        last[container] = i
    unheard = disbelieved(blocks)
    kept = minimum_cut([evidence(b, unheard) for b in blocks], edges)
    return " ".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def _main_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(p) for p in pages], dtype=object)


def extract(page: Column) -> Column:
    return F.pandas_udf(_main_texts, "string")(F.coalesce(page, F.lit("")))


def main_texts(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", extract(F.col("html")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
