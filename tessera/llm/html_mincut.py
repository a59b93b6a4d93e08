"""Main text of web pages by minimum cut.

A page becomes a row of text blocks. A classifier gives each block a cost for
either label, which become capacities to the two terminals; neighbours in page
order and blocks of one DOM parent are tied by smoothness edges. The maximum
flow separates content from boilerplate: the labelling of least total cost.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import add_struct

# Names of elements and words of class, id and role attributes.
NO_TEXT = "script style title noscript template iframe canvas object audio video select textarea datalist".split()
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
                   "tfoot th thead tr ul caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog search button fieldset".split())
MAIN_TAGS = frozenset(("article", "main"))
#: Elements of single texts: a boilerplate name there is a doubt, on others it settles the matter.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th caption figcaption span a em strong b i small".split())
BOILER_WORDS = frozenset("ad ads adv advert advertisement advertising advertorial sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                         "notices notification alert popup modal overlay sidebar side aside rail menu menus nav navbar navigation breadcrumb "
                         "breadcrumbs footer masthead topbar toolbar comment comments commentlist reply replies respond disqus discussion "
                         "feedback related recommended recommendations more share sharing social newsletter subscribe subscription signup "
                         "login signin register search form widget widgets pagination pager copyright legal disclaimer skip complementary "
                         "contentinfo tags".split())
HEADER_WORDS = frozenset(("header", "banner"))
MAIN_WORDS = frozenset("article main post entry story articlebody".split())
# Attributes up to the tag's end: a quote counts only where a value begins, any other value ends at white space or >. Nothing is
# tried twice (possessive parts), and a tag that does not end takes the rest of the page.
_REST = r"""((?>[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+))*+)"""
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)" + _REST + r"(?:>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z][^>]*+(?:>|\Z)", re.S)
_ENDS = {t: re.compile(rf"</{t}\s*>", re.I) for t in (*NO_TEXT, "svg")}
_ATTR = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
              "option": ("option",)}
_STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}


@dataclass
class Element:
    tag: str
    number: int
    main: bool       # inside the article
    boiler: bool     # inside something that is never article text
    header: bool     # inside a header
    link: bool
    doubts: int = 0  # elements around it, itself too, with a boilerplate word in a name
    hard: bool = False       # boilerplate by a tag or because it is hidden, not by a name
    landmark: bool = False   # inside an article or main element, whatever its names
    block: Element | None = None   # the nearest element that makes a block, itself if it does
    parent: Element | None = None


@dataclass
class Block:
    text: str
    tag: str
    parent: int      # the element that holds the block's own element
    main: bool
    boiler: bool
    header: bool
    links: int       # characters inside links
    doubts: int = 0
    named: bool = False      # boilerplate by a name alone, inside an article or main element


def _open(tag: str, attrs: str, number: int, above: Element) -> Element:
    names: list[set[str]] = []
    hidden = False
    if attrs and not attrs.isspace():
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id", "role"):
                names += [w for n in value.split() if (w := {x for x in re.split(r"[^a-z]+", n) if x})]
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
    page = tag in ("body", "html")
    header = tag == "header" or not page and any(n <= HEADER_WORDS for n in names)
    # a whole name says what an element is, a word in it may say what it is beside
    whole = not page and not header and any(n <= BOILER_WORDS for n in names)
    doubt = not page and not header and any(n & (BOILER_WORDS | HEADER_WORDS) for n in names)
    hard = hidden or tag in BOILER_TAGS
    boiler = hard or whole and tag not in TEXT_TAGS
    main = tag in MAIN_TAGS or any(n & MAIN_WORDS and not n & BOILER_WORDS for n in names)
    made = Element(tag, number, above.main or main and not boiler and not above.boiler, above.boiler or boiler, above.header or header,
                   above.link or tag == "a", above.doubts + doubt, above.hard or hard, above.landmark or tag in MAIN_TAGS, above.block, above)
    if tag in BLOCKS:
        made.block = made
    return made


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order; references decoded, white space folded. Malformed markup closes what browsers close."""
    out: list[Block] = []
    root = Element("", 0, False, False, False, False)
    root.block = root.parent = root
    stack, opened = [root], Counter()
    text: list[str] = []
    links = number = at = 0

    def flush() -> None:
        nonlocal links
        if text:
            said = "".join(text)
            said = " ".join((html.unescape(said) if "&" in said else said).split())
            if said:
                top, e = stack[-1], stack[-1].block
                boiler = e.boiler or top.boiler
                out.append(Block(said, e.tag, e.parent.number, e.main, boiler, e.header, min(links, len(said)), max(e.doubts, top.doubts),
                                 boiler and not top.hard and top.landmark))
            text.clear()
        links = 0

    def add(s: str) -> None:
        nonlocal links
        text.append(s)
        if stack[-1].link:
            links += len(s)

    def close(tags: tuple, stops) -> None:
        """The innermost open element of ``tags`` ends, with all in it, unless one of ``stops`` lies further in."""
        if any(opened[t] for t in tags):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in tags:
                    opened.subtract(e.tag for e in stack[i:])
                    del stack[i:]
                    return
                if stack[i].tag in stops:
                    return

    while m := _TAG.search(page, at):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, empty = m[2].lower(), m[3].endswith("/")
        if not m[1] and tag in _ENDS and not (empty and tag == "svg"):
            end = _ENDS[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        block = tag in BLOCKS
        if block:
            flush()
        elif tag == "br":
            text.append(" ")
            continue
        if m[1]:
            close((tag,), () if block else BLOCKS)
            continue
        if block:
            # an open paragraph, and what it holds, ends where a block begins
            close(("p",), BLOCKS)
            if tag in _CLOSED_BY:
                close(_CLOSED_BY[tag], _STOPS.get(tag, ()))
        if tag not in VOID and not empty:
            number += 1
            stack.append(_open(tag, m[3], number, stack[-1]))
            opened[tag] += 1
    if at < len(page):
        add(page[at:])
    flush()
    return out


def score(b: Block, has_main: bool) -> float:
    """Cost of calling the block boilerplate less that of calling it content: the classifier's log odds."""
    heading = len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1] in "123456"
    words, dense = b.text.count(" ") + 1, b.links / len(b.text)
    if b.boiler:
        return -9.0
    if b.header:
        return 6.0 if heading and b.main else -6.0
    if has_main:
        s = (6.0 if b.main else -6.0) - 3.0 * b.doubts
    else:
        s = -1.0 + min(words, 40) / 10 + (b.text[-1] in ".!?:;\"'”»…") * 0.8 + (b.tag in ("p", "blockquote", "pre")) * 1.2 + heading * 0.5 - 1.5 * b.doubts
    if dense > 0.5 and words < 25 and b.tag == "li":
        return s - 3.0 - 4.0 * dense * (b.doubts > 0)
    return s - 4.0 * dense * (not b.main or b.doubts > 0)


def edges_of(blocks: list[Block], beside: float = 0.8, together: float = 0.6, reach: int = 4) -> dict[tuple[int, int], float]:
    """Smoothness between neighbours in page order, and between blocks of one parent that follow within ``reach`` blocks."""
    out: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            out[i - 1, i] = beside
        j = last.get(b.parent)
        if j is not None and i - j <= reach:
            out[j, i] = out.get((j, i), 0.0) + together / (i - j)
        last[b.parent] = i
    return out


def min_cut(scores: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Content side of a minimum cut (the smaller one if there are several).

    A block whose own preference is stronger than all its ties is on that side
    in every minimum cut; such blocks are fixed first and move their ties into
    the neighbours' terminals. The flow decides the rest.
    """
    n = len(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), w in edges.items():
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    pull, fixed, queue = list(scores), [0] * n, deque(range(n))
    while queue:
        i = queue.popleft()
        if fixed[i] or abs(pull[i]) <= sum(near[i].values()):
            continue
        fixed[i] = 1 if pull[i] > 0 else -1
        for j, w in near[i].items():
            pull[j] += w * fixed[i]
            del near[j][i]
            queue.append(j)
        near[i] = {}
    rest = [i for i in range(n) if not fixed[i]]
    inside = _max_flow(rest, pull, near) if rest else set()
    return [f > 0 or i in inside for i, f in enumerate(fixed)]


def _max_flow(nodes: list[int], pull: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes that the source still reaches after a maximum flow.

    Blocking flows: a search from the sink gives every node its distance, and all shortest paths are filled before the
    next search. Residual capacities stay; paths that are longer than any before are few, as page neighbours' ties are small.
    """
    place = {i: k for k, i in enumerate(nodes)}
    n = len(nodes)
    to: list[list[int]] = [[place[j] for j in near[i]] for i in nodes]
    left: list[list[float]] = [list(near[i].values()) for i in nodes]
    back: list[list[int]] = [[0] * len(t) for t in to]
    at = [{j: e for e, j in enumerate(t)} for t in to]
    for i, t in enumerate(to):
        for e, j in enumerate(t):
            back[i][e] = at[j][i]
    gives, takes = [max(0.0, pull[i]) for i in nodes], [max(0.0, -pull[i]) for i in nodes]
    tiny = 1e-9
    while True:
        # distance to the sink; what cannot reach it stays at n + 1
        far = [n + 1] * n
        row = [i for i in range(n) if takes[i] > tiny]
        for i in row:
            far[i] = 0
        while row:
            after = []
            for j in row:
                for e, i in enumerate(to[j]):
                    if far[i] > n and left[i][back[j][e]] > tiny:
                        far[i] = far[j] + 1
                        after.append(i)
            row = after
        sources = [i for i in range(n) if gives[i] > tiny and far[i] <= n]
        if not sources:
            break
        turn = [0] * n
        for start in sources:
            path: list[tuple[int, int]] = []
            u = start
            while gives[start] > tiny:
                if far[u] == 0 and takes[u] > tiny:
                    flow = min([gives[start], takes[u], *(left[i][e] for i, e in path)])
                    gives[start] -= flow
                    takes[u] -= flow
                    for i, e in path:
                        left[i][e] -= flow
                        left[to[i][e]][back[i][e]] += flow
                    path, u = [], start
                    continue
                while turn[u] < len(to[u]) and not (left[u][turn[u]] > tiny and far[to[u][turn[u]]] == far[u] - 1):
                    turn[u] += 1
                if turn[u] < len(to[u]):
                    path.append((u, turn[u]))
                    u = to[u][turn[u]]
                elif path:
                    u, e = path.pop()
                    turn[u] += 1
                else:
                    break
    seen = {i for i in range(n) if gives[i] > tiny}
    row = list(seen)
    while row:
        i = row.pop()
        for e, j in enumerate(to[i]):
            if left[i][e] > tiny and j not in seen:
                seen.add(j)
                row.append(j)
    return {nodes[i] for i in seen}


def main_text(page: str | None) -> str:
    """Content blocks in page order, joined by line ends. Null, empty or all boilerplate: empty.

    Where that leaves nothing, names alone may have spoken against an article or main element: they are doubts then,
    which the cut weighs against the element.
    """
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    has_main = any(b.main and not b.boiler for b in blocks)
    keep = min_cut([score(b, has_main) for b in blocks], edges_of(blocks))
    if not any(keep) and any(b.named for b in blocks):
        keep = min_cut([6.0 - 3.0 * b.doubts if b.named else score(b, True) for b in blocks], edges_of(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract(df: DataFrame, html_col: str = "html", out: str = "main", keep: list[str] | None = None) -> DataFrame:
    """``df`` and a struct ``out`` with ``text`` and ``n_chars`` (code points) of the whole page. Repeated rows are extracted each;
    an empty table gives an empty result."""
    def make(pages: list) -> dict[str, list]:
        texts = [main_text(p) for p in pages]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    fields = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return add_struct(df, html_col, out, fields, make, keep=keep, as_bytes=False)
