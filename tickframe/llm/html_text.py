"""HTML extraction by tag-path ratios.

A page is read into blocks of text, each with its root-to-leaf path of structural tags (formatting tags do not
count). Per path: characters and punctuation marks a block, and the share of characters in links. Both ratios are
smoothed over the page's other paths with Gaussian weights on path distance, then fused into one score; paths whose
score reaches a share of the standard deviation (and which are no lists of links) hold content. Headings, quotes,
lists and the like beside content paths, below the same parent, belong to it. Elements that never hold an article
(scripts, styles, menus, forms, side bars, page headers and footers) and boxes that their class, id or role names as
adverts, notices, comments and so on are left out before.

Null or empty html gives an empty text. Broken markup is read as far as it goes: a new paragraph closes an open
one, end tags without a start are ignored, an unclosed tag is text up to the end. Pages are treated one by one,
whole. Every path is scored: paths form a tree whose nodes hold sums of what lies each number of steps below, so the
smoothing visits FAR steps up and down instead of all pairs; weights beyond FAR steps are below 1e-27.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

TAG = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*+>|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<end2>/?)(?P<name2>[A-Za-z][A-Za-z0-9:-]*+)[^>]*+>""",
    re.S,
)
ATTR = re.compile(r"""(?i)\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: Formatting tags: they are not steps of a path and end no block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr img picture source".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not text.
RAW = frozenset("script style noscript template svg math iframe object canvas audio video textarea select title".split())
#: Elements outside the article.
OUTSIDE = frozenset("head nav footer aside form menu dialog button fieldset".split())
CLOSED_BY = {
    "p": frozenset("p".split()), "li": frozenset("li".split()), "dt": frozenset("dt dd".split()), "dd": frozenset("dt dd".split()),
    "tr": frozenset("tr td th".split()), "td": frozenset("td th".split()), "th": frozenset("td th".split()), "option": frozenset(["option"]),
}
#: A paragraph ends where one of these begins.
ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: What class, id or role call a box that is no part of the article.
NOISE = frozenset(
    """ad ads advert advertisement adverts advertising adsense banner sponsor sponsored promo promoted promotion
    nav navbar navigation menu menubar breadcrumb breadcrumbs pager pagination toolbar topbar
    sidebar sidebars aside widget widgets rail related recommended recommendations trending popular
    footer foot copyright legal masthead header siteheader
    comment comments commentlist disqus respond reply replies discussion
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
    share sharing social tags tagcloud search contentinfo complementary""".split()
)
CONTENT = frozenset("article articlebody main content post entry story text body maincontent postcontent entrycontent".split())
PUNCTUATION = frozenset(".,;:!?…。，、；：！？¿¡\"'“”«»")
BESIDE = frozenset("h1 h2 h3 h4 h5 h6 blockquote li dd dt pre td th p figcaption summary caption".split())
FAR = 12
SPREAD = 1.5
THRESHOLD = 0.25


def marks(attrs: str) -> tuple[frozenset, bool]:
    """Words of class, id, role and itemprop; whether the element is hidden."""
    found, hidden = set(), False
    for m in ATTR.finditer(attrs):
        kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if kind == "hidden" or kind == "aria-hidden" and value == "true":
            hidden = True
        elif kind == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif kind != "aria-hidden":
            for word in value.split():
                found.add(re.sub(r"[^a-z0-9]", "", word))
                found.update(re.split(r"[^a-z]+", word))
    return frozenset(found), hidden


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters in links) of each block of text outside the elements and boxes that are left out."""
    out, parts = [], []
    stack: list[tuple[str, bool]] = []  # name, left out
    skipped = in_link = link_chars = 0
    inside = 0  # of article or main
    at = 0

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((tuple(n for n, _ in stack), text, min(link_chars, len(text))))
            parts.clear()
        link_chars = 0

    def pop() -> None:
        nonlocal skipped, inside
        name, left = stack.pop()
        skipped -= left
        inside -= name in ("article", "main")

    def add(raw: str) -> None:
        nonlocal link_chars
        if raw and not skipped:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                link_chars += len(text.strip())

    pos, n = 0, len(page)
    while pos < n:
        m = TAG.search(page, pos)
        if not m:
            break
        add(page[at : m.start()])
        at = pos = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:-3])
            continue
        closing = bool(m["end"] or m["end2"])
        if name in INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            continue
        if name == "br":
            parts.append(" ") if not skipped else None
            continue
        flush()
        if name in VOID:
            continue
        if closing:
            if any(x == name for x, _ in stack):
                while stack[-1][0] != name:
                    pop()
                pop()
            if name in ("nav", "ul", "li", "div", "p"):
                in_link = 0
            continue
        if name in RAW:
            if not (m["attrs"] or "").rstrip().endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, pos)
                at = pos = end.end() if end else n
            continue
        if name in ENDS_P and any(x == "p" for x, _ in stack):
            while stack[-1][0] != "p":
                pop()
            pop()
        elif name in CLOSED_BY and stack and stack[-1][0] in CLOSED_BY[name]:
            pop()
        words, hidden = marks(m["attrs"] or "")
        left = hidden or name in OUTSIDE or name == "header" and not inside or bool(words & NOISE) and not (words & CONTENT and name in ("article", "main", "body"))
        if name in ("body", "html"):
            left = False
        stack.append((name, left))
        skipped += left
        inside += name in ("article", "main")
    add(page[at:])
    flush()
    return out


def selected(found: list[tuple[tuple[str, ...], str, int]]) -> set[tuple[str, ...]]:
    """Paths that hold content."""
    nodes, chars, punct, links = (defaultdict(int) for _ in range(4))
    for path, text, linked in found:
        nodes[path] += 1
        chars[path] += len(text)
        punct[path] += sum(map(text.count, PUNCTUATION))
        links[path] += linked
    up, depth, at = [-1], [0], {}  # the tree of paths: parent and depth of each node
    inside = [False]  # of article or main
    children: dict[tuple[int, str], int] = {}
    for path in nodes:
        v = 0
        for tag in path:
            w = children.get((v, tag))
            if w is None:
                w = children[v, tag] = len(up)
                up.append(v)
                depth.append(depth[v] + 1)
                inside.append(inside[v] or tag in ("article", "main"))
            v = w
        at[path] = v
    below: list[dict[int, list[int]]] = [{} for _ in up]  # by steps down: blocks, characters, punctuation marks
    for path, v in at.items():
        for k in range(min(FAR, depth[v]) + 1):
            sums = below[v].setdefault(k, [0, 0, 0])
            sums[0] += nodes[path]
            sums[1] += chars[path]
            sums[2] += punct[path]
            v = up[v]
    weights = [math.exp(-((d / SPREAD) ** 2)) for d in range(FAR + 1)]

    def smoothed(v: int) -> list[float]:
        """Weighted sums of blocks, characters and punctuation marks of all paths near node v."""
        near = [[0, 0, 0] for _ in weights]
        last = -1
        for j in range(min(FAR, depth[v]) + 1):
            for k, sums in below[v].items():
                if j + k <= FAR:
                    for i in range(3):
                        near[j + k][i] += sums[i]
            if last >= 0:  # what lies below the node that we come from is nearer than by way of v
                for k, sums in below[last].items():
                    if j + k + 1 <= FAR:
                        for i in range(3):
                            near[j + k + 1][i] -= sums[i]
            last, v = v, up[v]
        return [sum(w * x[i] for w, x in zip(weights, near)) for i in range(3)]

    score = {}
    for p, v in at.items():
        total, tpr, ppr = smoothed(v)
        score[p] = math.sqrt(tpr / total * (1 + ppr / total)) * (1 - links[p] / max(chars[p], 1)) * (2.0 if inside[v] else 1.0) * math.log1p(chars[p])
    if not score:
        return set()
    mean = sum(score.values()) / len(score)
    spread = math.sqrt(sum((s - mean) ** 2 for s in score.values()) / len(score))
    least = max(THRESHOLD * max(score.values()), THRESHOLD * spread)
    kept = {p for p in nodes if score[p] >= least and links[p] <= 0.5 * chars[p]}
    articles = [p for p in kept if inside[at[p]]]
    if articles:  # the article's own paths, if there is one with content
        kept = set(articles)
    parents = {max(up[at[p]], 0) for p in kept}
    under = [False] * len(up)  # whether a node or one above it, other than the root, is a parent of content
    for v in range(1, len(up)):
        under[v] = v in parents or under[up[v]]
    for p, v in at.items():
        beside = p and p[-1] in BESIDE and under[v]
        if (beside or v in parents) and links[p] <= 0.5 * chars[p] and (not articles or inside[v]):
            kept.add(p)
    return kept


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    kept = selected(found)
    return " ".join(text for path, text, _ in found if path in kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, one row per input row."""

    def run(batches):
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
