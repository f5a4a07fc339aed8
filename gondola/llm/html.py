"""Main text of web pages by tag-path ratios.

Every text block of a page hangs on a path of tags from the root. Blocks of one path are taken
together: their text length, the number of their punctuation marks and the share of text
outside links, each per block, give the path's ratios. The ratios are smoothed over paths that
differ little, fused into one product, and weighted by what the names on the path say of the
content (an article, a menu). Paths at or above a share of the best one are content. The
article is the deepest element that holds most of the content, and within it every block is
kept that no name on its path marks as something else. A mark weighs on the ratio of its
path; it is lifted where the page's own text, or an article, lies below it.
"""

from __future__ import annotations

import html as entities
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm.common import per_text, struct_array

THRESHOLD = 0.25
#: Weight of a path's own ratio against those of the paths one tag away.
SMOOTHING = 0.7

# Tags by what they do, and name parts that mark what is no content or is.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "head", "select", "textarea", "button", "datalist"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "html", "td", "th", "blockquote", "nav", "aside", "footer", "header", "form"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "header"}
BOILERPLATE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promoted", "promotion", "nav", "navbar",
    "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "side", "aside", "widget", "widgets", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social",
    "related", "recommended", "recommendations", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "pagination", "pager", "toolbar",
    "copyright", "legal", "disclaimer", "search", "searchbox", "hidden", "skip", "outbrain", "taboola", "tags", "toc", "form", "alert", "paywall",
}
#: Marks that no amount of text below lifts, and names that mark an element in an article only where its ratio is low.
FIRM_TAGS = {"nav", "footer", "aside", "menu", "dialog"}
FIRM_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promoted", "promotion", "nav", "navbar", "navigation",
    "menu", "menubar", "breadcrumb", "breadcrumbs", "footer", "cookie", "cookies", "consent", "gdpr", "newsletter", "subscribe", "subscription", "share", "sharing",
    "social", "related", "recommended", "recommendations", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "pagination", "pager",
    "outbrain", "taboola", "paywall",
}
SOFT_NAMES = {"header", "side", "tags", "toc", "notice", "notices", "alert", "search", "legal", "disclaimer", "form", "skip", "toolbar"}
#: What each mark on a path does to its ratio, and the share of the text from which an element's mark is lifted.
WEIGHTS = {"=": 0.1, "-": 0.1, "?": 0.4}
DOMINANT = 0.8
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
CONTENT_TAGS = {"article", "main"}
FLOW = {"body", "html", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "table", "thead", "tbody", "tr", "td", "th", "figure", "figcaption"}
CONTENT_NAMES = {"article", "articlebody", "content", "maincontent", "post", "story", "entry", "body", "text", "main"}
MARKS = frozenset(".,;:!?…。、，；：！？¿¡\"'()«»„“”-–—")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>", re.S)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|style|aria-hidden)(?![\w-])\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME_PARTS = re.compile(r"[a-z]+(?=[A-Z])|[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")


def _standing(tag: str, attributes: str) -> str:
    """What a tag and its names say: "!" hidden, "=" surely no content, "-" no content, "?" perhaps none, "+" content."""
    names: set[str] = set()
    firm = tag in FIRM_TAGS
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if kind == "hidden" or kind == "aria-hidden" and value.lower() == "true":
                return "!"
            if kind == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return "!"
            firm |= kind == "role" and value.lower() in BOILERPLATE_ROLES
            if kind in ("class", "id"):
                names.update(p.lower() for word in value.split() for p in NAME_PARTS.findall(word))
    marked = names & BOILERPLATE_NAMES if tag not in ("body", "html") and tag not in CONTENT_TAGS else set()
    content = tag in CONTENT_TAGS or bool(names & CONTENT_NAMES) and tag not in ("body", "html")
    if firm or marked & FIRM_NAMES:
        return "="
    if tag in BOILERPLATE_TAGS or marked - SOFT_NAMES:
        return "-"
    if marked:
        return "" if content else "?"
    return "+" if content else ""


class Block:
    """One run of text between block tags: its element path, text and the length inside links."""

    __slots__ = ("path", "names", "text", "linked")

    def __init__(self, path: tuple[int, ...], names: tuple[str, ...], text: str, linked: int):
        self.path, self.names, self.text, self.linked = path, names, text, linked


class _Inline:
    """A link or span: whether its names mark it as no content, or hide it, and whether it was closed in its block."""

    __slots__ = ("tag", "hidden", "marked", "closed")

    def __init__(self, tag: str, standing: str):
        self.tag, self.hidden, self.closed = tag, standing == "!", False
        self.marked = standing in ("!", "=", "-")


def _without_marked_ends(parts: list[tuple[str, bool, _Inline | None]]) -> list[tuple[str, bool, _Inline | None]]:
    """A block's text without hidden pieces, and without marked links and spans at its start and end.

    A share or skip link stands there; within a sentence a name says nothing. What was not closed
    before the block ended is no element around the text.
    """
    drops = lambda p: not p[0].strip() or p[2] is not None and p[2].closed
    shown = [p for p in parts if p[2] is None or not (p[2].hidden and p[2].closed)]
    if not any(p[2] is not None for p in shown):
        return shown
    start, end = 0, len(shown)
    while start < end and drops(shown[start]):
        start += 1
    while end > start and drops(shown[end - 1]):
        end -= 1
    return shown[start:end]


def blocks(page: str) -> list[Block]:
    """The visible text blocks in page order; unclosed and unmatched tags are taken as browsers do."""
    stack: list[tuple[str, int, bool]] = []  # tag, element number, silent below
    names: list[str] = []
    found: list[Block] = []
    parts: list[tuple[str, bool, _Inline | None]] = []
    inline: list[_Inline] = []
    links, number, at = 0, 0, 0
    silent = 0

    def flush() -> None:
        inline.clear()
        if not parts:
            return
        kept = _without_marked_ends(parts)
        text = SPACE.sub(" ", entities.unescape("".join(p for p, *_ in kept))).strip()
        if text:
            linked = sum(len(SPACE.sub(" ", p)) for p, inside, _ in kept if inside)
            found.append(Block(tuple(e for _, e, _ in stack), tuple(names), text, linked))
        parts.clear()

    def pop_to(depth: int) -> None:
        nonlocal silent
        flush()
        while len(stack) > depth:
            _, _, hush = stack.pop()
            names.pop()
            silent -= hush

    end = len(page)
    while at < end:
        m = TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at and not silent:
            parts.append((page[at:stop], links > 0, next((i for i in inline if i.marked), None)))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA[") and not silent:
                parts.append((m[0][9:-3], links > 0, None))
            continue
        closing, attributes = m[1] == "/", m[3]
        if tag in INLINE:
            links = max(0, links + (-1 if closing else 1)) if tag == "a" else links
            if tag in ("a", "span") and not attributes.rstrip().endswith("/"):
                # A link ends at the next one; an end tag ends what was opened inside, too.
                if closing or tag == "a":
                    last = max((i for i, x in enumerate(inline) if x.tag == tag), default=None)
                    if last is not None:
                        for x in inline[last:]:
                            x.closed = True
                        del inline[last:]
                if not closing:
                    inline.append(_Inline(tag, _standing(tag, attributes) if attributes else ""))
            continue
        if tag == "br":
            flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    pop_to(depth)
                    links = 0
                    break
            else:
                flush()
            continue
        if tag in CLOSES_P and any(t == "p" for t, _, _ in stack):
            depth = max(i for i, (t, _, _) in enumerate(stack) if t == "p")
            if not any(t in SCOPES for t, _, _ in stack[depth + 1:]):
                pop_to(depth)
        if tag in SAME_ENDS:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in SAME_ENDS[tag]:
                    pop_to(depth)
                elif stack[depth][0] in SCOPES:
                    break
        flush()
        if tag in RAW or tag == "svg":
            shut = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = shut.end() if shut else end
            continue
        if tag == "body":
            pop_to(0)
            links = 0
        number += 1
        sign = _standing(tag, attributes)
        hush = tag in SILENT
        silent += hush
        stack.append((tag, number, hush))
        names.append(tag + sign)
    flush()
    return found


def path_scores(found: list[Block]) -> dict[tuple[str, ...], float]:
    """The fused ratio of each tag path: smoothed text and mark ratios, less what is in links, by its standing."""
    sums: dict[tuple[str, ...], np.ndarray] = {}
    for b in found:
        marks = sum(map(MARKS.__contains__, b.text))
        add = np.array([1, len(b.text), marks, min(b.linked, len(b.text))], float)
        sums[b.names] = sums.get(b.names, 0) + add
    ratio = {p: np.array([s[1] / s[0], s[2] / s[0]]) for p, s in sums.items()}
    by_parent: dict[tuple[str, ...], list] = {}
    for p in ratio:
        by_parent.setdefault(p[:-1], []).append(p)
    scores = {}
    for p, own in ratio.items():
        # Paths one tag away: siblings, the parent, and children.
        near = [ratio[q] for q in (*by_parent[p[:-1]], p[:-1], *by_parent.get(p, ())) if q != p and q in ratio]
        smooth = SMOOTHING * own + (1 - SMOOTHING) * (np.mean(near, 0) if near else own)
        free = 1 - sums[p][3] / max(1.0, sums[p][1])
        weight = 3.0 if any(n[-1] == "+" for n in p) else 1.0
        weight *= math.prod(WEIGHTS.get(n[-1], 1.0) for n in p)
        scores[p] = float(smooth[0] * (1 + smooth[1]) * free * free * weight)
    return scores


def _lift(found: list[Block]) -> None:
    """Take off marks of elements around most of the page's own text, such as a form or a wrapper named after a sidebar.

    A mark goes where an article or main element below has more text outside links than all
    blocks without marks, or, unless it is firm, where nearly all of the text is below it.
    """
    marks = [[i for i, n in enumerate(b.names) if n[-1] in WEIGHTS] for b in found]
    free = [max(0, len(b.text) - b.linked) for b in found]
    while any(marks):
        plain = sum(size for size, m in zip(free, marks) if not m)
        below: dict[int, int] = {}
        above: dict[int, list[int]] = {}
        articles: dict[int, int] = {}
        firm = set()
        for b, m, size in zip(found, marks, free):
            if not m:
                continue
            # Only the innermost mark has this text to itself.
            below[b.path[m[-1]]] = below.get(b.path[m[-1]], 0) + size
            if b.names[m[-1]][-1] == "=":
                firm.add(b.path[m[-1]])
            for i in range(m[-1] + 1, len(b.names)):
                if b.names[i] in ("article+", "main+"):
                    articles[b.path[i]] = articles.get(b.path[i], 0) + size
                    above[b.path[i]] = [b.path[j] for j in m]
        best = max(articles, key=lambda e: (articles[e], e), default=None)
        if best is not None and articles[best] > plain:
            gone = set(above[best])
        else:
            sizes = {e: size for e, size in below.items() if e not in firm and size}
            top = max(sizes, key=lambda e: (sizes[e], e), default=None)
            if top is None or sizes[top] < DOMINANT * (sizes[top] + plain):
                return
            gone = {top}
        for at, b in enumerate(found):
            if any(b.path[i] in gone for i in marks[at]):
                b.names = tuple(n[:-1] if e in gone else n for e, n in zip(b.path, b.names))
                marks[at] = [i for i in marks[at] if b.path[i] not in gone]


def _holder(content: list[Block], share: float) -> int | None:
    """The deepest element that holds at least ``share`` of the blocks' text."""
    weight: dict[int, int] = {}
    for b in content:
        for element in b.path:
            weight[element] = weight.get(element, 0) + len(b.text)
    least = share * sum(len(b.text) for b in content)
    return max((e for e, size in weight.items() if size >= least), default=None)


def main_text(page: str, threshold: float = THRESHOLD) -> str:
    """The article's blocks, each on a line; empty where a page has no text of its own.

    Content paths score at least ``threshold`` times the best. The deepest element that holds
    most of their text, or the article around it, is taken: there, all that no name marks as
    something else, or whose ratio is high although a name might; without such an element, all that the
    deepest element around most of it holds, except lists of links. Where that is the page, other
    parts of it before and after the content go, but no headings, lists, quotes or tables of its own.
    """
    found = [b for b in blocks(page) if not any(n[-1] == "!" for n in b.names)]
    _lift(found)
    usable = [b for b in found if not any(n[-1] in "=-" for n in b.names)]
    if not usable:
        return ""
    scores = path_scores(usable)
    least = threshold * max(scores.values())
    content = [b for b in usable if scores[b.names] >= least]
    plain = [b for b in content if not any(n[-1] == "?" for n in b.names)]
    content = plain or content
    usable = [b for b in usable if scores[b.names] >= least or not any(n[-1] == "?" for n in b.names)]
    core = _holder(content, 0.6)
    around = next((b for b in content if core in b.path), content[0])
    depth = around.path.index(core) if core in around.path else -1
    outer = around.names[: depth + 1]
    for wanted in ("article+", "main+"):
        if wanted in outer:
            root = around.path[max(i for i, n in enumerate(outer) if n == wanted)]
            return "\n".join(b.text for b in usable if root in b.path)
    root = _holder(content, 0.8)
    inside = [b for b in usable if root is None or root in b.path]
    depth = next((b.path.index(root) for b in content if root in b.path), -1)
    page_level = depth < 0 or content[0].names[depth].rstrip("+") in ("body", "html")
    lists = _link_lists(inside, depth)
    if page_level:
        # The page itself is no container: its other parts go, but not what stands in it as the content does.
        holding = {e for b in content for e in b.path[depth + 1:]}
        part = lambda b: next((e for e, n in zip(b.path[depth + 1:], b.names[depth + 1:]) if n.rstrip("+?") not in FLOW), None)
        own = set(map(id, content))
        places = [i for i, b in enumerate(inside) if id(b) in own]
        inside = [b for i, b in enumerate(inside) if places[0] < i < places[-1] or part(b) is None or part(b) in holding]
    return "\n".join(b.text for b in inside if not lists.intersection(b.path))


def _link_lists(inside: list[Block], depth: int) -> set[int]:
    """Elements below ``depth`` whose blocks, two or more, are all mostly links."""
    count: dict[int, int] = {}
    linked: dict[int, int] = {}
    for b in inside:
        for element in b.path[depth + 1:]:
            count[element] = count.get(element, 0) + 1
            linked[element] = linked.get(element, 0) + (b.linked >= 0.7 * len(b.text))
    return {e for e, n in count.items() if n > 1 and linked[e] == n}


def _extracted(pages: list[str]) -> pa.Array:
    texts = [main_text(p) for p in pages]
    return struct_array(text=pa.array(texts, pa.string()), n_chars=pa.array(map(len, texts), pa.int64()))


def extracted(html: Column) -> Column:
    """struct(text, n_chars) of a page; NULL and empty pages have the empty text."""
    return per_text(lambda: _extracted, "struct<text:string,n_chars:bigint>", html)


def report(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    The whole html is read, broken and truncated markup too; repeated rows are all returned,
    other columns are ignored, no rows give no rows.
    """
    made = extracted(F.col("html"))
    return pages.select("page_id", "url", made.alias("made")).select("page_id", "url", "made.*")
