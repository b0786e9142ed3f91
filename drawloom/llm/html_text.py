"""Main text of web pages by composite text density.

Per page: a tolerant pass over the tags, in time linear in the page's length,
builds the tree; elements that are no article text by what they are (menus, page headers,
footers, asides, forms, scripts, by tag, role or being hidden) are set aside. For every node
left the composite density is characters per tag, adjusted by the share of linked
characters and tags. The node whose children's densities sum to most is the
article; the least density on its path to the body is the threshold that
neighbours of the path must reach to count as parts of it.

Density cannot tell adverts, notices and reader comments from an article: they are
set aside by the class or id of a containing element, comments and plain adverts by that of any
block; if no text at all is left then, names are ignored. Names that begin like those of a list of
links but go on otherwise ('related-work'), or that tell how a page is laid out ('sidebar-layout'), say nothing.
Beside the densest part, headings before it and prose in the same container stay, however short.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawloom.llm.common import batch, ddl, pieces, raw, table

_TEXT = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")

# Fixed values of HTML: elements by how they are parsed and shown.
_RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
_FENCES = {"html", "body", "table", "ul", "ol", "dl", "article", "section", "main", "div"}
_NEVER = {"head", "script", "style", "noscript", "template", "nav", "footer", "aside", "form", "iframe", "object", "svg", "canvas", "audio", "video", "button", "select", "textarea", "menu", "dialog", "title", "search"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
_HINTS = (
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar "
    "cookie cookies consent gdpr notice notices alert banner popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments disqus respond reviews widget widgets toolbar pagination pager skip"
).split()
# these begin names of an article's own parts too ('related-work', 'social-history'), so what follows them counts
_OFTEN_TEXT = {"related", "social"}
# a name that ends so says how the whole page is laid out
_LAYOUT = r"(?!.*[-_](?:layout|page|template|theme)$)"
_LISTS = "posts articles stories links pages news items content list box bar section block area wrapper container widget media share sharing icons buttons".split()
_HINT = re.compile(rf"^{_LAYOUT}(?:{'|'.join(x for x in _HINTS if x not in _OFTEN_TEXT)})(?:[-_].*)?$|^(?:{'|'.join(sorted(_OFTEN_TEXT))})(?:[-_](?:{'|'.join(_LISTS)}))?$|^(?!(?:has|with|no|without)[-_]).*[-_](?:{'|'.join(_HINTS)})$")
_HOLDERS = {"div", "section", "ul", "ol", "dl", "table", "tr", "td", "details", "center", "fieldset", "figure", "header", "address"}
_COMMENTS = {"comment", "comments"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
_PROSE = {"p", "blockquote", "pre", "figure", "table", "ul", "ol", "dl"}
_PLAIN_ADS = {"ad", "ads", "advert", "advertisement", "sponsored", "promo"}


def _judge(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is never article text, and whether it is a container (or plain advert) that its name says is none."""
    if tag in _NEVER or tag == "header" and not in_article:
        return True, False
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return False, False
    named = False
    for name, a, b, c, hidden in _ATTR.findall(attrs):
        value = (a or b or c).lower()
        name = name.lower()
        if hidden or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True, False
        if name == "role" and value in _ROLES:
            return True, False
        if name in ("class", "id"):
            if tag in _HOLDERS:
                named |= any(_HINT.match(x) for x in value.split())
            elif tag in _BLOCK:
                tokens = set(value.split())
                named |= tag not in ("html", "body", "main") and bool(_COMMENTS & tokens or tag != "article" and _PLAIN_ADS & tokens)
    return False, named


class _Page:
    """Nodes in page order: tag, parent, last descendant, set aside, named; and the texts with their node and block.

    The open elements are a stack; for each tag the places of its open elements
    are kept, so that no step walks the stack or the rest of the page more than once.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.end, self.aside, self.named = ["#root"], [-1], [0], [False], [False]
        self.texts: list[tuple[int, int, str]] = []
        self.block = 0
        self.body = 0
        self.stack, self.places = [0], {}
        within = [False]  # an article or main element
        at, n, last = 0, len(source), source.rfind(">")
        self.strict = True  # until a quote is never closed
        while at < n:
            lt = source.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                self._text(self.stack[-1], source[at:lt])
            if lt == n:
                break
            if source.startswith("<!--", lt):
                close = source.find("-->", lt + 4)
                at = close + 3 if close >= 0 else n
                continue
            m = _NAME.match(source, lt)
            close = -1
            if lt < last:
                if m:
                    close = self._tag_end(source, m.end())
                elif source[lt + 1] in "!?":
                    close = source.find(">", lt)
            if close < 0:
                self._text(self.stack[-1], "<")
                at = lt + 1
                continue
            at = close + 1
            if not m:
                continue
            tag, attrs = m[2].lower(), source[m.end() : close]
            if tag in _BLOCK:
                self.block += 1
            if m[1]:
                self._close(tag)
                continue
            if tag in _BLOCK and tag not in ("html", "body"):
                self._pop_to({"p"}, _FENCES)
            if tag in _CLOSES:
                while self._pop_to(_CLOSES[tag], {"html", "body", "table", "ul", "ol", "dl"}):
                    pass
            if tag == "body":
                self._pop_to({"head"}, set())
            node, up = len(self.tag), self.stack[-1]
            never, named = _judge(tag, attrs, within[up])
            self.tag.append(tag)
            self.parent.append(up)
            self.end.append(node)
            self.aside.append(self.aside[up] or never)
            self.named.append(self.named[up] or named)
            within.append(within[up] or tag in ("article", "main"))
            if tag == "body" and not self.body:
                self.body = node
            if tag == "br":
                self.texts.append((up, self.block, " "))
            if tag in _RAW:
                found = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
                self._text(node, source[at : found.start() if found else n])
                at = found.end() if found else n
            elif tag not in _VOID and not attrs.rstrip().endswith("/"):
                self.places.setdefault(tag, []).append(len(self.stack))
                self.stack.append(node)
        for i in self.stack:
            self.end[i] = len(self.tag) - 1

    def _tag_end(self, source: str, at: int) -> int:
        """The > that ends a tag: outside quotes; the next one if a quote is never closed, here and further on."""
        i = at
        while self.strict:
            m = _STOP.search(source, i)
            if m and m[0] == ">":
                return m.start()
            close = source.find(m[0], m.end()) if m else -1
            if close < 0:
                self.strict = False
            i = close + 1
        return source.find(">", at)

    def _text(self, node: int, s: str) -> None:
        self.texts.append((node, self.block, html.unescape(s)))

    def _pop_to(self, tags: set, fences: set) -> bool:
        """Close the innermost open element of tags, with what is open in it, unless a fence is before it."""
        innermost = lambda names: max((self.places[t][-1] for t in names if self.places.get(t)), default=0)
        k = innermost(tags)
        if not k or innermost(fences - tags) > k:
            return False
        for i in self.stack[k:]:
            self.end[i] = len(self.tag) - 1
            self.places[self.tag[i]].pop()
        del self.stack[k:]
        return True

    def _close(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        self._pop_to({tag}, {"body"} if tag in ("div", "section", "article", "main", "table", "ul", "ol", "dl") else _FENCES - {tag})


def _density(c: int, t: int, lc: int, lt: int, ratio: float) -> float:
    """Composite density of a node with c characters, t tags, lc linked characters and lt links; ratio: linked characters of all."""
    if not c:
        return 0.0
    t, lt = max(t, 1), max(lt, 1)
    base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
    link = max(c / max(lc, 1) * t / lt, 1.0)
    return c / t * (math.log(link) / math.log(base) if base > 1.0001 else 1.0)


def _article(page: _Page, own: list[int], aside: list[bool]) -> tuple[list[bool], int]:
    """Whether each node is part of the main text, and the characters of its largest part; own: characters of each node's own text."""
    n = len(page.tag)
    inside = [False] * n  # a link or within one
    for i in range(1, n):
        inside[i] = page.tag[i] == "a" or inside[page.parent[i]]
    ratio = sum(c for i, c in enumerate(own) if inside[i]) / (sum(own) or 1)
    chars = [0 if aside[i] else own[i] for i in range(n)]
    linked = [c if inside[i] else 0 for i, c in enumerate(chars)]
    tags, links = [0] * n, [0] * n
    holds = [False] * n  # block elements among the children
    for i in range(n - 1, 0, -1):
        if aside[i]:
            continue
        p = page.parent[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        tags[p] += tags[i] + 1
        links[p] += links[i] + (page.tag[i] == "a")
        holds[p] |= page.tag[i] in _BLOCK and page.tag[i] != "hr"
    dense = [0.0 if aside[i] else _density(chars[i], tags[i], linked[i], links[i], ratio) for i in range(n)]
    sums = [0.0] * n
    for i in range(1, n):
        sums[page.parent[i]] += dense[i]
    inner = [i for i in range(page.body, n) if not aside[i] and holds[i]] or [page.body]
    best = max(inner, key=lambda i: (sums[i], -i))
    path, up = {best}, best
    while up != page.body and page.parent[up] >= 0:
        up = page.parent[up]
        path.add(up)
    threshold = min(dense[i] for i in path)
    part = [False] * n
    for i in range(n):
        p = page.parent[i]
        beside = p in path and p != best and i not in path and page.tag[i] in _BLOCK and chars[i] > 0
        # what stands beside the densest part: headings before it and prose in its own container are the article's, however short
        near = page.tag[i] in _HEADINGS and i < best or p == page.parent[best] != page.body and page.tag[i] in _PROSE
        beside = beside and (dense[i] >= threshold or near and 2 * linked[i] <= chars[i])
        part[i] = not aside[i] and (i == best or beside or p >= 0 and part[p])
    return part, chars[best]


def main_text(source: str) -> str:
    """The blocks of the page's main text, white space in each made single, joined by two \\n."""
    page = _Page(source)
    own = [0] * len(page.tag)
    for node, _, s in page.texts:
        if page.tag[node] not in _RAW:
            own[node] += sum(map(len, s.split()))
    aside = page.aside
    if not any(c for c, x in zip(own, aside) if not x):
        # all text was set aside: what roles and hiding suggest was wrong
        aside = [False] * len(page.tag)
        for i in range(1, len(page.tag)):
            aside[i] = aside[page.parent[i]] or page.tag[i] in _NEVER
    part, size = _article(page, own, [x or y for x, y in zip(aside, page.named)])
    if any(page.named) and not size:
        # nothing is left without the containers that names set aside
        part, _ = _article(page, own, aside)
    blocks: dict[int, list[str]] = {}
    for node, block, s in page.texts:
        if part[node]:
            blocks.setdefault(block, []).append(s)
    lines = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n\n".join(x for x in lines if x)


def _extract(batches):
    for b in pieces(batches, "html"):
        texts = [main_text(h.decode("utf-8", "replace")) for h in raw(b.column("html"))]
        yield batch(_TEXT, b.column("id"), b.column("url"), texts)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text (empty if there is none), n_chars.

    Null html counts as empty; null ids and urls stay null; repeated rows give a
    row each. Whole pages are read; extra columns are not carried.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    out = rows.mapInArrow(_extract, ddl(_TEXT))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: see extract."""
    return extract(table(spark, sf_dir, "pages"))
