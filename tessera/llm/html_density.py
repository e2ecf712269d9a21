"""Main text of HTML pages by composite text density.

A page is parsed into its element tree.  Elements that are never article text (menus,
page headers, footers, side bars, notices, adverts, forms, scripts, styles, reader
comments, hidden parts; by element name, role, class or id) are cut off.  Every other
element gets its composite density: characters per tag, adjusted by the share of link
characters and link tags against that of the whole body (Sun, Song and Liao, 2011).  The
sum of the densities of its children ranks an element; the highest sum marks the core.
The least density on the path from the body to the core is the threshold: from the body
down, each element that reaches it gives the block of highest sum in it; the text of all of
them is the result, and sparse elements beside them are left out, but for headings of such a
block.  With ``semantic`` an article or main element around the core is the result instead.

A class or id that is a mark, and a form, cut their element, unless hardly any text is left
beside them (a form or a notice around the whole page).  A class or id that only has a mark
among its words cuts unless the element holds the core (that of the article or main elements,
if there are any) or is a heading.

Parsing is lenient: missing end tags, unquoted attributes, stray ``<`` and a page cut
off anywhere are read like a browser reads them, and whole pages are read in one pass.

Defined results: a null or empty page, or one without article text, gives an empty text;
plain text without tags is its own article; equal pages get equal results; an empty
table gives an empty result; other columns pass through (those named like the results
are replaced).
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera.llm.common import slices

SLICE = 1 << 21

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)            # comment
    | <(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>   # tag, quoted values may hold >
    | <(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>             # tag with a stray quote
    | <[!?/][^>]*+(?:>|\Z)                          # declaration, stray end tag
    | <[a-zA-Z][^>]*+\Z                             # cut off inside a tag
    """, re.S | re.X)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"[\x20\x09-\x0D\xA0]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
CUT = frozenset("nav footer aside head button select option datalist fieldset label input menu dialog "
                "object embed applet audio video canvas map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Words in a class or id that name a part which is not article text.
MARKS = frozenset("ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promotion "
                  "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside comment comments "
                  "commentlist disqus respond replies cookie cookies consent gdpr notice notices popup modal overlay "
                  "newsletter subscribe subscription signup login share sharing social related widget toolbar "
                  "pagination pager skip masthead disclaimer".split())
PAGE_MARKS = frozenset("header banner topbar".split())  # cut outside an article only
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARKS_ALL = MARKS | PAGE_MARKS
IN_HEAD = frozenset("base link meta title style script noscript template".split())
#: An opening tag ends an open element of the second set, up to an element of the third.
LIST, TABLE = frozenset("ul ol menu dl".split()), frozenset(["table"])
ENDS = {"li": (frozenset(["li"]), LIST), "dt": (frozenset(["dt", "dd"]), LIST), "dd": (frozenset(["dt", "dd"]), LIST),
        "tr": (frozenset(["tr", "td", "th"]), TABLE), "td": (frozenset(["td", "th"]), TABLE | {"tr"}),
        "th": (frozenset(["td", "th"]), TABLE | {"tr"}), "option": (frozenset(["option"]), frozenset(["select", "datalist"]))}
WORD = re.compile(r"[A-Za-z][a-z]*")
#: How an element is cut: not, unless it holds the core, unless hardly any text is beside it, always.
KEPT, PARTLY, MARKED, NEVER = range(4)
#: Share of the page's text beside marked elements from which on these go.
BESIDE = 0.05


def is_cut(tag: str, attributes: str, inside: bool) -> int:
    """How an element is cut; ``inside``: within an article or main element."""
    if tag in CUT or (tag == "header" and not inside):
        return NEVER
    found = MARKED if tag == "form" else KEPT
    if not attributes or tag in ("html", "body", "article", "main"):
        return found
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return NEVER
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return NEVER
        if name == "role" and value.lower() in ROLES:
            return NEVER
        if name in ("class", "id"):
            for token in value.split():
                words = {token.lower()} & MARKS_ALL or {w.lower() for w in WORD.findall(token)}
                marks = words & (MARKS if inside else MARKS_ALL)
                if marks and marks == words:
                    found = MARKED
                elif marks and tag not in HEADINGS:
                    found = max(found, PARTLY)
    return found


class Page:
    """Element tree in page order: parents, names and counts, and the flow of text and breaks."""

    def __init__(self, page: str):
        self.parent, self.tag = [-1], [""]
        self.cut, self.mark, self.inside = [False], [KEPT], [False]  # cut or inside: the element or one around it
        self.flow: list[tuple[int, str | None]] = []  # (element, text), None for a break
        self.body = 0
        stack, at = [0], 0
        while at < len(page):
            m = TOKEN.search(page, at)
            text = page[at: m.start() if m else len(page)]
            if text:
                if self.tag[stack[-1]] == "head" and not text.isspace():
                    stack.pop()
                self._flow(stack[-1], text)
            if not m:
                break
            at = m.end()
            name = m.group(2) or m.group(5)
            if not name:
                continue
            close, tag = bool(m.group(1) or m.group(4)), name.lower()
            if close:
                self._close(stack, tag)
                if tag not in INLINE:
                    self._flow(stack[-1], None)
                continue
            if self.tag[stack[-1]] == "head" and tag not in IN_HEAD:
                stack.pop()
            if tag == "body" and not self.body:
                if not self.cut[stack[-1]]:
                    self.body = self._open(stack[-1], tag)
                    stack.append(self.body)
                continue
            if tag in RAW:
                at = self._skip(page, at, tag, m.group(0).endswith("/>"))
                continue
            if tag in ("article", "main") and self.cut[stack[-1]]:
                k = next(k for k, i in enumerate(stack) if self.cut[i])
                if self.tag[stack[k]] in ("nav", "header", "footer"):
                    del stack[k:]  # an end tag was forgotten
            if tag not in INLINE:
                self._imply(stack, tag)
            if tag in VOID:
                self._flow(self._open(stack[-1], tag), None)
                continue
            cut = is_cut(tag, m.group(3) or m.group(6) or "", self.inside[stack[-1]])
            if tag not in INLINE:
                self._flow(stack[-1], None)
            if cut >= MARKED and m.group(0).endswith("/>"):
                continue
            stack.append(self._open(stack[-1], tag, cut))

    def _flow(self, i: int, text: str | None) -> None:
        if not self.cut[i]:
            self.flow.append((i, text))

    def _open(self, parent: int, tag: str, cut: int = KEPT) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.cut.append(self.cut[parent] or cut == NEVER)
        self.mark.append(KEPT if cut == NEVER else cut)
        self.inside.append(self.inside[parent] or tag in ("article", "main"))
        return len(self.tag) - 1

    def _close(self, stack: list[int], tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] == tag:
                # an inline end tag leaves the blocks in it open
                alone = tag in INLINE and any(self.tag[i] not in INLINE for i in stack[k:])
                del stack[k:k + 1 if alone else None]
                return
        if tag in ("body", "html"):
            del stack[next((k for k, i in enumerate(stack) if self.cut[i]), len(stack)):]

    def _imply(self, stack: list[int], tag: str) -> None:
        """End tags that a block's opening tag implies."""
        for k in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[k]]
            if t == "p":
                del stack[k:]
                break
            if t not in INLINE:
                break
        if tag in ENDS:
            ended, stop = ENDS[tag]
            low = None
            for k in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[k]]
                if t in stop:
                    break
                if t in ended:
                    low = k
            if low is not None:
                del stack[low:]

    @staticmethod
    def _skip(page: str, at: int, tag: str, closed: bool) -> int:
        """Where the page goes on behind an element whose content is no text."""
        foreign = tag in ("svg", "math")
        if foreign and closed:
            return at
        m = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
        return m.end() if m else at if foreign else len(page)

    def densities(self) -> tuple[list[int], list[int], list[float], list[float]]:
        """Of each element: the end of its subtree, characters, density, and the sum of its children's densities."""
        n = len(self.tag)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = self.tag[i] == "a" or in_link[self.parent[i]]
        for i, text in self.flow:
            if text is not None:
                c = len(SPACE.sub(" ", text).strip(" "))
                chars[i] += c
                if in_link[i]:
                    link_chars[i] += c
        last = list(range(1, n + 1))
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            chars[p] += chars[i]
            tags[p] += tags[i] + (not self.cut[i])
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i] + (self.tag[i] == "a" and not self.cut[i])
            last[p] = max(last[p], last[i])
        b = self.body
        ratio = link_chars[b] / max(chars[b], 1)
        density, total = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            c = chars[i]
            if c:
                link = max(link_chars[i], 1)
                base = math.log(c / max(c - link_chars[i], 1) * link + ratio * c + math.e)
                t = max(tags[i], 1)
                density[i] = c / t * math.log(c / link * t / max(link_tags[i], 1)) / math.log(base)
            if i:
                total[self.parent[i]] += density[i]
        return last, chars, density, total

    def _path(self, i: int) -> list[int]:
        """The element and those around it, up to the body."""
        path = [i]
        while i != self.body and i > 0:
            i = self.parent[i]
            path.append(i)
        return path

    def settle(self) -> None:
        """Cuts the marked elements, but not those around the core of the page."""
        last, chars, _, total = self.densities()
        over = list(self.mark)  # the strongest mark of the element and those around it
        for i in range(1, len(over)):
            over[i] = max(over[i], over[self.parent[i]])
        whole = beside = 0
        for i, t in self.flow:
            if t is not None:
                c = len(SPACE.sub(" ", t).strip(" "))
                whole += c
                beside += c if over[i] < MARKED else 0
        text = [i for i in range(self.body, last[self.body]) if chars[i]]
        if beside >= BESIDE * whole:
            text = [i for i in text if over[i] < MARKED]
        main = [i for i in text if self.inside[i] and not self.inside[self.parent[i]]]
        main = [i for i in main if not over[i]] or main
        may = set(text)
        pick = [i for m in main for i in range(m, last[m]) if i in may] or text
        core = max(pick, key=total.__getitem__, default=self.body)
        held = set(self._path(core))
        for i in range(1, len(over)):
            self.cut[i] = self.cut[i] or self.cut[self.parent[i]] or (self.mark[i] != KEPT and i not in held)
        self.flow = [(i, t) for i, t in self.flow if not self.cut[i]]

    def select(self, semantic: bool = False) -> list[tuple[int, int]]:
        """Disjoint ranges [first, last) of elements, in order: the subtrees that hold the article."""
        if any(self.mark):
            self.settle()
        last, chars, density, total = self.densities()
        b = self.body
        block = [i == b or t not in INLINE for i, t in enumerate(self.tag)]
        best = list(range(len(block)))  # the block of highest sum in each subtree, the outermost of equal ones
        for i in range(last[b] - 1, b, -1):
            p = self.parent[i]
            if block[i] and (total[best[i]], -best[i]) > (total[best[p]], -best[p]):
                best[p] = best[i]
        core = best[b]
        path = self._path(core)
        for i in path:
            if semantic and self.tag[i] in ("article", "main"):
                return [(i, last[i])]
        threshold = min(density[i] for i in path)
        # from the body down, an element that reaches the threshold gives its block of highest sum
        reached, found = {self.parent[b]}, []
        for i in range(b, last[b]):
            if block[i] and chars[i] and density[i] >= threshold and self.parent[i] in reached:
                reached.add(i)
                found.append((best[i], last[best[i]]))
        starts = {first for first, _ in found}
        for i in range(last[b] - 1, b, -1):  # a heading goes with the block behind it
            if self.tag[i] in HEADINGS and chars[i] and self.parent[i] in reached:
                j = last[i]
                while j < last[b] and self.parent[j] == self.parent[i] and not chars[j]:
                    j = last[j]
                if j < last[b] and self.parent[j] == self.parent[i] and any(f in starts for f in range(j, last[j])):
                    starts.add(i)
                    found.append((i, last[i]))
        spans: list[tuple[int, int]] = []
        for first, end in sorted(found):
            if not spans or first >= spans[-1][1]:
                spans.append((first, end))
            elif end > spans[-1][1]:
                spans[-1] = (spans[-1][0], end)
        return spans

    def text(self, semantic: bool = False) -> str:
        chosen = [False] * len(self.tag)
        for first, last in self.select(semantic):
            chosen[first:last] = [True] * (last - first)
        # breaks of elements left out part the blocks, too
        parts = [" " if t is None else t for i, t in self.flow if t is None or chosen[i]]
        return SPACE.sub(" ", html.unescape("".join(parts))).strip(" ")


def main_text(page: str | None, semantic: bool = False) -> str:
    return Page(page).text(semantic) if page else ""


def html_density(df: DataFrame, html_col: str = "html", carry: bool = True, semantic: bool = False) -> DataFrame:
    """The input with ``text`` and ``n_chars``; ``carry=False`` drops the page.

    ``semantic`` trusts article and main elements: the one around the core is the result as it is.
    """
    src = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("text", "n_chars")])
    keep = [c for c in src.columns if carry or c != html_col]
    schema = StructType([*[src.schema[c] for c in keep], StructField("text", StringType()),
                         StructField("n_chars", LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, html_col, SLICE):
            texts = [main_text(p, semantic) for p in b.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return src.mapInArrow(work, schema)
