"""Main text of web pages by composite text density.

A page is read into a flat element tree in document order (an element's subtree is a
contiguous range). Elements that can't be main text by their tag, role or a class or id
that says nothing else (menus, page headers, footers, forms, notices, adverts, reader
comments, scripts) are cut off; a name that only holds such a word is left to the
densities. Every other element gets its composite text density: characters per tag,
adjusted by a logarithm for characters and tags in links relative to the body's. An
element's density sum is the sum of its children's densities. The element with the
largest sum (taken up to its enclosing article, if any) is the first part of the text;
the least density on its path up to the body is the threshold, and every element
elsewhere that reaches the threshold adds the largest-sum element of its own subtree.
Link lists inside what was taken are left out.

Edge cases. Null and empty pages, and pages without main text, give an empty text.
Unclosed, stray and nested tags never fail; depth isn't limited by recursion. Repeated
rows are extracted alike. Text outside any element counts as the body's. White space
(Unicode) inside a block becomes one space; blocks are joined by one space.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|[^<]++|<", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PART = re.compile(r"[A-Za-z]+")

# Element names of HTML by their role in parsing and in texts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea title noframes svg".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"br", "option", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
HEAD_ONLY = frozenset("meta title link script style base noscript template".split())
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
CUT_TAGS = RAW | frozenset("head nav footer aside form button select menu dialog input label".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion banner cookie cookies consent gdpr notice notices"
    " disclaimer popup popover modal overlay lightbox newsletter subscribe subscription signup sidebar sidebars aside menu menus nav navbar navigation breadcrumb"
    " breadcrumbs crumbs footer masthead comment comments commentlist disqus reply replies respond feedback related recommended recommendations recirculation"
    " share sharing social widget widgets toolbar pagination pager paginator login signin search searchbox copyright skip skiplink taboola outbrain paywall".split()
)
KEEP_WORDS = frozenset("article content main body post entry story text".split())
STRONG_WORDS = frozenset("comment comments ad ads sidebar footer menu nav".split())
#: Words that add nothing to what a name says.
PLAIN_WORDS = KEEP_WORDS | frozenset(
    "area bar block bottom box button col column container data group holder inline inner item items left level link links list module outer page panel posts"
    " primary right row secondary section site slot text thread title top unit wrap wrapper header".split()
)


def _names_boilerplate(value: str, in_article: bool) -> bool:
    """Whether one of the names in a class or id says that an element isn't main text, and nothing else."""
    for name in value.split():
        words = {w.lower() for w in _PART.findall(_HUMP.sub(" ", name))}
        if words <= PLAIN_WORDS:
            if "header" in words and not in_article and not words & KEEP_WORDS:
                return True
        elif words <= CUT_WORDS | PLAIN_WORDS and (words & STRONG_WORDS or not words & KEEP_WORDS):
            return True
    return False


def _cut(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element can't be main text."""
    if tag in CUT_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), entities.unescape(value.strip("\"'"))
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif name == "role":
            if not CUT_ROLES.isdisjoint(value.lower().split()):
                return True
        elif name in ("class", "id") and tag not in ("article", "main", "p", "h1") and _names_boilerplate(value, in_article):
            return True
    return False


class Page:
    """The flat element tree of a page."""

    def __init__(self, html: str):
        self.tags, self.parents, self.ends, self.dropped = ["body"], [-1], [0], [False]
        self.events: list[tuple[int, str | None]] = []  # (element, text), or (element, None) at a block's edge
        self.chars, self.links = [0], [0]
        self._read(html)

    def _open(self, tag: str, parent: int, cut: bool) -> int:
        self.tags.append(tag), self.parents.append(parent), self.ends.append(0), self.dropped.append(cut)
        self.chars.append(0), self.links.append(0)
        return len(self.tags) - 1

    def _read(self, html: str) -> None:
        stack, tags, at, size = [0], self.tags, 0, len(html)
        open_: Counter = Counter()  # how many elements of each name the stack holds
        articles = links = 0

        def close(depth: int) -> None:
            nonlocal articles, links
            while len(stack) > depth:
                node = stack.pop()
                open_[tags[node]] -= 1
                self.ends[node] = len(tags)
                articles -= tags[node] in ("article", "main")
                links -= tags[node] == "a"
                if tags[node] in BLOCK:
                    self.events.append((node, None))

        while at < size:
            m = _TOKEN.match(html, at)
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                text = m[0]
                if text[0] == "<" and len(text) > 1:
                    continue
                node = stack[-1]
                if self.dropped[node]:
                    continue
                if "&" in text:
                    text = entities.unescape(text)
                self.events.append((node, text))
                if n := len(text.strip()):
                    self.chars[node] += n
                    if links:
                        self.links[node] += n
                continue
            tag = tag.lower()
            if m[1] or m[4]:  # an end tag
                if open_[tag] > 0:
                    depth = len(stack) - 1
                    while tags[stack[depth]] != tag:
                        depth -= 1
                    close(depth)
                elif tag == "p":
                    self.events.append((stack[-1], None))
                continue
            attributes = (m[3] or m[6] or "").strip()
            if tag in ("html", "body"):
                while len(stack) > 1 and tags[stack[-1]] == "head":
                    close(len(stack) - 1)
                continue
            if tags[stack[-1]] == "head" and tag not in HEAD_ONLY:
                close(len(stack) - 1)
            if tag in CLOSES_P and open_["p"] > 0:
                for depth in range(len(stack) - 1, 0, -1):
                    if tags[stack[depth]] == "p":
                        close(depth)
                        break
                    if tags[stack[depth]] in BLOCK:
                        break
            if tag in CLOSED_BY and any(open_[t] > 0 for t in CLOSED_BY[tag][0]):
                ended, bounds = CLOSED_BY[tag]
                found = 0
                for depth in range(len(stack) - 1, 0, -1):
                    if tags[stack[depth]] in ended:
                        found = depth
                    elif tags[stack[depth]] in bounds:
                        break
                if found:
                    close(found)
            elif tag == "a" and links:  # links don't nest
                for depth in range(len(stack) - 1, 0, -1):
                    if tags[stack[depth]] == "a":
                        close(depth)
                        break
                    if tags[stack[depth]] in BLOCK:
                        break
            parent = stack[-1]
            if tag in BLOCK:
                self.events.append((parent, None))
            node = self._open(tag, parent, self.dropped[parent] or _cut(tag, attributes, articles > 0))
            if tag in VOID or (attributes.endswith("/") and tag == "svg"):
                self.ends[node] = len(tags)
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = end.end() if end else size
                self.ends[node] = len(tags)
                continue
            stack.append(node)
            open_[tag] += 1
            articles += tag in ("article", "main")
            links += tag == "a"
        close(0)

    def densities(self) -> tuple[list[float], list[float], list[int], list[int]]:
        """Density and density sum of each element; characters and link characters of its subtree."""
        n = len(self.tags)
        chars, links, below, below_links = self.chars[:], self.links[:], [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            if self.dropped[i]:
                continue
            p = self.parents[i]
            chars[p] += chars[i]
            links[p] += links[i]
            below[p] += below[i] + 1
            below_links[p] += below_links[i] + (self.tags[i] == "a")
        ratio = links[0] / max(1, chars[0])
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n):
            if self.dropped[i] or not chars[i]:
                continue
            c, t, lc, lt = chars[i], max(1, below[i]), max(1, links[i]), max(1, below_links[i])
            d = c / t
            if links[0]:
                base = math.log(c / max(1, c - links[i]) * links[i] + ratio * c + math.e)
                inner = c / lc * t / lt
                d *= max(0.0, math.log(max(1.0, inner)) / math.log(base)) if base > 1.0001 else 1.0
            density[i] = d
            if i:
                sums[self.parents[i]] += d
        return density, sums, chars, links

    def text(self) -> str:
        if not self.events:
            return ""
        density, sums, chars, links = self.densities()
        n = len(self.tags)
        if not chars[0]:
            return ""
        best = max(range(n), key=lambda i: (sums[i], density[i], -i))
        if not sums[best]:
            best = 0
        top, up = best, best
        while up >= 0:
            if self.tags[up] in ("article", "main"):
                top = up
                if self.tags[up] == "article":
                    break
            up = self.parents[up]
        threshold, up = density[best], best
        while up >= 0:
            threshold = min(threshold, density[up])
            up = self.parents[up]
        marked = bytearray(n)
        marked[top : self.ends[top]] = b"\1" * (self.ends[top] - top)
        if top == best and self.tags[top] not in ("article", "main"):
            i = 1
            while i < n:  # elements elsewhere, in document order
                if marked[i] or self.dropped[i]:
                    i = max(i + 1, self.ends[i]) if self.dropped[i] else i + 1
                    continue
                around = i < top < self.ends[i]  # other marked elements lie before this one
                if not around and 2 * links[i] > chars[i]:  # a menu, whatever else it says
                    i = self.ends[i]
                elif not around and chars[i] and density[i] >= threshold:
                    take = max(range(i, self.ends[i]), key=lambda k: (sums[k], -k))
                    take = take if sums[take] > density[i] else i
                    marked[take : self.ends[take]] = b"\1" * (self.ends[take] - take)
                    i = self.ends[i]
                else:
                    i += 1
        # lists and boxes of links inside what was taken
        for i in range(1, n):
            if marked[i] and i != top and self.tags[i] in ("ul", "ol", "div", "section", "table", "dl") and links[i] > 0.6 * chars[i] and chars[i]:
                marked[i : self.ends[i]] = bytes(self.ends[i] - i)
        out: list[str] = []
        for node, text in self.events:
            if text is None:
                out.append(" ")
            elif marked[node] and not self.dropped[node]:
                out.append(text)
        return " ".join("".join(out).split())


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus text and n_chars (code points)."""
    added = ["text", "n_chars"]
    keep = [c for c in (pages.columns if keep is None else keep) if c not in added]
    source = pages.select(*keep, F.col(html_col).alias("__html"))
    n = len(keep)
    schema = T.StructType([*source.select(*keep).schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                texts = [main_text(h) for h in batch.column(n).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*keep, *added])

    return source.mapInArrow(run, schema)
