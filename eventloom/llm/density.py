"""Main text of web pages by composite text density.

Per page: cut the markup into tags and texts, build the tree of block elements, count characters, tags, link characters and link tags below
each node, and take the subtree whose children have the greatest sum of densities; other parts count as content when
their density reaches the least density on the path from the body to that subtree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_slices

RAW = "script|style|iframe|textarea"  # their end tag or, without one, the end of the page ends them
TOKENS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>|<[!?/][^>]*+>|<[a-z/!?][^<>]*+\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
CONTROL = re.compile(r"<(?:input|select|textarea|button)(?=[\s/>])|(?P<last></label\s*+>)", re.I)

# fixed values: element names of HTML
CUT = frozenset("template noscript svg math select object canvas head title".split())
BLOCKS = frozenset(
    "body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption "
    "address details summary fieldset form nav header footer aside menu dialog center hr html hgroup".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside menu dialog button fieldset input".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
KEEPS_HEADER = frozenset(("article", "main"))
FLOW = "|".join(sorted(BLOCKS, key=len, reverse=True))
IN_HEAD = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|title|textarea|iframe|noscript|template)(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)|(?P<last></head\s*+>)|(?P<flow><(?:{FLOW})(?=[\s/>]))",
    re.S | re.I,
)
IN_DRAWING = re.compile(rf"(?P<inner><(?:foreignobject|desc|title|annotation-xml|m[ionst]|mtext)(?=[\s/>]))|(?P<last></(?:svg|math)\s*+>)|(?P<flow></?(?:{FLOW})(?=[\s/>]))", re.I)

# class, id and role words of what is not the article
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar aside menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead cookie cookies consent notice notices gdpr alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social comment comments reply replies respond disqus related recommended recommendations widget widgets toolbar pagination pager search complementary contentinfo".split()
)
COMMENTS = frozenset("comment comments reply replies respond disqus".split())
SPLIT = re.compile(r"[^a-z0-9]+")


def attributes(raw: str) -> dict[str, str]:
    """Names and values of a start tag, both in lower case; of repeated names the first counts."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw) if not raw.isspace() else ():
        found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    return found


def furniture(tag: str, attrs: dict[str, str], within: list[str]) -> bool:
    """Whether an element is a menu, header, footer or sidebar by its tag, or hidden."""
    if tag in DROPPED or (tag == "header" and not KEEPS_HEADER.intersection(within)):
        return True
    return bool(attrs) and ("hidden" in attrs or attrs.get("aria-hidden") == "true" or NO_DISPLAY.search(attrs.get("style", "")) is not None)


def furniture_names(attrs: dict[str, str]) -> frozenset[str]:
    """Furniture words of those class tokens, ids and roles that consist of nothing else (``sidebar``, ``ad-banner``; not ``has-sidebar``)."""
    found: set[str] = set()
    for name in ("class", "id", "role"):
        for token in attrs.get(name, "").split():
            parts = set(SPLIT.split(token)) - {""}
            if FURNITURE.issuperset(parts):
                found |= parts
    return frozenset(found)


def of_comment(attrs: dict[str, str]) -> bool:
    return any(COMMENTS.intersection(SPLIT.split(attrs.get(name, ""))) for name in ("class", "id", "role"))


def labels_control(source: str, at: int, attrs: dict[str, str]) -> bool:
    """Whether the label that opens at ``at`` belongs to a form control; other labels are running text."""
    found = None if "for" in attrs else CONTROL.search(source, at)
    return "for" in attrs or (found is not None and not found["last"])


class Page:
    """Block tree of a page: parallel lists, one entry per node, in document order; node 0 is the body."""

    def __init__(self, source: str):
        self.tags, self.parents, self.skipped = ["body"], [-1], [False]
        self.names, self.main = [frozenset()], [False]  # furniture words; whether it is an article or main, but not of a comment
        self.chars, self.marks, self.link_chars, self.link_marks = [0], [0], [0], [0]
        self.runs: list[tuple[int, int, str]] = []  # node, block, text
        self.headed, self.unclosed = False, set()  # a head was read; elements of which no end tag is ahead
        self._read(source)
        if any(self.names) or "form" in self.tags:
            self._skip_named()

    def _read(self, source: str) -> None:
        open_nodes, link, block, at = [0], False, 0, 0
        while token := TOKENS.search(source, at):
            if token.start() > at:
                self._text(open_nodes[-1], block, source[at : token.start()], link)
            at = token.end()
            tag = token["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            node = open_nodes[-1]
            if tag in CUT and not token["end"]:
                at = self._behind(tag, source, at, token["attrs"])
                continue
            if token["end"]:
                if tag == "a":
                    link = False
                names = [self.tags[i] for i in open_nodes]
                if tag in names[1:]:
                    while self.tags[open_nodes.pop()] != tag:
                        pass
                    block += 1
                    link = False
                elif tag in BLOCKS:
                    block += 1
                continue
            if tag in ("html", "body"):
                continue
            if tag == "br":
                self.runs.append((node, block, " "))
            if tag == "hr":
                block += 1
            if tag in VOID:
                self.marks[node] += 1
                continue
            raw = token["attrs"]
            attrs = attributes(raw) if raw else {}
            is_block = tag in BLOCKS
            if is_block:
                link = False
                block += 1
                closed = CLOSES.get(tag, {"p"}) | {"p"}
                while len(open_nodes) > 1 and self.tags[open_nodes[-1]] in closed:
                    open_nodes.pop()
                node = open_nodes[-1]
            drop = furniture(tag, attrs, [self.tags[i] for i in open_nodes] if tag == "header" else []) or (tag == "label" and labels_control(source, at, attrs))
            names = frozenset() if drop or tag in KEEPS_HEADER else furniture_names(attrs)
            if is_block or ((drop or names) and not raw.endswith("/")):
                open_nodes.append(len(self.tags))
                self.tags.append(tag)
                self.parents.append(node)
                self.skipped.append(drop or self.skipped[node])
                self.names.append(names)
                self.main.append(tag in KEEPS_HEADER and not self.skipped[-1] and not of_comment(attrs))
                for counts in (self.chars, self.marks, self.link_chars, self.link_marks):
                    counts.append(0)
                self.marks[-1] = 1
                if tag == "a" and names:
                    link = True
                    self.link_marks[-1] = 1
            else:
                self.marks[node] += 1
                if tag == "a":
                    link = True
                    self.link_marks[node] += 1
        if at < len(source):
            self._text(open_nodes[-1], block, source[at:], link)

    def _skip_named(self) -> None:
        """Skip what is furniture by name: adverts, sidebars, notices, comment sections; and forms.

        A name that stands for most of the text is none (one of comments in an article only if nothing else is left there). The text is that of
        articles and main or, without any, of the page. An element that holds an article or main is not skipped for its name, and a form
        that holds one, or most of the text, is a wrapper.
        """
        inside = self.main[:]
        for i in range(1, len(self.tags)):
            inside[i] |= inside[self.parents[i]]
        texts = [0 if skip else n for n, skip in zip(self.chars, self.skipped)]
        in_articles = [n * own for n, own in zip(texts, inside)]
        articles = any(in_articles)
        texts = in_articles if articles else texts
        total, held, above = sum(texts), dict.fromkeys(FURNITURE, 0), [frozenset()]
        for i in range(len(self.tags)):
            if i:
                outer = above[self.parents[i]]
                above.append(outer | self.names[i] if self.names[i] else outer)
            if texts[i]:
                for name in above[i]:
                    held[name] += texts[i]
        cut = {name for name, n in held.items() if (n < total if articles and name in COMMENTS else 2 * n <= total)}
        holds, below = self.main[:], texts[:]
        for i in range(len(self.tags) - 1, 0, -1):
            holds[self.parents[i]] |= holds[i]
            below[self.parents[i]] += below[i]
        for i in range(1, len(self.tags)):
            named = not cut.isdisjoint(self.names[i]) or (self.tags[i] == "form" and 2 * below[i] <= total)
            self.skipped[i] |= self.skipped[self.parents[i]] or (not holds[i] and named)

    def _behind(self, tag: str, source: str, at: int, attrs: str) -> int:
        """Where the page goes on after the start tag that ends at ``at``, of an element that is cut whole.

        An open head ends at the first flow tag, a drawing is empty (``<svg />``) or ends there too unless it embeds HTML. Of any
        other element without an end tag only the start tag is cut.
        """
        if tag == "head":
            if self.headed:
                return at
            self.headed = True
            for m in IN_HEAD.finditer(source, at):
                if m["last"] or m["flow"]:
                    return m.end() if m["last"] else m.start()
                at = m.end()
            return at
        if tag in ("svg", "math"):
            if attrs.endswith("/") or "drawing" in self.unclosed:
                return at
            m = IN_DRAWING.search(source, at)
            if not m:
                self.unclosed.add("drawing")
                return at
            if not m["inner"]:
                return m.end() if m["last"] else m.start()
        if tag in self.unclosed:
            return at
        last = re.compile(rf"</{tag}\s*+>", re.I).search(source, at)
        if not last:
            self.unclosed.add(tag)
        return last.end() if last else at

    def _text(self, node: int, block: int, raw: str, link: bool) -> None:
        if self.skipped[node]:
            return
        text = unescape(raw) if "&" in raw else raw
        size = len(text.strip())
        self.chars[node] += size
        if link:
            self.link_chars[node] += size
        self.runs.append((node, block, text))

    def content(self) -> str:
        """Main text: blocks of the chosen subtrees in page order, one line each."""
        chosen = self._choose()
        if not chosen:
            return ""
        inside = [False] * len(self.tags)
        for i in range(len(self.tags)):
            inside[i] = not self.skipped[i] and (i in chosen or (i > 0 and inside[self.parents[i]]))
        lines: list[str] = []
        last, held = None, []
        for node, block, text in self.runs:
            if not inside[node]:
                continue
            if block != last:
                lines.append(" ".join("".join(held).split()))
                last, held = block, []
            held.append(text)
        lines.append(" ".join("".join(held).split()))
        return "\n".join(line for line in lines if line)

    def _choose(self) -> set[int]:
        n = len(self.tags)
        own = list(zip(self.chars, self.marks, self.link_chars, self.link_marks))
        chars, marks, link_chars, link_marks = (list(x) for x in zip(*own))
        for i in range(n - 1, 0, -1):
            if not self.skipped[i]:
                p = self.parents[i]
                chars[p] += chars[i]
                marks[p] += marks[i]
                link_chars[p] += link_chars[i]
                link_marks[p] += link_marks[i]
        if not chars[0]:
            return set()
        ratio = link_chars[0] / chars[0]

        def density(c: int, t: int, lc: int, lt: int) -> float:
            if not c:
                return 0.0
            t, plain = max(t, 1), max(c - lc, 1)
            inner = max(c / max(lc, 1) * t / max(lt, 1), 1.0)
            return c / t * log(inner) / log(log(c / plain * lc + ratio * c + e) + e - 1)

        dense = [density(*x) for x in zip(chars, marks, link_chars, link_marks)]
        sums = [density(*x) for x in own]  # a node's own text counts like a child
        for i in range(n - 1, 0, -1):
            if not self.skipped[i]:
                sums[self.parents[i]] += dense[i]
        alive = [i for i in range(n) if not self.skipped[i] and chars[i]]
        top = max(alive, key=lambda i: (sums[i], -i))
        if not sums[top]:
            return set()
        path = [top]
        while path[-1]:
            path.append(self.parents[path[-1]])
        least = min(dense[i] for i in path)
        best = {i: (sums[i], -i, i) for i in alive}  # node of the greatest sum in each subtree
        for i in reversed(alive):
            if i and best[i][:2] > best[self.parents[i]][:2]:
                best[self.parents[i]] = best[i]
        reached = {0}
        for i in alive:
            if i and self.parents[i] in reached and dense[i] >= least:
                reached.add(i)
        chosen = {self._whole(best[i][2]) for i in reached}
        return {self._meeting(chosen)} if self._meeting(chosen) else chosen

    def _whole(self, node: int) -> int:
        """The outermost article or main element around a node, so that short sections of it are not lost; else the node."""
        found = node
        while node:
            if self.tags[node] in KEEPS_HEADER:
                found = node
            node = self.parents[node]
        return found

    def _meeting(self, nodes: set[int]) -> int:
        """The lowest node above all of these; 0 when only the body is."""
        common: set[int] | None = None
        for i in nodes:
            above = {i}
            while i:
                i = self.parents[i]
                above.add(i)
            common = above if common is None else common & above
        return max(common or {0})


def extract(html: str | None) -> str:
    """Main text of one page; null, empty and text-free pages give the empty string."""
    return Page(html).content() if html else ""


EXTRACT_SCHEMA = "page_id long, url string, text string, n_chars long"


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row; null ids and urls stay, repeated rows stay, other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, html):
            texts = [extract(x) for x in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64()),
            ], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", html).mapInArrow(run, EXTRACT_SCHEMA)
