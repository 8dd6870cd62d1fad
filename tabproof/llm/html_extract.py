"""Main text of web pages by consensus of each host's pages.

Two passes over the pages with a vote between them. The first parses every page, scores
its containers and lets each container's generalised tag-class path collect the score.
Votes are added up per task, then per host in Spark, and the path with the most wins. The
second pass parses the pages again and takes all containers at the winning path, with the
text that stands beside them in no container of its own; a page without such containers
uses its own best path. Hosts with many pages are no hot keys:
votes are combined before the shuffle, and the table of winners has one row per host.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabproof.llm.spool import spool
from tabproof.llm.url_filter import url_host

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.DOTALL)
_ATTRIBUTE = re.compile(
    r"""([A-Za-z_:][\w:.-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")

#: Elements whose content is read as plain characters up to their end tag, and is no text.
_RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE)
        for name in ("script", "style", "textarea", "title", "xmp", "noscript", "iframe")}
#: Nesting that is followed; what lies deeper counts as lying at this depth, as in browsers.
DEPTH = 512
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby "
    "rb rp rt s samp small span strike strong sub sup time tt u var".split())
_CONTAINERS = frozenset("article body center div main root section table tbody td tr".split())
#: Elements that end an open one of the same list, as far up as an element of the third.
_CLOSES = {
    **dict.fromkeys(("li",), (("li",), ("ul", "ol", "menu"))),
    **dict.fromkeys(("dt", "dd"), (("dt", "dd"), ("dl",))),
    **dict.fromkeys(("td", "th"), (("td", "th"), ("tr", "table"))),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")),
    "option": (("option",), ("select",)),
}
_NOT_TEXT = frozenset(
    "head nav footer aside form button select svg canvas template dialog menu object audio video "
    "math map fieldset".split())
_NOT_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar tablist".split())
#: What may stand in a head; anything else ends it, as in browsers.
_IN_HEAD = frozenset("base basefont bgsound link meta template".split()) | _RAW.keys()
#: Class and id words of what is not the article. The first kind may sit on a wrapper of the
#: whole page ("with-sidebar"), so an article or main element inside undoes it. So may the
#: second ("social-layout"): it does not count on what holds the main element or the page's
#: first article. If no text is left, no class or id word counts.
_LAYOUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner nav navbar navigation menu menus "
    "sidebar aside header footer masthead topbar toolbar widget widgets skip breadcrumb breadcrumbs "
    "pagination pager modal popup overlay cookie cookies consent gdpr notice notices notification "
    "alert login signup search".split())
_EXTRA_WORDS = frozenset(
    "comment comments commentlist respond disqus reply replies related recommended recommendations "
    "share sharing social sponsor sponsored sponsors promo promos promotion newsletter subscribe "
    "subscription adsense doubleclick taboola outbrain".split())
#: Classes that make an article of itself, whatever else its classes say.
_ARTICLE_CLASSES = frozenset("article entry post story".split())
#: Share of a page's text that a path holds at least where its elements' names count for it.
HINTED_SHARE = 0.8
_GOOD_WORDS = frozenset("article content post entry story text body main".split())


class Page:
    """Blocks and scored containers of one page."""

    def __init__(self, html: str) -> None:
        self._read(html, frozenset(), True)
        if self.wrappers:
            self._read(html, frozenset(self.wrappers), True)
        if self.worded and not any(not self.bad[node] for node, _, _ in self.blocks):
            self._read(html, frozenset(), False)

    def _read(self, html: str, wrappers: frozenset[int], by_words: bool) -> None:
        """Parse and score, without the class words of ``wrappers`` or of all elements."""
        #: Elements whose class words do not count, known before and found here.
        self.cleared, self.wrappers, self.by_words = wrappers, set(), by_words
        #: Whether a class word has left anything out, and whether an article has come.
        self.worded = self.article_seen = False
        #: The element whose class word of the second kind leaves this one out, or -1.
        self.sources = [-1]
        self.parents = [-1]
        self.tags = ["root"]
        self.paths = [""]
        self.hints = [0.8]
        #: 0 is text, 1 is left out by a class word, 2 by one of the second kind or for good.
        self.bad = [0]
        #: Element, text and characters inside links of each block.
        self.blocks: list[tuple[int, str, int]] = []
        self._parse(html)
        self._score()

    def _parse(self, html: str) -> None:
        stack = [0]
        head_over = False
        pieces: list[str] = []
        owner = 0
        links = linked = 0

        def flush() -> None:
            nonlocal pieces, linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self.blocks.append((owner, text, min(linked, len(text))))
                pieces, linked = [], 0

        def characters(piece: str) -> None:
            nonlocal owner, linked
            if self.tags[stack[-1]] == "head" and not piece.isspace():
                end_head()
            if self.bad[stack[-1]] == 2:
                return
            if "&" in piece:
                piece = entities.unescape(piece)
            if not pieces:
                owner = stack[-1]
                if piece.isspace():
                    return
            pieces.append(piece)
            if links:
                linked += len(piece)

        def close_to(depth: int) -> None:
            nonlocal links
            for node in stack[depth:]:
                links -= self.tags[node] == "a"
            del stack[depth:]

        def end_head() -> None:
            nonlocal head_over
            head_over = True
            for depth in range(1, len(stack)):
                if self.tags[stack[depth]] == "head":
                    flush()
                    close_to(depth)
                    break

        at, size = 0, len(html)
        while at < size:
            match = _TOKEN.search(html, at)
            if match is None:
                characters(html[at:])
                break
            if match.start() > at:
                characters(html[at:match.start()])
            at = match.end()
            tag = match[2]
            if tag is None:
                continue
            tag = tag.lower()
            inline = tag in _INLINE
            if match[1]:
                if tag == "br":
                    flush()
                    continue
                for depth in range(len(stack) - 1, 0, -1):
                    open_tag = self.tags[stack[depth]]
                    if open_tag == tag:
                        if not inline:
                            flush()
                        close_to(depth)
                        break
                    if inline and open_tag not in _INLINE:
                        break
                else:
                    if not inline:
                        flush()
                continue
            if tag == "head" and (head_over or "head" in map(self.tags.__getitem__, stack)):
                continue
            if tag == "body" or (
                    self.tags[stack[-1]] == "head" and tag not in _IN_HEAD and tag != "html"):
                end_head()
            if tag in _RAW:
                end = _RAW[tag].search(html, at)
                at = size if end is None else html.find(">", end.end()) + 1 or size
                continue
            if not inline:
                if tag not in ("img", "wbr", "input", "embed", "source", "track"):
                    flush()
                if tag in _VOID:
                    continue
                self._imply(tag, stack, close_to)
            elif tag in _VOID:
                continue
            if tag in ("html", "body") or len(stack) > DEPTH:
                continue  # the root stands for html and body
            stack.append(self._open(tag, match[3], stack[-1]))
            links += tag == "a"
        flush()

    def _imply(self, tag: str, stack: list[int], close_to) -> None:
        """End tags that ``tag`` stands for."""
        for depth in range(len(stack) - 1, 0, -1):
            name = self.tags[stack[depth]]
            if name == "p":
                close_to(depth)
                break
            if name not in _INLINE:
                break
        if tag in _CLOSES:
            ended, scope = _CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                name = self.tags[stack[depth]]
                if name in scope:
                    break
                if name in ended:
                    close_to(depth)
                    break

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        bad, hint = self.bad[parent], 1.0
        classes: list[str] = []
        words: set[str] = set()
        role = ""
        source = self.sources[parent]
        if attributes and attributes.strip("/ \t\r\n"):
            for match in _ATTRIBUTE.finditer(attributes):
                name = match[1].lower()
                value = match[2] or match[3] or match[4] or ""
                if name in ("class", "id"):
                    if name == "class":
                        classes = value.split()
                    words.update(re.findall("[a-z]+", _CAMEL.sub(" ", value).lower()))
                elif name == "role":
                    role = value.strip().lower()
                elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
                        name == "style" and re.search(r"display\s*:\s*none", value)):
                    bad, source = 2, -1
                elif name == "itemprop" and value == "articleBody":
                    hint = 1.5
        main = tag in ("article", "main") or role == "main"
        inside = any(self.tags[n] in ("article", "main") for n in self._up(parent)) if (
            tag == "header" or "header" in words) else False
        if not self.by_words or len(self.tags) in self.cleared:
            classes_said, words = frozenset(), words & _GOOD_WORDS
        else:
            classes_said = frozenset(c.lower() for c in classes)
        first = (role == "main" or tag == "main") or (tag == "article" and not self.article_seen)
        own = bool(words & _EXTRA_WORDS) or "hidden" in classes_said
        if main and own and first and (tag != "article" or classes_said & _ARTICLE_CLASSES):
            own = False
        if tag in _NOT_TEXT or role in _NOT_TEXT_ROLES or (tag == "header" and not inside):
            bad, source = 2, -1
        elif own:
            if bad < 2 or source >= 0:
                bad, source = 2, len(self.tags)
            self.worded = True
        elif main:
            hint = 1.5
            if bad == 2 and source >= 0 and (first or source in self.wrappers):
                self._clear(source)
                bad, source = 0, -1
            bad = 0 if bad == 1 else bad
            self.article_seen = self.article_seen or not bad
        elif bad == 0 and words & _LAYOUT_WORDS and not (
                inside and not words & (_LAYOUT_WORDS - {"header"})):
            bad = 1
            self.worded = True
        elif hint == 1.0 and words & _GOOD_WORDS:
            hint = 1.25
        path = self.paths[parent]
        if tag not in _INLINE:
            name = ".".join([tag, *sorted(_DIGITS.sub("N", c) for c in classes)])
            path = f"{path}>{name}" if path else name
        self.parents.append(parent)
        self.tags.append(tag)
        self.paths.append(path)
        self.hints.append(hint)
        self.bad.append(bad)
        self.sources.append(source)
        return len(self.tags) - 1

    def _clear(self, node: int) -> None:
        """Take ``node``, and what it is left out by itself, for wrappers of the page."""
        while node > 0:
            source = self.sources[node]
            if source == node:
                self.wrappers.add(node)
            elif source > 0:
                self.wrappers.add(source)
            node = self.parents[node]

    def _up(self, node: int) -> Iterator[int]:
        while node >= 0:
            yield node
            node = self.parents[node]

    def _score(self) -> None:
        """Score of each path: its containers' share of the page's text, how little else they
        hold, and what their elements say. Containers of one path never hold each other."""
        mass: dict[int, int] = defaultdict(int)
        held: dict[int, int] = defaultdict(int)
        for node, text, linked in self.blocks:
            good = 0 if self.bad[node] else len(text) - linked
            for above in self._up(node):
                mass[above] += good
                held[above] += len(text)
        whole = mass.get(0, 0)
        self.parts: dict[str, list[int]] = defaultdict(list)
        for n in held:
            if not self.bad[n] and self.tags[n] in _CONTAINERS:
                self.parts[self.paths[n]].append(n)
        self.scores = {}
        for path, nodes in self.parts.items():
            good, all_ = sum(mass[n] for n in nodes), sum(held[n] for n in nodes)
            if good:
                share, hint = good / whole, max(self.hints[n] for n in nodes)
                self.scores[path] = (hint if share >= HINTED_SHARE else min(hint, 1.0)) * share * (good / all_)

    def votes(self) -> dict[str, float]:
        """Score per path."""
        return self.scores

    def text(self, path: str | None) -> str:
        """Blocks of the containers at ``path``, else at the page's best path.

        Loose text of the elements around them, such as a title or a lead, and a main
        heading if they have none, belong to them. Without a score all text is taken.
        """
        if path not in self.scores:
            path = max(((s, self.parts[p][0], p) for p, s in self.scores.items()), default=(0, 0, ""))[2]
        parts = {*self.parts.get(path, (0,))}
        around = {above for n in parts for above in self._up(n)}
        inside, nearest, headed = [0 in parts], [0], [False]
        for n in range(1, len(self.tags)):
            above = self.parents[n]
            inside.append(inside[above] or n in parts)
            nearest.append(n if self.tags[n] in _CONTAINERS else nearest[above])
            headed.append(headed[above] or self.tags[n] == "h1")
        untitled = not any(inside[n] and headed[n] and not self.bad[n] for n, _, _ in self.blocks)
        return "\n".join(text for n, text, _ in self.blocks if not self.bad[n] and (
            inside[n] or nearest[n] in around or (untitled and headed[n])))


def _host_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: the winning path of each host."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally: dict[tuple[str, str], int] = defaultdict(int)
            for host, html in zip(batch.column(0), batch.column(1), strict=True):
                for path, score in Page(html.as_py()).votes().items():
                    # Whole numbers add up to the same sum in any order.
                    tally[host.as_py(), path] += round(score * 1_000_000)
            keys = [*tally]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([*tally.values()], pa.int64())], ["host", "path", "votes"])

    sites = pages.where("host != '' AND html IS NOT NULL").select("host", "html")
    counted = sites.mapInArrow(vote, "host string, path string, votes bigint")
    counted = counted.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return counted.groupBy("host").agg(
        F.max_by("path", F.struct("votes", "path")).alias("path"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, path`` of every page; ``path`` is its host's.

    ``text`` joins the article's blocks, of all its parts, by newlines in page order. Null html counts as
    empty; a page without article text gets an empty text. A page whose url names no host
    uses its own best container. Repeated pages get a row each (and vote each), an empty
    table gives none; other columns are not looked at.
    """
    pages = pages.select("page_id", "url", url_host(F.col("url")).alias("host"), "html")
    winners = spool(_host_paths(pages), "host-paths")
    winners = winners.select(F.col("host").alias("of_host"), "path")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(html.as_py() or "").text(path.as_py())
                     for html, path in zip(batch.column("html"), batch.column("path"), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64()), batch.column("path")],
                ["page_id", "url", "text", "n_chars", "path"])

    kind = pages.schema["page_id"].dataType.simpleString()
    joined = pages.join(winners, F.col("host") == F.col("of_host"), "left")
    return joined.select("page_id", "url", "html", "path").mapInArrow(
        extract, f"page_id {kind}, url string, text string, n_chars bigint, path string")
