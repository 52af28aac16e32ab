"""Main text of web pages from the container that most pages of the host agree on.

1. Every page is read once: its containers (article, main, section, div, table cell, body) are named
   by generalised paths, tags with class names in which digits are one sign, and scored by the plain
   text below them that is no link, weighted by what kind of container it is.
2. Each page has one vote, shared among its containers by score; votes are summed by host and path,
   pre-aggregated on every partition, and each host's best path wins. The paths that are the best
   container of several pages of the host, and of a share of all, are kept with it, one a template.
   Elements that only look like boilerplate, by a word in their class or id or as a form, are left out
   after the page was read, and only if they do not hold its main text.
3. Every page is read again. Of the templates' paths, its text is taken from the one with the highest
   product of the pages that it is best on and the page's own score; a page without text in any takes
   the host's winner, and without that its own best container.

The table of winners joins on its measured size: small ones are broadcast by Spark, others are
shuffled with hot hosts split. A page is a row, so a host with a third of all pages is no group.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Workspace, ascii_lower

# The start of a comment, a tag or another declaration; the rest of a tag, a ">" in quotes doesn't end it.
_START = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*+)|[!?/])")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_STEP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# What is no text, what is no part of an article, and what begins a block (fixed values).
RAW = frozenset("script style noscript template iframe object svg title textarea select button canvas audio video".split())
#: Those whose content is no markup: without an end tag they last to the end of the page, of others the tag alone is left out.
RAW_TEXT = frozenset("script style title textarea iframe".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog head".split())
#: Boilerplate unless they hold the page's main text, as are elements with a listed word.
DOUBTFUL = frozenset(("form",))
CONTAINERS = frozenset("html body article main section div td".split())
BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption thead tbody tr figure figcaption hr address details"
    " summary center fieldset".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation"
    " breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices popup modal overlay newsletter subscribe"
    " signup share sharing social related recommended comment comments reply replies respond disqus widget widgets toolbar"
    " pagination pager login search alert toc skip hidden".split()
)
CONTENT_WORDS = frozenset("article content main post entry story text body page".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())
DOUBTFUL_ROLES = frozenset(("form",))
#: Words of what readers wrote, which may be most of a page; and words that say what a class is about, not what it is.
READER_WORDS = frozenset("comment comments reply replies respond disqus".split())
_ABOUT = re.compile(r"(?<![a-z])(?:no|not|has|have|with|without|is)[-_]+[-_a-z]+")
#: Plain characters from which a doubtful element without any other sign of content is taken for prose.
_PROSE = 200
#: Longer paths, as in pages of thousands of nested elements, begin with their depth and a digest.
_PATH_LETTERS = 1000
_STORY_WORDS = frozenset("article post entry story".split())
#: Share of a host's pages from which a container is taken for a template's.
TEMPLATE_PERCENT = 1
_CONTENT_FIRST = frozenset(("article", "main"))
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text.strip(" /\n\t") else {}


def _names(attributes: dict[str, str]) -> set[str]:
    return set(_WORDS.findall(_CAMEL.sub(" ", f"{attributes.get('class', '')} {attributes.get('id', '')}").lower()))


def _listed(text: str) -> set[str]:
    """Listed words of a class or id; has-sidebar and no-ads name none."""
    words = (_ABOUT.sub(" ", _CAMEL.sub(" ", word).lower()) for word in text.split())
    return set(_WORDS.findall(" ".join(words))) & BOILERPLATE_WORDS


def _is_boilerplate(tag: str, attributes: dict[str, str]) -> bool:
    """Whether all of an element is left out, whatever it holds."""
    if tag in BOILERPLATE - DOUBTFUL:
        return True
    if tag in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    role = attributes.get("role", "").lower()
    return role in BOILERPLATE_ROLES - DOUBTFUL_ROLES or "display:none" in attributes.get("style", "").replace(" ", "").lower()


class _Doubt:
    """An element that is boilerplate unless it holds the page's main text."""

    def __init__(self, tag: str, words: set[str], names: set[str], outer: int, in_main: bool, by_heading: bool):
        self.outer = outer  # the doubtful element around it, or -1
        self.in_main = in_main
        self.of_readers = bool(words & READER_WORDS)
        self.by_heading = by_heading  # a section in an article whose id may be made from its heading
        self.named = tag in _CONTENT_FIRST or bool(names & CONTENT_WORDS)  # named as content
        self.content = self.heading = False  # a container in it is named as content; it has the heading
        self.plain = self.linked = self.main = 0  # characters in it; those of article and main containers
        self.direct = 0  # plain characters that are in no doubtful element in it


def _doubt(tag: str, attributes: dict[str, str], names: set[str], outer: int, in_main: bool, in_story: bool) -> _Doubt | None:
    if tag in ("html", "body"):
        return None
    by_class, words = _listed(attributes.get("class", "")), _listed(f"{attributes.get('class', '')} {attributes.get('id', '')}")
    if tag in _CONTENT_FIRST and not words & {"comment", "comments", "ad", "ads", "advert", "related"}:
        words = set()
    if not words and tag not in DOUBTFUL and attributes.get("role", "").lower() not in DOUBTFUL_ROLES:
        return None
    a_section = tag == "section" or tag == "div" and "section" in attributes.get("class", "").split()
    return _Doubt(tag, words, names, outer, in_main, in_story and a_section and bool(words) and not by_class and not words & READER_WORDS)


def _weight(tag: str, attributes: dict[str, str], names: set[str]) -> float:
    if tag == "article" or attributes.get("itemprop") == "articleBody":
        return 1.5
    if tag == "main" or attributes.get("role") == "main":
        return 1.4
    if tag == "body":
        return 0.7
    if tag == "html":
        return 0.6
    return 1.3 if names & CONTENT_WORDS else 1.0


class _Scanner:
    """Tags, comments and declarations of a page one after the other, in time linear in the page.

    A tag of which the quotes are never closed ends at its first ">"; one without any ">" is text.
    """

    def __init__(self, source: str):
        self.source = source
        self.last = source.rfind(">")
        self.steps: list[int] = []  # places of quotes and ">", once a tag's quotes were not closed
        self.ends: list[int] = []  # where a tag ends of which the rest goes on there; -1 for nowhere

    def _know_ends(self, place: int) -> None:
        """From the end back: a quote is followed by what comes after the next one of its kind."""
        self.steps = [m.start() for m in _STEP.finditer(self.source, place)]
        n = len(self.steps)
        self.ends = [-1] * (n + 1)
        following = {'"': n, "'": n}
        for k in range(n - 1, -1, -1):
            sign = self.source[self.steps[k]]
            if sign == ">":
                self.ends[k] = self.steps[k]
            else:
                if following[sign] < n:
                    self.ends[k] = self.ends[following[sign] + 1]
                following[sign] = k

    def _end(self, place: int) -> int:
        if not self.ends:
            found = _REST.match(self.source, place)
            if found:
                return found.end() - 1
            self._know_ends(place)
        return self.ends[bisect.bisect_left(self.steps, place)]

    def after(self, place: int) -> tuple[int, int, str, str, str] | None:
        """Start, end, closing sign, name and rest of the next one; without a name it is no tag."""
        while found := _START.search(self.source, place):
            place = found.end()
            if found[0] == "<!--":
                end = self.source.find("-->", place)
                return found.start(), len(self.source) if end < 0 else end + 3, "", "", ""
            if place > self.last:
                continue
            end = self._end(place) if found[2] else -1
            if end < 0:
                end = self.source.find(">", place)
            return found.start(), end + 1, found[1] or "", found[2] or "", self.source[place:end]
        return None


class _Open(NamedTuple):
    """An open element: number of its path, whether all in it is left out, innermost doubtful element and outermost article or main around it (or -1)."""

    tag: str
    path: int
    skip: bool
    doubt: int
    main: int


_OUTSIDE = _Open("", 0, False, -1, -1)

#: Text, whether in a link, the innermost doubtful element and the outermost article or main around it (or -1).
_Piece = tuple[str, bool, int, int]


def _depth(path: str) -> int:
    known = _DIGEST.match(path)
    return path.count(">") + (int(known[1]) if known else 0)


_DIGEST = re.compile(r"#(\d+):")


class Page:
    """Blocks of text of one page, each with the number of the path of the container around it.

    Paths are numbered as they are met, so a container's number is above that of the one around it,
    and sums over containers are taken from the last number back: time and memory stay linear in the
    page, however deep it is nested. Number 0 is the page itself.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int]] = []
        self.scores: dict[str, float] = {}
        self._paths, self._numbers = [""], {"": 0}
        self._steps: dict[tuple[int, str], int] = {}
        self._around, self._weights, self._story = [-1], [0.5], [False]
        self._read_blocks: list[tuple[list[_Piece], int]] = []
        self._doubts: list[_Doubt] = []
        self._mains: list[int] = []  # innermost doubtful element around each article or main that is in no other
        self._read(source)
        kept = self._kept_doubts()
        self._linked, self._text = [0] * len(self._paths), [0] * len(self._paths)
        for pieces, path in self._read_blocks:
            self._end_block([p for p in pieces if p[2] < 0 or p[2] in kept] if self._doubts else pieces, path)
        del self._read_blocks
        for k in range(len(self._paths) - 1, 0, -1):
            self._text[self._around[k]] += self._text[k]
            self._linked[self._around[k]] += self._linked[k]
        for path, weight, n, linked in zip(self._paths, self._weights, self._text, self._linked, strict=True):
            if n:
                self.scores[path] = weight * (n - linked) * (n - linked) / n

    def _kept_doubts(self) -> set[int]:
        """The doubtful elements that hold main text: outer ones first, and none in one that is left out.

        Where an article or main has text, those that hold the greater part of it, and so are not cards
        beside the article; elsewhere, and in it, those with most of the page's plain text and a name,
        container or heading of content, or with nearly all of it. Sections of an article named by their
        id alone stay unless they are mostly links. If no plain text would be left, the one with most
        plain text that has such a name, container or heading or is prose.
        """
        if not self._doubts:
            return set()
        sure = total = main_total = 0  # sure: plain text in none but kept ones
        for pieces, _ in self._read_blocks:
            for text, in_link, k, main in pieces:
                n = len(text) if text.strip() else 0
                of_main = main >= 0 and k == self._mains[main] and not in_link
                if not in_link:
                    total += n
                    main_total += n if of_main else 0
                if k < 0:
                    sure += 0 if in_link else n
                elif in_link:
                    self._doubts[k].linked += n
                else:
                    self._doubts[k].direct += n
                    self._doubts[k].main += n if of_main else 0
        for doubt in reversed(self._doubts):
            doubt.plain += doubt.direct
            if doubt.outer >= 0:
                outer = self._doubts[doubt.outer]
                outer.plain, outer.linked, outer.main = outer.plain + doubt.plain, outer.linked + doubt.linked, outer.main + doubt.main
                outer.content, outer.heading = outer.content or doubt.content, outer.heading or doubt.heading
        kept: set[int] = set()
        by_share: list[tuple[int, int]] = []
        for k, doubt in enumerate(self._doubts):
            if doubt.outer >= 0 and doubt.outer not in kept or not doubt.plain:
                continue
            named = doubt.heading or (doubt.named or doubt.content) and not doubt.of_readers
            if doubt.main:
                keep = 2 * doubt.main >= main_total and 5 * doubt.plain >= doubt.plain + sure
            elif doubt.by_heading:
                keep = doubt.plain >= doubt.linked
            else:
                likely = named or doubt.plain >= _PROSE and not doubt.of_readers
                if main_total and not doubt.in_main:
                    likely = named and doubt.plain * 10 >= total * 9
                keep = likely and doubt.plain * 10 >= total * (5 if named else 9)
                if likely and not keep:
                    by_share.append((doubt.plain, -k))
            if keep:
                kept.add(k)
                sure += doubt.direct
        if not sure and by_share:
            kept.add(-max(by_share)[1])
        return kept

    def _end_block(self, pieces: list[_Piece], path: int) -> None:
        text = " ".join("".join(p[0] for p in pieces).split())
        if not text:
            return
        linked = sum(len(p[0]) for p in pieces if p[1])
        self.blocks.append((text, path))
        self._text[path] += len(text)
        self._linked[path] += min(linked, len(text))

    def _read(self, source: str) -> None:
        scanner = _Scanner(source)
        stack: list[_Open] = []
        tags: Counter[str] = Counter()  # of the open elements
        now = _OUTSIDE
        in_link = False
        parts: list[_Piece] = []
        place = 0
        no_end: set[str] = set()  # tags that have no end tag in the rest of the page

        def close(tag: str) -> None:
            nonlocal now
            while tags[tag]:
                one = stack.pop().tag
                tags[one] -= 1
                if one == tag:
                    break
            now = stack[-1] if stack else _OUTSIDE

        def end_block() -> None:
            nonlocal parts
            if parts:
                self._read_blocks.append((parts, now.path))
                parts = []

        while True:
            found = scanner.after(place)
            end = found[0] if found else len(source)
            if end > place and not now.skip:
                parts.append((html.unescape(source[place:end]), in_link, now.doubt, now.main))
            if not found:
                break
            _, place, closing, tag, rest = found
            if not tag:
                continue
            tag = tag.lower()
            if tag in RAW:
                if not closing and not rest.endswith("/") and tag not in no_end:
                    after = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(source, place)
                    if after or tag in RAW_TEXT:
                        place = after.end() if after else len(source)
                    else:
                        no_end.add(tag)
                parts.append((" ", False, now.doubt, -1))
            elif tag == "a":
                in_link = not closing
            elif tag in CONTAINERS or tag in BOILERPLATE or tag in ("ul", "ol", "table", "figure", "details", "p", "span", "tr", "li") and (now.skip or now.doubt >= 0 or "=" in rest):
                if tag != "span":
                    end_block()
                if closing:
                    close(tag)
                elif not rest.endswith("/"):
                    self._open(tag, rest, stack, tags)
                    now = stack[-1]
            elif tag in BLOCKS:
                end_block()
                if tag == "h1" and not closing:
                    if now.doubt >= 0:
                        self._doubts[now.doubt].heading = True
                if closing:
                    close(tag)
            elif tag in ("br", "th"):
                parts.append((" ", False, now.doubt, -1))
            elif tag == "span" and closing and stack and stack[-1].tag == "span":
                close(tag)
        end_block()

    def _open(self, tag: str, rest: str, stack: list[_Open], tags: Counter[str]) -> None:
        if tag in ("article", "main", "body"):  # ends what was left open before the content
            while any(tags[before] for before in ("nav", "head", "header", "menu")):
                tags[stack.pop().tag] -= 1
        elif tag in ("p", "li", "tr") and stack and stack[-1].tag == tag:
            tags[stack.pop().tag] -= 1
        tags[tag] += 1
        _, path, skip, outer, main = stack[-1] if stack else _OUTSIDE
        attributes = _attributes(rest)
        names = _names(attributes)
        skip = skip or _is_boilerplate(tag, attributes)
        if skip:
            stack.append(_Open(tag, path, True, outer, main))
            return
        doubt = _doubt(tag, attributes, names, outer, main >= 0, "id" in attributes and (main >= 0 or self._story[path]))
        inner = outer
        if doubt:
            inner = len(self._doubts)
            self._doubts.append(doubt)
        elif tag in CONTAINERS and tag != "body" and names & CONTENT_WORDS and outer >= 0:
            self._doubts[outer].content = True
        weight = _weight(tag, attributes, names)
        if weight >= 1.4 and main < 0 and not doubt:
            main = len(self._mains)
            self._mains.append(inner)
        if tag in CONTAINERS:
            classes = sorted({_DIGITS.sub("#", c) for c in attributes.get("class", "").split()})
            path = self._below(path, ".".join([tag, *classes]))
            self._weights[path] = max(self._weights[path], weight)
        stack.append(_Open(tag, path, False, inner, main))

    def _below(self, around: int, step: str) -> int:
        """The number of the path with one step more."""
        known = self._steps.get((around, step))
        if known is not None:
            return known
        number = self._steps[around, step] = len(self._paths)
        path = f"{self._paths[around]}>{step}" if around else step
        if len(path) > _PATH_LETTERS:
            path = f"#{_depth(path)}:{hashlib.md5(path.encode('utf-8', 'surrogatepass')).hexdigest()}"
        self._paths.append(path)
        self._numbers[path] = number
        self._around.append(around)
        self._weights.append(0.0)
        self._story.append(self._story[around] or bool(set(_WORDS.findall(step.lower())) & _STORY_WORDS))
        return number

    def best(self) -> str:
        """The path of the highest score; of equal ones the deepest, then the first by name."""
        return min(self.scores, key=lambda p: (-self.scores[p], -_depth(p), p), default="")

    def _has_text(self, path: str) -> bool:
        return path in self._numbers and self._text[self._numbers[path]] > 0

    def of_host(self, winner: str | None, templates: list[tuple[str, int]]) -> str:
        """The path to take the text from, given the host's winner and its templates' paths with their pages."""
        fits = [(-pages * self.scores[path], -_depth(path), path) for path, pages in templates if self.scores.get(path)]
        if fits:
            return min(fits)[2]
        return winner if winner is not None and self._has_text(winner) else self.best()

    def text(self, path: str | None = None) -> str:
        """Blocks below a path, or below the page's own best one if it has no text there."""
        if path is None or not self._has_text(path):
            path = self.best()
        top = self._numbers[path]
        below = [False] * len(self._paths)
        for k in range(top, len(self._paths)):
            below[k] = k == top or k > 0 and below[self._around[k]]
        return "\n".join(text for text, k in self.blocks if below[k])


def container_votes(pages: DataFrame) -> DataFrame:
    """host, path, vote of each container of each page, and on how many it is the best; pages without text have none."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), 500):
                sums: dict[tuple[str, str], list] = {}
                part = batch.iloc[low : low + 500]
                for host, source in zip(part["host"], part["html"], strict=True):
                    page = Page(source or "")
                    total = sum(page.scores.values())
                    best = page.best()
                    for path, score in page.scores.items():
                        if score:
                            own = sums.setdefault((host, path), [0.0, 0])
                            own[0] += score / total
                            own[1] += path == best
                if sums:
                    yield pd.DataFrame([(*k, *v) for k, v in sums.items()], columns=["host", "path", "vote", "best_on"])

    return pages.select("host", "html").mapInPandas(vote, "host string, path string, vote double, best_on long")


def winning_paths(sums: DataFrame) -> DataFrame:
    """host, path, templates: of each host the path with most votes, and the paths (with pages) of its templates.

    sums: host, path, votes, best_on. Of equal votes the deepest path, then the first by name. A template
    is a path that is best on at least two pages and ``TEMPLATE_PERCENT`` of the host's pages, so a
    host has at most 100 / ``TEMPLATE_PERCENT``.
    """
    depth = F.size(F.split("path", ">")) + F.coalesce(F.regexp_extract("path", _DIGEST.pattern, 1).try_cast("int"), F.lit(0))
    first = F.min_by("path", F.struct(-F.col("votes"), -depth, F.col("path")))
    winners = sums.groupBy("host").agg(first.alias("path"), F.sum("best_on").alias("pages"))
    often = sums.where("best_on >= 2").select("host", F.col("path").alias("template"), "best_on")
    often = often.join(winners.select("host", "pages"), "host").where(F.col("best_on") * 100 >= F.col("pages") * TEMPLATE_PERCENT)
    templates = often.groupBy("host").agg(F.collect_list(F.struct("template", "best_on")).alias("templates"))
    return winners.select("host", "path").join(templates, "host", "left")


def _with_host(pages: DataFrame) -> DataFrame:
    after = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1)
    return pages.select("page_id", "url", "html", ascii_lower(after).alias("host"))


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, path (of the container used; null without text).

    pages: page_id, url, html; other columns are ignored. Null or empty html, and pages of boilerplate
    alone, have an empty text. Pages without a host (null url) vote among themselves.
    Rows of equal or null page_id, and repeated rows, keep a row and a vote each. Of templates that fit a
    page equally the deepest path is taken, then the first by name. An empty table gives no rows.
    """
    space = Workspace(pages.sparkSession, "html")
    hosted = _with_host(pages)
    sums = container_votes(hosted).groupBy("host", "path").agg(F.round(F.sum("vote"), 6).alias("votes"), F.sum("best_on").alias("best_on"))
    winners = space.store(winning_paths(space.store(sums, "votes")), "winners")
    joined = hosted.join(winners, "host", "left")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), 500):
                part = batch.iloc[low : low + 500]
                texts, paths = [], []
                for source, path, templates in zip(part["html"], part["path"], part["templates"], strict=True):
                    page = Page(source or "")
                    known = [] if templates is None else [(t["template"], t["best_on"]) for t in templates]
                    used = page.of_host(path if isinstance(path, str) else None, known)
                    texts.append(page.text(used))
                    paths.append(used if texts[-1] else None)
                yield part[["page_id", "url"]].assign(text=texts, path=paths)

    # Ids travel as text: pandas rounds whole numbers beside a null.
    columns = [F.col("page_id").cast("string"), "url", "html", "path", "templates"]
    found = joined.select(*columns).mapInPandas(read, "page_id string, url string, text string, path string")
    return found.withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType))
