"""Main text of web pages by site template removal (operator 6).

Each page is cut into elements; the subtrees of its containers are hashed and counted per host in Spark, and those that
recur on many pages of their host with different main texts are deleted; pages of one main text (copies, or one article
within other surroundings) count once. A subtree that holds most of an article's text is never deleted as a template.
Elements that are boilerplate by their own name, role or whole class go on every page, so that a host's only page is
cleaned too. What is left of the article is joined block by block.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.jobs import pieces, written

#: A subtree is a template if it occurs on so many different pages of its host and on this share of them.
MIN_PAGES, MIN_SHARE = 5, 0.1
#: A recurring subtree of so many characters that holds most of a page without an article is its text.
LONG_TEXT = 300
#: So many template keys (8 bytes each) are sent to every task; more are joined to the pages instead.
MAX_SENT_KEYS = 500_000

# Names of HTML elements, and the words of classes, ids and roles that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
DROPPED = frozenset(
    "script style noscript template svg math canvas iframe object embed head title nav menu footer aside form button select option"
    " textarea input dialog noframes xmp audio video map".split()
)
PROTECTED = frozenset("html body article main p h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption li dd dt td th tr tbody".split())
#: A class, an id or a role marks boilerplate if it is one of MARKS, or made of words of MARKS and FILLERS only, as
#: cookie-banner or comment-list are; search-results, related-work or ad-hoc are not. Whatever stands before them, comments,
#: adverts and sidebars are told by the last word that is no filler, their head, as in reader-comments or left-sidebar-2,
#: unless a word such as in has-sidebar or without-ads says that the element is none itself.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle banner sponsored promo promotion cookie cookies consent gdpr notice notices"
    " alert popup modal overlay newsletter subscribe paywall sidebar menu nav navbar navigation breadcrumb breadcrumbs"
    " footer comment comments commentlist reply replies respond disqus toolbar pagination pager login complementary contentinfo".split()
)
FILLERS = frozenset("area bar block body box button buttons container content form group inner item items link links list main outer panel section site slot thread top bottom left right unit widget widgets wrap wrapper".split())
COMMENT_HEADS = frozenset("comment comments commentlist".split())
ADVERT_HEADS = frozenset("ad ads advert adverts advertisement advertisements advertising adsbygoogle sponsored".split())
HEADS = COMMENT_HEADS | ADVERT_HEADS | frozenset("sidebar sidebars breadcrumb breadcrumbs pagination newsletter share sharing".split())
OTHERWISE = frozenset("has have with no not non without is hide show toggle enable disable".split())
WHOLE = frozenset("share sharing social related related-posts related-articles related-links share-buttons share-bar social-links social-share social-media search search-form search-box skip-link".split())
OUTER_MARKS = frozenset("header masthead topbar".split())
#: What an open element of each kind is hidden by from a start tag that would end it.
SCOPE = frozenset("html body table td th caption button object".split())
NEAR = {"p": 0, "li": 1, "dd": 2, "dt": 2, "tr": 3, "td": 4, "th": 4}
HIDES = [SCOPE, SCOPE | {"ul", "ol", "menu"}, SCOPE | {"dl"}, frozenset(("html", "body", "table")), frozenset(("html", "body", "table", "tr"))]

_name = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
_quoted = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
#: Every attribute of a tag is read, so that words in the values of others are no attributes.
_attribute = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++)))?""")
_words = re.compile(r"[^\W_]+")
_long_reference = re.compile(r"&#([xX]?)0*([0-9a-fA-F]{7,});?|&#([xX]?)0{7,}([0-9a-fA-F]{0,6});?")


def tags(source: str) -> Iterator[tuple[str, str, str, int, int]]:
    """(kind, name, attributes, start, end) of every piece of markup; kind is start, end, data or other.

    Values in quotes may hold ``>``, unless a quote runs to the end of the page: from there on tags end at their first
    ``>``. What follows the last ``>`` is text. Whatever the page, this takes time in proportion to its length. A sender
    of a position makes the search go on from there.
    """
    last, at, quotes = source.rfind(">"), 0, True
    while True:
        at = source.find("<", at)
        if at < 0:
            return
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            end = end + 3 if end >= 0 else len(source)
            found = ("other", "", "", at, end)
        elif source.startswith("<![CDATA[", at):
            end = source.find("]]>", at + 9)
            found = ("data", "", source[at + 9 : end if end >= 0 else len(source)], at, end + 3 if end >= 0 else len(source))
        elif at > last:
            return
        elif source[at + 1] in "!?":
            found = ("other", "", "", at, source.index(">", at) + 1)
        else:
            m = _name.match(source, at + 1)
            if not m:
                at += 1
                continue
            q = _quoted.match(source, m.end()) if quotes else None
            quotes = quotes and q is not None
            end = q.end() if q else source.index(">", at) + 1
            found = ("end" if m[1] else "start", m[2].lower(), source[m.end() : end - 1], at, end)
        at = (yield found) or found[4]


def unescaped(text: str) -> str:
    """Character references decoded; numbers too long for a code point are an unknown character."""

    def short(m: re.Match) -> str:
        digits = m[2] if m[2] is not None else m[4]
        return "\ufffd" if m[2] is not None and len(digits) > 7 else f"&#{m[1] or m[3] or ''}{digits or '0'};"

    return html.unescape(_long_reference.sub(short, text)) if "&" in text else text


def marks(value: str, known: frozenset) -> bool:
    found = _words.findall(value)
    return value in WHOLE or bool(found) and not known.isdisjoint(found) and all(w in known or w in FILLERS for w in found)


def headed(value: str, heads: frozenset) -> bool:
    """Whether the last word of a class that is neither a filler nor a number is one of ``heads``."""
    found = _words.findall(value)
    head = next((w for w in reversed(found) if w not in FILLERS and not w.isdecimal()), "")
    return head in heads and OTHERWISE.isdisjoint(found)


def is_boilerplate(tag: str, attributes: str, inside: bool) -> int:
    """1 if an element is boilerplate by its name or hidden, 2 if by its class, id or role, else 0; ``inside`` says that it
    lies in the page's article. Of elements within a line only adverts count (a class comment may be one in code), of
    articles only adverts and comments."""
    if tag in DROPPED:
        return 1
    if tag == "header" and not inside:
        return 1
    if not attributes or tag in ("html", "body", "main"):
        return 0
    block = tag in BLOCK or tag == "ins"
    for name, *values in _attribute.findall(attributes):
        value, name = "".join(values).lower(), name.lower()
        if tag == "article" and name in ("class", "id"):
            if any(headed(v, COMMENT_HEADS | ADVERT_HEADS) for v in value.split()):
                return 2
            continue
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return 1
        if name in ("class", "id", "role"):
            for v in value.split():
                if headed(v, HEADS if block else ADVERT_HEADS) or block and (marks(v, MARKS) or not inside and marks(v, OUTER_MARKS)):
                    return 2
    return 0


class Page:
    """Elements and text pieces of one page, in page order.

    Broken markup is read as browsers do in the common cases: block elements and list items end an open paragraph or
    item, end tags without a start are ignored, open elements end with their parent or the page.
    """

    def __init__(self, source: str):
        self.texts: list[str] = []
        self.blocks: list[int] = []
        #: (tag, from piece, to piece, boilerplate, container of an article: 1, or 2 within boilerplate, hash)
        self.elements: list[tuple[str, int, int, int, int, int]] = []
        self._open, self._block, self._inside, self._lost = [], 0, 0, 0
        self._count: dict[str, int] = {}  # open elements by name
        self._read(source)

    def _close(self, kind: int) -> None:
        """Ends the open element of a kind (see NEAR) with all in it, unless another element hides it."""
        at = self._open[-1][5][kind] if self._open else None
        while at is not None and len(self._open) > at:
            self._end_last()

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._block += 1
            if NEAR.get(tag):
                self._close(NEAR[tag])
            self._close(0)
        if tag in VOID:
            if tag in ("br", "hr"):
                self._text(" ")
            return
        dropped = is_boilerplate(tag, attributes, self._inside > 0)
        holds = (2 if self._lost else 1) if tag in ("article", "main") and not dropped else 0
        self._inside += holds > 0
        self._lost += dropped > 0
        self._count[tag] = self._count.get(tag, 0) + 1
        near = [None if tag in HIDES[k] else n for k, n in enumerate(self._open[-1][5] if self._open else [None] * 5)]
        if tag in NEAR:
            near[NEAR[tag]] = len(self._open)
        self._open.append((tag, [f"{tag} {attributes.strip()}"], len(self.texts), dropped, holds, near))

    def _text(self, text: str) -> None:
        self.texts.append(text), self.blocks.append(self._block)
        if self._open:
            self._open[-1][1].append(" ".join(text.split()))

    def _end_last(self) -> None:
        tag, content, first, dropped, holds, _ = self._open.pop()
        self._inside -= holds > 0
        self._lost -= dropped > 0
        self._count[tag] -= 1
        # an element's hash is made of its tag, its texts and the hashes of its children
        own = xxhash.xxh64_intdigest("\n".join(content).encode("utf-8", "replace")) - (1 << 63)
        if self._open:
            self._open[-1][1].append(str(own))
        counted = tag in BLOCK and tag not in PROTECTED and len(self.texts) > first
        self.elements.append((tag, first, len(self.texts), dropped, holds, own if counted else 0))
        if tag in BLOCK:
            self._block += 1

    def _read(self, source: str) -> None:
        lower = None
        found, at, jump = tags(source), 0, None
        while True:
            try:
                kind, tag, inner, start, end = found.send(jump)
            except StopIteration:
                break
            jump = None
            if start > at:
                self._text(unescaped(source[at:start]))
            at = end
            if kind == "data":
                self._text(inner)
            elif kind == "start":
                self._start(tag, inner)
                if tag in RAW:
                    lower = lower if lower is not None else source.lower()
                    # lower-casing may lengthen a text; then the end tag is looked for by a slower way
                    stop = lower.find(f"</{tag}", at) if len(lower) == len(source) else next((x.start() for x in re.compile(f"</{tag}", re.I).finditer(source, at)), -1)
                    at = jump = stop if stop >= 0 else len(source)
            elif kind == "end" and self._count.get(tag):
                while self._open[-1][0] != tag:
                    self._end_last()
                self._end_last()
            elif kind == "end" and tag in ("br", "p"):
                self._text(" ")
        if at < len(source):
            self._text(unescaped(source[at:]))
        while self._open:
            self._end_last()

    def hashes(self) -> set[int]:
        return {e[5] for e in self.elements if e[5]}

    def _mains(self, kind: int = 1) -> list[tuple[int, int]]:
        return [(e[1], e[2]) for e in self.elements if e[4] == kind]

    def content(self) -> int:
        """Hash of the article's text, or of the whole page's text if it names no article."""
        said = "".join("".join(self.texts[a:b]) for a, b in self._mains() or [(0, len(self.texts))])
        return xxhash.xxh64_intdigest(" ".join(said.split()).encode("utf-8", "replace")) - (1 << 63)

    def text(self, is_template: Callable[[int], bool]) -> str:
        """Blocks of the article, or of the page if it names none, joined by an empty line.

        Articles within boilerplate, such as comments or teasers in an aside, are none of the page's. An element that
        holds every article is no boilerplate, whatever its attributes say. Templates never take most of an article,
        alone or together; nor, if the page names no article, most of it and LONG_TEXT characters. If a page without an
        article would be left with nothing, articles within boilerplate count, and then words in attributes or templates
        don't.
        """
        out = self._cleaned(self._mains(), is_template)
        if not out and not self._mains():
            inner = self._mains(2)
            out = self._cleaned(inner, is_template) if inner else out
            named = [e for e in self.elements if e[3]]
            out = out or self._blocks([(0, len(self.texts))], [e for e in named if e[3] != 2] + self._templates(is_template))
            out = out or self._blocks([(0, len(self.texts))], named) or self._blocks([(0, len(self.texts))], [e for e in named if e[3] != 2])
        return "\n\n".join(out)

    def _templates(self, is_template: Callable[[int], bool]) -> list:
        return [e for e in self.elements if not e[3] and e[5] and is_template(e[5])]

    def _cleaned(self, articles: list[tuple[int, int]], is_template: Callable[[int], bool]) -> list[str]:
        first, last = (min(a for a, _ in articles), max(b for _, b in articles)) if articles else (0, -1)
        around = lambda e: bool(articles) and e[1] <= first and last <= e[2]
        named = [e for e in self.elements if e[3] and not (around(e) and e[0] not in RAW)]
        templates = [e for e in self._templates(is_template) if not around(e)]
        mains = articles or [(0, len(self.texts))]
        if templates:
            templates = self._taken(mains, named, templates, 0 if articles else LONG_TEXT)
        return self._blocks(mains, named + templates)

    def _taken(self, mains: list[tuple[int, int]], named: list, templates: list, least: int) -> list:
        """The templates that may go: none that holds most of the innermost or of the outermost article around it, and none
        of an article that would lose most of its text to all of them. Takes one pass over articles and templates in
        page order."""
        lengths = np.array([len(t.strip()) for t in self.texts])
        sums = lambda gone: np.append(0, np.cumsum(lengths * (self._kept(mains, gone) > 0))).tolist()
        most = lambda lost, whole: 2 * lost > whole and lost >= least
        before = sums(named)
        ranges = sorted(set(mains), key=lambda m: (m[0], -m[1]))
        placed, outside, stack, at = [], [], [], 0  # placed: (template, innermost and outermost article)
        for e in sorted(templates, key=lambda e: (e[1], -e[2])):
            while at < len(ranges) and ranges[at][0] <= e[1] and (ranges[at][0] < e[1] or ranges[at][1] >= e[2]):
                while stack and stack[-1][1] <= ranges[at][0] and stack[-1] != ranges[at]:
                    stack.pop()
                stack.append(ranges[at])
                at += 1
            while stack and stack[-1][1] < e[2]:
                stack.pop()
            held = {stack[0], stack[-1]} if stack else set()
            if not held:
                outside.append(e)
            elif not any(most(before[e[2]] - before[e[1]], before[b] - before[a]) for a, b in held):
                placed.append((e, held))
        after = sums(named + [e for e, _ in placed])
        hurt = {(a, b) for a, b in ranges if most(before[b] - before[a] - (after[b] - after[a]), before[b] - before[a])}
        return outside + [e for e, held in placed if held.isdisjoint(hurt)]

    def _kept(self, mains: list[tuple[int, int]], gone: list) -> np.ndarray:
        n = len(self.texts)
        keep = np.zeros(n + 1, np.int64)
        for ranges, sign in ((mains, 1), ([(e[1], e[2]) for e in gone], -n - 1)):
            for a, b in ranges:
                keep[a] += sign
                keep[b] -= sign
        return np.cumsum(keep)[:n]

    def _blocks(self, mains: list[tuple[int, int]], gone: list) -> list[str]:
        out, last = [], None
        for i in np.flatnonzero(self._kept(mains, gone) > 0).tolist():
            if self.blocks[i] != last:
                out.append([])
                last = self.blocks[i]
            out[-1].append(self.texts[i])
        return [b for b in (" ".join("".join(x).split()) for x in out) if b]


def host(url):
    """Host name of a url, in small letters; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def keyed(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.xxhash64(host(F.col("url"))).alias("host_key"), "html")


def subtree_keys(pages: DataFrame) -> DataFrame:
    """(host_key, content, key): one row for each distinct container subtree of a page, and one with key 0 for the page
    itself; ``content`` is a hash of its main text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                hosts, contents, keys = [], [], []
                for of_host, source in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    page = Page(source or "")
                    found = page.hashes() | {0}
                    hosts += [of_host] * len(found)
                    contents += [page.content()] * len(found)
                    keys += found
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (hosts, contents, keys)], ["host_key", "content", "key"])

    return keyed(pages).select("host_key", "html").mapInArrow(run, "host_key bigint, content bigint, key bigint")


def template_keys(pages: DataFrame, min_pages: int, min_share: float) -> DataFrame:
    """(host_key, keys): subtrees that recur on many pages of a host with different main texts.

    Pages are parsed once for both counts, which are combined before they are shuffled. As a template lies on at least
    ``min_share`` of a host's pages, a host has at most as many as 1 / min_share of its pages have subtrees.
    """
    counts = written(subtree_keys(pages).distinct().groupBy("host_key", "key").agg(F.count("*").alias("n")))
    sizes = counts.filter("key = 0").select("host_key", F.col("n").alias("pages"))
    often = counts.filter((F.col("key") != 0) & (F.col("n") >= min_pages))
    return often.join(sizes, "host_key").filter(F.col("n") >= min_share * F.col("pages")).groupBy("host_key").agg(F.sort_array(F.collect_list("key")).alias("keys"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, max_sent: int = MAX_SENT_KEYS) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars (code points).

    White space is what Unicode calls so, a no-break space included. A null or empty html gives an empty text; null urls and urls without a host count as one host; a null page_id stays
    null; a page that names no article is cleaned as a whole. Repeated rows are extracted each; other columns are
    ignored. Up to ``max_sent`` template keys (8 bytes each) are sent to every task; more of them are joined to the pages
    by their host, with the same result.
    """
    templates = written(template_keys(pages.select("page_id", "url", "html"), min_pages, min_share))
    n = templates.agg(F.sum(F.size("keys"))).first()[0] or 0
    of_host = F.broadcast(templates) if n <= max_sent else templates
    return keyed(pages).join(of_host, "host_key", "left").select("page_id", "html", "url", "keys").mapInArrow(extracted, "page_id bigint, url string, text string, n_chars bigint")


def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch):
            texts = []
            for source, keys in zip(part.column(1).to_pylist(), part.column(3), strict=True):
                known = frozenset(keys.as_py() or ())
                texts.append(Page(source or "").text(known.__contains__))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
