"""Main text of web pages, with site templates removed.

One pass hashes the element subtrees of every page; Spark counts, for each host and for each
section of a host (the first part of the path), on how many of their pages (by different
content) each subtree occurs.  A second pass reads the pages again, deletes the subtrees that
recur on at least half of them, and takes what is left of the article.

What the counts cannot tell (hosts with few pages, side columns that differ from page to page,
comments) goes by the element's tag, role, or the words of its class and id, if all of them name
furniture.  Names do not decide alone: an element that holds the article or nearly all text of
the page stays, whatever it is called, and so does most of an article that is a near copy of others.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm._common import Scratch, arrow_map, scan_texts, sized_batches

#: A subtree is a template of a host, or of a section, if it is on so many of its pages, and on this share of them.
#: Passages of real articles recur on up to two fifths of a host's pages in the test tables: the share is not set lower.
MIN_PAGES = 5
MIN_SHARE = 0.5
#: Templates do not take more than this share of an article: then it is a near copy of others.
MOST_OF_ARTICLE = 0.5
#: A named element with more than this share of a page without an article is its layout.
LAYOUT = 0.75

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp noembed noframes".split())
HEAD = frozenset("head title meta link base script style noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Never shown as text of the page.
UNSEEN = frozenset("head script style title noscript template iframe object svg canvas button select textarea dialog audio video map datalist".split())
#: Furniture by their tags.
ASIDE = frozenset("nav footer aside menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead footer sidebar aside widget widgets notice notices cookie cookies consent gdpr banner ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended pagination pager skip toolbar searchbox".split()
)
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond responses".split())
#: Words that may stand beside a name in a class or id without changing what it names.
BESIDE = frozenset(
    "site page global main top bottom left right primary secondary inner outer wrapper wrap container box area bar block slot unit panel column col section list item items link links button buttons icon icons form thread holder module region zone row group post posts article articles story stories content google site-wide sticky fixed mobile desktop js ui wp app id the of by for and".split()
)
#: The head of a post is not the head of the site.
_POST_HEAD = frozenset("post article entry content section story".split())
#: Start tags of the first kind close an open element of the second kinds.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_PARTS = re.compile(r"[a-z]{2,}")
_BREAK = None
_TAG_NAMED, _NAMED, _COMMENT, _HOST, _SECTION = range(5)


class _Open:
    __slots__ = ("name", "kind", "unseen", "part", "start", "parts")

    def __init__(self, name: str, kind: str, unseen: bool, part: int | None, start: int) -> None:
        self.name, self.kind, self.unseen, self.part, self.start = name, kind, unseen, part, start
        self.parts: list[bytes] = []


def named(kind: str, in_article: bool) -> int | None:
    """What a class and id say an element is: furniture, comments, or nothing.

    A class counts if every word of it names furniture or stands beside such names (``site-footer``,
    ``ad-slot``); ``no-sidebar``, ``has-sidebar``, ``social-science`` or ``widget-title`` say nothing.
    """
    for token in _HUMP.sub("-", kind).lower().split():
        words = _PARTS.findall(token)
        if any(w in COMMENTS for w in words) and all(w in COMMENTS or w in BESIDE for w in words):
            return _COMMENT
        if any(w in NAMES for w in words) and all(w in NAMES or w in BESIDE for w in words):
            return _NAMED
        if "header" in words and not in_article and not _POST_HEAD & set(words) and all(w == "header" or w in NAMES or w in BESIDE for w in words):
            return _NAMED
    return None


def _judged(name: str, rest: str, in_article: bool) -> tuple[bool, int | None, str]:
    """Whether an element is never shown, what part of the page it is if not the article, and its class and id."""
    if name in UNSEEN:
        return True, None, ""
    part = _TAG_NAMED if name in ASIDE or (name == "header" and not in_article) else _NAMED if name == "form" else None
    if not rest or rest.isspace():
        return False, part, ""
    found = {}
    for m in _ATTRIBUTE.finditer(rest):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    kind = f"{found.get('class', '')} {found.get('id', '')}".strip()
    if name in ("html", "body", "main"):
        return False, None, kind
    if "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True, None, kind
    if part is None and found.get("role", "").lower() in ROLES:
        part = _TAG_NAMED
    if part is None or part == _NAMED:
        said = named(kind, in_article)
        part = said if name != "article" or said == _COMMENT or in_article else None
        if name == "form" and part is None:
            part = _NAMED
    return False, part, kind


class _Places:
    """Spans of a page's pieces, without those inside others; spans of elements are apart or one inside the other."""

    def __init__(self, spans) -> None:
        self.spans: list[tuple[int, int]] = []
        for s in sorted(spans, key=lambda s: (s[0], -s[1])):
            if not self.spans or s[0] >= self.spans[-1][1]:
                self.spans.append(s)
        self.starts = [s[0] for s in self.spans]

    def outside(self, others: list[tuple]) -> list[tuple]:
        """Those of the other spans that are not inside one of these."""
        at = [bisect_right(self.starts, o[0]) - 1 for o in others]
        return [o for o, i in zip(others, at, strict=True) if i < 0 or self.spans[i][1] < o[1]]

    def inside(self, other: tuple) -> list[tuple[int, int]]:
        return [s for s in self.spans[bisect_left(self.starts, other[0]) : bisect_left(self.starts, other[1])] if s[1] <= other[1]]


def _holds(span: tuple, others: list[tuple]) -> bool:
    """Whether one of the other spans, which come in the order of their ends, is inside a span."""
    i = bisect_right(others, span[1], key=lambda o: o[1])
    while i and others[i - 1][1] > span[0]:
        i -= 1
        if others[i][0] >= span[0]:
            return True
    return False


class Page:
    """One pass over a page: subtree hashes, and the text of its article without furniture and the given subtrees.

    ``host`` are templates of the whole host, ``section`` those of a section only: these are
    deleted where the page has no article element.
    """

    def __init__(self, text: str, host: frozenset[int] | set[int] = frozenset(), section: frozenset[int] | set[int] = frozenset()) -> None:
        self.hashes: set[int] = set()
        self.out: list[str | None] = []
        #: Places in ``out`` of articles and main elements, and of what is not the article.
        self.articles: list[tuple[int, int, str]] = []
        self.parts: list[tuple[int, int, int]] = []
        self.host, self.section = host, section
        self.stack: list[_Open] = []
        self.inside = self.unseen = 0
        self._read(text)
        while self.stack:
            self._close()

    def _text(self, raw: str) -> None:
        if self.stack:
            if words := raw.split():
                self.stack[-1].parts.append(" ".join(words).encode())
            if self.stack[-1].name in ("html", "head") and not words:
                return
        if not self.unseen:
            self.out.append(html.unescape(raw))

    def _close(self) -> None:
        top = self.stack.pop()
        self.unseen -= top.unseen
        self.inside -= top.name in ("article", "main")
        digest = 0
        if top.parts:
            digest = xxhash.xxh3_64_intdigest(b"\x00".join([top.name.encode(), top.kind.lower().encode(), *top.parts]))
            if self.stack:
                self.stack[-1].parts.append(b"\x01" + digest.to_bytes(8, "little"))
        if not self.unseen and not top.unseen:
            at = (top.start, len(self.out))
            if top.part is not None:
                self.parts.append((*at, top.part))
            if top.name in ("article", "main"):
                self.articles.append((*at, top.name))
            elif top.name in BLOCK and digest and top.name not in ("html", "body"):
                digest -= 1 << 63
                self.hashes.add(digest)
                if digest in self.host:
                    self.parts.append((*at, _HOST))
                elif digest in self.section:
                    self.parts.append((*at, _SECTION))
        if top.name in BLOCK and not self.unseen:
            self.out.append(_BREAK)

    def _until(self, names: set[str] | frozenset[str], stop: set[str] | frozenset[str] = frozenset()) -> None:
        """Close up to the nearest open element of ``names``, if none of ``stop`` stands before it."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].name in names:
                while len(self.stack) > i:
                    self._close()
                return
            if self.stack[i].name in stop:
                return

    def _start(self, name: str, rest: str) -> None:
        if name in ("html", "body"):
            self._until({"head"})
            if any(x.name == name for x in self.stack):
                return
        elif self.stack and name not in HEAD and any(x.name == "head" for x in self.stack):
            self._until({"head"})
        if name in BLOCK:
            if self.stack and self.stack[-1].name != "button":
                self._until({"p"}, {"button", "table", "td", "th", "article", "section", "main", "div", "li", "blockquote"})
            if not self.unseen:
                self.out.append(_BREAK)
        if name in _CLOSES:
            self._until(*_CLOSES[name])
        if name in VOID:
            if name == "br" and not self.unseen:
                self.out.append(" ")
            return
        unseen, part, kind = _judged(name, rest, self.inside > 0)
        self.stack.append(_Open(name, kind, unseen, part, len(self.out)))
        self.unseen += unseen
        self.inside += name in ("article", "main")

    def _read(self, text: str) -> None:
        at = 0
        while m := _TAG.search(text, at):
            if m.start() > at:
                self._text(text[at : m.start()])
            at = m.end()
            name = (m["name"] or m["name2"] or "").lower()
            if not name:
                continue
            if m["end"] or m["end2"]:
                if name not in VOID and name not in ("html", "body"):
                    self._until({name})
                elif name == "br" and not self.unseen:
                    self.out.append(" ")
                continue
            rest = m["rest"] or m["rest2"] or ""
            self._start(name, rest)
            if name in RAW and not rest.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(text, at)
                stop = end.start() if end else len(text)
                self._text(text[at:stop])
                at = stop
        if at < len(text):
            self._text(text[at:])

    def _chosen(self) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Places of the article, and of what to leave out of it."""
        sizes = [0, *accumulate(0 if x is _BREAK else len(x) - x.count(" ") for x in self.out)]
        size = lambda x: sizes[x[1]] - sizes[x[0]]
        named = [p for p in self.parts if p[2] <= _COMMENT]
        free = _Places(p[:2] for p in named).outside(self.articles)
        if not free:  # whatever holds an article that is no comment holds the page
            named = [p for p in named if p[2] == _COMMENT or not _holds(p, self.articles)]
            free = _Places(p[:2] for p in named).outside(self.articles)
        if not free:
            named = [p for p in named if p[2] != _NAMED or size(p) <= LAYOUT * sizes[-1]]
            return [(0, len(self.out))], [p[:2] for p in (*named, *(p for p in self.parts if p[2] > _COMMENT))]
        articles = _Places(a[:2] for a in free if a[2] == "article")
        articles = articles if articles.spans else _Places(a[:2] for a in free)
        gone = _Places(p[:2] for p in named)
        templates = _Places(t[:2] for t in gone.outside([p for p in self.parts if p[2] == _HOST]) if not _holds(t, free))
        taken: list[tuple[int, int]] = []
        for a in articles.spans:
            inner = templates.inside(a)
            if sum(map(size, inner)) <= MOST_OF_ARTICLE * (size(a) - sum(map(size, gone.inside(a)))):
                taken += inner
        return articles.spans, gone.spans + taken

    def text(self) -> str:
        """Blocks joined by line feeds, white space in each made single spaces."""
        places, gone = self._chosen()
        left_out = [0] * (len(self.out) + 1)
        for x, y in gone:
            left_out[x] += 1
            left_out[y] -= 1
        left_out = list(accumulate(left_out))
        pieces = [x for a, b in places for x in [*(self.out[i] for i in range(a, b) if not left_out[i]), _BREAK]]
        blocks, now = [], []
        for piece in [*pieces, _BREAK]:
            if piece is not _BREAK:
                now.append(piece)
            elif now:
                if words := "".join(now).split():
                    blocks.append(" ".join(words))
                now = []
        return "\n".join(blocks)


def _hashed():
    def work(texts: list[bytes | None], kept: list[pa.Array]) -> list[pa.Array]:
        rows, content = [], []
        for t in texts:
            found = Page(t.decode()).hashes if t else set()
            rows.append(sorted(found))
            content.append(xxhash.xxh3_64_intdigest(str(sorted(found)).encode()) - (1 << 63))
        return [pa.array(rows, pa.list_(pa.int64())), pa.array(content, pa.int64())]

    return work


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sized_batches(batches, "text"):
        texts = []
        for raw, host, section in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            texts.append(Page(raw, set(host or ()), set(section or ())).text() if raw else "")
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """One row for each page: page_id, url, text, n_chars.

    ``pages`` needs page_id, url and html.  A null or empty html gives an empty text.  Pages
    without a host in their url belong to no site and lose no templates.  Pages with equal
    content count once in a host's counts, so copies of a page make no template.  Rows
    repeat as they come; an empty table gives an empty result.

    The subtrees kept for a host or section recur on half of its different pages, so they are at most twice as many as
    its pages have on average; their tables join the pages, broadcast only below the session's threshold.
    """
    scratch = Scratch(pages.sparkSession, "templates")
    url = F.col("url").cast("string")
    place = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
    host, section = F.lower(F.regexp_extract(url, place, 1)), F.regexp_extract(url, place + r"[^/?#]*/([^/?#]+)/", 2)
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.col("html").cast("string").alias("text"), host.alias("host"), section.alias("section"))
    seen = scan_texts(source.where("host <> ''"), lambda: _hashed(), pa.schema([("found", pa.list_(pa.int64())), ("content", pa.int64())]), "found array<bigint>, content long", ["host", "section"])
    seen = seen.groupBy(F.col("c0").alias("host"), "content").agg(F.min("c1").alias("section"), F.first("found").alias("found"))
    seen = scratch.keep(seen, "seen")
    counts = scratch.keep(seen.select("host", "section", F.explode("found").alias("subtree")).groupBy("host", "section", "subtree").agg(F.count("*").alias("n")), "counts")

    def templates(keys: list[str], column: str) -> DataFrame:
        total = seen.groupBy(*keys).agg(F.count("*").alias("pages"))
        often = counts.groupBy(*keys, "subtree").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_PAGES)
        often = often.join(total, keys).where(F.col("n") >= MIN_SHARE * F.col("pages"))
        return scratch.keep(often.groupBy(*keys).agg(F.collect_list("subtree").alias(column)), column)

    held = source.join(templates(["host"], "of_host"), "host", "left").join(templates(["host", "section"], "of_section"), ["host", "section"], "left")
    scratch.drop("seen", "counts")
    out = arrow_map(held.select("page_id", "url", "text", "of_host", "of_section"), _extracted, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
