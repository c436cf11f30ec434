"""Main text of web pages by differencing pages of neighbouring URLs.

A page is cut into lines, one for each block of markup. Pages of a host stand in the order of
their URL paths, copies as one page, and neighbours are compared; all lines of a pair, whatever their
markup, are aligned by a longest common subsequence. Outside articles a line that a neighbour shares
goes. Inside an article it goes if all pages of its run (four to seven, if the host has so many)
share it, and it stands before or after all lines that are the article's own, or is nothing but
links: shared lines between own ones, like a refrain, can't be told from text. Pages that share most
of an article are versions of it and tell nothing about lines inside; pages that share most of their
paragraphs outside articles tell nothing about these.

Markup is a further hint, for what no neighbour shares: elements that only hold furniture go on every
page (reader comments differ from page to page), and on a page without neighbours the lines outside
its one article that stand in no heading, paragraph or other element for text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .url_rules import url_parts

OPEN, CONTENT, FURNITURE = 0, 1, 2
KIND, LINK, FIRST = 3, 4, 8  # kinds' bits; of lines inside an article: nothing but links, first of the article
PROSE = 16  # of lines outside articles: in an element that holds text as such
VERSIONS = 3  # pages share so many times as much of their articles as one has of its own
_SALTS = 64  # a page's result is handed back to its copies in so many parts

# Elements of HTML by what they hold.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
WITHOUT_TEXT = {"head", "title", "script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio",
                "video", "select", "datalist", "textarea", "button"}
HEAD_ELEMENTS = {"base", "basefont", "bgsound", "link", "meta", "noscript", "script", "style", "template", "title"}
FURNITURE_ELEMENTS = {"nav", "footer", "aside", "dialog", "menu"}
ARTICLE_ELEMENTS = {"article", "main"}
FOREIGN = {"svg", "math"}  # the elements that a slash at their end closes, and all inside them
PROSE_ELEMENTS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dd", "figcaption"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "br", "caption", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "menu",
          "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
FURNITURE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
                   "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "login", "masthead", "menu",
                   "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "replies",
                   "reply", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar",
                   "widget"}
NOT_FURNITURE = {"closed", "enabled", "free", "has", "is", "no", "not", "off", "on", "open", "with", "without"}  # beside such a word a name tells nothing
FURNITURE_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation",
                   "search"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}


class _Lines(HTMLParser):
    """Collects lines; unclosed elements end with the element around them.

    A form, a header outside articles, a class, an id or a role only hints at furniture: such an
    element gets a mark, which is void once an article or main starts inside it. Forms' marks and those of
    compound names (``comment-list``) are void too on a page that would lose all its text by them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, int, tuple[int, ...], bool, int]] = []  # line, kind, marks around it, only links, article
        self.text: list[str] = []
        self.stack: list[tuple[str, int, bool, tuple[int, ...], bool]] = [("", OPEN, False, (), False)]  # element, kind, without text, marks, in a link
        self.marks, self.void, self.articles, self.plain = 0, set(), 0, False
        self.unsure: set[int] = set()  # marks of forms and compound names

    def flush(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                kind = self.stack[-1][1]
                if kind == OPEN and any(e[0] in PROSE_ELEMENTS for e in self.stack):
                    kind |= PROSE
                self.found.append((line, kind, self.stack[-1][3], not self.plain, self.articles))
            self.text, self.plain = [], False

    def lines(self) -> list[tuple[str, int]]:
        if all(kind == FURNITURE or not self.void.issuperset(marks) for _, kind, marks, _, _ in self.found):
            self.void |= self.unsure  # a form around all of a page's text is no part of the page
        out, last = [], 0
        for line, kind, marks, link, article in self.found:
            if not self.void.issuperset(marks):
                kind = FURNITURE
            elif kind == CONTENT:
                kind, last = kind | LINK * link | FIRST * (article != last), article
            out.append((line, kind))
        return out

    def handle_starttag(self, tag, attrs):
        self._leave_head(tag)
        if tag in BLOCKS:
            self.flush()
            if tag != "br":
                self._close_open({"p"} | CLOSED_BY.get(tag, set()), barrier=ARTICLE_ELEMENTS | {"div", "section", "ul", "ol", "table", "dl"})
        if tag in VOID:
            return
        _, kind, silent, marks, link = self.stack[-1]
        new, hints = kind, marks
        if tag in ARTICLE_ELEMENTS and kind == OPEN:
            new = CONTENT
        if tag in FURNITURE_ELEMENTS or self._hidden(tag, attrs):
            new = FURNITURE
        elif tag in ARTICLE_ELEMENTS and kind != FURNITURE:
            self.void.update(marks)
        elif (hint := self._hinted(tag, attrs)) or tag == "form" or tag == "header" and kind == OPEN:
            self.marks += 1
            hints = (*marks, self.marks)
            if hint == "compound" or tag == "form" and not hint:
                self.unsure.add(self.marks)
        if new != kind or hints != marks:
            self.flush()
        if new == CONTENT != kind:
            self.articles += 1
        self.stack.append((tag, new, silent or tag in WITHOUT_TEXT, hints, link or tag == "a"))

    @staticmethod
    def _hidden(tag, attrs) -> bool:
        if tag in ("html", "body", "main"):
            return False
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        return False

    @staticmethod
    def _hinted(tag, attrs) -> str:
        """Whether a class name, id or role says that the element is furniture: as a "whole", or only its
        first or last word does, as in ``comment-list`` and ``site-footer``: "compound"."""
        if tag in ("html", "body"):
            return ""
        hint = ""
        for name, value in attrs:
            value = (value or "").lower()
            if name == "role" and value in FURNITURE_ROLES:
                return "whole"
            if name in ("class", "id"):
                for word in value.split():
                    if word in FURNITURE_WORDS:
                        return "whole"
                    parts = re.split("[-_]+", word)
                    if (parts[0] in FURNITURE_WORDS or parts[-1] in FURNITURE_WORDS) and NOT_FURNITURE.isdisjoint(parts):
                        hint = "compound"
        return hint

    def _leave_head(self, tag: str) -> None:
        """Ends a title and a head without end tags: a title where a block or another element
        of the head starts, a head where anything starts that can't stand in one."""
        inner = self.stack[-1][0]
        if inner == "title" and (tag in BLOCKS or tag in HEAD_ELEMENTS):
            self.stack.pop()
            inner = self.stack[-1][0]
        if inner == "head" and tag not in HEAD_ELEMENTS or tag == "body":
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] == "head":
                    del self.stack[i:]
                    return

    def _close_open(self, tags: set[str], barrier: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in tags:
                del self.stack[i:]
                return
            if self.stack[i][0] in barrier:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in FOREIGN or tag not in VOID and any(e[0] in FOREIGN for e in self.stack):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                if self.stack[i][1] != self.stack[i - 1][1] or self.stack[i][3] != self.stack[i - 1][3]:
                    self.flush()
                del self.stack[i:]
                return

    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)  # as browsers do: up to the next ">"
        return super().parse_html_declaration(i)

    def handle_data(self, data):
        if self.stack[-1][0] == "head" and not data.isspace():
            self.stack.pop()
        if not self.stack[-1][2]:
            self.text.append(data)
            self.plain |= not (self.stack[-1][4] or data.isspace())


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """The lines of a page in order, each with its kind and, inside an article, ``LINK`` and ``FIRST``."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.lines()


def common_lines(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places (in a, in b) of a longest common subsequence, by bit-parallel rows; long inputs
    are halved first (Hirschberg), so memory stays near linear."""
    start = 0
    while start < len(a) and start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(a) - start and end < len(b) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    pairs = [(i, i) for i in range(start)]
    mid_a, mid_b = a[start : len(a) - end], b[start : len(b) - end]
    pairs += [(i + start, j + start) for i, j in _align(mid_a, mid_b)]
    return pairs + [(len(a) - end + i, len(b) - end + i) for i in range(end)]


def _rows(a: list[str], b: list[str], keep: bool) -> list[int]:
    places: dict[str, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, []
    for line in a:
        hit = v & places.get(line, 0)
        v = ((v + hit) | (v - hit)) & full
        if keep:
            rows.append(v)
    return rows if keep else [v]


def _align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [(0, b.index(a[0]))] if a[0] in b else []
    if len(a) * len(b) <= 1 << 28:
        rows, out, j = _rows(a, b, True), [], len(b) - 1
        for i in range(len(a) - 1, -1, -1):
            # A zero bit at j: the length grows with b[j]. It was already so without a[i]?
            while j >= 0 and rows[i] >> j & 1:
                j -= 1
            if j < 0:
                break
            if i and not rows[i - 1] >> j & 1:
                continue
            out.append((i, j))
            j -= 1
        return out[::-1]
    mid = len(a) // 2

    def lengths(x, y):
        bits = _rows(x, y, False)[0].to_bytes(len(y) // 8 + 1, "little")
        zero = 1 - np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[: len(y)].astype(np.int64)
        return np.concatenate([[0], np.cumsum(zero)])

    cut = int(np.argmax(lengths(a[:mid], b) + lengths(a[mid:][::-1], b[::-1])[::-1]))
    return _align(a[:mid], b[:cut]) + [(i + mid, j + cut) for i, j in _align(a[mid:], b[cut:])]


def neighbour_pairs(pages: DataFrame, work: str) -> DataFrame:
    """(key, host, run): pages of a host in the order of path and key, four to a run, up to
    seven to the last; neighbours in a run are paired. Keys must be distinct.

    The order is a range-partitioned sort; a page's rank in its host follows from its place in
    its partition and the sizes of the partitions before it, so no host is one task's work.
    """
    spark = pages.sparkSession
    ordered = pages.select("key", "host", "path").repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")
    ordered.select("key", "host", F.spark_partition_id().alias("part"),
                   F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place")).write.parquet(work)
    placed = spark.read.schema("key string, host string, part int, place long").parquet(work)
    # A row for each partition and host it holds; a host's ranks run on over its partitions.
    spans = placed.groupBy("host", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    host = Window.partitionBy("host")
    before = spans.select("host", "part", "first", F.sum("n").over(host).alias("pages"),
                          F.coalesce(F.sum("n").over(host.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.col("place") - F.col("first") + F.col("before")
    return placed.join(before, ["host", "part"]).where("pages > 1").select(
        "key", "host", F.least(F.floor(rank / 4), F.greatest(F.floor(F.col("pages") / 4) - 1, F.lit(0))).alias("run"))


def _repeated(run: list[tuple[list[int], list[int], bytes]]) -> list[tuple[list[int], list[int]]]:
    """Of each page (hashes, sizes and kinds of its lines) of a run the numbers of the lines that go, not
    counting furniture, and the hashes of furniture that a neighbour shares."""
    shared: dict[tuple[int, int], set[int]] = {}  # lines of the first page that the second has too
    for i, j in combinations(range(len(run)), 2):
        pairs = common_lines(run[i][0], run[j][0])
        shared[i, j], shared[j, i] = {a for a, _ in pairs}, {b for _, b in pairs}

    def alike(i: int, j: int, mask: int, kind: int) -> bool:
        """Whether page i shares so much of its lines of that kind that j is a version of it."""
        _, sizes, kinds = run[i]
        both = sum(sizes[x] for x in shared[i, j] if kinds[x] & mask == kind)
        return both >= VERSIONS * sum(size for x, size in enumerate(sizes) if x not in shared[i, j] and kinds[x] & KIND != FURNITURE) and both > 0

    out = []
    for i, (hashes, _, kinds) in enumerate(run):
        gone, told = set(), []
        for j in (i - 1, i + 1):
            if (i, j) in shared:
                paragraphs = alike(i, j, KIND | PROSE, OPEN | PROSE) or alike(j, i, KIND | PROSE, OPEN | PROSE)
                gone.update(x for x in shared[i, j] if kinds[x] & KIND == OPEN and not (paragraphs and kinds[x] & PROSE))
                told += [hashes[x] for x in shared[i, j] if kinds[x] & KIND == FURNITURE]
        others = [shared[i, j] for j in range(len(run)) if j != i and not alike(i, j, KIND, CONTENT) and not alike(j, i, KIND, CONTENT)]
        inside = [x for x, kind in enumerate(kinds) if kind & KIND == CONTENT]
        # Where there are three pages or more, one other page is too little to go by.
        repeated = set.intersection(*others).intersection(inside) if others and len(others) >= min(2, len(run) - 1) else set()
        gone.update(x for x in repeated if kinds[x] & LINK)
        for lines in (inside, inside[::-1]):  # from an article's first line on, then from its last line back
            edge = False
            for place, x in enumerate(lines):
                starts = kinds[x] & FIRST if lines is inside else place == 0 or kinds[lines[place - 1]] & FIRST
                edge = (edge or bool(starts)) and x in repeated
                if edge:
                    gone.add(x)
        own = np.cumsum([kind & KIND != FURNITURE for kind in kinds]) - 1
        out.append(([int(own[x]) for x in sorted(gone)], sorted(set(told))))
    return out


def _alone(kinds: bytes) -> set[int]:
    """Lines that go from a page without neighbours: those outside its one article that stand in no
    element for text."""
    if sum(kind & FIRST > 0 for kind in kinds) != 1:
        return set()
    return {x for x, kind in enumerate(kinds) if kind & KIND == OPEN and not kind & PROSE}


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that go from the pages of each run, which come one after the other."""
    held, out, last = [], [], None

    def close():
        out.extend((key, salts, *found) for (key, salts, _), found in zip(held, _repeated([page for _, _, page in held])))

    def rows():
        kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
        batch = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=["key", "salts", "gone", "told"])
        out.clear()
        return batch

    for batch in batches:
        for host, run, key, salts, *page in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if (host, run) != last:
                close()
                held, last = [], (host, run)
            held.append((key, salts, page))
        yield rows()
    close()
    yield rows()


def _signature(host: str, lines: list[tuple[str, int]]) -> tuple[str, list[int], list[int], bytes]:
    """The key that pages of a host have in common whose lines are equal but for marked furniture;
    hashes, sizes and kinds of all lines."""
    digests = [blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest() for line, _ in lines]
    own = (d for d, (_, kind) in zip(digests, lines) if kind & KIND != FURNITURE)
    key = blake2b(b"".join([host.encode("utf-8", "surrogatepass"), b"\0", *own]), digest_size=16).hexdigest()
    return key, [int.from_bytes(d, "little", signed=True) for d in digests], [len(line) for line, _ in lines], bytes(kind for _, kind in lines)


def extract_text(pages: DataFrame, work: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text: the lines of every page that neither its neighbours nor its markup
    show to be furniture, joined by one space; then n_lines, and how many of them went because
    a neighbour shares them (n_shared) and by markup alone (n_marked). ``work`` is a fresh shared
    folder; another named ``work``-lines is made beside it.

    Pages of a host with equal lines are one page to the others and get one result.
    A null html is empty and gives an empty text; pages with a null url form a host of their
    own; repeated rows get the same text; an empty table gives no rows; other columns are left out.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.select("*", host.alias("host"), path.alias("path"), F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)).cast("int").alias("salt"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = [_signature(at, page_lines(h)) for at, h in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist())]
            kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
            own = pa.array([any(kind & KIND != FURNITURE for kind in x[3]) for x in signed], pa.bool_())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("host", "path", "salt")), *(pa.array([x[i] for x in signed], k) for i, k in enumerate(kinds)), own],
                                             names=["host", "path", "salt", "key", "hashes", "sizes", "kinds", "own"])

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            keys, texts, open_kinds, marked = [], [], [], []
            for at, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                page = page_lines(html)
                key, hashes, _, _ = _signature(at, page)
                keys.append(key)
                texts.append(packer.compress("\n".join(x for x, k in page if k & KIND != FURNITURE).encode()))  # a line holds no line end
                open_kinds.append(bytes(k for _, k in page if k & KIND != FURNITURE))
                marked.append([h for h, (_, k) in zip(hashes, page) if k & KIND == FURNITURE])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(batch.column(c) for c in ("salt", "page_id", "url")),
                                              pa.array(texts, pa.binary()), pa.array(open_kinds, pa.binary()), pa.array(marked, pa.list_(pa.int64()))],
                                             names=["key", "salt", "page_id", "url", "lines", "kinds", "marked"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            texts, counts = [], []
            for packed, kinds, marked, gone, told in zip(*(batch.column(c).to_pylist() for c in ("lines", "kinds", "marked", "gone", "told"))):
                alone = gone is None
                gone, told = _alone(kinds) if alone else set(gone), set(told or ())
                lines = unpacker.decompress(packed).decode().split("\n") if kinds else []
                texts.append(" ".join(line for n, line in enumerate(lines) if n not in gone))
                both = sum(h in told for h in marked)
                counts.append((len(lines) + len(marked), both + len(gone) * (not alone), len(marked) - both + len(gone) * alone))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(3))],
                                             names=["page_id", "url", "text", "n_lines", "n_shared", "n_marked"])

    # One row for the pages of a host with equal lines: copies are no neighbours.
    found = "hashes array<long>, sizes array<int>, kinds binary"
    signed = rows.select("host", "path", "salt", "html").mapInArrow(sign, f"host string, path string, salt int, key string, {found}, own boolean")
    signed.where("own").groupBy("key").agg(
        F.min("host").alias("host"), F.min("path").alias("path"), F.max(F.struct("kinds", "sizes", "hashes")).alias("found"),
        F.collect_set("salt").alias("salts")).select("key", "host", "path", "found.hashes", "found.sizes", "found.kinds", "salts").write.parquet(f"{work}-lines")
    distinct = spark.read.schema(f"key string, host string, path string, {found}, salts array<int>").parquet(f"{work}-lines")
    pairs = neighbour_pairs(distinct.select("key", "host", "path"), work)
    # A run's rows are hashed to one partition and stand side by side in it.
    compared = pairs.join(distinct.drop("host"), "key").repartition("host", "run").sortWithinPartitions("host", "run", "path", "key") \
        .select("host", "run", "key", "salts", "hashes", "sizes", "kinds").mapInArrow(_compare, "key string, salts array<int>, gone array<long>, told array<long>")
    id_type = rows.schema["page_id"].dataType.simpleString()
    lined = rows.select("host", "salt", "page_id", "url", "html").mapInArrow(
        lines_of, f"key string, salt int, page_id {id_type}, url string, lines binary, kinds binary, marked array<long>")
    return lined.join(compared.select("key", F.explode("salts").alias("salt"), "gone", "told"), ["key", "salt"], "left") \
        .select("page_id", "url", "lines", "kinds", "marked", "gone", "told") \
        .mapInArrow(finish, f"page_id {id_type}, url string, text string, n_lines long, n_shared long, n_marked long")
