"""Main text of pages by differencing each with the nearest pages of its host.

1. Lines. A page's html is cut into the texts of its blocks, with character references decoded and white space
   single. Each line knows what markup says of it: outside the article by its element or class (menus, forms, adverts,
   comments, ...), inside an `article` or `main`, or nothing.
2. Pairs. Pages are ordered by host and URL path, where the page with the longest common beginning of the path
   stands next. Each page is paired with the `NEAREST` pages on either side, if they are of its host.
3. Differences. The lines of a pair are aligned by a longest common subsequence. A line that is
   aligned with more than half of the paired pages is the host's, not the page's, and is deleted. Lines inside an
   `article` are deleted only if all of at least `LEAST_WITNESSES` pages share them, since articles quote and repeat one
   another. A pair of copies, where the pages differ in little else, tells nothing and does not count.
4. What is left is the text: the lines inside the articles if there are any, else all.

Differencing alone can't give right results: adverts and menus that differ from page to page are shared by no pair,
and copies share their whole article. So markup, where it speaks, decides first.

Hashes of lines are range-partitioned by host and path, so a host with a third of all pages is in many tasks; blocks of
consecutive pages overlap by `NEAREST` pages. Html is read twice and shuffled only where very many pages lose
lines by differencing.

Defined cases: a null or empty html has an empty text; a null URL, or one without `://`, has an empty host and path;
pages that repeat as a whole, page_id, url and html, are one page to the differencing, and each comes out; an empty
table gives an empty result; only page_id, url and html are read. Very long pages are read whole, lines and all.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, over_all_cores, slices, stored
from reviewflow.llm.url_filter import url_parts

# Pages on either side, pages that must agree on a line inside an article, pages of a block.
NEAREST = 3
LEAST_WITNESSES = 4
BLOCK_PAGES = 256
# Copies: pairs with no more than this share of the text of either page that is not shared; for articles, with
# at least this share that is.
COPY_REST = 0.1
COPY_ARTICLE = 0.5
# Lines times lines that are aligned at once, as bits.
ALIGNED_BITS = 1 << 26
SLICE_PAGES = 128

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <(?P<raw>script|style|title|textarea|iframe|noembed|xmp)\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)
      | <(?P<close>/?)(?P<tag>[a-z][^\s/>]*+)(?P<rest>(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)
      | <[!?/][^>]*+>
      | (?P<text>[^<]++|<)""",
    re.S | re.I | re.X,
)
ATTRIBUTE = re.compile(r"""([a-z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.S | re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
OUTSIDE = frozenset(
    "head nav footer aside form button select noscript template dialog menu svg canvas object audio video map".split()
)
OUTSIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split()
)
# Words of class and id; those of the second row only outside an article, which may have a header of its own.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment "
    "comments disqus respond reply replies sidebar sidenav menu menubar nav navbar navigation breadcrumb breadcrumbs "
    "pager pagination share sharing social related recommended masthead topbar footer copyright toolbar skip".split()
)
HEADER_WORDS = frozenset(["header"])
WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
NEGATED = re.compile(r"\b(?:has|no|with|without)[-_]\w+", re.I)
# Elements that end where one of these begins or, for the others, at their end tag.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}

OPEN, INSIDE, DROPPED = 0, 1, 2

LINES = "host STRING, path STRING, k1 BIGINT, k2 BIGINT, hashes BINARY, zones BINARY, sizes BINARY"
DELETED = "k1 BIGINT, k2 BIGINT, deleted BINARY"


def dropped_by_markup(tag: str, rest: str, inside: bool) -> bool:
    """Whether an element is outside any article by its name, role, class or id."""
    if tag in OUTSIDE or tag == "header" and not inside:
        return True
    if len(rest) < 3 or tag in ("html", "body", "main"):
        return False
    words: set[str] = set()
    for name, *values in ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if name == "role" and value.strip().lower() in OUTSIDE_ROLES:
            return True
        if name in ("class", "id"):
            words.update(word.lower() for word in WORD.findall(NEGATED.sub(" ", value)))
    return bool(words & OUTSIDE_WORDS) or not inside and bool(words & HEADER_WORDS)


def is_article(tag: str, rest: str) -> bool:
    return tag in ("article", "main") or bool(re.search(r"""role\s*=\s*["']?main\b|itemprop\s*=\s*["']?articleBody\b""", rest, re.I))


def lines_of(html: str) -> list[tuple[int, str]]:
    """The lines of a page in its order, with OPEN, INSIDE or DROPPED."""
    lines: list[tuple[int, str]] = []
    held: list[str] = []
    # Open elements that matter, name and the zone within, and how many are open of each name.
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    zone = OPEN

    def flush() -> None:
        if held:
            text = " ".join(references.unescape("".join(held)).split())
            held.clear()
            if text:
                lines.append((zone, text))

    def pop() -> str:
        flush()
        name, _ = stack.pop()
        opened[name] -= 1
        return name

    for token in TOKEN.finditer(html):
        if (text := token["text"]) is not None:
            held.append(text)
            continue
        if token["raw"]:
            flush()
            continue
        if token["tag"] is None:
            continue
        tag, rest = token["tag"].lower(), token["rest"]
        if tag not in INLINE:
            flush()
        if token["close"]:
            if opened[tag]:
                while pop() != tag:
                    pass
        else:
            while stack and (tag == "body" or stack[-1][0] in IMPLIED.get(tag, ()) or stack[-1][0] == "p" and tag not in INLINE):
                pop()
            above = within = stack[-1][1] if stack else OPEN
            if tag not in VOID:
                if above == DROPPED:
                    within = INSIDE if tag == "main" else DROPPED
                elif dropped_by_markup(tag, rest, above == INSIDE):
                    within = DROPPED
                elif is_article(tag, rest):
                    within = INSIDE
                if within != above or within == DROPPED or tag not in INLINE and tag != "p":
                    flush()
                    stack.append((tag, within))
                    opened[tag] += 1
        zone = stack[-1][1] if stack else OPEN
    flush()
    return lines


# Alignment.


def common_subsequence(one: list[int], other: list[int]) -> list[tuple[int, int]]:
    """Pairs of positions of a longest common subsequence.

    Bit-parallel over `other`, with the rows kept; halves of `one` are aligned apart where they would be too large."""
    begin = 0
    while begin < min(len(one), len(other)) and one[begin] == other[begin]:
        begin += 1
    end = 0
    while end < min(len(one), len(other)) - begin and one[-1 - end] == other[-1 - end]:
        end += 1
    head = [(i, i) for i in range(begin)]
    tail = [(len(one) - i, len(other) - i) for i in range(end, 0, -1)]
    one, other = one[begin : len(one) - end], other[begin : len(other) - end]
    if not one or not other or not set(one) & set(other):
        return head + tail
    if len(one) > 1 and len(one) * len(other) > ALIGNED_BITS:
        middle = len(one) // 2
        left = row_lengths(one[:middle], other)
        right = row_lengths(one[middle:][::-1], other[::-1])[::-1]
        cut = int(np.argmax(left + right))
        first = common_subsequence(one[:middle], other[:cut])
        second = common_subsequence(one[middle:], other[cut:])
        inner = first + [(i + middle, j + cut) for i, j in second]
    else:
        rows, i, j, inner = bit_rows(one, other, keep=True), len(one), len(other), []
        while i and j:
            if one[i - 1] == other[j - 1]:
                i, j = i - 1, j - 1
                inner.append((i, j))
            elif rows[i] >> (j - 1) & 1:  # no growth here: as long without this place
                j -= 1
            else:
                i -= 1
        inner.reverse()
    return head + [(i + begin, j + begin) for i, j in inner] + tail


def bit_rows(one: list[int], other: list[int], keep: bool) -> list[int]:
    """For each prefix of `one` a number whose bit j is not set where the longest common subsequence with a prefix of
    `other` grows at j; only that of the whole of `one` unless all are kept."""
    whole = (1 << len(other)) - 1
    places: dict[int, int] = {}
    for j, value in enumerate(other):
        places[value] = places.get(value, 0) | 1 << j
    row, rows = whole, [whole]
    for value in one:
        met = row & places.get(value, 0)
        row = ((row + met) | (row - met)) & whole
        if keep:
            rows.append(row)
    return rows if keep else [row]


def row_lengths(one: list[int], other: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of `one` and all prefixes of `other`."""
    (row,) = bit_rows(one, other, keep=False)
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(other) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.append(0, np.cumsum(1 - bits[: len(other)].astype(np.int64)))


class Page:
    """Line hashes of a page, and which lines each page it is paired with shares."""

    def __init__(self, host: str, k1: int, k2: int, hashes: bytes, zones: bytes, sizes: bytes):
        self.host, self.key = host, (k1, k2)
        self.lines = np.frombuffer(hashes, "<i8").tolist()
        self.set = set(self.lines)
        self.zones, self.sizes = np.frombuffer(zones, np.uint8), np.frombuffer(sizes, "<i4").astype(np.int64)
        self.shared: list[np.ndarray] = []

    def pair(self, other: Page) -> None:
        mine, theirs = np.zeros(len(self.lines), bool), np.zeros(len(other.lines), bool)
        if not self.set.isdisjoint(other.set):
            for i, j in common_subsequence(self.lines, other.lines):
                mine[i] = theirs[j] = True
        # A pair of copies tells nothing of either page.
        if min(self.rest(mine), other.rest(theirs)) > COPY_REST:
            self.shared.append(mine)
            other.shared.append(theirs)

    def rest(self, shared: np.ndarray) -> float:
        """Share of the text that is not shared, markup's outside aside."""
        kept = self.zones != DROPPED
        return float((self.sizes[kept & ~shared].sum()) / max(1, self.sizes[kept].sum()))

    def deleted(self) -> np.ndarray:
        lost = np.zeros(len(self.lines), bool)
        if not self.shared:
            return lost
        votes = np.sum(self.shared, axis=0)
        lost |= (self.zones == OPEN) & (2 * votes > len(self.shared))
        inside = self.zones == INSIDE
        whole = max(1, self.sizes[inside].sum())
        witnesses = [one for one in self.shared if self.sizes[inside & one].sum() < COPY_ARTICLE * whole]
        if len(witnesses) >= LEAST_WITNESSES:
            lost |= inside & np.all(witnesses, axis=0)
        return lost


def hashed_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in LINES.split(", ")]
    for part in slices(batches, SLICE_PAGES):
        rows: list[list[bytes]] = [[], [], []]
        for html in part.column("html").to_pylist():
            lines = lines_of(html or "")
            hashes = np.array([xxhash.xxh3_64_intdigest(text) for _, text in lines], "<u8")
            rows[0].append(hashes.tobytes())
            rows[1].append(bytes(zone for zone, _ in lines))
            rows[2].append(np.array([len(text) for _, text in lines], "<i4").tobytes())
        yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names[:4]), *(pa.array(c, pa.binary()) for c in rows)], names)


def differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deleted lines of pages, from rows ordered by block and rank; pages of other blocks only witness."""
    near: list[tuple[int, bool, Page]] = []
    of = None

    def out(entry: tuple[int, bool, Page]) -> Iterator[tuple]:
        _, own, page = entry
        if own and (lost := page.deleted()).any():
            yield *page.key, np.packbits(lost).tobytes()

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [field.split()[0] for field in DELETED.split(", ")])

    for part in slices(batches, SLICE_PAGES):
        rows: list[tuple] = []
        for row in part.to_pylist():
            if row["block"] != of:
                rows += [done for entry in near for done in out(entry)]
                near, of = [], row["block"]
            page = Page(*(row[name] for name in ("host", "k1", "k2", "hashes", "zones", "sizes")))
            while near and row["rank"] - near[0][0] > NEAREST:
                rows += out(near.pop(0))
            for _, _, other in near:
                if other.host == page.host:
                    other.pair(page)
            near.append((row["rank"], row["own"], page))
        if rows:
            yield batch(rows)
    rows = [done for entry in near for done in out(entry)]
    if rows:
        yield batch(rows)


def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each page: its lines but those that markup or differencing leave out."""
    for part in slices(batches, SLICE_PAGES):
        found = []
        for html, deleted in zip(part.column("html").to_pylist(), part.column("deleted").to_pylist(), strict=True):
            lines = lines_of(html or "")
            lost = np.unpackbits(np.frombuffer(deleted, np.uint8))[: len(lines)] if deleted else np.zeros(len(lines), np.uint8)
            zone = INSIDE if any(z == INSIDE for z, _ in lines) else OPEN
            found.append(" ".join(text for (z, text), gone in zip(lines, lost.tolist(), strict=True) if z == zone and not gone))
        columns = [part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html and two hashes of all three."""
    slim = over_all_cores(documents(pages, "page_id", "url", "html"))
    return slim.withColumns({"k1": F.xxhash64("page_id", "url", "html"), "k2": F.xxhash64(F.lit("2"), "html", "url", "page_id")})


def ranked(lines: DataFrame) -> DataFrame:
    """Rows with their rank by host and path, counted from range partitions without bringing them together."""
    in_order = ("host", "path", "k1", "k2")
    rows = lines.repartitionByRange(*in_order).sortWithinPartitions(*in_order)
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()), "page-lines")
    part = F.shiftright("at", 33)
    # A row for each partition.
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    rows = rows.withColumn("part", part).join(F.broadcast(sizes), "part")
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("rank", rank).drop("part", "before", "at")


def deletions(pages: DataFrame) -> DataFrame:
    """Rows of `DELETED` for the pages that lose lines by differencing: a bit for each line, in page order."""
    host, path = url_parts(F.col("url"))
    parts = keyed(pages).withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    lines = parts.select("host", "path", "k1", "k2", "html").mapInArrow(hashed_lines, LINES)
    rows = ranked(lines.dropDuplicates(["k1", "k2"]))
    block = F.floor(F.col("rank") / BLOCK_PAGES)
    reach = (F.greatest(F.col("rank") + d, F.lit(0)) for d in (-NEAREST, 0, NEAREST))
    around = F.array_distinct(F.array(*(F.floor(rank / BLOCK_PAGES) for rank in reach)))
    rows = rows.withColumn("home", block).withColumn("block", F.explode(around))
    rows = rows.withColumn("own", F.col("home") == F.col("block")).drop("home", "path")
    rows = rows.repartition("block").sortWithinPartitions("block", "rank")
    return stored(rows.mapInArrow(differenced, DELETED), "page-deletions")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    found = deletions(pages)
    rows = keyed(pages).join(found, ["k1", "k2"], "left").select("page_id", "url", "html", "deleted")
    return rows.mapInArrow(texts, "page_id BIGINT, url STRING, text STRING, n_chars BIGINT")
