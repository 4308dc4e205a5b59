"""Main text of web pages by differencing pages of near URLs."""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm.common import saved

#: Elements whose content is never text of the page.
HIDDEN = {"script", "style", "noscript", "template", "svg", "iframe", "object", "select", "textarea", "title", "head"}
#: Elements around the article. In a form or a header that holds an article, the article is still one.
AROUND = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button"}
FRAMES = {"header", "form"}
#: Roles that say the same.
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "dialog"}
#: Class and id names that mark such parts, as whole names of elements that hold other blocks. They only break ties.
NAMES = {
    "ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "nav", "navbar", "menu", "header", "footer", "sidebar", "cookies", "cookie-notice",
    "consent", "notice", "popup", "modal", "newsletter", "subscribe", "comments", "comment", "replies", "disqus", "breadcrumb", "breadcrumbs", "share",
    "social", "related", "login", "signup", "widget",
}
HOLDERS = {"div", "section", "ul", "ol", "dl", "table", "fieldset", "details", "center"}
MAIN = {"article", "main"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: What the markup says of a block: nothing, part of the article, part of the surroundings, marked as such by a class name only.
OPEN, INSIDE, OUTSIDE, MARKED = 0, 1, 2, 3
#: While reading: in a frame that may still hold the article; in an article that stands in a marked part.
FRAME, TEASER = 4, 5


def zone_of(name: str, attributes: str, zone: int) -> int:
    """The zone that an opened block starts inside ``zone``."""
    if name in MAIN:
        if zone == OUTSIDE and name != "main":
            return OUTSIDE
        return TEASER if zone in (MARKED, TEASER) and name != "main" else INSIDE
    if zone == OUTSIDE or name in ("html", "body"):
        return zone
    names: set[str] = set()
    for m in NAMED.finditer(attributes):
        words = next((x for x in m.groups()[1:] if x is not None), "").lower().split()
        if m[1].lower() == "role":
            if zone != INSIDE and ROLES.intersection(words):
                return OUTSIDE
            if zone == OPEN and "main" in words:
                return INSIDE
        names.update(words)
    if name in AROUND and not (name == "header" and zone in (INSIDE, TEASER)):
        return FRAME if name in FRAMES and zone in (OPEN, FRAME) else OUTSIDE
    if zone == OPEN and "main" in names:
        return INSIDE
    if name in HOLDERS and zone != FRAME and NAMES & names:
        return MARKED
    return zone


def blocks(page: str) -> list[tuple[str, int]]:
    """Text blocks in page order with what the markup says of each. Markup that is cut off or never closed is taken as it
    comes; character references are decoded; white space inside a block is one space. Articles inside a marked part are
    the page's article where it has no other."""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []
    zone = OPEN
    at, end = 0, len(page)

    def close() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, zone))
        parts.clear()

    while at < end:
        found = PIECE.search(page, at)
        if not found:
            parts.append(html.unescape(page[at:]))
            break
        parts.append(html.unescape(page[at : found.start()]))
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name in HIDDEN and name != "head":
            if not found[1] and not found[3].rstrip().endswith("/"):
                over = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = over.end() if over else end
            continue
        if name in BLOCKS:
            close()
        elif name == "br":
            parts.append(" ")
        if found[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    zone = stack[i][1]
                    del stack[i:]
                    break
        elif name in BLOCKS and name not in EMPTY and not (name == "p" and stack and stack[-1][0] == "p"):
            stack.append((name, zone))
            zone = zone_of(name, found[3], zone)
    close()
    alone = all(z != INSIDE for _, z in out)
    last = {FRAME: OUTSIDE, TEASER: INSIDE if alone else MARKED}
    return [(text, last.get(z, z)) for text, z in out]


#: Pairs of equal lines up to which places are listed; beyond it alignment takes linear memory.
LISTED_PAIRS = 1 << 16


def by_places(a: list[int], b: list[int]) -> list[int]:
    """Indices of ``a`` in a longest common subsequence (Hunt and Szymanski): a longest increasing run of places, kept
    by patience piles. Memory follows the pairs of equal lines."""
    places: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    tails: list[int] = []
    tail_nodes: list[int] = []
    nodes: list[tuple[int, int]] = []  # (line, node before)
    for i, line in enumerate(a):
        for j in places.get(line, ()):
            k = bisect_left(tails, j)
            nodes.append((i, tail_nodes[k - 1] if k else -1))
            if k == len(tails):
                tails.append(j)
                tail_nodes.append(len(nodes) - 1)
            else:
                tails[k] = j
                tail_nodes[k] = len(nodes) - 1
    out, at = [], tail_nodes[-1] if tail_nodes else -1
    while at >= 0:
        out.append(nodes[at][0])
        at = nodes[at][1]
    return out


def common_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with every beginning of ``b``: one bit per line of ``b``,
    carried through additions of one wide integer (Crochemore and others, Hyyrö)."""
    masks: dict[int, int] = {}
    for j, line in enumerate(b):
        masks[line] = masks.get(line, 0) | (1 << j)
    full = (1 << len(b)) - 1
    row = full
    for line in a:
        same = row & masks.get(line, 0)
        row = ((row + same) | (row - same)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def by_halves(a: list[int], b: list[int]) -> list[int]:
    """Indices of ``a`` in a longest common subsequence, in linear memory (Hirschberg): ``b`` is cut where the first half of
    ``a`` from the front and the second from the back share most."""
    out, todo = [], [(0, a, b)]
    while todo:
        base, left, right = todo.pop()
        if not left or not right:
            continue
        if len(left) * len(right) <= LISTED_PAIRS:
            out.extend(base + i for i in by_places(left, right))
            continue
        if len(left) == 1:
            if left[0] in right:
                out.append(base)
            continue
        half = len(left) // 2
        cut = int((common_lengths(left[:half], right) + common_lengths(left[half:][::-1], right[::-1])[::-1]).argmax())
        todo += [(base, left[:half], right[:cut]), (base + half, left[half:], right[cut:])]
    return out


def longest_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which lines of ``a`` are in a longest common subsequence of both."""
    shared = np.zeros(len(a), bool)
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[len(a) - 1 - high] == b[len(b) - 1 - high]:
        high += 1
    shared[:low] = True
    shared[len(a) - high :] = True
    # Lines that the other page doesn't have can't be shared.
    left, right = np.arange(low, len(a) - high), b[low : len(b) - high]
    left = left[np.isin(a[left], right)]
    right = right[np.isin(right, a[left])]
    if not len(left) or not len(right):
        return shared
    lines, theirs = np.unique(a[left], return_counts=True), np.unique(right, return_counts=True)
    pairs = int((lines[1] * theirs[1]).sum())  # both hold the same lines
    align = by_places if pairs <= LISTED_PAIRS else by_halves
    shared[left[align(a[left].tolist(), right.tolist())]] = True
    return shared


def neighbours(rows: DataFrame, order: list[str], partitions: int) -> DataFrame:
    """The rows with ``before`` and ``after``: the rows next to each in the whole order, as structs of the order columns.

    Rows are range-partitioned; windows run inside a partition, so no group is gathered. The ends of the partitions (two rows
    of each) are fitted together.
    """
    me = F.struct(*order)
    cut = saved(rows.repartitionByRange(partitions, *order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*order)
    cut = cut.withColumn("before", F.lag(me).over(inside)).withColumn("after", F.lead(me).over(inside))
    ends = cut.groupBy("_part").agg(F.min(me).alias("low"), F.max(me).alias("high"))
    along = Window.orderBy("_part")
    ends = ends.select("_part", F.lag("high").over(along).alias("_low"), F.lead("low").over(along).alias("_high"))
    joined = cut.join(ends, "_part", "left")
    return joined.withColumn("before", F.coalesce("before", "_low")).withColumn("after", F.coalesce("after", "_high")).drop("_part", "_low", "_high")


def common_prefix(a, b):
    """Number of equal characters in front of two strings, path step by path step."""
    steps = F.zip_with(F.split(a, "/", -1), F.split(b, "/", -1), lambda x, y: F.when(x == y, F.length(x) + 1).otherwise(-1))
    return F.aggregate(steps, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda acc, x: F.struct(
        F.when(acc["on"] & (x >= 0), acc["n"] + x).otherwise(acc["n"]).alias("n"), (acc["on"] & F.coalesce(x >= 0, F.lit(False))).alias("on")), lambda acc: acc["n"])


EXTRACTED = "lines array<string>, zones array<int>, hashes array<long>"


def extract_pages(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """(page_id, url, text, n_chars, n_lines, n_shared) of every page: the blocks of its article, joined by newlines.

    Each page is paired with the page of nearest URL path in its host: of its two neighbours in path order the one with the longer common
    path. Pages of a host with the same blocks, but for those the markup calls surroundings, are copies: they take one place in that
    order, at the smallest of their paths, and are all compared with the page next to it, never with each other.
    The text lines of both are aligned by a longest common subsequence, and lines that both have are deleted, inside an
    ``article`` or ``main`` element as well; lines outside of it that the markup says nothing of stay if the other page doesn't have
    them. Markup decides in two cases: blocks inside the elements (or roles) of menus, headers, footers, sidebars and forms are
    never text, and where at least half of the characters in the page's articles are on shared lines, the two are copies
    of one article rather than pages with the same surroundings, and the articles stay whole. Class names break a tie: lines the
    other page doesn't have go where a containing block is named as advert, notice, sidebar or comments, unless the page then has no text.

    Null and empty html give an empty text. A null or malformed url is a host of its own (the empty one) with the url as path. Pages alone in their host are
    compared with none. Extra columns are left out; an empty table
    gives no rows. Only line hashes are shuffled to the pairs; html is read by the page's own task.
    """
    spark = pages.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches):
        from cartloom.llm.common import span_hashes

        for batch in batches:
            lines, zones, hashes = [], [], []
            for page in batch.column("html").to_pylist():
                found = blocks(page or "")
                texts = [t.encode("utf-8", "surrogatepass") for t, _ in found]
                edges = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
                own = span_hashes(np.frombuffer(b"".join(texts), np.uint8), edges[:-1], edges[1:])
                lines.append([t if z != OUTSIDE else None for t, z in found])  # other lines count by their hash only
                zones.append([z for _, z in found])
                hashes.append(own.view(np.int64))
            keep = [batch.column(c) for c in ("page_id", "url")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(lines, pa.list_(pa.string())), pa.array(zones, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64()))],
                ["page_id", "url", "lines", "zones", "hashes"])

    found = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    read = found.mapInArrow(cut, f"page_id long, url string, {EXTRACTED}")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*|[?#].*$", "")
    keyed = read.select(host.alias("host"), path.alias("path"), "page_id", "url", "lines", "zones", "hashes")
    blocks_of = F.filter(F.arrays_zip("hashes", "zones"), lambda x: x["zones"].isin(OPEN, INSIDE))
    keyed = keyed.withColumn("node", F.xxhash64("host", blocks_of)).withColumn("mark", F.xxhash64("host", "hashes", "zones"))
    # Pairs need hashes only; the texts are read again at the end rather than kept.
    narrow = saved(keyed.select("host", "path", "node", "mark", "hashes"))
    order = ["host", "path", "mark"]
    places = narrow.groupBy("host", "node").agg(F.min(F.struct("path", "mark")).alias("first")).select("host", "first.path", "node", "first.mark")
    placed = neighbours(places, order, n)
    near = lambda side: F.when(F.col(side)["host"] == F.col("host"), common_prefix(F.col("path"), F.col(side)["path"])).otherwise(-1)
    placed = placed.withColumn("_b", F.coalesce(near("before"), F.lit(-1))).withColumn("_a", F.coalesce(near("after"), F.lit(-1)))
    pair = F.when((F.col("_b") < 0) & (F.col("_a") < 0), None).when(F.col("_a") > F.col("_b"), F.col("after")["mark"]).otherwise(F.col("before")["mark"])
    pairs = narrow.select("node", "mark").distinct().join(placed.select("node", pair.alias("other")), "node").select("mark", "other")
    own = narrow.select("mark", "hashes").dropDuplicates(["mark"])
    sides = pairs.join(own, "mark").join(own.select(F.col("mark").alias("other"), F.col("hashes").alias("theirs")), "other", "left").select("mark", "hashes", "theirs")

    def differ(batches):
        for batch in batches:
            shared = [longest_common(np.array(a, np.int64), np.array(b or [], np.int64)).tolist()
                      for a, b in zip(batch.column("hashes").to_pylist(), batch.column("theirs").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("mark"), pa.array(shared, pa.list_(pa.bool_()))], ["mark", "shared"])

    marked = sides.mapInArrow(differ, "mark long, shared array<boolean>")
    full = keyed.select("mark", "page_id", "url", "lines", "zones").join(saved(marked), "mark")
    cells = F.arrays_zip("lines", "zones", "shared")
    # Characters of the articles: on lines that are the page's own, less those on shared lines.
    own_more = F.aggregate(cells, F.lit(0), lambda acc, x: acc + F.when(x["zones"] != INSIDE, 0).when(x["shared"], -F.length(x["lines"])).otherwise(F.length(x["lines"])))
    full = full.withColumn("copies", own_more <= 0)
    plain = F.filter(cells, lambda x: x["zones"].isin(OPEN, INSIDE) & (~x["shared"] | (F.col("copies") & (x["zones"] == INSIDE))))
    marked_only = F.filter(cells, lambda x: (x["zones"] == MARKED) & ~x["shared"])
    kept = F.when(F.size(plain) > 0, plain).otherwise(marked_only)
    text = F.array_join(F.transform(kept, lambda x: x["lines"]), "\n")
    return full.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), F.size("lines").cast("long").alias("n_lines"),
                       F.size(F.filter("shared", lambda s: s)).cast("long").alias("n_shared"))
