"""N-gram Jaccard join by vertical partitioning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import mix, saved, slices, span_hashes, utf8, words
from cartloom.llm.components import components

FRAGMENT_SHINGLES = 3_000_000
FLUSH_SHINGLES = 1_500_000
#: Bytes kept of a shingle's hash in a fragment; the fragment's number gives the high bits.
KEPT_BYTES = 7
#: Parts of the global order in which the overlaps of a pair are counted.
SEGMENTS = 8
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, first: int, last: int, k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of each row; a shorter row is one shingle, an empty one none."""
    text, starts, ends, rows = words(data, offsets, first, last)
    own = span_hashes(text, starts, ends)
    counts = np.bincount(rows - first, minlength=last - first)
    stops = np.cumsum(counts)
    joined = np.zeros(max(0, len(own) - k + 1), np.uint64)
    for i in range(k):
        joined = joined * _STEP + own[i : len(own) - k + 1 + i]
    joined = mix(joined + np.uint64(k))
    out = []
    for m, stop in zip(counts.tolist(), stops.tolist(), strict=True):
        if m >= k:
            out.append(np.unique(joined[stop - m : stop - k + 1]))
        elif m:
            one = np.uint64(0)
            with np.errstate(over="ignore"):
                for w in own[stop - m : stop]:
                    one = one * _STEP + w
                out.append(mix(np.array([one + np.uint64(m)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(shingles: np.ndarray) -> int:
    """64-bit digest of a whole set; sets are the same where key and size are."""
    return int(mix(np.array([mix(shingles ^ _STEP).sum(dtype=np.uint64)], np.uint64)).view(np.int64)[0])


def each_set(batch: pa.RecordBatch, text_col: str, k: int):
    data, offsets = utf8(batch.column(text_col))
    for first, last in slices(offsets):
        yield first, last, shingle_sets(data, offsets, first, last, k)


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_hash, key, n_shingles) of every row."""

    def keys(batches):
        for batch in batches:
            for first, last, sets in each_set(batch, "text", k):
                ids, hashes = (batch.column(c).slice(first, last - first) for c in ("doc_id", "text_hash"))
                yield pa.record_batch([ids, hashes, pa.array([set_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())],
                                      ["doc_id", "text_hash", "key", "n_shingles"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(keys, "doc_id long, text_hash long, key long, n_shingles long")


PACKED = "fragment int, keys binary, sizes binary, counts binary, shingles binary"


def fragments(docs: DataFrame, k: int, n: int) -> DataFrame:
    """The sets cut at the same ``n`` ranges of the global order: packed rows of (fragment, sets, their shingles there)."""

    def flush(sets: list[np.ndarray]):
        keys, sizes = np.array([set_key(s) for s in sets], np.int64), np.array([len(s) for s in sets], np.int64)
        shingles, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        cell = (shingles >> np.uint64(64 - n.bit_length() + 1)).astype(np.uint16 if n <= 65536 else np.int64)
        order = np.argsort(cell, kind="stable")
        shingles, of, cell = shingles[order], of[order], cell[order]
        edges = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
        columns: list[list] = [[], [], [], [], []]
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            owners = of[low:high]
            heads = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
            who = owners[heads]
            counts = np.diff(np.concatenate((heads, [high - low]))).astype(np.int32)
            for column, value in zip(columns, (int(cell[low]), keys[who].tobytes(), sizes[who].astype(np.int32).tobytes(), counts.tobytes(),
                                               shingles[low:high].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEPT_BYTES].tobytes()), strict=True):
                column.append(value)
        types = [pa.int32(), *[pa.binary()] * 4]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["fragment", "keys", "sizes", "counts", "shingles"])

    def cut(batches):
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for _, _, sets in each_set(batch, "text", k):
                for s in sets:
                    if len(s):
                        held.append(s)
                        size += len(s)
                if size >= FLUSH_SHINGLES:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return docs.select("text").mapInArrow(cut, PACKED)


SHARED = "key long, n long, shingles array<long>, spread array<int>"


def shared_shingles(packed: DataFrame, n: int) -> DataFrame:
    """In each fragment: the shingles that two or more different sets have, with the number of sets (``spread``)."""

    def count(group: pa.Table) -> pa.Table:
        join = lambda name, kind: np.frombuffer(b"".join(group[name].to_pylist()), kind)
        keys, sizes, counts, raw = join("keys", np.int64), join("sizes", np.int32), join("counts", np.int32), join("shingles", np.uint8)
        wide = np.zeros((len(raw) // KEPT_BYTES, 8), np.uint8)
        wide[:, :KEPT_BYTES] = raw.reshape(-1, KEPT_BYTES)
        # The hash again, but for the bits between the fragment's number and the kept bytes.
        high = np.uint64(int(group["fragment"][0].as_py()) << (64 - n.bit_length() + 1)) if n > 1 else np.uint64(0)
        shingles = wide.view("<u8").ravel() | (high & ~np.uint64((1 << 8 * KEPT_BYTES) - 1))
        of = np.repeat(np.arange(len(keys), dtype=np.int64), counts)
        order = np.argsort(shingles, kind="stable")
        shingles, of = shingles[order], of[order]
        # Shingles that stand once are dropped first; then copies of a set are counted once.
        fresh = np.concatenate(([True], shingles[1:] != shingles[:-1]))
        many = ~fresh
        many[:-1] |= ~fresh[1:]
        shingles, of = shingles[many], of[many]
        order = np.lexsort((sizes[of], keys[of], shingles))
        shingles, of = shingles[order], of[order]
        own, size = keys[of], sizes[of]
        again = np.zeros(len(shingles), bool)
        again[1:] = (shingles[1:] == shingles[:-1]) & (own[1:] == own[:-1]) & (size[1:] == size[:-1])
        shingles, own, size = shingles[~again], own[~again], size[~again]
        heads = np.flatnonzero(np.concatenate(([True], shingles[1:] != shingles[:-1]))) if len(shingles) else np.zeros(0, np.int64)
        spread = np.repeat(np.diff(np.concatenate((heads, [len(shingles)]))), np.diff(np.concatenate((heads, [len(shingles)]))))
        keep = spread >= 2
        shingles, own, size, spread = shingles[keep], own[keep], size[keep], spread[keep]
        order = np.lexsort((shingles, size, own))
        shingles, own, size, spread = shingles[order], own[order], size[order], spread[order]
        heads = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (size[1:] != size[:-1])))) if len(own) else np.zeros(0, np.int64)
        offsets = np.concatenate((heads, [len(own)])).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v)) for v in (shingles.view(np.int64), spread.astype(np.int32))]
        return pa.table({"key": own[heads], "n": size[heads].astype(np.int64), "shingles": lists[0], "spread": lists[1]})

    return packed.groupBy("fragment").applyInArrow(count, SHARED)


def needed(n, percent: int):
    """Smallest overlap that a set of ``n`` can have with a set like it."""
    return F.ceil(n * percent / 100).cast("long")


def alike_sizes(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def between(rows: DataFrame, x: str, y: str, percent: int) -> DataFrame:
    """Distinct pairs (a, na, b, nb), the smaller node first, of different nodes whose sizes allow a link."""
    low, high = F.least(x, y), F.greatest(x, y)
    pairs = rows.select(low["key"].alias("a"), low["n"].alias("na"), high["key"].alias("b"), high["n"].alias("nb"))
    return pairs.where(((F.col("a") != F.col("b")) | (F.col("na") != F.col("nb"))) & alike_sizes("na", "nb", percent)).distinct()


def as_nodes(links: DataFrame) -> DataFrame:
    return links.select(F.struct(F.col("a").alias("key"), F.col("na").alias("n")).alias("a"), F.struct(F.col("b").alias("key"), F.col("nb").alias("n")).alias("b"))


def verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, na, b, nb) that link: overlaps are counted in each part of the order by itself and summed."""
    left = segments.select(F.col("key").alias("a"), F.col("n").alias("na"), "segment", F.col("shingles").alias("_left"))
    right = segments.select(F.col("key").alias("b"), F.col("n").alias("nb"), "segment", F.col("shingles").alias("_right"))
    parts = pairs.join(left, ["a", "na"]).join(right, ["b", "nb", "segment"])
    sums = parts.groupBy("a", "na", "b", "nb").agg(F.sum(F.size(F.array_intersect("_left", "_right"))).alias("both"))
    return sums.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "na", "b", "nb")


#: Up to so many sets around a hub, their pairs are listed; beyond it they are filtered by what tells them from the hub.
LISTED_SETS = 64


def across(here: DataFrame, able: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of holders (shingle, hub, node, root, hub_root) of a shingle that are in different components.

    Around a hub with few sets the holders of each shingle are paired. Around one with many, each set is written as its
    difference from the hub: x = hub ^ ex. Two sets differ by |ex| + |ey| - 2 |ex & ey|, so to link they must either both be
    so near the hub that |ex| + |ey| is allowed, or have parts of their differences in common: then they meet in the prefixes of these
    differences, rarest first, and their sketches differ in few bits. So a large group of near copies gives few pairs that don't link.
    """
    around = here.select("hub", "node", "root", "hub_root").distinct()
    many = saved(around.groupBy("hub").count().where(F.col("count") > LISTED_SETS).select("hub"))
    few = here.join(many, "hub", "left_anti")
    left = few.select("shingle", F.col("node").alias("x"), F.col("root").alias("rx"))
    listed = left.join(few.select("shingle", F.col("node").alias("y"), F.col("root").alias("ry")), "shingle").where("rx <> ry and x < y")

    sets = able.select(F.struct("key", "n").alias("node"), F.col("cells.shingles").alias("own"))
    centre = sets.select(F.col("node").alias("hub"), F.col("own").alias("_hub"))
    near = around.join(many, "hub", "left_semi").join(sets, "node").join(centre, "hub")
    # Shingles that no other set has are in no hub list and never in common.
    alone = F.col("node.n") - F.size("own")
    edits = F.concat(F.array_except("own", "_hub"), F.transform(F.array_except("_hub", "own"), F.bitwise_not))
    most = F.floor(F.col("node.n") * (100 - percent) / percent)
    near = near.select("hub", "node", "root", "hub_root", edits.alias("edits"), alone.alias("alone"), most.cast("long").alias("most"))
    # A sketch of 256 bits: two sketches differ in no more bits than the sets in shingles.
    bits = [F.expr(f"aggregate(filter(edits, e -> pmod(xxhash64(e, 1), 4) = {i}), 0L, (acc, e) -> acc | shiftleft(1L, cast(pmod(xxhash64(e), 64) AS int)))")
            for i in range(4)]
    near = saved(near.withColumn("sketch", F.struct("alone", *(b.alias(f"s{i}") for i, b in enumerate(bits)))))
    cells = near.select("hub", "node", "root", "sketch", (F.col("most") + 1 - F.col("alone")).cast("int").alias("length"), F.explode("edits").alias("edit"))
    cells = cells.where("length > 0")
    common = cells.groupBy("hub", "edit").agg(F.count("*").alias("c"), F.min("root").alias("low"), F.max("root").alias("high"))
    ranked = cells.join(common, ["hub", "edit"]).groupBy("hub", "node", "root", "sketch", "length").agg(
        F.array_sort(F.collect_list(F.struct("c", "edit", (F.col("low") != F.col("high")).alias("mixed")))).alias("cells"))
    entries = ranked.select("hub", "node", "root", "sketch", F.explode(F.slice("cells", F.lit(1), F.col("length"))).alias("e"))
    entries = saved(entries.where("e.mixed").select("hub", F.col("e.edit").alias("edit"), "node", "root", "sketch"))
    left = entries.select("hub", "edit", F.col("node").alias("x"), F.col("root").alias("rx"), F.col("sketch").alias("kx"))
    alike = left.join(entries.select("hub", "edit", F.col("node").alias("y"), F.col("root").alias("ry"), F.col("sketch").alias("ky")), ["hub", "edit"])
    apart = F.expr("kx.alone + ky.alone + " + " + ".join(f"bit_count(kx.s{i} ^ ky.s{i})" for i in range(4)))
    alike = alike.where((F.col("rx") != F.col("ry")) & (F.col("x") < F.col("y")) & (apart * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)))

    size = F.size("edits") + F.col("alone")
    close = near.select("hub", "node", "root", size.alias("off"), "most", (F.col("root") != F.col("hub_root")).alias("outer")).where("off <= most")
    left = close.where("outer").select("hub", F.col("node").alias("x"), F.col("root").alias("rx"), F.col("off").alias("ox"))
    sure = left.join(close.select("hub", F.col("node").alias("y"), F.col("root").alias("ry"), F.col("off").alias("oy")), "hub").where(
        (F.col("rx") != F.col("ry")) & ((F.col("ox") + F.col("oy")) * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)))
    return between(listed.select("x", "y").union(alike.select("x", "y")).union(sure.select("x", "y")), "x", "y", percent)


def set_links(docs: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """(key, n, root): the component of every set that links with another one."""
    total = int(sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0])
    count = 64  # or more: a power of two, so that the hash's high bits are the fragment
    while count * FRAGMENT_SHINGLES < total:
        count *= 2
    shared = shared_shingles(fragments(docs, k, count), count)

    # A set that shares fewer shingles than its smallest overlap links with nothing. A set's own shingles bound its list.
    whole = shared.groupBy("key", "n").agg(F.flatten(F.collect_list(F.arrays_zip("spread", "shingles"))).alias("cells"))
    able = whole.where(F.size("cells") >= needed(F.col("n"), percent))
    # Typical sets share their shingles with the most others.
    weight = F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + c["spread"]) * 1000 / F.col("n")
    able = saved(able.select("key", "n", weight.cast("long").alias("weight"), F.array_sort("cells").alias("cells")))

    # Prefix in the global order (rarest first; shingles of one set only stand before all shared ones).
    length = F.col("n") - needed(F.col("n"), percent) + 1 - (F.col("n") - F.size("cells"))
    prefix = F.slice("cells", F.lit(1), length.cast("int"))
    node = F.struct("key", "n")
    index = saved(able.select(node.alias("node"), "weight", F.posexplode(prefix).alias("at", "c"), length.alias("length")).select(
        F.col("c.shingles").alias("shingle"), "node", "weight", (F.col("at") == F.least(F.col("length"), F.lit(1 << 30)) - 1).alias("last")))
    cut = able.select("key", "n", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("segment"), F.col("cells.shingles").alias("shingles"))
    segments = saved(cut.withColumn("shingles", F.filter("shingles", lambda x: F.shiftrightunsigned(x, 61) == F.col("segment"))))

    # The most typical holder of a shingle is tried with the others: first by each set's last prefix shingle only, then by all of
    # those whose holders are still in different components.
    typical = F.max(F.struct("weight", "node"))["node"]
    hubs = saved(index.groupBy("shingle").agg(typical.alias("hub"), F.count("*").alias("c")).where("c > 1").drop("c"))
    pairs = between(index.where("last").join(hubs, "shingle"), "node", "hub", percent)
    tried = saved(pairs)
    links = saved(verified(tried, segments, percent))
    roots = components(as_nodes(links))
    for everything in (False, True):
        placed = index.select("shingle", "node", "weight").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), typical.alias("hub")).where("low <> high")
        hub_root = roots.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
        here = placed.join(mixed.select("shingle", "hub"), "shingle").join(hub_root, "hub", "left").withColumn("hub_root", F.coalesce("hub_root", "hub"))
        # Last, every pair of holders in different components: nothing else can join two of them.
        pairs = across(saved(here), able, percent) if everything else between(here.where("root <> hub_root"), "node", "hub", percent)
        pairs = saved(pairs.join(tried, ["a", "na", "b", "nb"], "left_anti"))
        more = saved(verified(pairs, segments, percent))
        if not more.isEmpty():
            links = links.union(more)
            roots = components(as_nodes(links))
        tried = tried.union(pairs)
    return roots.select(F.col("node.key").alias("key"), F.col("node.n").alias("n_shingles"), "root")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: documents whose shingle sets have a Jaccard likeness of at least
    ``percent``/100 link, and component_id is the smallest doc_id reachable by links.

    Words are lower-cased (A-Z) and cut at ASCII white space; a text with fewer than ``k`` words is one shingle.

    The hashed shingles have one global order, cut into fragments of about FRAGMENT_SHINGLES. A fragment's task finds how many
    different sets hold each shingle; equal sets are one. Sets that can't reach the threshold with the shingles they
    share leave. The rest are candidates where they meet in a prefix shingle, rarest first. The overlap of a pair is counted
    in each part of the order separately and summed. Candidates are first tried against the most typical holder of the shingle, then against all
    holders in other components; pairs within a component can't change the result. So no link between different sets is lost.

    Null, empty and blank texts have no shingles and link with nothing (their own id). Repeated rows of one id belong together if
    their texts link. Extra columns are left out. An empty table gives no rows. Shingles are known by hashes of 59 or more bits.
    """
    sets = saved(document_sets(docs, k).drop("text_hash"))
    roots = set_links(docs, sets, k, percent)
    placed = sets.join(roots, ["key", "n_shingles"], "left").withColumn(
        "root", F.coalesce("root", F.struct("key", F.col("n_shingles").alias("n"))))
    full = saved(placed.where("n_shingles > 0").select("doc_id", "n_shingles", "root"))
    first = full.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    empty = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.join(first, "root").select("doc_id", "n_shingles", "component_id").union(empty)


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of texts that link the one of smallest doc_id (null ids last) and text hash.

    Rows are chosen by id and text, so rows of one id with texts of different groups are judged each, and so are rows without an id.
    Texts without shingles are a group each. Of rows of equal doc_id and text one stays.
    """
    sets = saved(document_sets(docs, k))
    placed = sets.join(set_links(docs, sets, k, percent), ["key", "n_shingles"], "left").withColumn(
        "root", F.coalesce("root", F.struct("key", F.col("n_shingles").alias("n"))))
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    first = placed.where("n_shingles > 0").groupBy("root").agg(F.min(row).alias("row")).select("row._id", "row._hash")
    empty = sets.where("n_shingles = 0").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    stay = first.union(empty)
    # The caller's columns travel in one struct, so no name of theirs meets one of ours.
    hashed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id"), F.xxhash64("text").alias("text_hash"))
    kept = hashed.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left_semi")
    return kept.dropDuplicates(["doc_id", "text_hash"]).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
