"""Document fingerprints by content-defined chunking."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import SLICE_BYTES, slices, span_hashes, utf8

#: Chunk lengths in bytes: no boundary before LEAST, the strict mask up to NORMAL, the loose one up to MOST.
LEAST, NORMAL, MOST = 12, 32, 128
STRICT_BITS, LOOSE_BITS = 6, 4
DIGEST_BYTES = 6
ENTRY_BYTES = DIGEST_BYTES + 1

_STEPS = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_STEPS = (_STEPS ^ (_STEPS >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
GEAR = (_STEPS >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: its value shifted in, 32 bytes back, by five doublings of the window."""
    h = GEAR[data]
    width = 1
    while width < 32:
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    return h


def boundaries(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the chunks of the texts between ``edges``. The gear window may reach back beyond a chunk, but
    never beyond LEAST bytes into it, so a chunk's end depends on its own text only."""
    starts: list[int] = []
    ends: list[int] = []
    h = gear_hashes(data)
    # Only the bits that the last LEAST bytes decide are looked at.
    low = h & np.uint32((1 << LEAST) - 1)
    loose = np.flatnonzero(low >> np.uint32(LEAST - LOOSE_BITS) == 0) + 1
    strict = np.flatnonzero(low >> np.uint32(LEAST - STRICT_BITS) == 0) + 1
    loose_list, strict_list = [*loose.tolist(), len(data) + MOST], [*strict.tolist(), len(data) + MOST]
    i = j = 0
    for low_edge, high_edge in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        at = low_edge
        while at < high_edge:
            first, normal, last = at + LEAST, at + NORMAL, min(at + MOST, high_edge)
            while strict_list[i] < first:
                i += 1
            end = strict_list[i]
            if end > normal:
                while loose_list[j] < normal:
                    j += 1
                end = loose_list[j]
            end = min(end, last)
            starts.append(at)
            ends.append(end)
            at = end
    return np.array(starts, np.int64), np.array(ends, np.int64)


def fingerprints(data: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """One sorted set of (digest, length) entries for each text between ``edges``."""
    starts, ends = boundaries(data, edges)
    digests = span_hashes(data, starts, ends) >> np.uint64(8 * (8 - DIGEST_BYTES))
    entries = (digests << np.uint64(8)) | (ends - starts).astype(np.uint64)
    texts = np.searchsorted(edges, starts, "right") - 1
    order = np.lexsort((entries, texts))
    entries, texts = entries[order], texts[order]
    fresh = np.ones(len(entries), bool)
    fresh[1:] = (entries[1:] != entries[:-1]) | (texts[1:] != texts[:-1])
    entries, texts = entries[fresh], texts[fresh]
    packed = entries.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - ENTRY_BYTES :].tobytes()
    cuts = np.searchsorted(texts, np.arange(len(edges))) * ENTRY_BYTES
    return [packed[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def entries_of(fingerprint: bytes) -> np.ndarray:
    wide = np.zeros((len(fingerprint) // ENTRY_BYTES, 8), np.uint8)
    wide[:, 8 - ENTRY_BYTES :] = np.frombuffer(fingerprint, np.uint8).reshape(-1, ENTRY_BYTES)
    return wide.view(">u8").ravel().astype(np.uint64)


def containment(own: bytes, other: bytes) -> float:
    """Bytes of ``own``'s distinct chunks that ``other`` has too, of all of them; two empty ones are alike."""
    if own == other:
        return 1.0
    if not own or not other:
        return 0.0
    mine, theirs = entries_of(own), entries_of(other)
    places = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
    lengths = (mine & np.uint64(255)).astype(np.int64)
    return float(lengths[theirs[places] == mine].sum() / lengths.sum())


def fingerprint_texts(texts: list[bytes]) -> list[bytes]:
    """Fingerprints of texts, in slices of bounded size."""
    out: list[bytes] = []
    edges = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=edges[1:])
    for first, last in slices(edges):
        joined = np.frombuffer(b"".join(texts[first:last]), np.uint8)
        out += fingerprints(joined, edges[first : last + 1] - edges[first])
    return out


def spliced(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def compared(ids: list, texts: list[str]) -> dict[str, list]:
    """Results of all texts but the last, each against the one after it."""
    edited = [spliced(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    raw = [t.encode() for t in edited]
    marks, edits = fingerprint_texts([t.encode() for t in texts]), fingerprint_texts(raw)
    return {
        "doc_id": ids[:-1], "n_chars": [len(t) for t in texts[:-1]],
        "edited_sha256": [hashlib.sha256(t).hexdigest() for t in raw],
        "fingerprint": [m.hex() for m in marks[:-1]], "edited_fingerprint": [m.hex() for m in edits],
        "near_edited": [containment(a, b) for a, b in zip(marks[:-1], edits, strict=True)],
        "near_next": [containment(a, b) for a, b in zip(marks[:-1], marks[1:], strict=True)],
    }


def arrow_rows(rows: dict[str, list]) -> pa.RecordBatch:
    types = {"doc_id": pa.int64(), "n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}
    return pa.record_batch([pa.array(v, types.get(k, pa.string())) for k, v in rows.items()], list(rows))


def range_number(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are not above the key, found in two steps of about the root of their number."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    literal = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    upto = F.greatest(F.size(F.filter(literal([g[0] for g in groups], "array<long>"), lambda b: b <= key)) - 1, F.lit(0))
    inner = F.size(F.filter(F.get(literal(groups, "array<array<long>>"), upto), lambda b: b <= key))
    return (upto * step + inner).cast("int")


def fingerprint_documents(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fingerprint of every text and of its edited form, whose last half is the start of the next document.

    Texts are cut by a gear hash with normalised chunk lengths; a fingerprint is the set of chunk digests with their
    lengths, as hex. Likeness is containment: the share of a document's distinct chunk bytes that the other has.

    Ids are cut into ranges at quantiles (the driver holds the bounds, four for each partition). Texts are shuffled once, by range and
    sorted; each range also gets a copy of the next range's first document, so that a task meets every document's successor as
    it streams.

    Null text is empty; two empty texts are alike (1), an empty and a full one are not (0). Null ids come first; rows
    of one id are ordered by text. The last document's successor is the first one (itself, if alone). Extra
    columns are left out. An empty table gives no rows.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_key", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    cuts = rows.approxQuantile("_key", [i / (4 * n) for i in range(1, 4 * n)], 1 / (40 * n))
    rows = rows.withColumn("_range", range_number(F.col("_key"), sorted({int(c) for c in cuts})))
    firsts = [tuple(r) for r in rows.groupBy("_range").agg(F.min("_key")).orderBy("_range").collect()]
    before = [(firsts[i][1], firsts[i - 1][0]) for i in range(len(firsts))]  # the first one stands before the last range's end
    heads = spark.createDataFrame(before, "_key long, _before int")
    copies = rows.join(F.broadcast(heads), "_key").groupBy("_before").agg(F.min("text").alias("text"))
    copies = copies.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("_key"), F.col("_before").alias("_range"), F.lit(1).alias("_copy"))
    dealt = rows.withColumn("_copy", F.lit(0)).union(copies).repartition(n, "_range").sortWithinPartitions("_range", "_copy", "_key", "text")

    def stream(batches):
        kept = None  # (range, id, text) of a document whose successor comes next
        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for first, last in slices(offsets, 4 * SLICE_BYTES):
                piece = batch.slice(first, last - first)
                ids, texts, ranges, copied = (piece.column(c).to_pylist() for c in ("doc_id", "text", "_range", "_copy"))
                if kept is not None:
                    ids, texts, ranges, copied = [kept[0], *ids], [kept[1], *texts], [kept[2], *ranges], [0, *copied]
                # A range ends with its copy; every document but that has its successor after it.
                low = 0
                for at in range(len(ids)):
                    if copied[at] or at == len(ids) - 1:
                        if at > low:
                            yield arrow_rows(compared(ids[low : at + 1], texts[low : at + 1]))
                        low = at + 1
                kept = None if copied[-1] else (ids[-1], texts[-1], ranges[-1])

    return dealt.select("doc_id", "text", "_range", "_copy").mapInArrow(stream, RESULT)
