"""SentencePiece encoding and decoding by suffix-array matching."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructType

from cartloom.llm.common import slices, span_hashes, utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 0x2581
UNKNOWN_SHOWN = " ⁇ "
#: Units longer than this are merged one by one with a heap; encoded units kept from one slice for the next.
LONG_UNIT, KEPT_UNITS = 256, 200_000
SLICE = 1 << 20


@dataclass
class Vocabulary:
    """The pieces of a BPE model with byte fallback, as plain arrays."""

    pieces: list[str]
    scores: np.ndarray
    ids: np.ndarray
    bytes_at: int
    shown: bytes
    shown_ends: np.ndarray
    prefix: bool


def load(path: str = MODEL) -> Vocabulary:
    """Read a model file on the driver; the arrays (a bounded vocabulary) travel with the tasks."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        raw = file.read()
    proto.ParseFromString(raw)
    normal = proto.normalizer_spec
    if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or normal.precompiled_charsmap or normal.remove_extra_whitespaces:
        raise ValueError("only BPE models with byte fallback and identity normalisation are supported")
    model = SentencePieceProcessor(model_proto=raw)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    byte_ids = [i for i in range(n) if model.is_byte(i)]
    if any(chr(SPACE) in names[i].lstrip(chr(SPACE)) for i in plain) or byte_ids != list(range(byte_ids[0], byte_ids[0] + 256)):
        raise ValueError("pieces must have spaces in front only, and the byte pieces must stand together")

    def show(i: int) -> bytes:
        if model.is_byte(i):
            return bytes([i - byte_ids[0]])
        if model.is_control(i):
            return b""
        return (UNKNOWN_SHOWN if model.is_unknown(i) else names[i].replace(chr(SPACE), " ")).encode()

    shown = [show(i) for i in range(n)]
    return Vocabulary([names[i] for i in plain], np.array([model.get_score(i) for i in plain]), np.array(plain, np.int32),
                      byte_ids[0], b"".join(shown), np.cumsum([len(s) for s in shown]), normal.add_dummy_prefix)


def code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


class SuffixIndex:
    """Suffix array of a text of dense codes, ordered by as many symbols as the longest piece has.

    Ranks of four symbols come from packed keys; each further level doubles the width from pairs of ranks. The ranges of all
    pieces are found by binary search, halves first.
    """

    def __init__(self, codes: np.ndarray, width: int):
        self.size = len(codes)
        padded = np.concatenate((codes.astype(np.uint64), np.zeros(4, np.uint64)))
        key = (padded[:-4] << np.uint64(48)) | (padded[1:-3] << np.uint64(32)) | (padded[2:-2] << np.uint64(16)) | padded[3:-1]
        self.keys: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        reach = 4
        while True:
            distinct, rank = np.unique(key, return_inverse=True)
            self.keys.append(distinct)
            self.ranks.append(rank)
            if reach >= width:
                break
            follow = np.concatenate((rank[reach:], np.full(min(reach, self.size), -1, rank.dtype))) + 1
            key = rank.astype(np.uint64) * np.uint64(self.size + 2) + follow.astype(np.uint64)
            reach *= 2
        self.order = np.argsort(self.ranks[-1], kind="stable")
        self.sorted = self.ranks[-1][self.order]

    def find(self, pieces: np.ndarray, lengths: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Range of ranks at ``level`` whose symbols begin with each piece (rows padded with zeros)."""
        distinct = self.keys[level]
        if level == 0:
            low = np.zeros(len(pieces), np.uint64)
            high = np.zeros(len(pieces), np.uint64)
            for i in range(4):
                given = i < lengths
                low = (low << np.uint64(16)) | np.where(given, pieces[:, i], 0).astype(np.uint64)
                high = (high << np.uint64(16)) | np.where(given, pieces[:, i], 0xFFFF).astype(np.uint64)
            return np.searchsorted(distinct, low, "left"), np.searchsorted(distinct, high, "right")
        half = 2 << level
        first_low, first_high = self.find(pieces[:, :half], np.minimum(lengths, half), level - 1)
        second_low, second_high = self.find(pieces[:, half:], np.maximum(lengths - half, 0), level - 1)
        longer = lengths > half
        base = np.uint64(self.size + 2)
        low = first_low.astype(np.uint64) * base + np.where(longer, second_low + 1, 0).astype(np.uint64)
        # A longer piece needs its whole first half: one rank, or none.
        last = np.where(longer, first_low.astype(np.uint64) * base + second_high.astype(np.uint64), first_high.astype(np.uint64) * base - np.uint64(1))
        ends = np.searchsorted(distinct, last, "right")
        begins = np.searchsorted(distinct, low, "left")
        none = (first_low >= first_high) | (longer & (second_low >= second_high))
        return begins, np.where(none, begins, np.maximum(ends, begins))

    def occurrences(self, pieces: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, piece) of every occurrence of every piece."""
        low, high = self.find(pieces, lengths, len(self.keys) - 1)
        low, high = np.searchsorted(self.sorted, low, "left"), np.searchsorted(self.sorted, high, "left")
        count = high - low
        which = np.repeat(np.arange(len(pieces)), count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        return self.order[at], which


class Encoder:
    """Encodes distinct units (a run of spaces and the word after it) of many texts at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        letters = np.unique(code_points(vocabulary.pieces))
        if len(letters) >= 0xFFFE:
            raise ValueError("too many different characters")
        self.code_of = np.zeros(0x110000, np.uint16)  # 0: in no piece
        self.code_of[letters] = np.arange(1, len(letters) + 1)
        self.lengths = np.array([len(p) for p in vocabulary.pieces])
        self.width = int(self.lengths.max())
        reach = 4
        while reach < self.width:
            reach *= 2
        self.pieces = np.zeros((len(self.lengths), reach), np.uint16)
        flat = self.code_of[code_points(vocabulary.pieces)]
        alone = np.flatnonzero(self.lengths == 1)
        self.single = np.full(len(letters) + 1, -1)  # pieces of one character need no search
        self.single[flat[np.cumsum(self.lengths)[alone] - 1]] = alone
        self.wide = np.flatnonzero(self.lengths > 1)
        rows = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.pieces[rows, np.arange(len(flat)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)] = flat
        self.forget()

    def forget(self) -> None:
        self.known, self.ends, self.flat = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.lookup = np.zeros(0, np.int64)

    def units(self, points: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Starts of the units: before a space that follows no space, around characters of no piece, at each text."""
        space, strange = points == SPACE, self.code_of[points] == 0
        begin = np.zeros(len(points), bool)
        begin[1:] = (space[1:] & ~space[:-1]) | strange[1:] | strange[:-1]
        begin[edges[:-1][edges[:-1] < edges[1:]]] = True
        return np.flatnonzero(begin)

    def edges_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of all pieces of two or more characters in the indexed text, sorted by position and length: (key, piece)."""
        at, which = SuffixIndex(codes, self.width).occurrences(self.pieces[self.wide], self.lengths[self.wide])
        piece = self.wide[which]
        key = at * (self.width + 1) + self.lengths[piece]
        order = np.argsort(key)
        return key[order], piece[order]

    def merge(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of each unit of the text (flat) and their ends. Every edge is a merge that may be made; each round relaxes, in
        each unit, the edge of best score (then the leftmost) that spans two neighbouring symbols."""
        gaps = np.cumsum(sizes + 1) - sizes - 1  # a zero stands after each unit
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        own = np.repeat(gaps, sizes) + inside
        points = np.zeros(int(sizes.sum()) + len(sizes), np.uint32)
        points[own] = text[np.repeat(starts, sizes) + inside]
        codes = self.code_of[points]
        keys, piece = self.edges_of(codes)
        scores, span = self.vocabulary.scores, self.width + 1

        def edge(start: np.ndarray, length: np.ndarray) -> np.ndarray:
            want = start * span + length
            found = np.minimum(np.searchsorted(keys, want), max(0, len(keys) - 1))
            good = (length <= self.width) & (keys[found] == want) if len(keys) else np.zeros(len(want), bool)
            return np.where(good, piece[found] if len(keys) else 0, -1)

        symbol = np.zeros(len(points), bool)
        symbol[own] = True
        stop = np.zeros(len(points), np.int64)  # end of the unit that a position is in
        stop[own] = np.repeat(gaps + sizes, sizes)
        for u in np.flatnonzero(sizes > LONG_UNIT):
            self.merge_long(int(gaps[u]), int(gaps[u] + sizes[u]), symbol, keys, piece)
        starts = own[np.repeat(sizes <= LONG_UNIT, sizes)]
        while len(starts):
            end = stop[starts]
            after = np.append(starts[1:], len(points))
            last = np.append(starts[2:], [len(points)] * min(2, len(starts)))[: len(starts)]
            reach = np.minimum(last, end)
            pair = after < end
            found = np.where(pair, edge(starts, reach - starts), -1)
            value = np.where(found >= 0, scores[found], -np.inf)
            heads = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1])))
            most = np.maximum.reduceat(value, heads)
            unit = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(starts))))
            best = np.flatnonzero((value == most[unit]) & (found >= 0))
            best = best[np.concatenate(([True], unit[best][1:] != unit[best][:-1]))] if len(best) else best
            symbol[after[best]] = False
            open_ = np.isfinite(most)[unit]
            open_[best + 1] = False
            starts = starts[open_]
        begin = np.flatnonzero(symbol)
        length = np.minimum(np.append(begin[1:], len(points)), stop[begin]) - begin
        found = np.where(length == 1, self.single[codes[begin]], edge(begin, length))
        ids, bare = self.vocabulary.ids[found], found < 0
        owner = np.searchsorted(gaps, begin, "right") - 1
        if bare.any():
            raw = [chr(p).encode("utf-8", "replace") for p in points[begin[bare]].tolist()]
            count = np.ones(len(begin), np.int64)
            count[bare] = [len(r) for r in raw]
            spread, owner = np.repeat(ids, count), np.repeat(owner, count)
            spread[np.repeat(bare, count)] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32) + self.vocabulary.bytes_at
            ids = spread
        return ids, np.cumsum(np.bincount(owner, minlength=len(sizes)))

    def merge_long(self, low: int, high: int, symbol: np.ndarray, keys: np.ndarray, piece: np.ndarray) -> None:
        """The same for one long unit, with a heap."""
        span, scores = self.width + 1, self.vocabulary.scores
        first, last = np.searchsorted(keys, [low * span, high * span])
        edges = dict(zip(keys[first:last].tolist(), scores[piece[first:last]].tolist(), strict=True))
        after, before = {i: i + 1 for i in range(low, high)}, {i: i - 1 for i in range(low, high)}
        heap: list[tuple[float, int, int, int]] = []

        def offer(a: int) -> None:
            b = after[a]
            if b < high and after[b] - a < span and (score := edges.get(a * span + after[b] - a)) is not None:
                heapq.heappush(heap, (-score, a, b, after[b]))

        for i in range(low, high):
            offer(i)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if after.get(a) != b or after.get(b) != c:
                continue
            after[a] = c
            del after[b]
            symbol[b] = False
            if c < high:
                before[c] = a
            offer(a)
            if before[a] >= low:
                offer(before[a])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts (flat) and the end of each text's ids."""
        mark = chr(SPACE)
        shaped = [(mark if self.vocabulary.prefix and t else "") + t.replace(" ", mark) for t in texts]
        points = code_points(shaped)
        edges = np.concatenate(([0], np.cumsum([len(t) for t in shaped]))).astype(np.int64)
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        starts = self.units(points, edges)
        stops = np.append(starts[1:], len(points))
        distinct, first, inverse = np.unique(span_hashes(points, starts, stops), return_index=True, return_inverse=True)
        if len(self.known) > KEPT_UNITS:
            self.forget()
        place = np.searchsorted(self.known, distinct)
        fresh = (place >= len(self.known)) | (self.known[np.minimum(place, max(0, len(self.known) - 1))] != distinct) if len(self.known) else np.ones(len(distinct), bool)
        if fresh.any():
            ids, ends = self.merge(points, starts[first[fresh]], (stops - starts)[first[fresh]])
            self.lookup = np.concatenate((self.lookup, np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(ends))))
            self.ends = np.concatenate((self.ends, ends + self.ends[-1]))
            self.flat = np.concatenate((self.flat, ids.astype(np.int32)))
            self.known = np.concatenate((self.known, distinct[fresh]))
            order = np.argsort(self.known)
            self.known, self.lookup = self.known[order], self.lookup[order]
        row = self.lookup[np.searchsorted(self.known, distinct)][inverse]
        count = self.ends[row + 1] - self.ends[row]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.ends[row], count)
        ends = np.concatenate(([0], np.cumsum(count)))
        return self.flat[at], ends[np.searchsorted(starts, edges[1:], "left")]


def decode(vocabulary: Vocabulary, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts that the ids show, and their offsets."""
    starts = np.concatenate(([0], vocabulary.shown_ends[:-1]))
    count = (vocabulary.shown_ends - starts)[ids]
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(starts[ids], count)
    data = np.frombuffer(vocabulary.shown, np.uint8)[at]
    offsets = np.concatenate(([0], np.concatenate(([0], np.cumsum(count)))[ends]))
    if vocabulary.prefix and len(data):
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        heads = heads[data[heads] == 32]
        gone = np.zeros(len(data) + 1, np.int64)
        gone[heads + 1] = 1
        keep = np.ones(len(data), bool)
        keep[heads] = False
        offsets = offsets - np.cumsum(gone)[offsets]
        data = data[keep]
    return data, offsets


def encode_documents(docs: DataFrame, vocabulary: Vocabulary | None = None, text_col: str = "text", out_col: str = "piece_ids") -> DataFrame:
    """All columns of ``docs`` and piece_ids (array<int>), n_pieces, round_trip (decoding gives the text again).

    Each slice of texts is cut into units that no piece can cross; the distinct ones are concatenated and indexed by a suffix array,
    every piece is found by binary search, and the edges, sorted by position, are relaxed into the model's merges. Characters
    in no piece become byte pieces. The whole text is encoded. Null text gives null ids, 0 pieces and a null round trip; an
    empty text has no ids. Columns of the new names are replaced. A lower one-eighth block (the space mark itself) in a text decodes
    as a space, so its round trip is false.
    """
    vocabulary = vocabulary or load()
    keep = [c for c in docs.columns if c not in (out_col, "n_pieces", "round_trip")]
    schema = StructType([docs.schema[c] for c in keep])
    for name, kind in ((out_col, ArrayType(IntegerType())), ("n_pieces", LongType()), ("round_trip", BooleanType())):
        schema = schema.add(name, kind)

    def run(batches):
        encoder = Encoder(vocabulary)
        for batch in batches:
            data, offsets = utf8(batch.column(text_col))
            for first, last in slices(offsets, SLICE):
                piece = batch.slice(first, last - first)
                column = piece.column(text_col)
                ids, ends = encoder.encode([t or "" for t in column.to_pylist()])
                shown, places = decode(vocabulary, ids, ends)
                edges = offsets[first : last + 1]
                same = np.diff(places) == np.diff(edges)
                own = data[edges[0] : edges[-1]]
                if same.all():
                    wrong = np.flatnonzero(shown != own)
                    same[np.searchsorted(places, wrong, "right") - 1] = False
                else:
                    for i in np.flatnonzero(same):
                        same[i] = np.array_equal(shown[places[i] : places[i + 1]], data[edges[i] : edges[i + 1]])
                none = np.asarray(column.is_null())
                starts = np.concatenate(([0], ends)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(ids.astype(np.int32)), mask=pa.array(none))
                new = [lists, pa.array(np.diff(starts).astype(np.int64)), pa.array(same, mask=none)]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), *new], [*keep, out_col, "n_pieces", "round_trip"])

    return docs.select(*keep).mapInArrow(run, schema)


def decode_documents(docs: DataFrame, vocabulary: Vocabulary | None = None, ids_col: str = "piece_ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``docs`` and the text that the ids show. Null ids give null; bytes that aren't UTF-8 show as U+FFFD."""
    vocabulary = vocabulary or load()
    keep = [c for c in docs.columns if c != out_col]

    def run(batches):
        for batch in batches:
            column = batch.column(ids_col)
            ids = np.asarray(column.flatten(), np.int64)
            ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            data, offsets = decode(vocabulary, ids, ends.astype(np.int64))
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") if v else None for a, b, v in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, out_col])

    return docs.select(*keep).mapInArrow(run, StructType([docs.schema[c] for c in keep]).add(out_col, "string"))
