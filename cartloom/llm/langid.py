"""Language identification by averaged hashed subword embeddings."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm.common import saved, slices, utf8

UNKNOWN = "und"
BUCKETS = 4096
#: Labels up to which their table of counts is sent to every task.
SENT_LABELS = 100_000
LETTER = re.compile(r"[^\W\d_]")
#: Every byte that isn't part of a word's letters counts as one boundary mark.
_MARK = np.arange(256, dtype=np.uint32)
_MARK[:65] = _MARK[91:97] = _MARK[123:128] = 32


def subword_counts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Counts (one row per text between ``edges``) of hashed byte n-grams of 2 to 4 bytes, word boundaries included."""
    out = np.zeros((len(edges) - 1, BUCKETS), np.float32)
    marks = _MARK[data]
    rows = np.repeat(np.arange(len(edges) - 1, dtype=np.int64), np.diff(edges))
    h = marks * np.uint32(0x9E3779B1)
    blank = marks == 32
    for n in range(2, 5):
        if len(data) < n:
            break
        h = (h[:-1] ^ (marks[n - 1 :] + np.uint32(n))) * np.uint32(0x85EBCA6B)
        whole = (rows[: len(h)] == rows[n - 1 :]) & ~(blank[: len(h)] & blank[1 : len(h) + 1])
        slot = rows[: len(h)][whole] * BUCKETS + (h[whole] >> np.uint32(20))
        out += np.bincount(slot, minlength=out.size).reshape(out.shape)
    return out


def features(column: pa.Array):
    """Row ranges and their subword counts; letters are lower-cased first."""
    texts = [(t or "").lower() for t in column.to_pylist()]
    has_letter = np.array([LETTER.search(t) is not None for t in texts], bool)
    data, offsets = utf8(pa.array(texts, pa.string()))
    for first, last in slices(offsets):
        for at in range(first, last, 256):
            end = min(at + 256, last)
            low, high = int(offsets[at]), int(offsets[end])
            yield at, end, subword_counts(data[low:high], offsets[at : end + 1] - low), has_letter[at:end]


@dataclass
class Model:
    """Subword vectors, softmax weights, temperature and the score under which a text is rejected."""

    languages: list[str]
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def logits(self, counts: np.ndarray) -> np.ndarray:
        mean = counts @ self.vectors / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return mean @ self.weights + self.bias

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return softmax(self.logits(counts) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def descend(counts: np.ndarray, labels: np.ndarray, n: int, dims: int, epochs: int, rate: float, seed: int):
    """Stochastic gradient descent (Adagrad steps) on the subword vectors and the softmax."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 0.1, (BUCKETS, dims)).astype(np.float32), np.zeros((dims, n), np.float32), np.zeros(n, np.float32)]
    parts[1] += rng.normal(0, 0.1, parts[1].shape).astype(np.float32)
    seen = [np.full(p.shape, 1e-6, np.float32) for p in parts]
    means = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), 32):
            rows = order[at : at + 32]
            x = means[rows]
            hidden = x @ parts[0]
            miss = softmax(hidden @ parts[1] + parts[2])
            miss[np.arange(len(rows)), labels[rows]] -= 1
            miss /= len(rows)
            steps = [x.T @ (miss @ parts[1].T), hidden.T @ miss, miss.sum(axis=0)]
            for p, g, s in zip(parts, steps, seen, strict=True):
                s += g * g
                p -= rate * g / np.sqrt(s)
    return parts


def calibrate(logits: np.ndarray, labels: np.ndarray, false_rejects: float) -> tuple[float, float]:
    """Temperature of least loss on rows the model hasn't seen, and the score that all but ``false_rejects`` of them reach."""
    if not len(labels):
        return 1.0, 0.0
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    scores = np.sort(softmax(logits / temperature).max(axis=1))
    return temperature, float(scores[int(false_rejects * len(scores))])


def sample_rows(docs: DataFrame, may_learn: Column, per_language: int, most_rows: int) -> DataFrame:
    """Labelled rows, the first by a hash of the text for each label: at most ``per_language``, and fewer where that would
    give more than ``most_rows`` in all (but two at least)."""
    rows = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rate = saved(rows.groupBy("lang").count())
    labels = rate.count()
    each = max(2, min(per_language, most_rows // max(1, labels)))
    # Sent to the tasks only where it is known to be small; a join by label would put a common one into one task.
    rate = F.broadcast(rate) if labels <= SENT_LABELS else rate
    turn = F.xxhash64("text", F.lit(11))
    # A hash threshold at twice the wanted number leaves little to rank, however common a language is.
    few = F.pmod(turn, F.lit(1 << 30)) <= F.least(F.lit(1.0), F.lit(2.0 * each + 100) / F.col("count")) * (1 << 30)
    near = rows.select("lang", "text").join(rate, "lang").where(few)
    return near.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy(turn))).where(F.col("_n") <= each)


def train(
    docs: DataFrame, may_learn: Column, per_language: int = 500, most_rows: int = 8_000, dims: int = 16, epochs: int = 12,
    rate: float = 0.5, false_rejects: float = 0.0005, folds: int = 4, seed: int = 3,
) -> Model | None:
    """Fit on a bounded sample: ``per_language`` whole texts for each label, whatever their number, but ``most_rows`` in
    all (two a label at least). Tasks turn texts into subword counts; the driver gets ``BUCKETS`` numbers a row. Every sampled
    row is scored by a model learned without its fold; those scores set the temperature and the bound under which ``false_rejects``
    of known texts would be rejected. None if nothing can be learned.
    """
    sample = sample_rows(docs, may_learn, per_language, most_rows)

    def count(batches):
        for batch in batches:
            for first, last, counts, _ in features(batch.column("text")):
                rows = [c.tobytes() for c in counts.astype(np.float32)]
                yield pa.record_batch([batch.column("lang").slice(first, last - first), pa.array(rows, pa.binary())], ["lang", "counts"])

    got = sample.select("lang", "text").mapInArrow(count, "lang string, counts binary").toArrow().sort_by([("lang", "ascending"), ("counts", "ascending")])
    if not got.num_rows:
        return None
    names = got["lang"].to_pylist()
    known = sorted(set(names))
    place = {x: i for i, x in enumerate(known)}
    labels = np.array([place[x] for x in names])
    counts = np.stack([np.frombuffer(c, np.float32) for c in got["counts"].to_pylist()])
    fold = np.random.default_rng(seed).permutation(len(labels)) % folds
    fit = lambda own: Model(known, *descend(counts[own], labels[own], len(known), dims, epochs, rate, seed), 1.0, 0.0)
    model = fit(np.ones(len(labels), bool))
    if len(labels) >= folds:
        logits = np.zeros((len(labels), len(known)), np.float32)
        for n in range(folds):
            logits[fold == n] = fit(fold != n).logits(counts[fold == n])
        model.temperature, model.reject_below = calibrate(logits, labels, false_rejects)
    return model


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and lang_pred, score, rejected (of these names only the new ones stay).

    The whole text is read. Null text, text without a letter, or no model give ``und``, score 0, rejected. Other texts get
    a learned language and its calibrated probability; ``rejected`` says that the score is under the calibrated bound.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]

    def predict(batches):
        for batch in batches:
            n = batch.num_rows
            named, scores = np.full(n, UNKNOWN, object), np.zeros(n)
            if model is not None:
                for first, last, counts, has_letter in features(batch.column(text_col)):
                    chances = model.probabilities(counts)
                    best = chances.argmax(axis=1)
                    named[first:last] = np.where(has_letter, np.array(model.languages, object)[best], UNKNOWN)
                    scores[first:last] = np.where(has_letter, chances.max(axis=1), 0.0)
                scores = np.clip(scores, 0.0, 1.0)
            below = (named == UNKNOWN) | (scores < (model.reject_below if model else 0))
            new = [pa.array(named.tolist(), pa.string()), pa.array(scores), pa.array(below)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new], [*keep, "lang_pred", "score", "rejected"])

    from pyspark.sql.types import StructType

    schema = StructType([docs.schema[c] for c in keep]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    source = docs.select(*keep)
    return source.mapInArrow(predict, schema)


def held_out(docs: DataFrame, of: int) -> Column:
    """True where crc32 of the id as text leaves remainder 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == 1, F.lit(False))
