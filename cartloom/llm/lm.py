"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import mix, saved, slices, span_hashes, utf8, words

#: Classes of the most common words and words in each, at least (see ``sizes``); classes of all other words, by their last letters.
CORE_CLASSES, CLASS_WORDS, SHAPES = 24, 32, 8
#: Rows of the hashed weight tables, at least.
CLASS_BITS, WORD_BITS = 14, 15
#: A word is listed (and sent to every task) if it makes up at least one in so many training tokens; so many words at most.
LISTED = 400_000
FEATURES = 3
#: Runs of at most so many rows are added one place at a time.
SHORT = 4
END = np.uint64(SHAPES)  # the end token's hash; its low bits aren't read
_SEED = np.uint64(0x9E3779B97F4A7C15)


def tokens(data: np.ndarray, offsets: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row (from 0) of every token: the words of each text, then its end. The low bits are the word's shape."""
    text, starts, ends, rows = words(data, offsets, first, last)
    h = span_hashes(text, starts, ends)
    if len(h):
        final = text[ends - 1].astype(np.uint64)
        second = np.where(ends - starts > 1, text[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
        shape = mix(final * np.uint64(257) + second) & np.uint64(SHAPES - 1)
        h = (h & ~np.uint64(2 * SHAPES - 1)) | shape
    rows = rows - first
    n = last - first
    counts = np.bincount(rows, minlength=n)
    stops = np.cumsum(counts + 1) - 1
    out, of = np.full(len(h) + n, END, np.uint64), np.repeat(np.arange(n), counts + 1)
    inner = np.ones(len(out), bool)
    inner[stops] = False
    out[inner] = h
    return out, of


def token_counts(docs: DataFrame, flush: int = 2_000_000) -> DataFrame:
    """(word, c): how often each token stands in the texts. Tasks count runs of texts before the shuffle."""

    def counted(held):
        word, c = np.unique(np.concatenate(held), return_counts=True)
        return pa.record_batch([pa.array(word.view(np.int64)), pa.array(c.astype(np.int64))], ["word", "c"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for first, last in slices(offsets):
                held.append(tokens(data, offsets, first, last)[0])
                size += len(held[-1])
                if size >= flush:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    return docs.select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def sizes(n: int, v: int) -> tuple[int, int, int]:
    """Core classes, words in each and extra bits of the weight tables for ``n`` tokens of ``v`` words: classes and words grow
    with the fourth root of the words each, so the core words with their square root, and the tables with the fourth root of
    the tokens (beyond four million)."""
    side = math.ceil(v**0.25)
    return max(CORE_CLASSES, side), max(CLASS_WORDS, side), max(0, round((math.log2(max(n, 1)) - 22) / 4))


@dataclass
class Model:
    """Counts of listed words, the classes, and the weights."""

    n: int
    v: int
    listed: np.ndarray
    counts: np.ndarray
    slots: np.ndarray
    bits: int
    place: np.ndarray  # class * (words in a class) + number of a core word, or -1
    discount: float
    shape_tokens: np.ndarray
    shape_words: np.ndarray
    class_bias: np.ndarray
    word_bias: np.ndarray
    class_weights: np.ndarray
    word_weights: np.ndarray

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each token in the list, or -1."""
        out = np.full(len(h), -1, np.int64)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.slots[slot], self.slots[slot + 1]
        todo = np.flatnonzero(at < end)
        at, end = at[todo], end[todo]
        while len(todo):
            hit = self.listed[at] == h[todo]
            out[todo[hit]] = at[hit]
            at = at + 1
            more = ~hit & (at < end)
            todo, at, end = todo[more], at[more], end[more]
        return out

    def features(self, h: np.ndarray, known: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        """Hashes of the last word, the last two, and the one before the last, whether or not the words are listed."""
        back = []
        for k in (1, 2):
            past = np.zeros(len(h), np.uint64)
            past[k:] = np.where(rows[k:] == rows[:-k], h[:-k], 0)
            back.append(past)
        return [mix(back[0] + np.uint64(1)), mix(mix(back[0]) + back[1] * _SEED + np.uint64(2)), mix(back[1] * _SEED + np.uint64(3))]

    def targets(self, h: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each token, and its number in a core class or -1."""
        place = np.where(known >= 0, self.place[known], -1) if len(self.place) else np.full(len(h), -1)
        core = place >= 0
        classes, wide = self.word_bias.shape
        shape = classes + (h & np.uint64(SHAPES - 1)).astype(np.int64)
        return np.where(core, place // wide, shape), np.where(core, place % wide, -1)


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def softmax(x: np.ndarray) -> np.ndarray:
    """In the place of ``x``."""
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def chosen(x: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The log softmax of one column a row. Writes over ``x``."""
    x -= x.max(axis=1, keepdims=True)
    own = x[np.arange(len(x)), which]
    return own - np.log(np.exp(x, out=x).sum(axis=1))


def class_rows(f: np.ndarray, table_rows: int = 1 << CLASS_BITS) -> np.ndarray:
    return (f >> np.uint64(65 - table_rows.bit_length())).astype(np.int64)


def word_rows(f: np.ndarray, of: np.ndarray, table_rows: int = 1 << WORD_BITS) -> np.ndarray:
    return (mix(f + of.astype(np.uint64) * _SEED) >> np.uint64(65 - table_rows.bit_length())).astype(np.int64)


def summed(table: np.ndarray, rows: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
    out = table[rows[0]] + bias
    for r in rows[1:]:
        out += table[r]
    return out


def run_sums(values: np.ndarray, order: np.ndarray, heads: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of ``values[order]`` over each run of rows. Most runs are short: those are added one place at a time."""
    out = values[order[heads]]
    for k in range(1, SHORT):
        more = np.flatnonzero((counts > k) & (counts <= SHORT))
        out[more] += values[order[heads[more] + k]]
    long = np.flatnonzero(counts > SHORT)
    if len(long):
        rows = order[np.repeat(counts > SHORT, counts)]
        out[long] = np.add.reduceat(values[rows], np.cumsum(counts[long]) - counts[long], axis=0)
    return out


def descend(table: np.ndarray, seen: np.ndarray, uses: np.ndarray, rows: list[np.ndarray], miss: np.ndarray, rate: float) -> None:
    """One gradient step on the rows that a batch uses, each at its own Adagrad rate."""
    for r in rows:
        order = np.argsort((r & 0xFFFF).astype(np.uint16), kind="stable")
        if len(table) > 1 << 16:
            order = order[np.argsort((r[order] >> 16).astype(np.uint16), kind="stable")]
        own = r[order]
        heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        counts = np.diff(np.append(heads, len(own)))
        step, which = run_sums(miss, order, heads, counts), own[heads]
        seen[which] += np.einsum("ij,ij->i", step, step) / step.shape[1]
        uses[which] += counts
        step *= (rate / np.sqrt(seen[which]))[:, None]
        table[which] -= step


def learn(model: Model, h: np.ndarray, of: np.ndarray, state: list[np.ndarray], rate: float, batch: int) -> None:
    known = model.find(h)
    feats = model.features(h, known, of)
    cls, number = model.targets(h, known)
    for at in range(0, len(h), batch):
        part = slice(at, at + batch)
        rows = [class_rows(f[part], len(model.class_weights)) for f in feats]
        miss = softmax(summed(model.class_weights, rows, model.class_bias))
        miss[np.arange(len(miss)), cls[part]] -= 1
        descend(model.class_weights, state[0], state[1], rows, miss, rate)
        core = np.flatnonzero(number[part] >= 0)
        if len(core):
            c = cls[part][core]
            rows = [word_rows(f[part][core], c, len(model.word_weights)) for f in feats]
            miss = softmax(summed(model.word_weights, rows, model.word_bias[c]))
            miss[np.arange(len(miss)), number[part][core]] -= 1
            descend(model.word_weights, state[2], state[3], rows, miss, rate)


def log_probabilities(model: Model, h: np.ndarray, known: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Natural log probability of each token; for a word in no core class, of its class only."""
    feats = model.features(h, known, of)
    cls, number = model.targets(h, known)
    out = np.zeros(len(h))
    for at in range(0, len(h), 1 << 14):
        part = slice(at, at + (1 << 14))
        scores = summed(model.class_weights, [class_rows(f[part], len(model.class_weights)) for f in feats], model.class_bias)
        own = chosen(scores, cls[part]).astype(float)
        core = np.flatnonzero(number[part] >= 0)
        if len(core):
            c = cls[part][core]
            inner = summed(model.word_weights, [word_rows(f[part][core], c, len(model.word_weights)) for f in feats], model.word_bias[c])
            own[core] += chosen(inner, number[part][core])
        out[part] = own
    return out


def prepare(counts: DataFrame) -> Model:
    """The model before training: unigram classes and words. The driver gets at most LISTED words and a few sums."""
    shape = F.col("word").bitwiseAND(SHAPES - 1)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.sum((F.col("c") == 1).cast("long")), F.sum((F.col("c") == 2).cast("long"))).first()
    n, v, once, twice = (int(x or 0) for x in total)
    listed = counts.where(F.col("c") * LISTED >= n).toArrow()
    word, c = np.asarray(listed["word"], np.int64).view(np.uint64), np.asarray(listed["c"], np.int64)
    order = np.argsort(word)
    word, c = word[order], c[order]
    bits = max(16, len(word).bit_length() + 3)
    slots = np.searchsorted(word >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
    place = np.full(len(word), -1, np.int64)
    # The more common words come first; every core class holds as many words.
    classes, wide, more_bits = sizes(n, v)
    common = np.lexsort((word, -c))[: classes * wide]
    place[common] = np.arange(len(common))
    rest = {r["s"]: (r["t"], r["w"]) for r in counts.groupBy(shape.alias("s")).agg(F.sum("c").alias("t"), F.count("*").alias("w")).collect()}
    tokens_of, words_of = (np.array([rest.get(s, (0, 0))[i] for s in range(SHAPES)], float) for i in (0, 1))
    core_shape = (word[common] & np.uint64(SHAPES - 1)).astype(np.int64)
    tokens_of -= np.bincount(core_shape, c[common], minlength=SHAPES)
    words_of -= np.bincount(core_shape, minlength=SHAPES)
    cls = np.zeros(classes + SHAPES)
    np.add.at(cls, place[common] // wide, c[common])
    cls[classes:] = tokens_of
    inner = np.full((classes, wide), -30.0, np.float32)
    inner[place[common] // wide, place[common] % wide] = np.log(c[common])
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
    bias = np.where(cls > 0, np.log(np.maximum(cls, 0.5)), np.where(np.arange(classes + SHAPES) < classes, -30.0, math.log(0.5)))
    return Model(n, v, word, c, slots, bits, place, discount, tokens_of, words_of, bias.astype(np.float32), inner,
                 np.zeros((1 << CLASS_BITS + more_bits, classes + SHAPES), np.float32), np.zeros((1 << WORD_BITS + more_bits, wide), np.float32))


BLOCK = 1 << 10


def train(docs: DataFrame, model: Model, rounds: int = 2, rate: float = 0.15, batch: int = 8192) -> Model:
    """Distributed gradient updates: in each round every task descends over its own texts of the round's share, from the
    same weights; a row's new weights are the mean over the tasks, each counted as often as it used the row. Every
    training text is used in one round. The driver holds one copy of the weights (see ``sizes``).
    """
    for turn in range(rounds):
        share = docs.where(F.pmod(F.xxhash64("text", F.lit(23)), F.lit(rounds)) == turn).select("text")
        current = model
        widths = model.class_weights.shape[1], model.word_weights.shape[1]

        def run(batches, model=current):
            from dataclasses import replace

            own = replace(model, class_weights=model.class_weights.copy(), word_weights=model.word_weights.copy())
            state = [make for rows in (len(own.class_weights), len(own.word_weights)) for make in (np.full(rows, 1e-3, np.float32), np.zeros(rows, np.int64))]
            any_rows = False
            for part in batches:
                data, offsets = utf8(part.column("text"))
                for first, last in slices(offsets):
                    any_rows = True
                    h, of = tokens(data, offsets, first, last)
                    learn(own, h, of, state, rate, batch)
            if any_rows:
                for kind, (weights, uses) in enumerate(((own.class_weights, state[1]), (own.word_weights, state[3]))):
                    for at in range(0, len(uses), BLOCK):
                        used = np.flatnonzero(uses[at : at + BLOCK])
                        if len(used):
                            yield pa.record_batch(
                                [pa.array([kind], pa.int32()), pa.array([at // BLOCK], pa.int32()), pa.array([used.astype(np.int16).tobytes()]),
                                 pa.array([uses[at + used].tobytes()]), pa.array([weights[at + used].tobytes()])],
                                ["kind", "block", "used", "uses", "weights"])

        def mean(group: pa.Table) -> pa.Table:
            kind, block = group["kind"][0].as_py(), group["block"][0].as_py()
            width = widths[kind]
            total, times = np.zeros((BLOCK, width)), np.zeros(BLOCK)
            for used, uses, weights in zip(*(group[c].to_pylist() for c in ("used", "uses", "weights")), strict=True):
                rows, n = np.frombuffer(used, np.int16), np.frombuffer(uses, np.int64)
                total[rows] += np.frombuffer(weights, np.float32).reshape(-1, width) * n[:, None]
                times[rows] += n
            rows = np.flatnonzero(times)
            out = (total[rows] / times[rows, None]).astype(np.float32)
            return pa.table({"kind": [kind], "block": [block], "used": [rows.astype(np.int16).tobytes()], "weights": [out.tobytes()]},
                            pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("used", pa.binary()), ("weights", pa.binary())]))

        sent = share.mapInArrow(run, "kind int, block int, used binary, uses binary, weights binary")
        means = sent.groupBy("kind", "block").applyInArrow(mean, "kind int, block int, used binary, weights binary").toArrow()
        tables = [model.class_weights.copy(), model.word_weights.copy()]
        for row in means.to_pylist():
            table = tables[row["kind"]]
            rows = row["block"] * BLOCK + np.frombuffer(row["used"], np.int16).astype(np.int64)
            table[rows] = np.frombuffer(row["weights"], np.float32).reshape(-1, table.shape[1])
        from dataclasses import replace

        model = replace(model, class_weights=tables[0], word_weights=tables[1])
    return model


PARTS = "row long, doc_id long, word long, times long, n_tokens long, n_known long, base double, score double"


def partial_scores(docs: DataFrame, model: Model) -> DataFrame:
    """For each text one row of what listed words give, and a row for each other distinct word (its count isn't known here)."""
    # Log shares of words of no core class, by shape.
    log_rest = np.log(model.shape_tokens + 1)
    log_base = math.log10(model.n + 0.5 * (model.v + 1))

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        listed_base = np.log10(model.counts + 0.5) - log_base
        listed_rest = np.where(model.place >= 0, 0.0, np.log(model.counts - model.discount) - log_rest[(model.listed & np.uint64(SHAPES - 1)).astype(np.int64)])
        for part in batches:
            data, offsets = utf8(part.column("text"))
            for first, last in slices(offsets):
                n = last - first
                h, of = tokens(data, offsets, first, last)
                known = model.find(h)
                hit = known >= 0
                score = log_probabilities(model, h, known, of)
                score[hit] += listed_rest[known[hit]]
                total = np.bincount(of, score, minlength=n) / math.log(10)
                base = np.bincount(of[hit], listed_base[known[hit]], minlength=n)
                ids = row + np.arange(n)
                doc = part.column("doc_id").slice(first, n)
                other, of_other = h[~hit], of[~hit]
                order = np.lexsort((other, of_other))
                other, of_other = other[order], of_other[order]
                heads = np.flatnonzero(np.concatenate(([True], (other[1:] != other[:-1]) | (of_other[1:] != of_other[:-1])))) if len(other) else np.zeros(0, np.int64)
                m, none = len(heads), [None] * n
                blank = pa.nulls(m, pa.int64())
                columns = [
                    pa.array(np.concatenate((ids, ids[of_other[heads]]))), pa.concat_arrays([doc.cast(pa.int64()), blank]),
                    pa.concat_arrays([pa.array(none, pa.int64()), pa.array(other[heads].view(np.int64))]),
                    pa.concat_arrays([pa.array(none, pa.int64()), pa.array(np.diff(np.append(heads, len(other))).astype(np.int64))]),
                    pa.concat_arrays([pa.array(np.bincount(of, minlength=n).astype(np.int64)), blank]),
                    pa.concat_arrays([pa.array(np.bincount(of[hit], minlength=n).astype(np.int64)), blank]),
                    pa.concat_arrays([pa.array(base), pa.nulls(m, pa.float64())]), pa.concat_arrays([pa.array(total), pa.nulls(m, pa.float64())]),
                ]
                row += n
                yield pa.record_batch(columns, ["row", "doc_id", "word", "times", "n_tokens", "n_known", "base", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, PARTS)


def score_texts(docs: DataFrame, may_learn: Column, rounds: int = 2) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row: log10 probabilities of the whole text.

    Tokens are the lower-cased (A-Z) words and one end. ``base_score`` is a smoothed unigram. ``score`` is a maximum-entropy
    model: a softmax over classes (blocks of the most common words, as many as ``sizes`` says; all other words by the shape of their last
    letters), then one over the words of a core class, both with hashed features of the last word, the last two and the one
    before the last. In a shape class a word has its discounted share of the training tokens, and all words never seen share what the discount
    leaves. Training takes all rows of ``may_learn``.

    Word counts are exact. Words of at least 1/LISTED of the training tokens go to every task (LISTED at most); the others are
    joined by hash, one row for each text and word. Null and empty texts have one token, the end. Repeated rows are scored
    each. Without training rows every word is unseen. Extra columns are left out. Words are known by 60-bit hashes.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", may_learn.alias("_learn"))
    learning = rows.where("_learn").select("text")
    counts = saved(token_counts(learning))
    model = prepare(counts)
    if model.n:
        model = train(learning, model, rounds)
    parts = saved(partial_scores(rows, model))

    rare = parts.where(F.col("word").isNotNull()).join(counts.where(F.col("c") * LISTED < model.n), "word", "left")
    c, times = F.coalesce("c", F.lit(0)), F.col("times")
    at = F.col("word").bitwiseAND(SHAPES - 1).cast("int")
    pick = lambda values: F.get(F.array(*[F.lit(float(x)) for x in values]), at)
    unseen = F.log(pick(model.discount * model.shape_words + 1))
    share = F.when(c > 0, F.log(F.greatest(c, F.lit(1)) - F.lit(model.discount))).otherwise(unseen) - pick([math.log(x + 1) for x in model.shape_tokens])
    base = F.log10(c + 0.5) - math.log10(model.n + 0.5 * (model.v + 1))
    zero = F.lit(0).cast("long")
    late = rare.groupBy("row").agg(F.sum(F.when(c > 0, times).otherwise(0)).alias("n_known"), F.sum(times * base).alias("base"),
                                   F.sum(times * share / math.log(10)).alias("score"))
    early = parts.where(F.col("word").isNull()).select("row", "doc_id", "n_tokens", "n_known", "base", "score")
    both = early.union(late.select("row", F.lit(None).cast("long"), zero, "n_known", "base", "score"))
    sums = both.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                                   F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return sums.select("doc_id", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")
