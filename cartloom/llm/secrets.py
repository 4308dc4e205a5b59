"""Secret scans: fixed patterns and a comparison of two character Markov models."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import WORD, saved

# The patterns of the base kinds, in their order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "markov"]

#: Strings that the models judge.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: The characters' states from 1; 0 stands before the first one and for any other.
STATES = len(ALPHABET) + 1
SPAN = "struct<start:int,end:int,what:string>"


def spans_of(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Column ``name``: spans of the pattern in ``_text``. Texts without a match are passed over by one search."""
    none = F.array().cast(f"array<{SPAN}>")
    hit = F.rlike("_text", F.lit(pattern))
    df = df.withColumn("_found", F.when(hit, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))))
    df = df.withColumn("_gaps", F.when(F.size("_found") > 0, F.split("_text", pattern, -1)))
    pairs = F.arrays_zip(F.transform("_found", F.length).alias("m"), F.col("_found").alias("w"),
                         F.transform(F.slice("_gaps", F.lit(1), F.size("_found")), F.length).alias("g"))

    def step(acc, x):
        low = acc["at"] + x["g"]
        one = F.struct(low.alias("start"), (low + x["m"]).alias("end"), x["w"].alias("what"))
        return F.struct((low + x["m"]).alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return df.withColumn(name, F.when(F.size("_found") > 0, walked).otherwise(none)).drop("_found", "_gaps")


def states(word: Column) -> Column:
    return F.transform(F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0)), lambda c: F.position(c, F.lit(ALPHABET)))


def ratio(word: Column, table: Column) -> Column:
    """Log-likelihood ratio of the random model to the ordinary one."""
    seen = states(word)
    before = F.concat(F.array(F.lit(0)), seen)
    steps = F.zip_with(F.slice(before, F.lit(1), F.size(seen)), seen, lambda a, b: F.get(table, a * STATES + b))
    return F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


@dataclass
class MarkovPair:
    """log P(next | last) of random strings less that of ordinary identifiers, for each pair of states."""

    ratios: list[float]

    def column(self) -> Column:
        return F.from_json(F.lit(json.dumps(self.ratios)), "array<double>")


def fit(labelled: DataFrame, smoothing: float = 0.5) -> MarkovPair:
    """Fit both models from rows (word, random). Pairs of states are counted by aggregation; the driver gets at most
    2 * STATES^2 counts. Without rows of a kind its model is uniform."""
    seen = states(F.col("word"))
    pair = F.zip_with(F.slice(F.concat(F.array(F.lit(0)), seen), F.lit(1), F.size(seen)), seen, lambda a, b: a * STATES + b)
    rows = labelled.select("random", F.explode(pair).alias("pair")).groupBy("random", "pair").count().collect()
    counts = {(r["random"], r["pair"]): r["count"] for r in rows}

    def logs(random: bool) -> list[float]:
        out = []
        for a in range(STATES):
            own = [counts.get((random, a * STATES + b), 0) + smoothing for b in range(STATES)]
            out += [math.log(x / sum(own)) for x in own]
        return out

    return MarkovPair([a - b for a, b in zip(logs(True), logs(False), strict=True)])


def base_and_tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, assign, access, hex, token): spans of the base kinds and of the strings to judge."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN)):
        df = spans_of(df, name, pattern)
    return df.drop("_text").withColumn("assign", F.filter("assign", lambda s: F.length(F.regexp_extract(s["what"], ASSIGN, 2)) >= 6))


def labelled_words(docs: DataFrame, found: DataFrame, sample_docs: int, sample_words: int) -> DataFrame:
    """Bounded samples of labelled strings: values of base spans are random, other words of sampled texts ordinary.

    About ``sample_docs`` texts are drawn by a hash of the text, and about ``sample_words`` distinct base values.
    """
    few = lambda key, of, most: F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) <= min(1.0, most / max(1, of)) * (1 << 30)
    value = lambda s: F.regexp_extract(s["what"], ASSIGN, 2)
    secret = found.select(F.explode(F.concat(F.transform("assign", value), F.transform("access", lambda s: s["what"]),
                                             F.transform("hex", lambda s: s["what"]))).alias("word")).where(F.length("word") >= 16).distinct()
    secret = secret.where(few("word", secret.count(), sample_words)).select("word", F.lit(True).alias("random"))
    texts = docs.where(F.col("text").isNotNull())
    texts = texts.where(few("text", docs.count(), sample_docs)).select(F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word"))
    word = F.regexp_replace("word", "^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "")
    plain = texts.select(word.alias("word")).where(F.rlike("word", F.lit("^[A-Za-z0-9+/_=-]{3,}$")) & ~F.rlike("word", F.lit(f"{HEX}|{ACCESS}")))
    plain = plain.distinct().join(secret.select("word"), "word", "left_anti").select("word", F.lit(False).alias("random"))
    return secret.union(plain)


def scan(docs: DataFrame, least_ratio: float = 12.0, sample_docs: int = 2000, sample_words: int = 20_000, model: MarkovPair | None = None) -> DataFrame:
    """Spans of secrets in every whole text: doc_id, assign, access, hex, markov (arrays of start, end, what).

    The base kinds are fixed patterns. A string of 20 or more token characters outside base spans is a ``markov`` secret if
    its log-likelihood ratio is at least ``least_ratio`` (a prior of about one in 160,000). The models are fitted on
    bounded samples (``sample_docs`` texts, ``sample_words`` values) unless given. Places are code points, ends exclusive.

    Null and empty texts have no spans. Each row is scanned by itself, so repeated rows give repeated results. Extra
    columns are left out. Only built-in functions run.
    """
    found = saved(base_and_tokens(docs))
    model = model or fit(labelled_words(docs, found, sample_docs, sample_words))
    base = F.concat("assign", "access", "hex")
    free = F.filter("token", lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    judged = F.filter("_free", lambda t: ratio(t["what"], F.col("_table")) >= least_ratio)
    return found.withColumn("_free", free).withColumn("_table", model.column()).withColumn("markov", judged).select(
        "doc_id", "assign", "access", "hex", "markov")


def joined_spans(*kinds: str) -> Column:
    """kind:start:end of all spans by start, then in the order of KINDS, joined by commas."""

    def tag(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("no"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    shown = F.transform(F.array_sort(F.concat(*(tag(k) for k in kinds))), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")
