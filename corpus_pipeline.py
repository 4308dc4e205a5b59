"""From raw documents to token ids: language, line dedup, near copies, mixture, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm import langid, line_dedup, mixing, ngram_join, sentencepiece_match
from cartloom.llm.common import saved, table

#: No SQL twin: training, sketches and pieces can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model takes; rejected ones go, all others keep their columns."""
    found = langid.identify(docs, langid.train(docs, ~langid.held_out(docs, 3)))
    return found.where(~F.col("rejected")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites stay in one document; documents of which nothing else is left go. n_chars follows the text."""
    cut = line_dedup.dedup_lines(docs)
    left = cut.where((F.col("n_removed") == 0) | F.rlike("text", F.lit(r"\S")))
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources near their target weights: a document stands as often as it is drawn."""
    return mixing.sampled_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, beside its columns."""
    return sentencepiece_match.encode_documents(docs)


STAGES = [("language_id", languages), ("line_dedup", lines), ("ngram_jaccard", near_copies), ("mixing", mixture), ("sentencepiece", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = saved(docs)
    return docs
