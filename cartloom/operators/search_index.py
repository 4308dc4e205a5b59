"""Inverted index over product texts, built once and read by many searches.

A search term holds no white space, so a text contains it just where one of the text's words does. The index keeps each distinct
word with the rows that have it, in blocks of ids, and the (far smaller) list of words; a search looks terms up in that list,
starts from the rarest term's rows and keeps those which the other terms have too. The texts aren't read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids one posting may hold, on average; a frequent word has as many postings as there are blocks.
BLOCK_ROWS = 100_000


def write_index(docs: DataFrame, key: str, text: Column, path: str, block_rows: int = BLOCK_ROWS) -> None:
    """Postings ``token, block, ids`` and words ``token, rows`` of ``text`` (lower case) below ``path``.

    ``key`` is unique; rows without key or text are in no posting. Ids are dealt to blocks by hash, so no posting grows with the table.
    """
    blocks = max(1, -(-docs.count() // block_rows))
    cells = docs.select(
        F.col(key).alias("id"), F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"), F.explode(F.array_distinct(F.split(F.lower(text), r"\s+"))).alias("token")
    ).where((F.col("token") != "") & F.col("id").isNotNull())
    postings = cells.groupBy("token", "block").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    postings.repartitionByRange("token", "block").sortWithinPartitions("token", "block").write.mode("overwrite").parquet(f"{path}/postings")
    kept = docs.sparkSession.read.parquet(f"{path}/postings")
    words = kept.groupBy("token").agg(F.sum(F.size("ids").cast("bigint")).alias("rows"))
    words.write.mode("overwrite").parquet(f"{path}/words")


def search_index(spark: SparkSession, path: str, query: str) -> DataFrame:
    """``id`` of the rows whose text holds every term of ``query``; a blank query finds none."""
    terms = sorted(set(query.lower().split()))
    postings, words = (spark.read.parquet(f"{path}/{part}") for part in ("postings", "words"))
    nothing = postings.select(F.explode("ids").alias("id")).where(F.lit(False))
    if not terms:
        return nothing
    named = F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.col("token").contains(t))
    hits = words.select("token", "rows", F.explode(named).alias("term"))
    # one row per term of the query
    weight = {r.term: r.rows for r in hits.groupBy("term").agg(F.sum("rows").alias("rows")).collect()}
    if len(weight) < len(terms):
        return nothing

    def rows_of(term: str) -> DataFrame:
        own = postings.join(hits.where(F.col("term") == term).select("token"), "token", "left_semi")
        return own.select("block", F.explode("ids").alias("id"))

    first, *others = sorted(terms, key=lambda t: (weight[t], t))
    found = reduce(lambda left, term: left.join(rows_of(term), ["block", "id"], "left_semi"), others, rows_of(first).distinct())
    return found.select("id")
