"""Cross-site line deduplication by distinct-site sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import saved

#: log2 of a sketch's registers; its standard error is about 1.04 / sqrt(2^SKETCH_BITS).
SKETCH_BITS = 10
#: Estimates within this share of the threshold (four standard errors) are counted exactly.
NEAR = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)


def site_lines(docs: DataFrame, site_col: str) -> DataFrame:
    """Rows (doc_id, _doc, at, line, site): trimmed, not empty lines of every text as hashes; a null site counts as one site."""
    lines = docs.select("doc_id", "_doc", F.xxhash64(F.coalesce(F.col(site_col).cast("string"), F.lit("\0null"))).alias("site"),
                        F.posexplode(F.split("text", "\n", -1)).alias("at", "_line"))
    lines = lines.withColumn("_line", F.btrim("_line", F.lit(" \t\r\u000b\f")))
    return lines.where(F.length("_line") > 0).select(
        "doc_id", "_doc", "at", F.struct(F.xxhash64("_line").alias("a"), F.hash("_line", F.lit(5)).alias("b")).alias("line"), "site")


def boilerplate_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """Lines on at least ``min_sites`` distinct sites, each with the first (doc_id, _doc, at) it stands at.

    A sketch per line merges by aggregation. Where its estimate is near the threshold, the distinct sites are counted
    exactly; elsewhere the sketch decides.
    """
    first = F.min(F.struct("doc_id", "_doc", "at"))
    spread = lines.groupBy("line").agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"), F.count("*").alias("n"), first.alias("first"))
    # A line that stands in fewer than min_sites places can't be on as many sites.
    spread = spread.where(F.col("n") >= min_sites).withColumn("sites", F.hll_sketch_estimate("sketch")).drop("sketch")
    spread = saved(spread.where(F.col("sites") >= min_sites * (1 - NEAR)))
    near = spread.where(F.col("sites") <= min_sites * (1 + NEAR)).select("line")
    exact = lines.join(near, "line", "left_semi").groupBy("line", "site").agg(F.lit(1).alias("_one")).groupBy("line").agg(F.count("*").alias("exact"))
    return spread.join(exact, "line", "left").where(F.coalesce("exact", "sites") >= min_sites).select("line", "first")


def dedup_lines(docs: DataFrame, min_sites: int = 8, site_col: str = "source") -> DataFrame:
    """Remove lines that stand on many sites; the first place of each (smallest doc_id, then line) keeps it.

    Returns every row with its columns, ``text`` without the removed lines, and n_lines, n_removed. Lines are compared
    trimmed; empty lines stay where they are. Null text stays null (0 lines), a text whose lines all go becomes empty.
    Null sites are one site. Rows of one doc_id are told apart by their text, so repeated rows are treated alike. An empty
    table gives no rows. Only built-in functions run; what is shuffled is a hash a line, and texts once.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # The caller's columns travel in one struct, so no name of theirs meets one of ours.
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), "doc_id", "text", F.col(site_col).alias("site"), F.xxhash64("text").alias("_doc"))
    lines = site_lines(base, "site")
    common = saved(boilerplate_lines(lines, min_sites))  # so that the join reads two plain shuffles, which Spark can split
    here = F.struct("doc_id", "_doc", "at")
    gone = lines.join(common, "line").where(~here.eqNullSafe(F.col("first"))).groupBy("doc_id", "_doc").agg(F.collect_set("at").alias("_gone"))
    # A document's own line numbers bound the list.
    marked = base.join(gone.select(F.col("doc_id").alias("_id"), F.col("_doc").alias("_hash"), "_gone"),
                       F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_doc") == F.col("_hash")), "left")
    parts = F.split("text", "\n", -1)
    # Stretches between removed lines are sliced out, so the work follows the lines, not lines times removed ones.
    cuts = F.concat(F.array(F.lit(-1)), F.array_sort("_gone"), F.array(F.size(parts)))
    stretches = F.zip_with(F.slice(cuts, F.lit(1), F.size(cuts) - 1), F.slice(cuts, F.lit(2), F.size(cuts) - 1), lambda a, b: F.slice(parts, a + 2, b - a - 1))
    removed = F.coalesce(F.size("_gone"), F.lit(0)).cast("long")
    text = F.when(removed > 0, F.array_join(F.flatten(stretches), "\n")).otherwise(F.col("text"))
    return marked.select(
        *[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in keep],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"), removed.alias("n_removed"))
