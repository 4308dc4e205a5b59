"""One JSON array of objects, read by many tasks.

The file is cut at every ``}``, which Spark's text reader splits by byte range. Whether a piece starts inside a string, and at
which depth, follows from the pieces before it: quotes and braces are counted per piece for both cases, summed along each
block and then along the (few) blocks. A record ends where the depth is back at nought outside a string. Only text between
two such places is put together again, so a task holds one record or the pieces of one block, never the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, at, value`` with ``quotes`` of a piece and its opening braces if it starts outside or inside a string.
    An escape never reaches over a ``}``: no JSON escape ends in one."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    strings = r'"[^"]*+("|\z)'
    outside = F.regexp_replace("bare", strings, "")
    inside = F.regexp_replace(F.regexp_replace("bare", r'\A[^"]*+("|\z)', ""), strings, "")
    return (
        spark.read.text(path, lineSep="}")
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"), "value", bare.alias("bare"),
        )
        .select("file", "block", "at", "value", _count(F.col("bare"), '"').alias("quotes"), _count(outside, "{").alias("out"), _count(inside, "{").alias("ins"))
    )


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the array of objects in each file at ``path``, as ``schema`` says.

    An object that does not fit the schema reads as Spark's JSON functions do (nulls). A file that does not end with the
    array's ``]`` at the outermost level is an error: it was cut off. An empty array has no rows.
    """
    block = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before, after = F.col("upto") - F.col("quotes"), F.col("upto")
    even = lambda n: n % 2 == 0
    depth = {
        "depth_out": F.when(even(before), F.col("out")).otherwise(F.col("ins")) - F.when(even(after), 1).otherwise(0),
        "depth_in": F.when(even(before), F.col("ins")).otherwise(F.col("out")) - F.when(even(after), 0).otherwise(1),
    }
    pieces = _pieces(spark, path).withColumn("upto", F.sum("quotes").over(block))
    pieces = pieces.select("file", "block", "at", "value", "upto", *[F.sum(d).over(block).alias(n) for n, d in depth.items()])

    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max_by(F.struct("depth_out", "depth_in", F.rtrim(F.translate("value", "\r\n\t", "   ")).alias("tail")), "at").alias("l")
    blocks = pieces.groupBy("file", "block").agg(F.max("upto").alias("quotes"), latest)
    blocks = blocks.withColumn("quoted", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("change", F.when(F.col("quoted") == 0, F.col("l.depth_out")).otherwise(F.col("l.depth_in")))
    base = F.coalesce(F.sum("change").over(earlier), F.lit(0))
    whole = (base + F.col("change") == -1) & ((F.col("quoted") + F.col("quotes")) % 2 == 0) & F.col("l.tail").rlike(r"\A\x{FEFF}?\s*(\[\s*)?\]\z")
    last = F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull()
    cut_off = F.raise_error(F.concat(F.lit("not a whole JSON array: "), F.col("file"))).cast("bigint")
    blocks = blocks.select("file", "block", "quoted", F.when(last & ~whole, cut_off).otherwise(base).alias("base"))

    placed = pieces.join(blocks, ["file", "block"]).withColumn(
        "ended",
        (F.col("base") + F.when(F.col("quoted") == 0, F.col("depth_out")).otherwise(F.col("depth_in")) == 0) & even(F.col("quoted") + after),
    )
    # blocks without a record's end hand their pieces on to the record that ends later
    ends = placed.groupBy("file", "block").agg(F.count_if("ended").alias("n"))
    ends = ends.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    numbered = placed.select(
        "file", "block", "at", "value", "ended", (F.count_if("ended").over(block) - F.col("ended").cast("int")).alias("nth")
    ).join(ends, ["file", "block"])
    records = numbered.groupBy("file", (F.col("first") + F.col("nth")).alias("record")).agg(
        F.bool_or("ended").alias("ended"), F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("pieces")
    )
    text = F.concat(F.array_join(F.transform("pieces", lambda p: p["value"]), "}"), F.lit("}"))
    return records.where("ended").select(F.from_json(F.regexp_replace(text, r"\A[^{]*+", ""), schema).alias("r")).select("r.*")
