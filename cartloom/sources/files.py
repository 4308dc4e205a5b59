"""Record files, archive CSV, file manifests, register, sitemap and robots readers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import BinaryIO
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.text import neutralise
from cartloom.sources.snapshot import path_exists


def write_records(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """JSON lines with keys in name order, rows in ``order``.

    The order is a range-partitioned sort, so part files are written in parallel and, read in
    name order, give the same bytes for the same rows. Nulls are written.
    """
    ordered = df.orderBy(*order).select(*sorted(df.columns))
    ordered.write.mode("overwrite").json(path, ignoreNullFields=False)


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of ``path``; a missing path reads as empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


BOM = "\ufeff"


def archive_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every cell as text that a spreadsheet will not evaluate; null as an empty cell."""
    return df.select(*[neutralise(F.col(c)).alias(c) for c in columns])


def write_archive_csv(
    df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str], single_file: bool = False
) -> None:
    """UTF-8 CSV with byte-order mark, CRLF and minimal quoting, one header per file.

    Large tables stay one file per sorted partition. ``single_file`` is for delivery of a table
    known to be small; it is the caller's choice and off by default.
    """
    cells = archive_cells(df.orderBy(*order), columns)
    cells = cells.withColumnRenamed(columns[0], BOM + columns[0])
    if single_file:
        cells = cells.coalesce(1)
    cells.write.mode("overwrite").csv(
        path,
        header=True,
        lineSep="\r\n",
        escape='"',
        emptyValue="",
        nullValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


CHUNK_BYTES = 4 << 20


def open_stream(path: str) -> BinaryIO:
    """A file as a forward stream, on any file system Arrow opens (local, hdfs, s3, gs)."""
    if path.startswith(("file:", "/")):
        return pafs.LocalFileSystem().open_input_stream("/" + path.removeprefix("file:").lstrip("/"))
    system, place = pafs.FileSystem.from_uri(path)
    return system.open_input_stream(place)


def _digester(opener: Callable[[str], BinaryIO], chunk: int):
    """Task body: the bytes and SHA-256 of each file, a chunk in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                digest, read = hashlib.sha256(), 0
                with opener(path) as stream:
                    while part := stream.read(chunk):
                        digest.update(part)
                        read += len(part)
                yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [read], "sha256": [digest.hexdigest()]})

    return run


def file_manifest(
    spark: SparkSession, folder: str, counts: DataFrame | None = None, pattern: str = "part-*",
    opener: Callable[[str], BinaryIO] = open_stream, chunk: int = CHUNK_BYTES,
) -> DataFrame:
    """``file, bytes, sha256, rows`` of every file below ``folder``.

    Spark lists the files and deals them to tasks by size; a task reads one file at a time in chunks, so files of any size
    do. Spark's scans leave empty files out, so these come from the list itself. ``opener`` serves file systems that Arrow doesn't know. ``counts`` is ``(path, rows)`` with the table folder as path;
    a table of several files repeats its total.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path")
    names = spark.createDataFrame([(unquote(uri).replace("file:///", "file:/", 1),) for uri in listed.inputFiles()], "path string")
    files = (
        listed.unionByName(names.join(listed, "path", "left_anti"))
        .mapInArrow(_digester(opener, chunk), "path string, bytes bigint, sha256 string")
        .select(F.regexp_extract("path", rf"\Q{folder.rstrip('/')}\E/(.*)$", 1).alias("file"), "bytes", "sha256")
        .withColumn("path", F.regexp_extract("file", r"^(.*)/[^/]*$", 1))
    )
    if counts is None:
        return files.select("file", "bytes", "sha256", F.lit(None).cast("bigint").alias("rows"))
    return files.join(counts, "path", "left").select("file", "bytes", "sha256", F.col("rows").cast("bigint"))


def checksum_lines(manifest: DataFrame) -> DataFrame:
    """``sha256sum`` text lines."""
    return manifest.orderBy("file").select(F.concat_ws("  ", "sha256", "file").alias("value"))


REGISTER = (
    "record_type string, record_id string, record_ref string, stage string, severity string,"
    " code string, message string, owner string, retry_status string, detail string"
)


def read_exception_register(spark: SparkSession, path: str, schema: str = REGISTER) -> DataFrame:
    """Exception CSV with a header; a missing file reads as empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, header=True, schema=schema, escape='"', multiLine=True, enforceSchema=False)


def sitemap_locs(docs: DataFrame, name: str = "sitemap", xml: str = "xml") -> DataFrame:
    """``(sitemap, loc, lastmod)`` of stored sitemap XML. One ``<url>`` block at a time, so a
    missing ``lastmod`` does not shift the others."""
    blocks = F.regexp_extract_all(xml, F.lit(r"(?is)<(?:url|sitemap)\b[^>]*>(.*?)</(?:url|sitemap)>"), F.lit(1))
    block = F.col("block")
    lastmod = F.trim(F.regexp_extract(block, r"(?is)<lastmod>\s*([^<]*?)\s*</lastmod>", 1))
    return (
        docs.select(F.col(name).alias("sitemap"), F.explode(blocks).alias("block"))
        .select(
            "sitemap",
            F.regexp_extract(block, r"(?is)<loc>\s*([^<\s]+)\s*</loc>", 1).alias("loc"),
            F.when(lastmod != "", lastmod).alias("lastmod"),
        )
        .where(F.col("loc") != "")
    )


def robots_rules(docs: DataFrame, site: str = "site", text: str = "text") -> DataFrame:
    """``(site, line, rule, value)`` of stored robots.txt; a bare wildcard path reads ``/``."""
    pattern = r"(?i)^\s*(sitemap|allow|disallow)\s*:\s*(\S+)"
    lines = docs.select(F.col(site).alias("site"), F.posexplode(F.split(text, r"\r?\n")).alias("at", "text"))
    return lines.where(F.col("text").rlike(pattern)).select(
        "site",
        (F.col("at") + 1).alias("line"),
        F.lower(F.regexp_extract("text", pattern, 1)).alias("rule"),
        F.regexp_replace(F.regexp_extract("text", pattern, 2), r"^/\*.*$", "/").alias("value"),
    )


def redirect_artifacts(redirects: DataFrame, path: str) -> dict[str, DataFrame]:
    """Write and return the full map, the permanent path rules and the gone list."""
    parts = {"map": redirects.orderBy("source_type", "source_path"), **redirect_rules(redirects)}
    for name, part in parts.items():
        part.write.mode("overwrite").json(f"{path}/{name}", ignoreNullFields=False)
    return parts


def redirect_rules(redirects: DataFrame, moved: Sequence[str] = ("301", "held_redirect_to_collection")) -> Mapping[str, DataFrame]:
    """Path-only outputs of the map: a query-string source cannot be matched by path."""
    by_path = redirects.where(~F.col("source_path").contains("?"))
    rules = by_path.where(F.col("outcome").isin(*moved) & (F.col("owner") == "storefront")).select(
        F.col("source_path").alias("source"), "destination", F.lit(True).alias("permanent")
    )
    gone = by_path.where(F.col("outcome") == "410").select("source_path")
    return {"redirects": rules.orderBy("source"), "gone": gone.orderBy("source_path")}
