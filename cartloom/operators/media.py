"""Images inside page and article bodies: find, resolve to originals, rewrite to new addresses."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cartloom.functions.text import blank_to_null, clean_text
from cartloom.functions.urls import (
    UPLOADS_PATH,
    absolutise,
    canon_key,
    content_type,
    original_of,
    part,
    percent_decode,
    url_filename,
    url_host,
)
from cartloom.operators.catalog import source_ref
from cartloom.operators.exceptions import AGENCY, Rule, exceptions_from_rules

# Fixed values.
URL_ATTRIBUTES = ["src", "data-src", "data-lazy-src", "data-orig-src", "data-large_image"]
SRCSET_ATTRIBUTES = ["srcset", "data-srcset", "data-lazy-srcset"]
DESCRIPTOR_ATTRIBUTES = ["sizes", "data-sizes"]
IMG = r"(?i)<img\b[^>]*>"
ANCHOR = r"(?i)<a\b[^>]*>"


def _attribute(name: str) -> str:
    return rf"(?i)(\b{name}\s*=\s*([\"']))([^\"']*)\2"


def upload_hosts(media: DataFrame, base: str) -> DataFrame:
    """Hosts that uploads of this snapshot live on: its base address and every host in the media
    export. A table, so nothing data-sized reaches the driver."""
    guid = F.coalesce(blank_to_null(F.col("guid.rendered")), F.col("guid.raw"))
    hosts = media.select(F.explode(F.array(url_host(F.col("source_url")), url_host(guid))).alias("host"))
    own = media.sparkSession.range(1).select(url_host(F.lit("" if base == "unknown" else base)).alias("host"))
    return hosts.unionByName(own).where(F.col("host") != "").distinct()


def body_references(
    docs: DataFrame, hosts: DataFrame, origin: str, key: list[str], body: str = "body_html"
) -> DataFrame:
    """Every upload reference of a body: key columns, ``at``, ``tag``, ``attr``, ``raw``, ``url``.

    Image tags are read attribute by attribute, ``srcset`` candidates count one by one, links to
    uploads count too. All in JVM expressions, one row per reference.
    """

    def found(tag: Column, kind: str, attr: str, many: bool) -> Column:
        value = F.regexp_extract(tag, _attribute(attr), 3)
        values = F.split(value, ",") if many else F.array(value)
        raws = F.transform(values, lambda v: F.regexp_extract(F.trim(v), r"^(\S*)", 1) if many else F.trim(v))
        return F.transform(
            F.filter(raws, lambda r: r != ""),
            lambda r: F.struct(F.lit(kind).alias("tag"), F.lit(attr).alias("attr"), r.alias("raw")),
        )

    images = F.transform(
        F.regexp_extract_all(body, F.lit(IMG), F.lit(0)),
        lambda t: F.concat(
            *[found(t, "img", a, False) for a in URL_ATTRIBUTES], *[found(t, "img", a, True) for a in SRCSET_ATTRIBUTES]
        ),
    )
    links = F.transform(
        F.regexp_extract_all(body, F.lit(ANCHOR), F.lit(0)), lambda t: found(t, "a", "href", False)
    )
    rows = (
        docs.select(*key, F.posexplode(F.flatten(F.concat(images, links))).alias("at", "r"))
        .select(*key, "at", "r.*", absolutise(F.col("r.raw"), origin).alias("url"))
        .where(percent_decode(part(F.col("url"), 3)).contains(UPLOADS_PATH))
        .withColumn("host", url_host(F.col("url")))
    )
    return rows.join(hosts, "host", "left_semi").drop("host")


def residual_references(docs: DataFrame, hosts: DataFrame, origin: str, key: list[str]) -> DataFrame:
    """Upload references a (rewritten) body still carries, per document that has any."""
    return body_references(docs, hosts, origin, key).groupBy(*key).agg(F.count(F.lit(1)).alias("residual"))


def known_media(media: DataFrame) -> DataFrame:
    """``canon -> source_url, media_id, alt, mime``: the first media row of each file."""
    row = F.struct("id", "source_url", "alt_text", "mime_type")
    return (
        media.where(F.col("source_url") != "")
        .groupBy(canon_key(F.col("source_url")).alias("canon"))
        .agg(F.min_by(row, "id").alias("m"))
        .select(
            "canon",
            F.col("m.source_url").alias("source_url"),
            F.col("m.id").alias("media_id"),
            F.col("m.alt_text").alias("alt_text"),
            F.col("m.mime_type").alias("mime_type"),
        )
    )


def resolve_references(refs: DataFrame, media: DataFrame) -> DataFrame:
    """Add ``source_url`` and ``resolved``: the media row of the reference itself, else of the file
    its thumbnail was made from, else the URL as written.

    Distinct URLs are resolved, not references, so a logo used on a third of all pages costs one
    lookup; the result is joined back by URL. Media keys are made of much longer text than the columns
    Spark's size estimate knows, so the lookups are told to sort and merge: a broadcast of them would
    stand whole in the driver and in every executor.
    """
    known = known_media(media).select("canon", "source_url").hint("merge")
    exact = known.withColumnsRenamed({"canon": "_canon", "source_url": "_exact"})
    thumbnail = known.withColumnsRenamed({"canon": "_original", "source_url": "_from"})
    urls = (
        refs.select("url").distinct()
        .withColumn("_canon", canon_key(F.col("url")))
        .withColumn("_original", canon_key(original_of(F.col("url"))))
        .join(exact, "_canon", "left")
        .join(thumbnail, "_original", "left")
        .select(
            "url",
            F.coalesce("_exact", "_from", "url").alias("source_url"),
            (F.col("_exact").isNotNull() | F.col("_from").isNotNull()).alias("resolved"),
        )
    )
    return refs.join(urls, "url")


def build_body_media(
    resolved: DataFrame, media: DataFrame, media_head: DataFrame, snapshot: str
) -> tuple[DataFrame, DataFrame]:
    """One file record per distinct original, with counts. Which documents use it and under which
    spellings are :func:`media_usage` and :func:`media_spellings` rows, not lists."""
    known = known_media(media)
    heads = media_head.select(F.col("url").alias("source_url"), F.col("status").alias("http_status")).dropDuplicates(["source_url"])
    files = (
        resolved.groupBy("source_url", "resolved")
        .agg(F.count(F.lit(1)).alias("reference_count"))
        .withColumn("canon", canon_key(F.col("source_url")))
        .join(known.drop("source_url"), "canon", "left")
        .join(heads, "source_url", "left")
    )
    down = F.coalesce(F.col("http_status") != 200, F.lit(False))
    name = url_filename(F.col("source_url"))
    records = files.select(
        "source_url",
        name.alias("filename"),
        clean_text(F.col("alt_text")).alias("alt"),
        content_type(F.col("source_url"), F.col("mime_type")).alias("content_type"),
        "resolved",
        "media_id",
        (F.col("http_status") == 200).alias("reachable"),
        "http_status",
        "reference_count",
        down.alias("held"),
        F.array_compact(F.array(F.when(down, "body_image_unreachable"))).alias("held_reasons"),
        source_ref(F.col("media_id"), "body_image", snapshot),
    )
    rules = [
        Rule(
            ~F.col("resolved"), "body_image_not_in_media_export", "medium",
            "body image is not in the media export; uploaded by URL",
        ),
        Rule(
            F.col("http_status") != 200, "body_image_unreachable", "high",
            F.concat(F.lit("body image returned HTTP "), F.col("http_status").cast("string"), F.lit("; body keeps the old URL")),
            owner=AGENCY, retry="auto-retryable",
        ),
    ]
    return records, exceptions_from_rules(files, rules, "body_image", F.col("media_id"), name)


def media_usage(resolved: DataFrame, key: list[str]) -> DataFrame:
    """``source_url`` and the documents that show it, one row per pair."""
    return resolved.select("source_url", *key).distinct()


def media_spellings(resolved: DataFrame) -> DataFrame:
    """Other spellings of each file."""
    return resolved.where(F.col("url") != F.col("source_url")).select("source_url", "url").distinct()


def target_urls(ledger: DataFrame, cdn: str) -> DataFrame:
    """``source_url -> new_url`` of uploaded files, derived from the ledger id, so a rerun derives
    the same body."""
    name = F.regexp_replace(F.url_encode(url_filename(F.col("key"))), r"\+", "%20")
    return ledger.where(F.col("resource") == "File").select(
        F.col("key").alias("source_url"),
        F.concat(F.lit(cdn.rstrip("/") + "/"), name, F.lit("?v="), F.col("id").cast("string")).alias("new_url"),
    )


_PATTERNS = {a: re.compile(_attribute(a)) for a in [*URL_ATTRIBUTES, *SRCSET_ATTRIBUTES, *DESCRIPTOR_ATTRIBUTES, "href"]}
_IMG, _ANCHOR, _GAP = re.compile(IMG), re.compile(ANCHOR), re.compile(r"\s{2,}")


def _swap(tag: str, attr: str, new_value) -> str:
    """Tag with the first ``attr`` value replaced by ``new_value(old)``; None keeps it."""
    found = _PATTERNS[attr].search(tag)
    value = new_value(found[3]) if found else None
    return tag if value is None else f"{tag[: found.start(3)]}{value}{tag[found.end(3) :]}"


def _new_candidates(value: str, moved: dict[str, str]) -> dict[str, str]:
    kept: dict[str, str] = {}
    for candidate in filter(None, map(str.split, value.split(","))):
        kept.setdefault(moved.get(candidate[0], candidate[0]), " ".join(candidate[1:]))
    return kept


def _new_image(tag: str, moved: dict[str, str]) -> str:
    source = None
    for attr in URL_ATTRIBUTES:
        found = _PATTERNS[attr].search(tag)
        new = moved.get(found[3].strip()) if found else None
        if new:
            tag, source = _swap(tag, attr, lambda _: new), new if attr == "src" else source
    for attr in SRCSET_ATTRIBUTES:
        found = _PATTERNS[attr].search(tag)
        if not found:
            continue
        kept = _new_candidates(found[3], moved)
        tag = _swap(tag, attr, lambda _: ", ".join(f"{u} {d}".strip() for u, d in kept.items()))
        if kept and set(kept) == {source}:
            # every candidate became the one file: the list says nothing any more
            for gone in (attr, *DESCRIPTOR_ATTRIBUTES):
                tag = _PATTERNS[gone].sub("", tag, count=1)
    return _GAP.sub(" ", tag)


def _new_body(body: str, moved: dict[str, str]) -> str:
    body = _IMG.sub(lambda m: _new_image(m[0], moved), body)
    return _ANCHOR.sub(lambda m: _swap(m[0], "href", lambda old: moved.get(old.strip())), body)


@F.pandas_udf(StringType())
def _rewrite(bodies: pd.Series, moves: pd.Series) -> pd.Series:
    return pd.Series([b if not m else _new_body(b, dict(m)) for b, m in zip(bodies, moves)])


def rewrite_bodies(docs: DataFrame, resolved: DataFrame, urls: DataFrame, key: list[str]) -> DataFrame:
    """Bodies with every mapped reference moved, plus ``references``, ``rewritten``, ``left``.

    The map handed to a document holds that document's own references only. New addresses are merged
    in, never broadcast (see :func:`resolve_references`).
    """
    moved = resolved.join(urls.hint("merge"), "source_url", "left")
    per_doc = moved.groupBy(*key).agg(
        F.map_from_entries(F.collect_set(F.when(F.col("new_url").isNotNull(), F.struct("raw", "new_url")))).alias("_moves"),
        F.count(F.lit(1)).alias("references"),
        F.count("new_url").alias("rewritten"),
    )
    zero = F.lit(0).cast("bigint")
    return (
        docs.join(per_doc, key, "left")
        .withColumn("body_html", _rewrite(F.col("body_html"), F.col("_moves")))
        .withColumn("references", F.coalesce("references", zero))
        .withColumn("rewritten", F.coalesce("rewritten", zero))
        .withColumn("left", F.col("references") - F.col("rewritten"))
        .drop("_moves")
    )
