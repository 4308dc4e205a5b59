"""Keyed ledger of what was loaded: upsert by checksum, versions, diff, load order, plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.text import json_checksum
from cartloom.operators.exceptions import AGENCY, Rule, exceptions_from_rules, union_all
from cartloom.operators.media import rewrite_bodies
from cartloom.operators.skew import numbered
from cartloom.session import checkpointed
from cartloom.sources.snapshot import path_exists

LEDGER = "resource string, key string, id bigint, checksum string, payload string"
OUTCOMES = ["created", "updated", "unchanged", "failed"]



def load_order() -> list[tuple[str, str, Column]]:
    """``(record type, resource, identity key)`` in load order."""
    source = F.concat(F.lit("source:"), F.col("source.source_id").cast("string"))
    handle = F.col("handle")
    return [
        ("metafield_definitions", "MetafieldDefinition", F.concat_ws(":", "owner_type", F.concat_ws(".", "namespace", "key"))),
        ("collections", "Collection", handle),
        ("products", "Product", handle),
        ("variants", "ProductVariant", source),
        ("media", "MediaImage", F.concat_ws(":", "product_handle", "original_url")),
        ("variants_inventory", "InventoryItem", source),
        ("collection_membership", "CollectionMembership", F.concat_ws(":", "handle", "product_handle")),
        ("metafields", "Metafield", F.concat_ws(":", "owner_type", "owner_handle", F.concat_ws(".", "namespace", "key"))),
        ("body_media", "File", F.col("source_url")),
        ("pages", "Page", handle),
        ("articles", "Article", handle),
        ("customers", "Customer", F.col("email")),
        ("discounts", "DiscountCodeNode", F.col("code")),
    ]


#: fields that say how a record is used, not what it is: outside the checksum
PAYLOAD_EXCLUDED = {
    "products": ["surface", "clubs", "genders"],
    "variants": ["product_id"],
    "media": ["product_id"],
    "body_media": ["reference_count"],
    "pages": ["references", "rewritten", "left"],
    "articles": ["references", "rewritten", "left"],
}
PRODUCT_SCOPED = {
    "products": "handle",
    "variants": "product_handle",
    "variants_inventory": "product_handle",
    "media": "product_handle",
    "metafields": "owner_handle",
    "collection_membership": "product_handle",
}


def payload_rows(name: str, resource: str, key: Column, df: DataFrame) -> DataFrame:
    """Batch rows of one record type: ``resource, key, payload, checksum, source_id, sku``."""
    dropped = {"held", "held_reasons", *PAYLOAD_EXCLUDED.get(name, [])}
    fields = sorted(c for c in df.columns if c not in dropped)
    body = F.struct(*[F.col(c) for c in fields])
    return df.select(
        F.lit(resource).alias("resource"),
        key.alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"),
        json_checksum(body).alias("checksum"),
        (F.col("source.source_id") if "source" in df.columns else F.lit(None).cast("bigint")).alias("source_id"),
        (F.col("sku") if "sku" in df.columns else F.lit(None).cast("string")).alias("sku"),
    )


def inventory_records(variants: DataFrame) -> DataFrame:
    return variants.where(~F.col("held")).select(
        "sku",
        F.col("inventory_tracked").alias("tracked"),
        F.col("inventory_quantity").alias("quantity"),
        F.col("inventory_policy").alias("policy"),
        "requires_shipping",
        "product_handle",
        "source",
        "held",
        "held_reasons",
    )


def held_exceptions(name: str, key: Column, df: DataFrame) -> DataFrame:
    rule = Rule(
        F.col("held"), "record_held_from_load", "high",
        "record has an unresolved blocking exception and was not loaded", owner=AGENCY,
        detail=F.struct(F.col("held_reasons").alias("reasons") if "held_reasons" in df.columns else F.lit(None).cast("array<string>").alias("reasons")),
    )
    source_id = F.col("source.source_id") if "source" in df.columns else F.lit(None)
    return exceptions_from_rules(df, [rule], name.rstrip("s"), source_id, key, stage="load")


def upsert(ledger: DataFrame, batch: DataFrame, counters: DataFrame | None = None, max_group_rows: int | None = None) -> DataFrame:
    """Ledger and batch merged: one row per key with ``outcome`` and the surviving entry.

    Same checksum is ``unchanged``, an unknown key gets the next id of its resource, anything else
    is ``updated`` under its id. ``batch`` keys are unique. With an ``applied`` column, rows that
    failed on the target are ``failed`` and leave the ledger as it was, so the next run retries just
    them. New ids follow the MD5 order of the keys, numbered in ranges, so a resource with most of
    the rows is not numbered by one task. ``counters`` (``resource, last_id``) keeps pruned ids from
    being used again.
    """
    old = ledger.select("resource", "key", *[F.col(c).alias(f"_{c}") for c in ("id", "checksum", "payload")])
    applied = F.col("applied") if "applied" in batch.columns else F.lit(True)
    new = batch.withColumn("applied", applied).withColumn("_in", F.lit(True))
    merged = old.join(new, ["resource", "key"], "full")
    outcome = (
        F.when(F.col("_in").isNull(), F.lit(None))
        .when(F.col("_id").isNotNull() & (F.col("_checksum") == F.col("checksum")), "unchanged")
        .when(~F.col("applied"), "failed")
        .when(F.col("_id").isNull(), "created")
        .otherwise("updated")
    )
    marked = merged.withColumn("outcome", outcome)
    last = ledger.groupBy("resource").agg(F.max("id").alias("last_id"))
    if counters is not None:
        kept = counters.groupBy("resource").agg(F.max("last_id").alias("_kept"))
        last = last.join(kept, "resource", "full").select("resource", F.greatest("last_id", "_kept").alias("last_id"))
    order = F.conv(F.substring(F.md5("key"), 1, 13), 16, 10).cast("bigint")
    extra = {} if max_group_rows is None else {"max_rows": max_group_rows}
    created = marked.where(F.col("outcome") == "created").select("resource", "key").withColumn("_order", order)
    turns = numbered(created, ["resource"], ["_order", "key"], ["_order"], out="_n", **extra).drop("_order")
    # one more join on the keys both sides are dealt by already; a union of known and new rows would need two scans
    every = (
        marked.join(turns, ["resource", "key"], "left")
        .join(last, "resource", "left")
        .withColumn("id", F.coalesce("_id", F.coalesce("last_id", F.lit(0).cast("bigint")) + F.col("_n")))
    )
    take_new = F.col("outcome").isin("created", "updated")
    return every.select(
        "resource",
        "key",
        "id",
        F.when(take_new, F.col("checksum")).otherwise(F.col("_checksum")).alias("checksum"),
        F.when(take_new, F.col("payload")).otherwise(F.col("_payload")).alias("payload"),
        "outcome",
    )


def next_version(merged: DataFrame) -> DataFrame:
    """Ledger rows after :func:`upsert`; a failed new row leaves none."""
    return merged.where(F.col("id").isNotNull()).drop("outcome")


def outcomes(merged: DataFrame) -> DataFrame:
    return merged.where(F.col("outcome").isNotNull()).select("resource", "key", "id", "outcome")


def per_resource_outcomes(results: DataFrame) -> DataFrame:
    """Counts of the four outcomes by resource."""
    return results.groupBy("resource").agg(
        *[F.count(F.when(F.col("outcome") == o, 1)).alias(o) for o in OUTCOMES]
    )


def retry_failed(results: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch rows the last run could not apply."""
    failed = results.where(F.col("outcome") == "failed").select("resource", "key")
    return batch.join(failed, ["resource", "key"], "left_semi")


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``resource, key, change, id_reused`` of every key: created, changed, removed or same."""
    old = before.select("resource", "key", F.col("id").alias("_id"), F.col("checksum").alias("_checksum"))
    new = after.select("resource", "key", "id", "checksum")
    change = (
        F.when(F.col("_id").isNull(), "created")
        .when(F.col("id").isNull(), "removed")
        .when(F.col("checksum") != F.col("_checksum"), "changed")
        .otherwise("same")
    )
    return old.join(new, ["resource", "key"], "full").select(
        "resource", "key", change.alias("change"), F.coalesce(F.col("id") == F.col("_id"), F.lit(False)).alias("id_reused")
    )


def diff_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("resource").agg(
        *[F.count(F.when(F.col("change") == c, 1)).alias(c) for c in ("created", "changed", "removed")],
        F.count(F.when(F.col("id_reused"), 1)).alias("ids_reused"),
    )


def write_ledger(ledger: DataFrame, folder: str, version: str) -> None:
    """One immutable folder per version, partitioned by resource."""
    ledger.write.mode("errorifexists").partitionBy("resource").parquet(f"{folder}/{version}")


def read_ledger(spark: SparkSession, folder: str, version: str | None) -> DataFrame:
    """A version, or an empty ledger where there is none."""
    if version is None or not path_exists(spark, f"{folder}/{version}"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{folder}/{version}").select("resource", "key", "id", "checksum", "payload")


def ledger_index(ledger: DataFrame) -> DataFrame:
    """``index, key, id`` rows: SKU and source id to target id, one row per pair. Customers are
    found by source id only, never by e-mail."""
    payload = F.col("payload")
    source_id = F.get_json_object(payload, "$.source.source_id")
    resource = F.col("resource")
    variant = resource.isin("ProductVariant", "InventoryItem")

    def entry(when: Column, name: str, key: Column) -> Column:
        return F.when(when & key.isNotNull() & (key != ""), F.struct(F.lit(name).alias("index"), key.alias("key")))

    entries = F.array(
        entry(variant, "variant_sku", F.get_json_object(payload, "$.sku")),
        entry(variant, "variant_source_id", source_id),
        entry(resource == "Product", "product_source_id", source_id),
        entry(resource == "Page", "page_source_id", source_id),
        entry(resource == "Article", "article_source_id", source_id),
        entry(resource == "Customer", "customer_source_id", source_id),
    )
    return (
        ledger.select(F.explode(F.array_compact(entries)).alias("e"), "id").select("e.index", "e.key", "id").distinct()
    )


def selected(name: str, df: DataFrame, scope: DataFrame | None) -> DataFrame:
    """Rows within a product scope (``product_handle``); unscoped types pass."""
    column = PRODUCT_SCOPED.get(name)
    if scope is None or column is None:
        return df
    return df.join(scope.select(F.col("product_handle").alias(column)).distinct(), column, "left_semi").select(*df.columns)


def load_all(
    records: Mapping[str, DataFrame],
    ledger: DataFrame,
    skip: Sequence[str] = (),
    only: Sequence[str] | None = None,
    scope: DataFrame | None = None,
    body_refs: DataFrame | None = None,
    urls_of=None,
    counters: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Load every record type; gives ``ledger``, ``results`` and ``exceptions``.

    All types but pages and articles go in one upsert. Bodies follow in a second one, rewritten with
    the addresses ``urls_of(ledger)`` derives from the files just loaded, so their checksum covers
    the body the target receives. ``body_refs`` are resolved references keyed by ``doc_type,
    handle``.
    """
    every = {
        **records,
        "variants_inventory": inventory_records(records["variants"]) if "variants" in records else None,
    }
    bodies = ("pages", "articles")
    chosen = [
        (name, resource, key)
        for name, resource, key in load_order()
        if every.get(name) is not None and name not in skip and (only is None or name in only)
    ]

    def batch(names: list, source: Mapping[str, DataFrame]) -> DataFrame:
        parts = []
        for name, resource, key in names:
            df = selected(name, source[name], scope)
            loadable = df.where(~F.col("held")) if "held" in df.columns else df
            parts.append(payload_rows(name, resource, key, loadable))
        return union_all(parts)

    first = [c for c in chosen if c[0] not in bodies]
    second = [c for c in chosen if c[0] in bodies]
    raised = [
        held_exceptions(name, key, selected(name, every[name], scope))
        for name, _resource, key in chosen
        if "held" in every[name].columns and name != "variants_inventory"
    ]
    if not chosen:
        raise ValueError("no record type left to load")
    results, current = [], ledger
    if first:
        merged = checkpointed(upsert(current, batch(first, every), counters))
        results.append(outcomes(merged))
        current = next_version(merged)
    if second:
        moved = {name: every[name] for name, _, _ in second}
        if body_refs is not None and urls_of is not None:
            moved = {
                name: rewrite_bodies(
                    df, body_refs.where(F.col("doc_type") == name).drop("doc_type"), urls_of(current), ["handle"]
                )
                for name, df in moved.items()
            }
        merged = checkpointed(upsert(current, batch(second, moved), counters))
        results.append(outcomes(merged))
        current = next_version(merged)
    return {
        "ledger": current,
        "results": union_all(results),
        "exceptions": union_all(raised) if raised else None,
    }
