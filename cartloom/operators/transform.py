"""The whole catalog transform: snapshot tables to record tables and one exception register."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.functions.urls import url_host
from cartloom.operators import catalog, media
from cartloom.operators.exceptions import union_all
from cartloom.sources.snapshot import Snapshot


def table_store(folder: str) -> Callable[[str, DataFrame], DataFrame]:
    """Keeps a step's result as a Parquet table, so later steps read it instead of redoing it and a
    lost executor costs one file read."""

    def keep(name: str, df: DataFrame) -> DataFrame:
        path = f"{folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return keep


def hold_with_product(records: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of held products are held too. ``held``: handles of held products."""
    flags = held.select(F.col("handle").alias("product_handle"), F.lit(True).alias("_held"))
    own = F.col("held") if "held" in records.columns else F.lit(False)
    reasons = F.col("held_reasons") if "held_reasons" in records.columns else F.array().cast("array<string>")
    by_product = F.col("_held").isNotNull()
    return (
        records.join(flags, "product_handle", "left")
        .withColumn("held_reasons", F.when(by_product, F.array_union(reasons, F.array(F.lit("product_held")))).otherwise(reasons))
        .withColumn("held", own | by_product)
        .drop("_held")
    )


def body_docs(records: dict[str, DataFrame]) -> DataFrame:
    """Bodies of pages and articles with ``doc_type`` and ``held``."""
    return union_all(
        [records[t].select(F.lit(t).alias("doc_type"), "handle", "body_html", "held") for t in ("pages", "articles")]
    )


def transform(snapshot: Snapshot, folder: str, vendor: str, sku_prefix: str = catalog.SKU_PREFIX) -> dict[str, DataFrame]:
    """All record tables by name, plus ``exceptions``, ``body_refs`` and ``body_usage``."""
    spark, taken = snapshot["products"].sparkSession, snapshot.taken
    keep = table_store(folder)
    products, variations = snapshot["products"], snapshot["variations"]
    raised: list[DataFrame] = []

    classified = keep("classified", catalog.classified_products(products))
    options, issues = catalog.build_options(products, variations)
    options, issues = keep("options", options), keep("option_issues", issues)
    raised.append(catalog.option_exceptions(issues, classified))
    variants, found = catalog.build_variants(products, classified, variations, options, taken, sku_prefix=sku_prefix, keep=partial(keep, "variants_judged"))
    variants = keep("variants_built", variants)
    raised += [found, catalog.duplicate_sku_exceptions(variants)]
    images, found = catalog.build_media(products, classified, variations, snapshot["media"], snapshot["media_head"], taken, sku_prefix)
    images = keep("media_built", images)
    raised.append(found)
    sold, shown = variants.select("product_id").distinct(), images.select("product_id").distinct()
    rows, found = catalog.build_products(classified, options, issues, sold, shown, taken, vendor)
    records = {"products": keep("products", rows)}
    raised.append(found)
    held = records["products"].where("held").select("handle")
    records["variants"] = keep("variants", hold_with_product(variants, held))
    records["media"] = keep("media", hold_with_product(images, held))
    rows, found = catalog.product_metafields(records["products"])
    records["metafields"] = keep("metafields", rows)
    raised.append(found)
    records["metafield_definitions"] = catalog.metafield_definitions(spark, taken)
    records["collection_membership"] = keep("collection_membership", catalog.collection_members(records["products"]))
    rows, found = catalog.build_collections(catalog.collection_definitions(spark), records["collection_membership"], taken)
    records["collections"] = keep("collections", rows)
    raised.append(found)
    for name, (rows, found) in {
        "pages": catalog.build_pages(snapshot["pages"], taken),
        "articles": catalog.build_articles(snapshot["posts"], snapshot["post_tags"], snapshot["post_categories"], taken),
        "customers": catalog.build_customers(snapshot["customers"], taken),
        "discounts": catalog.build_discounts(snapshot["coupons"], taken),
    }.items():
        records[name] = keep(name, rows)
        raised.append(found)
    origin = spark.range(1).select(url_host(F.lit("" if snapshot.base == "unknown" else snapshot.base))).first()[0]
    hosts = keep("upload_hosts", media.upload_hosts(snapshot["media"], snapshot.base))
    docs = body_docs(records)
    refs = media.body_references(docs.where(~F.col("held")), hosts, origin, ["doc_type", "handle"])
    resolved = keep("body_refs", media.resolve_references(refs, snapshot["media"]))
    rows, found = media.build_body_media(resolved, snapshot["media"], snapshot["media_head"], taken)
    records["body_media"] = keep("body_media", rows)
    raised.append(found)
    records["id_map"] = catalog.id_map(records, taken)
    return {
        **records,
        "body_refs": resolved,
        "body_usage": media.media_usage(resolved, ["doc_type", "handle"]),
        "upload_hosts": hosts,
        "exceptions": keep("exceptions", union_all(raised)),
    }
