"""schema.org records as JSON text. ``to_json`` leaves null members out, so empty ones are nulled."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.functions.text import blank_to_null
from cartloom.functions.urls import deployment_url

CONTEXT = "https://schema.org"


def capped(c: Column, limit: int) -> Column:
    """One line, ellipsis past ``limit`` (the field's published maximum), null when blank."""
    text = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))
    cut = F.concat(F.rtrim(F.substring(text, 1, limit - 1)), F.lit("…"))
    return F.when(F.length(text) > limit, cut).otherwise(blank_to_null(text))


def script_safe(json: Column) -> Column:
    """Escape what could close or break the script element that holds the JSON."""
    out = json
    for char, escape in (
        ("<", "u003c"),
        (">", "u003e"),
        ("&", "u0026"),
        ("\u2028", "u2028"),
        ("\u2029", "u2029"),
    ):
        out = F.replace(out, F.lit(char), F.lit("\\" + escape))
    return out


def price_text(c: Column) -> Column:
    return F.coalesce(c.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).cast("string")


def availability(in_stock: Column) -> Column:
    return F.when(in_stock, f"{CONTEXT}/InStock").otherwise(f"{CONTEXT}/OutOfStock")


def _node(kind: str, *members: Column) -> Column:
    return script_safe(F.to_json(F.struct(F.lit(CONTEXT).alias("@context"), F.lit(kind).alias("@type"), *members)))


def product_json_ld(base: str, offer_count: Column) -> Column:
    """Over one row per product: path, name, description, images, sku, brand, currency, low, high,
    available, offer_sku. One offer gives ``Offer``, any other number ``AggregateOffer``."""
    url = deployment_url(base, F.col("path"))
    images = F.transform(
        F.filter("images", lambda i: F.trim(i) != ""),
        lambda i: F.when(i.rlike("(?i)^https?://"), i).otherwise(deployment_url(base, i)),
    )
    single = offer_count == 1
    brand = capped(F.col("brand"), 100)
    offers = F.struct(
        F.when(single, "Offer").otherwise("AggregateOffer").alias("@type"),
        url.alias("url"),
        F.when(single, price_text(F.col("low"))).alias("price"),
        F.when(~single, price_text(F.col("low"))).alias("lowPrice"),
        F.when(~single, price_text(F.col("high"))).alias("highPrice"),
        F.col("currency").alias("priceCurrency"),
        F.when(~single & (offer_count > 0), offer_count).alias("offerCount"),
        availability(F.col("available")).alias("availability"),
        F.when(single, f"{CONTEXT}/NewCondition").alias("itemCondition"),
        F.when(single, capped(F.col("offer_sku"), 100)).alias("sku"),
    )
    return _node(
        "Product",
        capped(F.col("name"), 200).alias("name"),
        url.alias("url"),
        capped(F.col("description"), 1000).alias("description"),
        F.when(F.size(images) > 0, images).alias("image"),
        capped(F.col("sku"), 100).alias("sku"),
        F.when(brand.isNotNull(), F.struct(F.lit("Brand").alias("@type"), brand.alias("name"))).alias("brand"),
        offers.alias("offers"),
    )


def article_json_ld(base: str) -> Column:
    """Over path, headline, description, image, date_published, date_modified, author."""
    url = deployment_url(base, F.col("path"))
    organization = f"{base.rstrip('/')}#organization"
    author = capped(F.col("author"), 100)
    return _node(
        "Article",
        F.struct(F.lit("WebPage").alias("@type"), url.alias("@id")).alias("mainEntityOfPage"),
        url.alias("url"),
        capped(F.col("headline"), 110).alias("headline"),
        capped(F.col("description"), 1000).alias("description"),
        F.when(blank_to_null(F.col("image")).isNotNull(), F.array("image")).alias("image"),
        capped(F.col("date_published"), 40).alias("datePublished"),
        capped(F.coalesce("date_modified", "date_published"), 40).alias("dateModified"),
        F.struct(
            F.when(author.isNotNull(), "Person").alias("@type"),
            author.alias("name"),
            F.when(author.isNull(), organization).alias("@id"),
        ).alias("author"),
        F.struct(F.lit(organization).alias("@id")).alias("publisher"),
    )


def breadcrumb_json_ld(base: str, items: Column) -> Column:
    """Of ``array<struct<name, path>>``; the current page has no path."""
    entries = F.transform(
        items,
        lambda item, i: F.struct(
            F.lit("ListItem").alias("@type"),
            (i + 1).alias("position"),
            capped(item["name"], 200).alias("name"),
            F.when(blank_to_null(item["path"]).isNotNull(), deployment_url(base, item["path"])).alias("item"),
        ),
    )
    return _node("BreadcrumbList", entries.alias("itemListElement"))


def site_json_ld(base: str, name: Column, logo: str) -> Column:
    """``array`` of the Organization and WebSite records."""
    home = base.rstrip("/")
    organization = _node(
        "Organization",
        F.lit(f"{home}#organization").alias("@id"),
        name.alias("name"),
        F.lit(home).alias("url"),
        deployment_url(base, F.lit(logo)).alias("logo"),
    )
    action = F.struct(
        F.lit("SearchAction").alias("@type"),
        F.struct(
            F.lit("EntryPoint").alias("@type"),
            F.lit(f"{home}/search?q={{search_term_string}}").alias("urlTemplate"),
        ).alias("target"),
        F.lit("required name=search_term_string").alias("query-input"),
    )
    website = _node(
        "WebSite",
        F.lit(f"{home}#website").alias("@id"),
        name.alias("name"),
        F.lit(home).alias("url"),
        F.struct(F.lit(f"{home}#organization").alias("@id")).alias("publisher"),
        action.alias("potentialAction"),
    )
    return F.array(organization, website)
