"""Catalog reads: product view, scopes, filters, facets, search, related products, rails."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.functions.html import html_to_text, sanitize_html
from cartloom.functions.options import lookup, option_rank, string_array, tag_values
from cartloom.functions.text import blank_to_null, storefront_slug
from cartloom.operators.audit import RESERVED_HANDLES
from cartloom.rules import shop

PLACEHOLDER_NAME, PLACEHOLDER_VALUE = "Title", "Default Title"
LISTING_SIZE_ORDER = ["4XS", "3XS", "2XS", "XS", "S", "M", "L", "XL", "2XL", "3XL", "S/M", "M/L"]


def variant_summary(variants: DataFrame, product: str = "product_handle") -> DataFrame:
    """Per product: price range, compare-at, availability, the single variant's id."""
    return variants.groupBy(product).agg(
        F.min("price").alias("price"),
        F.max("price").alias("max_price"),
        F.max("compare_at_price").alias("_compare_at"),
        F.max("available").alias("in_stock"),
        F.min("currency").alias("currency"),
        F.count(F.lit(1)).alias("variant_count"),
        F.min("variant_id").alias("_variant"),
    )


def option_values(options: Column, names: Sequence[str]) -> Column:
    hit = F.filter(options, lambda o: F.lower(F.trim(o["name"])).isin(*names))
    return F.flatten(F.transform(hit, lambda o: o["values"]))


def catalog_view(products: DataFrame, variants: DataFrame, labels: Mapping[str, str] = shop.TYPE_TITLES) -> DataFrame:
    """Listing row per product.

    ``products``: handle, title, vendor, product_type, tags, options, image, created_at;
    ``variants``: product_handle, variant_id, price, compare_at_price, available, currency. A
    product without variants has no price and is not listed.
    """
    category = F.coalesce(
        F.get(tag_values(F.col("tags"), "type:"), F.lit(0)), blank_to_null(storefront_slug(F.col("product_type"))), F.lit("shop")
    )
    compare = F.when(F.col("_compare_at") > F.col("price"), F.col("_compare_at"))
    return (
        products.withColumnRenamed("handle", "product_handle")
        .join(variant_summary(variants), "product_handle")
        .withColumn("category_id", category)
        .select(
            F.col("product_handle").alias("handle"),
            "title",
            blank_to_null(F.trim("vendor")).alias("vendor"),
            "image",
            "price",
            "max_price",
            compare.alias("compare_at_price"),
            "currency",
            compare.isNotNull().alias("on_sale"),
            "in_stock",
            "category_id",
            F.coalesce(lookup(labels, F.col("category_id")), blank_to_null(F.col("product_type")), F.col("category_id")).alias("category_label"),
            F.get(tag_values(F.col("tags"), "surface:"), F.lit(0)).alias("surface"),
            tag_values(F.col("tags"), "club:").alias("clubs"),
            tag_values(F.col("tags"), "gender:").alias("gender"),
            option_values(F.col("options"), ["colour", "color"]).alias("colours"),
            option_values(F.col("options"), ["size", "sizes"]).alias("sizes"),
            F.when(F.col("variant_count") == 1, F.col("_variant")).alias("variant_id"),
            "created_at",
        )
    )


def product_detail_view(view: DataFrame, details: DataFrame) -> DataFrame:
    """Detail row: metafields override tags, the placeholder option is gone, swatches by value.

    ``details``: handle, options ``array<struct<name, values, swatches map>>``, fields
    ``map<key, array<string>>``, images, collection_handle, collection_title.
    """
    real = F.filter(
        "options",
        lambda o: (F.size(o["values"]) > 0)
        & ~((o["name"] == PLACEHOLDER_NAME) & (F.size(o["values"]) == 1) & (F.get(o["values"], F.lit(0)) == PLACEHOLDER_VALUE)),
    )
    crumb = F.when(
        F.col("collection_handle").isNotNull(),
        F.struct(F.concat(F.lit("/shop/"), "collection_handle").alias("href"), F.col("collection_title").alias("label")),
    ).otherwise(F.struct(F.concat(F.lit("/shop/"), "category_id").alias("href"), F.col("category_label").alias("label")))
    fields = lambda k: F.try_element_at("fields", F.lit(k))
    return (
        view.join(details, "handle")
        .withColumn("gender", F.coalesce(fields("gender"), "gender"))
        .withColumn("surface", F.coalesce(F.get(fields("surface"), F.lit(0)), "surface"))
        .withColumn("clubs", F.coalesce(fields("club"), "clubs"))
        .withColumn("options", real)
        .withColumn("images", F.when(F.size("images") > 0, F.col("images")).otherwise(F.array_compact(F.array("image"))))
        .withColumn("breadcrumb", crumb)
        .drop("collection_handle", "collection_title")
    )


@dataclass(frozen=True)
class Filters:
    """Listing filter state; an empty list does not filter."""

    in_stock: bool = False
    on_sale: bool = False
    gender: Sequence[str] = ()
    surface: Sequence[str] = ()
    colour: Sequence[str] = ()
    size: Sequence[str] = ()
    max_price: float | None = None


def listing_filter(view: DataFrame, f: Filters) -> DataFrame:
    keep = F.lit(True)
    if f.in_stock:
        keep = keep & F.col("in_stock")
    if f.on_sale:
        keep = keep & F.col("on_sale")
    for column, wanted in (("gender", f.gender), ("colours", f.colour), ("sizes", f.size)):
        if wanted:
            keep = keep & F.arrays_overlap(column, string_array(list(wanted)))
    if f.surface:
        keep = keep & F.col("surface").isin(*f.surface)
    if f.max_price is not None:
        keep = keep & (F.col("price") <= f.max_price)
    return view.where(keep)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; each task keeps ``k``, so no full sort runs."""
    return df.orderBy(*order).limit(k)


def listing_sort(view: DataFrame, how: str = "featured", position: str = "handle") -> DataFrame:
    """Listing order with a stable last key."""
    orders = {
        "featured": [],
        "price-asc": [F.asc("price")],
        "price-desc": [F.desc("price")],
        "newest": [F.desc("created_at")],
        "name-asc": [F.asc("title")],
    }
    return view.orderBy(*orders.get(how, []), F.asc(position))


def resolve_listing(
    view: DataFrame, kind: str, handle: str | None = None, members: DataFrame | None = None, new_arrivals: int = 24
) -> DataFrame | None:
    """Products of a scope: all, new-arrivals, sale, club, surface, category, collection. ``None``
    for a scope that does not exist."""
    if kind == "all":
        return view
    if kind == "new-arrivals":
        return top_k(view, [F.desc("created_at"), F.asc("handle")], new_arrivals)
    if kind == "sale":
        return view.where("on_sale")
    if handle is None:
        return None
    if kind == "club":
        return view.where(F.array_contains("clubs", handle))
    if kind == "surface" and handle in shop.SURFACE_TITLES:
        return view.where(F.col("surface") == handle)
    if kind == "category" and handle in shop.TYPE_TITLES:
        return view.where(F.col("category_id") == handle)
    if kind == "collection" and members is not None:
        mine = members.where(F.col("handle") == handle).select(F.col("product_handle").alias("handle")).distinct()
        return view.join(mine, "handle", "left_semi")
    return None


def haystack() -> Column:
    empty = string_array([])
    return F.lower(
        F.concat_ws(
            " ", "title", "category_id", F.coalesce("surface", F.lit("")),
            *[F.array_join(F.coalesce(c, empty), " ") for c in ("clubs", "colours", "gender")],
        )
    )


def search_catalog(view: DataFrame, query: str, hay: Column | None = None) -> DataFrame:
    """Products whose text holds every term; a blank query finds none."""
    terms = query.lower().split()
    if not terms:
        return view.where(F.lit(False))
    text = haystack() if hay is None else hay
    keep = F.lit(True)
    for term in terms:
        keep = keep & text.contains(term)
    return view.where(keep)


def search_sort(found: DataFrame, how: str = "relevance", position: str = "handle") -> DataFrame:
    order = {"price-asc": [F.asc("price")], "price-desc": [F.desc("price")]}.get(how, [])
    return found.orderBy(*order, F.asc(position))


def facet_counts(view: DataFrame, axes: Mapping[str, Column]) -> DataFrame:
    """``facet, value, n`` of all axes: every product gives its values once per facet, in one pass,
    combined before the shuffle. An axis is an array or a single value."""
    cells = [_cells(facet, values) for facet, values in axes.items()]
    return (
        view.select(F.explode(F.concat(*cells)).alias("c"))
        .where(F.col("c.value").isNotNull() & (F.col("c.value") != ""))
        .groupBy(F.col("c.facet").alias("facet"), F.col("c.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _cells(facet: str, values: Column) -> Column:
    return F.transform(
        F.coalesce(values, string_array([])), lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value"))
    )


def single(c: Column) -> Column:
    return F.array_compact(F.array(c.cast("string")))


def build_facets(view: DataFrame) -> DataFrame:
    """Facet counts of a listing; price bounds are the facet ``price`` with values min and max."""
    counts = facet_counts(
        view,
        {"gender": F.col("gender"), "surface": single(F.col("surface")), "colour": F.col("colours"), "size": F.col("sizes")},
    )
    bounds = view.agg(
        F.coalesce(F.floor(F.min("price")), F.lit(0)).cast("bigint").alias("lo"), F.coalesce(F.ceil(F.max("price")), F.lit(0)).cast("bigint").alias("hi")
    ).selectExpr("stack(2, 'min', lo, 'max', hi) AS (value, n)")
    return counts.unionByName(bounds.select(F.lit("price").alias("facet"), "value", "n"))


def facet_order(facets: DataFrame) -> DataFrame:
    """Colours by count, sizes in wearing order, the rest by value."""
    size = F.when(F.col("facet") == "size", option_rank(F.lit("Size"), F.col("value"), LISTING_SIZE_ORDER))
    colour = F.when(F.col("facet") == "colour", -F.col("n"))
    return facets.orderBy("facet", F.coalesce(size, F.lit(0)), F.coalesce(colour, F.lit(0)), "value")


def build_taxonomy(view: DataFrame, labels: Mapping[str, str] = shop.TYPE_TITLES) -> DataFrame:
    """Navigation and filter counts: ``section, id, label, n``; known categories without products
    count zero."""
    spark = view.sparkSession
    counts = facet_counts(
        view,
        {
            "category": single(F.col("category_id")), "surface": single(F.col("surface")), "club": F.col("clubs"),
            "gender": F.col("gender"), "colour": F.col("colours"), "size": F.col("sizes"),
            "availability": F.array_compact(F.array(F.when(F.col("in_stock"), "in_stock"), F.when(F.col("on_sale"), "on_sale"))),
        },
    )
    known = spark.createDataFrame([("category", k, v) for k, v in labels.items()], "facet string, value string, label string")
    return known.join(counts, ["facet", "value"], "full").select(
        F.col("facet").alias("section"), F.col("value").alias("id"), F.coalesce("label", "value").alias("label"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def category_tiles(view: DataFrame, position: str = "handle") -> DataFrame:
    """Per category: count and image of the first product, one in stock first."""
    first = F.struct(F.when(F.col("in_stock"), 0).otherwise(1), F.col(position))
    return view.groupBy("category_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("image", first).alias("image"))


def home_rails(view: DataFrame, k: int = 8, position: str = "handle") -> DataFrame:
    """``rail, rank, handle``: newest, and popular with stock first."""
    def rail(name: str, order: Sequence[Column]) -> DataFrame:
        picked = top_k(view, order, k)
        # k rows by now
        ranked = picked.select(position, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).alias("rank"))
        return ranked.select(F.lit(name).alias("rail"), "rank", position)

    return rail("new", [F.desc("created_at"), F.asc(position)]).unionByName(
        rail("popular", [F.desc("in_stock"), F.asc(position)])
    )


def related_products(view: DataFrame, group: str, position: str, k: int = 4) -> DataFrame:
    """``position, related, rank``: the first ``k`` others of the same group.

    Only a group's first ``k + 1`` products can be related to anything, so each product joins those
    few rows instead of its whole group. Spark limits each task to ``k + 1`` rows per group before
    the shuffle.
    """
    leaders = (
        view.select(group, F.col(position).alias("related"))
        .withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy("related")))
        .where(F.col("_rank") <= k + 1)
    )
    lists = leaders.groupBy(group).agg(F.sort_array(F.collect_list("related")).alias("_leaders"))
    others = F.slice(F.filter("_leaders", lambda r: r != F.col(position)), 1, k)
    return (
        view.select(group, position)
        .join(lists, group)
        .select(position, F.posexplode(others).alias("_at", "related"))
        .select(position, "related", (F.col("_at") + 1).alias("rank"))
    )


def variant_for_selection(selections: DataFrame, variants: DataFrame) -> DataFrame:
    """Variant of each full selection. ``selections``: selection_id, product, option_names,
    selection ``map``; ``variants``: product, position, variant_id, options
    ``array<struct<name, value>>``. An incomplete selection finds none; the first match counts."""
    complete = F.forall("option_names", lambda n: F.coalesce(F.try_element_at("selection", n), F.lit("")) != "")
    fits = F.forall(
        "options",
        lambda o: F.coalesce(F.try_element_at("selection", o["name"]) == o["value"], F.lit(True)),
    )
    return (
        selections.where(complete)
        .join(variants, "product")
        .where(fits)
        .groupBy("selection_id")
        .agg(F.min_by("variant_id", "position").alias("variant_id"))
    )


def value_available(variants: DataFrame) -> DataFrame:
    """``product, name, value, available``: does any purchasable variant carry the value."""
    return (
        variants.select("product", "available", F.explode("options").alias("o"))
        .groupBy("product", F.col("o.name").alias("name"), F.col("o.value").alias("value"))
        .agg(F.bool_or("available").alias("available"))
    )


def sole_purchasable(variants: DataFrame) -> DataFrame:
    """``product, variant_id, options`` where exactly one variant can be bought."""
    return (
        variants.where("available")
        .groupBy("product")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("variant_id", "options")).alias("v"))
        .where(F.col("n") == 1)
        .select("product", "v.*")
    )


def content_view(content: DataFrame, html: str, summary: str) -> DataFrame:
    """Pages or articles ready to show: clean markup and a description. Reserved handles never are."""
    text = lambda c: blank_to_null(F.trim(F.coalesce(c, F.lit(""))))
    return (
        content.where(~F.col("handle").isin(*RESERVED_HANDLES))
        .withColumn("html", sanitize_html(F.col(html)))
        .withColumn(
            "description",
            F.coalesce(text(F.col("seo.description")), text(F.col(summary)), blank_to_null(html_to_text(F.col("html"), 200))),
        )
        .withColumn("seo_title", text(F.col("seo.title")))
    )


def article_list(articles: DataFrame) -> DataFrame:
    """Newest first, ``-2`` duplicates left out."""
    return articles.where(~F.col("handle").rlike("-2$")).orderBy(F.desc_nulls_last("published_at"), "handle")
