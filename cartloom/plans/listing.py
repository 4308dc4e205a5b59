"""Listing queries over parts: catalog view, facets, pages, search, related, rails."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.money import cents
from cartloom.functions.options import normalize_colour
from cartloom.functions.seo import product_json_ld
from cartloom.operators import audit, listing
from cartloom.operators.search_index import search_index, write_index
from cartloom.plans.registry import query, table
from cartloom.session import checkpoint_dir

WORD = r"^(\S+)"

VARIANTS_SQL = """
    SELECT l_partkey, l_suppkey, min(CAST(l_extendedprice AS DECIMAL(18,2))) AS price,
      max(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_discount > 0.05) AS compare_at, bool_or(l_linestatus = 'O') AS available
    FROM lineitem GROUP BY 1, 2
"""


def variants(spark: SparkSession, folder: str) -> DataFrame:
    price = cents(F.col("l_extendedprice"))
    return table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.min(price).alias("price"),
        F.max(F.when(F.col("l_discount") > 0.05, price)).alias("compare_at_price"),
        F.bool_or(F.col("l_linestatus") == "O").alias("available"),
    ).select(
        F.col("l_partkey").alias("product_handle"), F.col("l_suppkey").alias("variant_id"), "price", "compare_at_price", "available",
        F.lit("AUD").alias("currency"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    option = lambda name, c: F.struct(F.lit(name).alias("name"), F.array(c).alias("values"))
    surface = F.when(F.col("p_size") > 40, "surface:beach").when(F.col("p_size") < 10, "surface:indoor")
    gender = F.when(F.col("p_brand").endswith("1"), "gender:Men").otherwise("gender:Unisex")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("handle"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("vendor"),
        F.col("p_type").alias("product_type"),
        F.array_compact(F.array(F.concat(F.lit("type:"), F.lower("p_type")), surface, gender)).alias("tags"),
        F.array(
            option("Colour", normalize_colour(F.regexp_extract("p_name", WORD, 1))), option("Size", F.col("p_size").cast("string"))
        ).alias("options"),
        F.concat(F.lit("/img/"), F.col("p_partkey").cast("string")).alias("image"),
        F.col("p_partkey").alias("created_at"),
    )


def view(spark: SparkSession, folder: str) -> DataFrame:
    return listing.catalog_view(products(spark, folder), variants(spark, folder))


COLOUR_SQL = "upper(left(regexp_extract(p_name, '^(\\S+)', 1), 1)) || substr(regexp_extract(p_name, '^(\\S+)', 1), 2)"
VIEW_SQL = f"""
    WITH v AS ({VARIANTS_SQL}),
    s AS (SELECT l_partkey, min(price) AS price, max(price) AS max_price, max(compare_at) AS compare_at, bool_or(available) AS in_stock,
      count(*) AS n, min(l_suppkey) AS variant FROM v GROUP BY 1),
    view AS (SELECT p_partkey AS handle, p_name AS title, p_brand AS vendor, CAST(price AS DOUBLE) AS price, CAST(max_price AS DOUBLE) AS max_price,
      CAST(CASE WHEN compare_at > price THEN compare_at END AS DOUBLE) AS compare_at_price, coalesce(compare_at > price, false) AS on_sale, in_stock,
      lower(p_type) AS category_id, p_type AS category_label,
      CASE WHEN p_size > 40 THEN 'beach' WHEN p_size < 10 THEN 'indoor' END AS surface,
      CASE WHEN p_brand LIKE '%1' THEN 'Men' ELSE 'Unisex' END AS gender, {COLOUR_SQL} AS colours, CAST(p_size AS VARCHAR) AS sizes,
      CASE WHEN n = 1 THEN variant END AS variant_id
      FROM part JOIN s ON l_partkey = p_partkey)
"""


def flat(df: DataFrame) -> DataFrame:
    return df.select(
        "handle", "title", "vendor", *[F.col(c).cast("double").alias(c) for c in ("price", "max_price", "compare_at_price")],
        "on_sale", "in_stock", "category_id", "category_label", "surface",
        *[F.array_join(c, ",").alias(c) for c in ("gender", "colours", "sizes")], "variant_id",
    )


@query("catalog_view", VIEW_SQL + "SELECT * FROM view")
def catalog_view(spark: SparkSession, folder: str) -> DataFrame:
    return flat(view(spark, folder))


@query(
    "facets",
    VIEW_SQL
    + """
    SELECT 'gender' AS facet, gender AS value, count(*) AS n FROM view GROUP BY 2
    UNION ALL SELECT 'surface', surface, count(*) FROM view WHERE surface IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'colour', colours, count(*) FROM view GROUP BY 2
    UNION ALL SELECT 'size', sizes, count(*) FROM view GROUP BY 2
    UNION ALL SELECT 'price', 'min', CAST(floor(min(price)) AS BIGINT) FROM view
    UNION ALL SELECT 'price', 'max', CAST(ceil(max(price)) AS BIGINT) FROM view
    """,
)
def facets(spark: SparkSession, folder: str) -> DataFrame:
    return listing.build_facets(view(spark, folder))


@query(
    "taxonomy",
    VIEW_SQL
    + """
    , c AS (SELECT 'category' AS section, category_id AS id, count(*) AS n FROM view GROUP BY 2
      UNION ALL SELECT 'surface', surface, count(*) FROM view WHERE surface IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'gender', gender, count(*) FROM view GROUP BY 2 UNION ALL SELECT 'colour', colours, count(*) FROM view GROUP BY 2
      UNION ALL SELECT 'size', sizes, count(*) FROM view GROUP BY 2
      UNION ALL SELECT 'availability', 'in_stock', count(*) FROM view WHERE in_stock HAVING count(*) > 0
      UNION ALL SELECT 'availability', 'on_sale', count(*) FROM view WHERE on_sale HAVING count(*) > 0)
    SELECT section, id, id AS label, n FROM c
    UNION ALL SELECT 'category', k, l, 0 FROM (VALUES ('economy', 'Economy'), ('unused', 'Unused')) t(k, l) WHERE k NOT IN (SELECT id FROM c WHERE section = 'category')
    """,
)
def taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    return listing.build_taxonomy(view(spark, folder), {"economy": "economy", "unused": "Unused"})


PAGE = listing.Filters(in_stock=True, gender=["Unisex"], surface=["beach", "indoor"], colour=["Red", "Blue", "Green"], max_price=5000)


@query(
    "listing_page",
    VIEW_SQL
    + """
    SELECT * FROM view WHERE in_stock AND gender = 'Unisex' AND surface IS NOT NULL AND colours IN ('Red', 'Blue', 'Green') AND price <= 5000
    ORDER BY price, handle LIMIT 24
    """,
)
def listing_page(spark: SparkSession, folder: str) -> DataFrame:
    """First page of a filtered listing by price; the page size is the feature."""
    return flat(listing.listing_sort(listing.listing_filter(view(spark, folder), PAGE), "price-asc").limit(24))


@query(
    "listing_filtered",
    VIEW_SQL
    + "SELECT handle FROM view WHERE in_stock AND gender = 'Unisex' AND surface IS NOT NULL AND colours IN ('Red', 'Blue', 'Green') AND price <= 5000",
)
def listing_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return listing.listing_filter(view(spark, folder), PAGE).select("handle")


@query("listing_scope", VIEW_SQL + "SELECT handle, price FROM view WHERE on_sale")
def listing_scope(spark: SparkSession, folder: str) -> DataFrame:
    return flat(listing.resolve_listing(view(spark, folder), "sale")).select("handle", "price")


@query(
    "search",
    VIEW_SQL
    + """
    SELECT handle, title FROM view
    WHERE lower(title || ' ' || category_id || ' ' || coalesce(surface, '') || '  ' || colours || ' ' || gender) LIKE '%red%'
      AND lower(title || ' ' || category_id || ' ' || coalesce(surface, '') || '  ' || colours || ' ' || gender) LIKE '%unisex%'
    """,
)
def search(spark: SparkSession, folder: str) -> DataFrame:
    return listing.search_catalog(view(spark, folder), "  Red unisex ").select("handle", "title")


SEARCHES = ["  Red unisex ", "promo men ea", "beach", "unisex nosuchword", " "]


@query(
    "search_indexed",
    VIEW_SQL
    + """,
    h AS (SELECT handle, lower(title || ' ' || category_id || ' ' || coalesce(surface, '') || '  ' || colours || ' ' || gender) AS hay FROM view)
    SELECT '  Red unisex ' AS query, handle FROM h WHERE hay LIKE '%red%' AND hay LIKE '%unisex%'
    UNION ALL SELECT 'promo men ea', handle FROM h WHERE hay LIKE '%promo%' AND hay LIKE '%men%' AND hay LIKE '%ea%'
    UNION ALL SELECT 'beach', handle FROM h WHERE hay LIKE '%beach%'
    """,
)
def search_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """Several searches over one index of all products, built once."""
    at = f"{checkpoint_dir(spark).rstrip('/')}/search-{uuid.uuid4().hex}"
    write_index(view(spark, folder), "handle", listing.haystack(), at)
    found = [search_index(spark, at, q).select(F.lit(q).alias("query"), F.col("id").alias("handle")) for q in SEARCHES]
    return reduce(DataFrame.unionByName, found)


@query(
    "related",
    """
    WITH r AS (SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS n FROM part),
    l AS (SELECT p_type, p_partkey AS related FROM r WHERE n <= 5)
    SELECT * FROM (
      SELECT p_partkey, related, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY related) AS INT) AS rank
      FROM r JOIN l USING (p_type) WHERE related <> p_partkey) WHERE rank <= 4
    """,
)
def related(spark: SparkSession, folder: str) -> DataFrame:
    return listing.related_products(table(spark, folder, "part"), "p_type", "p_partkey", 4)


@query(
    "rails",
    VIEW_SQL
    + """
    SELECT 'new' AS rail, CAST(row_number() OVER (ORDER BY handle DESC) AS INT) AS rank, handle FROM view QUALIFY rank <= 8
    UNION ALL SELECT 'popular', CAST(row_number() OVER (ORDER BY in_stock DESC, handle) AS INT) AS rank, handle FROM view QUALIFY rank <= 8
    """,
)
def rails(spark: SparkSession, folder: str) -> DataFrame:
    return listing.home_rails(view(spark, folder))


@query(
    "category_tiles",
    VIEW_SQL
    + "SELECT category_id, count(*) AS n, arg_min('/img/' || handle, CASE WHEN in_stock THEN 0 ELSE 1 END * 1000000000 + handle) AS image FROM view GROUP BY 1",
)
def category_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return listing.category_tiles(view(spark, folder))


@query(
    "product_detail",
    VIEW_SQL
    + """
    SELECT handle, CASE WHEN price > 3000 THEN 'court' ELSE surface END AS surface, gender, '/shop/' || category_id AS href, category_label AS label, 1 AS options FROM view
    """,
)
def product_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Detail rows: a metafield overrides the surface tag of dear products; the placeholder option is
    left out."""
    base = view(spark, folder)
    placeholder = F.struct(F.lit("Title").alias("name"), F.array(F.lit("Default Title")).alias("values"))
    colour = F.struct(F.lit("Colour").alias("name"), F.col("colours").alias("values"))
    details = base.select(
        "handle",
        F.array(placeholder, colour).alias("options"),
        F.when(F.col("price") > 3000, F.create_map(F.lit("surface"), F.array(F.lit("court")))).alias("fields"),
        F.array().cast("array<string>").alias("images"),
        F.lit(None).cast("string").alias("collection_handle"),
        F.lit(None).cast("string").alias("collection_title"),
    )
    return listing.product_detail_view(base, details).select(
        "handle", "surface", F.array_join("gender", ",").alias("gender"), "breadcrumb.href", "breadcrumb.label", F.size("options").alias("options")
    )


@query(
    "sole_purchasable",
    f"WITH v AS ({VARIANTS_SQL}) SELECT l_partkey AS product, min(l_suppkey) AS variant_id FROM v WHERE price > 90000 GROUP BY 1 HAVING count(*) = 1",
)
def sole_purchasable(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with exactly one dear variant."""
    rows = variants(spark, folder).select(
        F.col("product_handle").alias("product"), "variant_id", (F.col("price") > 90000).alias("available"),
        F.array(F.struct(F.lit("Supplier").alias("name"), F.col("variant_id").cast("string").alias("value"))).alias("options"),
    )
    return listing.sole_purchasable(rows).select("product", "variant_id")


@query(
    "value_available",
    f"""
    WITH v AS ({VARIANTS_SQL}) SELECT l_partkey AS product, 'Band' AS name, CASE WHEN price > 20000 THEN 'high' ELSE 'low' END AS value, bool_or(available) AS available FROM v GROUP BY 1, 3
    """,
)
def value_available(spark: SparkSession, folder: str) -> DataFrame:
    band = F.when(F.col("price") > 20000, "high").otherwise("low")
    rows = variants(spark, folder).select(
        F.col("product_handle").alias("product"), "available", F.array(F.struct(F.lit("Band").alias("name"), band.alias("value"))).alias("options")
    )
    return listing.value_available(rows)


@query(
    "variant_for_selection",
    f"""
    WITH v AS ({VARIANTS_SQL}), b AS (SELECT *, CASE WHEN price > 20000 THEN 'high' ELSE 'low' END AS band FROM v)
    SELECT p_partkey AS selection_id, min(l_suppkey) AS variant_id FROM part JOIN b ON l_partkey = p_partkey AND band = CASE WHEN p_size > 25 THEN 'high' ELSE 'low' END GROUP BY 1
    """,
)
def variant_for_selection(spark: SparkSession, folder: str) -> DataFrame:
    """First variant in the price band each part's size selects."""
    band = F.when(F.col("price") > 20000, "high").otherwise("low")
    rows = variants(spark, folder).select(
        F.col("product_handle").alias("product"), F.col("variant_id").alias("position"), "variant_id",
        F.array(F.struct(F.lit("Band").alias("name"), band.alias("value"))).alias("options"),
    )
    wanted = F.when(F.col("p_size") > 25, "high").otherwise("low")
    selections = table(spark, folder, "part").select(
        F.col("p_partkey").alias("selection_id"), F.col("p_partkey").alias("product"),
        F.array(F.lit("Band")).alias("option_names"), F.create_map(F.lit("Band"), wanted).alias("selection"),
    )
    return listing.variant_for_selection(selections, rows)


@query("product_json_ld")
def product_structured_data(spark: SparkSession, folder: str) -> DataFrame:
    rows = view(spark, folder)
    offers = listing.variant_summary(variants(spark, folder)).select(F.col("product_handle").alias("handle"), "variant_count")
    shaped = rows.join(offers, "handle").select(
        "handle", "variant_count", F.concat(F.lit("/product/"), F.col("handle").cast("string")).alias("path"), F.col("title").alias("name"),
        F.lit(None).cast("string").alias("description"), F.array("image").alias("images"), F.lit(None).cast("string").alias("sku"),
        F.col("vendor").alias("brand"), "currency", F.col("price").alias("low"), F.col("max_price").alias("high"), F.col("in_stock").alias("available"),
        F.col("variant_id").cast("string").alias("offer_sku"),
    )
    return shaped.select("handle", product_json_ld("https://shop.example.com", F.col("variant_count")).alias("json_ld"))


@query(
    "sitemap_entries",
    """
    WITH e AS (
      SELECT 0 AS kind, p AS path, f AS frequency, r AS priority FROM (VALUES ('', 'daily', 1.0), ('/shop', 'daily', 0.9), ('/shop/new-arrivals', 'daily', 0.7), ('/shop/sale', 'daily', 0.7), ('/blog', 'weekly', 0.6)) t(p, f, r)
      UNION ALL SELECT DISTINCT 1, '/shop/' || lower(p_type), 'daily', 0.8 FROM part
      UNION ALL SELECT 2, '/product/' || p_partkey, 'weekly', 0.7 FROM part
      UNION ALL SELECT 3, '/blog/' || doc_id, 'monthly', 0.5 FROM documents
      UNION ALL SELECT 4, '/page-' || page_id, 'monthly', 0.4 FROM pages WHERE page_id <> 2)
    SELECT 'https://shop.example.com' || path AS url, frequency, CAST(priority AS DOUBLE) AS priority FROM e
    """,
)
def sitemap_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Storefront sitemap over parts, documents and pages; the ``-2`` page handle is a duplicate."""
    none = F.lit(None).cast("string").alias("updated")
    part = table(spark, folder, "part")
    entries = audit.sitemap_entries(
        part.select(F.lower("p_type").alias("handle"), none).distinct(),
        part.select(F.col("p_partkey").cast("string").alias("handle"), none),
        table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("handle"), none),
        table(spark, folder, "pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("handle"), none),
        "https://shop.example.com",
    )
    return entries.select("url", "frequency", "priority")
