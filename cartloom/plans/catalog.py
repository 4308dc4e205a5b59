"""Catalog queries: handles, duplicates, prices, options, types, exceptions, records, media."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions import options as opt
from cartloom.functions.money import cents
from cartloom.functions.text import slugify
from cartloom.operators import catalog, media, quality
from cartloom.operators.exceptions import Rule, exceptions_by_code, exceptions_from_rules, union_all
from cartloom.plans import bindings as b
from cartloom.plans.registry import query, table
from cartloom.session import stored

SLUG_SQL = "trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-')"


@query(
    "unique_handles",
    f"""
    WITH s AS (SELECT p_partkey, {SLUG_SQL} AS slug FROM part),
    f AS (SELECT *, min(p_partkey) OVER (PARTITION BY slug) AS first FROM s)
    SELECT p_partkey, CASE WHEN first = p_partkey THEN slug ELSE slug || '-' || p_partkey END AS handle,
      CASE WHEN first <> p_partkey THEN first END AS taken_by FROM f
    """,
)
def unique_handles(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", slugify(F.col("p_name")).alias("slug"))
    return catalog.unique_handles(part, "slug", "p_partkey").select("p_partkey", "handle", "taken_by")


@query(
    "duplicate_names",
    """
    SELECT p_name, count(*) OVER (PARTITION BY p_name) AS n, p_partkey FROM part QUALIFY n > 1
    """,
)
def duplicate_names(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_members(table(spark, folder, "part"), ["p_name"], "p_partkey")


VARIATION_SQL = """
    SELECT l_partkey, l_suppkey,
      min(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_discount >= 0.08) AS sale,
      max(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = 'A') AS regular,
      min(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = 'N') AS current,
      CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE -l_quantity END) AS INT) AS stock,
      max(l_linenumber) AS size
    FROM lineitem GROUP BY l_partkey, l_suppkey
"""


@query(
    "price_fallback",
    f"""
    WITH v AS ({VARIATION_SQL})
    SELECT l_partkey * 100000 + l_suppkey AS id, CAST(coalesce(sale, regular, current, CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
      CAST(CASE WHEN sale <> regular THEN regular END AS DOUBLE) AS compare_at
    FROM v JOIN part ON p_partkey = l_partkey
    """,
)
def price_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Variation price: sale, regular, current, then the part's own."""
    parents = b.products(spark, folder).select(F.col("id").alias("parent_id"), F.struct("regular_price", "price").alias("parent"))
    rows = b.variations(spark, folder).join(parents, "parent_id")
    v = F.struct("sale_price", "regular_price", "price")
    cost = catalog.resolve_price(v, F.col("parent"))
    return rows.select("id", cost.alias("c")).select(
        "id", F.col("c.price").cast("double").alias("price"), F.col("c.compare_at").cast("double").alias("compare_at")
    )


COLOUR_SQL = """CASE lower(regexp_extract(p_name, '^(\\S+)', 1)) WHEN 'gray' THEN 'Grey' WHEN 'navy blue' THEN 'Navy'
      ELSE upper(left(regexp_extract(p_name, '^(\\S+)', 1), 1)) || lower(substr(regexp_extract(p_name, '^(\\S+)', 1), 2)) END"""


@query(
    "option_values",
    f"""
    WITH v AS (SELECT p_brand, {COLOUR_SQL} AS colour, p_size FROM part),
    c AS (SELECT p_brand, string_agg(colour, ',' ORDER BY colour) AS colours FROM (SELECT DISTINCT p_brand, colour FROM v) GROUP BY 1),
    s AS (SELECT p_brand, string_agg(CAST(p_size AS VARCHAR), ',' ORDER BY p_size) AS sizes FROM (SELECT DISTINCT p_brand, p_size FROM v) GROUP BY 1)
    SELECT p_brand, colours, sizes FROM c JOIN s USING (p_brand)
    """,
)
def option_values(spark: SparkSession, folder: str) -> DataFrame:
    """Colour and size values a brand uses, normalised and in order."""
    part = table(spark, folder, "part")
    values = part.groupBy("p_brand").agg(
        F.collect_set(opt.normalize_colour(F.regexp_extract("p_name", r"^(\S+)", 1))).alias("colours"),
        F.collect_set(opt.normalize_size(F.col("p_size").cast("string"))).alias("sizes"),
    )
    return values.select(
        "p_brand",
        F.array_join(opt.sort_option_values(F.lit("Colour"), F.col("colours")), ",").alias("colours"),
        F.array_join(opt.sort_option_values(F.lit("Sock Size"), F.col("sizes")), ",").alias("sizes"),
    )


@query(
    "product_type_rules",
    """
    SELECT CASE WHEN p_type = 'PROMO' THEN 'jerseys' WHEN p_type = 'SMALL' THEN 'tops' WHEN p_name LIKE '%ring%' THEN 'accessories'
        WHEN p_name LIKE '%bolt%' THEN 'shorts-pants' ELSE 'accessories' END AS type,
      CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'category' WHEN p_name LIKE '%ring%' OR p_name LIKE '%bolt%' THEN 'name-inferred' ELSE 'fallback' END AS how,
      CASE WHEN p_name LIKE '%blue%' THEN 'teamwear' WHEN p_name LIKE '%red%' THEN 'red-club' ELSE '' END AS clubs, count(*) AS n
    FROM part GROUP BY 1, 2, 3
    """,
)
def product_type_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Parts by derived type and club under a rule set made for the part names."""
    categories = F.array("p_type", F.when(F.col("p_name").contains("blue"), F.lit("Teamwear")).otherwise(F.lit("none")))
    typed = opt.product_type(
        categories, F.col("p_name"), {"promo": "jerseys", "small": "tops"}, ["jerseys", "tops"],
        [("ring", "accessories"), ("bolt", "shorts-pants")],
    )
    clubs = opt.clubs(categories, F.col("p_name"), [("red-club", "Red", "red club", "red")], ("teamwear", "Teamwear", "teamwear"))
    return (
        table(spark, folder, "part")
        .select(typed.alias("t"), F.array_join(clubs, ",").alias("clubs"))
        .groupBy("t.type", "t.how", "clubs")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def register(spark: SparkSession, folder: str) -> DataFrame:
    part, customer, orders = (table(spark, folder, t) for t in ("part", "customer", "orders"))
    return union_all(
        [
            exceptions_from_rules(
                part,
                [
                    Rule(F.col("p_size") > 45, "oversize_part", "high", "size above 45"),
                    Rule(F.col("p_retailprice") < 950, "low_price", "medium", F.concat(F.lit("price "), cents(F.col("p_retailprice")).cast("string"))),
                    Rule(F.col("p_name").contains("red"), "name_red", "low", "name mentions red", retry="resolved"),
                ],
                "part", F.col("p_partkey"), F.col("p_name"),
            ),
            exceptions_from_rules(
                customer, [Rule(F.col("c_acctbal") < 0, "negative_balance", "critical", "account in debt")],
                "customer", F.col("c_custkey"), F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")),
            ),
            exceptions_from_rules(
                orders, [Rule((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400_000), "large_pending", "high", "large pending order")],
                "order", F.col("o_orderkey"), F.col("o_orderkey").cast("string"),
            ),
        ]
    )


@query(
    "exception_register",
    """
    SELECT 'critical' AS severity, 'negative_balance' AS code, 'customer' AS record_type, CAST(c_custkey AS VARCHAR) AS record_id, 'account in debt' AS message FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'high', 'oversize_part', 'part', CAST(p_partkey AS VARCHAR), 'size above 45' FROM part WHERE p_size > 45
    UNION ALL SELECT 'medium', 'low_price', 'part', CAST(p_partkey AS VARCHAR), 'price ' || CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) FROM part WHERE p_retailprice < 950
    UNION ALL SELECT 'low', 'name_red', 'part', CAST(p_partkey AS VARCHAR), 'name mentions red' FROM part WHERE p_name LIKE '%red%'
    UNION ALL SELECT 'high', 'large_pending', 'order', CAST(o_orderkey AS VARCHAR), 'large pending order' FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000
    """,
)
def exception_register(spark: SparkSession, folder: str) -> DataFrame:
    return register(spark, folder).select("severity", "code", "record_type", "record_id", "message")


@query(
    "exceptions_by_code",
    """
    SELECT 'negative_balance' AS code, count(*) AS n FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0
    UNION ALL SELECT 'oversize_part', count(*) FROM part WHERE p_size > 45 HAVING count(*) > 0
    UNION ALL SELECT 'low_price', count(*) FROM part WHERE p_retailprice < 950 HAVING count(*) > 0
    UNION ALL SELECT 'name_red', count(*) FROM part WHERE p_name LIKE '%red%' HAVING count(*) > 0
    UNION ALL SELECT 'large_pending', count(*) FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000 HAVING count(*) > 0
    """,
)
def by_code(spark: SparkSession, folder: str) -> DataFrame:
    return exceptions_by_code(register(spark, folder))


def variant_frames(spark: SparkSession, folder: str, keep: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Variant records and exceptions of all parts; ``keep`` where a query reads both."""
    products, variations = b.products(spark, folder), b.variations(spark, folder)
    classified = catalog.classified_products(products)
    options, _ = catalog.build_options(products, variations)
    return catalog.build_variants(products, classified, variations, options, "tables", keep=keep)


@query(
    "variant_records",
    f"""
    WITH v AS ({VARIATION_SQL}),
    w AS (SELECT *, CASE WHEN stock > 0 THEN 'Grey' ELSE 'Navy' END AS colour, CAST(size AS VARCHAR) AS s,
      row_number() OVER (PARTITION BY l_partkey ORDER BY size, l_suppkey) AS position FROM v),
    k AS (SELECT l_partkey, count(DISTINCT colour) AS colours, count(DISTINCT s) AS sizes FROM w GROUP BY 1),
    j AS (SELECT w.*, colours, sizes, CASE WHEN colours > 1 THEN colour ELSE '' END || '/' || CASE WHEN sizes > 1 THEN s ELSE '' END AS combo FROM w JOIN k USING (l_partkey)),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, combo ORDER BY position) AS turn FROM j)
    SELECT l_partkey AS product_id, l_partkey * 100000 + l_suppkey AS source_id, position,
      CASE WHEN regular IS NULL THEN 'SKU-' || l_partkey || '-' || (l_partkey * 100000 + l_suppkey) ELSE 'S-' || l_suppkey || '-' || size END AS sku,
      CAST(coalesce(sale, regular, current, CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
      greatest(stock, 0) AS inventory_quantity,
      CASE WHEN colours > 1 AND sizes > 1 THEN 'Colour=' || colour || ';Sock Size=' || s WHEN colours > 1 THEN 'Colour=' || colour
        WHEN sizes > 1 THEN 'Sock Size=' || s ELSE 'Title=Default Title' END AS option_values,
      turn > 1 AS held
    FROM r JOIN part ON p_partkey = l_partkey
    UNION ALL
    SELECT p_partkey, p_partkey, 1, 'SKU-' || p_partkey || '-' || p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE), NULL,
      CASE WHEN colour <> 'Grey' THEN '' ELSE 'Title=Default Title' END, true
    FROM (SELECT *, {COLOUR_SQL} AS colour FROM part) WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)
    """,
)
def variant_records(spark: SparkSession, folder: str) -> DataFrame:
    """Variant records of all parts: position, SKU, price, stock, options, duplicates held."""
    records, _ = variant_frames(spark, folder)
    shown = F.transform("option_values", lambda o: F.concat_ws("=", o["name"], o["value"]))
    return records.select(
        "product_id", "source.source_id", "position", "sku", F.col("price").cast("double"), "inventory_quantity",
        F.array_join(shown, ";").alias("option_values"), "held",
    )


@query("variant_exceptions")
def variant_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    records, raised = variant_frames(spark, folder, keep=stored)
    return exceptions_by_code(raised.unionByName(catalog.duplicate_sku_exceptions(records)))


@query(
    "colour_images",
    f"""
    WITH v AS ({VARIATION_SQL}),
    w AS (SELECT *, CASE WHEN stock > 0 THEN 'gray' ELSE 'Navy Blue' END AS colour,
      CASE WHEN sale IS NOT NULL THEN 'https://shop.example.com/wp-content/uploads/part-' || l_partkey || '-' || size || '.jpg' END AS own FROM v)
    SELECT l_partkey * 100000 + l_suppkey AS id,
      coalesce(own, first_value(own) OVER (PARTITION BY l_partkey, colour ORDER BY own IS NULL, size, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS src
    FROM w
    """,
)
def colour_images(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.propagate_colour_image(b.variations(spark, folder)).select("id", "src")


@query("media_records")
def media_records(spark: SparkSession, folder: str) -> DataFrame:
    """Image records of all parts and suppliers."""
    products = b.products(spark, folder)
    records, _ = catalog.build_media(
        products, catalog.classified_products(products), b.variations(spark, folder), b.media(spark, folder), b.media_head(spark, folder), "tables"
    )
    return records.select("product_id", "original_url", "alt", "position", "variant_sku", "variant_count", "reachable")


@query(
    "customer_records",
    """
    WITH s AS (SELECT c_custkey, c_acctbal, lower(c_mktsegment || '.' || c_nationkey || '@Example.com') AS email FROM customer
      WHERE c_mktsegment <> 'MACHINERY' AND c_nationkey <> 0)
    SELECT c_custkey AS source_id, email, c_acctbal >= 0 AS has_address FROM s
    QUALIFY row_number() OVER (PARTITION BY email ORDER BY c_custkey) = 1
    """,
)
def customer_records(spark: SparkSession, folder: str) -> DataFrame:
    records, _ = catalog.build_customers(b.customers(spark, folder), "tables")
    return records.select("source.source_id", "email", F.col("default_address").isNotNull().alias("has_address"))


@query(
    "customer_exceptions",
    """
    WITH s AS (SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment,
        row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) AS turn FROM customer WHERE c_mktsegment <> 'MACHINERY')
    SELECT 'customer_without_email' AS code, count(*) AS n FROM s WHERE c_nationkey = 0 HAVING count(*) > 0
    UNION ALL SELECT 'duplicate_customer_email', count(*) FROM s WHERE c_nationkey <> 0 AND turn > 1 HAVING count(*) > 0
    UNION ALL SELECT 'customer_without_address', count(*) FROM s WHERE c_nationkey <> 0 AND turn = 1 AND c_acctbal < 0 HAVING count(*) > 0
    """,
)
def customer_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    _, raised = catalog.build_customers(b.customers(spark, folder), "tables")
    return exceptions_by_code(raised)


def resolved_bodies(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs, files = b.bodies(spark, folder), b.media(spark, folder)
    hosts = media.upload_hosts(files, b.HOST)
    refs = media.body_references(docs, hosts, "shop.example.com", ["handle"])
    return docs, media.resolve_references(refs, files), hosts


@query(
    "body_media",
    """
    WITH u AS (
      SELECT 'https://shop.example.com/wp-content/uploads/part-' || page_id || '.jpg' AS source_url, page_id IN (SELECT p_partkey FROM part) AS resolved, 3 AS n FROM pages WHERE page_id IN (SELECT p_partkey FROM part)
      UNION ALL SELECT 'https://shop.example.com/wp-content/uploads/part-' || page_id || '-x.jpg', false, 1 FROM pages
      UNION ALL SELECT 'https://shop.example.com/wp-content/uploads/part-' || page_id || '-300x200.jpg', false, 2 FROM pages WHERE page_id NOT IN (SELECT p_partkey FROM part)
      UNION ALL SELECT 'https://shop.example.com/wp-content/uploads/part-' || page_id || '.jpg', false, 1 FROM pages WHERE page_id NOT IN (SELECT p_partkey FROM part))
    SELECT source_url, resolved, CAST(sum(n) AS BIGINT) AS reference_count FROM u GROUP BY 1, 2
    """,
)
def body_media(spark: SparkSession, folder: str) -> DataFrame:
    """Files that page bodies show, thumbnails resolved to originals."""
    _, resolved, _ = resolved_bodies(spark, folder)
    records, _ = media.build_body_media(resolved, b.media(spark, folder), b.media_head(spark, folder), "tables")
    return records.select("source_url", "resolved", "reference_count")


@query("rewritten_bodies")
def rewritten_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies with their images moved to new addresses; what is left is counted again."""
    docs, resolved, hosts = resolved_bodies(spark, folder)
    files = b.media(spark, folder).select(
        F.lit("File").alias("resource"), F.col("source_url").alias("key"), F.col("id"), F.lit("").alias("checksum"), F.lit("{}").alias("payload")
    )
    moved = media.rewrite_bodies(docs, resolved, media.target_urls(files, "https://cdn.example.net/files"), ["handle"])
    left = media.residual_references(moved, hosts, "shop.example.com", ["handle"])
    digests = moved.select("handle", "references", "rewritten", "left", F.md5("body_html").alias("body"))  # before the join: bodies stay out of it
    return digests.join(left, "handle", "left").select(
        "handle", "references", "rewritten", "left", F.coalesce("residual", F.lit(0)).alias("residual"), "body"
    )
