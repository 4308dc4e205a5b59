"""Shop snapshot entities read out of the order tables: parts are products, the suppliers of a part
its variations, customers shoppers. Every column of the result comes from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.money import cents
from cartloom.plans.registry import table
from cartloom.sources.schemas import DDL, schema

HOST = "https://shop.example.com"


def fit(df: DataFrame, entity: str) -> DataFrame:
    """Snapshot shape: given columns cast, the rest null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema(entity).fields
        ]
    )


def image_url(key: Column, suffix: str = "") -> Column:
    return F.concat(F.lit(f"{HOST}/wp-content/uploads/part-"), key.cast("string"), F.lit(f"{suffix}.jpg"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    word = F.regexp_extract("p_name", r"^(\S+)", 1)
    named = lambda c: F.struct(F.lit(1).cast("bigint").alias("id"), c.alias("name"), F.lower(c).alias("slug"))

    def attribute(at: int, name: str, values):
        return F.struct(
            F.lit(at).cast("bigint").alias("id"), F.lit(name).alias("name"), F.lit(name.lower()).alias("slug"),
            F.lit(at).alias("position"), F.lit(True).alias("visible"), F.lit(True).alias("variation"), values.alias("options"),
        )

    attributes = F.array(
        attribute(0, "Color", F.array(word, F.lit("Gray"))),
        attribute(1, "Size", F.array(F.col("p_size").cast("string"), F.lit("36 - 41"))),
    )
    images = F.array(
        F.struct(
            F.col("p_partkey").alias("id"), image_url(F.col("p_partkey")).alias("src"),
            F.when(F.col("p_size") > 10, F.col("p_name")).alias("alt"), F.col("p_name").alias("name"),
        )
    )
    return fit(
        part.select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.when(F.col("p_type") == "PROMO", "draft").otherwise("publish").alias("status"),
            F.lit("variable").alias("type"),
            cents(F.col("p_retailprice")).cast("string").alias("regular_price"),
            F.concat(F.lit("<p>"), "p_name", F.lit("</p>")).alias("description"),
            attributes.alias("attributes"),
            F.array(named(F.col("p_type"))).alias("categories"),
            F.array(named(F.col("p_brand"))).alias("tags"),
            F.array(named(F.col("p_brand"))).alias("brands"),
            images.alias("images"),
            F.when(F.col("p_size") > 25, (F.col("p_size") / 10).cast("decimal(6,1)").cast("string")).alias("weight"),
            F.lit("taxable").alias("tax_status"),
        ),
        "products",
    )


def variations(spark: SparkSession, folder: str) -> DataFrame:
    """One per part and supplier, priced from its order lines."""
    lines = table(spark, folder, "lineitem")
    price = cents(F.col("l_extendedprice"))
    pairs = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.min(F.when(F.col("l_discount") >= 0.08, price)).alias("sale"),
        F.max(F.when(F.col("l_returnflag") == "A", price)).alias("regular"),
        F.min(F.when(F.col("l_returnflag") == "N", price)).alias("current"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(-F.col("l_quantity"))).cast("int").alias("stock"),
        F.max("l_linenumber").alias("size"),
    )
    colour = F.when(F.col("stock") > 0, "gray").otherwise("Navy Blue")

    def given(name: str, value):
        return F.struct(
            F.lit(1).cast("bigint").alias("id"), F.lit(name).alias("name"), F.lit(name.lower()).alias("slug"), value.alias("option")
        )

    own = F.col("sale").isNotNull()
    return fit(
        pairs.select(
            (F.col("l_partkey") * 100_000 + F.col("l_suppkey")).alias("id"),
            F.col("l_partkey").alias("parent_id"),
            F.lit("publish").alias("status"),
            F.when(F.col("regular").isNotNull(), F.concat_ws("-", F.lit("S"), "l_suppkey", "size")).otherwise("").alias("sku"),
            F.col("sale").cast("string").alias("sale_price"),
            F.col("regular").cast("string").alias("regular_price"),
            F.col("current").cast("string").alias("price"),
            F.lit(True).alias("manage_stock"),
            F.col("stock").alias("stock_quantity"),
            F.array(given("Color", colour), given("Size", F.col("size").cast("string"))).alias("attributes"),
            F.when(
                own,
                F.struct(
                    F.col("l_partkey").alias("id"), image_url(F.concat_ws("-", "l_partkey", "size")).alias("src"), F.lit(None).cast("string").alias("alt")
                ),
            ).alias("image"),
            F.col("size").alias("menu_order"),
        ),
        "variations",
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """The e-mail is shared per nation and segment, so duplicates occur; a negative balance has no
    address."""
    c = table(spark, folder, "customer")
    email = F.concat("c_mktsegment", F.lit("."), F.col("c_nationkey").cast("string"), F.lit("@Example.com"))
    fields = [f.split(":")[0].strip() for f in DDL["customers"].split("billing struct<")[1].split(">")[0].split(",")]
    block = F.struct(
        *[
            (F.when(F.col("c_acctbal") >= 0, F.col("c_name")) if f == "address_1" else F.lit(None)).cast("string").alias(f)
            for f in fields
        ]
    )
    return fit(
        c.select(
            F.col("c_custkey").alias("id"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "administrator").otherwise("customer").alias("role"),
            F.when(F.col("c_nationkey") == 0, "").otherwise(email).alias("email"),
            F.col("c_name").alias("first_name"),
            block.alias("billing"),
        ),
        "customers",
    )


def media(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return fit(
        part.select(
            F.col("p_partkey").alias("id"), image_url(F.col("p_partkey")).alias("source_url"),
            F.when(F.col("p_size") < 5, F.col("p_name")).alias("alt_text"), F.lit("image/jpeg").alias("mime_type"),
        ),
        "media",
    )


def media_head(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return fit(
        part.select(
            image_url(F.col("p_partkey")).alias("url"), F.when(F.col("p_size") == 50, 404).otherwise(200).alias("status")
        ),
        "media_head",
    )


def bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with an image block for the part of their number: a thumbnail, its candidates, a link."""
    pages = table(spark, folder, "pages")
    key = F.col("page_id")
    block = F.concat(
        F.lit('<p><img class="x" src="'), image_url(key, "-300x200"), F.lit('" srcset="'), image_url(key, "-300x200"), F.lit(" 300w, "),
        image_url(key), F.lit(' 1024w" sizes="100vw"><a href="'), image_url(F.concat(key.cast("string"), F.lit("-x"))), F.lit('">file</a></p>'),
    )
    return pages.select("page_id", F.concat("page_id", F.lit("-page")).alias("handle"), F.concat("html", block).alias("body_html"))
