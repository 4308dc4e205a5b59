"""Analytics items, carts and discounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.functions.money import js_round2, money
from cartloom.functions.options import string_array
from cartloom.functions.text import blank_to_null, clean_text

PLACEHOLDER_VARIANT = "Default Title"
EVENT_NAMES = ["page_view", "view_item", "add_to_cart", "begin_checkout"]
ITEM = (
    "struct<item_id:string,item_name:string,item_variant:string,item_brand:string,"
    "item_category:string,price:decimal(18,2),quantity:int,currency:string>"
)


def short_id(gid: Column) -> Column:
    """Last path part of a global id; any other id unchanged."""
    return F.coalesce(blank_to_null(F.regexp_extract(gid, "([^/]*)$", 1)), gid)


def amount(c: Column) -> Column:
    """Decimal of an amount string, junk as zero."""
    return F.coalesce(c.try_cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))


def item_quantity(c: Column) -> Column:
    return F.greatest(F.lit(1), F.coalesce(c.try_cast("int"), F.lit(1)))


def ga_item(
    product: Column, variant: Column, quantity: Column
) -> Column:
    """Item of a product page. ``product``: handle, title, vendor, price, currency, category;
    ``variant``: id, sku, title, price, currency, null while none is chosen."""
    label = blank_to_null(F.trim(variant["title"]))
    return F.struct(
        F.coalesce(blank_to_null(F.trim(variant["sku"])), short_id(variant["id"]), product["handle"]).alias(
            "item_id"
        ),
        product["title"].alias("item_name"),
        F.when(label != PLACEHOLDER_VARIANT, label).alias("item_variant"),
        blank_to_null(product["vendor"]).alias("item_brand"),
        blank_to_null(product["category"]).alias("item_category"),
        js_round2(F.coalesce(variant["price"], product["price"])).alias("price"),
        item_quantity(quantity).alias("quantity"),
        F.coalesce(variant["currency"], product["currency"]).alias("currency"),
    ).cast(ITEM)


def cart_line_item(line: Column, quantity: Column | None = None) -> Column:
    """Item of a cart line. ``line``: id, sku, handle, title, price, currency, quantity,
    options ``array<struct<name,value>>``."""
    shown = F.filter(
        line["options"], lambda o: (o["value"] != "") & (o["value"] != PLACEHOLDER_VARIANT)
    )
    return F.struct(
        F.coalesce(blank_to_null(F.trim(line["sku"])), short_id(line["id"]), line["handle"]).alias("item_id"),
        line["title"].alias("item_name"),
        blank_to_null(F.array_join(F.transform(shown, lambda o: o["value"]), " / ")).alias("item_variant"),
        F.lit(None).cast("string").alias("item_brand"),
        F.lit(None).cast("string").alias("item_category"),
        js_round2(amount(line["price"])).alias("price"),
        item_quantity(line["quantity"] if quantity is None else quantity).alias("quantity"),
        line["currency"].alias("currency"),
    ).cast(ITEM)


def items_value(items: Column) -> Column:
    zero = F.lit(0).cast("decimal(28,2)")
    total = F.aggregate(
        items, zero, lambda a, i: (a + i["price"] * i["quantity"].cast("decimal(10,0)")).cast("decimal(28,2)")
    )
    return total.cast("decimal(18,2)")


def ecommerce_params(
    items: Column, coupon: Column, fallback_currency: str, costed: Column | None = None
) -> Column:
    """``struct<currency, value, coupon>``; a costed total replaces the sum of the items."""
    value = items_value(items) if costed is None else F.coalesce(js_round2(costed), items_value(items))
    first = F.get(items, F.lit(0))["currency"]
    return F.struct(
        F.coalesce(first, F.lit(fallback_currency)).alias("currency"),
        value.alias("value"),
        blank_to_null(F.trim(coupon)).alias("coupon"),
    )


def cart_totals(cart: Column, fallback_currency: str) -> Column:
    """Subtotal, discount and payable total of a cart.

    ``cart``: subtotal, total, currency, allocations ``array<string>``. Not yet costed (total
    zero or absent) falls back to subtotal less discount, never below zero.
    """
    zero = F.lit(0).cast("decimal(28,4)")
    allocations = F.coalesce(cart["allocations"], string_array([]))
    given = F.aggregate(allocations, zero, lambda a, x: (a + amount(x)).cast("decimal(28,4)"))
    discount = F.greatest(given, zero)
    subtotal, total = amount(cart["subtotal"]), amount(cart["total"])
    return F.struct(
        F.coalesce(cart["currency"], F.lit(fallback_currency)).alias("currency"),
        subtotal.cast("decimal(18,2)").alias("subtotal"),
        discount.cast("decimal(18,2)").alias("discount"),
        F.when(total != 0, total).otherwise(F.greatest(zero, subtotal - discount)).cast("decimal(18,2)").alias("total"),
        (discount > 0).alias("has_discount"),
    )


def recost_lines(lines: Column, changes: Column) -> Column:
    """Cart lines after quantity edits (``map<line id, quantity>``).

    An edited line is costed at its unit price, an untouched one keeps its total, a line at zero
    is gone. Lines: ``array<struct<id, unit_price, total, quantity>>``.
    """

    def edited(line: Column) -> Column:
        change = F.try_element_at(changes, line["id"])
        wanted = F.when(change.isNotNull(), F.greatest(F.lit(0), change))  # greatest skips nulls
        cost = F.when(wanted.isNull(), amount(line["total"])).otherwise(
            amount(line["unit_price"]) * wanted.cast("decimal(10,0)")
        )
        return F.struct(
            line["id"].alias("id"),
            line["unit_price"].alias("unit_price"),
            cost.cast("decimal(28,4)").alias("total"),
            F.coalesce(wanted, line["quantity"]).alias("quantity"),
        )

    return F.filter(F.transform(lines, edited), lambda line: line["quantity"] > 0)


def recost_cart(lines: Column, changes: Column, taxes: Column, discount: Column) -> Column:
    """``struct<lines, quantity, subtotal, total>`` after edits; the last discount is kept."""
    left = recost_lines(lines, changes)
    zero = F.lit(0).cast("decimal(28,4)")
    subtotal = F.aggregate(left, zero, lambda a, line: (a + line["total"]).cast("decimal(28,4)"))
    return F.struct(
        left.alias("lines"),
        F.aggregate(left, F.lit(0), lambda a, line: a + line["quantity"]).alias("quantity"),
        subtotal.cast("decimal(18,2)").alias("subtotal"),
        F.greatest(zero, subtotal + amount(taxes) - amount(discount)).cast("decimal(18,2)").alias("total"),
    )


def applied_codes(codes: Column) -> Column:
    """Accepted codes of ``array<struct<code, applicable>>``."""
    return F.transform(F.filter(codes, lambda d: d["applicable"]), lambda d: d["code"])


def normalize_discount_code(c: Column) -> Column:
    """What the input submits: no white space, at most 64 characters (the accepted length)."""
    return F.substring(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", ""), 1, 64)


def address(block: Column, default_country: str) -> Column:
    """Typed address, null when the block has no first line."""

    def text(field: str) -> Column:
        return F.trim(F.coalesce(block[field], F.lit("")))

    return F.when(
        text("address_1") != "",
        F.struct(
            text("first_name").alias("first_name"),
            text("last_name").alias("last_name"),
            blank_to_null(text("company")).alias("company"),
            text("address_1").alias("address1"),
            blank_to_null(text("address_2")).alias("address2"),
            text("city").alias("city"),
            blank_to_null(text("state")).alias("province_code"),
            text("postcode").alias("zip"),
            F.coalesce(blank_to_null(text("country")), F.lit(default_country)).alias("country_code"),
            blank_to_null(text("phone")).alias("phone"),
        ),
    )


def default_address(shipping: Column, billing: Column, default_country: str) -> Column:
    return F.coalesce(address(shipping, default_country), address(billing, default_country))


def coupon_to_discount(row: Column, advanced_prefixes: Sequence[str], currency: str) -> Column:
    """Discount record of a coupon struct."""
    kind = row["discount_type"]
    each, cart = kind == "fixed_product", kind == "fixed_cart"
    empty = F.coalesce(row["meta_data"], F.array().cast("array<struct<id:bigint,key:string,value:string,display_key:string,display_value:string>>"))
    advanced = F.filter(
        empty,
        lambda m: m["key"].rlike("^(" + "|".join(advanced_prefixes) + ")")
        & ~F.coalesce(m["value"], F.lit("")).isin("", "[]", "{}", "no"),
    )
    minimum = money(row["minimum_amount"])
    combines = ~F.coalesce(row["individual_use"], F.lit(False))
    return F.struct(
        clean_text(row["code"], entities=False).alias("code"),
        F.when(kind == "percent", "percentage").when(each | cart, "fixed_amount").otherwise("unsupported").alias("type"),
        money(row["amount"]).alias("amount"),
        F.when(each | cart, F.lit(currency)).alias("currency"),
        F.when(each | cart, each).alias("applies_on_each_item"),
        F.coalesce(row["free_shipping"], F.lit(False)).alias("free_shipping"),
        row["date_created_gmt"].alias("starts_at"),
        row["date_expires_gmt"].alias("ends_at"),
        F.when(row["status"] == "publish", "ACTIVE").otherwise("DISABLED").alias("status"),
        row["usage_limit"].alias("usage_limit"),
        (F.coalesce(row["usage_limit_per_user"], F.lit(0)) != 0).alias("applies_once_per_customer"),
        F.when(minimum > 0, minimum).alias("minimum_subtotal"),
        F.coalesce(row["product_ids"], F.array().cast("array<bigint>")).alias("entitled_product_ids"),
        F.coalesce(row["product_categories"], F.array().cast("array<bigint>")).alias("entitled_category_ids"),
        F.coalesce(row["excluded_product_ids"], F.array().cast("array<bigint>")).alias("excluded_product_ids"),
        combines.alias("combines"),
        F.array_sort(F.array_distinct(F.transform(advanced, lambda m: m["key"]))).alias("unsupported_rules"),
    )


def discount_eligibility(d: Column, loaded: Column) -> Column:
    """Why a discount cannot be written yet, or ``ok``; with its fraction for percentage ones.

    ``loaded``: the entitled product ids that exist on the target.
    """
    missing = F.array_except(d["entitled_product_ids"], loaded)
    amount_set = F.coalesce(d["amount"], F.lit(0)) > 0
    verdict = (
        F.when(d["free_shipping"] & amount_set, "mixed_free_shipping")
        .when(d["free_shipping"], "free_shipping")
        .when(d["type"] == "unsupported", "unsupported_type")
        .when(F.size(d["entitled_category_ids"]) > 0, "category_restricted")
        .when(F.size(d["excluded_product_ids"]) > 0, "excluded_products")
        .when(F.size(missing) > 0, "unloaded_product")
        .otherwise("ok")
    )
    return F.struct(
        verdict.alias("verdict"),
        F.when(d["type"] == "percentage", F.bround(d["amount"] / 100, 4).cast("decimal(10,4)")).alias("fraction"),
        missing.alias("missing_products"),
    )
