"""Source audit: data-quality rules, inventories, duplicates, catalog reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.money import money
from cartloom.functions.text import clean_text
from cartloom.operators.archive import check_status, measures
from cartloom.operators.catalog import resolve_price
from cartloom.operators.exceptions import union_all

SHORTCODE = r"\[(\w[\w-]*)"
CONSENT_KEY = r"(?i)consent|newsletter|marketing|subscribe|optin|opt_in"
TRACKING_KEY = r"(?i)track|carrier|shipment|consign|ship_"
OPEN_STATUSES = ["processing", "on-hold", "pending"]


def duplicate_values(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, n`` of values used more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_members(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Members of every duplicated value, one row each with the value's count.

    Rows, not a list per value: a value may have any number of members. The join's build side has
    one row per duplicated value, so a hot value is split on the streamed side.
    """
    return df.join(duplicate_values(df, keys), list(keys)).select(*keys, "n", member)


def issues(df: DataFrame, entity: str, id_: Column, rules: Sequence[tuple[str, str, Column, str | Column, str]]) -> DataFrame:
    """Audit rows ``severity, entity, id, field, problem, owner`` in one pass over ``df``."""
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    when,
                    F.struct(
                        F.lit(severity).alias("severity"),
                        F.lit(entity).alias("entity"),
                        id_.cast("string").alias("id"),
                        F.lit(field).alias("field"),
                        (F.lit(problem) if isinstance(problem, str) else problem).alias("problem"),
                        F.lit(owner).alias("owner"),
                    ),
                )
                for severity, field, when, problem, owner in rules
            ]
        )
    )
    return df.select(F.explode(hits).alias("i")).select("i.*")


def _empty(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def sku_usage(products: DataFrame, variations: DataFrame) -> DataFrame:
    """``sku, n, in_variations`` over products and variations together."""
    skus = products.select("sku", F.lit(0).alias("v")).unionByName(variations.select("sku", F.lit(1).alias("v")))
    return (
        skus.where(~_empty(F.col("sku")))
        .groupBy("sku")
        .agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("in_variations"))
    )


def data_quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All audit findings over products, variations, orders, customers, content and media."""
    products, variations = tables["products"], tables["variations"]
    heads = tables["media_head"].select(F.col("url").alias("_url"), F.col("status").alias("_http")).dropDuplicates(["_url"])
    children = variations.groupBy(F.col("parent_id").alias("id")).agg(F.count(F.lit(1)).alias("children"))
    skus = sku_usage(products, variations)
    p = products.join(children, "id", "left").withColumn("children", F.coalesce("children", F.lit(0)))
    none = F.col("children") == 0
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    attributes = F.coalesce(F.size("attributes"), F.lit(0))
    redirect_info = F.exists(
        F.coalesce("meta_data", F.array().cast(products.schema["meta_data"].dataType)),
        lambda m: (m["key"] == "_yoast_post_redirect_info") & (F.coalesce(m["value"], F.lit("")) != ""),
    )
    product_rows = issues(p, "product", F.col("id"), [
        ("high", "variations", (F.col("type") == "variable") & none, "variable product with no variations", "agency"),
        ("high", "sku", (F.col("type") == "simple") & _empty(F.col("sku")), "simple product missing SKU", "agency"),
        ("high", "images", F.coalesce(F.size("images"), F.lit(0)) <= 0, "no product images", "agency"),
        ("medium", "description", _empty(F.col("description")), "empty description", "agency"),
        ("low", "weight", _empty(F.col("weight")) & none, "no weight", "agency"),
        ("info", "status", F.col("status") != "publish", text("status=", F.col("status"), "; confirm migrate or exclude"), "client"),
        ("high", "type", ~F.col("type").isin("simple", "variable"), text("type=", F.col("type"), "; no direct equivalent"), "client"),
        ("info", "redirect", redirect_info, "redirect info present; include in the redirect map", "agency"),
        ("high", "attributes", attributes > 3, text(attributes, " attributes; the target allows 3 options"), "agency"),
        ("high", "variations", F.col("children") > 100, text(F.col("children"), " variations; over the limit of 100"), "agency"),
    ])
    images = products.select("id", F.explode("images").alias("i")).join(heads, F.col("i.src") == F.col("_url"), "left")
    image_rows = issues(images, "product", F.col("id"), [
        ("low", "image", _empty(F.col("i.alt")), text("image ", F.col("i.id"), ": missing alt text"), "agency"),
        ("high", "image", F.col("_http") != 200, text("image ", F.col("i.id"), ": HEAD returned ", F.col("_http")), "agency"),
    ])
    v = variations.join(skus.where(F.col("n") > 1).select("sku", F.col("n").alias("_n")), "sku", "left")
    variation_rows = issues(v, "variation", F.col("id"), [
        ("high", "sku", _empty(F.col("sku")), text("variation missing SKU (parent ", F.col("parent_id"), ")"), "agency"),
        ("high", "sku", F.col("_n").isNotNull(), text("duplicate SKU ", F.col("sku"), " used ", F.col("_n"), " times"), "agency"),
        ("high", "regular_price", _empty(F.col("regular_price")), text("variation has no regular price (parent ", F.col("parent_id"), ")"), "agency"),
        ("medium", "stock_quantity", F.col("manage_stock") & (F.col("stock_quantity") < 0), text("negative stock ", F.col("stock_quantity")), "agency"),
        ("low", "weight", _empty(F.col("weight")), "no weight", "agency"),
    ])
    # a SKU shared by products alone is named once; one that a variation uses was named there
    shared = issues(skus.where((F.col("n") > 1) & (F.col("in_variations") == 0)), "product", F.col("sku"), [
        ("high", "sku", F.lit(True), text("duplicate SKU across products used ", F.col("n"), " times"), "agency"),
    ])
    order_rows = issues(tables["orders"], "order", F.col("id"), [
        ("high", "status", F.col("status").isin(*OPEN_STATUSES), text("open order status=", F.col("status"), " at snapshot"), "client"),
    ])
    emails = tables["customers"].select(F.lower("email").alias("_email")).where(~_empty(F.col("_email")))
    customer_rows = issues(duplicate_values(emails, ["_email"]), "customer", F.lit("redacted"), [
        ("medium", "email", F.lit(True), text("duplicate customer email (", F.col("n"), " accounts)"), "client"),
    ])

    def content(name: str, kind: str) -> DataFrame:
        rules = [
            ("info", "status", F.col("status") != "publish", text("status=", F.col("status"), "; confirm migrate or exclude"), "client"),
            ("medium", "slug", F.coalesce("slug", F.lit("")).rlike("-2$"), text("looks like a duplicate page ('", F.col("slug"), "')"), "client"),
        ]
        if kind == "post":
            rules.append(("medium", "content", _empty(F.col("content.raw")), "empty post body", "agency"))
        return issues(tables[name], kind, F.col("id"), rules)

    media = tables["media"].join(heads, F.col("source_url") == F.col("_url"), "left")
    media_rows = issues(media, "media", F.col("id"), [
        ("high", "source_url", F.col("_http") != 200, text("HEAD returned ", F.col("_http")), "agency"),
    ])
    return union_all([
        product_rows, image_rows, variation_rows, shared, order_rows, customer_rows,
        content("pages", "page"), content("posts", "post"), media_rows,
    ])


def report_order(report: DataFrame) -> DataFrame:
    rank = F.array_position(F.array(*[F.lit(s) for s in ("high", "medium", "low", "info")]), F.col("severity"))
    return report.orderBy(rank, "entity", "id", "field", "problem")


def word_count(html: Column) -> Column:
    text = F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), r"(?U)\s+", " "))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def shortcode_counts(html: Column) -> Column:
    """``namexcount`` of each shortcode in order of first use."""
    names = F.regexp_extract_all(html, F.lit(SHORTCODE), F.lit(1))
    distinct = F.array_distinct(names)
    return F.array_join(
        F.transform(
            distinct, lambda d: F.concat(d, F.lit("x"), F.size(F.filter(names, lambda n: n == d)).cast("string"))
        ),
        ";",
    )


def content_inventory(docs: DataFrame, html: Column, base: str, keep: Sequence[str]) -> DataFrame:
    """Per document: words, images, shortcodes, internal links, page-builder flag."""
    links = F.regexp_extract_all(html, F.lit('href="([^"]+)"'), F.lit(1))
    internal = F.filter(links, lambda h: h.startswith(base) | h.startswith("/"))
    return docs.select(
        *keep,
        word_count(html).alias("words"),
        F.size(F.regexp_extract_all(html, F.lit('<img[^>]+src="([^"]+)"'), F.lit(1))).alias("embedded_images"),
        shortcode_counts(html).alias("shortcodes"),
        F.size(internal).alias("internal_links"),
        html.contains("elementor").alias("page_builder"),
    )


def url_inventory(sitemap: DataFrame, products: DataFrame, content: DataFrame) -> DataFrame:
    """Every known URL with its proposed destination.

    Product and content URLs are left out only where the sitemap lists them; the two may repeat each
    other. ``content``: ``kind, link, status, modified``.
    """
    kind = F.regexp_extract("sitemap", r"^(.*?)(-sitemap.*)?$", 1)
    listed = sitemap.select(
        F.col("loc").alias("url"), F.concat(F.lit("sitemap:"), "sitemap").alias("source"), kind.alias("type"),
        F.lit("publish").alias("status"), "lastmod",
    )
    seen = listed.select("url").distinct()
    shop = products.where(~_empty(F.col("permalink"))).select(
        F.col("permalink").alias("url"), F.lit("shop:product").alias("source"), F.lit("product").alias("type"), "status",
        F.col("date_modified").alias("lastmod"),
    )
    pages = content.where(~_empty(F.col("link"))).select(
        F.col("link").alias("url"), F.concat(F.lit("content:"), "kind").alias("source"), F.col("kind").alias("type"), "status",
        F.col("modified").alias("lastmod"),
    )
    rest = shop.unionByName(pages).join(seen, "url", "left_anti")
    slug = F.regexp_extract(F.regexp_replace("url", "/+$", ""), "([^/]*)$", 1)
    from_sitemap = F.col("source").startswith("sitemap:product") & (F.col("type") == "product")
    path = F.regexp_extract("url", r"^(?:[a-zA-Z]+://[^/?#]*)?([^?#]*)", 1)
    return listed.unionByName(rest.select(*listed.columns)).select(
        "*",
        F.when(from_sitemap, F.concat(F.lit("/products/"), slug))
        .when(F.col("type") == "product_cat", "by approved collection mapping")
        .when(F.col("type").isin("page", "post"), path)
        .otherwise("")
        .alias("proposed_destination"),
        F.when(from_sitemap | (F.col("type") == "product_cat"), "301")
        .when(F.col("type").isin("page", "post"), "keep path (200) or 301")
        .otherwise("")
        .alias("redirect_type"),
    )


def meta_key_counts(df: DataFrame, meta: Column | str, owner: str) -> DataFrame:
    """``owner, key, n`` over an array of meta entries."""
    return (
        df.select(F.explode(meta).alias("m"))
        .groupBy(F.col("m.key").alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(owner).alias("owner"), "key", "n")
    )


def plugin_fingerprints(plugins: DataFrame, key_counts: DataFrame, patterns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Active plugins with the data they left: ``name, version, evidence, holds_data``.

    ``patterns``: ``(plugin pattern, owner, key pattern)`` rules. Both sides list the rules they
    match as they are read, so the regex matching needs no theta join: keys are summed per rule,
    then joined to plugins on the rule.
    """

    def rules(of: Column, pattern: int, owner: Column | None = None) -> Column:
        return F.array_compact(
            F.array(
                *[
                    F.when(of.rlike(("(?i)" if pattern == 0 else "") + rule[pattern]) & (F.lit(True) if owner is None else owner == rule[1]), F.lit(i))
                    for i, rule in enumerate(patterns)
                ]
            )
        )

    hits = (
        key_counts.select(F.explode(rules(F.col("key"), 2, F.col("owner"))).alias("rule"), "n")
        .groupBy("rule")
        .agg(F.sum("n").alias("n"))
    )
    named = plugins.where(F.col("status") == "active").withColumn("name", F.regexp_replace("name", "&amp;", "&"))
    return (
        named.select("name", "version", F.explode_outer(rules(F.col("name"), 0)).alias("rule"))
        .join(hits, "rule", "left")
        .groupBy("name", "version")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("evidence"))
        .withColumn("holds_data", F.col("evidence") > 0)
    )


def media_usage_by_product(products: DataFrame, variations: DataFrame) -> DataFrame:
    """``media_id, product_id`` pairs, distinct."""
    own = products.select(F.col("id").alias("product_id"), F.explode("images.id").alias("media_id"))
    child = variations.where(F.col("image.id").isNotNull()).select(F.col("parent_id").alias("product_id"), F.col("image.id").alias("media_id"))
    return own.unionByName(child).distinct()


def media_inventory(media: DataFrame, media_head: DataFrame, usage: DataFrame) -> DataFrame:
    """Attachment rows with dimensions, alt, HEAD status and how many products use each; which ones
    is :func:`media_usage_by_product`."""
    used = usage.groupBy(F.col("media_id").alias("id")).agg(F.count(F.lit(1)).alias("used_by_products"))
    heads = media_head.select(F.col("url").alias("source_url"), F.col("status").alias("http_status")).dropDuplicates(["source_url"])
    return (
        media.join(heads, "source_url", "left")
        .join(used, "id", "left")
        .select(
            F.col("id").alias("attachment_id"),
            F.col("media_details.file").alias("file"),
            "source_url",
            F.col("mime_type").alias("mime"),
            F.col("media_details.width").alias("width"),
            F.col("media_details.height").alias("height"),
            F.col("media_details.filesize").alias("filesize"),
            F.trim(F.coalesce("alt_text", F.lit(""))).alias("alt"),
            F.col("title.raw").alias("title"),
            F.col("post").alias("attached_to"),
            "date",
            "http_status",
            F.coalesce("used_by_products", F.lit(0).cast("bigint")).alias("used_by_products"),
        )
    )


def profile(df: DataFrame, entity: str, values: Mapping[str, Column], tallies: Mapping[str, Column] | None = None) -> DataFrame:
    """Tall ``entity, metric, value, n``: named aggregates in one pass, then one tally per axis."""
    names = list(values)
    wide = df.agg(*[c.cast("bigint").alias(n) for n, c in values.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    parts = [wide.selectExpr(f"stack({len(names)}, {pairs}) AS (metric, n)").select(F.lit(entity).alias("entity"), "metric", F.lit("").alias("value"), "n")]
    for axis, column in (tallies or {}).items():
        parts.append(
            df.groupBy(F.coalesce(column, F.lit("")).alias("value"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(entity).alias("entity"), F.lit(axis).alias("metric"), "value", "n")
        )
    return union_all(parts)


def source_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Entity profile of a snapshot."""
    one, count_if = F.lit(1), lambda c: F.count(F.when(c, 1))
    products, variations, orders, customers = (tables[t] for t in ("products", "variations", "orders", "customers"))
    per_parent = variations.groupBy("parent_id").agg(F.count(one).alias("n"))
    guest = F.coalesce("customer_id", F.lit(0)) == 0
    email = F.lower("billing.email")
    no_address = _empty(F.col("billing.address_1")) & _empty(F.col("shipping.address_1"))
    lines = orders.select(F.explode("line_items").alias("l")).select(F.col("l.meta_data").alias("meta"))
    keys = union_all([
        meta_key_counts(products, "meta_data", "product"),
        meta_key_counts(orders, "meta_data", "order"),
        meta_key_counts(lines, "meta", "line_item"),
        meta_key_counts(customers, "meta_data", "customer"),
    ])
    special = F.when(F.col("key").rlike(CONSENT_KEY), "consent_like_key").when(F.col("key").rlike(TRACKING_KEY), "tracking_like_key").otherwise("meta_key")
    return union_all([
        profile(products, "products", {
            "total": F.count(one),
            "on_sale": count_if(F.col("on_sale")),
            "featured": count_if(F.col("featured")),
            "without_images": count_if(F.coalesce(F.size("images"), F.lit(0)) <= 0),
            "max_attributes": F.max(F.coalesce(F.size("attributes"), F.lit(0))),
        }, {"by_status": F.col("status"), "by_type": F.col("type"), "tax_status": F.col("tax_status"), "stock_status": F.col("stock_status")}),
        profile(variations, "variations", {
            "total": F.count(one),
            "with_sku": count_if(~_empty(F.col("sku"))),
            "with_image": count_if(F.col("image.id").isNotNull()),
            "manage_stock": count_if(F.col("manage_stock")),
            "total_stock_units": F.coalesce(F.sum(F.when(F.col("manage_stock"), F.col("stock_quantity"))), F.lit(0)),
            "with_sale_price": count_if(~_empty(F.col("sale_price"))),
            "with_weight": count_if(~_empty(F.col("weight"))),
        }, {"stock_status": F.col("stock_status"), "backorders": F.col("backorders")}),
        profile(sku_usage(products, variations), "skus", {"unique_skus": F.count(one), "duplicate_skus": count_if(F.col("n") > 1)}),
        profile(per_parent, "variations", {"max_per_product": F.coalesce(F.max("n"), F.lit(0))}),
        profile(orders, "orders", {
            "total": F.count(one),
            "lowest_id": F.min("id"),
            "highest_id": F.max("id"),
            "open_at_snapshot": count_if(F.col("status").isin(*OPEN_STATUSES)),
            "guest_orders": count_if(guest),
            "unique_guest_emails": F.countDistinct(F.when(guest & ~_empty(email), email)),
            "orders_with_refunds": count_if(F.coalesce(F.size("refunds"), F.lit(0)) > 0),
            "line_items": F.coalesce(F.sum(F.coalesce(F.size("line_items"), F.lit(0))), F.lit(0)),
        }, {"by_status": F.col("status"), "currencies": F.col("currency"), "payment_methods": F.col("payment_method_title")}),
        profile(customers, "customers", {
            "total": F.count(one), "without_address": count_if(no_address), "paying": count_if(F.col("is_paying_customer")),
        }, {"by_role": F.col("role")}),
        profile(duplicate_values(customers.select(F.lower("email").alias("e")).where(~_empty(F.col("e"))), ["e"]), "customers", {"duplicate_emails": F.count(one)}),
        keys.select("owner", special.alias("metric"), F.col("key").alias("value"), "n").withColumnRenamed("owner", "entity"),
    ])


def reconcile_fields(source: DataFrame, parents: DataFrame, loaded: DataFrame, currency: str) -> DataFrame:
    """Mismatch counts of price, compare-at, tax and currency: expected from the source against the
    loaded variants. A default variant is checked against its product."""
    cols = ["regular_price", "sale_price", "price", "tax_status"]
    rows = source.select("id", "parent_id", *cols)
    own = parents.select("id", F.col("id").alias("parent_id"), *cols).join(
        source.select(F.col("parent_id").alias("id")).distinct(), "id", "left_anti"
    )
    up = parents.select(F.col("id").alias("parent_id"), F.struct(*cols).alias("parent"))
    expected = rows.unionByName(own).join(up, "parent_id", "left")
    cost = resolve_price(F.struct(*[F.col(c) for c in cols]), F.col("parent"))
    taxable = F.coalesce(F.nullif("tax_status", F.lit("")), F.nullif("parent.tax_status", F.lit("")), F.lit("taxable")) == "taxable"
    want = expected.select(F.col("id").alias("_id"), cost.alias("cost"), taxable.alias("want_taxable"))
    joined = loaded.join(want, F.col("source.source_id") == F.col("_id"), "left")
    differs = lambda a, b: F.count(F.when(~a.eqNullSafe(b), 1))
    return joined.agg(
        differs(F.col("price"), F.col("cost.price")).alias("price"),
        differs(F.col("compare_at_price"), F.col("cost.compare_at")).alias("compare_at"),
        differs(F.col("taxable"), F.col("want_taxable")).alias("taxable"),
        differs(F.col("currency"), F.lit(currency)).alias("currency"),
    )


def variant_count_differences(variations: DataFrame, products: DataFrame, loaded: DataFrame) -> DataFrame:
    """Products whose source and loaded variant counts differ."""
    source = variations.groupBy(F.col("parent_id").alias("source_id")).agg(F.count(F.lit(1)).alias("source"))
    target = loaded.groupBy(F.col("product_handle").alias("handle")).agg(F.count(F.lit(1)).alias("target"))
    handles = products.select(F.col("source.source_id").alias("source_id"), "handle")
    return (
        source.join(handles, "source_id", "left")
        .join(target, "handle", "left")
        .withColumn("target", F.coalesce("target", F.lit(0)))
        .where(F.col("source") != F.col("target"))
        .select("handle", "source_id", "source", "target")
    )


def held_reason_counts(records: DataFrame) -> DataFrame:
    """Held rows per reason code, the part before ``:``."""
    return (
        records.where("held")
        .select(F.explode("held_reasons").alias("r"))
        .groupBy(F.substring_index("r", ":", 1).alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def redact(df: DataFrame, type_: str = "record_type", id_: str = "record_id", ref: str = "record_ref") -> DataFrame:
    """Customer references as ``customer:<id>``; nothing else about a customer leaves."""
    safe = F.concat(F.lit("customer:"), F.coalesce(F.col(id_), F.lit("")))
    return df.withColumn(ref, F.when(F.col(type_) == "customer", safe).otherwise(F.col(ref)))


def reconcile_catalog(
    tables: Mapping[str, DataFrame], records: Mapping[str, DataFrame], ledger: DataFrame, exceptions: DataFrame,
    residual: DataFrame, currency: str, strict: bool = False,
) -> DataFrame:
    """Source, records and ledger compared check by check: ``check, source, target, held, status,
    explanation``. One conditional aggregate per table; the comparison runs on those few totals.

    ``residual``: :func:`media.residual_references` of the loaded bodies.
    """
    one = F.lit(1)
    count_if = lambda c: F.when(c, 1).otherwise(0)
    p, v = tables["products"], tables["variations"]
    rp, rv, rm = records["products"], records["variants"], records["media"]
    free = ~F.col("held")
    every = F.lit("all")

    def side(df: DataFrame, **values: Column) -> DataFrame:
        return measures(df, every, values)

    parents = v.select(F.col("parent_id").alias("id")).distinct()
    simple = p.join(parents, "id", "left_anti")
    blank = _empty(F.col("sku"))
    quantity = F.coalesce("stock_quantity", F.lit(0))
    imaged = rm.where(free).select(F.col("product_handle").alias("handle")).distinct()
    pictured = rp.join(imaged, "handle", "left_anti").where(free)
    regular = money(F.col("regular_price")).isNull()
    c = tables["customers"]
    addressed = ~(_empty(F.col("shipping.address_1")) & _empty(F.col("billing.address_1")))
    shopper = F.col("role") == "customer"
    members = records["collection_membership"]
    held_codes = (
        exceptions.where(F.col("record_type") == "variant")
        .join(rv.where("held").select(F.col("sku").alias("record_ref")).distinct(), "record_ref", "left_semi")
    )
    ledger_is = lambda r: count_if(F.col("resource") == r)
    staged = F.coalesce(F.get_json_object("payload", "$.quantity").try_cast("int"), F.lit(0))
    pages, posts = records["pages"], records["articles"]
    files = records.get("body_media")
    source = union_all([
        side(p, product_count_total=one, product_count_source_publish=count_if(F.col("status") == "publish"),
             product_count_source_draft=count_if(F.col("status") == "draft"),
             image_count_total=F.coalesce(F.size(F.array_distinct("images.src")), F.lit(0)),
             products_without_image=count_if(F.coalesce(F.size("images"), F.lit(0)) <= 0),
             product_seo_description_populated=count_if(~_empty(F.col("yoast_head_json.description")))),
        side(v.select("id").unionByName(simple.select("id")), variant_count_total=one),
        side(rp.where(free), product_count_target_draft_status=one, products_in_at_least_one_collection=one, product_seo_title_populated=one),
        side(v, sku_null_count_source=count_if(blank), inventory_staged_quantity_total=quantity,
             variants_without_regular_price_in_source=count_if(regular)),
        side(rv, sku_generated_count=count_if(F.col("sku_generated"))),
        side(rv.where(free), sku_unique_count=one, inventory_item_count=one),
        side(rm, media_unreachable=count_if(~F.coalesce("reachable", F.lit(True)))),
        side(rm.where(free), media_checksums_present=one),
        side(records["collections"], collection_count=one),
        side(members, collection_membership_rows=one),
        side(tables["pages"], page_count=one), side(tables["posts"], article_count=one),
        side(c.where(shopper), customer_count=one, customer_with_default_address=count_if(addressed)),
        side(records["customers"], customer_unique_emails=one),
        side(tables["coupons"], discount_count=one, discount_active_count=count_if(F.col("status") == "publish"),
             discount_free_shipping_count=count_if(F.col("free_shipping"))),
    ] + ([side(files, body_image_unique_files=one, body_image_references_rewritten=F.col("reference_count")),
          side(files.where(free), body_image_files_uploaded=one)] if files is not None else []))
    mismatches = reconcile_fields(v, p, rv.where(free), currency).selectExpr(
        "stack(4, 'variant_price_field_mismatches', price, 'variant_compare_at_field_mismatches', compare_at,"
        " 'variant_taxable_field_mismatches', taxable, 'variant_currency_field_mismatches', currency) AS (metric, value)"
    ).select(F.lit("all").alias("scope"), "metric", F.col("value").cast("decimal(38,4)").alias("value"))
    target = union_all([
        side(rp.where(free), product_count_total=one, product_count_source_publish=count_if(F.col("source_status") == "publish"),
             product_count_source_draft=count_if(F.col("source_status") == "draft"),
             product_count_target_draft_status=count_if(F.col("status") == "DRAFT"),
             product_seo_title_populated=count_if(F.col("seo.title") != ""),
             product_seo_description_populated=count_if(F.col("seo.description") != "")),
        side(rv.where(free), variant_count_total=one, sku_generated_count=count_if(F.col("sku_generated"))),
        side(rv.where(free).select("sku").distinct(), sku_unique_count=one),
        side(variant_count_differences(v, rp, rv.where(free)), variant_count_products_with_a_difference=one),
        side(rm.where(free), image_count_total=one, media_checksums_present=count_if(F.col("url_checksum").isNotNull())),
        side(pictured, products_without_image=one),
        side(ledger, collection_count=ledger_is("Collection"), collection_membership_rows=ledger_is("CollectionMembership"),
             inventory_item_count=ledger_is("InventoryItem"), body_image_files_uploaded=ledger_is("File"),
             inventory_staged_quantity_total=F.when(F.col("resource") == "InventoryItem", staged).otherwise(0)),
        side(members.select("product_handle").distinct(), products_in_at_least_one_collection=one),
        side(held_codes, variants_without_regular_price_in_source=count_if(F.col("code") == "variant_missing_price"),
             held_variants_missing_option_value=count_if(F.col("code") == "variant_missing_option_value")),
        side(rv, held_variants_total=count_if(F.col("held"))),
        side(pages.where(free), page_count=one), side(posts, article_count=one),
        side(records["customers"], customer_count=one, customer_with_default_address=count_if(F.col("default_address").isNotNull()),
             customer_marketing_consent_true=count_if(F.col("email_consent") != "NOT_SUBSCRIBED")),
        side(records["customers"].select("email").distinct(), customer_unique_emails=one),
        side(records["discounts"], discount_count=one, discount_active_count=count_if(F.col("status") == "ACTIVE"),
             discount_free_shipping_count=count_if(F.col("free_shipping")),
             discount_with_unsupported_rules=count_if(F.size("unsupported_rules") > 0)),
        side(residual, image_references_left_in_loaded_bodies=F.col("residual")),
        mismatches.select("scope", "metric", "value"),
    ] + ([side(files.where(free), body_image_unique_files=one, body_image_references_rewritten=F.col("reference_count")),
          side(files, body_image_unresolvable_sources=count_if(~F.col("resolved")))] if files is not None else []))
    held = union_all([
        side(rp, product_count_total=count_if(F.col("held"))), side(rv, variant_count_total=count_if(F.col("held"))),
    ] + ([side(files, body_image_unique_files=count_if(F.col("held")))] if files is not None else []))
    notes = F.create_map(*[F.lit(x) for pair in CHECK_NOTES.items() for x in pair])
    zero = F.lit(0).cast("decimal(38,4)")
    return (
        source.withColumnRenamed("value", "source")
        .join(target.withColumnRenamed("value", "target"), ["metric", "scope"], "full")
        .join(held.withColumnRenamed("value", "held"), ["metric", "scope"], "left")
        .select(
            F.col("metric").alias("check"),
            *[F.coalesce(c, zero).cast("bigint").alias(c) for c in ("source", "target", "held")],
            F.try_element_at(notes, F.col("metric")).alias("explanation"),
        )
        .withColumn("status", check_status(F.col("source"), F.col("target"), F.col("explanation"), strict))
    )


#: why a difference of a check is expected
CHECK_NOTES = {
    "product_count_total": "held for a client decision",
    "product_count_source_publish": "products held for a client decision are not loaded",
    "product_count_source_draft": "products held for a client decision are not loaded",
    "product_count_target_draft_status": "loads keep every product in draft",
    "variant_count_total": "held variants are excluded",
    "variant_count_products_with_a_difference": "each is a held product or variant with a named exception",
    "sku_null_count_source": "blank SKUs are filled from product and variation id",
    "sku_unique_count": "duplicate source SKUs are reported, never rewritten",
    "sku_generated_count": "generated SKUs on held variants are not loaded",
    "image_count_total": "variation images are added; held products contribute none",
    "products_without_image": "counted on the loaded subset",
    "media_unreachable": "unreachable media is excluded only when held",
    "variants_without_regular_price_in_source": "the rest inherit the product price",
    "held_variants_missing_option_value": "open variations have no equivalent on the target",
    "held_variants_total": "missing price, missing option value, or held product",
    "inventory_staged_quantity_total": "held variants keep their stock out of the total",
    "page_count": "functional pages are storefront routes",
    "body_image_unique_files": "unreachable files are not uploaded",
    "body_image_unresolvable_sources": "no original in the media export; uploaded by URL",
    "body_image_references_rewritten": "unreachable sources stay as they are",
    "image_references_left_in_loaded_bodies": "each is a named body_image exception",
    "product_seo_description_populated": "the Open Graph description is the fallback",
    "customer_count": "failed records are in the exception register",
    "discount_with_unsupported_rules": "advanced rules cannot be expressed on the target",
}
