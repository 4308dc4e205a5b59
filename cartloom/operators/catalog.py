"""Catalog transform: products, options, variants, media, content, customers and discounts as typed
records plus an exception register."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.functions import options as opt
from cartloom.functions.commerce import coupon_to_discount, default_address
from cartloom.functions.money import kg_to_grams, money
from cartloom.functions.text import (
    blank_to_null,
    clean_text,
    clean_texts,
    generate_sku,
    meta_value,
    rendered,
    slugify,
)
from cartloom.operators.exceptions import AGENCY, Rule, exceptions_from_rules, union_all
from cartloom.operators.skew import MAX_GROUP_ROWS, numbered, numbered_ranges, ranged, with_first
from cartloom.rules import shop
from cartloom.session import checkpointed, spread

CURRENCY = "AUD"
COUNTRY = "AU"
SKU_PREFIX = "SKU"


def source_ref(id_: Column, kind: str, snapshot: str) -> Column:
    return F.struct(
        id_.cast("bigint").alias("source_id"), F.lit(kind).alias("source_type"), F.lit(snapshot).alias("snapshot")
    ).alias("source")


def own_price(v: Column) -> Column:
    """``struct<price, compare_at>`` of a variation by itself: sale, regular, current."""
    sale, regular = money(v["sale_price"]), money(v["regular_price"])
    return F.struct(
        F.coalesce(sale, regular, money(v["price"])).alias("price"), F.when(sale != regular, regular).alias("compare_at")
    )


def parent_price(parent: Column) -> Column:
    """Price of a variation that has none: the parent's regular, current."""
    return F.coalesce(money(parent["regular_price"]), money(parent["price"]))


def resolve_price(v: Column, parent: Column) -> Column:
    """``struct<price, compare_at>``: sale, regular, current, parent regular, parent price."""
    own = own_price(v)
    return F.struct(F.coalesce(own["price"], parent_price(parent)).alias("price"), own["compare_at"].alias("compare_at"))


def resolve_inventory(v: Column, parent: Column) -> Column:
    """``struct<managed, quantity, raw>``: managed if either is, unmanaged sold-out is 0, negative
    is staged as 0."""
    managed = F.coalesce(v["manage_stock"], F.lit(False)) | F.coalesce(parent["manage_stock"], F.lit(False))
    raw = F.coalesce(v["stock_quantity"], F.when(~managed & (v["stock_status"] == "outofstock"), 0))
    return F.struct(
        managed.alias("managed"),
        F.when(raw < 0, 0).otherwise(raw).alias("quantity"),
        v["stock_quantity"].alias("raw"),
    )


def unique_handles(df: DataFrame, slug: str, id_: str) -> DataFrame:
    """Add ``handle`` and ``taken_by``: the first id of a slug owns it, later ones get ``-<id>``.

    A suffixed handle counts as taken too: a later row whose own slug equals an earlier suffixed
    handle is suffixed as well. Such a row names its blocker by the trailing digits of its slug, so
    one join on the unique id finds it. Each round joins only the rows suffixed in the last one and
    the loop ends when no row changes, however many steps follow one another.
    """
    # ids and slugs only, kept once: the steps below read them several times
    owned = checkpointed(with_first(df.select(id_, slug), [slug], id_, out="_owner"))
    rows = owned.withColumn("taken_by", F.when(F.col("_owner") != F.col(id_), F.col("_owner"))).drop("_owner")
    parts = r"^(.*)-(\d{1,18})$"
    named = rows.where(F.col("taken_by").isNull() & F.col(slug).rlike(parts)).withColumn(
        "_names", F.regexp_extract(slug, parts, 2).try_cast("bigint")
    )
    fresh = rows.where(F.col("taken_by").isNotNull()).select(id_, slug)
    found = None
    while not named.isEmpty():
        suffixed = fresh.select(F.col(id_).alias("_blocker"), F.concat_ws("-", slug, F.col(id_).cast("string")).alias("_full"))
        hits = checkpointed(
            named.join(suffixed, (F.col("_names") == F.col("_blocker")) & (F.col(slug) == F.col("_full")) & (F.col("_blocker") < F.col(id_)))
            .select(id_, slug, "_blocker")
        )
        if hits.isEmpty():
            break
        found = hits if found is None else found.union(hits)
        named = checkpointed(named.join(hits.select(id_), id_, "left_anti"))
        fresh = hits.select(id_, slug)
    if found is not None:
        rows = rows.join(found.select(id_, "_blocker"), id_, "left").withColumn("taken_by", F.coalesce("taken_by", "_blocker")).drop("_blocker")
    suffix = F.concat_ws("-", F.col(slug), F.col(id_).cast("string"))
    handles = rows.select(id_, "taken_by", F.when(F.col("taken_by").isNotNull(), suffix).otherwise(F.col(slug)).alias("handle"))
    return df.join(handles, id_)


def handle_rule() -> Rule:
    return Rule(
        F.col("taken_by").isNotNull(),
        "duplicate_handle",
        "medium",
        F.concat(
            F.lit("handle '"), F.col("_slug"), F.lit("' already used by source id "),
            F.col("taken_by").cast("string"), F.lit("; suffixed with the source id"),
        ),
        owner=AGENCY,
        retry="resolved",
        record_ref=F.col("_slug"),
    )




def _canonical(name: Column, policy: Mapping[str, tuple[str, str]]) -> Column:
    return F.coalesce(opt.lookup({k: v[1] for k, v in policy.items()}, F.lower(name)), name)


def product_attributes(products: DataFrame) -> DataFrame:
    """One row per attribute of a product: cleaned name and non-blank values, source order."""
    return (
        products.select("id", F.posexplode("attributes").alias("at", "a"))
        .select(
            "id",
            "at",
            F.coalesce(F.col("a.variation"), F.lit(False)).alias("axis"),
            clean_text(F.col("a.name")).alias("name"),
            F.filter(clean_texts(F.col("a.options")), lambda v: v != "").alias("values"),
        )
    )


def build_options(
    products: DataFrame,
    variations: DataFrame,
    policy: Mapping[str, tuple[str, str]] = shop.ATTRIBUTE_POLICY,
    max_options: int = shop.MAX_OPTIONS,
) -> tuple[DataFrame, DataFrame]:
    """Option table and issue table of all products.

    Options: ``product_id, options array<struct<position, name, values, value_map>>``. Issues:
    ``product_id, code, subject, values, held`` for the exception register.
    """
    attributes = (
        product_attributes(products)
        .where("axis")
        .withColumn("policy", F.coalesce(opt.lookup({k: v[0] for k, v in policy.items()}, F.lower("name")), F.lit("decision")))
        .withColumn("base", _canonical(F.col("name"), policy))
        .withColumn(
            "option",
            F.when(F.col("base") == "Size", opt.size_option_name(F.col("values"))).otherwise(F.col("base")),
        )
    )
    declared = (
        attributes.where((F.col("policy") == "option") & F.col("option").isNotNull())
        .groupBy(F.col("id").alias("product_id"), "option")
        # a product's attributes come from one source row, so the list is bounded by it
        .agg(
            F.min("at").alias("at"),
            F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "values"))), lambda s: s["values"])).alias("declared"),
        )
    )
    used = (
        variations.select(
            F.col("parent_id").alias("product_id"),
            F.explode(F.transform("attributes", lambda a: F.struct(a["name"].alias("name"), a["option"].alias("value")))).alias("a"),
        )
        # each spelling of a product is cleaned once, not once per variation
        .select("product_id", "a.name", "a.value").distinct()
        .select("product_id", _canonical(F.coalesce(clean_text(F.col("name")), F.lit("")), policy).alias("_base"), clean_text(F.col("value")).alias("value"))
        # of distinct spellings, so bounded by the option's vocabulary; a set would make Spark drop the distinct above, and a
        # filter on the cleaned value would clean it twice
        .groupBy("product_id", "_base")
        .agg(F.collect_list(F.nullif("value", F.lit(""))).alias("used"))
        .withColumn("used", F.when(F.size("used") > 0, F.col("used")))
    )
    sock = F.when(F.col("option") == "Sock Size", "Size").otherwise(F.col("option"))
    joined = (
        declared.withColumn("_base", sock)
        .join(used, ["product_id", "_base"], "left")
        .withColumn("raw", F.array_sort(F.array_distinct(F.coalesce("used", "declared"))))
        .withColumn(
            "pairs",
            F.transform(
                "raw",
                lambda v: F.struct(
                    v.alias("raw"),
                    opt.normalize_option_value(F.col("option"), v).alias("norm"),
                ),
            ),
        )
        .withColumn("collided", F.size(F.array_distinct(F.col("pairs.norm"))) < F.size("pairs"))
        .withColumn(
            "value_map",
            F.map_from_entries(
                F.transform("pairs", lambda p: F.struct(p["raw"], F.when(F.col("collided"), p["raw"]).otherwise(p["norm"])))
            ),
        )
    )
    kept = F.size("raw") > 1
    options = (
        joined.where(kept)
        .groupBy("product_id")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "at",
                        F.col("option").alias("name"),
                        opt.sort_option_values(F.col("option"), F.map_values("value_map")).alias("values"),
                        F.to_json("value_map").alias("value_json"),
                    )
                )
            ).alias("o")
        )
        .select(
            "product_id",
            F.transform(
                "o",
                lambda s, i: F.struct(
                    (i + 1).alias("position"),
                    s["name"].alias("name"),
                    s["values"].alias("values"),
                    F.from_json(s["value_json"], "map<string,string>").alias("value_map"),
                ),
            ).alias("options"),
        )
    )

    def issue(df: DataFrame, code: str, subject: Column, values: Column, held: bool) -> DataFrame:
        return df.select(
            "product_id", F.lit(code).alias("code"), subject.alias("subject"), values.alias("values"), F.lit(held).alias("held")
        )

    named = attributes.withColumnRenamed("id", "product_id")
    issues = union_all(
        [
            issue(named.where(F.col("policy") == "label"), "attribute_demoted_to_tag", F.col("name"), F.col("values"), False),
            issue(named.where(F.col("policy") == "decision"), "attribute_needs_decision", F.col("name"), F.col("values"), True),
            issue(
                named.where((F.col("policy") == "option") & F.col("option").isNull()),
                "mixed_size_systems", F.lit("Size"), F.col("values"), True,
            ),
            issue(joined.where(~kept), "single_value_option_dropped", F.col("option"), F.col("raw"), False),
            issue(joined.where(kept & F.col("collided")), "option_value_collision", F.col("option"), F.col("raw"), False),
            issue(
                options.where(F.size("options") > max_options),
                "option_limit_exceeded",
                F.size("options").cast("string"),
                F.col("options.name"),
                True,
            ),
        ]
    )
    return options, issues


_ISSUE_TEXT = {
    "attribute_demoted_to_tag": ("low", AGENCY, "resolved", "attribute is a label, not a variant axis; kept as a legacy tag only"),
    "attribute_needs_decision": ("critical", "client", "needs-decision", "attribute is not clearly variant-defining; needs a client decision before load"),
    "mixed_size_systems": ("high", "client", "needs-decision", "one Size attribute mixes apparel and numeric sizes; split at source before load"),
    "single_value_option_dropped": ("low", AGENCY, "resolved", "option has one value across all variations; dropped so the product is single-variant"),
    "option_value_collision": ("high", "client", "needs-decision", "normalising would merge distinct variants; raw source values kept"),
    "option_limit_exceeded": ("critical", "client", "needs-decision", "more variant options than the target allows; needs a client decision"),
}


def option_exceptions(issues: DataFrame, products: DataFrame) -> DataFrame:
    handles = products.select(F.col("id").alias("product_id"), "handle")
    rules = [
        Rule(
            F.col("code") == code,
            code,
            severity,
            F.concat(F.lit(f"{text}: "), F.col("subject")),
            owner=owner,
            retry=retry,
            detail=F.struct("subject", "values"),
        )
        for code, (severity, owner, retry, text) in _ISSUE_TEXT.items()
    ]
    return exceptions_from_rules(
        issues.join(handles, "product_id", "left"), rules, "product", F.col("product_id"), F.col("handle")
    )


def classified_products(products: DataFrame) -> DataFrame:
    """Products with title, handle and the axes derived from categories and name."""
    base = (
        products.withColumn("title", clean_text(F.col("name")))
        .withColumn("_slug", slugify(F.coalesce(blank_to_null(F.col("slug")), F.col("name"))))
        .withColumn("category_names", clean_texts(F.col("categories.name")))
        .withColumn("tag_names", clean_texts(F.col("tags.name")))
        .withColumn(
            "gender_values",
            F.flatten(
                F.transform(
                    F.filter(
                        F.coalesce("attributes", F.array().cast(products.schema["attributes"].dataType)),
                        lambda a: F.lower(F.trim(a["name"])) == "gender",
                    ),
                    lambda a: a["options"],
                )
            ),
        )
    )
    typed = base.withColumn("_type", opt.product_type(F.col("category_names"), F.col("title")))
    axes = (
        typed.withColumn("type_handle", F.col("_type.type"))
        .withColumn("type_how", F.col("_type.how"))
        .withColumn("surface", opt.surface(F.col("category_names"), F.col("title")))
        .withColumn("clubs", opt.clubs(F.col("category_names"), F.col("title")))
        .withColumn("genders", opt.genders(F.col("category_names"), F.col("gender_values")))
        .drop("_type", "gender_values")
    )
    return unique_handles(axes, "_slug", "id")


def seo_struct(title: Column) -> Column:
    y = F.col("yoast_head_json")
    described = F.coalesce(blank_to_null(y["description"]), y["og_description"])
    return F.struct(
        F.coalesce(blank_to_null(clean_text(y["title"])), title).alias("title"),
        clean_text(described).alias("description"),
    )


def collection_handles() -> Column:
    return F.array_compact(
        F.concat(F.array("type_handle", "surface"), F.coalesce("clubs", F.array().cast("array<string>")))
    )


def build_products(
    classified: DataFrame,
    options: DataFrame,
    issues: DataFrame,
    sellable: DataFrame,
    has_image: DataFrame,
    snapshot: str,
    vendor: str,
    bundle_types: Sequence[str] = ("easy_product_bundle",),
) -> tuple[DataFrame, DataFrame]:
    """Product records and their exceptions. ``sellable`` and ``has_image`` hold the ids of products
    with at least one built variant and one image."""
    held = (
        issues.where("held")
        .groupBy("product_id")
        .agg(
            F.collect_set(
                F.when(F.col("code") == "attribute_needs_decision", F.concat_ws(":", "code", "subject")).otherwise(F.col("code"))
            ).alias("_issue_reasons")
        )
    )
    key = F.col("id") == F.col("product_id")
    flags = sellable.select(F.col("product_id").alias("_sellable"))
    images = has_image.select(F.col("product_id").alias("_imaged"))
    joined = (
        classified.join(options, key, "left").drop("product_id")
        .join(held, key, "left").drop("product_id")
        .join(flags, F.col("id") == F.col("_sellable"), "left")
        .join(images, F.col("id") == F.col("_imaged"), "left")
        .withColumn("seo", seo_struct(F.col("title")))
    )
    bundle = F.col("type").isin(*bundle_types)
    unsellable = F.col("_sellable").isNull()
    reasons = F.array_sort(
        F.array_union(
            F.coalesce("_issue_reasons", F.array().cast("array<string>")),
            F.array_compact(
                F.array(F.when(bundle, "bundle_product"), F.when(unsellable, "product_without_sellable_variant"))
            ),
        )
    )
    records = joined.select(
        "handle",
        "title",
        F.coalesce("description", F.lit("")).alias("body_html"),
        F.coalesce(blank_to_null(clean_text(F.get(F.col("brands.name"), F.lit(0)))), F.lit(vendor)).alias("vendor"),
        F.coalesce(opt.lookup(shop.TYPE_TITLES, F.col("type_handle")), F.col("type_handle")).alias("product_type"),
        F.lit("DRAFT").alias("status"),
        opt.product_tags(
            F.col("category_names"), F.col("tag_names"), F.col("type_handle"), F.col("surface"), F.col("clubs"), F.col("genders")
        ).alias("tags"),
        F.coalesce(
            F.transform("options", lambda o: F.struct(o["position"].alias("position"), o["name"].alias("name"), o["values"].alias("values"))),
            F.array().cast("array<struct<position:int,name:string,values:array<string>>>"),
        ).alias("options"),
        "seo",
        F.col("status").alias("source_status"),
        F.col("permalink").alias("source_permalink"),
        collection_handles().alias("collections"),
        (F.size(reasons) > 0).alias("held"),
        reasons.alias("held_reasons"),
        source_ref(F.col("id"), "product", snapshot),
        "surface",
        "clubs",
        "genders",
    )
    rules = [
        handle_rule(),
        Rule(bundle, "bundle_product", "high", "bundle product has no equivalent on the target; rebuild by hand or with an app"),
        Rule(
            F.col("type_how") != "category",
            F.concat(F.lit("product_type_"), F.regexp_replace("type_how", "-", "_")),
            "medium",
            F.concat(F.lit("no mapped product-type category; assigned '"), F.col("type_handle"), F.lit("' by "), F.col("type_how")),
            detail=F.struct(F.col("category_names").alias("categories"), F.col("type_handle").alias("assigned")),
        ),
        Rule(
            F.col("_imaged").isNull() & (F.col("status") == "publish"),
            "product_without_image", "medium", "published product has no image; the listing will show a placeholder",
        ),
        Rule(
            unsellable, "product_without_sellable_variant", "critical",
            "every variant was held; product cannot be loaded",
        ),
        Rule(
            F.col("seo.description") == "", "seo_description_missing", "low", "no meta description; left empty",
        ),
    ]
    return records, exceptions_from_rules(joined, rules, "product", F.col("id"), F.col("handle"))


_VARIANT_FIELDS = [
    "sku", "regular_price", "sale_price", "price", "manage_stock", "stock_quantity", "stock_status",
    "backorders_allowed", "weight", "virtual", "tax_status", "meta_data", "global_unique_id",
]


def all_variations(products: DataFrame, variations: DataFrame) -> DataFrame:
    """Source variations plus one default variation of every product that has none."""
    cols = ["id", "parent_id", "menu_order", "attributes", "image", *_VARIANT_FIELDS]
    real = variations.select(*cols)
    parents = variations.select(F.col("parent_id").alias("id")).distinct()
    types = {f.name: f.dataType for f in variations.schema}
    simple = products.join(parents, "id", "left_anti").select(
        "id",
        F.col("id").alias("parent_id"),
        F.lit(0).alias("menu_order"),
        F.array().cast(types["attributes"]).alias("attributes"),
        F.lit(None).cast(types["image"]).alias("image"),
        *_VARIANT_FIELDS,
    )
    return real.unionByName(simple)


def own_facts(rows: DataFrame, policy: Mapping[str, tuple[str, str]] = shop.ATTRIBUTE_POLICY) -> DataFrame:
    """What a variation says by itself, cleaned: narrow rows to deal by product. Python runs here, as Spark forgets behind it how rows are dealt."""
    own = own_price(F.struct("sale_price", "regular_price", "price"))
    barcode = F.coalesce(blank_to_null(meta_value(F.col("meta_data"), shop.BARCODE_FIELD)), F.col("global_unique_id"))
    return (
        rows.withColumn("_names", clean_texts(F.col("attributes.name")))
        .withColumn("_values", clean_texts(F.col("attributes.option")))
        .select(
            # narrow numbers side by side: a shuffle's compression finds longer runs
            "manage_stock", "stock_status", "backorders_allowed", "virtual", "tax_status",
            F.nullif(kg_to_grams(F.col("weight")), F.lit(0)).alias("_grams"),
            blank_to_null(clean_text(barcode)).alias("barcode"),
            "id", "parent_id", own["price"].alias("_price"), own["compare_at"].alias("_compare_at"),
            F.coalesce("menu_order", F.lit(0)).alias("menu_order"), "stock_quantity",
            clean_text(F.col("sku")).alias("raw_sku"),
            F.zip_with("_names", "_values", lambda n, v: F.struct(_canonical(n, policy).alias("name"), v.alias("value"))).alias("_given"),
        )
    )


def build_variants(
    products: DataFrame,
    classified: DataFrame,
    variations: DataFrame,
    options: DataFrame,
    snapshot: str,
    policy: Mapping[str, tuple[str, str]] = shop.ATTRIBUTE_POLICY,
    sku_prefix: str = SKU_PREFIX,
    currency: str = CURRENCY,
    max_group_rows: int = MAX_GROUP_ROWS,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Variant records (before product holds) and their exceptions.

    ``products`` are the source rows, ``classified`` the same with handles: what needs no handle
    reads the source, so its plan stays short. ``keep`` writes the judged rows where both results
    are read; without it each makes them for itself.

    Rows are dealt by product once: numbering, the join with the product and the search for repeated combinations
    all run there. Where a product has more than ``max_group_rows`` rows, its rows are dealt by ranges and combinations instead.
    """
    parents = (
        classified.join(options, F.col("id") == F.col("product_id"), "left")
        .select(
            F.col("id").alias("parent_id"),
            "handle",
            "options",
            # read once a product, not once a variation
            F.struct(
                parent_price(F.struct("regular_price", "price")).alias("price"), "manage_stock",
                kg_to_grams(F.col("weight")).alias("grams"), "virtual", "tax_status",
            ).alias("parent"),
        )
    )
    rows, order = own_facts(all_variations(products, variations), policy), ["menu_order", "id"]
    cut = ranged(rows, ["parent_id"], order, max_rows=max_group_rows)
    if cut is None:
        placed = spread(rows, "parent_id").withColumn("position", F.row_number().over(Window.partitionBy("parent_id").orderBy(*order)).cast("bigint"))
    else:
        placed = numbered_ranges(cut, ["parent_id"], order)
    # the parent side is one row per product; a hot parent is split by the adaptive skew join
    joined = placed.join(parents, "parent_id")
    parent = F.col("parent")

    def given(name: Column) -> Column:
        return F.try_element_at(F.filter("_given", lambda g: g["name"] == name), F.lit(-1))["value"]

    def asked(o: Column) -> Column:
        raw = F.coalesce(given(o["name"]), F.when(o["name"] == "Sock Size", given(F.lit("Size"))))
        return F.struct(o["name"].alias("name"), o["value_map"].alias("value_map"), raw.alias("raw"))

    def chosen(o: Column) -> Column:
        value = F.when(o["raw"] != "", F.coalesce(F.try_element_at(o["value_map"], o["raw"]), o["raw"]))
        return F.struct(o["name"].alias("name"), value.alias("value"))

    shape = "array<struct<name:string,value:string>>"
    # in two steps, so the given value is looked up once
    picked = F.coalesce(F.transform(F.transform("options", asked), chosen), F.array().cast(shape))
    stock = resolve_inventory(F.struct("manage_stock", "stock_quantity", "stock_status"), parent)
    cost = F.struct(F.coalesce("_price", parent["price"]).alias("price"), F.col("_compare_at").alias("compare_at"))
    resolved = (
        joined.withColumn("_picked", picked)
        .withColumn("missing", F.transform(F.filter("_picked", lambda p: p["value"].isNull()), lambda p: p["name"]))
        .withColumn(
            "option_values",
            F.when(
                F.size("_picked") == 0,
                F.array(F.struct(F.lit("Title").alias("name"), F.lit("Default Title").alias("value"))),
            ).otherwise(F.filter("_picked", lambda p: p["value"].isNotNull())),
        )
        .withColumn("cost", cost)
        .withColumn("stock", stock)
        .withColumn("weight_grams", F.coalesce("_grams", parent["grams"]))
        .withColumn("sku_generated", F.col("raw_sku") == "")
        .withColumn("sku", F.when(F.col("sku_generated"), generate_sku(F.col("parent_id"), F.col("id"), sku_prefix)).otherwise(F.col("raw_sku")))
        .withColumn("_combination", F.when(F.size("missing") == 0, F.to_json("option_values")))
        .select(
            "id", "parent_id", "handle", "position", "sku", "sku_generated", "barcode", "cost", "stock", "weight_grams",
            F.when(F.col("backorders_allowed"), "CONTINUE").otherwise("DENY").alias("inventory_policy"),
            (~(F.coalesce("virtual", F.lit(False)) | F.coalesce(parent["virtual"], F.lit(False)))).alias("requires_shipping"),
            (
                F.coalesce(blank_to_null(F.col("tax_status")), blank_to_null(parent["tax_status"]), F.lit("taxable")) == "taxable"
            ).alias("taxable"),
            "option_values", "missing", "_combination",
        )
    )
    whole, combination = F.col("_combination").isNotNull(), ["parent_id", "_combination"]
    if cut is None:
        # a product's rows are in one task already: no shuffle
        owned = resolved.withColumn("_first", F.when(whole, F.first("id").over(Window.partitionBy(*combination).orderBy("position"))))
    else:
        # read twice: computed once, what is needed of it
        resolved = checkpointed(resolved)
        claimed = (
            resolved.where(whole)
            .groupBy(*combination)
            # positions are unique in a product; a minimum of structs would be a sort aggregation
            .agg(F.min_by("id", "position").alias("_first"), F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1)
            .drop("_n")
        )
        owned = resolved.join(claimed, combination, "left")
    checked = owned.withColumn("first_variation_id", F.when(F.col("_first") != F.col("id"), F.col("_first"))).drop("_first", "_combination")
    if keep is not None:
        checked = keep(checked)
    no_price = F.col("cost.price").isNull()
    no_value = F.size("missing") > 0
    repeated = F.col("first_variation_id").isNotNull()
    records = checked.select(
        F.col("handle").alias("product_handle"),
        F.col("parent_id").alias("product_id"),
        "sku",
        "sku_generated",
        "barcode",
        F.col("cost.price").alias("price"),
        F.col("cost.compare_at").alias("compare_at_price"),
        F.lit(currency).alias("currency"),
        "weight_grams",
        F.col("stock.quantity").alias("inventory_quantity"),
        F.col("stock.managed").alias("inventory_tracked"),
        "inventory_policy",
        "requires_shipping",
        "taxable",
        "option_values",
        "position",
        (no_price | no_value | repeated).alias("held"),
        F.array_compact(
            F.array(
                F.when(no_price, "variant_missing_price"),
                F.when(no_value, "variant_missing_option_value"),
                F.when(repeated, "duplicate_option_combination"),
            )
        ).alias("held_reasons"),
        source_ref(F.col("id"), "product_variation", snapshot),
    )
    detail = F.struct(F.col("handle").alias("product_handle"))
    rules = [
        Rule(F.col("sku_generated"), "sku_generated", "low", "variation had no SKU; generated from product and variation id", detail=detail),
        Rule(no_price, "variant_missing_price", "high", "no regular, sale or parent price; variant held out of the load", detail=detail),
        Rule(
            no_value, "variant_missing_option_value", "high",
            F.concat(F.lit("no value for option(s) "), F.array_join("missing", ", "), F.lit("; variant held")), detail=detail,
        ),
        Rule(
            repeated, "duplicate_option_combination", "high",
            F.concat(F.lit("same option combination as variation "), F.col("first_variation_id").cast("string"), F.lit("; row held")),
            detail=F.struct(F.col("handle").alias("product_handle"), "first_variation_id"),
        ),
        Rule(
            F.col("stock.raw") < 0, "negative_inventory", "medium",
            F.concat(F.lit("source stock quantity is "), F.col("stock.raw").cast("string"), F.lit("; staged as 0")),
        ),
        Rule(F.col("weight_grams").isNull(), "variant_missing_weight", "low", "no weight on the variation or its parent"),
    ]
    return records, exceptions_from_rules(checked, rules, "variant", F.col("id"), F.col("sku"))


def duplicate_sku_exceptions(variants: DataFrame) -> DataFrame:
    """One row per shared SKU. Its members are :func:`quality.duplicate_members` rows: a list of
    them would grow with the SKU."""
    shared = (
        variants.groupBy("sku")
        .agg(F.count(F.lit(1)).alias("n"), F.min("source.source_id").alias("first_id"))
        .where(F.col("n") > 1)
    )
    rule = Rule(
        F.lit(True), "duplicate_sku", "high",
        F.concat(F.lit("SKU used by "), F.col("n").cast("string"), F.lit(" variants; left unchanged, client must supply unique SKUs")),
        detail=F.struct(F.col("n").alias("variants"), F.col("first_id").alias("first_variation_id")),
    )
    return exceptions_from_rules(shared, [rule], "variant", F.col("sku"), F.col("sku"))


def variation_colours(variations: DataFrame, names: Sequence[str] = tuple(shop.COLOUR_ATTRIBUTES)) -> DataFrame:
    """Variations with ``colour`` (first colour attribute, null if blank) and ``own_src``."""
    hit = F.get(F.filter("attributes", lambda a: F.lower(F.trim(a["name"])).isin(*names)), F.lit(0))["option"]
    return variations.withColumn("colour", blank_to_null(clean_text(hit))).withColumn(
        "own_src", blank_to_null(F.col("image.src"))
    )


def propagate_colour_image(variations: DataFrame) -> DataFrame:
    """Add ``src``: the variation's own image, else the first image of its colour in the product.

    The first image per (product, colour) is a combinable minimum joined back, not a window.
    """
    rows = variation_colours(variations).withColumn("menu_order", F.coalesce("menu_order", F.lit(0)))
    firsts = (
        rows.where(F.col("colour").isNotNull() & F.col("own_src").isNotNull())
        .groupBy("parent_id", "colour")
        .agg(F.min_by("own_src", F.struct("menu_order", "id")).alias("_colour_src"))
    )
    return (
        rows.join(firsts, ["parent_id", "colour"], "left")
        .withColumn("src", F.coalesce("own_src", "_colour_src"))
        .drop("_colour_src")
    )


def image_skus(variations: DataFrame, sku_prefix: str = SKU_PREFIX) -> DataFrame:
    """``product_id, src, id, sku, position``: which variants show which image, one row each."""
    sku = clean_text(F.col("sku"))
    return (
        propagate_colour_image(variations)
        .where(F.col("src").isNotNull())
        .select(
            F.col("parent_id").alias("product_id"),
            "src",
            "menu_order",
            "id",
            F.coalesce(blank_to_null(sku), generate_sku(F.col("parent_id"), F.col("id"), sku_prefix)).alias("sku"),
        )
    )


def build_media(
    products: DataFrame,
    classified: DataFrame,
    variations: DataFrame,
    media: DataFrame,
    media_head: DataFrame,
    snapshot: str,
    sku_prefix: str = SKU_PREFIX,
    max_group_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Image records of products and their exceptions.

    Gallery images come first, then variation images, de-duplicated by address in that order. An
    image names its first variant and how many show it; the full list is :func:`image_skus`.
    """
    gallery = products.select(
        F.col("id").alias("product_id"), F.posexplode("images").alias("at", "i")
    ).select("product_id", F.lit(0).alias("kind"), F.col("at").cast("bigint"), F.lit(0).cast("bigint").alias("tie"), "i.id", "i.src", "i.alt")
    shown = variations.where(F.col("image.src") != "").select(
        F.col("parent_id").alias("product_id"),
        F.lit(1).alias("kind"),
        F.coalesce("menu_order", F.lit(0)).cast("bigint").alias("at"),
        F.col("id").alias("tie"),
        "image.id",
        "image.src",
        "image.alt",
    )
    distinct = (
        gallery.unionByName(shown)
        .where(F.col("src") != "")
        .groupBy("product_id", "src")
        .agg(F.min(F.struct("kind", "at", "tie", "id", "alt")).alias("f"))
        .select("product_id", "src", "f.*")
        .withColumn("_rank", F.col("kind") * F.lit(2**40) + F.col("at"))
    )
    extra = {} if max_group_rows is None else {"max_rows": max_group_rows}
    placed = numbered(distinct, ["product_id"], ["_rank", "tie"], ["_rank", "tie"], **extra)
    alts = media.select(F.col("id").alias("_media"), clean_text(F.col("alt_text")).alias("_media_alt"))
    heads = media_head.select(F.col("url").alias("src"), F.col("status").alias("http_status")).dropDuplicates(["src"])
    shows = (
        image_skus(variations, sku_prefix)
        .groupBy("product_id", "src")
        .agg(
            F.min_by("sku", F.struct("menu_order", "id")).alias("variant_sku"),
            F.count(F.lit(1)).alias("variant_count"),
        )
    )
    handles = classified.select(F.col("id").alias("product_id"), "handle")
    joined = (
        placed.join(handles, "product_id")
        .join(alts, F.col("id") == F.col("_media"), "left")
        .join(heads, "src", "left")
        .join(shows, ["product_id", "src"], "left")
        .withColumn("alt", F.coalesce(blank_to_null(clean_text(F.col("alt"))), F.col("_media_alt"), F.lit("")))
    )
    records = joined.select(
        F.col("handle").alias("product_handle"),
        "product_id",
        F.col("src").alias("original_url"),
        "alt",
        "position",
        "variant_sku",
        F.coalesce("variant_count", F.lit(0).cast("bigint")).alias("variant_count"),
        F.sha2(F.to_json(F.struct(F.col("src"))), 256).alias("url_checksum"),
        (F.col("http_status") == 200).alias("reachable"),
        "http_status",
        F.col("id").alias("media_id"),
        source_ref(F.col("id"), "product_image", snapshot),
    )
    rules = [
        Rule(
            F.col("http_status") != 200, "media_unreachable", "high",
            F.concat(F.lit("source image returned HTTP "), F.col("http_status").cast("string")), owner=AGENCY, retry="auto-retryable",
        ),
        Rule(F.col("alt") == "", "media_missing_alt", "low", "image has no alt text"),
    ]
    return records, exceptions_from_rules(joined, rules, "media", F.col("id"), F.col("handle"))


METAFIELD_AXES = {
    "surface": ("single_line_text_field", shop.SURFACE_CHOICES),
    "club": ("list.single_line_text_field", shop.CLUB_CHOICES),
    "gender": ("list.single_line_text_field", shop.GENDER_CHOICES),
}


def product_metafields(
    products: DataFrame, namespace: str = "shop", axes: Mapping[str, tuple[str, Sequence[str]]] = METAFIELD_AXES
) -> tuple[DataFrame, DataFrame]:
    """Trace row per product plus one row per non-empty axis, values outside the choice list dropped
    and reported."""
    values = {
        "surface": F.array_compact(F.array("surface")),
        "club": F.coalesce("clubs", F.array().cast("array<string>")),
        "gender": F.coalesce("genders", F.array().cast("array<string>")),
    }
    checked = products.select(
        "*", *[opt.choice_checked(values[k], axes[k][1]).alias(f"_{k}") for k in axes]
    )

    def row(ns: str, key: str, type_: str, value: Column) -> Column:
        return F.struct(
            F.lit(ns).alias("namespace"), F.lit(key).alias("key"), F.lit(type_).alias("type"), value.alias("value")
        )

    cells = [row("migration", "source_id", "single_line_text_field", F.col("source.source_id").cast("string"))]
    for key, (type_, _) in axes.items():
        kept = F.col(f"_{key}.kept")
        value = F.to_json(kept) if type_.startswith("list.") else F.get(kept, F.lit(0))
        cells.append(F.when(F.size(kept) > 0, row(namespace, key, type_, value)))
    records = checked.select(
        F.lit("PRODUCT").alias("owner_type"),
        F.col("handle").alias("owner_handle"),
        F.explode(F.array_compact(F.array(*cells))).alias("m"),
        "held",
        "source",
    ).select("owner_type", "owner_handle", "m.*", "held", "source")
    rules = [
        Rule(
            F.size(F.col(f"_{key}.rejected")) > 0,
            "metafield_value_outside_choices",
            "high",
            F.concat(
                F.lit(f"{namespace}.{key} value(s) "), F.array_join(f"_{key}.rejected", ", "),
                F.lit(" are not in the definition's choice list; dropped"),
            ),
            owner=AGENCY,
            detail=F.struct(F.lit(key).alias("key"), F.col(f"_{key}.rejected").alias("rejected")),
            record_ref=F.concat(F.col("handle"), F.lit(f":{namespace}.{key}")),
        )
        for key in axes
    ]
    return records, exceptions_from_rules(checked, rules, "metafield", F.col("source.source_id"), F.col("handle"))


#: (key, type, name, description, pinned, choices)
DEFINITIONS = [
    ("surface", "single_line_text_field", "Playing surface", "Where the product is played.", True, shop.SURFACE_CHOICES),
    ("club", "list.single_line_text_field", "Club or team", "Clubs this product belongs to.", True, shop.CLUB_CHOICES),
    ("gender", "list.single_line_text_field", "Gender", "Who the product is cut for.", True, shop.GENDER_CHOICES),
    ("size_guide", "single_line_text_field", "Size guide", "Handle of the size-guide page.", True, None),
    ("personalisation", "json", "Personalisation fields", "Name and number fields offered.", True, None),
]


def metafield_definitions(spark: SparkSession, snapshot: str, namespace: str = "shop") -> DataFrame:
    """Definition rows with their choice list as a JSON array."""
    rows = [
        (namespace, key, type_, name, "PRODUCT", text, pin, json.dumps(choices, separators=(",", ":")) if choices else None)
        for key, type_, name, text, pin, choices in DEFINITIONS
    ]
    rows.append(
        ("migration", "source_id", "single_line_text_field", "Source id", "PRODUCT", "Traces a record to its source.", False, None)
    )
    schema = "namespace string, key string, type string, name string, owner_type string, description string, pin boolean, choices string"
    return spark.createDataFrame(rows, schema).withColumn(
        "source", source_ref(F.lit(None).cast("bigint"), "definition", snapshot)
    ).withColumn("held", F.lit(False))


def collection_definitions(spark: SparkSession) -> DataFrame:
    rows = (
        [(h, t, "product-type") for h, t in shop.TYPE_TITLES.items()]
        + [(h, t, "surface") for h, t in shop.SURFACE_TITLES.items()]
        + [(c[0], c[1], "club") for c in shop.CLUBS]
        + [(shop.TEAMWEAR[0], shop.TEAMWEAR[1], "club")]
    )
    return spark.createDataFrame(rows, "handle string, title string, axis string")


def collection_members(products: DataFrame) -> DataFrame:
    """``(handle, product_handle)`` of loadable products, one row per pair: a popular collection can
    hold a third of the catalog, so it is never a list."""
    return (
        products.where(~F.col("held"))
        .select(F.explode("collections").alias("handle"), F.col("handle").alias("product_handle"))
        .distinct()
    )


def build_collections(definitions: DataFrame, members: DataFrame, snapshot: str) -> tuple[DataFrame, DataFrame]:
    """Collection records with their member count, and an exception for each empty one."""
    sizes = members.groupBy("handle").agg(F.count(F.lit(1)).alias("product_count"))
    records = definitions.join(sizes, "handle", "left").select(
        "handle",
        "title",
        "axis",
        F.lit("MANUAL").alias("rule_set"),
        F.coalesce("product_count", F.lit(0).cast("bigint")).alias("product_count"),
        F.lit(False).alias("held"),
        source_ref(F.lit(None).cast("bigint"), "collection", snapshot),
    )
    rule = Rule(F.col("product_count") == 0, "empty_collection", "medium", "collection has no members", owner=AGENCY)
    return records, exceptions_from_rules(records, [rule], "collection", F.col("handle"), F.col("handle"))


def build_pages(pages: DataFrame, snapshot: str, functional: str = shop.FUNCTIONAL_PAGE) -> tuple[DataFrame, DataFrame]:
    """Page records: storefront routes are held, ``-N`` slugs reported."""
    slug = clean_text(F.col("slug"))
    base = (
        pages.withColumn("raw_slug", slug)
        .withColumn("page_title", rendered(F.col("title")))
        .withColumn("_slug", slugify(F.coalesce(blank_to_null(F.col("slug")), F.col("title.rendered"))))
        .withColumn("body_html", rendered(F.col("content")))
        .withColumn("seo", seo_struct(F.col("page_title")))
    )
    rows = unique_handles(base, "_slug", "id")
    route = F.col("raw_slug").rlike(functional)
    records = rows.select(
        "handle",
        F.col("page_title").alias("title"),
        "body_html",
        (F.col("status") == "publish").alias("published"),
        F.col("status").alias("source_status"),
        F.col("date_gmt").alias("published_at"),
        "seo",
        F.col("link").alias("source_permalink"),
        route.alias("held"),
        F.array_compact(F.array(F.when(route, "page_is_storefront_route"))).alias("held_reasons"),
        source_ref(F.col("id"), "page", snapshot),
    )
    rules = [
        handle_rule(),
        Rule(route, "page_is_storefront_route", "medium", "functional page owned by the storefront; not loaded", owner=AGENCY, record_ref=F.col("raw_slug")),
        Rule(F.col("raw_slug").rlike(r"-\d+$"), "page_duplicate_suffix", "low", "slug looks like a duplicate; confirm the canonical page", record_ref=F.col("raw_slug")),
    ]
    return records, exceptions_from_rules(rows, rules, "page", F.col("id"), F.col("handle"))


def term_names(posts: DataFrame, column: str, terms: DataFrame, fallback: str) -> DataFrame:
    """``(id, term)`` of an id list, with ``<fallback>-<id>`` for an unknown term."""
    names = terms.select(F.col("id").alias("_term"), clean_text(F.col("name")).alias("_name"))
    return (
        posts.select("id", F.explode(column).alias("_id"))
        .join(names, F.col("_id") == F.col("_term"), "left")
        .select("id", F.coalesce("_name", F.concat(F.lit(f"{fallback}-"), F.col("_id").cast("string"))).alias("term"))
    )


def build_articles(
    posts: DataFrame, tags: DataFrame, categories: DataFrame, snapshot: str, blog: str = "news"
) -> tuple[DataFrame, DataFrame]:
    """Article records; tags are the sorted names of tag and category ids."""
    labels = (
        term_names(posts, "tags", tags, "wp-tag")
        .unionByName(term_names(posts, "categories", categories, "wp-cat"))
        # a post's own ids, bounded by its source row
        .groupBy("id")
        .agg(F.array_sort(F.collect_set("term")).alias("labels"))
    )
    base = (
        posts.withColumn("post_title", rendered(F.col("title")))
        .withColumn("_slug", slugify(F.coalesce(blank_to_null(F.col("slug")), F.col("title.rendered"))))
        .withColumn("body_html", rendered(F.col("content")))
        .withColumn("seo", seo_struct(F.col("post_title")))
        .withColumn("_author", clean_text(F.col("yoast_head_json.author")))
    )
    rows = unique_handles(base, "_slug", "id").join(labels, "id", "left")
    records = rows.select(
        F.lit(blog).alias("blog_handle"),
        "handle",
        F.col("post_title").alias("title"),
        "body_html",
        rendered(F.col("excerpt")).alias("excerpt"),
        F.coalesce(
            blank_to_null(F.col("_author")), F.concat(F.lit("wp-user-"), F.coalesce(F.col("author").cast("string"), F.lit("None")))
        ).alias("author"),
        (F.col("status") == "publish").alias("published"),
        F.col("date_gmt").alias("published_at"),
        F.coalesce("labels", F.array().cast("array<string>")).alias("tags"),
        "seo",
        F.col("link").alias("source_permalink"),
        F.lit(False).alias("held"),
        F.array().cast("array<string>").alias("held_reasons"),
        source_ref(F.col("id"), "post", snapshot),
    )
    return records, exceptions_from_rules(rows, [handle_rule()], "article", F.col("id"), F.col("handle"))


def build_customers(customers: DataFrame, snapshot: str, country: str = COUNTRY) -> tuple[DataFrame, DataFrame]:
    """Shopper records. Staff roles are left out, a missing e-mail and a later use of an e-mail are
    rejected, consent is never invented. Only ids reach the register."""
    rows = (
        customers.where(F.col("role") == "customer")
        .withColumn("_email", F.lower(clean_text(F.col("email"))))
        .withColumn("_address", default_address(F.col("shipping"), F.col("billing"), country))
    )
    named = rows.where(F.col("_email") != "")
    firsts = named.groupBy("_email").agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    marked = named.join(firsts, "_email", "left").withColumn(
        "first_id", F.when(F.col("_first") != F.col("id"), F.col("_first"))
    )
    kept = marked.where(F.col("first_id").isNull())
    ref = F.concat(F.lit("customer:"), F.col("id").cast("string"))
    records = kept.select(
        F.col("_email").alias("email"),
        clean_text(F.col("first_name")).alias("first_name"),
        clean_text(F.col("last_name")).alias("last_name"),
        blank_to_null(clean_text(F.col("billing.phone"))).alias("phone"),
        F.col("_address").alias("default_address"),
        F.array(F.lit("migrated"), F.concat(F.lit("source:"), F.col("id").cast("string"))).alias("tags"),
        F.lit("NOT_SUBSCRIBED").alias("email_consent"),
        F.lit(False).alias("tax_exempt"),
        F.lit(False).alias("held"),
        F.array().cast("array<string>").alias("held_reasons"),
        source_ref(F.col("id"), "customer", snapshot),
    )
    raised = union_all(
        [
            exceptions_from_rules(
                rows.where(F.col("_email") == ""),
                [Rule(F.lit(True), "customer_without_email", "high", "customer has no e-mail address")],
                "customer", F.col("id"), ref,
            ),
            exceptions_from_rules(
                marked,
                [
                    Rule(
                        F.col("first_id").isNotNull(), "duplicate_customer_email", "high",
                        F.concat(F.lit("e-mail already used by source customer "), F.col("first_id").cast("string")),
                    ),
                    Rule(
                        F.col("first_id").isNull() & F.col("_address").isNull(), "customer_without_address", "low",
                        "no billing or shipping address on the source account",
                    ),
                ],
                "customer", F.col("id"), ref,
            ),
        ]
    )
    return records, raised


def build_discounts(
    coupons: DataFrame, snapshot: str, currency: str = CURRENCY, advanced: Sequence[str] = tuple(shop.ADVANCED_COUPON_PREFIXES)
) -> tuple[DataFrame, DataFrame]:
    row = F.struct(*[F.col(c) for c in coupons.columns])
    rows = coupons.withColumn("_d", coupon_to_discount(row, advanced, currency))
    unsupported = F.col("_d.type") == "unsupported"
    records = rows.select(
        "_d.*",
        unsupported.alias("held"),
        F.array().cast("array<string>").alias("held_reasons"),
        source_ref(F.col("id"), "coupon", snapshot),
    )
    rules = [
        Rule(
            unsupported, "unsupported_discount_type", "high",
            F.concat(F.lit("discount type '"), F.coalesce("discount_type", F.lit("")), F.lit("' has no direct equivalent")), owner=AGENCY,
        ),
        Rule(
            F.size("_d.unsupported_rules") > 0, "advanced_coupon_rules", "medium", "coupon carries rules the target cannot express",
            detail=F.struct(F.col("_d.unsupported_rules").alias("meta_keys")),
        ),
    ]
    return records, exceptions_from_rules(rows, rules, "discount", F.col("id"), F.col("_d.code"))


def id_map(records: Mapping[str, DataFrame], snapshot: str) -> DataFrame:
    """Source id to target key of every record; customers by id reference, never by e-mail."""
    keys = {
        "products": ("handle", F.col("handle")),
        "pages": ("handle", F.col("handle")),
        "articles": ("handle", F.col("handle")),
        "variants": ("sku", F.col("sku")),
        "discounts": ("code", F.col("code")),
        "customers": ("email", F.concat(F.lit("customer:"), F.col("source.source_id").cast("string"))),
        "collections": ("handle", F.col("handle")),
    }
    return union_all(
        [
            records[name].select(
                F.col("source.source_type").alias("source_type"),
                F.col("source.source_id").alias("source_id"),
                F.lit(key).alias("target_key"),
                value.alias("value"),
                "held",
                F.lit(snapshot).alias("snapshot"),
            )
            for name, (key, value) in keys.items()
            if name in records
        ]
    )
