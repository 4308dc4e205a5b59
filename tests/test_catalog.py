"""The whole transform on a small shop, rule by rule."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import shopdata
from cartloom.operators import catalog, quality
from cartloom.operators.exceptions import Rule, exception_order, exceptions_by_severity
from cartloom.sources.snapshot import SnapshotMissing, source_summary
from conftest import snapshot


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def codes(records):
    return {r.code: r.n for r in records["exceptions"].groupBy("code").agg(F.count("*").alias("n")).collect()}


def test_missing_files_are_named_together(spark, tmp_path):
    folder = shopdata.write(tmp_path, skip=("pages", "coupons", "menu_items"))
    with pytest.raises(SnapshotMissing, match="coupons, pages"):
        snapshot(spark, folder)


def test_snapshot(spark, shop):
    source, _ = shop
    assert (source.taken, source.base) == ("2026-01-01", shopdata.SITE)
    counts = by(source_summary(source), "entity", "axis", "value")
    assert counts["products", "total", ""].n == 5 and counts["products", "status", "publish"].n == 4 and counts["customers", "role", "administrator"].n == 1


def test_products(shop):
    _, records = shop
    products = by(records["products"], "handle")
    assert set(products) == {"beach-tee", "beach-tee-12", "kit-jersey", "plain-sock", "gift-bundle"}
    tee = products["beach-tee"]
    assert tee.title == "Beach Tee & Sand" and tee.vendor == "Acme" and products["plain-sock"].vendor == "House Brand"
    assert {o.name: o["values"] for o in tee.options} == {"Colour": ["Black", "Navy"], "Size": ["S", "S/M", "2XL"]}
    assert tee.tags == ["gender:unisex", "legacy:summer-sale", "legacy:t-shirts", "surface:beach", "type:tops"]
    assert tee.collections == ["tops", "beach"] and not tee.held
    jersey = products["kit-jersey"]
    assert jersey.held_reasons == ["attribute_needs_decision:Condition"]
    assert jersey.options[0]["values"] == ["Gray", "Light Gray"] and jersey.collections == ["jerseys", "indoor", "teamwear"]
    assert products["gift-bundle"].held_reasons == ["bundle_product"]
    assert products["beach-tee-12"].options == [] and products["beach-tee-12"].genders == ["Men"]
    assert all(p.status == "DRAFT" for p in products.values())


def test_variants(shop):
    _, records = shop
    variants = {r.source.source_id: r for r in records["variants"].collect()}
    assert {i: v.position for i, v in variants.items() if v.product_handle == "beach-tee"} == {102: 1, 101: 2, 103: 3}
    assert variants[102].sku == "SKU-10-102" and variants[102].sku_generated and variants[102].weight_grams == 350
    assert (variants[101].price, variants[101].compare_at_price, variants[101].weight_grams) == (Decimal("15.00"), Decimal("20.00"), 200)
    assert {o.name: o.value for o in variants[101].option_values} == {"Colour": "Black", "Size": "2XL"}
    assert variants[121].price == Decimal("15.00") and variants[121].option_values[0].value == "Default Title"
    assert variants[13].inventory_quantity == 0 and variants[13].inventory_tracked
    assert variants[111].held and variants[111].price == Decimal("55.50") and "product_held" in variants[111].held_reasons


def test_exceptions(spark, shop):
    _, records = shop
    found = codes(records)
    expected = {
        "attribute_needs_decision": 1, "attribute_demoted_to_tag": 1, "option_value_collision": 1, "bundle_product": 1, "duplicate_handle": 1,
        "duplicate_sku": 1, "negative_inventory": 1, "media_unreachable": 1, "product_type_fallback": 1, "product_type_name_inferred": 1,
        "page_is_storefront_route": 1, "page_duplicate_suffix": 1, "customer_without_email": 1, "duplicate_customer_email": 1,
        "customer_without_address": 1, "unsupported_discount_type": 1, "advanced_coupon_rules": 1, "body_image_not_in_media_export": 1,
    }
    assert {c: found.get(c) for c in expected} == expected
    assert found["sku_generated"] == 2 and found["product_without_image"] == 2
    by_severity = {r.severity: r.n for r in exceptions_by_severity(records["exceptions"]).collect()}
    assert by_severity["critical"] == 1 and sum(by_severity.values()) == records["exceptions"].count()
    first = exception_order(records["exceptions"]).first()
    assert first.severity == "critical" and json.loads(first.detail)["subject"] == "Condition"
    assert not records["exceptions"].where(F.col("message").contains("@") | F.col("record_ref").contains("@")).count()
    with pytest.raises(ValueError):
        Rule(F.lit(True), "x", "awful", "m")


def test_media_and_metafields(shop):
    _, records = shop
    media = by(records["media"], "product_handle", "position")
    assert media["beach-tee", 1].original_url.endswith("tee.jpg") and media["beach-tee", 2].variant_sku == "TEE-1" and media["beach-tee", 2].variant_count == 2
    assert media["beach-tee-12", 1].alt == "Cap alt" and media["plain-sock", 1].reachable is False
    fields = by(records["metafields"], "owner_handle", "key")
    assert fields["beach-tee", "surface"].value == "beach" and fields["kit-jersey", "club"].value == '["teamwear"]'
    assert fields["kit-jersey", "source_id"].value == "11" and fields["kit-jersey", "source_id"].held
    definitions = by(records["metafield_definitions"], "key")
    assert definitions["surface"].choices == '["beach","indoor"]' and definitions["size_guide"].choices is None


def test_content_customers_discounts(shop):
    _, records = shop
    pages = by(records["pages"], "handle")
    assert pages["cart-2"].held and not pages["about"].held and pages["about"].title == "About & us"
    article = records["articles"].first()
    assert article.tags == ["General", "News", "wp-tag-9"] and article.author == "wp-user-7"
    customers = by(records["customers"], "email")
    assert set(customers) == {"one@example.invalid", "two@example.invalid"}
    one = customers["one@example.invalid"]
    assert one.default_address.country_code == "AU" and one.phone == "123" and one.email_consent == "NOT_SUBSCRIBED"
    ten = by(records["discounts"], "code")["TEN"]
    assert (ten.type, ten.amount, ten.minimum_subtotal, ten.unsupported_rules, ten.applies_once_per_customer) == ("percentage", Decimal("10.00"), None, ["_acfw_rule"], True)
    ids = by(records["id_map"], "source_type", "value")
    assert ("customer", "customer:50") in ids and not any("@" in v for _, v in ids)


def test_collections(shop):
    _, records = shop
    collections = by(records["collections"], "handle")
    assert collections["tops"].product_count == 1 and collections["jerseys"].product_count == 0
    assert codes(records)["empty_collection"] == sum(c.product_count == 0 for c in collections.values())


def test_suffixed_handle_counts_as_taken(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a-2"), (4, "b-9"), (9, "b"), (10, "b")], "id long, slug string")
    assert {r.id: r.handle for r in catalog.unique_handles(df, "slug", "id").collect()} == {1: "a", 2: "a-2", 3: "a-2-3", 4: "b-9", 9: "b", 10: "b-10"}


def test_duplicate_combination_and_open_variation(spark, tmp_path):
    entities = {
        "products": [{**shopdata.PRODUCTS[0], "attributes": [shopdata.attribute("Color", "Black", "Navy")], "variations": [1, 2, 3, 4]}],
        "variations": [
            shopdata.variant(1, 10, 3, "a", {"Color": "Black"}), shopdata.variant(2, 10, 1, "b", {"Color": "Black"}),
            shopdata.variant(3, 10, 2, "c", {"Color": ""}), shopdata.variant(4, 10, 4, "d", {"Color": "Navy"}, regular_price="", price="", weight="0"),
        ],
    }
    source = snapshot(spark, shopdata.write(tmp_path, entities))
    products = source["products"]
    options, _ = catalog.build_options(products, source["variations"])
    variants, raised = catalog.build_variants(products, catalog.classified_products(products), source["variations"], options, "s", max_group_rows=2)
    rows = {r.source.source_id: r for r in variants.collect()}
    assert {i: (r.position, r.held_reasons) for i, r in rows.items()} == {
        2: (1, []), 3: (2, ["variant_missing_option_value"]), 1: (3, ["duplicate_option_combination"]), 4: (4, ["variant_missing_price"]),
    }
    assert rows[4].weight_grams == 200
    message = raised.where(F.col("code") == "duplicate_option_combination").first()
    assert json.loads(message.detail)["first_variation_id"] == 2


def test_audit(spark, shop):
    source, records = shop
    report = quality.data_quality_report(source.tables)
    found = {(r.entity, r.id, r.field) for r in report.collect()}
    assert {("product", "11", "images"), ("product", "14", "type"), ("variation", "102", "sku"), ("variation", "103", "sku"), ("customer", "redacted", "email"), ("order", "72", "status"), ("post", "40", "x")} - found == {("post", "40", "x")}
    assert quality.report_order(report).first().severity == "high"
    inventory = {(r.entity, r.metric, r.value): r.n for r in quality.source_inventory(source.tables).collect()}
    assert inventory["variations", "max_per_product", ""] == 3 and inventory["skus", "duplicate_skus", ""] == 1 and inventory["orders", "guest_orders", ""] == 1
    assert inventory["line_item", "meta_key", "pa_size"] == 1
    used = {r.attachment_id: r.used_by_products for r in quality.media_inventory(source["media"], source["media_head"], quality.media_usage_by_product(source["products"], source["variations"])).collect()}
    assert used == {1: 1, 2: 1, 6: 0}
    patterns = [("^add-on", "line_item", "^pa_"), ("^Other", "line_item", "^pa_"), ("fields", "order", "^pa_")]
    keys = quality.meta_key_counts(source["orders"].select(F.explode("line_items.meta_data").alias("m")), "m", "line_item")
    prints = quality.plugin_fingerprints(source["plugins"], keys, patterns).collect()
    assert [(p.name, p.evidence, p.holds_data) for p in prints] == [("Add-on Fields & Co", 1, True)]
    held = {r.reason: r.n for r in quality.held_reason_counts(records["products"]).collect()}
    assert held == {"attribute_needs_decision": 1, "bundle_product": 1}
    content = quality.content_inventory(source["pages"], F.coalesce("content.raw", F.lit("")), shopdata.SITE, ["id"]).orderBy("id").first()
    assert (content.words, content.shortcodes, content.internal_links) == (2, "galleryx1", 1)


def test_handles_follow_any_number_of_suffix_steps(spark):
    slugs = ["x", "x", "x-2", "x-2-3", "x-2-3-4", "x-2-3-4-5"]
    df = spark.createDataFrame([(i + 1, s) for i, s in enumerate(slugs)], "id long, slug string")
    handles = {r.id: r.handle for r in catalog.unique_handles(df, "slug", "id").collect()}
    assert handles == {1: "x", 2: "x-2", 3: "x-2-3", 4: "x-2-3-4", 5: "x-2-3-4-5", 6: "x-2-3-4-5-6"}


def test_spellings_are_cleaned_once_a_product(spark):
    """Options see distinct spellings, entities and blanks included; duplicates are found without a sort aggregation."""
    from cartloom.functions.text import clean_text, clean_texts
    from cartloom.plans import bindings as b

    folder = "/root/testdata/sf0.001"
    options, _ = catalog.build_options(b.products(spark, folder), b.variations(spark, folder))
    plan = options._jdf.queryExecution().optimizedPlan().toString()
    # on the side of the variations, spellings are made distinct below the Python step
    side = plan[plan.index(" AS used#") :]
    side = side[side.index("\n") :]
    assert side.index("ArrowEvalPython") < side.index("Generate")
    assert "Aggregate [" in side[side.index("ArrowEvalPython") : side.index("Generate")]
    records, _ = catalog.build_variants(b.products(spark, folder), catalog.classified_products(b.products(spark, folder)), b.variations(spark, folder), options, "t")
    assert "SortAggregate" not in records._jdf.queryExecution().executedPlan().toString()
    rows = spark.createDataFrame([(["a", None, " b "], "x"), (["A &amp; B", None, "&lt;"], " &eacute; "), (None, None), ([], "&")], "vs array<string>, v string")
    got = [tuple(r) for r in rows.coalesce(1).select(clean_texts(F.col("vs")), clean_text(F.col("v"))).collect()]
    assert got == [(["a", "", "b"], "x"), (["A & B", "", "<"], "é"), ([], ""), ([], "&")]


def odd_variations(spark, folder):
    """A product with repeated, open and blank combinations, null orders, entities, and one whose variations leave all to it."""
    colours = ["Black", " Black ", "Navy &amp; Sand", "", "Black", "Navy &amp; Sand", None, "Red", "Red", "Black"]
    entities = {
        "products": [
            {**shopdata.PRODUCTS[0], "attributes": [shopdata.attribute("Color", "Black", "Red"), shopdata.attribute("Size", "36", "37")]},
            {**shopdata.PRODUCTS[1], "weight": "1.5", "manage_stock": True, "attributes": [shopdata.attribute("Color", "Gray", "Red")]}, shopdata.PRODUCTS[3],
        ],
        "variations": [
            shopdata.variant(i, 10, None if i % 4 == 0 else i % 3, " s&amp;t " if i % 2 else "", {"Color": c, "Size": "36" if i % 5 else "37"}, stock_quantity=i - 4)
            for i, c in enumerate(colours, 1)
        ]
        + [shopdata.variant(50 + i, 11, 0, "x", {"Color": "Gray" if i else "Red"}, regular_price="", price="", sale_price="") for i in range(3)],
    }
    return snapshot(spark, shopdata.write(folder, entities))


def test_variants_are_dealt_by_product_once(spark, tmp_path):
    """Numbering, the join and the search for repeated combinations share one shuffle of narrow rows, and no copy of all rows is written between them."""
    source = odd_variations(spark, tmp_path)
    products = source["products"]
    options, _ = catalog.build_options(products, source["variations"])
    classified = catalog.classified_products(products)
    records, raised = catalog.build_variants(products, classified, source["variations"], options, "s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on large tables
    try:
        plan = records._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan if "Exchange hashpartitioning" in line]
    assert sum("REPARTITION_BY_NUM" in line for line in dealt) == 1 and not any("_combination" in line for line in dealt)
    hot, hot_raised = catalog.build_variants(products, classified, source["variations"], options, "s", max_group_rows=3)
    text = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct("*"))).collect())
    assert text(records) == text(hot) and text(raised) == text(hot_raised)
    rows = {r.source.source_id: r for r in records.collect()}
    assert len(rows) == 14 and [i for i, r in sorted(rows.items(), key=lambda x: x[1].position) if r.product_id == 10] == [3, 4, 6, 8, 9, 1, 7, 10, 2, 5]
    # Black/36: 1, 2 (stripped); Black/37: 5, 10; Navy & Sand: 3, 6; Red: 8, 9; without a colour: 4, 7
    held = {i: r.held_reasons for i, r in rows.items() if r.held}
    assert {i for i, why in held.items() if why == ["duplicate_option_combination"]} == {2, 5, 6, 9, 52}
    assert {i for i, why in held.items() if why == ["variant_missing_option_value"]} >= {4, 7}
    assert (rows[3].sku, rows[4].sku, rows[1].inventory_quantity, rows[9].inventory_quantity) == ("s&t", "SKU-10-4", 0, 5)
    assert (rows[51].price, rows[51].weight_grams, rows[51].inventory_tracked) == (Decimal("55.50"), 1500, True)


def test_variants_read_twice_are_written_once(spark, tmp_path, monkeypatch):
    """Where records and exceptions are both read, the judged rows are written as columns once; neither judges or shuffles them again."""
    from cartloom import session
    from cartloom.operators.exceptions import exceptions_by_code
    from cartloom.plans import catalog as queries

    source = odd_variations(spark, tmp_path)
    products = source["products"]
    options, _ = catalog.build_options(products, source["variations"])
    given = products, catalog.classified_products(products), source["variations"], options, "s"
    copies = []
    records, raised = catalog.build_variants(*given, keep=lambda df: copies.append(session.stored(df)) or copies[-1])
    plain, plain_raised = catalog.build_variants(*given)
    text = lambda df: sorted(r[0] for r in df.select(F.to_json(F.struct("*"))).collect())
    assert len(copies) == 1 and text(records) == text(plain) and text(raised) == text(plain_raised)
    every = raised.unionByName(catalog.duplicate_sku_exceptions(records))
    plan = exceptions_by_code(every)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "ArrowEvalPython" not in plan and "parent_id" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    kept = []
    monkeypatch.setattr(queries, "stored", lambda df: kept.append(df.columns) or session.stored(df))
    counts = {r.code: r.n for r in queries.variant_exceptions(spark, "/root/testdata/sf0.001").collect()}
    assert len(kept) == 1 and counts["duplicate_option_combination"] > 0
