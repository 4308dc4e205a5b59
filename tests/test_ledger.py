"""Loads are idempotent, deltas exact, failures retried, plans right."""

import pytest
from pyspark.sql import functions as F

from cartloom.operators import ledger as lg
from cartloom.operators import media, quality, targets
from cartloom.operators.transform import body_docs
from cartloom.operators.ledger_store import read_store
from cartloom.streaming.jobs import ledger_writer

CDN = "https://cdn.invalid/files"


def load(spark, records, ledger, **kwargs):
    return lg.load_all(records, ledger, body_refs=records["body_refs"], urls_of=lambda book: media.target_urls(book, CDN), **kwargs)


def empty(spark):
    return lg.read_ledger(spark, "/nowhere", None)


@pytest.fixture(scope="module")
def loaded(spark, shop):
    run = load(spark, shop[1], empty(spark))
    return {k: v.cache() for k, v in run.items()}


def tally(results):
    return {r.outcome: r.n for r in results.groupBy("outcome").agg(F.count("*").alias("n")).collect()}


def test_first_load_creates_and_holds(spark, shop, loaded):
    assert set(tally(loaded["results"])) == {"created"}
    book = loaded["ledger"]
    assert book.count() == loaded["results"].count() == book.select("resource", "id").distinct().count()
    products = {r.key for r in book.where("resource = 'Product'").collect()}
    assert products == {"beach-tee", "beach-tee-12", "plain-sock"}
    held = {(r.record_type, r.record_ref) for r in loaded["exceptions"].collect()}
    assert ("product", "kit-jersey") in held and ("page", "cart-2") in held
    index = {(r["index"], r.key) for r in lg.ledger_index(book).collect()}
    assert ("variant_sku", "TEE-1") in index and ("customer_source_id", "50") in index and not any("@" in k for _, k in index)


def test_bodies_point_at_the_new_files(spark, shop, loaded):
    page = loaded["ledger"].where("resource = 'Page'").first()
    assert CDN in page.payload and "tee-300x200" not in page.payload and "srcset" not in page.payload and "sizes" not in page.payload
    docs = loaded["ledger"].where("resource = 'Page'").select(F.col("key").alias("handle"), F.get_json_object("payload", "$.body_html").alias("body_html"))
    assert media.residual_references(docs, shop[1]["upload_hosts"], "old-shop.invalid", ["handle"]).count() == 0


def test_rerun_changes_nothing(spark, shop, loaded):
    again = load(spark, shop[1], loaded["ledger"])
    assert tally(again["results"]) == {"unchanged": loaded["results"].count()}
    diff = lg.diff_counts(lg.snapshot_diff(loaded["ledger"], again["ledger"])).agg(*[F.sum(c) for c in ("created", "changed", "removed", "ids_reused")]).first()
    assert tuple(diff) == (0, 0, 0, loaded["ledger"].count())


def test_delta_is_exact(spark, loaded):
    """Five known edits and three new rows."""
    book = loaded["ledger"]
    edited = book.orderBy("resource", "key").limit(5).select("resource", "key")
    batch = book.join(edited.withColumn("_e", F.lit(True)), ["resource", "key"], "left").select(
        "resource", "key", F.when(F.col("_e"), F.lit("edited")).otherwise(F.col("checksum")).alias("checksum"), "payload"
    )
    new = spark.createDataFrame([("Product", f"new-{i}", f"c{i}", "{}") for i in range(3)], "resource string, key string, checksum string, payload string")
    merged = lg.upsert(book, batch.unionByName(new), max_group_rows=1)
    after = lg.next_version(merged)
    diff = lg.diff_counts(lg.snapshot_diff(book, after)).agg(*[F.sum(c) for c in ("created", "changed", "removed", "ids_reused")]).first()
    assert tuple(diff) == (3, 5, 0, book.count())
    top = book.where("resource = 'Product'").agg(F.max("id")).first()[0]
    assert sorted(r.id for r in after.where("key like 'new-%'").collect()) == [top + 1, top + 2, top + 3]


def test_failed_rows_are_retried_alone(spark, loaded):
    rows = "resource string, key string, checksum string, payload string, applied boolean"
    batch = spark.createDataFrame([("Page", "a", "1", "{}", True), ("Page", "b", "1", "{}", False)], rows)
    first = lg.upsert(empty(spark), batch)
    assert tally(lg.outcomes(first)) == {"created": 1, "failed": 1}
    retry = lg.retry_failed(lg.outcomes(first), batch).withColumn("applied", F.lit(True))
    assert [r.key for r in retry.collect()] == ["b"]
    second = lg.upsert(lg.next_version(first), retry)
    assert tally(lg.outcomes(second)) == {"created": 1} and lg.next_version(second).count() == 2
    # a failed change keeps the old entry
    worse = spark.createDataFrame([("Page", "a", "2", "{x}", False)], rows)
    kept = lg.next_version(lg.upsert(lg.next_version(first), worse)).where("key = 'a'").first()
    assert kept.checksum == "1"


def test_pruned_ids_are_not_reused(spark):
    batch = spark.createDataFrame([("Page", "z", "1", "{}")], "resource string, key string, checksum string, payload string")
    counters = spark.createDataFrame([("Page", 41)], "resource string, last_id long")
    assert lg.next_version(lg.upsert(empty(spark), batch, counters)).first().id == 42


def test_scope_and_types(spark, shop):
    scope = spark.createDataFrame([("plain-sock",)], "product_handle string")
    run = load(spark, shop[1], empty(spark), scope=scope, skip=["customers", "discounts"])
    keys = {(r.resource, r.key) for r in run["ledger"].collect()}
    assert {k for r, k in keys if r == "Product"} == {"plain-sock"}
    assert {k for r, k in keys if r == "CollectionMembership"} == {"accessories:plain-sock"} and not any(r == "Customer" for r, _ in keys)


def test_versions_and_stream_writer(spark, tmp_path, loaded):
    folder = str(tmp_path / "book")
    lg.write_ledger(loaded["ledger"], folder, "v1")
    assert lg.read_ledger(spark, folder, "v1").count() == loaded["ledger"].count()
    write = ledger_writer(str(tmp_path / "stream"))
    rows = "seq long, resource string, key string, checksum string, payload string"
    write(spark.createDataFrame([(1, "Page", "a", "1", "{}"), (2, "Page", "a", "2", "{}"), (3, "Page", "b", "1", "{}")], rows), 0)
    batch = spark.createDataFrame([(4, "Page", "b", "9", "{}"), (5, "Page", "c", "1", "{}")], rows)
    write(batch, 1)
    once = sorted(map(tuple, read_store(spark, str(tmp_path / "stream")).collect()))
    write(batch, 1)
    assert once == sorted(map(tuple, read_store(spark, str(tmp_path / "stream")).collect()))
    assert {(r[1], r[3]) for r in once} == {("a", "2"), ("b", "9"), ("c", "1")}


def test_reconciliation(spark, shop, loaded):
    source, records = shop
    docs = loaded["ledger"].where("resource in ('Page', 'Article')").select(F.col("key").alias("handle"), F.get_json_object("payload", "$.body_html").alias("body_html"))
    residual = media.residual_references(docs, records["upload_hosts"], "old-shop.invalid", ["handle"])
    checks = {r.check: r for r in quality.reconcile_catalog(source.tables, records, loaded["ledger"], records["exceptions"], residual, "AUD").collect()}
    # the rejected second user of an e-mail has an address, which nothing explains
    assert [c for c, r in checks.items() if r.status == "mismatch"] == ["customer_with_default_address"]
    assert (checks["product_count_total"].source, checks["product_count_total"].target, checks["product_count_total"].held) == (5, 3, 2)
    assert checks["variant_price_field_mismatches"].status == "match" and checks["collection_membership_rows"].status == "match"
    assert checks["product_count_total"].status == "explained" and len(checks) >= 40
    strict = quality.reconcile_catalog(source.tables, records, loaded["ledger"], records["exceptions"], residual, "AUD", strict=True)
    assert strict.where("check = 'product_count_total'").first().status == "mismatch"
    differs = quality.variant_count_differences(source["variations"], records["products"], records["variants"].where("not held")).collect()
    assert [(d.handle, d.source, d.target) for d in differs] == [("kit-jersey", 2, 0)]
    assert body_docs(records).count() == 3


def test_option_conflicts(spark):
    names = "product_id long, option_names array<string>"
    live = spark.createDataFrame([(1, ["Colour", "Size"]), (2, ["Title"]), (3, ["Size", "Colour"])], names)
    wanted = spark.createDataFrame([(1, ["Colour", "Size"]), (2, []), (3, ["Colour", "Size"])], names)
    assert [r.product_id for r in targets.option_conflicts(live, wanted).collect()] == [3]


def test_media_by_name_and_redaction(spark):
    wanted = spark.createDataFrame([("k", "a.jpg"), ("l", "b.jpg")], "key string, filename string")
    live = spark.createDataFrame([(2, "a.jpg"), (1, "a.jpg")], "id long, filename string")
    assert {(r.key, r.live_id) for r in targets.media_by_name(wanted, live).collect()} == {("k", 1), ("l", None)}
    rows = spark.createDataFrame([("customer", "5", "x@y.z"), ("page", "6", "about")], "record_type string, record_id string, record_ref string")
    assert {r.record_ref for r in quality.redact(rows).collect()} == {"customer:5", "about"}


def test_media_suffix_match_against_brute_force(spark):
    import re

    wanted = [(1, f"w{i}", f"https://a/{s}.jpg") for i, s in enumerate(["shirt", "shirt-a", "ab", "zz"])]
    live = [(1, i, f"https://c/{s}.jpg") for i, s in enumerate(["shirt_0f", "shirta", "abc", "ab" + "f" * 32, "ab" + "f" * 33, "other"], 1)]
    stem = lambda u: re.sub("[^a-z0-9]", "", u.rsplit("/", 1)[-1].rsplit(".", 1)[0].lower())
    expected = {
        k: min([i for _, i, u in live if stem(u) == stem(w) or re.fullmatch(re.escape(stem(w)) + "[0-9a-f]{1,32}", stem(u))], default=None)
        for _, k, w in wanted
    }
    none = spark.createDataFrame([], lg.LEDGER)
    got = targets.media_reuse_match(
        spark.createDataFrame(wanted, "product_id long, key string, url string"), spark.createDataFrame(live, "product_id long, id long, url string"), none
    )
    assert {r.key: r.live_id for r in got.collect()} == expected


def test_media_suffix_match_sends_no_stems_to_the_driver(spark):
    wanted = spark.range(50).select(F.col("id").alias("product_id"), F.col("id").cast("string").alias("key"), F.lit("https://a/shirtz.jpg").alias("url"))
    live = spark.range(50).select(F.col("id").alias("product_id"), "id", F.lit("https://c/shirtz_0123abcd.jpg").alias("url"))
    claimed = spark.createDataFrame([("MediaImage", 7)], "resource string, id long")
    got = targets.media_reuse_match(wanted, live, claimed)
    # below the join with the candidates, the claimed ids may be broadcast
    assert got._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin [product_id") == 1
    assert {r.product_id: r.live_id for r in got.collect()} == {n: None if n == 7 else n for n in range(50)}


def test_stale_plan_reads_the_ledger_once(spark, tmp_path):
    """Against a plain reading, with missing handles and ids and with a scope."""
    from itertools import product

    book = [("Product", "p", 1, "p")]
    for resource, base in (("ProductVariant", 100), ("InventoryItem", 200)):
        for n in range(60):
            book.append((resource, f"k{n}", None if n == 59 else base + n // 3, None if n % 7 == 0 else f"h{n % 5}"))
    rows = [(r, k, i, "c", "{}" if h is None else f'{{"product_handle":"{h}"}}') for r, k, i, h in book]
    spark.createDataFrame(rows, "resource string, key string, id long, checksum string, payload string").write.parquet(f"{tmp_path}/ledger")
    ledger = spark.read.parquet(f"{tmp_path}/ledger")
    loaded = {f"k{n}" for n in range(60) if n % 4 == 0 or n > 50} - {"k59"}
    live = {100 + n for n in range(20) if n % 6} | {200 + n for n in range(20) if n % 5}
    frames = spark.createDataFrame([(k,) for k in [*loaded, *loaded]], "key string"), spark.createDataFrame([(i,) for i in live], "id long")

    def plain(names):
        out, gone = set(), {}
        for resource, (r, k, i, h) in product(("ProductVariant", "InventoryItem"), book):
            if r != resource or k in loaded or (r == "ProductVariant" and names is not None and h not in names):
                continue
            kept = min((b for a, b, j, _ in book if a == r and b in loaded and j == i), default=None)
            verdict = "not_on_store" if i not in live else "collapsed_onto_loaded_variant" if kept else "live_but_held"
            if r == "ProductVariant" and verdict != "live_but_held":
                gone[k] = h
            if r == "ProductVariant" or k in gone:
                out.add((r, k, i, h if r == "ProductVariant" else gone[k], verdict, kept if verdict.startswith("collapsed") else None))
        return out

    for names in (None, {"h1", "h3"}):
        scope = None if names is None else spark.createDataFrame([(h,) for h in [*names, *names]], "product_handle string")
        plan = targets.stale_plan(ledger, *frames, scope)
        got = [tuple(r) for r in plan.collect()]
        assert len(got) == len(set(got)) and set(got) == plain(names) and {g[4] for g in got} == {"not_on_store", "collapsed_onto_loaded_variant", "live_but_held"}
        assert plan._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1


def test_prune_judges_stale_rows_once(spark, tmp_path):
    """Against a plain reading; loaded keys, live ids and rows of the plan repeat, some keys and ids are missing."""
    schema = "resource string, key string, id long, checksum string, payload string"
    book = [("Product", f"k{n}", n, "c", "{}") for n in range(5)]
    for resource, base in (("ProductVariant", 100), ("InventoryItem", 200)):
        book += [(resource, None if n == 11 else f"k{n}", None if n == 10 else base + n // 2, "c", '{"product_handle":"h"}') for n in range(12)]
    spark.createDataFrame(book, schema).write.parquet(f"{tmp_path}/ledger")
    rows = spark.read.parquet(f"{tmp_path}/ledger")
    ledger = rows.where("resource = 'Product'").unionByName(rows.where("resource = 'ProductVariant'")).unionByName(rows.where("resource = 'InventoryItem'"))
    loaded, live = ["k0", "k4", "k4", "k6", "k8", None], [100, 101, 101, 102, 104, 105, 200, 201, 202, 205, None]
    plan = targets.stale_plan(rows, spark.createDataFrame([(k,) for k in loaded], "key string"), spark.createDataFrame([(i,) for i in live], "id long"))
    # loaded keys and live ids go through the same passes, without joins and tables of distinct values
    made = plan._jdf.queryExecution().sparkPlan().toString()
    assert made.count("FileScan parquet") == 1 and "Join" not in made and "Aggregate" not in made

    def plain(resource):
        out = {}
        for r, k, i, *_ in book:
            if r == resource and (k is None or k not in loaded):
                shared = any(a == r and b is not None and b in loaded and i is not None and j == i for a, b, j, *_ in book)
                out[k] = "not_on_store" if i is None or i not in live else "collapsed_onto_loaded_variant" if shared else "live_but_held"
        return out

    variants = plain("ProductVariant")
    dropped = {("ProductVariant", k) for k, v in variants.items() if v != "live_but_held" and k is not None}
    stock = {k: v for k, v in plain("InventoryItem").items() if ("ProductVariant", k) in dropped}
    dropped |= {("InventoryItem", k) for k, v in stock.items() if v != "live_but_held"}
    got = plan.select("resource", "key", "verdict").collect()
    assert {tuple(r) for r in got} == {("ProductVariant", *x) for x in variants.items()} | {("InventoryItem", *x) for x in stock.items()}
    assert {r.verdict for r in got} == {"not_on_store", "collapsed_onto_loaded_variant", "live_but_held"}
    left = targets.prune(ledger, plan)
    assert left.columns == ledger.columns and left._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 3 + 1
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, left.collect()), key=key) == sorted((r for r in book if r[:2] not in dropped), key=key)
    twice = targets.prune(ledger, plan.unionByName(plan))
    assert twice.count() == left.count() == len(book) - len(dropped)
