"""Ledger queries: upsert, diff, publish, verify, stale rows, membership, matching."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.money import cents
from cartloom.operators import ledger as lg
from cartloom.operators import ledger_store as store
from cartloom.operators import targets
from cartloom.plans.registry import query, table
from cartloom.session import checkpoint_dir, checkpointed, spread


def part_rows(spark: SparkSession, folder: str, price: Column) -> DataFrame:
    """``resource, key, id, checksum, payload`` of parts; the checksum covers name and price."""
    return table(spark, folder, "part").select(
        F.lit("Product").alias("resource"),
        F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("key"),
        (F.col("p_partkey") + 1).alias("id"),
        F.md5(F.concat_ws("|", "p_name", price.cast("string"))).alias("checksum"),
        F.to_json(F.struct(F.col("p_name").alias("title"), price.alias("price"))).alias("payload"),
        "p_brand",
        "p_type",
    )


def before(spark: SparkSession, folder: str) -> DataFrame:
    """Earlier version: without the brand that came later."""
    return part_rows(spark, folder, cents(F.col("p_retailprice"))).where(F.col("p_brand") != "Brand#7").drop("p_brand", "p_type")


def after(spark: SparkSession, folder: str) -> DataFrame:
    """Later version: promotion prices cut, one brand gone."""
    price = cents(F.col("p_retailprice"))
    now = F.when(F.col("p_type") == "PROMO", price - 1).otherwise(price).cast("decimal(18,2)")
    return part_rows(spark, folder, now).where(F.col("p_brand") != "Brand#3").drop("p_brand", "p_type")


@query(
    "snapshot_diff",
    """
    SELECT 'Product' AS resource, 'part-' || p_partkey AS key,
      CASE WHEN p_brand = 'Brand#7' THEN 'created' WHEN p_brand = 'Brand#3' THEN 'removed' WHEN p_type = 'PROMO' THEN 'changed' ELSE 'same' END AS change,
      p_brand NOT IN ('Brand#7', 'Brand#3') AS id_reused FROM part
    """,
)
def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    return lg.snapshot_diff(before(spark, folder), after(spark, folder))


@query(
    "diff_counts",
    """
    SELECT 'Product' AS resource, count(*) FILTER (WHERE p_brand = 'Brand#7') AS created,
      count(*) FILTER (WHERE p_type = 'PROMO' AND p_brand NOT IN ('Brand#7', 'Brand#3')) AS changed,
      count(*) FILTER (WHERE p_brand = 'Brand#3') AS removed, count(*) FILTER (WHERE p_brand NOT IN ('Brand#7', 'Brand#3')) AS ids_reused FROM part
    """,
)
def diff_counts(spark: SparkSession, folder: str) -> DataFrame:
    return lg.diff_counts(lg.snapshot_diff(before(spark, folder), after(spark, folder)))


UPSERT_SQL = """
    WITH p AS (SELECT 'part-' || p_partkey AS key, p_partkey + 1 AS old_id, p_brand, p_type FROM part WHERE p_brand <> 'Brand#3'),
    n AS (SELECT key, row_number() OVER (ORDER BY substr(md5(key), 1, 13), key) + (SELECT max(p_partkey + 1) FROM part WHERE p_brand <> 'Brand#7') AS new_id FROM p WHERE p_brand = 'Brand#7'),
    o AS (SELECT 'Product' AS resource, p.key, coalesce(new_id, old_id) AS id,
      CASE WHEN p_brand = 'Brand#7' THEN 'created' WHEN p_type = 'PROMO' THEN 'updated' ELSE 'unchanged' END AS outcome FROM p LEFT JOIN n ON n.key = p.key)
"""


def merged(spark: SparkSession, folder: str) -> DataFrame:
    return lg.upsert(before(spark, folder), after(spark, folder).drop("id"))


@query("upsert_outcomes", UPSERT_SQL + "SELECT * FROM o")
def upsert_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Outcome and id of every loaded part; new ids follow the hash order of their keys."""
    return lg.outcomes(merged(spark, folder))


@query(
    "per_resource_outcomes",
    UPSERT_SQL
    + """
    SELECT resource, count(*) FILTER (WHERE outcome = 'created') AS created, count(*) FILTER (WHERE outcome = 'updated') AS updated,
      count(*) FILTER (WHERE outcome = 'unchanged') AS unchanged, count(*) FILTER (WHERE outcome = 'failed') AS failed FROM o GROUP BY 1
    """,
)
def per_resource_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return lg.per_resource_outcomes(lg.outcomes(merged(spark, folder)))


@query("retry_failed", "SELECT 'Product' AS resource, 'part-' || p_partkey AS key FROM part WHERE p_brand = 'Brand#7'")
def retry_failed(spark: SparkSession, folder: str) -> DataFrame:
    """A run in which every new part fails on the target: just those rows are tried again."""
    batch = after(spark, folder).drop("id")
    old = before(spark, folder)
    known = old.select("resource", "key", F.lit(True).alias("applied"))
    tried = batch.join(known, ["resource", "key"], "left").withColumn("applied", F.coalesce("applied", F.lit(False)))
    results = lg.outcomes(lg.upsert(old, tried))
    return lg.retry_failed(results, batch).select("resource", "key")


def store_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger of parts, their supplier variants (two suppliers may share a target id) and stock."""
    part = table(spark, folder, "part").select(
        F.lit("Product").alias("resource"), F.col("p_partkey").cast("string").alias("key"), F.col("p_partkey").alias("id"), F.lit("").alias("checksum"),
        F.to_json(
            F.struct(
                F.col("p_partkey").cast("string").alias("handle"), F.col("p_name").alias("title"), F.lit("DRAFT").alias("status"),
                F.when(F.col("p_type") == "SMALL", "draft").otherwise("publish").alias("source_status"),
            )
        ).alias("payload"),
    )
    pairs = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey").distinct()
    slot = F.col("l_partkey") * 1000 + F.floor(F.col("l_suppkey") / 10)

    def child(resource: str, base: int) -> DataFrame:
        return pairs.select(
            F.lit(resource).alias("resource"), F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("key"),
            (slot + base).alias("id"), F.lit("").alias("checksum"),
            F.to_json(F.struct(F.col("l_partkey").cast("string").alias("product_handle"))).alias("payload"),
        )

    return part.unionByName(child("ProductVariant", 10**10)).unionByName(child("InventoryItem", 2 * 10**10))


def live_products(spark: SparkSession, folder: str) -> DataFrame:
    """Store state: one brand was deleted, some parts are published, some were renamed."""
    return table(spark, folder, "part").where(F.col("p_brand") != "Brand#9").select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").cast("string").alias("handle"),
        F.when(F.col("p_type") == "LARGE", F.upper("p_name")).otherwise(F.col("p_name")).alias("title"),
        F.when(F.col("p_size") > 25, "ACTIVE").otherwise("DRAFT").alias("status"),
        (F.col("p_size") > 10).alias("published"),
    )


@query(
    "publish_plan",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS key,
      CASE WHEN p_brand = 'Brand#9' THEN '' ELSE concat_ws(',', CASE WHEN p_size <= 10 THEN 'publish' END, CASE WHEN p_type <> 'SMALL' AND p_size <= 25 THEN 'activate' END) END AS actions,
      CASE WHEN p_brand = 'Brand#9' THEN 'missing' WHEN p_size <= 10 OR (p_type <> 'SMALL' AND p_size <= 25) THEN 'change' ELSE 'unchanged' END AS verdict
    FROM part
    """,
)
def publish_plan(spark: SparkSession, folder: str) -> DataFrame:
    plan = targets.publish_plan(store_ledger(spark, folder), live_products(spark, folder), activate=True)
    return plan.select("key", F.array_join("actions", ",").alias("actions"), "verdict")


@query(
    "verify_ledger",
    """
    WITH n AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1),
    v AS (SELECT DISTINCT l_partkey || '-' || l_suppkey AS key, l_partkey * 1000 + l_suppkey // 10 AS slot FROM lineitem)
    SELECT 'missing' AS finding, 'Product' AS resource, CAST(p_partkey AS VARCHAR) AS key, false AS noted FROM part WHERE p_brand = 'Brand#9'
    UNION ALL SELECT 'missing', resource, key, false FROM v CROSS JOIN (VALUES ('ProductVariant'), ('InventoryItem')) t(resource) WHERE slot % 3 = 0
    UNION ALL SELECT 'variant_count_mismatch', 'Product', CAST(p_partkey AS VARCHAR), false FROM part JOIN n ON l_partkey = p_partkey WHERE p_brand <> 'Brand#9' AND n <> p_size
    UNION ALL SELECT 'field_drift', 'Product', CAST(p_partkey AS VARCHAR), p_type <> 'LARGE' FROM part WHERE p_brand <> 'Brand#9' AND (p_type = 'LARGE' OR p_size > 25)
    """,
)
def verify_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Every ledger row compared with the store: a product's variant count is the part's size, and every third
    variant slot, with its stock, was deleted."""
    sizes = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("bigint").alias("variants_count"))
    slot = F.col("l_partkey") * 1000 + F.floor(F.col("l_suppkey") / 10)
    slots = table(spark, folder, "lineitem").where(slot % 3 != 0).select(slot.alias("slot")).distinct()
    children = slots.select(F.explode(F.array(F.col("slot") + 10**10, F.col("slot") + 2 * 10**10)).alias("id"))
    live = live_products(spark, folder).join(sizes, "id").unionByName(children, allowMissingColumns=True)
    findings = targets.verify_ledger(store_ledger(spark, folder), live)
    noted = F.coalesce(F.get_json_object("detail", "$.note").isNotNull(), F.lit(False))
    return findings.select("finding", "resource", "key", noted.alias("noted"))


STALE_SQL = """
    WITH v AS (SELECT DISTINCT l_partkey, l_suppkey, l_partkey * 1000 + l_suppkey // 10 AS slot FROM lineitem),
    s AS (SELECT v.*, s_acctbal >= 0 AS loaded, s_nationkey FROM v JOIN supplier ON s_suppkey = l_suppkey),
    k AS (SELECT slot, min(l_partkey || '-' || l_suppkey) AS kept FROM s WHERE loaded GROUP BY 1),
    j AS (SELECT l_partkey || '-' || l_suppkey AS key, slot, kept, s_nationkey = 3 OR slot IN (SELECT slot FROM s WHERE s_nationkey = 3) AS gone FROM s LEFT JOIN k USING (slot) WHERE NOT loaded),
    r AS (SELECT key, CASE WHEN gone THEN 'not_on_store' WHEN kept IS NOT NULL THEN 'collapsed_onto_loaded_variant' ELSE 'live_but_held' END AS verdict, kept FROM j)
    SELECT resource, key, verdict, CASE WHEN verdict = 'collapsed_onto_loaded_variant' THEN kept END AS kept_key
    FROM r CROSS JOIN (VALUES ('ProductVariant'), ('InventoryItem')) t(resource) WHERE resource = 'ProductVariant' OR verdict <> 'live_but_held'
"""


def stale(spark: SparkSession, folder: str) -> DataFrame:
    book = store_ledger(spark, folder)
    suppliers = table(spark, folder, "supplier")
    pairs = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey").distinct().join(
        suppliers.select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal", "s_nationkey"), "l_suppkey"
    )
    key = F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("key")
    loaded = pairs.where(F.col("s_acctbal") >= 0).select(key)
    slot = F.col("l_partkey") * 1000 + F.floor(F.col("l_suppkey") / 10)
    lost = pairs.where(F.col("s_nationkey") == 3).select(F.explode(F.array(slot + 10**10, slot + 2 * 10**10)).alias("id"))
    # an outer join stays above the union of the ledger
    live = spread(book.select("id"), "id").join(lost.withColumn("_lost", F.lit(True)), "id", "left").where(F.col("_lost").isNull()).select("id")
    return targets.stale_plan(book, loaded, live)


@query("stale_plan", STALE_SQL)
def stale_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Variants of suppliers in debt are held now; objects of one nation are gone from the store."""
    return stale(spark, folder).select("resource", "key", "verdict", "kept_key")


@query(
    "prune",
    f"""
    WITH p AS ({STALE_SQL}), v AS (SELECT DISTINCT l_partkey || '-' || l_suppkey AS key FROM lineitem),
    l AS (SELECT 'Product' AS resource, CAST(p_partkey AS VARCHAR) AS key FROM part UNION ALL SELECT 'ProductVariant', key FROM v UNION ALL SELECT 'InventoryItem', key FROM v)
    SELECT resource, count(*) AS n FROM l WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.resource = l.resource AND p.key = l.key AND verdict <> 'live_but_held') GROUP BY 1
    """,
)
def prune(spark: SparkSession, folder: str) -> DataFrame:
    left = targets.prune(store_ledger(spark, folder), stale(spark, folder))
    return left.groupBy("resource").agg(F.count(F.lit(1)).alias("n"))


@query(
    "purge_plan",
    "SELECT CAST(5 AS INT) AS step, 'Product' AS resource, count(*) AS planned FROM part",
)
def purge_plan(spark: SparkSession, folder: str) -> DataFrame:
    return targets.purge_counts(targets.purge_plan(store_ledger(spark, folder)))


@query(
    "membership_delta",
    """
    WITH w AS (SELECT p_type AS collection, p_partkey AS product FROM part),
    c AS (SELECT CASE WHEN p_size > 40 THEN 'LARGE' ELSE p_type END AS collection, p_partkey AS product FROM part WHERE p_brand <> 'Brand#5')
    SELECT collection, product, 'add' AS action FROM (SELECT * FROM w EXCEPT SELECT * FROM c)
    UNION ALL SELECT collection, product, 'remove' FROM (SELECT * FROM c EXCEPT SELECT * FROM w) WHERE product IN (SELECT p_partkey FROM part WHERE p_brand <> 'Brand#2')
    """,
)
def membership_delta(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    wanted = part.select(F.col("p_type").alias("collection"), F.col("p_partkey").alias("product"))
    current = part.where(F.col("p_brand") != "Brand#5").select(
        F.when(F.col("p_size") > 40, "LARGE").otherwise(F.col("p_type")).alias("collection"), F.col("p_partkey").alias("product")
    )
    ours = part.where(F.col("p_brand") != "Brand#2").select(F.col("p_partkey").alias("product"))
    return targets.membership_delta(wanted, current, ours)


@query(
    "inventory_adjustments",
    """
    WITH q AS (SELECT l_partkey AS item_id, CAST(l_suppkey AS VARCHAR) AS location, CAST(sum(l_quantity) AS INT) AS wanted,
        CAST(coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) AS INT) AS now FROM lineitem GROUP BY 1, 2)
    SELECT item_id, location, now AS from_quantity, wanted AS to_quantity, sha1('shop/' || item_id || '/' || location || '/' || now || '->' || wanted) AS idempotency_key FROM q WHERE now <> wanted
    """,
)
def inventory_adjustments(spark: SparkSession, folder: str) -> DataFrame:
    """Stock to set: all ordered units, of which the closed lines are there."""
    lines = table(spark, folder, "lineitem")
    keys = [F.col("l_partkey").alias("item_id"), F.col("l_suppkey").cast("string").alias("location")]
    wanted = lines.groupBy(*keys).agg(F.sum("l_quantity").cast("int").alias("quantity")).withColumn("tracked", F.lit(True))
    current = lines.where(F.col("l_linestatus") == "F").groupBy(*keys).agg(F.sum("l_quantity").cast("int").alias("quantity"))
    return targets.inventory_adjustments(wanted, current, "shop")


@query(
    "placeholder_variants",
    """
    WITH l AS (SELECT l_partkey AS product_id, l_suppkey AS id, bool_or(l_linestatus = 'O') AS claimed FROM lineitem GROUP BY 1, 2),
    k AS (SELECT product_id FROM l GROUP BY 1 HAVING bool_or(claimed) AND bool_or(NOT claimed))
    SELECT product_id, product_id * 1000000 + id AS id FROM l WHERE NOT claimed AND product_id IN (SELECT product_id FROM k)
    """,
)
def placeholder_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Variants without an open line are nobody's; a part with no other keeps them."""
    pairs = table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.bool_or(F.col("l_linestatus") == "O").alias("claimed"))
    live = pairs.select(
        F.col("l_partkey").alias("product_id"), (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("id"), F.lit(None).cast("string").alias("source_id"), "claimed"
    )
    ours = live.where("claimed").select(F.lit("ProductVariant").alias("resource"), "id")
    return targets.placeholder_variants(live.drop("claimed"), ours)


@query(
    "match_live_variants",
    """
    WITH l AS (SELECT l_partkey AS product_id, l_suppkey, min(l_linenumber) AS lo, max(l_linenumber) AS hi, bool_or(l_returnflag = 'R') AS known, bool_or(l_returnflag = 'N') AS traced FROM lineitem GROUP BY 1, 2),
    o AS (SELECT product_id, lo, hi, min(product_id * 1000000 + l_suppkey) AS id FROM l GROUP BY 1, 2, 3)
    SELECT product_id, CAST(l_suppkey AS VARCHAR) AS key, CASE WHEN known OR traced THEN product_id * 1000000 + l_suppkey ELSE id END AS live_id,
      CASE WHEN known THEN 'id' WHEN traced THEN 'source_id' ELSE 'options' END AS how
    FROM l JOIN o USING (product_id, lo, hi)
    """,
)
def match_live_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier variants matched to live ones by id, by source id, else by the same option set."""
    pairs = table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"),
        F.bool_or(F.col("l_returnflag") == "R").alias("known"), F.bool_or(F.col("l_returnflag") == "N").alias("traced"),
    )
    id_ = F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")
    option = lambda n, c: F.struct(F.lit(n).alias("name"), F.col(c).cast("string").alias("value"))
    source = F.when(F.col("traced"), F.col("l_suppkey").cast("string")).alias("source_id")
    wanted = pairs.select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").cast("string").alias("key"), F.when(F.col("known"), id_).alias("known_id"), source,
        F.array(option("low", "lo"), option("high", "hi")).alias("option_values"),
    )
    live = pairs.select(
        F.col("l_partkey").alias("product_id"), id_.alias("id"), source, F.array(option("high", "hi"), option("low", "lo")).alias("option_values")
    )
    return targets.match_live_variants(wanted, live)


@query(
    "media_reuse_match",
    """
    SELECT p_partkey AS product_id, CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_type <> 'PROMO' AND p_brand <> 'Brand#8' THEN p_partkey END AS live_id FROM part
    """,
)
def media_reuse_match(spark: SparkSession, folder: str) -> DataFrame:
    """Uploads found again under their name plus a suffix; one brand's are claimed, promotions have
    another name."""
    part = table(spark, folder, "part")
    wanted = part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_partkey").cast("string").alias("key"), F.concat(F.lit("https://a.example/Shot-of-"), F.translate("p_name", " ", "-"), F.lit("_z.JPG")).alias("url")
    )
    suffix = F.concat(F.lit("_"), F.substring(F.md5("p_name"), 1, 8))
    name = F.when(F.col("p_type") == "PROMO", F.lit("other")).otherwise(F.concat(F.lit("shotof"), F.translate("p_name", " ", ""), F.lit("z")))
    live = part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_partkey").alias("id"), F.concat(F.lit("https://cdn.example/"), name, suffix, F.lit(".jpg?v=1")).alias("url")
    )
    claimed = part.where(F.col("p_brand") == "Brand#8").select(F.lit("MediaImage").alias("resource"), F.col("p_partkey").alias("id"))
    return targets.media_reuse_match(wanted, live, claimed)


@query(
    "ledger_store",
    """
    WITH b AS (SELECT o_orderkey AS k, 'order-' || o_orderkey AS key, CAST(unnest(CASE WHEN o_orderkey % 5 = 0 THEN [1, 2, 3] WHEN o_orderkey % 3 = 0 THEN [0, 2] WHEN o_orderkey % 7 = 0 THEN [3] ELSE [0] END) AS INT) AS n,
        o_orderstatus AS payload FROM orders),
    f AS (SELECT key, min(n) AS first, max(n) AS last, arg_max(payload, n) AS payload FROM b GROUP BY key),
    i AS (SELECT *, row_number() OVER (ORDER BY first, substr(md5(key), 1, 13), key) AS id FROM f)
    SELECT 'Order' AS resource, key, id, md5(payload || CASE WHEN last = 2 THEN '0' ELSE CAST(last AS VARCHAR) END) AS checksum, payload FROM i
    """,
)
def ledger_store(spark: SparkSession, folder: str) -> DataFrame:
    """All orders loaded in four batches that overlap, with compaction: the store's ledger at the end. Batch 2 brings
    the checksums of batch 0, so rows that it finds unchanged write nothing."""
    k = F.col("o_orderkey")
    turns = F.when(k % 5 == 0, F.array(*map(F.lit, (1, 2, 3)))).when(k % 3 == 0, F.array(F.lit(0), F.lit(2))).when(k % 7 == 0, F.array(F.lit(3))).otherwise(F.array(F.lit(0)))
    rows = table(spark, folder, "orders").select(
        F.lit("Order").alias("resource"), F.concat(F.lit("order-"), k).alias("key"), F.col("o_orderstatus").alias("payload"), F.explode(turns).alias("n"))
    mark = F.when(F.col("n") == 2, 0).otherwise(F.col("n")).cast("string")
    rows = checkpointed(rows.withColumn("checksum", F.md5(F.concat("payload", mark))))
    at = f"{checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
    for n in range(4):
        store.apply_batch(at, rows.where(F.col("n") == n).drop("n"), "load", n, fanout=3, buckets=8)
    return store.read_store(spark, at)
