"""Plans from ledger and live state. Live state is a stored table; nothing here talks to a store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.functions.text import file_stem
from cartloom.operators.exceptions import union_all

# Fixed values.
PURGE_ORDER = [
    "DiscountCodeNode", "Customer", "Article", "Page", "Product", "Collection", "File",
    "Blog", "MetafieldDefinition",
]


def field(name: str, payload: str = "payload") -> Column:
    return F.get_json_object(payload, f"$.{name}")


def publish_plan(
    ledger: DataFrame, live: DataFrame, activate: bool = False, scope: DataFrame | None = None
) -> DataFrame:
    """What publishing needs per object: actions, or why none.

    ``live``: ``id, status, published`` of objects that exist. A ``scope`` of product handles leaves
    collections out. Source drafts stay drafts whatever ``activate`` says.
    """
    kinds = ["Product"] if scope is not None else ["Product", "Collection"]
    targets = ledger.where(F.col("resource").isin(*kinds)).select(
        "resource", "key", "id", F.when(F.col("resource") == "Product", field("source_status")).alias("source_status")
    )
    if scope is not None:
        targets = targets.join(scope.select(F.col("product_handle").alias("key")).distinct(), "key", "left_semi")
    state = live.select("id", F.col("status").alias("live_status"), "published", F.lit(True).alias("_found"))
    wants = F.lit(activate) & (F.col("resource") == "Product") & F.coalesce(F.col("source_status") == "publish", F.lit(False))
    found = F.col("_found").isNotNull()
    shown = F.coalesce("published", F.lit(False))
    actions = F.array_compact(
        F.array(
            F.when(found & ~shown, "publish"),
            F.when(found & wants & ~F.col("live_status").eqNullSafe("ACTIVE"), "activate"),
        )
    )
    verdict = F.when(~found, "missing").when(F.size("actions") == 0, "unchanged").otherwise("change")
    return (
        targets.join(state, "id", "left")
        .withColumn("actions", actions)
        .select("resource", "key", "id", "source_status", "live_status", shown.alias("published"), "actions", verdict.alias("verdict"))
    )


def publish_counts(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.array_contains("actions", "publish"), 1)).alias("publish"),
        F.count(F.when(F.array_contains("actions", "activate"), 1)).alias("activate"),
        F.count(F.when(F.col("verdict") == "unchanged", 1)).alias("unchanged"),
        F.count(F.when(F.col("verdict") == "missing", 1)).alias("missing"),
    )


def verify_ledger(ledger: DataFrame, live: DataFrame, fields: Sequence[str] = ("handle", "title", "status")) -> DataFrame:
    """Differences between ledger and store: ``finding, resource, key, id, detail``.

    ``live``: ``id, handle, title, status, variants_count`` (null where not asked for).
    """
    rows = ledger.select("resource", "key", "id", "payload")
    seen = live.select("id", *[F.col(c).alias(f"live_{c}") for c in (*fields, "variants_count")], F.lit(True).alias("_found"))
    joined = rows.join(seen, "id", "left")
    held = (
        ledger.where(F.col("resource") == "ProductVariant")
        .groupBy(field("product_handle").alias("key"))
        .agg(F.count(F.lit(1)).alias("ledger_variants"))
    )
    products = joined.where((F.col("resource") == "Product") & F.col("_found")).join(held, "key", "left")
    drift = F.map_filter(
        F.map_from_arrays(
            F.array(*[F.lit(f) for f in fields]),
            F.array(*[F.struct(field(f).alias("ledger"), F.col(f"live_{f}").alias("live")) for f in fields]),
        ),
        lambda _, v: v["ledger"].isNotNull() & ~v["ledger"].eqNullSafe(v["live"]),
    )
    raised = (F.size("_drift") == 1) & F.coalesce(F.try_element_at("_drift", F.lit("status"))["live"] == "ACTIVE", F.lit(False))
    note = F.when(raised, "status raised to ACTIVE outside the load")

    def finding(df: DataFrame, name: str, detail: Column) -> DataFrame:
        return df.select(F.lit(name).alias("finding"), "resource", "key", "id", detail.alias("detail"))

    wrong_count = (F.col("ledger_variants") > 0) & (F.col("live_variants_count") != F.col("ledger_variants"))
    return union_all(
        [
            finding(joined.where(F.col("_found").isNull()), "missing", F.lit(None).cast("string")),
            finding(
                products.where(wrong_count), "variant_count_mismatch",
                F.to_json(F.struct("ledger_variants", F.col("live_variants_count").alias("live_variants"))),
            ),
            finding(
                products.withColumn("_drift", drift).where(F.size("_drift") > 0), "field_drift",
                F.to_json(F.struct(F.col("_drift").alias("fields"), note.alias("note"))),
            ),
            finding(
                joined.where((F.col("resource") == "MediaImage") & (F.col("live_status") != "READY")), "media_not_ready",
                F.col("live_status"),
            ),
        ]
    )


def stale_plan(
    ledger: DataFrame, loaded: DataFrame, live: DataFrame, scope: DataFrame | None = None
) -> DataFrame:
    """Variant and inventory rows the transform no longer loads, with what to do.

    ``loaded``: keys the transform still produces; ``live``: ids that exist; ``scope``: product
    handles the run touched. A row is dropped when its object is gone (``not_on_store``) or belongs
    to a loaded row too (``collapsed_onto_loaded_variant``), else kept as ``live_but_held``. An
    inventory row is judged the same way, but only after its variant row was dropped.

    Ledger keys are unique per resource. Both resources are judged in one reading: one pass by key, one by id. Loaded keys
    and live ids are rows among the others there, so that a task sorts once, with no table of distinct values beside it.
    """
    kept = loaded.where(F.col("key").isNotNull()).select("key", F.lit(True).alias("_loaded"))
    exists = live.where(F.col("id").isNotNull()).select("id", F.lit(True).alias("_live"))
    variant, row, here = F.col("resource") == "ProductVariant", F.col("resource").isNotNull(), F.col("_here").isNotNull()
    same_id, same_key = Window.partitionBy("id"), Window.partitionBy("key")

    def survivor(which: Column) -> Column:
        return F.min(F.when(here & which, F.col("key"))).over(same_id)

    judged = (
        ledger.where(F.col("resource").isin("ProductVariant", "InventoryItem"))
        .select("resource", "key", "id", field("product_handle").alias("product_handle"))
        .unionByName(kept, allowMissingColumns=True)
        .withColumn("_here", F.max("_loaded").over(same_key))
        .where(row)
        .drop("_loaded")
        .unionByName(exists, allowMissingColumns=True)
        .withColumn("_survivor", F.when(variant, survivor(variant)).otherwise(survivor(~variant)))
        .withColumn("_exists", F.max("_live").over(same_id))
        .where(row & ~here)
        .withColumn(
            "verdict",
            F.when(F.col("_exists").isNull(), "not_on_store")
            .when(F.col("_survivor").isNotNull(), "collapsed_onto_loaded_variant")
            .otherwise("live_but_held"),
        )
    )
    touched = F.lit(True)
    if scope is not None:
        names = scope.select("product_handle").distinct().withColumn("_touched", F.lit(True))
        judged, touched = judged.join(names, "product_handle", "left"), F.col("_touched").isNotNull()
    drops = variant & touched & (F.col("verdict") != "live_but_held") & F.col("key").isNotNull()
    return (
        judged.withColumn("_gone", F.max(F.when(drops, True)).over(same_key))
        .withColumn("_handle", F.max(F.when(drops, F.col("product_handle"))).over(same_key))
        .where((variant & touched) | (~variant & F.col("_gone")))
        .select(
            "resource", "key", "id", F.when(variant, F.col("product_handle")).otherwise(F.col("_handle")).alias("product_handle"), "verdict",
            F.when(F.col("verdict") == "collapsed_onto_loaded_variant", F.col("_survivor")).alias("kept_key"),
        )
    )


def prune(ledger: DataFrame, plan: DataFrame) -> DataFrame:
    """Ledger without the rows the plan drops.

    An outer join, of which only rows without a match stay: Spark would push an anti join into each branch of a ledger that
    is a union, and make the plan once for each.
    """
    gone = plan.where(F.col("verdict") != "live_but_held").select("resource", "key", F.lit(True).alias("_gone"))
    return ledger.join(gone, ["resource", "key"], "left").where(F.col("_gone").isNull()).select(*ledger.columns)


def purge_plan(ledger: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Everything the ledger created, in an order that respects dependencies."""
    order = [r for r in PURGE_ORDER if only is None or r in only]
    rank = F.array_position(F.array(*[F.lit(r) for r in PURGE_ORDER]), F.col("resource"))
    return ledger.where(F.col("resource").isin(*order)).select(
        rank.cast("int").alias("step"), "resource", "key", "id"
    ).orderBy("step", "key")


def purge_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("step", "resource").agg(F.count(F.lit(1)).alias("planned"))


def placeholder_variants(live: DataFrame, ledger: DataFrame) -> DataFrame:
    """Live variants nobody claims (not in the ledger, no source id), except where they are all a
    product has. ``live``: ``product_id, id, source_id``."""
    ours = ledger.where(F.col("resource") == "ProductVariant").select("id").distinct().withColumn("_ours", F.lit(True))
    marked = live.join(ours, "id", "left").withColumn(
        "_orphan", F.col("_ours").isNull() & (F.coalesce("source_id", F.lit("")) == "")
    )
    mixed = (
        marked.groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_orphan"), 1)).alias("orphans"))
        .where((F.col("orphans") > 0) & (F.col("orphans") < F.col("n")))
        .select("product_id")
    )
    return marked.where("_orphan").join(mixed, "product_id", "left_semi").select("product_id", "id")


def match_live_variants(wanted: DataFrame, live: DataFrame) -> DataFrame:
    """Live variant each wanted row updates: by ledger id, else source id, else the same option set
    in any order; ``create`` where none.

    ``wanted``: ``product_id, key, known_id, source_id, option_values``; ``live``: ``product_id, id,
    source_id, option_values``. Live ids are unique; of several live variants with one source id or
    option set the lowest id counts.
    """
    options = F.to_json(F.array_sort("option_values"))
    by_id = live.select("product_id", F.col("id").alias("known_id"), F.col("id").alias("_by_id"))
    by_source = (
        live.where(F.col("source_id").isNotNull()).groupBy("product_id", "source_id").agg(F.min("id").alias("_by_source"))
    )
    by_options = live.groupBy("product_id", options.alias("_set")).agg(F.min("id").alias("_by_options"))
    match = F.coalesce("_by_id", "_by_source", "_by_options")
    how = (
        F.when(F.col("_by_id").isNotNull(), "id")
        .when(F.col("_by_source").isNotNull(), "source_id")
        .when(F.col("_by_options").isNotNull(), "options")
        .otherwise("create")
    )
    return (
        wanted.withColumn("_set", options)
        .join(by_id, ["product_id", "known_id"], "left")
        .join(by_source, ["product_id", "source_id"], "left")
        .join(by_options, ["product_id", "_set"], "left")
        .select("product_id", "key", match.alias("live_id"), how.alias("how"))
    )


def option_conflicts(live: DataFrame, wanted: DataFrame, placeholder: str = "Title") -> DataFrame:
    """Products whose ordered option names differ. Both: ``product_id, option_names``."""
    want = F.when(F.coalesce(F.size("wanted_names"), F.lit(0)) > 0, F.col("wanted_names")).otherwise(F.array(F.lit(placeholder)))
    return (
        live.withColumnRenamed("option_names", "live_names")
        .join(wanted.withColumnRenamed("option_names", "wanted_names"), "product_id")
        .withColumn("wanted_names", want)
        .where(~F.col("live_names").eqNullSafe(F.col("wanted_names")))
    )


def inventory_adjustments(wanted: DataFrame, current: DataFrame, store: str) -> DataFrame:
    """Tracked items whose quantity differs, with a key derived from the exact change, so a repeated
    request cannot apply twice. ``wanted``: ``item_id, location, tracked, quantity``; ``current``:
    ``item_id, location, quantity``."""
    now = F.coalesce("_now", F.lit(0))
    change = F.concat(now.cast("string"), F.lit("->"), F.col("quantity").cast("string"))
    return (
        wanted.where(F.col("tracked") & F.col("quantity").isNotNull())
        .join(current.withColumnRenamed("quantity", "_now"), ["item_id", "location"], "left")
        .where(now != F.col("quantity"))
        .select(
            "item_id", "location", now.alias("from_quantity"), F.col("quantity").alias("to_quantity"),
            F.sha1(F.concat_ws("/", F.lit(store), F.col("item_id").cast("string"), "location", change)).alias("idempotency_key"),
        )
    )


def membership_delta(wanted: DataFrame, current: DataFrame, ours: DataFrame) -> DataFrame:
    """``collection, product, action``: what to add, and what of our own to remove."""
    pair = ["collection", "product"]
    want, have = wanted.select(*pair).distinct(), current.select(*pair).distinct()
    add = want.join(have, pair, "left_anti").withColumn("action", F.lit("add"))
    remove = (
        have.join(want, pair, "left_anti")
        .join(ours.select("product").distinct(), "product", "left_semi")
        .withColumn("action", F.lit("remove"))
    )
    return add.select(*pair, "action").unionByName(remove.select(*pair, "action"))


def media_reuse_match(wanted: DataFrame, live: DataFrame, ledger: DataFrame) -> DataFrame:
    """Unclaimed upload of the same product for each wanted image: equal file stem, or equal plus a
    hexadecimal suffix.

    ``wanted``: ``product_id, key, url``; ``live``: ``product_id, id, url``. The suffix test would be
    a theta join within a product; instead every live stem lists the (at most 33) stems it could
    extend, and the join is an equality on product and stem. Spark's size estimate knows nothing of that list, so the
    join is told to sort and merge: a broadcast of many stems per upload would go through the driver.
    """
    claimed = ledger.where(F.col("resource") == "MediaImage").select("id").distinct()
    free = live.join(claimed, "id", "left_anti").withColumn("_stem", file_stem(F.col("url")))
    stem = F.col("_stem")
    # what may be cut off: up to 32 hexadecimal digits at the end, never the whole stem
    digits = F.length(F.regexp_extract(stem, "([0-9a-f]{0,32})$", 1))
    cuts = F.sequence(F.lit(0), F.greatest(F.least(digits, F.length(stem) - 1), F.lit(0)))
    bases = F.transform(cuts, lambda n: F.substring(stem, F.lit(1), F.length(stem) - n))
    candidates = (
        free.where(stem != "")
        .select("product_id", "id", F.explode(bases).alias("_stem"))
        .groupBy("product_id", "_stem")
        .agg(F.min("id").alias("live_id"))
    )
    return (
        wanted.withColumn("_stem", file_stem(F.col("url")))
        .join(candidates.hint("merge"), ["product_id", "_stem"], "left")
        .select("product_id", "key", "live_id")
    )


def media_by_name(wanted: DataFrame, live: DataFrame) -> DataFrame:
    """Uploaded file with the same name. ``wanted``: ``key, filename``; ``live``: ``id, filename``."""
    names = live.groupBy("filename").agg(F.min("id").alias("live_id"))
    return wanted.join(names, "filename", "left").select("key", "filename", "live_id")
