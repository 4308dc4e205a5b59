"""Redirect map: dispositions, priority merge, holds, status codes, request resolution, grading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.urls import canonical_path, lookup_keys, normalize_url
from cartloom.operators.exceptions import union_all

HELD = "held_redirect_to_collection"
MOVED = ("301", HELD)
SHOP_ALL = "/shop"
HOLD_CODES = ["record_held_from_load"]
RESOLVED = ["resolved", "fixed", "done", "n/a"]
MAP_COLUMNS = [
    "source_path", "source_type", "source_status", "outcome", "destination",
    "owner", "reason", "needs_decision", "evidence",
]


def is_moved() -> Column:
    return F.col("outcome").isin(*MOVED)


def route(handle: Column) -> Column:
    return F.concat(F.lit(SHOP_ALL + "/"), handle)


def disposition(
    outcome: str | Column, destination: str | Column, owner: str | Column, reason: str | Column, needs: bool | Column
) -> Column:
    def col(value) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    return F.struct(
        col(outcome).alias("outcome"),
        col(destination).alias("destination"),
        col(owner).alias("owner"),
        col(reason).alias("reason"),
        col(needs).alias("needs_decision"),
    )


def decision(reason: str | Column) -> Column:
    """A row only the client can settle."""
    return disposition("client_decision", "", "none", reason, True)


@dataclass(frozen=True)
class TagRules:
    """Ordered tag classification. The token lists are rule data of one shop."""

    clubs: Sequence[tuple[str, str]] = (("north-academy", "north-academy"), ("west-club", "west-club"), ("teamwear", "teamwear"))
    surfaces: Sequence[str] = ("beach", "indoor")
    # Fixed values, first hit wins.
    types: Sequence[tuple[str, str]] = (
        ("jersey", "jerseys"),
        ("uniform", "jerseys"),
        ("polo", "tops"),
        ("t-shirt", "tops"),
        ("tshirt", "tops"),
        ("shirt", "tops"),
        ("singlet", "tops"),
        ("crop", "tops"),
        ("hoodie", "hoodies-jackets"),
        ("jacket", "hoodies-jackets"),
        ("sweater", "hoodies-jackets"),
        ("jumper", "hoodies-jackets"),
        ("tracksuit", "hoodies-jackets"),
        ("short", "shorts-pants"),
        ("pant", "shorts-pants"),
        ("sock", "accessories"),
        ("bag", "accessories"),
        ("backpack", "accessories"),
        ("kneepad", "accessories"),
        ("knee-pad", "accessories"),
    )
    soft_types: Sequence[str] = ("uniform",)
    brands: Sequence[str] = ()
    internal: Sequence[str] = ("homepage",)


def classify_tag(slug: Column, count: Column, in_sitemap: Column, rules: TagRules = TagRules()) -> Column:
    """Disposition of a tag archive: club, surface (whole token), type, brand, internal, empty, else
    the nearest listing."""
    soft = F.lit(False)
    for token in rules.soft_types:
        soft = soft | slug.contains(token)
    hits = [
        F.when(slug.contains(token), disposition("301", route(F.concat(F.lit("clubs/"), F.lit(club))), "storefront", f"club axis: tag contains '{token}'", False))
        for token, club in rules.clubs
    ]
    hits += [
        F.when(
            slug.rlike(f"(^|-){token}(-|$)"),
            disposition("301", route(F.lit(token)), "storefront", f"surface axis: tag contains '{token}'", False),
        )
        for token in rules.surfaces
    ]
    hits += [
        F.when(slug.contains(token), disposition("301", route(F.lit(type_)), "storefront", f"type axis: tag contains '{token}'", soft))
        for token, type_ in rules.types
    ]
    if rules.brands:
        hits.append(F.when(slug.isin(*rules.brands), decision("brand tag; no brand collection")))
    hits.append(
        F.when(slug.isin(*rules.internal), disposition("410", "", "storefront", "internal flag with no user-facing equivalent", False))
    )
    hits.append(
        F.when((count == 0) & ~in_sitemap, disposition("410", "", "storefront", "empty tag archive, not in the sitemap", False))
    )
    fallback = disposition("301", SHOP_ALL, "storefront", "tag with no collection; nearest listing", True)
    return F.coalesce(*hits, fallback)


def page_dispositions(pages: DataFrame, table: DataFrame) -> DataFrame:
    """Pages with the disposition of their slug; an unmapped page is a client decision.

    ``table``: ``slug, outcome, destination, owner, reason, needs_decision``. The home page is the
    empty slug.
    """
    rows = pages.withColumn("_key", F.when(F.col("slug") == "home", "").otherwise(F.col("slug")))
    known = table.withColumnRenamed("slug", "_key").withColumn("_known", F.lit(True))
    blank = F.coalesce("slug", F.lit("")) == ""
    path = (
        F.when(blank, F.concat(F.lit("/?page_id="), F.col("id").cast("string")))
        .when(F.col("slug") == "home", "/")
        .otherwise(F.concat(F.lit("/"), "slug"))
    )
    given = F.struct("outcome", "destination", "owner", "reason", "needs_decision")
    d = (
        F.when(blank, decision("draft page with no slug and no public path"))
        .when(F.col("_known"), given)
        .otherwise(decision("page has no storefront equivalent; confirm migration or retirement"))
    )
    return rows.join(known, "_key", "left").select(
        path.alias("source_path"), F.lit("page").alias("source_type"), F.col("status").alias("source_status"), d.alias("d")
    ).select("source_path", "source_type", "source_status", "d.*")


def category_dispositions(paths: DataFrame, table: DataFrame) -> DataFrame:
    """Category paths with the disposition of their slug. A category without one fails the job.

    ``paths``: ``slug, path, alias``; ``table``: ``slug, destination, reason`` with a null
    destination for a client decision.
    """
    known = table.withColumn("_known", F.lit(True))
    missing = F.raise_error(F.concat(F.lit("no disposition for category "), F.col("slug")))
    d = (
        F.when(F.col("_known").isNull(), decision(missing.cast("string")))
        .when(F.col("destination").isNull(), decision(F.col("reason")))
        .otherwise(disposition("301", F.col("destination"), "storefront", F.col("reason"), False))
    )
    return paths.join(known, "slug", "left").select(
        F.col("path").alias("source_path"), F.lit("product_category").alias("source_type"),
        F.lit("publish").alias("source_status"), d.alias("d"),
    ).select("source_path", "source_type", "source_status", "d.*")


def slug_siblings(products: DataFrame, slug: str = "slug") -> DataFrame:
    """``-2`` slugs whose base slug exists too."""
    suffixed = products.where(F.col(slug).endswith("-2")).withColumn("_base", F.regexp_replace(slug, "-2$", ""))
    bases = products.select(F.col(slug).alias("_base")).distinct()
    return suffixed.join(bases, "_base", "left_semi").select(slug).distinct()


def product_dispositions(products: DataFrame) -> DataFrame:
    """Published clean slugs keep their URL; drafts and ``-2`` slugs wait for a decision."""
    twins = slug_siblings(products).withColumn("_twin", F.lit(True))
    path = F.concat(F.lit("/product/"), "slug")
    dirty = F.col("slug").endswith("-2")
    d = (
        F.when(F.col("status") != "publish", decision("draft product has no public URL; publish or retire"))
        .when(dirty & F.col("_twin"), decision("duplicate handle: slug and base are both live; pick the canonical one"))
        .when(dirty, decision("dirty '-2' handle with no sibling; approve a clean one"))
        .otherwise(disposition("same_url", path, "storefront", "product handle preserved", False))
    )
    return products.join(twins, "slug", "left").select(
        path.alias("source_path"), F.lit("product").alias("source_type"), F.col("status").alias("source_status"), d.alias("d")
    ).select("source_path", "source_type", "source_status", "d.*")


def primary_collection(clubs: Column, type_: Column, how: Column, surface: Column) -> Column:
    """``struct<destination, why>``: club, type from a category, surface, inferred type, all."""
    club = F.get(clubs, F.lit(0))

    def choice(destination: Column, why: Column) -> Column:
        return F.struct(destination.alias("destination"), why.alias("why"))

    return (
        F.when(club.isNotNull(), choice(route(F.concat(F.lit("clubs/"), club)), F.concat(F.lit("club axis: "), club)))
        .when(how == "category", choice(route(type_), F.concat(F.lit("type axis: "), type_, F.lit(" (from category)"))))
        .when(surface.isNotNull(), choice(route(surface), F.concat(F.lit("surface axis: "), surface)))
        .when(type_.isNotNull(), choice(route(type_), F.concat(F.lit("type axis: "), type_, F.lit(" ("), how, F.lit(")"))))
        .otherwise(choice(F.lit(SHOP_ALL), F.lit("no axis resolved")))
    )


def priority_merge(
    rows: DataFrame, key: str = "source_path", priority: str = "priority", tiebreak: Sequence[str] = (), evidence: str = "evidence"
) -> DataFrame:
    """One row per key: the first source in priority order decides, later ones add evidence text once.

    Two combinable steps: equal evidence of a key is merged first, so a key that a third of all rows
    name arrives as its few distinct texts; the winner is a combinable minimum on the way.
    """
    order = F.struct(priority, *tiebreak)
    values = [c for c in rows.columns if c not in (key, priority, evidence)]
    texts = rows.groupBy(key, F.coalesce(evidence, F.lit("")).alias(evidence)).agg(
        F.min(order).alias("_order"), F.min_by(F.struct(*values), order).alias("_values")
    )
    joined = F.aggregate(
        F.transform(F.array_sort("_texts"), lambda t: t["text"]),
        F.lit(""),
        lambda acc, t: F.when((t == "") | acc.contains(t), acc).when(acc == "", t).otherwise(F.concat(acc, F.lit("; "), t)),
    )
    return (
        texts.groupBy(key)
        .agg(
            F.min_by("_values", "_order").alias("_values"),
            F.collect_list(F.struct(F.col("_order").alias("order"), F.col(evidence).alias("text"))).alias("_texts"),
        )
        .select(key, *[F.col(f"_values.{c}").alias(c) for c in values], joined.alias(evidence))
    )


def exception_holds(register: DataFrame) -> DataFrame:
    """``handle, ref``: unresolved blocking product exceptions, the alphabetically first one each."""
    severity = F.lower(F.trim(F.coalesce("severity", F.lit(""))))
    blocking = F.trim("code").isin(*HOLD_CODES) | (severity == "critical")
    open_ = ~F.lower(F.trim(F.coalesce("retry_status", F.lit("")))).isin(*RESOLVED)
    ref = F.concat(F.trim("code"), F.lit(":product:"), F.coalesce("record_id", F.lit("")))
    return (
        register.where((F.trim("record_type") == "product") & open_ & blocking & (F.trim("record_ref") != ""))
        .groupBy(F.trim("record_ref").alias("handle"))
        .agg(F.min(ref).alias("ref"))
    )


def held_products(register: DataFrame, loaded: DataFrame | None, products: DataFrame) -> DataFrame:
    """``handle, ref, why``: products held by the register, or absent from the ledger, or both.

    ``loaded``: handles in the load ledger, ``None`` when there is no ledger.
    """
    by_register = exception_holds(register).withColumn("_register", F.lit("exception register"))
    if loaded is None:
        return by_register.select("handle", "ref", F.array("_register").alias("why"))
    slugs = products.select(F.col("slug").alias("handle")).distinct()
    absent = slugs.join(loaded.select("handle").distinct(), "handle", "left_anti").withColumn(
        "_ledger", F.lit("absent from the load ledger")
    )
    return by_register.join(absent, "handle", "full").select(
        "handle",
        F.coalesce("ref", F.lit("not in the load ledger")).alias("ref"),
        F.array_sort(F.array_compact(F.array("_register", "_ledger"))).alias("why"),
    )


def apply_held(rows: DataFrame, held: DataFrame, collections: DataFrame) -> DataFrame:
    """Map rows with kept product URLs of held products turned into interim redirects.

    ``collections``: ``handle, destination, why`` of each product's primary collection.
    """
    handle = F.regexp_extract("source_path", "([^/]*)$", 1)
    kept = (F.col("source_type") == "product") & (F.col("outcome") == "same_url")
    hold = held.select(F.col("handle").alias("_handle"), F.col("ref").alias("_ref"), F.array_join("why", ", ").alias("_why"))
    home = collections.select(
        F.col("handle").alias("_handle"), F.col("destination").alias("_destination"), F.col("why").alias("_axis")
    )
    changed = F.col("_ref").isNotNull()
    rationale = F.coalesce("_axis", F.lit("no product record"))
    reason = F.concat(
        F.lit("product is held from the load; interim redirect to its primary collection ("), rationale,
        F.lit("); held by exception "), F.col("_ref"),
    )
    evidence = F.concat("evidence", F.lit("; held: "), "_why", F.lit(" ("), "_ref", F.lit(")"))
    return (
        rows.withColumn("_handle", F.when(kept, handle))
        .join(hold, "_handle", "left")
        .join(home, "_handle", "left")
        .withColumn("outcome", F.when(changed, HELD).otherwise(F.col("outcome")))
        .withColumn("destination", F.when(changed, F.coalesce("_destination", F.lit(SHOP_ALL))).otherwise(F.col("destination")))
        .withColumn("owner", F.when(changed, "storefront").otherwise(F.col("owner")))
        .withColumn("reason", F.when(changed, reason).otherwise(F.col("reason")))
        .withColumn("needs_decision", changed | F.col("needs_decision"))
        .withColumn("evidence", F.when(changed, evidence).otherwise(F.col("evidence")))
        .select(*rows.columns)
    )


def map_vs_ledger(rows: DataFrame, loaded: DataFrame) -> DataFrame:
    """Kept product URLs whose product was never loaded."""
    promised = rows.where((F.col("outcome") == "same_url") & F.col("source_path").startswith("/product/")).select(
        "source_path", F.regexp_extract("source_path", "([^/]*)$", 1).alias("handle")
    )
    return promised.join(loaded.select("handle").distinct(), "handle", "left_anti").select("source_path", "handle")


def status_codes(outcome: Column, owner: Column) -> Column:
    return (
        F.when(outcome.isin(*MOVED), F.when(owner == "storefront", "308").otherwise("301"))
        .when(outcome == "same_url", "200")
        .when(outcome == "410", "410")
        .otherwise("")
    )


def sitemap_evidence(sitemap: DataFrame, hosts: Sequence[str] | None = None) -> DataFrame:
    """``source_path, evidence``: the sitemap files that list a path, distinct files only."""
    return (
        sitemap.select(normalize_url(F.col("loc"), hosts).alias("source_path"), "sitemap")
        .where(F.col("source_path").isNotNull())
        .distinct()
        .groupBy("source_path")
        .agg(F.concat(F.lit("sitemap:"), F.array_join(F.array_sort(F.collect_list("sitemap")), ",")).alias("evidence"))
    )


def link_counts(docs: DataFrame, html: str, hosts: Sequence[str] | None = None) -> DataFrame:
    """``source_path, links``: how often bodies link to each normalised path."""
    hrefs = F.regexp_extract_all(html, F.lit("href=[\"']([^\"']+)[\"']"), F.lit(1))
    return (
        docs.select(F.explode(hrefs).alias("href"))
        .select(normalize_url(F.col("href"), hosts).alias("source_path"))
        .where(F.col("source_path").isNotNull())
        .groupBy("source_path")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def redirect_counts(rows: DataFrame) -> DataFrame:
    """Rows by type and outcome, with totals of each axis."""
    return (
        rows.groupingSets(
            [["source_type", "outcome"], ["source_type"], ["outcome"], []], F.col("source_type"), F.col("outcome")
        )
        .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))
    )


def outcome_table(rows: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    """Cross table of type by outcome."""
    return rows.groupBy("source_type").agg(*[F.count(F.when(F.col("outcome") == o, 1)).alias(o) for o in outcomes])


def resolve_request(requests: DataFrame, rules: DataFrame, gone: DataFrame) -> DataFrame:
    """``request_id, status, location`` of each request ``request_id, path, query``.

    The literal path is looked up before its decoded lower-case form, the gone list before the rules
    on each. Rules keep the query string. Unmatched paths lose extra slashes in one hop or pass.
    """
    # distinct paths are resolved, then joined back: a hot path costs one lookup
    paths = requests.select("path").distinct().withColumn("clean", canonical_path(F.col("path")))
    keys = paths.select("path", F.posexplode(lookup_keys(F.col("clean"))).alias("at", "key"))
    hits = (
        keys.join(gone.select(F.col("source_path").alias("key"), F.lit(True).alias("_gone")), "key", "left")
        .join(rules.select(F.col("source").alias("key"), "destination", "permanent"), "key", "left")
        .where(F.col("_gone") | F.col("destination").isNotNull())
        .groupBy("path")
        .agg(F.min_by(F.struct("_gone", "destination", "permanent"), "at").alias("hit"))
    )
    search = F.when(F.coalesce("query", F.lit("")) == "", "").otherwise(F.concat(F.lit("?"), "query"))
    status = (
        F.when(F.col("hit._gone"), 410)
        .when(F.col("hit.destination").isNotNull(), F.when(F.col("hit.permanent"), 308).otherwise(307))
        .when(F.col("clean") != F.col("path"), 308)
    )
    location = F.when(F.col("hit._gone"), F.lit(None)).when(
        F.col("hit.destination").isNotNull(), F.concat("hit.destination", search)
    ).when(F.col("clean") != F.col("path"), F.concat("clean", search))
    resolved = paths.join(hits, "path", "left")
    return requests.join(resolved, "path").select("request_id", status.alias("status"), location.alias("location"))


def grade_redirects(rows: DataFrame, hops: DataFrame, unbuilt: Sequence[str] = ()) -> DataFrame:
    """Verdict per map row from observed walks ``source_path, hops, final_path, final_status``.

    ``unbuilt``: path prefixes whose 404 is expected for now.
    """
    target = F.when(F.col("outcome") == "same_url", F.col("source_path")).otherwise(F.col("destination"))
    landed = F.regexp_extract("final_path", r"^([^?]*)", 1)
    pending = F.lit(False)
    for prefix in unbuilt:
        pending = pending | target.startswith(prefix)
    quick = F.when(F.col("hops") <= 1, "single_hop_ok").otherwise("multi_hop")
    verdict = (
        F.when((F.col("outcome") == "client_decision") | F.col("source_path").contains("?"), "skipped")
        .when(F.col("final_status").isNull(), "fail")
        .when(
            F.col("outcome") == "410",
            F.when(F.col("final_status") != 410, "fail").when(F.col("hops") == 0, "gone_410_ok").otherwise("multi_hop"),
        )
        .when(landed != target, "wrong_destination")
        .when(F.col("final_status") == 200, quick)
        .when((F.col("final_status") == 404) & pending, "destination_404")
        .otherwise("fail")
    )
    return rows.join(hops, "source_path", "left").select("source_path", "outcome", "destination", "hops", verdict.alias("result"))


def canonical_check(rows: DataFrame, fetches: DataFrame) -> DataFrame:
    """Does the slash-free form of each row answer right on its own: ``source_path, ok``.

    ``fetches``: ``source_path, status, location_path``.
    """
    ok = (
        (is_moved() & F.col("status").isin(301, 308) & F.col("location_path").eqNullSafe(F.col("destination")))
        | ((F.col("outcome") == "same_url") & F.col("status").isin(200, 404))
        | ((F.col("outcome") == "410") & (F.col("status") == 410))
    )
    checked = rows.where((F.col("outcome") != "client_decision") & ~F.col("source_path").contains("?"))
    return checked.join(fetches, "source_path", "left").select(
        "source_path", "outcome", F.coalesce(ok, F.lit(False)).alias("ok")
    )


def with_evidence(rows: DataFrame, priority: int, evidence: Column, sitemap: DataFrame | None = None) -> DataFrame:
    """Registry rows of one source: its own evidence, then the sitemap files that list the path."""
    base = rows.withColumn("priority", F.lit(priority)).withColumn("evidence", evidence)
    if sitemap is None:
        return base.select("priority", *MAP_COLUMNS)
    listed = sitemap.select("source_path", F.col("evidence").alias("_listed"))
    return (
        base.join(listed, "source_path", "left")
        .withColumn("evidence", F.concat_ws("; ", "evidence", "_listed"))
        .select("priority", *MAP_COLUMNS)
    )


def plugin_redirects(raw: DataFrame, published: DataFrame) -> DataFrame:
    """Rows of the source site's own redirects ``origin, target``, chains followed to their end.

    The last rule of an origin counts. A chain that does not end at a published product waits for a
    decision.
    """
    from cartloom.operators.graph import collapse_chains

    rules = (
        raw.select(
            normalize_url(F.concat(F.lit("/"), F.regexp_replace("origin", "^/+", ""))).alias("source_path"),
            normalize_url(F.concat(F.lit("/"), F.regexp_replace("target", "^/+", ""))).alias("destination"),
            "seq",
        )
        .where(F.col("source_path").isNotNull() & F.col("destination").isNotNull() & (F.col("source_path") != F.col("destination")))
        .groupBy("source_path")
        .agg(F.max_by("destination", "seq").alias("destination"))
    )
    ends = collapse_chains(rules, max_hops=None)
    live = published.select(F.col("slug").alias("_slug")).distinct().withColumn("_live", F.lit(True))
    d = F.when(
        F.col("_live"),
        disposition(
            "301", F.col("destination"), "storefront",
            F.concat(F.lit("redirect of the source site"), F.when(F.col("collapsed") > 0, ", chain collapsed").otherwise("")), False,
        ),
    ).otherwise(decision(F.concat(F.lit("redirect target '"), "destination", F.lit("' is not a published product"))))
    return (
        ends.withColumn("_slug", F.regexp_extract("destination", "([^/]*)$", 1))
        .join(live, "_slug", "left")
        .select("source_path", F.lit("plugin_redirect").alias("source_type"), F.lit("gone").alias("source_status"), d.alias("d"))
        .select("source_path", "source_type", "source_status", "d.*")
    )


def constant_rows(df: DataFrame, path: Column, source_type: str, d: Column, status: Column | str = "publish") -> DataFrame:
    state = F.lit(status) if isinstance(status, str) else status
    return df.select(
        path.alias("source_path"), F.lit(source_type).alias("source_type"), state.alias("source_status"), d.alias("d")
    ).select("source_path", "source_type", "source_status", "d.*")


@dataclass(frozen=True)
class MapRules:
    """Rule tables of one shop's redirect map; see the operators for their columns."""

    pages: DataFrame
    categories: DataFrame
    system: DataFrame | None = None
    tags: TagRules = field(default_factory=TagRules)
    hosts: Sequence[str] | None = None
    blog: str = "/blog"
    # Fixed values.
    feeds: Mapping[str, str] = field(
        default_factory=lambda: {"/feed": "site feed", "/comments/feed": "site comments feed", "/blog/feed": "blog page feed"}
    )
    demo_categories: Sequence[int] = ()


def redirect_inventory(tables: Mapping[str, DataFrame], rules: MapRules, plugin: DataFrame | None = None) -> DataFrame:
    """Every legacy URL of a snapshot with one disposition, merged by source priority.

    ``tables``: products, pages, posts, product_categories, product_tags, post_categories,
    post_tags, sitemap_urls, menu_items. ``plugin``: ``origin, target, seq``.
    """
    from cartloom.operators.graph import category_paths

    spark = tables["products"].sparkSession
    listed = sitemap_evidence(tables["sitemap_urls"], rules.hosts)
    text = F.lit
    products, pages, posts = tables["products"], tables["pages"], tables["posts"]
    sources = [with_evidence(product_dispositions(products), 1, text("products"), listed)]
    if plugin is not None:
        published = products.where(F.col("status") == "publish")
        sources.append(with_evidence(plugin_redirects(plugin, published), 2, text("products: redirect rule")))
    sources.append(with_evidence(page_dispositions(pages, rules.pages), 3, text("pages"), listed))
    demo = (
        F.arrays_overlap("categories", F.array(*[F.lit(int(c)).cast("bigint") for c in rules.demo_categories]))
        if rules.demo_categories
        else F.lit(False)
    )
    post_d = F.when(F.col("slug").rlike(r"^\d+$"), decision("numeric post slug; approve a clean handle or retire")).otherwise(
        disposition("301", F.concat(F.lit(f"{rules.blog}/"), "slug"), "storefront", "post handle kept under the blog", demo)
    )
    sources.append(with_evidence(constant_rows(posts, F.concat(F.lit("/"), "slug"), "post", post_d, F.col("status")), 4, text("posts"), listed))
    paths = category_paths(tables["product_categories"])
    sources.append(with_evidence(category_dispositions(paths, rules.categories), 5, text("product_categories"), listed))
    tags = tables["product_tags"].withColumn("source_path", F.concat(F.lit("/product-tag/"), "slug"))
    seen = listed.select("source_path", F.lit(True).alias("_seen"))
    tagged = tags.join(seen, "source_path", "left").withColumn(
        "d", classify_tag(F.col("slug"), F.coalesce("count", F.lit(0)), F.coalesce("_seen", F.lit(False)), rules.tags)
    )
    sources.append(
        with_evidence(
            tagged.select("source_path", text("product_tag").alias("source_type"), text("publish").alias("source_status"), "d.*"),
            6, text("product_tags"), listed,
        )
    )
    index = disposition("301", rules.blog, "storefront", "the blog has one flat index", False)
    feed = disposition("410", "", "storefront", "feed retired; the storefront publishes none", False)
    for name, kind, prefix in (("post_categories", "post_category", "/category/"), ("post_tags", "post_tag", "/tag/")):
        path = F.concat(F.lit(prefix), "slug")
        sources.append(with_evidence(constant_rows(tables[name], path, kind, index), 7, text(name), listed))
        sources.append(with_evidence(constant_rows(tables[name], F.concat(path, F.lit("/feed")), "feed", feed), 9, text("feed convention")))
    feeds = spark.createDataFrame([(p,) for p in rules.feeds], "path string")
    sources.append(with_evidence(constant_rows(feeds, F.col("path"), "feed", feed), 9, text("feed convention")))
    if rules.system is not None:
        sources.append(with_evidence(rules.system, 8, text("system URL"), listed))
    unknown = decision("indexed URL with no matching entity; confirm")
    other = constant_rows(listed, F.col("source_path"), "sitemap_other", unknown).join(listed, "source_path")
    sources.append(other.withColumn("priority", F.lit(10)).select("priority", *MAP_COLUMNS))
    menu = tables["menu_items"].select(normalize_url(F.col("url"), rules.hosts).alias("path")).where(F.col("path").isNotNull()).distinct()
    sources.append(with_evidence(constant_rows(menu, F.col("path"), "menu_link", decision("navigation link with no matching entity")), 11, text("menu_items")))
    bodies = pages.select(F.col("content.rendered").alias("html")).unionByName(posts.select(F.col("content.rendered").alias("html")))
    links = link_counts(bodies, "html", rules.hosts)
    page_paths = pages.where(F.col("slug") != "").select(
        F.concat(F.lit("/?page_id="), F.col("id").cast("string")).alias("source_path"),
        F.when(F.col("slug") == "home", "/").otherwise(F.concat(F.lit("/"), "slug")).alias("_page"),
    )
    linked = links.join(page_paths, "source_path", "left").withColumn(
        "d",
        F.when(F.col("_page").isNotNull(), disposition("301", F.col("_page"), "storefront", "page_id link resolved to the page's path", False))
        .otherwise(decision("internally linked URL with no matching entity")),
    )
    sources.append(
        linked.select(
            F.lit(12).alias("priority"), "source_path", text("internal_link").alias("source_type"),
            F.when(F.col("_page").isNotNull(), "publish").otherwise("unknown").alias("source_status"), "d.*",
            F.concat(F.lit("internal link x"), F.col("links").cast("string")).alias("evidence"),
        ).select("priority", *MAP_COLUMNS)
    )
    return priority_merge(union_all(sources), tiebreak=["reason"]).select(*MAP_COLUMNS)
