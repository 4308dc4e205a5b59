"""Grading of stored observations: crawls, page metadata, secrets, headers, performance runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.urls import deployment_url
from cartloom.operators.exceptions import union_all
from cartloom.operators.quality import duplicate_values
from cartloom.operators.selection import nth_rows
from cartloom.operators.skew import MAX_GROUP_ROWS, numbered

# Fixed values.
SECRET_PATTERNS = [
    ("admin access token", r"(?i)shpat_[0-9a-f]{16,}"),
    ("shared secret", r"(?i)shpss_[0-9a-f]{16,}"),
    ("custom app token", r"(?i)shpca_[0-9a-f]{16,}"),
    ("mail service key", r"\bre_[A-Za-z0-9_-]{20,}"),
    ("private key block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    ("32-hex token shape", r"[\"'][0-9a-f]{32}[\"']"),
]
HSTS_MIN_SECONDS = 15_552_000


def secret_scan(docs: DataFrame, key: str, text: str, patterns: Sequence[tuple[str, str]] = tuple(SECRET_PATTERNS)) -> DataFrame:
    """``key, pattern, hits`` of every document with a hit; the matched text is never kept.
    Names of an application's own variables are the caller's to add."""
    hits = F.array(
        *[F.struct(F.lit(label).alias("pattern"), F.regexp_count(text, F.lit(p)).alias("hits")) for label, p in patterns]
    )
    found = docs.select(key, F.explode(F.filter(hits, lambda h: h["hits"] > 0)).alias("h"))
    return found.select(key, "h.pattern", "h.hits")


def security_header_checks(responses: DataFrame) -> DataFrame:
    """``url, header, value, severity, ok`` per rule. ``responses``: ``url, headers`` with lower-case
    header names."""

    def value(name: str) -> Column:
        return F.try_element_at("headers", F.lit(name))

    present = lambda name: F.coalesce(value(name), F.lit("")) != ""
    hsts = F.regexp_extract(F.coalesce(value("strict-transport-security"), F.lit("")), r"(?i)max-age=(\d+)", 1).try_cast("bigint")
    frames = present("x-frame-options") | F.coalesce(value("content-security-policy").contains("frame-ancestors"), F.lit(False))
    rules = [
        ("strict-transport-security", "high", F.coalesce(hsts, F.lit(0)) >= HSTS_MIN_SECONDS),
        ("x-content-type-options", "medium", F.coalesce(F.lower(value("x-content-type-options")) == "nosniff", F.lit(False))),
        ("referrer-policy", "medium", present("referrer-policy")),
        ("x-frame-options", "medium", frames),
        ("content-security-policy", "low", present("content-security-policy")),
        ("permissions-policy", "low", present("permissions-policy")),
        ("x-robots-tag", "info", F.lit(True)),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("header"), value(n).alias("value"), F.lit(s).alias("severity"), ok.alias("ok"))
            for n, s, ok in rules
        ]
    )
    return responses.select("url", F.explode(rows).alias("r")).select("url", "r.*")


def meta_content(html: Column, name: str) -> Column:
    """``content`` of a ``<meta>`` with that name or property, attributes in either order."""
    tag = F.regexp_extract(html, rf"(?i)<meta\b[^>]*(?:name|property)=[\"']{name}[\"'][^>]*>", 0)
    return F.trim(F.regexp_extract(tag, r"(?i)\bcontent=[\"']([^\"']*)[\"']", 1))


def seo_audit(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """Page metadata: title, description, canonical, Open Graph, robots, headings, JSON-LD."""
    doc = F.col(html)
    canonical = F.regexp_extract(doc, r"(?i)<link[^>]+rel=[\"']canonical[\"'][^>]*>", 0)
    blocks = F.regexp_extract_all(
        doc, F.lit(r"(?is)<script[^>]+type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), F.lit(1)
    )
    types = F.array_distinct(
        F.flatten(F.transform(blocks, lambda b: F.regexp_extract_all(b, F.lit(r'"@type"\s*:\s*"([^"]+)"'), F.lit(1))))
    )
    return pages.select(
        *keep,
        F.trim(F.regexp_extract(doc, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"),
        meta_content(doc, "description").alias("description"),
        F.regexp_extract(canonical, r"(?i)href=[\"']([^\"']*)[\"']", 1).alias("canonical"),
        meta_content(doc, "og:title").alias("og_title"),
        meta_content(doc, "og:description").alias("og_description"),
        meta_content(doc, "og:image").alias("og_image"),
        meta_content(doc, "og:type").alias("og_type"),
        meta_content(doc, "twitter:card").alias("twitter_card"),
        meta_content(doc, "robots").alias("robots"),
        F.regexp_count(doc, F.lit(r"(?i)<h1[\s>]")).alias("h1_count"),
        F.size(blocks).alias("json_ld_blocks"),
        F.when(F.size(blocks) > 0, F.forall(blocks, lambda b: F.try_parse_json(b).isNotNull())).alias("json_ld_valid"),
        types.alias("json_ld_types"),
    )


def seo_defects(audit: DataFrame, key: str) -> DataFrame:
    """``defect, severity, key, value``: missing fields per page, values that several pages share."""
    missing = F.array_compact(
        F.array(
            *[
                F.when(when, F.struct(F.lit(d).alias("defect"), F.lit(s).alias("severity")))
                for d, s, when in (
                    ("missing title", "medium", F.col("title") == ""),
                    ("missing description", "medium", F.col("description") == ""),
                    ("missing canonical", "low", F.col("canonical") == ""),
                    ("missing og:title", "medium", F.col("og_title") == ""),
                    ("h1 count is not one", "low", F.col("h1_count") != 1),
                    ("invalid JSON-LD", "medium", ~F.coalesce("json_ld_valid", F.lit(True))),
                )
            ]
        )
    )
    per_page = audit.select(F.explode(missing).alias("d"), F.col(key).cast("string").alias("key")).select(
        "d.defect", "d.severity", "key", F.lit(None).cast("bigint").alias("pages")
    )
    shared = [
        duplicate_values(audit.where(F.col(c) != "").select(c), [c]).select(
            F.lit(f"duplicate {c}").alias("defect"), F.lit("medium").alias("severity"), F.col(c).alias("key"), F.col("n").alias("pages")
        )
        for c in ("title", "description")
    ]
    return union_all([per_page, *shared])


def status_distribution(fetches: DataFrame) -> DataFrame:
    return fetches.groupBy("kind", "status").agg(F.count(F.lit(1)).alias("n"))


def failed_fetches(fetches: DataFrame) -> DataFrame:
    """Fetches that did not answer 200 (images may answer 206), with their referrer."""
    fine = (F.col("status") == 200) | ((F.col("kind") == "image") & (F.col("status") == 206))
    return fetches.where(~F.coalesce(fine, F.lit(False))).select("kind", "url", "status", "final_url", "referrer")


def redirect_verdicts(observed: DataFrame, base: str) -> DataFrame:
    """Pass or fail of redirect probes ``source, expect_code, expect_dest, first_status, hops,
    final_status, final_url``."""
    ok_status = F.col("first_status").isin(301, 308) | (F.col("first_status") == F.col("expect_code"))
    wanted = deployment_url(base, F.col("expect_dest"))
    trimmed = lambda c: F.regexp_replace(c, "/$", "")
    ok_dest = (F.coalesce("expect_dest", F.lit("")) == "") | (trimmed(F.col("final_url")) == trimmed(wanted))
    return observed.select(
        "source", "hops", (F.col("hops") == 1).alias("one_hop"), ok_dest.alias("dest_ok"),
        (ok_status & ok_dest & (F.col("final_status") == 200)).alias("passed"),
    )


def gone_verdicts(observed: DataFrame) -> DataFrame:
    return observed.select(
        "source", "hops", (F.col("final_status") == 410).alias("passed"), (F.col("first_status") == 410).alias("direct")
    )


def crawl_summary(fetches: DataFrame, redirects: DataFrame, gone: DataFrame) -> DataFrame:
    """``check, total, failing``."""
    failing = lambda c: F.count(F.when(~c, 1)).alias("failing")
    fine = (F.col("status") == 200) | ((F.col("kind") == "image") & (F.col("status") == 206))
    total = F.count(F.lit(1)).alias("total")
    return union_all(
        [
            fetches.groupBy(F.col("kind").alias("check")).agg(total, failing(F.coalesce(fine, F.lit(False)))),
            redirects.agg(total, failing(F.coalesce("passed", F.lit(False)))).select(F.lit("redirect").alias("check"), "total", "failing"),
            gone.agg(total, failing(F.coalesce("passed", F.lit(False)))).select(F.lit("gone").alias("check"), "total", "failing"),
        ]
    )


def deterministic_sample(df: DataFrame, key: str, n: int, seed: int, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """``n`` rows that the key and seed alone decide; all rows when there are no more. Null keys take part like others; which of
    several rows of one key is taken is open.

    The n-th smallest draw is found by narrowing, then every task keeps its rows below it; the sample, in order of its draws, is
    never gathered into one task.
    """
    drawn = df.withColumn("_draw", F.xxhash64(F.col(key), F.lit(seed)))
    alone = drawn.select(F.lit(1).alias("_all"), "_draw")
    bound = nth_rows(alone, ["_all"], ["_draw"], lambda rows: F.least(rows, F.lit(n)), max_rows).first() if n > 0 else None
    if bound is None:
        return df.where(F.lit(False))
    below = drawn.where(F.col("_draw") < bound["_draw"])
    at = drawn.where(F.col("_draw") == bound["_draw"])
    return below.unionByName(at.orderBy(key).limit(n - below.count())).orderBy("_draw", key).select(*df.columns)


def even_sample(df: DataFrame, order: str, spread: Column, n: int) -> DataFrame:
    """``n`` rows evenly spaced in ``order``; all rows when there are no more. ``spread`` is a number
    that rises with ``order``."""
    one = df.withColumn("_all", F.lit(1)).withColumn("_spread", spread)
    placed = numbered(one, ["_all"], [order], ["_spread"], out="_at")
    total = one.groupBy("_all").agg(F.count(F.lit(1)).alias("_total"))
    step = F.greatest(F.col("_total"), F.lit(n)) / F.lit(n)
    slot = F.ceil((F.col("_at") - 1) / step)
    hit = (F.floor(slot * step) == F.col("_at") - 1) & (slot < n)
    return placed.join(F.broadcast(total), "_all").where((F.col("_total") <= n) | hit).select(*df.columns)


def median_run(runs: DataFrame, keys: Sequence[str], score: str, tie: str, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """The lower-middle run by score of each page. Pages with very many runs are narrowed to the middle, never sorted."""
    return nth_rows(runs, keys, [score, tie], lambda n: F.floor((n - 1) / 2) + 1, max_rows)


def performance_verdict(performance: Column, lcp_ms: Column, cls: Column) -> Column:
    """Pass on all three thresholds; a missing number fails."""
    return F.coalesce((performance >= 85) & (lcp_ms < 2500) & (cls < 0.1), F.lit(False))


STATIC_PATHS = [
    ("/", "daily", 1.0),
    ("/shop", "daily", 0.9),
    ("/shop/new-arrivals", "daily", 0.7),
    ("/shop/sale", "daily", 0.7),
    ("/blog", "weekly", 0.6),
]
RESERVED_HANDLES = ["blog", "shop", "product", "search", "cart", "api", "home"]


def sitemap_entries(collections: DataFrame, products: DataFrame, articles: DataFrame, pages: DataFrame, base: str) -> DataFrame:
    """Storefront sitemap ``url, lastmod, frequency, priority``: first kind wins a shared URL.

    Inputs: ``handle, updated``.
    """
    static = collections.sparkSession.createDataFrame(
        [(p, f, r) for p, f, r in STATIC_PATHS], "path string, frequency string, priority double"
    ).select(F.lit(0).alias("kind"), "path", F.lit(None).cast("string").alias("lastmod"), "frequency", "priority")

    def rows(df: DataFrame, kind: int, prefix: str, frequency: str, priority: float) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), F.concat(F.lit(prefix), "handle").alias("path"), F.col("updated").alias("lastmod"),
            F.lit(frequency).alias("frequency"), F.lit(priority).alias("priority"),
        )

    single = ~F.col("handle").rlike("-2$")
    every = union_all(
        [
            static,
            rows(collections.where(F.col("handle") != "frontpage"), 1, "/shop/", "daily", 0.8),
            rows(products, 2, "/product/", "weekly", 0.7),
            rows(articles.where(single), 3, "/blog/", "monthly", 0.5),
            rows(pages.where(single & ~F.col("handle").isin(*RESERVED_HANDLES)), 4, "/", "monthly", 0.4),
        ]
    ).withColumn("url", deployment_url(base, F.col("path")))
    value = F.struct("lastmod", "frequency", "priority")
    return every.groupBy("url").agg(F.min_by(value, "kind").alias("v")).select("url", "v.*")
