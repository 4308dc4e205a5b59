"""URL, redirect, crawl and content queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.html import ALLOWED_TAGS, DROP_VOID, DROP_WITH_CONTENT, ENTITIES, SELF_CLOSING, html_to_text, sanitize_html
from cartloom.functions.urls import normalize_url
from cartloom.operators import audit, graph, quality, redirects
from cartloom.operators.exceptions import union_all
from cartloom.plans.registry import query, table
from cartloom.sources.files import robots_rules, sitemap_locs

PATH_SQL = """
    SELECT page_id, url,
      CASE WHEN p = '' THEN '/' ELSE p END || CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_sort(q), '&') ELSE '' END AS path
    FROM (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)), '/+$', '') AS p,
      list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND x NOT LIKE 'utm_%') AS q FROM pages)
"""


@query("normalize_urls", f"SELECT page_id, path FROM ({PATH_SQL})")
def normalize_urls(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", normalize_url(F.col("url")).alias("path"))


HREF_SQL = """
    SELECT page_id, url, unnest(list_distinct(list_transform(regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*("[^"]*"|''[^'']*'')', 1), lambda v: substr(v, 2, length(v) - 2)))) AS href FROM pages
"""


@query(
    "link_frontier",
    f"""
    SELECT link, arg_min(url, page_id) AS referrer, count(DISTINCT url) AS referrers FROM (
      SELECT page_id, url, regexp_extract(url, '^https?://[^/?#]*') || href AS link FROM ({HREF_SQL})) GROUP BY link
    """,
)
def link_frontier(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct same-host links of all pages with the first page that has them."""
    return graph.link_frontier(table(spark, folder, "pages"), "page_id")


@query(
    "page_seo_audit",
    """
    SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, '' AS description, '' AS canonical,
      len(regexp_extract_all(html, '(?i)<h1[\\s>]')) AS h1_count, 0 AS json_ld_blocks FROM pages
    """,
)
def page_seo_audit(spark: SparkSession, folder: str) -> DataFrame:
    found = audit.seo_audit(table(spark, folder, "pages"), ["page_id"])
    return found.select(
        "page_id", "title", "description", "canonical", F.col("h1_count").cast("bigint"), F.col("json_ld_blocks").cast("int")
    )


@query(
    "seo_defects",
    """
    WITH t AS (SELECT trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages)
    SELECT d AS defect, CAST(page_id AS VARCHAR) AS key, NULL AS pages FROM pages CROSS JOIN (VALUES ('missing description'), ('missing canonical'), ('missing og:title')) v(d)
    UNION ALL SELECT 'duplicate title', title, count(*) FROM t WHERE title <> '' GROUP BY title HAVING count(*) > 1
    """,
)
def seo_defects(spark: SparkSession, folder: str) -> DataFrame:
    found = audit.seo_audit(table(spark, folder, "pages"), ["page_id"])
    return audit.seo_defects(found, "page_id").select("defect", "key", "pages")


SECRETS = [
    ("bearer or key word", r"(?i)\b(api[_-]?key|secret|token|password)\b"),
    ("long token", r"\b[A-Za-z0-9]{32,}\b"),
    ("access key shape", r"\b(?:sk|pk|re|gh)[-_][A-Za-z0-9_]{16,}"),
    ("private key block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]


@query(
    "secret_scan",
    "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT doc_id, '{n}' AS pattern, len(regexp_extract_all(text, '{p}')) AS hits FROM documents" for n, p in SECRETS)
    + ") WHERE hits > 0",
)
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Credential shapes per document over whole texts; only counts leave."""
    found = audit.secret_scan(table(spark, folder, "documents"), "doc_id", "text", SECRETS)
    return found.select("doc_id", "pattern", F.col("hits").cast("bigint"))


@query(
    "content_inventory",
    """
    SELECT page_id, len(regexp_extract_all(html, '<img[^>]+src="([^"]+)"', 1)) AS embedded_images,
      len(list_filter(regexp_extract_all(html, 'href="([^"]+)"', 1), lambda h: h LIKE '/%')) AS internal_links,
      html LIKE '%elementor%' AS page_builder FROM pages
    """,
)
def content_inventory(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.content_inventory(table(spark, folder, "pages"), F.col("html"), "https://shop.example.com", ["page_id"])
    return rows.select("page_id", *[F.col(c).cast("bigint").alias(c) for c in ("embedded_images", "internal_links")], "page_builder")


@query("content_words")
def content_words(spark: SparkSession, folder: str) -> DataFrame:
    """Words and shortcodes of all documents."""
    rows = quality.content_inventory(table(spark, folder, "documents"), F.col("text"), "https://shop.example.com", ["doc_id"])
    return rows.select("doc_id", "words", "shortcodes")


def sanitize_sql() -> str:
    """The rules step by step: comments, declarations, listed elements in their order, then every tag and run of text on its own.
    Only links carry attributes in the table."""
    def without(text: str) -> str:
        for tag in DROP_WITH_CONTENT:
            text = f"regexp_replace(regexp_replace({text}, '<{tag}\\b[^>]*>.*?</{tag}\\s*>', '', 'gis'), '</?{tag}\\b[^>]*>', '', 'gi')"
        for tag in DROP_VOID:
            text = f"regexp_replace({text}, '<{tag}\\b[^>]*>', '', 'gi')"
        return text

    names = ", ".join(f"'{t}'" for t in ALLOWED_TAGS)
    alone = ", ".join(f"'{t}'" for t in SELF_CLOSING)
    bare = "regexp_replace(html, '<!--.*?-->', '', 'gs')"
    link = "regexp_extract(t, 'href=\"([^\"]*)\"', 1)"
    safe = f"regexp_matches({link}, '(?i)^(https?:|mailto:|tel:|#|/([^/]|$))')"
    escaped = f"replace(replace(replace({link}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    plain = f"regexp_replace({without(bare)}, '<[^>]*>', ' ', 'g')"
    for entity, sign in ENTITIES:
        plain = f"regexp_replace({plain}, '&{entity};', '{sign}', 'gi')"
    return rf"""
    WITH p AS (SELECT page_id, regexp_extract_all({without(f"regexp_replace({bare}, '<!.*?>', '', 'gs')")}, '<[^>]*>|[^<]+|<') AS tokens,
        trim(regexp_replace({plain}, '\s+', ' ', 'g')) AS plain FROM pages),
    n AS (SELECT page_id, plain, list_transform(tokens, lambda t: struct_pack(t := t, n := lower(regexp_extract(t, '^</?([a-zA-Z][a-zA-Z0-9:-]*)', 1)))) AS tokens FROM p),
    m AS (SELECT page_id, plain, array_to_string(list_transform(tokens, lambda x: CASE WHEN x.n = '' THEN x.t WHEN x.n NOT IN ({names}) THEN ''
        WHEN x.t LIKE '</%' THEN CASE WHEN x.n IN ({alone}) THEN '' ELSE '</' || x.n || '>' END
        WHEN x.n IN ({alone}) THEN '<' || x.n || ' />'
        WHEN x.n = 'a' AND x.t LIKE '% href=%' AND {safe.replace("(t,", "(x.t,")} THEN '<a href="' || {escaped.replace("(t,", "(x.t,")} || '">'
        ELSE '<' || x.n || '>' END), '') AS markup FROM n)
    SELECT page_id, md5(regexp_replace(regexp_replace(markup, '[ \t]*\n[ \t\n]*', chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS markup,
      CASE WHEN length(plain) > 200 THEN rtrim(plain[1:199]) || '…' ELSE plain END AS excerpt FROM m
    """


@query("sanitize_pages", sanitize_sql())
def sanitize_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Display-safe markup and excerpts of whole pages."""
    clean = sanitize_html(F.col("html"))
    return table(spark, folder, "pages").select(
        "page_id", F.md5(clean).alias("markup"), html_to_text(F.col("html"), 200).alias("excerpt")
    )


MAP_SQL = """
    SELECT '/p/' || p_partkey AS source_path, CASE WHEN p_size = 1 THEN '/' WHEN p_size = 2 THEN '/p/' || p_partkey ELSE '/p/' || (p_partkey // 4) END AS destination,
      CASE WHEN p_partkey = 0 OR p_type = 'PROMO' THEN 'same_url' WHEN p_size = 50 THEN '410' WHEN p_type = 'LARGE' THEN 'client_decision' ELSE '301' END AS outcome, p_type AS source_type
    FROM part
"""


def part_map(spark: SparkSession, folder: str) -> DataFrame:
    """Redirects among parts: each to the one at a quarter of its number, with planted faults."""
    path = lambda c: F.concat(F.lit("/p/"), c.cast("string"))
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        path(key).alias("source_path"),
        F.when(F.col("p_size") == 1, "/").when(F.col("p_size") == 2, path(key)).otherwise(path(F.floor(key / 4))).alias("destination"),
        F.when((key == 0) | (F.col("p_type") == "PROMO"), "same_url")
        .when(F.col("p_size") == 50, "410")
        .when(F.col("p_type") == "LARGE", "client_decision")
        .otherwise("301")
        .alias("outcome"),
        F.col("p_type").alias("source_type"),
        F.when(F.col("p_type") == "ECONOMY", "server").otherwise("storefront").alias("owner"),
    )


@query(
    "collapse_chains",
    f"""
    WITH RECURSIVE m AS ({MAP_SQL}), e AS (SELECT source_path AS src, destination AS dst FROM m WHERE outcome = '301'),
    w AS (SELECT src AS start, dst AS node, 0 AS hops, [src] AS path FROM e
      UNION ALL SELECT w.start, e.dst, w.hops + 1, list_append(w.path, w.node) FROM w JOIN e ON e.src = w.node WHERE NOT list_contains(w.path, w.node) AND w.hops < 10),
    l AS (SELECT start, arg_max(node, hops) AS node, max(hops) AS hops FROM w GROUP BY 1)
    SELECT source_path, coalesce(node, destination) AS destination, CAST(coalesce(hops, 0) AS INT) AS collapsed FROM m LEFT JOIN l ON start = source_path
    """,
)
def collapse_chains(spark: SparkSession, folder: str) -> DataFrame:
    rows = graph.collapse_chains(part_map(spark, folder), moved=F.col("outcome") == "301")
    return rows.select("source_path", "destination", "collapsed")


@query(
    "map_integrity",
    f"""
    WITH m AS ({MAP_SQL}), r AS (SELECT * FROM m WHERE outcome = '301'), j AS (SELECT r.source_path AS source, r.destination, t.outcome FROM r LEFT JOIN m t ON t.source_path = r.destination)
    SELECT 'self-redirect' AS problem, source, destination FROM j WHERE source = destination
    UNION ALL SELECT 'redirect to home/empty', source, destination FROM j WHERE destination IN ('', '/')
    UNION ALL SELECT 'chain remains', source, destination FROM j WHERE outcome = '301'
    UNION ALL SELECT 'redirect to a 410 path', source, destination FROM j WHERE outcome = '410'
    """,
)
def map_integrity(spark: SparkSession, folder: str) -> DataFrame:
    return graph.map_integrity(part_map(spark, folder), moved=F.col("outcome") == "301", gone=F.col("outcome") == "410")


@query(
    "redirect_counts",
    f"""
    SELECT source_type, outcome, count(*) AS n, CAST(grouping(source_type, outcome) AS BIGINT) AS level FROM ({MAP_SQL})
    GROUP BY GROUPING SETS ((source_type, outcome), (source_type), (outcome), ())
    """,
)
def redirect_counts(spark: SparkSession, folder: str) -> DataFrame:
    return redirects.redirect_counts(part_map(spark, folder))


@query(
    "status_codes",
    f"""
    SELECT source_path, CASE outcome WHEN '301' THEN CASE WHEN source_type = 'ECONOMY' THEN '301' ELSE '308' END WHEN 'same_url' THEN '200' WHEN '410' THEN '410' ELSE '' END AS status_code FROM ({MAP_SQL})
    """,
)
def status_codes(spark: SparkSession, folder: str) -> DataFrame:
    return part_map(spark, folder).select("source_path", redirects.status_codes(F.col("outcome"), F.col("owner")).alias("status_code"))


@query(
    "resolve_request",
    f"""
    WITH m AS ({MAP_SQL})
    SELECT l_orderkey, l_linenumber, count(*) AS n, min(CASE outcome WHEN '410' THEN 410 WHEN '301' THEN 308 ELSE CASE WHEN l_linenumber > 3 THEN 308 END END) AS status,
      min(CASE outcome WHEN '301' THEN destination || CASE WHEN l_linestatus = 'O' THEN '?ref=x' ELSE '' END WHEN '410' THEN NULL ELSE CASE WHEN l_linenumber > 3 THEN CASE WHEN l_returnflag = 'R' THEN '/P/' ELSE '/p/' END || l_partkey || CASE WHEN l_linestatus = 'O' THEN '?ref=x' ELSE '' END END END) AS location
    FROM lineitem JOIN m ON source_path = '/p/' || l_partkey GROUP BY 1, 2
    """,
)
def resolve_request(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line asks for its part's old path, some in upper case or with extra slashes."""
    lines = table(spark, folder, "lineitem")
    prefix = F.when(F.col("l_returnflag") == "R", "/P/").otherwise("/p/")
    path = F.concat(prefix, F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") > 3, "//").otherwise(""))
    requests = lines.select(
        F.struct("l_orderkey", "l_linenumber").alias("request_id"), path.alias("path"), F.when(F.col("l_linestatus") == "O", "ref=x").alias("query")
    )
    rows = part_map(spark, folder)
    rules = rows.where(F.col("outcome") == "301").select(F.col("source_path").alias("source"), "destination", F.lit(True).alias("permanent"))
    answered = redirects.resolve_request(requests, rules, rows.where(F.col("outcome") == "410").select("source_path"))
    return answered.groupBy("request_id.l_orderkey", "request_id.l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.min("status").alias("status"), F.min("location").alias("location")
    )


@query(
    "priority_merge",
    f"""
    WITH k AS (SELECT page_id, path FROM ({PATH_SQL})),
    l AS (SELECT DISTINCT coalesce(nullif(lower(regexp_replace(href, '/+$', '')), ''), '/') AS path FROM ({HREF_SQL})),
    r AS (SELECT path AS source_path, 1 AS priority, 'page' AS source_type, 'pages' AS evidence FROM k
      UNION ALL SELECT path, 2, 'link', 'linked' FROM l
      UNION ALL SELECT path, 3, 'copy', 'again' FROM k WHERE path LIKE '%?%')
    SELECT source_path, arg_min(source_type, priority) AS source_type, string_agg(DISTINCT evidence, '; ' ORDER BY evidence) AS texts FROM r GROUP BY 1
    """,
)
def priority_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of pages, then of links, then query copies: the first source decides."""
    pages = table(spark, folder, "pages")
    paths = pages.select(normalize_url(F.col("url")).alias("source_path"))
    hrefs = graph.link_frontier(pages, "page_id").select(F.regexp_extract("link", "^https?://[^/]*(.*)$", 1).alias("href"))
    links = hrefs.select(normalize_url(F.col("href")).alias("source_path"))

    def source(df: DataFrame, priority: int, kind: str, evidence: str) -> DataFrame:
        return df.select("source_path", F.lit(priority).alias("priority"), F.lit(kind).alias("source_type"), F.lit(evidence).alias("evidence"))

    merged = redirects.priority_merge(
        union_all(
            [
                source(paths, 1, "page", "pages"),
                source(links, 2, "link", "linked"),
                source(paths.where(F.col("source_path").contains("?")), 3, "copy", "again"),
            ]
        )
    )
    return merged.select("source_path", "source_type", F.array_join(F.array_sort(F.split("evidence", "; ")), "; ").alias("texts"))


@query(
    "category_paths",
    """
    WITH c AS (SELECT r_regionkey + 1 AS id, lower(r_name) AS slug, 0 AS parent FROM region
      UNION ALL SELECT n_nationkey + 101, lower(n_name), n_regionkey + 1 FROM nation),
    f AS (SELECT c.id, c.slug, CASE WHEN p.slug IS NULL THEN c.slug ELSE p.slug || '/' || c.slug END AS chain FROM c LEFT JOIN c p ON p.id = c.parent)
    SELECT CAST(id AS BIGINT) AS id, '/product-category/' || chain AS path, false AS alias FROM f
    UNION ALL SELECT CAST(id AS BIGINT), '/product-category/' || slug, true FROM f WHERE chain <> slug
    """,
)
def category_paths(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region").select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("id"), F.lower("r_name").alias("slug"), F.lit(0).cast("bigint").alias("parent")
    )
    nations = table(spark, folder, "nation").select(
        (F.col("n_nationkey") + 101).cast("bigint").alias("id"), F.lower("n_name").alias("slug"), (F.col("n_regionkey") + 1).cast("bigint").alias("parent")
    )
    return graph.category_paths(regions.unionByName(nations)).select("id", "path", "alias")


@query(
    "classify_tags",
    """
    WITH t AS (SELECT DISTINCT trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, p_type FROM part)
    SELECT slug, p_type, CASE WHEN slug LIKE '%red%' THEN '/shop/clubs/red-club' WHEN regexp_matches(slug, '(^|-)blue(-|$)') THEN '/shop/blue'
      WHEN slug LIKE '%ring%' THEN '/shop/accessories' WHEN slug LIKE '%bolt%' THEN '/shop/tops' WHEN p_type = 'PROMO' THEN '' ELSE '/shop' END AS destination,
      CASE WHEN slug LIKE '%red%' OR regexp_matches(slug, '(^|-)blue(-|$)') OR slug LIKE '%ring%' OR slug LIKE '%bolt%' THEN '301' WHEN p_type = 'PROMO' THEN '410' ELSE '301' END AS outcome
    FROM t
    """,
)
def classify_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Part names read as tags; a promotion counts as an empty, unlisted archive."""
    from cartloom.functions.text import slugify

    rules = redirects.TagRules(clubs=[("red", "red-club")], surfaces=["blue"], types=[("ring", "accessories"), ("bolt", "tops")])
    tags = table(spark, folder, "part").select(slugify(F.col("p_name")).alias("slug"), "p_type").distinct()
    d = redirects.classify_tag(F.col("slug"), F.when(F.col("p_type") == "PROMO", 0).otherwise(1), F.lit(False), rules)
    return tags.select("slug", "p_type", d["destination"].alias("destination"), d["outcome"].alias("outcome"))


@query(
    "product_dispositions",
    """
    WITH p AS (SELECT DISTINCT CASE WHEN p_size > 40 THEN replace(p_name, ' ', '-') || '-' || lower(p_type) || '-2' ELSE replace(p_name, ' ', '-') || CASE WHEN p_type = 'SMALL' THEN '' ELSE '-' || lower(p_type) END END AS slug,
      CASE WHEN p_type = 'PROMO' THEN 'draft' ELSE 'publish' END AS status FROM part)
    SELECT '/product/' || slug AS source_path, status AS source_status, CASE WHEN status = 'publish' AND slug NOT LIKE '%-2' THEN 'same_url' ELSE 'client_decision' END AS outcome,
      status = 'publish' AND slug LIKE '%-2' AND regexp_replace(slug, '-2$', '') IN (SELECT slug FROM p) AS twin FROM p
    """,
)
def product_dispositions(spark: SparkSession, folder: str) -> DataFrame:
    name, kind = F.translate("p_name", " ", "-"), F.lower("p_type")
    slug = F.when(F.col("p_size") > 40, F.concat(name, F.lit("-"), kind, F.lit("-2"))).otherwise(
        F.concat(name, F.when(F.col("p_type") == "SMALL", "").otherwise(F.concat(F.lit("-"), kind)))
    )
    products = table(spark, folder, "part").select(
        slug.alias("slug"), F.when(F.col("p_type") == "PROMO", "draft").otherwise("publish").alias("status")
    ).distinct()
    rows = redirects.product_dispositions(products)
    return rows.select("source_path", "source_status", "outcome", F.col("reason").startswith("duplicate handle").alias("twin"))


@query(
    "held_products",
    """
    WITH r AS (SELECT CAST(p_partkey AS VARCHAR) AS handle, 'oversize:product:' || p_partkey AS ref FROM part WHERE p_size > 45),
    a AS (SELECT CAST(p_partkey AS VARCHAR) AS handle FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09 AND l_quantity > 40))
    SELECT coalesce(r.handle, a.handle) AS handle, coalesce(ref, 'not in the load ledger') AS ref,
      concat_ws(',', CASE WHEN a.handle IS NOT NULL THEN 'absent from the load ledger' END, CASE WHEN r.handle IS NOT NULL THEN 'exception register' END) AS why
    FROM r FULL JOIN a ON a.handle = r.handle
    """,
)
def held_products(spark: SparkSession, folder: str) -> DataFrame:
    """Oversize parts are held by the register; parts without a large discounted line are not loaded."""
    part = table(spark, folder, "part")
    key = F.col("p_partkey").cast("string")
    register = part.where(F.col("p_size") > 45).select(
        F.lit("product").alias("record_type"), key.alias("record_id"), key.alias("record_ref"), F.lit("critical").alias("severity"),
        F.lit("oversize").alias("code"), F.lit("needs-decision").alias("retry_status"),
    )
    big = table(spark, folder, "lineitem").where((F.col("l_discount") > 0.09) & (F.col("l_quantity") > 40))
    loaded = big.select(F.col("l_partkey").cast("string").alias("handle")).distinct()
    held = redirects.held_products(register, loaded, part.select(key.alias("slug")))
    return held.select("handle", "ref", F.array_join("why", ",").alias("why"))


@query(
    "walk_hops",
    f"""
    WITH RECURSIVE m AS ({MAP_SQL}), e AS (SELECT source_path AS src, destination AS dst FROM m WHERE outcome = '301'),
    w AS (SELECT source_path AS start, source_path AS node, 0 AS hops, []::VARCHAR[] AS path FROM m
      UNION ALL SELECT w.start, e.dst, w.hops + 1, list_append(w.path, w.node) FROM w JOIN e ON e.src = w.node WHERE NOT list_contains(w.path, w.node) AND w.hops < 5),
    l AS (SELECT start, arg_max(node, hops) AS final_url, CAST(max(hops) AS INT) AS hops FROM w GROUP BY 1)
    SELECT start, hops, final_url, CASE t.outcome WHEN '301' THEN NULL WHEN '410' THEN 410 WHEN 'client_decision' THEN 404 WHEN 'same_url' THEN 200 END AS final_status
    FROM l LEFT JOIN m t ON t.source_path = final_url
    """,
)
def walk_hops(spark: SparkSession, folder: str) -> DataFrame:
    """Stored answers of all old paths walked to their end, at most five hops."""
    rows = part_map(spark, folder)
    status = F.when(F.col("outcome") == "301", 301).when(F.col("outcome") == "410", 410).when(F.col("outcome") == "same_url", 200).otherwise(404)
    fetches = rows.select(
        F.col("source_path").alias("url"), status.alias("status"), F.when(F.col("outcome") == "301", F.col("destination")).alias("location")
    )
    ends = graph.walk_hops(fetches, fetches.select("url"), 5)
    return ends.select("start", "hops", "final_url", "final_status")


@query(
    "grade_redirects",
    f"""
    WITH RECURSIVE m AS ({MAP_SQL}), e AS (SELECT source_path AS src, destination AS dst FROM m WHERE outcome = '301'),
    w AS (SELECT source_path AS start, source_path AS node, 0 AS hops, []::VARCHAR[] AS path FROM m
      UNION ALL SELECT w.start, e.dst, w.hops + 1, list_append(w.path, w.node) FROM w JOIN e ON e.src = w.node WHERE NOT list_contains(w.path, w.node) AND w.hops < 5),
    l AS (SELECT start, arg_max(node, hops) AS landed, max(hops) AS walked FROM w GROUP BY 1),
    g AS (SELECT m.*, l.landed, l.walked + CASE WHEN m.source_type = 'ECONOMY' THEN 1 ELSE 0 END AS hops, t.outcome AS last,
      CASE m.outcome WHEN 'same_url' THEN m.source_path ELSE m.destination END AS target
      FROM m JOIN l ON start = m.source_path LEFT JOIN m t ON t.source_path = l.landed)
    SELECT source_path, CASE WHEN outcome = 'client_decision' THEN 'skipped' WHEN last IS NULL OR last = '301' THEN 'fail'
      WHEN outcome = '410' THEN CASE WHEN hops = 0 THEN 'gone_410_ok' ELSE 'multi_hop' END
      WHEN landed <> target THEN 'wrong_destination' WHEN last = 'same_url' THEN CASE WHEN hops <= 1 THEN 'single_hop_ok' ELSE 'multi_hop' END
      WHEN last = 'client_decision' AND target LIKE '/p/1%' THEN 'destination_404' ELSE 'fail' END AS result FROM g
    """,
)
def grade_redirects(spark: SparkSession, folder: str) -> DataFrame:
    """All map rows graded from the walked answers. Paths that the server owns take one hop more (their slash goes
    first); pages under ``/p/1`` are not built yet."""
    rows = part_map(spark, folder)
    owners = rows.select("source_path", F.when(F.col("owner") == "server", 1).otherwise(0).alias("_slash"))
    ends = walk_hops(spark, folder).select(
        F.col("start").alias("source_path"), "hops", F.col("final_url").alias("final_path"), "final_status"
    )
    seen = ends.join(owners, "source_path").withColumn("hops", F.col("hops") + F.col("_slash")).drop("_slash")
    return redirects.grade_redirects(rows, seen, unbuilt=["/p/1"]).select("source_path", "result")


@query(
    "map_vs_ledger",
    """
    SELECT '/product/' || p_partkey AS source_path, CAST(p_partkey AS VARCHAR) AS handle FROM part
    WHERE p_type <> 'PROMO' AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09 AND l_quantity > 40)
    """,
)
def map_vs_ledger(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select(
        F.concat(F.lit("/product/"), F.col("p_partkey").cast("string")).alias("source_path"),
        F.when(F.col("p_type") == "PROMO", "client_decision").otherwise("same_url").alias("outcome"),
    )
    big = table(spark, folder, "lineitem").where((F.col("l_discount") > 0.09) & (F.col("l_quantity") > 40))
    return redirects.map_vs_ledger(rows, big.select(F.col("l_partkey").cast("string").alias("handle")))


@query(
    "url_inventory",
    """
    WITH s AS (SELECT url FROM pages WHERE url LIKE 'https:%')
    SELECT url, 'sitemap:page-sitemap' AS source, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS proposed_destination FROM s
    UNION ALL SELECT url, 'content:page', regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) FROM pages WHERE url NOT IN (SELECT url FROM s)
    UNION ALL SELECT 'https://shop.example.com/product/' || p_partkey, 'shop:product', '' FROM part
    """,
)
def url_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with https are in the sitemap; the rest and all parts come from their own tables."""
    pages, none = table(spark, folder, "pages"), F.lit(None).cast("string")
    listed = pages.where(F.col("url").startswith("https:")).select(F.lit("page-sitemap").alias("sitemap"), F.col("url").alias("loc"), none.alias("lastmod"))
    shop = table(spark, folder, "part").select(
        F.concat(F.lit("https://shop.example.com/product/"), F.col("p_partkey").cast("string")).alias("permalink"), F.lit("publish").alias("status"), none.alias("date_modified")
    )
    content = pages.select(F.lit("page").alias("kind"), F.col("url").alias("link"), F.lit("publish").alias("status"), none.alias("modified"))
    return quality.url_inventory(listed, shop, content).select("url", "source", "proposed_destination")


@query("sitemap_locs", "SELECT 'page-' || (page_id % 7) AS sitemap, url AS loc, CASE WHEN page_id % 2 = 0 THEN '2024-01-01' END AS lastmod FROM pages")
def read_sitemaps(spark: SparkSession, folder: str) -> DataFrame:
    """Each page's address written as sitemap XML and read back."""
    lastmod = F.when(F.col("page_id") % 2 == 0, "<lastmod>2024-01-01</lastmod>").otherwise("")
    docs = table(spark, folder, "pages").select(
        F.concat(F.lit("page-"), (F.col("page_id") % 7).cast("string")).alias("sitemap"),
        F.concat(F.lit("<urlset><url>\n<loc> "), "url", F.lit("</loc>"), lastmod, F.lit("</url></urlset>")).alias("xml"),
    )
    return sitemap_locs(docs)


@query(
    "robots_rules",
    """
    SELECT page_id AS site, 2 AS line, 'disallow' AS rule, '/' || page_id AS value FROM pages
    UNION ALL SELECT page_id, 3, 'allow', '/' FROM pages UNION ALL SELECT page_id, 5, 'sitemap', url FROM pages
    """,
)
def read_robots(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat(
        F.lit("User-agent: *\nDisallow: /"), F.col("page_id").cast("string"), F.lit("\n Allow : /*\n# none\nSITEMAP: "), "url", F.lit("\n")
    )
    docs = table(spark, folder, "pages").select(F.col("page_id").alias("site"), text.alias("text"))
    return robots_rules(docs)
