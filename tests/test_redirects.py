"""Redirect map of the small shop: precedence, holds, chains, integrity, artefacts, grading."""

import pytest
from pyspark.sql import functions as F

import shopdata
from cartloom.operators import audit, graph, redirects
from cartloom.operators.catalog import classified_products
from cartloom.sources import files

HOSTS = ["www.old-shop.invalid"]
PAGE_RULES = [("about", "same_url", "/about", "storefront", "kept", False), ("cart-2", "410", "", "storefront", "retired", False)]


@pytest.fixture(scope="module")
def mapped(spark, shop):
    source, _ = shop
    fields = "slug string, outcome string, destination string, owner string, reason string, needs_decision boolean"
    rules = redirects.MapRules(
        pages=spark.createDataFrame(PAGE_RULES, fields),
        categories=spark.createDataFrame([("t-shirts", "/shop/tops", "tops"), ("kids", None, "ask")], "slug string, destination string, reason string"),
        hosts=HOSTS,
    )
    plugin = spark.createDataFrame([("old-a", "old-b", 1), ("old-b", "product/beach-tee", 2), ("old-c", "nowhere", 3)], "origin string, target string, seq int")
    return redirects.redirect_inventory(source.tables, rules, plugin).cache()


def by_path(df):
    return {r.source_path: r for r in df.collect()}


def test_inventory(mapped):
    rows = by_path(mapped)
    tee = rows["/product/beach-tee"]
    # slug shared by a draft: the published one is not guaranteed, but one row decides
    assert tee.source_type == "product" and "sitemap:product-sitemap.xml" in tee.evidence
    assert rows["/old-a"].destination == "/product/beach-tee" and "chain collapsed" in rows["/old-a"].reason and rows["/old-c"].outcome == "client_decision"
    assert rows["/about"].outcome == "same_url" and rows["/about"].evidence == "pages; menu_items"
    assert rows["/first"].destination == "/blog/first"
    assert rows["/product-category/t-shirts/kids"].outcome == "client_decision" and rows["/product-category/t-shirts"].outcome == "301"
    assert rows["/product-category/kids"].source_type == "product_category"
    assert rows["/product-tag/polo-day"].destination == "/shop/tops" and rows["/product-tag/gone"].outcome == "410"
    assert rows["/old-thing"].source_type == "sitemap_other" and rows["/tag/news/feed"].outcome == "410" and rows["/feed"].outcome == "410"


def test_unmapped_category_fails(spark):
    paths = spark.createDataFrame([("new", "/product-category/new", False)], "slug string, path string, alias boolean")
    table = spark.createDataFrame([("old", "/shop", "r")], "slug string, destination string, reason string")
    with pytest.raises(Exception, match="no disposition for category new"):
        redirects.category_dispositions(paths, table).collect()


def test_holds(spark, shop, mapped):
    source, records = shop
    loaded = records["products"].where("not held").select("handle")
    register = records["exceptions"].unionByName(
        spark.createDataFrame(
            [("product", "99", "plain-sock", "load", "high", "record_held_from_load", "m", "client", "resolved", "{}")], records["exceptions"].schema
        )
    )
    held = {r.handle: r for r in redirects.held_products(register, loaded, source["products"]).collect()}
    assert set(held) == {"kit-jersey", "gift-bundle"}
    assert held["kit-jersey"].ref.startswith("attribute_needs_decision:product:11") and len(held["kit-jersey"].why) == 2
    assert held["gift-bundle"].why == ["absent from the load ledger"] and held["gift-bundle"].ref == "not in the load ledger"
    only = redirects.held_products(register, None, source["products"]).collect()
    assert [r.handle for r in only] == ["kit-jersey"]
    classified = classified_products(source["products"])
    homes = classified.select(
        F.col("slug").alias("handle"), redirects.primary_collection(F.col("clubs"), F.col("type_handle"), F.col("type_how"), F.col("surface")).alias("c")
    ).select("handle", "c.*")
    held_df = redirects.held_products(register, loaded, source["products"])
    applied = redirects.apply_held(mapped, held_df, homes)
    jersey = by_path(applied)["/product/kit-jersey"]
    assert (jersey.outcome, jersey.destination, jersey.needs_decision) == (redirects.HELD, "/shop/clubs/teamwear", True)
    assert applied.count() == mapped.count()
    assert {r.handle for r in redirects.map_vs_ledger(mapped, loaded).collect()} == {"kit-jersey", "gift-bundle"}
    assert not redirects.map_vs_ledger(applied, loaded).count()
    # the row flips back once the product loads
    none = redirects.held_products(register.limit(0), source["products"].select(F.col("slug").alias("handle")), source["products"])
    assert by_path(redirects.apply_held(mapped, none, homes))["/product/kit-jersey"].outcome == "same_url"


def faulty(spark):
    rows = [("/a", "/b", "301"), ("/b", "/c", "301"), ("/c", "/d", "301"), ("/self", "/self", "301"), ("/home", "/", "301"), ("/dead", "/gone", "301"), ("/gone", "", "410"), ("/x", "/y", "301"), ("/y", "/x", "301")]
    return spark.createDataFrame(rows, "source_path string, destination string, outcome string")


def test_chains_and_integrity(spark):
    moved, gone = F.col("outcome") == "301", F.col("outcome") == "410"
    rows = faulty(spark)
    problems = {(r.problem, r.source) for r in graph.map_integrity(rows, moved=moved, gone=gone).collect()}
    assert {("self-redirect", "/self"), ("redirect to home/empty", "/home"), ("redirect to a 410 path", "/dead"), ("chain remains", "/a")} <= problems
    done = by_path(graph.collapse_chains(rows, moved=moved))
    assert (done["/a"].destination, done["/a"].collapsed, done["/b"].destination, done["/c"].collapsed) == ("/d", 2, "/d", 0)
    left = {r.source for r in graph.map_integrity(graph.collapse_chains(rows, moved=moved), moved=moved, gone=gone).collect() if r.problem == "chain remains"}
    assert left <= {"/self", "/x", "/y"}


def test_long_chain_stops_at_the_bound(spark):
    rows = spark.createDataFrame([(f"/{i}", f"/{i + 1}") for i in range(15)], "source_path string, destination string")
    done = by_path(graph.collapse_chains(rows, max_hops=10))
    assert (done["/0"].destination, done["/0"].collapsed) == ("/11", 10) and done["/9"].destination == "/15"


def test_artifacts_and_requests(spark, mapped, tmp_path):
    parts = files.redirect_artifacts(mapped, str(tmp_path))
    rules, gone = parts["redirects"], parts["gone"]
    assert not rules.where(F.col("source").contains("?")).count() and "/product-tag/gone" in {r.source_path for r in gone.collect()}
    asked = spark.createDataFrame(
        [(1, "/first/", "q=1"), (2, "/Product-Tag/GONE", ""), (3, "//about//", "a=b"), (4, "/about", ""), (5, "/product-tag/polo-day", None)], "request_id int, path string, query string"
    )
    got = {r.request_id: (r.status, r.location) for r in redirects.resolve_request(asked, rules, gone).collect()}
    assert got == {1: (308, "/blog/first?q=1"), 2: (410, None), 3: (308, "/about?a=b"), 4: (None, None), 5: (308, "/shop/tops")}


def test_grading(spark):
    rows = spark.createDataFrame(
        [("/a", "301", "/x"), ("/b", "301", "/x"), ("/c", "410", ""), ("/d", "same_url", "/d"), ("/e", "301", "/new/x"), ("/f", "client_decision", ""), ("/g?x", "301", "/x"), ("/h", "410", ""), ("/i", "301", "/x"), ("/j", "301", "/x")],
        "source_path string, outcome string, destination string",
    )
    walks = spark.createDataFrame(
        [("/a", 1, "/x?q", 200), ("/b", 2, "/x", 200), ("/c", 0, "/c", 410), ("/d", 1, "/d", 200), ("/e", 1, "/new/x", 404), ("/h", 1, "/h", 410), ("/i", 1, "/z", 200), ("/j", 1, "/x", 500)],
        "source_path string, hops int, final_path string, final_status int",
    )
    got = {r.source_path: r.result for r in redirects.grade_redirects(rows, walks, ["/new/"]).collect()}
    assert got == {
        "/a": "single_hop_ok", "/b": "multi_hop", "/c": "gone_410_ok", "/d": "single_hop_ok", "/e": "destination_404", "/f": "skipped", "/g?x": "skipped",
        "/h": "multi_hop", "/i": "wrong_destination", "/j": "fail",
    }
    fetches = spark.createDataFrame([("/a", 308, "/x"), ("/c", 200, None)], "source_path string, status int, location_path string")
    ok = {r.source_path: r.ok for r in redirects.canonical_check(rows, fetches).collect()}
    assert ok["/a"] and not ok["/c"] and not ok["/d"] and "/f" not in ok


def test_outcome_table(mapped):
    total = redirects.redirect_counts(mapped).where("level = 3").first().n
    wide = redirects.outcome_table(mapped, ["301", "410", "same_url", "client_decision"]).collect()
    assert total == mapped.count() == sum(r["301"] + r["410"] + r["same_url"] + r["client_decision"] for r in wide)


def test_crawl_and_headers(spark):
    fetches = spark.createDataFrame(
        [("page", "/a", 200, "/a", "(seed)"), ("page", "/b", 404, "/b", "/a"), ("image", "/i", 206, "/i", "/a")], "kind string, url string, status int, final_url string, referrer string"
    )
    assert [(r.url, r.referrer) for r in audit.failed_fetches(fetches).collect()] == [("/b", "/a")]
    assert {(r.kind, r.status): r.n for r in audit.status_distribution(fetches).collect()} == {("page", 200): 1, ("page", 404): 1, ("image", 206): 1}
    probes = spark.createDataFrame(
        [("/o", 308, "/n", 308, 1, 200, "https://s/n/"), ("/p", 308, "/n", 302, 1, 200, "https://s/n")], "source string, expect_code int, expect_dest string, first_status int, hops int, final_status int, final_url string"
    )
    verdicts = audit.redirect_verdicts(probes, "https://s")
    gone = audit.gone_verdicts(spark.createDataFrame([("/g", 0, 410, 410), ("/h", 1, 308, 410)], "source string, hops int, first_status int, final_status int"))
    assert [r.passed for r in verdicts.orderBy("source").collect()] == [True, False] and [r.direct for r in gone.orderBy("source").collect()] == [True, False]
    assert {r.check: r.failing for r in audit.crawl_summary(fetches, verdicts, gone).collect()} == {"page": 1, "image": 0, "redirect": 1, "gone": 0}
    headers = spark.createDataFrame([("/", {"strict-transport-security": "max-age=100", "x-content-type-options": "NoSniff", "content-security-policy": "frame-ancestors 'none'"})], "url string, headers map<string,string>")
    ok = {r.header: r.ok for r in audit.security_header_checks(headers).collect()}
    assert ok == {
        "strict-transport-security": False, "x-content-type-options": True, "referrer-policy": False, "x-frame-options": True,
        "content-security-policy": True, "permissions-policy": False, "x-robots-tag": True,
    }
    assert spark.range(1).select(audit.performance_verdict(F.lit(90), F.lit(2400.0), F.lit(0.05)), audit.performance_verdict(F.lit(90), F.lit(None).cast("double"), F.lit(0.0))).first()[:] == (True, False)


def test_samples(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = [[r.k for r in audit.deterministic_sample(df.repartition(n), "k", 20, 7).collect()] for n in (1, 5)]
    assert a == b and len(set(a)) == 20 and a != [r.k for r in audit.deterministic_sample(df, "k", 20, 8).collect()]
    even = sorted(r.k for r in audit.even_sample(df, "k", F.col("k"), 8).collect())
    assert even == [int(i * 1000 / 8) for i in range(8)]
    assert audit.even_sample(df, "k", F.col("k"), 5000).count() == 1000


def test_page_metadata(spark):
    html = """<head><title> Home </title><meta content="About us" name="description"><link rel="canonical" href="https://s/"><meta property='og:title' content='T'>
    <script type="application/ld+json">{"@type":"Product","offers":{"@type":"Offer"}}</script><script type="application/ld+json">{bad</script></head><h1>a</h1><h1 class=x>b</h1>"""
    pages = spark.createDataFrame([(1, html), (2, "<title>Home</title>")], "page int, html string")
    found = audit.seo_audit(pages, ["page"]).orderBy("page").collect()
    assert (found[0].title, found[0].description, found[0].canonical, found[0].og_title, found[0].h1_count) == ("Home", "About us", "https://s/", "T", 2)
    assert (found[0].json_ld_blocks, found[0].json_ld_valid, found[0].json_ld_types, found[1].json_ld_valid) == (2, False, ["Product", "Offer"], None)
    defects = {(r.defect, r.key) for r in audit.seo_defects(audit.seo_audit(pages, ["page"]), "page").collect()}
    assert {("duplicate title", "Home"), ("missing canonical", "2"), ("invalid JSON-LD", "1"), ("h1 count is not one", "1")} <= defects
    frontier = graph.image_frontier(spark.createDataFrame([(1, "/p", '<img src="/_next/image?url=%2Fa.png&w=1"><img src="/a.png">')], "n int, url string, html string"), "n").collect()
    assert [(r.image, r.referrer) for r in frontier] == [("/a.png", "/p")]
    assert shopdata.SITE.startswith("https")


def brute_walk(edges, start, bound):
    at, hops, seen = start, 0, set()
    while True:
        if at not in edges:
            return at, hops, "end"
        if at in seen:
            return at, hops, "loop"
        if hops == bound:
            return at, hops, "bound"
        seen.add(at)
        at, hops = edges[at], hops + 1


@pytest.mark.parametrize("bound", [None, 0, 1, 5, 6, 100])
def test_walk_against_brute_force(spark, bound):
    import random

    from cartloom.operators.graph import walk

    rnd = random.Random(4)
    edges = {f"n{i}": f"n{rnd.randrange(60)}" for i in range(0, 60) if rnd.random() < 0.9}
    edges |= {f"c{i}": f"c{i + 1}" for i in range(37)} | {"self": "self", "into": "self"}
    df = spark.createDataFrame(list(edges.items()), "src string, dst string")
    nodes = sorted(set(edges) | set(edges.values()))
    found = walk(spark.createDataFrame([(n,) for n in nodes], "start string"), df, bound)
    got = {r.start: (r["at"], r.hops, r.ended) for r in found.collect()}
    assert got == {n: brute_walk(edges, n, bound) for n in nodes}


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """5,000 hops and a loop of 1,000: rounds grow with the logarithm."""
    from cartloom.operators import graph

    rounds, real = [], graph.checkpointed
    monkeypatch.setattr(graph, "checkpointed", lambda df: rounds.append(1) or real(df))
    chain = [(f"c{i}", f"c{i + 1}") for i in range(5000)]
    ends = {r.source_path: (r.destination, r.collapsed) for r in graph.collapse_chains(
        spark.createDataFrame(chain, "source_path string, destination string"), max_hops=None).collect()}
    assert ends["c0"] == ("c5000", 4999) and ends["c4998"] == ("c5000", 1) and ends["c4999"] == ("c5000", 0) and len(rounds) < 20
    rounds.clear()
    loop = [(f"l{i}", f"l{(i + 1) % 1000}") for i in range(1000)] + [("t0", "t1"), ("t1", "l5")]
    found = {r.start: (r["at"], r.hops, r.ended) for r in graph.walk(
        spark.createDataFrame([("t0",), ("l7",)], "start string"), spark.createDataFrame(loop, "src string, dst string"), None).collect()}
    assert found == {"t0": ("l5", 1002, "loop"), "l7": ("l7", 1000, "loop")} and len(rounds) < 30
