"""Body images: scan, resolve, rewrite, rewrite again."""

import pytest
from pyspark.sql import functions as F

from cartloom.operators import listing, media

UP = "https://www.s.invalid/wp-content/uploads"
BODY = (
    f'<img src="/wp-content/uploads/a-300x200.jpg" data-src="{UP}/b.jpg" srcset="{UP}/a-300x200.jpg 300w, {UP}/a.jpg 900w" sizes="9vw">'
    f'<img src="https://else.invalid/wp-content/uploads/x.jpg"><a href="//s.invalid/wp-content/uploads/f%20g.pdf">f</a><img src="{UP}/lost-20x20.png" srcset="{UP}/lost-20x20.png 1x, {UP}/a.jpg 2x">'
)


@pytest.fixture(scope="module")
def frames(spark):
    docs = spark.createDataFrame([("d", BODY), ("e", "<p>none</p>"), ("f", None)], "handle string, body_html string")
    rows = [(1, f"{UP}/a.jpg", "Alt", "image/jpeg"), (2, f"{UP}/b.jpg", "", "image/jpeg"), (3, "https://s.invalid/wp-content/uploads/f g.pdf", "", "application/pdf")]
    table = spark.createDataFrame(rows, "id long, source_url string, alt_text string, mime_type string").withColumn(
        "guid", F.lit(None).cast("struct<rendered:string,raw:string>")
    )
    hosts = media.upload_hosts(table, "https://s.invalid")
    refs = media.body_references(docs, hosts, "s.invalid", ["handle"])
    return docs, table, hosts, media.resolve_references(refs, table)


def test_scan_and_resolve(frames):
    _, _, hosts, resolved = frames
    assert [r.host for r in hosts.collect()] == ["s.invalid"]
    found = sorted((r.attr, r.raw, r.source_url, r.resolved) for r in resolved.collect())
    assert ("data-src", f"{UP}/b.jpg", f"{UP}/b.jpg", True) in found and not any("else.invalid" in f[1] for f in found)
    assert ("href", "//s.invalid/wp-content/uploads/f%20g.pdf", "https://s.invalid/wp-content/uploads/f g.pdf", True) in found
    assert [f for f in found if not f[3]] == [("src", f"{UP}/lost-20x20.png", f"{UP}/lost-20x20.png", False), ("srcset", f"{UP}/lost-20x20.png", f"{UP}/lost-20x20.png", False)]
    assert len(media.media_spellings(resolved).collect()) == 3


def test_rewrite_is_complete_and_idempotent(spark, frames):
    docs, table, hosts, resolved = frames
    ledger = table.select(F.lit("File").alias("resource"), F.col("source_url").alias("key"), "id", F.lit("").alias("checksum"), F.lit("{}").alias("payload"))
    urls = media.target_urls(ledger, "https://cdn.invalid")
    once = media.rewrite_bodies(docs, resolved, urls, ["handle"])
    row = {r.handle: r for r in once.collect()}
    body = row["d"].body_html
    assert body.count("https://cdn.invalid/a.jpg?v=1") == 2 or "a.jpg?v=1 2x" in body
    assert "f%20g.pdf?v=3" in body and "sizes" not in body.split("else.invalid")[0]
    assert f'{UP}/lost-20x20.png 1x, https://cdn.invalid/a.jpg?v=1 2x' in body and "https://else.invalid/wp-content/uploads/x.jpg" in body
    assert (row["d"].references, row["d"].left) == (row["d"].rewritten + 2, 2) and row["e"].references == 0 and row["f"].body_html is None
    left = media.residual_references(once, hosts, "s.invalid", ["handle"]).collect()
    assert [(r.handle, r.residual) for r in left] == [("d", 2)]
    docs2 = once.select("handle", "body_html")
    again = media.resolve_references(media.body_references(docs2, hosts, "s.invalid", ["handle"]), table)
    twice = media.rewrite_bodies(docs2, again, urls, ["handle"])
    assert {r.handle: r.body_html for r in twice.collect()} == {r.handle: r.body_html for r in once.collect()}


def test_content_views(spark):
    seo = "struct<title:string,description:string>"
    pages = spark.createDataFrame(
        [("about", "<p onclick=x>Hi</p>", "", None, "2024"), ("shop", "<p>x</p>", "s", None, "2024"), ("faq", "<p>y</p>", " sum ", "d", "2025"), ("faq-2", "", "", None, None)],
        "handle string, body string, summary string, d string, published_at string",
    ).withColumn("seo", F.struct(F.lit(" T ").alias("title"), F.col("d").alias("description")).cast(seo))
    rows = {r.handle: r for r in listing.content_view(pages, "body", "summary").collect()}
    assert set(rows) == {"about", "faq", "faq-2"}
    assert (rows["about"].html, rows["about"].description, rows["faq"].description, rows["faq-2"].description, rows["faq"].seo_title) == ("<p>Hi</p>", "Hi", "d", None, "T")
    assert [r.handle for r in listing.article_list(pages).collect()] == ["faq", "about", "shop"]


def test_media_lookups_are_merged(spark):
    """Media, as many as the shop has files, are never broadcast, however small their estimate."""
    import re

    import __spark_entry__

    found = __spark_entry__.queries()["rewritten_bodies"](spark, "/root/testdata/sf0.001")
    joins = re.findall(r"(\w+Join) \[(_canon|_original|source_url)#", found._jdf.queryExecution().sparkPlan().toString())
    assert {kind for kind, _ in joins} == {"SortMergeJoin"} and {key for _, key in joins} == {"_canon", "_original", "source_url"}
