"""Bounded walks over link graphs: redirect chains, category trees, fetch hops, link frontier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.urls import attribute_values, proxied_image, same_host_link
from cartloom.session import checkpointed


def doubled(table: DataFrame) -> DataFrame:
    """Jumps twice as far: ``src, dst`` joined with itself."""
    onward = table.select(F.col("src").alias("dst"), F.col("dst").alias("_to"))
    return checkpointed(table.join(onward, "dst").select("src", F.col("_to").alias("dst")))


def jump_tables(edges: DataFrame) -> tuple[list[DataFrame], bool]:
    """Jumps of 1, 2, 4, ... hops, and whether some run for ever.

    A table holds the nodes that still have so many hops before them. Chains die out; where two tables in a row are of
    one size, all nodes left lead into loops. Then jumps are doubled until they are as long as those nodes are many, so
    that every one lands on a loop.
    """
    tables = [checkpointed(edges)]
    size = tables[0].count()
    endless = False
    while size and not (endless and 1 << (len(tables) - 1) >= size):
        tables.append(doubled(tables[-1]))
        before, size = size, tables[-1].count()
        endless = size == before
    return (tables if size else tables[:-1]), size > 0


def loop_lengths(edges: DataFrame, on_loops: DataFrame) -> DataFrame:
    """``node, around``: each node of a loop with the loop's length. Windows of 1, 2, 4, ... nodes take their smallest
    node; once they are longer than any loop, that node names the loop."""
    steps = edges.join(on_loops.select(F.col("node").alias("src")), "src", "left_semi")
    seen = checkpointed(steps.select(F.col("src").alias("node"), F.col("dst").alias("to"), F.col("src").alias("low")))
    size, window = seen.count(), 1
    while window < size:
        ahead = seen.select(F.col("node").alias("to"), F.col("to").alias("_to"), F.col("low").alias("_low"))
        seen = checkpointed(seen.join(ahead, "to").select("node", F.col("_to").alias("to"), F.least("low", "_low").alias("low")))
        window *= 2
    return seen.join(seen.groupBy("low").agg(F.count(F.lit(1)).alias("around")), "low").select("node", "around")


def walk(starts: DataFrame, edges: DataFrame, max_hops: int | None) -> DataFrame:
    """Follow ``edges`` (``src, dst``; one per ``src``) from the nodes ``start``.

    Gives ``start, at, hops, ended`` with ``ended`` one of end, loop, bound. A walk ends where there is no edge, at the first node it
    meets again, or after ``max_hops`` (None: never). Rounds grow with the logarithm of the longest chain: jump tables of
    1, 2, 4, ... hops are built by joining each with itself, and every walk then takes each jump at most once, the longest first,
    as long as it doesn't step onto a loop; the loop's length says where it closes.
    """
    edges = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst")
    tables, endless = jump_tables(edges)
    if not tables:
        return starts.select("start", F.col("start").alias("at"), F.lit(0).alias("hops"), F.lit("end").alias("ended"))
    jump = lambda n: tables[n].select(F.col("src").alias("at"), F.col("dst").alias("_to"))
    begun = starts.select("start", F.col("start").alias("at"), F.lit(0).cast("bigint").alias("hops"))
    loops = None
    if endless:
        loops = loop_lengths(tables[0], checkpointed(tables[-1].select(F.col("dst").alias("node")).distinct()))
        there = loops.select(F.col("node").alias("at"), F.lit(True).alias("_there"))
        begun = begun.join(there, "at", "left").withColumn("inside", F.coalesce("_there", F.lit(False))).drop("_there")
    else:
        begun = begun.withColumn("inside", F.lit(False))
    moving = begun
    for n in range(len(tables) - 1, -1, -1):
        step = jump(n)
        if loops is not None:  # a jump onto a loop would pass its entry
            step = step.join(loops.select(F.col("node").alias("_to")), "_to", "left_anti")
        joined = moving.join(step, "at", "left")
        go = F.col("_to").isNotNull() & ~F.col("inside")
        moving = joined.select(
            "start", F.when(go, F.col("_to")).otherwise(F.col("at")).alias("at"), (F.col("hops") + F.when(go, 1 << n).otherwise(0)).alias("hops"), "inside"
        )
    if loops is None:
        ended = moving.withColumn("ended", F.lit("end"))
    else:
        # one more hop enters the loop, unless the walk began on it
        last = moving.join(jump(0), "at", "left")
        enters = F.col("_to").isNotNull() & ~F.col("inside")
        last = last.select("start", F.when(enters, F.col("_to")).otherwise(F.col("at")).alias("at"), (F.col("hops") + enters.cast("bigint")).alias("hops"))
        closed = last.join(loops.withColumnRenamed("node", "at"), "at", "left")
        ended = closed.select(
            "start", "at", (F.col("hops") + F.coalesce("around", F.lit(0))).alias("hops"), F.when(F.col("around").isNotNull(), "loop").otherwise("end").alias("ended")
        )
    ended = checkpointed(ended.select("start", "at", F.col("hops").cast("int").alias("hops"), "ended"))
    if max_hops is None:
        return ended
    # longer walks stop at the bound: its binary digits say which jumps lead there
    cut = ended.where(F.col("hops") > max_hops).select("start", F.col("start").alias("at"))
    for n in range(len(tables)):
        if max_hops >> n & 1:
            cut = cut.join(jump(n), "at").select("start", F.col("_to").alias("at"))
    cut = cut.select("start", "at", F.lit(max_hops).alias("hops"), F.lit("bound").alias("ended"))
    return ended.where(F.col("hops") <= max_hops).unionByName(cut)


def collapse_chains(
    redirects: DataFrame, source: str = "source_path", destination: str = "destination", moved: Column | None = None, max_hops: int | None = 10
) -> DataFrame:
    """Redirects with their final destination and ``collapsed``, the number of hops taken out.

    Hops are counted on the input map, so they do not depend on row order. A loop stops at its first
    repeated path and a longer chain at the bound; both stay visible to :func:`map_integrity`.
    """
    is_moved = F.lit(True) if moved is None else moved
    edges = checkpointed(redirects.where(is_moved).select(F.col(source).alias("src"), F.col(destination).alias("dst")))
    # only rows whose destination redirects again have anything to walk; their own hop doesn't count
    chained = edges.join(edges.select(F.col("src").alias("dst")), "dst", "left_semi").select(F.col("src").alias("start"))
    ends = walk(chained, edges, None if max_hops is None else max_hops + 1).select(
        F.col("start").alias(source), F.col("at").alias("_final"), (F.col("hops") - 1).alias("_hops")
    )
    return (
        redirects.join(ends, source, "left")
        .withColumn(destination, F.coalesce("_final", destination))
        .withColumn("collapsed", F.coalesce("_hops", F.lit(0)))
        .drop("_final", "_hops")
    )


def map_integrity(
    redirects: DataFrame, source: str = "source_path", destination: str = "destination", moved: Column | None = None, gone: Column | None = None
) -> DataFrame:
    """``problem, source, destination`` of every broken rule; empty when the map is sound."""
    is_moved = F.lit(True) if moved is None else moved
    is_gone = F.lit(False) if gone is None else gone
    rows = redirects.where(is_moved).select(F.col(source).alias("source"), F.col(destination).alias("destination"))
    targets = redirects.select(
        F.col(source).alias("destination"), is_moved.alias("_moved"), is_gone.alias("_gone")
    ).where(F.col("_moved") | F.col("_gone"))
    problems = F.array_compact(
        F.array(
            F.when(F.col("source") == F.col("destination"), "self-redirect"),
            F.when(F.coalesce("destination", F.lit("")).isin("", "/"), "redirect to home/empty"),
            F.when(F.col("_moved"), "chain remains"),
            F.when(F.col("_gone"), "redirect to a 410 path"),
        )
    )
    return rows.join(targets, "destination", "left").select(
        F.explode(problems).alias("problem"), "source", "destination"
    )


def category_paths(categories: DataFrame, prefix: str = "/product-category/", max_depth: int = 6) -> DataFrame:
    """``id, path, alias`` of every category: its root-to-leaf path, and the bare one where that
    differs. ``categories``: ``id, slug, parent`` (0 or null at the root). Parents missing from the
    table end the path."""
    up = categories.select(F.col("id").alias("_up"), F.col("slug").alias("_slug"), F.col("parent").alias("_next"))
    rows = categories.select("id", "slug", F.col("slug").alias("chain"), F.nullif("parent", F.lit(0)).alias("parent"))
    for _ in range(max_depth):
        rows = (
            rows.join(up, F.col("parent") == F.col("_up"), "left")
            .withColumn("chain", F.concat_ws("/", "_slug", "chain"))
            .withColumn("parent", F.nullif("_next", F.lit(0)))
            .drop("_up", "_slug", "_next")
        )
    return rows.select(
        "id",
        "slug",
        F.explode(
            F.array_distinct(F.array(F.concat(F.lit(prefix), "chain"), F.concat(F.lit(prefix), "slug")))
        ).alias("path"),
        F.concat(F.lit(prefix), "chain").alias("_full"),
    ).select("id", "slug", "path", (F.col("path") != F.col("_full")).alias("alias"))


def walk_hops(fetches: DataFrame, starts: DataFrame, max_hops: int = 5) -> DataFrame:
    """``start, hops, final_url, final_status, ended`` over stored fetches ``url, status, location``.

    ``starts``: ``url``. A URL that was never fetched ends with a null status.
    """
    redirect = F.col("status").isin(301, 302, 303, 307, 308) & F.col("location").isNotNull()
    edges = fetches.where(redirect).select(F.col("url").alias("src"), F.col("location").alias("dst"))
    ends = walk(starts.select(F.col("url").alias("start")), edges, max_hops)
    statuses = fetches.select(F.col("url").alias("at"), F.col("status").alias("_status"))
    return ends.join(statuses, "at", "left").select(
        "start",
        "hops",
        F.col("at").alias("final_url"),
        F.when(F.col("ended") == "end", F.col("_status")).alias("final_status"),
        "ended",
    )


def link_frontier(pages: DataFrame, order: str, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct same-host links of stored pages with the first page, in ``order``, that has them."""
    links = pages.select(
        F.col(order).alias("_order"), F.col(url).alias("referrer"), F.explode(F.array_distinct(attribute_values(F.col(html), "a", "href"))).alias("href")
    ).withColumn("link", same_host_link(F.col("href"), F.col("referrer")))
    return (
        links.where(F.col("link").isNotNull())
        .groupBy("link")
        .agg(F.min_by("referrer", "_order").alias("referrer"), F.countDistinct("referrer").alias("referrers"))
    )


def image_frontier(pages: DataFrame, order: str, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct image addresses, proxies decoded, with their first page."""
    images = pages.select(
        F.col(order).alias("_order"), F.col(url).alias("referrer"), F.explode(F.array_distinct(attribute_values(F.col(html), "img", "src"))).alias("src")
    )
    return images.groupBy(proxied_image(F.col("src")).alias("image")).agg(F.min_by("referrer", "_order").alias("referrer"))
