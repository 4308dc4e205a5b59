"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the links (a, b): the smallest node of its component.

    Each round takes the smallest label among neighbours and then the label's own label, until none changes; rounds grow with the
    logarithm of a component's width in most graphs. Labels are written after each round, nothing is collected.
    """
    both = saved(links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a")).distinct())
    labels = saved(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")))
    while True:
        heard = both.join(labels.select(F.col("node").alias("other"), F.col("root").alias("_r")), "other").groupBy("node").agg(F.min("_r").alias("_r"))
        nearer = labels.join(heard, "node").select("node", F.least("root", "_r").alias("root"), F.col("root").alias("old"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        fresh = saved(nearer.join(jump, "root", "left").select("node", F.least("root", F.coalesce("_up", "root")).alias("root"), "old"))
        changed = not fresh.where(F.col("root") != F.col("old")).isEmpty()
        labels = fresh.select("node", "root")
        if not changed:
            return labels
