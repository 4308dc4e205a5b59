"""Reconciliation queries: a load against its source by digests, fields, counts and reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.operators import catalog, digests, quality
from cartloom.plans import bindings as b
from cartloom.plans.catalog import SLUG_SQL, VARIATION_SQL, variant_frames
from cartloom.plans.registry import query, table

COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def faulty_copy(orders: DataFrame) -> DataFrame:
    """Orders as a load might leave them: some lost, some altered, some new, some twice."""
    key = F.col("o_orderkey")
    altered = (
        orders.where(key % 97 != 5)
        .withColumn("o_totalprice", F.when(key % 89 == 3, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
        .withColumn("o_orderstatus", F.when(key % 83 != 4, F.col("o_orderstatus")))
        .withColumn("o_orderpriority", F.when(key % 79 == 6, "").otherwise(F.col("o_orderpriority")))
    )
    new = orders.where(key % 101 == 7).withColumn("o_orderkey", key + 1_000_000_000)
    return altered.unionByName(altered.where(key % 103 == 9)).unionByName(new)


@query(
    "load_differences",
    """
    WITH t AS (SELECT o_orderkey AS k, o_custkey AS c, CASE WHEN k % 83 <> 4 THEN o_orderstatus END AS s,
        o_totalprice + CASE WHEN k % 89 = 3 THEN 1 ELSE 0 END AS p, CASE WHEN k % 79 = 6 THEN '' ELSE o_orderpriority END AS r,
        CASE WHEN k % 103 = 9 THEN 2 ELSE 1 END AS n FROM orders WHERE k % 97 <> 5
      UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 1 FROM orders WHERE o_orderkey % 101 = 7),
    j AS (SELECT coalesce(k, o_orderkey) AS o_orderkey, k IS NULL AS lost, o.o_orderkey IS NULL AS new, coalesce(n, 0) AS target_rows,
        CASE WHEN o.o_orderkey IS NULL THEN 0 ELSE 1 END AS source_rows,
        n = 2 OR c IS DISTINCT FROM o_custkey AS dc, n = 2 OR s IS DISTINCT FROM o_orderstatus AS ds,
        n = 2 OR p IS DISTINCT FROM o_totalprice AS dp, n = 2 OR r IS DISTINCT FROM o_orderpriority AS dr
      FROM orders o FULL JOIN t ON k = o.o_orderkey)
    SELECT o_orderkey, CASE WHEN lost THEN 'missing' WHEN new THEN 'extra' ELSE 'changed' END AS status, source_rows, target_rows,
      CASE WHEN lost OR new THEN '' ELSE concat_ws(',', CASE WHEN dc THEN 'o_custkey' END, CASE WHEN ds THEN 'o_orderstatus' END,
        CASE WHEN dp THEN 'o_totalprice' END, CASE WHEN dr THEN 'o_orderpriority' END) END AS columns
    FROM j WHERE lost OR new OR dc OR ds OR dp OR dr
    """,
)
def load_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that a load lost, added, repeated or altered, with the altered columns."""
    orders = table(spark, folder, "orders").select("o_orderkey", *COLUMNS)
    found = digests.differing_keys(orders, faulty_copy(orders), ["o_orderkey"], COLUMNS)
    return found.withColumn("columns", F.array_join("columns", ","))


@query(
    "field_mismatches",
    f"""
    WITH v AS (SELECT l_partkey * 100000 + l_suppkey AS id, sale, regular FROM ({VARIATION_SQL})
      UNION ALL SELECT p_partkey, NULL, NULL FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem))
    SELECT count(*) FILTER (WHERE id % 10 = 1) AS price, count(*) FILTER (WHERE id % 6 = 0 AND sale <> regular) AS compare_at,
      count(*) FILTER (WHERE id % 7 = 2) AS taxable, count(*) FILTER (WHERE id % 25 = 3) AS currency
    FROM v
    """,
)
def field_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    """Loaded variants whose price, compare-at price, tax or currency isn't what the source says; the faults are planted."""
    loaded, _ = variant_frames(spark, folder)
    id_ = F.col("source.source_id")
    loaded = (
        loaded.withColumn("price", F.when(id_ % 10 == 1, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)"))
        .withColumn("compare_at_price", F.when(id_ % 6 != 0, F.col("compare_at_price")))
        .withColumn("taxable", (id_ % 7 == 2) != F.col("taxable"))
        .withColumn("currency", F.when(id_ % 25 == 3, "NZD").otherwise(F.col("currency")))
    )
    return quality.reconcile_fields(b.variations(spark, folder), b.products(spark, folder), loaded, catalog.CURRENCY)


#: Variations of a part with the turn of each option combination.
TURNS = f"""
    WITH v AS ({VARIATION_SQL}),
    w AS (SELECT l_partkey, CASE WHEN stock > 0 THEN 'Grey' ELSE 'Navy' END AS colour, size FROM v),
    c AS (SELECT l_partkey, count(*) AS source, CASE WHEN count(DISTINCT colour) > 1 THEN 1 ELSE 0 END AS by_colour,
      CASE WHEN count(DISTINCT size) > 1 THEN 1 ELSE 0 END AS by_size FROM w GROUP BY 1),
    d AS (SELECT DISTINCT l_partkey, CASE WHEN by_colour = 1 THEN colour END AS colour, CASE WHEN by_size = 1 THEN size END AS size FROM w JOIN c USING (l_partkey)),
    k AS (SELECT l_partkey, source, target FROM c JOIN (SELECT l_partkey, count(*) AS target FROM d GROUP BY 1) USING (l_partkey))
"""


@query(
    "variant_count_differences",
    TURNS
    + f""",
    s AS (SELECT p_partkey, {SLUG_SQL} AS slug FROM part),
    h AS (SELECT p_partkey, CASE WHEN min(p_partkey) OVER (PARTITION BY slug) = p_partkey THEN slug ELSE slug || '-' || p_partkey END AS handle FROM s)
    SELECT handle, l_partkey AS source_id, source, target FROM k JOIN h ON p_partkey = l_partkey WHERE source <> target
    """,
)
def variant_count_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Products of which fewer variants are loaded than the source has."""
    loaded, _ = variant_frames(spark, folder)
    rows = catalog.classified_products(b.products(spark, folder)).select(catalog.source_ref(F.col("id"), "product", "tables"), "handle")
    return quality.variant_count_differences(b.variations(spark, folder), rows, loaded.where(~F.col("held")))


@query(
    "held_reasons",
    TURNS
    + """
    SELECT 'duplicate_option_combination' AS reason, sum(source - target) AS n FROM k HAVING sum(source - target) > 0
    UNION ALL SELECT 'variant_missing_option_value', count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem) HAVING count(*) > 0
    """,
)
def held_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return quality.held_reason_counts(variant_frames(spark, folder)[0])
