"""Order queries: reconciliation, totals, refunds, payment state, lines, orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.money import cents
from cartloom.operators import archive, quality
from cartloom.operators.skew import with_first
from cartloom.plans.registry import query, table

NET = "decimal(4,2)"


def line_net():
    """Exact discounted line total."""
    rate = (F.lit(1).cast(NET) - F.col("l_discount").cast(NET)).cast(NET)
    return (cents(F.col("l_extendedprice")) * rate).cast("decimal(22,4)")


def line_net_units():
    """Discounted line total as a whole number of 1/10,000: parsing a double into a scaled decimal
    costs several times more than rounding it to whole cents and percents."""
    price = F.rint(F.col("l_extendedprice") * 100).cast("bigint").cast("decimal(18,0)")
    share = F.lit(100).cast("decimal(3,0)") - F.rint(F.col("l_discount") * 100).cast("int").cast("decimal(3,0)")
    return price * share


def scaled(units):
    """Money of summed units."""
    return (units * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(34,4)")


@query(
    "order_reconcile",
    """
    WITH lines AS (
      SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS net, count(*) AS n
      FROM lineitem GROUP BY l_orderkey),
    both_sides AS (
      SELECT 'status=' || o_orderstatus AS scope, CAST(o_totalprice AS DECIMAL(18,2)) AS total, net, n
      FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey),
    checks AS (
      SELECT 'order_count' AS metric, scope, CAST(count(*) AS DOUBLE) AS source_value, CAST(count(n) AS DOUBLE) AS archive_value FROM both_sides GROUP BY scope
      UNION ALL
      SELECT 'order_total', scope, CAST(sum(total) AS DOUBLE), CAST(coalesce(sum(net), 0) AS DOUBLE) FROM both_sides GROUP BY scope
      UNION ALL
      SELECT 'orphan_rows', 'lineitem', 0, (SELECT CAST(count(*) AS DOUBLE) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
      UNION ALL
      SELECT 'orphan_rows', 'orders', 0, (SELECT CAST(count(*) AS DOUBLE) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)))
    SELECT metric, scope, source_value, archive_value,
      CASE WHEN source_value = archive_value THEN 'match' ELSE 'mismatch' END AS status
    FROM checks
    """,
)
def order_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Totals by status from the order headers against totals from their lines, and orphans."""
    orders = table(spark, folder, "orders")
    lines = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(scaled(F.sum(line_net_units())).alias("net"), F.count(F.lit(1)).alias("lines"))
    )
    scope = F.concat(F.lit("status="), "o_orderstatus")
    # one full join and one aggregation serve both sides and both orphan counts
    joined = orders.withColumn("_head", F.lit(1)).join(lines, "o_orderkey", "full")
    zero, has_head = F.lit(0), F.col("_head").isNotNull()
    checks = archive.reconcile_pairs(
        joined.withColumn("scope", F.when(has_head, F.concat(F.lit("status="), "o_orderstatus"))),
        F.col("scope"),
        {
            "order_count": (F.col("_head"), F.when(has_head & (F.col("lines") > 0), 1)),
            "order_total": (cents(F.col("o_totalprice")), F.when(has_head, F.col("net"))),
            "orders": (zero, F.when(F.col("lines").isNull(), 1)),
            "lineitem": (zero, F.when(~has_head, F.col("lines"))),
        },
    )
    # the scopes of an orphan check are the table it is about; their few totals are added up here
    orphan = F.col("metric").isin("orders", "lineitem")
    scoped = checks.where(orphan | F.col("scope").isNotNull()).groupBy(
        F.when(orphan, "orphan_rows").otherwise(F.col("metric")).alias("metric"),
        F.when(orphan, F.col("metric")).otherwise(F.col("scope")).alias("scope"),
    )
    totals = scoped.agg(*[F.sum(c).cast("double").alias(c) for c in ("source_value", "archive_value")])
    status = archive.check_status(F.col("source_value"), F.col("archive_value"), F.lit(None))
    return totals.withColumn("status", status)


@query(
    "tally_status",
    """
    SELECT 'orders' AS entity, 'total' AS metric, '' AS value, count(*) AS n FROM orders
    UNION ALL SELECT 'orders', 'by_status', o_orderstatus, count(*) FROM orders GROUP BY 3
    UNION ALL SELECT 'orders', 'by_priority', o_orderpriority, count(*) FROM orders GROUP BY 3
    UNION ALL SELECT 'customers', 'total', '', count(*) FROM customer
    UNION ALL SELECT 'customers', 'in_debt', '', count(*) FILTER (WHERE c_acctbal < 0) FROM customer
    UNION ALL SELECT 'customers', 'by_segment', c_mktsegment, count(*) FROM customer GROUP BY 3
    """,
)
def tally_status(spark: SparkSession, folder: str) -> DataFrame:
    one = F.count(F.lit(1))
    orders = quality.profile(
        table(spark, folder, "orders"), "orders", {"total": one},
        {"by_status": F.col("o_orderstatus"), "by_priority": F.col("o_orderpriority")},
    )
    customers = quality.profile(
        table(spark, folder, "customer"), "customers",
        {"total": one, "in_debt": F.count(F.when(F.col("c_acctbal") < 0, 1))}, {"by_segment": F.col("c_mktsegment")},
    )
    return orders.unionByName(customers)


@query(
    "order_summary",
    """
    SELECT count(*) AS orders, min(o_orderkey) AS min_order_id, max(o_orderkey) AS max_order_id,
      strftime(min(o_orderdate), '%Y-%m-%d') AS min_order_date, strftime(max(o_orderdate), '%Y-%m-%d') AS max_order_date,
      (SELECT string_agg(p, ',' ORDER BY p) FROM (SELECT DISTINCT o_orderpriority AS p FROM orders)) AS currencies,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_total
    FROM orders
    """,
)
def order_summary(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    summary = archive.order_summary(orders, "o_orderkey", "day", "o_orderpriority", cents(F.col("o_totalprice")))
    return summary.withColumn("order_total", F.col("order_total").cast("double"))


@query(
    "customer_order_totals",
    """
    SELECT c_custkey, c_mktsegment, count(o_orderkey) AS orders_in_archive,
      CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS order_total_in_archive
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment
    """,
)
def customer_order_totals(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    totals = archive.customer_order_totals(
        customers, table(spark, folder, "orders"), "c_custkey", "o_custkey", cents(F.col("o_totalprice"))
    )
    return totals.select(
        "c_custkey", "c_mktsegment", "orders_in_archive", F.col("order_total_in_archive").cast("double")
    )


def refund_lines(spark: SparkSession, folder: str) -> DataFrame:
    returned = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return returned.select(F.col("l_orderkey").alias("order_id"), (-F.col("l_extendedprice")).alias("l_extendedprice"))


@query(
    "refunds_by_order",
    """
    SELECT l_orderkey AS order_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS refunded, count(*) AS refunds
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey
    """,
)
def refunds_by_order(spark: SparkSession, folder: str) -> DataFrame:
    totals = archive.refund_totals_by_order(refund_lines(spark, folder), amount=cents(F.col("l_extendedprice")))
    return totals.select("order_id", F.col("refunded").cast("double"), "refunds")


STATUS_NAMES = {"F": "completed", "O": "pending", "P": "processing"}


@query(
    "payment_status",
    """
    WITH r AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS refunded FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    s AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total, coalesce(refunded, 0) AS refunded,
      CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'processing' END AS status,
      o_orderpriority = '1-URGENT' AS paid FROM orders LEFT JOIN r ON l_orderkey = o_orderkey)
    SELECT CASE WHEN refunded > 0 THEN 'partially-refunded' WHEN paid THEN 'paid' WHEN status IN ('completed', 'processing') THEN 'paid-date-not-recorded' ELSE 'unpaid' END AS payment_status,
      count(*) AS orders, CAST(sum(refunded) AS DOUBLE) AS refunded, CAST(sum(total - refunded) AS DOUBLE) AS net
    FROM s GROUP BY 1
    """,
)
def payment_status(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by payment state; an urgent order counts as paid on its order date."""
    refunds = archive.refund_totals_by_order(refund_lines(spark, folder), amount=cents(F.col("l_extendedprice")))
    names = F.create_map(*[F.lit(x) for pair in STATUS_NAMES.items() for x in pair])
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.element_at(names, F.col("o_orderstatus")).alias("status"),
        cents(F.col("o_totalprice")).alias("total"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate").cast("string")).alias("paid_at"),
    )
    joined = orders.join(refunds.withColumnRenamed("order_id", "id"), "id", "left").withColumn(
        "refunded", F.coalesce("refunded", F.lit(0).cast("decimal(18,2)"))
    )
    state = archive.payment_status(F.col("status"), F.col("refunded"), F.col("paid_at"))
    return joined.groupBy(state.alias("payment_status")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("refunded").cast("double").alias("refunded"),
        F.sum(F.col("total") - F.col("refunded")).cast("double").alias("net"),
    )


@query(
    "order_lines_union",
    """
    WITH lines AS (
      SELECT l_orderkey AS order_id, 'line_item' AS line_type, CAST(l_quantity AS BIGINT) AS quantity,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS line_subtotal, CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS line_total FROM lineitem
      UNION ALL SELECT o_orderkey, 'shipping', 1, 9.90, 9.90 FROM orders
      UNION ALL SELECT o_orderkey, 'fee', 1, 5.00, 5.00 FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT line_type, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(line_subtotal) AS DOUBLE) AS line_subtotal,
      CAST(sum(line_subtotal - line_total) AS DOUBLE) AS line_discount, CAST(sum(line_total) AS DOUBLE) AS line_total
    FROM lines GROUP BY line_type
    """,
)
def order_lines_union(spark: SparkSession, folder: str) -> DataFrame:
    """Goods, one flat shipping line per order, a fee on urgent ones; totals by kind."""
    orders = table(spark, folder, "orders")

    def flat(df: DataFrame, amount: str) -> DataFrame:
        cost = F.lit(amount).cast("decimal(22,4)")
        return df.select(
            F.col("o_orderkey").alias("order_id"), F.lit(1).cast("bigint").alias("quantity"),
            cost.alias("line_subtotal"), cost.alias("line_total"),
        )

    goods = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_quantity").cast("bigint").alias("quantity"),
        cents(F.col("l_extendedprice")).cast("decimal(22,4)").alias("line_subtotal"), line_net().alias("line_total"),
    )
    lines = archive.union_lines(
        {"line_item": goods, "shipping": flat(orders, "9.90"), "fee": flat(orders.where(F.col("o_orderpriority") == "1-URGENT"), "5.00")}
    )
    return lines.groupBy("line_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"),
        *[F.sum(c).cast("double").alias(c) for c in ("line_subtotal", "line_discount", "line_total")],
    )


@query(
    "orphans_both_ways",
    """
    SELECT 'order_without_lines' AS kind, o_orderkey AS order_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'line_without_order', l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    """,
)
def orphans_both_ways(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"))
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    return (
        archive.orphan_rows(orders, lines, "order_id").withColumn("kind", F.lit("order_without_lines"))
        .unionByName(archive.orphan_rows(lines, orders, "order_id").withColumn("kind", F.lit("line_without_order")))
    )


@query(
    "first_customer_per_segment",
    """
    SELECT c_custkey, c_mktsegment, c_nationkey, min(c_custkey) OVER (PARTITION BY c_mktsegment, c_nationkey) AS first_id FROM customer
    """,
)
def first_customer_per_segment(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return with_first(customers, ["c_mktsegment", "c_nationkey"], "c_custkey")


@query(
    "duplicate_combinations",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, min(l_partkey) OVER (PARTITION BY l_orderkey, l_linenumber) AS first_id FROM lineitem
    """,
)
def duplicate_combinations(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the first part that uses their order and line number."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return with_first(lines, ["l_orderkey", "l_linenumber"], "l_partkey")


@query(
    "duplicate_line_keys",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def duplicate_line_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_values(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "fulfilment_status",
    """
    WITH l AS (SELECT l_orderkey, bool_and(l_linestatus = 'F') AS picked FROM lineitem GROUP BY 1)
    SELECT CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'not-fulfilled (pending)' ELSE 'in-progress (processing)' END AS fulfilment_status,
      CASE WHEN picked IS NULL THEN 'not recorded' WHEN picked THEN 'pickup' ELSE 'shipped' END AS delivery_type, count(*) AS orders
    FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1, 2
    """,
)
def fulfilment_status(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by fulfilment and delivery; a closed line counts as picked up. The distinct line states
    of an order (at most two) are its shipping methods."""
    names = F.create_map(*[F.lit(x) for pair in STATUS_NAMES.items() for x in pair])
    method = F.when(F.col("l_linestatus") == "F", "local_pickup").otherwise("courier")
    methods = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_set(method).alias("methods")
    )
    joined = table(spark, folder, "orders").join(methods, "o_orderkey", "left")
    return joined.groupBy(
        archive.fulfilment_status(F.element_at(names, F.col("o_orderstatus"))).alias("fulfilment_status"),
        archive.delivery_type(F.col("methods")).alias("delivery_type"),
    ).agg(F.count(F.lit(1)).alias("orders"))
