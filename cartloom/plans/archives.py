"""Archive queries: nested orders, refunds and gateways read out of the order tables, exploded into the archive's
tables, and the archive checked against its source. An order's lines are one nested record, as in an export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.money import cents
from cartloom.operators import archive
from cartloom.plans import bindings
from cartloom.plans.bindings import fit
from cartloom.plans.registry import query, table
from cartloom.sources.files import archive_cells

REFUND = 1_000_000_000
ELSEWHERE = 1_000_000_000_000

#: Twin side of the binding: the same facts as flat rows, worked out from the tables alone.
FACTS = """
    WITH heads AS (
      SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'N-' || o_orderkey END AS number,
        CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderpriority = '5-LOW' THEN 'cancelled'
          WHEN o_orderstatus = 'O' THEN 'on-hold' ELSE 'return-approved' END AS status,
        CASE WHEN o_custkey % 4 = 0 THEN 'NZD' ELSE 'AUD' END AS currency,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS day, o_custkey AS customer, o_orderpriority AS method,
        CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderkey % 13 = 0 AS couponed, o_orderkey % 11 = 0 AS fee,
        CASE WHEN o_custkey % 7 = 0 THEN '' WHEN o_custkey % 5 = 0 THEN 'local_pickup' ELSE 'flat_rate' END AS shipping,
        o_orderkey % 5 < 3 AS dated
      FROM orders),
    goods AS (
      SELECT l_orderkey AS id, l_orderkey * 10 + l_linenumber AS line_id, l_partkey AS part, l_suppkey AS supplier, CAST(l_quantity AS INTEGER) AS quantity,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_tax AS DECIMAL(18,2)) AS tax, l_returnflag AS flag, l_linestatus AS state
      FROM lineitem),
    items AS (SELECT g.*, h.number, h.currency, h.status FROM goods g JOIN heads h USING (id)),
    back AS (
      SELECT CASE WHEN id % 17 = 0 THEN id + 1000000000000 ELSE id END AS order_id, id + 1000000000 AS refund_id, id AS source_id,
        sum(price) AS amount, count(*) AS lines
      FROM goods WHERE flag = 'R' GROUP BY id),
    refunded AS (SELECT order_id AS id, amount FROM back WHERE order_id IN (SELECT id FROM heads)),
    costed AS (SELECT h.*, coalesce(r.amount, 0) AS returned FROM heads h LEFT JOIN refunded r USING (id))
"""


def _lines(rows: DataFrame, sign: int = 1) -> DataFrame:
    """Nested line items per order key, of ``lineitem`` rows."""
    entry = lambda key, value, shown=None, shown_value=None: F.struct(
        F.lit(1).cast("bigint").alias("id"), F.lit(key).alias("key"), value.cast("string").alias("value"),
        F.lit(shown).cast("string").alias("display_key"), (F.lit(None) if shown_value is None else shown_value).cast("string").alias("display_value"),
    )
    price = cents(F.col("l_extendedprice"))
    id_ = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    item = F.struct(
        id_.alias("id"), F.concat(F.lit(" Part\r\n "), F.col("l_partkey").cast("string")).alias("name"), F.lit(None).cast("string").alias("parent_name"),
        F.col("l_partkey").alias("product_id"), F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey")).otherwise(0).alias("variation_id"),
        F.col("l_quantity").cast("int").alias("quantity"), F.concat(F.lit("P-"), "l_partkey").alias("sku"), price.cast("double").alias("price"),
        F.format_number(price * sign, 2).alias("subtotal"),
        F.format_number((price - F.col("l_quantity").cast("decimal(18,2)")) * sign, 2).alias("total"),
        cents(F.col("l_tax")).cast("string").alias("total_tax"),
        F.array(
            entry("_refunded_item_id", id_), entry("flag", F.col("l_returnflag"), "Colour"),
            entry("state", F.lit("x"), None, F.concat("l_linestatus", F.lit(" \n 1"))), entry("parts", F.lit(' [{"a":1}]')),
        ).alias("meta_data"),
    )
    # a record is a column before it is gathered: expressions inside collect_list are not compiled
    made = rows.select(F.col("l_orderkey").alias("_key"), item.alias("_item"), price.alias("_price"), (F.col("l_returnflag") == "R").cast("int").alias("_returned"))
    return made.groupBy("_key").agg(F.collect_list("_item").alias("line_items"), F.sum("_price").alias("_amount"), F.max("_returned").alias("_back"))


def _address(first, city):
    fields = ["first_name", "last_name", "company", "address_1", "address_2", "city", "state", "postcode", "country", "email", "phone"]
    given = {"first_name": first, "city": city}
    return F.struct(*[given.get(f, F.lit(None)).cast("string").alias(f) for f in fields])


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their lines, shipping, fees, coupons and the ids of half of the refunds."""
    heads = table(spark, folder, "orders").join(_lines(table(spark, folder, "lineitem")), F.col("o_orderkey") == F.col("_key"), "left")
    key, shopper = F.col("o_orderkey"), F.col("o_custkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    pickup = shopper % 5 == 0
    method = F.struct(
        (key * 10 + 8).alias("id"), F.when(pickup, "local_pickup").otherwise("flat_rate").alias("method_id"),
        F.when(pickup, "Pick up").otherwise("Flat rate").alias("method_title"), F.lit("9.50").alias("total"), F.lit("0.95").alias("total_tax"),
    )
    fee = F.struct((key * 10 + 9).alias("id"), F.lit("Handling").alias("name"), F.lit("3.00").alias("total"), F.lit("").alias("total_tax"))
    coupon = F.struct(one.alias("id"), F.lit("SAVE").alias("code"), F.lit("1.00").alias("discount"))
    refund = F.struct((key + REFUND).alias("id"), F.lit("").alias("reason"), F.lit("").alias("total"))
    linked = (F.col("_back") == 1) & (key % 2 == 0) & (key % 17 != 0)
    return fit(
        heads.select(
            key.alias("id"),
            F.when(key % 3 != 0, F.concat(F.lit("N-"), key.cast("string"))).alias("number"),
            F.when(key % 10 == 0, key - 1).otherwise(zero).alias("parent_id"),
            F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderpriority") == "5-LOW", "cancelled")
            .when(F.col("o_orderstatus") == "O", "on-hold").otherwise("return-approved").alias("status"),
            F.when(shopper % 4 == 0, "NZD").otherwise("AUD").alias("currency"),
            day.alias("date_created_gmt"), F.concat(day, F.lit("Z")).alias("date_modified_gmt"),
            F.when(key % 5 < 3, F.concat(F.lit(" "), day)).when(key % 5 == 3, "").alias("date_paid_gmt"),
            F.when(F.col("o_orderstatus") == "F", F.concat(day, F.lit("+10:00"))).alias("date_completed_gmt"),
            shopper.alias("customer_id"),
            F.concat(F.when(key % 2 == 0, "=").otherwise("-"), F.when(key % 4 == 1, key.cast("string")).otherwise(F.concat(F.lit("leave \r\n at "), "o_orderpriority"))).alias("customer_note"),
            F.col("o_orderpriority").alias("payment_method"), F.concat(F.lit(" Pay\n"), "o_orderpriority").alias("payment_method_title"),
            F.when(key % 2 == 0, F.concat(F.lit("T"), key.cast("string"))).alias("transaction_id"), (shopper % 2 == 0).alias("prices_include_tax"),
            F.lit("1,000.00").alias("discount_total"), F.lit("9.50").alias("shipping_total"), F.lit(" 1.10 ").alias("total_tax"),
            F.when(key % 2 == 0, "n/a").otherwise("0.10").alias("cart_tax"),
            F.format_number(cents(F.col("o_totalprice")), 2).alias("total"),
            _address(F.concat(F.lit("C\n"), shopper.cast("string")), F.col("o_orderpriority")).alias("billing"),
            _address(F.concat(F.lit("S"), shopper.cast("string")), F.lit(None)).alias("shipping"),
            "line_items",
            F.when(shopper % 7 == 0, F.array().cast(fit_type("orders", "shipping_lines"))).otherwise(F.array(method)).alias("shipping_lines"),
            F.when(key % 11 == 0, F.array(fee)).alias("fee_lines"),
            F.when(key % 13 == 0, F.array(coupon, coupon)).alias("coupon_lines"),
            F.when(linked, F.array(refund)).alias("refunds"),
        ),
        "orders",
    )


def fit_type(entity: str, column: str):
    return bindings.schema(entity)[column].dataType


def refunds(spark: SparkSession, folder: str) -> DataFrame:
    """One refund per order with a returned line. Odd orders are named by the link only; every 17th link leads to no order."""
    back = _lines(table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R"), -1)
    key = F.col("_key")
    target = F.when(key % 17 == 0, key + ELSEWHERE).otherwise(key)
    meta = F.struct(
        F.lit(1).cast("bigint").alias("id"), F.lit("_refund_type").alias("key"), F.when(key % 3 == 0, "full").otherwise("part\nly").alias("value"),
        F.lit(None).cast("string").alias("display_key"), F.lit(None).cast("string").alias("display_value"),
    )
    links = F.struct(F.array(F.struct(F.lit("https://shop.example.com/shop").alias("href")), F.struct(F.concat(F.lit("https://shop.example.com/orders/"), target.cast("string"), F.lit("?x=1")).alias("href"))).alias("up"))
    return fit(
        back.select(
            (key + REFUND).alias("id"), F.lit("2024-02-03T04:05:06").alias("date_created_gmt"), F.format_number(-F.col("_amount"), 2).alias("amount"),
            F.when(key % 2 == 0, " too \r\n small ").alias("reason"), (key % 4).alias("refunded_by"), (key % 2 == 0).alias("refunded_payment"),
            F.array(meta).alias("meta_data"), "line_items", links.alias("_links"),
        ),
        "refunds",
    )


def gateways(spark: SparkSession, folder: str) -> DataFrame:
    """A gateway per priority but one; some have no method title."""
    ways = table(spark, folder, "orders").select("o_orderpriority").distinct().where(F.col("o_orderpriority") != "2-HIGH")
    named = F.when(F.col("o_orderpriority") < "3", F.concat(F.lit("Way "), "o_orderpriority")).otherwise("")
    return fit(ways.select(F.col("o_orderpriority").alias("id"), F.concat(F.lit("Title "), "o_orderpriority").alias("title"), named.alias("method_title")), "payment_gateways")


def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return archive.archive_tables(orders(spark, folder), refunds(spark, folder), bindings.customers(spark, folder), gateways(spark, folder))


@query(
    "archive_orders",
    FACTS
    + """,
    counted AS (SELECT id, count(*) AS n, sum(quantity) AS q, sum(price) AS subtotal FROM goods GROUP BY id)
    SELECT number AS order_number, h.id AS order_id, CASE WHEN h.id % 10 = 0 AND h.id <> 1 THEN h.id - 1 END AS parent_order_id, status, currency,
      day || '+00:00' AS date_created, day || 'Z' AS date_modified, CASE WHEN dated THEN day || '+00:00' ELSE '' END AS date_paid,
      CASE WHEN status = 'completed' THEN day || '+10:00' ELSE '' END AS date_completed,
      nullif(customer, 0) AS customer_id,
      CASE WHEN h.id % 2 = 0 THEN '=' ELSE '-' END || CASE WHEN h.id % 4 = 1 THEN CAST(h.id AS VARCHAR) ELSE 'leave at ' || method END AS customer_note,
      'C ' || customer AS billing_first_name, method AS billing_city, 'S' || customer AS shipping_first_name,
      coalesce(n, 0) AS line_item_count, coalesce(q, 0) AS item_quantity, coalesce(subtotal, 0) AS items_subtotal,
      1000.00 AS discount_total, 9.50 AS shipping_total, CASE WHEN fee THEN 3.00 ELSE 0 END AS fee_total,
      CASE WHEN h.id % 2 = 1 THEN 0.10 END AS cart_tax, 1.10 AS total_tax, total AS order_total,
      returned AS refunded_total, total - returned AS net_total, CASE WHEN couponed THEN 'SAVE; SAVE' ELSE '' END AS coupon_codes,
      CASE shipping WHEN '' THEN '' WHEN 'flat_rate' THEN 'Flat rate' ELSE 'Pick up' END AS shipping_methods,
      method AS payment_method, 'Pay ' || method AS payment_method_title, CASE WHEN h.id % 2 = 0 THEN 'T' || h.id ELSE '' END AS transaction_id,
      CASE WHEN customer % 2 = 0 THEN 'yes' ELSE 'no' END AS prices_include_tax
    FROM costed h LEFT JOIN counted c ON c.id = h.id
    """,
)
def archive_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order heads of the archive, without the address cells that the tables leave empty."""
    heads = tables(spark, folder)["orders"]
    empty = {"created_via", "order_key", "discount_tax", "shipping_tax"}
    kept = {"billing_first_name", "billing_city", "shipping_first_name", "shipping_methods", "shipping_total"}
    return heads.select(*[c for c in heads.columns if c in kept or not (c in empty or c.startswith(("billing_", "shipping_")))])


@query(
    "archive_order_lines",
    FACTS
    + """
    SELECT number AS order_number, id AS order_id, line_id, 'line_item' AS line_type, nullif(part, 0) AS product_id,
      CASE WHEN supplier % 2 = 0 THEN nullif(supplier, 0) END AS variation_id, 'P-' || part AS sku, 'Part ' || part AS product_name, '' AS parent_name,
      'Colour: ' || flag || '; state: ' || state || ' 1' AS variant, quantity, price AS unit_price, price AS line_subtotal,
      CAST(quantity AS DECIMAL(18,2)) AS line_discount, price - quantity AS line_total, tax AS line_tax, currency FROM items
    UNION ALL
    SELECT number, id, id * 10 + 8, 'shipping', NULL, NULL, '', CASE shipping WHEN 'flat_rate' THEN 'Flat rate' ELSE 'Pick up' END, '', shipping, 1, 9.50, 9.50, 0, 9.50, 0.95, currency
      FROM heads WHERE shipping <> ''
    UNION ALL
    SELECT number, id, id * 10 + 9, 'fee', NULL, NULL, '', 'Handling', '', '', 1, 3.00, 3.00, 0, 3.00, NULL, currency FROM heads WHERE fee
    """,
)
def archive_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Items, shipping and fees of nested orders in one shape."""
    return tables(spark, folder)["order-lines"]


@query(
    "archive_payments",
    FACTS
    + """
    SELECT number AS order_number, id AS order_id, method AS payment_method, 'Pay ' || method AS payment_method_title,
      CASE WHEN method = '2-HIGH' THEN '' WHEN method < '3' THEN 'Way ' || method ELSE 'Title ' || method END AS gateway_method_title,
      CASE WHEN id % 2 = 0 THEN 'T' || id ELSE '' END AS transaction_reference, total AS amount, currency,
      CASE WHEN dated THEN day || '+00:00' ELSE '' END AS payment_date,
      CASE WHEN returned > 0 THEN 'partially-refunded' WHEN dated THEN 'paid' WHEN status = 'cancelled' THEN status ELSE 'paid-date-not-recorded' END AS payment_status,
      returned AS refunded_total, total - returned AS net_amount
    FROM costed
    """,
)
def archive_payments(spark: SparkSession, folder: str) -> DataFrame:
    return tables(spark, folder)["payments"]


@query(
    "archive_refunds",
    FACTS
    + """
    SELECT refund_id, coalesce(h.number, '') AS order_number, order_id, '2024-02-03T04:05:06+00:00' AS refund_date, -amount AS amount,
      coalesce(h.currency, '') AS currency, CASE WHEN source_id % 3 = 0 THEN 'full' ELSE 'part ly' END AS refund_type,
      CASE WHEN source_id % 2 = 0 THEN 'too small' ELSE '' END AS reason, nullif(source_id % 4, 0) AS refunded_by_user_id,
      CASE WHEN source_id % 2 = 0 THEN 'yes' ELSE 'no' END AS refunded_payment, lines AS refund_line_count, h.id IS NULL AS orphan
    FROM back LEFT JOIN heads h ON h.id = order_id
    """,
)
def archive_refunds(spark: SparkSession, folder: str) -> DataFrame:
    """Refunds with their order, found by the nested id or else by the link; ``orphan`` where neither leads to an order."""
    heads = orders(spark, folder)
    linked = archive.refund_orders(archive.lines_as_ids(refunds(spark, folder)), heads)
    lost = archive.orphan_refunds(linked, heads).select("refund_id", F.lit(True).alias("orphan"))
    return archive.archive_refunds(linked, heads).join(lost, "refund_id", "left").withColumn("orphan", F.coalesce("orphan", F.lit(False)))


@query(
    "archive_refund_lines",
    FACTS
    + """
    SELECT g.id + 1000000000 AS refund_id, coalesce(h.number, '') AS order_number, b.order_id, line_id, CAST(line_id AS VARCHAR) AS refunded_item_id,
      nullif(part, 0) AS product_id, CASE WHEN supplier % 2 = 0 THEN nullif(supplier, 0) END AS variation_id, 'P-' || part AS sku, 'Part ' || part AS product_name,
      'Colour: R; state: ' || state || ' 1' AS variant, quantity, -price AS line_subtotal, quantity - price AS line_total, tax AS line_tax,
      coalesce(h.currency, '') AS currency
    FROM goods g JOIN back b ON b.source_id = g.id LEFT JOIN heads h ON h.id = b.order_id WHERE flag = 'R'
    """,
)
def archive_refund_lines(spark: SparkSession, folder: str) -> DataFrame:
    return tables(spark, folder)["refund-lines"]


@query(
    "archive_fulfilments",
    FACTS
    + """
    SELECT number AS order_number, id AS order_id,
      CASE status WHEN 'completed' THEN 'fulfilled' WHEN 'cancelled' THEN 'not-fulfilled (cancelled)' ELSE 'in-progress (' || status || ')' END AS fulfilment_status,
      CASE WHEN status = 'completed' THEN day || '+10:00' ELSE '' END AS fulfilment_date,
      CASE shipping WHEN '' THEN 'not recorded' WHEN 'local_pickup' THEN 'pickup' ELSE 'shipped' END AS delivery_type,
      CASE shipping WHEN '' THEN '' WHEN 'local_pickup' THEN 'Pick up' ELSE 'Flat rate' END AS shipping_method, shipping AS shipping_method_id,
      coalesce((SELECT sum(quantity) FROM goods g WHERE g.id = h.id), 0) AS item_quantity, 'S' || customer AS shipping_recipient_name
    FROM heads h
    """,
)
def archive_fulfilments(spark: SparkSession, folder: str) -> DataFrame:
    blank = ["carrier", "tracking_number", "tracking_url", "shipping_city", "shipping_state", "shipping_postcode", "shipping_country"]
    return tables(spark, folder)["fulfilments"].drop(*blank)


@query(
    "archive_fulfilment_lines",
    FACTS
    + """
    SELECT number AS order_number, id AS order_id, line_id, 'P-' || part AS sku, 'Part ' || part AS product_name,
      'Colour: ' || flag || '; state: ' || state || ' 1' AS variant, quantity,
      CASE status WHEN 'completed' THEN 'fulfilled' WHEN 'cancelled' THEN 'not-fulfilled (cancelled)' ELSE 'in-progress (' || status || ')' END AS fulfilment_status
    FROM items
    """,
)
def archive_fulfilment_lines(spark: SparkSession, folder: str) -> DataFrame:
    return tables(spark, folder)["fulfilment-lines"]


@query(
    "archive_customers",
    FACTS
    + """
    SELECT c_custkey AS customer_id, CASE WHEN c_nationkey = 0 THEN '' ELSE c_mktsegment || '.' || c_nationkey || '@Example.com' END AS email, c_name AS first_name,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN 'administrator' ELSE 'customer' END AS role, CASE WHEN c_acctbal >= 0 THEN c_name ELSE '' END AS billing_address_1,
      count(id) AS orders_in_archive, coalesce(sum(total), 0) AS order_total_in_archive
    FROM customer LEFT JOIN heads ON customer = c_custkey AND customer <> 0 GROUP BY ALL
    """,
)
def archive_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Shoppers with what they ordered; orders of no customer (id 0) count for nobody."""
    people = tables(spark, folder)["customers-reference"]
    return people.select("customer_id", "email", "first_name", "role", "billing_address_1", "orders_in_archive", "order_total_in_archive")


@query(
    "archive_cells",
    FACTS
    + """
    SELECT CAST(id AS VARCHAR) AS order_id,
      CASE WHEN id % 2 = 1 AND id % 4 = 1 THEN '-' || id
        ELSE '''' || CASE WHEN id % 2 = 0 THEN '=' ELSE '-' END || 'leave at ' || method END AS customer_note,
      CASE WHEN customer = 0 THEN '' ELSE CAST(customer AS VARCHAR) END AS customer_id
    FROM heads
    """,
)
def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells that a spreadsheet will not evaluate: formulas are quoted, negative numbers stay."""
    return archive_cells(tables(spark, folder)["orders"], ["order_id", "customer_note", "customer_id"])


_CHECKS = """
    kept AS (SELECT * FROM items WHERE line_id % 50 <> 1),
    spoiled AS (SELECT * FROM costed WHERE id % 40 <> 7),
    checks AS (
      SELECT 'order_count' AS metric, 'all' AS scope, (SELECT count(*) FROM costed)::DOUBLE AS source_value, (SELECT count(*) FROM costed)::DOUBLE AS archive_value
      UNION ALL SELECT 'order_count', 'status=' || status, count(*), count(*) FROM costed GROUP BY status
      UNION ALL SELECT 'payment_count', 'all', (SELECT count(*) FROM costed), (SELECT count(*) FROM spoiled)
      UNION ALL SELECT 'fulfilment_count', 'all', count(*), count(*) FROM costed
      UNION ALL SELECT 'line_item_count', 'all', (SELECT count(*) FROM items), (SELECT count(*) FROM kept)
      UNION ALL SELECT 'fulfilment_line_count', 'all', count(*), count(*) FROM items
      UNION ALL SELECT 'shipping_line_count', 'all', count(*), count(*) FROM costed WHERE shipping <> ''
      UNION ALL SELECT 'fee_line_count', 'all', count(*), count(*) FROM costed WHERE fee
      UNION ALL SELECT 'refund_count', 'all', count(*), count(*) FROM back
      UNION ALL SELECT 'refund_line_count', 'all', sum(lines), sum(lines) FROM back
      UNION ALL SELECT 'customer_reference_count', 'all', count(*), count(*) FROM customer
      UNION ALL SELECT 'discount_total', 'currency=' || currency, 1000 * count(*), 1000 * count(*) FROM costed GROUP BY currency
      UNION ALL SELECT 'shipping_total', 'currency=' || currency, CAST(9.5 * count(*) AS DOUBLE), CAST(9.5 * count(*) AS DOUBLE) FROM costed GROUP BY currency
      UNION ALL SELECT 'tax_total', 'currency=' || currency, CAST(1.1 * count(*) AS DOUBLE), CAST(1.1 * count(*) AS DOUBLE) FROM costed GROUP BY currency
      UNION ALL SELECT 'order_total', 'currency=' || currency, sum(total), sum(total) FROM costed GROUP BY currency
      UNION ALL SELECT 'net_total', 'currency=' || currency, sum(total - returned), sum(total - returned) FROM costed GROUP BY currency
      UNION ALL SELECT 'refund_total', 'currency=' || currency, sum(returned), sum(returned) FROM costed GROUP BY currency
      UNION ALL SELECT 'gross_line_subtotal', 'currency=' || i.currency, sum(i.price), sum(CASE WHEN i.line_id % 50 <> 1 THEN i.price ELSE 0 END) FROM items i GROUP BY i.currency
      UNION ALL SELECT 'orphan_rows', 'refunds', 0, (SELECT count(*) FROM back WHERE order_id NOT IN (SELECT id FROM heads))
      UNION ALL SELECT 'orphan_rows', 'refund-lines', 0, (SELECT sum(lines) FROM back WHERE order_id NOT IN (SELECT id FROM heads))
      UNION ALL SELECT 'orphan_rows', t, 0, 0 FROM (VALUES ('order-lines'), ('payments'), ('fulfilments'), ('fulfilment-lines')) v(t))
"""


@query(
    "reconcile_archive",
    FACTS
    + ","
    + _CHECKS
    + """
    SELECT metric, scope, source_value, coalesce(archive_value, 0) AS archive_value, source_value - coalesce(archive_value, 0) AS difference,
      CASE WHEN metric = 'payment_count' THEN 'payments are sent later' END AS explanation,
      CASE WHEN source_value = coalesce(archive_value, 0) THEN 'match' WHEN metric = 'payment_count' THEN 'explained' ELSE 'mismatch' END AS status
    FROM checks
    """,
)
def reconcile_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The whole reconciliation, of an archive that lacks some lines and (with a note) some payments."""
    built = tables(spark, folder)
    built["order-lines"] = built["order-lines"].where((F.col("line_type") != "line_item") | (F.col("line_id") % 50 != 1))
    built["payments"] = built["payments"].where(F.col("order_id") % 40 != 7)
    checks = archive.reconcile_archive(
        orders(spark, folder), refunds(spark, folder), bindings.customers(spark, folder), built, {"payment_count": "payments are sent later"}
    )
    value = [F.col(c).cast("double").alias(c) for c in ("source_value", "archive_value", "difference")]
    # a note belongs to its metric, whether the two sides differ or not
    return checks.select("metric", "scope", *value, "explanation", "status")
