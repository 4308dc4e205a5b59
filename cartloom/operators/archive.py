"""Order history as flat archive tables, and its reconciliation against the source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.money import money, money_or_zero, money_text
from cartloom.functions.text import blank_to_null, meta_pairs, meta_value, one_line_text, stamp_tz
from cartloom.operators.exceptions import union_all

# Fixed values.
ADDRESS_FIELDS = [
    "first_name", "last_name", "company", "address_1", "address_2",
    "city", "state", "postcode", "country", "email", "phone",
]
PAID_STATUSES = ["completed", "processing", "refunded", "return-approved", "on-hold"]
ENDED_STATUSES = ["cancelled", "failed"]
UNFULFILLABLE = ["cancelled", "failed", "pending"]

#: Most copies of a row that are written out from one array.
_BLOCK = 65_536


def _text(c: Column) -> Column:
    # order text holds entities rarely and newlines often; entities are decoded at extract time
    return one_line_text(c, entities=False)


def _present(c: Column) -> Column:
    """Ids of 0 mean none."""
    return F.when(c != 0, c)


def _sum(items: Column, field: str) -> Column:
    zero = F.lit(0).cast("decimal(38,10)")
    return F.aggregate(
        items,
        zero,
        lambda a, i: (a + money_or_zero(i[field])).cast("decimal(38,10)"),
    )


def total_of(items: Column, field: str) -> Column:
    """Two-place sum over an array of structs; null array is zero."""
    return F.bround(F.coalesce(_sum(items, field), F.lit(0).cast("decimal(38,10)")), 2).cast("decimal(18,2)")


def _order_base() -> list[Column]:
    return [
        F.coalesce(F.col("number"), F.col("id").cast("string")).alias("order_number"),
        F.col("id").alias("order_id"),
    ]


def refund_orders(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    """Refunds with the order they belong to: nested id first, else the id in the parent link."""
    nested = orders.select(
        F.col("id").alias("_nested_order"), F.explode("refunds.id").alias("_refund_id")
    )
    href = F.get(
        F.filter(F.col("_links.up.href"), lambda h: h.rlike(r"/orders/\d+")), F.lit(0)
    )
    linked = F.regexp_extract(href, r"/orders/(\d+)", 1).try_cast("bigint")
    return (
        refunds.join(nested, F.col("id") == F.col("_refund_id"), "left")
        .withColumn("order_id", F.coalesce("_nested_order", linked))
        .drop("_nested_order", "_refund_id")
    )


def lines_as_ids(rows: DataFrame) -> DataFrame:
    """Rows whose ``line_items`` hold ids alone: enough to count them, and joins don't carry the records."""
    return rows.withColumn("line_items", F.transform("line_items", lambda i: F.struct(i["id"].alias("id"))))


def refund_totals_by_order(
    refunds: DataFrame, key: str = "order_id", amount: Column | None = None
) -> DataFrame:
    """Absolute refunded amount per order."""
    value = F.abs(money_or_zero(F.col("amount"))) if amount is None else F.abs(amount)
    return (
        refunds.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum(value).cast("decimal(18,2)").alias("refunded"), F.count(F.lit(1)).alias("refunds"))
    )


def payment_status(status: Column, refunded: Column, paid_at: Column) -> Column:
    return (
        F.when(status == "refunded", "refunded")
        .when(refunded > 0, "partially-refunded")
        .when(paid_at.isNotNull() & (paid_at != ""), "paid")
        .when(status.isin(*ENDED_STATUSES), status)
        .when(status.isin(*PAID_STATUSES), "paid-date-not-recorded")
        .otherwise("unpaid")
    )


def fulfilment_status(status: Column) -> Column:
    return (
        F.when(status == "completed", "fulfilled")
        .when(status.isin(*UNFULFILLABLE), F.concat(F.lit("not-fulfilled ("), status, F.lit(")")))
        .otherwise(F.concat(F.lit("in-progress ("), status, F.lit(")")))
    )


def delivery_type(method_ids: Column) -> Column:
    return (
        F.when(F.coalesce(F.size(method_ids), F.lit(0)) <= 0, "not recorded")
        .when(F.forall(method_ids, lambda m: m == "local_pickup"), "pickup")
        .otherwise("shipped")
    )


def _address_cells() -> list[Column]:
    cells = [_text(F.col(f"billing.{f}")).alias(f"billing_{f}") for f in ADDRESS_FIELDS]
    return cells + [
        _text(F.col(f"shipping.{f}")).alias(f"shipping_{f}") for f in ADDRESS_FIELDS if f != "email"
    ]


def _joined(items: Column, field: str) -> Column:
    return F.coalesce(F.array_join(F.transform(items, lambda i: _text(i[field])), "; "), F.lit(""))


def _yes_no(c: Column) -> Column:
    return F.when(c, "yes").otherwise("no")


def with_refunded(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """Orders plus ``refunded``; ``refunds`` carries ``order_id``."""
    totals = refund_totals_by_order(refunds).withColumnRenamed("order_id", "_order")
    joined = orders.join(totals, F.col("id") == F.col("_order"), "left").drop("_order")
    return joined.withColumn("refunded", F.coalesce("refunded", F.lit(0).cast("decimal(18,2)")))


def _quantity(items: Column) -> Column:
    return F.coalesce(
        F.aggregate(items, F.lit(0).cast("bigint"), lambda a, i: a + F.coalesce(i["quantity"], F.lit(0))),
        F.lit(0).cast("bigint"),
    )


def archive_orders(orders: DataFrame, tz: str = "+00:00") -> DataFrame:
    """One row per order, of :func:`with_refunded` rows."""
    items = F.col("line_items")
    net = (money_or_zero(F.col("total")) - F.col("refunded")).cast("decimal(38,10)")
    return orders.select(
        *_order_base(),
        _present(F.col("parent_id")).alias("parent_order_id"),
        F.coalesce("status", F.lit("")).alias("status"),
        F.coalesce("currency", F.lit("")).alias("currency"),
        *[
            stamp_tz(F.col(f"date_{d}_gmt"), tz).alias(f"date_{d}")
            for d in ("created", "modified", "paid", "completed")
        ],
        F.coalesce("created_via", F.lit("")).alias("created_via"),
        _present(F.col("customer_id")).alias("customer_id"),
        _text(F.col("customer_note")).alias("customer_note"),
        *_address_cells(),
        F.coalesce(F.size(items), F.lit(0)).alias("line_item_count"),
        _quantity(items).alias("item_quantity"),
        total_of(items, "subtotal").alias("items_subtotal"),
        *[
            money(F.col(f)).alias(f)
            for f in ("discount_total", "discount_tax", "shipping_total", "shipping_tax")
        ],
        total_of(F.col("fee_lines"), "total").alias("fee_total"),
        money(F.col("cart_tax")).alias("cart_tax"),
        money(F.col("total_tax")).alias("total_tax"),
        money(F.col("total")).alias("order_total"),
        F.col("refunded").alias("refunded_total"),
        F.bround(net, 2).cast("decimal(18,2)").alias("net_total"),
        _joined(F.col("coupon_lines"), "code").alias("coupon_codes"),
        _joined(F.col("shipping_lines"), "method_title").alias("shipping_methods"),
        F.coalesce("payment_method", F.lit("")).alias("payment_method"),
        _text(F.col("payment_method_title")).alias("payment_method_title"),
        F.coalesce("transaction_id", F.lit("")).alias("transaction_id"),
        _yes_no(F.col("prices_include_tax")).alias("prices_include_tax"),
        F.coalesce("order_key", F.lit("")).alias("order_key"),
    )


def order_lines(orders: DataFrame) -> DataFrame:
    """Line items, shipping lines and fees in one shape; discount is subtotal less total.

    Each order is exploded once over the three kinds together, so the table is read once.
    """
    fields = (
        "line_id bigint, line_type string, product_id bigint, variation_id bigint, sku string,"
        " product_name string, parent_name string, variant string, quantity int, unit_price string,"
        " line_subtotal string, line_total string, line_tax string"
    )
    shape = "struct<" + ",".join(f.strip().replace(" ", ":") for f in fields.split(",")) + ">"

    def line(kind: str, i: Column, **values: Column) -> Column:
        empty = F.lit(None)
        order = [f.strip().split(" ")[0] for f in fields.split(",")]
        given = {"line_id": i["id"], "line_type": F.lit(kind), "line_tax": i["total_tax"], **values}
        return F.struct(*[given.get(n, empty).alias(n) for n in order]).cast(shape)

    none = F.array().cast(f"array<{shape}>")
    goods = F.transform(
        "line_items",
        lambda i: line(
            "line_item",
            i,
            product_id=_present(i["product_id"]),
            variation_id=_present(i["variation_id"]),
            sku=i["sku"],
            product_name=i["name"],
            parent_name=i["parent_name"],
            variant=F.array_join(meta_pairs(i["meta_data"]), "; "),
            quantity=i["quantity"],
            unit_price=i["price"].cast("string"),
            line_subtotal=i["subtotal"],
            line_total=i["total"],
        ),
    )

    def flat(kind: str, column: str, name: str, variant: str | None) -> Column:
        return F.transform(
            column,
            lambda i: line(
                kind,
                i,
                product_name=i[name],
                variant=i[variant] if variant else F.lit(""),
                quantity=F.lit(1),
                unit_price=i["total"],
                line_subtotal=i["total"],
                line_total=i["total"],
            ),
        )

    shipping = flat("shipping", "shipping_lines", "method_title", "method_id")
    fees = flat("fee", "fee_lines", "name", None)
    every = F.concat(*[F.coalesce(part, none) for part in (goods, shipping, fees)])
    subtotal, total = money_or_zero(F.col("l.line_subtotal")), money_or_zero(F.col("l.line_total"))
    return orders.select(
        *_order_base(), F.coalesce("currency", F.lit("")).alias("currency"), F.explode(every).alias("l")
    ).select(
        "order_number",
        "order_id",
        *[F.col(f"l.{c}").alias(c) for c in ("line_id", "line_type", "product_id", "variation_id")],
        *[_text(F.col(f"l.{c}")).alias(c) for c in ("sku", "product_name", "parent_name", "variant")],
        F.col("l.quantity").alias("quantity"),
        money(F.col("l.unit_price")).alias("unit_price"),
        F.bround(subtotal, 2).cast("decimal(18,2)").alias("line_subtotal"),
        F.bround((subtotal - total).cast("decimal(38,10)"), 2).cast("decimal(18,2)").alias("line_discount"),
        F.bround(total, 2).cast("decimal(18,2)").alias("line_total"),
        money(F.col("l.line_tax")).alias("line_tax"),
        "currency",
    )


def union_lines(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Flat line tables in one shape: ``line_type`` by name, discount is subtotal less total."""
    return union_all(
        [
            df.select(
                "order_id", F.lit(kind).alias("line_type"), "quantity", "line_subtotal",
                (F.col("line_subtotal") - F.col("line_total")).alias("line_discount"), "line_total",
            )
            for kind, df in parts.items()
        ]
    )


def archive_payments(orders: DataFrame, gateways: DataFrame, tz: str = "+00:00") -> DataFrame:
    """One payment row per order with its gateway's title. The gateway list is shop
    configuration, joined by Spark's own size-checked choice of strategy."""
    titles = gateways.where(F.col("id").isNotNull()).select(
        F.col("id").alias("_gateway"),
        _text(F.coalesce(blank_to_null(F.col("method_title")), F.col("title"))).alias("gateway_method_title"),
    )
    net = (money_or_zero(F.col("total")) - F.col("refunded")).cast("decimal(38,10)")
    return orders.join(titles, F.col("payment_method") == F.col("_gateway"), "left").select(
        *_order_base(),
        F.coalesce("payment_method", F.lit("")).alias("payment_method"),
        _text(F.col("payment_method_title")).alias("payment_method_title"),
        F.coalesce("gateway_method_title", F.lit("")).alias("gateway_method_title"),
        F.coalesce("transaction_id", F.lit("")).alias("transaction_reference"),
        money(F.col("total")).alias("amount"),
        F.coalesce("currency", F.lit("")).alias("currency"),
        stamp_tz(F.col("date_paid_gmt"), tz).alias("payment_date"),
        payment_status(F.coalesce("status", F.lit("")), F.col("refunded"), F.col("date_paid_gmt")).alias(
            "payment_status"
        ),
        F.col("refunded").alias("refunded_total"),
        F.bround(net, 2).cast("decimal(18,2)").alias("net_amount"),
    )


def _with_order(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    heads = orders.select(
        F.col("id").alias("_order"),
        F.coalesce(F.col("number"), F.col("id").cast("string")).alias("order_number"),
        F.coalesce("currency", F.lit("")).alias("currency"),
    )
    return (
        refunds.join(heads, F.col("order_id") == F.col("_order"), "left")
        .withColumn("order_number", F.coalesce("order_number", F.lit("")))
        .withColumn("currency", F.coalesce("currency", F.lit("")))
    )


def archive_refunds(refunds: DataFrame, orders: DataFrame, tz: str = "+00:00") -> DataFrame:
    """Refund rows, of :func:`refund_orders` rows."""
    return _with_order(refunds, orders).select(
        F.col("id").alias("refund_id"),
        "order_number",
        "order_id",
        stamp_tz(F.col("date_created_gmt"), tz).alias("refund_date"),
        money(F.col("amount")).alias("amount"),
        "currency",
        _text(meta_value(F.col("meta_data"), "_refund_type")).alias("refund_type"),
        _text(F.col("reason")).alias("reason"),
        _present(F.col("refunded_by")).alias("refunded_by_user_id"),
        _yes_no(F.col("refunded_payment")).alias("refunded_payment"),
        F.coalesce(F.size("line_items"), F.lit(0)).alias("refund_line_count"),
    )


def archive_refund_lines(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        _with_order(refunds, orders)
        .withColumn("i", F.explode("line_items"))
        .select(
            F.col("id").alias("refund_id"),
            "order_number",
            "order_id",
            F.col("i.id").alias("line_id"),
            _text(meta_value(F.col("i.meta_data"), "_refunded_item_id")).alias("refunded_item_id"),
            _present(F.col("i.product_id")).alias("product_id"),
            _present(F.col("i.variation_id")).alias("variation_id"),
            _text(F.col("i.sku")).alias("sku"),
            _text(F.col("i.name")).alias("product_name"),
            F.array_join(meta_pairs(F.col("i.meta_data")), "; ").alias("variant"),
            F.col("i.quantity").alias("quantity"),
            money(F.col("i.subtotal")).alias("line_subtotal"),
            money(F.col("i.total")).alias("line_total"),
            money(F.col("i.total_tax")).alias("line_tax"),
            "currency",
        )
    )


def orphan_refunds(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    """Refunds whose order is not in the source."""
    keys = orders.select(F.col("id").alias("order_id"))
    return refunds.join(keys, "order_id", "left_anti").select(F.col("id").alias("refund_id"), "order_id")


def archive_fulfilments(orders: DataFrame, tz: str = "+00:00") -> DataFrame:
    methods = F.transform("shipping_lines", lambda s: F.coalesce(s["method_id"], F.lit("")))
    name = F.concat_ws(
        " ", F.coalesce(F.col("shipping.first_name"), F.lit("")), F.coalesce(F.col("shipping.last_name"), F.lit(""))
    )
    blank = F.lit("")
    return orders.select(
        *_order_base(),
        fulfilment_status(F.coalesce("status", F.lit(""))).alias("fulfilment_status"),
        stamp_tz(F.col("date_completed_gmt"), tz).alias("fulfilment_date"),
        delivery_type(methods).alias("delivery_type"),
        _joined(F.col("shipping_lines"), "method_title").alias("shipping_method"),
        F.coalesce(F.array_join(methods, "; "), blank).alias("shipping_method_id"),
        blank.alias("carrier"),
        blank.alias("tracking_number"),
        blank.alias("tracking_url"),
        _quantity(F.col("line_items")).alias("item_quantity"),
        _text(name).alias("shipping_recipient_name"),
        *[_text(F.col(f"shipping.{f}")).alias(f"shipping_{f}") for f in ("city", "state", "postcode", "country")],
    )


def archive_fulfilment_lines(orders: DataFrame) -> DataFrame:
    return orders.select(
        *_order_base(),
        fulfilment_status(F.coalesce("status", F.lit(""))).alias("fulfilment_status"),
        F.explode("line_items").alias("i"),
    ).select(
        "order_number",
        "order_id",
        F.col("i.id").alias("line_id"),
        _text(F.col("i.sku")).alias("sku"),
        _text(F.col("i.name")).alias("product_name"),
        F.array_join(meta_pairs(F.col("i.meta_data")), "; ").alias("variant"),
        F.col("i.quantity").alias("quantity"),
        "fulfilment_status",
    )


def customer_order_totals(
    customers: DataFrame, orders: DataFrame, customer: str, order_customer: str, total: Column
) -> DataFrame:
    """Customers plus orders and order total; orders are summed before the join, so a customer
    with a third of all orders is one row by then."""
    sums = (
        orders.where(F.col(order_customer).isNotNull())
        .groupBy(F.col(order_customer).alias(customer))
        .agg(
            F.count(F.lit(1)).alias("orders_in_archive"),
            F.sum(total).cast("decimal(28,2)").alias("order_total_in_archive"),
        )
    )
    return (
        customers.join(sums, customer, "left")
        .withColumn("orders_in_archive", F.coalesce("orders_in_archive", F.lit(0).cast("bigint")))
        .withColumn(
            "order_total_in_archive", F.coalesce("order_total_in_archive", F.lit(0).cast("decimal(28,2)"))
        )
    )


def archive_customers(customers: DataFrame, orders: DataFrame, tz: str = "+00:00") -> DataFrame:
    placed = orders.select(_present(F.col("customer_id")).alias("customer_id"), "total")
    rows = customers.select(
        F.col("id").alias("customer_id"),
        *[_text(F.col(f)).alias(f) for f in ("username", "email", "first_name", "last_name")],
        F.coalesce("role", F.lit("")).alias("role"),
        stamp_tz(F.col("date_created_gmt"), tz).alias("date_created"),
        _yes_no(F.col("is_paying_customer")).alias("is_paying_customer"),
        *_address_cells(),
    )
    return customer_order_totals(rows, placed, "customer_id", "customer_id", money_or_zero(F.col("total")))


def orphan_rows(child: DataFrame, parent: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Child rows whose key is in no parent row."""
    keys = [key] if isinstance(key, str) else list(key)
    if set(child.columns) != set(keys):
        # distinct first: a hot key is then one row on the build side
        return child.join(parent.select(*keys).distinct(), keys, "left_anti")
    # rows that are nothing but their key are counted, both sides in one hash aggregation, so neither side is sorted;
    # the few lost ones are written out again, in blocks
    sides = child.select(*keys, F.lit(1).alias("_row")).unionByName(parent.select(*keys, F.lit(0).alias("_row")))
    counted = sides.groupBy(*keys).agg(F.sum("_row").alias("_rows"), F.min("_row").alias("_known"))
    # a null key is equal to none
    null_key = reduce(or_, [F.col(k).isNull() for k in keys])
    lost = counted.where((F.col("_rows") > 0) & ((F.col("_known") > 0) | null_key))
    blocks = lost.withColumn("_block", F.explode(F.expr(f"sequence(0, (_rows - 1) div {_BLOCK})")))
    here = F.least(F.lit(_BLOCK), F.col("_rows") - F.col("_block") * _BLOCK).cast("int")
    return blocks.withColumn("_one", F.explode(F.array_repeat(F.lit(True), here))).select(*child.columns)


def archive_tables(
    orders: DataFrame, refunds: DataFrame, customers: DataFrame, gateways: DataFrame, tz: str = "+00:00"
) -> dict[str, DataFrame]:
    """The eight tables of the archive."""
    linked = refund_orders(refunds, orders)
    costed = with_refunded(orders, linked)
    return {
        "orders": archive_orders(costed, tz),
        "order-lines": order_lines(orders),
        "payments": archive_payments(costed, gateways, tz),
        "refunds": archive_refunds(refund_orders(lines_as_ids(refunds), orders), orders, tz),
        "refund-lines": archive_refund_lines(linked, orders),
        "fulfilments": archive_fulfilments(orders, tz),
        "fulfilment-lines": archive_fulfilment_lines(orders),
        "customers-reference": archive_customers(customers, orders, tz),
    }


def measures(df: DataFrame, scope: Column, values: Mapping[str, Column]) -> DataFrame:
    """Tall ``(metric, scope, value)`` of conditional sums: one aggregation per table, whatever the
    number of metrics."""
    names = list(values)
    wide = df.groupBy(scope.alias("scope")).agg(
        *[F.coalesce(F.sum(v), F.lit(0)).cast("decimal(38,4)").alias(n) for n, v in values.items()]
    )
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.selectExpr("scope", f"stack({len(names)}, {pairs}) AS (metric, value)")


def measures_by(df: DataFrame, groups: Mapping[str, tuple[Column, Mapping[str, Column]]]) -> DataFrame:
    """:func:`measures` of several scopes in one reading of ``df``; a null scope is left out.

    Sums are first taken per combination of the scopes, which the tasks do before anything is shuffled; each scope then adds up the
    combinations' few rows.
    """
    scopes = {g: f"_scope_{i}" for i, g in enumerate(groups)}
    cells = {(g, n): f"_value_{i}_{j}" for i, g in enumerate(groups) for j, n in enumerate(groups[g][1])}
    given = df.select(*[groups[g][0].alias(c) for g, c in scopes.items()], *[groups[g][1][n].alias(c) for (g, n), c in cells.items()])
    summed = given.groupBy(*scopes.values()).agg(*[F.sum(c).alias(c) for c in cells.values()])
    tall = F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(scopes[g]).alias("scope"), F.col(c).cast("decimal(38,10)").alias("value"))
        for (g, n), c in cells.items()
    ])
    return (
        summed.select(F.explode(tall).alias("_cell")).select("_cell.*").where(F.col("scope").isNotNull())
        .groupBy("scope", "metric").agg(F.coalesce(F.sum("value"), F.lit(0)).cast("decimal(38,4)").alias("value"))
        .select("scope", "metric", "value")
    )


def reconcile_pairs(df: DataFrame, scope: Column, pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Checks whose two sides lie in one joined table: a single aggregation gives both."""
    sums = [
        F.coalesce(F.sum(side), F.lit(0)).cast("decimal(38,4)").alias(f"{n}_{i}") for n, sides in pairs.items() for i, side in enumerate(sides)
    ]
    cells = ", ".join(f"'{n}', `{n}_0`, `{n}_1`" for n in pairs)
    wide = df.groupBy(scope.alias("scope")).agg(*sums)
    return wide.selectExpr("scope", f"stack({len(pairs)}, {cells}) AS (metric, source_value, archive_value)").withColumn(
        "status", check_status(F.col("source_value"), F.col("archive_value"), F.lit(None))
    )


def reconcile_totals(source: DataFrame, archive: DataFrame, notes: Mapping[str, str] | None = None, strict: bool = False) -> DataFrame:
    """Compare two :func:`measures` tables.

    A difference with a note is ``explained``, one without is ``mismatch``; ``strict`` ignores the
    notes, so a new defect cannot hide behind an old one.
    """
    noted = F.create_map(*[F.lit(x) for pair in (notes or {}).items() for x in pair]) if notes else None
    explanation = F.try_element_at(noted, F.col("metric")) if notes else F.lit(None).cast("string")
    zero = F.lit(0).cast("decimal(38,4)")
    return (
        source.withColumnRenamed("value", "source_value")
        .join(archive.withColumnRenamed("value", "archive_value"), ["metric", "scope"], "full")
        .withColumn("source_value", F.coalesce("source_value", zero))
        .withColumn("archive_value", F.coalesce("archive_value", zero))
        .withColumn("difference", (F.col("source_value") - F.col("archive_value")).cast("decimal(38,4)"))
        .withColumn("explanation", explanation)
        .withColumn("status", check_status(F.col("source_value"), F.col("archive_value"), F.col("explanation"), strict))
    )


def check_status(source: Column, target: Column, explanation: Column, strict: bool = False) -> Column:
    same = F.when(source.eqNullSafe(target), "match")
    return same.otherwise("mismatch") if strict else same.when(explanation.isNotNull(), "explained").otherwise("mismatch")


def reconcile_archive(
    orders: DataFrame, refunds: DataFrame, customers: DataFrame, tables: Mapping[str, DataFrame],
    notes: Mapping[str, str] | None = None, strict: bool = False,
) -> DataFrame:
    """Counts, sums per currency, line counts and orphans of the archive against its source."""
    one = F.lit(1)
    status = F.concat(F.lit("status="), F.coalesce("status", F.lit("")))
    currency = F.concat(F.lit("currency="), F.coalesce("currency", F.lit("")))
    every = F.lit("all")
    amount = {n: money_or_zero(F.col(c)) for n, c in (
        ("discount_total", "discount_total"), ("shipping_total", "shipping_total"),
        ("tax_total", "total_tax"), ("order_total", "total"),
    )}
    linked = refund_orders(refunds, orders)
    refund_value = F.abs(money_or_zero(F.col("amount")))
    refunds_in = _with_order(linked, orders).where(F.col("_order").isNotNull())
    source = union_all([
        measures_by(orders, {
            "all": (every, {
                "order_count": one, "payment_count": one, "fulfilment_count": one,
                "line_item_count": F.coalesce(F.size("line_items"), F.lit(0)),
                "shipping_line_count": F.coalesce(F.size("shipping_lines"), F.lit(0)),
                "fee_line_count": F.coalesce(F.size("fee_lines"), F.lit(0)),
                "fulfilment_line_count": F.coalesce(F.size("line_items"), F.lit(0)),
            }),
            "status": (status, {"order_count": one}),
            "currency": (currency, {**amount, "gross_line_subtotal": total_of(F.col("line_items"), "subtotal")}),
        }),
        measures(refunds, every, {
            "refund_count": one, "refund_line_count": F.coalesce(F.size("line_items"), F.lit(0)),
        }),
        measures(refunds_in, currency, {"refund_total": refund_value}),
        measures(customers, every, {"customer_reference_count": one}),
        measures(
            orders.select("currency", money_or_zero(F.col("total")).alias("net"))
            .unionByName(refunds_in.select("currency", (-refund_value).alias("net"))),
            currency, {"net_total": F.col("net")},
        ),
    ])
    head, lines = tables["orders"], tables["order-lines"]
    is_goods = F.col("line_type") == "line_item"
    archive = union_all([
        measures_by(head, {
            "all": (every, {"order_count": one}),
            "status": (status, {"order_count": one}),
            "currency": (currency, {
                "discount_total": F.col("discount_total"), "shipping_total": F.col("shipping_total"),
                "tax_total": F.col("total_tax"), "order_total": F.col("order_total"),
                "net_total": F.col("net_total"), "refund_total": F.col("refunded_total"),
            }),
        }),
        measures_by(lines, {
            "currency": (F.when(is_goods, currency), {"gross_line_subtotal": F.col("line_subtotal")}),
            "all": (every, {
                f"{kind}_count": (F.col("line_type") == kind.replace("_line", "") if kind != "line_item" else is_goods).cast("int")
                for kind in ("line_item", "shipping_line", "fee_line")
            }),
        }),
        *[
            measures(tables[t], every, {m: one})
            for t, m in (
                ("payments", "payment_count"), ("refunds", "refund_count"), ("refund-lines", "refund_line_count"),
                ("fulfilments", "fulfilment_count"), ("fulfilment-lines", "fulfilment_line_count"),
                ("customers-reference", "customer_reference_count"),
            )
        ],
    ])
    orphans = union_all([
        # rows are counted by order first, so an order is one row at the join
        orphan_rows(tables[t].groupBy("order_number").agg(F.count(one).alias("n")), head, "order_number").agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("decimal(38,4)").alias("archive_value")
        ).select(
            F.lit("orphan_rows").alias("metric"), F.lit(t).alias("scope"),
            F.lit(0).cast("decimal(38,4)").alias("source_value"), "archive_value",
            (-F.col("archive_value")).cast("decimal(38,4)").alias("difference"),
            F.lit(None).cast("string").alias("explanation"),
            F.when(F.col("archive_value") == 0, "match").otherwise("mismatch").alias("status"),
        )
        for t in ("order-lines", "payments", "refunds", "refund-lines", "fulfilments", "fulfilment-lines")
    ])
    return reconcile_totals(source, archive, notes, strict).unionByName(orphans)


def order_summary(orders: DataFrame, order_id: str, created: str, currency: str, total: Column) -> DataFrame:
    """One row: extent, currencies and total of the order table."""
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.min(order_id).alias("min_order_id"),
        F.max(order_id).alias("max_order_id"),
        F.min(created).alias("min_order_date"),
        F.max(created).alias("max_order_date"),
        F.array_join(F.array_sort(F.collect_set(currency)), ",").alias("currencies"),
        F.coalesce(F.sum(total), F.lit(0)).cast("decimal(28,2)").alias("order_total"),
    )
