"""Archive tables: totals conserved, links right, files byte-stable."""

import csv
import hashlib
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import shopdata
from cartloom.operators import archive
from cartloom.sources import files, schemas
from cartloom.sources.snapshot import load_snapshot


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    folder = shopdata.write(tmp_path_factory.mktemp("orders"))
    return load_snapshot(spark, folder, schemas.ARCHIVE_REQUIRED, schemas.ARCHIVE_OPTIONAL)


@pytest.fixture(scope="module")
def tables(source):
    return archive.archive_tables(source["orders"], source["refunds"], source["customers"], source["payment_gateways"])


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_orders(tables):
    orders = by(tables["orders"], "order_id")
    first = orders[70]
    assert (first.order_number, first.line_item_count, first.item_quantity, first.items_subtotal) == ("N-70", 2, 2, Decimal("30.00"))
    assert (first.order_total, first.refunded_total, first.net_total) == (Decimal("33.00"), Decimal("10.00"), Decimal("23.00"))
    assert first.date_created == "2024-01-01T10:00:00+00:00" and first.date_completed == "" and first.customer_note == "=cmd() second"
    assert orders[71].order_number == "71" and orders[71].customer_id is None and orders[71].fee_total == Decimal("1.00")
    assert (orders[72].order_total, orders[72].net_total) == (Decimal("1000.50"), Decimal("999.50"))


def test_lines_payments_fulfilments(tables):
    lines = {(r.order_id, r.line_type, r.line_id): r for r in tables["order-lines"].collect()}
    assert {k[1] for k in lines} == {"line_item", "shipping", "fee"} and len(lines) == 5
    assert lines[70, "line_item", 1].variant == "Size: XL" and lines[70, "line_item", 1].line_discount == Decimal("2.00")
    assert lines[70, "shipping", 3].variant == "local_pickup" and lines[71, "fee", 5].quantity == 1
    payments = by(tables["payments"], "order_id")
    assert {i: p.payment_status for i, p in payments.items()} == {70: "partially-refunded", 71: "cancelled", 72: "partially-refunded"}
    assert payments[70].gateway_method_title == "Credit card" and payments[71].gateway_method_title == ""
    shipped = by(tables["fulfilments"], "order_id")
    assert {i: (f.fulfilment_status, f.delivery_type) for i, f in shipped.items()} == {
        70: ("fulfilled", "pickup"), 71: ("not-fulfilled (cancelled)", "not recorded"), 72: ("in-progress (processing)", "not recorded"),
    }


def test_refunds(source, tables):
    refunds = by(tables["refunds"], "refund_id")
    assert {i: r.order_id for i, r in refunds.items()} == {90: 70, 91: 72, 92: None}
    linked = archive.refund_orders(source["refunds"], source["orders"])
    assert [r.refund_id for r in archive.orphan_refunds(linked, source["orders"]).collect()] == [92]
    assert tables["refund-lines"].first().line_total == Decimal("-10.00")
    people = by(tables["customers-reference"], "customer_id")
    assert (people[50].orders_in_archive, people[50].order_total_in_archive) == (2, Decimal("1033.50")) and people[51].orders_in_archive == 0


def test_reconciliation(source, tables):
    checks = archive.reconcile_archive(source["orders"], source["refunds"], source["customers"], tables)
    bad = [r for r in checks.collect() if r.status != "match"]
    # the refund without an order is the one orphan, in its head row only (it has no lines)
    assert [(r.metric, r.scope) for r in bad] == [("orphan_rows", "refunds")]
    broken = {**tables, "order-lines": tables["order-lines"].where("line_id <> 2")}
    found = {(r.metric, r.scope): r for r in archive.reconcile_archive(source["orders"], source["refunds"], source["customers"], broken).collect()}
    assert found["gross_line_subtotal", "currency=AUD"].difference == Decimal("10.0000") and found["line_item_count", "all"].status == "mismatch"
    noted = archive.reconcile_archive(source["orders"], source["refunds"], source["customers"], broken, {"gross_line_subtotal": "known"})
    assert noted.where("metric = 'gross_line_subtotal' and scope = 'currency=AUD'").first().status == "explained"


def write(tables, folder):
    for name, df in tables.items():
        key = [c for c in ("order_id", "refund_id", "customer_id", "line_type", "line_id") if c in df.columns]
        files.write_archive_csv(df, f"{folder}/{name}", df.columns, key, single_file=True)
    return {str(p.relative_to(folder).parent): p.read_bytes() for p in Path(folder).rglob("part-*")}


def test_files_are_safe_and_byte_identical(spark, tables, tmp_path):
    once, twice = write(tables, tmp_path / "a"), write(tables, tmp_path / "b")
    assert once == twice and len(once) == 8
    raw = once["orders"]
    assert raw.startswith(b"\xef\xbb\xbforder_number") and raw.count(b"\r\n") == 4 and raw.count(b"\n") == 4
    rows = list(csv.DictReader(raw.decode("utf-8-sig").splitlines()))
    assert rows[0]["customer_note"] == "'=cmd() second" and rows[0]["billing_address_1"] == "'@home" and rows[0]["net_total"] == "23.00"
    refund = list(csv.DictReader(once["refund-lines"].decode("utf-8-sig").splitlines()))[0]
    assert refund["line_total"] == "-10.00"
    counts = spark.createDataFrame([("orders", 3)], "path string, rows long")
    manifest = {r.file.split("/")[0]: r for r in files.file_manifest(spark, str(tmp_path / "a"), counts).collect()}
    assert manifest["orders"].sha256 == hashlib.sha256(raw).hexdigest() and manifest["orders"].bytes == len(raw) and manifest["orders"].rows == 3
    lines = [r.value for r in files.checksum_lines(files.file_manifest(spark, str(tmp_path / "a"))).collect()]
    assert any(line.startswith(hashlib.sha256(raw).hexdigest() + "  orders/") for line in lines)


def test_records_round_trip(spark, tables, tmp_path):
    path = str(tmp_path / "records")
    df = tables["refunds"].select("refund_id", "amount", "reason")
    files.write_records(df, path, ["refund_id"])
    assert files.read_records(spark, path, "amount decimal(18,2), reason string, refund_id long").count() == 3
    text = "".join(p.read_text() for p in sorted(Path(path).glob("part-*")))
    assert text.splitlines()[0] == '{"amount":10.00,"reason":"+ok","refund_id":90}'
    assert files.read_records(spark, str(tmp_path / "none"), "a int").count() == 0


def test_order_summary(source):
    row = archive.order_summary(source["orders"], "id", "date_created_gmt", "currency", F.regexp_replace("total", ",", "").cast("decimal(18,2)")).first()
    assert (row.orders, row.min_order_id, row.max_order_id, row.currencies, row.order_total) == (3, 70, 72, "AUD,NZD", Decimal("1040.50"))


def test_orphan_keys_as_rows(spark, monkeypatch):
    """Repeated and null keys, against an anti join of the rows; neither side is sorted."""
    monkeypatch.setattr(archive, "_BLOCK", 2)
    child = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (None,), (None,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (3,), (3,), (None,), (9,)], "k int")
    lost = archive.orphan_rows(child, parent, "k")
    assert sorted((r.k is None, r.k) for r in lost.collect() if r.k) == [(False, 2)] * 3
    assert lost.count() == 5 and lost.exceptAll(child.join(parent, "k", "left_anti")).count() == 0
    plan = lost._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    wide = child.withColumn("v", F.lit(7))
    assert wide.columns == archive.orphan_rows(wide, parent, "k").columns and archive.orphan_rows(wide, parent, "k").count() == 5


def test_measures_by_reads_once(spark):
    """Several scopes of one reading equal one aggregation each; a null scope is left out."""
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4), (None, "x", 8)], "s string, t string, v int")
    one, s, t, v = F.lit(1), F.col("s"), F.col("t"), F.col("v")
    got = archive.measures_by(df, {"t": (t, {"n": one, "v": v}), "s": (s, {"v": v})})
    parts = archive.measures(df, t, {"n": one, "v": v}).unionByName(archive.measures(df.where("s is not null"), s, {"v": v}))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, parts.collect()))


def test_lines_as_ids_keeps_counts(source):
    slim = archive.lines_as_ids(source["refunds"])
    assert [f.name for f in slim.schema["line_items"].dataType.elementType.fields] == ["id"]
    linked = [archive.refund_orders(r, source["orders"]) for r in (slim, source["refunds"])]
    found = [sorted(map(tuple, archive.archive_refunds(r, source["orders"]).collect()), key=str) for r in linked]
    assert found[0] == found[1]


def test_one_line_text_of_ragged_texts(spark):
    from cartloom.functions.text import _on_one_line, one_line_text, strip

    texts = [None, "", " ", "plain", "two words", " edge", "edge ", "a\r\n b", " x ", "é", "x\u0085", "x\t", " y", "a\tb", "x\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = _on_one_line(strip(F.coalesce("t", F.lit(""))))
    assert all(r[0] == r[1] for r in df.select(one_line_text(F.col("t"), entities=False), plain).collect())
    assert df.where(F.col("t") == "plain").select(one_line_text(F.col("t"), entities=False)).first()[0] == "plain"
