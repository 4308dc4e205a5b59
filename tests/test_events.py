"""Batch event operators against brute force; streams against their batch twins, with restarts."""

import base64
import hashlib
import hmac
import random
from collections import defaultdict, deque
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cartloom.operators import events as ev
from cartloom.streaming import jobs
from test_expressions import signature

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def hits(n=400, seed=3, keys=("hot", "a", "b"), gap=60):
    rnd, at, rows = random.Random(seed), START, []
    for i in range(n):
        at += timedelta(seconds=rnd.choice([0, 1, 5, gap, 4 * gap]))
        rows.append(("hot" if rnd.random() < 0.7 else rnd.choice(keys), at, i))
    return rows


def brute_limit(rows, limit, window):
    kept, out = defaultdict(deque), {}
    for key, at, i in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        log = kept[key]
        while log and log[0] <= at - window:
            log.popleft()
        if len(log) < limit:
            log.append(at)
            out[i] = (True, limit - len(log), 0)
        else:
            out[i] = (False, 0, int((log[0] + window - at).total_seconds() * 1000))
    return out


@pytest.mark.parametrize("max_rows", [7, 50, 10_000])
def test_rate_limit(spark, max_rows):
    rows = hits()
    df = spark.createDataFrame(rows, "key string, ts timestamp, id long").repartition(5)
    got = {r.id: (r.allowed, r.remaining, r.retry_after_ms) for r in ev.rate_limit(df, "key", "ts", "id", 3, 120, max_rows).collect()}
    assert got == brute_limit(rows, 3, timedelta(seconds=120))


@pytest.mark.parametrize("n", [1000, 4000])
def test_rate_limit_rounds_do_not_grow(spark, monkeypatch, n):
    """One busy key without pauses: four times the slices, the same few rounds."""
    rnd = random.Random(2)
    rows = [("hot", START + timedelta(seconds=20 * i + rnd.randrange(20)), i) for i in range(n)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, id long")
    cuts = []
    real = ev.checkpointed
    monkeypatch.setattr(ev, "checkpointed", lambda df: cuts.append(1) or real(df))
    got = {r.id: (r.allowed, r.remaining, r.retry_after_ms) for r in ev.rate_limit(df, "key", "ts", "id", 3, 60, 100).collect()}
    assert got == brute_limit(rows, 3, timedelta(seconds=60)) and len(cuts) <= 7


def test_rate_limit_in_an_even_rhythm(spark):
    """The worst case: every slice's end depends on its start, so guesses are repaired one after the other."""
    rows = [("hot", START + timedelta(seconds=7 * i), i) for i in range(300)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, id long")
    got = {r.id: (r.allowed, r.remaining, r.retry_after_ms) for r in ev.rate_limit(df, "key", "ts", "id", 2, 60, 70).collect()}
    assert got == brute_limit(rows, 2, timedelta(seconds=60))


def test_rate_limit_query_against_brute_force(spark):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.001"
    rows = [(r.event_type, r.ts, r.event_id) for r in spark.read.parquet(f"{folder}/events.parquet").collect()]
    got = {r.id: (r.allowed, r.remaining) for r in entry.queries()["rate_limit"](spark, folder).collect()}
    assert got == {i: v[:2] for i, v in brute_limit(rows, 5, timedelta(days=1)).items()}


def brute_seen(rows, ttl):
    last, out = {}, {}
    for key, at, i in sorted(rows, key=lambda r: (r[1], r[2])):
        out[i] = bool(key) and key in last and at - last[key] < ttl
        last[key] = at
    return out


def test_deliveries_and_views(spark):
    rows = hits(keys=("", "a", "b"))
    df = spark.createDataFrame(rows, "key string, ts timestamp, id long")
    got = {r.id: r.duplicate for r in ev.dedupe_deliveries(df, "key", "ts", "id", 90, max_rows=40).collect()}
    assert got == brute_seen(rows, timedelta(seconds=90))
    paths = spark.createDataFrame([(k, t, i, f"/{i % 3 and 1}") for k, t, i in rows], "key string, ts timestamp, id long, path string")
    sent = {r.id for r in ev.page_view_dedupe(paths, "key", "ts", "id", F.col("path"), 40).collect()}
    last, want = {}, set()
    for k, t, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if last.get(k) != f"/{i % 3 and 1}":
            want.add(i)
        last[k] = f"/{i % 3 and 1}"
    assert sent == want


def submissions(spark):
    def token(at):
        stamp = int(at.timestamp() * 1000) - 10_000
        return f"{stamp}.{signature(str(stamp), 'k')}"

    rows = []
    for i in range(9):
        at = START + timedelta(seconds=i)
        message = "short" if i == 2 else "a message of some length"
        rows.append((i, at, "1.1.1.1", "", "" if i == 1 else token(at), "bot" if i == 0 else "", "A", "B", "a@b.co", "", "S", message))
    fields = "id long, ts timestamp, forwarded_for string, real_ip string, token string, website string, first_name string, last_name string, email string, phone string, subject string, message string"
    return spark.createDataFrame(rows, fields)


CONTACT = {0: "honeypot", 1: "token_missing", 2: "validation", 3: "accepted", 4: "accepted", 5: "accepted", 6: "accepted", 7: "rate_limited", 8: "rate_limited"}


def test_contact_outcomes(spark):
    rows = ev.contact_outcomes(submissions(spark), "k").collect()
    assert {r.id: r.outcome for r in rows} == CONTACT
    assert {r.id: r.answer for r in rows} == {i: "success" if o in ("honeypot", "token_missing", "accepted") else "error" for i, o in CONTACT.items()}


def deliveries(spark):
    sign = lambda b: base64.b64encode(hmac.new(b"k", b, hashlib.sha256).digest()).decode()
    body, bad = b'{"handle":"tee"}', b"{oops"
    rows = [
        (1, 0, "products/update", "w1", "Shop.example ", sign(body), body), (2, 10, "products/update", "w1", "shop.example", sign(body), body),
        (3, 20, "products/update", "w2", "shop.example", "junk", body), (4, 30, "products/update", "w3", "other", sign(body), body),
        (5, 40, "app/x", "w4", "shop.example", sign(body), body), (6, 50, "products/create", "", "shop.example", sign(bad), bad),
        (7, 60, "products/create", "", "shop.example", sign(bad), bad), (8, 5000, "products/update", "w1", "shop.example", sign(body), body),
    ]
    fields = "seq long, received_at timestamp, topic string, webhook_id string, shop string, hmac string, body binary"
    return spark.createDataFrame([(s, START + timedelta(seconds=t), a, w, sh, h, bytearray(b)) for s, t, a, w, sh, h, b in rows], fields)


WEBHOOKS = {1: "revalidated", 2: "duplicate", 3: "401", 4: "403", 5: "ignored", 6: "revalidated", 7: "revalidated", 8: "revalidated"}


def test_webhook_outcomes(spark):
    rows = ev.webhook_outcomes(deliveries(spark), "k", ["shop.example"])
    assert {r.seq: r.outcome for r in rows.collect()} == WEBHOOKS
    tags = sorted((r.seq, r.tag) for r in ev.tag_rows(rows).collect())
    assert tags[:2] == [(1, "shop:product:tee"), (1, "shop:products")] and (6, "shop:products") in tags


class Stream:
    """Rows arrive as files, one micro-batch each; ``run`` may be called again on the same checkpoint."""

    def __init__(self, spark, folder, df, order, batches):
        self.spark, self.folder, self.schema = spark, folder, df.schema
        rows = df.orderBy(order).collect()
        size = -(-len(rows) // batches)
        self.parts = [spark.createDataFrame(rows[i : i + size], df.schema) for i in range(0, len(rows), size)]
        self.sent = 0

    def send(self, n):
        for part in self.parts[self.sent : self.sent + n]:
            part.coalesce(1).write.mode("append").parquet(str(self.folder / "in"))
        self.sent += n

    def run(self, job):
        source = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(str(self.folder / "in"))
        q = (
            job(source).writeStream.format("parquet").option("checkpointLocation", str(self.folder / "ckpt"))
            .outputMode("append").trigger(availableNow=True).start(str(self.folder / "out"))
        )
        q.awaitTermination()

    def out(self):
        return self.spark.read.parquet(str(self.folder / "out"))


def replay(spark, tmp_path, df, order, job, batches=3):
    """First batch, stop, restart from the checkpoint, rest."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    stream = Stream(spark, tmp_path, df, order, batches)
    for n in (1, batches - 1):
        stream.send(n)
        stream.run(job)
    return stream.out()


def test_stream_deliveries(spark, tmp_path):
    rows = hits(120, keys=("", "a", "b"))
    df = spark.createDataFrame(rows, "key string, ts timestamp, id long")
    out = replay(spark, tmp_path, df, ["ts", "id"], lambda s: jobs.dedupe_deliveries(s, "key", "ts", "id", 90, "1 day"))
    assert {r.seq: r.duplicate for r in out.collect()} == brute_seen(rows, timedelta(seconds=90))


def test_stream_views(spark, tmp_path):
    rows = spark.createDataFrame([(k, t, i, f"/{i % 3 and 1}") for k, t, i in hits(120)], "key string, ts timestamp, id long, path string")
    out = replay(spark, tmp_path, rows, ["ts", "id"], lambda s: jobs.page_view_dedupe(s, "key", "ts", "id", F.col("path"), delay="1 day"))
    want = {r.id for r in ev.page_view_dedupe(rows, "key", "ts", "id", F.col("path")).collect()}
    assert {r.seq for r in out.where("send").collect()} == want and out.count() == 120


def test_stream_rate_limit(spark, tmp_path):
    rows = hits(120)
    df = spark.createDataFrame(rows, "key string, ts timestamp, id long")
    out = replay(spark, tmp_path, df, ["ts", "id"], lambda s: jobs.rate_limit(s, F.col("key"), "ts", "id", 3, 120, "1 day"))
    want = {i: v[:2] for i, v in brute_limit(rows, 3, timedelta(seconds=120)).items()}
    assert {r.seq: (r.allowed, r.remaining) for r in out.collect()} == want


def test_stream_contact(spark, tmp_path):
    out = replay(spark, tmp_path, submissions(spark), ["id"], lambda s: jobs.contact_outcomes(s, "k", delay="1 day"))
    assert {r.seq: r.outcome for r in out.collect()} == CONTACT


def test_stream_webhooks(spark, tmp_path):
    out = replay(spark, tmp_path, deliveries(spark), ["seq"], lambda s: jobs.webhook_outcomes(s, "k", ["shop.example"], delay="1 day"))
    assert {r.seq: r.outcome for r in out.collect()} == WEBHOOKS
    assert out.where("seq = 1").first().tags == ["shop:products", "shop:product:tee"]


def test_stream_metrics(spark, tmp_path):
    item = "array<struct<price:decimal(18,2),quantity:int,currency:string>>"
    raw = spark.createDataFrame(
        [("view_item" if i % 2 else "other", START + timedelta(minutes=i), f'[{{"price":{i},"quantity":2,"currency":"AUD"}}]', "") for i in range(30)] + [("view_item", START + timedelta(days=2), "[]", "")],
        "name string, ts timestamp, raw string, coupon string",
    ).select("name", "ts", F.from_json("raw", item).alias("items"), "coupon", F.lit(None).cast("decimal(18,2)").alias("costed"))
    out = replay(spark, tmp_path, raw, ["ts"], lambda s: jobs.ecommerce_metrics(s, "AUD", "10 minutes", "1 minute"), batches=3)
    batch = ev.commerce_events(raw, "AUD").groupBy(F.window("ts", "10 minutes").start.alias("start")).agg(F.sum("value").alias("v"), F.count("*").alias("n"))
    want = {(r.start, r.v, r.n) for r in batch.collect() if r.start < datetime(2024, 1, 2)}
    assert {(r.start, r.value, r.events) for r in out.collect()} == want


def test_stream_drop_repeats(spark, tmp_path):
    rows = spark.createDataFrame([("a", START + timedelta(seconds=i), i) for i in range(6)] + [("b", START, 9)], "key string, ts timestamp, id long")
    out = replay(spark, tmp_path, rows, ["ts", "id"], lambda s: jobs.drop_repeats(s, "key", "ts", "1 hour"), batches=2)
    assert sorted(r.key for r in out.collect()) == ["a", "b"]


def out_of_order(rows, reach, seed=5):
    """Rows as a stream may bring them: each up to ``reach`` late; last one row far ahead, which lets the watermark pass all others."""
    rnd = random.Random(seed)
    return sorted(rows, key=lambda r: r[1] + timedelta(seconds=rnd.uniform(0, reach)))


def event_time_replay(spark, tmp_path, rows, schema, job, batches=4):
    """``rows`` in order of arrival, with a restart after the first micro-batch."""
    arrivals = [(*r, i) for i, r in enumerate(rows)]
    last = max(r[1] for r in rows) + timedelta(days=9)
    arrivals.append((*[("end" if i == 0 else last if i == 1 else -1 if i == 2 else "/") for i in range(len(rows[0]))], len(rows)))
    df = spark.createDataFrame(arrivals, schema + ", arrival long")
    out = replay(spark, tmp_path, df, ["arrival"], job, batches)
    return out.where("seq >= 0")


@pytest.mark.parametrize("slot", [1, 60, 90])
def test_stream_deliveries_out_of_order(spark, tmp_path, slot):
    rows = hits(150, keys=("a", "b"))
    mixed = out_of_order(rows, 1800)
    assert mixed != rows
    out = event_time_replay(
        spark, tmp_path, mixed, "key string, ts timestamp, id long", lambda s: jobs.dedupe_deliveries(s, "key", "ts", "id", 90, "1 hour", slot)
    )
    found = out.collect()
    assert len(found) == 150 and {r.seq: r.duplicate for r in found} == brute_seen(rows, timedelta(seconds=90))


def test_stream_rate_limit_out_of_order(spark, tmp_path):
    rows = hits(150)
    out = event_time_replay(
        spark, tmp_path, out_of_order(rows, 1800), "key string, ts timestamp, id long",
        lambda s: jobs.rate_limit(s, F.col("key"), "ts", "id", 3, 120, "1 hour", 30),
    )
    want = {i: (a, left) for i, (a, left, _) in brute_limit(rows, 3, timedelta(seconds=120)).items()}
    assert {r.seq: (r.allowed, r.remaining) for r in out.collect()} == want


def test_stream_views_out_of_order(spark, tmp_path):
    rows = [(k, t, i, None if i % 7 == 0 else f"/{i % 3 and 1}") for k, t, i in hits(150)]
    schema = "key string, ts timestamp, id long, path string"
    out = event_time_replay(
        spark, tmp_path, out_of_order(rows, 1800), schema,
        lambda s: jobs.page_view_dedupe(s, "key", "ts", "id", F.col("path"), delay="1 hour", order_seconds=60),
    )
    want = {r.id for r in ev.page_view_dedupe(spark.createDataFrame(rows, schema), "key", "ts", "id", F.col("path")).collect()}
    found = out.collect()
    assert len(found) == 150 and {r.seq for r in found if r.send} == want


def test_slot_no_longer_than_the_key_is_kept():
    from cartloom.streaming.state import SeenDeliveries

    with pytest.raises(ValueError):
        SeenDeliveries(1_000_000, 2_000_000)
