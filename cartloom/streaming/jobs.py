"""Streaming jobs. Stateless parts are the batch functions; stateful ones have a batch twin in
:mod:`cartloom.operators.events`.

The events themselves carry no watermark. Unbounded streams need one to let state go, so each job
takes a delay: events later than it are dropped by Spark's state operators (and counted in the query
progress as rows dropped by watermark). Micro-batches are bounded by the source's admission options
(``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``), which also bound what one key brings at a time.

``order_seconds`` of the stateful jobs is 0 for an answer in the micro-batch that brings the row: rows of one key are then
ordered within that micro-batch. Above 0 rows wait in state, in slots of so many seconds of event time, until the watermark
passes their slot. Verdicts then equal the batch twin's for rows that come in any order within the delay, and a task holds one
slot of one key. Rows of a last slot that the watermark never passes stay in state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from cartloom.functions import forms
from cartloom.operators import events as ev
from cartloom.operators.ledger_store import FANOUT, apply_batch


SECOND = 1_000_000


def _stateful(
    rows: DataFrame, key: Column, ts: str, seq: str, processor: StatefulProcessor, fields: str, delay: str, extra: dict[str, Column] | None = None
) -> DataFrame:
    """``key, seq, ts`` rows through a per-key processor, in event-time mode."""
    narrow = rows.select(
        key.alias("key"), F.col(seq).alias("seq"), F.col(ts).cast("timestamp").alias("ts"), *[c.alias(n) for n, c in (extra or {}).items()]
    ).withColumn("us", F.unix_micros("ts"))
    return (
        narrow.withWatermark("ts", delay)
        .groupBy("key")
        .transformWithStateInPandas(
            statefulProcessor=processor, outputStructType=fields, outputMode="Append", timeMode="EventTime"
        )
    )


def dedupe_deliveries(
    stream: DataFrame, id_: str, ts: str, seq: str, ttl_seconds: int = ev.TTL_SECONDS, delay: str = "10 minutes", order_seconds: int = 0
) -> DataFrame:
    """``seq, us, duplicate`` of each delivery; a blank id bypasses the state."""
    blank = F.coalesce(F.col(id_).cast("string"), F.lit("")) == ""
    from cartloom.streaming.state import SeenDeliveries

    seen = SeenDeliveries(ttl_seconds * SECOND, order_seconds * SECOND)
    named = _stateful(stream.where(~blank), F.col(id_).cast("string"), ts, seq, seen, "seq bigint, us bigint, duplicate boolean", delay)
    free = stream.where(blank).select(
        F.col(seq).cast("bigint").alias("seq"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"), F.lit(False).alias("duplicate")
    )
    return named.unionByName(free)


def drop_repeats(stream: DataFrame, id_: str, ts: str, delay: str = "10 minutes") -> DataFrame:
    """Variant without the restarting clock: the first delivery of an id within the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([id_])


def page_view_dedupe(
    stream: DataFrame, session: str, ts: str, seq: str, path: Column, keep_seconds: int = 86_400, delay: str = "10 minutes", order_seconds: int = 0
) -> DataFrame:
    """``seq, us, send`` of each view. A session idle for ``keep_seconds`` is forgotten."""
    from cartloom.streaming.state import LastPath

    last = LastPath(keep_seconds * SECOND, order_seconds * SECOND)
    return _stateful(stream, F.col(session).cast("string"), ts, seq, last, "seq bigint, us bigint, send boolean", delay, {"path": path})


def rate_limit(
    stream: DataFrame, key: Column, ts: str, seq: str, limit: int = ev.LIMIT, window_seconds: int = ev.WINDOW_SECONDS, delay: str = "10 minutes",
    order_seconds: int = 0,
) -> DataFrame:
    """``seq, us, allowed, remaining, wait_us`` of each hit."""
    from cartloom.streaming.state import SlidingLog

    fields = "seq bigint, us bigint, allowed boolean, remaining bigint, wait_us bigint"
    log = SlidingLog(limit, window_seconds * SECOND, order_seconds * SECOND)
    return _stateful(stream, key.cast("string"), ts, seq, log, fields, delay)


def webhook_outcomes(
    stream: DataFrame, secret: str, shops: Sequence[str], ttl_seconds: int = ev.TTL_SECONDS, delay: str = "10 minutes", order_seconds: int = 0
) -> DataFrame:
    """``seq, outcome, tags``: verified and allowed deliveries go through the duplicate memory, the
    rest keep their rejection. The plan travels with the row through the state operator, so no
    stream-stream join is needed."""
    checked = ev.webhook_checks(stream, secret, shops)
    accepted = checked.where(F.col("rejected").isNull())
    blank = F.coalesce("webhook_id", F.lit("")) == ""
    from cartloom.streaming.state import SeenDeliveries

    seen = SeenDeliveries(ttl_seconds * SECOND, order_seconds * SECOND, ("topic", "tags", "known"))
    shape = "seq bigint, us bigint, duplicate boolean, topic string, tags array<string>, known boolean"
    plan = {"topic": F.col("plan.topic"), "tags": F.col("plan.tags"), "known": F.col("plan.known")}
    remembered = _stateful(
        accepted.where(~blank), F.col("webhook_id"), "received_at", "seq", seen, shape, delay, plan
    ).withColumn("rejected", F.lit(None).cast("string"))

    def bypass(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("seq").cast("bigint"), F.unix_micros(F.col("received_at").cast("timestamp")).alias("us"), F.lit(False).alias("duplicate"),
            *[c.alias(n) for n, c in plan.items()], "rejected",
        )

    every = remembered.unionByName(bypass(checked.where(F.col("rejected").isNotNull() | blank)))
    outcome = ev.webhook_outcome(F.col("rejected"), F.col("duplicate"), F.col("known"))
    return every.select("seq", outcome.alias("outcome"), "topic", F.when(outcome == "revalidated", F.col("tags")).alias("tags"))


def contact_outcomes(
    stream: DataFrame, secret: str | None, limit: int = ev.LIMIT, window_seconds: int = ev.WINDOW_SECONDS, delay: str = "10 minutes", order_seconds: int = 0
) -> DataFrame:
    """``seq, outcome, answer``: honeypot, token, rate limit, validation, in that order."""
    from cartloom.streaming.state import SlidingLog

    now_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    values = forms.contact_values(F.struct(*[F.col(f) for f in forms.LIMITS]))
    checked = (
        stream.withColumn("_rejected", ev.pre_check(now_ms, secret))
        .withColumn("_key", forms.rate_limit_key(F.col("forwarded_for"), F.col("real_ip")))
        .withColumn("_invalid", F.size(forms.contact_errors(values)))
    )

    log = SlidingLog(limit, window_seconds * SECOND, order_seconds * SECOND, ("invalid",))
    fields = "seq bigint, us bigint, allowed boolean, remaining bigint, wait_us bigint, invalid int"
    limited = _stateful(
        checked.where(F.col("_rejected").isNull()), F.col("_key"), "ts", "id", log, fields, delay,
        {"invalid": F.col("_invalid")},
    ).select("seq", "allowed", "invalid", F.lit(None).cast("string").alias("rejected"))
    refused = checked.where(F.col("_rejected").isNotNull()).select(
        F.col("id").cast("bigint").alias("seq"), F.lit(True).alias("allowed"), F.col("_invalid").alias("invalid"), F.col("_rejected").alias("rejected")
    )
    outcome = (
        F.when(F.col("rejected").isNotNull(), F.col("rejected"))
        .when(~F.col("allowed"), "rate_limited")
        .when(F.col("invalid") > 0, "validation")
        .otherwise("accepted")
    )
    return limited.unionByName(refused).select("seq", outcome.alias("outcome"), ev.answered_as(outcome).alias("answer"))


def ecommerce_metrics(stream: DataFrame, fallback_currency: str, window: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Event count, value and quantity per window, event and currency. The window is this job's own;
    the events carry none."""
    rows = ev.commerce_events(stream, fallback_currency).withWatermark("ts", delay)
    return (
        rows.groupBy(F.window("ts", window), "name", "currency")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"), F.sum("quantity").alias("quantity"))
        .select(F.col("window.start").alias("start"), "name", "currency", "events", "value", "quantity")
    )


def ledger_writer(folder: str, writer: str | None = None, fanout: int = FANOUT) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: upsert a micro-batch of payload rows into the ledger store in ``folder``.

    What is written follows the batch (see :mod:`cartloom.operators.ledger_store`). A batch that Spark repeats after a restart
    is known by the query's id, which its checkpoint keeps, and its epoch, and changes nothing. A query without that
    checkpoint has a new id and goes on from the ledger as it is. ``writer`` names a caller that is not a stream.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        name = writer or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        last = batch.groupBy("resource", "key").agg(F.max_by(F.struct("payload", "checksum"), "seq").alias("l")).select("resource", "key", "l.*")
        apply_batch(folder, last, name, epoch, fanout)

    return write
