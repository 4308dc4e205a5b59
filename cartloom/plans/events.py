"""Event queries: runs, page views, deliveries, limits, metrics, form and webhook outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions.forms import contact_errors, contact_values, form_signature, hmac_sha256
from cartloom.functions.money import cents
from cartloom.operators import audit
from cartloom.operators import events as ev
from cartloom.plans.registry import query, table


@query(
    "median_run",
    """
    SELECT event_type, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS n, count(*) OVER (PARTITION BY event_type) AS total FROM events)
    WHERE n = (total - 1) // 2 + 1
    """,
)
def median_run(spark: SparkSession, folder: str) -> DataFrame:
    """Lower-middle event of each type by value."""
    return audit.median_run(table(spark, folder, "events"), ["event_type"], "value", "event_id").select("event_type", "event_id", "value")


@query(
    "page_view_dedupe",
    """
    SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events) WHERE prev IS DISTINCT FROM event_type
    """,
)
def page_view_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a user that differ in type from the one before."""
    views = ev.page_view_dedupe(table(spark, folder, "events"), "user_id", "ts", "event_id", F.col("event_type"))
    return views.select("event_id", "user_id", "event_type")


@query(
    "dedupe_deliveries",
    """
    WITH d AS (SELECT event_id, ts, CASE WHEN event_type = 'error' THEN '' ELSE json_extract_string(props, '$.k') END AS id FROM events)
    SELECT event_id, id <> '' AND coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY id ORDER BY ts, event_id) < 3600000000, false) AS duplicate FROM d
    """,
)
def dedupe_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """The property ``k`` as delivery id, an hour as memory; errors carry none."""
    id_ = F.when(F.col("event_type") == "error", "").otherwise(F.get_json_object("props", "$.k"))
    deliveries = table(spark, folder, "events").select("event_id", "ts", id_.alias("id"))
    return ev.dedupe_deliveries(deliveries, "id", "ts", "event_id", 3600).select("event_id", "duplicate")


def sliding_log(source: str, limit: int, window_us: int) -> str:
    """Recursive SQL over ``source`` (k, event_id, us, n): one hit of every key a step, with its accepted times."""
    return f"""
    w AS (
      SELECT k, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS event_id, CAST([] AS BIGINT[]) AS kept, false AS allowed, CAST(0 AS BIGINT) AS wait
      FROM (SELECT DISTINCT k FROM {source})
      UNION ALL
      SELECT k, n, event_id, CASE WHEN len(live) < {limit} THEN list_append(live, us) ELSE live END, len(live) < {limit},
        CASE WHEN len(live) < {limit} THEN 0 ELSE live[1] + {window_us} - us END
      FROM (SELECT h.k, h.n, h.event_id, h.us, list_filter(w.kept, lambda x: x > h.us - {window_us}) AS live
        FROM w JOIN {source} AS h ON h.k = w.k AND h.n = w.n + 1))"""


@query(
    "rate_limit",
    f"""
    WITH RECURSIVE h AS (SELECT event_type AS k, event_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events),
    {sliding_log("h", 5, 86_400_000_000)}
    SELECT k AS key, event_id AS id, allowed, CASE WHEN allowed THEN 5 - len(kept) ELSE 0 END AS remaining, CAST(ceil(wait / 1000) AS BIGINT) AS retry_after_ms
    FROM w WHERE n > 0
    """,
)
def rate_limit(spark: SparkSession, folder: str) -> DataFrame:
    """Five events per type and day."""
    return ev.rate_limit(table(spark, folder, "events"), "event_type", "ts", "event_id", 5, 86_400)


SECRET = "form-secret"


@query(
    "contact_outcomes",
    f"""
    WITH RECURSIVE f AS (SELECT event_id, epoch_us(ts) AS us, event_type, event_id % 11 AS kind,
        CASE WHEN event_id % 2 = 0 THEN 'a' || user_id % 40 WHEN event_id % 3 = 0 THEN 'b' || user_id % 5 ELSE 'unknown' END AS k FROM events),
    r AS (SELECT *, CASE WHEN event_type = 'error' THEN 'honeypot' WHEN kind = 0 THEN 'token_missing' WHEN kind IN (1, 2) THEN 'token_malformed'
        WHEN kind = 3 THEN 'token_signature' WHEN kind = 4 THEN 'token_too_fast' WHEN kind = 5 THEN 'token_expired' END AS rejected FROM f),
    h AS (SELECT k, event_id, us, row_number() OVER (PARTITION BY k ORDER BY us, event_id) AS n FROM r WHERE rejected IS NULL),
    {sliding_log("h", 5, 43_200_000_000)},
    o AS (SELECT r.event_id AS id, coalesce(w.wait, 0) AS wait, CASE WHEN rejected IS NOT NULL THEN rejected WHEN NOT w.allowed THEN 'rate_limited'
        WHEN event_type = 'click' OR r.event_id % 13 = 0 THEN 'validation' ELSE 'accepted' END AS outcome,
        CASE WHEN event_type = 'click' THEN 1 ELSE 0 END + CASE WHEN r.event_id % 13 = 0 THEN 2 ELSE 0 END AS bad
      FROM r LEFT JOIN w ON w.event_id = r.event_id)
    SELECT id, outcome, CASE WHEN outcome IN ('accepted', 'honeypot') OR (outcome LIKE 'token_%' AND outcome <> 'token_expired') THEN 'success' ELSE 'error' END AS answer,
      CASE WHEN outcome = 'validation' THEN bad END AS field_errors, CAST(ceil(wait / 1000) AS BIGINT) AS retry_after_ms FROM o
    """,
)
def contact_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as form submissions: full fields, every kind of bad token, honeypots, two kinds of sender address."""
    now, kind = F.unix_millis(F.col("ts").cast("timestamp")), F.col("event_id") % 11
    signed = lambda age: F.concat_ws(".", (now - age).cast("string"), form_signature((now - age).cast("string"), SECRET))
    token = (
        F.when(kind == 0, " ").when(kind == 1, "later.x").when(kind == 2, (now - 9_000).cast("string"))
        .when(kind == 3, F.concat((now - 9_000).cast("string"), F.lit(".forged"))).when(kind == 4, signed(2_999)).when(kind == 5, signed(3_600_001))
        .when(kind == 6, signed(3_000)).otherwise(signed(3_600_000))
    )
    wrong = F.col("event_id") % 13 == 0
    submissions = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), "ts", token.alias("token"), F.when(F.col("event_type") == "error", "x").otherwise(" ").alias("website"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" a"), F.col("user_id") % 40, F.lit(" , proxy"))).alias("forwarded_for"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("b"), F.col("user_id") % 5)).alias("real_ip"),
        F.lit("Ada").alias("first_name"), F.lit("L").alias("last_name"), F.lit("Order").alias("subject"),
        F.when(wrong, "nobody").otherwise("a@b.co").alias("email"), F.when(wrong, "12").otherwise("").alias("phone"),
        F.when(F.col("event_type") == "click", "short").otherwise("long enough a message").alias("message"),
    )
    found = ev.contact_outcomes(submissions, SECRET, 5, 43_200)
    return found.select("id", "outcome", "answer", F.size("errors").alias("field_errors"), "retry_after_ms")


@query(
    "event_metrics",
    """
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS start, event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value,
      CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS quantity FROM events GROUP BY 1, 2
    """,
)
def event_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").withColumn("start", F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH"))
    metrics = ev.event_metrics(
        rows, ["start", "event_type"], cents(F.col("value")), F.get_json_object("props", "$.k").cast("bigint")
    )
    return metrics.withColumn("value", F.col("value").cast("double"))


@query(
    "commerce_events",
    """
    WITH e AS (SELECT CASE event_type WHEN 'view' THEN 'view_item' WHEN 'click' THEN 'add_to_cart' ELSE 'begin_checkout' END AS name, CAST(value AS DECIMAL(18,2)) AS price,
      CAST(json_extract_string(props, '$.k') AS INT) % 3 + 1 AS quantity FROM events WHERE event_type IN ('view', 'click', 'purchase'))
    SELECT name, 'AUD' AS currency, count(*) AS events, CAST(sum(price * quantity) AS DOUBLE) AS value, CAST(sum(quantity) AS BIGINT) AS quantity FROM e GROUP BY 1
    """,
)
def commerce_events(spark: SparkSession, folder: str) -> DataFrame:
    """Item events built from views, clicks and purchases; other types are not commerce."""
    kind = F.create_map(*[F.lit(x) for x in ("view", "view_item", "click", "add_to_cart", "purchase", "begin_checkout")])
    quantity = (F.get_json_object("props", "$.k").cast("int") % 3 + 1).cast("int")
    item = F.struct(cents(F.col("value")).alias("price"), quantity.alias("quantity"), F.lit("AUD").alias("currency"))
    raw = table(spark, folder, "events").select(
        F.coalesce(F.try_element_at(kind, F.col("event_type")), F.col("event_type")).alias("name"), "ts", F.array(item).alias("items"),
        F.lit("").alias("coupon"), F.lit(None).cast("decimal(18,2)").alias("costed"),
    )
    metrics = ev.event_metrics(ev.commerce_events(raw, "AUD"), ["name", "currency"], F.col("value"), F.col("quantity"))
    return metrics.withColumn("value", F.col("value").cast("double"))


@query(
    "contact_validation",
    """
    SELECT doc_id, CASE WHEN length(m) = 0 THEN 'required' WHEN length(m) < 10 THEN 'short' WHEN length(m) > 2000 THEN 'long' ELSE 'ok' END AS message FROM (
      SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '[\\x00-\\x08\\x0b-\\x1f\\x7f]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS m FROM documents)
    """,
)
def contact_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents checked as form messages."""
    blank = F.lit("x")
    form = F.struct(
        *[blank.alias(f) for f in ("first_name", "last_name", "subject")], F.lit("a@b.co").alias("email"), F.lit("").alias("phone"), F.col("text").alias("message")
    )
    problem = F.try_element_at(contact_errors(contact_values(form)), F.lit("message"))
    verdict = (
        F.when(problem.contains("required"), "required").when(problem.contains("at least"), "short").when(problem.contains("or fewer"), "long").otherwise("ok")
    )
    return table(spark, folder, "documents").select("doc_id", verdict.alias("message"))


TOPICS = ("view", "products/update", "click", "collections/update", "purchase", "inventory_levels/update")


@query(
    "webhook_outcomes",
    """
    WITH d AS (SELECT event_id, ts, event_type, json_extract_string(props, '$.k') AS id, CASE WHEN value < 1 THEN '401' WHEN value > 30 THEN '403' END AS rejected FROM events),
    s AS (SELECT event_id, event_type, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY id ORDER BY ts, event_id) < 3600000000 AS seen FROM d WHERE rejected IS NULL)
    SELECT event_id AS seq, rejected AS outcome FROM d WHERE rejected IS NOT NULL
    UNION ALL SELECT event_id, CASE WHEN seen THEN 'duplicate' WHEN event_type IN ('view', 'click', 'purchase') THEN 'revalidated' ELSE 'ignored' END FROM s
    """,
)
def webhook_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as signed deliveries: forged signatures, foreign shops, repeats, unknown topics."""
    topics = F.create_map(*[F.lit(x) for x in TOPICS])
    body = F.col("props").cast("binary")
    signed = F.base64(hmac_sha256(body, "secret"))
    deliveries = table(spark, folder, "events").select(
        F.col("event_id").alias("seq"), F.col("ts").alias("received_at"), F.coalesce(F.try_element_at(topics, F.col("event_type")), F.col("event_type")).alias("topic"),
        F.get_json_object("props", "$.k").alias("webhook_id"), F.when(F.col("value") > 30, "other.example").otherwise("shop.example").alias("shop"),
        F.when(F.col("value") < 1, F.reverse(signed)).otherwise(signed).alias("hmac"), body.alias("body"),
    )
    return ev.webhook_outcomes(deliveries, "secret", ["shop.example"], 3600).select("seq", "outcome")
