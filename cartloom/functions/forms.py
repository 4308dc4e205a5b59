"""Contact-form and webhook expressions, all JVM-side: HMAC is composed of built-in hashes."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.functions.options import string_array
from cartloom.functions.text import blank_to_null

# Fixed values.
LIMITS = {
    "first_name": 60,
    "last_name": 60,
    "email": 160,
    "phone": 32,
    "subject": 120,
    "message": 2000,
}
LABELS = {
    "first_name": "First name",
    "last_name": "Last name",
    "email": "Email address",
    "subject": "Subject",
    "message": "Message",
}
MESSAGE_MIN_LENGTH = 10
EMAIL = r"^[^\s@,;:<>()\[\]\\]+@[^\s@.,;:<>()\[\]\\]+(?:\.[^\s@.,;:<>()\[\]\\]+)+$"
PHONE = r"^[0-9+()\-. ]{6,}$"
CONTROL = r"[\x00-\x08\x0b-\x1f\x7f-\x9f]"
MIN_FORM_AGE_MS = 3_000
MAX_FORM_AGE_MS = 3_600_000
FUTURE_SKEW_MS = 5_000
PRODUCT_TOPICS = ["products/create", "products/update", "products/delete"]
COLLECTION_TOPICS = ["collections/create", "collections/update", "collections/delete"]
INVENTORY_TOPICS = ["inventory_levels/update", "inventory_items/update"]


def normalize_field(c: Column) -> Column:
    text = F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?", "\n")
    return F.regexp_replace(F.regexp_replace(text, CONTROL, ""), r"(?U)^\s+|\s+$", "")


def single_line(c: Column) -> Column:
    text = F.regexp_replace(normalize_field(c), r"\n+", " ")
    return F.trim(F.regexp_replace(text, r"(?U)\s{2,}", " "))


def contact_values(form: Column) -> Column:
    """Normalised fields of a submission struct."""
    return F.struct(
        *[
            (normalize_field if f == "message" else single_line)(form[f]).alias(f)
            for f in LIMITS
        ]
    )


def contact_errors(values: Column) -> Column:
    """``map<field, message>`` of the first problem of each field."""

    def too_long(field: str, label: str) -> Column:
        return F.when(
            F.length(values[field]) > LIMITS[field],
            F.lit(f"{label} must be {LIMITS[field]} characters or fewer."),
        )

    def required(field: str) -> Column:
        return F.when(values[field] == "", F.lit(f"{LABELS[field]} is required."))

    phone = values["phone"]
    digits = F.length(F.regexp_replace(phone, r"\D", ""))
    problems = {
        field: F.coalesce(required(field), too_long(field, LABELS[field]))
        for field in ("first_name", "last_name", "subject")
    }
    problems["email"] = F.coalesce(
        required("email"),
        too_long("email", "Email address"),
        F.when(~values["email"].rlike(EMAIL), F.lit("Enter a valid email address.")),
    )
    problems["phone"] = F.when(
        phone != "",
        F.coalesce(
            too_long("phone", "Phone number"),
            F.when(
                ~phone.rlike(PHONE) | (digits < 6),
                F.lit("Enter a valid phone number, or leave it blank."),
            ),
        ),
    )
    problems["message"] = F.coalesce(
        required("message"),
        F.when(
            F.length(values["message"]) < MESSAGE_MIN_LENGTH,
            F.lit(f"Message must be at least {MESSAGE_MIN_LENGTH} characters."),
        ),
        too_long("message", "Message"),
    )
    entries = F.create_map(*[x for f, p in problems.items() for x in (F.lit(f), p)])
    return F.map_filter(entries, lambda _, message: message.isNotNull())


def honeypot_filled(c: Column) -> Column:
    return normalize_field(c) != ""


_BLOCK = 64  # SHA-256 block size


def hmac_sha256(body: Column, secret: str) -> Column:
    """HMAC digest bytes, composed of two built-in SHA-256 calls (RFC 2104), so it stays in codegen."""
    key = secret.encode()
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")

    def digest(pad: int, message: Column) -> Column:
        block = F.lit(bytearray(k ^ pad for k in key))
        return F.unhex(F.sha2(F.concat(block, message.cast("binary")), 256))

    return digest(0x5C, digest(0x36, body))


def form_signature(stamp: Column, secret: str) -> Column:
    """Unpadded URL-safe base64 of the stamp's HMAC."""
    return F.rtrim(F.translate(F.base64(hmac_sha256(stamp, secret)), "+/=", "-_ "))


def verify_form_token(
    token: Column,
    now_ms: Column,
    secret: str | None,
    min_age_ms: int = MIN_FORM_AGE_MS,
    max_age_ms: int = MAX_FORM_AGE_MS,
) -> Column:
    """``ok`` or why not: missing, malformed, signature, too_fast, expired."""
    text = F.trim(F.coalesce(token, F.lit("")))
    stamp = F.regexp_extract(text, r"(?s)^([^.]*)", 1)
    signature = F.regexp_extract(text, r"(?s)^[^.]*\.(.*)$", 1)
    issued = stamp.try_cast("bigint")
    age = now_ms - issued
    verdict = F.when(text == "", "missing").when(~stamp.rlike(r"^\d{1,15}$"), "malformed")
    if secret:
        # the signature covers the number, so leading zeros do not count
        signed = signature == form_signature(issued.cast("string"), secret)
        verdict = verdict.when(signature == "", "malformed").when(~signed, "signature")
    return (
        verdict.when(age < -FUTURE_SKEW_MS, "malformed")
        .when(age < min_age_ms, "too_fast")
        .when(age > max_age_ms, "expired")
        .otherwise("ok")
    )


def verify_hmac(body: Column, header: Column, secret: str) -> Column:
    """True when ``header`` is the base64 SHA-256 HMAC of the raw ``body`` bytes; padding and the
    URL-safe alphabet do not matter."""
    if not secret:
        return F.lit(False)

    def plain(c: Column) -> Column:
        return F.rtrim(F.translate(F.trim(c), "-_=", "+/ "))

    filled = F.coalesce(body.cast("binary"), F.lit(bytearray()))
    return F.coalesce(plain(header) == plain(F.base64(hmac_sha256(filled, secret))), F.lit(False))


def topic_tags(topic: Column, payload: Column, prefix: str = "shop") -> Column:
    """``struct<topic, tags, handle, known>``: which cache tags a delivery drops.

    ``payload`` is JSON text; text that does not parse carries no handle.
    """
    name = F.lower(F.trim(F.coalesce(topic, F.lit(""))))
    # a non-string handle (number, object) is no handle
    raw = F.try_parse_json(payload)
    typed = F.when(
        F.schema_of_variant(F.try_variant_get(raw, "$.handle", "variant")) == "STRING",
        F.try_variant_get(raw, "$.handle", "string"),
    )
    handle = F.trim(typed)
    handle = F.when((F.length(handle) > 0) & (F.length(handle) <= 200), handle)

    def tags(coarse: str, fine: str) -> Column:
        one = F.concat(F.lit(f"{prefix}:{fine}:"), handle)
        return F.array_compact(F.array(F.lit(f"{prefix}:{coarse}"), one))

    product, collection = name.isin(*PRODUCT_TOPICS), name.isin(*COLLECTION_TOPICS)
    inventory = name.isin(*INVENTORY_TOPICS)
    return F.struct(
        name.alias("topic"),
        F.when(product, tags("products", "product"))
        .when(collection, tags("collections", "collection"))
        .when(inventory, string_array([f"{prefix}:inventory", f"{prefix}:products"]))
        .otherwise(string_array([]))
        .alias("tags"),
        F.when(~inventory, handle).alias("handle"),
        (product | collection | inventory).alias("known"),
    )


def rate_limit_key(forwarded: Column, real_ip: Column) -> Column:
    """First forwarded address, else the real one, else ``unknown``; at most 64 characters."""
    first = blank_to_null(F.trim(F.get(F.split(F.coalesce(forwarded, F.lit("")), ","), F.lit(0))))
    real = blank_to_null(F.trim(F.coalesce(real_ip, F.lit(""))))
    return F.coalesce(F.substring(first, 1, 64), F.substring(real, 1, 64), F.lit("unknown"))
