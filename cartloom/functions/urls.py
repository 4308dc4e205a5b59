"""URL expressions. Parts come from one RFC 3986 pattern, so a malformed URL yields empty parts
instead of failing the job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.functions.text import blank_to_null

_PARTS = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_SCHEME, _AUTHORITY, _PATH, _QUERY, _FRAGMENT = 1, 2, 3, 4, 5

# Fixed values.
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term",
    "utm_content", "utm_id", "gclid", "fbclid",
]
ACTION_PARAMS = [
    "add_to_wishlist", "quick_view_button", "add-to-cart", "remove_item", "removed_item",
    "undo_item", "wc-ajax", "filtering", "filter_", "orderby", "product-page",
    "really_curr_tax", "min_price", "max_price",
]
ASSET_SUFFIX = r"\.(png|jpe?g|gif|webp|svg|pdf|css|js|ico)$"
ADMIN_PREFIX = r"^/wp-(json|admin)"
UPLOADS_PATH = "/wp-content/uploads/"
RESIZED_NAME = r"^(.+?)-\d{2,5}x\d{2,5}(\.[A-Za-z0-9]{1,5})$"
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "gif", "webp", "heic", "avif", "bmp", "svg"]


def part(url: Column, n: int) -> Column:
    return F.regexp_extract(url, _PARTS, n)


def percent_decode(c: Column) -> Column:
    """Percent-decoding that leaves ``+`` and malformed text as they are."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(c, r"\+", "%2B")), c)


def form_decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def url_host(c: Column) -> Column:
    """Bare lower-case host: no user, port or leading ``www.``."""
    text = F.trim(F.coalesce(c, F.lit("")))
    full = F.when((text == "") | text.contains("//"), text).otherwise(F.concat(F.lit("//"), text))
    host = F.regexp_replace(F.regexp_replace(part(full, _AUTHORITY), r"^.*@", ""), r":\d*$", "")
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def absolutise(c: Column, origin: Column | str) -> Column:
    """Protocol- and root-relative URLs to https."""
    base = F.lit(origin) if isinstance(origin, str) else origin
    url = F.trim(F.coalesce(c, F.lit("")))
    return (
        F.when(url.startswith("//"), F.concat(F.lit("https:"), url))
        .when(url.startswith("/") & (base != ""), F.concat(F.lit("https://"), base, url))
        .otherwise(url)
    )


def url_canon(c: Column) -> Column:
    """``struct<host, path>`` that every spelling of one file shares."""
    return F.struct(url_host(c).alias("host"), percent_decode(part(c, _PATH)).alias("path"))


def canon_key(c: Column) -> Column:
    """:func:`url_canon` as one join key."""
    return F.concat(url_host(c), F.lit(" "), percent_decode(part(c, _PATH)))


def is_upload(c: Column, hosts: Sequence[str]) -> Column:
    return url_host(c).isin(*hosts) & percent_decode(part(c, _PATH)).contains(UPLOADS_PATH)


def url_filename(c: Column) -> Column:
    name = percent_decode(F.regexp_extract(part(c, _PATH), r"([^/]*)$", 1))
    return F.coalesce(blank_to_null(name), F.lit("file"))


def content_type(c: Column, mime: Column) -> Column:
    given = F.coalesce(mime, F.lit(""))
    extension = F.lower(F.regexp_extract(url_filename(c), r"([^.]*)$", 1))
    return (
        F.when(F.lower(given).startswith("image/"), "IMAGE")
        .when(given != "", "FILE")
        .when(extension.isin(*IMAGE_EXTENSIONS), "IMAGE")
        .otherwise("FILE")
    )


def original_of(c: Column) -> Column:
    """URL of the file a ``-WxH`` thumbnail was made from, null for anything else."""
    pattern = r"^([^?#]*/)?([^/?#]+?)-\d{2,5}x\d{2,5}(\.[A-Za-z0-9]{1,5})((?:[?#].*)?)$"
    return F.when(
        c.rlike(pattern),
        F.concat(*[F.regexp_extract(c, pattern, i) for i in (1, 2, 3, 4)]),
    )


def _pairs(query: Column) -> Column:
    """Decoded ``array<struct<k, v>>`` of a query string."""
    raw = F.filter(F.split(query, "&"), lambda p: p != "")
    return F.transform(
        raw,
        lambda p: F.struct(
            form_decode(F.regexp_extract(p, r"(?s)^([^=]*)", 1)).alias("k"),
            form_decode(F.regexp_extract(p, r"(?s)^[^=]*=?(.*)$", 1)).alias("v"),
        ),
    )


def normalize_url(
    c: Column,
    hosts: Sequence[str] | None = None,
    tracking: Sequence[str] = tuple(TRACKING_PARAMS),
    actions: Sequence[str] = tuple(ACTION_PARAMS),
) -> Column:
    """Comparable path (plus structural query) of a legacy URL, null when it names no page.

    Dropped: mail, phone, script and fragment links, hosts outside ``hosts`` (``None`` takes any),
    assets, admin paths, and URLs whose remaining parameters are all on-page actions. ``&amp;`` is
    the one entity that occurs in links.
    """
    url = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "&amp;", "&")
    authority = F.lower(part(url, _AUTHORITY))
    foreign = F.lit(False) if hosts is None else (authority != "") & ~authority.isin(*hosts)
    decoded = F.regexp_replace(F.lower(percent_decode(part(url, _PATH))), "/{2,}", "/")
    stripped = F.regexp_replace(decoded, "/+$", "")
    path = F.when(stripped.startswith("/"), stripped).otherwise(F.concat(F.lit("/"), stripped))
    kept = F.filter(_pairs(part(url, _QUERY)), lambda p: ~F.lower(p["k"]).isin(*tracking))
    only_actions = (F.size(kept) > 0) & F.forall(kept, lambda p: F.lower(p["k"]).isin(*actions))
    query = F.array_join(
        F.transform(F.array_sort(kept), lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&"
    )
    dropped = (
        (url == "")
        | url.rlike("^(mailto:|tel:|#|javascript:)")
        | foreign
        | path.rlike(ADMIN_PREFIX)
        | path.rlike(ASSET_SUFFIX)
        | only_actions
    )
    return F.when(~dropped, F.when(F.size(kept) > 0, F.concat(path, F.lit("?"), query)).otherwise(path))


def canonical_path(c: Column) -> Column:
    path = F.regexp_replace(F.regexp_replace(c, "/{2,}", "/"), "/+$", "")
    return F.when(path == "", "/").otherwise(path)


def lookup_keys(path: Column) -> Column:
    """Literal path first, then its decoded lower-case form."""
    return F.array_distinct(F.array(path, F.lower(percent_decode(path))))


PAGE_ASSET = r"(?i)\.(js|css|woff2?|ico|png|jpe?g|svg|webp|avif|gif|xml|txt|json|map)$"


def same_host_link(href: Column, base: Column) -> Column:
    """Absolute http(s) link on the page's own host without its fragment, null for any other link.

    Relative links resolve against the page's folder; ``..`` segments are kept as written.
    """
    link = F.trim(F.regexp_replace(href, "&amp;", "&"))
    site = F.concat(part(base, _SCHEME), F.lit("://"), part(base, _AUTHORITY))
    here = part(base, _PATH)
    folder = F.regexp_replace(here, r"[^/]*$", "")
    full = (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(part(base, _SCHEME), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(site, here, link))
        .when((link == "") | link.startswith("#"), base)
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )
    bare = F.regexp_replace(full, "#.*$", "")
    path = part(bare, _PATH)
    keep = (
        bare.rlike("(?i)^https?://")
        & (F.lower(part(bare, _AUTHORITY)) == F.lower(part(base, _AUTHORITY)))
        & ~path.rlike("^/(_next|api)/")
        & ~path.rlike(PAGE_ASSET)
    )
    return F.when(keep, F.when(path == "", F.concat(bare, F.lit("/"))).otherwise(bare))


def attribute_values(html: Column, tag: str, attr: str) -> Column:
    """Every quoted ``attr`` value of ``tag`` elements, in document order."""
    pattern = rf"(?i)<{tag}\b[^>]*?\b{attr}\s*=\s*(\"[^\"]*\"|'[^']*')"
    quoted = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    return F.transform(quoted, lambda v: F.substring(v, F.lit(2), F.length(v) - 2))


def proxied_image(c: Column) -> Column:
    """Address behind an image-proxy URL (``?url=...``), else the URL itself."""
    inner = F.regexp_extract(c, r"[?&]url=([^&]+)", 1)
    proxied = (part(c, _PATH) == "/_next/image") & (inner != "")
    return F.when(proxied, percent_decode(inner)).otherwise(c)


def deployment_url(base: str, path: Column) -> Column:
    """Absolute URL with one slash between site and path."""
    clean = F.regexp_replace(F.coalesce(path, F.lit("")), "^/+|/+$", "")
    return F.when(clean == "", F.lit(base.rstrip("/"))).otherwise(
        F.concat(F.lit(base.rstrip("/") + "/"), clean)
    )


def page_view_path(path: Column, search: Column) -> Column:
    filled = F.coalesce(path, F.lit(""))
    rooted = F.when(filled.startswith("/"), filled).otherwise(F.concat(F.lit("/"), filled))
    query = F.regexp_replace(F.coalesce(search, F.lit("")), r"^\?", "")
    return F.when(query == "", rooted).otherwise(F.concat(rooted, F.lit("?"), query))
