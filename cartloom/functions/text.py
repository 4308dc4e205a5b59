"""Text and nested-value expressions."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_EDGES = r"(?U)^\s+|\s+$"
#: Found in every text that white space at its edges or a line break could change; most texts have neither.
_RAGGED = r"\A[^\x21-\x7E]|[^\x21-\x7E]\z|[\r\n]"


def _plain(texts: pa.Array) -> bool:
    """No text of the batch holds an entity: it goes back as it came."""
    return not pc.any(pc.match_substring(texts, "&")).as_py()


@F.arrow_udf(StringType())
def _unescape(values: pa.Array) -> pa.Array:
    if _plain(values):
        return values
    return pa.array([v if v is None else html.unescape(v) for v in values.to_pylist()], pa.string())


def _decompose(value: str) -> str:
    return unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode("ascii")


@F.pandas_udf(StringType())
def _ascii(values: pd.Series) -> pd.Series:
    return values.map(_decompose, na_action="ignore")


@F.arrow_udf(ArrayType(StringType()))
def _unescape_all(values: pa.Array) -> pa.Array:
    if _plain(values.flatten()):
        return values
    clean = [vs if vs is None else [v if v is None else html.unescape(v) for v in vs] for vs in values.to_pylist()]
    return pa.array(clean, pa.list_(pa.string()))


def clean_texts(c: Column) -> Column:
    """:func:`clean_text` of every element; null array to empty."""
    filled = F.coalesce(c, F.array().cast("array<string>"))
    return F.transform(_unescape_all(filled), lambda v: _where_ragged(F.coalesce(v, F.lit("")), strip))


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(c, _EDGES, "")


def clean_text(c: Column, entities: bool = True) -> Column:
    """Null to ``""``, HTML entities decoded, trimmed.

    ``entities=False`` keeps the expression inside codegen for columns that hold none.
    """
    filled = F.coalesce(c, F.lit(""))
    return strip(_unescape(filled) if entities else filled)


def rendered(c: Column) -> Column:
    """Text of a ``struct<rendered, raw>`` field: first non-empty of the two."""
    pick = F.coalesce(blank_to_null(c["rendered"]), blank_to_null(c["raw"]))
    return clean_text(pick)


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def one_line_text(c: Column, entities: bool = True) -> Column:
    """:func:`clean_text` on one line."""
    filled = F.coalesce(c, F.lit(""))
    return _on_one_line(clean_text(filled)) if entities else _where_ragged(filled, lambda t: _on_one_line(strip(t)))


def _on_one_line(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s*[\r\n]+\s*", " "))


def _where_ragged(c: Column, change: Callable[[Column], Column]) -> Column:
    """One search instead of the replacements where a text has nothing to replace."""
    return F.when(c.rlike(_RAGGED), change(c)).otherwise(c)


def slugify(c: Column, empty: str = "untitled", fold_accents: bool = True) -> Column:
    """Lower-case ASCII words joined by ``-``. ``fold_accents=False`` suits ASCII-only columns."""
    base = _ascii(clean_text(c)) if fold_accents else clean_text(c, entities=False)
    words = F.lower(F.regexp_replace(base, "[^a-zA-Z0-9]+", "-"))
    slug = F.regexp_replace(words, "^-+|-+$", "")
    return F.coalesce(blank_to_null(slug), F.lit(empty))


def storefront_slug(c: Column) -> Column:
    """Listing-side slug: ``&`` reads ``and``, no accent folding, may be empty."""
    text = F.regexp_replace(F.lower(c), "&", "and")
    return F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def title_words(c: Column) -> Column:
    """Capital after every non-letter (``initcap`` only looks at blanks)."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(?U)(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def stamp_tz(c: Column, offset: str = "+00:00") -> Column:
    """Give a naive ISO time an explicit offset; leave one that has it."""
    text = F.trim(F.coalesce(c, F.lit("")))
    return (
        F.when(text == "", "")
        .when(text.rlike(r"Z$|[+-]\d{2}:\d{2}$"), text)
        .otherwise(F.concat(text, F.lit(offset)))
    )


def neutralise(c: Column) -> Column:
    """Cell that a spreadsheet will not evaluate; plain numbers stay numbers."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    formula = ~text.rlike(r"^-?\d+(\.\d+)?$") & text.rlike("^[=+\\-@\t\r]")
    return F.when(formula, F.concat(F.lit("'"), text)).otherwise(text)


def meta_value(meta: Column, key: str) -> Column:
    """Value of the first entry with ``key``."""
    return F.get(F.filter(meta, lambda e: e["key"] == key), F.lit(0))["value"]


def meta_pairs(meta: Column) -> Column:
    """Visible ``key: value`` pairs in source order.

    Display fields win; keys starting with ``_`` and object or list values are left out.
    """

    def label(e: Column) -> Column:
        return F.coalesce(blank_to_null(e["display_key"]), e["key"], F.lit(""))

    def shown(e: Column) -> Column:
        return F.coalesce(e["display_value"], e["value"])

    def visible(e: Column) -> Column:
        nested = F.coalesce(shown(e), F.lit("")).rlike(r"^\s*[\[{]")
        return (label(e) != "") & ~label(e).startswith("_") & ~nested

    def flat(c: Column) -> Column:
        return _where_ragged(F.coalesce(c, F.lit("")), _on_one_line)

    kept = F.filter(F.coalesce(meta, F.array().cast(_META)), visible)
    return F.transform(kept, lambda e: F.concat(flat(label(e)), F.lit(": "), flat(shown(e))))


_META = "array<struct<id:bigint,key:string,value:string,display_key:string,display_value:string>>"


def record_checksum(*cols: Column | str) -> Column:
    """SHA-256 of canonical JSON: keys in name order, nulls kept, no blanks.

    Pass column names; nested structs must already carry their fields in name order.
    """
    names = sorted(c for c in cols if isinstance(c, str))
    body = F.struct(*[F.col(f"`{n}`") for n in names], *[c for c in cols if not isinstance(c, str)])
    return json_checksum(body)


def json_checksum(body: Column) -> Column:
    return F.sha2(F.to_json(body, {"ignoreNullFields": "false"}), 256)


def file_stem(url: Column) -> Column:
    """Letters and digits of the decoded file name without its extension, lower case."""
    name = F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"([^/]*)$", 1)
    decoded = F.coalesce(F.try_url_decode(F.regexp_replace(name, r"\+", "%2B")), name)
    return F.lower(F.regexp_replace(F.regexp_replace(decoded, r"\.[^.]*$", ""), "[^A-Za-z0-9]", ""))


def generate_sku(product_id: Column, variant_id: Column, prefix: str = "SKU") -> Column:
    return F.concat_ws("-", F.lit(prefix), product_id.cast("string"), variant_id.cast("string"))
