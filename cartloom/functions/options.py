"""Catalog normalisation: option values, product type, surface, clubs, gender, tags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.functions.text import blank_to_null, slugify, strip, title_words
from cartloom.rules import shop

NUMERIC_SIZE = r"^\d+(\s*-\s*\d+)?$"


_ENTRY, _PAIR = "\x01", "\x02"


def lookup(table: Mapping[str, str], key: Column) -> Column:
    """Value of a small fixed mapping, null when absent.

    The mapping is one foldable text literal, which the optimizer turns into a map once; a tree of
    literals would be analysed again with every later step.
    """
    text = _ENTRY.join(f"{k}{_PAIR}{v}" for k, v in table.items())
    return F.try_element_at(F.str_to_map(F.lit(text), F.lit(_ENTRY), F.lit(_PAIR)), key)


def string_array(values: Sequence[str]) -> Column:
    if not values:
        return F.array().cast("array<string>")
    return F.split(F.lit(_ENTRY.join(values)), _ENTRY)


def normalize_colour(c: Column, synonyms: Mapping[str, str] = shop.COLOUR_SYNONYMS) -> Column:
    """Each half of a ``/`` pair through the synonym table, else title case."""

    def one(part: Column) -> Column:
        word = strip(part)
        return F.coalesce(lookup(synonyms, F.lower(word)), title_words(word))

    halves = F.transform(F.split(c, "/"), one)
    return F.array_join(F.filter(halves, lambda h: h != ""), " / ")


def is_numeric_size(c: Column) -> Column:
    return strip(c).rlike(NUMERIC_SIZE)


def normalize_size(c: Column, synonyms: Mapping[str, str] = shop.SIZE_SYNONYMS) -> Column:
    text = strip(c)
    upper = F.upper(text)
    return (
        F.when(text == "", text)
        .when(text.rlike(NUMERIC_SIZE), F.regexp_replace(text, r"\s*-\s*", "-"))
        .otherwise(F.coalesce(lookup(synonyms, upper), F.when(F.length(upper) <= 4, upper), text))
    )


def normalize_gender(c: Column, synonyms: Mapping[str, str] = shop.GENDER_SYNONYMS) -> Column:
    text = strip(c)
    return F.coalesce(lookup(synonyms, F.lower(text)), title_words(text))


def normalize_option_value(name: Column, value: Column) -> Column:
    return (
        F.when(name == "Colour", normalize_colour(value))
        .when(name.isin("Size", "Sock Size"), normalize_size(value))
        .when(name == "Gender", normalize_gender(value))
        .otherwise(strip(value))
    )


def size_option_name(values: Column) -> Column:
    """``Sock Size`` when every value is numeric, ``Size`` when none is, null when mixed."""
    filled = F.filter(values, lambda v: strip(v) != "")
    return (
        F.when(F.size(filled) == 0, "Size")
        .when(F.forall(filled, is_numeric_size), "Sock Size")
        .when(~F.exists(filled, is_numeric_size), "Size")
    )


def option_rank(name: Column, value: Column, size_order: Sequence[str] = shop.SIZE_ORDER) -> Column:
    """Sort key of one option value: wearing order, leading number, or 0 (alphabetical)."""
    worn = F.array_position(string_array(size_order), value)
    lead = F.regexp_extract(value, r"^(\d+)", 1).try_cast("int")
    return (
        F.when(name == "Size", F.when(worn > 0, worn - 1).otherwise(F.lit(99)))
        .when(name == "Sock Size", F.coalesce(lead, F.lit(0)))
        .otherwise(F.lit(0))
        .cast("int")
    )


def sort_option_values(name: Column, values: Column) -> Column:
    ranked = F.transform(
        F.array_distinct(values), lambda v: F.struct(option_rank(name, v).alias("rank"), v.alias("value"))
    )
    return F.transform(F.array_sort(ranked), lambda s: s["value"])


def lowered(categories: Column) -> Column:
    return F.transform(categories, lambda c: F.lower(strip(c)))


def product_type(
    categories: Column,
    name: Column,
    category_types: Mapping[str, str] = shop.CATEGORY_TYPES,
    priority: Sequence[str] = tuple(shop.TYPE_PRIORITY),
    name_types: Sequence[tuple[str, str]] = tuple(shop.NAME_TYPES),
    fallback: str = shop.FALLBACK_TYPE,
) -> Column:
    """``struct<type, how>``: best mapped category, else first keyword in the name, else fallback."""
    mapped = F.transform(lowered(categories), lambda c: lookup(category_types, c))
    by_category = F.coalesce(
        *[F.when(F.array_contains(F.array_compact(mapped), t), F.lit(t)) for t in priority]
    )
    text = F.lower(strip(name))
    by_name = F.coalesce(*[F.when(text.contains(word), F.lit(t)) for word, t in name_types])
    return F.struct(
        F.coalesce(by_category, by_name, F.lit(fallback)).alias("type"),
        F.when(by_category.isNotNull(), "category")
        .when(by_name.isNotNull(), "name-inferred")
        .otherwise("fallback")
        .alias("how"),
    )


def surface(categories: Column, name: Column) -> Column:
    low = lowered(categories)
    beach = F.arrays_overlap(low, string_array(shop.BEACH_CATEGORIES))
    return F.when(beach | F.lower(name).contains("beach"), "beach").when(
        F.arrays_overlap(low, string_array(shop.INDOOR_CATEGORIES)), "indoor"
    )


def clubs(
    categories: Column,
    name: Column,
    rules: Sequence[tuple[str, str, str, str]] = tuple(shop.CLUBS),
    teamwear: tuple[str, str, str] = shop.TEAMWEAR,
) -> Column:
    """Club handles in rule order; the team category counts only when no club matched."""
    low, text = lowered(categories), F.lower(name)
    hits = F.array_compact(
        F.array(
            *[
                F.when(F.array_contains(low, category) | text.contains(words), F.lit(handle))
                for handle, _title, category, words in rules
            ]
        )
    )
    team = F.array_contains(low, teamwear[2]) & (F.size(hits) == 0)
    return F.when(team, F.array(F.lit(teamwear[0]))).otherwise(hits)


def genders(categories: Column, attribute_values: Column) -> Column:
    by_category = F.when(
        F.arrays_overlap(lowered(categories), string_array(shop.WOMEN_CATEGORIES)), F.array(F.lit("Women"))
    ).otherwise(string_array([]))
    by_value = F.filter(
        F.transform(attribute_values, lambda v: normalize_gender(v)), lambda g: g.isin("Men", "Women")
    )
    found = F.array_sort(F.array_union(by_category, by_value))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("Unisex")))


def _legacy(word: Column) -> Column:
    # runs inside a lambda, where a Python UDF cannot: the caller passes decoded words
    return F.concat(F.lit("legacy:"), slugify(word, fold_accents=False))


def product_tags(
    categories: Column, tags: Column, type_: Column, surface_: Column, clubs_: Column, genders_: Column
) -> Column:
    """Sorted distinct union of legacy slugs and axis tags."""
    legacy = F.array_union(F.transform(categories, _legacy), F.transform(tags, _legacy))
    axes = F.array_compact(
        F.array(
            F.concat(F.lit("type:"), type_),
            F.concat(F.lit("surface:"), surface_),
        )
    )
    clubs_part = F.transform(clubs_, lambda c: F.concat(F.lit("club:"), c))
    gender_part = F.transform(genders_, lambda g: F.concat(F.lit("gender:"), F.lower(g)))
    return F.array_sort(
        F.array_union(F.array_union(legacy, axes), F.array_union(clubs_part, gender_part))
    )


def choice_checked(values: Column, choices: Sequence[str]) -> Column:
    """``struct<kept, rejected>`` against a closed list."""
    allowed = string_array(choices)
    return F.struct(
        F.filter(values, lambda v: F.array_contains(allowed, v)).alias("kept"),
        F.array_sort(F.array_except(values, allowed)).alias("rejected"),
    )


def tag_values(tags: Column, prefix: str) -> Column:
    """Tags under ``prefix`` with the prefix taken off."""
    hits = F.filter(tags, lambda t: t.startswith(prefix))
    return F.transform(hits, lambda t: F.substring(t, F.lit(len(prefix) + 1), F.length(t)))


def metafield_details(fields: Column) -> Column:
    """``map<key, array<string>>`` of ``array<struct<key,type,value>>``.

    List types hold a JSON array; text that does not parse is kept as one raw value.
    """

    def values(f: Column) -> Column:
        listed = F.from_json(f["value"], "array<string>")
        ok = f["type"].startswith("list.") & listed.isNotNull() & f["value"].rlike(r"^\s*\[")
        return F.when(ok, listed).otherwise(F.array(f["value"]))

    usable = F.filter(fields, lambda f: blank_to_null(f["value"]).isNotNull())
    return F.map_from_entries(
        F.transform(usable, lambda f: F.struct(f["key"].alias("key"), values(f).alias("value")))
    )
