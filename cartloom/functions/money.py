"""Money and weight expressions. ANSI mode is on, so every parse is a ``try`` form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def parse_decimal(c: Column) -> Column:
    """Text to a wide decimal: blanks and thousands commas dropped, anything else null."""
    return F.translate(F.trim(c.cast("string")), ",", "").try_cast("decimal(38,10)")


def money(c: Column, half_even: bool = True) -> Column:
    """Two-place amount, null when absent. ``half_even=False`` rounds ties away from zero."""
    parsed = parse_decimal(c)
    return (F.bround(parsed, 2) if half_even else F.round(parsed, 2)).cast(MONEY)


def money_or_zero(c: Column) -> Column:
    return F.coalesce(parse_decimal(c), F.lit(0).cast("decimal(38,10)"))


def money_text(c: Column) -> Column:
    """Rendered amount; ``""`` when absent."""
    return F.coalesce(money(c).cast("string"), F.lit(""))


def kg_to_grams(c: Column) -> Column:
    return F.bround(parse_decimal(c) * 1000, 0).cast("int")


def cents(c: Column) -> Column:
    """Exact amount of a ``double`` money column, so sums do not depend on row order."""
    return c.cast(MONEY)


def js_round2(c: Column) -> Column:
    """Two places, ties toward plus infinity."""
    return (F.floor(c.cast("decimal(28,6)") * 100 + F.lit(0.5).cast("decimal(2,1)")) / 100).cast(MONEY)
