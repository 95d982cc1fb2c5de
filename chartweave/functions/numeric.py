"""Repair of numbers and rank changes read from images; results stay text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartweave.functions.text import blank, strip

# fixed values: letters misread for digits
MISREAD, DIGITS = "OIlSB", "01158"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def repair_change(c: Column) -> Column:
    """'NEW', a signed whole number, or '' if there is none."""
    t = F.translate(strip(c), "I", "1")
    digits = F.regexp_extract(t, r"(\d+)", 1)
    down = t.startswith("-") | F.lower(t).contains("down")
    fixed = F.when(F.upper(t) == "NEW", F.lit("NEW")).when(t.rlike(r"^[+-]\d+$"), t)
    fixed = fixed.when(digits != "", F.concat(F.when(down, F.lit("-")).otherwise(F.lit("+")), digits)).otherwise(F.lit(""))
    return F.when(blank(c), F.lit("")).otherwise(fixed)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value worked out once and named, not written out at every use."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def repair_number(c: Column) -> Column:
    """Digits of a number without separators; k and m at the end are multiplied out in floating point and cut off
    ('8.2M' is '8199999'); text without a digit stays as it is."""

    def scaled(t: Column) -> Column:
        head = F.substring(t, F.lit(1), F.length(t) - 1)
        first = F.regexp_extract(head, r"(\d+\.?\d*)", 1)
        value = F.when(head.rlike(NUMBER), head).otherwise(first).try_cast("double") * F.when(t.rlike("[kK]$"), 1_000).otherwise(1_000_000)
        # beyond the whole numbers of 64 bits the text stays as it is
        return F.coalesce(_once(value, lambda n: F.when(F.abs(n) < 9.2e18, n.cast("bigint").cast("string"))), t)

    def fixed(t: Column) -> Column:
        bare = F.regexp_replace(t, r"[^\d.]", "")
        out = F.when(t.rlike("[kKmM]$"), scaled(t)).when(t.rlike(r"\d[a-zA-Z]$"), F.regexp_extract(t, r"(\d+\.?\d*)", 1))
        return out.otherwise(F.coalesce(F.nullif(bare, F.lit("")), t))

    text = F.translate(F.regexp_replace(strip(c), "[, ]", ""), MISREAD, DIGITS)
    return F.when(blank(c), F.lit("")).otherwise(_once(text, fixed))


def rank_number(c: Column) -> Column:
    """The rank as int, null if it is no whole number."""
    t = strip(c)
    return F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("int"))
