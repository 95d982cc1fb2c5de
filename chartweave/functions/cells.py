"""Typed readings of dirty chart cells; an unreadable cell is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A whole number with marks or blanks around it and perhaps `.0`; letters, other digits and minus signs are no marks.
WHOLE = r"^[^\p{L}\p{N}\-−–]*([0-9]+)(?:\.0+)?[^\p{L}\p{N}\-−–]*$"
DAY_FIRST = r"([0-9]{1,2})[^0-9]+([0-9]{1,2})[^0-9]+([0-9]{4}|[0-9]{2})"


def whole_number(c: Column, low: int, high: int) -> Column:
    """The whole number in `c` if it lies within low..high, else null."""
    n = F.regexp_extract(c, WHOLE, 1).try_cast("int")
    return F.when(n.between(low, high), n)


def day_first_date(c: Column) -> Column:
    """The date in `c`, written day, month, year with any separators; two-digit years from 69 on are 19xx."""
    # one match, then its three numbers
    parts = F.split(F.regexp_extract(c, DAY_FIRST, 0), "[^0-9]+")
    d, m, y = (F.get(parts, F.lit(i)) for i in range(3))
    year = F.when(F.length(y) == 4, y).when(y >= F.lit("69"), F.concat(F.lit("19"), y)).otherwise(F.concat(F.lit("20"), y))
    return F.concat_ws("-", year, m, d).try_cast("date")


def count_reading(c: Column) -> Column:
    """The number in a cell as double: quotes, blanks and thousands commas removed; null where there is none."""
    return F.regexp_replace(c, r"[\s\xA0,\"']", "").try_cast("double")
