"""Dates in file names, posts and chart cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: formats of chart dates in the order in which they are tried, when merging a folder and when merging folder by folder
_FIRST, _NEXT = ("m/d/y", "d-m-y", "Y-m-d"), ("d-m-y", "Y-m-d")
#: Written forms that are tried when no date of a table has one of those above.
FREE = ("m/d/Y", "Y/m/d", "m-d-Y", "d.m.Y", "Month d, Y", "d Month Y")
FORMATS, SEQUENTIAL_FORMATS = (*_FIRST, *FREE), (*_NEXT, *FREE)
_SHAPE = {
    "m/d/y": r"^(\d{1,2})/(\d{1,2})/(\d{2})$", "d-m-y": r"^(\d{1,2})-(\d{1,2})-(\d{2})$", "Y-m-d": r"^(\d{4})-(\d{1,2})-(\d{1,2})$",
    "m/d/Y": r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "Y/m/d": r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "m-d-Y": r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "d.m.Y": r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$",
    "Month d, Y": r"^([A-Za-z]{3})[a-z]* (\d{1,2}),? (\d{4})$", "d Month Y": r"^(\d{1,2}) ([A-Za-z]{3})[a-z]*,? (\d{4})$",
}
_ORDER = {"m/d/y": (3, 1, 2), "d-m-y": (3, 2, 1), "Y-m-d": (1, 2, 3), "m/d/Y": (3, 1, 2), "Y/m/d": (1, 2, 3), "m-d-Y": (3, 1, 2), "d.m.Y": (3, 2, 1), "Month d, Y": (3, 1, 2), "d Month Y": (3, 2, 1)}
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def parse_date(c: Column, form: str) -> Column:
    """The date in `c` written in one of FORMATS, null otherwise; two-digit years from 69 on are 19xx."""
    y, m, d = (F.regexp_extract(F.trim(c), _SHAPE[form], i) for i in _ORDER[form])
    month = F.array_position(F.array(*map(F.lit, _MONTHS)), F.lower(m)) if "Month" in form else m.try_cast("int")
    y, d = y.try_cast("int"), d.try_cast("int")
    year = F.when(y >= 100, y).when(y >= 69, y + 1900).otherwise(y + 2000)
    return F.when(y.isNotNull(), F.format_string("%04d-%02d-%02d", year, month, d).try_cast("date"))


# fixed values: the date in a file name, the sentence that announces a chart, the time of a post
FILE_DATE = r"(\d{4})-(\d{2})-(\d{2})_\d+"
ANNOUNCED = r"(?i)chart dated ([A-Za-z]+) (\d{1,2})[a-z]{2}, (\d{4})"
POSTED = r"^\w{3} (\w{3} \d{2} \d{2}:\d{2}:\d{2}) [+-]\d{4} (\d{4})$"


def file_date(name: Column) -> Column:
    """Date of an image or table file named ..YYYY-MM-DD_n.., as mm/dd/yy; '' without one."""
    y, m, d = (F.regexp_extract(name, FILE_DATE, i) for i in (1, 2, 3))
    return F.when(y != "", F.concat_ws("/", m, d, F.substring(y, 3, 2))).otherwise(F.lit(""))


def announced_date(text: Column) -> Column:
    """The date after 'chart dated' in a post ('August 23rd, 2025'), in any letter case; null without one."""
    month, day, year = (F.regexp_extract(text, ANNOUNCED, i) for i in (1, 2, 3))
    return F.try_to_date(F.when(month != "", F.concat_ws(" ", F.initcap(month), day, year)), "MMMM d yyyy")


def posted_at(c: Column) -> Column:
    """Time of a post like 'Fri Oct 27 08:25:09 +0000 2023'; the offset is left out, not applied; null if it can't be read."""
    text = F.concat_ws(" ", F.regexp_extract(c, POSTED, 1), F.regexp_extract(c, POSTED, 2))
    return F.try_to_timestamp(F.when(c.rlike(POSTED), text), F.lit("MMM dd HH:mm:ss yyyy"))


def month_folder(d: Column) -> Column:
    """Name of a date's month folder, such as 'Oct 23'."""
    return F.date_format(d, "MMM yy")
