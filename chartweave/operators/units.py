"""Bringing figures written in different units and scales to counts of single units."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS = ("sales", "streams", "airplay", "units")
#: Conversion factors: unit -> single units. Fixed and small, so it is safe to broadcast.
FACTORS = {"one": 1, "hundred": 100, "thousand": 1000, "ten_thousand": 10_000, "lakh": 100_000, "million": 1_000_000, "crore": 10_000_000, "hundred_million": 100_000_000, "billion": 1_000_000_000}
#: Spellings of units, lower case.
ALIASES = {
    "one": "copies copy sold plays play streams listeners aud. aud audience units unit u. spins sales downloads single|units single|counts single|unit full|counts".split(),
    "hundred": "hundred hundreds 00s (00s) x100 units|of|100 100s (100s)".split(),
    "thousand": "k thou. thou thousand thousands thsd. thsd tsd. tsd tausend mille 000s (000s) 1000s (1000s) x1000 x1,000 x|1000 ×1000 ×1,000 '000 in|000 units|of|1000 units|of|1,000 1,000s 千 тыс тыс.".split(),
    "ten_thousand": "万 萬 x10000 x10,000 10,000s".split(),
    "lakh": "lakh lakhs lac lacs".split(),
    "million": "m mm mn mln mln. mio mio. million millions millones millón millon million(s) 000,000s x1000000 x1,000,000 ×1,000,000 units|of|1000000 units|of|1,000,000 1,000,000s 百万 млн млн.".split(),
    "crore": "crore crores cr cr.".split(),
    "hundred_million": "亿 億".split(),
    "billion": "b bn bn. billion billions mrd mrd. milliard milliards x1,000,000,000 x1000000000".split(),
}
NUMBER = re.compile(r"[0-9](?:[0-9.,'’\s]*[0-9])?")
#: What may stand between the names of columns, and between these and their unit, in a caption.
LIST = re.compile(r"^\s*(,|;|&|\+|and|und|y|et)(\s*(and|&|\+))?\s*$", re.I)
LINK = re.compile(r"^\s*(,?\s*(which|that)?\s*(is|are)?\s*(all\s+)?(given|printed|shown|counted|stated|expressed|listed|reported)?\s*in(\s+the)?|/|:|=|\()\s*$", re.I)


@cache
def automaton(kind: str) -> ahocorasick.Automaton:
    """All aliases in one automaton; for captions ('caption') with the names of the columns."""
    a = ahocorasick.Automaton()
    for unit, words in ALIASES.items():
        for w in words:
            a.add_word(w.replace("|", " "), ("unit", unit, w.replace("|", " ")))
    if kind == "caption":
        for f in FIELDS:
            a.add_word(f, ("field", f, f))
    a.make_automaton()
    return a


def matches(text: str, kind: str) -> list[tuple[int, int, str, str]]:
    """(start, end, what, value) of the longest matches at word borders, left to right, not overlapping."""
    found = []
    for end, (what, value, word) in automaton(kind).iter(text):
        start, end = end - len(word) + 1, end + 1
        head, tail = text[start - 1 : start], text[end : end + 1]
        if word[0].isalpha() and word[0].isascii() and head.isalpha() or word[0].isdigit() and (head.isalnum() or head in ".,") and head:
            continue
        if word[-1].isalnum() and word[-1].isascii() and (tail.isalnum() or tail == "-" and text[end + 1 : end + 2].isalpha()):
            continue
        found.append((start, end, what, value))
    found.sort(key=lambda m: (m[0] - m[1], m[0]))
    kept: list[tuple[int, int, str, str]] = []
    for m in found:
        if all(m[1] <= k[0] or m[0] >= k[1] for k in kept):
            kept.append(m)
    return sorted(kept)


def read_cell(text: str | None) -> tuple[str | None, str | None]:
    """(number as written, unit or null) of a cell; (null, null) without a number.

    The unit is the longest alias right after the number, else right before it; nouns
    (copies, plays) are no units.
    """
    if text is None or not (n := NUMBER.search(text)):
        return None, None
    low = text.lower()
    after = before = None
    for start, end, _, unit in matches(low, "cell"):
        if unit == "one":
            continue
        if start >= n.end() and not low[n.end() : start].strip(" (\t ") and after is None:
            after = unit
        elif end <= n.start() and not low[end : n.start()].strip(" .\t ") and before is None:
            before = unit
    return n.group(), after or before


def read_caption(text: str | None) -> list[tuple[str, str]]:
    """(field, unit) for each column whose scale the caption tells: names of columns, a link such as 'in' or ':', a unit."""
    if not text:
        return []
    low = text.lower()
    found = matches(low, "caption")
    out: dict[str, str] = {}
    names: list[str] = []
    last = 0
    for start, end, what, value in found:
        if what == "unit" and value == "one" and low[start:end] in FIELDS:
            what, value = "field", low[start:end]
        gap = low[last:start]
        if what == "field":
            names = [*names, value] if names and LIST.match(gap) else [value]
        elif names and LINK.match(gap):
            out |= dict.fromkeys(names, value)
            names = []
        else:
            names = []
        last = end
    return [(f, u) for f, u in out.items() if u != "one"]


def parse_number(written: str | None, scaled: bool) -> float | None:
    """The value of a number as written. With a scale a lone point or comma is decimal, without it separates thousands
    (unless the digits after it aren't three)."""
    if written is None:
        return None
    t = re.sub(r"[\s'’]", "", written)
    marks = [c for c in t if c in ".,"]
    if len(set(marks)) == 2:
        decimal = marks[-1]
        t = t.replace("." if decimal == "," else ",", "").replace(decimal, ".")
    elif len(marks) == 1 and (scaled or len(t) - 1 - t.index(marks[0]) != 3):
        t = t.replace(",", ".")
    else:
        t = t.replace(",", "").replace(".", "")
    try:
        return float(t)
    except ValueError:
        return None


def unify_units(charts: DataFrame, captions: DataFrame, key: str = "raw_id") -> DataFrame:
    """One row per row and field of `charts`: key, src_file, field, cell, unit, told_in, factor, count.

    A multi-pattern automaton over the aliases of units reads each cell and each caption
    (longest match at word borders). The cell's own unit goes before the caption's; the
    caption counts only for the columns it names (field context: 'K-pop' or '53 million
    listeners' name none). The factors, a fixed table, are then joined by broadcast, the
    captions by src_file as any table that grows.

    told_in is 'cell', 'caption' or null (already single units); count is double, null for
    cells without a number (factor and unit are null then too). Cases: null or empty
    captions tell nothing; of several captions of a file each column's largest factor
    counts; repeated rows and nulls stay; empty tables give empty tables; other columns of
    both tables are left out, so their names can't clash.
    """
    spark = charts.sparkSession
    cells = charts.select(F.col(key).alias("__key"), F.col("src_file").alias("__file"), F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("c")) for f in FIELDS])).alias("x"))
    cells = cells.select("__key", "__file", F.col("x.f").alias("field"), F.col("x.c").alias("cell"))
    read = T.StructType([*cells.schema, T.StructField("written", T.StringType()), T.StructField("unit", T.StringType()), T.StructField("plain", T.DoubleType()), T.StructField("scaled", T.DoubleType())])

    def read_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [read_cell(x) for x in b.column(3).to_pylist()]
            w = [x for x, _ in got]
            made = [pa.array(w, pa.string()), pa.array([u for _, u in got], pa.string()), *[pa.array([parse_number(x, s) for x in w], pa.float64()) for s in (False, True)]]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], names=read.names)

    def read_captions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(f, *x) for f, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for x in read_caption(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["c_file", "c_field", "c_unit"])

    factors = spark.createDataFrame(list(FACTORS.items()), "f_unit string, factor bigint")
    told = captions.select("src_file", F.col("caption").cast("string")).mapInArrow(read_captions, "c_file string, c_field string, c_unit string")
    told = told.join(F.broadcast(factors), F.col("c_unit") == F.col("f_unit")).groupBy("c_file", "c_field").agg(F.max_by("c_unit", "factor").alias("c_unit"))
    x = cells.mapInArrow(read_cells, read).join(told, (F.col("__file") == F.col("c_file")) & (F.col("field") == F.col("c_field")), "left")
    has = F.col("written").isNotNull()
    told_in = F.when(has & F.col("unit").isNotNull(), "cell").when(has & F.col("c_unit").isNotNull(), "caption")
    x = x.select("*", told_in.alias("told_in"), F.when(has, F.coalesce("unit", "c_unit", F.lit("one"))).alias("unit_used"))
    x = x.join(F.broadcast(factors), F.col("unit_used") == F.col("f_unit"), "left")
    value = F.when(F.col("told_in").isNull(), F.col("plain")).otherwise(F.col("scaled")) * F.col("factor")
    return x.select(F.col("__key").alias(key), F.col("__file").alias("src_file"), "field", "cell", F.col("unit_used").alias("unit"), "told_in", "factor", F.round(value).alias("count"))


def scaled_cells(unified: DataFrame, key: str = "raw_id") -> DataFrame:
    """(key, field) of each cell whose digits are not yet the count."""
    return unified.filter(F.col("told_in").isNotNull() & (F.col("factor") != 1)).select(key, "field")
