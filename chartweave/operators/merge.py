"""Merging chart tables of many files into one ordered table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartweave.functions.dates import FORMATS, parse_date
from chartweave.functions.numeric import rank_number, repair_change, repair_number
from chartweave.functions.text import normalize_credit, normalize_text, split_change
from chartweave.operators.ordering import position_in_group, sort_keeping_places
from chartweave.schema import TEMPLATE_NAMES

# fixed value: the columns whose numbers are repaired
REPAIRED = ("rank", "sales", "sales_percent", "streams", "streams_percent", "airplay", "airplay_percent", "units")


def union_all(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, columns by name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def rename_template(df: DataFrame) -> DataFrame:
    """Columns of exported templates under the raw names, which are padded and named otherwise there."""
    plain = {c: c.strip().lower().replace(" ", "_") for c in df.columns}
    return df.select(*[F.col(f"`{c}`").alias(TEMPLATE_NAMES.get(n, n)) for c, n in plain.items()])


def repair_cells(df: DataFrame) -> DataFrame:
    """change and the counted columns repaired; the others stay."""
    fixed = {"change": repair_change(F.col("change"))} | {c: repair_number(F.col(c)) for c in REPAIRED}
    return df.withColumns({c: e for c, e in fixed.items() if c in df.columns})


def normalize_cells(df: DataFrame) -> DataFrame:
    """A leading number of song, then of artist, moved to a blank change; then both texts normalized."""
    song, change = split_change(F.col("song"), F.col("change"))
    df = df.withColumns({"song": song, "change": change})
    artist, change = split_change(F.col("artist"), F.col("change"))
    df = df.withColumns({"artist": artist, "change": change})
    return df.withColumns({c: normalize_credit(normalize_text(F.col(c))) for c in ("song", "artist")})


def date_format_of(df: DataFrame, date: str = "chart_date", forms: tuple[str, ...] = FORMATS) -> DataFrame:
    """One row, form: the first of the formats in which any date of the table can be read, null if none."""
    counts = df.agg(*[F.count(parse_date(F.col(date), f)).alias(f"n{i}") for i, f in enumerate(forms)])
    form: Column = F.lit(None).cast("string")
    for i, f in reversed(list(enumerate(forms))):
        form = F.when(F.col(f"n{i}") > 0, F.lit(f)).otherwise(form)
    return counts.select(form.alias("form"))


def with_dates(df: DataFrame, date: str = "chart_date", forms: tuple[str, ...] = FORMATS, name: str = "date") -> DataFrame:
    """df with the parsed date: one format for the whole table, as date_format_of finds it."""
    form = F.col("__form")
    parsed: Column = F.lit(None).cast("date")
    for f in reversed(forms):
        parsed = F.when(form == f, parse_date(F.col(date), f)).otherwise(parsed)
    found = date_format_of(df, date, forms).select(F.col("form").alias("__form"))
    return df.join(F.broadcast(found), F.lit(True), "left").withColumn(name, parsed).drop("__form")


def unify_date_text(df: DataFrame, date: str = "chart_date", order: str = "pos") -> DataFrame:
    """Dates rewritten from d-m-yy to m/d/yy if the first one in `order` is written so, without padding; else unchanged."""
    shape = r"^(\d{1,2})-(\d{1,2})-(\d{2})$"
    first = df.agg(F.min_by(F.col(date), F.when(F.col(date).isNotNull(), F.col(order))).alias("d")).select(F.coalesce(F.col("d").rlike(shape), F.lit(False)).alias("__turn"))
    turned = F.regexp_replace(date, shape, "$2/$1/$3")
    return df.join(F.broadcast(first), F.lit(True), "left").withColumn(date, F.when(F.col("__turn"), turned).otherwise(F.col(date))).drop("__turn")


def merge_charts(df: DataFrame, file: str = "src_file", pos: str = "pos", id_: str = "raw_id", keep_undated: bool = False, forms: tuple[str, ...] = FORMATS) -> DataFrame:
    """The merged charts with date and out_pos, the place within its date, newest dates first when sorted by
    (date desc, out_pos).

    Files of one date follow each other by name; within a date rows without a rank keep their
    place and the others stand in order of rank. Rows without a readable date are left out
    unless keep_undated (or no date of the table can be read). forms: the formats of dates in the
    order in which they are tried (SEQUENTIAL_FORMATS where each folder is merged by itself).
    """
    t = with_dates(df, forms=forms).withColumn("__rank", rank_number(F.col("rank")))
    if not keep_undated:
        any_date = F.max(F.col("date").isNotNull().cast("int")).alias("__any")
        t = t.join(F.broadcast(t.agg(any_date)), F.lit(True)).filter("date is not null or __any = 0").drop("__any")
    t = position_in_group(t, ["date"], [F.col(file), F.col(pos), F.col(id_)], "__at")
    return sort_keeping_places(t, ["date"], "__rank", "__at").drop("__rank", "__at")
