"""Order as data: sorts that keep places, and the order of merged charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def position_in_group(df: DataFrame, by: list[str], order: list[Column], name: str = "pos") -> DataFrame:
    """df with the place of each row in its group, from 0; `order` must be unique within a group."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("bigint"))


def sort_keeping_places(df: DataFrame, by: list[str], rank: str, pos: str, out: str = "out_pos") -> DataFrame:
    """df with `out`, the new place: rows without rank keep theirs, ranked rows take the other places in order of rank.

    Ties of rank go by pos, which must be unique within a group. The k-th place and the k-th
    rank are matched by a join on (group, k), so no group becomes one value.
    """
    ranked = df.filter(F.col(rank).isNotNull())
    key = [F.col(b).alias(f"__{b}") for b in by]
    places = ranked.select(*key, F.col(pos).alias("__place"), F.row_number().over(Window.partitionBy(*by).orderBy(pos)).alias("__k"))
    k = F.when(F.col(rank).isNotNull(), F.row_number().over(Window.partitionBy(*by, F.col(rank).isNull()).orderBy(rank, pos)))
    numbered = df.withColumn("__n", k)
    on = F.col("__n") == F.col("__k")
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"__{b}"))
    return numbered.join(places, on, "left").withColumn(out, F.coalesce("__place", pos)).drop("__n", "__k", "__place", *[f"__{b}" for b in by])


def chart_order(date: str, rank: str, pos: str) -> list[Column]:
    """Newest first, then rank with missing ones last, then pos; missing dates last."""
    return [F.col(date).desc_nulls_last(), F.col(rank).asc_nulls_last(), F.col(pos).asc_nulls_last()]


def number_rows(df: DataFrame, file: str = "src_file", pos: str = "pos", name: str = "raw_id") -> DataFrame:
    """df with a number for each row that is unique and in the order of (file, pos), from 0; pos counts from 0 in each file.

    Only the files' sizes are put in order, one row a file; the rows themselves aren't sorted.
    """
    sizes = df.groupBy(F.col(file).alias("__file")).agg((F.max(pos) + 1).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__file", F.coalesce(before, F.lit(0)).alias("__start"))
    return df.join(starts, F.col(file).eqNullSafe(F.col("__file"))).withColumn(name, (F.col("__start") + F.col(pos)).cast("bigint")).drop("__file", "__start")
