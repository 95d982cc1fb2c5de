"""Which rows of a chart table are of one song, however song and artist are written."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartweave.functions.keys import bag_hash, has_letters, letters, names_of, parts_of
from chartweave.session import cut


def anagram_parts(df: DataFrame) -> DataFrame | None:
    """(__pm, __ps, __pa, __pp) of the (letters of) songs and artists that share a character multiset in their
    market with another record; None if there are none, which is the rule.

    Distinct forms (letters, sorted names) are grouped by market and multiset hash. Only groups with several forms are
    looked at: forms of one record (fields in each other's place, names of a credit in another order) stay
    part 0 or become one higher part (__pp), so anagrams and hash collisions are told apart exactly.

    Plan: forms collapse map-side; a hot song has few forms, so no group grows with its rows.
    """
    s, a = F.col("song"), F.col("artist")
    named = df.filter(has_letters(s) | has_letters(a))
    forms = named.select(F.col("market").alias("__pm"), letters(s).alias("__ps"), letters(a).alias("__pa"), names_of(s).alias("songs"), names_of(a).alias("artists")).distinct()
    within = Window.partitionBy("__pm", "bag")
    pair = F.xxhash64(F.least("__ps", "__pa"), F.greatest("__ps", "__pa"))
    forms = forms.withColumn("bag", bag_hash(F.concat("__ps", "__pa"))).withColumn("pair", pair)
    forms = forms.withColumn("lo", F.min("pair").over(within)).withColumn("hi", F.max("pair").over(within)).filter("lo < hi").drop("lo", "hi", "pair")

    def part(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["__ps", "__pa", "songs", "artists"])
        names = group[["songs", "artists"]].astype(object).where(group[["songs", "artists"]].notna(), None)
        roots = parts_of(list(zip(group["__ps"], group["__pa"], names["songs"], names["artists"])))
        number = {r: k for k, r in enumerate(sorted(set(roots)))}
        group = group.assign(__pp=[number[r] for r in roots])
        return group.loc[group["__pp"] > 0, ["__pm", "__ps", "__pa", "__pp"]].drop_duplicates()

    parts = cut(forms.groupBy("__pm", "bag").applyInPandas(part, "__pm string, __ps string, __pa string, __pp int"))
    return None if parts.isEmpty() else parts


def with_song(df: DataFrame, parts: DataFrame | None, song: str = "__song", part: str = "__part") -> DataFrame:
    """`df` with the multiset hash of song and artist (null without letters) and the part that anagram_parts gave them."""
    s, a = F.col("song"), F.col("artist")
    key = F.when(has_letters(s) | has_letters(a), bag_hash(F.concat(letters(s), letters(a))))
    if parts is None:
        return df.withColumns({song: key, part: F.lit(0)})
    # a list of exceptions: Spark broadcasts it only if its size on disk is small
    on = F.col("market").eqNullSafe(F.col("__pm")) & (letters(s) == F.col("__ps")) & (letters(a) == F.col("__pa"))
    return df.withColumn(song, key).join(parts, on, "left").withColumn(part, F.coalesce("__pp", F.lit(0))).drop("__pm", "__ps", "__pa", "__pp")
