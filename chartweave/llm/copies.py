"""Copies of a record that differ in form only, collapsed with their number."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartweave.functions.cells import day_first_date, whole_number
from chartweave.functions.keys import MASK60, bag_hash, letters, names_of, parts_of
from chartweave.session import cut

def fingerprint(pairs: list[tuple[str, Column]], seed: int) -> Column:
    """Commutative hash of a multiset of (field name, value) pairs: 60-bit hashes added modulo 2**60."""
    total: Column = F.lit(0).cast("bigint")
    for name, value in pairs:
        total = (total + F.xxhash64(F.lit(name), value, F.lit(seed)).bitwiseAND(F.lit(MASK60))).bitwiseAND(F.lit(MASK60))
    return total


def copy_links(df: DataFrame) -> DataFrame:
    """(keep_id, copy_id): each row of a chart table that is a copy, with the smallest row_id of its group.

    Rows are copies if market, chart date, usable rank (1 to 100), song and artist agree apart
    from white space, letter case, punctuation, the order of the names in a credit, or song
    and artist having changed places. The order of words counts in everything but credits; two
    rows that differ only in the order of names in the song are taken for rows with song and
    artist in each other's place.

    Each (field name, normalized value) pair is hashed, song and artist under one name since
    they may change places, their value as a multiset of characters; the hashes are added
    (a commutative multiset hash, twice 60 bits) and grouped. Members of groups are then
    compared field by field with the group's first row, without sorting; groups in which one
    differs (hash collisions, anagrams, lost separators) are parted into the closure of this
    comparison over their distinct forms, so every link is found and none is false.

    Cases: rows without market, date, usable rank or any letter are no copies. Exact
    repeats with the same row_id count as one row. An empty table gives an empty table.
    Other columns play no part.

    Plan: the aggregate is on four longs and combines map-side, so a hot group arrives as a
    few rows; only rows of groups of two or more are kept (a table in the shared checkpoint
    folder); its join with one row per group is split by AQE when skewed. Distinct forms of a
    group are few whatever its number of rows.
    """
    song, artist = F.col("song"), F.col("artist")
    rows = df.select("row_id", "market", "song", "artist", day_first_date(F.col("chart_date")).alias("day"), whole_number(F.col("rank"), 1, 100).alias("rank"))
    rows = rows.filter("market is not null and day is not null and rank is not null")
    rows = rows.select("row_id", "market", "day", "rank", letters(song).alias("s"), letters(artist).alias("a"), "song", "artist").filter("s <> '' or a <> ''")
    keys = []
    for seed in (1, 2):
        pairs = [("market", F.col("market")), ("day", F.col("day")), ("rank", F.col("rank")), ("text", bag_hash(F.col("s"), seed)), ("text", bag_hash(F.col("a"), seed))]
        keys.append(fingerprint(pairs, seed).alias(f"f{seed}"))
    rows = rows.select("*", *keys)
    groups = rows.groupBy("f1", "f2").agg(F.min("row_id").alias("keep_id"), F.max("row_id").alias("last_id")).filter("keep_id < last_id")
    members = rows.join(groups, ["f1", "f2"]).select("keep_id", "row_id", "market", "day", "rank", "s", "a", names_of(song).alias("sn"), names_of(artist).alias("an"))
    members = cut(members)
    fields = ("market", "day", "rank", "s", "a", "sn", "an")
    first = members.filter("row_id = keep_id").groupBy("keep_id").agg(*[F.first(c).alias(f"k_{c}") for c in fields])
    others = members.filter("row_id <> keep_id").join(first, "keep_id")
    same = F.expr("market = k_market and day = k_day and rank = k_rank")
    same &= F.expr("(s = k_s and (a = k_a or coalesce(an = k_an, false))) or (a = k_a and coalesce(sn = k_sn, false)) or (s = k_a and (a = k_s or coalesce(an = k_sn, false))) or (a = k_s and coalesce(sn = k_an, false))")
    others = others.withColumn("same", same)
    mixed = cut(others.filter("not same").select("keep_id").distinct())
    plain = others.select("keep_id", F.col("row_id").alias("copy_id"))
    if mixed.isEmpty():
        return plain.distinct()
    by = ["market", "day", "rank"]
    forms = members.join(mixed, "keep_id").groupBy("keep_id", *by, "s", "a", "sn", "an").agg(F.min("row_id").alias("low"))

    def part(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in group.groupby(by):
            roots = parts_of([tuple(x if isinstance(x, str) else None for x in f) for f in zip(g["s"], g["a"], g["sn"], g["an"])])
            g = g.assign(root=roots)
            out.append(g.assign(real=g.groupby("root")["low"].transform("min")))
        return pd.concat(out)[["keep_id", *by, "s", "a", "sn", "an", "real"]]

    real = forms.groupBy("keep_id").applyInPandas(part, "keep_id bigint, market string, day date, rank int, s string, a string, sn string, an string, real bigint")
    fits = F.col("r.keep_id") == F.col("m.keep_id")
    for c in (*by, "s", "a", "sn", "an"):
        fits &= F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}"))
    odd = members.alias("m").join(real.alias("r"), fits).select("m.row_id", "r.real").filter("row_id <> real").select(F.col("real").alias("keep_id"), F.col("row_id").alias("copy_id"))
    return plain.join(mixed, "keep_id", "left_anti").unionByName(odd).distinct()


def collapse_copies(df: DataFrame) -> DataFrame:
    """The rows of `df` that are no copies, with copies: how many rows, itself included, each stands for.

    A column named copies in the input is replaced. See copy_links for what a copy is.
    """
    links = cut(copy_links(df))
    counts = links.groupBy("keep_id").agg((F.count(F.lit(1)) + 1).alias("copies"))
    kept = df.drop("copies").join(links, df["row_id"] == links["copy_id"], "left_anti")
    kept = kept.join(counts, kept["row_id"] == counts["keep_id"], "left").drop("keep_id")
    return kept.withColumn("copies", F.coalesce("copies", F.lit(1).cast("bigint")))
