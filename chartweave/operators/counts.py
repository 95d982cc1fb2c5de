"""Distinct values, modes, top counts and summaries of charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartweave.functions.text import likely_song, valid_pair


def distinct_in_order(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """keys, first (least `order`) and n of each distinct combination."""
    return df.groupBy(*keys).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))


def distinct_songs(df: DataFrame, order: str = "pos") -> DataFrame:
    """Distinct valid (song, artist) pairs that look like songs, with first and n."""
    song, artist = F.col("song"), F.col("artist")
    return distinct_in_order(df.filter(valid_pair(song, artist) & likely_song(song, artist)), ["song", "artist"], order)


def mode_of(df: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """by, mode, n: the most frequent value of each group; ties by first appearance."""
    counts = distinct_in_order(df, [*by, value], order)
    return counts.groupBy(*by).agg(F.max_by(value, F.struct("n", -F.col("first"))).alias("mode"), F.max("n").alias("n"))


def top_counts(df: DataFrame, value: str, k: int = 5) -> DataFrame:
    """value, n of the k most frequent values; ties by value."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(value)).limit(k)


def split_valid(df: DataFrame, song: str = "song", artist: str = "artist") -> DataFrame:
    """df with valid: whether both texts are there; rows are kept in their order by pos."""
    return df.withColumn("valid", valid_pair(F.col(song), F.col(artist)))


def pair_count(df: DataFrame) -> Column:
    """Number of distinct (song, artist) pairs without nulls, as an aggregate."""
    pair = F.when(F.col("song").isNotNull() & F.col("artist").isNotNull(), F.struct("song", "artist"))
    return F.count_distinct(pair)


def standardization_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows, distinct pairs before and after, the share saved in percent (null without pairs)."""
    a = before.agg(F.count(F.lit(1)).alias("rows"), pair_count(before).alias("pairs_before"))
    b = after.agg(pair_count(after).alias("pairs_after"))
    out = a.join(F.broadcast(b), F.lit(True))
    saved = (F.col("pairs_before") - F.col("pairs_after")) / F.nullif(F.col("pairs_before"), F.lit(0)) * 100.0
    return out.withColumn("saved_percent", saved)


def match_report(scored: DataFrame) -> DataFrame:
    """One row: pairs, accepted, failed and success_percent of scored pairs with a boolean accepted."""
    n, ok = F.count(F.lit(1)), F.count_if("accepted")
    return scored.agg(n.alias("pairs"), ok.alias("accepted"), (n - ok).alias("failed"), (ok / F.nullif(n, F.lit(0)) * 100.0).alias("success_percent"))
