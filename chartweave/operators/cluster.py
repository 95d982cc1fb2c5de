"""Standard spellings by greedy leader clustering of similar texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.functions.similarity import ratio
from chartweave.functions.text import valid_pair
from chartweave.session import cut


def similar_pairs(values: DataFrame, threshold: float, by: list[str]) -> DataFrame:
    """(by, i, j), i < j: pairs of values (by, id, value) whose indel ratio is at least threshold, within `by`.

    LCS is at most the common multiset of characters, so a pair needs
    ceil(t (|a| + |b|) / 200) numbered characters in common; each text's rarest ones, as many
    as a match cannot miss, serve as join keys (prefix filter), then lengths and the
    multisets are tested and only the rest is scored. Nothing is lost.
    """
    t = threshold / 100.0
    chars = F.filter(F.split("value", ""), lambda c: F.length(c) > 0)
    tok = values.select(*by, "id", "value", F.posexplode(chars).alias("at", "ch"))
    tok = tok.groupBy(*by, "id", "value", "ch").agg(F.count(F.lit(1)).alias("k"))
    tok = tok.select(*by, "id", "value", F.explode(F.transform(F.sequence(F.lit(1), F.col("k").cast("int")), lambda i: F.concat_ws(":", F.col("ch"), i))).alias("tok"))
    freq = tok.groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    sets = tok.join(freq, "tok").groupBy(*by, "id", "value").agg(F.sort_array(F.collect_list(F.struct("n", "tok"))).alias("s"))
    size = F.size("s")
    # a partner of the least possible length still shares this many
    least = F.ceil(size * (t / (2 - t)) - 1e-9).cast("int")
    sets = cut(sets.select(*by, "id", "value", size.alias("len"), F.transform("s", lambda x: x["tok"]).alias("toks"), F.transform(F.slice("s", 1, F.greatest(size - least + 1, F.lit(1))), lambda x: x["tok"]).alias("first")))
    a = sets.select(*by, F.col("id").alias("i"), F.col("len").alias("la"), F.explode("first").alias("tok"))
    b = sets.select(*by, F.col("id").alias("j"), F.col("len").alias("lb"), F.explode("first").alias("tok"))
    near = (F.col("i") < F.col("j")) & (2 * F.least("la", "lb") >= t * (F.col("la") + F.col("lb")) - 1e-9)
    pairs = a.join(b, [*by, "tok"]).filter(near).select(*by, "i", "j").distinct()
    left = sets.select(*by, F.col("id").alias("i"), F.col("value").alias("va"), F.col("toks").alias("ta"))
    right = sets.select(*by, F.col("id").alias("j"), F.col("value").alias("vb"), F.col("toks").alias("tb"))
    pairs = pairs.join(left, [*by, "i"]).join(right, [*by, "j"])
    pairs = pairs.filter(2 * F.size(F.array_intersect("ta", "tb")) >= t * (F.size("ta") + F.size("tb")) - 1e-9)
    return pairs.withColumn("r", ratio(F.col("va"), F.col("vb"))).filter(F.col("r") >= threshold).select(*by, "i", "j")


def leaders(pairs: DataFrame, by: list[str]) -> DataFrame:
    """(by, id, leader) of the ids in `pairs` (by, i, j with i < j) as one pass in order of id would group them.

    An id leads if no leader before it is similar to it, else it joins the first such leader.
    In rounds: an undecided id without an undecided smaller neighbour leads, its larger
    neighbours don't; members are assigned after the last round.
    """
    pairs = cut(pairs.distinct())
    nodes = pairs.select(*by, F.col("i").alias("id")).union(pairs.select(*by, F.col("j").alias("id"))).distinct()
    state = nodes.withColumn("lead", F.lit(None).cast("boolean"))
    while True:
        open_ = state.filter("lead is null").select(*by, F.col("id").alias("i"))
        blocked = pairs.join(open_, [*by, "i"]).select(*by, F.col("j").alias("id")).distinct().withColumn("blocked", F.lit(True))
        state = state.join(blocked, [*by, "id"], "left").withColumn("lead", F.coalesce("lead", F.when(F.col("blocked").isNull(), F.lit(True)))).drop("blocked")
        lead = state.filter("lead").select(*by, F.col("id").alias("i"))
        led = pairs.join(lead, [*by, "i"]).select(*by, F.col("j").alias("id")).distinct().withColumn("led", F.lit(True))
        state = cut(state.join(led, [*by, "id"], "left").withColumn("lead", F.coalesce("lead", F.when(F.col("led"), F.lit(False)))).drop("led"))
        if state.filter("lead is null").isEmpty():
            break
    first = pairs.join(state.filter("lead").select(*by, F.col("id").alias("i")), [*by, "i"]).groupBy(*by, F.col("j").alias("id")).agg(F.min("i").alias("leader"))
    return state.join(first, [*by, "id"], "left").select(*by, "id", F.when(F.col("lead"), F.col("id")).otherwise(F.col("leader")).alias("leader"))


def spelling_map(df: DataFrame, value: str, order: str, threshold: float, by: list[str] | None = None) -> DataFrame:
    """(by, variant, standard): each value that changes, with the most frequent spelling of its cluster; ties go to the first seen."""
    by = by or []
    seen = df.groupBy(*by, F.col(value).alias("value")).agg(F.min(order).alias("id"), F.count(F.lit(1)).alias("n"))
    seen = cut(seen)
    found = leaders(similar_pairs(seen, threshold, by), by)
    named = found.join(seen, [*by, "id"])
    best = named.groupBy(*by, "leader").agg(F.max_by("value", F.struct("n", -F.col("id"))).alias("standard"))
    return named.join(best, [*by, "leader"]).select(*by, F.col("value").alias("variant"), "standard").filter("variant <> standard")


def _apply(df: DataFrame, spelling: DataFrame, column: str, by: list[str]) -> DataFrame:
    m = spelling.select(*[F.col(b).alias(f"__{b}") for b in by], "variant", "standard")
    on = F.col(column) == F.col("variant")
    for b in by:
        on = on & (F.col(b) == F.col(f"__{b}"))
    return df.join(m, on, "left").withColumn(column, F.coalesce("standard", column)).drop("variant", "standard", *[f"__{b}" for b in by])


def standardize_artists(df: DataFrame, threshold: float = 80, order: str = "pos") -> DataFrame:
    """df with artists in standard spelling; null and blank ones stay. `order` must be unique."""
    known = df.filter(F.length(F.trim("artist")) > 0)
    return _apply(df, spelling_map(known, "artist", order, threshold), "artist", [])


def standardize_songs(df: DataFrame, threshold: float = 85, order: str = "pos") -> DataFrame:
    """df with songs in standard spelling among those of the same artist ('' is an artist, null is none)."""
    known = df.filter((F.length(F.trim("song")) > 0) & F.col("artist").isNotNull())
    return _apply(df, spelling_map(known, "song", order, threshold, ["artist"]), "song", ["artist"])


def standardize_pairs(df: DataFrame, threshold: float = 85, order: str = "pos") -> DataFrame:
    """df with (song, artist) in standard spelling, compared as 'song | artist'; rows without both stay as they are."""
    both = F.concat_ws(" | ", "song", "artist")
    known = df.filter(valid_pair(F.col("song"), F.col("artist"))).withColumn("__both", both)
    spelling = spelling_map(known, "__both", order, threshold)
    parts = known.groupBy(F.col("__both").alias("standard")).agg(F.min(F.struct("song", "artist")).alias("p"))
    m = spelling.join(parts, "standard").select("variant", F.col("p.song").alias("__song"), F.col("p.artist").alias("__artist"))
    out = df.withColumn("__both", F.when(valid_pair(F.col("song"), F.col("artist")), both)).join(m, F.col("__both") == F.col("variant"), "left")
    return out.withColumns({"song": F.coalesce("__song", "song"), "artist": F.coalesce("__artist", "artist")}).drop("__both", "variant", "__song", "__artist")


def standardize(df: DataFrame, artists: float = 80, songs: float = 85, pairs: float = 85, order: str = "pos") -> DataFrame:
    """Artists, then songs per artist, then pairs; the rows stay the same in number and order."""
    return standardize_pairs(standardize_songs(standardize_artists(df, artists, order), songs, order), pairs, order)
