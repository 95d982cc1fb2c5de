"""Resolving (song, artist) pairs against the answers of a catalogue search."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartweave.functions.keys import combo_hash
from chartweave.functions.similarity import quick_similarity, ratio
from chartweave.functions.text import credit_text, search_text

Similarity = Callable[[Column, Column], Column]
# fixed values: candidates looked at, least scores, and the points of the early stop (index, score)
CANDIDATES, INDIVIDUAL, CONFIDENCE, LENIENCE, FLOOR = 25, 75.0, 75.0, 15.0, 50.0
EARLY_STOPS = ((10, 90.0), (15, 75.0))
QUICK_LEAST = 35.0


def search_query(song: Column, artist: Column) -> Column:
    """The strict query: both texts quoted."""
    return F.concat(F.lit('recording:"'), search_text(song), F.lit('" AND artist:"'), search_text(artist), F.lit('"'))


def search_ladder(song: Column, artist: Column) -> Column:
    """The eight queries in the order in which they are tried."""
    s, a = search_text(song), search_text(artist)
    qs, qa = (F.concat(F.lit('"'), x, F.lit('"')) for x in (s, a))
    r, by = F.lit("recording:"), F.lit("artist:")
    both = lambda x, word, y: F.concat(r, x, F.lit(f" {word} "), by, y)
    return F.array(both(s, "AND", a), both(qs, "AND", qa), both(qs, "OR", qa), both(s, "OR", a), F.concat(r, qs), F.concat(by, qa), F.concat(r, s), F.concat(by, a))


def candidates(answers: DataFrame, limit: int = CANDIDATES) -> DataFrame:
    """answers with one row per candidate: idx, c_id, c_song, c_artist from the first `limit` recordings; those without title or credit are left out."""
    rows = answers.select("*", F.posexplode(F.slice("recordings", 1, limit)).alias("idx", "__rec")).drop("recordings")
    rows = rows.select("*", F.col("__rec.id").alias("c_id"), F.col("__rec.title").alias("c_song"), credit_text(F.col("__rec.artist-credit")).alias("c_artist")).drop("__rec")
    return rows.filter((F.length("c_song") > 0) & (F.length("c_artist") > 0))


def combined_score(song: Column, artist: Column) -> Column:
    """One score of both: fixed values for exact or near-exact pairs, else 65 % song and 35 % artist."""
    return (
        F.when((song == 100) & (artist >= 85), F.lit(98.0))
        .when((artist == 100) & (song >= 85), F.lit(95.0))
        .when((song >= 95) & (artist >= 95), F.lit(96.0))
        .otherwise(song * 0.65 + artist * 0.35)
    )


def score_candidates(rows: DataFrame, similarity: Similarity = quick_similarity) -> DataFrame:
    """Candidates with song_score, artist_score and score."""
    rows = rows.withColumn("song_score", similarity(F.col("song"), F.col("c_song"))).withColumn("artist_score", similarity(F.col("artist"), F.col("c_artist")))
    return rows.withColumn("score", combined_score(F.col("song_score"), F.col("artist_score")))


def stop_early(scored: DataFrame, key: str) -> DataFrame:
    """Candidates up to the first that is late and good enough to end the search."""
    stop = F.lit(False)
    for idx, least in EARLY_STOPS:
        stop = stop | ((F.col("idx") >= idx) & (F.col("score") >= least))
    first = F.min(F.when(stop, F.col("idx"))).over(Window.partitionBy(key))
    return scored.withColumn("__stop", first).filter(F.col("__stop").isNull() | (F.col("idx") <= F.col("__stop"))).drop("__stop")


def best_candidate(scored: DataFrame, key: str) -> DataFrame:
    """The best candidate of each key: highest score above 0, the first of equal ones."""
    best = F.max_by(F.struct("idx", "c_id", "c_song", "c_artist", "song_score", "artist_score", "score"), F.struct("score", -F.col("idx"))).alias("b")
    return scored.filter("score > 0").groupBy(key).agg(best).select(key, "b.*")


def accept(best: DataFrame, individual: Column | float = INDIVIDUAL, confidence: Column | float = CONFIDENCE) -> DataFrame:
    """best with accepted and reasons: the thresholds that a rejected candidate misses. Only the best one is tried."""
    one = individual if isinstance(individual, Column) else F.lit(individual)
    total = F.greatest(F.lit(FLOOR), (confidence if isinstance(confidence, Column) else F.lit(confidence)) - LENIENCE)
    missed = F.array_compact(F.array(F.when(F.col("song_score") < one, F.lit("song")), F.when(F.col("artist_score") < one, F.lit("artist")), F.when(F.col("score") < total, F.lit("combined"))))
    return best.withColumn("reasons", missed).withColumn("accepted", F.size("reasons") == 0)


def resolve_answers(answers: DataFrame, key: str = "combo_hash", similarity: Similarity = quick_similarity, early: bool = False) -> DataFrame:
    """answers (key, song, artist, recordings) -> the best candidate per key, accepted or with reasons."""
    scored = score_candidates(candidates(answers), similarity)
    return accept(best_candidate(stop_early(scored, key) if early else scored, key))


def resolve_strict(answers: DataFrame, key: str = "combo_hash", least: float = 85.0, limit: int = 3) -> DataFrame:
    """The strict rules: indel ratio in lower case, mean of both at least `least`, of the first three candidates."""
    lower = lambda a, b: ratio(F.lower(a), F.lower(b))
    rows = score_candidates(candidates(answers, limit), lower).withColumn("score", (F.col("song_score") + F.col("artist_score")) / 2)
    return best_candidate(rows, key).withColumn("accepted", F.col("score") >= least)


def choose_answers(tries: DataFrame, key: str = "combo_hash", similarity: Similarity = quick_similarity) -> DataFrame:
    """tries (key, strategy from 1, song, artist, recordings) -> the first accepted answer of each key.

    A first or an eighth answer only needs to hold recordings; those between also need a
    first recording whose mean score against the search texts is at least QUICK_LEAST.
    """
    first = F.get(F.col("recordings"), F.lit(0))
    title, credit = first["title"], credit_text(first["artist-credit"])
    quick = (similarity(search_text(F.col("song")), title) + similarity(search_text(F.col("artist")), credit)) / 2
    good = F.col("strategy").isin(1, 8) | (F.coalesce(F.when((F.length(title) > 0) & (F.length(credit) > 0), quick), F.lit(0.0)) >= QUICK_LEAST)
    kept = tries.filter(F.size(F.coalesce("recordings", F.array())) > 0).filter(good)
    best = kept.groupBy(key).agg(F.min_by(F.struct(*[c for c in tries.columns if c != key]), "strategy").alias("b"))
    return best.select(key, "b.*")


def to_resolve(pairs: DataFrame, done: DataFrame, failed: DataFrame, key: str = "combo_hash") -> DataFrame:
    """pairs neither answered before nor failed for good, so a run can be taken up again at any time."""
    return pairs.join(done.select(key), key, "left_anti").join(failed.select(key), key, "left_anti")


def with_cache(pairs: DataFrame, cache: DataFrame, key: str = "combo_hash") -> DataFrame:
    """pairs with the cached columns and hit."""
    marked = cache.withColumn("__hit", F.lit(True))
    return pairs.join(marked, key, "left").withColumn("hit", F.coalesce("__hit", F.lit(False))).drop("__hit")


def apply_names(charts: DataFrame, resolved: DataFrame, mbid: bool = False) -> DataFrame:
    """charts with the accepted names; unmatched rows keep theirs. mbid: adds the recording's id, '' without a match.

    resolved has combo_hash, c_song, c_artist, c_id and accepted; of repeated hashes the
    smallest id counts. Whether it is broadcast is left to its measured size.
    """
    names = resolved.filter("accepted").groupBy("combo_hash").agg(F.min(F.struct("c_id", "c_song", "c_artist")).alias("n"))
    out = charts.withColumn("combo_hash", combo_hash(F.col("song"), F.col("artist"))).join(names, "combo_hash", "left")
    out = out.withColumns({"song": F.coalesce("n.c_song", "song"), "artist": F.coalesce("n.c_artist", "artist")} | ({"mbid": F.coalesce("n.c_id", F.lit(""))} if mbid else {}))
    return out.drop("combo_hash", "n")


def threshold_sweep(best: DataFrame, thresholds: list[float]) -> DataFrame:
    """threshold, pairs, accepted: the answers decided anew under several individual thresholds in one pass."""
    rows = best.select("*", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"))
    return accept(rows, individual=F.col("threshold")).groupBy("threshold").agg(F.count(F.lit(1)).alias("pairs"), F.count_if("accepted").alias("accepted"))
