"""Implausible readings in weekly counts, relative to the normal behaviour of their source."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.functions.cells import count_reading, day_first_date
from chartweave.operators.entities import anagram_parts, with_song
from chartweave.session import cut

#: The least typical movement assumed of a market, as a logarithm, and that of one without two weeks in a row.
LEAST_SCALE, NO_SCALE = 0.02, 0.1
#: Field -> (least, most) that a week's count of a charted song can be.
LIMITS = {"points": (1.0, 1e5), "sales": (0.0, 1e8), "streams": (0.0, 1e10)}
#: Isolation trees a forest, readings a tree, and readings of a market from which these are taken.
TREES, SAMPLE, POOL = 32, 64, 1024
#: What passes for noise, in typical weekly movements of the market: beyond the neighbours, and off the song's level or its season.
QUIET_STEP, QUIET_LEVEL = 2.5, 8.0
#: Bins of the logarithm of a weekly movement, by which a market's median is found from parts of it.
BINS, BIN, BIN_LOW = 2048, 1 / 128, -12.0
WEEKS = 53


def physically_possible(v, field: str):
    """Column condition: a whole number within the field's limits."""
    low, high = LIMITS[field]
    return v.between(low, high) & (v == F.floor(v))


def grow_forest(points: np.ndarray, low0: np.ndarray, high0: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Isolation trees over points (trees, sample, features), all trees level by level at once.

    A root is split anywhere in low0..high0 (trees, features), the range of all readings, so that
    values too rare for a sample (long runs) can be parted too; other nodes in the range of
    their points. Returns per tree and node of a complete binary tree the feature (-1: leaf), the
    threshold and the path length that ending there stands for.
    """
    trees, size, width = points.shape
    depth = int(np.ceil(np.log2(max(size, 2))))
    nodes = 2 ** (depth + 1) - 1
    feature, split, path = np.full((trees, nodes), -1, np.int8), np.zeros((trees, nodes), np.float32), np.zeros((trees, nodes), np.float32)
    at = np.zeros((trees, size), np.int64)
    base = np.arange(trees)[:, None] * nodes
    pick_tree = np.arange(trees)
    for level in range(depth + 1):
        first, count = 2**level - 1, 2**level
        live = at >= first
        slot = (np.arange(trees)[:, None] * count + at - first)[live]
        held = np.bincount(slot, minlength=trees * count).reshape(trees, count)
        path[:, first : first + count] = level + mean_path(held)
        if level == depth:
            break
        x = points[live]
        low, high = np.full((trees * count, width), np.inf, np.float32), np.full((trees * count, width), -np.inf, np.float32)
        np.minimum.at(low, slot, x)
        np.maximum.at(high, slot, x)
        if level == 0:
            low, high = low0, high0
        spread = high > low
        choice = np.where(spread, rng.random(spread.shape), -1.0)
        if level == 0:
            # every feature has the first word in as many trees
            choice += 2.0 * (spread & (np.arange(width) == (pick_tree % width)[:, None]))
        q = choice.argmax(1)
        pick = np.arange(trees * count)
        can = spread.any(1)
        lo, hi = low[pick, q], high[pick, q]
        lo, hi = np.where(can, lo, 0), np.where(can, hi, 0)
        cutoff = lo + (hi - lo) * rng.random(trees * count).astype(np.float32)
        feature[:, first : first + count] = np.where(can, q, -1).reshape(trees, count)
        split[:, first : first + count] = cutoff.reshape(trees, count)
        f = feature.reshape(-1)[(base + at)[live]]
        down = 2 * at[live] + 1 + (x[np.arange(len(x)), np.maximum(f, 0)] > split.reshape(-1)[(base + at)[live]])
        at[live] = np.where(f >= 0, down, at[live])
    return feature, split, path


def mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.maximum(n, 1).astype(np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n > 1, 1.0, 0.0))


class Forest(NamedTuple):
    """A market's forest for one field, with what its features are measured by."""

    scale: float  # typical weekly movement
    season: np.ndarray  # usual distance from a song's level in each week of the year
    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray

    def features(self, level: np.ndarray, step: np.ndarray, week: np.ndarray, run: np.ndarray) -> np.ndarray:
        """Level, difference, season and run length of readings; 0 is noise."""
        beyond = lambda x, quiet: np.log1p(np.maximum(0.0, np.abs(x) / self.scale - quiet))
        return np.stack([beyond(level, QUIET_LEVEL), beyond(step, QUIET_STEP), beyond(level - self.season[week], QUIET_LEVEL), np.log(np.maximum(run, 2.0) / 2.0)], 1).astype(np.float32)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Isolation score of each reading; equal readings, as those within noise, are passed down once."""
        out = np.empty(len(x))
        odd = x.any(1)
        for rows, points in ((~odd, np.zeros((1, x.shape[1]), np.float32)), (odd, x[odd])):
            if not rows.any():
                continue
            trees, nodes = self.feature.shape
            base = (np.arange(trees) * nodes)[:, None]
            at = np.zeros((trees, len(points)), np.int64)
            f, s = self.feature.reshape(-1), self.split.reshape(-1)
            row = np.arange(len(points))[None]
            for _ in range(int(np.log2(nodes + 1)) - 1):
                q = f[base + at]
                right = points[row, np.maximum(q, 0)] > s[base + at]
                at = np.where(q >= 0, 2 * at + 1 + right, at)
            out[rows] = 2.0 ** (-self.path.reshape(-1)[base + at].mean(0) / mean_path(np.array([SAMPLE]))[0])
        return out


def reading_hash(song: np.ndarray, part: np.ndarray, day: np.ndarray) -> np.ndarray:
    """A pseudo-random order of readings that no split of a market changes."""
    x = song.astype(np.uint64) + part.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + day.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _shift(x: np.ndarray, by: int, song: np.ndarray) -> np.ndarray:
    """x of the row `by` places before (after, if negative), NaN beyond the song."""
    out = np.full(len(x), np.nan)
    if 0 < abs(by) < len(x):
        a, b = (slice(by, None), slice(None, -by)) if by > 0 else (slice(None, by), slice(-by, None))
        out[a] = np.where(song[a] == song[b], x[b], np.nan)
    return out


def week_features(day: np.ndarray, song: np.ndarray, value: np.ndarray) -> dict[str, np.ndarray]:
    """What the readings of songs are told by; rows sorted by song and day, no value missing.

    log: logarithm; low, high: those of the nearest weeks; middle: the song's median; move: from
    the week before; run: weeks in a row with the same value; week: of the year.
    """
    v = np.log(np.maximum(value, 0.5))
    before, after = _shift(v, 1, song), _shift(v, -1, song)
    # at an end of the song the two nearest weeks stand in for both sides
    second = np.where(np.isnan(before), _shift(v, -2, song), np.where(np.isnan(after), _shift(v, 2, song), before))
    both = np.stack([before, after, second])
    alone = np.isnan(both).all(0)
    both[:, alone] = v[alone]
    new_song = np.concatenate([[True], song[1:] != song[:-1]])
    sid = np.cumsum(new_song) - 1
    starts, sizes = np.flatnonzero(new_song), np.bincount(sid)
    middle = v[np.lexsort((v, sid))][starts + (sizes - 1) // 2]
    same = np.concatenate([[False], (value[1:] == value[:-1]) & ~new_song[1:] & (np.diff(day) == 7)])
    rid = np.cumsum(~same) - 1
    date = day.astype("datetime64[D]")
    week = (date - date.astype("datetime64[Y]").astype("datetime64[D]")).astype(np.int64) // 7
    return {"log": v, "low": np.fmin.reduce(both), "high": np.fmax.reduce(both), "middle": middle[sid], "move": np.abs(v - before), "run": np.bincount(rid)[rid].astype(float), "week": week}


def steps(w: dict[str, np.ndarray], v: np.ndarray) -> np.ndarray:
    """How far v lies beyond the nearest weeks, signed."""
    return np.where(v > w["high"], v - w["high"], np.where(v < w["low"], v - w["low"], 0.0))


def summarize(w: dict[str, np.ndarray], order: np.ndarray) -> dict[str, np.ndarray]:
    """What a forest needs to know of some readings of a market; order: their reading_hash. Parts of a market are added up by merge_summaries."""
    move = w["move"][~np.isnan(w["move"])]
    bins = np.clip((np.log(np.maximum(move, 1e-12)) - BIN_LOW) / BIN, 0, BINS - 1).astype(np.int64)
    level, step = w["log"] - w["middle"], steps(w, w["log"])
    low, high = np.full(WEEKS, np.inf), np.full(WEEKS, -np.inf)
    np.minimum.at(low, w["week"], level)
    np.maximum.at(high, w["week"], level)
    total = np.zeros(WEEKS, np.int64)
    np.add.at(total, w["week"], np.rint(level * 1e6).astype(np.int64))
    pick = np.argsort(order, kind="stable")[:POOL]
    return {
        "moves": np.bincount(bins, minlength=BINS), "weeks": np.bincount(w["week"], minlength=WEEKS), "total": total, "low": low, "high": high, "top": np.array([np.abs(step).max(initial=0.0), w["run"].max(initial=1.0)]),
        "order": order[pick], "level": level[pick], "step": step[pick], "week": w["week"][pick], "run": w["run"][pick],
    }


def merge_summaries(parts: Iterable[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The summary of all readings from those of its parts, whatever the parts are."""
    parts = list(parts)
    out = {k: sum(p[k] for p in parts) for k in ("moves", "weeks", "total")}
    out |= {"low": np.minimum.reduce([p["low"] for p in parts]), "high": np.maximum.reduce([p["high"] for p in parts]), "top": np.maximum.reduce([p["top"] for p in parts])}
    order = np.concatenate([p["order"] for p in parts])
    pick = np.argsort(order, kind="stable")[:POOL]
    return out | {k: np.concatenate([p[k] for p in parts])[pick] for k in ("order", "level", "step", "week", "run")}


def fit_forest(summary: dict[str, np.ndarray], seed: int, times: float, least_run: int) -> Forest:
    """The forest of a market and field. Roots range to the greatest reading and at least to twice what is implausible."""
    moves = summary["moves"]
    n = int(moves.sum())
    scale = max(1.4826 * float(np.exp(BIN_LOW + BIN * (np.searchsorted(np.cumsum(moves), (n + 1) // 2) + 0.5))), LEAST_SCALE) if n else NO_SCALE
    season = np.rint(summary["total"] / np.maximum(summary["weeks"], 1)) / 1e6
    blank = Forest(scale, season, *(np.zeros((1, 1)),) * 3)
    points = blank.features(summary["level"], summary["step"], summary["week"], summary["run"])
    seen = summary["weeks"] > 0
    far = np.maximum(np.abs(summary["low"][seen]), np.abs(summary["high"][seen])).max(initial=0.0)
    off = np.maximum(np.abs(summary["low"][seen] - season[seen]), np.abs(summary["high"][seen] - season[seen])).max(initial=0.0)
    step, run = summary["top"]
    one = np.array([0])
    most = blank.features(np.array([max(far, 20 * scale)]), np.array([max(step, 2 * times * scale)]), one, np.array([max(run, 2.0 * least_run)]))[0]
    most[2] = np.log1p(max(off / scale, 20.0) - QUIET_LEVEL)
    rng = np.random.default_rng(seed)
    sample = points[rng.integers(0, len(points), (TREES, SAMPLE))]
    high = np.repeat(most[None], TREES, 0).astype(np.float32)
    return Forest(scale, season, *grow_forest(sample, np.zeros_like(high), high, rng))


def bars(forest: Forest, times: float, least_run: int) -> np.ndarray:
    """The forest's scores of two readings that are just implausible and usual otherwise: `times` typical movements beyond the neighbours, and a run of least_run."""
    zero = np.zeros(2)
    x = forest.features(zero, zero, np.array([0, 0]), zero)
    x[:, [0, 2]] = 0
    x[0, 1], x[1, 3] = np.log1p(times - QUIET_STEP), np.log(max(least_run, 2) / 2)
    return forest.score(x) - 1e-9


def judge(forest: Forest, w: dict[str, np.ndarray], most: np.ndarray, times: float, least_run: int, floor: bool) -> dict[str, np.ndarray]:
    """Of the readings (log; most: the greatest of a week's copies): score, bounds from which copies are spikes (NaN: none), stuck."""
    spike_bar, stuck_bar = bars(forest, times, least_run) if floor else (0.0, 0.0)

    def look(v: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part = {k: x[at] for k, x in w.items()}
        step = steps(part, v)
        score = forest.score(forest.features(v - part["middle"], step, part["week"], part["run"]))
        return score, np.sign(step) * ((np.abs(step) > QUIET_STEP * forest.scale) & (score >= spike_bar))

    def bound(inner: np.ndarray, outer: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where between a value that is none and one that is a spike begins."""
        for _ in range(30):
            mid = (inner + outer) / 2
            hit = look(mid, at)[1] != 0
            inner, outer = np.where(hit, inner, mid), np.where(hit, mid, outer)
        return outer

    all_ = np.arange(len(w["log"]))
    score, side = look(w["log"], all_)
    stuck = (w["run"] >= least_run) & (score >= stuck_bar)
    low, high = np.where(side < 0, w["log"], np.nan), np.where(side > 0, w["log"], np.nan)
    two = np.flatnonzero(~np.isnan(most))
    if len(two):
        score2, side2 = look(most[two], two)
        score[two] = np.maximum(score[two], score2)
        up, down = side2 > 0, side2 < 0
        low[two[down]] = most[two][down]
        for k, sign in ((two[up & (side[two] <= 0)], 1), (two[~down & (side[two] < 0)], -1)):
            if len(k) and sign > 0:
                high[k] = bound(np.maximum(w["log"][k], w["high"][k]), most[k], k)
            elif len(k):
                low[k] = bound(np.minimum(most[k], w["low"][k]), w["log"][k], k)
    return {"score": score, "low": low, "high": high, "stuck": stuck}


def _groups(t: pa.Table, by: tuple[str, ...]) -> np.ndarray:
    """Where rows with another `by` than the row before begin."""
    new = np.zeros(len(t), bool)
    for c in by:
        x = t[c].combine_chunks()
        x = x.dictionary_encode().indices.fill_null(-1) if pa.types.is_string(x.type) or pa.types.is_large_string(x.type) else x.fill_null(0)
        x = x.to_numpy(zero_copy_only=False)
        new[1:] |= x[1:] != x[:-1]
    new[:1] = True
    return np.flatnonzero(new)


def in_whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole (market, block) groups from batches sorted by these."""
    kept: list[pa.RecordBatch] = []
    for b in batches:
        starts = _groups(t := pa.Table.from_batches([b]), ("market", "block"))
        if kept and len(b):
            seam = _groups(pa.Table.from_batches([kept[-1].slice(len(kept[-1]) - 1), b.slice(0, 1)]), ("market", "block"))
            if len(seam) > 1:
                yield pa.Table.from_batches(kept)
                kept = []
        if len(starts) > 1:
            yield pa.Table.from_batches([*kept, b.slice(0, int(starts[-1]))])
            kept = [b.slice(int(starts[-1]))]
        elif len(t):
            kept.append(b)
    if kept:
        yield pa.Table.from_batches(kept)


def _readings(t: pa.Table) -> Iterator[tuple[int, str, np.ndarray, dict[str, np.ndarray], np.ndarray]]:
    """(number, field, rows, week_features, reading_hash) of the readings of each field of one block."""
    song, part, day = (t[c].to_numpy() for c in ("song", "part", "day"))
    sid = np.cumsum(np.concatenate([[True], (song[1:] != song[:-1]) | (part[1:] != part[:-1])])) if len(song) else song
    order = reading_hash(song, part, day)
    for i, f in enumerate(LIMITS):
        value = t[f"v_{f}"].to_numpy().astype(float)
        ok = np.flatnonzero(~np.isnan(value))
        if len(ok):
            yield i, f, ok, week_features(day[ok].astype(np.int64), sid[ok], value[ok]), order[ok]


def summarize_blocks(weeks: DataFrame) -> DataFrame:
    """(market, field, summary) of each block of `weeks`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_whole_blocks(batches):
            starts = _groups(table, ("market", "block"))
            for a, b in zip(starts, [*starts[1:], len(table)]):
                t = table.slice(a, b - a)
                found = [(f, pickle.dumps(summarize(w, order))) for _, f, _, w, order in _readings(t)]
                yield pa.RecordBatch.from_pydict({"market": pa.array([t["market"][0].as_py()] * len(found), pa.string()), "field": pa.array([f for f, _ in found], pa.string()), "summary": pa.array([s for _, s in found], pa.binary())})

    return weeks.mapInArrow(run, "market string, field string, summary binary")


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    return group.head(1).assign(summary=[pickle.dumps(merge_summaries(map(pickle.loads, group["summary"])))])


def judge_weeks(weeks: DataFrame, times: float, least_run: int, floor: bool) -> DataFrame:
    """The implausible song's weeks: market, song, part, day and per field score, low, high (bounds of logarithms) and stuck.

    `weeks` has market, block, song, part, day, summaries and per field v_F (least value of the week's copies) and x_F
    (the greatest where it differs), in partitions sorted by the first five that hold whole blocks. A block of
    a market that has several begins with a row that holds the summaries of the whole market.
    """
    names = [f"{k}_{f}" for f in LIMITS for k in ("score", "low", "high", "stuck")]
    schema = "market string, song bigint, part int, day int, " + ", ".join(f"{n} double" for n in names)

    def solve(t: pa.Table) -> pa.RecordBatch:
        market = t["market"][0].as_py()
        whole: dict = {}
        if t["summaries"][0].is_valid:
            whole = pickle.loads(t["summaries"][0].as_py())
            t = t.slice(1)
        out, hit = {n: np.full(len(t), np.nan) for n in names}, np.zeros(len(t), bool)
        for i, f, rows, w, order in _readings(t):
            forest = fit_forest(pickle.loads(whole[f]) if whole else summarize(w, order), zlib.crc32((market or "").encode()) + i, times, least_run)
            most = t[f"x_{f}"].to_numpy().astype(float)[rows]
            got = judge(forest, w, np.log(np.maximum(most, 0.5)), times, least_run, floor)
            for k, x in got.items():
                out[f"{k}_{f}"][rows] = x
            hit[rows] |= got["stuck"] | ~np.isnan(got["low"]) | ~np.isnan(got["high"])
        keep = np.flatnonzero(hit)
        columns = [t[c].combine_chunks().take(pa.array(keep)) for c in ("market", "song", "part", "day")]
        return pa.RecordBatch.from_arrays([*columns, *[pa.array(out[n][keep], pa.float64(), from_pandas=True) for n in names]], names=["market", "song", "part", "day", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_whole_blocks(batches):
            starts = _groups(table, ("market", "block"))
            for a, b in zip(starts, [*starts[1:], len(table)]):
                yield solve(table.slice(a, b - a))

    return weeks.mapInArrow(run, schema)


def flag_spikes(df: DataFrame, times: float = 5.0, least_run: int = 4, floor: bool = True, block_rows: int = 100_000) -> DataFrame:
    """(row_id, market, field, value, reason, score): each implausible reading of points, sales and streams.

    Reasons: 'limit' - negative, fractional or beyond LIMITS, by rule; 'spike' and 'stuck' - by an
    isolation forest per market and field, on level (off the song's median), difference (beyond
    the nearest weeks on both sides; at the ends, the two nearest), season (off the market's usual
    level in that week of the year) and run length (weeks in a row with the same value). Each is
    measured in the market's typical weekly movement (1.4826 x median absolute log change) beyond what passes
    for noise. Every reading is scored; the bar is the score which the market's own forest gives
    to a reading just implausible in one way, `times` typical movements out or a run of
    least_run. An exact check follows: a spike lies beyond both neighbours by more than noise
    (QUIET_STEP), so a lasting change of level is none, and a run has least_run weeks. Without
    `floor` the score is not asked, for comparison.

    Trees are fitted on TREES x SAMPLE readings out of POOL of the market, those first in a hash order;
    scale, season and ranges are counted over all of its readings.

    Cases: missing cells are no reading and no case, a cell that isn't a number neither; rows
    without date or name are tested for limits only. Copies of a week: the smallest possible
    value stands for the week to its neighbours, each copy is tested on its own. An empty table gives an empty table.

    Plan: copies collapse map-side to one row per song and week, which are partitioned by
    (market, block of whole songs). A market of more than block_rows rows has several blocks, so a
    hot one is spread; its summaries are added up from its blocks first, and its forest is
    the same whatever the blocks. Only implausible weeks are joined with the rows.
    """
    parts = anagram_parts(df)
    rows = with_song(
        df.select("row_id", "market", "song", "artist", F.datediff(day_first_date(F.col("chart_date")), F.lit("1970-01-01").cast("date")).alias("day"), *[count_reading(F.col(f)).alias(f) for f in LIMITS]), parts
    ).select("row_id", "market", F.col("__song").alias("song"), F.col("__part").alias("part"), "day", *LIMITS)
    possible = {f: F.when(physically_possible(F.col(f), f), F.col(f)) for f in LIMITS}
    least = [F.min(possible[f]).alias(f"v_{f}") for f in LIMITS]
    most = [F.max(possible[f]).alias(f"m_{f}") for f in LIMITS]
    weeks = rows.filter("song is not null and day is not null").groupBy("market", "song", "part", "day").agg(*least, *most)
    readings = [c for f in LIMITS for c in (F.col(f"v_{f}"), F.when(F.col(f"m_{f}") > F.col(f"v_{f}"), F.col(f"m_{f}")).alias(f"x_{f}"))]
    large = cut(df.groupBy(F.col("market").alias("k")).count().filter(F.col("count") > block_rows).select("k", F.ceil(F.col("count") / block_rows).cast("bigint").alias("blocks")))
    block = F.lit(0).cast("bigint")
    many = not large.isEmpty()
    if many:
        weeks = weeks.join(large, F.col("market").eqNullSafe(F.col("k")), "left")
        block = F.coalesce(F.pmod("song", "blocks"), block)
    weeks = weeks.select("market", block.alias("block"), "song", "part", "day", *readings)
    by = ["market", "block", "song", "part", "day"]
    if many:
        weeks = cut(weeks.repartition("market", "block"))
        hot = weeks.join(large, F.col("market").eqNullSafe(F.col("k")), "left_semi").repartition("market", "block").sortWithinPartitions(*by)
        # a market's summaries, of bounded size, are added up in two steps
        sums = summarize_blocks(hot).withColumn("some", F.pmod(F.xxhash64("summary"), F.lit(64)).cast("int"))
        sums = sums.groupBy("market", "field", "some").applyInPandas(_merge, sums.schema).groupBy("market", "field").applyInPandas(_merge, sums.schema)

        def pack(group: pd.DataFrame) -> pd.DataFrame:
            return group.head(1)[["market"]].assign(summaries=[pickle.dumps(dict(zip(group["field"], group["summary"])))])

        packed = sums.groupBy("market").applyInPandas(pack, "market string, summaries binary")
        first = packed.join(large, F.col("market").eqNullSafe(F.col("k"))).select("market", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), "summaries")
        weeks = weeks.withColumn("summaries", F.lit(None).cast("binary")).unionByName(first, allowMissingColumns=True)
    else:
        weeks = weeks.withColumn("summaries", F.lit(None).cast("binary"))
    # a row of summaries has no song and comes first
    found = judge_weeks(weeks.repartition("market", "block").sortWithinPartitions(*by), times, least_run, floor)
    hit = [F.struct(*[F.col(f"{k}_{f}").alias(k) for k in ("score", "low", "high", "stuck")]).alias(f"b_{f}") for f in LIMITS]
    found = found.select(F.col("market").alias("m"), F.col("song").alias("s"), F.col("part").alias("p"), F.col("day").alias("d"), *hit)
    rows = rows.join(found, F.col("market").eqNullSafe(F.col("m")) & F.col("song").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")) & F.col("day").eqNullSafe(F.col("d")), "left")
    tests = []
    for f in LIMITS:
        v, b = F.col(f), F.col(f"b_{f}")
        lv = F.log(F.greatest(v, F.lit(0.5)))
        reason = F.when(v.isNotNull() & ~physically_possible(v, f), "limit").when((lv >= b["high"] - 1e-9) | (lv <= b["low"] + 1e-9), "spike").when(v.isNotNull() & (b["stuck"] == 1), "stuck")
        tests.append(F.when(reason.isNotNull(), F.struct(F.lit(f).alias("field"), v.alias("value"), reason.alias("reason"), F.when(reason != "limit", b["score"]).alias("score"))))
    return rows.select("row_id", "market", F.explode(F.array_compact(F.array(*tests))).alias("x")).select("row_id", "market", "x.*")
