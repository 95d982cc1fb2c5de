"""Similarity of two texts, 0 to 100."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from chartweave.functions.text import comparison_text, strip


def edit_similarity(a: Column, b: Column) -> Column:
    """Share of the longer text that no edit touches; 0 for empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise((longest - F.levenshtein(a, b)) / longest * 100.0)


def word_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of the distinct words."""
    wa, wb = (F.array_distinct(F.filter(F.split(x, r"\s+"), lambda w: F.length(w) > 0)) for x in (a, b))
    union = F.size(F.array_union(wa, wb))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(wa, wb)) / union * 100.0)


def containment(a: Column, b: Column) -> Column:
    """Length of the shorter text against the longer if it lies in it, else 0."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    return F.when((F.length(short) > 0) & long.contains(short), F.length(short) / F.length(long) * 100.0).otherwise(F.lit(0.0))


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bits in parallel."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """200 * LCS / (sum of lengths); 100 for two empty texts."""
    n = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / n if n else 100.0


def partial_ratio(a: str, b: str) -> float:
    """Best indel_ratio of the shorter text with a window of the longer, also windows cut off at the ends."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    return max(indel_ratio(short, long[max(0, i) : i + n]) for i in range(1 - n, len(long)))


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    wa, wb = set(a.split()), set(b.split())
    if not wa or not wb:
        return 0.0
    both = " ".join(sorted(wa & wb))
    if both and (wa <= wb or wb <= wa):
        return 100.0
    da, db = " ".join(sorted(wa - wb)), " ".join(sorted(wb - wa))
    ja, jb = f"{both} {da}".strip(), f"{both} {db}".strip()
    best = indel_ratio(ja, jb)
    return max(best, indel_ratio(both, ja), indel_ratio(both, jb)) if both else best


def weighted_ratio(a: str, b: str) -> float:
    """The best of the ratios, word-based ones weighed down, partial ones used where lengths differ much."""
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    base = indel_ratio(a, b)
    if longer < 1.5:
        return max(base, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if longer < 8 else 0.6
    words = lambda s: " ".join(sorted(s.split()))
    wa, wb = set(a.split()), set(b.split())
    parts = 100.0 if wa & wb else partial_ratio(" ".join(sorted(wa - wb)), " ".join(sorted(wb - wa)))
    return max(base, scale * partial_ratio(a, b), 0.95 * scale * max(partial_ratio(words(a), words(b)), parts))


def _pairwise(function, a: Column, b: Column) -> Column:
    udf = F.pandas_udf(lambda x, y: pd.Series([None if p is None or q is None else float(function(p, q)) for p, q in zip(x, y)], dtype="float64"), "double")
    return udf(a, b)


def ratio(a: Column, b: Column) -> Column:
    """indel_ratio as a column, null for null."""
    return _pairwise(indel_ratio, a, b)


def lcs_similarity(a: Column, b: Column) -> Column:
    """LCS against the longer text."""
    return _pairwise(lambda p, q: 100.0 * lcs_length(p, q) / max(len(p), len(q), 1), a, b)


def _gates(a: Column, b: Column) -> tuple[Column, Column, Column, Column]:
    x, y = strip(F.lower(a)), strip(F.lower(b))
    return x, y, comparison_text(x), comparison_text(y)


def enhanced_similarity(a: Column, b: Column) -> Column:
    """100 if equal in lower case, 95 if equal for comparing, else edits, words, subsequence and containment at 40, 25, 20 and 15 %."""
    x, y, p, q = _gates(a, b)
    mix = 0.4 * edit_similarity(p, q) + 0.25 * word_similarity(p, q) + 0.2 * lcs_similarity(p, q) + 0.15 * containment(p, q)
    return F.when(x == y, F.lit(100.0)).when(p == q, F.lit(95.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), mix)))


def quick_similarity(a: Column, b: Column) -> Column:
    """The same gates, then 80 % edits and 20 % of 50 if one text lies in the other: built-in expressions only."""

    def score(v: Column) -> Column:
        p, q = v["p"], v["q"]
        inside = (F.length(p) > 0) & (F.length(q) > 0) & (p.contains(q) | q.contains(p))
        mix = 0.8 * edit_similarity(p, q) + F.when(inside, F.lit(10.0)).otherwise(F.lit(0.0))
        return F.when(v["x"] == v["y"], F.lit(100.0)).when(p == q, F.lit(95.0)).otherwise(mix)

    # the four texts are worked out once and named, not written out at every use
    x, y, p, q = _gates(a, b)
    texts = F.array(F.struct(x.alias("x"), y.alias("y"), p.alias("p"), q.alias("q")))
    return F.get(F.transform(texts, score), F.lit(0))


def blended_similarity(a: Column, b: Column, raw: bool = False) -> Column:
    """Blend of five ratios; raw: on lower-case text with the first gate only and other weights."""
    x, y, p, q = _gates(a, b)

    def blend(s: str, t: str) -> float:
        w = (0.4, 0.2, 0.25, 0.1, 0.05) if raw else (0.4, 0.25, 0.2, 0.1, 0.05)
        parts = (weighted_ratio(s, t), indel_ratio(s, t), token_sort_ratio(s, t), partial_ratio(s, t), token_set_ratio(s, t))
        return min(100.0, max(0.0, sum(k * v for k, v in zip(w, parts))))

    if raw:
        return F.when(x == y, F.lit(100.0)).otherwise(_pairwise(blend, x, y))
    return F.when(x == y, F.lit(100.0)).when(p == q, F.lit(95.0)).otherwise(_pairwise(blend, p, q))
