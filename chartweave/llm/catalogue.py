"""Mapping freely typed entries to the closest entry of a reference list."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartweave.llm.typed import edits, fold_text, skeleton
from chartweave.session import cut

NONE = "NONE"
GUEST = r"(?i)\s*[(\[]?\s*\b(?:feat(?:\.|uring)?|ft\.?)\s.*$"
#: Words that say nothing about which recording is meant.
CHATTER = re.compile(r"[(\[{]?\b(?:official(?: music)?(?: audio| video)?|audio|video|lyrics?(?: video)?|hq|hd|4k|single|album version|explicit|clean)\b[)\]}]?")
#: Version marks; a recording with one is another recording than one without.
VERSION = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "1": "1", "2": "2", "3": "3", "4": "4", "one": "1", "two": "2"}
KIND = re.compile(r"\b(remix|acoustic|live|demo|instrumental|unplugged|radio edit|karaoke|cover|reprise|remaster(?:ed)?|extended)\b")
PART = re.compile(r"[\s,(\[-]*\bp[art]{0,3}[a-z]?t[.\s]*(i{1,3}|iv|[1-4]|one|two)\b[)\].\s]*$|[\s,(\[-]+\b(?:vol|no)[.\s]+([1-4])[)\].\s]*$|\s+(i{1,3}|iv|[1-4])[)\].\s]*$")
JOINS = re.compile(r"\s+(?:feat\.?|featuring|ft\.?|with|and|x|vs\.?|n)\s+|\s*[&/+;]\s*")
LEET = str.maketrans("013457@$", "oieastas")
TAIL_WORDS = ("lyrics", "single", "official", "audio", "video")


def _code(gram: str) -> int:
    """Up to three characters as one number, exactly."""
    a, b, c = (gram + "\0\0")[:3]
    return ord(a) << 42 | ord(b) << 21 | ord(c)


def _trigrams(texts: Iterable[str]) -> list[int]:
    found: set[str] = set()
    for s in texts:
        found |= {s[i : i + 3] for i in range(len(s) - 2)} if len(s) > 2 else {s} - {""}
    return sorted(map(_code, found))


def _grams(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_trigrams(re.sub(r"[\W_]+", "", fold_text(t or "")) for t in pair) for pair in zip(a, b)])


def grams(a: Column, b: Column) -> Column:
    """Distinct character trigrams, as numbers, of the letters of each text (folded); texts under three letters count as one."""
    return F.pandas_udf(_grams, "array<bigint>")(a, b)


def _bones(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_trigrams(skeleton(_plain(t or "").replace(" ", "")) for t in pair) for pair in zip(a, b)])


def bones(a: Column, b: Column) -> Column:
    """Distinct trigrams of the consonants and digits of each text as _plain reads it; texts under three of them count as one."""
    return F.pandas_udf(_bones, "array<bigint>")(a, b)


def similarity_pairs(left: DataFrame, right: DataFrame, at_least: float) -> DataFrame:
    """(l, r, jaccard) of all pairs of left (id, tokens) and right (id, tokens) with a Jaccard similarity of at_least or more.

    Prefix-filter join: the tokens of each set are ordered by their frequency in both
    tables, rarest first; sets that similar share a token within their first
    n - ceil(t n) + 1. Length and positional filters thin the matches, then Jaccard is
    computed exactly. No pair is lost. Tokens within a set are distinct; empty sets match nothing.
    """
    both = left.select(F.explode("tokens").alias("tok")).unionByName(right.select(F.explode("tokens").alias("tok")))
    freq = both.groupBy("tok").agg(F.count(F.lit(1)).alias("n"))

    def ordered(df: DataFrame, name: str) -> DataFrame:
        toks = df.select("id", F.explode("tokens").alias("tok")).join(freq, "tok")
        sets = toks.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "tok"))).alias("s"))
        size = F.size("s")
        first = F.slice("s", 1, size - F.ceil(F.lit(at_least) * size).cast("int") + 1)
        sets = sets.select("id", F.transform("s", lambda x: x["tok"]).alias("tokens"), size.alias("size"), F.transform(first, lambda x: x["tok"]).alias("first"))
        return sets.select(*[F.col(c).alias(f"{name}_{c}") for c in sets.columns])

    a, b = cut(ordered(left, "l")), cut(ordered(right, "r"))
    pa = a.select("l_id", "l_size", F.posexplode("l_first").alias("l_pos", "tok"))
    pb = b.select("r_id", "r_size", F.posexplode("r_first").alias("r_pos", "tok"))
    t = at_least
    rest = F.least(F.col("l_size") - F.col("l_pos"), F.col("r_size") - F.col("r_pos"))  # this token and those after it
    need = F.ceil((F.col("l_size") + F.col("r_size")) * (t / (1 + t)) - 1e-9)
    near = (F.col("l_size") >= t * F.col("r_size") - 1e-9) & (F.col("r_size") >= t * F.col("l_size") - 1e-9) & (rest >= need)
    pairs = pa.join(pb, "tok").filter(near).select("l_id", "r_id").distinct()
    full = pairs.join(a.select("l_id", "l_tokens"), "l_id").join(b.select("r_id", "r_tokens"), "r_id")
    common = F.size(F.array_intersect("l_tokens", "r_tokens"))
    full = full.withColumn("jaccard", common / (F.size("l_tokens") + F.size("r_tokens") - common))
    return full.filter(F.col("jaccard") >= t).select(F.col("l_id").alias("l"), F.col("r_id").alias("r"), "jaccard")


def _plain(s: str) -> str:
    """Folded words with chatter, leet digits within words and marks removed; '&', '+' and 'n' read as 'and'."""
    t = fold_text(s)
    t = " ".join(w.translate(LEET) if re.search(r"[a-z]", w) and re.search(r"[0-9@$]", w) and not re.fullmatch(r"[0-9]{1,2}[a-z\W]+", w) else w for w in t.split())
    t = CHATTER.sub(" ", t)
    t = re.sub(r"\s*[&+]\s*|\sn\s", " and ", t)
    return re.sub(r"[^\w\s]|_", " ", re.sub(r"(?<=\w)['’](?=\w)", "", t))


def split_version(title: str) -> tuple[str, frozenset[str]]:
    """(title without its version marks, the marks) of a title as typed."""
    t = CHATTER.sub(" ", fold_text(title)).strip(" *!?.~\"'-")
    marks = set()
    if m := PART.search(t):
        marks.add(VERSION[m.group(1) or m.group(2) or m.group(3)])
        t = t[: m.start()]
    for m in KIND.finditer(t):
        marks.add(m.group(1))
    return KIND.sub(" ", t), frozenset(marks)


def _words_cost(wa: list[str], wb: list[str]) -> float | None:
    """Cost of the words of a typed title against a known one."""
    while len(wa) > len(wb) and any(edits(wa[-1], w, 2) <= 2 or len(wa[-1]) > 3 and w.startswith(wa[-1]) for w in TAIL_WORDS):
        wa = wa[:-1]
    if wb[0] == "the" and wa[:1] != ["the"] and len(wa) > 1:
        wb = wb[1:]
    x, y = "".join(wa), "".join(wb)
    if not x or not y:
        return None
    if x == y:
        return 0.0
    if len(wa) == len(wb):
        # word by word, so that another word of the same length isn't taken for a typing error
        ds = [edits(p, q, 3) for p, q in zip(wa, wb)]
        if all(d <= min(3, max(1, (len(q) + 1) // 3)) for d, q in zip(ds, wb)) and sum(ds) <= max(2, len(y) // 4):
            return sum(ds) / len(y)
        if all(p == q or p == skeleton(q) or edits(p, skeleton(q), 1) + 2 <= len(p) and edits(p, skeleton(q), 1) <= 1 or edits(p, q, 2) <= 1 for p, q in zip(wa, wb)):
            return 0.2
        return None
    most = max(1, int(len(y) * 0.12))
    d = edits(x, y, most)
    return d / len(y) if d <= most else None


def _cut_cost(x: str, y: str) -> float | None:
    """Cost of x if it is y with its end cut off."""
    if 6 <= len(x) < len(y) and len(x) >= 0.4 * len(y):
        most = max(1, len(x) // 8)
        d = edits(x, y[: len(x)], most)
        if d <= most:
            return 0.15 + d / len(x)
    return None


@lru_cache(100_000)
def _title(title: str) -> tuple[tuple[str, ...], frozenset[str], tuple[str, ...], str]:
    """Words without version marks, the marks, all words, their letters."""
    base, marks = split_version(title)
    words = tuple(_plain(re.sub(r"\bpart\b", "pt", fold_text(title))).split())
    return tuple(_plain(base).split()), marks, words, "".join(words)


def title_cost(typed: str, known: str) -> float | None:
    """How far a typed title is from a known one: 0 equal, None if it isn't meant."""
    (wa, va, fa, x), (wb, vb, fb, y) = _title(typed), _title(known)
    if not x or not y or not wa or not wb:
        return None
    if x == y:
        return 0.0
    options = []
    if va == vb and (c := _words_cost(list(wa), list(wb))) is not None:
        options.append(c)
    ends = lambda s: len(s) - len(s.rstrip("i"))
    if len(fa) < len(fb):
        # blanks left out: the marks must stand at the end all the same
        whole = x if len(fa) == 1 or x.startswith("the") == y.startswith("the") else "the" + x
        most = max(1, int(len(y) * 0.12))
        goal = y if whole.startswith("the") or not y.startswith("the") else y[3:]
        d = edits(whole, goal, most)
        if d <= most and (not vb or ends(whole) == ends(goal) and whole[-1] == goal[-1]) and (vb or not va or len(fa) == 1):
            options.append(0.02 + d / len(y))
    if len(fa) <= len(fb) and (not va or fa[-1] in ("i", "a")):
        for goal in {y, y.removeprefix("the")}:
            if (c := _cut_cost(x, goal)) is not None:
                # the end that was cut off may have held a mark
                options.append(c + (0.1 if vb else 0.0))
    return min(options) if options else None


def _near(a: str, b: str) -> float | None:
    """Share of edits between two texts without spaces, None beyond what typing errors explain."""
    n = max(len(a), len(b))
    most = max(2 if n >= 6 else 1, int(n * 0.2))
    d = edits(a, b, most)
    return d / n if d <= most else None


def _name_cost(a: list[str], b: list[str]) -> float | None:
    """Cost of one name (words) against another: equal words in any order, typing errors, initials, a surname alone, missing vowels, a cut end."""
    a, b = ([w for w in x if w not in ("the", "of")] for x in (a, b))
    x, y = "".join(a), "".join(b)
    if not x or not y:
        return None
    if x == y or sorted(a) == sorted(b):
        return 0.0
    costs = [c for p in (x, "".join(a[1:] + a[:1]), "".join(a[-1:] + a[:-1])) if (c := _near(p, y)) is not None]
    if costs:
        return min(costs)
    if len(a) == len(b) > 1:
        left = list(b)
        total = 0.0
        for w in sorted(a, key=len, reverse=True):
            fits = [(0.1 if len(w) == 1 or w == skeleton(v) else edits(w, v, 2) / len(v), v) for v in left if len(w) == 1 and v[0] == w or w == skeleton(v) or edits(w, v, 2) <= min(2, max(1, len(v) // 4))]
            if not fits:
                break
            c, v = min(fits)
            left.remove(v)
            total += c
        else:
            if any(len(w) > 2 for w in a):
                return total / len(a) + 0.02
    if len(a) == 1 and len(b) > 1 and len(b[-1]) >= 5 and edits(a[0], b[-1], 1) <= 1:
        return 0.15 + edits(a[0], b[-1], 1) / len(y)
    sx, sy = skeleton(x), skeleton(y)
    if len(sy) >= 4 and len(x) <= len(sy) + 1 and edits(sx, sy, 1) <= min(1, len(sy) // 6):
        return 0.2
    if len(x) >= 6 and len(x) >= 0.6 * len(y) and edits(x, y[: len(x)], 1) <= 1:
        return 0.2
    return None


@lru_cache(100_000)
def _credit(s: str, comma_parts: bool) -> list[list[str]]:
    """The names of a credit as lists of words; comma_parts: a comma parts names, else it stands before a given name."""
    t = re.sub(r",\s*the\b", " ", re.sub(r"(?<!^)\b(\w)\.", r"\1 ", fold_text(s)))
    t = " ".join("feat" if len(w) >= 6 and edits(w, "featuring", 3) <= 3 else "with" if len(w) in (4, 5) and edits(w, "with", 1) <= 1 else w for w in t.split())
    parts = []
    for p in JOINS.split(t):
        if "," in p and not comma_parts and p.count(",") == 1:
            last, first = p.split(",")
            parts.append(_plain(f"{first} {last}").split())
        else:
            parts += [_plain(q).split() for q in p.split(",")]
    return [p for p in parts if p]


def artist_cost(typed: str, known: str) -> float | None:
    """How far a typed credit is from a known one; names after the first may be left out or come in any order."""
    b = _credit(known, True)
    options = []
    for comma in {False, "," in typed}:
        a = _credit(typed, comma)
        if not a or not b:
            continue
        whole = _name_cost([w for p in a for w in p], [w for p in b for w in p])
        if whole is not None:
            options.append(whole)
        main = [c for p in a if (c := _name_cost(p, b[0])) is not None]
        if main and len(a) == 1:
            options.append(min(main) + (0.01 if len(b) > 1 else 0.0))
        elif main and all(any(_name_cost(p, q) is not None for q in b) for p in a):
            options.append(min(main) + 0.005 * abs(len(b) - len(a)))
    return min(options) if options else None


def entry_cost(song: str, artist: str, title: str, credit: str) -> float | None:
    """Cost of an entry against a recording, also with song and artist in each other's place; None if either doesn't fit."""
    best = None
    for s, a in ((song, artist), (artist, song)):
        t = title_cost(s, title)
        c = artist_cost(a, credit) if t is not None else None
        if t is not None and c is not None and (best is None or t + c < best):
            best = t + c
    return best


def _jaccard(song: str, artist: str, title: str, credits: Iterable[str]) -> float:
    """The highest Jaccard similarity of an entry's trigrams with those of the title and any of the credits."""
    a = set(_grams([song], [artist])[0])
    sets = [set(_grams([title], [c])[0]) for c in credits]
    return max(len(a & b) / max(1, len(a | b)) for b in sets)


def map_entries(entries: DataFrame, catalogue: DataFrame, at_least: tuple[float, ...] = (0.6, 0.3), bones_at_least: float = 0.25) -> DataFrame:
    """(entry_id, recording_id, jaccard, cost): for each row of `entries` the recording of `catalogue` meant, or 'NONE'.

    Candidates come from prefix-filter set-similarity joins of character trigrams over song and
    artist together (so places may be changed), first at the highest threshold; entries for which no candidate fits go on to
    the next, and last to a join on trigrams of the consonants, since dropped vowels beside an
    initial, a slip or a surname alone leave few of the former. Each
    recording is also under its credit's first name, since guests may be left out.
    A candidate fits if title and credit both do (typing errors word by word, initials,
    'Last, First', dropped vowels or ends, version marks). Of those that fit the one with the highest exact Jaccard
    similarity of the character trigrams is kept; ties go to the least cost of the differences, then the
    smaller recording_id. An entry that has a fit at one threshold can have no better one below it, so the
    stages give what the lowest threshold alone would. A recording that fits but is below both
    last thresholds is not found.

    Cases: a null or blank song or artist gives 'NONE'; null titles or credits of the catalogue
    match nothing; repeated entries each get their row, equal texts are matched once; an empty
    catalogue gives 'NONE' everywhere; very long texts are compared whole; other columns are left out.

    Plan: all work is on distinct (song, artist) texts; popular entries are joined back at the
    end. The catalogue may grow: its prefixes are broadcast only if Spark finds them small.
    """
    given = entries.select("entry_id", F.trim(F.coalesce("song", F.lit(""))).alias("song"), F.trim(F.coalesce("artist", F.lit(""))).alias("artist"))
    distinct = given.filter((F.length("song") > 0) & (F.length("artist") > 0)).select("song", "artist").distinct()
    distinct = cut(distinct.select(F.struct(F.xxhash64("song", "artist").alias("id1"), F.xxhash64("artist", "song", F.lit(1)).alias("id2")).alias("id"), "song", "artist"))
    known = catalogue.select("recording_id", "title", "artist_credit").filter("recording_id is not null and title is not null and artist_credit is not null").distinct()
    alone = F.split(F.regexp_replace("artist_credit", GUEST, ""), r"\s*[&;/]\s*|,\s+")[0]
    known = cut(known.withColumn("forms", F.array_distinct(F.array(F.col("artist_credit"), alone))))
    formed = known.select("recording_id", "title", F.posexplode("forms").alias("form", "credit"))
    stages = [(grams, t, None) for t in at_least] + [(bones, bones_at_least, at_least[-1])]
    found, left = [], distinct
    for tokens, t, seen in stages:
        have = cut(left.select("id", tokens(F.col("song"), F.col("artist")).alias("tokens")).filter(F.size("tokens") > 0))
        names = formed.select(F.struct("recording_id", "form").alias("id"), tokens(F.col("title"), F.col("credit")).alias("tokens")).filter(F.size("tokens") > 0)
        pairs = similarity_pairs(have, names, t).groupBy(F.col("l").alias("id"), F.col("r.recording_id").alias("recording_id")).agg(F.max("jaccard").alias("jaccard"))
        best = cut(best_fit(pairs.join(left, "id").join(known, "recording_id"), seen))
        found.append(best)
        left = cut(left.join(best.select("id"), "id", "left_anti"))
    best = reduce(DataFrame.unionByName, found).drop("id")
    out = given.join(best, ["song", "artist"], "left")
    return out.select("entry_id", F.coalesce("recording_id", F.lit(NONE)).alias("recording_id"), "jaccard", "cost")


def best_fit(pairs: DataFrame, seen: float | None) -> DataFrame:
    """id, song, artist and of its candidates the one that fits with the highest Jaccard similarity: recording_id, jaccard, cost.

    seen: the similarities given are not of character trigrams, which are computed here; pairs that reach `seen` in these were tried before.
    """

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            if seen is not None:
                p["jaccard"] = [_jaccard(*x) for x in zip(p["song"], p["artist"], p["title"], p["forms"])]
                p = p[p["jaccard"] < seen]
            cost = [entry_cost(*x) for x in zip(p["song"], p["artist"], p["title"], p["artist_credit"])]
            p = p.assign(cost=pd.Series(cost, index=p.index, dtype=float))
            yield p.loc[p["cost"].notna(), ["id1", "id2", "song", "artist", "recording_id", "jaccard", "cost"]]

    rows = pairs.select("id.id1", "id.id2", "song", "artist", "recording_id", "title", "artist_credit", "forms", "jaccard")
    fits = rows.mapInPandas(fit, "id1 bigint, id2 bigint, song string, artist string, recording_id string, jaccard double, cost double")
    best = fits.groupBy(F.struct("id1", "id2").alias("id")).agg(F.min(F.struct((-F.col("jaccard")).alias("far"), "cost", "recording_id", "song", "artist")).alias("b"))
    return best.select("id", "b.song", "b.artist", "b.recording_id", (-F.col("b.far")).alias("jaccard"), "b.cost")
