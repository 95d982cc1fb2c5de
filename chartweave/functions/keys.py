"""Comparison keys: letters-only text, commutative hashes and their verification, combination hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Everything but letters and digits of any script; combining marks stay with their letter.
NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"
MASK60 = (1 << 60) - 1
#: What parts the names of a credit; blanks may be written as other marks.
NAMES_APART = r"\s*[;&,]\s*|[\s_\xA0/.-]feat\.?[\s_\xA0/-]+|[\s\xA0_-]/+[\s\xA0_-]|//+"
#: Stands between names that were joined again.
NAME_END = "\x1f"


def letters(c: Column) -> Column:
    """Letters and digits of `c` in lower case, '' for null. 'ß' equals 'SS'."""
    return F.regexp_replace(F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("ß"), F.lit("ss")), NOT_WORD, "")


def has_letters(c: Column) -> Column:
    """Whether there is a letter or digit at all; false for null."""
    return F.coalesce(c.rlike(r"[\p{L}\p{N}]"), F.lit(False))


def _bag_sums(texts: pa.Array, seed: int) -> np.ndarray:
    """Per text the sum of its bytes' random 60-bit numbers, modulo 2**60; nulls as ''."""
    texts = texts.fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    numbers = np.random.default_rng(seed + 811).integers(0, 1 << 60, 256, dtype=np.uint64)
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(numbers[raw], out=sums[1:])
    return ((sums[at[1:] - at[0]] - sums[at[:-1] - at[0]]) & np.uint64(MASK60)).astype(np.int64)


def bag_hash(text: Column, seed: int = 0) -> Column:
    """Commutative 60-bit hash of the multiset of bytes of `text`; 0 for null and ''.

    Each byte stands for a random number and these are added modulo 2**60, so the order of
    characters doesn't matter but their number does; nothing is sorted. Anagrams share it: who
    groups by it must verify. An Arrow UDF: whole batches are summed at once, several times
    cheaper than a lambda over each character.
    """

    @F.arrow_udf("bigint")
    def bag(texts: pa.Array) -> pa.Array:
        return pa.array(_bag_sums(texts, seed), pa.int64())

    return bag(text)


def record_key(*fields: Column, seed: int = 0) -> Column:
    """bag_hash over the letters of several fields together."""
    return bag_hash(F.concat(*[letters(f) for f in fields]), seed)


def names_of(c: Column) -> Column:
    """The letters of each name of a credit, sorted and joined by NAME_END; null for a text without separators, which is one name.

    A slash parts names only where it stands apart from words or nothing else does.
    """
    t = F.lower(c)
    parts = F.when(t.rlike(NAMES_APART), F.split(t, NAMES_APART)).otherwise(F.split(t, "/"))
    return F.when(t.rlike("[;&,/]|feat"), F.array_join(F.array_sort(F.array_remove(F.transform(parts, letters), "")), NAME_END))


def in_some_order(names: list[str], text: str) -> bool:
    """Whether `text` is all of `names`, one after another in some order."""
    if sum(map(len, names)) != len(text):
        return False
    kinds = sorted(set(names))
    tried = {start := (0, tuple(names.count(k) for k in kinds))}
    todo = [start]
    while todo:
        at, left = todo.pop()
        if at == len(text):
            return True
        for i, k in enumerate(kinds):
            if left[i] and text.startswith(k, at) and (then := (at + len(k), left[:i] + (left[i] - 1,) + left[i + 1 :])) not in tried:
                tried.add(then)
                todo.append(then)
    return False


Form = tuple[str, str, str | None, str | None]  # letters of two fields, then their sorted names


def same_credit(a: str, a_names: str | None, b: str, b_names: str | None) -> bool:
    """Equal letters, or the same names in another order, also where one side's separators are lost."""
    if a == b or a_names and a_names == b_names:
        return True
    return any(n and NAME_END in n and in_some_order(n.split(NAME_END), x) for n, x in ((a_names, b), (b_names, a)))


def same_form(p: Form, q: Form) -> bool:
    """Whether two (song, artist) forms are one record: one field equal by letters and the other as a credit, at either place."""
    (s, a, sn, an), (t, b, tn, bn) = p, q
    return (
        s == t and same_credit(a, an, b, bn) or a == b and same_credit(s, sn, t, tn)
        or s == b and same_credit(a, an, t, tn) or a == t and same_credit(s, sn, b, bn)
    )


def parts_of(forms: list[Form]) -> list[int]:
    """For each form the place of the first form of its record: the closure of same_form.

    Forms are first joined by equal keys, one pass; only the few parts left are compared.
    """
    root = list(range(len(forms)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(i: int, j: int) -> None:
        i, j = sorted((find(i), find(j)))
        root[j] = i

    first: dict[tuple, int] = {}
    forms = [(s, a, sn or None, an or None) for s, a, sn, an in forms]
    for i, (s, a, sn, an) in enumerate(forms):
        for k in (("l", *sorted((s, a))), ("c", s, an or a), ("c", a, sn or s)):
            join(i, first.setdefault(k, i))
    heads = [i for i in range(len(forms)) if find(i) == i]
    if len(heads) > 1:
        kinds: dict[int, dict[Form, int]] = {}
        for i, f in enumerate(forms):
            kinds.setdefault(find(i), {}).setdefault(f, i)
        for n, h in enumerate(heads):
            for g in heads[:n]:
                if find(g) != find(h) and any(same_form(p, q) for p in kinds[h] for q in kinds[g]):
                    join(g, h)
    return [find(i) for i in range(len(forms))]


def combo_hash(song: Column, artist: Column, threshold: Column | None = None) -> Column:
    """md5 of the trimmed lower-case pair, with the threshold as a third part if given."""
    parts = [F.lower(F.trim(F.coalesce(song, F.lit("")))), F.lower(F.trim(F.coalesce(artist, F.lit(""))))]
    if threshold is not None:
        parts.append(threshold.cast("string"))
    return F.md5(F.concat_ws("|", *parts))
