"""Scalar rules against tables of cases worked out by hand."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from chartweave.functions import cells, dates, keys, numeric, text
from chartweave.functions import similarity as sim


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(function(F.col("v")), "i").orderBy("i").collect()]


NUMBERS = {
    "1.2K": "1200", "2.5M": "2500000", "8.2M": "8199999", "16.4M": "16399999", "5,500": "5500", "lm": "1000000", "Ik": "1000", "OS": "05", "45%": "45", "-5": "5",
    "12a": "12", "abc": "abc", "": "", None: "", "  ": "", "12.5x": "12.5", "k": "k", "1e3k": "1000000", "99999999999999999999M": "99999999999999999999M",
}
CHANGES = {"NEW": "NEW", "new": "NEW", "+2": "+2", "-3": "-3", "5": "+5", "up 4": "+4", "down 4": "-4", "I": "+1", "=": "", None: "", " ": "", "-x7": "-7"}


def test_numbers(spark):
    assert apply(spark, numeric.repair_number, list(NUMBERS)) == list(NUMBERS.values())


def test_changes(spark):
    assert apply(spark, numeric.repair_change, list(CHANGES)) == list(CHANGES.values())


def test_rank(spark):
    assert apply(spark, numeric.rank_number, ["7", " 7 ", "7.0", "", None, "x", "0", "99999999999"]) == [7, 7, None, None, None, None, 0, None]


def test_texts(spark):
    assert apply(spark, text.normalize_text, ["==Été  [Live]", None, "", "«A» „B‚ it's", "x y"]) == ["ete live", "", "", "a b it's", "x y"]
    assert apply(spark, text.normalize_credit, ["A ft. B", "a feat. b", "A & B", "Song (Radio  Edit)", None, "A & B (live at X) c"]) == ["A feat.. B", "a feat.. b", "A and B", "Song", None, "A and B c"]
    assert apply(spark, text.search_text, ["A (x) [y] b feat. C", "a+b:c", None]) == ["A b", "a\\+b\\:c", ""]
    assert apply(spark, text.comparison_text, ["It's (x) ok! ft. me", "é-x"]) == ["Its ok", "éx"]


def test_split_change(spark):
    df = spark.createDataFrame([("7 rings", ""), ("-3 x", None), ("0 y", " "), ("7 rings", "+1"), ("rings", ""), (None, ""), ("12", "")], "t string, c string")
    s, c = text.split_change(F.col("t"), F.col("c"))
    assert [tuple(r) for r in df.select(s, c).collect()] == [("rings", "+7"), ("x", "-3"), ("y", "0"), ("7 rings", "+1"), ("rings", ""), (None, ""), ("12", "")]


def test_filters(spark):
    df = spark.createDataFrame([("the weekend", "x y"), ("Song", "A"), ("Song", "123"), ("Song", "An Act"), (" ", "a"), (None, "a")], "song string, artist string")
    got = df.select(F.coalesce(text.likely_song(F.col("song"), F.col("artist")), F.lit(False)), text.valid_pair(F.col("song"), F.col("artist"))).collect()
    assert [tuple(r) for r in got] == [(False, True), (False, True), (False, True), (True, True), (False, False), (False, False)]


def test_dates(spark):
    assert apply(spark, dates.file_date, ["ocr_table_2025-08-10_1.csv", "x.csv"]) == ["08/10/25", ""]
    d = [str(x) if x else None for x in apply(spark, lambda c: dates.parse_date(c, "m/d/y"), ["08/25/23", "13/01/23", "1/2/75", None, "08-25-23"])]
    assert d == ["2023-08-25", None, "1975-01-02", None, None]
    assert [str(x) if x else None for x in apply(spark, dates.announced_date, ["The chart dated August 23rd, 2025!", "none", None, "chart dated Smarch 1st, 2025"])] == ["2025-08-23", None, None, None]
    assert [str(x) if x else None for x in apply(spark, dates.posted_at, ["Fri Oct 27 08:25:09 +0200 2023", "yesterday", None])] == ["2023-10-27 08:25:09", None, None]
    assert [str(x) if x else None for x in apply(spark, cells.day_first_date, ["13-10-23", " 5.1.99", "28 - 03 - 25", "31_02_24", "x", None])] == ["2023-10-13", "1999-01-05", "2025-03-28", None, None, None]


@pytest.mark.parametrize("v, n", [("5", 5), ("#5", 5), (" 5.", 5), ('"5"', 5), ("'5", 5), ("5.0", 5), (" 5", 5), ("-5", None), ("5-", None), ("5.5", None), ("0", None), ("101", None), ("x5", None), ("", None), (None, None), ("100", 100), ("99999999999", None)])
def test_whole_number(spark, v, n):
    assert apply(spark, lambda c: cells.whole_number(c, 1, 100), [v]) == [n]


def test_hashes(spark):
    df = spark.createDataFrame([("Ab", " C "), ("ab", "c"), (None, "c")], "s string, a string")
    h = [r[0] for r in df.select(keys.combo_hash(F.col("s"), F.col("a"))).collect()]
    assert h[0] == h[1] != h[2]
    bags = apply(spark, keys.bag_hash, ["abc", "cab", "abcc", "", None, "é"])
    assert bags[0] == bags[1] != bags[2] and bags[3] == bags[4] == 0 and len(set(bags)) == 4
    assert apply(spark, keys.names_of, ["B c & a", "A; b/c", "x / Y", "a/b", "Z feat. Q", "one, two", None, "b//a"]) == ["a\x1fbc", "a\x1fbc", "x\x1fy", "a\x1fb", "q\x1fz", "one\x1ftwo", None, "a\x1fb"]


def test_forms():
    assert keys.in_some_order(["ab", "a", "ba"], "abbaa") and keys.in_some_order(["ab", "a", "ba"], "aabba") and not keys.in_some_order(["ab", "ba"], "aabb") and not keys.in_some_order(["a"], "aa")
    assert not keys.in_some_order(["a" * i for i in range(1, 9)], "a" * 35 + "b") and keys.in_some_order(["a"] * 3000 + ["ab"] * 500, "ab" * 500 + "a" * 3000)

    def form(song, artist):
        plain = lambda x: "".join(re.findall(r"[a-z0-9]+", x.lower()))
        names = lambda x: "\x1f".join(sorted(plain(n) for n in re.split("[&,;]", x)))
        return plain(song), plain(artist), names(song), names(artist)

    forms = [form(*x) for x in [("A Tune", "Dario Latuck & Pifax"), ("a tune", "Pifax, Dario Latuck"), ("Dario Latuck Pifax", "ATune"), ("A Tune", "PIFAX dario latuck"), ("Tune A", "Dario Latuck & Pifax"), ("A Tune", "Latuck Pifax Dario"), ("Sum 41 & 3", "x"), ("3, Sum 41", "X"), ("Sum 14 & 3", "x")]]
    assert keys.parts_of(forms) == [0, 0, 0, 0, 4, 5, 6, 6, 8] and keys.parts_of(forms[:1]) == [0] and keys.parts_of([]) == []


def test_similarity(spark):
    assert round(sim.indel_ratio("kitten", "sitting"), 3) == 61.538 and sim.indel_ratio("", "") == 100 and sim.lcs_length("abcbdab", "bdcaba") == 4
    assert sim.partial_ratio("abc", "xxabcxx") == 100 and sim.token_sort_ratio("b a", "a b") == 100 and sim.token_set_ratio("a b", "b a c") == 100
    df = spark.createDataFrame([("The Song", "the song"), ("Song (x)", "Song"), ("abc", "abd"), ("", "x"), (None, "x")], "a string, b string")
    for f in (sim.enhanced_similarity, sim.quick_similarity, sim.blended_similarity):
        ab, ba = ([r[0] for r in df.select(f(F.col(x), F.col(y))).collect()] for x, y in ("ab", "ba"))
        assert ab[0] == 100 and ab[1] == 95 and all(v is None or 0 <= v <= 100 for v in ab) and ab == ba
