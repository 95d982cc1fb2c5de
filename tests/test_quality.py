"""Filling, loading, units and spikes on small cases, against plain restatements."""

from __future__ import annotations

import csv
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartweave.operators import fill, records, spikes, units
from chartweave.plans.core_queries import p7_rule

CHART = "row_id long, market string, src_file string, pos long, chart_date string, rank string, change string, song string, artist string, points string, peak string, weeks_on_chart string, sales string, streams string, loaded_at string"


def chart(spark, rows):
    base = {"market": "M", "src_file": "f", "pos": 0, "chart_date": "06-10-23", "rank": "1", "change": "", "song": "S", "artist": "A", "points": "100", "peak": "1", "weeks_on_chart": "1", "sales": "1,000", "streams": "10,000", "loaded_at": None}
    names = [c.split()[0] for c in CHART.split(", ")]
    return spark.createDataFrame([tuple(({"row_id": i} | base | r)[n] for n in names) for i, r in enumerate(rows)], CHART)


def filled(spark, rows):
    return {r["row_id"]: r for r in fill.fill_chart_gaps(chart(spark, rows)).collect()}


def test_fill(spark):
    got = filled(
        spark,
        [
            {"chart_date": "06-10-23", "rank": "2", "weeks_on_chart": "3", "peak": "2"},
            {"chart_date": "13-10-23", "rank": "NA", "weeks_on_chart": None, "peak": "-"},
            {"chart_date": "20-10-23", "rank": "6.0", "weeks_on_chart": "5", "peak": "2"},
            {"chart_date": "27-10-23", "rank": "-1", "weeks_on_chart": "", "peak": "0"},
            {"chart_date": "20-10-23", "rank": "?", "weeks_on_chart": "x"},
            {"chart_date": "nope", "rank": "", "song": None, "artist": None},
            {"chart_date": "20-10-23", "song": " ", "artist": None, "rank": ""},
            {"chart_date": "06-10-23", "market": "N", "rank": "", "peak": "", "weeks_on_chart": ""},
        ],
    )
    f = lambda i, c: tuple(got[i][f"{c}_{x}"] for x in ("filled", "method", "distance"))
    assert f(0, "rank") == (2, "observed", None) and f(2, "rank") == (6, "observed", None)
    assert f(1, "rank") == (4, "interpolated", 7) and f(1, "weeks_on_chart") == (4, "interpolated", 7) and f(1, "peak") == (2, "carried", 7)
    assert f(3, "rank") == (6, "carried", 7) and f(3, "weeks_on_chart") == (6, "carried", 7)
    assert f(4, "rank") == (6, "same_week", 0) and f(4, "weeks_on_chart") == (5, "same_week", 0)
    assert f(5, "rank") == (None, "none", None) and f(6, "rank") == (6, "chart_median", None) and f(7, "peak") == (None, "none", None)


def test_fill_edges(spark):
    df = chart(spark, [{}, {}, {"row_id": 0}]).withColumn("rank_filled", F.lit("clash"))
    out = fill.fill_chart_gaps(df)
    assert out.count() == 3 and out.columns.count("rank_filled") == 1 and dict(out.dtypes)["rank_filled"] == "int"
    assert fill.fill_chart_gaps(df.limit(0)).count() == 0 and fill.missing_cells(out).count() == 0
    far = filled(spark, [{"chart_date": "06-10-23"}, {"chart_date": "06-10-24", "rank": ""}])
    assert far[1]["rank_method"] == "none"
    long = filled(spark, [{"song": "x" * 50_000, "rank": ""}, {"song": "X" * 50_000, "rank": "3"}])
    assert long[0]["rank_filled"] == 3


def test_fill_tells_anagrams_apart(spark):
    rows = [
        {"song": "Listen", "rank": "5"}, {"song": "Silent", "chart_date": "13-10-23", "rank": "52", "weeks_on_chart": "22"}, {"song": "Listen", "chart_date": "13-10-23", "rank": "", "weeks_on_chart": ""}, {"song": "A", "artist": "LISTEN!", "chart_date": "13-10-23", "rank": "x", "weeks_on_chart": None},
        {"song": "Sum 13", "rank": "7"}, {"song": "Sum 31", "rank": "", "chart_date": "13-10-23"},
    ]
    got = filled(spark, rows)
    assert (got[2]["rank_filled"], got[2]["rank_method"], got[2]["weeks_on_chart_filled"]) == (5, "carried", 2)
    assert got[3]["rank_filled"] == 5 and got[5]["rank_method"] == "chart_median"


def test_filled_peak_is_no_worse_than_the_rank(spark):
    got = filled(spark, [{"rank": "9", "peak": "7"}, {"chart_date": "13-10-23", "rank": "3", "peak": ""}, {"song": "T", "rank": "2", "peak": ""}])
    assert (got[1]["peak_filled"], got[1]["peak_method"]) == (3, "carried") and (got[2]["peak_filled"], got[2]["peak_method"]) == (2, "chart_median")


def by_hand(line, width=16):
    s = (line or "").removeprefix("﻿").removesuffix("\r")
    if not s.strip():
        return "blank"
    fields, i = 0, 0
    while True:
        if s[i : i + 1] == '"':
            i += 1
            while True:
                j = s.find('"', i)
                if j < 0:
                    return "quoting"
                if s[j + 1 : j + 2] == '"':
                    i = j + 2
                    continue
                i = j + 1
                break
            if i < len(s) and s[i] != ",":
                return "quoting"
        else:
            j = s.find(",", i)
            part = s[i : len(s) if j < 0 else j]
            if '"' in part:
                return "quoting"
            i += len(part)
        fields += 1
        if i >= len(s):
            return None if fields == width else "columns"
        i += 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet='a,"\n é', max_size=30)), max_size=20), st.sampled_from([1, 2, 3]))
def test_tokenizer(lines, width):
    assert records.tokenize(lines, width)[0] == [by_hand(x, width) for x in lines]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='ab,"\n é', max_size=600), min_size=1, max_size=4), max_size=5))
def test_tokenizer_fields(rows):
    import io

    lines = []
    for r in rows:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(r)
        lines.append(out.getvalue())
    for line, r in zip(lines, rows):
        reasons, _, fields = records.tokenize([line], len(r))
        assert reasons == [None] and fields == [r]


def test_load(spark):
    good = '10-04-26,5,new,"A, ""b""\nc",X,61,30,3,73,"4,500",5,"21,200,000",100,"24,200,000",15,"145,833"'
    bad = lambda a, b: good.replace(a, b, 1)
    lines = [
        ("﻿Chart_Date,Rank" + ",x" * 14, "-"), ("", "-"), (None, "-"), (" \r", "-"), ('"chart_date","RANK"', "-"), (good, None), (good + "\r", None), (good + ",", "columns"), (good[:-3], "quoting"),
        (bad(",5,", ", 5 ,"), None), (bad(",5,", ",0,"), "value"), (bad(",5,", ",5.0,"), "value"), (bad(",new,", ",+12,"), None), (bad(",new,", ",+-1,"), "value"), (bad(",new,", ",123,"), "value"), (bad(",new,", ",, "), "quoting"),
        (bad(",new,", ', "new",'), "quoting"), ("x" * 200_000, "columns"), (bad("A,", "A" * 100_000 + ","), None),
    ]
    df = spark.createDataFrame([(i, "f", i, x) for i, (x, _) in enumerate(lines)], "line_id long, src_file string, line_no long, raw_line string")
    got = {r["line_id"]: r for r in records.load_records(df.withColumn("reason", F.lit("clash"))).collect()}
    assert {i: got[i]["reason"] if i in got else "-" for i in range(len(lines))} == {i: r for i, (_, r) in enumerate(lines)}
    r = got[5]
    assert (str(r["chart_date"]), r["rank"], r["change"], r["song"], r["sales"]) == ("2026-04-10", 5, "NEW", 'A, "b"\nc', 4500.0)
    assert got[10]["offset"] == 1 and got[13]["offset"] == 2 and got[16]["offset"] == 12 and got[8]["rank"] is None
    assert records.load_records(df.limit(0)).count() == 0


CELLS = {
    "450K": (450000, "cell"), "12.5M": (12500000, "cell"), "18,165,400": (18165400, None), "2\xa0074": (2074, None), "1'184": (1184, None), "25.271.200": (25271200, None), "11,8 Mio": (11800000, "cell"), "18.08万": (180800, "cell"),
    "K 171.88": (171880, "cell"), "5,841 sold": (5841, None), "13289k plays": (13289000, "cell"), "16.63 million streams": (16630000, "cell"), "2.3259 crore": (23259000, "cell"), "8.35 hundred": (835, "cell"), "1.826x1000": (1826, "cell"),
    "18402.7 (000s)": (18402700, "cell"), "0.0069bn": (6900000, "cell"), "70.73 lakh": (7073000, "cell"), " -   ": (None, None), None: (None, None), "": (None, None), "145,466 u.": (145466, None), "3.214m": (3214000, "cell"),
}


def test_units(spark):
    raw = spark.createDataFrame([(i, "f", c, "7", None, "3") for i, c in enumerate(CELLS)], "raw_id long, src_file string, sales string, streams string, airplay string, units string")
    got = {r["raw_id"]: r for r in units.unify_units(raw, spark.createDataFrame([], "src_file string, caption string")).filter("field = 'sales'").collect()}
    assert {c: (got[i]["count"], got[i]["told_in"]) for i, c in enumerate(CELLS)} == CELLS


def test_captions(spark):
    said = {
        "sales, Streams + units / thsd.. Other columns not scaled.": {"sales", "streams", "units"}, "All figures are single counts except Streams & Airplay, which are in x1,000,000.": {"streams", "airplay"},
        "Over 53 million listeners follow this list. Figures as counted.": set(), "Edition 14, see the web page for K-pop extras.": set(), "Based on reports from thousands of stations; full counts.": set(), "Figures in single units.": set(),
        "Note: sales given in 000s": {"sales"}, "Weekly table (Units: hundreds)": {"units"}, "scan ok - airplay & Units printed in units of 1000": {"airplay", "units"}, "streams and airplay in Mio., the rest as full counts.": {"streams", "airplay"}, None: set(), "": set(),
    }
    assert {c: {f for f, _ in units.read_caption(c)} for c in said} == said
    raw = spark.createDataFrame([(1, "f", "5.716", "9,000", "0.5M", "12"), (2, "g", "5,716", "1", "2", "3")], "raw_id long, src_file string, sales string, streams string, airplay string, units string")
    cap = spark.createDataFrame([("f", "Note: sales, airplay + units given in thousands"), ("f", "Note: units given in hundreds"), ("h", "Note: sales given in K")], "src_file string, caption string")
    got = {(r["raw_id"], r["field"]): (r["count"], r["told_in"]) for r in units.unify_units(raw, cap).collect()}
    assert got == {(1, "sales"): (5716, "caption"), (1, "streams"): (9000, None), (1, "airplay"): (500000, "cell"), (1, "units"): (12000, "caption"), (2, "sales"): (5716, None), (2, "streams"): (1, None), (2, "airplay"): (2, None), (2, "units"): (3, None)}
    assert units.unify_units(raw.limit(0), cap).count() == 0


def weeks_of(values, **more):
    import datetime as dt

    day = dt.date(2024, 1, 5)
    return [{"chart_date": (day + dt.timedelta(7 * i)).strftime("%d-%m-%y"), "sales": None if v is None else str(v)} | more for i, v in enumerate(values)]


def market(rng, songs=40, n=12):
    rows = []
    for s in range(songs):
        level = rng.uniform(1000, 5000)
        values = []
        for _ in range(n):
            level *= rng.uniform(0.9, 1.1)
            values.append(round(level))
        rows += weeks_of(values, song=f"song {s}", artist=f"act {s}", points="1" + str(s), streams=None)
    return rows


def test_spikes(spark):
    rng = random.Random(5)
    rows = market(rng)
    n = len(rows)
    cases = [
        (weeks_of([1000, 1050, 9000, 990, 1010], song="spike"), {2}), (weeks_of([1000, 1050, 80, 990, 1010], song="dip"), {2}), (weeks_of([1000, 1010, 3000, 3100, 2900], song="level"), set()),
        (weeks_of([760, 777, 777, 777, 777, 770], song="stuck"), {1, 2, 3, 4}), (weeks_of([760, 777, 777, 777, 770], song="three"), set()), (weeks_of([800, -5, 810, 12.5, 805, 10**12, None, "x"], song="limits"), {1, 3, 5}),
        (weeks_of([1000, 1020, 990, 9000], song="last"), {3}), (weeks_of([700], song="single"), set()),
    ]
    want = set()
    for own, hits in cases:
        want |= {len(rows) + i for i in hits}
        rows += [{"points": "5", "streams": None} | r for r in own]
    twin = next(i for i, r in enumerate(rows) if r.get("song") == "spike" and r["sales"] == "9000")
    rows.append(rows[twin] | {"song": " SPIKE!"})
    want.add(len(rows) - 1)
    rows += [{"chart_date": "bad", "sales": "-1", "points": None, "streams": None}, {"song": None, "artist": None, "sales": "7", "points": None, "streams": None}]
    want.add(len(rows) - 2)
    rows = [r | {"points": None} for r in rows]
    got = spikes.flag_spikes(chart(spark, rows)).collect()
    assert {r["row_id"] for r in got} == want and {r["field"] for r in got} == {"sales"} and n == 480
    assert spikes.flag_spikes(chart(spark, rows).limit(0)).count() == 0
    # blocks of a hot market only spread the work
    plain = {tuple(r) for r in got}
    for n in (100, 37):
        assert {tuple(r) for r in spikes.flag_spikes(chart(spark, rows), block_rows=n).collect()} == plain


def test_the_forest_decides(spark):
    rng = random.Random(8)
    rows = market(rng, 60, 14)
    for k in range(12):
        rows += weeks_of([1000, 1040, round(1020 * (1.22 + 0.005 * k)), 1010, 990], song=f"a little {k}")
        rows += weeks_of([1000, 1040, 5000 + k, 1010, 990], song=f"far out {k}")
    rows = [r | {"points": None, "streams": None} for r in rows]
    with_, without = ({(r["row_id"], r["field"]) for r in spikes.flag_spikes(chart(spark, rows), floor=f).collect()} for f in (True, False))
    assert with_ < without and len(with_) == 12 and len(without) >= 24


def test_copies_of_a_week_are_judged_one_by_one(spark):
    rows = market(random.Random(9), 40, 12) + weeks_of([1000, 1010, 990, 1005, 1000], song="copied")
    week = rows[-3]
    extra = [1000, 1100, 3000, 9000, 50]
    rows += [week | {"sales": str(x)} for x in extra]
    rows = [r | {"points": None, "streams": None} for r in rows]
    got = {r["row_id"] for r in spikes.flag_spikes(chart(spark, rows)).collect()}
    assert got == {len(rows) - 3, len(rows) - 2, len(rows) - 1}


def test_summaries_add_up():
    import numpy as np

    rng = np.random.default_rng(3)
    song = np.repeat(np.arange(300), 10)
    day = np.tile(np.arange(10) * 7 + 19_000, 300)
    w = spikes.week_features(day, song, np.round(np.exp(rng.normal(7, 1, 3000))))
    order = spikes.reading_hash(song, np.zeros(3000, np.int64), day)
    whole = spikes.summarize(w, order)
    cut = [np.flatnonzero(song % 7 == k) for k in range(7)]
    parts = spikes.merge_summaries([spikes.summarize({k: x[i] for k, x in w.items()}, order[i]) for i in cut])
    assert whole.keys() == parts.keys() and all((whole[k] == parts[k]).all() for k in whole)


def rule_of_thumb(spark, folder):
    """The forest against a plain rule: five typical movements beyond the neighbours, or four equal weeks."""
    from tests.oracle import connect

    want = {tuple(r) for r in connect(folder).execute(p7_rule()).fetchall()}
    got = {tuple(r) for r in spikes.flag_spikes(spark.read.parquet(f"{folder}/chart_template.parquet")).select("row_id", "field").collect()}
    return len(got & want) / len(want), len(got & want) / len(got)


def test_spikes_agree_with_a_rule(spark, small):
    recall, precision = rule_of_thumb(spark, small)
    assert recall > 0.95 and precision > 0.95
