"""Reconstruction, ordering, merging, standard spellings and resolving."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartweave.functions.similarity import indel_ratio
from chartweave.operators import cluster, counts, merge, ordering, resolve, rows
from chartweave.schema import RAW_COLUMNS, WORDS


def words(spark, data):
    return spark.createDataFrame([(f, h, i, t, x - 0.001, y - 0.002, x + 0.001, y + 0.002) for i, (f, h, t, x, y) in enumerate(data)], WORDS)


def test_chained_rows(spark):
    w = words(spark, [("f", None, "a", 0.1, 0.10), ("f", None, "b", 0.1, 0.115), ("f", None, "c", 0.1, 0.13), ("f", None, "d", 0.1, 0.16), ("g", None, "e", 0.1, 0.5)])
    y = (F.col("y0") + F.col("y1")) / 2
    got = rows.detect_rows(w, "file_name", y, F.col("ord"), rows.tolerance(F.col("image_height")))
    assert {r["text"]: r["row_id"] for r in got.collect()} == {"a": 0, "b": 0, "c": 0, "d": 1, "e": 0}


def test_reconstruction(spark):
    head = ("ocr_table_2025-08-10_1", None, "Rank", 0.03, 0.1)
    name = head[0]
    w = words(spark, [head, (name, None, "1", 0.021, 0.2), (name, None, "9", 0.05, 0.2), (name, None, "out", 0.02, 0.2), (name, None, "off", 0.974, 0.2), (name, None, "Song", 0.2, 0.195), (name, None, "Two", 0.15, 0.196), (name, None, "Act", 0.2, 0.21), ("empty_row", None, "h", 0.03, 0.1)])
    got = rows.reconstruct_table(w).collect()
    assert len(got) == 1
    r = got[0].asDict()
    assert (r["chart_date"], r["rank"], r["song"], r["artist"], r["pos"]) == ("08/10/25", "9", "Song Two", "Act", 0) and r["units"] == ""
    assert rows.reconstruct_table(words(spark, [head]).limit(0)).count() == 0


def test_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.021, 0.067, 0.9739, 0.974)], "x double")
    assert [r[0] for r in df.select(rows.bucket(F.col("x"), rows.COLUMN_EDGES)).collect()] == [None, 0, 1, 13, None]
    fixed = rows.fixed_rows(words(spark, [("f", None, "a", 0.1, 0.03), ("f", None, "b", 0.1, 0.99)]), (F.col("y0") + F.col("y1")) / 2)
    assert [(r["text"], r["row_id"]) for r in fixed.collect()] == [("a", 0)]
    assert len(rows.even_edges(words(spark, [("f", None, "a", 0.1, 0.1), ("f", None, "b", 0.8, 0.1)])).first()["edges"]) == 15


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(1, 5))), max_size=25))
def test_places_are_kept(spark, data):
    df = spark.createDataFrame([(g, i, r) for i, (g, r) in enumerate(data)], "g int, pos int, rank int")
    got = ordering.sort_keeping_places(df, ["g"], "rank", "pos").collect()
    for g in {x[0] for x in data}:
        own = sorted((r for r in got if r["g"] == g), key=lambda r: r["out_pos"])
        assert sorted(r["pos"] for r in own) == [r["out_pos"] for r in own]
        assert all(r["pos"] == r["out_pos"] for r in own if r["rank"] is None)
        ranked = [(r["rank"], r["pos"]) for r in own if r["rank"] is not None]
        assert ranked == sorted(ranked)


def test_merge(spark):
    t = spark.createDataFrame([(1, "a", 0, "08/25/23", "2"), (2, "a", 1, "08/25/23", "x"), (3, "b", 0, "08/25/23", "1"), (4, "b", 1, "bad", "1"), (5, "b", 2, "08/26/23", None)], "raw_id long, src_file string, pos long, chart_date string, rank string")
    got = {r["raw_id"]: (str(r["date"]), r["out_pos"]) for r in merge.merge_charts(t).collect()}
    assert got == {1: ("2023-08-25", 2), 2: ("2023-08-25", 1), 3: ("2023-08-25", 0), 5: ("2023-08-26", 0)}
    assert merge.merge_charts(t, keep_undated=True).count() == 5
    bad = t.withColumn("chart_date", F.lit("?"))
    assert merge.merge_charts(bad).count() == 5 and merge.merge_charts(t.limit(0)).count() == 0
    dashed = t.withColumn("chart_date", F.lit("25-08-23"))
    assert merge.unify_date_text(dashed, order="raw_id").first()["chart_date"] == "25/08/23".replace("25/08", "08/25")
    assert merge.date_format_of(dashed).first()["form"] == "d-m-y"
    assert merge.rename_template(spark.createDataFrame([(1, "x")], "`Weeks_On_Chart` int, ` Sales ` string")).columns == ["woc", "sales"]


def test_cell_chain(spark):
    base = {c: "" for c in RAW_COLUMNS} | {"song": "7 Rings (Live)", "artist": "Á & B ft. C", "change": "", "rank": "l", "sales": "1.2K", "points": "1.2K"}
    df = spark.createDataFrame([tuple(base[c] for c in RAW_COLUMNS)], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    r = merge.normalize_cells(merge.repair_cells(df)).first()
    assert (r["rank"], r["sales"], r["points"], r["song"], r["artist"], r["change"]) == ("1", "1200", "1.2K", "rings live", "a and b feat.. c", "+7")


def greedy(values, threshold):
    lead = {}
    for i, v in enumerate(values):
        lead[i] = next((j for j in range(i) if lead[j] == j and indel_ratio(values[j], v) >= threshold), i)
    return lead


@pytest.mark.parametrize("seed", range(3))
def test_clusters_as_one_pass(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdef") for _ in range(rng.randint(3, 9))) for _ in range(8)]
    values = list(dict.fromkeys("".join(c for c in rng.choice(base) if rng.random() > 0.12) + rng.choice(["", "x"]) for _ in range(40)))
    df = spark.createDataFrame(list(enumerate(values)), "id long, value string")
    want = greedy(values, 80)
    got = {r["id"]: r["leader"] for r in cluster.leaders(cluster.similar_pairs(df, 80, []), []).collect()}
    assert {i: got.get(i, i) for i in range(len(values))} == want


def test_standard_spellings(spark):
    data = [("Velvet Antimony", "A"), ("Velvet Antimony", "A"), ("Velvet Antymony", "A"), ("", "B"), (None, "B"), ("Other", "Somg One"), ("Other", "Song One"), ("Other", "Song One")]
    df = spark.createDataFrame([(i, a, s) for i, (a, s) in enumerate(data)], "pos long, artist string, song string")
    out = cluster.standardize(df)
    got = {r["pos"]: (r["artist"], r["song"]) for r in out.collect()}
    assert len(got) == len(data) and got[2] == ("Velvet Antimony", "A") and got[5] == ("Other", "Song One") and got[3] == ("", "B") and got[4] == (None, "B")
    assert cluster.standardize(df.limit(0)).count() == 0
    assert counts.standardization_summary(df, out).first()["pairs_after"] <= 5


def answer(key, song, artist, recs):
    return (key, song, artist, [(i, t, [((n,), None) for n in c]) for i, t, c in recs])


ANSWERS = "combo_hash string, song string, artist string, recordings array<struct<id:string,title:string,`artist-credit`:array<struct<artist:struct<name:string>,literal:string>>>>"


def test_resolving(spark):
    df = spark.createDataFrame(
        [
            answer("k1", "The Song", "Act", [("1", "the song", ["Act"]), ("2", "The Song", ["Act"])]),
            answer("k2", "Some Song", "Act One", [("3", "Quite Other", ["Nobody"])]),
            answer("k3", "Empty", "Act", []),
            answer("k4", "No", "Credit", [("4", "No", []), ("5", None, ["x"])]),
        ],
        ANSWERS,
    )
    got = {r["combo_hash"]: r for r in resolve.resolve_answers(df).collect()}
    assert set(got) == {"k1", "k2"} and got["k1"]["c_id"] == "1" and got["k1"]["accepted"] and not got["k2"]["accepted"] and got["k2"]["reasons"] == ["song", "artist", "combined"]
    assert resolve.resolve_strict(df).filter("accepted").count() == 1
    sweep = {r["threshold"]: r["accepted"] for r in resolve.threshold_sweep(resolve.best_candidate(resolve.score_candidates(resolve.candidates(df)), "combo_hash"), [0, 101]).collect()}
    assert sweep == {0.0: 1, 101.0: 0}
    charts = spark.createDataFrame([("the song ", "act"), ("x", "y"), (None, None)], "song string, artist string")
    hashed = resolve.resolve_answers(df.withColumn("combo_hash", F.md5(F.lit("the song|act"))).filter("song = 'The Song'"))
    assert [(r["song"], r["artist"], r["mbid"]) for r in resolve.apply_names(charts, hashed, mbid=True).collect() if r["mbid"]] == [("the song", "Act", "1")]


def test_early_stop(spark):
    recs = [(str(i), "other thing" if i < 10 else "The Song", ["Act"]) for i in range(14)] + [("z", "The Song", ["Act"])]
    scored = resolve.score_candidates(resolve.candidates(spark.createDataFrame([answer("k", "The Song", "Act", recs)], ANSWERS)))
    assert resolve.stop_early(scored, "combo_hash").agg(F.max("idx")).first()[0] == 10


def test_ladder(spark):
    df = spark.createDataFrame([("A (x)", "B & C")], "s string, a string")
    q = df.select(resolve.search_ladder(F.col("s"), F.col("a"))).first()[0]
    assert len(q) == 8 and q[0] == "recording:A AND artist:B \\& C" and q[4] == 'recording:"A"'
    assert df.select(resolve.search_query(F.col("s"), F.col("a"))).first()[0] == 'recording:"A" AND artist:"B \\& C"'
    t = spark.createDataFrame([("k", n, *answer("k", "The Song", "Act", r)[1:]) for n, r in ((1, []), (2, [("1", "Nothing alike", ["Zzz"])]), (5, [("2", "The Song", ["Act"])]), (8, [("3", "x", ["y"])]))], ANSWERS.replace("combo_hash string,", "combo_hash string, strategy int,"))
    assert resolve.choose_answers(t).first()["strategy"] == 5
