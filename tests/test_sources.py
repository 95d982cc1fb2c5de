"""Files, posts and streams."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from chartweave.schema import POSTS, RAW_COLUMNS
from chartweave.sources import files, posts
from chartweave.streaming.resume import append_new, stream_images, windowed_counts


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([tuple(f"{c}{i}" if c != "song" else 'a "q", b' for c in RAW_COLUMNS) for i in range(3)], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    files.write_ordered_csv(df, str(tmp_path / "out"), F.col("rank").desc())
    back = files.read_charts(spark, str(tmp_path / "out"))
    assert [r["rank"] for r in back.orderBy("pos").collect()] == ["rank2", "rank1", "rank0"] and back.first()["song"] == 'a "q", b'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / files.MERGED).write_text(",".join(RAW_COLUMNS) + "\n" + ",".join("x" * 16) + "\n")
    assert files.read_charts(spark, str(tmp_path / "in")).count() == 0


def test_images(spark, tmp_path):
    d = tmp_path / "my charts"
    d.mkdir()
    for n in ("2025-08-10_1.jpg", "2025-08-10_10.jpg", "2025-13-10_1.jpg", "other.jpg", "2025-08-10_1.png"):
        (d / n).write_bytes(b"x")
    got = files.read_images(spark, str(d))
    assert {r["file_name"] for r in got.collect()} == {"2025-08-10_1.jpg", "2025-08-10_10.jpg", "2025-13-10_1.jpg"}
    months = {r["file_name"]: r["month"] for r in files.file_targets(got).collect()}
    assert months["2025-08-10_1.jpg"] == "Aug 25" and months["2025-13-10_1.jpg"] is None
    assert got.select(files.merged_name(F.lit("my charts"))).first()[0] == "my_charts_merged.csv"
    boxes = files.recognize(spark.createDataFrame([("p/a.jpg", b"1"), ("p/b.jpg", b"")], "path string, content binary"), lambda: lambda c: [{"image_height": 10, "text": c.decode(), "x0": 0.0, "y0": 0.0, "x1": 1.0, "y1": 1.0}] if c else 1 / 0)
    assert [(r["file_name"], r["text"]) for r in boxes.collect()] == [("a.jpg", "1")]
    files.write_report(spark.createDataFrame([(1,)], "pairs int"), str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"pairs": 1}


POSTS_ROWS = [
    ("1", "Fri Aug 25 08:25:09 +0000 2023", "chart dated August 26th, 2023", [("photo", "u1"), ("video", "u2"), ("photo", None), ("photo", "u4")]),
    ("2", "Fri Aug 25 09:25:09 +0000 2023", "chart dated August 26th, 2023", [("photo", "u1b")]),
    ("3", "Wed Aug 09 08:25:09 +0000 2023", "old", [("photo", "u5")]),
    ("4", "garbage", None, None), ("5", "Sat Aug 26 08:25:09 +0000 2023", None, [("photo", "u6")]),
]


def test_posts(spark):
    df = spark.createDataFrame(POSTS_ROWS, POSTS)
    got = posts.image_files(df)
    assert sorted((r["id"], r["file_name"]) for r in got.collect()) == [("1", "2023-08-26_1.jpg"), ("1", "2023-08-26_4.jpg"), ("2", "2023-08-26_1.jpg"), ("5", "2023-08-26_1.jpg")]
    present = spark.createDataFrame([("2023-08-26_4.jpg",)], "file_name string")
    assert [(r["id"], r["url"]) for r in posts.new_files(got, present).collect()] == [("1", "u1")]
    assert posts.next_cursor(df).first()["oldest_id"] == "1"


def test_post_source_and_stream(spark, tmp_path):
    path = tmp_path / "posts.jsonl"
    lines = [json.dumps({"id": i, "created_at": c, "full_text": t, "media": m and [{"type": k, "url": u} for k, u in m]}) for i, c, t, m in POSTS_ROWS]
    path.write_text("\n".join(lines[:3]) + "\n")
    posts.register(spark)
    assert spark.read.format("posts").option("path", str(path)).option("page", 2).load().count() == 3
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    run = lambda: stream_images(spark.readStream.format("posts").option("path", str(path)).load(), out, check).awaitTermination()
    run()
    first = spark.read.parquet(out).count()
    path.write_text("\n".join(lines) + "\n")
    run()
    run()
    names = [r["file_name"] for r in spark.read.parquet(out).collect()]
    assert first == 2 and len(names) == len(set(names)) == 2


def test_append_is_repeatable(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    append_new(df, p, "k")
    append_new(df, p, "k")
    assert spark.read.parquet(p).count() == 2


def test_windows(spark, small):
    e = spark.read.parquet(f"{small}/events.parquet")
    assert windowed_counts(e, "ts").agg(F.sum("n")).first()[0] == e.count()


def test_places_in_files(spark, tmp_path):
    from chartweave.schema import RAW_COLUMNS

    (tmp_path / "in").mkdir()
    for name, n in (("b.csv", 3), ("a.csv", 2), ("final_merged_all_dates.csv", 4)):
        lines = [",".join(RAW_COLUMNS)] + [f"d,{i},,{name} {i}" + "," * 12 for i in range(n)]
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
    rows = files.read_charts(spark, str(tmp_path / "in")).orderBy("src_file", "pos").collect()
    assert [(r["src_file"], r["pos"], r["song"]) for r in rows] == [(f, i, f"{f} {i}") for f, n in (("a.csv", 2), ("b.csv", 3)) for i in range(n)]


def test_pipeline(spark, tmp_path):
    import csv
    import glob

    from chartweave.functions.keys import combo_hash
    from chartweave.plans.pipeline import run_pipeline
    from chartweave.schema import RECORDINGS

    (tmp_path / "in").mkdir()
    charts = {"a.csv": [("08/18/23", "2", "+1", "Anti Hero", "Taylor Swift", "450K"), ("08/18/23", "1", "", "3 Flowers", "Miley Cyrus", "1,000")], "b.csv": [("08/25/23", "1", "new", "Anti-Hero", "taylor swift", "8.2M"), ("08/25/23", "", "", "Anti Hero", "Taylor Swift", "-")]}
    for name, rows in charts.items():
        with open(tmp_path / "in" / name, "w", newline="") as f:
            w = csv.writer(f)
            w.writerow(RAW_COLUMNS)
            w.writerows([[d, r, c, s, a, "", "", "", "", x, "", "", "", "", "", ""] for d, r, c, s, a, x in rows])
    rec = [("m1", "Anti Hero", [(("Taylor Swift",), None)])]
    answers = spark.createDataFrame([("anti hero", "taylor swift", rec)], "song string, artist string, recordings " + RECORDINGS.simpleString().replace("artist-credit", "`artist-credit`"))
    answers = answers.withColumn("combo_hash", combo_hash(F.col("song"), F.col("artist")))
    report = run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), answers, mbid=True).first()
    assert (report["rows"], report["pairs_before"], report["pairs_after"], report["accepted"]) == (4, 3, 2, 1)
    (out,) = glob.glob(str(tmp_path / "out" / "*.csv"))
    got = list(csv.DictReader(open(out)))
    assert [(r["chart_date"], r["rank"], r["change"], r["song"], r["artist"], r["sales"], r["mbid"]) for r in got] == [
        ("08/25/23", "1", "NEW", "Anti Hero", "Taylor Swift", "8199999", "m1"), ("08/25/23", "", "", "Anti Hero", "Taylor Swift", "-", "m1"),
        ("08/18/23", "1", "+3", "flowers", "miley cyrus", "1000", ""), ("08/18/23", "2", "+1", "Anti Hero", "Taylor Swift", "450000", "m1"),
    ]
    (tmp_path / "none").mkdir()
    assert run_pipeline(spark, str(tmp_path / "none"), str(tmp_path / "out2")).first()["rows"] == 0
