"""Encoding, mixing and residue."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartweave.llm import encode, mix, residue

PATH = encode.tokenizer_path("byte_bpe_50k.tiktoken")


def chunked(text, mean):
    enc = encode.byte_bpe(PATH)
    raw = text.encode()
    points = encode.cut_points(raw, mean)
    chunks = [raw[a:b] for a, b in zip([0, *points], [*points, len(raw)])]
    dirty = [b < len(raw) and not encode.clean_join(raw, b) for b in [*points, len(raw)]]
    ids = [np.array(enc.encode_ordinary(c.decode()), np.uint16) for c in chunks]
    return np.concatenate(encode.repair(enc, [c.decode() for c in chunks], ids, encode.token_lengths(PATH), dirty)).tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "'", " ", "\n", "re", "ll", "12", "é", "中", "  ", "\t", "'s", "!", " ", "🙂", "\r\n", "   \n", "word ", "ß"]), max_size=150), st.sampled_from([16, 64]))
def test_chunks_agree_with_whole(parts, mean):
    text = "".join(parts)
    assert chunked(text, mean) == encode.byte_bpe(PATH).encode_ordinary(text)


def test_borders_follow_content():
    rng = random.Random(3)
    text = "\n".join("".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(400)).encode()
    a, b = encode.cut_points(text, 256), encode.cut_points(b"new first line\n" + text, 256)
    moved = {p + 15 for p in a}
    assert len(moved & set(b)) > 0.9 * len(a) and all(q - p >= 64 for p, q in zip(a, a[1:]))


def test_encode(spark, small):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(encode.tokenizer_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [None, "", "  ", "x", "x", "<|endoftext|>", "long " * 60_000, "z" * 30_000, "same line\n" * 900, "same line\n" * 900 + "end", "\x00퟿ é"]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in encode.encode_corpus(df, PATH).collect()}
    assert got == {i: t.encode(x, add_special_tokens=False).ids if x else [] for i, x in enumerate(texts)}
    twice = encode.encode_corpus(df.unionByName(df), PATH)
    assert twice.count() == 2 * len(texts) and encode.encode_corpus(df.limit(0), PATH).count() == 0
    docs = spark.read.parquet(f"{small}/documents.parquet")
    whole = {r["doc_id"]: t.encode(r["text"] or "", add_special_tokens=False).ids for r in docs.collect()}
    assert {r["doc_id"]: r["ids"] for r in encode.encode_corpus(docs, PATH).collect()} == whole
    assert {r["doc_id"]: r["tokens"] for r in encode.token_counts(docs, PATH).collect()} == {k: len(v) for k, v in whole.items()}


def by_quotients(weights, seats):
    got = [0] * len(weights)
    for _ in range(seats):
        i = max(range(len(weights)), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))
        got[i] += 1
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=9), st.integers(0, 200))
def test_apportionment(weights, seats):
    assert mix.sainte_lague(weights, seats) == by_quotients(weights, seats)


def test_apportionment_edges():
    assert mix.sainte_lague([], 5) == [] and mix.sainte_lague([0, 3], 4) == [0, 4] and mix.sainte_lague([0.0], 4) == [0]


def test_mix(spark):
    rng = random.Random(1)
    docs = [(i, "big" if i % 3 else "small", " word" * rng.randint(5, 60)) for i in range(900)] + [(900, "big", None), (901, "big", ""), (902, None, "a b"), (903, "other", "a b")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("tokens", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 3), ("none", 0.1, 5)], "source string, target_share double, max_repeats int")
    drawn = mix.draw_mix(df, targets, PATH)
    rows = drawn.collect()
    assert all(1 <= r["repeats"] <= {"big": 1, "small": 3}[r["source"]] for r in rows) and len({r["doc_id"] for r in rows}) == len(rows)
    shares = {r["source"]: r for r in mix.mix_shares(drawn, targets).collect()}
    assert abs(shares["big"]["actual_share"] - 5 / 9) < 0.02 and shares["none"]["tokens"] == 0 and shares["none"]["actual_share"] == 0
    assert {r["doc_id"] for r in mix.draw_mix(df, targets, PATH).collect()} == {r["doc_id"] for r in rows}
    sharded = mix.mix_shares(mix.draw_mix(df, targets, PATH, shard_tokens=2000), targets)
    assert abs({r["source"]: r["actual_share"] for r in sharded.collect()}["big"] - 5 / 9) < 0.03
    assert mix.draw_mix(df.limit(0), targets, PATH).count() == 0 and mix.draw_mix(df, targets.limit(0), PATH).count() == 0
    assert mix.mix_shares(mix.draw_mix(df.limit(0), targets, PATH), targets).count() == 3


def test_one_huge_document_does_not_break_the_shares(spark):
    rng = random.Random(2)
    docs = [(i, "ab"[i % 2], " word" * rng.randint(5, 200)) for i in range(600)] + [(600, "a", " word" * 60_000), (601, "a", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    drawn = mix.draw_mix(df, targets, PATH)
    shares = {r["source"]: r for r in mix.mix_shares(drawn, targets).collect()}
    assert abs(shares["a"]["actual_share"] - 0.5) < 0.01 and shares["a"]["due_share"] == 0.5 and drawn.filter("doc_id = 600").count() == 0
    few = {r["source"]: r["actual_share"] for r in mix.mix_shares(mix.draw_mix(df, targets, PATH, shard_tokens=9000, most_shards=3), targets).collect()}
    assert abs(few["a"] - 0.5) < 0.01


@given(st.lists(st.integers(1, 50), max_size=30), st.integers(0, 300))
def test_quota(tokens, quota):
    taken = mix.fill_quota(np.array(tokens, np.int64), quota)
    used = sum(n for n, t in zip(tokens, taken) if t)
    assert used <= quota and all(n > quota - used for n, t in zip(tokens, taken) if not t)


MD = "# %% [markdown]\n{}\n\n# %% In[1]\nx = load('rows')\nx.head()\n"
PROMPT = "# Lab 2\n\n{}\n\nIn [1]:\nprint(1)\n\nOut[1]:\n1"
NB = '{{"cells": [{{"cell_type": "markdown", "metadata": {{}}, "source": ["{}"]}}, {{"cell_type": "code", "source": ["a = 1"], "outputs": []}}], "nbformat": 4}}'
OWN = "We load the table and keep the rows where the delay is above ten."
CASES = [
    (MD.format("# {{ title }}\n\nBy [Insert author here]"), "placeholder"), (MD.format("Author: $team_name$"), "placeholder"), (NB.format("# XXXX team XXXX"), "placeholder"), (PROMPT.format("［author を入力］"), "placeholder"),
    (MD.format("Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor."), "filler"), (NB.format("Text goes here. Text goes here."), "filler"), (PROMPT.format("asdf qwer zxcvasdf jkl fdsa"), "filler"),
    ("404 Not Found\n\nPlease try again in a few minutes.", "error"), ("<html><head><title>Oops!</title></head><body><h1>Oops!</h1><p>It may have been moved or deleted.</p></body></html>", "error"), ("503", "error"),
    ('{"message": "Sorry, something went wrong", "status": 502, "detail": "Rate limit reached for this address."}', "error"), (MD.format("# Page not found\n\nYou do not have permission to view this file."), "error"),
    ("Gallery\nPlease enable scripts and cookies to continue.", "script"), (NB.format("Bitte aktivieren Sie JavaScript, um diese Seite zu sehen."), "script"), ("<noscript>JavaScript is disabled in your browser.</noscript><div id='x'></div>", "script"),
    (MD.format(OWN), None), (PROMPT.format(OWN + " Exercise 5: change the window."), None), (NB.format(OWN), None), (None, None), ("", None), ("  \n", None), ("# Lab 3\n\n" + OWN, None),
    (MD.format("The letter template marks a field with double braces, for instance `{{ name }}`; the renderer replaces it."), None), (MD.format("Typical filler such as *lorem ipsum* fools the language guesser, as the table shows."), None),
    (MD.format("In class we ask what an *Access denied* or *Page not found* answer means for a crawler."), None), (MD.format("Set `<your token>` style arguments in your own config."), None), (MD.format("The dashboard export only works when the reader has JavaScript enabled, which is why we keep a picture."), None),
    ("# %% In[1]\ntpl = '''\n{{ name }}\n'''\n# your code here\n\n# %% Out[1]\n404 Not Found\n", None), (PROMPT.format(OWN) + "\n\nIn [2]:\necho '${OUT}'\n\nOut[2]:\n----\n\nHTTPError: 404 Client Error: Not Found for url: x", None),
    (MD.format("```\n{{ name }}\n```\n" + OWN), None), (NB.format(OWN)[:-20], None), (OWN + "\n" + OWN * 5000, None), (MD.format("lorem ipsum dolor sit amet " * 3000), "filler"),
]


def test_residue(spark):
    df = spark.createDataFrame([(i, t, f"r{i}/x", "a/b.ipynb") for i, (t, _) in enumerate(CASES)], "doc_id long, text string, repo string, path string")
    got = {r["doc_id"]: r["reason"] for r in residue.find_residue(df).collect()}
    assert [(i, got.get(i)) for i in range(len(CASES))] == [(i, k) for i, (_, k) in enumerate(CASES)]
    assert residue.without_residue(df.withColumn("reason", F.lit("clash"))).count() == sum(k is None for _, k in CASES)
    assert residue.find_residue(df.unionByName(df)).count() == len(got) and residue.find_residue(df.limit(0)).count() == 0
    assert residue.find_residue(df.drop("repo", "path")).count() == len(got)


def test_duplicated_pages(spark):
    page = "<html><body><p>The harbour gate is shut tonight.</p></body></html>"
    rows = [(i, page, f"owner{i}/alpha", "beta.ipynb") for i in range(3)] + [(9, page.replace("harbour gate", "alpha door"), "owner9/alpha", "x.ipynb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, repo string, path string")
    assert {(r["doc_id"], r["reason"]) for r in residue.find_residue(df).collect()} == {(i, "duplicate") for i in range(3)}
    assert residue.find_residue(df.filter("doc_id < 2")).count() == 0


def test_repeated_cells_of_any_wording(spark):
    rng = random.Random(4)
    words = [a + b for a in ("ta", "mo", "re", "li", "su", "ko") for b in ("nder", "pple", "stic", "mbra", "gola", "vern")]
    pick = lambda n: " ".join(rng.sample(words, n))
    book = "# %% [markdown]\n# {}\n\n# %% [markdown]\n{}\n\n# %% In[1]\n{}\n\n# %% [markdown]\n{}\n"
    canned = "The harbour gate stays shut tonight."
    rows = []
    for i in range(40):
        topic = pick(4)
        rows.append((i, f"owner{i}/{pick(1)}", f"{topic.split()[0]}.ipynb", book.format(topic, topic + " and " + pick(3), topic.split()[1] + " = 1", canned if i < 6 else topic + " again")))
    # a notebook copied under six hosts, and one sentence filled in
    copied = book.format(pick(3), pick(5), "x = 1", "Nothing here belongs together whatsoever.")
    rows += [(100 + i, f"copier{i}/x", "y.ipynb", copied) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, repo string, path string, text string")
    assert {tuple(r) for r in residue.find_residue(df).collect()} == {(i, "duplicate") for i in range(6)}
    assert residue.find_residue(df.filter("doc_id > 3 and doc_id < 50")).count() == 0


def test_cells_that_say_little():
    assert residue.says_little("blah, blah, yada, blah blah, bla bla, blah, yada") and not residue.says_little("no no no") and not residue.says_little(OWN)
    text = "# yada study\n\nblah yada blah yada blah yada blah yada\n"
    assert not residue.is_foreign("blah yada blah", "x/y.ipynb", text) and not residue.is_foreign("blah", "blah/y.ipynb", "blah") and residue.is_foreign("", "", "")


@pytest.mark.parametrize("text, n", [("# %% [markdown]\na\n# %% In[1]\nb\n# %% [markdown]\nc\n", 2), ("plain", 1), ('{"cells": [', 1), ("In [1]:\nx", 0)])
def test_cells(text, n):
    assert len(residue.text_cells(text)) == n


def test_filler_is_counted_over_the_whole_cell():
    own = "we plot the mean of each station and compare both years ".split()
    latin = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do ".split()
    for n in (1, 20, 60):
        assert residue.judge_cell(" ".join(own * n + latin * 9 * n), True) == "filler"
        assert residue.judge_cell(" ".join(own * n + latin * (n * 11 // 10 + 1)), False) == "filler"
        assert residue.judge_cell(" ".join(latin * n + own * 2 * n), True) != "filler"
    assert residue.judge_cell("own " * 500 + "asdf qwerty " * 300, False) == "filler"


def test_notebook_with_metadata_first():
    import json

    cells = [{"cell_type": "markdown", "source": ["Some words\n", "of a cell"]}, {"cell_type": "code", "source": "x = 1"}, {"cell_type": "markdown", "source": "# {{title}}"}]
    text = json.dumps({"metadata": {"kernel": "k" * 400}, "nbformat": 4, "cells": cells})
    assert residue.text_cells(text) == ["Some words\nof a cell", "# {{title}}"]
    broken = text[:-1]
    assert residue.text_cells(broken) == [broken] and residue.text_cells('{"a": "cells"}') == ['{"a": "cells"}']


def test_short_pages_of_any_wording(spark):
    page = "The thing you wanted has gone elsewhere. Kindly ring the front desk."
    rows = [(i, f"owner{i}/birds", "notes/storks.txt", page) for i in range(3)] + [(3, "owner3/desk", "front.txt", page), (4, "owner4/birds", "a.txt", "Only one place says exactly this here."), (5, "owner5/birds", "b.txt", page + " More words of its own." * 20)]
    df = spark.createDataFrame(rows, "doc_id long, repo string, path string, text string")
    assert {tuple(r) for r in residue.find_residue(df).collect()} == {(i, "duplicate") for i in range(3)}
