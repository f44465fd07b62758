"""Repeated passages against a comparison of all windows."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from stratastar.llm import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(docs):
    first, words = {}, {}
    for i, text in sorted(docs):
        words[i] = WORD.findall(text or "")
        for s in range(len(words[i]) - 19):
            first.setdefault(tuple(words[i][s : s + 20]), (i, s))
    out = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] != (i, s):
                gone.update(range(s, s + 20))
        out[i] = (len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone))
    return out


def rows(df, **how):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.cut_repeats(df, **how).collect()}


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ü."]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [draw(n) for n in (19, 20, 21, 60, 150)]
    docs = []
    for _ in range(80):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts.append(draw(rng.randrange(0, 40)))
            p = rng.choice(passages)
            cut = rng.randrange(0, 5)
            parts.append(p[cut : len(p) - rng.randrange(0, 5)])
        docs.append(rng.choice([" ", "\n", " \t "]).join(x for part in parts for x in part))
    docs += [None, "", "  ", "short text", " ".join(["again"] * 100), " ".join(["a", "b", "c"] * 40)]
    docs += [docs[3], docs[3]]
    docs.append(" ".join(draw(25_000) + passages[4] + passages[4]))
    return list(enumerate(docs))


def test_against_all_windows(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    assert rows(df.repartition(6)) == brute_force(docs)


def test_many_tasks_and_small_buffers(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(df.repartition(40)) == brute_force(docs)
    monkeypatch.setattr(substring_dedup, "HELD", 50)
    assert rows(df.coalesce(1)) == brute_force(docs)


def test_spans_are_maximal(spark):
    docs = corpus()
    spans = substring_dedup.maximal_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    expected = brute_force(docs)
    assert {r.doc_id: sum(s.end - s.start for s in r.repeats) for r in spans} == {i: n for i, (_, n, _) in expected.items() if n}
    assert all(a.end < b.start for r in spans for a, b in zip(r.repeats, r.repeats[1:], strict=False))
    assert all(s.end - s.start >= 20 for r in spans for s in r.repeats)


def test_layout_and_carried_columns(spark):
    text = "  keep\tthis \n"
    df = spark.createDataFrame([(1, text, "a"), (2, None, "b")], "doc_id long, text string, kept_text string")
    got = {r.doc_id: (r.kept_text, r.carried.kept_text) for r in substring_dedup.cut_repeats(df, carry=("kept_text",), as_it_was=True).collect()}
    assert got == {1: (text, "a"), 2: (None, "b")}


def test_repeated_and_null_ids(spark):
    long = " ".join(f"x{i}" for i in range(30))
    docs = [(1, long), (1, long), (1, "p " + long), (2, long), (None, long), (None, None)]
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substring_dedup.cut_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == [(-1, 0, 0), (-1, 30, 0), (1, 30, 0), (1, 30, 0), (1, 31, 30), (2, 30, 30)]


def test_empty_table(spark):
    assert rows(spark.createDataFrame([], "doc_id long, text string")) == {}
