"""Near duplicates against all pairs of full sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratastar.llm import near_dup, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def members(text):
    found = WORD.findall((text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def brute_force(docs, percent=85):
    sets = {i: members(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def rows(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()}


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 40, 90]))] for _ in range(40)]
    docs = []
    for b in base:
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(b)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(" ".join(copy))
    # A chain: each one near the next, the ends far apart.
    chain = [rng.choice(vocabulary) for _ in range(100)]
    for step in range(8):
        chain = chain[2:] + [f"c{step}", f"d{step}"]
        docs.append("\n".join(chain))
    docs += [None, "", " \t\n ", "One", "one", "ONE two", "one two", "É x", "é x", "a\x0bb c\x0cd e f g", "a b c d e f g", "a b c d e f g"]
    docs.append(" ".join(rng.choice(vocabulary) for _ in range(30_000)))
    docs.append(docs[-1] + " tail")
    return list(enumerate(docs, start=100))


def test_against_all_pairs(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("component_id", F.lit("x")).withColumn("kept", F.lit(1))
    assert rows(df.repartition(5)) == brute_force(docs)


def test_members_of_other_components_meet(spark):
    """A bucket whose first member links with nobody must still link the others."""
    rng = random.Random(9)
    base = [f"t{rng.randrange(10**6)}" for _ in range(200)]
    docs = [(i, base[:]) for i in range(60)]
    for i, tokens in docs:
        for _ in range(3 + i % 4):
            tokens[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
    docs = [(i, " ".join(t)) for i, t in docs]
    assert rows(spark.createDataFrame(docs, "doc_id long, text string")) == brute_force(docs)


def test_copies_that_link_with_few_are_contracted_before_all_meet(spark, monkeypatch):
    """Copies of one text, of which only some link, must not all be compared in full with all others."""
    rng = random.Random(3)
    base = [f"t{i}" for i in range(150)]
    docs = []
    for i in range(240):
        tokens = list(base)
        for at in rng.sample(range(150), 1 + i % 3):
            tokens[at] = f"x{i}-{at}"
        docs.append((i, " ".join(tokens)))
    compared, confirmed = [], near_dup._confirmed

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(near_dup, "_confirmed", counted)
    assert rows(spark.createDataFrame(docs, "doc_id long, text string")) == brute_force(docs)
    assert sum(compared) < 3_900  # 4,395 when every bucket kept one lead


def test_last_meeting_looks_a_class_up_once(spark, monkeypatch):
    """Sketch and bands of a class come by one join on each side, and a third join lets the sides meet."""
    plans, confirmed = {}, near_dup._confirmed

    def spied(pairs, *rest):
        plans[rest[-1]] = pairs._jdf.queryExecution().analyzed().toString()
        return confirmed(pairs, *rest)

    monkeypatch.setattr(near_dup, "_confirmed", spied)
    rng = random.Random(9)
    base = [f"t{rng.randrange(10**6)}" for _ in range(200)]
    docs = [(i, base[:]) for i in range(60)]
    for i, tokens in docs:
        for _ in range(3 + i % 4):
            tokens[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
    docs = [(i, " ".join(t)) for i, t in docs]
    monkeypatch.setattr(near_dup, "FEW", 10**9)
    assert rows(spark.createDataFrame(docs, "doc_id long, text string")) == brute_force(docs)
    assert plans["meet"].count("Join Inner") == 3


def test_repeated_and_null_ids(spark):
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words"), (None, "a b c d e f"), (2, "A b c d e f"), (None, None)]
    found = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert found == [(-1, 0, -1, True), (-1, 2, -1, True), (1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def repeated_ids(docs):
    """Components over rows: rows link by their sets, and rows of one id are tied."""
    rows = [(i, members(t)) for i, t in docs]
    part = list(range(len(rows)))

    def find(n):
        while part[n] != n:
            n = part[n]
        return n

    for x, (i, a) in enumerate(rows):
        for y, (j, b) in enumerate(rows[:x]):
            both = len(a & b)
            if (i == j and a and b) or (both and 100 * both >= 85 * len(a | b)):
                part[find(x)] = find(y)
    least = {}
    for n, (i, _) in enumerate(rows):
        least[find(n)] = min(i, least.get(find(n), i))
    return sorted((i, len(s), least[find(n)] if s else i, i == least[find(n)] or not s) for n, (i, s) in enumerate(rows))


def test_near_copies_of_each_text_of_an_id(spark):
    rng = random.Random(11)
    texts = [" ".join(f"t{rng.randrange(10**6)}" for _ in range(100)) for _ in range(4)]
    tables = [
        [(1, texts[0]), (1, texts[1]), (2, texts[0] + " tail"), (3, texts[1] + " tail")],
        [(5, texts[0]), (5, texts[1]), (2, texts[0] + " tail"), (3, texts[1] + " tail"), (9, None), (5, None)],
        [(rng.randrange(12), rng.choice(texts[2:]) + " tail" * rng.randrange(3)) for _ in range(10)] + [(20 + k, f"{k} alone {texts[k % 4][:200]}") for k in range(8)],
    ]
    for docs in tables:
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
        found = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect())
        assert found == repeated_ids(docs)


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_buckets_by_leads_and_by_pairs(spark, monkeypatch, share):
    """Large buckets of several components, settled by leads, by pairs, or by both."""
    monkeypatch.setattr(near_dup, "SHARE", share)
    rng = random.Random(12)
    base, docs = [f"t{rng.randrange(10**6)}" for _ in range(300)], []
    for group in range(4):
        mine = base[:]
        for _ in range(9):
            mine[rng.randrange(300)] = f"g{rng.randrange(10**6)}"
        for _ in range(20):
            copy = mine[:]
            for _ in range(rng.randrange(1, 4)):
                copy[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
            docs.append(" ".join(copy))
    rng.shuffle(docs)
    docs = list(enumerate(docs))
    assert rows(spark.createDataFrame(docs, "doc_id long, text string")) == brute_force(docs)


def test_confirming_by_a_shuffle_join(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BROADCAST_ROWS", -1)
    docs = corpus()
    assert rows(spark.createDataFrame(docs, "doc_id long, text string")) == brute_force(docs)


def test_only_the_result_stays_stored(spark):
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    near_dup.near_duplicates(spark.createDataFrame(corpus()[:30], "doc_id long, text string"))
    assert len(set(os.listdir(folder)) - before) == 1


def test_empty_table(spark):
    assert rows(spark.createDataFrame([], "doc_id long, text string")) == {}


@pytest.mark.parametrize("lower", [False, True])
def test_words_match_the_pattern(lower):
    texts = ["", "a", " a  bc\t", "É ü x\x1f y", "A" * 50 + "\x0b" + "b", "\n", "z"] * 3
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    got = words.words_of(data, offsets, lower)
    found = [bytes(data[a:b]).decode() for a, b in zip(got.start, got.end, strict=True)]
    expected = [WORD.findall(t) for t in texts]
    assert found == [w for ws in expected for w in ws]
    assert got.counts.tolist() == [len(ws) for ws in expected]
    key = [w.translate(LOWER) if lower else w for w in found]
    assert len(set(key)) == len(set(got.hashes.tolist())) == len(set(zip(key, got.hashes.tolist(), strict=True)))


@pytest.mark.parametrize("size", [40, 400, 20_000])
def test_sketches_agree_as_sets_do(spark, size):
    rng = np.random.default_rng(size)
    found, passed = [], 0
    for _ in range(30):
        pool = rng.integers(0, 2**63, size).astype(np.uint64)
        cut = size * 3 // 40  # similarity 0.85
        sets = [np.unique(pool[: size - cut]), np.unique(pool[cut:])]
        both = len(np.intersect1d(*sets))
        sizes = np.array([len(s) for s in sets])
        bits, filled = near_dup.odd_sketches(np.concatenate(sets), sizes)
        found.append((float(both / (sizes.sum() - both)), bits[0].tolist(), bits[1].tolist(), *map(int, filled), *map(int, sizes)))
    df = spark.createDataFrame(found, "j double, s_a array<long>, s_b array<long>, f_a long, f_b long, n_a long, n_b long")
    passed = df.where(near_dup._likely("a", "b")).count()
    assert passed == 30
    # Sets of similarity 0.6 hardly ever pass.
    far = df.withColumn("s_b", F.array_sort("s_b")).where(near_dup._likely("a", "b")).count()
    assert far == 0


def planted(rng, union, percent, pairs):
    """Sketches and sizes of pairs of sets with `union` members, of which `percent` are shared."""
    both = union * percent // 100
    assert 100 * both == percent * union
    n, m = (union + both + 1) // 2, (union + both) // 2
    pool = rng.integers(0, 2**63, (pairs, union)).astype(np.uint64)
    sets = pool[:, :n], np.concatenate([pool[:, :both], pool[:, n:]], axis=1)
    (s_a, f_a), (s_b, f_b) = (near_dup.odd_sketches(x.ravel(), np.full(pairs, x.shape[1])) for x in sets)
    return [(union, *row, n, m) for row in zip(s_a.tolist(), s_b.tolist(), f_a.tolist(), f_b.tolist(), strict=True)]


PLANTED = "size long, s_a array<long>, s_b array<long>, f_a long, f_b long, n_a long, n_b long"


@pytest.mark.parametrize("percent", [80, 90])
def test_bands_and_filter_at_another_threshold(spark, percent):
    bands, of = near_dup.bands_of(percent)
    assert (1 - (percent / 100) ** of) ** bands < 1e-6 and near_dup.bands_of(85) == (36, 7)
    rng = np.random.default_rng(percent)
    found = [row for union in (20, 40, 60, 100, 200, 400) for row in planted(rng, union, percent, 1000)]
    assert spark.createDataFrame(found, PLANTED).where(~near_dup._likely("a", "b", percent)).isEmpty()


def test_copies_between_two_thresholds(spark):
    """Copies of 100 words with two changed far apart share 86 of 106 shingles."""
    rng = random.Random(80)
    docs = []
    for i in range(60):
        base = [f"t{rng.randrange(10**6)}" for _ in range(100)]
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:30], "one", *base[31:70], "two", *base[71:]]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(df) == {i: (96, i, True) for i in range(120)}
    assert {r.doc_id: (r.component_id, r.kept) for r in near_dup.near_duplicates(df, 80).collect()} == {i: (i - i % 2, i % 2 == 0) for i in range(120)}
    assert near_dup.without_near_duplicates(df, 80).count() == 60


def test_sketches_rule_no_link_out(spark):
    """Pairs of exactly the least similarity, at sizes where the number of filled bins varies most."""
    rng = np.random.default_rng(85)
    found = [row for union in (20, 40, 60, 100, 200, 400) for row in planted(rng, union, 85, 2000)]
    lost = spark.createDataFrame(found, PLANTED).where(~near_dup._likely("a", "b"))
    assert {r["size"]: r["count"] for r in lost.groupBy("size").count().collect()} == {}
