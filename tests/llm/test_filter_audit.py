"""The filter audit against filtering the documents in every order, one after another."""

from __future__ import annotations

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from stratastar.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(docs):
    """Letters that each document fails."""
    out = []
    for i, text, *_ in docs:
        text = text or ""
        words, letters = WORD.findall(text), set()
        if len(words) < 200:
            letters.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            letters.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            letters.add("C")
        if re.search("[#$%&*|]", text):
            letters.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in docs):
            letters.add("E")
        out.append(letters)
    return out


def brute_force(docs, labels):
    failed, out = fails(docs), {}
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    for part in {d[2] or "" for d in docs}:
        mine = [(d[0], f) for d, f in zip(docs, failed, strict=True) if (d[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, start=1):
                hit = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[letter] += len(hit)
                out[part, "".join(order), step] = [
                    len(left),
                    len(hit),
                    sum(letter in f for _, f in mine) - len(hit),
                    sum(f == {letter} for _, f in mine),
                    sum(i in good for i, _ in hit),
                    sum(i in toxic for i, _ in hit),
                    letter,
                ]
        for (p, _, _), row in out.items():
            if p == part and isinstance(row[-1], str):
                row[-1] = shapley[row[-1]]
    return out


def found(spark, docs, labels):
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("mask", F.lit("clash")).withColumn("part", F.lit(1)).withColumn("digest", F.lit(2))
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(df.repartition(3), said).collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}
    assert len(out) == len(rows)
    return out


LONG = " ".join(f"w{i}" for i in range(220))
HALF = " ".join(f"w{i % 100}" for i in range(200))


def test_against_every_order(spark):
    docs = [
        (1, LONG, "en"), (2, LONG, "de"), (2, LONG, "en"), (3, LONG + " #", "en"), (4, "ABC " * 300, "en"), (5, HALF, "en"), (6, HALF + " w1", None),
        (7, None, None), (8, "", ""), (9, " \t\n", "de"), (None, LONG, "en"), (None, None, "fr"), (10, "Ä" * 97 + "ABC", "fr"), (11, "Ä" * 96 + "ABC", "fr"),
        (12, "a\x0bb\x0cc\xa0d | e", "fr"), (12, "a\x0bb\x0cc\xa0d | e", "fr"), (13, "x " * 100_000 + "&", "en"), (14, "Ä É É " * 120, "de"), (15, "ABC " * 300, "xx"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (4, 1, 1), (None, 1, 1), (7, None, 1), (99, 1, 1), (13, 1, None)]
    expected = brute_force(docs, labels)
    got = found(spark, docs, labels)
    assert got.keys() == expected.keys() and len(got) == 600 * len({d[2] or "" for d in docs})
    assert got == expected


def test_empty_tables(spark):
    assert found(spark, [], [(1, 1, 1)]) == {}
    assert found(spark, [(1, "a", "en")], []) == brute_force([(1, "a", "en")], [])


@pytest.mark.parametrize("letters", ["A", "AB", "ABCD"])
def test_ranks_and_intervals(letters):
    orders = ["".join(p) for p in permutations(letters)]
    for rank, order in enumerate(orders):
        for n in range(len(letters) + 1):
            first = filter_audit.first_rank(order[:n], letters)
            assert first == min(i for i, o in enumerate(orders) if o.startswith(order[:n])) <= rank
    removed = set()
    for mask, step, first, behind in filter_audit.intervals(letters):
        for rank in range(first, behind):
            assert (mask, rank) not in removed  # a mask goes once in every order
            removed.add((mask, rank))
            hit = [c for c in orders[rank][:step] if mask >> letters.index(c) & 1]
            assert hit == [orders[rank][step - 1]]
    assert len(removed) == (2 ** len(letters) - 1) * len(orders)


def test_another_set_of_filters(spark):
    facts = spark.createDataFrame([("p", m, m == 3) for m in (0, 1, 2, 3, 3)], "part string, mask int, odd boolean")
    rows = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.odd, r.shapley) for r in filter_audit.audited(facts, "AB", ("odd",)).collect()}
    assert rows == {("AB", 1): (2, 3, 0, 1, 2, 4), ("AB", 2): (1, 1, 2, 1, 0, 4), ("BA", 1): (2, 3, 0, 1, 2, 4), ("BA", 2): (1, 1, 2, 1, 0, 4)}
