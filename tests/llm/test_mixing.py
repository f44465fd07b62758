"""Mixing against a plain water-filling and plain prefixes."""

from __future__ import annotations

import hashlib
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stratastar.llm import mixing
from stratastar.llm.common import Scratch
from stratastar.llm.mixing import Mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def shared(budget, children):
    """children: {name: (weight, capacity)}; fills the ones that overflow, again and again."""
    left, out = dict(children), {}
    while True:
        rest = budget - sum(out.values())
        weight = sum(w for w, _ in left.values())
        full = {n: c for n, (w, c) in left.items() if c <= Fraction(w * rest, weight)}
        if not full:
            break
        out |= full
        left = {n: x for n, x in left.items() if n not in full}
        if not left:
            return out
    rest, weight = budget - sum(out.values()), sum(w for w, _ in left.values())
    return out | {n: w * rest // weight for n, (w, _) in left.items()}


def brute_force(docs, mix):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    leaves = {}
    for i, text, lang, source in docs:
        content = md5(f"{'' if i is None else i}:{text or ''}")
        source = source or "(none)"
        leaves.setdefault((source[:1], lang or "(none)", source), []).append((i, len(WORD.findall(text or "")), content))
    weight = lambda level, name: max(0, mix.weights.get(level, {}).get(name, 1))
    tokens = {leaf: sum(n for _, n, _ in rows) for leaf, rows in leaves.items()}
    live = {leaf: n * mix.epochs for leaf, n in tokens.items() if n and all(weight(level, name) for level, name in zip(mixing.LEVELS, leaf, strict=True))}
    budget = {(): sum(tokens.values()) * mix.percent // 100}
    for depth in (1, 2, 3):
        below = {}
        for parent, b in budget.items():
            names = {leaf[depth - 1] for leaf in live if leaf[: depth - 1] == parent}
            children = {n: (weight(mixing.LEVELS[depth - 1], n), sum(c for leaf, c in live.items() if leaf[:depth] == (*parent, n))) for n in names}
            below |= {(*parent, n): x for n, x in shared(b, children).items()} if children else {}
        budget = below
    out = []
    for leaf, b in budget.items():
        epochs, room = divmod(b, tokens[leaf])
        rows = sorted((md5(f"{mix.seed}:{epochs}:{content}"), i, n) for i, n, content in leaves[leaf]) if all(i is not None for i, _, _ in leaves[leaf]) else sorted(((md5(f"{mix.seed}:{epochs}:{content}"), i, n) for i, n, content in leaves[leaf]), key=lambda x: x[0])
        for k, i, n in rows:
            upto = sum(m for other, _, m in rows if other <= k)
            out += [(i, *leaf, n, e) for e in range(epochs + (1 if room and upto <= room else 0))]
    return sorted(out, key=str)


def corpus():
    rng = random.Random(8)
    docs = []
    for i in range(600):
        source = rng.choice(["a1", "a1", "a1", "a2", "b1", "b2", "c9"])
        docs.append((i, " ".join("w" for _ in range(rng.randint(0, 30))), rng.choice(["en", "en", "de", None]), source))
    docs += [(None, "x y z", "en", "a1"), (None, None, "en", None), (7000, "", "fr", "b1"), (7001, "same text", "en", "a2"), (7001, "same text", "en", "a2"), (7002, "v " * 20_000, "de", "c9")]
    return docs


MIXES = [
    Mix(),
    Mix(weights={"domain": {"a": 1, "b": 8, "c": 2}, "language": {"en": 5, "de": 1}, "source": {"a1": 3}}, percent=60),
    Mix(weights={"domain": {"a": 0}, "language": {"de": -1}}, percent=100, epochs=5, seed=3),
    Mix(percent=0),
    Mix(percent=1000, epochs=3),
]


def rows(df, mix, **how):
    out = mixing.mixed(df, F.substring("source", 1, 1), mix, **how).collect()
    return sorted(((r.doc_id, r.domain, r.language, r.source, r.n_tokens, r.epoch) for r in out), key=str)


def fixed(docs):
    return [(i, t, lang, s or None) for i, t, lang, s in docs]


@pytest.mark.parametrize("mix", MIXES)
def test_against_plain_water_filling(spark, mix):
    docs = corpus()
    df = spark.createDataFrame(fixed(docs), SCHEMA).withColumn("epoch", F.lit("clash")).withColumn("domain", F.lit("clash")).repartition(4)
    expected = [(i, "(none)" if s == "(none)" else d, lang, s, n, e) for i, d, lang, s, n, e in brute_force(docs, mix)]
    assert rows(df, mix) == sorted(expected, key=str)


def test_fine_digits_change_nothing(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame(docs, SCHEMA)
    whole = rows(df, MIXES[1])
    monkeypatch.setattr(mixing, "DIGITS", 1)
    assert rows(df, MIXES[1]) == whole


@pytest.mark.parametrize("digits", [(8, 16_384), (1, 2), (64, 64)])
def test_level_among_many_children(spark, monkeypatch, digits):
    """Thousands of children under one parent, many alike or of one ratio, at budgets from nothing to more than all."""
    monkeypatch.setattr(mixing, "RATIO_DIGITS", digits)
    rng = random.Random(9)
    children = {}
    for n in range(1500):
        parent = rng.choice(["hot"] * 5 + ["p", "q"])
        weight, capacity = rng.choice([1, 1, 2, 3, 7]), rng.choice([10, 20, 30, rng.randrange(1, 10**6), rng.randrange(1, 50)])
        children.setdefault(parent, {})[f"s{n}"] = (weight, capacity)
    children["exact"] = {"a": (1, 10), "b": (2, 20), "c": (3, 30), "d": (1, 11)}
    children["one"] = {"a": (5, 7)}
    scratch = Scratch(spark, "test")
    total = {p: sum(c for _, c in own.values()) for p, own in children.items()}
    for share in (Fraction(0), Fraction(1, 1000), Fraction(1, 7), Fraction(60, 71), Fraction(99, 100), Fraction(1), Fraction(3)):
        rows = [(p, name, w, c, int(total[p] * share)) for p, own in children.items() for name, (w, c) in own.items()]
        df = spark.createDataFrame(rows, "domain string, source string, weight long, capacity long, budget long")
        got = {(r.domain, r.source): r.share for r in mixing.allotted(df, ["domain"], scratch, "t").collect()}
        assert got == {(p, name): x for p, own in children.items() for name, x in shared(int(total[p] * share), own).items()}


def test_siblings_make_up_before_ancestors(spark):
    """b1 is short; b2 takes what is missing, and a1 gains nothing."""
    docs = [(i, "w " * 10, "en", "a1") for i in range(100)] + [(200, "w " * 10, "en", "b1")] + [(300 + i, "w " * 10, "en", "b2") for i in range(100)]
    got = rows(spark.createDataFrame(docs, SCHEMA), Mix(percent=50, epochs=1))
    total = {s: sum(r[4] for r in got if r[3] == s) for s in ("a1", "b1", "b2")}
    assert total == {"a1": 500, "b1": 10, "b2": 490}


def test_carried_columns_empty_table_and_native_plan(spark):
    df = spark.createDataFrame(corpus(), SCHEMA).withColumn("epoch", F.lit("mine"))
    out = mixing.mixed(df, F.col("source"), Mix(), carry=("epoch", "text"))
    assert {r.carried.epoch for r in out.collect()} == {"mine"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert rows(df.where("false"), Mix()) == []
