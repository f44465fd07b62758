"""Language identification: the kernel against sets, and accuracy on held-out documents."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratastar.llm import language_id as lid

SCHEMA = "doc_id long, text string, lang string"
DATA = "/root/testdata/sf0.01/documents.parquet"


def test_presence_counts_distinct_grams():
    texts = ["abcabc", "", "a1b", "ñañ"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    rows = lid.presence(data, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    for text, row in zip(texts, rows, strict=True):
        codes = [c if chr(c).islower() or c > 127 else 32 for c in text.encode()]
        grams = {tuple(codes[i : i + n]) for n in range(1, 5) for i in range(len(codes) - n + 1)}
        assert row.sum() == len(grams)


def test_folded_weights_equal_kernel_regression():
    rng = np.random.default_rng(0)
    rows = (rng.random((40, lid.BUCKETS)) < 0.01).astype(np.uint8)
    rows[:20, :50] = 1
    labels = ["a"] * 20 + ["b"] * 20
    landmark = np.arange(40) % 4 == 0
    model = lid.learned(rows, labels, landmark)
    unit = rows / np.sqrt(rows.sum(axis=1, keepdims=True))
    values, vectors = np.linalg.eigh(unit[landmark] @ unit[landmark].T)
    phi = unit @ unit[landmark].T @ (vectors / np.sqrt(np.maximum(values, 1e-6 * values.max())) @ vectors.T)
    centred, y = phi - phi.mean(0), np.array([[1, -1]] * 20 + [[-1, 1]] * 20, float)
    w = np.linalg.solve(centred.T @ centred + lid.RIDGE * 40 * np.eye(10), centred.T @ (y - y.mean(0)))
    expected = np.exp(lid.SHARPNESS * (centred @ w + y.mean(0)))
    np.testing.assert_allclose(model.scores(rows), expected / expected.sum(1, keepdims=True), atol=1e-4)
    assert (model.scores(rows).argmax(1) == [0] * 20 + [1] * 20).all()


def test_accuracy_on_held_out_documents(spark):
    documents = spark.read.parquet(DATA)
    # A prediction may not use the label columns.
    out = lid.predicted(documents.select("doc_id", "text"), lid.train(documents)).join(documents, "doc_id")
    right, n = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.98
    assert out.where("held_out <> (crc32(cast(string(doc_id) as binary)) % 4 = 2)").isEmpty()


def test_training_rows_and_scores_against_a_plain_version(spark, monkeypatch):
    """The query recomputed: which rows are learned from, the model of them, and every score one by one."""
    monkeypatch.setattr(lid, "TRAINED", 12)
    monkeypatch.setattr(lid, "LANDMARKS", 5)
    rng = random.Random(2)
    words = {"en": "the of and to in that with hat".split(), "de": "der die und das nicht ein über".split(), "fr": "le la les des est une été".split()}
    docs = []
    for i in range(150):
        lang = rng.choice(list(words))
        docs.append((i, " ".join(rng.choice(words[lang]) for _ in range(rng.randrange(4, 30))), lang))
    docs += [(200, docs[0][1], docs[0][2]), (201, None, "en"), (202, "12 !", "de"), (None, "the of", "en"), (203, "of the", None), (0, docs[0][1], docs[0][2])]
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)

    prints = {r.text: r.p for r in df.select("text", F.xxhash64("text").alias("p")).collect()}
    learned = {}
    for i, text, lang in docs:
        if i is not None and lang and text and any(c.isalpha() for c in text) and zlib.crc32(str(i).encode()) % 4 != 2:
            learned.setdefault(lang, set()).add(text)
    rows, labels, landmark = [], [], []
    for lang in sorted(learned):
        for place, text in enumerate(sorted(learned[lang], key=prints.get)[:12]):
            data = np.frombuffer(text.lower().encode(), np.uint8)
            rows.append(lid.presence(data, np.array([0, len(data)]))[0])
            labels.append(lang)
            landmark.append(place < 5)
    model = lid.learned(np.array(rows), labels, np.array(landmark))
    found = lid.train(df)
    assert found.languages == model.languages
    np.testing.assert_allclose(found.weights, model.weights, atol=1e-4)
    np.testing.assert_allclose(found.common, model.common, atol=1e-6)
    out = lid.predicted(df, found).collect()
    expected = []
    for i, text, _ in docs:
        if text and any(c.isalpha() for c in text):
            data = np.frombuffer(text.lower().encode(), np.uint8)
            p, familiar = model.judged(lid.presence(data, np.array([0, len(data)])))
            expected.append((i if i is not None else -1, model.languages[int(p[0].argmax())], round(float(p[0].max()), 3), round(float(familiar[0]), 3)))
        else:
            expected.append((i if i is not None else -1, "und", 0.0, 0.0))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.lang_pred, round(r.score, 3), round(r.familiar, 3)) for r in out)
    for one, two in zip(got, sorted(expected), strict=True):
        assert one[:2] == two[:2] and abs(one[2] - two[2]) < 2e-3 and abs(one[3] - two[3]) < 2e-3


@pytest.fixture(scope="module")
def small(spark):
    texts = {"en": "the cat and the dog with that hat ", "de": "und der die das nicht ein zwei über "}
    rows = [(i + 1, texts[k] * (1 + i % 3) + str(i), k) for i in range(60) for k in [("en", "de")[i % 2]]]
    return spark.createDataFrame(rows, SCHEMA)


def test_defined_cases(spark, small):
    odd = [(None, "the cat and the dog", "en"), (501, None, "en"), (502, "", None), (503, "12 !? \t", "de"), (504, "der die das und", None), (504, "der die das und", None), (505, "the hat " * 40_000, "en")]
    documents = small.unionByName(spark.createDataFrame(odd, SCHEMA)).withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit("clash"))
    out = lid.predicted(documents, lid.train(documents), carry=("lang_pred",)).collect()
    got = sorted((r.doc_id or -1, r.lang_pred) for r in out if (r.doc_id or 999) > 500)
    assert got == [(-1, "en"), (501, "und"), (502, "und"), (503, "und"), (504, "de"), (504, "de"), (505, "en")]
    assert all(r.carried.lang_pred == "clash" and 0 <= r.score <= 1 for r in out)
    assert all(r.score == 0 for r in out if r.lang_pred == "und")
    assert not next(r for r in out if r.doc_id is None).held_out


def test_nothing_to_learn_from(spark, small):
    blank = small.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lid.predicted(blank, lid.train(blank)).collect()} == {"und"}
    empty = small.where("false")
    assert lid.predicted(empty, lid.train(empty)).collect() == []
    one = small.withColumn("lang", F.lit("en"))
    assert {r.lang_pred for r in lid.predicted(one, lid.train(one)).collect()} == {"en"}
