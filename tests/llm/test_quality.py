"""Quality scores: vectors against a plain count, and accuracy on held-out documents."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratastar.llm import quality
from stratastar.llm.words import words_of

DATA = "/root/testdata/sf0.01"


def chunk(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    return words_of(data, np.cumsum([0, *(len(t.encode()) for t in texts)]), lower=True)


def test_contexts_against_a_plain_count():
    texts = ["The cat sat, the CAT ran 12 times!", "", "one", "two words"]
    words = chunk(texts)
    word, shape = quality.symbols(words)
    index = np.zeros((quality.SYMBOLS, quality.DIM), np.int64)
    for k in range(quality.NONZERO):
        np.add.at(index, (np.arange(quality.SYMBOLS), quality._PLACE[:, k]), quality._SIGN[:, k])
    expected = np.zeros_like(index)
    at = 0
    for text in texts:
        n = len(re.findall(r"\S+", text))
        for i in range(at, at + n):
            expected[word[i]] += index[shape[i]]
            for j in range(max(at, i - 2), min(at + n, i + 3)):
                if j != i:
                    expected[word[i]] += index[word[j]] + index[shape[j]]
                    expected[shape[i]] += index[shape[j]]
        at += n
    assert (quality.contexts(words) == expected).all()


def plain_vectors(texts):
    """Word and shape vectors from plain counts over all texts, one symbol after another."""
    index = np.zeros((quality.SYMBOLS, quality.DIM), np.int64)
    for k in range(quality.NONZERO):
        np.add.at(index, (np.arange(quality.SYMBOLS), quality._PLACE[:, k]), quality._SIGN[:, k])
    total = {}
    for text in texts:
        words = [tuple(int(x[0]) for x in quality.symbols(chunk([w]))) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        for i, (word, shape) in enumerate(words):
            total.setdefault(word, np.zeros(quality.DIM))
            total[word] += index[shape]
            for j in range(max(0, i - quality.REACH), min(len(words), i + quality.REACH + 1)):
                if j != i:
                    total[word] += index[words[j][0]] + index[words[j][1]]
                    total[shape] = total.get(shape, np.zeros(quality.DIM)) + index[words[j][1]]
    out = {}
    for low, high in ((0, quality.WORDS), (quality.WORDS, quality.SYMBOLS)):
        own = {s: v / np.linalg.norm(v) for s, v in total.items() if low <= s < high and np.abs(v).sum()}
        centre = sum(own.values()) / max(len(own), 1)
        out |= {s: (v - centre) / max(np.linalg.norm(v - centre), 1e-9) for s, v in own.items()}
    return out


def plain_features(text, vectors):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    both = [tuple(int(x[0]) for x in quality.symbols(chunk([w]))) for w in words]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    out, n = [], max(len(words), 1)
    for which in (0, 1):
        rows = np.array([vectors.get(b[which], np.zeros(quality.DIM)) for b in both]).reshape(-1, quality.DIM)
        mean = rows.sum(axis=0) / n
        out += [mean, np.sqrt(np.maximum((rows**2).sum(axis=0) / n - mean**2, 0))]
    shapes = np.bincount([b[1] - quality.WORDS for b in both] if both else np.zeros(0, int), minlength=quality.SHAPES) / n
    again = sum(a == b for a, b in zip(lower, lower[1:], strict=False)) / n
    return np.concatenate([*out, shapes, [again, np.log1p(len(words))]])


def test_whole_query_against_a_plain_version(spark):
    """Vectors, pooling, the choice of training rows and the scores, recomputed text by text."""
    rng = random.Random(4)
    good, junk = "the house stands near a quiet river and trees grow".split(), "BUY $$$ now!!! click 4 free WIN cash 99 http".split()
    docs, labels = [], []
    for i in range(240):
        fine = rng.random() < 0.6
        text = " ".join(rng.choice(good if fine else junk) + rng.choice(["", "", ".", ","]) for _ in range(rng.randrange(15, 60)))
        docs.append((i, text))
        if rng.random() < 0.8:
            labels.append((i, int(fine), 0))
    labels += [(3, 1, 0), (3, 0, 0), (None, 1, 0), (999, 1, 0), (5, None, 0)]
    docs += [(500, None), (501, ""), (502, "the the the quiet quiet"), (3, docs[3][1]), (None, docs[4][1])]
    vectors = plain_vectors([t or "" for _, t in docs])
    found = quality.word_vectors(spark.createDataFrame(docs, "doc_id long, text string"))
    expected = np.zeros_like(found)
    for symbol, v in vectors.items():
        expected[symbol] = v
    assert np.abs(found - expected).max() < 1e-5
    features = np.array([plain_features(t or "", vectors) for _, t in docs])
    whole = chunk([t or "" for _, t in docs])
    assert np.abs(quality.pooled(whole, found) - features).max() < 1e-4

    said = {}
    for i, q, _ in labels:
        if i is not None and q is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            said.setdefault(i, []).append(q)
    rows = [(int(sum(said[i]) / len(said[i]) >= 0.5), f) for (i, _), f in zip(docs, features, strict=True) if i in said]
    network = quality.trained(np.array([f for _, f in rows]), np.array([y for y, _ in rows]))
    plain = network.scores(features)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    out = quality.scored(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(out) == len(docs)
    by_id = {}
    for (i, _), score in zip(docs, plain, strict=True):
        by_id[i] = score
    sure = [r for r in out if by_id[r.doc_id] < 0.2 or by_id[r.doc_id] > 0.8]
    assert len(sure) > 230 and all(abs(r.score - by_id[r.doc_id]) < 0.1 for r in sure if r.doc_id not in (500, 501, 502))
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in out)


def test_shapes_tell_kinds_apart():
    _, shape = quality.symbols(chunk(["word Word WORD word. 12 !! é abcdefghijklmnop"]))
    assert len(set(shape.tolist())) == 8


def test_accuracy_on_held_out_documents(spark):
    documents, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.scored(documents.select("doc_id", "text"), labels)
    rows = out.join(labels, "doc_id").where("held_out").toPandas()
    assert len(rows) > 60 and ((rows["score"] >= 0.5) == rows["quality"]).mean() > 0.93
    assert out.where("held_out <> (crc32(cast(string(doc_id) as binary)) % 4 = 2)").isEmpty()
    assert out.where("predicted <> cast(score >= 0.7 as int) or not score between 0 and 1").isEmpty()


def test_held_out_labels_are_not_learned(spark):
    """Turning the held-out labels round changes no score."""
    documents, labels = (spark.read.parquet(f"{DATA}/{t}.parquet").where("doc_id < 300") for t in ("documents", "labels"))
    out = crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(crc, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.scored(documents, x).select("doc_id", F.col("score").alias(n)) for n, x in (("one", labels), ("two", turned)))
    assert one.join(two, "doc_id").where("abs(one - two) > 1e-9").isEmpty()
    del out


def test_probabilities_are_calibrated():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 6))
    truth = 1 / (1 + np.exp(-(x[:, 0] * 2 - x[:, 1])))
    y = (rng.random(4000) < truth).astype(int)
    scores = quality.trained(x[:3000], y[:3000]).scores(x[3000:])
    assert np.abs(scores - truth[3000:]).mean() < 0.06


@pytest.mark.parametrize(("labels", "share"), [([], 0.5), ([(1, 1, 0), (2, 1, 0)], 1.0), ([(1, None, 0), (None, 0, 0)], 0.5)])
def test_defined_cases(spark, labels, share):
    docs = [(1, "some words here"), (1, "some words here"), (2, None), (3, ""), (None, "x"), (4, "long " * 50_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("label", F.lit(5))
    rows = quality.scored(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(rows) == 6 and all(abs(r.score - share) < 1e-3 for r in rows)
    assert quality.scored(df.where("false"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect() == []
