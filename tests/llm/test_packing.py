"""Packing against the tokenizer itself, and against the fewest sequences possible."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratastar.llm import common, packing
from stratastar.llm.queries import tokenizer

CAPACITY = 2048


@pytest.fixture(scope="module")
def tk():
    return Tokenizer.from_file(tokenizer())


def test_ids_are_those_of_the_whole_text(tk):
    texts = [
        "", " ", "Plain words, here.", "it's DON'T we'll", "x!!... É 12ab a_b^c`d", "<|endoftext|> a<|startoftext|>b", "a<|endoftext|>",
        "\x1fz\x85 q　r s", "é ﬁ İ İ ß", "tab\tnew\nline\r\x0b\x0cend", "日本語 テキスト", "🙂🙂 ok🙂", "A.B.C", "x" * 5000, "?!" * 300, "a'b", "(x)[y]{z}~", "word" + "-" * 40,
    ]
    encoder = packing.Encoder(tokenizer())
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([t.encode() for t in texts])]
        assert got == [e.ids for e in tk.encode_batch(texts, add_special_tokens=False)]


def test_ids_of_every_letter(tk):
    """Every letter of the fast path, alone, in a word, before marks, and with a combining mark."""
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    texts = [f"{c} a{c}b! {c}{c.lower()}.. {c}\u0301 \u03a3{c}\u03a3" for c in letters]
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.Encoder(tokenizer()).encode([t.encode() for t in texts])]
    assert got == [e.ids for e in tk.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aé É.!ßſİŉΣ' -1", max_size=30))
def test_ids_of_any_text(text):
    tk, encoder = Tokenizer.from_file(tokenizer()), packing.encoder_for(tokenizer())
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == tk.encode(text, add_special_tokens=False).ids


def test_other_tokenizer_files_encode_whole_texts():
    """A file whose normaliser or splitter is another one: no short way is taken."""
    path = tokenizer("byte_bpe_50k.json")
    encoder, tk = packing.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_runs and packing.Encoder(tokenizer()).by_runs
    texts = ["Plain Words, here it is. don't STOP now! été", "", " a\n\tb  ", "x<|endoftext|>y"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([t.encode() for t in texts])] == [e.ids for e in tk.encode_batch(texts, add_special_tokens=False)]


def test_both_files_pack(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 50)
    docs = {i: f"Some Words, number {i}; don't stop! " * (i % 9 + 1) for i in range(60)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        check(packing.packed(df, tokenizer(name)).collect(), docs, Tokenizer.from_file(tokenizer(name)))


def test_long_texts_in_blocks(tk, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 20)
    text = ("the cat, sat!\n\non  the mat " * 20 + "x" * 70 + " end").encode()
    blocks = list(packing._blocks(text))
    assert b"".join(blocks) == text and len(blocks) > 10
    assert sum((np.frombuffer(packing.Encoder(tokenizer()).encode([b])[0], "<u4").tolist() for b in blocks), []) == tk.encode(text.decode(), add_special_tokens=False).ids


def test_forgetting_changes_nothing(tk, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder = packing.Encoder(tokenizer())
    text = "the cat, sat! the mat. on the cat, again? " * 5
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == tk.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(12))
def test_plan_holds_everything(seed):
    rng = random.Random(seed)
    kind = [lambda: rng.randint(1, 2048), lambda: rng.randint(900, 1200), lambda: rng.choice([700, 690, 650]), lambda: min(2048, int(rng.expovariate(1 / 300)) + 1)][seed % 4]
    histogram = Counter(kind() for _ in range(rng.choice([1, 10, 3000])))
    bins = packing.plan(dict(histogram))
    held = Counter()
    for b in bins:
        assert sum(n * k for n, k in b.load) + b.room == CAPACITY and b.room >= 0 and b.many > 0
        for length, k in b.load:
            held[length] += k * b.many
    assert held == histogram
    used, bound = sum(b.many for b in bins), -(-sum(n * c for n, c in histogram.items()) // CAPACITY)
    big = sum(c for n, c in histogram.items() if n > 1024)
    thirds = -(-sum(c for n, c in histogram.items() if n > 2048 // 3) // 2)
    assert used <= max(bound, big, thirds) * 1.02 + 2


def test_configurations_beat_one_size_each():
    """Three sizes that only fill sequences together."""
    assert sum(b.many for b in packing.plan({1024 + 300: 500, 500: 500, 224: 500})) == 500
    assert sum(b.many for b in packing.plan({})) == 0


def check(rows, docs, tk):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for doc, text in docs.items():
        ids = tk.encode(text or "", add_special_tokens=False).ids + [0]
        mine = sorted(pieces.pop(doc), key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(-(-len(ids) // CAPACITY)))
        for r in mine:
            part = ids[r.start : r.start + CAPACITY]
            assert (r.start, r.length) == (r.piece * CAPACITY, len(part))
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert not pieces
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return len(sequences), -(-sum(r.length for r in rows) // CAPACITY)


def test_every_piece_has_its_place(spark, tk, monkeypatch):
    rng = random.Random(2)
    docs = {i: " ".join("wandering"[: rng.randint(1, 9)] for _ in range(int(rng.expovariate(1 / 400)))) for i in range(400)}
    docs |= {1000: None, 1001: "", 1002: " \n", 1003: "word " * 30_000} | {2000 + i: "same text" for i in range(150)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").selectExpr("*", "'x' AS piece", "1 AS length").repartition(7)
    used, bound = check(packing.packed(df, tokenizer()).collect(), docs, tk)
    assert used <= bound * 1.01 + 1
    monkeypatch.setattr(packing, "SALTED", 20)
    assert check(packing.packed(df, tokenizer()).collect(), docs, tk)[0] == used


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    rows = packing.packed(df, tokenizer()).collect()
    assert sorted((r.doc_id or -1, r.length) for r in rows) == [(-1, 1), (-1, 2), (1, 3), (1, 3)]
    assert sorted((r.offset, r.length) for r in rows) == [(o, n) for o, n in sorted((r.offset, r.length) for r in rows)] and len({r.offset for r in rows}) == 4
    assert packing.packed(df.where("false"), tokenizer()).collect() == []


def test_a_worker_forgets_its_encoder_when_another_operator_begins():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some words"])], ["doc_id", "text"])
    for _ in packing._pieces(iter([batch]), tokenizer(), 2048):
        pass
    first = common.REMEMBERED["packing"][tokenizer()]
    for _ in packing._pieces(iter([batch]), tokenizer(), 2048):
        pass
    assert common.REMEMBERED["packing"][tokenizer()] is first
    assert list(common.leanly("near_dup", lambda batches: batches)(iter([batch]))) == [batch]
    assert "packing" not in common.REMEMBERED
