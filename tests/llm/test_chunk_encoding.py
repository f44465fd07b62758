"""Encoding with reused chunks against the tokenizer itself."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratastar.llm import chunk_encoding
from stratastar.llm.queries import tokenizer

FILE = tokenizer("byte_bpe_50k.json")
PARTS = ["a", "'", "r", "e", "ll", " ", "  ", "\n", "\t", "é", "ß", "漢", "1", ".", "!", "'re", "🙂", "the ", "<|endoftext|>", "<|endof", " ", " ", "word"]


@pytest.fixture(scope="module")
def tk():
    return Tokenizer.from_file(FILE)


def odd_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 1500))) for _ in range(60)]
    texts += [t[rng.randint(0, 30) :] + rng.choice(texts)[:700] for t in texts]
    return texts + ["a" * 30_000, " " * 20_000, "'" * 9000 + "re", "<|endoftext|>" * 200, "\n \n" * 3000, "".join(rng.choice("ab") for _ in range(20_000)), "é" * 9000, ""]


@pytest.mark.parametrize("share", [1.0, 0.5, 0.1])
def test_ids_with_shared_chunks(tk, monkeypatch, share):
    monkeypatch.setattr(chunk_encoding, "BLOCK", 4000)
    encoder, rng, texts = chunk_encoding.encoder_for(FILE), random.Random(4), odd_texts()
    for (_, text, pieces), whole in zip(chunk_encoding._texts(pa.array(texts), encoder.special), texts, strict=True):
        assert b"".join(text[a:b] for a, b, _ in pieces) == text == whole.encode()
        assert all(b - a <= chunk_encoding.MOST for a, b, _ in pieces)
        shared = {n: encoder.ids(text[a:b]) for n, (a, b, wall) in enumerate(pieces) if not wall and rng.random() < share}
        ids = chunk_encoding.ids_of(encoder, text, pieces, shared)
        assert ids.tolist() == tk.encode(whole, add_special_tokens=False).ids
        assert encoder.decoded(ids).decode() == tk.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=3), max_size=60), st.lists(st.integers(0, 200), max_size=8))
def test_any_cuts_are_repaired(parts, places):
    """Chunks cut anywhere, however short, with all of them reused."""
    encoder, whole = chunk_encoding.encoder_for(FILE), "".join(p for p in parts if p != "<|endoftext|>").replace("<|endoftext|>", "")
    chars = sorted({min(p, len(whole)) for p in places} | {0, len(whole)})
    at = [len(whole[:c].encode()) for c in chars]
    text = whole.encode()
    pieces = [(a, b, False) for a, b in zip(at[:-1], at[1:], strict=True)]
    shared = {n: encoder.ids(text[a:b]) for n, (a, b, _) in enumerate(pieces)}
    assert chunk_encoding.ids_of(encoder, text, pieces, shared).tolist() == encoder.tokenizer.encode(whole, add_special_tokens=False).ids


def test_bytes_that_are_no_utf8(tk):
    encoder = chunk_encoding.encoder_for(FILE)
    for ids in ([164], [164, 98, 164], [156, 120], [0, 50256, 220]):
        assert encoder.decoded(np.array(ids, encoder.dtype)).decode() == tk.decode(ids, skip_special_tokens=False)


def test_equal_passages_are_cut_alike():
    rng = random.Random(5)
    passage = " ".join(f"p{rng.randrange(1000)}" for _ in range(2000))
    texts = [f"{'x' * k} {passage} tail" for k in (0, 3, 77)]
    cuts = [{text[a:b] for a, b, _ in pieces} for _, text, pieces in chunk_encoding._texts(pa.array(texts), None)]
    assert len(set.intersection(*cuts)) >= 0.8 * len(cuts[0])


def test_whole_operator(spark, tk):
    texts = odd_texts()
    rng = random.Random(6)
    passage = " ".join(f"word{rng.randrange(300)}" for _ in range(3000))
    texts += [f"{t[:200]}{passage} {t[:50]}<|endoftext|>{passage}" for t in texts[:12]] + [passage] * 20 + [None, None, " "]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, passage), (3, texts[3])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("digest", F.lit(1)).withColumn("hash", F.lit("clash")).withColumn("held", F.lit(2))
    rows = chunk_encoding.encoded(df.repartition(6), FILE).collect()
    expected = []
    for i, t in docs:
        ids = tk.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tk.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)
    assert chunk_encoding.encoded(df.where("false"), FILE).collect() == []


def test_shared_chunks_are_encoded_once(spark, tmp_path):
    from stratastar.llm.common import Scratch, settle

    rng = random.Random(7)
    passage = " ".join(f"word{rng.randrange(300)}" for _ in range(3000))
    docs = [(i, f"start {i} {passage}") for i in range(50)]
    texts = settle(spark).createDataFrame(docs, "doc_id long, text string").selectExpr("unhex(sha2(text, 256)) AS digest", "text")
    scratch = Scratch(spark, "test")
    packed = texts.mapInArrow(chunk_encoding._compressed, "digest binary, packed binary")
    shared = chunk_encoding.shared_chunks(chunk_encoding.chunk_places(texts, FILE, scratch), packed, FILE, scratch)
    assert 0 < shared.count() == shared.select("hash").distinct().count() <= 2 * len(passage) / chunk_encoding.LEAST


def test_characters_of_unlike_class_go_to_the_tokenizer(tk):
    encoder = chunk_encoding.Encoder(FILE)
    assert encoder.ascii
    every = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    assert encoder.alike.isdisjoint(encoder.apart)
    texts = [f"a{c}b {c}{c} 1{c}" for c in every] + [f"x{c}y" for c in encoder.apart]
    assert all(encoder.ids(t.encode())[0].tolist() == tk.encode(t, add_special_tokens=False).ids for t in texts)
    encoder.apart.add("é")
    encoder.alike.discard("é")
    assert encoder.ids("é déjà".encode())[0].tolist() == tk.encode("é déjà", add_special_tokens=False).ids


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        chunk_encoding.Encoder(tokenizer("word_bpe_49k.json"))
