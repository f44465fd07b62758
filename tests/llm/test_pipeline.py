"""The pipeline, stage by stage, against brute force on a small fixture."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from stratastar.llm import near_dup
from stratastar.llm.queries import tokenizer
from tests.llm import test_near_dup, test_packing, test_substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture():
    rng = random.Random(11)
    words = {"en": "the of and to in that with hat cat this which from house there".split(), "de": "der die und das nicht ein über zwei haus werden schön auch".split()}
    draw = lambda lang, n: " ".join(rng.choice(words[lang]) + str(rng.randrange(40)) for _ in range(n))
    docs = []
    passage = draw("en", 60)
    for i in range(150):
        lang = rng.choice(["en", "en", "de"])
        text = draw(lang, rng.randrange(5, 120))
        if i % 10 == 0:
            text += "\n" + passage
        docs.append((text, lang))
    docs += [(docs[i][0], docs[i][1]) for i in range(20)]  # exact copies
    docs += [(docs[i][0] + " end", docs[i][1]) for i in range(20, 40)]
    docs += [("12 ?! 34", "en"), (None, "en"), ("", None), (draw("en", 3000), "en"), (passage, "en")]
    docs = [(i, t, lang, f"src{i % 7}", len(t) if t else 0) for i, (t, lang) in enumerate(docs)]
    docs.append((7, docs[7][1], docs[7][2], docs[7][3], docs[7][4]))  # a repeated row
    docs.append((None, draw("en", 30), None, None, None))
    return docs


@pytest.fixture(scope="module")
def stages(spark):
    """Result of each stage on what the one before kept."""
    df = spark.createDataFrame(fixture(), SCHEMA).repartition(4)
    out = [df.collect()]
    for _, stage in pipeline.STAGES:
        result = stage(spark, df, "")
        rows = result.collect()
        df = spark.createDataFrame(rows, result.schema)
        out.append(rows)
    return out


def test_columns(stages):
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_stage_rejects_only_texts_without_language(stages):
    before, after = stages[0], stages[1]
    gone = Counter(before) - Counter(after)
    assert sorted(r.text or "" for r in gone) == ["", "", "12 ?! 34"] and not Counter(after) - Counter(before)


def test_near_duplicates_stage_keeps_one_of_each_group(stages):
    before, after = stages[1], stages[2]
    parts = test_near_dup.brute_force([(r.doc_id, r.text) for r in before if r.doc_id is not None], pipeline.NEAR)
    expected = sorted(i for i, (_, _, kept) in parts.items() if kept)
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == expected
    assert sum(r.doc_id is None for r in after) == 1 and not set(after) - set(before)


def test_repeats_stage(stages):
    before, after = stages[2], stages[3]
    expected = test_substring_dedup.brute_force([(r.doc_id, r.text) for r in before if r.doc_id is not None])
    by_id = {r.doc_id: r for r in after}
    for r in before:
        n, removed, text = expected.get(r.doc_id, (1, 0, None))
        if removed == n:
            assert r.doc_id not in by_id
        else:
            kept = by_id[r.doc_id]
            assert kept.text == (text if removed else r.text) and kept.n_chars == (len(text) if removed else r.n_chars)
            assert (kept.lang, kept.source) == (r.lang, r.source)
    assert any(x[1] for x in expected.values())


def test_mixing_stage_takes_whole_rows_up_to_twice(stages):
    before, after = Counter(stages[3]), Counter(stages[4])
    assert not set(after) - set(before) and max(after.values()) <= 2
    assert sum(len((r.text or "").split()) * n for r, n in after.items()) <= sum(len((r.text or "").split()) * n for r, n in before.items())


def test_packing_stage(stages):
    rows = stages[4]
    texts, seen = {}, Counter()
    # Rows taken twice pack twice: compare per id, as many times as it was taken.
    for r in rows:
        texts[r.doc_id] = r.text
        seen[r.doc_id] += 1
    packed = stages[5]
    assert Counter(r.doc_id for r in packed if r.piece == 0) == seen
    once, used = [], Counter()
    for r in sorted(packed, key=lambda r: (r.doc_id or -1, r.piece, r.sequence_id, r.offset)):
        used[(r.doc_id, r.piece)] += 1
        if used[(r.doc_id, r.piece)] == 1:
            once.append(r)
    tk = Tokenizer.from_file(tokenizer())
    for r in once:
        ids = tk.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert r.length == len(ids[r.start : r.start + 2048])
    assert test_packing.CAPACITY >= max(r.offset + r.length for r in packed)


def test_run_writes_and_rereads_every_stage(spark, tmp_path):
    spark.createDataFrame(fixture(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    stored = set(folder.iterdir())
    out = pipeline.run(spark, str(tmp_path))
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - stored] == ["packing"]  # nothing else stays
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and not out.isEmpty()


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        df = stage(spark, df, "")
        assert df.collect() == []


def test_one_of_repeated_rows_stays(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c d"), (2, "a b"), (None, "a b"), (None, "a b")], "doc_id long, text string").withColumn("text_hash", F.lit("clash"))
    got = sorted((r.doc_id or -1, r.text) for r in near_dup.without_near_duplicates(df).collect())
    assert got == [(-1, "a b"), (-1, "a b"), (1, "a b"), (1, "c d")]


def test_near_duplicates_stage_follows_its_threshold(spark, monkeypatch):
    words = [f"word{i}" for i in range(100)]
    copy = [*words[:30], "one", *words[31:70], "two", *words[71:]]
    df = spark.createDataFrame([(i, " ".join(w), "en", "src0", 1) for i, w in enumerate((words, copy))], SCHEMA)
    assert pipeline.NEAR == 80
    for percent, left in ((85, 2), (80, 1)):
        monkeypatch.setattr(pipeline, "NEAR", percent)
        assert pipeline.drop_near_duplicates(spark, df, "").count() == left


def test_columns_of_any_name(spark):
    """Names with dots and back quotes, and those that the operators use themselves, pass every stage."""
    rows = [(*r, "x", i, "y", 1) for i, r in enumerate(fixture()[:60])]
    names = "`a.b` string, `c``d` int, carried string, row int"
    df = spark.createDataFrame(rows, f"{SCHEMA}, {names}")
    for _, stage in pipeline.STAGES[:-1]:
        result = stage(spark, df, "")
        assert result.columns == df.columns
        df = spark.createDataFrame(result.collect(), result.schema)
    kept = df.collect()
    assert kept and all((r["a.b"], r["carried"], r["row"]) == ("x", "y", 1) for r in kept)
    assert pipeline.STAGES[-1][1](spark, df, "").count() >= len(kept)


FOREIGN = {
    "fi": "Tämä on suomenkielinen teksti joka ei kuulu mihinkään opituista kielistä ja siksi se pitäisi hylätä heti",
    "pl": "Ten tekst jest napisany po polsku i nie należy do żadnego z poznanych języków dlatego powinien odpaść szybko",
    "ru": "Этот текст написан по русски и не относится ни к одному из известных языков поэтому его надо отбросить",
    "tr": "Bu metin Türkçe yazılmıştır ve öğrenilen dillerin hiçbirine ait değildir bu yüzden reddedilmelidir",
    "zh": "这是一段中文文本不属于任何已学习的语言因此应当被拒绝",
    "none": "qzx vbkw jqpf xxzt wqvj kzzp fvbq xjwk zqpv bqxt jvkz pwqx",
}


def test_language_stage_on_foreign_and_clean_texts(spark):
    """Texts in no learned language go, whatever their length; every document with letters stays."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    more = [(10**9 + i, " ".join([text] * times), None, "src0", 1) for i, text in enumerate(FOREIGN.values()) for times in (1, 20)]
    more += [(2 * 10**9, "This text is written in English and so it stays here", None, "src0", 1), (2 * 10**9 + 1, "Der Text ist deutsch und bleibt", None, "src0", 1)]
    kept = pipeline.identify_language(spark, documents.unionByName(spark.createDataFrame(more, documents.schema)), "")
    assert sorted(r.doc_id for r in kept.where("doc_id >= 1000000000").collect()) == [2 * 10**9, 2 * 10**9 + 1]
    clean = documents.where(r"text rlike '\\p{L}'")
    assert kept.where("doc_id < 1000000000").count() == clean.count()


def test_text_is_not_carried_beside_itself(spark, monkeypatch):
    """The stage that cuts passages moves a text once and still returns the columns as they came."""
    seen, cut = [], pipeline.substring_dedup.cut_repeats
    monkeypatch.setattr(pipeline.substring_dedup, "cut_repeats", lambda docs, carry=(), **rest: seen.append(carry) or cut(docs, carry=carry, **rest))
    passage = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"a  {passage}", "en"), (2, f"{passage} b", "fr"), (3, None, None)], "doc_id long, text string, lang string")
    found = pipeline.cut_repeats(spark, docs, "")
    assert seen == [("doc_id", "lang")] and found.columns == docs.columns
    assert sorted(tuple(r) for r in found.collect()) == [(1, f"a  {passage}", "en"), (2, "b", "fr"), (3, None, None)]
