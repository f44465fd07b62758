"""Passages that repeat, word for word, found by seed and extend; later copies are cut out.

Words are runs outside space and 0x09-0x0D, unchanged. A window is WINDOW consecutive words of one
document. A window repeats if its word sequence also starts earlier: in a smaller doc_id, or
earlier in the same document. Every word covered by a repeating window goes.

1. Seeds. Each window elects the smallest hash among its runs of ANCHOR words (winnowing), so
   equal windows elect equal anchors, and about one word in seven is an anchor. Anchors that
   occur twice or more anywhere are the seeds; the join on them brings documents together.
2. Extension. Around each seed the match is extended to the left and the right, over the run of
   windows that elected it. Where all runs of a seed have the same words, as inside long copies,
   whole runs are compared; elsewhere, as at the ends of a passage, each window on its own. Both
   by a 128-bit hash of the words. Each task keeps the first place of every hash among its own
   rows, so that a passage found in a third of all documents meets only once per task.
3. Maximal repeats. Adjacent repeating windows merge into spans; nothing under WINDOW words is one.

Defined cases: a null text has no words; texts under WINDOW words have no window and stay whole.
Rows with a null id neither lose words nor count as an earlier place. Rows that share an id count
as one document for "earlier": equal places are no repeat of each other. Columns named in `carry`
pass through untouched, whatever their names; others are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch, carried, leanly, schema_of, settle
from stratastar.llm.words import GRAMS, GRAMS_2, OTHER, Powers, Words, chunks, mix, signed, sums_between, words_of

WINDOW = 20
ANCHOR = 8
#: Anchors in a window.
SPREAD = WINDOW - ANCHOR + 1
#: Candidate runs and windows that a task holds before it compares them among themselves.
HELD = 80_000


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i:i + width], by doubling."""
    out, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[:-step], out[step:])
        reach += step
    return out


@dataclass(frozen=True)
class Elected:
    """Windows of one chunk and what they elected, and the runs of windows that elected the same.

    `first` is a window's first word; run r is windows run[r]:run[r + 1], and `several[r]` tells
    that its anchor stands in it more than once.
    """

    first: np.ndarray
    anchor: np.ndarray
    run: np.ndarray
    several: np.ndarray


def elected(words: Words) -> Elected:
    at, hashes = words.grams(ANCHOR)
    if len(hashes) < SPREAD:
        none = np.zeros(0, np.int64)
        return Elected(none, np.zeros(0, np.uint64), np.zeros(1, np.int64), none)
    owner = words.owner()[at]
    whole = owner[: len(at) - SPREAD + 1] == owner[SPREAD - 1 :]
    least = _sliding_min(hashes, SPREAD)
    gram = np.flatnonzero(whole)
    first, anchor = at[gram], least[gram]
    opens = np.ones(len(first), bool)
    opens[1:] = (anchor[1:] != anchor[:-1]) | (gram[1:] != gram[:-1] + 1)
    run = np.append(np.flatnonzero(opens), len(first))
    if not len(first):
        return Elected(first, anchor, np.zeros(1, np.int64), np.zeros(0, bool))
    heads, tails = gram[run[:-1]], gram[run[1:] - 1] + SPREAD
    several = _occurrences(hashes, anchor[run[:-1]], heads, tails) > 1
    return Elected(first, anchor, run, several)


def _occurrences(hashes: np.ndarray, wanted: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """How often wanted[i] stands in hashes[heads[i]:tails[i]]."""
    size = tails - heads
    owner = np.repeat(np.arange(len(size)), size)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + heads[owner]
    return np.bincount(owner[hashes[inside] == wanted[owner]], minlength=len(size))


def _spans(words: Words, found: Elected, powers: Powers, values: np.ndarray) -> np.ndarray:
    """Hash of all words of every run."""
    start, size = found.first[found.run[:-1]], np.diff(found.run) + WINDOW - 1
    return mix(sums_between(values, powers, start, start + size) ^ size.astype(np.uint64))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, anchor, content, n, inner) once per document, anchor and words of its run.

    n is 2 if the anchor stands in the document more than once; inner: more than once in the run,
    so that the run may repeat windows of its own.
    """
    for batch in batches:
        for row, end, data, offsets in chunks(batch.column(1)):
            words = words_of(data, offsets)
            found = elected(words)
            if not len(found.first):
                continue
            heads = found.run[:-1]
            owner, anchor, content = words.owner()[found.first[heads]], found.anchor[heads], _spans(words, found, GRAMS, words.hashes)
            order = np.lexsort((content, anchor, owner))
            owner, anchor, content, several = owner[order], anchor[order], content[order], found.several[order]
            head = np.ones(len(anchor), bool)
            head[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]) | (owner[1:] != owner[:-1])
            head = np.flatnonzero(head)
            n = np.minimum(np.diff(np.append(head, len(anchor))) + several[head], 2).astype(np.int32)
            ids = batch.column(0).slice(row, end - row).take(pa.array(owner[head]))
            inner = pa.array(several[head])
            yield pa.RecordBatch.from_arrays([ids, pa.array(signed(anchor[head])), pa.array(signed(content[head])), pa.array(n), inner], ["doc_id", "anchor", "content", "n", "inner"])


_FOUND = ["hash_1", "hash_2", "doc_id", "row", "start", "length"]


def _compared(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Among the places held: the first one of every hash, and merged runs of those that come later."""
    one, two, doc, row, start, length = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((start, doc, two, one))
    one, two, doc, row, start, length = (x[order] for x in (one, two, doc, row, start, length))
    fresh = np.ones(len(one), bool)
    fresh[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    first = (doc == doc[head]) & (start == start[head])
    yield pa.RecordBatch.from_arrays([pa.array(x[first]) for x in (signed(one), signed(two), doc, row, start, length)], _FOUND)
    doc, row, start, length = doc[~first], row[~first], start[~first], length[~first]
    if len(doc):
        order = np.lexsort((start, row, doc))
        doc, row, start, end = doc[order], row[order], start[order], (start + length)[order]
        cut = np.ones(len(doc), bool)
        cut[1:] = (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]) | (start[1:] > end[:-1])
        head = np.flatnonzero(cut)
        last = np.append(head[1:], len(doc)) - 1
        blank = pa.nulls(len(head), pa.int64())
        yield pa.RecordBatch.from_arrays([blank, blank, *map(pa.array, (doc[head], row[head], start[head], end[last] - start[head]))], _FOUND)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of the seeds whose runs are all alike, and windows of the others, compared within this task."""
    parts, held = [], 0
    for batch in batches:
        ids, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for row, end, data, offsets in chunks(batch.column(2)):
            words = words_of(data, offsets)
            found = elected(words)
            alike, mixed = (np.unique(batch.column(i).slice(row, end - row).flatten().to_numpy()).view(np.uint64) for i in (3, 4))

            def add(first, one, two, length, words=words, row=row):
                nonlocal held
                owner = words.owner()[first]
                start = (first - words.first[owner]).astype(np.int32)
                parts.append((one, two, ids[row + owner], rows[row + owner], start, length.astype(np.int32)))
                held += len(start)

            heads = found.run[:-1]
            near = np.isin(found.anchor[heads], alike)
            if near.any():
                one = _spans(words, found, GRAMS, words.hashes)
                two = _spans(words, found, GRAMS_2, mix(words.hashes ^ OTHER))
                add(found.first[heads[near]], one[near], two[near], np.diff(found.run)[near])
            near = np.isin(found.anchor, mixed)
            if near.any():
                (_, one), (_, two) = words.grams(WINDOW), words.grams(WINDOW, second=True)
                add(found.first[near], one[near], two[near], np.ones(int(near.sum())))
            if held >= HELD:
                yield from _compared(parts)
                parts, held = [], 0
        pa.default_memory_pool().release_unused()
    if held:
        yield from _compared(parts)


def maximal_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, row, repeats): maximal spans [start, end) of words that stand earlier elsewhere.

    `row` tells rows of one id with different texts apart: Spark's hash of the text.
    """
    spark = settle(documents.sparkSession)
    scratch = Scratch(spark, "repeats")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("row"), F.col("text").cast("string").alias("text"))
    docs = docs.where("doc_id is not null and text is not null")
    anchors = docs.select("doc_id", "text").mapInArrow(leanly("substring_dedup", _anchors), "doc_id long, anchor long, content long, n int, inner boolean")
    anchors = scratch.store(anchors, "anchors")
    seeds = anchors.groupBy("anchor").agg(
        F.sum("n").alias("n"), (F.max("inner") | (F.min("content") != F.max("content"))).alias("mixed")
    )
    seeds = scratch.store(seeds.where("n > 1").select("anchor", "mixed"), "seeds")
    seeded = anchors.select("doc_id", "anchor").join(seeds, "anchor").groupBy("doc_id")
    seeded = seeded.agg(*(F.collect_set(F.when(which, F.col("anchor"))).alias(name) for name, which in (("alike", ~F.col("mixed")), ("mixed", F.col("mixed")))))
    seeded = scratch.store(seeded, "seeded")
    scratch.drop("anchors", "seeds")
    found = docs.join(seeded, "doc_id").select("doc_id", "row", "text", "alike", "mixed")
    found = scratch.store(found.mapInArrow(leanly("substring_dedup", _places), "hash_1 long, hash_2 long, doc_id long, row int, start int, length int"), "places")
    place = W.partitionBy("hash_1", "hash_2").orderBy("doc_id", "start")
    later = found.where("hash_1 is not null").withColumn("place", F.rank().over(place)).where("place > 1")
    later = later.select("doc_id", "row", "start", "length").unionByName(found.where("hash_1 is null").select("doc_id", "row", "start", "length"))
    runs = later.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("runs"))
    spans = scratch.store(runs.mapInArrow(leanly("substring_dedup", _merged), "doc_id long, row int, repeats array<struct<start:int,end:int>>"), "spans")
    scratch.keep("spans")
    return spans


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows, sorted per row, to maximal spans of words."""
    for batch in batches:
        runs = batch.column(2)
        flat = runs.flatten()
        counts = runs.value_lengths().to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(counts)), counts)
        start = flat.field(0).to_numpy().astype(np.int64)
        end = start + flat.field(1).to_numpy() + WINDOW - 1
        # Shifting each row past the others lets one running maximum serve all rows.
        shift = np.cumsum(np.concatenate([[0], np.maximum.reduceat(end, np.cumsum(counts) - counts)[:-1] + 1])) if len(counts) else counts
        low, high = start + shift[owner], np.maximum.accumulate(end + shift[owner])
        head = np.ones(len(low), bool)
        head[1:] = low[1:] > high[:-1]
        head = np.flatnonzero(head)
        last = np.append(head[1:], len(low)) - 1
        spans = pa.StructArray.from_arrays(
            [pa.array(start[head].astype(np.int32)), pa.array((high[last] - shift[owner[head]]).astype(np.int32))], ["start", "end"]
        )
        cuts = np.concatenate([[0], np.cumsum(np.bincount(owner[head], minlength=len(counts)))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(cuts), spans)], ["doc_id", "row", "repeats"])


def _kept(batches: Iterator[pa.RecordBatch], as_it_was: bool) -> Iterator[pa.RecordBatch]:
    """Columns doc_id, carried, n_words, n_removed, kept_text from doc_id, carried, text, repeats."""
    for batch in batches:
        for row, end, data, offsets in chunks(batch.column(2)):
            words = words_of(data, offsets)
            mine = batch.column(3).slice(row, end - row)
            counts = mine.value_lengths().fill_null(0).to_numpy()
            flat = mine.flatten()
            base = words.first[np.repeat(np.arange(end - row), counts)]
            cover = np.zeros(len(words.start) + 1, np.int32)
            np.add.at(cover, base + flat.field(0).to_numpy(zero_copy_only=False), 1)
            np.add.at(cover, base + flat.field(1).to_numpy(zero_copy_only=False), -1)
            stays = np.cumsum(cover[:-1]) == 0
            kept = np.bincount(words.owner()[stays], minlength=end - row)
            start, length = words.start[stays], (words.end - words.start)[stays]
            # One space after every kept word but the last of its text.
            gap = np.ones(len(start), np.int64)
            gap[np.cumsum(kept)[kept > 0] - 1] = 0
            stop = np.cumsum(length + gap)
            source = np.repeat(start - (stop - length - gap), length + gap) + np.arange(stop[-1] if len(stop) else 0)
            text = data[np.minimum(source, len(data) - 1)]
            text[(stop - 1)[gap > 0]] = 0x20
            cuts = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(kept)])].astype(np.int32)
            out = pa.StringArray.from_buffers(end - row, pa.py_buffer(cuts), pa.py_buffer(text))
            removed = words.counts - kept
            if as_it_was:
                out = pc.if_else(pa.array(removed > 0), out, batch.column(2).slice(row, end - row))
            ids, carried = (batch.column(i).slice(row, end - row) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([ids, carried, pa.array(words.counts), pa.array(removed), out], _KEPT)


_KEPT = ["doc_id", "carried", "n_words", "n_removed", "kept_text"]


def cut_repeats(documents: DataFrame, carry: tuple[str, ...] = (), as_it_was: bool = False) -> DataFrame:
    """Per row: doc_id, carried (a struct of the columns `carry`), n_words, n_removed, kept_text.

    kept_text has the kept words joined by one space; with `as_it_was` a text that loses nothing
    keeps its own white space (and a null stays null).
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), carried(carry), F.col("text").cast("string").alias("text"))
    spans = maximal_repeats(docs)
    joined = docs.withColumn("row", F.hash("text")).join(spans, ["doc_id", "row"], "left").select("doc_id", "carried", "text", "repeats")
    schema = schema_of(doc_id="long", carried=docs.schema["carried"].dataType, n_words="long", n_removed="long", kept_text="string")
    return joined.mapInArrow(leanly("substring_dedup", lambda batches: _kept(batches, as_it_was)), schema)
