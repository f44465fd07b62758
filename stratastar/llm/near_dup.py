"""Near-duplicate documents by MinHash bands, checked with odd sketches and confirmed on full sets.

A document's set holds its distinct runs of five words (A-Z lower-cased); with fewer words the
whole sequence is its one member. Two documents link when 100 * |A and B| >= percent * |A or B|,
with a percent of 85 unless the caller gives another; a component is what links reach.

1. One pass over the texts gives, per document, the size and a 128-bit fingerprint of its set,
   MinHash samples as band keys (at 85 percent 36 keys of 7 samples, at 80 percent 46 of 6), and an odd sketch: 1024 further samples (the least
   hash in each of 1024 bins) each flip one of 2048 bits. Two sketches differ in few bits if
   the samples agree. Documents with equal sets are one class from here on.
2. Classes that share a band key stand in one bucket. Each is compared with the bucket's
   smallest member, first by sketch, then on full sets; confirmed links are contracted, and the
   smallest member, which has met everyone, leaves. A bucket whose members are all of one component
   is settled. This is repeated, with a new smallest member each time, as long as a round leaves at
   most SHARE of the pairs of different components in a bucket, so their number falls at each round.
   After that leads are drawn, one for about DRAWN members of a bucket, others at each round: copies of one
   text that link with few of each other are contracted so, without meeting all others. Nobody leaves then.
3. In what is left, or once it is FEW pairs per place, members of different components meet, again by
   sketch, then on full sets.
   So every two classes that share a bucket are connected, or compared and found apart.

A pair is left unconfirmed only if its sketches differ in more samples than the least similarity
gives, plus DEVIATIONS standard deviations (of the samples that differ between sets of these sizes,
and of the folding into bits) and SLACK samples. Two sets of the least similarity share no bucket
with a chance below 1e-6.

Defined cases: null or empty texts and texts without words have an empty set and link with
nothing. Rows with a null id link with nothing and are kept. Rows that share an id are each
judged by their own text; an id counts as linked if one of its rows is, so it ties what its rows
link with. Ties cannot occur: the component is its smallest id. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch, leanly, settle
from stratastar.llm.components import components
from stratastar.llm.words import Words, chunks, mix, signed, stream, words_of

SHINGLE = 5
PERCENT = 85
#: Chance that two sets of the least similarity share no band stays below MISSED, with MOST_SAMPLES samples at most.
MISSED = 1e-6
MOST_SAMPLES = 276
BINS = 1024
SKETCH_BITS = 2048
DEVIATIONS = 5
#: Samples allowed for besides, as the counts of small sets have longer tails than a normal law.
SLACK = 2

_U = np.uint64
_SCALE = (stream(21, MOST_SAMPLES) >> _U(32)).astype(np.uint32) | np.uint32(1)
_SHIFT = (stream(22, MOST_SAMPLES) >> _U(32)).astype(np.uint32)
_FOLD = stream(23, MOST_SAMPLES) | _U(1)
_BAND = stream(24, MOST_SAMPLES)
_BIN = stream(25, BINS)
#: A round is followed by another of its kind if at most this share of the pairs is left.
SHARE = 0.5
#: Pairs per place in a bucket up to which the rest meets without a further round.
FEW = 4
#: Members of a bucket that get one lead when leads are drawn.
DRAWN = 8
#: Documents (three numbers each, 12 MB in all) up to which those to confirm are broadcast.
BROADCAST_ROWS = 500_000
#: Values of one block of samples; it stays in the cache of a core.
_BLOCK = 1024


def bands_of(percent: int) -> tuple[int, int]:
    """Bands and samples of a band: the longest bands that keep to MISSED and MOST_SAMPLES."""
    for rows in range(MOST_SAMPLES, 0, -1):
        alike = (percent / 100) ** rows
        bands = 1 if alike == 1 else math.ceil(math.log(MISSED) / math.log1p(-alike))
        if bands * rows <= MOST_SAMPLES:
            return bands, rows
    raise ValueError(f"a similarity of {percent} percent needs more than {MOST_SAMPLES} samples")


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct member hashes of every text, one text after another, and their number per text."""
    counts = words.counts
    at, hashes = words.grams(SHINGLE)
    sizes = np.maximum(counts - SHINGLE + 1, 0)
    for k in range(1, SHINGLE):
        short = np.flatnonzero(counts == k)
        if len(short):
            starts, grams = words.grams(k)
            whole = grams[np.searchsorted(starts, words.first[short])]
            place = np.searchsorted(at, words.first[short])
            at = np.insert(at, place, words.first[short])
            hashes = np.insert(hashes, place, whole)
            sizes[short] = 1
    ends = np.cumsum(sizes)
    for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
        if size > 1:
            hashes[end - size : end].sort()
    owner = np.repeat(np.arange(len(counts)), sizes)
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.bincount(owner[fresh], minlength=len(counts))


def samples_of(members: np.ndarray, sizes: np.ndarray, count: int) -> np.ndarray:
    """(sample, text) MinHash values of non-empty sets laid one after another."""
    out = np.full((count, len(sizes)), np.uint32(0xFFFFFFFF))
    x = (members >> _U(32)).astype(np.uint32)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    block = np.empty((count, _BLOCK), np.uint32)
    for at in range(0, len(x), _BLOCK):
        part = x[at : at + _BLOCK]
        values = block[:, : len(part)]
        np.multiply(_SCALE[:count, None], part[None, :], out=values)
        values += _SHIFT[:count, None]
        low, high = np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + len(part), "left")
        cuts = np.maximum(starts[low:high] - at, 0)
        out[:, low:high] = np.minimum(out[:, low:high], np.minimum.reduceat(values, cuts, axis=1))
    return out


def band_keys(samples: np.ndarray, rows: int) -> np.ndarray:
    """(text, band): one key per band of `rows` samples."""
    bands = len(samples) // rows
    keys = np.zeros((samples.shape[1], bands), np.uint64)
    for band in range(bands):
        folded = np.full(samples.shape[1], _BAND[band])
        for row in range(rows):
            folded += samples[band * rows + row].astype(np.uint64) * _FOLD[row]
        keys[:, band] = mix(folded)
    return keys


def odd_sketches(members: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, word of 64 bits), and the number of samples per text.

    A sample is the least member of one bin; it flips the bit that it and its bin hash to.
    """
    texts = len(sizes)
    h = mix(members ^ _U(0x6A09E667F3BCC909))
    place = np.repeat(np.arange(texts), sizes) * BINS + (h % _U(BINS)).astype(np.int64)
    least = np.full(texts * BINS, ~_U(0))
    np.minimum.at(least, place, h >> _U(10))
    filled = np.flatnonzero(least != ~_U(0))
    bit = (mix(least[filled] ^ _BIN[filled % BINS]) % _U(SKETCH_BITS)).astype(np.int64)
    flips = np.bincount(bit + filled // BINS * SKETCH_BITS, minlength=texts * SKETCH_BITS) & 1
    bits = np.packbits(flips.astype(np.uint8).reshape(texts, SKETCH_BITS), axis=1, bitorder="little").view(np.int64)
    return bits, np.bincount(filled // BINS, minlength=texts)


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (rows + 1) * width, width, dtype=np.int32)), pa.array(values.ravel()))


def _sketch(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    bands, of = bands_of(percent)
    for batch in batches:
        for row, end, data, offsets in chunks(batch.column(1), rows=512):
            members, sizes = shingle_sets(words_of(data, offsets, lower=True))
            full = np.flatnonzero(sizes)
            own = [batch.column(i).slice(row, end - row) for i in (0, 2)]
            none = np.flatnonzero(sizes == 0)
            if len(none):
                blank = pa.nulls(len(none), pa.int64())
                empty = pa.nulls(len(none), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(none)) for c in own), pa.array(sizes[none]), blank, blank, empty, empty], _NAMES)
            if len(full):
                heads = np.cumsum(sizes[full]) - sizes[full]
                one = np.add.reduceat(mix(members), heads)
                two = np.add.reduceat(mix(members ^ _U(0x5851F42D4C957F2D)), heads)
                samples = samples_of(members, sizes[full], bands * of)
                sketches, _ = odd_sketches(members, sizes[full])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.take(pa.array(full)) for c in own),
                        pa.array(sizes[full]),
                        pa.array(signed(one)),
                        pa.array(signed(two)),
                        _lists(signed(band_keys(samples, of))),
                        _lists(sketches),
                    ],
                    _NAMES,
                )


_NAMES = ["doc_id", "text_hash", "n_shingles", "print_1", "print_2", "bands", "sketch"]
_SCHEMA = "doc_id long, text_hash long, n_shingles long, print_1 long, print_2 long, bands array<long>, sketch array<long>"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in chunks(batch.column(1)):
            members, sizes = shingle_sets(words_of(data, offsets, lower=True))
            cuts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(cuts), pa.array(signed(members)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), sets], ["doc_id", "members"])


def differing(one: Column, two: Column) -> Column:
    """Samples that two sets do not share, estimated from the bits in which their odd sketches differ."""
    bits = SKETCH_BITS
    apart = sum((F.bit_count(one[i].bitwiseXOR(two[i])) for i in range(bits // 64)), F.lit(0))
    return -F.lit(bits / 2) * F.log(F.greatest(1 - 2 * apart / F.lit(bits), F.lit(1e-9)))


def _likely(a: str, b: str, percent: int = PERCENT) -> Column:
    """Neither the sizes nor the sketches rule the link out."""
    least = percent / 100
    n, m = F.col(f"n_{a}"), F.col(f"n_{b}")
    fits = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    # What exactly the least similarity gives, per bin: members in all, in both sets, in one only.
    load = (n + m) / (1 + least) / BINS
    both = least * load
    alone = [F.greatest(x / BINS - both, F.lit(0.0)) for x in (n, m)]
    # Chances that the bin is empty in one set and in both, and mean and variance of its samples apart:
    # one if it is empty in one set, two if its least members differ. The sizes are known, so what their
    # chance would add is taken off: per kind of member, its number times the square of its effect.
    empty, none = [F.exp(-x / BINS) for x in (n, m)], F.exp(-load)
    share = (1 - none) / load
    slope = (none - share) / load
    mean = 2 - empty[0] - empty[1] - 2 * both * share
    one = empty[0] + empty[1] - 2 * none
    effects = both * F.pow(empty[0] + empty[1] - 2 * share - 2 * both * slope, 2)
    effects += sum((x * F.pow(e - 2 * both * slope, 2) for x, e in zip(alone, empty, strict=True)), F.lit(0.0))
    sampling = BINS * F.greatest(2 * mean - one - mean * mean - effects, F.lit(0.0))
    apart = F.greatest(BINS * mean, F.lit(1.0))
    two, four = F.pow(F.lit(1 - 2 / SKETCH_BITS), apart), F.pow(F.lit(1 - 4 / SKETCH_BITS), apart)
    folding = (SKETCH_BITS / 4 * (1 - four) + SKETCH_BITS**2 / 4 * (four - two * two)) / (two * two)
    most = BINS * mean + DEVIATIONS * F.sqrt(sampling + F.greatest(folding, F.lit(0.0))) + SLACK
    return fits & (differing(F.col(f"s_{a}"), F.col(f"s_{b}")) <= most)


def _confirmed(pairs: DataFrame, docs: DataFrame, reps: DataFrame, repeated: bool, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Those pairs (a, b) of classes that link, by the full sets of a document of each."""
    pairs = scratch.store(pairs, f"{name}-pairs")
    concerned = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(reps, "class")
    concerned = scratch.store(concerned, f"{name}-concerned")
    # Few documents are looked for in the scan itself; beyond that the join shuffles.
    few = concerned.count() <= BROADCAST_ROWS
    texts = docs.join(F.broadcast(concerned) if few else concerned, ["doc_id", "text_hash"]).select("class", "text")
    if repeated:  # a row that is there more than once, word for word, counts once
        texts = texts.dropDuplicates(["class"])
    sets = scratch.store(texts.mapInArrow(leanly("near_dup", _sets), "class long, members array<long>"), f"{name}-sets")
    of = lambda side: sets.select(F.col("class").alias(side), F.col("members").alias(f"m_{side}"))
    both = F.size(F.array_intersect("m_a", "m_b"))
    linked = pairs.join(of("a"), "a").join(of("b"), "b").where(100 * both >= percent * (F.size("m_a") + F.size("m_b") - both))
    links = scratch.store(linked.select("a", "b"), f"{name}-links")
    scratch.drop(f"{name}-pairs", f"{name}-concerned", f"{name}-sets")
    return links


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of `documents` (doc_id, text): doc_id, n_shingles, component_id, kept, text_hash.

    text_hash (Spark's xxhash64 of the text) tells rows of one id apart.
    """
    spark = settle(documents.sparkSession)
    scratch = Scratch(spark, "near-dup")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    every = scratch.store(docs.mapInArrow(leanly("near_dup", lambda batches: _sketch(batches, percent)), _SCHEMA), "sketches")

    # A class is one set, whatever ids hold it. Its number is fixed once it is stored.
    rows = every.select("doc_id", "text_hash", "n_shingles", "print_1", "print_2")
    of_set = rows.where("n_shingles > 0 and doc_id is not null").groupBy("print_1", "print_2").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"))
    of_set = of_set.select("print_1", "print_2", F.monotonically_increasing_id().alias("class"), "rep.doc_id", "rep.text_hash")
    classes = scratch.store(of_set, "classes")
    reps = classes.select("class", "doc_id", "text_hash")
    repeated = not rows.where("doc_id is not null").groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    chosen = every.drop("text_hash").join(classes.drop("text_hash"), ["print_1", "print_2", "doc_id"]).dropDuplicates(["class"])
    chosen = scratch.store(chosen.select("class", "n_shingles", "bands", "sketch"), "chosen")
    # An id with several sets ties their classes together.
    own, prints = rows.where("n_shingles > 0 and doc_id is not null"), F.struct("print_1", "print_2")
    several = own.groupBy("doc_id").agg(F.min(prints).alias("x"), F.max(prints).alias("y")).where("x < y").select("doc_id")
    ids = own.join(several, "doc_id").join(classes.select("print_1", "print_2", "class"), ["print_1", "print_2"])
    ids = scratch.store(ids.select("doc_id", "class").distinct(), "ids")
    tied = ids.join(ids.groupBy("doc_id").agg(F.min("class").alias("a")), "doc_id").where(F.col("class") != F.col("a"))
    tied = tied.select("a", F.col("class").alias("b")).distinct()
    links = [scratch.store(tied, "tied")]
    banded = chosen.select("class", F.explode("bands").alias("key"))
    several = banded.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x < y").select("key")
    buckets = scratch.store(banded.join(several, "key").select("key", "class"), "buckets-0")
    parts = None if links[0].isEmpty() else components(links[0], scratch, "parts-0")

    def looked_up(side: str, *more: str) -> DataFrame:
        return chosen.select(F.col("class").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in more))

    def placed(buckets: DataFrame, parts: DataFrame | None, name: str) -> DataFrame:
        """(key, class, part, lead, lead_part, n, pairs) of the buckets that still hold several components.

        n is a bucket's number of members, pairs that of its pairs of different components.
        """
        if parts is None:
            buckets = buckets.withColumn("part", F.col("class"))
        else:
            buckets = buckets.join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn("part", F.coalesce("component", "class"))
        buckets = scratch.store(buckets.select("key", "class", "part"), f"{name}-placed")
        by_part = buckets.groupBy("key", "part").agg(F.min("class").alias("class"), F.count("*").cast("double").alias("of"))
        head, n = F.min(F.struct("class", "part")).alias("head"), F.sum("of").alias("n")
        open_ones = by_part.groupBy("key").agg(head, F.count("*").alias("parts"), n, F.sum(F.col("of") * F.col("of")).alias("alike")).where("parts > 1")
        apart = ((F.col("n") * F.col("n") - F.col("alike")) / 2).alias("pairs")
        open_ones = open_ones.select("key", F.col("head.class").alias("lead"), F.col("head.part").alias("lead_part"), "n", apart)
        out = scratch.store(buckets.join(open_ones, "key"), name)
        scratch.drop(f"{name}-placed")
        return out

    turn, before, drawn = 0, None, False
    while True:
        live = placed(buckets, parts, f"live-{turn}")
        scratch.drop(f"buckets-{turn}")
        pairs, places = live.agg(F.sum(F.col("pairs") / F.col("n")), F.count("*")).first()
        if not pairs or (turn and pairs <= FEW * places):
            break
        if turn and pairs > SHARE * before:
            if drawn:
                break
            drawn = True
        before = pairs
        stars = (_drawn(live, turn) if drawn else live).where("part <> lead_part")
        stars = stars.select(F.least("lead", "class").alias("a"), F.greatest("lead", "class").alias("b")).distinct()
        stars = stars.join(looked_up("a"), "a").join(looked_up("b"), "b").where(_likely("a", "b", percent)).select("a", "b")
        found = _confirmed(stars, docs, reps, repeated, percent, scratch, f"star-{turn}")
        buckets = (live if drawn else live.where("class <> lead")).select("key", "class")
        buckets = scratch.store(buckets, f"buckets-{turn + 1}")
        scratch.drop(f"live-{turn}")
        if not found.isEmpty():
            links.append(found)
            parts = _joined(links, scratch, f"parts-{turn + 1}")
        turn += 1

    if pairs:
        sides = {}
        for side in ("a", "b"):
            own = live.select("key", F.col("class").alias(side), F.col("part").alias(f"part_{side}"))
            sides[side] = own.join(looked_up(side, "bands"), side)
        left, right = sides["a"], sides["b"]
        apart = (F.col("part_a") != F.col("part_b")) & (F.col("a") < F.col("b")) & _likely("a", "b", percent)
        # Two classes may share several buckets; they meet in the first.
        shared = F.array_position(F.zip_with("bands_a", "bands_b", lambda x, y: x == y), True)
        meets = left.join(right, (left["key"] == right["key"]) & apart & (shared == F.array_position(F.col("bands_a"), left["key"])))
        found = _confirmed(meets.select("a", "b").distinct(), docs, reps, repeated, percent, scratch, "meet")
        if not found.isEmpty():
            links.append(found)
            parts = _joined(links, scratch, "parts-last")

    component = F.col("doc_id")
    named = classes.select("print_1", "print_2", "class", "doc_id")
    if parts is not None:
        named = named.join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn("part", F.coalesce("component", "class"))
        named = scratch.store(named.select("print_1", "print_2", "part", "doc_id"), "named")
        named = named.join(named.groupBy("part").agg(F.min("doc_id").alias("least")), "part")
        component = F.col("least")
    named = named.select("print_1", "print_2", component.alias("component_id"))
    out = rows.join(named, ["print_1", "print_2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    out = scratch.store(out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "text_hash"), "out")
    scratch.keep("out")
    return out


def _drawn(live: DataFrame, turn: int) -> DataFrame:
    """`live` with a lead for about DRAWN members of a bucket each, drawn by hashes that change with `turn`."""
    slots = F.greatest(F.ceil(F.col("n") / DRAWN), F.lit(1))
    live = live.drop("lead", "lead_part").withColumn("slot", F.pmod(F.xxhash64("key", "class", F.lit(turn)), slots))
    heads = live.groupBy("key", "slot").agg(F.min(F.struct(F.xxhash64("class", "key", F.lit(turn)).alias("draw"), "class", "part")).alias("head"))
    heads = heads.select("key", "slot", F.col("head.class").alias("lead"), F.col("head.part").alias("lead_part"))
    return live.join(heads, ["key", "slot"])


def _joined(links: list[DataFrame], scratch: Scratch, name: str) -> DataFrame:
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    return components(edges, scratch, name)


def without_near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows of `documents` that stay, with all their columns: of each component the document with the
    smallest id, and of rows that repeat it by id and text, one. Rows with a null id all stay."""
    scratch = Scratch(documents.sparkSession, "near-dup-stay")
    judged = near_duplicates(documents, percent).select("doc_id", "text_hash", "kept")
    gone = scratch.store(judged.where("not kept").select("doc_id", "text_hash").distinct(), "gone")
    again = judged.where("kept and doc_id is not null").groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash")
    again = scratch.store(again, "again")

    def same(other: DataFrame) -> Column:
        return (documents["doc_id"].cast("long") == other["doc_id"]) & (F.xxhash64(documents["text"].cast("string")) == other["text_hash"])

    apart = gone.unionByName(again)
    rest = documents.join(apart, same(apart), "left_anti")
    if again.isEmpty():
        return rest
    repeated = documents.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.unionByName(repeated)
