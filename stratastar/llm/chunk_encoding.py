"""Byte-level BPE of whole texts, with content-defined chunks that several texts share encoded once.

1. Cut. A rolling hash over the last WINDOW bytes decides where a text is cut, so equal passages
   are cut alike wherever they lie. Strings of special tokens are pieces of their own.
2. Share. Chunks that occur in more than one distinct text are encoded once each, by the text of
   the least digest that holds them.
3. Repair. A chunk was encoded without its surroundings, so around its two ends the ids may differ
   from those of the whole text. A text is encoded from left to right: what lies between shared
   chunks, with some text on both sides, is re-encoded, and wider and wider until the new
   encoding and the chunk's own agree on a boundary between words.

Why agreement is exact: the pattern that splits a text into words looks back at nothing, and at
most two characters ahead of a match. So from a boundary of the whole text on, an encoding of a part of
it has the same boundaries up to two characters before the part's end, and from a boundary that
both share on, a chunk's words are the text's words. A word's ids depend on the word alone.

Words are found by the same pattern in `regex`, and a word's ids are remembered. A character that
`regex` and the tokenizer file's own splitter do not class alike (asked once per character) sends
its piece of text to the tokenizer as it is.

Only tokenizer files of that kind are accepted: byte-level BPE with its usual pattern, no
normaliser, no added prefix space, no dropout, and added tokens taken as they are.

A text that occurs more than once is encoded once as well. Texts are compared by SHA-256, chunks by a
128-bit hash. Texts travel between tasks compressed, twice: to those that encode shared chunks, and
to those that put ids together.

Defined cases: a null text counts as empty and has no ids. Rows that repeat, and rows without a
doc_id, give a row each. An empty table gives an empty result. Other columns are not read. A text
has to fit in one task, with its ids.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch, settle
from stratastar.llm.words import Powers, chunks, stream, sums_between

#: Bytes that decide on a cut, and bits of their hash that have to be zero: a cut in 512 places.
WINDOW = 32
BITS = 9
LEAST, MOST = 128, 4096
#: Words at a chunk's start that the first re-encoding covers.
HEAD = 6
#: Two characters of UTF-8 are at most this long.
AHEAD = 8
#: Bytes encoded in one call.
BLOCK = 1 << 18
#: Words whose ids a task remembers; of two generations the older one goes.
REMEMBERED = 200_000

#: Fixed value: the pattern of byte-level BPE files.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_ROLL = Powers(0x9FB21C651E98DF25 | 1)
_CODE = stream(13, 256)

# ---------------------------------------------------------------- cutting


def candidates(data: np.ndarray) -> np.ndarray:
    """Places where the rolling hash asks for a cut: the first byte of a character, WINDOW bytes in at least."""
    found = []
    for begin in range(0, max(0, len(data) - WINDOW), 1 << 20):
        part = data[begin : begin + (1 << 20) + WINDOW]
        start = np.arange(len(part) - WINDOW)
        rolled = sums_between(_CODE[part], _ROLL, start, start + WINDOW)
        at = np.flatnonzero(rolled >> np.uint64(64 - BITS) == 0) + WINDOW
        found.append(begin + at[part[at] & 0xC0 != 0x80])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def cut(text: bytes, places: list[int], special: re.Pattern[bytes] | None) -> list[tuple[int, int, bool]]:
    """(start, end, is a special token) of a text's pieces, in order and without gaps."""
    out: list[tuple[int, int, bool]] = []
    walls = [m.span() for m in special.finditer(text)] if special else []
    at, i = 0, 0
    for a, b in [*walls, (len(text), len(text))]:
        while at < a:
            while i < len(places) and places[i] < at + LEAST:
                i += 1
            end = places[i] if i < len(places) else a
            if end - at > MOST:
                end = at + MOST
                while end < a and text[end] & 0xC0 == 0x80:
                    end -= 1
            end = min(end, a)
            out.append((at, end, False))
            at = end
        if a < b:
            out.append((a, b, True))
            at = b
    return out


def _texts(column: pa.Array, special: re.Pattern[bytes] | None) -> Iterator[tuple[int, bytes, list[tuple[int, int, bool]]]]:
    """(row, text, its pieces) of every row."""
    for row, end, data, offsets in chunks(column):
        places, raw = candidates(data), data.tobytes()
        bounds = np.searchsorted(places, offsets)
        for n in range(end - row):
            a, b = int(offsets[n]), int(offsets[n + 1])
            # A window lies inside its text, so equal texts are cut alike.
            own = places[bounds[n] : bounds[n + 1]] - a
            text = raw[a:b]
            yield row + n, text, cut(text, own[own >= WINDOW].tolist(), special)


# ---------------------------------------------------------------- encoding


class Encoder:
    """A tokenizer file of the kind described above."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        read = json.loads(Path(path).read_text())
        _check(read)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = {t["content"].encode(): t["id"] for t in read["added_tokens"]}
        self.special_ids = added
        self.special = re.compile(b"|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        byte_of = {c: b for b, c in _byte_letters().items()}
        size = max([*read["model"]["vocab"].values(), *added.values()]) + 1
        table = [b""] * size
        for token, i in read["model"]["vocab"].items():
            table[i] = bytes(byte_of[c] for c in token)
        for token, i in added.items():
            table[i] = token
        self.lengths = np.array([len(t) for t in table], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        self.letters = "".join(_byte_letters()[b] for b in range(256))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: Characters that `regex` classes as the tokenizer does, and others.
        self.alike: set[str] = set()
        self.apart: set[str] = set()
        self.ascii = self._classed({chr(c) for c in range(128)})

    def _classed(self, characters: set[str]) -> bool:
        """Whether both splitters class all of these characters alike."""
        for c in characters - self.alike - self.apart:
            # Only c's class (letter, number, space, other) decides where this text is split.
            probe = f"a{c}a1{c}1!{c}! {c} {c}{c}\n{c}a"
            split = [len(part) for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
            (self.alike if split == [len(w.encode()) for w in PATTERN.findall(probe)] else self.apart).add(c)
        return self.apart.isdisjoint(characters)

    def ids(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a piece of text that holds no special token, and whether each begins a word."""
        whole = text.decode()
        if not (self.ascii and (whole.isascii() or self._classed(set(whole)))):
            found = self.tokenizer.encode(whole, add_special_tokens=False)
            return np.array(found.ids, self.dtype), np.diff(np.array(found.word_ids, np.int64), prepend=-1) != 0
        words = PATTERN.findall(whole)
        if len(self.known) >= REMEMBERED:
            self.known, self.older = {}, self.known
        entries = list(map(self.known.get, words))
        for n in [n for n, entry in enumerate(entries) if entry is None]:
            entry = self.known.get(words[n]) or self.older.get(words[n])
            self.known[words[n]] = entries[n] = entry or self._word(words[n])
        size = np.fromiter(map(len, entries), np.int64, len(entries)) // self.dtype.itemsize
        ids = np.frombuffer(b"".join(entries), self.dtype)
        begins = np.zeros(len(ids), bool)
        begins[np.cumsum(size) - size] = True
        return ids, begins

    def _word(self, word: str) -> bytes:
        spelt = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(spelt)], self.dtype).tobytes()

    def decoded(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, one after another; what is not UTF-8 becomes the replacement character."""
        out = []
        for begin in range(0, len(ids), BLOCK):
            part = ids[begin : begin + BLOCK]
            size = self.lengths[part]
            behind = np.cumsum(size)
            out.append(self.bytes[np.arange(behind[-1]) + np.repeat(self.begins[part] - behind + size, size)].tobytes())
        return b"".join(out).decode("utf-8", "replace").encode()


def _byte_letters() -> dict[int, str]:
    """The letter for every byte: itself where printable, else from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + n) for n, b in enumerate(rest)}}


def _check(read: dict) -> None:
    before, model = read["pre_tokenizer"] or {}, read["model"]
    fits = (
        read["normalizer"] is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
        and model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        and not any(t.get(k) for t in read["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        and (read["decoder"] or {}).get("type") == "ByteLevel"
    )
    if not fits:
        raise ValueError("chunk reuse needs a byte-level BPE file with the usual pattern and no normaliser")


_ENCODERS: dict[str, Encoder] = {}


def encoder_for(path: str) -> Encoder:
    """One encoder per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


@dataclass(frozen=True)
class Held:
    """An encoded chunk at its place in a text: boundaries between its words, in bytes and in ids."""

    start: int
    end: int
    ids: np.ndarray
    words: np.ndarray
    places: np.ndarray

    @staticmethod
    def of(start: int, ids: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> Held:
        behind = np.cumsum(lengths[ids]) + start
        words = np.flatnonzero(begins)
        return Held(start, int(behind[-1]), ids, words, np.where(words > 0, behind[words - 1], start))


def joined(encoder: Encoder, text: bytes, begin: int, end: int, held: list[Held]) -> Iterator[np.ndarray]:
    """Ids of text[begin:end], which holds no special token, with the ids of `held` chunks of it reused."""
    at, i, failures = begin, 0, 0
    while at < end:
        target = held[i] if i < len(held) else None
        stop = target.start if target else end
        if stop - at > BLOCK:
            # A long way: the words that are certain, block by block.
            size = BLOCK
            while True:
                new = Held.of(at, *encoder.ids(text[at : _character(text, min(at + size, end))]), encoder.lengths)
                sure = len(new.places) - 1 if new.end == end else int(np.searchsorted(new.places, new.end - AHEAD, "right")) - 1
                if new.end == end or sure > 0:
                    break
                size *= 2
            if new.end == end:
                yield new.ids
                return
            yield new.ids[: new.words[sure]]
            at = int(new.places[sure])
            while i < len(held) and held[i].start < at:
                i += 1
            continue
        if target is None:
            yield encoder.ids(text[at:end])[0]
            return
        agreed = None
        if target.start == at:
            agreed = 0
        else:
            for last in (int(target.places[HEAD]), target.end) if len(target.places) > HEAD else (target.end,):
                new = Held.of(at, *encoder.ids(text[at:last]), encoder.lengths)
                sure = new.places if last == end else new.places[new.places <= last - AHEAD]
                common = np.intersect1d(sure, target.places, assume_unique=True)
                if len(common):
                    yield new.ids[: new.words[np.searchsorted(new.places, common[0])]]
                    agreed = int(np.searchsorted(target.places, common[0]))
                    break
        if agreed is None:
            # This chunk, and more of them each time, is encoded along with what comes before it.
            i += 2**failures
            failures += 1
            continue
        failures = 0
        sure = max(agreed, int(np.searchsorted(target.places, target.end - AHEAD, "right")) - 1)
        yield target.ids[target.words[agreed] : target.words[sure]]
        at = int(target.places[sure])
        i += 1


def _character(text: bytes, at: int) -> int:
    """The last beginning of a character up to `at`."""
    while at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return at


def ids_of(encoder: Encoder, text: bytes, pieces: list[tuple[int, int, bool]], shared: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Ids of a whole text; `shared` has ids and word beginnings of some of its pieces by number."""
    out: list[np.ndarray] = []
    begin, held = 0, []
    for n, (a, b, wall) in enumerate([*pieces, (len(text), len(text), True)]):
        if wall:
            out += joined(encoder, text, begin, a, held)
            begin, held = b, []
            if a < b:
                out.append(np.array([encoder.special_ids[text[a:b]]], encoder.dtype))
        elif n in shared:
            held.append(Held.of(a, *shared[n], encoder.lengths))
    return np.concatenate(out) if out else np.zeros(0, encoder.dtype)


# ---------------------------------------------------------------- tasks


def _chunk_hashes(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Per (digest, text) row the hashes of its chunks; null for a special token."""
    encoder = encoder_for(path)
    for batch in batches:
        hashes, ends = [], [0]
        for _, text, pieces in _texts(batch.column(1), encoder.special):
            hashes += [None if wall else hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b, wall in pieces]
            ends.append(len(hashes))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes, pa.binary()))], ["digest", "hashes"])


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([press(t.as_buffer()) for t in batch.column(1)], pa.binary())], ["digest", "packed"])


def _unpacked(column: pa.Array) -> pa.Array:
    opened = zstandard.ZstdDecompressor().decompress
    return pa.array([opened(t.as_buffer()) for t in column], pa.binary())


def _encoded_chunks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Ids of the chunks that each (digest, packed, owned) row is to encode."""
    encoder = encoder_for(path)
    for batch in batches:
        first = np.concatenate([[0], np.cumsum(batch.column(2).value_lengths().to_numpy())]).tolist()
        number, hashes = batch.column(2).flatten().flatten()
        number, ids, begins = number.to_pylist(), [], []
        for row, text, pieces in _texts(_unpacked(batch.column(1)), encoder.special):
            for k in range(first[row], first[row + 1]):
                a, b, _ = pieces[number[k]]
                found, begin = encoder.ids(text[a:b])
                ids.append(found.tobytes())
                begins.append(np.packbits(begin).tobytes())
        yield pa.RecordBatch.from_arrays([hashes, pa.array(ids, pa.binary()), pa.array(begins, pa.binary())], ["hash", "ids", "begins"])


def _assembled(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = encoder_for(path)
    for batch in batches:
        lists = batch.column(2)
        first = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        number, ids, begins = lists.flatten().flatten()
        number = number.to_numpy(zero_copy_only=False)
        n_tokens, ids_sha, text_sha = [], [], []
        for row, text, pieces in _texts(_unpacked(batch.column(1)), encoder.special):
            shared = {}
            for k in range(first[row], first[row + 1]):
                own = np.frombuffer(ids[k].as_buffer(), encoder.dtype)
                bits = np.unpackbits(np.frombuffer(begins[k].as_buffer(), np.uint8), count=len(own))
                shared[int(number[k])] = own, bits
            found = ids_of(encoder, text, pieces, shared)
            n_tokens.append(len(found))
            ids_sha.append(hashlib.sha256(found.astype("<u4").tobytes()).hexdigest())
            text_sha.append(hashlib.sha256(encoder.decoded(found)).hexdigest())
        columns = [batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["digest", "n_tokens", "ids_sha256", "decoded_sha256"])


# ---------------------------------------------------------------- operator


def chunk_places(texts: DataFrame, tokenizer: str, scratch: Scratch) -> DataFrame:
    """(digest, number, hash) of every chunk of the distinct texts among `texts` (digest, text)."""
    lists = texts.mapInArrow(lambda batches: _chunk_hashes(batches, tokenizer), "digest binary, hashes array<binary>").dropDuplicates(["digest"])
    lists = scratch.store(lists, "lists")
    return lists.select("digest", F.posexplode("hashes").alias("number", "hash")).where("hash is not null")


def shared_chunks(places: DataFrame, packed: DataFrame, tokenizer: str, scratch: Scratch) -> DataFrame:
    """(hash, ids, begins) of every chunk that two texts share, each encoded once."""
    several = places.groupBy("hash").agg(F.min(F.struct("digest", "number")).alias("owner"), F.max("digest").alias("last")).where("owner.digest < last")
    owned = several.groupBy("owner.digest").agg(F.collect_list(F.struct("owner.number", "hash")).alias("owned"))
    mine = packed.join(owned, "digest").select("digest", "packed", "owned")
    coded = mine.mapInArrow(lambda batches: _encoded_chunks(batches, tokenizer), "hash binary, ids binary, begins binary")
    return scratch.store(coded, "shared")


def encoded(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (of little-endian 32-bit ids), decoded_sha256.

    `tokenizer` is the path of a tokenizer file that every executor has.
    """
    spark = settle(documents.sparkSession)
    encoder_for(tokenizer)  # an unfit file is an error here, not in a task
    scratch = Scratch(spark, "chunk-encoding")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = docs.select("digest", "text")
    places = chunk_places(texts, tokenizer, scratch)
    packed = texts.mapInArrow(_compressed, "digest binary, packed binary").dropDuplicates(["digest"])
    shared = shared_chunks(places, packed, tokenizer, scratch)
    held = places.join(shared, "hash").groupBy("digest").agg(F.collect_list(F.struct("number", "ids", "begins")).alias("held"))
    once = packed.join(held, "digest", "left").select("digest", "packed", "held")
    schema = "digest binary, n_tokens long, ids_sha256 string, decoded_sha256 string"
    results = scratch.store(once.mapInArrow(lambda batches: _assembled(batches, tokenizer), schema), "results")
    scratch.keep("results")
    return docs.select("doc_id", "digest").join(results, "digest").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
