"""Best-fit packing of tokenised documents into sequences of a fixed length, by linear grouping.

A document's ids, followed by the end id, are cut into pieces only where they exceed the
sequence length. Pieces are packed by length alone, so the plan is made on the histogram of
lengths (at most CAPACITY entries, however large the corpus):

1. Linear grouping. Pieces over a share SMALL of a sequence, longest first, are split into GROUPS
   groups of equal cardinality, and each group counts as its longest length.
2. Configurations. Over those few sizes, sequences are filled by configurations (how many of
   each size); column generation finds the mix that needs fewest sequences, rounded down, and
   what is left over goes to step 4 with the small pieces.
3. Substitution. The group's actual pieces take the places of the rounded size. They are at most
   as long, so every sequence still fits.
4. Best fit. What is left, longest first, goes where it leaves least room; new sequences open
   only where nothing fits.

Then every piece gets its place: its rank among the pieces of its length picks a slot of the
plan. Ranks come from counts per (length, salt), so no length is ranked in one task.

Defined cases: a null or empty text is the end id alone. Rows that repeat are packed each on its
own. A null doc_id is packed like any other. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch, lean, settle
from stratastar.llm.words import chunks

CAPACITY = 2048
END = 0
#: Pieces up to this share of a sequence are small. Each share is tried on the histogram; the plan with fewest sequences wins.
SMALL = (1 / 8, 1 / 3, 2 / 5, 1 / 2)
GROUPS = 96
#: Rows ranked together.
SALTED = 50_000
#: Space-free runs, and words, whose ids a task remembers; forgotten when full.
REMEMBERED = 500_000
#: Bytes of text split into runs at once.
BLOCK = 4 << 20
_SPACE = re.compile(rb"[\x09-\x0D ]")

# ---------------------------------------------------------------- tokens

if sys.byteorder != "little":
    raise ImportError("ids are packed as this machine lays them out, which must be little-endian")


#: Normaliser and pre-tokenizer under which a text's ids are those of its space-free runs.
RUNS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class Encoder(dict):
    """Ids of whole texts, as little-endian 32-bit numbers.

    Under a file's RUNS rules white space never lies inside a token and leaves no token, so a text's
    ids are those of its space-free runs, one after another. A run's ids are remembered; of two
    generations of REMEMBERED runs the older one goes. A run of Latin letters is one word of the
    vocabulary's model, lower-cased, byte by byte, and ASCII marks after it are words of their own;
    any other run is encoded in full. Words are remembered too, as the same one stands in runs with
    other marks and capitals. A file with other rules encodes whole texts.
    """

    #: Letters whose lower case is one letter and which no normal form changes, then marks.
    plain = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u0148\u014a-\u017e]+)([!-&(-/:-@\\[-^`{-~]*)")
    #: How byte-level vocabularies write a byte: itself where it is printable, else a letter from 256 on.
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    written = {b: 256 + n for n, b in enumerate(sorted({*range(256)} - {*printable}))}

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        read = json.loads(Path(path).read_text())
        self.by_runs = (
            all(read[part] == rules for part, rules in RUNS.items())
            and read["model"]["type"] == "BPE"
            and not read["model"].get("dropout")
            and all(re.fullmatch(r"<\|[a-z]+\|>", t["content"]) and not (t["normalized"] or t["lstrip"] or t["rstrip"]) for t in read["added_tokens"])
        )
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.older: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def full(self, run: str) -> bytes:
        return array("I", self.tokenizer.encode(run, add_special_tokens=False).ids).tobytes()

    def __missing__(self, run: bytes) -> bytes:
        ids = self.older.get(run)
        if ids is None:
            text = run.decode()
            if run.isalpha():  # ASCII letters only, for bytes
                parts = (text, "")
            elif run[:-1].isalpha() and text[-1] in ".,":
                parts = (text[:-1], text[-1])
            else:
                found = self.plain.fullmatch(text)
                parts = found and found.groups()
            if parts is None:
                ids = self.full(text)
            else:
                word, marks = parts
                word = word.lower()
                ids = self.words.get(word)
                if ids is None:
                    spelt = word if word.isascii() else word.encode().decode("latin-1").translate(self.written)
                    if len(self.words) >= REMEMBERED:
                        self.words.clear()
                    ids = self.words[word] = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
                if marks:
                    if marks not in self.marks:
                        self.marks = {"": b""} if len(self.marks) > REMEMBERED else self.marks
                        self.marks[marks] = self.full(marks)
                    ids += self.marks[marks]
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[run] = ids
        return ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text."""
        if not self.by_runs:
            return [self.full(text.decode()) for text in texts]
        return [b"".join(b"".join(map(self.__getitem__, block.split())) for block in _blocks(text)) for text in texts]


def _blocks(text: bytes) -> Iterator[bytes]:
    """A long text in blocks cut at white space, which no token crosses."""
    at = 0
    while len(text) - at > BLOCK:
        end = _SPACE.search(text, at + BLOCK)
        if end is None:
            break
        yield text[at : end.start()]
        at = end.start()
    yield text[at:]


def encoder_for(path: str, remembered: dict[str, Encoder] | None = None) -> Encoder:
    """One encoder per Python worker; what it remembers serves later tasks of packing."""
    remembered = {} if remembered is None else remembered
    if path not in remembered:
        remembered[path] = Encoder(path)
    return remembered[path]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    with lean("packing") as remembered:
        yield from _cut(batches, encoder_for(path, remembered), capacity)


def _cut(batches: Iterator[pa.RecordBatch], encoder: Encoder, capacity: int) -> Iterator[pa.RecordBatch]:
    end_id = np.array([END], "<u4").tobytes()
    for batch in batches:
        for row, end, data, offsets in chunks(batch.column(1)):
            raw = data.tobytes()
            texts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            owner, piece, start, length, crc = [], [], [], [], []
            for n, ids in enumerate(encoder.encode(texts)):
                ids += end_id
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    owner.append(n)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            ids = batch.column(0).slice(row, end - row).take(pa.array(owner, pa.int64()))
            columns = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", "piece", "start", "length", "ids_crc32"])


# ---------------------------------------------------------------- plan


@dataclass
class Bins:
    """`many` sequences of one make-up: (length, number) pairs, and the room left in each."""

    many: int
    room: int
    load: list[tuple[int, int]] = field(default_factory=list)

    def split(self, many: int) -> Bins:
        self.many -= many
        return Bins(many, self.room, list(self.load))

    def add(self, length: int, number: int) -> None:
        self.load.append((length, number))
        self.room -= length * number


def grouped(histogram: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths, longest first, as groups of equal cardinality: lists of (length, count)."""
    left = sum(histogram.values())
    out: list[list[tuple[int, int]]] = []
    items = sorted(histogram.items(), reverse=True)
    for k in range(groups, 0, -1):
        room, group = -(-left // k), []
        left -= room
        while room and items:
            length, n = items.pop(0)
            taken = min(n, room)
            room -= taken
            group.append((length, taken))
            if n > taken:
                items.insert(0, (length, n - taken))
        if group:
            out.append(group)
    return out


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most worth that fits into one sequence: a knapsack over the few sizes."""
    value = np.zeros(capacity + 1)
    taken = np.zeros((len(sizes), capacity + 1), np.int16)
    for i, (size, gain) in enumerate(zip(sizes.tolist(), worth.tolist(), strict=True)):
        best, copies = value.copy(), taken[i]
        for n in range(1, capacity // size + 1):
            offer = value[: capacity + 1 - n * size] + n * gain
            better = offer > best[n * size :] + 1e-12
            best[n * size :][better] = offer[better]
            copies[n * size :][better] = n
        value = best
    room, chosen = capacity, np.zeros(len(sizes), np.int64)
    for i in range(len(sizes) - 1, -1, -1):
        chosen[i] = taken[i, room]
        room -= chosen[i] * sizes[i]
    return float(value[capacity]), chosen


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[int, np.ndarray]]:
    """(times, configuration): column generation for the fewest sequences, rounded down."""
    basis = np.diag(capacity // sizes).astype(float)
    amount = np.linalg.solve(basis, demand.astype(float))
    for turn in range(rounds):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        gain, column = _best_configuration(sizes, np.maximum(worth, 0), capacity)
        if gain <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column.astype(float))
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        leaves = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaves]):
            break
        amount = amount - ratio[leaves] * step
        amount[leaves] = ratio[leaves]
        basis[:, leaves] = column
        if turn % 50 == 49:
            amount = np.linalg.solve(basis, demand.astype(float))
    amount = np.linalg.solve(basis, demand.astype(float))
    return [(int(np.floor(x + 1e-6)), basis[:, i].round().astype(np.int64)) for i, x in enumerate(amount) if x >= 1 - 1e-6]


def best_fit(bins: list[Bins], histogram: dict[int, int], capacity: int) -> None:
    """Place what `histogram` holds, longest first, where it leaves least room."""
    rooms: dict[int, list[Bins]] = {}
    for b in bins:
        rooms.setdefault(b.room, []).append(b)
    for length, left in sorted(histogram.items(), reverse=True):
        while left:
            room = min((r for r, some in rooms.items() if r >= length and some), default=None)
            if room is None:
                each = capacity // length
                if left >= each:
                    one = Bins(left // each, capacity)
                    one.add(length, each)
                    left -= one.many * each
                else:
                    one = Bins(1, capacity)
                    one.add(length, left)
                    left = 0
                bins.append(one)
                rooms.setdefault(one.room, []).append(one)
                continue
            one = rooms[room].pop()
            each = room // length
            if left >= each:
                number, times = each, min(one.many, left // each)
            else:
                number, times = left, 1
            if times < one.many:
                rest = one.split(one.many - times)
                bins.append(rest)
                rooms[room].append(rest)
            one.add(length, number)
            left -= number * times
            rooms.setdefault(one.room, []).append(one)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Bins]:
    """Sequences for pieces of the given lengths. Its size follows the number of lengths."""
    return min((planned(histogram, capacity, groups, int(share * capacity)) for share in SMALL), key=lambda bins: sum(b.many for b in bins))


def planned(histogram: dict[int, int], capacity: int, groups: int, small: int) -> list[Bins]:
    left = {n: c for n, c in histogram.items() if c > 0}
    large = {n: c for n, c in left.items() if n > small}
    bins: list[Bins] = []
    if large:
        parts = grouped(large, groups)
        # Groups with one longest length are one size.
        sizes = sorted({part[0][0] for part in parts}, reverse=True)
        stock = {s: [x for part in parts if part[0][0] == s for x in part] for s in sizes}
        demand = np.array([sum(n for _, n in stock[s]) for s in sizes])
        for times, config in configurations(np.array(sizes), demand, capacity):
            times = min([times, *(sum(n for _, n in stock[s]) // int(k) for s, k in zip(sizes, config, strict=True) if k)])
            if times < 1:
                continue
            made = [Bins(times, capacity)]
            for size, number in zip(sizes, config.tolist(), strict=True):
                for _ in range(number):
                    made = _substituted(made, stock[size], times)
            bins += made
        left = {n: c for n, c in left.items() if n <= small}
        for items in stock.values():
            for n, c in items:
                left[n] = left.get(n, 0) + c
    best_fit(bins, {n: c for n, c in left.items() if c}, capacity)
    return [b for b in bins if b.many]


def _substituted(made: list[Bins], stock: list[tuple[int, int]], times: int) -> list[Bins]:
    """One actual piece into each of `times` sequences; the stock is used longest first."""
    out, queue = [], list(made)
    while times:
        one = queue.pop(0)
        length, n = stock[0]
        take = min(one.many, n)
        if take < one.many:
            queue.insert(0, one.split(one.many - take))
        one.add(length, 1)
        out.append(one)
        times -= take
        if n == take:
            stock.pop(0)
        else:
            stock[0] = (length, n - take)
    return out


def slots(bins: list[Bins]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset, pieces per sequence), by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for one in bins:
        offset = 0
        for length, number in one.load:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, offset, number))
            used[length] = rank + one.many * number
            offset += length * number
        sequence += one.many
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placed(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The last column, a rank within the length, becomes sequence_id and offset."""
    lengths, firsts = np.unique(table[:, 0], return_index=True)
    ends = np.append(firsts[1:], len(table))
    for batch in batches:
        length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
        which = np.searchsorted(lengths, length)
        order = np.argsort(which, kind="stable")
        cuts = np.flatnonzero(np.diff(which[order], prepend=-1))
        at = np.zeros(len(length), np.int64)
        for mine in np.split(order, cuts[1:]):
            k = which[mine[0]] if len(mine) else 0
            at[mine] = firsts[k] + np.searchsorted(table[firsts[k] : ends[k], 1], rank[mine], "right") - 1
        past = rank - table[at, 1]
        sequence = table[at, 2] + past // table[at, 4]
        offset = table[at, 3] + past % table[at, 4] * length
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])


# ---------------------------------------------------------------- operator

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def packed(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    `tokenizer` is the path of a tokenizer file that every executor has.
    """
    spark = settle(documents.sparkSession)
    scratch = Scratch(spark, "packing")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = docs.mapInArrow(lambda batches: _pieces(batches, tokenizer, capacity), _PIECE)
    pieces = scratch.store(pieces, "pieces")
    counts = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    histogram = {r["length"]: r["count"] for r in counts}
    table = slots(plan(histogram, capacity))

    salts = max(1, -(-max(histogram.values(), default=0) // SALTED))
    everything = [c for c in pieces.columns if c != "length"]
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64(*everything), F.lit(salts)))
    own = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = salted.withColumn("place", F.row_number().over(own) - 1)
    if salts > 1:
        shares = salted.groupBy("length", "salt").count()
        before = F.sum("count").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
        shares = scratch.store(shares.select("length", "salt", F.coalesce(before, F.lit(0)).alias("before")), "shares")
        ranked = ranked.join(shares, ["length", "salt"]).withColumn("place", F.col("place") + F.col("before"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("place").cast("long").alias("place"))
    return ranked.mapInArrow(lambda batches: _placed(batches, table), f"{_PIECE}, sequence_id long, offset long")
