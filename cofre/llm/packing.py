"""Packing token sequences: first-fit decreasing with a tournament tree, in randomised groups.

Texts are tokenised once into chunks of at most ``capacity`` ids, written to the shared folder. A full chunk is a sequence of its own
and needs nothing more. The others are dealt by a hash of their row into groups of about :data:`GROUP` chunks, whose number
grows with the input, and each group is packed by itself: longest chunk first, each into the first bin with room, found in
a tournament tree of free capacities in logarithmic time. The ids travel with their chunk, so one shuffle of
the partial chunks gives placements and finished sequences, and a group's memory is bounded by its chunks.

First fit leaves small holes. A sequence is padded to the capacity unless its length is a power of two, so: holes of at
least ``least_part`` are filled with the front parts of the emptiest bins' chunks, cut to size, and the one bin that may stay open is cut
into sequences of powers of two. What padding remains is below ``least_part`` ids a sequence.

Words repeat, so each worker remembers the ids of up to :data:`MEMORY` words and starts anew beyond that. That is exact for tokenizers that drop white space, as words
then are encoded apart (held against whole texts by the tests); ``by_word=False`` encodes whole texts.

Defined results: a null or empty text is the end id alone. Every row of the table is packed, repeated ones too, each by itself.
A text of any length is cut into chunks. Chunks of equal length are packed in the order
of their row number; which sequence holds which chunk depends on that order, so on the partitions of the input, but
not on retries, as everything starts from the written chunks. An empty table gives no rows. Only key and text are
read, so other columns, whatever their names, neither matter nor clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import Scratch

CAPACITY = 4096
#: Chunks of a group, on average. Groups never hold more than about this many times the capacity in ids.
GROUP = 4096
#: Shortest part that a chunk is cut into to fill a hole.
LEAST_PART = 32
#: Most words whose ids a worker remembers from batch to batch, and most characters in them.
MEMORY, MEMORY_CHARS = 1_200_000, 24_000_000
#: Words that are one sequence to the tokenizer, and sequences that are encoded at a time.
CALL, CALLS = 1000, 20
#: Sequences of packed groups are numbered from here, by group and bin; full chunks by their row.
PACKED = 1 << 62
GROUP_BITS = 24


class Words:
    """Ids of texts by way of their words. Needs a tokenizer that drops white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.n_chars = 0
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Append the ids of new words. Many words are one call, which tells each id's word."""
        flat, sizes = [self.ids], []
        for at in range(0, len(words), CALLS * CALL):
            calls = [words[i : i + CALL] for i in range(at, min(at + CALLS * CALL, len(words)), CALL)]
            for call, found in zip(calls, self.tokenizer.encode_batch(calls, is_pretokenized=True, add_special_tokens=False), strict=True):
                flat.append(np.array(found.ids, np.uint32))
                sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(call)))
        base = len(self.ends) - 1
        self.number.update(zip(words, range(base, base + len(words)), strict=True))
        self.n_chars += sum(map(len, words))
        self.ids = np.concatenate(flat)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of each text's. Words lie between ASCII white space."""
        split = pc.ascii_split_whitespace(texts)
        spoken = split.flatten().dictionary_encode()
        words = spoken.dictionary.to_pylist()
        new = [word for word in words if word not in self.number]
        if new:
            self._learn(new)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))[spoken.indices.to_numpy(zero_copy_only=False)]
        begins, sizes = self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers]
        total = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.ids[np.repeat(begins - total[:-1], sizes) + np.arange(total[-1])]
        words_before = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        counts = np.diff(total[words_before.astype(np.int64)])
        if len(self.number) > MEMORY or self.n_chars > MEMORY_CHARS:
            self._forget()
        return flat, counts


class Whole:
    """Ids of whole texts, for any tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts


_encoders: dict[tuple, Words | Whole] = {}


def _encoder(path: str, by_word: bool) -> Words | Whole:
    """One encoder per worker, kept from task to task."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path, by_word) not in _encoders:
        _encoders[path, by_word] = (Words if by_word else Whole)(path)
    return _encoders[path, by_word]


def _with_end(flat: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` put behind each text's ids."""
    return np.insert(flat, np.cumsum(counts), end), counts + 1


def _cut(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and length of every chunk, in order."""
    parts = -(-sizes // capacity)
    text = np.repeat(np.arange(len(sizes)), parts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = number * capacity
    return text, start, np.minimum(sizes[text] - start, capacity)


def tokenize(
    df: DataFrame, tokenizer: str, end: int, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, by_word: bool = True,
    batch: int = 8_000_000,
) -> DataFrame:
    """Chunks: key, start, length, doc_tokens, ids (unsigned little-endian, two bytes each, or four if ids need it).

    ``batch``: bytes of text that are encoded at a time.
    """

    def batches_of(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
        """Pieces of about ``batch`` bytes, with the place of their first text."""
        texts = pc.fill_null(texts, "")
        before = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // batch
        first = 0
        for last in [*(np.flatnonzero(np.diff(before)) + 1).tolist(), len(texts)]:
            if last > first:
                yield first, texts.slice(first, last - first)
                first = last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, by_word)
        narrow = max(encoder.tokenizer.get_vocab_size(), end + 1) <= 1 << 16
        kind = np.dtype("<u2" if narrow else "<u4")
        for given in batches:
            for first, texts in batches_of(given["text"]):
                flat, sizes = _with_end(*encoder.encode(texts), end)
                owner, start, length = _cut(sizes, capacity)
                ends = np.concatenate([[0], np.cumsum(length)]) * kind.itemsize
                ids = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(length), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat.astype(kind))]
                )
                columns = [given["key"].take(pa.array(owner + first)), pa.array(start), pa.array(length), pa.array(sizes[owner]), ids.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "length", "doc_tokens", "ids"])

    rows = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, start long, length long, doc_tokens long, ids binary")


class Tournament:
    """Free capacities of bins as leaves; every inner node holds the larger of its two, so the first bin with room is
    found from the root down."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> int:
        """Put ``size`` into the first bin with room and return the bin."""
        free, at = self.free, 1
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        found = at - self.leaves
        free[at] -= size
        while at > 1:
            at //= 2
            larger = max(free[2 * at], free[2 * at + 1])
            if free[at] == larger:
                break
            free[at] = larger
        return found


Part = tuple[int, int, int]  # item, start in it, length


@dataclass
class Bin:
    parts: list[Part] = field(default_factory=list)
    load: int = 0

    def add(self, part: Part) -> None:
        self.parts.append(part)
        self.load += part[2]

    def take(self, most: int) -> Part:
        """Take away the last part, or its front ``most`` ids."""
        item, start, length = self.parts.pop()
        if length > most:
            self.parts.append((item, start + most, length - most))
            length = most
        self.load -= length
        return item, start, length


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[Bin]:
    """Bins of whole items: longest first, equal ones in their order, each into the first bin with room."""
    # All bins but one are at least half full, so twice the total size bounds their number.
    most = min(len(sizes), 2 * sum(sizes) // capacity + 1)
    tree, bins = Tournament(most, capacity), []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.put(sizes[item])
        if at == len(bins):
            bins.append(Bin())
        bins[at].add((item, 0, sizes[item]))
    return bins


def _power(number: int) -> bool:
    return number & (number - 1) == 0


def fill_holes(bins: list[Bin], capacity: int, least_part: int) -> list[Bin]:
    """Fill holes of ``least_part`` and more from the emptiest bins, and cut the last open bin into powers of two."""
    done = [b for b in bins if capacity - b.load < least_part or _power(b.load)]
    unfilled = [b for b in bins if capacity - b.load >= least_part and not _power(b.load)]
    unfilled.sort(key=lambda b: b.load)
    first, last = 0, len(unfilled) - 1
    while first < last:
        giver, taker = unfilled[first], unfilled[last]
        taker.add(giver.take(capacity - taker.load))
        if capacity - taker.load < least_part:
            done.append(taker)
            last -= 1
        if giver.load == 0:
            first += 1
    if first == last and unfilled[first].load:
        rest = unfilled[first]
        while rest.load:
            size, cut = 1 << (rest.load.bit_length() - 1), Bin()
            while cut.load < size:
                cut.add(rest.take(size - cut.load))
            done.append(cut)
    return done


def pack_group(sizes: list[int], capacity: int = CAPACITY, least_part: int = LEAST_PART) -> list[Bin]:
    return fill_holes(first_fit_decreasing(sizes, capacity), capacity, least_part)


PIECE = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(
    df: DataFrame, tokenizer: str, end: int, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, group: int = GROUP,
    least_part: int = LEAST_PART, seed: int = 0, by_word: bool = True,
) -> DataFrame:
    """Pieces of texts in sequences: key, start, length, doc_tokens, sequence_id, offset, ids (32 bits each, little-endian)."""
    scratch = Scratch(df.sparkSession, "packing")
    numbered = tokenize(df, tokenizer, end, text, key, capacity, by_word).withColumn("chunk", F.monotonically_increasing_id())
    chunks = scratch.write(numbered, "chunks")
    kind = chunks.schema["key"].dataType.simpleString()
    partial = chunks.where(F.col("length") < capacity)
    groups = -(-partial.count() // group)

    def wide(ids: bytes, length: int) -> np.ndarray:
        return np.frombuffer(ids, f"<u{len(ids) // length}").astype("<u4")

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk", ignore_index=True)
        first = PACKED + (int(rows["bucket"][0]) << GROUP_BITS)
        ids = [wide(i, n) for i, n in zip(rows["ids"], rows["length"], strict=True)]
        found = []
        for number, used in enumerate(pack_group(rows["length"].tolist(), capacity, least_part)):
            offset = 0
            for item, start, length in used.parts:
                found.append((item, start, length, first + number, offset, ids[item][start : start + length].tobytes()))
                offset += length
        placed = pd.DataFrame(found, columns=["item", "start", "length", "sequence_id", "offset", "ids"])
        owner = rows.loc[placed["item"]].reset_index(drop=True)
        return placed.assign(key=owner["key"], doc_tokens=owner["doc_tokens"], start=placed["start"] + owner["start"])[
            ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        ]

    @F.pandas_udf("binary")
    def widened(ids: pd.Series, length: pd.Series) -> pd.Series:
        return pd.Series([wide(i, n).tobytes() for i, n in zip(ids, length, strict=True)], dtype=object)

    full = chunks.where(F.col("length") == capacity).select(
        "key", "start", "length", "doc_tokens", F.col("chunk").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        widened("ids", "length").alias("ids"),
    )
    bucket = F.pmod(F.xxhash64("chunk", F.lit(seed)), F.lit(max(groups, 1)))
    dealt = partial.select("chunk", F.col("key"), "start", "length", "doc_tokens", "ids", bucket.alias("bucket"))
    return full.unionByName(dealt.groupBy("bucket").applyInPandas(packed, f"key {kind}, {PIECE}"))


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad: int = 0) -> DataFrame:
    """Finished sequences: sequence_id, length without padding, ids in order, padded unless the length is a power of two."""
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )

    @F.pandas_udf("binary")
    def joined(parts: pd.Series, length: pd.Series) -> pd.Series:
        filler = np.full(capacity, pad, "<u4").tobytes()
        return pd.Series([
            b"".join(row) + (b"" if _power(int(n)) else filler[: 4 * (capacity - int(n))])
            for row, n in zip(parts, length, strict=True)
        ], dtype=object)

    return whole.select("sequence_id", "length", joined(F.transform("parts", lambda part: part["ids"]), "length").alias("ids"))
