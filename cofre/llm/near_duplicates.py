"""MinHash near-duplicates with sequential Bayesian verification.

1. A text becomes the set of its word shingles, as 64-bit hashes; equal sets share one representative. Of the set,
   256 minimum hashes are taken. Forty bands of five of them are the buckets; a bit of each, mixed anew per function, is
   the signature.
2. Candidates are pairs within a bucket of like set size. Their signatures are compared in batches of 64 bits. After
   each batch the posterior of the similarity (uniform prior; a bit agrees with probability (1 + J) / 2) tells
   whether it may still reach the threshold; a pair for which this is less probable than ``miss`` is dropped. Pairs of
   sets with at most ``SMALL`` shingles skip this. Last comes a bound without error, for all: a bitmap holds the parity of the set's hashes per place, and two sets differ in
   at least as many shingles as their bitmaps in bits.
3. Survivors are verified on full sets, read anew from the texts.

No bucket emits all its pairs. First each member is compared with one pivot, the smallest member it shares a bucket
with. Links so found are joined into components. In further rounds members outside their bucket's largest component
are compared with one member of it, another one in each bucket, and components are joined again. What is left are
pairs of *different* components in one bucket: members outside the largest are compared with all others, each pair in
the first bucket it shares. So any pair of one bucket is either compared or already in one component, and no link
between different components is lost; the rounds before only make that rest small. Two sets of similarity 0.8 share
no bucket with probability (1 - 0.8^5)^40 = 1.3e-7.

Defined results: null and empty texts have an empty set, are linked with nothing and stay. With fewer words than a
shingle has, the whole sequence is one shingle. The component is named by its smallest key; of repeated rows and
null keys one row per component stays (null keys are largest), the first in the order of the table. Texts of any length are cut into
shingles whole. An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import Scratch, join_few, join_groups, keep_rows
from cofre.llm.components import components

HASHES, BANDS, ROWS, BATCH = 256, 40, 5, 64
PARITY_BITS = 1024
SMALL = 64  # shingles; up to here the parity bound alone is about exact
THRESHOLD = 80  # percent
MISS = 1e-9
ROUNDS = 1
SEGMENT = 1 << 20
COLUMNS = 4096  # shingles hashed at once

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(name: str, base: int) -> np.ndarray:
    if name not in _tables:
        powers = np.full(SEGMENT + 1, base, np.uint64)
        powers[0] = 1
        _tables[name] = np.multiply.accumulate(powers)
    return _tables[name]


def _segments(data: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """Pieces of at most SEGMENT bytes cut before a word, and whether the piece is a single longer word."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    at, size = 0, len(data)
    while at < size:
        end = min(at + SEGMENT, size)
        if end < size and not blank[end]:
            gaps = np.flatnonzero(blank[at:end])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                gaps = np.flatnonzero(blank[end:])
                end = end + int(gaps[0]) if len(gaps) else size
                yield data[at:end], True
                at = end
                continue
        yield data[at:end], False
        at = end


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word of the text with A-Z lower-cased."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    upper = (data >= 65) & (data <= 90)
    data = data + upper.astype(np.uint8) * np.uint8(32)
    found = []
    for piece, is_word in _segments(data):
        if is_word:
            found.append(np.frombuffer(hashlib.blake2b(piece.tobytes(), digest_size=8).digest(), np.uint64))
            continue
        inside = np.zeros(len(piece) + 2, np.int8)
        inside[1:-1] = ~((piece == 32) | ((piece >= 9) & (piece <= 13)))
        change = np.diff(inside)
        start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * _table("powers", _BASE)[: len(piece)], out=sums[1:])
        found.append(_mix((sums[end] - sums[start]) * _table("inverse", _INVERSE)[start]))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a text, sorted."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    shingles = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        shingles = _mix(shingles * np.uint64(31) + hashes[i : len(hashes) - size + 1 + i])
    return np.unique(shingles)


_random = np.random.default_rng(20240229)
_FACTORS = (_random.integers(0, 1 << 31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_SHIFTS = _random.integers(0, 1 << 32, HASHES, np.uint32)[:, None]
_FUNCTIONS = np.arange(HASHES, dtype=np.uint64) << np.uint64(32)


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and the signature bits, as signed 64-bit numbers."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), COLUMNS):
        np.minimum(least, (values[None, at : at + COLUMNS] * _FACTORS + _SHIFTS).min(axis=1), out=least)
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    bands = np.arange(BANDS, dtype=np.uint64)
    for column in rows.T:
        bands = _mix(bands * np.uint64(31) + column + np.uint64(1))
    # The low bit of a minimum depends on the winning shingle alone, whatever the function; a mixed one on both.
    bits = np.packbits((_mix(least.astype(np.uint64) | _FUNCTIONS) >> np.uint64(63)).astype(np.uint8)).view(np.int64)
    return bands.view(np.int64), bits


def parity(shingles: np.ndarray) -> np.ndarray:
    """For each place of the bitmap whether an odd number of shingles falls there, as signed 64-bit numbers."""
    places = ((shingles >> np.uint64(12)) & np.uint64(PARITY_BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=PARITY_BITS) & 1).astype(np.uint8)).view(np.int64)


def _sketch(words: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, marks, bands, bits, parities = [], [], [], [], []
            for text in batch.pop("text"):
                shingles = shingle_set(text, words)
                band, bit = signature(shingles) if len(shingles) else (None, None)
                sizes.append(len(shingles))
                marks.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                bands.append(band)
                bits.append(bit)
                parities.append(parity(shingles) if len(shingles) else None)
            yield batch.assign(n=sizes, mark=marks, bands=bands, bits=bits, parity=parities)

    return run


def _sets(words: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rids = batch["rid"].to_numpy()
            texts = batch["text"].to_numpy()
            for at in range(0, len(batch), 256):
                found = [shingle_set(text, words).view(np.int64) for text in texts[at : at + 256]]
                yield pd.DataFrame({"rid": rids[at : at + 256], "shingles": found})

    return run


def cutoffs(threshold: int = THRESHOLD, miss: float = MISS) -> list[int]:
    """The most differing bits after each batch with which a pair goes on."""
    agree = np.linspace(0.5, 1, 20001)[1:-1]
    similar = agree >= (1 + threshold / 100) / 2 - 1e-12
    found = []
    for seen in range(BATCH, HASHES + 1, BATCH):
        most = 0
        for differ in range(seen + 1):
            log = (seen - differ) * np.log(agree) + differ * np.log1p(-agree)
            weight = np.exp(log - log.max())
            if weight[similar].sum() < miss * weight.sum():
                break
            most = differ
        found.append(most)
    return found


def may_be_similar(a: Callable[[str], Column], b: Callable[[str], Column], threshold: int, miss: float) -> Column:
    """Sizes, signature batches and parities leave the threshold possible; each test runs only if those before it passed.

    ``a`` and ``b`` give the columns n, bits and parity of the two sets.
    """
    passed = F.least(a("n"), b("n")) * 100 >= F.greatest(a("n"), b("n")) * threshold

    def differing(name: str, i: int) -> Column:
        return F.bit_count(F.get(a(name), F.lit(i)).bitwiseXOR(F.get(b(name), F.lit(i))))

    differ, signed = F.lit(0), F.lit(True)
    for i, most in enumerate(cutoffs(threshold, miss)):
        differ = differ + differing("bits", i)
        signed = signed & (differ <= most)
    passed = passed & ((F.greatest(a("n"), b("n")) <= SMALL) | signed)
    apart = F.lit(0)
    for i in range(PARITY_BITS // 64):
        apart = apart + differing("parity", i)
    return passed & (apart * (100 + threshold) <= (a("n") + b("n")) * (100 - threshold))


class _Search:
    def __init__(self, df: DataFrame, text: str, key: str, words: int, threshold: int, miss: float):
        self.scratch = Scratch(df.sparkSession, "near")
        self.words, self.threshold, self.miss = words, threshold, miss
        self.texts = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("row_hash"))
        rows = self.texts.select(F.monotonically_increasing_id().alias("rid"), "key", "row_hash", "text")
        schema = f"rid long, key {df.schema[key].dataType.simpleString()}, row_hash long, n long, mark binary, bands array<long>, bits array<long>, parity array<long>"
        self.rows = self.scratch.write(rows.mapInPandas(_sketch(words), schema), "rows")
        first = self.rows.where("n > 0").groupBy("mark").agg(F.min("rid").alias("rid"))
        self.sets = self.scratch.write(self.rows.join(first.select("rid"), "rid", "left_semi").drop("mark"), "sets")

    def members(self) -> DataFrame:
        """band, rid, pivot: all members of buckets with several members."""
        each = self.sets.select("rid", F.explode("bands").alias("band"))
        buckets = each.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("rid").alias("pivot")).where("size > 1")
        buckets = self.scratch.write(buckets, "buckets")
        members = self.scratch.write(join_groups(each, buckets, ["band"]), "members")
        self.scratch.drop("buckets")
        return members

    def signed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that their signatures leave possible."""
        of_a, of_b = (self.sets.select(F.col("rid").alias(s), F.struct("n", "bits", "parity").alias(f"of_{s}")) for s in "ab")
        both = pairs.join(of_a, "a").join(of_b, "b")
        possible = may_be_similar(lambda c: F.col(f"of_a.{c}"), lambda c: F.col(f"of_b.{c}"), self.threshold, self.miss)
        return both.where(possible).select("a", "b")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose full sets reach the threshold."""
        pairs = self.scratch.write(pairs, f"{name}-pairs")
        wanted = pairs.select(F.col("a").alias("rid")).union(pairs.select(F.col("b").alias("rid"))).distinct()
        places = self.sets.select("rid", F.col("key").alias("w_key"), F.col("row_hash").alias("w_hash"))
        wanted = self.scratch.write(places.join(wanted, "rid"), f"{name}-wanted")
        texts = join_few(self.texts, wanted, [(F.col("key"), "w_key"), (F.col("row_hash"), "w_hash")]).select("rid", "text")
        full = self.scratch.write(texts.mapInPandas(_sets(self.words), "rid long, shingles array<long>"), f"{name}-sets")
        one = pairs.join(full.select(F.col("rid").alias("a"), F.col("shingles").alias("set_a")), "a")
        both = one.join(full.select(F.col("rid").alias("b"), F.col("shingles").alias("set_b")), "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - common
        links = self.scratch.write(both.where(common * 100 >= union * self.threshold).select("a", "b").distinct(), f"{name}-links")
        self.scratch.drop(f"{name}-pairs", f"{name}-wanted", f"{name}-sets")
        return links

    def mixed(self, members: DataFrame, found: DataFrame, name: str) -> DataFrame:
        """band, rid, component, main: the buckets with members of several components; main is the largest."""
        known = members.join(found.withColumnRenamed("node", "rid"), "rid", "left").select(
            "band", "rid", F.coalesce("component", "rid").alias("component")
        )
        known = self.scratch.write(known, f"{name}-known")
        sizes = known.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size"))
        several = sizes.groupBy("band").agg(
            F.max_by("component", F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("parts")
        )
        rest = self.scratch.write(known.join(several.where("parts > 1").select("band", "main"), "band"), f"{name}-mixed")
        self.scratch.drop(f"{name}-known")
        return rest

    def to_main(self, rest: DataFrame) -> DataFrame:
        """Pairs of a member outside its bucket's main component and one of it, chosen by a hash."""
        chosen = rest.where("component = main").groupBy("band").agg(F.min_by("rid", F.xxhash64("band", "rid")).alias("a"))
        outside = rest.where("component <> main").select("band", F.col("rid").alias("b"))
        return outside.join(chosen, "band").select("a", "b").distinct()

    def across(self, rest: DataFrame) -> DataFrame:
        """Possible pairs within a bucket whose sides are in different components, each in the first bucket they share."""
        rest = self.scratch.write(rest.join(self.sets.select("rid", "n", "bits", "parity", "bands"), "rid"), "signed")
        a, b = (rest.select(*[F.col(c).alias(f"{c}_{s}") for c in rest.columns if c != "band"], "band") for s in "ab")
        once = (F.col("component_b") == F.col("main_b")) | (F.col("rid_a") < F.col("rid_b"))
        possible = may_be_similar(lambda c: F.col(f"{c}_a"), lambda c: F.col(f"{c}_b"), self.threshold, self.miss)
        first = F.array_min(F.array_intersect("bands_a", "bands_b")) == a["band"]
        met = a.where("component_a <> main_a").join(
            b, (a["band"] == b["band"]) & (F.col("component_a") != F.col("component_b")) & once & possible & first
        )
        return met.select(F.least("rid_a", "rid_b").alias("a"), F.greatest("rid_a", "rid_b").alias("b"))

    def components(self) -> DataFrame:
        """node, component over representatives; a representative without a link is missing."""
        members = self.members()
        nearest = members.where("rid <> pivot").groupBy("rid").agg(F.min("pivot").alias("a")).select("a", F.col("rid").alias("b"))
        links = self.verified(self.signed(nearest), "pivot")
        found = components(links, self.scratch, "pivots")
        step, going = 0, True
        while True:
            step, last = step + 1, not going or step == ROUNDS
            name = f"round{step}"
            rest = self.mixed(members, found, name)
            more = self.verified(self.across(rest) if last else self.signed(self.to_main(rest)), name)
            self.scratch.drop(f"{name}-mixed")
            going = not more.isEmpty()
            if going:
                joined = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
                found = components(joined, self.scratch, name)
            if last:
                self.scratch.drop("members", "signed")
                return found


def near_duplicates(
    df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, threshold: int = THRESHOLD, miss: float = MISS
) -> DataFrame:
    """One row per row of ``df``: key, row_hash, n_shingles, component_id, kept."""
    search = _Search(df, text, key, words, threshold, miss)
    found = search.components()
    of_mark = search.rows.where("n > 0").groupBy("mark").agg(F.min("rid").alias("node"))
    of_mark = of_mark.join(found, "node", "left").select("mark", F.coalesce("component", "node").alias("component"))
    rows = search.rows.select("rid", "key", "row_hash", "n", "mark").join(of_mark, "mark", "left")
    rows = rows.withColumn("component", F.when(F.col("n") == 0, F.col("rid")).otherwise(F.col("component")))
    rows = search.scratch.write(rows.drop("mark"), "labelled")
    smallest = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "rid")).alias("first")
    first = search.scratch.write(rows.groupBy("component").agg(smallest, F.count(F.lit(1)).alias("size")), "components")
    return join_groups(rows, first, ["component"]).select(
        "key", "row_hash", F.col("n").alias("n_shingles"), F.col("first.key").alias("component_id"),
        (F.col("rid") == F.col("first.rid")).alias("kept"),
    )


def drop_near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """One row of each group of near duplicates, with all columns of ``df`` as they were."""
    return keep_rows(df, near_duplicates(df, text, key, **settings), key, F.xxhash64(df[text]))
