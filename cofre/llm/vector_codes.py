"""Vector codes by product quantisation, with ball k-means for each part.

Components become integers, vectors are cut into parts, and every part has a codebook. All sums and distances
are integers, so neither the order of rows nor the number of tasks bears on the result.

A round is one map over the rows, which carry the entry each part had before. The parts of an entry form a ball around it:

* An entry at more than twice a part's distance to its own entry can't be nearer. Sorted by their distance from the ball's entry, the others
  part the ball into rings: a part in a ring meets only the entries that stand before its ring, and one in the core meets none. What
  no part of the ball can reach is no neighbour.
* A ball whose entry stayed, and whose moved entries are no neighbours by the ball's radius, is stable: its parts keep their
  entry unseen.

Both tests are strict, so ties still go to the lower index. Of the parts that changed their entry, each task adds up what left and what came
(part, entry, count and sum of components); these few rows are summed by Spark, and the driver holds nothing but codebooks. A round's
rows are written to the shared folder and the round before is dropped, so a lost executor costs its own tasks.

Defined results: a vector that is null, empty, or holds a null or a component that is not finite is dropped. Rows of equal id are all
kept and coded apart; where they bear on the first entries, the smaller vector comes first, and null ids come last. With fewer rows than
entries the codebooks are as short. Equal entries are allowed; the lower index takes all. Vectors of several lengths,
of a length that the parts don't divide, or with components too large for exact distances in 64 bits are an error. An empty table
gives no rows. Only id, vector and label are read, so other columns, whatever their names, neither matter nor clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import Scratch, bounded

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def usable(vector: Column) -> Column:
    """The vector is there, has components, and all are finite."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return ((left - right) ** 2).sum(axis=-1)


@dataclass
class Ball:
    """What a round knows of one part: its entries, which of them moved, and how far each ball reached (squared)."""

    entries: np.ndarray
    moved: np.ndarray
    radius: np.ndarray

    def __post_init__(self):
        self.apart = squared(self.entries[:, None], self.entries[None])
        reached = 4 * self.radius[:, None] >= self.apart
        np.fill_diagonal(reached, False)
        self.stable = ~self.moved & ~(reached & self.moved[None]).any(axis=1)

    def assign(self, parts: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of every part, and per ball the largest squared distance that was seen."""
        codes, seen = before.copy(), np.zeros(len(self.entries), np.int64)
        for entry in np.unique(before):
            if self.stable[entry]:
                seen[entry] = max(seen[entry], self.radius[entry])
                continue
            rows = np.flatnonzero(before == entry)
            members = parts[rows]
            best = squared(members, self.entries[entry])
            code = np.full(len(rows), entry)
            order = np.argsort(self.apart[entry], kind="stable")
            order = order[order != entry]
            # The ring of a part: how many entries are no more than twice its distance away from its own.
            ring = np.searchsorted(self.apart[entry][order], 4 * best, side="right")
            for step, other in enumerate(order[: ring.max()]):
                near = np.flatnonzero(ring > step)
                there = squared(members[near], self.entries[other])
                closer = (there < best[near]) | ((there == best[near]) & (other < code[near]))
                best[near[closer]], code[near[closer]] = there[closer], other
            codes[rows] = code
            np.maximum.at(seen, code, best)
        return codes, seen


@dataclass
class Codebooks:
    """Entries by part, with the count and sum of their parts."""

    entries: np.ndarray
    moved: np.ndarray
    radius: np.ndarray
    count: np.ndarray
    total: np.ndarray

    @classmethod
    def starting(cls, entries: np.ndarray) -> Codebooks:
        shape = entries.shape[:2]
        zero = np.zeros(shape, np.int64)
        return cls(entries, np.ones(shape, bool), zero, zero, np.zeros_like(entries))

    def following(self, count: np.ndarray, total: np.ndarray, radius: np.ndarray) -> Codebooks:
        """The codebooks after a round that changed counts and sums by these."""
        count, total = self.count + count, self.total + total
        means = total // np.maximum(count, 1)[:, :, None]
        entries = np.where(count[:, :, None] > 0, means, self.entries)
        return Codebooks(entries, (entries != self.entries).any(axis=2), radius, count, total)

    def balls(self) -> list[Ball]:
        return [Ball(e, m, r) for e, m, r in zip(self.entries, self.moved, self.radius, strict=True)]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """A binary column of equally long values as rows of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


class _Coder:
    """The rounds over one table."""

    def __init__(self, df: DataFrame, vector: str, key: str, label: str, parts: int, entries: int, rounds: int):
        self.scratch = Scratch(df.sparkSession, "vector-codes")
        self.parts, self.rounds = parts, rounds
        rows = df.select(df[key].alias("key"), df[label].alias("label"), df[vector].alias("vector")).where(usable(df[vector]))
        self.kinds = {c: rows.schema[c].dataType.simpleString() for c in ("key", "label")}
        largest = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x).cast("double"))))
        size = F.size("vector")
        found = rows.agg(F.min(size).alias("low"), F.max(size).alias("high"), largest.alias("largest")).first()
        self.width = found["low"]
        if self.width is None:
            return
        if found["low"] != found["high"] or self.width % parts:
            raise ValueError(f"Vectors of {found['low']} to {found['high']} components can't be cut into {parts} equal parts.")
        most = int(found["largest"] * SCALE) + 1
        if 16 * most * most * self.width >= 1 << 62:
            raise ValueError("Components are too large for exact distances in 64 bits.")
        self.kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        first = rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).collect()
        numbers = np.floor(np.array([r["vector"] for r in first], np.float64) * SCALE).astype(np.int64)
        self.books = Codebooks.starting(numbers.reshape(len(first), parts, -1).swapaxes(0, 1))
        self.table = self.scratch.write(self._quantised(rows), "round0")

    def _quantised(self, rows: DataFrame) -> DataFrame:
        """key, label, v (the integers) and codes, null before the first round."""
        kind, width = self.kind, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flat = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                numbers = np.floor(flat * SCALE).astype(kind).reshape(-1, width)
                v = pa.array([row.tobytes() for row in numbers], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch["key"], batch["label"], v, pa.nulls(len(v), pa.binary())], names=["key", "label", "v", "codes"]
                )

        return rows.mapInArrow(run, f"key {self.kinds['key']}, label {self.kinds['label']}, v binary, codes binary")

    def _unpacked(self):
        """A function from a batch to its parts (part, row, component) and codes (part, row)."""
        kind, width, parts = self.kind, self.width, self.parts

        def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray | None]:
            numbers = _matrix(batch["v"], kind, width).astype(np.int64).reshape(-1, parts, width // parts).swapaxes(0, 1)
            codes = None if batch["codes"].null_count else _matrix(batch["codes"], "u1", parts).astype(np.int64).T
            return np.ascontiguousarray(numbers), codes

        return unpack

    def _assigned(self) -> DataFrame:
        """All rows with their codes for the present codebooks, and behind a task's rows its changes: part, entry, n, radius, total."""
        books, unpack = self.books, self._unpacked()
        n_parts, n_entries = books.entries.shape[:2]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            balls = books.balls()
            count, radius, total = np.zeros((n_parts, n_entries), np.int64), np.zeros((n_parts, n_entries), np.int64), np.zeros_like(books.total)
            schema = None
            for batch in batches:
                if not len(batch):
                    continue
                schema = batch.schema
                numbers, before = unpack(batch)
                known = before if before is not None else np.zeros(numbers.shape[:2], np.int64)
                after = np.empty_like(known)
                for part, ball in enumerate(balls):
                    after[part], seen = ball.assign(numbers[part], known[part])
                    radius[part] = np.maximum(radius[part], seen)
                    changed = np.ones(len(batch), bool) if before is None else after[part] != known[part]
                    for entry in np.unique(after[part][changed]):
                        came = changed & (after[part] == entry)
                        count[part, entry] += came.sum()
                        total[part, entry] += numbers[part][came].sum(axis=0)
                    for entry in np.unique(known[part][changed]) if before is not None else ():
                        left = changed & (known[part] == entry)
                        count[part, entry] -= left.sum()
                        total[part, entry] -= numbers[part][left].sum(axis=0)
                codes = pa.array([row.tobytes() for row in after.T.astype(np.uint8)], pa.binary())
                yield self_batch(batch, codes)
            if schema is not None:
                yield changes(schema, count, radius, total)

        names = ["key", "label", "v", "codes", "part", "entry", "n", "radius", "total"]
        own = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

        def self_batch(batch: pa.RecordBatch, codes: pa.Array) -> pa.RecordBatch:
            columns = [batch["key"], batch["label"], batch["v"], codes, *[pa.nulls(len(batch), kind) for kind in own]]
            return pa.RecordBatch.from_arrays(columns, names=names)

        def changes(schema: pa.Schema, count: np.ndarray, radius: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
            size = n_parts * n_entries
            numbers = [np.repeat(np.arange(n_parts), n_entries), np.tile(np.arange(n_entries), n_parts), count.ravel(), radius.ravel()]
            columns = [pa.nulls(size, schema.field(name).type) for name in names[:4]]
            columns += [pa.array(values, kind) for values, kind in zip(numbers, own, strict=False)]
            columns.append(pa.array(total.reshape(size, -1).tolist(), own[-1]))
            return pa.RecordBatch.from_arrays(columns, names=names)

        more = "part int, entry int, n long, radius long, total array<long>"
        return self.table.mapInArrow(run, f"key {self.kinds['key']}, label {self.kinds['label']}, v binary, codes binary, {more}")

    def _round(self, number: int) -> None:
        """Assign all parts, then move the entries to their means."""
        written = self.scratch.write(self._assigned(), f"round{number}")
        self.scratch.drop(f"round{number - 1}")
        sums = (
            written.where("part is not null").select("part", "entry", "n", "radius", F.posexplode("total").alias("at", "x"))
            .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("x").alias("x"))
        )
        count, radius, total = np.zeros_like(self.books.count), np.zeros_like(self.books.count), np.zeros_like(self.books.total)
        for r in sums.collect():
            count[r["part"], r["entry"]], radius[r["part"], r["entry"]], total[r["part"], r["entry"], r["at"]] = r["n"], r["radius"], r["x"]
        self.books = self.books.following(count, total, radius)
        self.table = written.where("part is null").select("key", "label", "v", "codes")

    def run(self) -> DataFrame:
        """key, label, codes (a byte a part), error."""
        for number in range(1, self.rounds + 1):
            self._round(number)
        books, unpack = self.books, self._unpacked()

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            balls = books.balls()
            for batch in batches:
                numbers, before = unpack(batch)
                known = before if before is not None else np.zeros(numbers.shape[:2], np.int64)
                codes = np.stack([ball.assign(*both)[0] for ball, both in zip(balls, zip(numbers, known, strict=True), strict=True)])
                error = sum(squared(n, b[c]) for n, b, c in zip(numbers, books.entries, codes, strict=True))
                columns = [batch["key"], batch["label"], pa.array([row.tobytes() for row in codes.T.astype(np.uint8)], pa.binary()), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "codes", "error"])

        schema = f"key {self.kinds['key']}, label {self.kinds['label']}, codes binary, error long"
        found = self.scratch.write(self.table.mapInArrow(finish, schema), "codes")
        self.scratch.drop(f"round{self.rounds}")
        return found


def encode_vectors(
    df: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks | None]:
    """A row per usable row (key, label, codes, error), and the codebooks, None without rows. At most 256 entries."""
    if entries > 256:
        raise ValueError("A code is a byte, so a codebook has at most 256 entries.")
    coder = _Coder(df, vector, key, label, parts, entries, rounds)
    if coder.width is None:
        schema = f"key {coder.kinds['key']}, label {coder.kinds['label']}, codes binary, error long"
        return df.sparkSession.createDataFrame([], schema), None
    return coder.run(), coder.books


def with_label_error(found: DataFrame) -> DataFrame:
    """Add label_error, the error summed over equal labels, null being one."""
    summed = found.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    summed = Scratch(found.sparkSession, "label-errors").write(summed, "labels")
    return found.join(bounded(summed), F.col("label").eqNullSafe(F.col("same"))).drop("same")
