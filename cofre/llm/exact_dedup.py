"""Exact deduplication with composable polynomial fingerprints.

A text is cut into chunks of bytes. The fingerprint of a chunk is its polynomial modulo two primes; two neighbours
combine as ``left * base^len(right) + right``, so chunks are hashed apart, in any task, and whole texts need no
buffer of their own. Rows of equal fingerprint and length form a class; its texts are then compared chunk by chunk:
all copies of a chunk are equal when their smallest and largest are, which combines before the shuffle, so a class
that holds a third of all rows costs one row per task and chunk. A class that fails (a collision) is divided by
the SHA-256 of the whole texts.

Defined results: a null text counts as empty and all empty texts are equal. Of equal texts the largest key stays, a
null key loses to any other, and of repeated rows with the same key exactly one stays. Texts of any length are hashed and
compared in chunks. An empty table gives no rows. Columns other than key and text, whatever their names, are neither read
nor clash with anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import Scratch, bounded, join_few, join_groups, keep_rows, lower_ascii

#: The two largest primes below 2^31: products of two residues fit a bigint.
MODULI = (2147483647, 2147483629)
BASES = (1103515245, 1664525013)
#: Bytes of a chunk that is hashed, and of one that is compared.
HASH_BYTES = 65536
COMPARE_BYTES = 4096

_powers: dict[tuple[int, int], np.ndarray] = {}


def _power_table(base: int, modulus: int, size: int) -> np.ndarray:
    """base^0 .. base^(size-1), or more of them, modulo ``modulus``."""
    table = _powers.get((base, modulus), np.ones(1, np.int64))
    while len(table) < size:
        table = np.concatenate([table, table * (int(table[-1]) * base % modulus) % modulus])
    _powers[base, modulus] = table
    return table


def chunk_polynomial(chunk: bytes, base: int, modulus: int) -> tuple[int, int]:
    """The chunk's polynomial, and the factor that shifts what stands to its left."""
    size = len(chunk)
    table = _power_table(base, modulus, size + 1)
    digits = np.frombuffer(chunk, np.uint8).astype(np.int64) + 1
    return int(digits @ table[:size][::-1]) % modulus, int(table[size])


def chunks(binary: Column, size: int) -> Column:
    """Pieces of at most ``size`` bytes, in order; one empty piece of an empty text."""
    last = F.floor(F.greatest(F.octet_length(binary) - 1, F.lit(0)) / size)
    return F.transform(F.sequence(F.lit(0), last.cast("int")), lambda i: F.substring(binary, i * size + 1, F.lit(size)))


def _hash_chunks(moduli: tuple[int, ...]):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[chunk_polynomial(c, b, m) for b, m in zip(BASES, moduli, strict=True)] for c in batch]
            yield pd.DataFrame(
                [(a[0], a[1], b[0], b[1]) for a, b in found], columns=["h1", "f1", "h2", "f2"], dtype="int64"
            )

    return F.pandas_udf(run, "h1 long, f1 long, h2 long, f2 long")


def fingerprints(
    df: DataFrame, text: str = "text", key: str = "doc_id", chunk_bytes: int = HASH_BYTES, moduli: tuple[int, int] = MODULI
) -> DataFrame:
    """One row per row of ``df``: key, row_hash, text_sha256, n_bytes, and the fingerprint h1, h2."""
    whole = df.select(F.col(key).alias("key"), lower_ascii(F.col(text)).alias("norm")).select(
        F.monotonically_increasing_id().alias("rid"),
        "key",
        F.xxhash64("norm").alias("row_hash"),
        F.sha2("norm", 256).alias("text_sha256"),
        F.col("norm").cast("binary").alias("norm"),
    )
    pieces = whole.select(
        "rid", "key", "row_hash", "text_sha256", F.octet_length("norm").cast("long").alias("n_bytes"),
        F.posexplode(chunks(F.col("norm"), chunk_bytes)).alias("chunk_no", "chunk"),
    )
    hashed = pieces.select("*", _hash_chunks(moduli)("chunk").alias("p")).drop("chunk").select("*", "p.*").drop("p")

    def combined(hash_column: str, factor: str, modulus: int) -> Column:
        return F.aggregate(
            "parts", F.lit(0).cast("long"), lambda left, x: (left * x[factor] + x[hash_column]) % F.lit(modulus)
        ).alias(hash_column)

    return (
        hashed.groupBy("rid", "key", "row_hash", "text_sha256", "n_bytes")
        .agg(F.array_sort(F.collect_list(F.struct("chunk_no", "h1", "f1", "h2", "f2"))).alias("parts"))
        .select(
            "rid", "key", "row_hash", "text_sha256", "n_bytes",
            combined("h1", "f1", moduli[0]), combined("h2", "f2", moduli[1]),
        )
    )


def collisions(df: DataFrame, members: DataFrame, text: str, key: str) -> DataFrame:
    """Fingerprints (h1, h2, n_bytes) under which texts differ. ``members``: key, row_hash and fingerprint of the texts to compare."""
    whole = df.select(F.col(key).alias("key"), lower_ascii(F.col(text)).alias("norm")).withColumn("row_hash", F.xxhash64("norm"))
    sought = members.withColumnsRenamed({"key": "m_key", "row_hash": "m_hash"})
    pieces = join_few(whole, sought, [(whole["key"], "m_key"), (whole["row_hash"], "m_hash")]).select(
        "h1", "h2", "n_bytes", F.posexplode(chunks(F.col("norm").cast("binary"), COMPARE_BYTES)).alias("chunk_no", "chunk")
    )
    compared = pieces.groupBy("h1", "h2", "n_bytes", "chunk_no").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    return compared.where("low <> high").select("h1", "h2", "n_bytes").distinct()


def exact_duplicates(
    df: DataFrame, text: str = "text", key: str = "doc_id", chunk_bytes: int = HASH_BYTES, moduli: tuple[int, int] = MODULI
) -> DataFrame:
    """One row per row of ``df``: key, row_hash, keep_id, group_size, kept, text_sha256, n_bytes."""
    scratch = Scratch(df.sparkSession, "exact")
    rows = scratch.write(fingerprints(df, text, key, chunk_bytes, moduli), "fingerprints")
    mark = ["h1", "h2", "n_bytes"]
    repeated = rows.groupBy(*mark).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = scratch.write(rows.join(repeated, mark, "left_semi").select("key", "row_hash", *mark).distinct(), "members")
    differing = scratch.write(collisions(df, members, text, key), "differing")
    n_differing = differing.count()
    part = F.lit("")
    if n_differing:
        rows = rows.join(bounded(differing.withColumn("differs", F.lit(True))), mark, "left")
        part = F.when(F.col("differs"), F.col("text_sha256")).otherwise("")
    rows = rows.withColumn("part", part)
    groups = rows.groupBy(*mark, "part").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("key", "rid")).alias("best")
    )
    groups = scratch.write(groups.withColumn("size", F.col("group_size")), "groups")
    return join_groups(rows, groups, [*mark, "part"]).select(
        "key", "row_hash", F.col("best.key").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"), "text_sha256", "n_bytes",
    )


def drop_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay, with all its columns as they were."""
    return keep_rows(df, exact_duplicates(df, text, key), key, F.xxhash64(lower_ascii(df[text])))
