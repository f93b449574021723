"""WARC archives of any payload size, as a table of record chunks.

A payload becomes rows (record, chunk number, at most ``chunk_bytes`` bytes) that carry the digest of all bytes so
far. The row that holds the payload in the given table is the last place where it is whole: it is cut there, one record at
a time, and from then on neither archives, digests nor reading hold a record in one buffer. A payload of several chunks is written as the
format's segments: one record for the first chunk and ``continuation`` records for the rest. Archives are written
and read by Spark's text source. A payload is also cut inside every occurrence of the line that begins a record,
so that this line parts an archive into records without fail.

Of equal payloads of at least ``revisit_bytes`` bytes the one with the smallest key is a ``response``, the others
are ``revisit`` records that name it and have no payload of their own.

Defined results: a null payload is empty; a null key is larger than any other; each row has a record of its own,
also a repeated one; line ends in an address are percent-encoded. An empty table gives empty archives. Other columns, whatever their names,
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofre.llm.common import Scratch, bounded
from cofre.llm.exact_dedup import chunks

CHUNK_BYTES = 262_144
REVISIT_BYTES = 100
#: Fixed values of the format.
BEGIN = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _running_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of a record come one after the other; number 0 begins a record."""
    digest, size = hashlib.sha256(), 0
    for batch in batches:
        so_far, sizes = [], []
        for number, chunk in zip(batch["chunk_no"], batch["chunk"], strict=True):
            if number == 0:
                digest, size = hashlib.sha256(), 0
            digest.update(chunk)
            size += len(chunk)
            so_far.append(digest.hexdigest())
            sizes.append(size)
        yield batch.assign(bytes_so_far=sizes, digest_so_far=so_far)


def chunk_table(df: DataFrame, key: str, url: str, payload: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """rid, key, url, chunk_no, is_last, chunk, bytes_so_far, digest_so_far."""
    begin = BEGIN.replace(".", r"\.")
    parts = F.split(F.coalesce(F.col(payload), F.lit("")), f"(?<={begin[:-1]})(?=\n)")
    cut = F.flatten(F.transform(parts, lambda part: chunks(part.cast("binary"), chunk_bytes)))
    rows = df.select(
        F.monotonically_increasing_id().alias("rid"), F.col(key).alias("key"), F.col(url).alias("url"), cut.alias("cut")
    ).select("rid", "key", "url", F.size("cut").alias("n"), F.posexplode("cut").alias("chunk_no", "chunk"))
    rows = rows.select("rid", "key", "url", "chunk_no", (F.col("chunk_no") == F.col("n") - 1).alias("is_last"), "chunk")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(_running_digests, f"{schema}, bytes_so_far long, digest_so_far string")


def _record_id(key: Column, rid: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.url_encode(F.coalesce(key.cast("string"), F.lit(""))), F.lit(":"), rid.cast("string"))


def _header(name: str, value: Column) -> Column:
    """A header line; null where ``value`` is null."""
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def write_archives(
    df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
    chunk_bytes: int = CHUNK_BYTES, revisit_bytes: int = REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record per row of ``df`` to compressed archives in ``folder``."""
    scratch = Scratch(df.sparkSession, "warc")
    table = scratch.write(chunk_table(df, key, url, payload, chunk_bytes), "chunks")
    whole = table.where("is_last").select("rid", "key", F.col("bytes_so_far").alias("n_bytes"), F.col("digest_so_far").alias("digest"))
    large = whole.where(F.col("n_bytes") >= revisit_bytes)
    first = large.groupBy("digest").agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "rid")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    revisits = large.join(first, "digest").where(F.col("rid") != F.col("first.rid")).select(
        "rid", "digest", _record_id(F.col("first.key"), F.col("first.rid")).alias("refers_to")
    )
    revisits = scratch.write(revisits, "revisits")
    sized = bounded(revisits)
    of_chunk = table.join(sized.drop("digest"), "rid", "left_anti")
    record = _record_id(F.col("key"), F.col("rid"))
    target = F.replace(F.replace(F.col("url").cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    several = (F.col("chunk_no") > 0) | ~F.col("is_last")
    later = F.col("chunk_no") > 0

    def lines(*headers: Column) -> Column:
        return F.concat(F.lit(BEGIN), F.concat_ws("\r\n", *headers), F.lit(END))

    responses = of_chunk.select(F.concat(
        lines(
            _header("WARC-Type", F.when(later, "continuation").otherwise("response")),
            _header("WARC-Record-ID", F.concat(F.lit("<"), record, F.when(later, F.concat(F.lit(":"), F.col("chunk_no"))).otherwise(""), F.lit(">"))),
            _header("WARC-Target-URI", target),
            _header("WARC-Date", F.lit(date)),
            _header("WARC-Segment-Number", F.when(several, F.col("chunk_no") + 1)),
            _header("WARC-Segment-Origin-ID", F.when(later, F.concat(F.lit("<"), record, F.lit(">")))),
            _header("WARC-Segment-Total-Length", F.when(several & F.col("is_last"), F.col("bytes_so_far"))),
            _header("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("chunk", 256))),
            _header("WARC-Payload-Digest", F.when(F.col("is_last"), F.concat(F.lit("sha256:"), F.col("digest_so_far")))),
            _header("Content-Type", F.lit("text/html; charset=utf-8")),
            _header("Content-Length", F.octet_length("chunk")),
        ),
        F.col("chunk").cast("string"), F.lit("\r\n"),
    ).alias("value"))
    again = table.where("is_last").join(sized, "rid").select(F.concat(
        lines(
            _header("WARC-Type", F.lit("revisit")),
            _header("WARC-Record-ID", F.concat(F.lit("<"), record, F.lit(">"))),
            _header("WARC-Target-URI", target),
            _header("WARC-Date", F.lit(date)),
            _header("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to"), F.lit(">"))),
            _header("WARC-Profile", F.lit(PROFILE)),
            _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            _header("Content-Length", F.lit(0)),
        ),
        F.lit("\r\n"),
    ).alias("value"))
    responses.unionAll(again).write.option("lineSep", "\r\n").option("compression", "gzip").text(folder)
    scratch.drop("chunks")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives as they stand: headers as a map, and the block. A damaged record fails the job."""
    raw = spark.read.option("lineSep", BEGIN).text(folder).where("octet_length(value) > 0")
    rows = raw.select(F.substring_index("value", END, 1).alias("head"), F.col("value").cast("binary").alias("value"))
    rows = rows.select(F.str_to_map("head", F.lit("\r\n"), F.lit(": ")).alias("headers"), F.octet_length("head").alias("skip"), "value")
    size = F.col("headers")["Content-Length"].cast("int")
    block = F.substring(F.col("value"), F.col("skip") + len(END) + 1, size)
    rows = rows.select("headers", block.alias("block"), (F.octet_length("value") == F.col("skip") + size + 2 * len(END)).alias("whole"))
    digest = F.col("headers")["WARC-Block-Digest"]
    sound = F.col("whole") & (digest.isNull() | (digest == F.concat(F.lit("sha256:"), F.sha2("block", 256))))
    broken = F.raise_error(F.concat(F.lit("Damaged record "), F.col("headers")["WARC-Record-ID"])).cast("binary")
    return rows.select("headers", F.when(sound, F.col("block")).otherwise(broken).alias("block"))


def _whole_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Segments come in order of origin and number; a row for each origin, when its last segment is there."""
    digest, size = hashlib.sha256(), 0
    for batch in batches:
        found = []
        for row in batch.itertuples(index=False):
            if row.number == 1:
                digest, size = hashlib.sha256(), 0
            digest.update(row.block)
            size += len(row.block)
            if row.total == row.total:  # a number, so the last segment
                found.append((row.record, size, digest.hexdigest(), size == row.total))
        if found:
            yield pd.DataFrame(found, columns=["record", "n_bytes", "digest", "complete"])


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record, segments put together: key (as text), payload_bytes, payload_digest, record_type, refers_to.

    Bytes and digest are those of the payload read, for a revisit those of the response it names. They are held
    against the digests in the headers; a difference fails the job.
    """
    headers = F.col("headers")
    rows = read_records(spark, folder).select(
        F.btrim(headers["WARC-Record-ID"], F.lit("<>")).alias("record"),
        F.btrim(F.coalesce(headers["WARC-Segment-Origin-ID"], headers["WARC-Record-ID"]), F.lit("<>")).alias("origin"),
        headers["WARC-Type"].alias("record_type"),
        F.btrim(headers["WARC-Refers-To"], F.lit("<>")).alias("refers_to"),
        headers["WARC-Payload-Digest"].alias("named"),
        headers["WARC-Segment-Number"].cast("int").alias("number"),
        headers["WARC-Segment-Total-Length"].cast("double").alias("total"),
        "block",
    )
    sha = F.concat(F.lit("sha256:"), F.col("digest"))
    single = rows.where("number is null and record_type = 'response'").select(
        "record", F.octet_length("block").cast("long").alias("n_bytes"), F.sha2("block", 256).alias("digest"), "named"
    )
    segments = rows.where("number is not null").select(F.col("origin").alias("record"), "number", "total", "block")
    joined = (
        segments.repartition("record")
        .sortWithinPartitions("record", "number")
        .mapInPandas(_whole_digests, "record string, n_bytes long, digest string, complete boolean")
    )
    last = rows.where("total is not null").select(F.col("origin").alias("record"), "named")
    segmented = joined.join(last, "record").select(
        "record", F.when(F.col("complete"), F.col("n_bytes")).otherwise(F.raise_error(F.lit("Segments are missing")).cast("long")).alias("n_bytes"),
        "digest", "named",
    )
    checked = F.when(sha == F.col("named"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("Another digest than named by "), F.col("record")))
    )
    responses = single.unionByName(segmented).select(
        "record", "n_bytes", checked.alias("digest"), F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to")
    )
    revisits = rows.where("record_type = 'revisit'").select("record", "refers_to", "named")
    read_again = revisits.join(responses.select(F.col("record").alias("refers_to"), "n_bytes", "digest"), "refers_to", "left").select(
        "record", "n_bytes", checked.alias("digest"), F.lit("revisit").alias("record_type"), "refers_to"
    )

    def key_of(record: str) -> Column:
        return F.nullif(F.url_decode(F.split(F.col(record), ":")[2]), F.lit(""))

    return responses.unionByName(read_again).select(
        key_of("record").alias("key"), F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", key_of("refers_to").alias("refers_to"),
    )
