import hashlib

import pytest

from cofre.llm import warc
from cofre.llm.common import Scratch

HTML = "<p>" + "käse &amp; brot " * 20
EDGES = [
    (1, "http://a/1", HTML), (2, "http://a/2", HTML), (3, None, None), (4, "http://a/\r\nX: y", ""), (5, "u", "short"), (6, "u", "short"),
    (7, "u", "x" * 98 + "é"), (8, "u", "x" * 98 + "é"), (9, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nWARC/1.1\r\n" * 9),
    (None, "u", HTML), (10, "u", "€" * 5000), (10, "u", "€" * 5000), (11, "u", "\r\n" * 300), (12, "u", "\r\n\r\n"),
]


def plain(rows):
    first = {}
    for key, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100:
            first[body] = min(first.get(body, float("inf")), float("inf") if key is None else key)
    found, seen = [], set()
    for key, _, html in rows:
        body = (html or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        again = len(body) >= 100 and (key != first[body] or body in seen)
        if not again:
            seen.add(body)
        found.append((key, len(body), digest, "revisit" if again else "response", int(first[body]) if again else None))
    return found


@pytest.mark.parametrize("chunk", [3, 64, warc.CHUNK_BYTES])
def test_round_trip(spark, chunk):
    pages = spark.createDataFrame([r + ("other", 1) for r in EDGES], "page_id long, url string, html string, `key` string, rid long")
    folder = f"{Scratch(spark, 'test').path}/warc"
    warc.write_archives(pages, folder, chunk_bytes=chunk)
    found = [(None if r.key is None else int(r.key), r.payload_bytes, r.payload_digest, r.record_type, None if r.refers_to is None else int(r.refers_to)) for r in warc.read_payloads(spark, folder).collect()]
    assert sorted(found, key=repr) == sorted(plain(EDGES), key=repr)
    records = warc.read_records(spark, folder).collect()
    assert max(len(r.block) for r in records) <= chunk
    if chunk == 3:
        assert any(r.headers["WARC-Type"] == "continuation" for r in records)


def test_damage_is_found(spark):
    pages = spark.createDataFrame([(1, "u", HTML)], "page_id long, url string, html string")
    folder = f"{Scratch(spark, 'test').path}/warc"
    warc.write_archives(pages, folder)
    other = f"{Scratch(spark, 'test').path}/warc"
    spark.read.option("lineSep", "\u0000").text(folder).selectExpr("replace(value, 'brot', 'Brot') as value").write.option("lineSep", "\u0000").text(other)
    with pytest.raises(Exception, match="Damaged record"):
        warc.read_payloads(spark, other).collect()


def test_empty_table(spark):
    folder = f"{Scratch(spark, 'test').path}/warc"
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read_payloads(spark, folder).count() == 0
