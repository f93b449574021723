import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cofre.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "one two", "tab\tnew\nline\r\nend", "\x1c\x1d a\x1eb \x1f", "a\x85b \xa0c  d e", "é ́x ̸= < ̸", "ΟΔΟΣ ΣΑΣ. İI ǅ",
    "<|endoftext|> x<|startoftext|>y", "汉字 かな 😀👍🏽", "12 1.2 ½ ²", "don't 'S we'LL", "x" * 3000, "a\x00b ﻿ ​", "¡Qué! ñandú…",
]


def whole_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    tokenizer = Tokenizer.from_file(PATH)
    monkeypatch.setattr(packing, "MEMORY", 20)
    words, whole = packing.Words(PATH), packing.Whole(PATH)
    texts = ODD + [" ".join(ODD)] + ["".join(random.Random(i).choices("aZé ß'́\x1f 0.,- \n", k=60)) for i in range(200)]
    wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for encoder in (words, whole):
        for low in range(0, len(texts), 50):
            flat, counts = encoder.encode(pa.array(texts[low : low + 50], pa.string()))
            assert [list(p) for p in np.split(flat, np.cumsum(counts)[:-1])] == wanted[low : low + 50]


def plain_first_fit(sizes, capacity):
    bins = []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for parts in bins:
            if sum(sizes[i] for i in parts) + sizes[item] <= capacity:
                parts.append(item)
                break
        else:
            bins.append([item])
    return bins


@pytest.mark.parametrize("seed", range(30))
def test_first_fit_and_holes(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 64, 100])
    sizes = [rng.randint(1, capacity) if rng.random() < 0.5 else rng.randint(1, 5) for _ in range(rng.randint(1, 300))]
    bins = packing.first_fit_decreasing(sizes, capacity)
    assert [[item for item, _, _ in b.parts] for b in bins] == plain_first_fit(sizes, capacity)
    least = rng.randint(1, 8)
    done = packing.pack_group(sizes, capacity, least)
    parts = sorted(part for b in done for part in b.parts)
    ends = {}
    for item, start, length in parts:
        assert start == ends.get(item, 0) and length > 0
        ends[item] = start + length
    assert ends == dict(enumerate(sizes))
    for b in done:
        assert b.load == sum(p[2] for p in b.parts) <= capacity
        assert capacity - b.load < least or b.load & (b.load - 1) == 0


def check(rows, texts, capacity, least):
    """Every id in one piece, sequences without gaps, little padding."""
    wanted = {key: whole_ids(text) for key, text in texts}
    of_key, of_sequence = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and r["doc_tokens"] == len(wanted[r["key"]])
        of_key.setdefault(r["key"], []).append((r["start"], ids))
        of_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for key, ids in wanted.items():
        copies = sum(k == key for k, _ in texts)
        found = sorted(of_key[key])
        if copies == 1:
            assert [i for _, part in found for i in part] == ids
            assert [start for start, _ in found] == [sum(len(p) for _, p in found[:i]) for i in range(len(found))]
        assert sum(len(part) for _, part in found) == copies * len(ids)
    for parts in of_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity and (capacity - end < least or end & (end - 1) == 0)
    return of_sequence


@pytest.mark.parametrize(("capacity", "group", "least", "by_word"), [(4096, 4096, 32, True), (16, 10, 3, True), (16, 10, 1, False), (100, 7, 9, True)])
def test_every_id_once(spark, documents, capacity, group, least, by_word):
    texts = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "some words here " * i) for i in range(50)]
    texts += [(7000, None), (7001, "again"), (7001, "again"), (None, "no key")]
    given = documents(texts, clashing=True).repartition(3)
    found = packing.pack(given, PATH, 2, capacity=capacity, group=group, least_part=least, by_word=by_word)
    rows = found.collect()
    sequences = check(rows, texts, capacity, least)
    made = packing.sequences(found, capacity, pad=1).collect()
    assert {r["sequence_id"]: r["length"] for r in made} == {s: sum(n for _, n in parts) for s, parts in sequences.items()}
    for r in made:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == (r["length"] if r["length"] & (r["length"] - 1) == 0 else capacity) and set(ids[r["length"] :]) <= {1}
        placed = sorted((p["offset"], p["ids"]) for p in rows if p["sequence_id"] == r["sequence_id"])
        assert b"".join(part for _, part in placed) == ids[: r["length"]].tobytes()


def test_query(spark):
    from conftest import FOLDER

    from cofre.llm import queries

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.queries()["op12_packing"](spark, FOLDER).collect()
    found = {}
    for r in rows:
        ids = whole_ids(texts[r["doc_id"]])
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        found.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert set(found) == set(texts)
    for key, parts in found.items():
        assert sum(n for _, n in parts) == len(whole_ids(texts[key]))


def test_empty_table(spark, documents):
    assert packing.pack(documents([]), PATH, 2).collect() == []
