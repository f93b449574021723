import hashlib
import math
import random

import numpy as np
import pytest

from cofre.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label string, `key` string, codes binary, v int, part int, error long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "other", b"x", 1, 2, 3) for i, v, label in rows], SCHEMA)


def plain(rows, parts=8, entries=16, rounds=6):
    """The same by all distances, row after row."""
    kept = [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    numbers = [[math.floor(4096 * x) for x in v] for _, v, _ in kept]
    size = len(numbers[0]) // parts
    cut = [[n[p * size : (p + 1) * size] for p in range(parts)] for n in numbers]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        codes = [[nearest(p, c[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, code in zip(cut, codes, strict=True) if code[p] == e]
                if mine:
                    books[p][e] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    last = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return [(k[0], k[2], bytes(e for _, e in row), sum(d for d, _ in row)) for k, row in zip(kept, last, strict=True)], digest


def cases():
    rng = random.Random(3)
    near = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.251]) for _ in range(16)], rng.choice(["a", "b", None])) for i in range(150)]
    odd = [
        (500, None, "a"), (501, [], "a"), (502, [math.nan] * 16, "a"), (503, [1.0] * 15 + [math.inf], "b"), (504, [0.0] * 15 + [None], None),
        (505, [-math.inf] + [0.0] * 15, None), (None, [0.1] * 16, "c"), (7, [0.3] * 16, "dup"), (7, [0.3] * 16, "dup"),
    ]
    blobs = [(i, [rng.gauss(3 * (i % 20), 0.2) for _ in range(8)], None) for i in range(200)]
    return {"ties": near + odd, "few": near[:5] + odd[:6], "same": [(i, [0.5] * 8, "x") for i in range(40)], "blobs": blobs}


@pytest.mark.parametrize("name", ["ties", "few", "same", "blobs"])
def test_against_all_distances(spark, name):
    rows = cases()[name]
    found, books = vc.encode_vectors(table(spark, rows).repartition(3))
    wanted, digest = plain(rows)
    assert sorted(((r["key"], r["label"], bytes(r["codes"]), r["error"]) for r in found.collect()), key=repr) == sorted(wanted, key=repr)
    assert books.digest() == digest
    of_label = {}
    for _, label, _, error in wanted:
        of_label[label] = of_label.get(label, 0) + error
    summed = vc.with_label_error(found).collect()
    assert len(summed) == len(wanted) and all(r["label_error"] == of_label[r["label"]] for r in summed)


@pytest.mark.parametrize("seed", range(20))
def test_balls_skip_nothing_that_matters(seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(-4, 5, (300, 3)) + (rng.integers(0, 4, (300, 1)) * (30 if seed % 2 else 3))
    entries, codes, radius, moved = points[:10].copy(), np.zeros(300, np.int64), np.zeros(10, np.int64), np.ones(10, bool)
    skipped = 0
    for _ in range(40):
        ball = vc.Ball(entries, moved, radius)
        skipped += int(ball.stable.sum())
        codes, radius = ball.assign(points, codes)
        distances = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (codes == distances.argmin(axis=1)).all()
        for e in range(10):
            assert radius[e] >= max(distances[codes == e, e], default=0)
        means = np.array([points[codes == e].sum(axis=0) // max((codes == e).sum(), 1) if (codes == e).any() else entries[e] for e in range(10)])
        moved, entries = (means != entries).any(axis=1), means
    assert skipped > 0


def test_lengths_and_sizes_that_cannot_be(spark):
    for rows in ([(1, [0.0] * 8, ""), (2, [0.0] * 16, "")], [(1, [0.0] * 9, "")], [(1, [1e12] * 8, "")]):
        with pytest.raises(ValueError, match="equal parts|too large"):
            vc.encode_vectors(table(spark, rows))


def test_empty_table(spark):
    for rows in ([], [(1, None, "a")]):
        found, books = vc.encode_vectors(table(spark, rows))
        assert books is None and vc.with_label_error(found).collect() == []
