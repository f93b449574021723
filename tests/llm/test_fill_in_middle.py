import hashlib
import re

import pytest

from cofre.llm import fill_in_middle as fim
from cofre.llm.common import Scratch

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
EDGES = [
    (1, "one two  three\n four"), (2, None), (3, ""), (4, "   \t\n"), (5, " lead and trail "), (6, "é ü 汉字 😀 x" * 9), (7, "a <P> b c d"),
    (8, "x<S>y z"), (9, "<M>"), (10, "< P> <S <M S> >"), (11, "nospace" * 900), (12, "\x1c a\x85b \xa0c  d"), (13, "😀" * 700), (14, " " * 800 + "end"),
    (14, " " * 800 + "end"), (None, "no key at all"), *[(20 + i, f"w{i} " * (i + 1) + "<" * (i % 4)) for i in range(60)],
]


def plain(key, text, rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    one, two, chance, kind = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    low, high = sorted((one % (n + 1), two % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or chance % 100 >= rate:
        return key, n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if kind % 100 < spm:
        return key, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return key, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize(("frame_bytes", "rate", "spm"), [(4, 100, 50), (7, 100, 0), (64, 100, 100), (fim.FRAME_BYTES, 50, 80)])
def test_against_plain_cuts(spark, documents, frame_bytes, rate, spm):
    stored = Scratch(spark, "test").write(fim.store_frames(documents(EDGES, clashing=True), frame_bytes=frame_bytes), "frames")
    moved = fim.transform(fim.draw_cuts(stored, rate=rate, spm=spm))
    wanted = [plain(key, text, rate, spm) for key, text in EDGES]
    if rate == 100:
        assert len({row[2] for row in wanted}) == (3 if spm == 50 else 2)
    texts = moved.select("key", "n", "form", "prefix_chars", "middle_chars").collect()
    assert sorted((tuple(r) for r in texts), key=repr) == sorted((row[:5] for row in wanted), key=repr)
    outputs = [(r["key"], r["form"], r["text"]) for r in fim.texts(moved).collect()]
    assert sorted(outputs, key=repr) == sorted(((row[0], row[2], row[5]) for row in wanted), key=repr)
    found = [(r["key"], r["output_sha256"], r["restored_sha256"]) for r in fim.digests(moved).collect()]

    def sha(text):
        return hashlib.sha256((text or "").encode()).hexdigest()

    assert sorted(found, key=repr) == sorted(((row[0], sha(row[5]), sha(text)) for row, (_, text) in zip(wanted, EDGES, strict=True)), key=repr)


def test_frames_are_apart_and_bounded():
    text = ("word é 😀 " * 5000).encode()
    kept = fim.Frames.of(text, 1000)
    parts = [fim.decompress(f) for f in kept.frames]
    assert b"".join(parts) == text and max(map(len, parts)) <= 1000
    assert all(p.decode() for p in parts) and kept.n == 15001 and kept.n_chars == len(text.decode())
    assert [len("".join(p.decode() for p in parts[:i])) for i in range(len(parts))] == list(kept.chars_before)


def test_selection_opens_cut_frames_only(monkeypatch):
    kept = fim.Frames.of(("word " * 100_000).encode(), 1000)
    opened = []
    monkeypatch.setattr(fim, "decompress", lambda frame, plain=fim.decompress: opened.append(1) or plain(frame))
    fim.rearrange(kept, "psm", 20_000, 70_000)
    assert len(opened) <= 6 < len(kept.frames)


def test_restoring_reads_markers_that_run_over_frames():
    frames = [fim._compress(piece) for piece in (b"<", b"P>one <S", b"> three<M> two", b"")]
    assert b"".join(fim.restore(frames, "psm")) == b"one  two three"
    with pytest.raises(ValueError, match="lacks a marker"):
        list(fim.restore(frames, "spm"))


def test_empty_table(spark, documents):
    assert fim.digests(fim.fill_in_middle(documents([]))).collect() == []
