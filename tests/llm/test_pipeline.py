"""Each stage on its own input against plain versions, and that nothing else happens to rows."""

import re

import pytest
from conftest import FOLDER
from test_exact_dedup import plain as exact_plain
from test_mixing import plain as mix_plain
from test_near_duplicates import brute

import corpus_pipeline
from cofre.llm import language_id
from cofre.llm.common import read
from cofre.llm.queries import held_out

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Rows after each stage, the input first."""
    docs = read(spark, FOLDER, "documents")
    found = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        assert result.columns[:5] == COLUMNS
        rows = result.collect()
        docs = spark.createDataFrame([tuple(r)[: len(COLUMNS)] for r in rows], docs.schema)
        found.append(rows)
    return found


def keys(rows):
    return sorted(r.doc_id for r in rows)


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "mixing"]


def test_language_stage_keeps_what_is_not_rejected(spark, steps):
    docs = read(spark, FOLDER, "documents")
    found = language_id.identify(docs, ~held_out(docs["doc_id"])).where("not rejected").collect()
    assert keys(steps[1]) == sorted(r.key for r in found)
    with_letters = [r.doc_id for r in steps[0] if re.search(r"[^\W\d_]", r.text or "")]
    assert set(keys(steps[1])) <= set(with_letters) and len(steps[1]) >= 0.98 * len(with_letters)


def test_exact_stage(steps):
    assert keys(steps[2]) == sorted(k for k, _ in exact_plain([(r.doc_id, r.text) for r in steps[1]]).values())


def test_near_stage(steps):
    assert keys(steps[3]) == sorted({c for _, c in brute([(r.doc_id, r.text) for r in steps[2]], 5).values()})


def test_decontamination_stage(spark, steps):
    def words(text):
        return [w for w in (re.sub(r"[\W_]", "", x.lower()) for x in text.split()) if w]

    items = [words(r.text) for r in read(spark, FOLDER, "benchmark").collect()]
    marks = [{tuple(w[i : i + 8]) for i in range(len(w) - 7)} for w in items]

    def leaks(text):
        w = words(text)
        found = {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
        return any(len(m & found) >= min(-(-len(m) // 2), 6) for m in marks if m)

    assert keys(steps[4]) == [r.doc_id for r in sorted(steps[3]) if not leaks(r.text)]


def test_mixing_stage(steps):
    wanted = mix_plain([(r.doc_id, r.text, r.source) for r in steps[4]])
    assert keys(steps[5]) == sorted(k for (k, _, _), n in wanted.items() for _ in range(n))


def test_run_is_the_stages(spark, steps):
    assert keys(corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()) == keys(steps[5])


def test_stages_take_any_table(spark, documents):
    df = documents([(1, None), (1, None), (2, "text of one document"), (2, "text of one document"), (None, "no key, some text")], clashing=True)
    for table in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            result = stage(spark, table, FOLDER)
            assert result.columns[: len(df.columns)] == df.columns
            result.collect()
