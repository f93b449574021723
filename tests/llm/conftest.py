import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cofre.llm.common import ship  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside, in any spelling of their own.
CLASHING = "`key` string, rid long, row_hash long, kept boolean, n long, node string, component long, mark string, `_key` long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    """Make a documents table of (doc_id, text) or (doc_id, text, lang, source) rows, with clashing columns on request."""

    def make(rows, clashing=False):
        full = [(tuple(r) + (None,) * 4)[:4] + (len(r[1] or ""),) for r in rows]
        if not clashing:
            return spark.createDataFrame(full, DOCUMENTS)
        more = ("other", 1, 2, True, 3, "x", 4, "y", 5)
        return spark.createDataFrame([r + more for r in full], f"{DOCUMENTS}, {CLASHING}")

    return make
