import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture
def documents(spark):
    """A documents frame from (doc_id, text) pairs, with further columns whose names clash with the operators' own."""

    def build(rows):
        full = [(i, t, "en", "src0", 1, 7, "x", 3) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, piece int, length string, shard int"
        return spark.createDataFrame(full, schema)

    return build
