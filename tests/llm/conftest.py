import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def docs(spark):
    """documents rows from (doc_id, text) pairs, with a column more whose name an operator may use itself."""
    def make(pairs, parts=3):
        rows = [(i, t, "en", "src", len(t or ""), "mine") for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string").repartition(parts)
    return make
