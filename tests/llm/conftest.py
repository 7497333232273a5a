import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture
def docs_of(spark):
    """Rows (doc_id, text) with extra columns whose names clash with those the operators make."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "x", 1, [2], "y") for i, t in rows],
            "doc_id bigint, text string, key string, n_shingles int, sketch array<int>, component_id string")
    return make
