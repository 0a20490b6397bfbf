import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))


@pytest.fixture
def documents(spark):
    """Documents from texts; doc_id counts from 0. Clashing extra columns come along."""

    def make(texts, **more):
        rows = [(i, t, "en", "src", None, 7, "x") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id long, key string")

    return make
