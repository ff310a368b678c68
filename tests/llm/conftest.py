import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, with ids, sources and columns that clash with results."""

    def make(texts, sources=None, langs=None):
        rows = [
            (i, t, (sources or ["s"] * len(texts))[i], (langs or ["en"] * len(texts))[i], "x", -1)
            for i, t in enumerate(texts)
        ]
        schema = "doc_id long, text string, source string, lang string, n_words string, kept int"
        return spark.createDataFrame(rows, schema)

    return make
