import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from racelens.session import get_spark
    return get_spark("local[*]", 8)


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table from texts; extra columns have names that clash with inner ones."""
    def build(texts, start=0):
        rows = [(start + i, t, "en", None, None, "x", 7) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS + ", sig string, key int")
    return build
