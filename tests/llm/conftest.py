from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[1])]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the smallest documents table."""
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text[, lang, source]) rows, with columns whose names clash with inner ones."""

    def make(rows):
        full = [(*row, *(None,) * (4 - len(row)), 1, "x", 2, 3, True, "y") for row in rows]
        schema = (
            "doc_id long, text string, lang string, source string, n_words int, bytes string, row int, `end` int, "
            "kept boolean, `a.b` string"
        )
        return spark.createDataFrame(full, schema)

    return make
