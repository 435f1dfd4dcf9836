"""Small frames with the hard cases: nulls, empty and long texts, ties, repeated rows, further columns."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, bits long, cands string, rank string, part string"


@pytest.fixture
def docs(spark):
    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, None, "s", None, 1, "x", "y", "z") for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, CLASHING)

    return make
