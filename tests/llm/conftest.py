"""Helpers of the operator tests; the session comes from the parent folder."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Rows from (doc_id, text), with columns whose names the operators use themselves."""

    def make(rows):
        full = [(i, t, "x", 1, "y", 2) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, mark string, g int, score string, n int")

    return make
