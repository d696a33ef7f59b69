from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.01"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from cohortlab.session import build_session
    return build_session(master="local[*]", shuffle_partitions=8, app="cohortlab-tests")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame from (doc_id, text[, lang[, source]]) tuples, with extra columns whose names clash with internals."""
    from pyspark.sql import functions as F

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), None) for r in rows]
        extra = {c: F.lit("x") for c in ("length", "piece", "size", "start", "words", "sig", "band", "_part", "h", "tie", "bucket")}
        return spark.createDataFrame(full, DOC_SCHEMA).withColumns(extra)
    return make


@pytest.fixture(scope="session")
def sf_docs():
    """(doc_id, text, lang, source) of the small documents table."""
    import duckdb
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet'").fetchall()
