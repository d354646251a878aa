import tempfile

import pytest

from llm_data import EDGE_DOCS, write_tables


@pytest.fixture(scope="session")
def edge_dir(spark):
    """Tables with nulls, empty and long texts, ties, repeated rows and columns named like results."""
    return write_tables(spark, tempfile.mkdtemp(prefix="edgeloom-edge-"), EDGE_DOCS)


@pytest.fixture(scope="session")
def empty_dir(spark):
    return write_tables(spark, tempfile.mkdtemp(prefix="edgeloom-empty-"), [], empty=True)
