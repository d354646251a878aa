"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import functools
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest

from __spark_entry__ import entry
from edgeloom.plans import q_load, q_merge, q_query, q_round_trip
from edgeloom.plans.catalog import oracle_sql, queries
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module", autouse=True)
def one_graph():
    """The queries over the loaded graph share one, which is loaded (and stored) once."""
    cached = functools.lru_cache(q_load.graph)
    with pytest.MonkeyPatch.context() as m:
        for module in (q_load, q_merge, q_query, q_round_trip):
            if hasattr(module, "graph"):
                m.setattr(module, "graph", cached)
        yield


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, queries()[name], oracle_sql()[name], SF)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["id", "label", "line"]
    assert df.count() > 0
