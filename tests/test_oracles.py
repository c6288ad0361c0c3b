"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from oracle_check import connect, differences

from folioforge.plans.oracles import ORACLES
from folioforge.plans.queries import QUERIES

pytestmark = pytest.mark.oracle
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
if not os.path.isdir(SF_DIR):
    pytest.skip("no test tables", allow_module_level=True)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    # Principal components of 64 features have no SQL form; tests compare them with numpy.
    assert set(QUERIES) - set(ORACLES) == {"pca_embeddings"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, QUERIES[name], ORACLES[name], SF_DIR) == []


def test_flagship_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
