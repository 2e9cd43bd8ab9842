"""Every registered query of the subpackage against its SQL at the smallest scale."""

import pytest
from oracle import compare, connect

from rimsight.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    status, note = compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLE.get(name), SF)
    assert status in ("ok", "rows"), note
