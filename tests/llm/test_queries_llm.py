"""Every registered query of the operators, against its SQL where it has one."""

import pytest
from oracle import compare

from landledger.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    if name in queries.ORACLES:
        compare(name, df, sf, queries.ORACLES[name])
    else:
        assert df.count() > 0
