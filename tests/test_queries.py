"""Every registered query of the engine's own operators against its DuckDB SQL; rows where there is none."""

from __future__ import annotations

import oracle
import pytest
from conftest import SF

from gridflux.plans.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE_SQL:
        assert oracle.difference(con, ORACLE_SQL[name], df) == ""
    else:
        assert df.count() > 0


def test_entry_registers_all(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
