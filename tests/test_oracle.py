"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import pytest
from conftest import SF_SMALL

from lateflow.queries import SPARK, SQL

from tools.compare_oracle import compare


@pytest.mark.parametrize("name", sorted(SPARK))
def test_query_matches_oracle(spark, name):
    status = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert status.startswith("OK") or (name not in SQL and status.startswith("rows-only")), status


def test_every_query_has_an_oracle():
    assert sorted(SPARK) == sorted(SQL)
