"""Every registered query's physical plan is free of nested-loop and cartesian joins."""

from conftest import SF_SMALL

from tools.plan_census import census


def test_no_nested_loop_or_cartesian_join(spark):
    res = census(spark, SF_SMALL)
    assert len(res) >= 51
    assert [n for n, c in res.items() if c["nlj"]] == []
