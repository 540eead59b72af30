"""The driver contract in __spark_entry__.py."""

import importlib.util

from conftest import REPO


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", REPO / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_entry_runs_the_flagship_query(spark):
    m = load_entry()
    df = m.entry(spark)
    assert df.count() == 492
    assert df.columns == ["window_start_us", "window_end_us", "zone", "trip_count", "surge_sum",
                          "surge_n", "avg_surge", "finalized_at_watermark_us", "batch_id",
                          "window_date"]


def test_every_query_has_oracle_sql():
    from lateflow.queries import SPARK

    m = load_entry()
    assert set(SPARK) <= set(m.oracle_sql()) <= set(m.queries())
    assert len(SPARK) >= 51
