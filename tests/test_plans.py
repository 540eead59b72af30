"""Plan shapes that the design relies on at scale."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from lateflow.plans.replay import Replay
from lateflow.sources.arrivals import trip_events

from tools.plan_census import written_plans


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_per_slice_pass_reads_two_columns(spark, capsys):
    r = Replay(trip_events(spark, SF_SMALL))
    per_slice = r.timed.groupBy("slice_id").agg(F.max("et_us"))
    per_slice.explain("formatted")
    text = capsys.readouterr().out
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    # the per-trip window (schema version) is pruned away: no trip shuffle here
    assert "Window" not in text


def test_events_are_classified_once_for_both_products(spark):
    """Late rows and window counts read one written table: the events are scanned once for
    the batches and once for the classification, and the trips are shuffled once."""
    with written_plans() as plans:
        r = Replay(trip_events(spark, SF_SMALL))
        r.late_events().count()
        r.finalized_windows().count()
    scans = [p for p in plans if "events.parquet" in p]
    assert len(scans) == 2
    assert sum(p.count("Exchange hashpartitioning(_t#") for p in scans) == 1
    joined = next(p for p in scans if "late_reason" in p)
    # Spark knows the written table's size, so the events are not shuffled for the join
    assert "BroadcastHashJoin" in joined and "SortMergeJoin" not in joined


def test_counts_are_pre_aggregated_before_the_shuffle(spark):
    r = Replay(trip_events(spark, SF_SMALL))
    on_time = r.classified.filter("late_reason IS NULL")
    agg = on_time.groupBy("window_start_us", "pickup_zone").count()
    text = plan_text(agg)
    assert "partial_count" in text


def test_evolve_union_scans_the_events_once(spark):
    from lateflow.queries import SPARK

    with written_plans() as plans:
        plans.append(plan_text(SPARK["evolve_union"](spark, SF_SMALL)))
    assert sum(p.count("events.parquet") for p in plans) == 1
