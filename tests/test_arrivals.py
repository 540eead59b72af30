"""The arrival adapter: its facts in one aggregate, and the order checks against a window."""

import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from lateflow.functions.timecols import epoch_us
from lateflow.operators import quality as Q
from lateflow.sources.arrivals import SCHEMA_V2_FROM_US, strip_annotations, trip_events

# fixed values: counts of the adapter over the given tables
FACTS = {
    SF_MID: {"rows": 10000, "trips": 5000, "on_time": 7611, "out_of_order": 859, "late": 1386,
             "very_late": 144},
    SF_SMALL: {"rows": 1000, "trips": 500},
}


@pytest.mark.parametrize("sf", list(FACTS))
def test_facts_of_the_adapter(spark, sf):
    t = trip_events(spark, sf)
    new = epoch_us("event_time") >= SCHEMA_V2_FROM_US
    start = F.col("event_type") == "trip_started"
    impossible = {
        "arrived before it happened": F.col("processing_time") < F.col("event_time"),
        "surge before the change": ~new & F.col("surge_multiplier").isNotNull(),
        "no surge after it": new & start & F.col("surge_multiplier").isNull(),
        "version and surge disagree": (F.col("schema_version") == 2) != F.col(
            "surge_multiplier").isNotNull(),
        "fare of a start": start & F.col("fare_usd").isNotNull(),
        "no fare at the end": ~start & F.col("fare_usd").isNull(),
    }
    got = t.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("trip_id").alias("trips"),
                *[F.count_if(F.col("_delay_class") == c).alias(c)
                  for c in ("on_time", "out_of_order", "late", "very_late")],
                *[F.count_if(cond).alias(name) for name, cond in impossible.items()]).first()
    assert {k: got[k] for k in FACTS[sf]} == FACTS[sf]
    assert {k: got[k] for k in impossible} == dict.fromkeys(impossible, 0)
    two_versions = t.groupBy("trip_id").agg(F.countDistinct("schema_version").alias("v"))
    assert two_versions.filter("v <> 1").isEmpty()


def test_reports_over_the_adapter(spark):
    t = trip_events(spark, SF_MID).cache()
    assert Q.trip_pairs(t).first().asDict() == {
        "trips": 5000, "complete_pairs": 5000, "incomplete": 0}
    share = {r["is_tunnel"]: r["late_rate"] for r in Q.late_rate_tunnel(t).collect()}
    assert share[True] > 5 * share[False]
    assert Q.out_of_order(t).filter("out_of_order").count() == 1321  # fixed value
    t.unpersist()


def test_two_derivations_agree_and_a_feed_has_no_annotations(spark):
    one, two = (strip_annotations(trip_events(spark, SF_SMALL)) for _ in range(2))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert one.columns == [c for c in trip_events(spark, SF_SMALL).columns if c[0] != "_"]


@pytest.mark.parametrize("cell_rows", [1, 7, 100_000])
def test_running_maximum_equals_one_window(spark, cell_rows):
    # dense slices, gaps, equal keys, null keys and null values
    rows = spark.range(700).select(
        F.when(F.col("id") % 31 > 0, F.pmod(F.col("id") * 7919, F.lit(1009)) * F.when(
            F.col("id") % 3 == 0, 1).otherwise(40) + F.col("id") % 2).alias("k"),
        F.col("id").cast("string").alias("tie"),
        F.when(F.col("id") % 5 > 0, F.pmod(F.col("id") * 104729, F.lit(997))).alias("v"))
    w = Window.orderBy("k", "tie").rowsBetween(Window.unboundedPreceding, -1)
    want = rows.select("*", F.max("v").over(w).alias("prev_max_us"))
    got = Q.running_max(rows, "k", "tie", "v", 1000, cell_rows).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_the_order_scan_writes_no_events(spark):
    from tools.plan_census import written_plans

    with written_plans() as plans:
        Q.out_of_order(trip_events(spark, SF_SMALL)).collect()
    assert plans and not [p for p in plans if "event_id" in p.split("\n")[1]]
    assert all("HashAggregate" in p for p in plans)  # tables of slices and cells only
