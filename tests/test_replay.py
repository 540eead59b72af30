"""Batch replay: fixed values of the given tables, and a plain loop on random events."""

import random

import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from lateflow.plans.replay import Replay
from lateflow.schemas import LatenessPolicy
from lateflow.sources.arrivals import trip_events
from lateflow.stream_queries import batch_balance

# fixed values: sf, window, batches, finalized rows, finalized trips, open trips, late trips,
# late rows beyond watermark, missing-time rows, landed trips, first surge batch, last wm
ANCHORS = [
    (SF_SMALL, 15, 838, 492, 492, 0, 8, 15, 2, 500, 97, 1706656576220708),
    (SF_SMALL, 60, 838, 481, 492, 0, 8, 15, 2, 500, 98, 1706656576220708),
    (SF_MID, 15, 2792, 4576, 4926, 1, 73, 144, 11, 5000, 281, 1706658432194062),
    (SF_MID, 60, 2792, 3556, 4920, 7, 73, 144, 11, 5000, 283, 1706658432194062),
]


@pytest.mark.parametrize("sf,window,batches,fin_rows,fin_trips,open_trips,late_trips,"
                         "beyond,missing,landed,first_surge,last_wm", ANCHORS)
def test_golden_anchors(spark, sf, window, batches, fin_rows, fin_trips, open_trips,
                        late_trips, beyond, missing, landed, first_surge, last_wm):
    r = Replay(trip_events(spark, sf), LatenessPolicy(window, 10), 15)
    rec = r.reconcile().first()
    assert rec["micro_batches"] == batches
    assert rec["finalized_trips"] == fin_trips and rec["open_trips"] == open_trips
    assert rec["late_trips"] == late_trips and rec["landed_trips"] == landed
    assert rec["last_watermark_us"] == last_wm and rec["reconciles"]
    assert r.finalized_internal().count() == fin_rows
    reasons = {x[0]: x[1] for x in r.late_rows.groupBy("late_reason").count().collect()}
    assert reasons == {"beyond_watermark": beyond, "missing_event_time": missing}
    fs = r.finalized_internal().filter("surge_n > 0").agg(F.min("batch_id")).first()[0]
    assert fs == first_surge


def test_no_row_of_the_products_contradicts_the_policy(spark):
    r = Replay(trip_events(spark, SF_MID))
    fin, late, steps = r.finalized_windows(), r.late_events(), r.batches
    end, mark = F.col("window_end"), F.col("watermark")
    assert fin.groupBy("window_start", "zone").count().filter("count > 1").isEmpty()
    assert fin.filter(end > F.col("finalized_at_watermark")).isEmpty()
    assert late.filter((F.col("late_reason") == "beyond_watermark") & (
        (end > mark) | (F.col("_delay_class") == "on_time"))).isEmpty()
    has = F.col("avg_surge_multiplier").isNotNull()
    assert fin.filter(has != (F.col("window_date") >= F.lit("2024-01-04").cast("date"))).isEmpty()
    assert steps.filter("watermark_after_us < watermark_before_us").isEmpty()
    assert steps.agg(F.max("batch_id") - F.min("batch_id") + 1 == F.count_distinct(
        "batch_id")).first()[0]
    assert r.classified.filter("late_reason IS NULL AND window_end_us <= watermark_before_us").isEmpty()


@pytest.mark.parametrize("seed, route", [(1, True), (2, False)])
def test_random_events_equal_a_plain_loop(spark, seed, route):
    rng, minute = random.Random(seed), 60_000_000
    policy = LatenessPolicy(20, 4, route_missing_zone=route)
    rows = []
    for i in range(120):
        pt = rng.randint(0, 600) * minute + i
        et = None if rng.random() < 0.05 else pt - rng.choice([1, 3, 30, 90]) * minute
        rows.append((f"{i:03}", rng.choice(["trip_started", "trip_completed"]),
                     rng.choice(["K", "L", None]), rng.choice([None, 1.0, 2.5]), et, pt))
    df = spark.createDataFrame(rows, "event_id STRING, event_type STRING, pickup_zone STRING, "
                                     "surge_multiplier DOUBLE, et BIGINT, pt BIGINT").select(
        "*", F.timestamp_micros("et").alias("event_time"),
        F.timestamp_micros("pt").alias("processing_time")).drop("et", "pt")
    r = Replay(df, policy, 30)
    newest = None
    late, counts, published, balance = set(), {}, {}, []
    slices = sorted({x[5] // (30 * minute) for x in rows})
    landed = 0
    for number, s in enumerate(slices):
        own = [x for x in rows if x[5] // (30 * minute) == s]
        mark = None if newest is None else newest - 4 * minute
        for i, kind, zone, surge, et, _ in own:
            start = None if et is None else et // (20 * minute) * 20 * minute
            landed += kind == "trip_started"
            if et is None or (mark is not None and start + 20 * minute <= mark) or (
                    route and zone is None and kind == "trip_started"):
                late.add((i, number))
            elif kind == "trip_started":
                counts[start, zone] = counts.get((start, zone), 0) + 1
        newest = max([x[4] for x in own if x[4] is not None] + [newest] * (newest is not None),
                     default=None)
        for key in [k for k in counts if newest is not None
                    and k[0] + 20 * minute <= newest - 4 * minute]:
            published[key] = (counts.pop(key), number)
        balance.append((number, landed, sum(n for n, _ in published.values()),
                        sum(counts.values())))
    assert {(x["event_id"], x["batch_id"]) for x in r.late_rows.collect()} == late
    assert {(x["window_start_us"], x["zone"]): (x["trip_count"], x["batch_id"])
            for x in r.finalized_internal().collect() if x["zone"] is not None} == {
        k: v for k, v in published.items() if k[1] is not None}
    assert {(x["window_start_us"], x["zone"]): x["trip_count"]
            for x in r.open_internal().collect()} == counts
    got = batch_balance(r).orderBy("batch_id").collect()
    assert [(x["batch_id"], x["landed"], x["finalized"], x["open"]) for x in got] == balance
    assert all(x["balanced"] for x in got) and r.reconcile().first()["reconciles"]
