"""Time arithmetic, lateness and the steps of the policy, against plain integers."""

import random

import pytest
from pyspark.sql import functions as F

from lateflow.functions.timecols import date_of_us, floor_div, floor_to, late_reason, policy_reason
from lateflow.schemas import STATE_SCHEMA, US_PER_DAY, LatenessPolicy
from lateflow.streaming.job import (StateStore, advance_watermark, classify_batch, closes,
                                    finalized_rows, merge_partials)

MINUTE = 60_000_000
INSTANTS = [0, 1, -1, MINUTE - 1, MINUTE, -MINUTE, US_PER_DAY - 1, US_PER_DAY, -US_PER_DAY,
            1_709_164_800_000_000, 1_709_251_199_999_999]  # the last two: a 29 February


@pytest.mark.parametrize("width", [1, MINUTE, 45 * MINUTE, US_PER_DAY])
def test_bounds_are_floors_on_both_sides_of_the_epoch(spark, width):
    rng = random.Random(width)
    values = INSTANTS + [rng.randint(-10**15, 10**15) for _ in range(50)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "us BIGINT")
    got = df.select("us", floor_to("us", width), floor_div("us", width),
                    F.datediff(date_of_us("us"), F.lit("1970-01-01").cast("date"))).collect()
    assert len(got) == len(values)  # a null is a row as well
    for us, start, number, day in got:
        assert (start, number, day) == ((None,) * 3 if us is None else (
            us // width * width, us // width, us // US_PER_DAY))


def test_reasons_of_all_combinations(spark):
    cells = [(et, end, mark, zone, kind) for et in (None, 5) for end in (9, 10, 11)
             for mark in (None, 10) for zone in (None, "K")
             for kind in ("trip_started", "trip_completed")]
    df = spark.createDataFrame(cells, "et BIGINT, end BIGINT, mark BIGINT, pickup_zone STRING, "
                                      "event_type STRING")
    got = df.select("*", late_reason("et", "end", "mark"),
                    policy_reason("et", "end", "mark", True)).collect()
    for et, end, mark, zone, kind, plain, routed in got:
        want = ("missing_event_time" if et is None else
                "beyond_watermark" if mark is not None and end <= mark else None)
        assert plain == want
        assert routed == (want or ("missing_zone" if zone is None and kind == "trip_started" else None))


@pytest.mark.parametrize("route", [True, False])
def test_a_batch_is_classified_by_the_policy(spark, route):
    df = spark.createDataFrame([(z, k) for z in ("K", None) for k in ("trip_started", "other")],
                               "pickup_zone STRING, event_type STRING").withColumn(
        "event_time", F.timestamp_micros(F.lit(3 * MINUTE)))
    got = classify_batch(df, None, LatenessPolicy(5, 1, route_missing_zone=route)).collect()
    assert {(r["window_start_us"], r["window_end_us"]) for r in got} == {(0, 5 * MINUTE)}
    assert sorted(r["late_reason"] or "" for r in got) == ["", "", "", "missing_zone" * route]


def test_the_watermark_is_the_running_maximum_less_the_lateness():
    rng, policy = random.Random(2), LatenessPolicy(7, 3)
    newest = mark = None
    seen = []
    for _ in range(200):
        batch = rng.choice([None, rng.randint(-500, 500) * MINUTE])
        seen += [batch] * (batch is not None)
        newest, mark = advance_watermark(newest, mark, batch, policy)
        assert (newest, mark) == ((max(seen), max(seen) - 3 * MINUTE) if seen else (None, None))


def test_partials_merge_and_close_at_the_window_end(spark):
    policy = LatenessPolicy(10, 0)
    rng = random.Random(3)
    rows = [(rng.choice([0, 10, 20]) * MINUTE, rng.choice(["K", "L"]), 1, s, int(s is not None))
            for s in (rng.choice([None, 1.0, 1.5, 2.25]) for _ in range(60))]
    state, partials = (spark.createDataFrame(part, STATE_SCHEMA) for part in (rows[:25], rows[25:]))
    merged = merge_partials(state, partials)
    for mark in (None, 10 * MINUTE - 1, 10 * MINUTE, 30 * MINUTE):
        done = [(F_us, z, n, a) for F_us, z, n, a in finalized_rows(merged, mark, 4, policy).select(
            F.unix_micros("window_start"), "zone", "trip_count", "avg_surge_multiplier").collect()]
        want = []
        for key in sorted({r[:2] for r in rows}):
            own = [r for r in rows if r[:2] == key]
            surges = [r[3] for r in own if r[3] is not None]
            if mark is not None and key[0] + 10 * MINUTE <= mark:
                want.append((*key, len(own), round(sum(surges) / len(surges), 4) if surges else None))
        assert sorted(done) == want
        assert merged.filter(~closes(mark, policy)).count() + len(done) == merged.count()


def test_a_snapshot_is_found_by_its_writer_and_batch_only(spark, tmpdir_path):
    none = spark.createDataFrame([], STATE_SCHEMA)
    stores = {w: StateStore(spark, tmpdir_path, w) for w in ("n", "s")}
    for batch_id in range(13):
        stores["n"].save(batch_id, {"watermark_us": batch_id}, none)
    assert stores["s"].before(0)[0]["watermark_us"] is None
    for batch_id in (1, 5):
        with pytest.raises(LookupError):
            stores["s"].before(batch_id)
    assert [stores["n"].before(b)[0]["watermark_us"] for b in (1, 4, 13)] == [0, 3, 12]
    stores["n"].forget(6)  # batch 7 starts from no older snapshot
    with pytest.raises(LookupError):
        stores["n"].before(7)
    assert stores["n"].before(6)[0]["watermark_us"] == 5
    stores["s"].save(0, {"watermark_us": 70}, none)
    assert stores["n"].newest()[0]["watermark_us"] == 12 and stores["n"].versions()[-1] == 12
