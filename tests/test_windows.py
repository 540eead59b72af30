"""The window stream on plain Parquet: replays, restarts, lost state, checks, bad lines."""

import json
import random
import shutil
from pathlib import Path

import pytest
from conftest import SF_SMALL
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lateflow.plans.replay import Replay
from lateflow.schemas import LatenessPolicy
from lateflow.sources.arrivals import trip_events
from lateflow.streaming import windows as W

MIN = 60_000_000
POLICY = LatenessPolicy(window_minutes=30, allowed_lateness_minutes=5)
FIELDS = ["event_id", "event_type", "pickup_zone", "surge_multiplier"]


def batch(spark, rows):
    """(minute or None, zone, type, surge) tuples as landed events."""
    data = [(f"e{i}", kind, zone, surge, None if minute is None else int(minute * MIN))
            for i, (minute, zone, kind, surge) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id STRING, event_type STRING, pickup_zone STRING, "
                                     "surge_multiplier DOUBLE, us BIGINT")
    names = [c.split()[0] for c in W.LANDED_SCHEMA.split(", ")]
    types = dict(c.split() for c in W.LANDED_SCHEMA.split(", "))
    have = {"event_time": F.timestamp_micros("us")} | {c: F.col(c) for c in FIELDS}
    return df.select(*[have.get(c, F.lit(None)).cast(types[c]).alias(c) for c in names])


def random_batches(seed, n=6):
    """Arrival batches whose event times wander forward, some of them far behind."""
    rng = random.Random(seed)
    out = []
    for b in range(n):
        rows = []
        for _ in range(rng.randint(0, 25)):
            minute = None if rng.random() < 0.05 else b * 20 + rng.randint(-70, 25)
            rows.append((minute, rng.choice(["A", "B", None]),
                         rng.choice(["trip_started"] * 3 + ["trip_completed"]),
                         rng.choice([None, 1.25, 2.0])))
        out.append(rows)
    return out


def plain(batches, policy):
    """The policy as a loop over rows: (published, open, late) of all batches."""
    w, lag = policy.window_us, policy.lateness_us
    newest = mark = None
    counts, published, late = {}, [], []
    for number, rows in enumerate(batches):
        times = []
        for minute, zone, kind, surge in rows:
            us = None if minute is None else int(minute * MIN)
            start = None if us is None else us // w * w
            times += [us] * (us is not None)
            if us is None:
                late.append((number, "missing_event_time"))
            elif mark is not None and start + w <= mark:
                late.append((number, "beyond_watermark"))
            elif zone is None and kind == "trip_started":
                late.append((number, "missing_zone"))
            elif kind == "trip_started":
                n, s, k = counts.get((start, zone), (0, 0.0, 0))
                counts[start, zone] = n + 1, s + (surge or 0.0), k + (surge is not None)
        newest = max(times + [newest] * (newest is not None), default=None)
        if newest is not None:
            mark = max(newest - lag, mark if mark is not None else newest - lag)
        for key in sorted(k for k in counts if mark is not None and k[0] + w <= mark):
            published.append((number, *key, *counts.pop(key), mark))
    return sorted(published), sorted((*k, v[0]) for k, v in counts.items()), sorted(late)


def found(sink, writer):
    mine = F.col("writer") == writer
    published = sorted((r["batch_id"], r["window_start_us"], r["zone"], r["trip_count"],
                        r["surge_sum"] or 0.0, r["surge_n"], r["watermark_us"])
                       for r in sink.windows().filter(mine).collect())
    open_ = sorted((r["window_start_us"], r["zone"], r["trip_count"])
                   for r in sink.open_after().filter(mine).collect())
    late = sorted((r["batch_id"], r["late_reason"])
                  for r in sink.read("late").filter(mine).collect())
    return published, open_, late


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_batches_run_twice_by_two_writers_equal_a_plain_loop(spark, tmpdir_path, seed):
    sink = W.Sink(spark, tmpdir_path + "/out")
    batches = random_batches(seed)
    for number, rows in enumerate(batches):
        events = batch(spark, rows)
        for writer in ("a", "b", "b", "a"):
            W.apply(sink, events, number, writer, POLICY)
    want = plain(batches, POLICY)
    assert found(sink, "a") == found(sink, "b") == want
    assert want[0] and want[2]


def test_a_rewind_of_several_batches_ends_in_the_same_tables(spark, tmpdir_path):
    batches = random_batches(4)
    sink = W.Sink(spark, tmpdir_path + "/out")
    for number in [0, 1, 2, 3, 1, 2, 3, 4, 5, 5]:
        # a new process knows nothing but the files
        W.apply(W.Sink(spark, sink.out), batch(spark, batches[number]), number, "w", POLICY)
    assert found(sink, "w") == plain(batches, POLICY)


def test_a_batch_without_its_predecessor_is_refused(spark, tmpdir_path):
    out = Path(tmpdir_path, "out")
    rows = [(1, "A", "trip_started", None)]
    for number in range(3):
        W.apply(W.Sink(spark, str(out)), batch(spark, rows), number, "w", POLICY)
    with pytest.raises(LookupError):
        W.apply(W.Sink(spark, str(out)), batch(spark, rows), 4, "w", POLICY)
    with pytest.raises(LookupError):
        W.apply(W.Sink(spark, str(out)), batch(spark, rows), 1, "other", POLICY)
    shutil.move(out / "progress/writer=w/batch_id=1", Path(tmpdir_path, "lost"))
    with pytest.raises(LookupError):  # batch 0 is there, but is not what batch 2 starts from
        W.apply(W.Sink(spark, str(out)), batch(spark, rows), 2, "w", POLICY)


def test_lost_open_windows_fail_the_batch(spark, tmpdir_path):
    out = Path(tmpdir_path, "out")
    for number in range(2):
        W.apply(W.Sink(spark, str(out)), batch(spark, [(1, "A", "trip_started", None)]), number,
                "w", POLICY)
    shutil.move(out / "counts/writer=w/batch_id=1/state=open", Path(tmpdir_path, "lost"))
    rows = batch(spark, [(50, "A", "trip_started", None)])
    # an empty folder is no open windows, which one trip before contradicts
    with pytest.raises(W.GuardError):
        W.apply(W.Sink(spark, str(out)), rows, 2, "w", POLICY)
    assert not (out / "progress/writer=w/batch_id=2").exists()


def test_a_watermark_that_went_back_fails_the_batch(spark, tmpdir_path):
    sink = W.Sink(spark, tmpdir_path + "/out")
    W.apply(sink, batch(spark, [(1, "A", "trip_started", None), (90, "A", "trip_started", None)]),
            0, "w", POLICY)
    progress, _ = sink.before("w", 1)
    late = batch(spark, [(2, "A", "trip_started", None)])
    W.apply(sink, late, 1, "w", POLICY)  # beyond the watermark: to the side output
    assert found(sink, "w")[2] == [(1, "beyond_watermark")]
    changed = {k: progress[k] for k in W.PROGRESS} | {"watermark_after_us": 10 * MIN}
    sink.commit("w", 0, changed)
    before = found(sink, "w")
    with pytest.raises(W.GuardError):
        W.apply(W.Sink(spark, sink.out), late, 1, "w", POLICY)
    assert found(sink, "w") == before  # nothing of the failed batch was written


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landed"))
    trips = trip_events(spark, SF_SMALL)
    return root, trips, W.land(trips, root + "/landing", 5760)


def test_an_interrupted_stream_resumes_with_the_same_batch(spark, landed):
    root, trips, slices = landed
    with pytest.raises(StreamingQueryException):
        W.stream(spark, root + "/landing", root + "/out", POLICY, interrupt_after=2)
    sink = W.Sink(spark, root + "/out")
    assert sink.read("progress").count() == 3 < slices
    W.stream(spark, root + "/landing", root + "/out", POLICY)
    assert sink.read("progress").select("writer").distinct().count() == 1
    replay = Replay(trips, POLICY, 5760)
    names = ["window_start_us", "zone", "trip_count", "surge_n", "batch_id", "watermark_us"]
    got, want = sink.windows().select(*names), replay.finalized_internal().select(*names)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert sink.read("late").count() == replay.late_rows.count()
    before = sink.read("progress").count()
    W.stream(spark, root + "/landing", root + "/out", POLICY)  # nothing new: nothing happens
    assert sink.read("progress").count() == before == slices


def test_landing_takes_an_unused_folder_only(landed):
    root, trips, _ = landed
    with pytest.raises(FileExistsError):
        W.land(trips, root + "/landing", 5760)


def test_a_hot_slice_lands_in_many_files_of_many_tasks_and_in_order(spark, tmpdir_path):
    from lateflow.stream_queries import landed_order

    trips = trip_events(spark, SF_SMALL)
    first = trips.agg(F.min("processing_time")).first()[0]
    # every event of the second half of the month arrives within one slice
    number = F.col("event_id").cast("long")
    hot = trips.withColumn("processing_time", F.when(
        number >= 500, F.lit(first) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), number / 1000))
        .otherwise(F.col("processing_time")))
    slices = W.land(hot, tmpdir_path + "/landing", 720, rows_per_file=40)
    sizes = {d.name: sorted(p.name for p in d.glob("part-*.json"))
             for d in Path(tmpdir_path, "landing/slices").iterdir() if d.is_dir()}
    assert len(sizes) == slices
    names = max(sizes.values(), key=len)
    assert len(names) >= 500 // 40
    assert len({n.split("-")[1] for n in names}) > 1  # number of the task
    checked = landed_order(spark, tmpdir_path + "/landing")
    assert checked.count() == 1000 and checked.filter("not in_order").isEmpty()


def test_bad_lines_are_kept_as_they_are(spark, tmpdir_path):
    lines = ['{"event_id":"cut', "", "[1,2", "plain text", '{"event_id":"t","schema_version":"x"}',
             '{"event_id":"a","event_type":"trip_started","event_time":"not a time"}',
             json.dumps({"event_id": "ok", "event_type": "trip_started", "pickup_zone": "A",
                         "event_time": "1970-01-01T00:01:00.000000Z", "unknown": [1]}),
             json.dumps({"event_id": "no time", "event_type": "trip_started"})]
    path = Path(tmpdir_path, "lines.json")
    path.write_text("\n".join(lines) + "\n")
    sink = W.Sink(spark, tmpdir_path + "/out")
    progress = W.apply(sink, W.read_lines(spark, str(path)), 0, "w", POLICY)
    late = sorted((r["late_reason"], r["raw_line"] or "", r["event_id"] or "")
                  for r in sink.read("late").collect())
    bad = [(x, "t" if '"t"' in x else "a" if '"a"' in x else "")
           for x in lines[:6] if x]  # what did parse of a line stays beside its text
    assert late == sorted([("malformed_line", x, i) for x, i in bad]
                          + [("missing_event_time", "", "no time")])
    assert progress["n_events"] == 7 and progress["open_trips"] == 1


def test_writer_names_are_folder_names(spark, tmpdir_path):
    with pytest.raises(ValueError):
        W.apply(W.Sink(spark, tmpdir_path), batch(spark, []), 0, "a/../b", POLICY)
