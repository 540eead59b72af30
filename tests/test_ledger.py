"""Versioned tables against a model: random commits, replays, overwrites and restores, every
version read back and compared with a list of rows kept in Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lateflow.operators.repair import recount, row_difference, zone_change
from lateflow.operators.versions import busiest_day
from lateflow.schemas import COUNTS_TABLE, LATE_TABLE
from lateflow.sources.ledger import pipeline_tables

DAYS = [dt.date(2024, 2, 27) + dt.timedelta(days=i) for i in range(4)]  # over a leap day
SCHEMA = ("day DATE, quarter INT, zone STRING, trip_count BIGINT, avg_surge_multiplier DOUBLE, "
          "batch_id BIGINT")


def frame(spark, rows):
    start = F.expr("CAST(day AS TIMESTAMP) + make_dt_interval(0, 0, 15 * quarter)")
    return spark.createDataFrame(rows, SCHEMA).select(
        start.alias("window_start"), (start + F.expr("INTERVAL 15 MINUTES")).alias("window_end"),
        "zone", "trip_count", "avg_surge_multiplier",
        F.lit(None).cast("timestamp").alias("finalized_at_watermark"), "batch_id",
        F.col("day").alias("window_date"))


def shown(df):
    """Rows as the model keeps them; a column that a version lacks reads as absent."""
    surge = "avg_surge_multiplier" in df.columns
    return sorted(((r["window_date"], r["zone"], r["trip_count"],
                    r["avg_surge_multiplier"] if surge else None, r["batch_id"])
                   for r in df.collect()), key=str), surge


class Model:
    """Rows and columns of every version."""

    def __init__(self):
        self.versions = [([], False)]
        self.done = {}

    def push(self, rows, surge):
        self.versions.append((sorted(rows, key=str), surge))

    @property
    def now(self):
        return self.versions[-1]


def some_rows(rng, days, batch_id, surge):
    return [(rng.choice(days), rng.randint(0, 95), rng.choice("KLM"), rng.randint(1, 9),
             rng.choice([None, 1.5]) if surge else None, batch_id)
            for _ in range(rng.randint(1, 5))]


def flat(rows):
    return [(d, z, n, s, b) for d, _, z, n, s, b in rows]


@pytest.mark.parametrize("seed", [11, 12])
def test_every_version_equals_the_model(spark, tmpdir_path, seed):
    rng, model = random.Random(seed), Model()
    table = pipeline_tables(spark, tmpdir_path)[COUNTS_TABLE]
    assert table.ensure() and not table.ensure()
    kinds = ["append"] * 6 + ["replay"] * 2 + ["overwrite", "restore", "compact"]
    rng.shuffle(kinds)
    for step, kind in enumerate(["append", *kinds, "append"]):
        rows, surge = model.now
        if kind == "append":
            writer = rng.choice(["p", "q"])
            number = model.done.get(writer, -1) + rng.randint(1, 2)  # batches may commit nothing
            new = some_rows(rng, DAYS, number, step > 4)
            assert table.append(frame(spark, new), writer, number)
            model.done[writer] = number
            model.push(rows + flat(new), surge or any(r[4] is not None for r in new))
        elif kind == "replay" and model.done:
            writer, last = rng.choice(sorted(model.done.items()))
            again = frame(spark, some_rows(rng, DAYS, last, True))
            assert not table.append(again, writer, rng.randint(0, last))
        elif kind == "overwrite":
            day = rng.choice(DAYS)
            new = some_rows(rng, [day], -1, False)
            table.overwrite_partitions(frame(spark, new), [day.isoformat()])
            model.push([r for r in rows if r[0] != day] + flat(new), surge)
        elif kind == "restore":
            back = rng.randrange(len(model.versions))
            table.restore(back)
            model.push(*model.versions[back])
        elif kind == "compact":
            days = {r[0] for r in rows}
            assert table.compact()["numFilesAdded"] == len(days)
            model.push(rows, surge)
    table.refresh()
    assert table.version() == len(model.versions) - 1
    for version, want in enumerate(model.versions):
        assert shown(table.read(version)) == want, (version, table.commits()[version])
    stamps = [c["timestamp"] for c in table.commits()]
    assert stamps == sorted(set(stamps))
    for version, stamp in enumerate(stamps):
        assert table.version_as_of(stamp) == version
    assert {w: table.committed_version(w) for w in ("p", "q", "none")} == {
        w: model.done.get(w) for w in ("p", "q", "none")}
    widened = [c["version"] for c in table.schema_changes()]
    first = next((v for v, (_, s) in enumerate(model.versions) if s), None)
    assert widened[:1] == ([first] if first is not None else [])


def test_nothing_is_committed_by_an_empty_append(spark, tmpdir_path):
    for table in pipeline_tables(spark, tmpdir_path).values():
        table.ensure()
        assert not table.append(table.read(), "w", 0)
        assert table.version() == 0 and table.committed_version("w") is None
        with pytest.raises(LookupError):
            table.read(1)
        with pytest.raises(LookupError):
            table.version_as_of(table.commits()[0]["timestamp"] - 1)


def test_of_two_writers_at_one_version_the_second_fails_and_harms_nothing(spark, tmpdir_path):
    rng = random.Random(5)
    one, two = (pipeline_tables(spark, tmpdir_path)[COUNTS_TABLE] for _ in range(2))
    one.ensure()
    two.commits()
    first, second = some_rows(rng, DAYS, 0, False), some_rows(rng, DAYS, 0, False)
    assert one.append(frame(spark, first), "one", 0)
    with pytest.raises(FileExistsError):
        two.append(frame(spark, second), "two", 0)
    assert shown(one.refresh().read())[0] == sorted(flat(first), key=str)
    assert two.refresh().append(frame(spark, second), "two", 0)
    assert shown(one.refresh().read())[0] == sorted(flat(first + second), key=str)


@pytest.mark.parametrize("outside", [None, DAYS[3]])
def test_an_overwrite_takes_rows_of_its_partitions_only(spark, tmpdir_path, outside):
    table = pipeline_tables(spark, tmpdir_path)[COUNTS_TABLE]
    table.ensure()
    rows = frame(spark, [(DAYS[0], 3, "K", 2, None, 0)])
    table.append(rows, "w", 0)
    with pytest.raises(ValueError):
        table.overwrite_partitions(rows.withColumn("window_date", F.lit(outside).cast("date")),
                                   [DAYS[0].isoformat()])
    assert table.read().exceptAll(rows.drop("avg_surge_multiplier")).isEmpty()


# ------------------------------------------------------------------- repairs of a day
def late_trips(spark, rows):
    """(minute of the event, minute its window starts, window length, zone), from DAYS[0]."""
    at = "CAST(DATE'2024-02-27' AS TIMESTAMP) + make_dt_interval(0, 0, {})"
    df = spark.createDataFrame([(f"t{i}", *r) for i, r in enumerate(rows)],
                               "event_id STRING, m INT, s INT, w INT, pickup_zone STRING")
    return df.select("event_id", F.lit("trip_started").alias("event_type"),
                     F.expr(at.format("m")).alias("event_time"), "pickup_zone",
                     F.lit("beyond_watermark").alias("late_reason"),
                     F.expr(at.format("s")).alias("window_start"),
                     F.expr(at.format("s + w")).alias("window_end"),
                     F.to_date(F.expr(at.format("m"))).alias("event_date"))


def test_a_day_rebuilt_from_its_late_trips_is_seen_and_undone(spark, tmpdir_path):
    tables = pipeline_tables(spark, tmpdir_path)
    counts, late = tables[COUNTS_TABLE], tables[LATE_TABLE]
    for t in tables.values():
        t.ensure()
    published = [(d, q, z, 5, None, 0) for d in DAYS for q in (0, 1) for z in "KL"]
    counts.append(frame(spark, published), "w", 0)
    day = 24 * 60
    late.append(late_trips(spark, [(day + 3, day, 15, "K"), (day + 4, day, 15, "K"),
                                   (day + 20, day + 15, 15, "M"), (5, 0, 15, "L")]), "w", 0)
    busiest = busiest_day(late.read()).first()["day"]
    assert busiest == DAYS[1]
    good = counts.version()
    bad = counts.overwrite_partitions(recount(late.read(), busiest, F.current_timestamp()),
                                      [busiest.isoformat()])
    lost = {r["zone"]: r["lost"] for r in zone_change(counts.read(good), counts.read(bad)).collect()}
    assert lost == {"K": 8, "L": 10, "M": -1, "TOTAL": 17}
    assert tuple(row_difference(counts.read(bad), counts.read(good)).first()) == (2, 4)
    counts.restore(good)
    assert tuple(row_difference(counts.read(), counts.read(good)).first()) == (0, 0)


def test_a_window_belongs_to_the_day_it_starts(spark):
    rows = late_trips(spark, [(1435, 1410, 60, "K"), (1465, 1410, 60, "K"), (1475, 1470, 60, "K")])
    got = [(r["window_date"], r["trip_count"]) for r in
           recount(rows, DAYS[0], F.current_timestamp()).collect()]
    assert got == [(DAYS[0], 2)]


def test_the_total_is_a_row_of_its_own_beside_a_null_zone(spark):
    rows = spark.createDataFrame([("K", 4), (None, 1)], "zone STRING, trip_count BIGINT")
    got = {(r["zone"], r["before"], r["after"], r["lost"])
           for r in zone_change(rows.limit(0), rows).collect()}
    assert got == {("K", 0, 4, -4), (None, 0, 1, -1), ("TOTAL", 0, 5, -5)}
