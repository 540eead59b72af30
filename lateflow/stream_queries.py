"""Registered queries that write and read files: the window stream run by Spark's streaming
engine, landing, malformed lines, evolving tables and overwritten partitions.

All take the whole events table. Files go to the shared checkpoint folder. The streams take
arrival slices of half a day and more, so that the number of micro-batches depends on the
time span of the events and not on their number.
"""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateflow import oracle as O
from lateflow.functions.timecols import date_of_us, epoch_us
from lateflow.operators import quality as Q
from lateflow.operators.repair import recount
from lateflow.operators.versions import busiest_day
from lateflow.plans.replay import Replay
from lateflow.plans.scan import materialize, prefix_scan
from lateflow.queries import (LEDGER_SQL, SQL, _files, for_oracle, register, replay_for, trips_for)
from lateflow.schemas import DEFAULT_POLICY, EVENT_NAMES, EVENT_SCHEMA, US_PER_MINUTE
from lateflow.session import ensure_checkpoint_dir
from lateflow.sources import evolving
from lateflow.sources.arrivals import strip_annotations
from lateflow.streaming import windows as W

#: minutes of an arrival slice: one stream, a stream that is interrupted, two writers
STREAM_SLICE, RESTART_SLICE, WRITERS_SLICE = 720, 1440, 2880
INTERRUPT_AFTER = 7
_STREAMS: dict[tuple, W.Sink] = {}
#: queries that run micro-batches before they return a plain read of what these wrote
STREAMED = ("stream_windows", "stream_late_rows", "stream_open_windows", "stream_progress",
            "stream_restarted", "replayed_writers")


def folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _landed(spark, sf_dir, slice_minutes: int) -> str:
    root = folder(spark, "stream")
    W.land(trips_for(spark, sf_dir), f"{root}/landing", slice_minutes)
    return root


def stream_for(spark, sf_dir) -> W.Sink:
    """The tables of one uninterrupted stream over the events, shared by its queries."""
    key = (spark.sparkContext.applicationId, _files(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    if key not in _STREAMS:
        _STREAMS.clear()
        root = _landed(spark, sf_dir, STREAM_SLICE)
        _STREAMS[key] = W.stream(spark, f"{root}/landing", f"{root}/out")
    return _STREAMS[key]


def _published(sink: W.Sink) -> DataFrame:
    return sink.windows().select(
        "window_start_us", "window_end_us", "zone", "trip_count", "surge_sum", "surge_n",
        F.when(F.col("surge_n") > 0, F.col("surge_sum") / F.col("surge_n")).alias("avg_surge"),
        F.col("watermark_us").alias("finalized_at_watermark_us"), "batch_id",
        F.date_format(date_of_us("window_start_us"), "yyyy-MM-dd").alias("window_date"))


PUBLISHED_SQL = """
SELECT window_start_us, window_end_us, zone, trip_count, surge_sum, surge_n,
       CASE WHEN surge_n > 0 THEN surge_sum / surge_n END AS avg_surge,
       watermark_us AS finalized_at_watermark_us, batch_id,
       CAST(window_date AS VARCHAR) AS window_date
FROM fin"""
LATE_SQL = """
SELECT event_id, event_type, schema_version, et_us AS event_time_us,
       pt_us AS processing_time_us, trip_id, driver_id, pickup_zone, dropoff_zone,
       distance_km, fare_usd, surge_multiplier, _delay_class, _delay_seconds,
       late_reason, window_start_us, window_end_us, watermark_before_us AS watermark_us,
       batch_id, CAST(event_date AS VARCHAR) AS event_date
FROM late"""


# ------------------------------------------------------------------ the stream itself
@register("stream_windows", O.with_replay(PUBLISHED_SQL, slice_minutes=STREAM_SLICE))
def q_stream_windows(spark, sf_dir):
    """What the streaming query published: file source, foreachBatch, availableNow."""
    return _published(stream_for(spark, sf_dir))


@register("stream_late_rows", O.with_replay(LATE_SQL, slice_minutes=STREAM_SLICE))
def q_stream_late_rows(spark, sf_dir):
    return for_oracle(stream_for(spark, sf_dir).read("late").drop("writer", W.RAW))


@register("stream_open_windows", O.with_replay("""
SELECT window_start_us, window_end_us, zone, trip_count, surge_sum, surge_n
FROM windows WHERE batch_id IS NULL""", slice_minutes=STREAM_SLICE))
def q_stream_open_windows(spark, sf_dir):
    return stream_for(spark, sf_dir).open_after().drop("writer", "batch_id")


BATCH_BALANCE_SQL = """
per_batch AS (
  SELECT batch_id, count(*) FILTER (WHERE event_type = 'trip_started') AS landed,
         count(*) FILTER (WHERE event_type = 'trip_started' AND late_reason IS NOT NULL) AS late,
         count(*) FILTER (WHERE late_reason IS NOT NULL) AS late_events
  FROM classified GROUP BY batch_id
),
closed AS (SELECT batch_id, sum(trip_count) AS finalized FROM fin GROUP BY batch_id),
balance AS (
  SELECT b.batch_id, CAST(sum(p.landed) OVER w AS BIGINT) AS landed,
         CAST(sum(COALESCE(c.finalized, 0)) OVER w AS BIGINT) AS finalized,
         CAST(sum(p.late) OVER w AS BIGINT) AS late
  FROM batches b JOIN per_batch p USING (batch_id) LEFT JOIN closed c USING (batch_id)
  WINDOW w AS (ORDER BY b.batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


@register("stream_progress", "WITH " + O.replay_ctes(slice_minutes=STREAM_SLICE) + ",\n"
          + BATCH_BALANCE_SQL + """
SELECT b.batch_id, b.n_events, b.n_trips, p.late_events, p.late AS late_trips,
       CAST(0 AS BIGINT) AS violations,
       CAST(COALESCE(c.finalized, 0) AS BIGINT) AS finalized_trips,
       a.landed - a.finalized - a.late AS open_trips,
       b.watermark_before_us, b.watermark_after_us
FROM batches b JOIN per_batch p USING (batch_id) JOIN balance a USING (batch_id)
LEFT JOIN closed c USING (batch_id)""")
def q_stream_progress(spark, sf_dir):
    """One row a micro-batch, as the stream observed it; ``violations`` is its guard."""
    return stream_for(spark, sf_dir).read("progress").select(
        "batch_id", "n_events", "n_trips", "late_events", "late_trips", "violations",
        "finalized_trips", "open_trips", "watermark_before_us", "watermark_after_us")


@register("stream_restarted", O.with_replay(PUBLISHED_SQL, slice_minutes=RESTART_SLICE))
def q_stream_restarted(spark, sf_dir):
    """A query that dies with a batch applied but not recorded, and a second one that
    resumes from its checkpoint, runs that batch again and goes on."""
    root = _landed(spark, sf_dir, RESTART_SLICE)
    try:
        W.stream(spark, f"{root}/landing", f"{root}/out", interrupt_after=INTERRUPT_AFTER)
    except StreamingQueryException as exc:
        if "Interrupted" not in str(exc):
            raise
    return _published(W.stream(spark, f"{root}/landing", f"{root}/out"))


@register("replayed_writers", O.with_replay("""
SELECT writer, window_start_us, zone, trip_count, surge_sum, surge_n, batch_id
FROM fin, (VALUES ('north'), ('south')) AS w(writer)
UNION ALL
SELECT writer || ' late', window_start_us, pickup_zone, count(*), sum(surge_multiplier),
       count(surge_multiplier), batch_id
FROM late, (VALUES ('north'), ('south')) AS w(writer)
GROUP BY writer, window_start_us, pickup_zone, batch_id""", slice_minutes=WRITERS_SLICE))
def q_replayed_writers(spark, sf_dir):
    """Two writers share the tables, and every batch of both runs twice."""
    root = _landed(spark, sf_dir, WRITERS_SLICE)
    slices = [r["slice_id"] for r in spark.read.schema("number BIGINT, slice_id BIGINT").json(
        f"{root}/landing/ready").orderBy("number").collect()]  # one line a slice
    sink = W.Sink(spark, f"{root}/out")
    for batch_id, slice_id in enumerate(slices):
        events = W.read_slice(spark, f"{root}/landing", slice_id)
        for writer in ("north", "south", "south", "north"):
            W.apply(sink, events, batch_id, writer)
    late = sink.read("late").groupBy(
        F.concat("writer", F.lit(" late")).alias("writer"), "window_start_us",
        F.col("pickup_zone").alias("zone"), "batch_id").agg(
        F.count(F.lit(1)).alias("trip_count"), F.sum("surge_multiplier").alias("surge_sum"),
        F.count("surge_multiplier").alias("surge_n"))
    names = ["writer", "window_start_us", "zone", "trip_count", "surge_sum", "surge_n", "batch_id"]
    return sink.windows().select(*names).unionByName(late.select(*names))


@register("batch_balance", O.with_replay_more(BATCH_BALANCE_SQL, """
SELECT batch_id, landed, finalized, landed - finalized - late AS open, late,
       true AS balanced FROM balance"""))
def q_batch_balance(spark, sf_dir):
    """After every batch of the replay: trips finalized, open and late add up to those that
    landed. Open trips come from the on-time rows, landed ones from the slices."""
    return batch_balance(replay_for(spark, sf_dir))


def batch_balance(replay: Replay) -> DataFrame:
    trip = F.col("event_type") == F.lit(replay.counted_type)
    late = F.col("late_reason").isNotNull()
    zero = F.lit(0).cast("long")
    parts = [
        replay.batches.select("batch_id", F.col("n_trips").alias("landed"), zero.alias("on_time"),
                              zero.alias("late"), zero.alias("finalized")),
        replay.classified.groupBy("batch_id").agg(
            F.count_if(trip & ~late).alias("on_time"), F.count_if(trip & late).alias("late")
        ).select("batch_id", zero.alias("landed"), "on_time", "late", zero.alias("finalized")),
        replay.finalized_internal().groupBy("batch_id").agg(
            F.sum("trip_count").alias("finalized")).select(
            "batch_id", zero.alias("landed"), zero.alias("on_time"), zero.alias("late"),
            "finalized")]
    names = ("landed", "on_time", "late", "finalized")
    per_batch = materialize(parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy(
        "batch_id").agg(*[F.sum(n).cast("long").alias(n) for n in names]))
    sums = prefix_scan(per_batch, "batch_id", "landed", 4096, names)
    open_ = F.col("upto_on_time") - F.col("upto_finalized")
    return sums.select(
        "batch_id", F.col("upto_landed").alias("landed"),
        F.col("upto_finalized").alias("finalized"), open_.alias("open"),
        F.col("upto_late").alias("late"),
        ((F.col("upto_finalized") + open_ + F.col("upto_late") == F.col("upto_landed"))
         & (open_ >= 0)).alias("balanced"))


# ------------------------------------------------------------------ landing and lines
@register("landing_read_back", O.with_trips(f"""
SELECT event_id, pt_us, pt_us // {STREAM_SLICE * US_PER_MINUTE} AS slice_id, true AS in_order
FROM trips"""))
def q_landing_read_back(spark, sf_dir):
    """The landed files, read back: each event's slice, and whether it stands after all that
    arrived before it, by file name and place in the file."""
    root = _landed(spark, sf_dir, STREAM_SLICE)
    return landed_order(spark, f"{root}/landing")


def landed_order(spark, landing: str) -> DataFrame:
    # files stand in the order of the task and the file number in their names, slice by
    # slice, and the rows of a file block are read in order
    task, number = (F.regexp_extract("_metadata.file_name", x, 1).cast("long")
                    for x in (r"^part-(\d+)-", r"\.c(\d+)\."))
    rows = spark.read.schema(EVENT_SCHEMA).option("basePath", f"{landing}/slices").option(
        "timestampFormat", W.LANDING_TS_FORMAT).json(f"{landing}/slices").select(
        "event_id", epoch_us("processing_time").alias("pt_us"),
        F.regexp_extract("_metadata.file_path", r"slice_id=(-?\d+)", 1).cast("long").alias("slice_id"),
        F.struct(task.alias("task"), number.alias("number"),
                 F.col("_metadata.file_block_start").alias("start")).alias("block"),
        F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows)
    files = materialize(rows.groupBy("slice_id", "block").agg(
        F.min("row").alias("first"), F.count(F.lit(1)).alias("n")))
    starts = files.select("slice_id", "block", "first", F.sum("n").over(
        Q.Window.orderBy("slice_id", "block").rowsBetween(
            Q.Window.unboundedPreceding, -1)).alias("before"))  # one row for each file block
    at = rows.join(starts, ["slice_id", "block"]).withColumn(
        "at", F.coalesce("before", F.lit(0)) + F.col("row") - F.col("first"))
    checked = Q.arrival_order_check(at, "at", "event_id", "pt_us", 1 << 16)
    return checked.select("event_id", "pt_us", "slice_id", "in_order")


#: planted lines: every so many-th event gives one of each kind
PLANT_EVERY = 50
_PLANTED = [  # (text before the event's number, text after it, event_id survives)
    ('{"event_id":"', '","event_type":', False),
    ("event ", " was lost", False),
    ('{"event_id":"', '","schema_version":"two"}', True),
]


def _planted_sql() -> str:
    nulls = ", ".join(f"NULL AS {c}" for c in (
        "event_type", "schema_version", "event_time_us", "processing_time_us", "trip_id",
        "pickup_zone", "fare_usd", "surge_multiplier"))
    return "\nUNION ALL\n".join(
        f"SELECT {'event_id' if survives else 'NULL'} AS event_id, {nulls}, "
        f"'{a}' || event_id || '{b}' AS raw_line, 'malformed_line' AS late_reason "
        f"FROM trips WHERE CAST(event_id AS BIGINT) % {PLANT_EVERY} = 0" for a, b, survives in _PLANTED)


@register("json_round_trip", O.with_trips("""
SELECT event_id, event_type, schema_version, et_us AS event_time_us,
       pt_us AS processing_time_us, trip_id, pickup_zone, fare_usd, surge_multiplier,
       NULL AS raw_line, CASE WHEN et_us IS NULL THEN 'missing_event_time' END AS late_reason
FROM trips
UNION ALL
""" + _planted_sql()))
def q_json_round_trip(spark, sf_dir):
    """All events as JSON lines with broken lines among them, read back: none is lost, and a
    line that does not parse is kept as it was."""
    trips = trips_for(spark, sf_dir)
    number = F.col("event_id").cast("long")
    good = trips.select(F.to_json(F.struct(*EVENT_NAMES), {
        "timestampFormat": W.LANDING_TS_FORMAT}).alias("value"))
    some = trips.filter(number % PLANT_EVERY == 0)
    lines = good
    for a, b, _ in _PLANTED:
        lines = lines.unionByName(some.select(F.concat(F.lit(a), "event_id", F.lit(b)).alias("value")))
    path = folder(spark, "lines")
    lines.write.text(path)
    rows = W.classify(W.read_lines(spark, path), None, DEFAULT_POLICY)
    return for_oracle(rows.select(
        "event_id", "event_type", "schema_version", "event_time", "processing_time", "trip_id",
        "pickup_zone", "fare_usd", "surge_multiplier", W.RAW, "late_reason"))


# ----------------------------------------------------- tables whose files tell their state
def _evolved(spark, sf_dir) -> str:
    path = folder(spark, "evolving")
    rows = replay_for(spark, sf_dir).finalized_internal().select(
        "window_start_us", "zone", "trip_count",
        F.when(F.col("surge_n") > 0, F.col("surge_sum") / F.col("surge_n")).alias("avg_surge"),
        date_of_us("window_start_us").alias("window_date"))
    evolving.write_evolving(materialize(rows), path, "window_date", "avg_surge")
    return path


@register("evolved_rows", O.with_replay("""
SELECT window_start_us, zone, trip_count,
       CASE WHEN surge_n > 0 THEN surge_sum / surge_n END AS avg_surge,
       CAST(window_date AS VARCHAR) AS window_date FROM fin"""))
def q_evolved_rows(spark, sf_dir):
    """Files with and without the newer column, merged by their schemas."""
    return for_oracle(evolving.read_merged(spark, _evolved(spark, sf_dir)))


@register("columns_from_files", O.with_replay("""
SELECT CAST(d.upto AS VARCHAR) AS upto, c.column_name
FROM (SELECT DISTINCT unnest([
        (SELECT min(window_date) FROM fin), (SELECT max(window_date) FROM fin),
        (SELECT min(window_date) FROM fin WHERE surge_n > 0),
        (SELECT max(window_date) FROM fin WHERE window_date <
          (SELECT min(window_date) FROM fin WHERE surge_n > 0))]) AS upto) d,
     (VALUES ('window_start_us'), ('zone'), ('trip_count'), ('avg_surge'), ('window_date'))
       AS c(column_name)
WHERE d.upto IS NOT NULL AND (c.column_name <> 'avg_surge'
  OR d.upto >= (SELECT min(window_date) FROM fin WHERE surge_n > 0))"""))
def q_columns_from_files(spark, sf_dir):
    """The columns of the table up to its first and last day, the day that brings the newer
    column, and the day before: what Spark merges from the files of those days."""
    path = _evolved(spark, sf_dir)
    whole = evolving.read_merged(spark, path)
    day = F.col("window_date")
    ends = whole.agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    probes = {ends["a"], ends["b"]}
    if "avg_surge" in whole.columns:
        first = whole.filter("avg_surge is not null").agg(F.min(day)).first()[0]
        probes |= {first, whole.filter(day < F.lit(first)).agg(F.max(day)).first()[0]}
    rows = [(d.isoformat(), c) for d in sorted(p for p in probes if p is not None)
            for c in evolving.read_merged(spark, path, d, "window_date").columns]
    return spark.createDataFrame(rows, "upto STRING, column_name STRING")


@register("overwritten_partitions", O.with_replay_more(LEDGER_SQL, """
SELECT 'windows' AS table_name, CAST(window_date AS VARCHAR) AS partition,
       sum(b)::BIGINT AS rows_before, sum(a)::BIGINT AS rows_after,
       window_date NOT IN (SELECT day FROM busiest) AS untouched
FROM (SELECT window_date, 1 AS b, 0 AS a FROM published
      UNION ALL SELECT window_date, 0, 1 FROM published
        WHERE window_date NOT IN (SELECT day FROM busiest)
      UNION ALL SELECT window_date, 0, 1 FROM correction) w GROUP BY window_date
UNION ALL
SELECT 'late', CAST(event_date AS VARCHAR), count(*),
       count(*) FILTER (WHERE event_date IS NOT NULL OR event_type = 'trip_started'),
       event_date IS NOT NULL
FROM late GROUP BY event_date"""))
def q_overwritten_partitions(spark, sf_dir):
    """Two written tables with one partition each replaced by Spark: the busiest late day of
    the windows by its late trips alone, the null date of the late rows by its trips. The
    other partitions are compared by a hash of their rows."""
    replay = replay_for(spark, sf_dir)
    counts, late = replay.finalized_windows(), replay.late_events()
    found = []
    day = busiest_day(late).first()
    wrong = recount(late, day["day"], F.current_timestamp()) if day else counts.limit(0)
    no_day = F.col("event_date").isNull() & (F.col("event_type") == "trip_started")
    for name, rows, partition, fix in (
            ("windows", counts, "window_date", wrong.select(*counts.columns)),
            ("late", strip_annotations(late), "event_date", strip_annotations(late.filter(no_day)))):
        path = folder(spark, "overwritten")
        rows.write.partitionBy(partition).parquet(path)
        before = materialize(evolving.read_merged(spark, path))
        evolving.overwrite_partitions(fix, path, partition)
        after = evolving.read_merged(spark, path)
        found.append(evolving.changed_partitions(before, after, partition).select(
            F.lit(name).alias("table_name"), F.col("partition").cast("string").alias("partition"),
            "rows_before", "rows_after", "untouched"))
    return found[0].unionByName(found[1])


__all__ = ["SQL", "batch_balance", "landed_order", "stream_for"]
