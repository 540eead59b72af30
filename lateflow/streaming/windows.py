"""The window stream on plain partitioned Parquet: no commit log, no state store.

    landing/slices/slice_id=S/*.json   events of one arrival slice, in files of bounded size
    landing/ready/*.json               one line for each slice, in arrival order
        --file source, one line per trigger-->  foreachBatch(apply)
    out/counts/writer=/batch_id=/state=published|open
    out/late/writer=/batch_id=         side output
    out/progress/writer=/batch_id=     one row a batch, written last

A slice is the unit of a micro-batch, however many files and tasks it takes. Every table is
written with dynamic partition overwrite: a batch that runs again, after a crash at any
point, rewrites its own partitions and nothing else, so the sink needs no record of what was
committed. ``counts`` has the windows a batch published and those still open after it, from
one aggregate and one write; ``progress`` its watermark, its counts and what the checks
observed. Batch N starts from these partitions of batch N - 1 and from no older ones; if
they are missing it is refused.

Two checks fail a batch before its ``progress`` is written: an on-time row of a window that
was already published (a watermark that went back), and trips that do not add up (open before
+ on time = published + open after), which a lost or changed ``open`` partition does.

Lines that are no JSON of the schema go to the side output with their text in ``raw_line``.

The cost of a small batch is that of building its plans, so expressions are SQL text: a few
calls into the JVM for each batch instead of several hundred.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lateflow.functions.timecols import epoch_us, floor_div
from lateflow.schemas import (DEFAULT_POLICY, EVENT_NAMES, EVENT_SCHEMA, US_PER_DAY,
                              US_PER_MINUTE, LatenessPolicy)
from lateflow.sources.fs import HadoopFS
from lateflow.streaming.job import LANDING_TS_FORMAT

RAW = "raw_line"
LANDED_SCHEMA = f"{EVENT_SCHEMA}, {RAW} STRING"
KEYS = "writer STRING, batch_id BIGINT"
SCHEMAS = {
    "counts": "window_start_us BIGINT, zone STRING, trip_count BIGINT, surge_sum DOUBLE, "
              f"surge_n BIGINT, window_end_us BIGINT, watermark_us BIGINT, {KEYS}, state STRING",
    "late": f"{LANDED_SCHEMA}, late_reason STRING, window_start_us BIGINT, window_end_us BIGINT, "
            f"watermark_us BIGINT, event_date DATE, {KEYS}",
    "progress": "n_events BIGINT, n_trips BIGINT, late_events BIGINT, late_trips BIGINT, "
                "violations BIGINT, finalized_trips BIGINT, open_trips BIGINT, "
                "max_event_us BIGINT, watermark_before_us BIGINT, watermark_after_us BIGINT, "
                f"{KEYS}",
}
COLUMNS = {table: [c.split()[0] for c in ddl.split(", ")] for table, ddl in SCHEMAS.items()}
PARTIAL = COLUMNS["counts"][:5]  # what is carried from batch to batch
PROGRESS = COLUMNS["progress"][:-2]


class GuardError(ValueError):
    """A batch that contradicts what was published before it."""


class Interrupted(RuntimeError):
    """Raised on request after a batch was applied and before Spark records it."""


# ------------------------------------------------------------------------- landing
def land(trips: DataFrame, landing: str, slice_minutes: int, rows_per_file: int = 100_000) -> int:
    """Write trip events as JSON lines, a folder for each arrival slice and a line in
    ``ready`` for each folder; returns the number of slices.

    Range partitions over (slice, arrival) split a hot slice between tasks, and a task's
    rows between files of at most ``rows_per_file`` lines; small slices share tasks. Names of
    files grow with the arrival of their rows, so the order is kept within and between them.
    """
    spark = trips.sparkSession
    fs = HadoopFS(spark)
    if fs.list_names(landing):
        raise FileExistsError(f"{landing} is in use")
    order = ["slice_id", "processing_time", "event_id"]
    # a stated number of ranges: adaptive execution would merge small ones into one task
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (trips.withColumn("slice_id", floor_div(epoch_us("processing_time"),
                                            slice_minutes * US_PER_MINUTE))
     .repartitionByRange(ranges, *order).sortWithinPartitions(*order)
     .write.partitionBy("slice_id").option("maxRecordsPerFile", rows_per_file)
     .option("timestampFormat", LANDING_TS_FORMAT).json(f"{landing}/slices"))
    slices = sorted(int(n.split("=", 1)[1]) for n in
                    fs.list_names(f"{landing}/slices", dirs_only=True) if n.startswith("slice_id="))
    for number, slice_id in enumerate(slices):
        path = f"{landing}/ready/{number:08d}.json"
        fs.write_text_atomic(path, json.dumps({"number": number, "slice_id": slice_id}))
        fs.set_mtime(path, 1_000_000_000_000 + 1000 * number)  # the source goes by these
    return len(slices)


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Events of JSON-line files or folders; a line that does not parse has its text in
    ``raw_line`` (null in good rows)."""
    return (spark.read.schema(LANDED_SCHEMA).option("columnNameOfCorruptRecord", RAW)
            .option("timestampFormat", LANDING_TS_FORMAT).json(list(paths)))


def read_slice(spark: SparkSession, landing: str, slice_id: int) -> DataFrame:
    return read_lines(spark, f"{landing}/slices/slice_id={slice_id}")


# ---------------------------------------------------------------------------- sink
class Sink:
    """The tables under a folder, and what this process wrote to ``progress`` last."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self._latest: dict[str, dict] = {}

    def read(self, table: str) -> DataFrame:
        path = f"{self.out}/{table}"
        if not HadoopFS(self.spark).exists(path):
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(path)

    def windows(self) -> DataFrame:
        return self.read("counts").where("state = 'published'").drop("state")

    def open_after(self, batch_id: int | None = None) -> DataFrame:
        """Windows open after a batch, of each writer; after its last one by default."""
        rows = self.read("counts").where("state = 'open'").drop("state", "watermark_us")
        if batch_id is not None:
            return rows.where(F.col("batch_id") == batch_id)
        last = self.read("progress").groupBy("writer").agg(F.max("batch_id").alias("batch_id"))
        return rows.join(last, ["writer", "batch_id"])

    def write(self, table: str, rows: DataFrame, writer: str, batch_id: int) -> None:
        """The batch's rows of a table, instead of any that an earlier run of it wrote."""
        names = COLUMNS[table]
        keys = {"writer": f"'{writer}' AS writer", "batch_id": f"{batch_id}L AS batch_id"}
        (rows.selectExpr(*[keys.get(c, c) for c in names]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*names[names.index("writer"):]).parquet(f"{self.out}/{table}"))

    def _partition(self, table: str, columns: list[str], writer: str, batch_id: int,
                   state: str = "") -> DataFrame | None:
        path = f"{self.out}/{table}/writer={writer}/batch_id={batch_id}{state}"
        types = dict(c.split() for c in SCHEMAS[table].split(", "))
        try:
            return self.spark.read.schema(", ".join(f"{c} {types[c]}" for c in columns)).parquet(path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return None

    def before(self, writer: str, batch_id: int) -> tuple[dict, DataFrame | None]:
        """(progress, open windows) that a batch starts from: those of the batch before."""
        if batch_id == 0:
            return dict.fromkeys(PROGRESS), None
        last = self._latest.get(writer)
        if last is None or last["batch_id"] != batch_id - 1:
            found = self._partition("progress", PROGRESS, writer, batch_id - 1)
            row = found.first() if found is not None else None
            if row is None:
                raise LookupError(f"no progress of batch {batch_id - 1} of writer {writer}")
            last = row.asDict()
        # no partition: nothing was open, or it is lost; the check of trips tells
        return last, self._partition("counts", PARTIAL, writer, batch_id - 1, "/state=open")

    def commit(self, writer: str, batch_id: int, progress: dict) -> None:
        values = ", ".join(f"CAST({'NULL' if progress[n] is None else progress[n]} AS BIGINT) AS {n}"
                           for n in PROGRESS)
        self.write("progress", self.spark.sql("SELECT " + values), writer, batch_id)
        self._latest[writer] = progress | {"batch_id": batch_id}


# ------------------------------------------------------------------------ the batch
def extreme(pick, *values):
    """``max`` or ``min`` of the values that are there."""
    return pick((x for x in values if x is not None), default=None)


def trailing(newest_us: int | None, policy: LatenessPolicy) -> int | None:
    """The watermark that a newest event time gives."""
    return None if newest_us is None else newest_us - policy.lateness_us


def _upto(column: str, limit: int | None) -> str:
    """SQL condition: the column is at or before the limit; false without a limit."""
    return "false" if limit is None else f"coalesce({column} <= {limit}L, false)"


TRIP = "coalesce(event_type = 'trip_started', false)"
ON_TIME = f"(late_reason IS NULL AND {TRIP})"


def classify(events: DataFrame, watermark_us: int | None, policy: LatenessPolicy) -> DataFrame:
    """Window bounds and the reason why a row goes to the side output (null: on time)."""
    w = policy.window_us
    no_zone = f"WHEN pickup_zone IS NULL AND {TRIP} THEN 'missing_zone'"
    return events.selectExpr(
        "*", "unix_micros(event_time) AS et_us",
        f"et_us - pmod(et_us, {w}L) AS window_start_us", f"window_start_us + {w}L AS window_end_us",
        f"""CASE WHEN {RAW} IS NOT NULL THEN 'malformed_line'
                 WHEN et_us IS NULL THEN 'missing_event_time'
                 WHEN {_upto('window_end_us', watermark_us)} THEN 'beyond_watermark'
                 {no_zone if policy.route_missing_zone else ''} END AS late_reason""")


def apply(sink: Sink, events: DataFrame, batch_id: int, writer: str,
          policy: LatenessPolicy = DEFAULT_POLICY) -> dict:
    """One micro-batch. One scan caches the batch and observes its scalars; the counts, then
    the late rows if there are any, are written; ``progress`` comes last."""
    if not re.fullmatch(r"[\w.-]+", writer):
        raise ValueError(f"{writer!r} is no name for a folder")
    last, open_before = sink.before(writer, batch_id)
    watermark = last["watermark_after_us"]
    rows = classify(events, watermark, policy).persist()
    try:
        seen, written = (Observation(f"{x}-{uuid.uuid4().hex}") for x in ("seen", "written"))
        # windows that end here or before are published: derived from the newest event, so
        # that it does not depend on the watermark it checks
        published = _upto("window_end_us", trailing(last["max_event_us"], policy))
        (rows.observe(seen, *map(F.expr, (
            "count(*) AS n_events", f"count_if({TRIP}) AS n_trips",
            "count_if(late_reason IS NOT NULL) AS late_events",
            f"count_if(late_reason IS NOT NULL AND {TRIP}) AS late_trips",
            f"count_if({ON_TIME}) AS on_time", "max(et_us) AS newest",
            f"count_if(late_reason IS NULL AND {published}) AS violations")))
         .write.format("noop").mode("overwrite").save())
        got = seen.get
        if got["violations"]:
            raise GuardError(f"batch {batch_id}: {got['violations']} on-time rows of windows "
                             "that were published before")
        newest = extreme(max, last["max_event_us"], got["newest"])
        after = extreme(max, watermark, trailing(newest, policy))
        partials = rows.where(ON_TIME).selectExpr(
            "window_start_us", "pickup_zone AS zone", "1L AS trip_count",
            "surge_multiplier AS surge_sum", "CAST(surge_multiplier IS NOT NULL AS BIGINT) AS surge_n")
        if open_before is not None:
            partials = open_before.union(partials)
        counts = partials.groupBy("window_start_us", "zone").agg(*map(F.expr, (
            "sum(trip_count) AS trip_count", "sum(surge_sum) AS surge_sum",
            "sum(surge_n) AS surge_n"))).selectExpr(
            "*", f"window_start_us + {policy.window_us}L AS window_end_us",
            f"{_upto('window_end_us', after)} AS closed",
            f"CASE WHEN closed THEN {'NULL' if after is None else after} END AS watermark_us",
            "CASE WHEN closed THEN 'published' ELSE 'open' END AS state").observe(
            written, *map(F.expr, ("sum(if(closed, trip_count, 0)) AS finalized_trips",
                                   "sum(if(closed, 0, trip_count)) AS open_trips")))
        sink.write("counts", counts, writer, batch_id)
        if got["late_events"]:
            sink.write("late", rows.where("late_reason IS NOT NULL").selectExpr(
                *EVENT_NAMES, RAW, "late_reason", "window_start_us", "window_end_us",
                f"CAST({'NULL' if watermark is None else watermark} AS BIGINT) AS watermark_us",
                f"date_from_unix_date(CAST((et_us - pmod(et_us, {US_PER_DAY}L)) div "
                f"{US_PER_DAY}L AS INT)) AS event_date"), writer, batch_id)
        total = written.get
        progress = {
            **{k: got[k] for k in ("n_events", "n_trips", "late_events", "late_trips",
                                   "violations")},
            **{k: total[k] or 0 for k in ("finalized_trips", "open_trips")},
            "max_event_us": newest, "watermark_before_us": watermark,
            "watermark_after_us": after}
        if (last["open_trips"] or 0) + got["on_time"] != (
                progress["finalized_trips"] + progress["open_trips"]):
            raise GuardError(f"batch {batch_id}: open and on-time trips do not add up; the open "
                             f"windows of batch {batch_id - 1} were changed or lost")
        sink.commit(writer, batch_id, progress)
        return progress
    finally:
        rows.unpersist()


# ----------------------------------------------------------------------- the stream
def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that owns a checkpoint folder; restarts keep it."""
    return json.loads(HadoopFS(spark).read_text(f"{checkpoint}/metadata"))["id"]


def stream(spark: SparkSession, landing: str, out: str, policy: LatenessPolicy = DEFAULT_POLICY,
           interrupt_after: int | None = None,
           applied: Callable[[int, dict], None] | None = None) -> Sink:
    """Process every slice that is ready and not yet processed, one for each micro-batch.
    ``interrupt_after`` raises ``Interrupted`` when that batch has been applied, as a crash
    before Spark records the batch would; the next call resumes with the same batch.
    ``applied`` is told the number and progress of each batch."""
    sink, checkpoint = Sink(spark, out), f"{out.rstrip('/')}/checkpoint"
    writer: list[str] = []  # the query's id; Spark writes it down when the query starts

    def on_batch(ready: DataFrame, batch_id: int) -> None:
        (line,) = ready.collect()  # one file of one line
        writer[:] = writer or [writer_of(spark, checkpoint)]
        progress = apply(sink, read_slice(spark, landing, line["slice_id"]), batch_id, writer[0],
                         policy)
        if applied is not None:
            applied(batch_id, progress)
        if batch_id == interrupt_after:
            raise Interrupted(f"after batch {batch_id}")

    query = (spark.readStream.schema("number BIGINT, slice_id BIGINT")
             .option("maxFilesPerTrigger", 1).json(f"{landing}/ready")
             .writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return sink
