"""Batch replay of the lateness policy over a landed table of trip events.

The streaming job (``lateflow.streaming.job``) processes one processing-time slice per
micro-batch. Its outcome is a pure function of the events, so the same policy can
run as one batch query over all events:

* batch id    = dense index of the event's non-empty arrival slice;
* watermark W = running max of event time over *earlier* batches - lateness
                (null before the first event time; never regresses);
* late        = no event time, or the event's window ends at or before W;
* counted     = on-time ``trip_started`` rows, per (window, pickup zone);
* finalized   = by the first batch whose post-batch watermark reaches window_end,
                stamped with that watermark; windows no batch reaches stay open.

Products: ``window_counts`` (on-time counts per window and zone) and ``late_rows``
(the side output) are materialized once per replay; reports are built on them.

Plan shape: one partial/final aggregate over the events gives one row per slice
(bounded by time span / slice width, not by data volume); two-level scans over that
table give batch ids and watermarks; it is materialized, size-checked and broadcast
back onto the events, so the events are never shuffled for the join. The on-time
counts are one more partial/final aggregate; finalization is an as-of lookup on the
distinct window ends (again metadata-sized) joined back by window end.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateflow.functions.timecols import (date_of_us, epoch_us, floor_div, floor_to,
                                         from_epoch_us, policy_reason)
from lateflow.plans.scan import first_at_or_after, materialize, prefix_scan
from lateflow.schemas import (DEFAULT_POLICY, DEFAULT_SLICE_MINUTES, EVENT_NAMES,
                              US_PER_DAY, US_PER_MINUTE, LatenessPolicy)

# Block widths of the two-level scans: 4096 slices per block, one day of window ends.
SLICE_BLOCK = 4096


@dataclass
class Replay:
    trips: DataFrame
    policy: LatenessPolicy = DEFAULT_POLICY
    slice_minutes: int = DEFAULT_SLICE_MINUTES
    zone_column: str = "pickup_zone"
    counted_type: str = "trip_started"

    @property
    def slice_us(self) -> int:
        return self.slice_minutes * US_PER_MINUTE

    # ------------------------------------------------------------------ inputs
    @cached_property
    def timed(self) -> DataFrame:
        """Events with epoch-micro clocks, slice id and window bounds."""
        w = self.policy.window_us
        et, pt = epoch_us("event_time"), epoch_us("processing_time")
        return (self.trips
                .withColumn("et_us", et)
                .withColumn("pt_us", pt)
                .withColumn("slice_id", floor_div("pt_us", self.slice_us))
                .withColumn("window_start_us", floor_to("et_us", w))
                .withColumn("window_end_us", F.col("window_start_us") + F.lit(w)))

    # ------------------------------------------------------------- per batch
    @cached_property
    def batches(self) -> DataFrame:
        """One row per non-empty slice: batch_id, counts, batch max event time, and
        the watermark before / after the batch. Materialized (small, reused)."""
        lateness = F.lit(self.policy.lateness_us)
        per_slice = self.timed.groupBy("slice_id").agg(
            F.max("et_us").alias("batch_max_us"),
            F.count(F.lit(1)).alias("n_events"),
            F.count_if(F.col("event_type") == F.lit(self.counted_type)).alias("n_trips"),
            F.min("pt_us").alias("min_pt_us"), F.max("pt_us").alias("max_pt_us"))
        # one row per non-empty slice: materialized so the scan below reads metadata only
        scanned = prefix_scan(materialize(per_slice), "slice_id", "batch_max_us", SLICE_BLOCK)
        out = scanned.select(
            "slice_id", F.col("idx").alias("batch_id"), "n_events", "n_trips", "batch_max_us",
            "min_pt_us", "max_pt_us",
            (F.col("prev_max") - lateness).alias("watermark_before_us"),
            (F.col("upto_max") - lateness).alias("watermark_after_us"))
        return materialize(out)

    @cached_property
    def classified(self) -> DataFrame:
        """Every event with batch id, the watermark it met, and its late reason. Written
        once as a columnar table: the late rows and the window counts both read it, so the
        events are derived and shuffled once."""
        meta = self.batches.select("slice_id", "batch_id", "watermark_before_us")
        return materialize(self.timed.join(meta, "slice_id")
                           .withColumn("late_reason", policy_reason(
                               "et_us", "window_end_us", "watermark_before_us",
                               self.policy.route_missing_zone, self.zone_column, "event_type",
                               self.counted_type)))

    # -------------------------------------------------------------- outputs
    @cached_property
    def late_rows(self) -> DataFrame:
        """Side output rows (internal form: epoch micros)."""
        return self.classified.filter(F.col("late_reason").isNotNull())

    def late_events(self) -> DataFrame:
        """The ``late_events`` table: input columns + routing metadata."""
        return self.late_rows.select(
            *[F.col(c) for c in EVENT_NAMES if c in self.trips.columns],
            "late_reason",
            from_epoch_us("window_start_us").alias("window_start"),
            from_epoch_us("window_end_us").alias("window_end"),
            from_epoch_us("watermark_before_us").alias("watermark"),
            F.col("batch_id").cast("long").alias("batch_id"),
            date_of_us("et_us").alias("event_date"))

    @cached_property
    def window_counts(self) -> DataFrame:
        """On-time counted events per (window, zone) over all batches."""
        on_time = self.classified.filter(
            F.col("late_reason").isNull() & (F.col("event_type") == F.lit(self.counted_type)))
        # the replay's aggregated product: written once, read by the as-of lookup and
        # the final join
        return materialize(
            on_time.groupBy("window_start_us", F.col(self.zone_column).alias("zone")).agg(
                F.count(F.lit(1)).alias("trip_count"),
                F.sum("surge_multiplier").alias("surge_sum"),
                F.count("surge_multiplier").alias("surge_n")))

    @cached_property
    def finalizing(self) -> DataFrame:
        """window_end_us -> (batch_id, watermark_us) of the batch that finalizes it."""
        steps = self.batches.filter(
            F.col("watermark_after_us").isNotNull()
            & (F.col("watermark_before_us").isNull()
               | (F.col("watermark_after_us") > F.col("watermark_before_us")))
        ).select(F.col("watermark_after_us").alias("step_wm"), "batch_id",
                 F.col("watermark_after_us").alias("watermark_us"))
        ends = (self.window_counts
                .select((F.col("window_start_us") + F.lit(self.policy.window_us))
                        .alias("window_end_us")).distinct())
        found = first_at_or_after(ends, "window_end_us", steps, "step_wm",
                                  ["batch_id", "watermark_us"], US_PER_DAY)
        return materialize(found)

    @cached_property
    def windows(self) -> DataFrame:
        """All counted windows with their finalizing batch (null while open)."""
        w = self.policy.window_us
        return (self.window_counts
                .withColumn("window_end_us", F.col("window_start_us") + F.lit(w))
                .join(self.finalizing, "window_end_us", "left"))

    def finalized_internal(self) -> DataFrame:
        return self.windows.filter(F.col("batch_id").isNotNull())

    def open_internal(self) -> DataFrame:
        return self.windows.filter(F.col("batch_id").isNull())

    def finalized_windows(self) -> DataFrame:
        """The ``zone_window_counts`` table (rounded average surge, as the sink writes)."""
        return self.finalized_internal().select(*counts_columns())

    def open_windows(self) -> DataFrame:
        return self.open_internal().select(
            from_epoch_us("window_start_us").alias("window_start"),
            from_epoch_us("window_end_us").alias("window_end"),
            "zone", "trip_count", "surge_sum", "surge_n")

    def reconcile(self) -> DataFrame:
        """Finalized + open + late trips == landed trips, in one row."""
        zero = F.lit(0).cast("long")
        names = ["landed_events", "landed_trips", "micro_batches", "last_watermark_us",
                 "finalized_trips", "open_trips", "late_events", "late_trips"]

        def part(**cols):
            return [cols.get(n, F.lit(None).cast("long")).cast("long").alias(n) for n in names]

        is_fin = F.col("batch_id").isNotNull()
        counted = F.col("event_type") == F.lit(self.counted_type)
        # One aggregate over a union of the three sources: no join between them.
        parts = (self.batches.select(*part(
                    landed_events=F.col("n_events"), landed_trips=F.col("n_trips"),
                    micro_batches=F.lit(1), last_watermark_us=F.col("watermark_after_us")))
                 .unionByName(self.windows.select(*part(
                     finalized_trips=F.when(is_fin, F.col("trip_count")).otherwise(zero),
                     open_trips=F.when(is_fin, zero).otherwise(F.col("trip_count")))))
                 .unionByName(self.late_rows.select(*part(
                     late_events=F.lit(1), late_trips=F.when(counted, 1).otherwise(0)))))
        sums = [F.coalesce(F.sum(n), zero).cast("long").alias(n)
                for n in names if n != "last_watermark_us"]
        row = parts.agg(*sums, F.max("last_watermark_us").alias("last_watermark_us"))
        return row.withColumn(
            "reconciles",
            (F.col("finalized_trips") + F.col("open_trips") + F.col("late_trips"))
            == F.col("landed_trips"))


def counts_columns():
    """Projection from internal window rows to the sink's column set."""
    avg = F.when(F.col("surge_n") > 0,
                 F.bround(F.col("surge_sum") / F.col("surge_n"), 4))
    return [
        from_epoch_us("window_start_us").alias("window_start"),
        from_epoch_us("window_end_us").alias("window_end"),
        F.col("zone"),
        F.col("trip_count").cast("long").alias("trip_count"),
        avg.cast("double").alias("avg_surge_multiplier"),
        from_epoch_us("watermark_us").alias("finalized_at_watermark"),
        F.col("batch_id").cast("long").alias("batch_id"),
        date_of_us("window_start_us").alias("window_date"),
    ]
