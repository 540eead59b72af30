"""Versioned views of the published counts, derived in-query from a batch replay.

The streaming job commits one version per micro-batch that finalizes windows. The
same history can be derived from the replay, which makes every versioned operation
checkable against plain SQL:

* v0           create (schema only);
* v1 .. vN     one append per finalizing batch, in batch order (commit time = the
               batch's last arrival time: a clock taken from the data, not the wall);
* v(N+1)       the bad correction: the busiest late day's partition overwritten by a
               recount of that day's late trips only (tagged job=late-data-correction);
* v(N+2)       restore to vN.

All per-commit tables are one row per finalizing batch (bounded by the number of
batches, not by data volume); scans over them are two-level (``prefix_scan``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateflow.functions.timecols import date_of_us
from lateflow.functions.trips import is_tunnel_zone
from lateflow.operators import health as H
from lateflow.plans.rank import exact_median
from lateflow.plans.replay import Replay
from lateflow.operators.repair import row_difference, zone_change
from lateflow.plans.scan import first_at_or_after, materialize, prefix_scan
from lateflow.schemas import (BAD_CORRECTION_JOB, COUNTS_COLUMNS, COUNTS_TABLE, EVOLVING_COLUMNS,
                              LATE_COLUMNS, LATE_TABLE, US_PER_DAY)

US_PER_S = 1_000_000
CREATE_BEFORE_US = 1 * US_PER_S      # v0 is committed 1 s before the first append
CORRECTION_AFTER_US = 60 * US_PER_S  # the bad correction 1 min after the last append
RESTORE_AFTER_US = 120 * US_PER_S    # the restore 2 min after the last append


SNAPSHOT = ["window_start_us", "window_end_us", "zone", "trip_count", "batch_id", "window_date"]


def _shown(versioned: DataFrame, version: int) -> DataFrame:
    return versioned.filter((F.col("since") <= version)
                            & (F.col("until").isNull() | (F.col("until") > version)))


def busiest_day(late: DataFrame) -> DataFrame:
    """One row (day, n): the day with the most late trips; ties -> earliest day.
    Null days are ignored; no late trip -> no row. A top-1 (limit is the feature)."""
    per_day = (H.late_trips(late).filter(F.col("event_date").isNotNull())
               .groupBy(F.col("event_date").alias("day")).agg(F.count(F.lit(1)).alias("n")))
    return per_day.orderBy(F.col("n").desc(), F.col("day").asc()).limit(1)


def _values_so_far() -> list:
    """Whether the evolving column has a value in this commit, in any earlier one, and up
    to this one; a commit with the first value evolves the table."""
    had = F.coalesce(F.col("prev_max"), F.lit(0)) == 1
    return ["has_surge", had.alias("had_value"), (F.col("upto_max") == 1).alias("has_value"),
            ((F.col("has_surge") == 1) & ~had).alias("evolves")]


@dataclass
class ReplayLedger:
    replay: Replay

    # ------------------------------------------------------------ base tables
    @cached_property
    def late(self) -> DataFrame:
        return self.replay.late_events()

    @cached_property
    def commits(self) -> DataFrame:
        """One row per data commit of zone_window_counts: batch_id, version, ts_us,
        has_surge, evolves (first commit carrying a surge value)."""
        fin = self.replay.finalized_internal()
        per_batch = fin.groupBy("batch_id").agg(
            F.max((F.col("surge_n") > 0).cast("int")).alias("has_surge"))
        times = self.replay.batches.select("batch_id", F.col("max_pt_us").alias("ts_us"))
        scanned = prefix_scan(materialize(per_batch.join(times, "batch_id")), "batch_id",
                              "has_surge", 4096)
        out = scanned.select(
            "batch_id", (F.col("idx") + 1).alias("version"), "ts_us", *_values_so_far())
        return materialize(out)

    @cached_property
    def late_commits(self) -> DataFrame:
        """One row per data commit of late_events (batches with late rows)."""
        per_batch = self.replay.late_rows.groupBy("batch_id").agg(
            F.max(F.col("surge_multiplier").isNotNull().cast("int")).alias("has_surge"))
        times = self.replay.batches.select("batch_id", F.col("max_pt_us").alias("ts_us"))
        scanned = prefix_scan(materialize(per_batch.join(times, "batch_id")), "batch_id",
                              "has_surge", 4096)
        return materialize(scanned.select(
            "batch_id", (F.col("idx") + 1).alias("version"), "ts_us", *_values_so_far()))

    @cached_property
    def day(self) -> DataFrame:
        return materialize(busiest_day(self.late))

    @cached_property
    def published(self) -> DataFrame:
        """Finalized rows with their commit version and window_date (vN snapshot)."""
        fin = self.replay.finalized_internal()
        return (fin.join(self.commits.select("batch_id", "version"), "batch_id")
                .withColumn("window_date", date_of_us("window_start_us")))

    @cached_property
    def last(self) -> int:
        """The version of the last data commit, vN (0: none)."""
        return self.commits.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    @cached_property
    def correction_rows(self) -> DataFrame:
        lt = H.late_trips(self.late).withColumn("day", date_of_us("window_start_us"))
        on_day = lt.join(self.day.select("day"), "day")
        return (on_day.groupBy("window_start_us", F.col("pickup_zone").alias("zone"))
                .agg(F.count(F.lit(1)).alias("trip_count"))
                .withColumn("window_end_us",
                            F.col("window_start_us") + F.lit(self.replay.policy.window_us))
                .withColumn("batch_id", F.lit(-1).cast("long"))
                .withColumn("window_date", date_of_us("window_start_us")))

    @cached_property
    def versioned(self) -> DataFrame:
        """Every row the table ever held, with the versions that show it: from ``since`` up
        to, not including, ``until`` (null: still shown). The bad correction ends the day's
        rows and starts its own; the restore ends those and shows again what the version
        it restores showed of the day."""
        n = self.last
        on_day = F.col("day").isNotNull()
        marked = self.published.join(
            self.day.select("day"), F.col("window_date") == F.col("day"), "left")
        whole = marked.select(*SNAPSHOT, F.col("version").alias("since"),
                              F.when(on_day, F.lit(n + 1)).cast("long").alias("until"))
        bad = self.correction_rows.select(*SNAPSHOT, F.lit(n + 1).cast("long").alias("since"),
                                          F.lit(n + 2).cast("long").alias("until"))
        target = _shown(whole, n).filter(F.col("until") == n + 1)
        back = target.select(*SNAPSHOT, F.lit(n + 2).cast("long").alias("since"),
                             F.lit(None).cast("long").alias("until"))
        return materialize(whole.unionByName(bad).unionByName(back))

    def as_of(self, version: int) -> DataFrame:
        """The table as of a version."""
        return _shown(self.versioned, version).select(*SNAPSHOT)

    def as_of_versions(self, versions: list[int]) -> DataFrame:
        """The table as of each of a few versions (column as_of), in one scan."""
        asked = F.array(*[F.lit(v).cast("long") for v in sorted(set(versions))])
        shown = F.filter(asked, lambda v: (F.col("since") <= v)
                         & (F.col("until").isNull() | (F.col("until") > v)))
        return self.versioned.select(F.explode(shown).alias("as_of"), *SNAPSHOT)

    def as_of_ts(self, probes: DataFrame) -> DataFrame:
        """For each probe_us: the latest version committed at or before it (null: none)."""
        steps = self.recorded.select((-F.col("timestamp_us")).alias("at"),
                                      (-F.col("version")).alias("version"))
        asked = probes.select((-F.col("probe_us")).alias("q")).distinct()
        found = first_at_or_after(asked, "q", steps, "at", ["version"], US_PER_DAY)
        return found.select((-F.col("q")).alias("probe_us"),
                            (-F.col("version")).alias("resolves_to"))

    def snapshot(self, which: str) -> DataFrame:
        """``before`` (vN), ``bad`` (vN+1) or ``current`` (vN+2, the restored table)."""
        return self.as_of(self.last + {"before": 0, "bad": 1, "current": 2}[which])

    # --------------------------------------------------------------- reports
    def history(self) -> DataFrame:
        """Commits newest first: version, timestamp_us, operation, predicate, tags."""
        return self.recorded.orderBy(F.col("version").desc())

    @cached_property
    def recorded(self) -> DataFrame:
        """The commits in no order; one row each, derived once."""
        c = self.commits
        data = c.select(
            "version", F.col("ts_us").alias("timestamp_us"), F.lit("WRITE").alias("operation"),
            F.lit(None).cast("string").alias("predicate"),
            F.when(F.col("evolves"), F.concat(F.lit("added avg_surge_multiplier at batch "),
                                              F.col("batch_id").cast("string")))
            .alias("schema_evolution"),
            F.lit(None).cast("string").alias("job"),
            F.lit(None).cast("long").alias("restored_to"))
        # one aggregate over commits and the busiest day together: no join needed
        per_day = self.day
        both = (c.select("version", "ts_us", F.lit(None).cast("date").alias("day"))
                .unionByName(per_day.select(F.lit(None).cast("long").alias("version"),
                                            F.lit(None).cast("long").alias("ts_us"), "day")))
        agg = both.agg(F.coalesce(F.max("version"), F.lit(0)).alias("n"),
                       F.min("ts_us").alias("first_ts"), F.max("ts_us").alias("last_ts"),
                       F.max("day").alias("day"))
        create = agg.select(F.lit(0).cast("long").alias("version"),
                            (F.col("first_ts") - F.lit(CREATE_BEFORE_US)).alias("timestamp_us"),
                            F.lit("CREATE TABLE").alias("operation"),
                            F.lit(None).cast("string").alias("predicate"),
                            F.lit(None).cast("string").alias("schema_evolution"),
                            F.lit(None).cast("string").alias("job"),
                            F.lit(None).cast("long").alias("restored_to"))
        bad = agg.filter(F.col("day").isNotNull()).select(
            (F.col("n") + 1).cast("long").alias("version"),
            (F.col("last_ts") + F.lit(CORRECTION_AFTER_US)).alias("timestamp_us"),
            F.lit("WRITE").alias("operation"),
            F.concat(F.lit("window_date = '"), F.date_format("day", "yyyy-MM-dd"), F.lit("'"))
            .alias("predicate"),
            F.lit(None).cast("string").alias("schema_evolution"),
            F.lit(BAD_CORRECTION_JOB).alias("job"),
            F.lit(None).cast("long").alias("restored_to"))
        restore = agg.filter(F.col("day").isNotNull()).select(
            (F.col("n") + 2).cast("long").alias("version"),
            (F.col("last_ts") + F.lit(RESTORE_AFTER_US)).alias("timestamp_us"),
            F.lit("RESTORE").alias("operation"),
            F.lit(None).cast("string").alias("predicate"),
            F.lit(None).cast("string").alias("schema_evolution"),
            F.lit(None).cast("string").alias("job"),
            F.col("n").cast("long").alias("restored_to"))
        return materialize(create.unionByName(data).unionByName(bad).unionByName(restore))

    def tagged_versions(self, job: str = BAD_CORRECTION_JOB) -> DataFrame:
        """The most recent commit tagged ``job``, the version before it, the first
        schema-evolution version, and the day the tagged overwrite replaced (the quoted
        literal of its predicate). No tagged commit -> no row."""
        h = self.recorded
        is_job = F.col("job") == F.lit(job)
        agg = h.agg(
            F.max(F.when(is_job, F.col("version"))).alias("bad_version"),
            F.min(F.when(F.col("schema_evolution").isNotNull(), F.col("version")))
            .alias("first_evolution_version"),
            F.max_by(F.split(F.col("predicate"), "'").getItem(1),
                     F.when(is_job, F.col("version"))).alias("corrected_day"))
        return agg.filter(F.col("bad_version").isNotNull()).select(
            "bad_version", (F.col("bad_version") - 1).alias("version_before"),
            "first_evolution_version", "corrected_day")

    def asof_timestamp(self) -> DataFrame:
        """Reads as of instants before, at and after every commit."""
        at = F.col("timestamp_us")
        near = self.recorded.select(F.explode(F.array(at - 1, at, at + 1)).alias("probe_us"))
        return self.as_of_ts(near)

    def schema_changes(self) -> DataFrame:
        """Commits that added a column, per table: table_name, version, timestamp_us, change."""
        counts = self.commits.filter("evolves").select(
            F.lit(COUNTS_TABLE).alias("table_name"), "version", F.col("ts_us").alias("timestamp_us"),
            F.concat(F.lit("added avg_surge_multiplier at batch "),
                     F.col("batch_id").cast("string")).alias("change"))
        late = self.late_commits.filter("evolves").select(
            F.lit(LATE_TABLE).alias("table_name"), "version", F.col("ts_us").alias("timestamp_us"),
            F.concat(F.lit("added surge_multiplier at batch "),
                     F.col("batch_id").cast("string")).alias("change"))
        return counts.unionByName(late)

    def first_value_commit(self) -> DataFrame:
        """Per table: the commit that first carried a value of the evolving column (the
        one that evolves the schema), its batch, its rows and rows with a value."""
        fin = self.replay.finalized_internal().groupBy("batch_id").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("surge_n") > 0).alias("rows_with_value"))
        late = self.replay.late_rows.groupBy("batch_id").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("surge_multiplier").alias("rows_with_value"))
        cols = ["version", "batch_id", "rows", "rows_with_value"]
        counts = (self.commits.filter("evolves").join(fin, "batch_id")
                  .select(F.lit(COUNTS_TABLE).alias("table_name"),
                          F.lit("avg_surge_multiplier").alias("column_name"), *cols))
        late_part = (self.late_commits.filter("evolves").join(late, "batch_id")
                     .select(F.lit(LATE_TABLE).alias("table_name"),
                             F.lit("surge_multiplier").alias("column_name"), *cols))
        return counts.unionByName(late_part)

    def columns_by_version(self, table: str) -> DataFrame:
        """The columns a reader of each version sees, and those of the version before: the
        evolving columns belong to the table once any row so far has a value."""
        commits, columns = ((self.commits, COUNTS_COLUMNS) if table == COUNTS_TABLE
                            else (self.late_commits, LATE_COLUMNS))
        base = F.array(*[F.lit(c) for c, _ in columns if c not in EVOLVING_COLUMNS])
        more = F.array(*[F.lit(c) for c, _ in columns if c in EVOLVING_COLUMNS])
        return commits.select(
            "version", F.when(F.col("has_value"), F.concat(base, more)).otherwise(base)
            .alias("columns"), F.when(F.col("had_value"), F.concat(base, more)).otherwise(base)
            .alias("columns_before"))

    def schema_diff(self) -> DataFrame:
        """The columns each table gained, with the versions just before and at the change."""
        parts = [self.columns_by_version(t).select(
            F.lit(t).alias("table_name"), (F.col("version") - 1).alias("version_before"),
            F.col("version").alias("version_after"),
            F.explode(F.array_except("columns", "columns_before")).alias("added_column"))
            for t in (COUNTS_TABLE, LATE_TABLE)]
        return parts[0].unionByName(parts[1])

    def null_split(self) -> DataFrame:
        """Rows and rows with a value of the evolved column, per partition (current)."""
        c = self.published.groupBy("window_date").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("surge_n") > 0).alias("with_value"))
        lt = self.late.groupBy("event_date").agg(
            F.count(F.lit(1)).alias("rows"), F.count("surge_multiplier").alias("with_value"))
        return (c.select(F.lit(COUNTS_TABLE).alias("table_name"),
                         F.date_format("window_date", "yyyy-MM-dd").alias("partition"),
                         "rows", "with_value")
                .unionByName(lt.select(F.lit(LATE_TABLE).alias("table_name"),
                                       F.date_format("event_date", "yyyy-MM-dd").alias("partition"),
                                       "rows", "with_value")))

    def snapshot_diff(self) -> DataFrame:
        """Per zone on the corrected day: trips before (vN), after (vN+1), lost; + TOTAL."""
        day = self.day.select(F.col("day").alias("window_date"))
        return zone_change(*(self.snapshot(w).join(day, "window_date") for w in ("before", "bad")))

    def zone_totals(self, which: str = "before") -> DataFrame:
        day = self.day.select(F.col("day").alias("window_date"))
        return (self.snapshot(which).join(day, "window_date").groupBy("zone")
                .agg(F.sum("trip_count").cast("long").alias("trips")))

    def snapshot_equal(self) -> DataFrame:
        """Rows that two versions don't share: the restored table and the bad one, each
        against the last good one (pair, only_left, only_right)."""
        good = self.snapshot("before")
        parts = [row_difference(self.snapshot(w), good).select(
            F.lit(f"{name} / before").alias("pair"), "only_left", "only_right")
            for w, name in (("current", "restored"), ("bad", "bad"))]
        return parts[0].unionByName(parts[1])

    def daily_two_versions(self) -> DataFrame:
        """Daily view of the healthy table next to the bad correction (side by side)."""
        def per_day(snap, suffix):
            return snap.groupBy(F.col("window_date").alias("day")).agg(
                F.sum("trip_count").cast("long").alias("counted" + suffix))
        late = (H.late_trips(self.late).filter(F.col("event_date").isNotNull())
                .groupBy(F.col("event_date").alias("day")).agg(F.count(F.lit(1)).alias("late")))
        d = (per_day(self.snapshot("current"), "_current")
             .join(per_day(self.snapshot("bad"), "_bad"), "day", "full_outer")
             .join(late, "day", "full_outer")
             .select("day", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                              for c in ("counted_current", "counted_bad", "late")]))
        return (d.withColumn("late_pct_current", H.late_share("counted_current", "late"))
                 .withColumn("late_pct_bad", H.late_share("counted_bad", "late")))

    def txn_versions(self, app_id: str = "replay") -> DataFrame:
        """Per table: the writer's last committed batch (the txn version)."""
        c = self.commits.agg(F.max("batch_id").alias("txn_version")).select(
            F.lit(COUNTS_TABLE).alias("table_name"), "txn_version")
        lt = self.late_commits.agg(F.max("batch_id").alias("txn_version")).select(
            F.lit(LATE_TABLE).alias("table_name"), "txn_version")
        return c.unionByName(lt).select("table_name", F.lit(app_id).alias("app_id"),
                                        "txn_version")

    def describe(self) -> DataFrame:
        """Per table: latest version, live rows, and how many commits of each kind."""
        h = self.recorded
        counts = h.agg(
            F.max("version").alias("version"),
            F.count_if(F.col("operation") == "WRITE").alias("writes"),
            F.count_if(F.col("predicate").isNotNull()).alias("overwrites"),
            F.count_if(F.col("operation") == "RESTORE").alias("restores"))
        rows = self.snapshot("current").agg(F.count(F.lit(1)).alias("rows"))
        late_c = self.late_commits.agg(
            F.coalesce(F.max("version"), F.lit(0)).alias("version"),
            F.count(F.lit(1)).alias("writes"))
        late_rows = self.late.agg(F.count(F.lit(1)).alias("rows"))
        names = ["version", "rows", "writes", "overwrites", "restores"]

        def part(df, table, **cols):
            return df.select(F.lit(table).alias("table_name"), *[
                (F.col(n) if n in df.columns else F.lit(None)).cast("long").alias(n)
                for n in names])
        parts = (part(counts, COUNTS_TABLE).unionByName(part(rows, COUNTS_TABLE))
                 .unionByName(part(late_c, LATE_TABLE)).unionByName(part(late_rows, LATE_TABLE)))
        return parts.groupBy("table_name").agg(
            *[F.coalesce(F.max(n), F.lit(0)).cast("long").alias(n) for n in names])

    def additive_correction(self) -> DataFrame:
        """The right fix: published + late trips per (window, zone), never a replacement."""
        comp = H.window_completeness(self.replay.finalized_windows(), self.late)
        return comp.select("window_start_us", "zone", F.col("counted").alias("published"),
                           "late", (F.col("counted") + F.col("late")).alias("corrected"))


# ---------------------------------------------------------------- diagnosis
@dataclass(frozen=True)
class DiagnosisThresholds:
    """Our thresholds for the symptom -> cause rules (the reference states them in prose)."""

    collapse_ratio: float = 0.2       # day's counted < ratio x median day: overwritten
    spike_pct: float = 10.0           # late share that means the watermark ran ahead, if
    complete: float = 0.95            # its windows are also less complete than this
    tunnel_factor: float = 3.0        # tunnel late share vs other zones
    buffering_max_factor: float = 3.0  # median delay within (lateness, factor x lateness]
    offline_min_minutes: float = 60.0  # median delay of hours: devices offline


def diagnose_days(ledger: ReplayLedger, which: str = "bad",
                  t: DiagnosisThresholds = DiagnosisThresholds()) -> DataFrame:
    """One row per day of the chosen snapshot with the health signals and a cause."""
    lateness_min = ledger.replay.policy.allowed_lateness_minutes
    snap = ledger.snapshot(which)
    tunnel = is_tunnel_zone("zone")
    counted = snap.groupBy(F.col("window_date").alias("day")).agg(
        F.sum("trip_count").cast("long").alias("counted"),
        F.sum(F.when(tunnel, F.col("trip_count")).otherwise(0)).cast("long")
        .alias("counted_tunnel"))
    lt = H.late_trips(ledger.late).filter(F.col("event_date").isNotNull())
    late = lt.groupBy(F.col("event_date").alias("day")).agg(
        F.count(F.lit(1)).alias("late"),
        F.count_if(tunnel).alias("late_tunnel"))
    median = exact_median(lt.withColumnRenamed("event_date", "day"), ["day"],
                          "arrival_delay_min", "event_id", "median_delay_min")
    late = late.join(median, "day", "left")
    complete = (H.window_completeness(snap.withColumn(
                    "window_start", F.timestamp_micros("window_start_us")), ledger.late)
                .groupBy(date_of_us("window_start_us").alias("day"))
                .agg(F.bround(F.avg("completeness"), 3).alias("mean_completeness")))
    d = (counted.join(late, "day", "full_outer").join(complete, "day", "left")
         .select("day", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                          for c in ("counted", "counted_tunnel", "late", "late_tunnel")],
                 "median_delay_min", "mean_completeness"))
    d = (d.withColumn("late_pct", H.late_share("counted", "late"))
          .withColumn("tunnel_late_pct", F.bround(F.try_divide(
              F.lit(100.0) * F.col("late_tunnel"), F.col("counted_tunnel") + F.col("late_tunnel")), 1))
          .withColumn("other_late_pct", F.bround(F.try_divide(
              F.lit(100.0) * (F.col("late") - F.col("late_tunnel")),
              (F.col("counted") - F.col("counted_tunnel")) + (F.col("late") - F.col("late_tunnel"))),
              1))
          # one row per day: a whole-table window over a table bounded by the day count
          .withColumn("median_day_counted", F.median("counted").over(Window.partitionBy())))
    tunnel_heavy = F.col("tunnel_late_pct") >= F.lit(t.tunnel_factor) * F.col("other_late_pct")
    cause = (F.when((F.col("late") == 0) & (F.col("counted") > 0),
                    F.lit("late_events_missing_upstream"))
             .when(F.col("counted") < F.lit(t.collapse_ratio) * F.col("median_day_counted"),
                   F.lit("partition_overwritten"))
             .when((F.col("late_pct") >= F.lit(t.spike_pct))
                   & (F.col("mean_completeness") < F.lit(t.complete)), F.lit("watermark_ran_ahead"))
             .when(tunnel_heavy & (F.col("median_delay_min") > F.lit(float(lateness_min)))
                   & (F.col("median_delay_min")
                      <= F.lit(t.buffering_max_factor * lateness_min)),
                   F.lit("tunnel_buffering_exceeds_lateness"))
             .when(tunnel_heavy & (F.col("median_delay_min") >= F.lit(t.offline_min_minutes)),
                   F.lit("devices_offline_hours"))
             .otherwise(F.lit("healthy")))
    return d.select("day", "counted", "late", "late_pct", "tunnel_late_pct", "other_late_pct",
                    F.bround("median_delay_min", 1).alias("median_delay_min"),
                    "mean_completeness", cause.alias("cause"))
