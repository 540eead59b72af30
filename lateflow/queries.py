"""Registered queries: Spark DataFrame side and oracle SQL side, side by side.

Each query takes ``(spark, sf_dir)`` and reads the driver's tables at ``sf_dir``
(whole tables). Outputs go through ``for_oracle``: instants as epoch micros
(``<name>_us`` BIGINT) and dates as ISO text, so the two engines compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateflow import oracle as O
from lateflow.functions.timecols import date_of_us, epoch_us, iso_ms, parse_iso
from lateflow.operators import health as H
from lateflow.operators import quality as Q
from lateflow.plans.rank import positioned
from lateflow.plans.replay import Replay
from lateflow.plans.scan import materialize
from lateflow.schemas import DEFAULT_POLICY, DEFAULT_SLICE_MINUTES
from lateflow.sources.arrivals import strip_annotations, trip_events

QueryFn = Callable[[SparkSession, str], DataFrame]
SPARK: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def for_oracle(df: DataFrame) -> DataFrame:
    """Timestamps -> ``<col>_us`` epoch micros; dates -> 'YYYY-MM-DD' text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(epoch_us(f.name).alias(f.name + "_us"))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


#: the replay of the input that was asked for last; its steps are written tables
_LAST: dict[tuple, Replay] = {}


def _files(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of the files of a table: changes when its data does."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listFiles(p, True)
    out = []
    while found.hasNext():
        f = found.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def forget() -> None:
    """The next query derives its replay anew."""
    _LAST.clear()
    _LEDGERS.clear()
    _stream_queries._STREAMS.clear()


def replay_for(spark: SparkSession, sf_dir: str, policy=DEFAULT_POLICY,
               slice_minutes: int = DEFAULT_SLICE_MINUTES) -> Replay:
    """The replay of an input and policy, shared by the queries that follow each other on
    the same files; another input, or changed files, start a new one."""
    key = (spark.sparkContext.applicationId, _files(spark, f"{sf_dir.rstrip('/')}/events.parquet"),
           policy, slice_minutes)
    if key not in _LAST:
        forget()
        _LAST[key] = Replay(trip_events(spark, sf_dir), policy, slice_minutes)
    return _LAST[key]


def trips_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_events(spark, sf_dir)


# ---------------------------------------------------------------- batch replay
@register("watermarks", O.with_replay("""
SELECT slice_id, batch_id, n_events, n_trips, batch_max_us,
       watermark_before_us, watermark_after_us FROM batches"""))
def q_watermarks(spark, sf_dir):
    return replay_for(spark, sf_dir).batches.select(
        "slice_id", "batch_id", "n_events", "n_trips", "batch_max_us",
        "watermark_before_us", "watermark_after_us")


@register("landing_slices", O.with_replay("""
SELECT slice_id, batch_id, n_events AS events, n_trips AS trips_started,
       n_events - n_trips AS other_events, min_pt_us, max_pt_us FROM batches"""))
def q_landing_slices(spark, sf_dir):
    return replay_for(spark, sf_dir).batches.select(
        "slice_id", "batch_id", F.col("n_events").alias("events"),
        F.col("n_trips").alias("trips_started"),
        (F.col("n_events") - F.col("n_trips")).alias("other_events"),
        "min_pt_us", "max_pt_us")


@register("late_classify", O.with_replay("""
SELECT event_id, batch_id, window_start_us, window_end_us,
       watermark_before_us AS watermark_us, late_reason FROM classified"""))
def q_late_classify(spark, sf_dir):
    return replay_for(spark, sf_dir).classified.select(
        "event_id", "batch_id", "window_start_us", "window_end_us",
        F.col("watermark_before_us").alias("watermark_us"), "late_reason")


@register("late_events", O.with_replay("""
SELECT event_id, event_type, schema_version, et_us AS event_time_us,
       pt_us AS processing_time_us, trip_id, driver_id, pickup_zone, dropoff_zone,
       distance_km, fare_usd, surge_multiplier, _delay_class, _delay_seconds,
       late_reason, window_start_us, window_end_us, watermark_before_us AS watermark_us,
       batch_id, CAST(event_date AS VARCHAR) AS event_date
FROM late"""))
def q_late_events(spark, sf_dir):
    return for_oracle(replay_for(spark, sf_dir).late_events())


@register("finalized_windows", O.with_replay("""
SELECT window_start_us, window_end_us, zone, trip_count, surge_sum, surge_n,
       CASE WHEN surge_n > 0 THEN surge_sum / surge_n END AS avg_surge,
       watermark_us AS finalized_at_watermark_us, batch_id,
       CAST(window_date AS VARCHAR) AS window_date
FROM fin"""))
def q_finalized_windows(spark, sf_dir):
    return replay_for(spark, sf_dir).finalized_internal().select(
        "window_start_us", "window_end_us", "zone", "trip_count", "surge_sum", "surge_n",
        F.when(F.col("surge_n") > 0, F.col("surge_sum") / F.col("surge_n")).alias("avg_surge"),
        F.col("watermark_us").alias("finalized_at_watermark_us"), "batch_id",
        F.date_format(date_of_us("window_start_us"), "yyyy-MM-dd").alias("window_date"))


@register("open_windows", O.with_replay("""
SELECT window_start_us, zone, trip_count, surge_sum, surge_n
FROM windows WHERE batch_id IS NULL"""))
def q_open_windows(spark, sf_dir):
    return replay_for(spark, sf_dir).open_internal().select(
        "window_start_us", "zone", "trip_count", "surge_sum", "surge_n")


@register("reconcile", O.with_replay("""
SELECT landed_events, landed_trips, micro_batches, last_watermark_us,
       finalized_trips, open_trips, late_events, late_trips,
       finalized_trips + open_trips + late_trips = landed_trips AS reconciles
FROM (SELECT
  (SELECT CAST(sum(n_events) AS BIGINT) FROM batches) AS landed_events,
  (SELECT CAST(sum(n_trips) AS BIGINT) FROM batches) AS landed_trips,
  (SELECT count(*) FROM batches) AS micro_batches,
  (SELECT max(watermark_after_us) FROM batches) AS last_watermark_us,
  (SELECT CAST(COALESCE(sum(trip_count), 0) AS BIGINT) FROM windows
     WHERE batch_id IS NOT NULL) AS finalized_trips,
  (SELECT CAST(COALESCE(sum(trip_count), 0) AS BIGINT) FROM windows
     WHERE batch_id IS NULL) AS open_trips,
  (SELECT count(*) FROM late) AS late_events,
  (SELECT count(*) FROM late WHERE event_type = 'trip_started') AS late_trips) s"""))
def q_reconcile(spark, sf_dir):
    return replay_for(spark, sf_dir).reconcile()


@register("batch_groups", O.with_replay("""
SELECT batch_id, window_start_us, pickup_zone AS zone, event_type, late_reason,
       count(*) AS n, max(et_us) AS max_us, sum(surge_multiplier) AS surge_sum,
       count(surge_multiplier) AS surge_n
FROM classified GROUP BY batch_id, window_start_us, pickup_zone, event_type, late_reason"""))
def q_batch_groups(spark, sf_dir):
    return replay_for(spark, sf_dir).classified.groupBy(
        "batch_id", "window_start_us", F.col("pickup_zone").alias("zone"), "event_type",
        "late_reason").agg(
        F.count(F.lit(1)).alias("n"), F.max("et_us").alias("max_us"),
        F.sum("surge_multiplier").alias("surge_sum"),
        F.count("surge_multiplier").alias("surge_n"))


# ------------------------------------------------------------ scalar operators
@register("window_assign", O.with_replay(f"""
SELECT event_id, window_start_us, window_end_us,
       {O.date_txt('window_start_us')} AS window_date,
       {O.date_txt('et_us')} AS event_date
FROM timed"""))
def q_window_assign(spark, sf_dir):
    t = replay_for(spark, sf_dir).timed
    return t.select("event_id", "window_start_us", "window_end_us",
                    F.date_format(date_of_us("window_start_us"), "yyyy-MM-dd").alias("window_date"),
                    F.date_format(date_of_us("et_us"), "yyyy-MM-dd").alias("event_date"))


@register("epoch_roundtrip", O.with_trips("""
SELECT event_id, et_us AS event_time_us, pt_us AS processing_time_us,
       epoch_us(make_timestamp(et_us)) = et_us AS event_time_roundtrip,
       epoch_us(make_timestamp(pt_us)) = pt_us AS processing_time_roundtrip
FROM trips"""))
def q_epoch_roundtrip(spark, sf_dir):
    t = trips_for(spark, sf_dir)
    et, pt = epoch_us("event_time"), epoch_us("processing_time")
    return t.select("event_id", et.alias("event_time_us"), pt.alias("processing_time_us"),
                    (F.timestamp_micros(et) == F.col("event_time")).alias("event_time_roundtrip"),
                    (F.timestamp_micros(pt) == F.col("processing_time"))
                    .alias("processing_time_roundtrip"))


@register("iso_format", O.with_trips("""
SELECT event_id,
       strftime(make_timestamp(et_us), '%Y-%m-%dT%H:%M:%S.%gZ') AS event_time_iso,
       strftime(make_timestamp(pt_us), '%Y-%m-%dT%H:%M:%S.%gZ') AS processing_time_iso,
       epoch_us(strptime(strftime(make_timestamp(et_us), '%Y-%m-%dT%H:%M:%S.%gZ'),
                         '%Y-%m-%dT%H:%M:%S.%gZ')) AS event_time_ms_us
FROM trips"""))
def q_iso_format(spark, sf_dir):
    t = trips_for(spark, sf_dir)
    return t.select("event_id", iso_ms("event_time").alias("event_time_iso"),
                    iso_ms("processing_time").alias("processing_time_iso"),
                    epoch_us(parse_iso(iso_ms("event_time"))).alias("event_time_ms_us"))


@register("arrival_delay", O.with_replay("""
SELECT event_id, zone, late_reason, arrival_delay_min FROM late_trips"""))
def q_arrival_delay(spark, sf_dir):
    return H.arrival_delay(replay_for(spark, sf_dir).late_events())


@register("fare_quote", O.with_trips("""
SELECT event_id, distance_km, surge,
       CAST(round((CAST(2.50 AS DECIMAL(4,2)) + CAST(1.35 AS DECIMAL(4,2))
                   * CAST(distance_km AS DECIMAL(12,4)))
                  * COALESCE(CAST(surge AS DECIMAL(6,2)), CAST(1 AS DECIMAL(6,2))), 2)
            AS DOUBLE) AS fare_usd
FROM (SELECT event_id, distance_km,
             round_even(least(surge_multiplier, CAST(3.0 AS DOUBLE)) / CAST(0.25 AS DOUBLE), 0)
               * CAST(0.25 AS DOUBLE) AS surge
      FROM trips WHERE event_type = 'trip_completed') s"""))
def q_fare_quote(spark, sf_dir):
    return Q.fare_quote(trips_for(spark, sf_dir))


@register("delay_bands", O.with_trips("""
SELECT observed_band, delay_class, count(*) AS n FROM (
  SELECT CASE WHEN d IS NULL THEN NULL WHEN d <= 3.0 THEN 'on_time'
              WHEN d <= 90.0 THEN 'out_of_order' WHEN d <= 900.0 THEN 'late'
              ELSE 'very_late' END AS observed_band, _delay_class AS delay_class
  FROM (SELECT CAST(pt_us - et_us AS DOUBLE) / CAST(1000000.0 AS DOUBLE) AS d, _delay_class
        FROM trips) x) y
GROUP BY observed_band, delay_class"""))
def q_delay_bands(spark, sf_dir):
    return Q.delay_bands(trips_for(spark, sf_dir))


@register("strip_annotations", O.with_trips("""
SELECT event_id, event_type, schema_version, et_us AS event_time_us,
       pt_us AS processing_time_us, trip_id, driver_id, pickup_zone, dropoff_zone,
       distance_km, fare_usd, surge_multiplier FROM trips"""))
def q_strip_annotations(spark, sf_dir):
    return for_oracle(strip_annotations(trips_for(spark, sf_dir)))


@register("evolve_union", O.with_trips("""
SELECT event_id, schema_version, fare_usd FROM trips WHERE schema_version = 1
UNION ALL BY NAME
SELECT event_id, schema_version, surge_multiplier, fare_usd FROM trips
WHERE schema_version = 2"""))
def q_evolve_union(spark, sf_dir):
    # two batches of one landed table: written once, so the events are derived once
    t = materialize(trips_for(spark, sf_dir).select("event_id", "schema_version", "fare_usd",
                                                    "surge_multiplier"))
    v1 = t.filter(F.col("schema_version") == 1).select("event_id", "schema_version", "fare_usd")
    v2 = t.filter(F.col("schema_version") == 2).select("event_id", "schema_version",
                                                       "surge_multiplier", "fare_usd")
    return v1.unionByName(v2, allowMissingColumns=True)


# --------------------------------------------------------------------- health
def _tables(spark, sf_dir):
    r = replay_for(spark, sf_dir)
    return r.finalized_windows(), r.late_events()


@register("late_by_zone", O.with_replay(f"""
SELECT COALESCE(c.zone, lz.zone) AS zone, COALESCE(c.counted, 0) AS counted,
       COALESCE(lz.late, 0) AS late,
       {O.late_share('COALESCE(c.counted, 0)', 'COALESCE(lz.late, 0)')} AS late_pct,
       lz.median_delay_min, row_number() OVER (ORDER BY
         {O.late_share('COALESCE(c.counted, 0)', 'COALESCE(lz.late, 0)')} DESC NULLS LAST,
         COALESCE(c.zone, lz.zone) NULLS FIRST) AS position
FROM (SELECT zone, CAST(sum(trip_count) AS BIGINT) AS counted FROM fin GROUP BY zone) c
FULL OUTER JOIN (
  SELECT zone, count(*) AS late, round_even(median(arrival_delay_min), 0) AS median_delay_min
  FROM late_trips WHERE zone IS NOT NULL GROUP BY zone) lz ON c.zone = lz.zone"""))
def q_late_by_zone(spark, sf_dir):
    return positioned(H.late_by_zone(*_tables(spark, sf_dir)), [F.col("late_pct").desc(), "zone"])


@register("delay_class_counts", O.with_replay("""
SELECT _delay_class AS delay_class, count(*) AS n FROM late_trips
WHERE _delay_class IS NOT NULL GROUP BY _delay_class"""))
def q_delay_class_counts(spark, sf_dir):
    return H.order_count_by(H.delay_class_counts(_tables(spark, sf_dir)[1]), ["delay_class"])


WINDOW_COMPLETENESS_SQL = """
wcomp AS (
  SELECT COALESCE(c.window_start_us, l.window_start_us) AS window_start_us,
         COALESCE(c.zone, l.zone) AS zone,
         COALESCE(c.trip_count, 0) AS counted, COALESCE(l.late, 0) AS late,
         CAST(COALESCE(c.trip_count, 0) AS DOUBLE)
           / NULLIF(COALESCE(c.trip_count, 0) + COALESCE(l.late, 0), 0) AS completeness
  FROM (SELECT window_start_us, zone, trip_count FROM fin) c
  FULL OUTER JOIN (
    SELECT window_start_us, zone, count(*) AS late FROM late_trips
    WHERE window_start_us IS NOT NULL AND zone IS NOT NULL
    GROUP BY window_start_us, zone) l
  ON c.window_start_us = l.window_start_us AND c.zone = l.zone
)"""


@register("window_completeness", O.with_replay_more(WINDOW_COMPLETENESS_SQL, """
SELECT window_start_us, zone, counted, late, completeness FROM wcomp"""))
def q_window_completeness(spark, sf_dir):
    return H.window_completeness(*_tables(spark, sf_dir))


@register("zone_health", O.with_replay_more(WINDOW_COMPLETENESS_SQL, """
SELECT zone, count(*) AS windows, count(*) FILTER (WHERE completeness < 1) AS incomplete,
       count(*) FILTER (WHERE counted = 0) AS missing,
       round_even(avg(completeness), 3) AS mean_completeness,
       row_number() OVER (ORDER BY round_even(avg(completeness), 3) NULLS FIRST,
                          zone NULLS FIRST) AS position
FROM wcomp GROUP BY zone"""))
def q_zone_health(spark, sf_dir):
    return positioned(H.zone_health(H.window_completeness(*_tables(spark, sf_dir))),
                      ["mean_completeness", "zone"])


@register("worst_windows", O.with_replay_more(WINDOW_COMPLETENESS_SQL, """
SELECT window_start_us, zone, counted, late, completeness FROM wcomp
WHERE completeness < 1 ORDER BY window_start_us, zone LIMIT 10"""))
def q_worst_windows(spark, sf_dir):
    return H.worst_windows(H.window_completeness(*_tables(spark, sf_dir)), 10)


@register("latest_windows", O.with_replay("""
SELECT window_start_us, zone, trip_count, batch_id FROM fin
ORDER BY window_start_us DESC, zone DESC LIMIT 5"""))
def q_latest_windows(spark, sf_dir):
    counts = _tables(spark, sf_dir)[0]
    return for_oracle(H.latest_windows(counts, 5).select(
        "window_start", "zone", "trip_count", "batch_id"))


DAILY_SQL = f"""
daily AS (
  SELECT COALESCE(c.day, l.day) AS day, COALESCE(c.counted, 0) AS counted,
         COALESCE(l.late, 0) AS late
  FROM (SELECT window_date AS day, CAST(sum(trip_count) AS BIGINT) AS counted
        FROM fin GROUP BY window_date) c
  FULL OUTER JOIN (SELECT event_date AS day, count(*) AS late FROM late_trips
                   WHERE event_date IS NOT NULL GROUP BY event_date) l ON c.day = l.day
)"""


@register("daily_health", O.with_replay_more(DAILY_SQL, f"""
SELECT CAST(day AS VARCHAR) AS day, counted, late,
       {O.late_share('counted', 'late')} AS late_pct FROM daily"""))
def q_daily_health(spark, sf_dir):
    return for_oracle(H.daily_health(*_tables(spark, sf_dir)).orderBy("day"))


@register("late_by_reason", O.with_replay("""
SELECT late_reason, COALESCE(_delay_class, '-') AS delay_class, count(*) AS n
FROM late GROUP BY late_reason, _delay_class"""))
def q_late_by_reason(spark, sf_dir):
    return H.order_count_by(H.late_by_reason(_tables(spark, sf_dir)[1]),
                            ["late_reason", "delay_class"])


@register("late_trips_by_zone", O.with_replay("""
SELECT pickup_zone, count(*) AS n FROM late WHERE event_type = 'trip_started'
GROUP BY pickup_zone"""))
def q_late_trips_by_zone(spark, sf_dir):
    return H.order_count_by(H.late_trips_by_zone(_tables(spark, sf_dir)[1]), ["pickup_zone"])


# -------------------------------------------------------------------- quality
@register("stream_summary", O.with_trips("""
SELECT CASE WHEN grouping(event_type) = 0 THEN 'event_type'
            WHEN grouping(_delay_class) = 0 THEN 'delay_class'
            WHEN grouping(schema_version) = 0 THEN 'schema_version'
            ELSE 'events' END AS kind,
       CASE WHEN grouping(event_type) = 0 THEN event_type
            WHEN grouping(_delay_class) = 0 THEN _delay_class
            WHEN grouping(schema_version) = 0 THEN CAST(schema_version AS VARCHAR)
            ELSE 'all' END AS key,
       count(*) AS n
FROM trips
GROUP BY GROUPING SETS ((event_type), (_delay_class), (schema_version), ())"""))
def q_stream_summary(spark, sf_dir):
    return Q.stream_summary(trips_for(spark, sf_dir))


@register("out_of_order", O.with_trips("""
SELECT event_id, pt_us, et_us, prev_max_us,
       COALESCE(et_us < prev_max_us, false) AS out_of_order
FROM (SELECT event_id, pt_us, et_us,
             max(et_us) OVER (ORDER BY pt_us, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max_us
      FROM trips) s"""))
def q_out_of_order(spark, sf_dir):
    return Q.out_of_order(trips_for(spark, sf_dir))


@register("trip_pairs", O.with_trips("""
SELECT count(*) AS trips,
       count(*) FILTER (WHERE n = 2 AND starts = 1 AND ends = 1) AS complete_pairs,
       count(*) FILTER (WHERE NOT (n = 2 AND starts = 1 AND ends = 1)) AS incomplete
FROM (SELECT trip_id, count(*) AS n,
             count(*) FILTER (WHERE event_type = 'trip_started') AS starts,
             count(*) FILTER (WHERE event_type = 'trip_completed') AS ends
      FROM trips GROUP BY trip_id) p"""))
def q_trip_pairs(spark, sf_dir):
    return Q.trip_pairs(trips_for(spark, sf_dir))


@register("duplicate_windows", O.with_replay("""
SELECT CAST(COALESCE(sum(n), 0) AS BIGINT) AS rows, count(*) AS distinct_keys,
       count(*) FILTER (WHERE n > 1) AS duplicated_keys
FROM (SELECT window_start_us, zone, count(*) AS n FROM fin
      GROUP BY window_start_us, zone) k"""))
def q_duplicate_windows(spark, sf_dir):
    return Q.duplicate_windows(_tables(spark, sf_dir)[0])


@register("late_rate_tunnel", O.with_trips("""
SELECT is_tunnel, count(*) AS events, count(*) FILTER (WHERE _delay_class = 'late') AS late,
       CAST(count(*) FILTER (WHERE _delay_class = 'late') AS DOUBLE) / count(*) AS late_rate
FROM (SELECT COALESCE(CASE WHEN event_type = 'trip_completed' THEN dropoff_zone
                           ELSE pickup_zone END IN ('Z03', 'Z04'), false) AS is_tunnel,
             _delay_class FROM trips) z
GROUP BY is_tunnel"""))
def q_late_rate_tunnel(spark, sf_dir):
    return Q.late_rate_tunnel(trips_for(spark, sf_dir))


@register("arrival_order_check", O.with_trips("""
SELECT 'arrival' AS landed_by, event_id, pt_us, prev AS prev_max_us,
       COALESCE(pt_us >= prev, true) AS in_order
FROM (SELECT event_id, pt_us, max(pt_us) OVER (ORDER BY pt_us, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM trips) a
UNION ALL
SELECT 'event', event_id, pt_us, prev, COALESCE(pt_us >= prev, true)
FROM (SELECT event_id, pt_us, max(pt_us) OVER (ORDER BY CAST(event_id AS BIGINT)
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM trips) e"""))
def q_arrival_order_check(spark, sf_dir):
    """Two landing orders of the events: by arrival (never goes back) and by event number
    (goes back wherever an event arrived late)."""
    rows = trips_for(spark, sf_dir).select("event_id", epoch_us("processing_time").alias("pt_us"))
    rows = rows.withColumn("number", F.col("event_id").cast("long"))
    parts = [Q.arrival_order_check(rows, key, "event_id", "pt_us", width).select(
        F.lit(name).alias("landed_by"), "event_id", "pt_us", "prev_max_us", "in_order")
        for name, key, width in (("arrival", "pt_us", Q.ARRIVAL_SLICE_US),
                                 ("event", "number", 1 << 16))]
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------- versioned counts table
LEDGER_SQL = f"""
commits0 AS (
  SELECT f.batch_id, f.has_surge, b.max_pt_us AS ts_us,
         dense_rank() OVER (ORDER BY f.batch_id) AS version
  FROM (SELECT batch_id, max(CASE WHEN surge_n > 0 THEN 1 ELSE 0 END) AS has_surge
        FROM fin GROUP BY batch_id) f JOIN batches b USING (batch_id)
),
commits AS (
  SELECT *, has_surge = 1 AND COALESCE(max(has_surge) OVER (ORDER BY batch_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS evolves
  FROM commits0
),
late_commits0 AS (
  SELECT f.batch_id, f.has_surge, b.max_pt_us AS ts_us,
         dense_rank() OVER (ORDER BY f.batch_id) AS version
  FROM (SELECT batch_id, max(CASE WHEN surge_multiplier IS NOT NULL THEN 1 ELSE 0 END)
               AS has_surge FROM late GROUP BY batch_id) f JOIN batches b USING (batch_id)
),
late_commits AS (
  SELECT *, has_surge = 1 AND COALESCE(max(has_surge) OVER (ORDER BY batch_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS evolves
  FROM late_commits0
),
busiest AS (
  SELECT event_date AS day, count(*) AS n FROM late_trips WHERE event_date IS NOT NULL
  GROUP BY event_date ORDER BY n DESC, day LIMIT 1
),
published AS (SELECT f.*, c.version FROM fin f JOIN commits c USING (batch_id)),
correction AS (
  SELECT window_start_us, window_start_us + {O.W} AS window_end_us, pickup_zone AS zone,
         count(*) AS trip_count, CAST(-1 AS BIGINT) AS batch_id,
         CAST(make_timestamp(window_start_us) AS DATE) AS window_date
  FROM late_trips
  WHERE CAST(make_timestamp(window_start_us) AS DATE) IN (SELECT day FROM busiest)
  GROUP BY window_start_us, pickup_zone
),
snap_before AS (
  SELECT window_start_us, window_end_us, zone, trip_count, batch_id, window_date FROM published
),
snap_bad AS (
  SELECT * FROM snap_before WHERE window_date NOT IN (SELECT day FROM busiest)
  UNION ALL SELECT window_start_us, window_end_us, zone, trip_count, batch_id, window_date
  FROM correction
),
nver AS (SELECT COALESCE(max(version), 0) AS n, min(ts_us) AS first_ts, max(ts_us) AS last_ts
         FROM commits),
hist AS (
  SELECT CAST(0 AS BIGINT) AS version, (SELECT first_ts FROM nver) - 1000000 AS timestamp_us,
         'CREATE TABLE' AS operation, CAST(NULL AS VARCHAR) AS predicate,
         CAST(NULL AS VARCHAR) AS schema_evolution, CAST(NULL AS VARCHAR) AS job,
         CAST(NULL AS BIGINT) AS restored_to
  UNION ALL
  SELECT version, ts_us, 'WRITE', NULL,
         CASE WHEN evolves THEN 'added avg_surge_multiplier at batch ' || CAST(batch_id AS VARCHAR) END,
         NULL, NULL FROM commits
  UNION ALL
  SELECT (SELECT n FROM nver) + 1, (SELECT last_ts FROM nver) + 60000000, 'WRITE',
         'window_date = ''' || CAST(day AS VARCHAR) || '''', NULL, 'late-data-correction', NULL
  FROM busiest
  UNION ALL
  SELECT (SELECT n FROM nver) + 2, (SELECT last_ts FROM nver) + 120000000, 'RESTORE',
         NULL, NULL, NULL, (SELECT n FROM nver) FROM busiest
)"""

SNAP_COLS = "window_start_us, window_end_us, zone, trip_count, batch_id, " \
            "CAST(window_date AS VARCHAR) AS window_date"

_LEDGERS: dict[tuple, object] = {}


def ledger_for(spark, sf_dir):
    from lateflow.operators.versions import ReplayLedger

    r = replay_for(spark, sf_dir)
    key = id(r)
    if key not in _LEDGERS:
        _LEDGERS[key] = ReplayLedger(r)
    return _LEDGERS[key]


def _dates(df):
    return df.select(*[F.date_format(c, "yyyy-MM-dd").alias(c)
                       if isinstance(df.schema[c].dataType, T.DateType) else F.col(c)
                       for c in df.columns])


@register("busiest_late_day", O.with_replay_more(LEDGER_SQL, """
SELECT CAST(day AS VARCHAR) AS day, n FROM busiest"""))
def q_busiest_late_day(spark, sf_dir):
    return _dates(ledger_for(spark, sf_dir).day)


@register("late_trips_on_day", O.with_replay_more(LEDGER_SQL, """
SELECT event_id, window_start_us, window_end_us, pickup_zone,
       CAST(event_date AS VARCHAR) AS event_date
FROM late_trips WHERE event_date IN (SELECT day FROM busiest)"""))
def q_late_trips_on_day(spark, sf_dir):
    from lateflow.operators.health import late_trips

    led = ledger_for(spark, sf_dir)
    lt = late_trips(led.late).join(
        led.day.select(F.col("day").alias("event_date")), "event_date")
    return for_oracle(lt.select("event_id", "window_start", "window_end", "pickup_zone",
                                "event_date"))


@register("zone_totals", O.with_replay_more(LEDGER_SQL, """
SELECT zone, CAST(sum(trip_count) AS BIGINT) AS trips FROM snap_before
WHERE window_date IN (SELECT day FROM busiest) GROUP BY zone"""))
def q_zone_totals(spark, sf_dir):
    return ledger_for(spark, sf_dir).zone_totals("before")


@register("bad_correction", O.with_replay_more(LEDGER_SQL, f"""
SELECT {SNAP_COLS} FROM correction"""))
def q_bad_correction(spark, sf_dir):
    return _dates(ledger_for(spark, sf_dir).correction_rows.select(
        "window_start_us", "window_end_us", "zone", "trip_count", "batch_id", "window_date"))


@register("asof_version", O.with_replay_more(LEDGER_SQL, f"""
SELECT *, row_number() OVER (ORDER BY as_of, window_start_us, zone) AS position FROM (
  SELECT v AS as_of, {SNAP_COLS} FROM published, (
    SELECT DISTINCT unnest([1, n // 2, n]) AS v FROM nver) probes WHERE version <= v
  UNION ALL SELECT (SELECT n FROM nver) + 1, {SNAP_COLS} FROM snap_bad
  UNION ALL SELECT (SELECT n FROM nver) + 2, {SNAP_COLS} FROM snap_before) s"""))
def q_asof_version(spark, sf_dir):
    led = ledger_for(spark, sf_dir)
    n = led.last
    return _dates(positioned(led.as_of_versions([1, n // 2, n, n + 1, n + 2]),
                             ["as_of", "window_start_us", "zone"]))


@register("restore_snapshot", O.with_replay_more(LEDGER_SQL, f"""
SELECT {SNAP_COLS} FROM snap_before"""))
def q_restore_snapshot(spark, sf_dir):
    return _dates(ledger_for(spark, sf_dir).snapshot("current")
                  .orderBy("window_start_us", "zone"))


@register("snapshot_diff", O.with_replay_more(LEDGER_SQL, """
SELECT CASE WHEN grouping(zone) = 1 THEN 'TOTAL' ELSE zone END AS zone,
       CAST(sum(b) AS BIGINT) AS "before",
       CAST(sum(a) AS BIGINT) AS "after", CAST(sum(b) - sum(a) AS BIGINT) AS lost
FROM (SELECT zone, trip_count AS b, 0 AS a FROM snap_before
      WHERE window_date IN (SELECT day FROM busiest)
      UNION ALL SELECT zone, 0, trip_count FROM correction) u
GROUP BY ROLLUP (zone)"""))
def q_snapshot_diff(spark, sf_dir):
    return ledger_for(spark, sf_dir).snapshot_diff()


@register("snapshot_equal", O.with_replay_more(LEDGER_SQL, """
SELECT 'restored / before' AS pair, CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right
UNION ALL
SELECT 'bad / before',
  (SELECT count(*) FROM (SELECT * FROM snap_bad EXCEPT ALL SELECT * FROM snap_before) x),
  (SELECT count(*) FROM (SELECT * FROM snap_before EXCEPT ALL SELECT * FROM snap_bad) y)"""))
def q_snapshot_equal(spark, sf_dir):
    return ledger_for(spark, sf_dir).snapshot_equal()


@register("daily_two_versions", O.with_replay_more(LEDGER_SQL, f"""
SELECT CAST(day AS VARCHAR) AS day, counted_current, counted_bad, late,
       {O.late_share('counted_current', 'late')} AS late_pct_current,
       {O.late_share('counted_bad', 'late')} AS late_pct_bad
FROM (
  SELECT COALESCE(cb.day, lt.day) AS day, COALESCE(cb.counted_current, 0) AS counted_current,
         COALESCE(cb.counted_bad, 0) AS counted_bad, COALESCE(lt.late, 0) AS late
  FROM (SELECT COALESCE(c.day, b.day) AS day, c.counted_current, b.counted_bad
        FROM (SELECT window_date AS day, CAST(sum(trip_count) AS BIGINT) AS counted_current
              FROM snap_before GROUP BY window_date) c
        FULL OUTER JOIN (SELECT window_date AS day, CAST(sum(trip_count) AS BIGINT) AS counted_bad
                         FROM snap_bad GROUP BY window_date) b ON c.day = b.day) cb
  FULL OUTER JOIN (SELECT event_date AS day, count(*) AS late FROM late_trips
                   WHERE event_date IS NOT NULL GROUP BY event_date) lt ON cb.day = lt.day) d"""))
def q_daily_two_versions(spark, sf_dir):
    return _dates(ledger_for(spark, sf_dir).daily_two_versions())


@register("history", O.with_replay_more(LEDGER_SQL, """
SELECT version, timestamp_us, operation, predicate, schema_evolution, job, restored_to
FROM hist ORDER BY version DESC"""))
def q_history(spark, sf_dir):
    return ledger_for(spark, sf_dir).history()


@register("tagged_versions", O.with_replay_more(LEDGER_SQL, """
SELECT bad_version, bad_version - 1 AS version_before, first_evolution_version, corrected_day
FROM (SELECT max(version) FILTER (WHERE job = 'late-data-correction') AS bad_version,
             min(version) FILTER (WHERE schema_evolution IS NOT NULL) AS first_evolution_version,
             arg_max(split_part(predicate, chr(39), 2), version)
               FILTER (WHERE job = 'late-data-correction') AS corrected_day
      FROM hist) t
WHERE bad_version IS NOT NULL"""))
def q_tagged_versions(spark, sf_dir):
    return ledger_for(spark, sf_dir).tagged_versions()


@register("asof_timestamp", O.with_replay_more(LEDGER_SQL, """
SELECT probe_us, (SELECT max(version) FROM hist WHERE timestamp_us <= probe_us) AS resolves_to
FROM (SELECT DISTINCT unnest([timestamp_us - 1, timestamp_us, timestamp_us + 1]) AS probe_us
      FROM hist) p"""))
def q_asof_timestamp(spark, sf_dir):
    return ledger_for(spark, sf_dir).asof_timestamp()


SCHEMA_CHANGES_SQL = """
SELECT 'zone_window_counts' AS table_name, version, ts_us AS timestamp_us,
       'added avg_surge_multiplier at batch ' || CAST(batch_id AS VARCHAR) AS change
FROM commits WHERE evolves
UNION ALL
SELECT 'late_events', version, ts_us,
       'added surge_multiplier at batch ' || CAST(batch_id AS VARCHAR)
FROM late_commits WHERE evolves"""


@register("schema_changes", O.with_replay_more(LEDGER_SQL, SCHEMA_CHANGES_SQL))
def q_schema_changes(spark, sf_dir):
    return ledger_for(spark, sf_dir).schema_changes()


@register("first_value_commit", O.with_replay_more(LEDGER_SQL, """
SELECT 'zone_window_counts' AS table_name, 'avg_surge_multiplier' AS column_name,
       c.version, c.batch_id, f.rows, f.rows_with_value
FROM commits c JOIN (SELECT batch_id, count(*) AS rows,
                            count(*) FILTER (WHERE surge_n > 0) AS rows_with_value
                     FROM fin GROUP BY batch_id) f USING (batch_id)
WHERE c.evolves
UNION ALL
SELECT 'late_events', 'surge_multiplier', c.version, c.batch_id, l.rows, l.rows_with_value
FROM late_commits c JOIN (SELECT batch_id, count(*) AS rows,
                                 count(surge_multiplier) AS rows_with_value
                          FROM late GROUP BY batch_id) l USING (batch_id)
WHERE c.evolves"""))
def q_first_value_commit(spark, sf_dir):
    return ledger_for(spark, sf_dir).first_value_commit()


@register("schema_diff", O.with_replay_more(LEDGER_SQL, """
SELECT 'zone_window_counts' AS table_name, min(version) - 1 AS version_before,
       min(version) AS version_after, 'avg_surge_multiplier' AS added_column
FROM commits WHERE has_surge = 1 HAVING count(*) > 0
UNION ALL
SELECT 'late_events', min(version) - 1, min(version), 'surge_multiplier'
FROM late_commits WHERE has_surge = 1 HAVING count(*) > 0"""))
def q_schema_diff(spark, sf_dir):
    return ledger_for(spark, sf_dir).schema_diff()


@register("null_split", O.with_replay_more(LEDGER_SQL, """
SELECT 'zone_window_counts' AS table_name, CAST(window_date AS VARCHAR) AS partition,
       count(*) AS rows, count(*) FILTER (WHERE surge_n > 0) AS with_value
FROM published GROUP BY window_date
UNION ALL
SELECT 'late_events', CAST(event_date AS VARCHAR), count(*), count(surge_multiplier)
FROM late GROUP BY event_date"""))
def q_null_split(spark, sf_dir):
    return ledger_for(spark, sf_dir).null_split()


@register("txn_versions", O.with_replay_more(LEDGER_SQL, """
SELECT 'zone_window_counts' AS table_name, 'replay' AS app_id,
       (SELECT max(batch_id) FROM commits) AS txn_version
UNION ALL
SELECT 'late_events', 'replay', (SELECT max(batch_id) FROM late_commits)"""))
def q_txn_versions(spark, sf_dir):
    return ledger_for(spark, sf_dir).txn_versions()


@register("describe", O.with_replay_more(LEDGER_SQL, """
SELECT 'zone_window_counts' AS table_name, (SELECT max(version) FROM hist) AS version,
       (SELECT count(*) FROM snap_before) AS rows,
       (SELECT count(*) FILTER (WHERE operation = 'WRITE') FROM hist) AS writes,
       (SELECT count(*) FILTER (WHERE predicate IS NOT NULL) FROM hist) AS overwrites,
       (SELECT count(*) FILTER (WHERE operation = 'RESTORE') FROM hist) AS restores
UNION ALL
SELECT 'late_events', (SELECT COALESCE(max(version), 0) FROM late_commits),
       (SELECT count(*) FROM late), (SELECT count(*) FROM late_commits), 0, 0"""))
def q_describe(spark, sf_dir):
    return ledger_for(spark, sf_dir).describe()


@register("additive_correction", O.with_replay_more(WINDOW_COMPLETENESS_SQL, """
SELECT window_start_us, zone, counted AS published, late, counted + late AS corrected
FROM wcomp"""))
def q_additive_correction(spark, sf_dir):
    return ledger_for(spark, sf_dir).additive_correction()


@register("diagnose_days", O.with_replay_more(LEDGER_SQL, f"""
SELECT CAST(day AS VARCHAR) AS day, counted, late, late_pct, tunnel_late_pct, other_late_pct,
       round_even(median_delay_min, 1) AS median_delay_min, mean_completeness,
       CASE WHEN late = 0 AND counted > 0 THEN 'late_events_missing_upstream'
            WHEN counted < 0.2 * median_day_counted THEN 'partition_overwritten'
            WHEN late_pct >= 10.0 AND mean_completeness < 0.95 THEN 'watermark_ran_ahead'
            WHEN tunnel_late_pct >= 3.0 * other_late_pct AND median_delay_min > 10.0
                 AND median_delay_min <= 30.0 THEN 'tunnel_buffering_exceeds_lateness'
            WHEN tunnel_late_pct >= 3.0 * other_late_pct AND median_delay_min >= 60.0
                 THEN 'devices_offline_hours'
            ELSE 'healthy' END AS cause
FROM (
  SELECT *, {O.late_share('counted', 'late')} AS late_pct,
         round_even(CAST(100.0 AS DOUBLE) * late_tunnel
                    / NULLIF(counted_tunnel + late_tunnel, 0), 1) AS tunnel_late_pct,
         round_even(CAST(100.0 AS DOUBLE) * (late - late_tunnel)
                    / NULLIF((counted - counted_tunnel) + (late - late_tunnel), 0), 1)
           AS other_late_pct,
         median(counted) OVER () AS median_day_counted
  FROM (
    SELECT COALESCE(dc.day, dl.day) AS day, COALESCE(dc.counted, 0) AS counted,
           COALESCE(dc.counted_tunnel, 0) AS counted_tunnel, COALESCE(dl.late, 0) AS late,
           COALESCE(dl.late_tunnel, 0) AS late_tunnel, dl.median_delay_min, dw.mean_completeness
    FROM (SELECT window_date AS day, CAST(sum(trip_count) AS BIGINT) AS counted,
                 CAST(sum(CASE WHEN zone IN ('Z03', 'Z04') THEN trip_count ELSE 0 END)
                      AS BIGINT) AS counted_tunnel
          FROM snap_bad GROUP BY window_date) dc
    FULL OUTER JOIN (
          SELECT event_date AS day, count(*) AS late,
                 count(*) FILTER (WHERE zone IN ('Z03', 'Z04')) AS late_tunnel,
                 median(arrival_delay_min) AS median_delay_min
          FROM late_trips WHERE event_date IS NOT NULL GROUP BY event_date) dl
    ON dc.day = dl.day
    LEFT JOIN (
      SELECT CAST(make_timestamp(ws) AS DATE) AS day,
             round_even(avg(CAST(c AS DOUBLE) / (c + l)), 3) AS mean_completeness
      FROM (SELECT COALESCE(a.window_start_us, b.window_start_us) AS ws,
                   COALESCE(a.trip_count, 0) AS c, COALESCE(b.late, 0) AS l
            FROM snap_bad a FULL OUTER JOIN (
              SELECT window_start_us, zone, count(*) AS late FROM late_trips
              WHERE window_start_us IS NOT NULL AND zone IS NOT NULL
              GROUP BY window_start_us, zone) b
            ON a.window_start_us = b.window_start_us AND a.zone = b.zone) w
      GROUP BY 1) dw ON COALESCE(dc.day, dl.day) = dw.day) d0) d1"""))
def q_diagnose_days(spark, sf_dir):
    from lateflow.operators.versions import diagnose_days

    return _dates(diagnose_days(ledger_for(spark, sf_dir), "bad"))


from lateflow import stream_queries as _stream_queries  # noqa: E402  registers its queries
