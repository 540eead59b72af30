"""Oracle SQL: the same queries as plain SQL over the driver's tables (DuckDB dialect).

Each statement starts from the ``events`` view and repeats the arrival adapter and,
where needed, the batch replay as CTEs, with global window functions where the Spark
plan uses two-level scans. Instants are emitted as epoch microseconds (``*_us``) and
dates as ISO text, exactly like the Spark side's ``for_oracle`` projection.
"""

from __future__ import annotations

from lateflow.schemas import (DEFAULT_POLICY, DEFAULT_SLICE_MINUTES, US_PER_MINUTE,
                              LatenessPolicy)

W = DEFAULT_POLICY.window_us
L = DEFAULT_POLICY.lateness_us
S = DEFAULT_SLICE_MINUTES * US_PER_MINUTE


def arrivals_ctes() -> str:
    """CTE ``trips``: trip events with et_us / pt_us (epoch micros)."""
    return """
ev0 AS (
  SELECT event_id AS e, event_id - event_id % 2 AS t, epoch_us(ts) AS et0, user_id, value
  FROM events
),
ev1 AS (
  SELECT *,
    1 + ((((t % 10009) * (t % 10009) * 17 + (t % 10009) * 7919) % 10009) % 8) AS pick_no,
    1 + ((((t % 10009) * (t % 10009) * 13 + (t % 10009) * 104729) % 10009) % 8) AS drop_no,
    (((e % 10007) * (e % 10007) * 31 + (e % 10007) * 7919) % 10007) % 100 AS h
  FROM ev0
),
ev2 AS (
  SELECT *,
    CASE WHEN (CASE WHEN e % 2 = 0 THEN pick_no ELSE drop_no END) IN (3, 4) THEN
      CASE WHEN h < 45 THEN 'on_time' WHEN h < 55 THEN 'out_of_order'
           WHEN h < 97 THEN 'late' ELSE 'very_late' END
    ELSE
      CASE WHEN h < 86 THEN 'on_time' WHEN h < 94 THEN 'out_of_order'
           WHEN h < 99 THEN 'late' ELSE 'very_late' END
    END AS delay_class
  FROM ev1
),
ev3 AS (
  SELECT *,
    CASE delay_class WHEN 'on_time' THEN 1 + e % 3 WHEN 'out_of_order' THEN 5 + e % 86
         WHEN 'late' THEN 120 + e % 781 ELSE 3600 + ((e % 18001) * 31) % 18001 END AS delay_s,
    min(et0) OVER (PARTITION BY t) >= 1704326400000000 AS v2,
    CAST(value AS DECIMAL(12,2)) * CAST(0.25 AS DECIMAL(3,2)) AS km
  FROM ev2
),
ev4 AS (
  SELECT *, CASE WHEN v2 THEN CAST(1.0 + 0.25 * (t % 9) AS DOUBLE) END AS surge FROM ev3
),
trips AS (
  SELECT
    CAST(e AS VARCHAR) AS event_id,
    CASE WHEN e % 2 = 0 THEN 'trip_started' ELSE 'trip_completed' END AS event_type,
    CAST(CASE WHEN v2 THEN 2 ELSE 1 END AS INTEGER) AS schema_version,
    CASE WHEN e % 997 = 0 THEN NULL ELSE et0 END AS et_us,
    et0 + 1000000 * delay_s AS pt_us,
    CAST(t AS VARCHAR) AS trip_id,
    'D' || CAST(user_id AS VARCHAR) AS driver_id,
    'Z0' || CAST(pick_no AS VARCHAR) AS pickup_zone,
    'Z0' || CAST(drop_no AS VARCHAR) AS dropoff_zone,
    CASE WHEN e % 2 = 1 THEN CAST(km AS DOUBLE) END AS distance_km,
    CASE WHEN e % 2 = 1 THEN CAST(round((CAST(2.50 AS DECIMAL(4,2))
           + CAST(1.35 AS DECIMAL(4,2)) * km)
           * COALESCE(CAST(surge AS DECIMAL(6,2)), CAST(1 AS DECIMAL(6,2))), 2) AS DOUBLE)
    END AS fare_usd,
    surge AS surge_multiplier,
    delay_class AS _delay_class,
    CAST(delay_s AS DOUBLE) AS _delay_seconds
  FROM ev4
)"""


def replay_ctes(policy: LatenessPolicy = DEFAULT_POLICY,
                slice_minutes: int = DEFAULT_SLICE_MINUTES) -> str:
    """CTEs timed, batches, classified, window_counts, windows, fin, late, late_trips."""
    w, lat, s = policy.window_us, policy.lateness_us, slice_minutes * US_PER_MINUTE
    return arrivals_ctes() + f""",
timed AS (
  SELECT *, pt_us // {s} AS slice_id,
         et_us - et_us % {w} AS window_start_us,
         et_us - et_us % {w} + {w} AS window_end_us
  FROM trips
),
per_slice AS (
  SELECT slice_id, max(et_us) AS batch_max_us, count(*) AS n_events,
         count(*) FILTER (WHERE event_type = 'trip_started') AS n_trips,
         min(pt_us) AS min_pt_us, max(pt_us) AS max_pt_us
  FROM timed GROUP BY slice_id
),
batches AS (
  SELECT slice_id, row_number() OVER (ORDER BY slice_id) - 1 AS batch_id,
         n_events, n_trips, batch_max_us, min_pt_us, max_pt_us,
         max(batch_max_us) OVER (ORDER BY slice_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {lat} AS watermark_before_us,
         max(batch_max_us) OVER (ORDER BY slice_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - {lat} AS watermark_after_us
  FROM per_slice
),
classified AS (
  SELECT t.*, b.batch_id, b.watermark_before_us,
    CASE WHEN t.et_us IS NULL THEN 'missing_event_time'
         WHEN b.watermark_before_us IS NOT NULL AND t.window_end_us <= b.watermark_before_us
         THEN 'beyond_watermark' END AS late_reason
  FROM timed t JOIN batches b USING (slice_id)
),
window_counts AS (
  SELECT window_start_us, pickup_zone AS zone, count(*) AS trip_count,
         sum(surge_multiplier) AS surge_sum, count(surge_multiplier) AS surge_n
  FROM classified WHERE late_reason IS NULL AND event_type = 'trip_started'
  GROUP BY window_start_us, pickup_zone
),
windows AS (
  SELECT wc.*, wc.window_start_us + {w} AS window_end_us,
    (SELECT min(b.batch_id) FROM batches b
      WHERE b.watermark_after_us >= wc.window_start_us + {w}) AS batch_id,
    (SELECT min(b.watermark_after_us) FROM batches b
      WHERE b.watermark_after_us >= wc.window_start_us + {w}) AS watermark_us
  FROM window_counts wc
),
fin AS (
  SELECT *, CAST(make_timestamp(window_start_us) AS DATE) AS window_date
  FROM windows WHERE batch_id IS NOT NULL
),
late AS (
  SELECT *, CAST(make_timestamp(et_us) AS DATE) AS event_date
  FROM classified WHERE late_reason IS NOT NULL
),
late_trips AS (
  SELECT *, pickup_zone AS zone,
         CAST(pt_us - et_us AS DOUBLE) / CAST(60000000.0 AS DOUBLE) AS arrival_delay_min
  FROM late WHERE event_type = 'trip_started'
)"""


def with_trips(body: str) -> str:
    return "WITH " + arrivals_ctes() + "\n" + body


def with_replay(body: str, policy: LatenessPolicy = DEFAULT_POLICY,
                slice_minutes: int = DEFAULT_SLICE_MINUTES) -> str:
    return "WITH " + replay_ctes(policy, slice_minutes) + "\n" + body


def with_replay_more(extra_ctes: str, body: str) -> str:
    return "WITH " + replay_ctes() + ",\n" + extra_ctes + "\n" + body


DATE_TXT = "CAST(CAST(make_timestamp({us}) AS DATE) AS VARCHAR)"


def date_txt(us: str) -> str:
    return DATE_TXT.format(us=us)


LATE_SHARE = ("round_even(CAST(100.0 AS DOUBLE) * {late} / NULLIF({counted} + {late}, 0), 1)")


def late_share(counted: str, late: str) -> str:
    return LATE_SHARE.format(counted=counted, late=late)
