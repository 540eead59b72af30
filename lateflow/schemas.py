"""Table schemas (DDL) and policy constants.

Times are UTC. Event times travel as epoch microseconds inside the plans; tables
store proper TIMESTAMP / DATE columns.
"""

from __future__ import annotations

from dataclasses import dataclass

US_PER_SECOND = 1_000_000
US_PER_MINUTE = 60 * US_PER_SECOND
US_PER_DAY = 24 * 60 * US_PER_MINUTE

# Trip events as they land: superset schema (v1 rows read surge_multiplier as null).
EVENT_COLUMNS = [
    ("event_id", "STRING"), ("event_type", "STRING"), ("schema_version", "INT"),
    ("event_time", "TIMESTAMP"), ("processing_time", "TIMESTAMP"),
    ("trip_id", "STRING"), ("driver_id", "STRING"),
    ("pickup_zone", "STRING"), ("dropoff_zone", "STRING"),
    ("distance_km", "DOUBLE"), ("fare_usd", "DOUBLE"), ("surge_multiplier", "DOUBLE"),
    ("_delay_class", "STRING"), ("_delay_seconds", "DOUBLE"),
]
EVENT_SCHEMA = ", ".join(f"{n} {t}" for n, t in EVENT_COLUMNS)
EVENT_NAMES = [n for n, _ in EVENT_COLUMNS]

# Finalized windows, partitioned by window_date, written once per (window, zone).
COUNTS_COLUMNS = [
    ("window_start", "TIMESTAMP"), ("window_end", "TIMESTAMP"), ("zone", "STRING"),
    ("trip_count", "BIGINT"), ("avg_surge_multiplier", "DOUBLE"),
    ("finalized_at_watermark", "TIMESTAMP"), ("batch_id", "BIGINT"), ("window_date", "DATE"),
]

# Side output: every input column, then the routing metadata.
LATE_COLUMNS = EVENT_COLUMNS + [
    ("late_reason", "STRING"), ("window_start", "TIMESTAMP"), ("window_end", "TIMESTAMP"),
    ("watermark", "TIMESTAMP"), ("batch_id", "BIGINT"), ("event_date", "DATE"),
]

# Open-window state carried between micro-batches (one row per open window and zone).
STATE_SCHEMA = "window_start_us BIGINT, zone STRING, n BIGINT, surge_sum DOUBLE, surge_n BIGINT"

# Columns that appear only once schema v2 data arrives; tables start without them.
EVOLVING_COLUMNS = ("surge_multiplier", "avg_surge_multiplier")

COUNTS_TABLE = "zone_window_counts"
LATE_TABLE = "late_events"

# Commit tags in the ledger history.
JOB_TAG = "job"
BAD_CORRECTION_JOB = "late-data-correction"


@dataclass(frozen=True)
class LatenessPolicy:
    """Tumbling window length and allowed lateness, in minutes."""

    window_minutes: int = 15
    allowed_lateness_minutes: int = 10
    # an on-time counted row without a zone cannot be published (zone is the key): it goes
    # to the side output as ``missing_zone``; off, it counts under a null zone
    route_missing_zone: bool = True

    @property
    def window_us(self) -> int:
        return self.window_minutes * US_PER_MINUTE

    @property
    def lateness_us(self) -> int:
        return self.allowed_lateness_minutes * US_PER_MINUTE


DEFAULT_POLICY = LatenessPolicy()
DEFAULT_SLICE_MINUTES = 15
