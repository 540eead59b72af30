"""Column expressions for event time: epoch micros, tumbling bounds, lateness.

All built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lateflow.schemas import US_PER_DAY


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(ts: str | Column) -> Column:
    """TIMESTAMP (or TIMESTAMP_NTZ read as UTC) -> epoch microseconds, null-safe."""
    return F.unix_micros(col_of(ts).cast("timestamp"))


def from_epoch_us(us: str | Column) -> Column:
    return F.timestamp_micros(col_of(us))


def floor_to(us: str | Column, width_us: int) -> Column:
    """Largest multiple of ``width_us`` <= us (epoch aligned, also below zero).

    A null input stays null: unlike ``F.window`` this never filters rows out.
    """
    u = col_of(us)
    return u - F.pmod(u, F.lit(width_us))


def floor_div(us: str | Column, width_us: int) -> Column:
    """floor(us / width_us): the aligned multiple divided exactly (|us| < 2^53)."""
    return (floor_to(us, width_us) / F.lit(width_us)).cast("long")


def date_of_us(us: str | Column) -> Column:
    """UTC calendar date of an instant given in epoch micros (floors before day 0).
    Integer arithmetic, so it does not depend on the session time zone."""
    return F.date_from_unix_date(floor_div(us, US_PER_DAY).cast("int"))


def late_reason(event_us: str | Column, window_end_us: str | Column,
                watermark_us: str | Column) -> Column:
    """``missing_event_time`` / ``beyond_watermark`` / null (on time).

    Late means the event's window ends at or before the watermark in force when the
    event arrived; before the first watermark nothing is late.
    """
    end, wm = col_of(window_end_us), col_of(watermark_us)
    return (F.when(col_of(event_us).isNull(), F.lit("missing_event_time"))
            .when(wm.isNotNull() & (end <= wm), F.lit("beyond_watermark")))


def policy_reason(event_us, window_end_us, watermark_us, route_missing_zone: bool = False,
                  zone="pickup_zone", event_type="event_type",
                  counted_type: str = "trip_started") -> Column:
    """``late_reason`` plus, when enabled, ``missing_zone`` for an otherwise on-time
    counted row whose zone is null."""
    base = late_reason(event_us, window_end_us, watermark_us)
    if not route_missing_zone:
        return base
    no_zone = col_of(zone).isNull() & (col_of(event_type) == F.lit(counted_type))
    return F.coalesce(base, F.when(no_zone, F.lit("missing_zone")))


ISO_MS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def iso_ms(ts: str | Column) -> Column:
    """ISO-8601 text with millisecond precision and a ``Z`` suffix (UTC session)."""
    return F.date_format(col_of(ts), ISO_MS_FORMAT)


def parse_iso(text: str | Column) -> Column:
    return F.to_timestamp(col_of(text), ISO_MS_FORMAT)


def minutes_between_us(later_us: str | Column, earlier_us: str | Column) -> Column:
    return (col_of(later_us) - col_of(earlier_us)) / F.lit(float(60 * 1_000_000))
