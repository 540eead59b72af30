"""Trip-domain expressions: zones, fares, surge steps, delay bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateflow.functions.timecols import col_of

# The zones' codes run from Z01 to Z08; these two are in the tunnel.
ZONES = 8
TUNNEL_ZONES = ("Z03", "Z04")

# fare = (base + per_km * km) * surge, surge capped at 3.0 in quarter steps.
FARE_BASE_USD = "2.50"
FARE_PER_KM_USD = "1.35"
SURGE_CAP = 3.0
SURGE_STEP = 0.25

# Upper bounds (seconds) of the observed-delay bands, smallest first.
DELAY_BANDS = [("on_time", 3.0), ("out_of_order", 90.0), ("late", 900.0)]
DELAY_BAND_ELSE = "very_late"


def zone_dim(spark: SparkSession) -> DataFrame:
    """The zone dimension, one row for each zone."""
    return spark.range(1, ZONES + 1).select(
        F.format_string("Z%02d", "id").alias("zone")).withColumn(
        "is_tunnel", F.col("zone").isin(*TUNNEL_ZONES))


def is_tunnel_zone(zone: str | Column) -> Column:
    return col_of(zone).isin(*TUNNEL_ZONES)


def event_zone(event_type: str | Column = "event_type", pickup: str | Column = "pickup_zone",
               dropoff: str | Column = "dropoff_zone") -> Column:
    """Where the phone was when the event happened: pickup for a start, dropoff at the end."""
    return F.when(col_of(event_type) == F.lit("trip_completed"), col_of(dropoff)) \
        .otherwise(col_of(pickup))


def surge_step(raw: str | Column) -> Column:
    """Clamp to the cap and snap to quarter steps (half-even on exact quarter ties)."""
    capped = F.least(col_of(raw).cast("double"), F.lit(SURGE_CAP))
    return F.bround(capped / F.lit(SURGE_STEP), 0) * F.lit(SURGE_STEP)


def fare_usd(distance_km: str | Column, surge: str | Column) -> Column:
    """Fare in exact DECIMAL arithmetic, rounded to cents, then as DOUBLE."""
    km = col_of(distance_km).cast("decimal(12,4)")
    mult = F.coalesce(col_of(surge).cast("decimal(6,2)"), F.lit(1).cast("decimal(6,2)"))
    raw = (F.lit(FARE_BASE_USD).cast("decimal(4,2)")
           + F.lit(FARE_PER_KM_USD).cast("decimal(4,2)") * km) * mult
    return F.round(raw, 2).cast("double")


def delay_band(delay_seconds: str | Column) -> Column:
    """Classify an observed arrival delay (seconds) into the four delay classes."""
    d = col_of(delay_seconds)
    expr = None
    for name, upper in DELAY_BANDS:
        cond = d <= F.lit(upper)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.when(d.isNotNull(), F.lit(DELAY_BAND_ELSE))
