"""Arrival adapter: the driver's ``events`` table -> trip events with two clocks.

``events`` has one clock and no trips, so every query starts from this deterministic
mapping (integer arithmetic only, so any SQL engine reproduces it exactly):

* event ``e`` belongs to trip ``t = e - e % 2``; even ids start a trip, odd ids end it;
* zones, delay class and delay come from fixed modular hashes of ``t`` and ``e``;
* ``processing_time = event_time + delay``; every 997th event has no event time;
* trips whose first event is on or after the schema-v2 day carry a surge multiplier.

Operands are reduced modulo the prime before they are multiplied, which keeps
every product far inside BIGINT for any id (same residues, so the same result).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lateflow.functions.timecols import epoch_us
from lateflow.schemas import EVENT_NAMES

# Fixed values of the adapter.
ZONE_PRIME = 10009
DELAY_PRIME = 10007
MISSING_TIME_EVERY = 997
SCHEMA_V2_FROM_US = 1704326400000000  # 2024-01-04T00:00:00Z
TUNNEL_ZONE_NUMBERS = (3, 4)
# (class, upper bound of h for tunnel zones, upper bound of h elsewhere), h in 0..99
DELAY_CLASS_CUTS = [("on_time", 45, 86), ("out_of_order", 55, 94), ("late", 97, 99)]
# delay seconds per class: (offset, modulus, multiplier) -> offset + (e * multiplier) % modulus
DELAY_SECONDS = {"on_time": (1, 3, 1), "out_of_order": (5, 86, 1), "late": (120, 781, 1),
                 "very_late": (3600, 18001, 31)}
PICKUP_HASH = (17, 7919)
DROPOFF_HASH = (13, 104729)
DELAY_HASH = (31, 7919)


def _mod_hash(x, prime: int, a: int, b: int):
    """(x*x*a + x*b) % prime for x >= 0, overflow-free."""
    r = F.pmod(x, F.lit(prime))
    return F.pmod(r * r * F.lit(a) + r * F.lit(b), F.lit(prime))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def trip_events(spark: SparkSession, sf_dir: str, annotate: bool = True) -> DataFrame:
    """Trip events (EVENT_SCHEMA columns) derived from ``events`` at ``sf_dir``."""
    return adapt(read_events(spark, sf_dir), annotate=annotate)


def adapt(events: DataFrame, annotate: bool = True) -> DataFrame:
    e = F.col("event_id")
    t = e - F.pmod(e, F.lit(2))
    df = events.select(
        e.alias("_e"), t.alias("_t"), epoch_us("ts").alias("_et0"),
        F.col("user_id"), F.col("value"))
    # A trip's schema version is fixed by its first event. The per-trip window runs on
    # the five source columns, so nothing derived crosses its shuffle (groups of at most
    # two rows: skew-free); queries that need no version prune it away entirely.
    df = df.withColumn("_trip_first", F.min("_et0").over(Window.partitionBy("_t")))
    e, t = F.col("_e"), F.col("_t")
    started = F.pmod(e, F.lit(2)) == 0
    pick_no = F.lit(1) + F.pmod(_mod_hash(t, ZONE_PRIME, *PICKUP_HASH), F.lit(8))
    drop_no = F.lit(1) + F.pmod(_mod_hash(t, ZONE_PRIME, *DROPOFF_HASH), F.lit(8))
    h = F.pmod(_mod_hash(e, DELAY_PRIME, *DELAY_HASH), F.lit(100))
    df = df.select(
        "*", pick_no.alias("_pick"), drop_no.alias("_drop"), h.alias("_h"),
        started.alias("_started"))
    zone_no = F.when(F.col("_started"), F.col("_pick")).otherwise(F.col("_drop"))
    tunnel = zone_no.isin(*TUNNEL_ZONE_NUMBERS)
    # class index = number of cuts at or below h (0 on_time .. 3 very_late); kept as
    # small arithmetic so the expression stays compact when Catalyst inlines it.
    idx = None
    for _, tunnel_cut, other_cut in DELAY_CLASS_CUTS:
        step = (F.col("_h") >= F.when(tunnel, F.lit(tunnel_cut))
                .otherwise(F.lit(other_cut))).cast("int")
        idx = step if idx is None else idx + step
    df = df.withColumn("_cls", idx + F.lit(1))
    names = [name for name, *_ in DELAY_CLASS_CUTS] + ["very_late"]
    delays = [F.lit(offset) + F.pmod(F.pmod(e, F.lit(modulus)) * F.lit(mult), F.lit(modulus))
              for offset, modulus, mult in (DELAY_SECONDS[n] for n in names)]
    df = (df.withColumn("_class", F.element_at(F.array(*[F.lit(n) for n in names]),
                                               F.col("_cls")))
            .withColumn("_delay", F.element_at(F.array(*delays), F.col("_cls"))))

    v2 = F.col("_trip_first") >= F.lit(SCHEMA_V2_FROM_US)
    surge = F.when(v2, F.lit(1.0) + F.lit(0.25) * F.pmod(t, F.lit(9)).cast("double"))
    km = (F.col("value").cast("decimal(12,2)") * F.lit("0.25").cast("decimal(3,2)"))
    surge_dec = F.coalesce(surge.cast("decimal(6,2)"), F.lit(1).cast("decimal(6,2)"))
    fare = F.round((F.lit("2.50").cast("decimal(4,2)")
                    + F.lit("1.35").cast("decimal(4,2)") * km) * surge_dec, 2)
    completed = ~F.col("_started")
    out = df.select(
        e.cast("string").alias("event_id"),
        F.when(F.col("_started"), F.lit("trip_started")).otherwise(F.lit("trip_completed"))
        .alias("event_type"),
        F.when(v2, F.lit(2)).otherwise(F.lit(1)).cast("int").alias("schema_version"),
        F.when(F.pmod(e, F.lit(MISSING_TIME_EVERY)) == 0, F.lit(None).cast("timestamp"))
        .otherwise(F.timestamp_micros(F.col("_et0"))).alias("event_time"),
        F.timestamp_micros(F.col("_et0") + F.lit(1_000_000) * F.col("_delay"))
        .alias("processing_time"),
        t.cast("string").alias("trip_id"),
        F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("driver_id"),
        F.concat(F.lit("Z0"), F.col("_pick").cast("string")).alias("pickup_zone"),
        F.concat(F.lit("Z0"), F.col("_drop").cast("string")).alias("dropoff_zone"),
        F.when(completed, km.cast("double")).alias("distance_km"),
        F.when(completed, fare.cast("double")).alias("fare_usd"),
        surge.alias("surge_multiplier"),
        F.col("_class").alias("_delay_class"),
        F.col("_delay").cast("double").alias("_delay_seconds"),
    )
    if not annotate:
        out = strip_annotations(out)
    return out


def strip_annotations(df: DataFrame) -> DataFrame:
    """Drop ground-truth columns (names starting with ``_``), as a real feed has none."""
    return df.select([c for c in df.columns if not c.startswith("_")])


__all__ = ["trip_events", "adapt", "read_events", "strip_annotations", "EVENT_NAMES"]
