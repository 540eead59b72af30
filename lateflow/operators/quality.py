"""Stream-quality checks over landed trip events and the published windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateflow.functions.timecols import epoch_us, floor_div
from lateflow.functions.trips import delay_band, event_zone, fare_usd, surge_step, zone_dim
from lateflow.plans.scan import materialize, prefix_scan
from lateflow.schemas import DEFAULT_SLICE_MINUTES, US_PER_MINUTE

ARRIVAL_SLICE_US = DEFAULT_SLICE_MINUTES * US_PER_MINUTE


def stream_summary(trips: DataFrame) -> DataFrame:
    """Event counters in one aggregate pass (grouping sets): per event type, per delay
    class, per schema version, and the total. Columns: kind, key, n."""
    g = trips.groupingSets(
        [["event_type"], ["_delay_class"], ["schema_version"], []],
        "event_type", "_delay_class", "schema_version").agg(
        F.count(F.lit(1)).alias("n"),
        F.grouping("event_type").alias("_g1"), F.grouping("_delay_class").alias("_g2"),
        F.grouping("schema_version").alias("_g3"))
    kind = (F.when(F.col("_g1") == 0, F.lit("event_type"))
            .when(F.col("_g2") == 0, F.lit("delay_class"))
            .when(F.col("_g3") == 0, F.lit("schema_version")).otherwise(F.lit("events")))
    key = (F.when(F.col("_g1") == 0, F.col("event_type"))
           .when(F.col("_g2") == 0, F.col("_delay_class"))
           .when(F.col("_g3") == 0, F.col("schema_version").cast("string")).otherwise("all"))
    return g.select(kind.alias("kind"), key.alias("key"), "n")


#: rows of a cell of the arrival scan, about
CELL_ROWS = 1 << 16
_SUBS = 1 << 20  # cells of one slice at most


def running_max(rows: DataFrame, key: str, tie: str, value: str, width: int,
                cell_rows: int = CELL_ROWS) -> DataFrame:
    """Adds prev_max_us: the greatest ``value`` of the rows before, by the long ``key`` and
    then ``tie`` (together unique). Rows without a key come first.

    A carry scan that writes no row of the input: rows are counted for each slice of ``width``
    of the key; a slice of more than ``cell_rows`` rows is cut into equal ranges of its own
    span; the greatest value of each cell and the prefix maximum over the cells (a table of
    cells) give every cell its carry; inside a cell an ordinary window does the rest. A cell
    exceeds its size only where rows are much denser than in the rest of the slice: rows that
    share one key are not parted.
    """
    slice_ = F.coalesce(floor_div(key, width), F.lit(-(1 << 42)))
    sliced = rows.withColumn("_slice", slice_)
    sizes = materialize(sliced.groupBy("_slice").agg(
        F.least(F.ceil(F.count(F.lit(1)) / cell_rows), F.lit(_SUBS)).cast("long").alias("_cells"),
        F.min(key).alias("_lo"), F.max(key).alias("_hi")))
    span = F.col("_hi") - F.col("_lo") + 1
    sub = F.coalesce(F.expr("(`%s` - _lo) * _cells div (_hi - _lo + 1)" % key), F.lit(0))
    celled = sliced.join(sizes, "_slice").withColumn(
        "_cell", F.col("_slice") * _SUBS + F.when(span > 1, sub).otherwise(0)).drop(
        "_slice", "_cells", "_lo", "_hi")
    most = materialize(celled.groupBy("_cell").agg(F.max(value).alias("_most")))
    carry = prefix_scan(most, "_cell", "_most", 4096 * _SUBS).select(
        "_cell", F.col("prev_max").alias("_carry"))
    w = Window.partitionBy("_cell").orderBy(key, tie).rowsBetween(Window.unboundedPreceding, -1)
    return (celled.withColumn("_own", F.max(value).over(w)).join(carry, "_cell")
            .withColumn("prev_max_us", F.greatest("_own", "_carry"))
            .drop("_cell", "_own", "_carry"))


def _clocks(trips: DataFrame) -> DataFrame:
    return trips.select("event_id", epoch_us("processing_time").alias("pt_us"),
                        epoch_us("event_time").alias("et_us"))


def out_of_order(trips: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Events whose event time is below the max event time of everything that arrived
    before them (arrival order = processing_time, then event_id)."""
    seen = running_max(_clocks(trips), "pt_us", "event_id", "et_us", ARRIVAL_SLICE_US, cell_rows)
    return seen.select("event_id", "pt_us", "et_us", "prev_max_us",
                       F.coalesce(F.col("et_us") < F.col("prev_max_us"), F.lit(False))
                       .alias("out_of_order"))


def trip_pairs(trips: DataFrame) -> DataFrame:
    """Every trip should have exactly one start and one completion."""
    per_trip = trips.groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "trip_started").alias("starts"),
        F.count_if(F.col("event_type") == "trip_completed").alias("ends"))
    ok = (F.col("n") == 2) & (F.col("starts") == 1) & (F.col("ends") == 1)
    return per_trip.agg(F.count(F.lit(1)).alias("trips"),
                        F.count_if(ok).alias("complete_pairs"),
                        F.count_if(~ok).alias("incomplete"))


def duplicate_windows(counts: DataFrame) -> DataFrame:
    """Each (window_start, zone) must be published once: rows vs distinct keys."""
    per_key = counts.groupBy("window_start", "zone").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
                       F.count(F.lit(1)).alias("distinct_keys"),
                       F.count_if(F.col("n") > 1).alias("duplicated_keys"))


def late_rate_tunnel(trips: DataFrame) -> DataFrame:
    """Share of events in the ``late`` delay class, tunnel zones vs the rest (zone of
    the event: pickup for a start, dropoff for a completion)."""
    zones = zone_dim(trips.sparkSession)
    ev = trips.select(event_zone().alias("zone"), "_delay_class")
    return (ev.join(zones, "zone", "left")
            .groupBy(F.coalesce("is_tunnel", F.lit(False)).alias("is_tunnel"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count_if(F.col("_delay_class") == "late").alias("late"))
            .withColumn("late_rate", F.col("late") / F.col("events")))


def arrival_order_check(rows: DataFrame, key: str, tie: str, time: str, width: int) -> DataFrame:
    """Each row of a frame in the order it landed (long ``key``, then ``tie``): whether its
    ``time`` is no earlier than that of every row before it."""
    seen = running_max(rows, key, tie, time, width)
    return seen.withColumn("in_order", F.coalesce(F.col(time) >= F.col("prev_max_us"), F.lit(True)))


def delay_bands(trips: DataFrame) -> DataFrame:
    """Observed arrival delay classified into bands, against the injected class."""
    seconds = (epoch_us("processing_time") - epoch_us("event_time")) / F.lit(1_000_000.0)
    return (trips.select(delay_band(seconds).alias("observed_band"),
                         F.col("_delay_class").alias("delay_class"))
            .groupBy("observed_band", "delay_class").agg(F.count(F.lit(1)).alias("n")))


def fare_quote(trips: DataFrame) -> DataFrame:
    """Fare from distance and surge (surge capped, quarter steps), for completions."""
    done = trips.filter(F.col("event_type") == "trip_completed")
    surge = surge_step(F.col("surge_multiplier"))
    return done.select("event_id", "distance_km", surge.alias("surge"),
                       fare_usd("distance_km", surge).alias("fare_usd"))
