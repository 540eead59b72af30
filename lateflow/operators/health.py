"""Health signals over the published counts and the late side output.

* side-output volume: late trips / (counted + late trips), by zone and by day;
* window completeness: counted / (counted + late) per (window, zone).

Inputs are the two tables in sink form: ``counts`` (zone_window_counts) and
``late`` (late_events). Only ``trip_started`` rows count as trips. Rows with a null
grouping key are left out of a grouping (no null zone, window or day group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateflow.functions.timecols import epoch_us
from lateflow.plans.rank import exact_median

COUNTED_TYPE = "trip_started"


def late_trips(late: DataFrame) -> DataFrame:
    """Late trip starts with zone, window start (micros) and arrival delay in minutes."""
    return (late.filter(F.col("event_type") == F.lit(COUNTED_TYPE))
            .withColumn("zone", F.col("pickup_zone"))
            .withColumn("window_start_us", epoch_us("window_start"))
            .withColumn("arrival_delay_min",
                        (epoch_us("processing_time") - epoch_us("event_time"))
                        / F.lit(60_000_000.0)))


def late_share(counted: str, late: str):
    """Percent late, one decimal, half-even; null when there is nothing at all."""
    total = F.col(counted) + F.col(late)
    return F.bround(F.try_divide(F.lit(100.0) * F.col(late), total), 1)


def late_by_zone(counts: DataFrame, late: DataFrame) -> DataFrame:
    """Counted and late trips per zone, late share, median arrival delay of late trips."""
    counted = counts.groupBy("zone").agg(F.sum("trip_count").alias("counted"))
    lt = late_trips(late).filter(F.col("zone").isNotNull())
    per_zone = lt.groupBy("zone").agg(F.count(F.lit(1)).alias("late"))
    # exact median without holding a (possibly hot) zone in one aggregation buffer
    median = exact_median(lt, ["zone"], "arrival_delay_min", "event_id", "_median")
    per_zone = per_zone.join(median, "zone", "left").withColumn(
        "median_delay_min", F.bround("_median", 0)).drop("_median")
    return (counted.join(per_zone, "zone", "full_outer")
            .select("zone",
                    F.coalesce("counted", F.lit(0)).cast("long").alias("counted"),
                    F.coalesce("late", F.lit(0)).cast("long").alias("late"),
                    "median_delay_min")
            .withColumn("late_pct", late_share("counted", "late"))
            .select("zone", "counted", "late", "late_pct", "median_delay_min"))


def delay_class_counts(late: DataFrame) -> DataFrame:
    """How late the late trips were, by injected delay class (non-null, most first)."""
    return (late_trips(late).filter(F.col("_delay_class").isNotNull())
            .groupBy(F.col("_delay_class").alias("delay_class"))
            .agg(F.count(F.lit(1)).alias("n")))


def window_completeness(counts: DataFrame, late: DataFrame) -> DataFrame:
    """One row per (window, zone) with any trip, on time or late."""
    counted = counts.select(epoch_us("window_start").alias("window_start_us"), "zone",
                            F.col("trip_count").alias("counted"))
    lt = (late_trips(late)
          .filter(F.col("window_start_us").isNotNull() & F.col("zone").isNotNull())
          .groupBy("window_start_us", "zone").agg(F.count(F.lit(1)).alias("late")))
    return (counted.join(lt, ["window_start_us", "zone"], "full_outer")
            .select("window_start_us", "zone",
                    F.coalesce("counted", F.lit(0)).cast("long").alias("counted"),
                    F.coalesce("late", F.lit(0)).cast("long").alias("late"))
            .withColumn("completeness", F.try_divide(
                F.col("counted").cast("double"), (F.col("counted") + F.col("late")))))


def zone_health(completeness: DataFrame) -> DataFrame:
    """Per zone: windows, incomplete windows, never-published windows, mean completeness."""
    return completeness.groupBy("zone").agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(F.col("completeness") < 1).alias("incomplete"),
        F.count_if(F.col("counted") == 0).alias("missing"),
        F.bround(F.avg("completeness"), 3).alias("mean_completeness"))


def daily_health(counts: DataFrame, late: DataFrame) -> DataFrame:
    """Per UTC day: counted trips (by window date), late trips (by event date), late %."""
    counted = (counts.filter(F.col("window_date").isNotNull())
               .groupBy(F.col("window_date").alias("day"))
               .agg(F.sum("trip_count").alias("counted")))
    lt = (late_trips(late).filter(F.col("event_date").isNotNull())
          .groupBy(F.col("event_date").alias("day")).agg(F.count(F.lit(1)).alias("late")))
    return (counted.join(lt, "day", "full_outer")
            .select("day", F.coalesce("counted", F.lit(0)).cast("long").alias("counted"),
                    F.coalesce("late", F.lit(0)).cast("long").alias("late"))
            .withColumn("late_pct", late_share("counted", "late")))


def worst_windows(completeness: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` incomplete windows by (window start, zone): a top-k report."""
    return (completeness.filter(F.col("completeness") < 1)
            .orderBy("window_start_us", "zone").limit(n))


def latest_windows(counts: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` rows of the snapshot ordered by (window start, zone)."""
    return counts.orderBy(F.col("window_start").desc(), F.col("zone").desc()).limit(n)


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Grouped row count; order it with ``order_count_by`` (count desc, keys as text)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def order_count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    # a null key sorts as the text "None", as a report printing keys would show it
    return df.orderBy(F.col("n").desc(),
                      *[F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in keys])


def late_by_reason(late: DataFrame) -> DataFrame:
    """Side output by reason and injected delay class, '-' when the class is unknown."""
    return (count_by(late, ["late_reason", "_delay_class"])
            .select("late_reason",
                    F.coalesce(F.col("_delay_class"), F.lit("-")).alias("delay_class"), "n"))


def late_trips_by_zone(late: DataFrame) -> DataFrame:
    return count_by(late.filter(F.col("event_type") == F.lit(COUNTED_TYPE)), ["pickup_zone"])


def arrival_delay(late: DataFrame) -> DataFrame:
    return late_trips(late).select("event_id", "zone", "late_reason", "arrival_delay_min")
