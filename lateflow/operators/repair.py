"""Rebuilding and comparing one day of the counted windows.

``recount`` is the incident on purpose: a day rebuilt from its late trips alone. Putting it
in place of the day loses what was counted on time; comparing versions shows the loss, and
restoring the version before it undoes it. The right repair adds late trips to the counted
ones (``ReplayLedger.additive_correction``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateflow.functions.timecols import date_of_us, epoch_us


def recount(late: DataFrame, day, stamp: Column) -> DataFrame:
    """Counted-window rows of the windows that start on ``day``, from late trips only. The
    day is the window's: a window and its rows stay in one partition."""
    window_day = date_of_us(epoch_us("window_start"))
    return (late.filter((F.col("event_type") == "trip_started") & (window_day == F.lit(day)))
            .groupBy("window_start", "window_end", F.col("pickup_zone").alias("zone"))
            .agg(F.count(F.lit(1)).alias("trip_count"))
            .withColumns({"avg_surge_multiplier": F.lit(None).cast("double"),
                          "finalized_at_watermark": stamp.cast("timestamp"),
                          "batch_id": F.lit(-1).cast("long"), "window_date": window_day}))


def zone_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Trips per zone in two sets of counted windows, the loss, and a TOTAL row. A null
    zone is a zone (shown as null): only the rollup's own row is the total."""
    sides = before.select("zone", F.col("trip_count").alias("before"),
                          F.lit(0).cast("long").alias("after")).unionByName(
        after.select("zone", F.lit(0).cast("long").alias("before"),
                     F.col("trip_count").alias("after")))
    total = sides.rollup("zone").agg(F.grouping("zone").alias("all"),
                                     F.sum("before").cast("long").alias("before"),
                                     F.sum("after").cast("long").alias("after"))
    return total.select(F.when(F.col("all") == 1, "TOTAL").otherwise(F.col("zone")).alias("zone"),
                        "before", "after", (F.col("before") - F.col("after")).alias("lost"))


def row_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row (only_left, only_right): rows that one side has more often, in one shuffle."""
    signed = left.withColumn("_n", F.lit(1)).unionByName(
        right.select(*left.columns).withColumn("_n", F.lit(-1)))
    extra = signed.groupBy(*left.columns).agg(F.sum("_n").alias("_n"))
    return extra.agg(
        F.coalesce(F.sum(F.greatest("_n", F.lit(0))), F.lit(0)).cast("long").alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("_n"), F.lit(0))), F.lit(0)).cast("long")
        .alias("only_right"))
