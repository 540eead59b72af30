"""Exact order statistics per group without holding a group in one task.

``F.median`` / ``percentile`` keep a group's distinct values in one aggregation buffer,
so a hot group (a third of all rows) would sit in one task's memory. Here:

1. rows are range-partitioned on (group, value, tiebreak): the sampled bounds split a
   hot group, and even a hot value, across balanced partitions; the result is written
   to the checkpoint folder so partition ids are stable;
2. one row per (partition, group) gives each group's row count and, per partition,
   how many of its rows sit in earlier partitions (a table of at most partitions +
   groups rows);
3. a window per (partition, group) - never larger than one balanced partition - gives
   each row its rank inside its group; the wanted ranks are picked with a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateflow.plans.scan import materialize


def ranked(df: DataFrame, groups: list[str], value: str, tiebreak: str,
           partitions: int | None = None) -> DataFrame:
    """Rows with ``_rank`` (0-based position in the group by value, tiebreak) and
    ``_n`` (group size). Null values are left out."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = df.filter(F.col(value).isNotNull()).select(*groups, value, tiebreak)
    parted = materialize(base.repartitionByRange(n, *groups, value, tiebreak)
                         .withColumn("_part", F.spark_partition_id()))
    per_part = parted.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_c"))
    wg = Window.partitionBy(*groups)
    carry = materialize(per_part.select(
        "_part", *groups,
        F.coalesce(F.sum("_c").over(wg.orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_carry"),
        F.sum("_c").over(wg).alias("_n")))
    wl = Window.partitionBy("_part", *groups).orderBy(value, tiebreak)
    return (parted.join(carry, ["_part", *groups])
            .withColumn("_rank", F.col("_carry") + F.row_number().over(wl) - 1)
            .drop("_carry", "_part"))


def exact_median(df: DataFrame, groups: list[str], value: str, tiebreak: str,
                 alias: str = "median") -> DataFrame:
    """Interpolated median per group (the middle value, or the mean of the two middle
    values weighted 0.5 / 0.5), equal to ``percentile(value, 0.5)``."""
    r = ranked(df, groups, value, tiebreak)
    lo = F.floor((F.col("_n") - 1) / 2).cast("long")
    hi = F.ceil((F.col("_n") - 1) / 2).cast("long")
    picked = r.filter((F.col("_rank") == lo) | (F.col("_rank") == hi))
    g = picked.groupBy(*groups).agg(
        F.max(F.when(F.col("_rank") == lo, F.col(value))).alias("_lo"),
        F.max(F.when(F.col("_rank") == hi, F.col(value))).alias("_hi"),
        F.max("_n").alias("_n"))
    return g.select(*groups, F.when(F.col("_n") % 2 == 1, F.col("_lo"))
                    .otherwise(F.lit(0.5) * F.col("_lo") + F.lit(0.5) * F.col("_hi"))
                    .alias(alias))


def positioned(df: DataFrame, order: list[str | Column], name: str = "position",
               partitions: int | None = None) -> DataFrame:
    """The rows with their place (1, 2, ...) in a total order, so that the order is a value
    that can be checked and survives a write.

    Rows are range partitioned by the order and written once; one count for each partition
    gives the places of its first row, and a window inside each partition does the rest.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = materialize(df.repartitionByRange(n, *order)
                         .withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
             .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry")))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (parted.join(carry, "_part")
            .withColumn(name, F.col("_carry") + F.row_number().over(inside))
            .drop("_part", "_carry"))
