"""Partitioned Parquet tables whose columns come from their files, and partitions that Spark
overwrites.

A column that appears with newer data is in the files from the first partition that has a
value for it; older files stay as they are and read it as null. What columns a table had up
to a partition is what Spark merges from those files' schemas. A partition is replaced by
dynamic partition overwrite, which touches no file of any other partition, the null
partition included.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateflow.sources.fs import HadoopFS


def write_evolving(rows: DataFrame, path: str, partition: str, evolving: str) -> None:
    """Append ``rows`` by partition; the files of partitions before the first one with a
    value of ``evolving`` do not have the column. Partitions are dates, read in their order."""
    first = rows.filter(F.col(evolving).isNotNull()).agg(F.min(partition)).first()[0]
    has = F.lit(False) if first is None else F.coalesce(F.col(partition) >= F.lit(first), F.lit(False))
    out = dict(partitionBy=partition, mode="append")
    rows.filter(~has).drop(evolving).write.parquet(path, **out)
    if first is not None:
        rows.filter(has).write.parquet(path, **out)


def read_merged(spark: SparkSession, path: str, upto: dt.date | None = None,
                partition: str | None = None) -> DataFrame:
    """The table with every column that any of its files has; with ``upto``, only the
    partitions up to that date, and the columns of their files."""
    reader = spark.read.option("mergeSchema", "true").option("basePath", path)
    if upto is None:
        return reader.parquet(path)
    prefix = f"{partition}="
    names = [n for n in HadoopFS(spark).list_names(path, dirs_only=True) if n.startswith(prefix)]
    return reader.parquet(*[f"{path}/{n}" for n in names if n[len(prefix):] <= upto.isoformat()])


def overwrite_partitions(rows: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that ``rows`` has rows of, and no other."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def fingerprint(rows: DataFrame, partition: str) -> DataFrame:
    """partition, n and a hash of all rows of each partition, whatever their order."""
    every = F.xxhash64(*[F.col(c) for c in sorted(rows.columns)])
    return rows.groupBy(partition).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(every).alias("x"),
        F.sum(F.pmod(every, F.lit(1_000_003))).alias("s"))


def changed_partitions(before: DataFrame, after: DataFrame, partition: str) -> DataFrame:
    """Per partition (null included): rows before and after, and whether it is untouched."""
    a, b = fingerprint(before, partition).alias("a"), fingerprint(after, partition).alias("b")
    joined = a.join(b, F.col(f"a.{partition}").eqNullSafe(F.col(f"b.{partition}")), "full")
    same = (F.col("a.n") == F.col("b.n")) & (F.col("a.x") == F.col("b.x")) & (
        F.col("a.s") == F.col("b.s"))
    return joined.select(
        F.coalesce(f"a.{partition}", f"b.{partition}").alias("partition"),
        F.coalesce("a.n", F.lit(0)).alias("rows_before"),
        F.coalesce("b.n", F.lit(0)).alias("rows_after"),
        F.coalesce(same, F.lit(False)).alias("untouched"))
