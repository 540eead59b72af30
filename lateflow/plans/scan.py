"""Ordered scans and as-of joins for per-batch metadata.

The replay needs running values in arrival order over *per-batch* rows (one row per
non-empty processing-time slice): the running max event time (the watermark), the
dense batch index, and "first batch whose watermark reaches t" (an as-of lookup).
A window with ORDER BY and no PARTITION BY would pull every row into one task, so
the scans here are two-level:

1. rows are grouped into blocks of a bounded key range; an ordinary partitioned
   window does the in-block scan;
2. one row per block carries the block total; a scan over the block rows (a table of
   at most ``key span / block width`` rows) gives the carry from earlier blocks;
3. the carry is joined back on the block id and combined with the in-block value.

Only blocks that hold rows exist, so an outlier key far away costs one extra row,
never a range expansion.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateflow.functions.timecols import floor_div
from lateflow.session import ensure_checkpoint_dir

def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back: the lineage
    is cut, a lost executor loses nothing, later reads take only the columns they need,
    and the optimizer knows the table's size in bytes when it picks a join."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    _write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def _write(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def prefix_scan(df: DataFrame, key: str, value: str, block_width: int,
                sums: tuple[str, ...] = ()) -> DataFrame:
    """Add, for rows with unique long ``key`` ordered by key:

    * ``prev_max``: max of ``value`` over rows with a smaller key (null if none);
    * ``upto_max``: the same including the row itself;
    * ``idx``: 0-based position of the row (dense index of keys);
    * for each column c of ``sums``, ``upto_c``: its sum up to and including the row.
    Nulls in ``value`` are ignored, as ``max`` does, and count as 0 in sums. ``df`` should be
    cheap to read twice (materialized metadata).

    The carry table has one row per block that holds rows.
    """
    blk = "_scan_blk"
    w = Window.partitionBy(blk).orderBy(key)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0)
    d = (df.withColumn(blk, floor_div(key, block_width))
         .withColumn("_in_prev", F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1)))
         .withColumn("_in_idx", F.row_number().over(w) - 1)
         .select("*", *[F.coalesce(F.sum(c).over(upto), zero).alias(f"_in_{c}") for c in sums]))
    # block totals come from the block-partitioned rows (no further exchange); the carry
    # table has one row per block that holds rows, so it is broadcast
    wb = Window.orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    carry = (d.groupBy(blk).agg(F.max(value).alias("_bmax"), F.count(F.lit(1)).alias("_bn"),
                                *[F.sum(c).alias(f"_b_{c}") for c in sums])
             .select(blk, F.max("_bmax").over(wb).alias("_carry_max"),
                     F.coalesce(F.sum("_bn").over(wb), zero).alias("_carry_n"),
                     *[F.coalesce(F.sum(f"_b_{c}").over(wb), zero).alias(f"_carry_{c}")
                       for c in sums]))
    prev = F.greatest(F.col("_in_prev"), F.col("_carry_max"))
    return (d.join(carry, blk)
            .withColumn("prev_max", prev)
            .withColumn("upto_max", F.greatest(prev, F.col(value)))
            .withColumn("idx", (F.col("_carry_n") + F.col("_in_idx")).cast("long"))
            .select("*", *[(F.col(f"_carry_{c}") + F.col(f"_in_{c}")).alias(f"upto_{c}")
                           for c in sums])
            .drop(blk, "_in_prev", "_in_idx", "_carry_max", "_carry_n",
                  *[f"_{x}_{c}" for c in sums for x in ("in", "carry")]))


def first_at_or_after(queries: DataFrame, qkey: str, steps: DataFrame, skey: str,
                      payload: list[str], block_width: int) -> DataFrame:
    """As-of lookup: for each query key q, min of each payload column over steps
    with ``skey >= q``. Payload columns must grow with ``skey`` (e.g. batch id and
    watermark of a monotone watermark), so the minima belong to the same step.
    Returns ``qkey`` plus the payload columns (null when no step reaches q).
    """
    k, blk = "_asof_key", "_asof_blk"
    qs = queries.select(F.col(qkey).alias(k), *[F.lit(None).cast("long").alias(p)
                                               for p in payload], F.lit(0).alias("_q"))
    ss = steps.select(F.col(skey).alias(k), *[F.col(p).cast("long").alias(p) for p in payload],
                      F.lit(1).alias("_q"))
    u = qs.unionByName(ss).withColumn(blk, floor_div(k, block_width))
    # range frame: rows with an equal key are peers, so a step at exactly q counts.
    w = Window.partitionBy(blk).orderBy(k).rangeBetween(Window.currentRow,
                                                         Window.unboundedFollowing)
    inblock = u.select(k, blk, "_q", *[F.min(p).over(w).alias("_in_" + p) for p in payload])
    wb = Window.orderBy(blk).rowsBetween(1, Window.unboundedFollowing)
    blocks = (u.groupBy(blk).agg(*[F.min(p).alias("_b_" + p) for p in payload])
              .select(blk, *[F.min("_b_" + p).over(wb).alias("_later_" + p) for p in payload]))
    res = inblock.filter(F.col("_q") == 0).join(blocks, blk)
    return res.select(F.col(k).alias(qkey), *[
        F.least(F.col("_in_" + p), F.col("_later_" + p)).alias(p) for p in payload])

