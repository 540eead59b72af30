"""Sharding by extendible hashing.

Rows are keyed by a 60-bit hash of their id. The directory is indexed by hash prefixes: it
starts as one bucket, and only buckets over the byte limit split, on one more bit, until
every bucket fits. A bucket is thus the shortest prefix whose rows fit while its parent's
do not, and shards come out between the limit and what one split leaves.

Scale. Bytes are first summed per fine cell (a prefix long enough that cells are far below
the limit), pre-aggregated before the shuffle; only cells that are over the limit all the
same are summed again by longer prefixes. The buckets come from sums of cells over all
shorter prefixes, again by grouping: those that fit and whose parent does not. Rows meet a
table of the prefixes as long as the longest bucket among the cells (mostly a few a bucket,
where cells are dozens; never more than the cells). Every join says how it is done: a side
is sent to the executors if it was counted and has at most ``SENT`` rows, else both sides
are sorted, since the bytes of a file say little about the rows (hash ranges compress well,
prefixes of all lengths are many times their cells). Rows that no bit can part (equal
hashes) overflow into pages of the bucket, numbered over partitions, so that repeated rows
don't meet in one task; a single row over the limit has its own page.

Defined cases: a null text has 0 bytes; a null id is a key like any other; an empty table
has no shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateflow.llm.shared import unused, written

BITS = 60
LIMIT = 256 << 20
#: a fine cell holds about this part of a shard
FINE = 64
#: a side of a join of at most so many rows goes to the executors (some 100 bytes a row there
#: and on the driver)
SENT = 1 << 17


def key_hash(column: str) -> Column:
    """The first 60 bits of the md5 of the id as text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(h, depth):
    h, depth = (F.col(x) if isinstance(x, str) else x for x in (h, depth))
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def _key(cell, depth):
    """One number for a prefix and its depth: its bits behind a 1."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftleft", F.lit(1).cast("long"), depth.cast("int")) + cell


def _side(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has so many rows, as the smaller side of a join."""
    return F.broadcast(df) if rows <= SENT else df.hint("merge")


def buckets(cells: DataFrame, limit: int) -> DataFrame:
    """depth, prefix and total of the buckets: the shortest prefixes within the limit, and
    those that no bit can part; ``cells`` has cell, at (the cell's depth) and bytes."""
    every = cells.select("at", "cell", "bytes",
                         F.explode(F.sequence(F.lit(0), "at")).alias("depth"))
    every = every.withColumn("prefix", F.call_function(
        "shiftright", F.col("cell"), (F.col("at") - F.col("depth")).cast("int")))
    sums = written(every.groupBy("depth", "prefix").agg(F.sum("bytes").alias("total")), "sums")
    split = sums.filter(F.col("total") > limit).select(
        (F.col("depth") + 1).alias("depth"),
        F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"))
    split = split.union(cells.sparkSession.range(1).select(
        F.lit(0).alias("depth"), F.col("id").alias("prefix")))
    fits = sums.filter((F.col("total") <= limit) | (F.col("depth") == BITS))
    return fits.join(split.hint("merge"), ["depth", "prefix"], "left_semi")


def directory(cells: DataFrame, levels: list[int], limit: int) -> tuple[DataFrame, list[int]]:
    """key, depth and total: for the cells of each level all their prefixes of one depth, with
    the bucket that each is in; and these depths. A level's depth is that of its longest
    bucket, so that most buckets have few of them."""
    found = written(buckets(cells, limit), "buckets")
    counts = {r["depth"]: r["n"] for r in found.groupBy("depth").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # at most BITS + 1 rows
    known = _side(found.select(_key(F.col("prefix"), F.col("depth")).alias("bucket"), "depth",
                               "total"), sum(counts.values()))
    ends, parts = [], None
    for before, at in zip([-1, *levels], levels):
        depths = [d for d in counts if before < d <= at] or [at]
        end = max(depths)
        ends.append(end)
        near = cells.filter(F.col("at") == at).select(F.call_function(
            "shiftright", F.col("cell"), F.lit(at - end)).alias("c")).distinct()
        tried = near.select("c", F.explode(F.array(*map(F.lit, sorted(depths)))).alias("d"))
        part = tried.withColumn("bucket", _key(F.call_function(
            "shiftright", F.col("c"), (F.lit(end) - F.col("d")).cast("int")), F.col("d"))).join(
            known, "bucket").select(_key(F.col("c"), end).alias("key"), "depth", "total")
        parts = part if parts is None else parts.union(part)
    return written(parts, "directory"), ends


def extendible_shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes, depth, prefix (of depth bits), page (0 but for overflow),
    shard_bytes and shard (text: prefix bits and page). Such columns are replaced."""
    docs = docs.drop("n_bytes", "depth", "prefix", "page", "shard_bytes", "shard")
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    # the caller's columns go by number, so that no name of theirs meets one of here; those
    # that nobody asks for are not read
    names = [f"c{i}" for i in range(len(docs.columns))]
    keyed = docs.select("*", size.alias("n_bytes"), key_hash("doc_id").alias(
        unused(docs, "_h"))).toDF(*names, "n_bytes", "_h")
    slim = keyed.select("_h", "n_bytes")
    total = slim.agg(F.sum("n_bytes")).first()[0] or 0
    depth = 0
    while depth < BITS and (limit << depth) < total * FINE:
        depth += 1
    levels, rows, leaves, cuts = [], slim, None, []
    while True:  # mostly once; again only for cells over the limit
        cells = written(rows.groupBy(_prefix("_h", F.lit(depth)).alias("cell")).agg(
            F.sum("n_bytes").alias("bytes")), "cells")
        levels.append(depth)
        over = cells.filter(F.col("bytes") > limit).select(F.col("cell").alias("_c"))
        many = 0 if depth == BITS else over.count()
        part = (cells.filter(F.col("bytes") <= limit) if many else cells).select(
            "cell", F.lit(depth).alias("at"), "bytes")
        leaves = part if leaves is None else leaves.union(part)
        if not many:
            break
        cuts.append(_side(over, many))
        rows = slim.join(cuts[-1], _prefix("_h", F.lit(depth)) == F.col("_c"), "left_semi")
        depth = min(BITS, depth + 12)
    found, ends = directory(leaves, levels, limit)
    out = keyed.withColumn("_key", _key(_prefix("_h", F.lit(ends[0])), ends[0]))
    for at, end, cut in zip(levels, ends[1:], cuts):
        out = out.join(cut, _prefix("_h", F.lit(at)) == F.col("_c"), "left").withColumn(
            "_key", F.when(F.col("_c").isNotNull(), _key(_prefix("_h", F.lit(end)), end))
            .otherwise(F.col("_key"))).drop("_c")
    found = found.withColumnsRenamed({"key": "_key", "total": "bucket_bytes"})
    out = out.join(_side(found, found.count()), "_key").withColumn(
        "prefix", _prefix("_h", F.col("depth")))
    plain = out.filter(F.col("bucket_bytes") <= limit).withColumn("page", F.lit(0).cast("long"))
    both = plain.select(*names, "n_bytes", "depth", "prefix", "page",
                        F.col("bucket_bytes").alias("shard_bytes"))
    if levels[-1] == BITS:
        # written, so that the partition numbers are the same for counts and rows
        paged = _paged(written(out.filter(F.col("bucket_bytes") > limit).withColumn(
            "_part", F.spark_partition_id()), "overflow"), limit)
        both = both.union(paged.select(*names, "n_bytes", "depth", "prefix", "page",
                                       "shard_bytes"))
    bits = F.when(F.col("depth") > 0, F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2),
                                             F.col("depth"), F.lit("0"))).otherwise(F.lit(""))
    return both.select(
        *[F.col(c).alias(name) for c, name in zip(names, docs.columns)], "n_bytes", "depth",
        "prefix", "page", "shard_bytes",
        F.concat(bits, F.lit("-"), F.col("page").cast("string")).alias("shard"))


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Overflow pages of buckets whose rows have one hash: rows are sized in whole units of
    the largest row, and numbered over input partitions."""
    counts = rows.groupBy("prefix", "_part").agg(F.count(F.lit(1)).alias("_n"),
                                                 F.max("n_bytes").alias("_m"))
    before = Window.partitionBy("prefix").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    most = counts.groupBy("prefix").agg(F.max("_m").alias("_most"))
    counts = written(counts.withColumn("_b", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop(
        "_n", "_m").join(most.hint("merge"), "prefix"), "counts")
    inside = Window.partitionBy("prefix", "_part").orderBy(F.col("n_bytes").desc())
    rows = rows.withColumn("_r", F.row_number().over(inside) - 1).join(
        _side(counts, counts.count()), ["prefix", "_part"])
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("_most"), F.lit(1))))
    rows = rows.withColumn("page", F.floor((F.col("_b") + F.col("_r")) / each).cast("long"))
    sums = written(rows.groupBy("prefix", "page").agg(F.sum("n_bytes").alias("shard_bytes")),
                   "pages")
    return rows.join(_side(sums, sums.count()), ["prefix", "page"])
