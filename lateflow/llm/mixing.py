"""Mixing sources to target weights by Pfair scheduling.

A source's rows form blocks, in a hashed order. With target weight w, block i (from 0) of
a source is released at floor(i / w) and has its deadline at ceil((i + 1) / w). Of the
released blocks, earliest deadline first takes one in each slot. With weights that sum to
one this meets every deadline, so at every slot each source has had its weight times the
slots, less than one block off.

Up to slot ``horizon`` (the first slot for which a source has no full block left, so at most
the number of blocks) the schedule follows the exact target weights, as fractions. The
driver works it out slot by slot and keeps the source of each slot, two bytes; executors
number the blocks of ``CHUNK`` slots each. Rows are numbered within a source over hash ranges
(cells), so a source with a third of all rows has no task to itself; the schedule is joined
with the table of cells, and rows, which move once, with their cell's slots.

All rows are kept. After the horizon no order can hold all target weights, as a source has
run out. The remaining blocks follow a schedule of weights rounded to multiples of
1 / ``GRAIN`` (each source at least one), which repeats every ``GRAIN`` slots: block i of a
source with q units sits in period i // q at the slot of unit i % q; slots of sources that
ran out stay empty. What holds there is the deviation of less than a block from the rounded
weights, and so from the exact ones in proportion among the sources left, up to the
rounding of 1 / ``GRAIN`` of the slots. With a ``grain`` given, that schedule of rounded
weights is used from the start.

Defined cases: a null source is a source of its own; without given weights a source weighs
its row count to the power ``temper``; a source missing from given weights weighs as the
smallest given; a source of weight zero comes after the horizon; an empty table gives no rows. More than ``grain`` sources are refused.
Equal rows are interchangeable.
"""

from __future__ import annotations

import heapq
import math
from array import array
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateflow.llm.shared import arrow_stage, local_rows, written

BLOCK = 16
#: name of the null source
NULL = "\0null"
GRAIN = 4096
TEMPER = 0.7
#: rows of all sources in one hash range, so that no task numbers many more of one source
CELL_ROWS = 1 << 12
#: slots of the exact schedule in one row of its table
CHUNK = 1 << 14


def units(weights: dict[str | None, float], grain: int = GRAIN) -> dict[str | None, int]:
    """Whole units of 1 / grain for each source, at least one, by largest remainder."""
    if len(weights) > grain:
        raise ValueError(f"{len(weights)} sources need a finer grain than {grain}")
    total = sum(weights.values())
    order = sorted(weights, key=lambda s: (s is not None, s or ""))
    exact = {s: weights[s] / total * (grain - len(weights)) for s in order}
    out = {s: 1 + int(exact[s]) for s in order}
    spare = grain - sum(out.values())
    for s in sorted(order, key=lambda s: -(exact[s] - int(exact[s])))[:spare]:
        out[s] += 1
    return out


def period(share: dict[str | None, int], grain: int = GRAIN) -> list[tuple]:
    """(source, unit, slot, release, deadline) of one period, earliest deadline first."""
    waiting: list[list] = [[] for _ in range(grain)]
    for n, (s, q) in enumerate(share.items()):
        for i in range(q):
            w = Fraction(q, grain)
            release, deadline = int(i / w), -int(-(i + 1) / w // 1)
            waiting[release].append((deadline, n, i, s, release))
    ready, out = [], []
    for slot in range(grain):
        for item in waiting[slot]:
            heapq.heappush(ready, item)
        deadline, _, i, s, release = heapq.heappop(ready)
        out.append((s, i, slot, release, deadline))
    return out


def exact(weights: list) -> list[int]:
    """The weights as whole numbers in the same proportion."""
    parts = [Fraction(w) for w in weights]
    scale = math.lcm(*(p.denominator for p in parts))
    return [int(p * scale) for p in parts]


def schedule(weights: list[int], blocks: list[int]) -> array:
    """Source (its place in the list) of each slot, earliest deadline first, up to the first
    slot whose source has none of its ``blocks`` left."""
    total, out = sum(weights), array("H")
    waiting = [(0, n) for n, w in enumerate(weights) if w > 0]  # by release
    ready: list[tuple[int, int]] = []  # by deadline
    done = [0] * len(weights)
    while waiting or ready:
        while waiting and waiting[0][0] <= len(out):
            n = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(done[n] + 1) * total // weights[n]), n))
        n = heapq.heappop(ready)[1]
        if done[n] >= blocks[n]:
            break
        out.append(n)
        done[n] += 1
        heapq.heappush(waiting, (done[n] * total // weights[n], n))
    return out


def _placed(spark, slots: array, weights: list[int]) -> DataFrame:
    """_n (source), block, _slot, _first (release) and _last (deadline) of the schedule."""
    chunks, done = [], [0] * len(weights)
    for at in range(0, len(slots), CHUNK):
        part = slots[at:at + CHUNK]
        chunks.append((at, list(done), part.tobytes()))
        for n in part:
            done[n] += 1
    total = sum(weights)

    def stage(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            part, seen, out = array("H"), row["done"], []
            part.frombytes(row["part"])
            for slot, n in enumerate(part, row["at"]):
                i, w = seen[n], weights[n]
                seen[n] += 1
                out.append((n, i, slot, i * total // w, -(-(i + 1) * total // w)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)],
                names=["_n", "block", "_slot", "_first", "_last"])

    return arrow_stage(
        local_rows(spark, chunks, {"at": pa.int64(), "done": pa.list_(pa.int64()),
                                   "part": pa.binary()}), stage,
        "_n long, block long, _slot long, _first long, _last long")


def pfair_mix(docs: DataFrame, weights: dict[str | None, float] | None = None,
              block: int = BLOCK, grain: int | None = None, temper: float = TEMPER,
              order: list[str] | None = None) -> DataFrame:
    """``docs`` with block (number within its source), release, deadline, slot, position
    (order within the mix) and in_horizon. Columns of those names are replaced, all others
    stay as they are."""
    spark = docs.sparkSession
    rounded, grain = grain is not None, grain or GRAIN
    docs = docs.drop("block", "release", "deadline", "slot", "position", "in_horizon")
    order = order or [c for c, t in docs.dtypes if c in ("doc_id", "text")]
    # the caller's columns travel in one struct, so that no name of theirs meets one of here
    keys = [f"order{i}" for i in range(len(order))]
    safe = F.coalesce(F.col("source").cast("string"), F.lit(NULL))
    docs = docs.select(F.struct(*docs.columns).alias("row"), safe.alias("name"),
                       *[F.col(c).alias(k) for c, k in zip(order, keys)])
    found = docs.groupBy("name").agg(F.count(F.lit(1)).alias("n")).limit(grain + 1).collect()
    counts = {None if r["name"] == NULL else r["name"]: r["n"] for r in found}
    if weights is None:
        weights = {s: n ** temper for s, n in counts.items()}
    else:
        weights = {s: weights.get(s, min(weights.values(), default=1)) for s in counts}
    share = units(weights, grain) if counts else {}
    names = list(share)
    whole = exact([weights[s] for s in names])
    slots = array("H") if rounded else schedule(whole, [counts[s] // block for s in names])
    taken = [0] * len(names)
    for n in slots:
        taken[n] += 1
    repeat = period(share, grain) if share else []
    horizon = len(slots)
    if rounded:
        ends, at = [], {(s, i): slot for s, i, slot, _, _ in repeat}
        for s, n in counts.items():
            blocks = n // block  # the first block that is missing or not full
            ends.append(blocks // share[s] * grain + at[s, blocks % share[s]])
        horizon = min(ends, default=0)

    # rows of a source are numbered over hash ranges (cells); only these meet the schedule
    cells = 1
    while cells * CELL_ROWS < sum(counts.values()) and cells < 1 << 20:
        cells *= 2
    spread = F.xxhash64(*keys)
    docs = docs.select("*", spread.alias("spread"), F.floor(
        F.shiftrightunsigned(spread, 34) * cells / (1 << 30)).cast("int").alias("cell"))
    before = Window.partitionBy("name").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1)  # at most 2^20 cells of a source, one row each
    offsets = docs.groupBy("name", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        "name", "cell", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = written(_cell_slots(spark, offsets, names, share, taken, repeat, slots, whole,
                                 block, grain), "slots")
    inside = Window.partitionBy("name", "cell").orderBy("spread", *keys)
    # the rows move once to be numbered; the cell's slots are joined on the same keys
    rows = docs.withColumn("rank", F.row_number().over(inside) - 1).join(
        placed, ["name", "cell"])
    number = (F.col("before") + F.col("rank")).cast("long")
    rows = rows.select("row", "slots", number.alias("number"),
                       F.floor(number / block).cast("long").alias("block"))
    own = F.get("slots", (F.col("block") - F.col("slots")[0]["block"]).cast("int"))
    rows = rows.select("row", "number", "block", own.alias("own"))
    return rows.select(
        "row.*", "block", "own.release", "own.deadline", "own.slot",
        (F.col("own.slot") * block + F.col("number") % block).alias("position"),
        (F.col("own.slot") < horizon).alias("in_horizon"))


def _cell_slots(spark, offsets: DataFrame, names: list, share: dict, taken: list[int],
                repeat: list[tuple], slots: array, whole: list[int], block: int,
                grain: int) -> DataFrame:
    """name, cell, before (rows of the source in earlier cells) and slots: the blocks that
    the cell's rows are in, with release, deadline and slot, in order (about a cell's rows
    / ``block`` of them). Blocks beyond the exact schedule follow the repeating one."""
    named = [NULL if s is None else s for s in names]
    # both tables have at most ``grain`` rows
    sizes = F.broadcast(local_rows(
        spark, [(s, n, share[o], taken[n]) for n, (s, o) in enumerate(zip(named, names))],
        {"name": pa.string()} | dict.fromkeys(("source", "q", "taken"), pa.int64())))
    table = F.broadcast(local_rows(
        spark, [(NULL if s is None else s, *rest) for s, *rest in repeat],
        {"name": pa.string()} | dict.fromkeys(("unit", "at", "first", "last"), pa.int64())))
    every = F.sequence(F.floor(F.col("before") / block).cast("long"),
                       F.floor((F.col("before") + F.col("n") - 1) / block).cast("long"))
    blocks = offsets.select("name", "cell", "before", F.explode(every).alias("block")).join(
        sizes, "name")
    rest = F.greatest(F.col("block") - F.col("taken"), F.lit(0))
    blocks = blocks.withColumn("turn", F.floor(rest / F.col("q")).cast("long")).withColumn(
        "unit", rest % F.col("q")).join(table, ["name", "unit"])
    offset = F.col("turn") * grain + len(slots)
    places = {"release": offset + F.col("first"), "deadline": offset + F.col("last"),
              "slot": offset + F.col("at")}
    if len(slots):
        exact_ = _placed(spark, slots, whole).toDF("source", "block", "slot_", "first_", "last_")
        blocks = blocks.join(exact_, ["source", "block"], "left")
        places = {c: F.coalesce(F.col(x), places[c]) for c, x in (
            ("release", "first_"), ("deadline", "last_"), ("slot", "slot_"))}
    return blocks.groupBy("name", "cell").agg(
        F.min("before").alias("before"), F.array_sort(F.collect_list(F.struct(
            "block", *(x.alias(c) for c, x in places.items())))).alias("slots"))
