"""Small helpers of the llm operators: written intermediate tables, Arrow stages, and a
Bloom filter of fixed size."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateflow.session import ensure_checkpoint_dir

U64 = np.uint64


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back: cuts the
    lineage, survives lost executors, and re-reads only the columns asked for."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column that orders its rows as its files, by the number of the task that
    wrote them, hold them. What is read from no files is written first."""
    try:
        meta = df.metadataColumn("_metadata")
        task, number = (F.regexp_extract(meta["file_name"], x, 1).try_cast("long")
                        for x in (r"^part-(\d+)-", r"[.-]c(\d+)\."))
        return df.select("*", F.struct(task.alias("task"), number.alias("number"),
                                       meta["row_index"].alias("row")).alias(name))
    except AnalysisException:
        return in_file_order(written(df, "ordered"), name)


#: bytes of an Arrow batch that is sent to a Python worker, as texts can be long
BATCH_BYTES = 4 << 20
_shipped: set[str] = set()


def _bytes(spark: SparkSession, text: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each application: Spark's own
    file server carries the archive, so executors need no copy of the repository. Arrow
    batches of the session are set to about ``BATCH_BYTES`` (a whole row at least), unless
    it asks for fewer already."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(spark, spark.conf.get(limit)) > BATCH_BYTES:
        spark.conf.set(limit, f"{BATCH_BYTES}b")
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="lateflow-")) / "lateflow_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


#: tables that a Python worker keeps from batch to batch, by their modules
kept: list[dict] = []
_stage: list[str] = []


def keeps(table: dict) -> dict:
    """Register a module's table; workers live on from stage to stage, so it is cleared when
    another stage begins."""
    kept.append(table)
    return table


def begin(stage: str) -> None:
    if _stage != [stage]:
        for table in kept:
            table.clear()
        _stage[:] = [stage]


def trim() -> None:
    """Give memory that a task has freed back to the system: an idle worker shares its
    executor's memory with the JVM and the other workers."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def arrow_stage(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
                schema: T.StructType | str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; batches are independent."""
    ship(df.sparkSession)
    name = uuid.uuid4().hex

    def run(batches):
        begin(name)
        try:
            for batch in batches:
                if batch.num_rows:
                    yield from fn(batch)
        finally:
            trim()

    return df.mapInArrow(run, schema)


def local_rows(spark: SparkSession, rows: list[tuple], fields: dict[str, pa.DataType]) -> DataFrame:
    """A few rows of the driver as a DataFrame. They go as an Arrow table: from a list, Spark
    would have Python workers of another kind unpickle them, which executors then keep beside
    those of the Arrow stages."""
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.table(
        [pa.array(list(c), kind) for c, kind in zip(columns, fields.values())],
        names=list(fields)))


def held(column: str, divisor: int):
    """crc32(column as text) mod divisor; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % F.lit(divisor)


class Bloom:
    """A Bloom filter over 64-bit hashes. Its size is fixed by ``bits`` (a power of two),
    so it can always be sent to the executors: with more keys it lets more rows through,
    and the exact join behind it does the rest."""

    PROBES = 3

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = U64(len(words) * 64 - 1)

    @staticmethod
    def build(keys: DataFrame, column: str, bits: int = 1 << 25) -> "Bloom":
        h = F.col(column)
        spots = F.array(*[F.shiftrightunsigned(h, 7 * i).bitwiseAND(F.lit(bits - 1))
                          for i in range(Bloom.PROBES)])
        packed = (keys.select(F.explode(spots).alias("p"))
                  .groupBy(F.shiftright("p", 6).alias("w"))
                  .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b")))
        got = packed.toArrow()  # at most bits / 64 rows
        words = np.zeros(bits // 64, dtype=U64)
        words[got["w"].to_numpy()] = got["b"].to_numpy().view(U64)
        return Bloom(words)

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Which of the uint64 hashes may be among the keys."""
        out = self._probe(h, 0)
        left = np.flatnonzero(out)
        if 2 * len(left) < len(h):  # most are out: the others alone go on
            out[left] = self._rest(h[left])
            return out
        return out & self._rest(h)

    def _rest(self, h: np.ndarray) -> np.ndarray:
        out = self._probe(h, 1)
        for i in range(2, self.PROBES):
            out &= self._probe(h, i)
        return out

    def _probe(self, h: np.ndarray, i: int) -> np.ndarray:
        p = (h >> U64(7 * i)) & self.mask
        return ((self.words[(p >> U64(6)).astype(np.int64)] >> (p & U64(63))) & U64(1)) == 1


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, for a helper column (names are compared as
    Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
