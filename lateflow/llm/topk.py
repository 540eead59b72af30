"""Exact top-k inner products over an impact-ordered, score-at-a-time index.

Vectors are integer vectors. Candidates are dealt into blocks by a hash of their id; each
block has, for every dimension, postings ordered by value and cut into segments. For a
query, a segment's quantised impact is the most that its postings can add, above the least
that the dimension adds to any vector of the block, so impacts are never negative. Segments
of all dimensions are processed by descending impact and add it to their postings'
accumulators. At any time, accumulator + the greatest unprocessed impact of every dimension
bounds a vector's score from above; the k-th best of the exact scores seen bounds the
answer from below. Processing stops only when this proves that few vectors are left that
can be among the best; all of those are rescored exactly.

Scale. Queries are a stated set and are compared with all rows in (block, query block)
groups of bounded size, whatever the table's; each returns k rows a query, of which a
window keeps the best k. Nothing is broadcast.

Defined cases: vectors that are null or hold null or non-finite components, and null ids,
take no part. Shorter vectors count as ended by zeros. Rows that repeat an id are queries
and candidates of their own: a query's candidates are all rows but its own one, and a query
id that repeats has an answer for each of its rows. Components and scores have to fit 64-bit
integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateflow.llm.shared import ship, written

BLOCK = 1 << 14
QUERY_BLOCK = 256
SEGMENTS = 16
#: segments processed between two looks at the bounds
STEP = 128


def integer_vectors(df: DataFrame, vec_id: str, embedding: str, scale: int = 1024) -> DataFrame:
    """vec_id and v (array of floor(scale * component)), usable vectors only."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) != float("inf")))
    return (df.filter(F.col(embedding).isNotNull() & F.col(vec_id).isNotNull()).filter(fine)
            .select(F.col(vec_id).cast("long").alias("vec_id"),
                    F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast(
                        "double")).cast("long")).alias("v")))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(size), int(size.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = lists.flatten().to_numpy()
    return out


class ImpactIndex:
    """Postings of a block of vectors, by dimension and descending value, in segments."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors
        self.rows = ids if rows is None else rows
        n, dims = vectors.shape
        order = np.argsort(-vectors, axis=0, kind="stable")
        cut = np.unique(np.linspace(0, n, min(SEGMENTS, n) + 1).astype(np.int64))
        self.first, self.last = cut[:-1], cut[1:]
        ranked = np.take_along_axis(vectors, order, axis=0)
        #: the vectors in a segment of a dimension, one posting list after the other
        self.postings = [np.split(column, cut[1:-1])
                         for column in np.ascontiguousarray(order.T)]
        self.high = ranked[self.first].astype(float)  # [segment, dimension]
        self.low = ranked[self.last - 1].astype(float)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places in the block, scores) of the best k but the row ``own``."""
        n, dims = self.vectors.shape
        most = np.maximum(query * self.high, query * self.low)
        least = np.minimum(query * self.high, query * self.low).min(axis=0)
        impact = most - least  # [segment, dimension], not negative
        turn = np.argsort(-impact, axis=None, kind="stable")
        segment, dim = np.unravel_index(turn, impact.shape)
        ahead_of = np.vstack((-np.sort(-impact, axis=0), np.zeros(dims)))
        base, got = least.sum(), np.zeros(n)
        possible = np.flatnonzero(self.rows != own)
        floor = -np.inf
        for at in range(0, len(turn), STEP):
            s, d = segment[at:at + STEP], dim[at:at + STEP]
            for i, j, x in zip(s.tolist(), d.tolist(), impact[s, d].tolist()):
                got[self.postings[j][i]] += x  # a vector is once in a posting list
            done = np.bincount(dim[:at + STEP], minlength=dims)
            rest = ahead_of[done, np.arange(dims)]  # greatest unprocessed impacts
            bound = base + got[possible] + rest.sum()
            first = min(4 * k, len(possible))
            best = np.argpartition(-bound, first - 1)[:first] if first else []
            exact = self.vectors[possible[best]] @ query
            if len(exact) >= k:
                floor = max(floor, float(np.sort(exact)[-k]))
            possible = possible[bound + 1e-9 * np.abs(bound) + 1 >= floor]
            if len(possible) <= max(8 * k, n // 16):
                break  # whoever is left out is proved not to be among the best k
        scores = self.vectors[possible] @ query
        best = np.lexsort((self.rows[possible], self.ids[possible], -scores))[:k]
        return possible[best], scores[best]


def _search(k: int):
    def search(key, queries: pa.Table, block: pa.Table) -> pa.Table:
        out = ([], [], [], [], [])
        if queries.num_rows and block.num_rows:
            q, v = _matrix(queries["v"]), _matrix(block["v"])
            dims = max(q.shape[1], v.shape[1])
            q, v = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (q, v))
            index = ImpactIndex(block["vec_id"].to_numpy(), v, block["row"].to_numpy())
            for name, own, vector in zip(queries["vec_id"].to_pylist(),
                                         queries["row"].to_pylist(), q):
                at, scores = index.top(vector, own, k)
                out[0].extend([own] * len(at))
                out[1].extend([name] * len(at))
                out[2].extend(index.rows[at].tolist())
                out[3].extend(index.ids[at].tolist())
                out[4].extend(scores.tolist())
        return pa.table([pa.array(x, pa.int64()) for x in out],
                        names=["query_row", "query_id", "row", "vec_id", "score"])

    return search


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates of each query;
    ``vectors`` has vec_id and v, ``is_query`` is a boolean column of it."""
    ship(vectors.sparkSession)
    # numbered before it is written, so that a row's number is the same wherever it is read
    vectors = written(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = vectors.filter(is_query)
    blocks = max(1, -(-vectors.count() // BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    # by the row, so that copies of an id are dealt apart as well
    deal = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    left = queries.select("row", "vec_id", "v", deal(query_blocks, "q").alias("qb"), F.explode(
        F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    right = vectors.select("row", "vec_id", "v", deal(blocks, "b").alias("b"), F.explode(
        F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))
    found = left.groupBy("b", "qb").cogroup(right.groupBy("b", "qb")).applyInArrow(
        _search(k), "query_row long, query_id long, row long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(best)).filter(
        F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"),
                                   "vec_id", "score")
