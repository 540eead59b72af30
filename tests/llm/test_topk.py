"""Exact top-k over the impact-ordered index against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from lateflow.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, v string"


def brute(rows, k):
    fine = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e in rows
            if i is not None and e is not None
            and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for n, (q, v) in enumerate(fine):
        if q % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, e)), i)
                          for m, (i, e) in enumerate(fine) if m != n)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k=10):
    df = spark.createDataFrame([(i, e, "x", "y") for i, e in rows], SCHEMA)
    vectors = topk.integer_vectors(df, "vec_id", "embedding")
    found = topk.exact_top_k(vectors, F.col("vec_id") % 10 == 0, k)
    return sorted(tuple(r) for r in found.collect())


def test_random_clustered_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 60)  # several blocks
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    rng = random.Random(2)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in centres[i % 4]]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 12) for i in range(25)]  # ties
    rows += [(2000, None), (2010, [None] * 12), (2020, [math.nan] * 12), (2030, [math.inf] * 12),
             (None, [1.0] * 12), (2040, []), (2050, [3.0]), (2060, [0.0] * 12)]
    rows += [(20, [0.25] * 12), (20, [-1.0] * 12), (7, [0.5] * 12), (30, rows[30][1])]  # repeats
    assert run(spark, rows) == brute(rows, 10)


def test_few_candidates_and_empty(spark):
    rows = [(0, [1.0, -2.0]), (1, [0.25, 3.0]), (10, [-1.0, 0.001])]
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(100, [1.0]), (100, [3.0])]) == [(100, 1, 100, 3072 * 1024)] * 2


def test_processing_stops_on_proof():
    """With one dominant dimension, most segments are never processed."""
    rng = np.random.default_rng(0)
    vectors = rng.integers(-50, 50, (4000, 32))
    vectors[:, 0] = rng.integers(-100_000, 100_000, 4000)
    index = topk.ImpactIndex(np.arange(4000), vectors)
    query = np.ones(32, dtype=np.int64)
    calls = []

    class Lists(list):
        def __getitem__(self, i):
            calls.append(1)
            return super().__getitem__(i)

    index.postings = Lists(index.postings)
    ids, scores = index.top(query, -1, 10)
    want = np.lexsort((np.arange(4000), -(vectors @ query)))[:10]
    assert ids.tolist() == want.tolist()
    assert len(calls) < index.high.size / 2
