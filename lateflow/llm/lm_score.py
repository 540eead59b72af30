"""Language-model scores: the marginal document probability over a subword lattice.

The model is a unigram over the pieces of a public vocabulary plus a document end. Piece
probabilities start from the vocabulary's own scores (by rank) and are re-estimated by
expectation maximisation over all distinct words of the training documents, weighted by
their counts. A document's score is the log10 of its probability summed over all
segmentations: forward recursion in log space for each distinct word, added up over the
words, times the end's probability.

Beside it stands the add-0.1 word unigram: sum of log10((c + 0.1) / (N + 0.1 (V + 1))).

Scale. Word counts are aggregated within a slice, then by a shuffle of (word, count), so
both grow with distinct words. The forward recursion runs once for each distinct word of
the corpus. The most frequent words (at most ``FREQUENT``, chosen by a count threshold) go
to the executors as a table of fixed size; the other words of a document are joined by
hash, where no key is hot, as each is rare. A word is known by a 64-bit hash.

Defined cases: a null text counts as empty (one token, the end). Documents that are not
held out train the model, a null id included. With no training documents the pieces keep
their first weights and c, N and V are 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateflow.llm import lattice
from lateflow.llm.shared import U64, arrow_stage, written
from lateflow.llm.words import Words, row_slices, text_buffer

FREQUENT = 1 << 18
ROUNDS = 1
ALPHA = 0.1
LN10 = math.log(10)


def _counts(batch: pa.RecordBatch):
    """(hash, word, training count) of each slice's distinct words."""
    held, texts = batch.column(0), batch.column(1)
    for a, b in row_slices(texts, 32 << 20):
        words = Words(*text_buffer(texts.slice(a, b - a)))
        if not len(words):
            continue
        h, first, index = np.unique(words.hash, return_index=True, return_inverse=True)
        train = ~held.slice(a, b - a).to_numpy(zero_copy_only=False)[words.doc]
        n = np.bincount(index, weights=train, minlength=len(h)).astype(np.int64)
        size = words.end[first] - words.start[first]
        at = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
        spots = np.repeat(words.start[first] - at[:-1], size) + np.arange(at[-1])
        spelled = pa.StringArray.from_buffers(
            len(h), pa.py_buffer(at), pa.py_buffer(words.lower[spots]))
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), spelled, pa.array(n)],
                                         names=["h", "word", "c"])


def _expected(vocab: DataFrame, pieces: list[bytes], logp: np.ndarray) -> np.ndarray:
    def stage(batch: pa.RecordBatch):
        use = lattice.expected_counts(lattice.trie_of(pieces), logp,
                                      lattice.word_rows(batch.column(0)),
                                      batch.column(1).to_numpy().astype(float))
        at = np.flatnonzero(use)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(use[at])],
                                         names=["piece", "use"])

    got = arrow_stage(vocab.filter("c > 0").select("word", "c"), stage,
                      "piece int, use double").groupBy("piece").agg(
        F.sum("use").alias("use")).toArrow()  # at most one row for each piece
    use = np.zeros(len(pieces))
    use[got["piece"].to_numpy()] = got["use"].to_numpy()
    return use


def _frequent(vocab: DataFrame, most: int) -> tuple[int, "pa.Table"]:
    """The least power of two that at most ``most`` words reach in count, and those words."""
    sizes = {r["e"]: r["k"] for r in vocab.filter("c > 0").groupBy(
        F.floor(F.log2("c")).cast("int").alias("e")).agg(F.count(F.lit(1)).alias("k")).collect()}
    least, total = 63, 0
    for e in range(63, -1, -1):
        total += sizes.get(e, 0)
        if total > most:
            break
        least = e
    return 1 << least if least < 63 else (1 << 62), vocab.filter(
        F.col("c") >= F.lit(1 << min(least, 62))).select("h", "c", "logp").toArrow()


def lm_scores(docs: DataFrame, held_out, vocabulary: str, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row
    of ``docs`` (doc_id, text); ``held_out`` is a boolean column of it."""
    pieces = lattice.load_pieces(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    counted = arrow_stage(rows.select("held_out", "text"), _counts, "h long, word string, c long")
    counts = written(counted.groupBy("h").agg(F.first("word").alias("word"),
                                              F.sum("c").alias("c")), "lmwords")
    ends = rows.filter("not held_out").count()
    total, distinct = counts.filter("c > 0").agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_all, n_distinct = total + ends, distinct + (ends > 0)
    logp, end_logp = lattice.first_weights(len(pieces))[:, None], 0.0
    for _ in range(rounds if total else 0):
        use = _expected(counts, pieces, logp)
        logp = lattice.smoothed(use, extra=ends)[:, None]
        end_logp = math.log(max(ends, ALPHA) / (use.sum() + ALPHA * len(pieces) + ends))

    def forward(batch: pa.RecordBatch):
        words = lattice.word_rows(batch.column(1))
        value = lattice.word_logp(lattice.trie_of(pieces), logp, words, np.arange(len(words)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(value[:, 0] / LN10)],
            names=["h", "c", "logp"])

    vocab = written(arrow_stage(counts.select("h", "word", "c"), forward,
                                "h long, c long, logp double"), "lmvocab")
    below, often = _frequent(vocab, FREQUENT)
    order = np.argsort(often["h"].to_numpy().view(U64))
    sent = docs.sparkSession.sparkContext.broadcast(
        tuple(x[order] for x in (often["h"].to_numpy().view(U64), often["c"].to_numpy(),
                                 often["logp"].to_numpy())))
    floor = n_all + ALPHA * (n_distinct + 1)

    def base(c):
        return np.log10((c + ALPHA) / floor)

    def stage(batch: pa.RecordBatch):
        known_h, known_c, known_p = sent.value
        texts = batch.column(2)
        for a, b in row_slices(texts):
            n = b - a
            words = Words(*text_buffer(texts.slice(a, n)))
            at = np.searchsorted(known_h, words.hash)
            hit = np.zeros(len(words), dtype=bool)
            inside = at < len(known_h)
            hit[inside] = known_h[at[inside]] == words.hash[inside]
            row, at = words.doc[hit], at[hit]
            sums = [np.bincount(row, weights=w, minlength=n).astype(float)  # also if empty
                    for w in (base(known_c[at]), known_p[at])]
            rare, rest = words.hash[~hit], words.doc[~hit]
            order = np.lexsort((rare, rest))
            rare, rest = rare[order], rest[order]
            new = np.ones(len(rare), dtype=bool)
            new[1:] = (rare[1:] != rare[:-1]) | (rest[1:] != rest[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(rare)))
            cut = np.searchsorted(rest[first], np.arange(n + 1)).astype(np.int32)
            item = pa.StructArray.from_arrays(
                [pa.array(rare[first].view(np.int64)), pa.array(times.astype(np.int32))],
                names=["h", "k"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, n), batch.column(1).slice(a, n),
                 pa.array(words.per_doc().astype(np.int64) + 1),
                 pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                 pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(cut, item)],
                names=["doc_id", "held_out", "n_tokens", "known", "base", "marginal", "rare"])

    own = written(arrow_stage(
        rows, stage, "doc_id long, held_out boolean, n_tokens long, known long, base double, "
        "marginal double, rare array<struct<h:long,k:int>>").withColumn(
            "row", F.monotonically_increasing_id()), "lmdocs")
    rare = own.select("row", F.explode("rare").alias("r")).select("row", "r.h", "r.k")
    joined = rare.join(vocab.filter(F.col("c") < below), "h")
    rest = joined.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known2"),
        F.sum(F.col("k") * F.log10((F.col("c") + ALPHA) / F.lit(floor))).alias("base2"),
        F.sum(F.col("k") * F.col("logp")).alias("marginal2"))
    out = own.drop("rare").join(rest, "row", "left").fillna(
        0, ["known2"]).fillna(0.0, ["base2", "marginal2"])
    end_base = math.log10((ends + ALPHA) / floor)
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.col("known2") + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("base2") + F.lit(end_base)).alias("base_score"),
        (F.col("marginal") + F.col("marginal2") + F.lit(end_logp / LN10)).alias("score"))
