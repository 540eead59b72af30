"""Language ID by segmentation-marginalised unigrams.

Each language has its own piece probabilities over one fixed public vocabulary, learned by
expectation maximisation on word types of a bounded sample of labelled texts. A text is
scored, whole, as the sum over its words of the log probability of the word, marginalised
over all segmentations (see ``lattice``); the language with the highest total wins.

Scale. The fit reads about ``sample`` rows of each language (chosen by a hash of the id, so
by a threshold and not by a sort) and sends at most languages x pieces numbers to the
driver. Prediction is one scan; a worker scores each distinct word of a slice once.

Defined cases: ``und`` with score 0 if the text is null, has no letter, or nothing could
be learned. score is the posterior of the prediction under the fitted shares of the
languages, with the text's log likelihood averaged per word above ``SHARPNESS`` words. Ties
go to the language that sorts first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateflow.llm import lattice
from lateflow.llm.shared import arrow_stage, unused, written
from lateflow.llm.words import Words, row_slices, text_buffer

#: expected number of labelled rows of each language used for the fit
SAMPLE = 1500
ROUNDS = 2
#: words after which more text no longer sharpens the score
SHARPNESS = 50
UNKNOWN = "und"


class LanguageModel:
    def __init__(self, langs: list[str], pieces: list[bytes], logp: np.ndarray,
                 prior: np.ndarray):
        self.langs, self.pieces, self.logp, self.prior = langs, pieces, logp, prior
        self.key = f"lang-{hash((tuple(langs), logp.tobytes()))}"


def _word_counts(batch: pa.RecordBatch):
    """(lang, word, n) of each slice."""
    langs, texts = batch.column(0), batch.column(1)
    codes = langs.dictionary_encode()
    of, names = codes.indices.to_numpy(zero_copy_only=False), codes.dictionary
    for a, b in row_slices(texts):
        words = Words(*text_buffer(texts.slice(a, b - a)))
        if not len(words):
            continue
        lang = of[a:b][words.doc]
        order = np.lexsort((words.hash, lang))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (
            lang[order][1:] != lang[order][:-1])
        at = np.flatnonzero(new)
        pick = order[at]
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(lang[pick])),
             pa.array([words.word(i) for i in pick], pa.binary()).cast(pa.string()),
             pa.array(np.diff(np.append(at, len(order))).astype(np.int64))],
            names=["lang", "word", "n"])


def fit(labelled: DataFrame, vocabulary: str, sample: int = SAMPLE,
        rounds: int = ROUNDS) -> LanguageModel:
    """Learns from ``labelled`` (doc_id, text, lang), rows with a null lang left out.
    ``sample`` is the expected number of rows used of each language."""
    pieces = lattice.load_pieces(vocabulary)
    rows = labelled.filter("lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return LanguageModel([], pieces, np.zeros((len(pieces), 0)), np.zeros(0))
    share = F.create_map(*[x for l in langs for x in (
        F.lit(l), F.lit(min(1.0, sample / sizes[l])))])
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("fit")), 11) / float(1 << 53)
    chosen = rows.filter(place < share[F.col("lang")]).select("lang", "text")
    counts = written(arrow_stage(chosen, _word_counts, "lang string, word string, n long")
                     .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langwords")
    logp = np.repeat(lattice.first_weights(len(pieces))[:, None], len(langs), axis=1)
    for _ in range(rounds):
        logp = _maximised(counts, pieces, langs, logp)
    total = np.array([sizes[l] for l in langs], dtype=float)
    return LanguageModel(langs, pieces, logp, np.log(total / total.sum()))


def _maximised(counts: DataFrame, pieces: list[bytes], langs: list[str],
               logp: np.ndarray) -> np.ndarray:
    def expect(batch: pa.RecordBatch):
        trie = lattice.trie_of(pieces)
        names = np.array(batch.column(0).to_pylist())
        for k, lang in enumerate(langs):
            some = pa.array(names == lang)
            words = batch.column(1).filter(some)
            if len(words):
                n = batch.column(2).filter(some).to_numpy().astype(float)
                use = lattice.expected_counts(trie, logp[:, [k]], lattice.word_rows(words), n)
                at = np.flatnonzero(use)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)),
                     pa.array(use[at])], names=["k", "piece", "use"])

    got = arrow_stage(counts, expect, "k int, piece int, use double").groupBy(
        "k", "piece").agg(F.sum("use").alias("use")).toArrow()  # languages x pieces at most
    use = np.zeros((len(pieces), len(langs)))
    use[got["piece"].to_numpy(), got["k"].to_numpy()] = got["use"].to_numpy()
    return np.stack([lattice.smoothed(use[:, k]) for k in range(len(langs))], axis=1)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and score (columns of those names are replaced); only the
    text is looked at."""
    docs = docs.drop("lang_pred", "score")
    text = F.col("text").cast("string")
    marked = docs.withColumn(unused(docs, "letter"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)))
    names = marked.columns
    langs, prior = model.langs, model.prior

    def stage(batch: pa.RecordBatch):
        texts, letter = batch.column(names.index("text")), batch.column(len(names) - 1)
        for a, b in row_slices(texts):
            rows = batch.slice(a, b - a)
            pred, score = [UNKNOWN] * (b - a), np.zeros(b - a)
            if langs:
                trie = lattice.trie_of(model.pieces)
                words = Words(*text_buffer(texts.slice(a, b - a)))
                logp, index = lattice.distinct_logp(model.key, trie, model.logp, words)
                total = np.stack([np.bincount(words.doc, weights=logp[index, k],
                                              minlength=b - a).astype(float)
                                  for k in range(len(langs))], axis=1)
                best = np.argmax(total + prior, axis=1)
                flat = total * np.minimum(1.0, SHARPNESS / np.maximum(words.per_doc(), 1))[:, None]
                flat = flat + prior
                flat -= flat.max(axis=1, keepdims=True)
                p = np.exp(flat)
                p /= p.sum(axis=1, keepdims=True)
                has = letter.slice(a, b - a).to_numpy(zero_copy_only=False)
                score = np.where(has, p[np.arange(b - a), best], 0.0)
                pred = [langs[k] if h else UNKNOWN for k, h in zip(best, has)]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], pa.array(pred, pa.string()), pa.array(score)],
                names=[*names[:-1], "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return arrow_stage(marked.withColumn("text", text), stage, schema)
