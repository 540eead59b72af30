"""Segmentation lattices, language ID and lattice scores against brute force."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_MID
from pyspark.sql import functions as F

from lateflow.llm import langid, lattice, lm_score
from lateflow.llm.queries import PIECES, QUERIES
from lateflow.llm.words import Words, text_buffer

SMALL = [b" ", b" a", b"a", b"b", b"ab", b"abc", b"c", b" ab"] + [bytes([i]) for i in range(256)]
SMALL = list(dict.fromkeys(SMALL))


def segmentations(spelled, pieces):
    """All ways to cut a spelling, by cut positions."""
    n = len(spelled)
    for r in range(n):
        for cuts in itertools.combinations(range(1, n), r):
            parts = [spelled[a:b] for a, b in zip((0, *cuts), (*cuts, n))]
            if all(p in pieces for p in parts):
                yield parts


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    logp = np.log(rng.dirichlet(np.ones(len(SMALL)), 2).T)
    index = {p: i for i, p in enumerate(SMALL)}
    trie = lattice.Trie(SMALL)
    words = ["a", "ab", "abc", "abcab", "cabbacab", "é", "zab"]
    w = Words(*text_buffer(pa.array([" ".join(words)])))
    got = lattice.word_logp(trie, logp, w, np.arange(len(words)))
    counts = np.arange(1.0, len(words) + 1)
    want_use = np.zeros(len(SMALL))
    for i, word in enumerate(words):
        ways = list(segmentations(b" " + word.encode(), index))
        p = [[math.exp(sum(logp[index[x], m] for x in parts)) for parts in ways] for m in (0, 1)]
        assert np.allclose(np.exp(got[i]), [sum(x) for x in p])
        for parts, q in zip(ways, p[0]):
            for x in parts:
                want_use[index[x]] += counts[i] * q / sum(p[0])
    use = lattice.expected_counts(trie, logp[:, [0]], w, counts)
    assert np.allclose(use, want_use)


@pytest.mark.parametrize("cut", [1, 2, 5, 7, 4096])
def test_long_words_sum_all_segmentations_over_runs(monkeypatch, cut):
    rng = np.random.default_rng(cut)
    letters = np.array(list("abcz\u00e9"))
    words = ["abcababcab", "x", "ab", "".join(rng.choice(letters, 300)), "abc" * 40, "a" * 37]
    w = Words(*text_buffer(pa.array([" ".join(words[:3]), " ".join(words[3:])])))
    logp = np.log(rng.dirichlet(np.ones(len(SMALL)), 3).T)
    trie, counts = lattice.Trie(SMALL), np.arange(1.0, len(words) + 1)
    pick = np.array([5, 0, 3, 1, 2, 4])
    monkeypatch.setattr(lattice, "CUT", 10**9)
    want = lattice.word_logp(trie, logp, w, pick)
    use = lattice.expected_counts(trie, logp[:, [1]], w, counts)
    monkeypatch.setattr(lattice, "CUT", cut)
    assert np.allclose(lattice.word_logp(trie, logp, w, pick), want, rtol=1e-12)
    assert np.allclose(lattice.expected_counts(trie, logp[:, [1]], w, counts), use, rtol=1e-9)


def test_a_word_of_many_runs_has_no_forced_cuts(monkeypatch):
    pieces = lattice.load_pieces(PIECES)
    trie, logp = lattice.Trie(pieces), lattice.first_weights(len(pieces))[:, None]
    text = "thequickbrownfoxjumps" * 480
    w = Words(*text_buffer(pa.array([text])))
    got = lattice.word_logp(trie, logp, w, np.arange(1))[0, 0]
    monkeypatch.setattr(lattice, "CUT", 10**9)
    assert math.isclose(got, lattice.word_logp(trie, logp, w, np.arange(1))[0, 0], rel_tol=1e-12)


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_base_scores_and_counts(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in rows.items()}
    train = Counter(w for i, ws in tokens.items() if crc(i, 10) for w in ws)
    n, v = sum(train.values()), len(train)
    got = {r["doc_id"]: r for r in QUERIES["op10_lattice_lm"](spark, SF_MID).collect()}
    assert got.keys() == rows.keys()
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (crc(i, 10) == 0, len(ws), n)
        assert r["n_known"] == sum(w in train for w in ws)
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_scores_match_a_direct_model(spark):
    """The same model computed in one process: EM over all words, then forward sums."""
    rows = [(i, t) for i, t in enumerate(
        ["a b ab abc", "abc abc b", None, "", "c c c cab", "A B", "zz a\u00e9 ab", "b a"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm_score.lm_scores(
        docs, F.col("doc_id") == 6, PIECES).collect()}
    pieces = lattice.load_pieces(PIECES)
    trie = lattice.Trie(pieces)
    logp = lattice.first_weights(len(pieces))[:, None]
    train = [t for i, t in rows if i != 6]
    w = Words(*text_buffer(pa.array([" ".join(t or "" for t in train)])))
    use = lattice.expected_counts(trie, logp, w, np.ones(len(w)))
    logp = lattice.smoothed(use, extra=len(train))[:, None]
    end = math.log(len(train) / (use.sum() + 0.1 * len(pieces) + len(train)))
    for i, t in rows:
        ws = Words(*text_buffer(pa.array([t or ""])))
        total = lattice.word_logp(trie, logp, ws, np.arange(len(ws))).sum() + end
        assert math.isclose(got[i], total / math.log(10), rel_tol=1e-9)


def test_rare_words_go_through_the_join(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").limit(200)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    want = {r["doc_id"]: r for r in lm_score.lm_scores(docs, F.col("doc_id") % 5 == 0,
                                                       PIECES).collect()}
    monkeypatch.setattr(lm_score, "FREQUENT", 50)
    got = {r["doc_id"]: r for r in lm_score.lm_scores(docs, F.col("doc_id") % 5 == 0,
                                                      PIECES).collect()}
    for i, r in want.items():
        assert got[i]["n_known"] == r["n_known"]
        assert math.isclose(got[i]["base_score"], r["base_score"], rel_tol=1e-9)
        assert math.isclose(got[i]["score"], r["score"], rel_tol=1e-9)


def test_lm_empty_table_and_untrained(spark):
    schema = "doc_id long, text string, score string"
    held = F.lit(True)
    assert lm_score.lm_scores(spark.createDataFrame([], schema), held, PIECES).count() == 0
    rows = lm_score.lm_scores(spark.createDataFrame([(None, "a b", "x"), (1, None, "x")], schema),
                              held, PIECES).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows} == {(3, 0, 0), (1, 0, 0)}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op7_marginal_langid"](spark, SF_MID).join(docs, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert {r["held_out"] for r in got if crc(r["doc_id"], 4) == 2} == {True}
    assert len(held) > 200
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.99
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_texts(spark):
    schema = "doc_id long, text string, lang string, score string, lang_pred string"
    train = [(i, t, l, "x", "y") for i, (t, l) in enumerate(
        [("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    df = spark.createDataFrame(train, schema)
    model = langid.fit(df, PIECES)
    assert model.langs == ["de", "en"]
    texts = [None, "", "123 !!! \u00b2", "the dog", "und die katze", "the " * 50000, "x" * 20000]
    rows = spark.createDataFrame([(i, t, None, "x", "y") for i, t in enumerate(texts)] * 2, schema)
    out = langid.predict(rows, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3
    assert [got[i][0] for i in (3, 4, 5)] == ["en", "de", "en"]
    assert out.count() == 14
    untrained = langid.fit(df.filter("false"), PIECES)
    assert {r["lang_pred"] for r in langid.predict(rows, untrained).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0
