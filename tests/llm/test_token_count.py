"""The compiled tokenizer against the library."""

import random

import pyarrow as pa
import pytest
from conftest import SF_MID

from lateflow.llm.queries import TOKENIZER
from lateflow.llm.token_count import Machine, token_counts
from lateflow.llm.words import text_buffer


@pytest.fixture(scope="module")
def machine():
    with open(TOKENIZER, encoding="utf-8") as f:
        return Machine(f.read())


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts],
                                               add_special_tokens=False)]


CASES = ["", None, "Hello world's I'VE don't ''s !!'s 123 45.6", "naïve Éa ÉÀ ß ΑΣ Σ İstanbul",
         "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> <|endoftext|><|endoftext|>",
         "é a ́b 日本語テスト 😀😀 ﬁ ½ ²", "x\u00a0y\u3000z\u2028w", "aaaaaaaaaaaa bananana!!!???",
         "\x00\x01 \x1f\x85 \x1c a\x1cb", "I'm you'll we'd 'tis 're'", "a_b-c don’t",
         "x" * 3000 + " " + "ab" * 900, "the " * 50000, "\n\n\t  ", "'", "'' 's's", "ÿþ ÿ"]


def test_cases(machine):
    assert machine.text_counts(*text_buffer(pa.array(CASES))).tolist() == library(CASES)


def test_random_strings(machine):
    rng = random.Random(5)
    parts = ["th", "ing", "'s", "'", " ", "  ", "é", "e\u0301", "Ω", "12", "!", "—", "q", "zz",
             "<|endoftext|>", "<|", "the", "ation", "\n", "ſ", "K"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(400)]
    assert machine.text_counts(*text_buffer(pa.array(texts))).tolist() == library(texts)


def test_every_vocabulary_word(machine):
    import json

    with open(TOKENIZER, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    texts = [v.removesuffix("</w>") for v in list(vocab)[::7]]
    assert machine.text_counts(*text_buffer(pa.array(texts))).tolist() == library(texts)


def test_bounded_tables_start_over(machine, monkeypatch):
    from lateflow.llm import token_count

    monkeypatch.setattr(token_count, "KEEP_PAIRS", 50)
    monkeypatch.setattr(token_count, "KEEP_WORDS", 20)
    texts = [f"word{i} some thing{i * 7}" for i in range(200)]
    got = [n for t in texts for n in machine.text_counts(*text_buffer(pa.array([t]))).tolist()]
    assert got == library(texts)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    got = token_counts(docs, TOKENIZER).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in got] == library([r["text"] for r in rows])
    assert [r["n_bytes"] for r in got] == [len((r["text"] or "").encode()) for r in rows]
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)


def test_empty_table_and_odd_columns(spark):
    schema = "doc_id long, text string, n_tokens string, n_bytes string"
    assert token_counts(spark.createDataFrame([], schema), TOKENIZER).count() == 0
    rows = token_counts(spark.createDataFrame([(None, None, "x", "y"), (1, "a b", "x", "y")] * 2,
                                              schema), TOKENIZER).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows) == [(0, 0), (0, 0), (1, 2), (1, 2)]
