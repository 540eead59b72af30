"""What an executor's Python workers hold, and how many of them a stage needs."""

import re

import numpy as np
import pyarrow as pa
from conftest import SF_MID

from lateflow.llm import lattice, mixing, near_dup
from lateflow.llm import words as W
from lateflow.llm.queries import PIECES


def plans(monkeypatch, module):
    """(name, physical plan) of each table that the module writes."""
    seen, write = [], module.written

    def noted(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(module, "written", noted)
    return seen


def test_trie_is_small_and_steps_as_its_pieces_spell():
    pieces = lattice.load_pieces(PIECES)
    trie = lattice.Trie(pieces)
    assert sum(x.nbytes for x in vars(trie).values() if isinstance(x, np.ndarray)) < 4 << 20
    spelled = {p[:i]: -1 for p in pieces for i in range(1, len(p) + 1)}
    spelled |= {p: n for n, p in enumerate(pieces)}
    rng = np.random.default_rng(3)
    for p in rng.permutation(len(pieces))[:300]:
        row, so_far = np.ones(256, np.int32), b""
        for b in pieces[p]:
            node = trie.step(row, np.arange(256, dtype=np.uint8))
            assert [x for x in range(256) if node[x] > 0] == [
                x for x in range(256) if so_far + bytes([x]) in spelled]
            so_far += bytes([b])
            assert trie.piece[node[b]] == spelled[so_far]
            row = np.full(256, trie.row[node[b]], np.int32)
    # a node without children leads nowhere
    assert not trie.step(np.zeros(256, np.int32), np.arange(256, dtype=np.uint8)).any()


def test_tables_of_powers_that_workers_keep_are_small():
    texts = pa.array(["a b c " * 200_000, "x" * 300_000, None, "", "é" * 100_000 + " b"])
    words = W.Words(*W.text_buffer(texts))
    assert sum(x.nbytes for x in W._powers) < 2 << 20
    assert len(words) == 600_003
    assert len(set(words.hash.tolist())) == 5
    alone = W.Words(*W.text_buffer(pa.array(["x" * 300_000, "b", "é" * 100_000])))
    assert words.hash[600_000] == alone.hash[0]
    assert words.hash[600_001] == alone.hash[2] and words.hash[600_002] == alone.hash[1]


def test_sets_of_open_members_take_one_python_worker_a_task(spark, monkeypatch):
    vocab = [f"w{i}" for i in range(400)]
    base = [vocab[i * 7 % 400] for i in range(60)]
    rows = []
    for i in range(40):
        text = list(base)
        text[i % 50 + 5] = f"x{i}"
        rows.append((i, " ".join(text)))
    seen = plans(monkeypatch, near_dup)
    docs = spark.createDataFrame([*rows, (None, "a b"), (99, None)], "doc_id long, text string")
    state = spark.createDataFrame([(i, 3, 56) for i in range(39)], "rep long, least long, n long")
    out, sketch = near_dup._with_shared(state.withColumn("s", near_dup.F.col("n")),
                                        docs.withColumnRenamed("doc_id", "rep").filter(
                                            "rep is not null"), 80)
    (plan,) = [p for name, p in seen if name == "shingles"]
    assert plan.count("MapInArrow") == 1
    # the filter may let a few others through, but loses none
    assert {r["rep"] for r in sketch.select("rep").collect()} >= set(range(39))
    want = {i: sum(any(g in near_dup_set(t) for j, t in rows if j != i and j < 39)
                   for g in near_dup_set(text)) for i, text in rows[:39]}
    kept = {r["rep"]: r["s"] for r in out.collect()}
    assert kept == {i: s for i, s in want.items() if s * 100 >= (
        56 + max(3, -(-56 * 80 // 100)) - s) * 80}


def near_dup_set(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_the_mix_asks_for_no_workers_beside_the_arrow_stages(spark, monkeypatch):
    seen = plans(monkeypatch, mixing)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "source", "text")
    mixed = mixing.pfair_mix(docs, order=["doc_id"], block=8)
    assert mixed.count() == docs.count()
    assert seen and not [p for _, p in seen if re.search("ExistingRDD", p)]


def test_the_mix_of_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.pfair_mix(docs, order=["doc_id"]).collect() == []
