"""Queries with SQL, and the pipeline stage by stage."""

from collections import Counter

import corpus_pipeline as P
import pytest
from conftest import SF_MID, SF_SMALL

from lateflow.llm import sharding
from lateflow.llm.queries import QUERIES, SQL
from lateflow.llm.shared import table, written

from tools.compare_oracle import duck_connection, rows_of_duck, rows_of_spark


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    cols, rows = rows_of_spark(QUERIES[name](spark, SF_MID))
    assert (cols, rows) == rows_of_duck(duck_connection(SF_MID).sql(SQL[name]))


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in P.STAGES:
        out = written(stage(spark, docs, SF_SMALL), name)
        ids = [r["doc_id"] for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(kept)
        if name != "shard":
            assert out.columns == docs.columns
        if name in ("mix", "shard"):
            assert set(ids) == set(kept)  # nothing is dropped here
        if name == "language_id":
            assert all(any(c.isalpha() for c in kept[i]["text"] or "") for i in ids)
        kept = {i: kept[i] for i in ids}
        docs = out
    final = P.run(spark, SF_SMALL)
    assert Counter(r["doc_id"] for r in final.collect()) == Counter(kept.keys())


def test_pipeline_on_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (None, "the cat sat on the mat", "en", "a", 5),
            (3, "the cat sat on the mat today", "en", None, 5), (3, "the cat sat on the mat today", "en", None, 5),
            (4, "the cat sat on the mat today", "en", "b", 5), (5, "123", "en", "b", 5)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "x y z")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    out = P.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["3", "None"]
    empty = tmp_path / "empty"
    spark.createDataFrame([], schema).write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(
        str(empty / "benchmark.parquet"))
    assert P.run(spark, str(empty)).count() == 0


def test_shards_keep_the_order_of_the_mix(spark):
    docs = table(spark, SF_MID, "documents")
    stages = dict(P.STAGES)
    mixed = written(stages["mix"](spark, docs, SF_MID), "mix")
    schedule = P.pfair_mix(docs, order=["doc_id"]).orderBy("position").select("doc_id").collect()
    order = {r["doc_id"]: n for n, r in enumerate(schedule)}
    assert order != {i: n for n, i in enumerate(sorted(order))}
    # as the mix has them, and as another order of the same rows has them
    for rows, at in ((mixed, order), (docs.orderBy("doc_id"), {i: i for i in order})):
        shards = {}
        for r in stages["shard"](spark, rows, SF_MID).collect():
            shards.setdefault(r["shard"], []).append((r["place"], at[r["doc_id"]]))
        assert len(shards) > 1
        for found in shards.values():  # together, and in order
            assert [p for p, _ in found] == list(range(len(found)))
            assert found == sorted(found, key=lambda x: x[1])


def test_the_last_stage_gives_the_same_with_nothing_sent_to_executors(spark, monkeypatch):
    docs = table(spark, SF_MID, "documents")
    rows = written(dict(P.STAGES)["mix"](spark, docs, SF_MID), "mix")
    want = P.assign_shards(spark, rows, SF_MID)
    monkeypatch.setattr(sharding, "SENT", 0, raising=False)
    got = P.assign_shards(spark, rows, SF_MID)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.dtypes == want.dtypes and got.columns[:len(docs.columns)] == docs.columns
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() == docs.count()
