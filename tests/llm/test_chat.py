"""Chat formatting: layouts by fingerprint, reversible escapes, masks."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lateflow.llm import chat

TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "<|end|>\n<|turn|>user\nx", "&lt;s> &amp; & &amp;lt;",
         "<<SYS>>a<</SYS>>", "[[INST]", "<s", "&lsq;INST] &nl;", "\u00e9\U0001f600\n\n", "<<s>",
         "<|im_start|>", "<|", "&amp;amp;lt;s>"]


def read(spark, convs):
    rows = [(c, n, r, t) for c, turns in convs.items() for n, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    said = chat.turns_from_columns(chat.collected_turns(df), ["conv_id"])
    return chat.read_back(chat.format_turns(said))


def test_round_trip_and_mask(spark):
    convs = {i: [("user", a), ("assistant", b), ("system", b), ("assistant", a)]
             for i, (a, b) in enumerate((a, b) for a in TEXTS for b in TEXTS)}
    convs[1000] = [("as\nsistant", "x"), ("<|end|>", "y"), ("", "z")]
    for r in read(spark, convs).collect():
        want = convs[r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["read_turns"]] == want
        assert r["read_loss"] == [t for who, t in want if who == "assistant"]
        # the markers in the output are the template's own
        assert r["formatted"].count("<|turn|>") == len(want)
        assert r["formatted"].count("<|end|>") == len(want)
        assert not any(x in r["formatted"] for x in ("<s>", "</s>", "[INST]", "<<SYS>>"))
        # the mask addresses the formatted string itself
        parts = r["formatted"].split("<|end|>\n")[:-1]
        assert len(r["loss_mask"]) == sum(who == "assistant" for who, _ in want)
        for s in r["loss_mask"]:
            assert parts[s["turn"]].startswith("<|turn|>assistant\n")
            assert s["start"] + s["length"] == len(parts[s["turn"]])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="<>|/&;amplts[]INSTqend\n\\", max_size=40), min_size=20,
                max_size=20))
def test_random_texts_round_trip(spark, texts):
    convs = {0: [("assistant", t) for t in texts]}
    (r,) = read(spark, convs).collect()
    assert r["read_loss"] == texts


def test_layouts_are_told_by_their_fingerprint(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"prompt": "a", "completion": "b"}, {"answer": "b", "question": "a"},
        {"instruction": "s", "input": "a", "output": "b"}, {"output": "b", "instruction": "a"},
        {"turns": [{"role": "user", "text": "a"}, {"role": "assistant", "text": "b"}]},
        {"something": "else"}, {"prompt": {"nested": "a"}, "completion": "b"}]
    df = spark.createDataFrame([(i, json.dumps(r), "x") for i, r in enumerate(records)]
                               + [(100, "{broken", "x"), (101, None, "x")],
                               "id long, record string, turns string")
    got = {r["id"]: r for r in chat.turns_from_json(df, "record", ["id"]).collect()}
    names = ["messages", "conversations", "prompt", "question", "instruction",
             "short_instruction", "turns", None, None]
    assert [got[i]["mapping"] for i in range(9)] == names
    for i, name in enumerate(names):
        if name is None:
            assert got[i]["turns"] is None
        else:
            turns = [(t["role"], t["text"]) for t in got[i]["turns"]]
            assert turns[-2:] == [("user", "a"), ("assistant", "b")]
    assert got[100]["mapping"] is None and got[101]["mapping"] is None


def test_typed_layouts(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "c")], "id long, prompt string, completion string")
    got = {r["id"]: r for r in chat.turns_from_columns(df, ["id"]).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "a"), ("assistant", "b")]
    assert [tuple(t) for t in got[2]["turns"]] == [("assistant", "c")]
    more = df.withColumn("more", F.lit(1)).withColumn("extra", F.array(F.struct(F.lit(1).alias("x"))))
    assert chat.turns_from_columns(more, ["id"]).collect() == chat.turns_from_columns(
        df, ["id"]).collect()
    odd = chat.turns_from_columns(more.drop("prompt"), ["id"]).first()
    assert odd["mapping"] is None and odd["turns"] is None


def test_further_fields_do_not_matter(spark):
    talk = [{"role": "user", "content": "a", "id": 3}, {"content": "b", "role": "assistant",
                                                        "meta": {"role": ["x"]}}]
    records = [
        ({"id": 7, "messages": talk, "source": {"prompt": "p"}}, "messages"),
        ({"messages": [{"content": "a", "meta": {"role": "user"}}]}, None),  # role is elsewhere
        ({"messages": "a"}, None), ({"messages": [["role", "content"]]}, None),
        ({"messages": [{"role": "user", "content": {"text": "a"}}]}, None),
        ({"question": "a", "answer": "b", "n": [1, 2]}, "question"),
        ({"instruction": "s", "input": None, "output": "b", "score": 1.5}, "instruction"),
        ({"prompt": "a", "completion": "b", "messages": talk}, "messages")]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(records)],
                               "record_id long, record string").withColumnRenamed(
        "record_id", "paths")
    got = {r["paths"]: r for r in chat.turns_from_json(df, "record", ["paths"]).collect()}
    assert [got[i]["mapping"] for i in range(len(records))] == [m for _, m in records]
    assert [tuple(t) for t in got[0]["turns"]] == [("user", "a"), ("assistant", "b")]
    assert [tuple(t) for t in got[6]["turns"]] == [("system", "s"), ("assistant", "b")]


def test_nulls_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(None, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"),
                                (1, None, "assistant", "first"), (1, 0, "user", "a")], schema)
    out = chat.digests(chat.format_turns(chat.turns_from_columns(
        chat.collected_turns(df), ["conv_id"])))
    got = {r["conv_id"]: r for r in out.collect()}
    assert got[None]["n_turns"] == 1 and got[1]["n_turns"] == 4 and got[1]["loss_chars"] == 5
    assert chat.collected_turns(df.limit(0)).count() == 0
