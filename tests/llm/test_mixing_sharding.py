"""Pfair mixing and extendible hashing against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from conftest import SF_MID

from lateflow.llm import mixing, sharding
from lateflow.llm.queries import QUERIES
from lateflow.llm.sharding import BITS, extendible_shards

SCHEMA = "doc_id long, text string, source string, slot string, prefix string, number long"


def brute_schedule(share, slots, grain):
    """(source, block) of each slot: scan all released blocks for the earliest deadline."""
    order = list(share)
    nxt, out = dict.fromkeys(share, 0), []
    for slot in range(slots):
        ready = []
        for n, s in enumerate(order):
            w, i = Fraction(share[s], grain), nxt[s]
            if math.floor(i / w) <= slot:
                ready.append((math.ceil((i + 1) / w), n, s, i))
        deadline, _, s, i = min(ready)
        assert slot < deadline
        out.append((s, i))
        nxt[s] += 1
    return out


@pytest.mark.parametrize("weights", [{"a": 5, "b": 3, None: 1}, {"x": 1}, {"a": 1, "b": 1},
                                     {f"s{i}": 1 + i % 4 for i in range(30)}])
def test_period_is_edf_and_within_one_block(weights):
    share = mixing.units(weights, 64)
    assert sum(share.values()) == 64 and min(share.values()) >= 1
    got = mixing.period(share, 64)
    assert [(s, i) for s, i, *_ in got] == brute_schedule(share, 64, 64)
    done = Counter()
    for slot, (s, i, at, release, deadline) in enumerate(got):
        assert at == slot and release <= slot < deadline
        done[s] += 1
        for x, q in share.items():  # the lag of every source stays below one block
            assert abs(done[x] - Fraction(q, 64) * (slot + 1)) < 1


def test_all_rows_are_placed_in_their_slots(spark):
    rows = [(i, f"t{i % 50}", ["a", "b", None][min(i % 6, 2)], "x", "y", 0) for i in range(400)]
    rows += [(7, "t", "c", "x", "y", 0)] * 9  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.pfair_mix(df, {"a": 2, "b": 1, None: 3}, block=4, grain=64).collect()
    assert len(out) == len(rows) and len({r["position"] for r in out}) == len(rows)
    assert Counter((r["doc_id"], r["source"]) for r in out) == Counter((r[0], r[2]) for r in rows)
    share = mixing.units({"a": 2, "b": 1, None: 3, "c": 1}, 64)
    slots = max(r["slot"] for r in out) + 1
    plan = brute_schedule(share, slots, 64)
    for r in out:
        assert plan[r["slot"]] == (r["source"], r["block"])
    sizes = Counter(r[2] for r in rows)
    filled = defaultdict(int)
    horizon = 0
    for s, i in plan:  # the first slot whose block is not full
        if (i + 1) * 4 > sizes[s]:
            break
        horizon += 1
    assert {r["slot"] for r in out if r["in_horizon"]} == set(range(horizon))
    assert not filled


def test_long_schedule_stays_within_one_block_of_the_target_weights():
    rows = {f"s{i}": 3000 for i in range(19)} | {"big": 28_500, "rare": 2}
    weights = [n ** mixing.TEMPER for n in rows.values()]
    target = [Fraction(w) / sum(map(Fraction, weights)) for w in weights]
    slots = mixing.schedule(mixing.exact(weights), [10_000] * len(weights))
    assert len(slots) > 20_000
    done = [0] * len(weights)
    for slot, n in enumerate(slots, 1):
        done[n] += 1
        assert slot % 50 or all(abs(d - w * slot) < 1 for d, w in zip(done, target))


def test_rows_follow_the_target_weights(spark):
    sizes = {"a": 30_000, "b": 10_000, None: 100, "zero": 40}
    weights = {"a": 0.7, "b": 0.29995, None: 0.00005, "zero": 0}
    rows = [(i, "t", s, "x", "y", 0) for s, n in sizes.items() for i in range(n)]
    out = mixing.pfair_mix(spark.createDataFrame(rows, SCHEMA), weights, block=1).collect()
    assert len(out) == len(rows) == len({r["position"] for r in out})
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in out)
    mixed = sorted((r["slot"], r["source"]) for r in out if r["in_horizon"] and r["source"])
    horizon = sum(r["in_horizon"] for r in out)
    assert horizon > 30_000
    done = Counter(s for _, s in mixed)
    assert abs(done["a"] - 0.7 * horizon) < 1.001 and abs(done["b"] - 0.29995 * horizon) < 1.001


def test_mixing_edges(spark):
    assert mixing.pfair_mix(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        mixing.units({i: 1.0 for i in range(20)}, 10)
    out = QUERIES["op1_pfair_mix"](spark, SF_MID).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(1000))
    assert len({r["position"] for r in out}) == 1000


def brute_shards(rows, limit):
    """Splits buckets over the limit on one more bit, by recursion."""
    keyed = [(int(hashlib.md5(str("null" if i is None else i).encode()).hexdigest()[:15], 16),
              len((t or "").encode()), i) for i, t in rows]
    out = []

    def split(items, depth):
        size = sum(n for _, n, _ in items)
        if not items:
            return
        if size <= limit or depth == BITS:
            out.extend((i, n, depth, h >> (BITS - depth), size) for h, n, i in items)
            return
        bit = BITS - depth - 1
        for b in (0, 1):
            split([x for x in items if x[0] >> bit & 1 == b], depth + 1)

    split(keyed, 0)
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [200, 1000, 100_000])
def test_shards_are_the_buckets_of_repeated_splits(spark, limit):
    rows = [(i, "x" * (i * 37 % 190)) for i in range(300)] + [(None, "\u00e9" * 20), (1000, None)]
    df = spark.createDataFrame([(i, t, "s", "a", "b", 1) for i, t in rows], SCHEMA)
    out = extendible_shards(df, limit).collect()
    assert len(out) == len(rows) and all(r["page"] == 0 for r in out)
    got = sorted(((r["doc_id"], r["n_bytes"], r["depth"], r["prefix"], r["shard_bytes"])
                  for r in out), key=str)
    assert got == brute_shards(rows, limit)
    sizes = defaultdict(int)
    for r in out:
        sizes[r["shard"]] += r["n_bytes"]
    assert all(n <= limit for n in sizes.values())


def test_rows_that_no_bit_parts_overflow_into_pages(spark):
    rows = [(5, "x" * 90)] * 40 + [(6, "y" * 500)] + [(i, "z" * 10) for i in range(100, 140)]
    df = spark.createDataFrame([(i, t, "s", "a", "b", 1) for i, t in rows], SCHEMA).repartition(3)
    out = extendible_shards(df, 200).collect()
    assert Counter((r["doc_id"], r["n_bytes"]) for r in out) == Counter(
        (i, len(t)) for i, t in rows)
    sizes, ids = defaultdict(int), defaultdict(set)
    for r in out:
        sizes[r["shard"]] += r["n_bytes"]
        ids[r["shard"]].add(r["doc_id"])
        assert r["shard_bytes"] <= 200 or r["doc_id"] == 6
    assert all(n <= 200 for s, n in sizes.items() if ids[s] != {6})
    assert sum(1 for s in ids if ids[s] == {5}) == 20


def test_empty_table(spark):
    assert extendible_shards(spark.createDataFrame([], SCHEMA), 10).count() == 0


def noted(monkeypatch):
    """(name, physical plan, table) of each table that the sharding writes."""
    seen, write = [], sharding.written

    def note(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append((name, plan, write(df, name)))
        return seen[-1][2]

    monkeypatch.setattr(sharding, "written", note)
    return seen


def test_what_goes_to_executors_grows_with_the_shards_and_not_with_the_cells(spark, monkeypatch):
    seen = noted(monkeypatch)
    rows = [(i, "x" * (i * 37 % 190)) for i in range(6000)]
    df = spark.createDataFrame([(i, t, "s", "a", "b", 1) for i, t in rows], SCHEMA)
    out = extendible_shards(df, 20_000).collect()
    shards = len({r["shard"] for r in out})
    (cells,) = [x.count() for name, _, x in seen if name == "cells"]
    (directory,) = [x.count() for name, _, x in seen if name == "directory"]
    assert 30 < shards and 20 * shards < cells and directory <= 4 * shards
    # prefixes of all lengths, many times the cells, are never sent
    assert not [p for name, p, _ in seen if name in ("sums", "buckets") and "Broadcast" in p]
    (plan,) = [p for name, p, _ in seen if name == "directory"]
    assert not re.search(r"BroadcastExchange(?s:.)*explode", plan)


def test_nothing_is_sent_that_has_more_rows_than_allowed(spark, monkeypatch):
    seen = noted(monkeypatch)
    monkeypatch.setattr(sharding, "SENT", 0, raising=False)
    limit = 300
    plain = [(i, "x" * (i * 37 % 190)) for i in range(400)] + [(None, "\u00e9" * 20), (1000, None)]
    long = [(i, "y" * 500) for i in range(2000, 2020)]  # over the limit: down to the last bit
    again = [(7777, "z" * 90)] * 40
    df = spark.createDataFrame([(i, t, "s", "a", "b", 1) for i, t in plain + long + again],
                               SCHEMA).repartition(3)
    shards = extendible_shards(df, limit)
    seen.append(("shards", shards._jdf.queryExecution().executedPlan().toString(), shards))
    assert {"cells", "directory", "overflow"} <= {name for name, _, _ in seen}
    assert not [name for name, p, _ in seen if "Broadcast" in p]
    out = shards.collect()
    want = brute_shards(plain + long + again, limit)
    assert sorted(((r["doc_id"], r["n_bytes"], r["depth"], r["prefix"]) for r in out),
                  key=str) == sorted((w[:4] for w in want), key=str)
    sizes = defaultdict(int)
    for r in out:
        sizes[r["shard"]] += r["n_bytes"]
    assert all(r["shard_bytes"] == sizes[r["shard"]] for r in out)
    assert all(n <= limit or n == 500 for n in sizes.values())
    assert len({r["shard"] for r in out if r["doc_id"] == 7777}) == 14  # 3 rows a page


def test_columns_that_nobody_asks_for_do_not_move(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SENT", 0, raising=False)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
        out = extendible_shards(docs, 1 << 16).select("doc_id", "shard")
        assert out.count() == docs.count()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    # only the length is taken of a text; what the exchange moves does not hold it
    assert "Exchange hashpartitioning" in plan
    assert not re.search(r"text#\d+ AS |struct\(", plan)
