import random
import re

import numpy as np
import pytest
import xxhash

from lateflow.llm.simhash import CHUNK, Ring, fingerprints, links, shingle_hashes, simhash_duplicates

_LOWER = {c: c + 32 for c in range(65, 91)}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or (
        [" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """Smallest member of each component, by comparing every pair."""
    found = {}
    arr = np.array(sorted(set(fps)), dtype=np.uint64)
    seen = np.zeros(len(arr), dtype=bool)
    for i in range(len(arr)):
        if seen[i]:
            continue
        todo, members = [i], []
        seen[i] = True
        while todo:
            j = todo.pop()
            members.append(j)
            near = np.flatnonzero((np.bitwise_count(arr ^ arr[j]) <= 3) & ~seen)
            seen[near] = True
            todo.extend(near.tolist())
        for j in members:
            found[int(arr[j])] = min(int(arr[k]) for k in members)
    return found


def plain(rows):
    """{(id, fingerprint): component} of (id, text) rows."""
    fps = [plain_fingerprint(t) for _, t in rows]
    label = plain_components([f for (i, _), f in zip(rows, fps) if i is not None])
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            c = label[f]
            least[c] = min(i, least.get(c, i))
    return sorted(((i, f"{f:016x}", least[label[f]] if i is not None else None)
                   for (i, _), f in zip(rows, fps)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"])
                   for r in df.collect()), key=str)


def test_fingerprint_bits_and_chunks():
    rng = random.Random(3)
    texts = ["", " \t\n", "One", "one TWO", "a b c", "Ä b\x0bc\x0cd  e", "a b c " * 400]
    texts += [" ".join(rng.choice("ab cd ef gh ij kl".split()) for _ in range(n))
              for n in (3, 254, 255, 256, 257, 511, 900)]
    h = [shingle_hashes(t.encode()) for t in texts]
    assert fingerprints(h).tolist() == [plain_fingerprint(t) for t in texts]
    long = "word " * 10 + "x" * (CHUNK + 5) + " " + " ".join(str(i) for i in range(300_000))
    assert int(fingerprints([shingle_hashes(long.encode())])[0]) == plain_fingerprint(long)


@pytest.mark.parametrize("distance", [1, 2, 3, 5])
def test_every_pair_within_the_distance_meets_in_a_viable_key(distance):
    rng = random.Random(distance)
    ring = Ring(distance)
    for _ in range(2000):
        x = 0
        for b in rng.sample(range(64), rng.randint(0, distance)):
            x |= 1 << b
        assert ring.first_key(np.array([x], np.uint64))[0] < len(ring.keys)
    far = np.array([(1 << (distance + 1)) - 1], np.uint64)
    assert ring.first_key(far)[0] == len(ring.keys)


@pytest.mark.parametrize("block", [4096, 40])
def test_links_of_dense_groups_equal_all_pairs(spark, block):
    rng = random.Random(block)
    fps = set()
    for _ in range(6):  # balls around a centre: hot keys; chains of small steps
        c = rng.getrandbits(64)
        for _ in range(150):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
        for _ in range(30):
            c ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(c)
    fps |= {rng.getrandbits(64) for _ in range(300)} | {0, 7, (1 << 64) - 1}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = links(spark.createDataFrame(signed, "fp long"), 3, block).collect()
    mask = (1 << 64) - 1
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for r in edges:
        a, b = r["a"] & mask, r["b"] & mask
        assert (a ^ b).bit_count() <= 3
        parent[root(a)] = root(b)
    want = plain_components(fps)
    groups = {}
    for f in fps:
        groups.setdefault(root(f), set()).add(want[f])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))
    assert len(edges) < 8 * 16 * len(fps)  # no group emitted all its pairs


def test_defined_cases(spark):
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(5, None), (4, ""), (9, " \n"), (None, base), (None, None), (1, base),
            (2, base.upper()), (2, "another text with the same id"), (3, "one"), (8, "ONE"),
            (7, base + " tail"), (7, base + " tail"), (-2, "a much longer tale " * 50)]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows],
                                 "doc_id long, text string, fp long, component long")
    found = simhash_duplicates(docs)
    assert got(found) == plain(rows)
    kept = {r["doc_id"] for r in found.collect() if r["kept"]}
    assert None in kept and 2 in kept and 5 not in kept
    empty = simhash_duplicates(docs.filter("doc_id > 100"))
    assert empty.columns == ["doc_id", "fingerprint", "component_id", "kept"]
    assert empty.collect() == []


def test_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = got(simhash_duplicates(docs))
    assert found == plain(rows)
    assert len({c for *_, c in found}) < len(rows)
