"""Circulant MinHash near duplicates against brute force over all pairs."""

import itertools
import random

import pytest
from conftest import SF_MID

from lateflow.llm.near_dup import near_duplicates

SCHEMA = "doc_id long, text string, lang string, rep string, key string"


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text, k=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def brute(rows, percent=85):
    """[(doc_id, n_shingles, component_id, kept)] over all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if i is None or j is None or not a or not b or i > j:
                continue
            n = len(a & b)
            if n * 100 >= (len(a) + len(b) - n) * percent:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    out = []
    for i, s in sets:
        c = i if i is None or not s else root(i)
        out.append((i, len(s), c, True if i is None else i == c))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted([tuple(r) for r in near_duplicates(df, **kw).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()], key=str)


def test_planted_groups(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(3000)]
    rows, i = [], 0
    for _ in range(6):
        base = [rng.choice(vocab) for _ in range(120)]
        rows += [(i + k, " ".join(base)) for k in range(5)]  # exact copies
        i += 5
        for edits in (1, 1, 2, 2, 2, 3, 4, 6):  # around the threshold
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((i, "  ".join(w).upper()))
            i += 1
        chain = list(base)  # a chain of edits: linked through its neighbours only
        for _ in range(6):
            chain[rng.randrange(len(chain))] = rng.choice(vocab)
            rows.append((i, "\n".join(chain)))
            i += 1
    rows += [(i + k, " ".join(rng.choice(vocab) for _ in range(60))) for k in range(30)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(a, b, None, "x", "y") for a, b in rows], SCHEMA)
    assert run(df) == brute(rows)


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c d e f"), (4, "a b c d e f"),
            (5, "A B C D E F"), (6, "one two"), (7, "one  two"), (8, "two one"),
            (9, "x " * 40000), (9, "x " * 40000), (10, "y" * 300000), (11, "É b"), (12, "é b"),
            (13, "a b c d e f"), (13, "one two")]
    df = spark.createDataFrame([(a, b, None, None, None) for a, b in rows], SCHEMA)
    assert run(df) == brute(rows)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_many_rounds(spark, monkeypatch):
    """The pivot rounds alone give the same components."""
    from lateflow.llm import near_dup

    monkeypatch.setattr(near_dup, "PAIRS_PER_MEMBER", 0)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(25):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = f"e{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame([(a, b, None, None, None) for a, b in rows], SCHEMA)
    assert run(df) == brute(rows)


def test_few_pairs_of_a_group_without_links_meet_their_texts(spark, monkeypatch):
    """Copies with two of 14 edits each: those that share no edit are far from a link (0.71),
    those that share one are close (0.846), and no shingle is any copy's own."""
    from lateflow.llm import near_dup

    met, old = [], near_dup.written

    def counted(df, name):
        out = old(df, name)
        if name == "near":
            met.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "written", counted)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(124)]
    rows = []
    for i, (x, y) in enumerate(itertools.combinations(range(14), 2)):
        w = list(base)
        for edit in (x, y):
            w[8 * edit + 6] = f"e{edit}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame([(a, b, None, None, None) for a, b in rows], SCHEMA)
    assert run(df) == brute(rows)
    assert sum(met) < 0.6 * len(rows) * (len(rows) - 1) / 2


@pytest.mark.parametrize("percent", [80, 85])
def test_whole_table(spark, percent):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert run(docs, threshold=percent / 100) == brute(rows, percent)


def test_bands_fit_the_threshold():
    from lateflow.llm import near_dup

    assert near_dup.banding(85) == (near_dup.ROWS, near_dup.BANDS)
    for percent in (50, 70, 80, 82, 85, 95):
        rows, bands = near_dup.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands < 3.2e-5
