import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lateflow.llm import phrases as P

_LOWER = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least=10, longest=3, covered=50, top=2000):
    f, words = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(_LOWER)):
            ws = re.findall(r"[^ \t]+", piece)
            words[lang] += len(ws)
            for n in range(1, longest + 1):
                for i in range(len(ws) - n + 1):
                    f[lang, tuple(ws[i:i + n])] += 1
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    drop = set()
    for (lang, ws), a in cand.items():
        for m in range(2, len(ws)):
            for i in range(len(ws) - m + 1):
                if 100 * a >= covered * f[lang, ws[i:i + m]]:
                    drop.add((lang, ws[i:i + m]))
    out = defaultdict(list)
    for (lang, ws), a in cand.items():
        if (lang, ws) in drop:
            continue
        best = min((10**6 * a * a // (f[lang, ws[:k]] * f[lang, ws[k:]]), k)
                   for k in range(1, len(ws)))
        s, k = best
        out[lang].append((-s, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return [(lang, r + 1, p.decode(), -a, x, y, words[lang], -s) for lang in sorted(out)
            for r, (s, a, p, x, y) in enumerate(sorted(out[lang])[:top])]


def got(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.orderBy("lang", "rank").collect()]


def texts(seed, n=160):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "日本", "a'b", "x-y", "new", "york", "city", " z"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "\x0c; ", ":", "!?"]
    out = []
    for _ in range(n):
        t = "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))
        out.append((t + "new york city " * rng.randint(0, 2), rng.choice(["en", "fr", None, "und"])))
    return out + [(None, "en"), ("", "fr"), ("..,;", None), (None, None), (out[0])]


def frame(spark, rows):
    data = [(i % 50 if i % 7 else None, t, g, 1, "x") for i, (t, g) in enumerate(rows)]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, n int, phrase string").repartition(3)


@pytest.mark.parametrize("bits", [64, 9])
def test_equals_plain_counts_also_where_fingerprints_collide(spark, bits):
    rows = texts(1)
    found = P.collocations(frame(spark, rows), bits=bits)
    assert found.columns == COLUMNS
    assert got(found) == plain(rows)


@pytest.mark.parametrize("least, longest, covered, top", [
    (2, 3, 80, 5), (3, 4, 50, 40), (1, 2, 50, 1000), (4, 5, 101, 3)])
def test_parameters(spark, least, longest, covered, top):
    rows = texts(least, 60)
    found = P.collocations(frame(spark, rows), least, longest, covered, top)
    assert got(found) == plain(rows, least, longest, covered, top)


def test_products_pass_64_bits(spark):
    # 2^63 < 10^6 * a^2 from a = 3,037,001 on; the scores stay exact
    spark.conf.set("spark.sql.ansi.enabled", "true")
    one = "a b " * 60_000
    rows = [(one, "en")] * 52
    found = got(P.collocations(frame(spark, rows), longest=2))
    assert found == plain([(one, "en")] * 52, longest=2)
    assert found[0][3] > 3_037_001


def test_empty_tables(spark):
    df = frame(spark, texts(2, 4))
    assert P.collocations(df.filter("doc_id > 99")).collect() == []
    assert P.collocations(df.filter("text = ''")).collect() == []


def test_long_texts_are_cut_between_pieces():
    rng = random.Random(5)
    text = "".join(rng.choice(["ab", "c", "Ab"]) + rng.choice([" ", " ", "\t ", ".", "\n"])
                   for _ in range(4000)) + "x" * 3000 + " tail of it, " + "y " * 2000
    column = pa.array(["short one", text, None, "end"])
    whole = P.Pieces(*P.text_buffer(column))
    seeds = np.array([1, 2, 3, 4], dtype=np.uint64)
    for n in (1, 2, 3):
        first, h, check = whole.ngrams(n, seeds, 64)
        offsets = P.text_buffer(column)[1]
        want = sorted(zip(whole.row[first].tolist(),
                          (whole.start[first] - offsets[whole.row[first]]).tolist(),
                          h.tolist(), check.tolist()))
        have = []
        for raw, at, rows, base in P.parts(column, 500):
            assert len(raw) < 5000
            p = P.Pieces(raw, at)
            first, h, check = p.ngrams(n, seeds[rows], 64)
            have += zip(rows[p.row[first]].tolist(),
                        (p.start[first] - at[p.row[first]] + base[p.row[first]]).tolist(),
                        h.tolist(), check.tolist())
        assert sorted(have) == want


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert got(P.collocations(docs)) == plain(rows)
