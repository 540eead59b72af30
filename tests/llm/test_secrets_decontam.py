"""Secret scan and benchmark decontamination against brute force and planted cases."""

import hashlib
import random
import re
import string

import numpy as np
import pyarrow as pa
from conftest import SF_MID

from lateflow.llm import decontam, secret_scan
from lateflow.llm.queries import QUERIES
from lateflow.llm.shared import Bloom
from lateflow.llm.words import Words, text_buffer

PATTERNS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]+", 0, 24)}


def brute(text):
    out = []
    for n, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m.group(group)) >= least:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return [x for *_, x in sorted(out)]


def check(rows, got):
    for i, text in rows:
        base, r = brute(text), got[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
            sum(x.startswith(k) for x in base) for k in PATTERNS)
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert [x for x in spans if not x.startswith("format")] == base
        starts = [int(x.split(":")[1]) for x in spans]
        assert starts == sorted(starts)


def test_base_spans_and_inferred_formats(spark):
    rng = random.Random(4)
    key = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    prose = ["the and of tion ing that with house river green walking slowly".split()
             for _ in range(3)]
    texts = [" ".join(rng.choice(rng.choice(prose)) for _ in range(60))
             + f" password={key(24)} x" for _ in range(120)]
    lone = key(24)
    texts += [f"see {lone} for it", "Passwd: 'abc' secret = \"abcdef\"", "token:=aaaaaa secret:token=abcdefg",
              "AKIA" + "A" * 15, "AKIA" + "A" * 16 + "AKIA" + "B" * 30, "\u00e9\u00e9 " + "a1" * 12 + "g", "",
              None, "API_KEY='" + "k" * 50000, "f" * 23 + "F" + "0" * 24, "\u017fecret=abcdefgh", "password  =  abcdef"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows],
                               "doc_id long, text string, spans string, n_hex string")
    got = {r["doc_id"]: r for r in secret_scan.scan(df, secret_scan.fit(df)).collect()}
    check(rows, got)
    at = texts[120].index(lone)
    assert f"format:{at}:{at + 24}" in got[120]["spans"]  # no keyword: by its form alone
    assert not any("format" in got[i]["spans"] for i in range(120))


def test_formats_in_parts_of_runs_and_beside_base_spans(spark):
    rng = random.Random(5)
    key = lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    words = "the house river green walking slowly information usually something".split()
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    a, b, path = key(24), key(24), "usually/" * 20
    texts = [f"{prose(60)} password={key(24)} x" for _ in range(200)] + [
        f"see {path}{a} there",  # past the first 128 characters of its run
        f"see {'0a' * 12}-{b} there",  # joined to a base span
        f"see {path}something there"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(df, secret_scan.fit(df)).collect()}
    at = texts[200].index(a)
    assert got[200] == f"format:{at}:{at + 24}"
    assert got[201] == f"hex:4:28,format:29:53"
    assert got[202] == "" and not any("format" in got[i] for i in range(200))


def test_no_labels_and_empty(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(None, "just words here"), (1, None), (1, None)], schema)
    formats = secret_scan.fit(df)
    assert formats.kinds == {}
    assert [r["spans"] for r in secret_scan.scan(df, formats).collect()] == ["", "", ""]
    assert secret_scan.scan(df.limit(0), formats).count() == 0


def test_secrets_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(rows, {r["doc_id"]: r for r in QUERIES["op4_grammar_secrets"](spark, SF_MID).collect()})


BENCH = [(1, "Alice has 12 apples and gives 5 kg of them to her friend Bob in Paris before 7 pm."),
         (2, "A train leaves the station at 80 km and meets another train after 3 hours on track 80."),
         (3, "too short"), (4, None), (None, "which of these rivers flows through the old capital of the northern kingdom")]


def run(spark, texts, bench=BENCH):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, key string, item_ids string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    return {r["doc_id"]: r for r in decontam.contamination(docs, items).collect()}


def test_templates_and_slots(spark):
    filler = "some words that come before and after the passage in question here "
    texts = [
        BENCH[0][1], filler + BENCH[0][1].lower() + " " + filler, BENCH[0][1].upper(),
        # other numbers and names, consistently
        filler + "Carol has 40 apples and gives 9 kg of them to her friend Dave in Berlin before 3 pm.",
        # item 2 says 80 twice: the same other number twice fits, two numbers don't
        "A train leaves the station at 95 km and meets another train after 4 hours on track 95.",
        "A train leaves the station at 95 km and meets another train after 4 hours on track 96.",
        filler * 3, "", None, "too short", "has 12 apples", filler + BENCH[4][1] * 1,
        "Alice, has 12 apples: and (gives) 5 kg of them to \"her\" friend Bob in Paris - before 7 pm!"]
    got = run(spark, texts)
    hits = {i: r["n_items"] for i, r in got.items()}
    assert [hits[i] > 0 for i in range(len(texts))] == [
        True, True, True, True, True, False, False, False, False, True, False, True, True]
    assert got[0]["item_ids"] == [1] and got[4]["item_ids"] == [2] and got[11]["item_ids"] == []
    assert all(r["contaminated"] == (r["n_items"] > 0) for r in got.values())


def test_a_conflict_takes_away_its_own_windows_only(spark):
    words = [f"w{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(60)]
    long = lambda a, b: " ".join(words[:10] + [a] + words[10:50] + [b] + words[50:])
    bench = [(1, long("80", "80")),
             (2, "Tom has 3 apples in a large basket and then buys 5 more of them at the market")]
    got = run(spark, [
        long("80", "81"),  # verbatim but for one of two equal numbers
        long("95", "96"),  # equal by chance in the item, different in the copy
        "Tom has 4 apples in a large basket and then buys 4 more of them at the market",
        "Tom has 4 pears"], bench)
    assert [got[i]["item_ids"] for i in range(4)] == [[1], [1], [2], []]


def test_broad_placeholders_short_items_and_shifts(spark):
    bench = [(1, "Tom drives to IBM with twelve boxes, covers 5km and then sells them near Paris."),
             (2, "the slow green river runs below an old stone bridge towards some quiet town"),
             (3, "every morning the baker carries warm bread across the wide market square before "
                 "the first bells ring over town")]
    two, three = bench[1][1], bench[2][1]
    got = run(spark, [
        # names at the beginning, in capitals and of two words, number words, attached units
        "Alice drives to NASA with seven boxes, covers 40 miles and then sells them near New York.",
        two.replace("below", "under"), three.replace("wide", "broad"),  # one word in the middle
        three.replace("across the", "right across all of the"),  # words put in
        "the slow green river is not what a baker carries before the first bells"], bench)
    assert [got[i]["item_ids"] for i in range(5)] == [[1], [2], [3], [3], []]


def test_exact_copies_of_dense_short_and_unspaced_items(spark):
    bench = [(1, "What is 12 times 7?"), (2, "Compute 15 + 27 * 3"),
             (3, "Anna Berta Carl Dora Emil Frida Georg Hanna Ida Jakob"),
             (4, "1 2 3 5 8 13 21 34 55 89 144"), (5, "哪一条河流经过这个王国的古老首都？"), (6, "小明有多少")]
    copies = [f"well then {t} and so on" for _, t in bench[:4]] + [
        f"你好{t}谢谢" for _, t in bench[4:]]
    got = run(spark, copies + ["Compute 15 - 27 / 3", "What is 13 times 8?", "这个古老的河流。"], bench)
    assert [got[i]["item_ids"] for i in range(9)] == [[1], [2], [3], [4], [5], [6], [], [], []]


def test_items_of_one_and_two_words(spark):
    bench = [(1, "Bonjour monde"), (2, "Paris")]
    got = run(spark, ["Bonjour monde", "x Bonjour monde y", "bonjour le monde", "monde, bonjour",
                      "Paris.", "a day in Paris", " paris "], bench)
    assert [got[i]["item_ids"] for i in range(7)] == [[1], [1], [], [], [2], [], [2]]


def test_repeats_and_empty_tables(spark):
    got = run(spark, [" ".join([BENCH[1][1]] * 300)] * 3)
    assert all(r["item_ids"] == [2] for r in got.values())
    assert run(spark, []) == {}
    assert not run(spark, [BENCH[0][1]], [(None, None)])[0]["contaminated"]


def test_planted_passages_of_the_whole_table(spark):
    """The documents that hold an item's words in order, and no others."""
    plain = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    items = [plain(r["text"]) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    want = {r["doc_id"] for r in docs if any(x in plain(r["text"]) for x in items)}
    got = QUERIES["op8_template_decontam"](spark, SF_MID).collect()
    assert {r["doc_id"] for r in got if r["contaminated"]} == want
    assert len(got) == len(docs)


def test_plain_words_take_no_step_each(monkeypatch):
    """Words of letters are told apart together, however many different ones a text has."""
    rng = random.Random(8)
    plain = {"".join(rng.choices("abcdefgéñжя", k=9)) for _ in range(5000)}
    text = " ".join(f"{rng.choice(['', '('])}{w.capitalize() if w < 'b' else w}{rng.choice(['', '.', ',', '?!'])}"
                    for w in sorted(plain))
    asked, kind = [], decontam._kind
    monkeypatch.setattr(decontam, "_kind", lambda w: asked.append(w) or kind(w))
    decontam._words.clear()
    decontam._tokens(Words(*text_buffer(pa.array([text]))))
    assert len(asked) < 10


def test_tokens_are_what_each_word_is():
    rng = random.Random(9)
    signs = list(".,;:!?\"'()[]*&-$%€£=+_~@|/\\<>^`#{}") + list("«»“”’…°।。！ \u0085\x1c\x7f")
    letters = list("abcABC019éÉßÜöÑ÷×İıΣσςЖжЁאبª²½ǅ٣中ไ😀")
    known = [*decontam.UNITS, *decontam._SPELT, "Twelve", "twenty-one", "5km", "$3", "A", "I", "IBM",
             "ABc", "ABC", "(aB", "(Ab", "(A)", "O'Neil", "McD", "***", "?\"'", "x:*)", "-", "a-b", "a1b"]

    def word():
        w = rng.choice(known) if rng.random() < .3 else "".join(rng.choices(letters, k=rng.randint(1, 5)))
        return "".join([rng.choice(signs) * (rng.random() < .3), w, *rng.choices(signs, k=rng.choice((0, 0, 1, 2)))])

    texts = [" ".join(word() for _ in range(rng.randint(0, 6))) for _ in range(3000)] + [
        "", None, "x", "É", "*", "(Aa"]
    words = Words(*text_buffer(pa.array(texts)))
    decontam._words.clear()
    literal, kind, ends, fill = decontam._tokens(words)
    want = [decontam._kind(words.raw[a:b].tobytes().decode()) for a, b in zip(words.start, words.end)]
    hashed = lambda ts: Words(*text_buffer(pa.array(["".join(t.split()) or "." for t in ts]))).hash
    assert literal.tolist() == hashed([w[0] for w in want]).tolist()
    assert kind.tolist() == [w[1] for w in want] and ends.tolist() == [w[2] for w in want]
    assert fill.tolist() == hashed([w[3] for w in want]).tolist()


def test_filter_narrowed_or_whole():
    """The same rows pass, whether few or most of a batch may be keys."""
    rng = np.random.default_rng(1)
    keys, others = (rng.integers(0, 1 << 64, 4000, dtype=np.uint64) for _ in range(2))
    bloom = Bloom(np.zeros(1 << 12, dtype=np.uint64))
    for i in range(Bloom.PROBES):
        p = (keys >> np.uint64(7 * i)) & bloom.mask
        np.bitwise_or.at(bloom.words, (p >> np.uint64(6)).astype(int), np.uint64(1) << (p & np.uint64(63)))
    alone = np.array([bloom.holds(h[None])[0] for h in others])
    assert 0 < alone.sum() < 400 and bloom.holds(keys).all() and not len(bloom.holds(keys[:0]))
    assert (bloom.holds(others) == alone).all()
    assert bloom.holds(np.concatenate((keys, others)))[4000:].tolist() == alone.tolist()
