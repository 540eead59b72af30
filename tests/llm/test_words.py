"""The word kernel against plain Python."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lateflow.llm import words as W


def plain(text):
    return (text or "").encode().lower().split()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ \t\n\x0b\r\x0c\x85\u00a0éÉ。", max_size=30)),
                max_size=8))
def test_words_of_texts(texts):
    words = W.Words(*W.text_buffer(pa.array(texts, pa.string())))
    got = [[] for _ in texts]
    for i, d in enumerate(words.doc.tolist()):
        got[d].append(words.word(i))
    assert got == [plain(t) for t in texts]
    by_word = {}
    for i in range(len(words)):
        assert by_word.setdefault(words.word(i), words.hash[i]) == words.hash[i]
    assert len(set(map(int, by_word.values()))) == len(by_word)


def test_long_texts_cross_segments(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(20000))
    whole = W.Words(*W.text_buffer(pa.array([text]))).hash
    monkeypatch.setattr(W, "SEGMENT", 1000)
    W._powers.clear()
    assert (W.Words(*W.text_buffer(pa.array([text]))).hash == whole).all()
    W._powers.clear()


def test_shingles_depend_on_order_and_number():
    texts = ["a b c d e", "e d c b a", "a b c d", "a b c", "a b c d e f", "", None]
    doc, s = W.shingles(W.Words(*W.text_buffer(pa.array(texts))))
    sets = [set(s[doc == i].tolist()) for i in range(len(texts))]
    assert [len(x) for x in sets] == [1, 1, 1, 1, 2, 0, 0]
    assert sets[0] < sets[4]
    assert len(sets[0] | sets[1] | sets[2] | sets[3]) == 4


def test_row_slices_cover_all_rows():
    column = pa.array(["x" * n for n in (0, 5, 100, 0, 7, 300, 1)])
    cuts = list(W.row_slices(column, 50))
    assert cuts[0][0] == 0 and cuts[-1][1] == 7
    assert all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert np.all([b > a for a, b in cuts])
