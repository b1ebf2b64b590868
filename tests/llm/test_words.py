"""Words and windows against regular expressions."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from brindle.llm import words as w
from tests.llm import plain

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAzZ09 .-\néß中 ", max_size=60)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    got = w.split(texts)
    assert got.counts.tolist() == [len(plain.words(t)) for t in texts]
    for t, text in enumerate(texts):
        at = range(got.first[t], got.first[t + 1])
        assert [got.text[got.start[i] : got.end[i]].decode() for i in at] == plain.words(text)


def test_equal_words_have_equal_hashes_and_others_do_not():
    many = [f"word{i}" for i in range(50_000)]
    got = w.split([" ".join(many), " ".join(reversed(many)).upper()])
    assert (got.of(0) == got.of(1)[::-1]).all()
    assert len(np.unique(got.hash)) == len(many)


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(f"{i}x" for i in range(5000))
    whole = w.split([text])
    monkeypatch.setattr(w, "PIECE", 64)
    assert (w.split([text]).hash == whole.hash).all()
    one = "é" * 10_000
    assert len(w.split([one, one]).hash) == 2


def test_windows_stay_inside_texts():
    got = w.split(["a b c", "a b", None, "b c d e"])
    hashes, at = w.windows(got, 3)
    assert at.tolist() == [0, 5, 6]
    assert len(set(hashes.tolist())) == 3
    assert len(w.windows(w.split([None, ""]), 3)[0]) == 0
