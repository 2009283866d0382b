"""Vectorised words against regular expressions."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from marketstream.llm import words

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB1 .\n\té漢-\x0b", max_size=12)), max_size=8)


@given(texts, st.integers(1, 30))
@pytest.mark.parametrize(("kind", "pattern"), [(words.ALPHANUMERIC, rb"[0-9A-Za-z\x80-\xff]+"), (words.NOT_SPACE, rb"[^\x20\x09-\x0d]+")])
def test_words_are_those_of_the_pattern(kind, pattern, some, size):
    got = {}
    for a, b, found in words.each_piece(pa.array(some, pa.string()), kind, size):
        for i in range(a, b):
            at = slice(found.first[i - a], found.first[i - a + 1])
            got[i] = [bytes(found.data[s:e]) for s, e in zip(found.starts[at], found.ends[at], strict=True)]
    assert [got[i] for i in range(len(some))] == [re.findall(pattern, (t or "").encode()) for t in some]


def test_equal_words_and_runs_have_equal_hashes():
    found = words.words(*words.texts_of(pa.array(["one Two one two", "ONE two, xtwo"])), words.NOT_SPACE)
    one, two = found.hashes[:2]
    assert found.hashes[:6].tolist() == [one, two, one, two, one, found.hashes[5]] and found.hashes[5] != two
    runs = words.run_hashes(found.hashes, np.array([0, 2, 1, 4]), np.array([2, 4, 3, 6]))
    assert runs[0] == runs[1] and len(set(runs.tolist())) == 3
    many = words.words(*words.texts_of(pa.array([" ".join(map(str, range(100_000)))])), words.NOT_SPACE)
    assert len(set(many.hashes.tolist())) == 100_000
