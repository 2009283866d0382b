import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import prose  # noqa: E402

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    """A table of documents from texts, ids counting from 1, or from (id, text, source)."""

    def build(rows):
        rows = [r if isinstance(r, tuple) else (i, r, "web") for i, r in enumerate(rows, 1)]
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, COLUMNS)

    return build


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in every column, empty and blank texts, a very long one, ties and repeated rows."""
    rng = random.Random(5)
    texts = [prose(rng) for _ in range(6)]
    long = " ".join(prose(rng) for _ in range(400))
    return make([
        (1, texts[0], "a"), (2, texts[0], "b"), (2, texts[0], "b"), (3, texts[1], None), (3, texts[2], "a"), (None, texts[3], "b"),
        (None, None, None), (4, None, "a"), (5, "", "a"), (6, " \n\t ", "c"), (7, long, "c"), (8, "one", "a"), (9, "One two", None),
        (10, texts[4] + "\n" + texts[5], "b"), (-11, "née Ünï 漢字 \U0001f600 end.", "a"), (12, "né\x00ro a\x00", "a"),
    ])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)

