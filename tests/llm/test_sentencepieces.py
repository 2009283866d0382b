"""Ids and texts equal to those of the library, on chosen, random and odd texts."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from helpers import clashing
from marketstream.llm import queries
from marketstream.llm import sentencepieces as pieces
from marketstream.llm.words import texts_of

PATH = public_tokenizers.path(queries.PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.model_of(pieces.read_model(PATH))


def encode(texts, model):
    data, offsets = texts_of(pa.array(texts, pa.string()))
    ids, first = pieces.encode(data, offsets, model)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


def decode(lists, model):
    offsets = np.cumsum([0, *map(len, lists)])
    return pieces.decode(np.array([i for x in lists for i in x], np.int64), offsets, model)


CHOSEN = [
    "", " ", "  a b", "a  b ", "▁x▁ ▁", "tab\tnl\nnul\0z", "<s>x</s><unk>", "<0x41>", "a　b", "ﬁ ① é é", "a" * 999, " " * 37,
    "=-" * 50 + "=" * 45, "漢字 \U0001f600\U0001f468‍\U0001f469 ünï �", "3.14159 2026-01-01", "ab" * 400 + "abc" * 300,
]


def test_chosen_texts(library, model):
    assert encode(CHOSEN, model) == [library.encode(t) for t in CHOSEN]
    assert decode(encode(CHOSEN, model), model) == [t.replace("▁", " ") for t in CHOSEN]


@pytest.mark.parametrize(("step", "bits"), [(64, 2), (pieces.STEP_BYTES, pieces.SLOT_BITS), (pieces.STEP_BYTES, 1)])
def test_random_texts(library, model, monkeypatch, step, bits):
    """Texts of random characters and of random pieces, whole and in small parts, with many and few slots for equal words."""
    monkeypatch.setattr(pieces, "STEP_BYTES", step)
    monkeypatch.setattr(pieces, "SLOT_BITS", bits)
    rng = random.Random(3)
    names = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    kinds = ["ab", "abc ", "ethaisnorld", "  \n\t-=", "абвгде ", "漢字的是一 在", "".join(sorted(set("".join(names)))), names]
    texts = ["".join(rng.choice(kind) for _ in range(rng.randrange(80))) for kind in kinds for _ in range(250)]
    got = encode(texts, model)
    assert got == [library.encode(t) for t in texts]
    assert decode(got, model) == texts


def test_words_of_one_hash(library, model, monkeypatch):
    """Words are compared, so equal hashes of different words change nothing."""
    monkeypatch.setattr(pieces, "run_hashes", lambda values, starts, ends: np.zeros(len(starts), np.uint64))
    assert encode(CHOSEN, model) == [library.encode(t) for t in CHOSEN]


def test_random_ids(library, model):
    """Any ids decode as the library decodes them: controls, unknown ids and bytes that are no text."""
    rng = random.Random(4)
    pools = [range(3), range(259), range(130, 259), range(3, 31_999), [259, 260, 0, 1, 29_871, 200, 300]]
    lists = [[rng.choice(pool) for _ in range(rng.randrange(12))] for pool in pools for _ in range(300)]
    assert decode(lists, model) == [library.decode(x) for x in lists]
    with pytest.raises(ValueError, match="not of the model"):
        decode([[32_000]], model)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(odd, library):
    expected = []
    for row in odd.collect():
        ids = library.encode(row["text"] or "")
        expected.append((str(row["doc_id"]), len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    got = pieces.report(clashing(odd, "ids", "decoded", "_ids"), PATH)
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == sorted(expected)


def test_empty_table(empty):
    assert pieces.report(empty, PATH).collect() == []


def test_columns_stay(odd, library):
    got = pieces.tokenised(clashing(odd, "ids"), PATH)
    assert got.columns == [*odd.columns, "ids"] and got.count() == odd.count()
    assert all(r["ids"] == library.encode(r["text"] or "") for r in got.collect())


def test_null_lists(spark):
    rows = spark.createDataFrame([(None,), ([],), ([None, 259],)], "ids array<int>")
    proto = pieces.read_model(PATH)
    assert {r[0] for r in rows.select(pieces.decoded(rows["ids"], proto)).collect()} == {"", pieces.UNKNOWN + "  "}


def test_other_models_are_refused():
    with pytest.raises(Exception):  # noqa: B017
        pieces.model_of(b"no model")


def test_registered_query(spark, sf_dir, library):
    """The whole table, document by document."""
    docs = queries.table(spark, sf_dir, "documents").collect()
    expected = []
    for row in docs:
        ids = library.encode(row["text"] or "")
        expected.append((row["doc_id"], len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert sorted(map(tuple, queries.op11_sentencepiece_rounds(spark, sf_dir).collect())) == sorted(expected)
