"""Cuts and forms against regular expressions, and the way back from the output."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import clashing
from marketstream.llm import fill_in_middle as fim
from marketstream.llm.words import texts_of

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(key, text):
    h = digest(f"1:{'' if key is None else key}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


def random_text(rng):
    kinds = ["ab", "aZ é1", "  \n", "漢字\U0001f600a", "<PSM>", "abcdefgh" * 9 + " "]
    kind = rng.choice(kinds)
    return "".join(rng.choice(kind) for _ in range(rng.choice([0, 1, 5, 40, 700])))


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, fim.BLOCK])
def test_cuts(block):
    """Every block size finds the code points before any unit, at block edges and inside long units too."""
    rng = random.Random(block)
    texts = [random_text(rng) for _ in range(200)]
    data, offsets = texts_of(pa.array(texts, pa.string()))
    draws = np.array([rng.randrange(1 << 32) for _ in texts])
    n, (found,) = fim.points_before(data, offsets, [draws], block)
    units = [UNIT.findall(t) for t in texts]
    assert n.tolist() == [len(u) for u in units]
    assert found.tolist() == [len("".join(u[: d % (len(u) + 1)])) for u, d in zip(units, draws.tolist(), strict=True)]


def test_descent():
    """The tree alone: blocks, units and code points before each unit's block."""
    data, offsets = texts_of(pa.array(["", "a" * 10 + " b é", "x"]))
    unit, point = fim.begins(data, offsets)
    trees = fim.trees_of(unit, point, offsets, 4)
    assert trees.n_blocks.tolist() == [0, 4, 1]
    at, units, points = fim.descend(trees, np.array([1, 1, 1, 1, 1, 2]), np.array([0, 1, 2, 3, 4, 0]))
    assert at.tolist() == [0, 2, 2, 3, 3, 0] and units.tolist() == [0, 1, 1, 3, 3, 0] and points.tolist() == [0, 8, 8, 12, 12, 0]


def test_random_rows(make):
    rng = random.Random(9)
    docs = make([(i, random_text(rng), "a") for i in range(400)])
    got = fim.transformed(docs).select("doc_id", "text", "fim.*").withColumn("back", fim.restored(F.col("output"), F.col("form")))
    rows = got.collect()
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["doc_id"], r["text"])
        assert r["back"] == r["text"]


def test_odd_rows(odd):
    got = fim.report(clashing(odd, "fim", "_cut", "_form", "n"))
    expected = []
    for r in odd.collect():
        n, form, a, b, output = brute(r["doc_id"], r["text"])
        expected.append((r["doc_id"], n, form, a, b, digest(output), digest(r["text"] or "")))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_shares_and_columns(odd):
    got = fim.transformed(clashing(odd, "_cut", "fim"), plain=100)
    assert got.columns == [*odd.columns, "_cut", "fim"] and {r["fim"]["form"] for r in got.collect()} == {"plain"}
    forms = {r["fim"]["form"] for r in fim.transformed(odd, plain=0, suffix_first=100).collect() if r["text"]}
    assert forms == {"spm"}


def test_empty_table(empty):
    assert fim.report(empty).collect() == []
