"""Fill-in-the-middle: each text is cut at two of its units and its middle moved behind the rest.

A unit is a run of the letters A-Z and a-z, or any other single code point. To find a cut by its unit number, a text is
divided into blocks of a fixed number of bytes, and a Fenwick tree over the blocks holds how many units and code points begin in them.
A binary-lifting descent of the tree finds the block of a cut together with the units and code points before it; the
boundary is then located among the block's own bytes. The trees of many texts lie in flat arrays and are descended together.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import free_name
from marketstream.llm.words import byte_set, pieces, texts_of

LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A))
#: Bytes of a block.
BLOCK = 256
#: Texts are handled in pieces of about so many bytes.
STEP_BYTES = 1 << 20
#: The signs that begin the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
#: Of 100 texts so many stay plain, and of 100 others so many are suffix-first.
PLAIN, SUFFIX_FIRST = 10, 20


class Trees(NamedTuple):
    """The Fenwick trees of many texts. Node i (from 1) of text t stands at ``first[t] + i - 1``."""

    first: np.ndarray
    n_blocks: np.ndarray
    units: np.ndarray
    points: np.ndarray


def begins(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte whether a unit, and whether a code point, begins with it."""
    point = (data & 0xC0) != 0x80
    letter = LETTER[data]
    goes_on = np.zeros(len(data), bool)
    goes_on[1:] = letter[1:] & letter[:-1]
    heads = offsets[:-1]
    goes_on[heads[heads < len(data)]] = False
    return point & ~goes_on, point


def trees_of(unit: np.ndarray, point: np.ndarray, offsets: np.ndarray, block: int) -> Trees:
    """One tree for each text, over blocks of ``block`` bytes from its first byte on."""
    n_blocks = -(-np.diff(offsets) // block)
    first = np.r_[0, np.cumsum(n_blocks)]
    text = np.repeat(np.arange(len(n_blocks)), n_blocks)
    number = np.arange(first[-1]) - first[text] + 1
    low = number & -number
    ends = np.minimum(offsets[text] + number * block, offsets[text + 1])
    begin = offsets[text] + (number - low) * block

    def nodes(flag: np.ndarray) -> np.ndarray:
        before = np.r_[0, np.cumsum(flag)]
        return before[ends] - before[begin]

    return Trees(first[:-1], n_blocks, nodes(unit), nodes(point))


def descend(trees: Trees, text: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each (text, unit number): blocks, units and code points before the block in which that unit begins."""
    at, units, points = (np.zeros(len(text), np.int64) for _ in range(3))
    size = trees.n_blocks[text]
    step = 1 << int(size.max(initial=0)).bit_length()
    while step:
        node = at + step
        inside = node <= size
        place = np.where(inside, trees.first[text] + node - 1, 0)
        goes = inside & (units + trees.units[place] <= wanted) if len(trees.units) else inside
        at, units = np.where(goes, node, at), np.where(goes, units + trees.units[place], units)
        points = np.where(goes, points + trees.points[place], points)
        step >>= 1
    return at, units, points


def points_before(data: np.ndarray, offsets: np.ndarray, draws: list[np.ndarray], block: int = BLOCK) -> tuple[np.ndarray, list[np.ndarray]]:
    """The units of each text, and for each array of draws the code points before unit draw % (units + 1)."""
    unit, point = begins(data, offsets)
    sums = np.r_[0, np.cumsum(unit)]
    n = sums[offsets[1:]] - sums[offsets[:-1]]
    trees = trees_of(unit, point, offsets, block)
    out = []
    for draw in draws:
        wanted = draw % (n + 1)
        text = np.flatnonzero((wanted > 0) & (wanted < n))
        at, units, points = descend(trees, text, wanted[text])
        # The boundary within the block: the unit that has so many others of its block before it.
        here = offsets[text] + at * block
        span = np.minimum(here[:, None] + np.arange(block), len(data) - 1)
        inside = here[:, None] + np.arange(block) < offsets[text + 1][:, None]
        seen = np.cumsum(unit[span] & inside, axis=1)
        to = np.argmax(seen > (wanted[text] - units)[:, None], axis=1)
        ahead = np.where(to > 0, np.cumsum(point[span], axis=1)[np.arange(len(text)), to - 1], 0) if len(text) else 0
        found = np.zeros(len(n), np.int64)
        found[text] = points + ahead
        whole = wanted == n
        total = np.r_[0, np.cumsum(point)]
        found[whole] = (total[offsets[1:]] - total[offsets[:-1]])[whole]
        out.append(found)
    return n, out


def cuts(text: Column, first: Column, second: Column, block: int = BLOCK) -> Column:
    """A struct of n (units of the text), prefix_chars and middle_chars (code points) for two draws, whole numbers from 0.

    The prefix ends after the smaller of draw % (n + 1) units, the middle after the larger. A null text is empty.
    """

    @F.arrow_udf("struct<n: bigint, prefix_chars: bigint, middle_chars: bigint>")
    def cut(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        draws = [d.to_numpy(zero_copy_only=False).astype(np.int64) for d in (first, second)]
        data, offsets = texts_of(texts)
        out = [(np.zeros(0, np.int64),) * 3]
        for a, b in pieces(offsets, STEP_BYTES):
            part = offsets[a : b + 1]
            n, (x, y) = points_before(data[part[0] : part[-1]], part - part[0], [d[a:b] for d in draws], block)
            out.append((n, np.minimum(x, y), np.abs(x - y)))
        columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
        return pa.StructArray.from_arrays(columns, ["n", "prefix_chars", "middle_chars"])

    return cut(text, first, second)


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits for each key: the first digits of the SHA-256 of seed, colon and key; a null key is empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def transformed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "fim",
    plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, seed: int = SEED, block: int = BLOCK,
) -> DataFrame:
    """``docs`` with ``name``: a struct of n, form, prefix_chars, middle_chars and output, the text in its new order.

    ``plain`` of 100 texts stay as they are, as do empty and null texts and those that contain one of the three signs;
    of the others ``suffix_first`` of 100 are ``spm`` (suffix, prefix, middle), the rest ``psm``. Lengths are null where
    the form is plain. Everything is drawn from the key, so rows with equal keys and texts have equal results. Other
    columns stay; one called ``name`` is replaced.
    """
    first, second, third, fourth = draws(F.col(key), seed)
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    cut = free_name(docs, "_cut")
    found = docs.withColumn(cut, cuts(F.col(text), first, second, block))
    form = (
        F.when((F.col(cut)["n"] == 0) | marked | (third % 100 >= 100 - plain), "plain")
        .when(fourth % 100 < suffix_first, "spm")
        .otherwise("psm")
    )
    a, b = F.col(cut)["prefix_chars"], F.col(cut)["middle_chars"]
    before, middle = F.substring(whole, F.lit(1), a.cast("int")), F.substring(whole, (a + 1).cast("int"), b.cast("int"))
    after = F.substring(whole, (a + b + 1).cast("int"), F.length(whole))
    shape = free_name(found, "_form")
    found = found.withColumn(shape, form)
    is_plain = F.col(shape) == "plain"
    output = (
        F.when(is_plain, whole)
        .when(F.col(shape) == "psm", F.concat(F.lit(PREFIX), before, F.lit(SUFFIX), after, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), after, F.lit(PREFIX), before, F.lit(MIDDLE), middle))
    )
    result = F.struct(
        F.col(cut)["n"].alias("n"), F.col(shape).alias("form"),
        F.when(~is_plain, a).alias("prefix_chars"), F.when(~is_plain, b).alias("middle_chars"), output.alias("output"),
    )
    return found.withColumn(name, result).drop(cut, shape)


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from its output and form alone. A text with a sign stays plain, so signs are unique."""
    body = F.substring_index(output, MIDDLE, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(F.substring_index(F.substring_index(body, SUFFIX, 1), PREFIX, -1), middle, F.substring_index(body, SUFFIX, -1))
    spm = F.concat(F.substring_index(body, PREFIX, -1), middle, F.substring_index(F.substring_index(body, PREFIX, 1), SUFFIX, -1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    fim = F.col("fim")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return transformed(rows, **options).select(
        "doc_id", fim["n"].alias("n"), fim["form"].alias("form"),
        fim["prefix_chars"].alias("prefix_chars"), fim["middle_chars"].alias("middle_chars"),
        digest(fim["output"]).alias("output_sha256"), digest(restored(fim["output"], fim["form"])).alias("restored_sha256"),
    )
