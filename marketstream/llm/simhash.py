"""SimHash near-duplicates: fingerprints of word shingles, linked when few bits differ.

Pairs of different fingerprints are found with pivot distance tables. A table row holds a fingerprint and its Hamming
distances to many reference fingerprints. Two fingerprints with at most d different bits have distances to any reference
that differ by at most d, so a larger difference in one coordinate discards a pair before the bits are compared.
Only fingerprints that agree on all but d of d + 4 blocks of bits meet at all (any pair with at most d different bits
does for some choice of blocks), which keeps the table a plain equality join and its buckets small.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import free_name, written
from marketstream.llm.components import components
from marketstream.llm.words import GOLDEN, mix
from marketstream.operators.membership import join_set

BITS = 64
SHINGLE = 3
MOST_BITS = 2
SEED = 42
N_PIVOTS = 16
#: Shingles of one text that are hashed at once.
STEP = 1 << 18


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: a bit is set when it is set in over half of the shingles' hashes; 0 without words."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(found) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    total = np.zeros(BITS, np.int64)
    for a in range(0, len(starts), STEP):
        spans = zip(starts[a : a + STEP].tolist(), ends[a : a + STEP].tolist(), strict=True)
        hashes = map(xxhash.xxh64_intdigest, [line[i:j] for i, j in spans], repeat(SEED))
        part = np.fromiter(hashes, "<u8", min(STEP, len(starts) - a))
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of each text as a signed 64-bit number."""

    @F.arrow_udf("bigint")
    def of_texts(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_py(), shingle) for t in texts], pa.int64())

    return of_texts(text)


def pivots(n: int = N_PIVOTS) -> list[int]:
    """Reference fingerprints, as signed numbers: the first values of a fixed random sequence."""
    return [int(x) for x in mix((np.arange(n, dtype=np.uint64) + np.uint64(1)) * GOLDEN).view(np.int64)]


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def block_masks(most_bits: int = MOST_BITS) -> list[int]:
    """For every choice of blocks that may differ, a mask of the bits of the other blocks, as a signed number."""
    n = most_bits + 4
    edges = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [((1 << BITS) - 1) ^ sum(some) for some in combinations(blocks, most_bits)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(fingerprints: DataFrame, most_bits: int = MOST_BITS, n_pivots: int = N_PIVOTS) -> DataFrame:
    """Pairs (a, b), a below b, of different values of ``fingerprint`` with at most ``most_bits`` different bits."""
    if most_bits < 1:
        return fingerprints.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    value = F.col("fingerprint")
    coordinates = F.array(*[distance(value, F.lit(p)).cast("tinyint") for p in pivots(n_pivots)])
    table = fingerprints.select("fingerprint").distinct().select("fingerprint", coordinates.alias("at"))
    masks = block_masks(most_bits)
    # The masked value alone does not tell which blocks it keeps, so their choice is part of the key.
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), value.bitwiseAND(F.lit(m)).alias("kept")) for i, m in enumerate(masks)])
    met = table.select("fingerprint", "at", F.explode(choices).alias("key")).select("key.choice", "key.kept", "fingerprint", "at")
    x, y = met.toDF("choice", "kept", "a", "at_a"), met.toDF("choice", "kept", "b", "at_b")
    apart = F.array_max(F.zip_with("at_a", "at_b", lambda p, q: F.abs(p.cast("int") - q.cast("int"))))
    near = x.join(y, ["choice", "kept"]).filter((F.col("a") < F.col("b")) & (apart <= most_bits))
    return near.filter(distance(F.col("a"), F.col("b")) <= most_bits).select("a", "b").distinct()


def grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, most_bits: int, n_pivots: int) -> tuple[DataFrame, DataFrame]:
    """The rows as doc_id and fingerprint, and of each fingerprint the least id and the root of its component."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("fingerprint"))
    rows = written(rows, "fingerprints")
    classes = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes, most_bits, n_pivots)).select(F.col("node").alias("fingerprint"), "root")
    return rows, classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, most_bits: int = MOST_BITS,
    n_pivots: int = N_PIVOTS,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits) and component_id.

    Documents whose fingerprints differ in at most ``most_bits`` bits are linked; component_id is the smallest doc_id that
    a document reaches. Copies share a fingerprint and take part once. A text without words, null included, has
    fingerprint 0 and is linked like any other. Repeated rows stay; documents without an id take part, and
    component_id is null only where no document of the component has one.
    """
    rows, rooted = grouped(docs, doc_id, text, shingle, most_bits, n_pivots)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.join(named, "root").select("fingerprint", "component_id")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return rows.join(members, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")


def one_row_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, most_bits: int = MOST_BITS,
    n_pivots: int = N_PIVOTS,
) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id and then fingerprint; the columns stay as they are.

    Rows that repeat an id with other texts are decided by their own text. Rows without an id cannot be told apart from
    others and all stay.
    """
    rows, rooted = grouped(docs, doc_id, text, shingle, most_bits, n_pivots)
    named = rooted.filter(F.col("least").isNotNull())
    keepers = named.groupBy("root").agg(F.min(F.struct("least", "fingerprint")).alias("keeper")).select("keeper.*")
    keys = rows.filter(F.col("doc_id").isNotNull()).groupBy("doc_id", "fingerprint").count()
    kept = keepers.select(F.col("least").alias("doc_id"), "fingerprint", F.lit(True).alias("stays"))
    keys = written(keys.join(kept, ["doc_id", "fingerprint"], "left"), "keys")
    key = free_name(docs, "_key")
    struct = F.struct(F.col("doc_id").alias("id"), F.col("fingerprint").alias("fingerprint")).alias(key)
    with_key = lambda some: some.withColumn(key, F.struct(F.col(doc_id).alias("id"), fingerprint(F.col(text), shingle).alias("fingerprint")))
    gone = written(keys.filter(F.col("stays").isNull()).select(struct), "gone")
    several = written(keys.filter(F.col("stays") & (F.col("count") > 1)).select("doc_id", "fingerprint"), "repeated")
    again = several.select(struct)
    # Texts stay where they are while the keys that go are few enough to be broadcast, by their measured size.
    single = join_set(join_set(with_key(docs), gone, key, "left_anti"), again, key, "left_anti")
    ids = several.select(F.col("doc_id").alias(doc_id)).distinct()
    repeated = join_set(with_key(join_set(docs, ids, doc_id, "left_semi")), again, key, "left_semi").dropDuplicates([key])
    return single.unionByName(repeated).select(*docs.columns)


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; the columns stay as they are.

    Rows that repeat an id are one document, of which one row stays. Rows without an id cannot be told apart from
    others and all stay.
    """
    found = near_duplicates(docs, doc_id, text, **options)
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(doc_id)).distinct()
    repeated = docs.groupBy(doc_id).count().filter((F.col("count") > 1) & F.col(doc_id).isNotNull()).select(doc_id)
    # Texts stay where they are while the ids that go are few enough to be broadcast, by their measured size.
    kept = join_set(docs, written(gone, "gone"), doc_id, "left_anti")
    several = written(repeated, "repeated")
    single = join_set(kept, several, doc_id, "left_anti")
    return single.unionByName(join_set(kept, several, doc_id, "left_semi").dropDuplicates([doc_id])).select(*docs.columns)
