"""License scan: MinHash bands over overlapping windows of text retrieve templates, shingle containment verifies them.

A template of m shingles is looked for in windows of m + s - 1 shingles that begin at multiples of s, about a quarter of m, so
any m shingles in a row lie within some window. Band j of a window is its least shingle under the j-th hash; a window and a
template meet when a band is equal. A window that holds a share c of the template has a Jaccard similarity of at least
c * m / (m + s - 1 + (1 - c) * m), and one band in ``bands`` is equal with the probability that ``chance`` gives.
A band can only be equal if the window holds the very shingle that is the template's least one, so bands are computed
for the windows around those shingles alone: the result is that of computing them for all windows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream.functions.codec import computed_once
from marketstream.llm.license_texts import TEXTS

SHINGLE = 5
LEAST = 0.8
BANDS = 32
#: Bound of the templates: they are a parameter, and are broadcast.
MOST_TEMPLATE_WORDS = 1_000_000

# The notices, headers and texts that are looked for.
NOTICES = TEXTS | {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
}


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingles_of(words: Column, n: int = SHINGLE) -> Column:
    """Hashes of every ``n`` consecutive words; all words together where there are fewer; none without words."""
    at = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
    found = F.transform(at, lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(F.size(words) > 0, found).otherwise(F.array().cast("array<bigint>"))


def band(shingles: Column, j: Column) -> Column:
    """The least shingle under hash ``j``, as its hash."""
    return F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, j)))


def chance(m: int, stride: int, least: float = LEAST, bands: int = BANDS) -> float:
    """At least so probably a window that holds a share ``least`` of a template of ``m`` shingles retrieves it."""
    held = -(-least * m // 1)
    return 1 - (1 - held / (2 * m + stride - 1 - held)) ** bands


def templates(spark: SparkSession, texts: Mapping[str, str], bands: int = BANDS) -> DataFrame:
    """One row per template: license_id, its different shingles, their number m, stride, window, its bands and the shingles that give them."""
    if sum(len(t.split()) for t in texts.values()) > MOST_TEMPLATE_WORDS:
        raise ValueError("the templates have too many words to be broadcast")
    rows = spark.createDataFrame([*texts.items()], "license_id string, text string")
    words = computed_once(rows, "words", words_of(F.col("text")))
    found = words.select("license_id", F.array_distinct(shingles_of(F.col("words"))).alias("shingles")).filter("size(shingles) > 0")
    m = F.size("shingles")
    stride = F.greatest(F.lit(1), F.floor(m / 4).cast("int"))
    numbers = F.sequence(F.lit(0), F.lit(bands - 1))
    least = F.transform(numbers, lambda j: F.array_min(F.transform("shingles", lambda x: F.struct(F.xxhash64(x, j).alias("band"), x.alias("shingle")))))
    sized = found.select("license_id", "shingles", m.alias("m"), stride.alias("stride"), (m + stride - 1).alias("window"), least.alias("least"))
    return sized.withColumn("bands", F.col("least.band")).withColumn("givers", F.array_distinct("least.shingle")).drop("least")


def scan(
    docs: DataFrame, texts: Mapping[str, str], doc_id: str = "doc_id", text: str = "text", least: float = LEAST, bands: int = BANDS,
) -> DataFrame:
    """One row per document and template found in it: doc_id, license_id, containment, n_windows, first_word.

    ``containment`` is the largest share of the template's shingles in one window, at least ``least``; ``n_windows`` counts the
    windows that reach ``least`` and ``first_word`` is where the first of them begins. Texts are compared by their words,
    letters and digits in lower case. Nulls and texts without words have no rows. Rows that repeat id and text are one
    document. A template of fewer than five words is found only in texts that consist of it.
    """
    wanted = templates(docs.sparkSession, texts, bands)
    givers = [g for row in wanted.select("givers").collect() for g in row[0]]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    words = computed_once(rows, "words", words_of(F.col("text"))).drop("text")
    cut = computed_once(words, "all", shingles_of(F.col("words"))).drop("words")
    holds = cut.filter(F.exists("all", lambda x: x.isin(givers))) if givers else cut.limit(0)
    met = holds.join(F.broadcast(wanted), F.arrays_overlap("all", "givers"))
    places = F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda i: F.array_contains("givers", F.get("all", i)))
    # The windows, by number, that hold the shingle at i.
    windows = F.transform(places, lambda i: F.sequence(
        F.greatest(F.ceil((i - F.col("window") + 1) / F.col("stride")), F.lit(0)).cast("int"), F.floor(i / F.col("stride")).cast("int")))
    each = met.select("*", F.explode(F.array_distinct(F.flatten(windows))).alias("number"))
    held = F.slice("all", F.col("number") * F.col("stride") + 1, F.col("window"))
    same = F.exists(F.sequence(F.lit(0), F.lit(bands - 1)), lambda j: band(F.col("held"), j) == F.get("bands", j))
    retrieved = computed_once(each, "held", held).filter(same)
    share = F.size(F.array_intersect("held", "shingles")) / F.col("m")
    verified = retrieved.select("doc_id", "text_hash", "license_id", share.alias("share"), (F.col("number") * F.col("stride")).alias("word")).filter(F.col("share") >= least)
    return verified.groupBy("doc_id", "text_hash", "license_id").agg(
        F.max("share").alias("containment"), F.count_distinct("word").alias("n_windows"), F.min("word").cast("bigint").alias("first_word")
    ).drop("text_hash")
