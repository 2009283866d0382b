"""Document fingerprints by consistent weighted sampling.

A document is a set of words, weighted by how often they occur. For each sample, every word draws, from its hash alone, two
gamma(2, 1) numbers r and c and a uniform number beta. A weight w is put on the word's own logarithmic grid,
t = floor(ln w / r + beta), ln y = r * (t - beta), and the word with the least ln a = ln c - ln y - r is taken, together
with t. Two documents take the same (word, t) with a probability equal to their generalised Jaccard similarity,
sum of the smaller weights over sum of the larger ones, so the share of equal samples estimates it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketstream.llm.neighbours import with_next

SAMPLES = 32
#: The logarithms that samples compare lie within +-128 and are kept to so many binary places, above 32 bits of identity.
PLACES = 23
LOW = (1 << 32) - 1
NONE = (1 << 63) - 1


def halves(h: Column) -> tuple[Column, Column]:
    """Two uniform numbers in (0, 1) from a 64-bit hash."""
    scale = F.lit(1.0 / (1 << 32))
    high, low = F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(LOW))
    return (high + F.lit(0.5)) * scale, (low + F.lit(0.5)) * scale


def gamma(h: Column) -> Column:
    """A gamma(2, 1) number: the sum of two exponential ones."""
    u, v = halves(h)
    return -F.log(u * v)


def sample(word: Column, weight: Column, k: int) -> Column:
    """Sample ``k`` of one word: least for the word that the document takes, and ``NONE`` for weight 0.

    Everything is evaluated for every weight, so what depends on the word alone is worked out once for several weights.
    """
    h = F.xxhash64(word, F.lit(3 * k + 2))
    r, c = gamma(F.xxhash64(word, F.lit(3 * k))), gamma(F.xxhash64(word, F.lit(3 * k + 1)))
    beta = halves(h)[0]
    t = F.floor(F.log(F.greatest(weight, F.lit(1)).cast("double")) / r + beta)
    ln_a = F.log(c) - r * (t - beta) - r
    rank = F.shiftleft(((ln_a + F.lit(128.0)) * F.lit(float(1 << PLACES))).cast("bigint"), 32)
    absent = F.when(weight > 0, F.lit(0).cast("bigint")).otherwise(F.lit(NONE))
    return F.greatest(rank.bitwiseOR(h.bitwiseXOR(t).bitwiseAND(F.lit(LOW))), absent)


def signatures(rows: DataFrame, keys: Sequence[str], texts: Sequence[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and, for each column of ``texts``, ``<text>_samples``: an array of ``samples`` numbers.

    ``keys`` identify a row. Rows without a word in any text are absent, and a text without words has null samples.
    Words are what stands between white space, in lower case. Rows are not shuffled if they are partitioned by some of the keys.
    """
    each = F.array(*[F.struct(F.lit(i).alias("which"), F.col(t).alias("text")) for i, t in enumerate(texts)])
    words = F.explode(F.split(F.lower(F.col("text.text")), r"[\x09-\x0D\x20]+"))
    spoken = rows.select(*keys, F.explode(each).alias("text")).select(*keys, "text.which", words.alias("word")).filter("word <> ''")
    weights = [F.count_if(F.col("which") == i).alias(f"w{i}") for i in range(len(texts))]
    weighted = spoken.groupBy(*keys, F.xxhash64("word").alias("word")).agg(*weights)
    taken = weighted.groupBy(*keys).agg(*[
        F.min(sample(F.col("word"), F.col(f"w{i}"), k)).alias(f"s{i}_{k}") for i in range(len(texts)) for k in range(samples)
    ])
    found = [
        F.when(F.col(f"s{i}_0") < NONE, F.array(*[F.col(f"s{i}_{k}").bitwiseAND(F.lit(LOW)) for k in range(samples)])).alias(f"{t}_samples")
        for i, t in enumerate(texts)
    ]
    return taken.select(*keys, *found)


def no_words(samples: int = SAMPLES) -> Column:
    """The samples of a text without words; no word's sample is negative."""
    return F.array_repeat(F.lit(-1).cast("bigint"), samples)


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples: an estimate of the generalised Jaccard similarity."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda equal: equal)
    return F.size(same) / F.lit(float(samples))


def digits(samples: Column) -> Column:
    """Eight hexadecimal digits for each sample; underscores for a text without words."""
    return F.array_join(F.transform(samples, lambda s: F.when(s < 0, "________").otherwise(F.lower(F.lpad(F.hex(s), 8, "0")))), "")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """One row per document: fingerprints of its text and of its edited text, and how alike they are.

    In the edited text the last floor(n_chars / 2) code points give way to the first as many, or all, of the next document by
    descending doc_id, after the last that of the first. Documents with the same id follow by the hash of their text,
    those without an id come last. A null text is empty; texts without words are alike and unlike any other.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cut = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.length("text") - cut), F.col("next").substr(F.lit(1), cut))
    seated = with_next(rows, "doc_id", "text").withColumn("edited", F.when(~F.col("_guest"), edited))
    keys = ["_bucket", "_place"]
    base = seated.select(
        *keys, "_guest", "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    )
    found = base.join(signatures(seated, keys, ["text", "edited"], samples), keys, "left")
    own, other = (F.coalesce(F.col(f"{t}_samples"), no_words(samples)) for t in ("text", "edited"))
    line = Window.partitionBy("_bucket").orderBy("_place")
    found = found.withColumn("own", own).withColumn("other", other).withColumn("following", F.lead("own").over(line))
    return found.filter(~F.col("_guest")).select(
        "doc_id", "n_chars", "edited_sha256",
        digits(F.col("own")).alias("fingerprint"), digits(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), samples).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), samples).alias("near_next"),
    )
