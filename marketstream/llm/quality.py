"""Ordinal quality classifier: a cumulative-link (proportional odds) regression on hashed text.

All grades share one weight per hashed feature; ordered thresholds cut the score into grades. Labelled documents are
fitted on a sample of bounded size; every document is scored, in place.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.llm import words
from marketstream.llm.common import free_name

#: Labelled documents that are fitted, at most: the bound of the sample.
MOST_LABELLED = 6_000
DIMENSIONS = 1 << 18
#: Bytes of a word's beginning that are a feature of their own.
PREFIX = 4
#: A feature counts when it stands in at least so many fitted documents.
LEAST_DOCUMENTS = 3
STEPS = 300
RATE = 0.12
#: Inverse variance of the weights, whose prior is normal around 0.
PENALTY = 1.0

SYMBOLS = ~(words.ALPHANUMERIC | words.byte_set((0x09, 0x0D), (0x20, 0x20)))
UPPER = words.byte_set((0x41, 0x5A))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each text, each once, and for each text, and after the last, where they begin.

    Features are the words, their first ``PREFIX`` bytes, the runs of symbols, two or more capitals in a row as one feature,
    and how often a word is repeated on average, by powers of two.
    """
    out, sizes = [], []
    for a, b, found in words.each_piece(texts, words.ALPHANUMERIC):
        n, data, offsets = b - a, found.data, found.offsets
        of_word = np.repeat(np.arange(n), np.diff(found.first))
        different = distinct(of_word, found.hashes)
        kinds = np.bincount(different // DIMENSIONS, minlength=n)
        repeats = np.log2(np.maximum(np.diff(found.first), 1) / np.maximum(kinds, 1)).astype(np.uint64)
        long = found.ends - found.starts > PREFIX
        prefixes = words.span_hashes(data, found.starts[long], found.starts[long] + PREFIX)
        starts, ends = words.runs(SYMBOLS[data], offsets)
        symbols = words.span_hashes(data, starts, ends)
        capitals, last = words.runs(UPPER[data], offsets)
        capitals = np.searchsorted(offsets, capitals[last - capitals > 1], "right") - 1
        key = np.concatenate([
            different,
            distinct(of_word[long], prefixes + words.GOLDEN),
            distinct(np.searchsorted(offsets, starts, "right") - 1, symbols),
            distinct(capitals, np.full(len(capitals), 1, np.uint64)),
            distinct(np.arange(n), words.mix(repeats + np.uint64(2))),
        ])
        key.sort()
        out.append(key % DIMENSIONS)
        sizes.append(np.bincount(key // DIMENSIONS, minlength=n))
    flat = np.concatenate(out) if out else np.zeros(0, np.int64)
    return flat, np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)


def distinct(text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The different features of each text: text number * DIMENSIONS + feature, in order."""
    keys = np.sort(text * DIMENSIONS + (hashes % np.uint64(DIMENSIONS)).astype(np.int64))
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """P(grade >= k) = logistic(score - thresholds[k - 1]), thresholds in ascending order."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: pa.Array) -> np.ndarray:
        """A row per text: the probability of each grade from 1 on, or a better one."""
        flat, first = features(texts)
        score = sums(self.weights[flat], first)
        return logistic(score[:, None] - self.thresholds[None, :])


def fit_arrays(flat: np.ndarray, first: np.ndarray, grades: np.ndarray, n_grades: int, steps: int = STEPS) -> Model:
    """Maximum penalised likelihood by full-batch Adam. Without documents, every document gets the best grade."""
    n = len(grades)
    if not n:
        return Model(np.zeros(DIMENSIONS), np.full(n_grades - 1, -50.0))
    used = np.bincount(flat, minlength=DIMENSIONS) >= LEAST_DOCUMENTS
    index = np.cumsum(used) - 1
    row = np.repeat(np.arange(n), np.diff(first))[used[flat]]
    flat = index[flat[used[flat]]]
    first = np.searchsorted(row, np.arange(n + 1))
    share = np.array([(np.sum(grades >= k) + 0.5) / (n + 1) for k in range(1, n_grades)])
    start = -np.log(share / (1 - share))
    # Thresholds as a first value and the logarithms of the gaps, which keeps them in order.
    x = np.concatenate([np.zeros(used.sum()), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    m, v, k = np.zeros_like(x), np.zeros_like(x), int(used.sum())
    for step in range(1, steps + 1):
        gaps = np.exp(x[k + 1 :])
        cuts = np.concatenate([[-np.inf], x[k] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        score = sums(x[:k][flat], first)
        low, high = logistic(score - cuts[grades]), logistic(score - cuts[grades + 1])
        chance = np.maximum(low - high, 1e-12)
        by_score = -(low * (1 - low) - high * (1 - high)) / chance / n
        by_low, by_high = low * (1 - low) / chance / n, -high * (1 - high) / chance / n
        by_cut = np.bincount(grades, by_low, n_grades + 1) + np.bincount(grades + 1, by_high, n_grades + 1)
        inner = by_cut[1:n_grades]
        from_end = np.cumsum(inner[::-1])[::-1]
        grad = np.concatenate([np.bincount(flat, by_score[row], k) + PENALTY / n * x[:k], from_end[:1], from_end[1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(DIMENSIONS)
    weights[used] = x[:k]
    return Model(weights, x[k] + np.concatenate([[0.0], np.cumsum(np.exp(x[k + 1 :]))]))


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int, doc_id: str = "doc_id", text: str = "text", most: int = MOST_LABELLED) -> Model:
    """Fit on at most ``most`` documents of ``ratings`` (the id and grade, 0 to ``n_grades`` - 1), those with the least hash of the id.

    Ratings without a grade, outside the range or without a document are left out; of several ratings of an id the
    lowest counts. The result is the same in every run.
    """
    rated = ratings.filter(F.col("grade").between(0, n_grades - 1)).groupBy(doc_id).agg(F.min("grade").cast("int").alias("grade"))
    sample = rated.filter(F.col(doc_id).isNotNull()).orderBy(F.xxhash64(doc_id, F.lit(7)), doc_id).limit(most)
    hashed = F.arrow_udf(_feature_lists, "array<int>")
    picked = docs.select(F.col(doc_id), F.col(text).alias("_text")).join(F.broadcast(sample), doc_id)
    rows = picked.select(F.col(doc_id), "grade", hashed("_text").alias("features")).toArrow().combine_chunks()
    order = np.lexsort((rows["features"].combine_chunks().value_lengths().to_numpy(), rows[doc_id].to_numpy()))
    rows = rows.take(pa.array(order))
    lists = rows["features"].combine_chunks()
    lists = pa.array([], pa.list_(pa.int32())) if not len(rows) else lists
    flat = lists.flatten().to_numpy().astype(np.int64)
    first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]) if len(rows) else np.zeros(1, np.int64)
    return fit_arrays(flat, first, rows["grade"].to_numpy().astype(np.int64), n_grades)


def _feature_lists(texts: pa.Array) -> pa.Array:
    flat, first = features(texts)
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat, pa.int32()))


def tails(model: Model, text: Column) -> Column:
    """For each text the probabilities of grade 1 or better, 2 or better, and so on."""

    @F.arrow_udf("array<double>")
    def of_texts(texts: pa.Array) -> pa.Array:
        found = model.tails(texts)
        cut = np.arange(len(found) + 1) * found.shape[1]
        return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(found.ravel()))

    return of_texts(text)


def expected_grade(tails: Column) -> Column:
    return F.aggregate(tails, F.lit(0.0), lambda total, p: total + p)


def grades(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Graded ratings from two labels: 0 toxic, 1 of low quality, 2 good. A missing label gives no rating unless the other decides."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select(doc_id, grade.alias("grade")).filter("grade is not null")


N_GRADES = 3
#: A document is kept when it is good with at least this probability.
LEAST_GOOD = 0.5


def scores(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", least: float = LEAST_GOOD) -> DataFrame:
    """One row per row of ``docs``: doc_id, expected_grade, p_grade_1, .. (probability of that grade or a better one), kept.

    A null text is scored as the empty text.
    """
    found = docs.select(F.col(doc_id).alias("doc_id"), tails(model, F.col(text)).alias("tails"))
    better = [F.col("tails")[k].alias(f"p_grade_{k + 1}") for k in range(len(model.thresholds))]
    best = F.col("tails")[len(model.thresholds) - 1]
    return found.select("doc_id", expected_grade(F.col("tails")).alias("expected_grade"), *better, (best >= least).alias("kept"))


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = LEAST_GOOD) -> DataFrame:
    """``docs`` without those whose probability of the best grade is below ``least``; the columns stay as they are."""
    name = free_name(docs, "_tails")
    found = docs.withColumn(name, tails(model, F.col(text)))
    return found.filter(F.col(name)[len(model.thresholds) - 1] >= least).drop(name)
