"""Katz backoff language model of word pairs.

The probability of a word after another is, for a pair that was seen, its Good-Turing discounted share of the first
word's count; for others it backs off to the word's own discounted share, times a weight of the first word that makes
its probabilities add up to 1 exactly. A word never seen takes what the discounts leave over.

Model tables hold one row per word and per stored pair. For scoring, the most frequent rows, a fixed number, travel to
the tasks that read the documents; the others are looked up by a join, so no table needs to fit anywhere as a whole.
Words are known by 64-bit hashes of their bytes, pairs by a combination of two.

Most pairs are seen once. A text that the model has learned from has no unseen pairs, so a pair of it that is not stored
was seen once; of those seen once, only the ones that other texts ask for are stored. Pairs are counted in ``ROUNDS``
rounds, each with its share of the hashes, and the counts go when the model stands.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from marketstream.llm import words
from marketstream.llm.common import discarded, written

#: Counts up to this one are discounted.
MOST_DISCOUNTED = 5
#: Pairs seen less often are not stored.
LEAST_PAIR = 1
#: Bounds of what the tasks get of the model: rows of the most frequent words and pairs.
HOT_WORDS = 1 << 18
HOT_PAIRS = 1 << 20
#: Shares of the pairs that are counted one after the other.
ROUNDS = 2
#: Tokens whose pairs are counted together before they are shuffled.
STEP = 1 << 21
#: Rows that a task hands over at once.
ROWS = 1 << 18
#: Bytes of text that are handled at once.
PIECE_BYTES = 1 << 19

#: Stand-ins for the end of a text, a token like any other, and for what comes before its first word.
END, START = 1, 2


class Model(NamedTuple):
    """``words``: word, count, log_p, log_alpha, log_share. ``pairs``: pair, count, log_seen, gain. All logarithms to base 10.

    log P(b | a) = log_p(b) + log_alpha(a) + gain(a, b), with gain 0 for pairs that were not seen; for those that were, it is
    log_seen(a, b) + log_share(a), and ``log_once`` is the log_seen of a pair seen once. Where the training was told of other
    texts, gain is null for pairs that none of them has, and such pairs seen once are not stored.
    """

    words: DataFrame
    pairs: DataFrame
    tokens: int
    types: int
    log_p_unknown: float
    log_alpha_start: float
    log_share_start: float
    log_once: float

    def log_base(self, count: Column) -> Column:
        return F.log10((count + F.lit(0.5)) / F.lit(self.tokens + 0.5 * (self.types + 1)))


def tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Piece by piece: the number of the first text, all tokens, and for each text, and after the last, its first token."""
    for a, b, found in words.each_piece(column, words.NOT_SPACE, PIECE_BYTES):
        first = found.first + np.arange(b - a + 1)
        flat = np.full(first[-1], END, np.uint64)
        inside = np.ones(len(flat), bool)
        inside[first[1:] - 1] = False
        flat[inside] = found.hashes
        yield a, flat, first


def before(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What each token follows."""
    out = np.empty_like(flat)
    out[1:] = flat[:-1]
    out[first[:-1]] = START
    return out


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a ^ ((b << np.uint64(1)) | (b >> np.uint64(63)))


def pair_column(a: Column, b: Column) -> Column:
    """``pair`` as a column."""
    return a.bitwiseXOR(F.shiftleft(b, 1).bitwiseOR(F.shiftrightunsigned(b, 63)))


def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [flat for _, flat, _ in tokens(batch["text"])]
        if found:
            word, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])


def count_pairs(share: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts pairs of the share in texts to learn from, and tells which of them other texts have."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        read = 0

        def counted() -> Iterator[pa.RecordBatch]:
            a, b, own = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            # Half of the bits of either word put equal pairs side by side; rows in the order of the first word travel smaller.
            order = np.argsort((a & np.uint64(0xFFFFFFFF00000000)) | (b >> np.uint64(32)))
            a, b, own = a[order], b[order], own[order]
            del order
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            at = np.flatnonzero(new)
            n = np.add.reduceat(own, at, dtype=np.int64) if len(at) else at
            asked = n < np.diff(at, append=len(a))
            for i in range(0, len(at), ROWS):
                k = slice(i, i + ROWS)
                columns = [pa.array(a[at[k]].view(np.int64)), pa.array(b[at[k]].view(np.int64)), pa.array(n[k]), pa.array(asked[k])]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n", "asked"])

        for batch in batches:
            learned = batch["learned"].to_numpy(zero_copy_only=False)
            for at, flat, first in tokens(batch["text"]):
                a, own = before(flat, first), np.repeat(learned[at : at + len(first) - 1], np.diff(first))
                mine = pair(a, flat) % np.uint64(ROUNDS) == share
                held.append((a[mine], flat[mine], own[mine]))
                read += len(flat)
                if read >= STEP:
                    read = 0
                    yield from counted()
        if held:
            yield from counted()

    return count


def discounts(seen: dict[int, int], most: int = MOST_DISCOUNTED) -> list[float]:
    """Katz's factors for counts 1 to ``most`` from the numbers of types seen so often (Good-Turing, made to vanish above ``most``).

    Where the numbers are too few for a factor between 0 and 1, half a count is taken off.
    """
    n = lambda r: seen.get(r, 0)
    rest = (most + 1) * n(most + 1) / n(1) if n(1) else 1.0
    out = []
    for r in range(1, most + 1):
        d = ((r + 1) * n(r + 1) / (r * n(r)) - rest) / (1 - rest) if n(r) and rest < 1 else 0.0
        out.append(d if 0 < d <= 1 else (r - 0.5) / r)
    return out


def discounted(count: Column, factors: list[float]) -> Column:
    factor = F.element_at(F.array(*[F.lit(f) for f in factors]), F.least(count, F.lit(len(factors))).cast("int"))
    return F.when(count <= len(factors), factor * count).otherwise(count.cast("double"))


def train(texts: DataFrame, learned: Column | None = None) -> Model:
    """A model of the column ``text``; null is empty. Without any text all words are unknown.

    With ``learned``, only rows for which it holds are learned from; the others tell what will be asked for.
    """
    rows = texts.select("text", F.lit(True).alias("learned") if learned is None else F.coalesce(learned, F.lit(False)).alias("learned"))
    counts = rows.filter("learned").select("text").mapInArrow(count_words, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("count"))
    counts = written(counts, "word-counts")
    n_tokens, n_types = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    low = {r["count"]: r["types"] for r in counts.filter(F.col("count") <= MOST_DISCOUNTED + 1).groupBy("count").agg(F.count("*").alias("types")).collect()}
    factors = discounts(low)
    # Of all mass, what the discounts take off goes to the unknown word, and never nothing.
    off = sum((1 - f) * r * low.get(r, 0) for r, f in enumerate(factors, 1)) / max(n_tokens, 1)
    p_unknown = max(off, 0.5 / (n_tokens + 0.5 * (n_types + 1)))
    share = (1 - p_unknown) / (1 - off) if off < 1 else 0.0
    known = counts.withColumn("p", discounted(F.col("count"), factors) * F.lit(share / max(n_tokens, 1)))

    parts, seen_types = [], dict.fromkeys(range(1, MOST_DISCOUNTED + 2), 0)
    for k in range(ROUNDS):
        totals = rows.mapInArrow(count_pairs(k), "a bigint, b bigint, n bigint, asked boolean")
        # A task has few rows of one pair, so they are summed up only where they meet.
        totals = totals.repartition("a", "b").groupBy("a", "b").agg(F.sum("n").alias("count"), F.max("asked").alias("asked"))
        seen = Observation()
        rare = [F.count_if(F.col("count") == r).alias(str(r)) for r in seen_types]
        parts.append(written(totals.observe(seen, *rare).filter(F.col("count") >= LEAST_PAIR), "pair-counts"))
        seen_types = {r: n + seen.get[str(r)] for r, n in seen_types.items()}
    stored = reduce(DataFrame.union, parts)
    factors = discounts(seen_types)

    n_texts = counts.filter(F.col("word") == END).select("count").first()
    firsts = known.select(F.col("word").alias("a"), F.col("count").alias("of_a"))
    firsts = firsts.union(texts.sparkSession.createDataFrame([(START, n_texts[0] if n_texts else 0)], "a bigint, of_a bigint"))
    least_hot, of_b = hottest(counts, HOT_WORDS), known.select(F.col("word").alias("b"), F.col("p").alias("p_b"), "count")
    hot = F.broadcast(of_b.filter(F.col("count") >= least_hot).drop("count"))
    mass = discounted(F.col("count"), factors)
    # The most frequent words travel to the pairs; only pairs that end with others are shuffled.
    near = stored.join(hot, "b", "left").select("a", mass.alias("mass"), F.coalesce("p_b", F.lit(0.0)).alias("p_b"))
    far = stored.select("a", "b").join(hot, "b", "left_anti").join(of_b.filter(F.col("count") < least_hot), "b").select("a", F.lit(0.0).alias("mass"), "p_b")
    sums = near.union(far).groupBy("a").agg(F.sum("mass").alias("mass"), F.sum("p_b").alias("lower")).join(firsts, "a")
    # Something is always left for other words: half a count where the discounts leave less.
    seen_share = F.col("mass") / F.col("of_a")
    most = F.col("of_a") / (F.col("of_a") + 0.5)
    shrink = F.least(F.lit(1.0), most / seen_share)
    alpha = (1 - seen_share * shrink) / (1 - F.col("lower"))
    contexts = written(sums.select("a", F.log10(alpha).alias("log_alpha"), F.log10(shrink / F.col("of_a")).alias("log_share")), "contexts")

    log_seen, columns = F.log10(mass).alias("log_seen"), ["pair", "count", "log_seen"]
    keyed = stored.withColumns({"pair": pair_column(F.col("a"), F.col("b")), "log_seen": log_seen})
    asked = (keyed if learned is None else keyed.filter("asked")).join(contexts, "a").join(of_b.drop("count"), "b")
    gain = F.col("log_seen") + F.col("log_share") - F.col("log_alpha") - F.log10("p_b")
    pairs = asked.select(*columns, gain.alias("gain"))
    if learned is not None:
        pairs = pairs.union(keyed.filter(~F.col("asked") & (F.col("count") > 1)).select(*columns, F.lit(None).cast("double")))
    pairs = written(pairs, "pairs")
    table = known.join(contexts.withColumnRenamed("a", "word"), "word", "left")
    of_a = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("log_alpha", "log_share")]
    table = written(table.select("word", "count", F.log10("p").alias("log_p"), *of_a), "words")
    start = contexts.filter(F.col("a") == START).select("log_alpha", "log_share").first() or (0.0, 0.0)
    for done in (*parts, contexts, counts):
        discarded(done)
    return Model(table, pairs, n_tokens, n_types, math.log10(p_unknown), *start, math.log10(factors[0]))


def hottest(rows: DataFrame, most: int) -> int:
    """The least count for which at most ``most`` rows have it or a higher one."""
    by_count = rows.groupBy("count").agg(F.count("*").alias("rows"))
    # There are far fewer different counts than rows: at most the root of twice the tokens.
    above = Window.orderBy(F.desc("count")).rowsBetween(Window.unboundedPreceding, 0)
    found = by_count.withColumn("above", F.sum("rows").over(above)).filter(F.col("above") <= most).agg(F.min("count")).first()[0]
    return (1 << 62) if found is None else found


class Hot(NamedTuple):
    """The most frequent rows of a table, by key."""

    keys: np.ndarray
    values: list[np.ndarray]
    first: np.ndarray  #: by the leading bits of a key, the first row with these bits or higher ones
    shift: int

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row of each key, and whether it has one."""
        leading = (keys >> np.uint64(self.shift)).astype(np.int64)
        at, after = self.first[leading], self.first[leading + 1]
        known = np.zeros(len(keys), bool)
        # Hashes are spread evenly, so there are a few rows at most to compare with.
        left = np.flatnonzero(at < after)
        while len(left):
            same = self.keys[at[left]] == keys[left]
            known[left[same]] = True
            left = left[~same]
            at[left] += 1
            left = left[at[left] < after[left]]
        return at, known


def hot_table(keys: np.ndarray, values: list[np.ndarray]) -> Hot:
    order = np.argsort(keys)
    bits = max(1, len(keys).bit_length())
    first = np.searchsorted(keys[order] >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
    return Hot(keys[order], [v[order] for v in values], first, 64 - bits)


def hot_rows(rows: DataFrame, key: str, values: list[str], least: int) -> Hot:
    got = rows.filter(F.col("count") >= least).select(key, *values).toArrow()
    return hot_table(got[key].to_numpy().view(np.uint64), [got[v].to_numpy() for v in values])


SUMMARY, PAIR, WORD = 0, 1, 2
LOOKED_UP = "row bigint, kind tinyint, own boolean, key bigint, n int, known int, base double, score double"


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", learned: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, base_score and score, the text's log10 probability.

    A text is its words, A-Z in lower case, and an end; a null text is empty and has the end alone. A model that was trained
    with ``learned`` scores the rows that it was trained with, and takes the same condition here.
    """
    least_word, least_pair = hottest(model.words, HOT_WORDS), hottest(model.pairs, HOT_PAIRS)
    hot_words = hot_rows(model.words, "word", ["count", "log_p", "log_alpha", "log_share"], least_word)
    hot_pairs = hot_rows(model.pairs, "pair", ["log_seen", "gain"], least_pair)
    # Once to each worker, where a function's own variables would go to each task.
    hot = docs.sparkSession.sparkContext.broadcast((hot_words, hot_pairs))
    del hot_words, hot_pairs
    size, starts, log_once = model.tokens + 0.5 * (model.types + 1), (model.log_alpha_start, model.log_share_start), model.log_once

    def evaluate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_words, hot_pairs = hot.value
        for batch in batches:
            ids, rows, learned = batch["doc_id"], batch["row"].to_numpy(), batch["own"].to_numpy(zero_copy_only=False)
            for a, flat, first in tokens(batch["text"]):
                n = len(first) - 1
                owner = np.repeat(np.arange(n), np.diff(first))
                of_text = learned[a : a + n]
                of_token = of_text[owner]
                at, is_hot = hot_words.look_up(flat)
                base, total = np.zeros(len(flat)), np.zeros(len(flat))
                if is_hot.any():
                    count, log_p, log_alpha, log_share = (v[at[is_hot]] for v in hot_words.values)
                    base[is_hot] = np.log10((count + 0.5) / size)
                    # A word's weight counts where it is followed, so everywhere but at the end.
                    own = of_token[is_hot]
                    total[is_hot] = np.where(own, 0.0, log_p) + np.where(flat[is_hot] == END, 0.0, np.where(own, log_share, log_alpha))
                keys = pair(before(flat, first), flat)
                pair_at, is_pair = hot_pairs.look_up(keys)
                if is_pair.any():
                    log_seen, gain = (v[pair_at[is_pair]] for v in hot_pairs.values)
                    total[is_pair] += np.where(of_token[is_pair], log_seen, gain)
                # Learned pairs count as seen once until they are looked up.
                total[of_token & ~is_pair] += log_once
                sums = [np.bincount(owner, x, n) for x in (is_hot, base, total)]
                numbers = rows[a : a + n]
                zeros = lambda k: np.zeros(k)
                start = np.where(of_text, starts[1], starts[0])
                for kind, key, own, whose, count, known, b, s in (
                    (SUMMARY, ids.slice(a, n), of_text, numbers, np.diff(first), sums[0], sums[1], sums[2] + start),
                    (PAIR, keys[~is_pair], of_token[~is_pair], numbers[owner[~is_pair]], None, None, None, None),
                    (WORD, flat[~is_hot], of_token[~is_hot], numbers[owner[~is_hot]], None, None, None, None),
                ):
                    k = len(whose)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(whose), pa.array(np.full(k, kind, np.int8)), pa.array(own),
                            key if isinstance(key, pa.Array) else pa.array(key.view(np.int64)),
                            pa.array(np.ones(k, np.int32) if count is None else count.astype(np.int32)),
                            pa.array(zeros(k).astype(np.int32) if known is None else known.astype(np.int32)),
                            pa.array(zeros(k) if b is None else b), pa.array(zeros(k) if s is None else s),
                        ],
                        ["row", "kind", "own", "key", "n", "known", "base", "score"],
                    )

    own = F.lit(False) if learned is None else F.coalesce(learned, F.lit(False))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"), own.alias("own"))
    looked_up = rows.mapInArrow(evaluate, LOOKED_UP)
    none = F.lit(None).cast("double")
    cold_pairs = model.pairs.filter(F.col("count") < least_pair).select(
        F.lit(PAIR).cast("tinyint").alias("cold_kind"), F.col("pair").alias("key"), none.alias("cold_base"), F.col("gain").alias("cold_score"),
        (F.col("log_seen") - F.lit(log_once)).alias("cold_own"),
    )
    followed = lambda c: F.when(F.col("word") == END, 0.0).otherwise(F.col(c))
    cold_words = model.words.filter(F.col("count") < least_word).select(
        F.lit(WORD).cast("tinyint").alias("cold_kind"), F.col("word").alias("key"), model.log_base(F.col("count")).alias("cold_base"),
        (F.col("log_p") + followed("log_alpha")).alias("cold_score"), followed("log_share").alias("cold_own"),
    )
    # The model's side has each key once, so its share of a partition is far smaller than the lookups; hashing it spares sorting them.
    # One number as the key is found sooner than two; a text's id may be like a hash, so kinds are compared as well.
    found = looked_up.join(cold_pairs.union(cold_words).hint("shuffle_hash"), "key", "left")
    is_word, is_known = F.col("kind") == WORD, F.col("kind").eqNullSafe(F.col("cold_kind"))
    cold = F.when(is_known & F.col("own"), F.col("cold_own")).when(is_known, F.col("cold_score"))
    # A pair that is not stored changes nothing.
    found = found.filter((F.col("kind") != PAIR) | is_known)
    base = F.when(is_word, F.coalesce(F.when(is_known, F.col("cold_base")), F.lit(math.log10(0.5 / size)))).otherwise(F.col("base"))
    value = F.when(is_word, F.coalesce(cold, F.lit(model.log_p_unknown))).otherwise(F.col("score") + F.coalesce(cold, F.lit(0.0)))
    known = F.when(is_word, is_known.cast("int")).otherwise(F.col("known"))
    summary = F.col("kind") == SUMMARY
    return (
        found.groupBy("row")
        .agg(
            F.max(F.when(summary, F.col("key"))).alias("doc_id"), F.sum(F.when(summary, F.col("n")).otherwise(0)).alias("n_tokens"),
            F.sum(known).alias("n_known"), F.sum(base).alias("base_score"), F.sum(value).alias("score"),
        )
        .drop("row")
    )


def is_held_out(doc_id: Column, parts: int = 5, part: int = 1) -> Column:
    """Whether the checksum of the id as text leaves ``part``; a null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the documents that are not held out and score all of them."""
    rows, learned = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ~is_held_out(F.col("doc_id"))
    model = train(rows, learned)
    return score(rows, model, learned=learned).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
