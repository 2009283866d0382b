"""Substring dedup by sliding runs of sentences.

Every run of several consecutive sentences is hashed; runs with equal hashes are joined over all documents, and sentences
that a repeated run covers go wherever the run does not stand for the first time. The runs that are hashed are, from each
sentence on and, with ``both_ways``, also up to each sentence, the shortest one of at least two sentences that has enough
words; with both, every sentence of a longer run lies in one of them. A sentence ends with a full stop, question or exclamation mark of any script or a line;
in a longer one, as in text without marks, every word counts as a sentence, so that a passage is found wherever it stands
and as far as it goes. Where a text joins a passage's first or last sentence to other words, runs from the mark that
follows or up to the mark before take its words one by one.

There are about as many runs as words, so they are never on disk all at once: they are compared in ``ROUNDS`` rounds, each
with its share of the hashes, and a round leaves only the runs that go.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketstream.llm import words
from marketstream.llm.common import written

#: Words of a run at least; a single sentence makes a run from ``LONG_RUN`` words on.
LEAST_WORDS = 16
LEAST_SENTENCES = 2
LONG_RUN = 48
#: Sentences of more words are taken word by word.
LONG_SENTENCE = 24
#: Shares of the hashes that are compared one after the other.
ROUNDS = 3

MARKS = words.byte_set((0x0A, 0x0A), (0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
#: Marks of several bytes: wide forms, ellipsis, next line, line and paragraph separators, and the marks of other scripts.
WIDE_MARKS = [np.frombuffer(c.encode(), np.uint8) for c in "。｡．！？…‼⁇⁈⁉؟۔।॥։။።፧។\u0085\u2028\u2029"]


class Sentences(NamedTuple):
    text: np.ndarray  #: number of the text of each sentence
    first: np.ndarray  #: its first word
    after: np.ndarray  #: the word after its last
    found: words.Words
    whole: np.ndarray  #: number of the sentence that it is, or is a word of


def wide_marks(data: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Where marks of several bytes begin, and their bytes, mark by mark."""
    lead = np.flatnonzero(data >= 0xC2)
    out = []
    for mark in WIDE_MARKS if len(lead) else ():
        at = lead[data[lead] == mark[0]]
        for k in range(1, len(mark)):
            at = at[at + k < len(data)]
            at = at[data[at + k] == mark[k]]
        out.append((at, len(mark)))
    return out


def split_words(data: np.ndarray, offsets: np.ndarray) -> words.Words:
    """Words without the marks; a kana or ideograph, written without spaces, is a word of its own."""
    member = words.ALPHANUMERIC[data]
    for at, size in wide_marks(data):
        for k in range(size):
            member[at + k] = False
    starts, ends = words.runs(member, offsets)
    lead = np.flatnonzero(data >= 0xE3)
    lead = lead[lead + 1 < len(data)]
    first, second = data[lead], data[lead + 1]
    three = ((first == 0xE3) & ((second >= 0x81) & (second <= 0x83) | (second >= 0x90))) | ((first >= 0xE4) & (first <= 0xE9))
    four = (first == 0xF0) & (second >= 0xA0) & (second <= 0xB3)
    cuts = np.unique(np.concatenate([lead[three], lead[three] + 3, lead[four], lead[four] + 4]))
    if len(cuts):
        within = np.searchsorted(starts, cuts, "right") - 1
        cuts = cuts[(within >= 0) & (starts[within] < cuts) & (cuts < ends[within])]
        starts, ends = np.sort(np.append(starts, cuts)), np.sort(np.append(ends, cuts))
    return words.Words(words.span_hashes(data, starts, ends), np.searchsorted(starts, offsets), starts, ends, data, offsets)


def starts_of(kind: np.ndarray) -> np.ndarray:
    """Where the value differs from the one before."""
    change = np.ones(len(kind), bool)
    change[1:] = kind[1:] != kind[:-1]
    return change


def sentences(found: words.Words) -> Sentences:
    n = len(found.hashes)
    text = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    is_mark = MARKS[found.data]
    for at, _ in wide_marks(found.data):
        is_mark[at] = True
    marks = np.concatenate([[0], np.cumsum(is_mark)])[found.starts] if n else np.zeros(0, np.int64)
    begins = starts_of(text) | starts_of(marks)
    number = np.cumsum(begins) - 1
    size = np.bincount(number, minlength=1)[number] if n else number
    first = np.flatnonzero(begins | (size > LONG_SENTENCE))
    return Sentences(text[first], first, np.append(first[1:], n)[: len(first)], found, number[first])


class Runs(NamedTuple):
    text: np.ndarray
    first: np.ndarray  #: sentence it begins with, from 0 in the text
    after: np.ndarray  #: sentence after its last
    high: np.ndarray
    low: np.ndarray
    repeated: np.ndarray  #: whether the text has the same run before


def runs(s: Sentences, least_words: int, least: int, both_ways: bool, share: int | None = None) -> Runs:
    """All runs, or those with hashes of one of ``ROUNDS`` shares; by text and first sentence."""
    i = np.arange(len(s.first))
    alone = s.after - s.first >= max(LONG_RUN, least_words)
    after = np.where(alone, i + 1, np.maximum(np.searchsorted(s.after, s.first + least_words) + 1, i + least))
    since = np.where(alone, i, np.minimum(np.searchsorted(s.first, s.after - least_words, "right") - 1, i + 1 - least))
    # Near the ends of a long sentence, words that are a whole sentence elsewhere: their run goes on to the next sentence.
    whole_first, whole_after = np.searchsorted(s.whole, s.whole), np.searchsorted(s.whole, s.whole, "right")
    left, so_far = s.after[whole_after - 1] - s.first, s.after - s.first[whole_first]
    near = lambda size: both_ways & (size >= least_words) & (size <= LONG_SENTENCE)
    pairs = [
        (np.ones(len(i), bool), i, after),
        (np.full(len(i), both_ways), since, i + 1),
        (near(left), i, whole_after + least - 1),
        (near(so_far), whole_first - least + 1, i + 1),
    ]
    text_first, text_after = np.searchsorted(s.text, s.text), np.searchsorted(s.text, s.text, "right")
    width, keys = len(i) + 1, []
    for wanted, begin, end in pairs:
        wanted = wanted & (begin >= text_first) & (end <= text_after)
        keys.append(begin[wanted] * width + end[wanted])
    # Sorted parts are quickly merged.
    keys = np.sort(np.concatenate(keys), kind="stable")
    i, after = np.divmod(keys[starts_of(keys)], width)
    begin, end = s.first[i], s.after[after - 1]
    high = words.run_hashes(s.found.hashes, begin, end)
    if share is not None:
        own = high % np.uint64(ROUNDS) == share
        i, after, begin, end, high = i[own], after[own], begin[own], end[own], high[own]
    low = words.run_hashes(words.mix(s.found.hashes + words.GOLDEN), begin, end)
    base = np.searchsorted(s.text, np.arange(len(s.found.first)))
    text = s.text[i]
    order = np.lexsort((i, low, high, text))
    again = np.zeros(len(i), bool)
    same = (text[order][1:] == text[order][:-1]) & (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
    again[order[1:]] = same
    return Runs(text, i - base[text], after - base[text], high, low, again)


def later(order: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Which of the runs also stand here in a document that comes before."""
    if not len(high):
        return np.zeros(0, bool)
    by = np.argsort(high)
    at = np.flatnonzero(starts_of(high[by]) | starts_of(low[by]))
    out = np.empty(len(by), bool)
    out[by] = order[by] > np.repeat(np.minimum.reduceat(order[by], at), np.diff(at, append=len(by)))
    return out


def joined(text: np.ndarray, first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of sentences, by text and first one, with those that touch or overlap made one."""
    if not len(text):
        return text, first, after
    # Set apart by more than any text is long, the texts need no loop.
    width = int(after.max()) + 1
    reach = np.maximum.accumulate(text * width + after)
    new = np.ones(len(text), bool)
    new[1:] = (text * width + first)[1:] > reach[:-1]
    new |= starts_of(text)
    at = np.flatnonzero(new)
    return text[at], first[at], (reach - text * width)[np.append(at[1:], len(text)) - 1]


#: ``place``: sentence it begins with and sentence after its last, 32 bits each.
RUN = "doc bigint, `order` bigint, goes boolean, place bigint, high bigint, low bigint"


def all_runs(docs: DataFrame, least_words: int, least: int, both_ways: bool, share: int) -> DataFrame:
    """One row per document and different run of the share: where it stands first in the document.

    What goes whatever other tasks see comes as joined ranges of sentences, marked, without hashes of a run: runs that the
    document has before, and runs that the task has seen in a document before it.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.texts_of(batch["text"])
            orders = batch["order"].to_numpy()
            for a, b in words.pieces(offsets):
                part = offsets[a : b + 1]
                found = split_words(data[part[0] : part[-1]], part - part[0])
                r = runs(sentences(found), least_words, least, both_ways, share)
                goes = r.repeated | later(orders[a + r.text], r.high, r.low)
                gone = joined(r.text[goes], r.first[goes], r.after[goes])
                # Any hashes do for these, as long as they differ.
                spread = words.mix(words.mix(orders[a + gone[0]].view(np.uint64)) + gone[1].astype(np.uint64))
                for text, first, after, high, low, sure in (
                    (r.text[~goes], r.first[~goes], r.after[~goes], r.high[~goes], r.low[~goes], False), (*gone, spread, spread, True),
                ):
                    at = pa.array(text + a)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["doc"].take(at), batch["order"].take(at), pa.array(np.full(len(text), sure)),
                            pa.array(first << 32 | after), pa.array(high.view(np.int64)), pa.array(low.view(np.int64)),
                        ],
                        ["doc", "order", "goes", "place", "high", "low"],
                    )

    return docs.mapInArrow(emit, RUN)


def repeated_runs(docs: DataFrame, least_words: int, least: int, both_ways: bool) -> DataFrame:
    """doc, place: what goes from each of ``docs`` (doc, order, text) because of the documents before it."""
    found = []
    for share in range(ROUNDS):
        some = all_runs(docs, least_words, least, both_ways, share)
        keeper = F.min("order").over(Window.partitionBy("high", "low"))
        again = some.withColumn("keeper", keeper).filter(F.col("goes") | (F.col("order") > F.col("keeper")))
        found.append(written(again.select("doc", "place"), "repeated-runs"))
    return reduce(DataFrame.union, found)


RESULT = pa.struct([("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("n_words", pa.int64()), ("n_words_removed", pa.int64())])


def rewritten(texts: pa.Array, gone: pa.Array) -> pa.StructArray:
    """The texts without the sentences at the places of ``gone``; sentences, words, and of each how many went."""
    data, offsets = words.texts_of(texts)
    out = []
    for a, b in words.pieces(offsets):
        part = offsets[a : b + 1] - offsets[a]
        found = split_words(data[offsets[a] : offsets[b]], part)
        s, n = sentences(found), b - a
        places = gone.slice(a, n)
        base = np.searchsorted(s.text, np.arange(n))[pc.list_parent_indices(places).to_numpy()]
        first, after = np.divmod(pc.list_flatten(places).to_numpy(), 1 << 32)
        size = len(s.first) + 1
        away = np.cumsum(np.bincount(base + first, minlength=size) - np.bincount(base + after, minlength=size))[:-1] > 0
        n_words = s.after - s.first
        # A sentence reaches to the first word of the next one; what stands before the first word of all stays.
        begin = found.starts[s.first]
        end = np.append(begin[1:], 0)[: len(begin)]
        last = np.append(s.text[1:] != s.text[:-1], True)[: len(begin)]
        end[last] = part[s.text[last] + 1]
        edge = np.zeros(len(found.data) + 1, np.int8)
        edge[begin[away]] += 1
        edge[end[away]] -= 1
        kept = np.cumsum(edge[:-1], dtype=np.int8) == 0
        left = np.concatenate([[0], np.cumsum(kept)])[part]
        text = pa.LargeStringArray.from_buffers(n, pa.py_buffer(left), pa.py_buffer(found.data[kept])).cast(pa.string())
        sums = [np.bincount(s.text, minlength=n), np.bincount(s.text[away], minlength=n), np.bincount(s.text, n_words, n), np.bincount(s.text[away], n_words[away], n)]
        columns = [pc.if_else(texts.slice(a, n).is_valid(), text, None), *(pa.array(x.astype(np.int64)) for x in sums)]
        out.append(pa.StructArray.from_arrays(columns, fields=list(RESULT)))
    return pa.concat_arrays(out) if out else pa.array([], RESULT)


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, least: int = LEAST_SENTENCES,
    both_ways: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text without repeated runs, n_sentences, n_removed, n_words, n_words_removed.

    Of a run that stands in several documents, the one with the smallest id keeps it, in its first place. Rows that repeat
    an id are one document: they keep what that id keeps. Documents without an id come last and are one document in this
    sense. A null text stays null; texts without a word stay as they are. Without ``both_ways``, the last sentences of a
    repeated run stay if no shortest run ends with them.
    """
    rows = docs.select(F.xxhash64(doc_id, text).alias("doc"), F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    order = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("order")
    again = repeated_runs(rows.select("doc", order, "text"), least_words, least, both_ways)
    # At most a few rows for each sentence of a document meet here.
    gone = again.distinct().groupBy("doc").agg(F.collect_list("place").alias("gone"))

    @F.arrow_udf("struct<text:string,n_sentences:bigint,n_removed:bigint,n_words:bigint,n_words_removed:bigint>")
    def rewrite(texts: pa.Array, gone: pa.Array) -> pa.Array:
        return rewritten(texts, gone)

    done = rows.join(written(gone, "removed-runs"), "doc", "left").select("doc_id", rewrite(F.col("text"), F.col("gone")).alias("out"))
    return done.select("doc_id", "out.*")
