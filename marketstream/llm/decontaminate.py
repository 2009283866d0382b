"""Benchmark decontamination with suffix arrays of the training texts.

The words of a task's documents are laid out in shards. Each shard's suffix array is sorted by prefix doubling; every
suffix of every benchmark item is then binary-searched in it, word by word. Suffixes that reach the window length
give the hit words, the items and, extended word by word, the longest verbatim matches with their places.
Documents are never shuffled: the items travel, in blocks of bounded size, and each document keeps its row.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.llm import words
from marketstream.llm.common import free_name

WINDOW = 13
SHARE = 20
#: Suffixes start at so many places of a shard; a power of two below 2 ** 21, so that two ranks and a place fit 64 bits.
SHARD = 1 << 20
#: Suffixes are sorted by so many words, or by the window if it is longer.
DEPTH = 16
#: Benchmark texts sent to the tasks at once.
BLOCK_BYTES = 16 << 20
#: Places compared at once when matches are extended.
PAIRS = 1 << 22

SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64())])
MATCH = pa.struct([("item_id", pa.string()), ("n_words", pa.int64()), ("item_word", pa.int64()), ("doc_word", pa.int64())])
SCAN = (
    "struct<n_words:bigint,hits:array<struct<first:bigint,last:bigint>>,"
    "matches:array<struct<item_id:string,n_words:bigint,item_word:bigint,doc_word:bigint>>>"
)


class Items(NamedTuple):
    """Benchmark items as one run of word hashes; items without a word are left out."""

    ids: list[str | None]
    hashes: np.ndarray
    first: np.ndarray  #: for each item, and after the last, its first word

    def windows(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Where windows begin, and how many words each has."""
        item = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        size = np.diff(self.first)[item]
        inside = np.arange(len(self.hashes)) - self.first[:-1][item]
        begins = np.flatnonzero(inside <= np.maximum(size - window, 0))
        return begins, np.minimum(size, window)[begins]


def read_items(rows: list[tuple[str | None, str | None]]) -> Items:
    found = words.words(*words.texts_of(pa.array([t for _, t in rows], pa.large_string())), words.ALPHANUMERIC)
    return Items([i for i, _ in rows], found.hashes, found.first)


def suffix_array(seq: np.ndarray, owned: int, depth: int) -> np.ndarray:
    """The places below ``owned`` in the order of the ``depth`` words from each on. ``seq``: small non-negative ranks."""
    n = len(seq)
    bits = np.uint64(max(1, int(n + 1).bit_length()))
    place, low = np.arange(n, dtype=np.uint64), (np.uint64(1) << bits) - np.uint64(1)
    rank, span = seq.astype(np.uint64), 1
    order = np.argsort(seq, kind="stable")
    while span < depth:
        later = np.zeros(n, dtype=np.uint64)
        later[: max(n - span, 0)] = rank[span:] + np.uint64(1)
        keys = np.sort((((rank << bits) | later) << bits) | place)
        order = (keys & low).astype(np.int64)
        keys >>= bits
        fresh = np.zeros(n, dtype=np.uint64)
        fresh[1:] = keys[1:] != keys[:-1]
        rank[order] = np.cumsum(fresh, dtype=np.uint64)
        span *= 2
    return order[order < owned]


def bound(seq: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: int, word: np.ndarray, right: bool):
    """For each search, the first place of ``order[lo:hi]`` whose word ``at`` is not below (right: is above) ``word``."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        middle = (lo[open_] + hi[open_]) >> 1
        there = seq[np.minimum(order[middle] + at, len(seq) - 1)]
        below = there <= word[open_] if right else there < word[open_]
        lo[open_[below]] = middle[below] + 1
        hi[open_[~below]] = middle[~below]


def search(seq: np.ndarray, order: np.ndarray, query: np.ndarray, begins: np.ndarray, sizes: np.ndarray):
    """The range of ``order`` whose suffixes begin with ``query[b : b + size]``, for each suffix ``b`` that has one."""
    left = np.arange(len(begins))
    lo, hi = np.zeros(len(begins), np.int64), np.full(len(begins), len(order), np.int64)
    out = []
    for at in range(int(sizes.max(initial=0))):
        word = query[begins[left] + at]
        lo, hi = (bound(seq, order, lo, hi, at, word, right) for right in (False, True))
        found = (lo < hi) & (word > 0)
        left, lo, hi = left[found], lo[found], hi[found]
        whole = sizes[left] == at + 1
        out.append((left[whole], lo[whole], hi[whole]))
        left, lo, hi = left[~whole], lo[~whole], hi[~whole]
        if not len(left):
            break
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3


def spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number of each range, and the range's own number."""
    size = hi - lo
    owner = np.repeat(np.arange(len(lo)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[owner], owner


def extended(text: np.ndarray, query: np.ndarray, place: np.ndarray, begin: np.ndarray, end: np.ndarray, size: np.ndarray):
    """Length of the match of ``query`` from ``begin`` with ``text`` from ``place``, of which ``size`` words are known."""
    size, active = size.copy(), np.arange(len(place))
    while len(active):
        p, q = place[active] + size[active], begin[active] + size[active]
        go = (p < len(text)) & (q < end[active])
        active, p, q = active[go], p[go], q[go]
        active = active[text[p] == query[q]]
        size[active] += 1
    return size


def scan_words(found: words.Words, items: Items, window: int, shard: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which words of a piece of documents are hit, and the matches: document, item, length, place in item, in document."""
    n_docs = len(found.first) - 1
    begins, sizes = items.windows(window)
    if not len(found.hashes) or not len(begins):
        return np.zeros(len(found.hashes), bool), [np.zeros(0, np.int64)] * 5
    # A word that equals no other stands after each document, so that no match runs on into the next.
    doc = np.repeat(np.arange(n_docs), np.diff(found.first))
    place = np.arange(len(doc)) + doc
    vocabulary, ranks = np.unique(found.hashes, return_inverse=True)
    text = np.zeros(len(doc) + n_docs, np.int64)
    text[place] = ranks + 1
    at = np.searchsorted(vocabulary, items.hashes)
    known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == items.hashes
    query = np.where(known, at + 1, 0)
    item_of = np.repeat(np.arange(len(items.ids)), np.diff(items.first))
    cover, matches, depth = np.zeros(len(text) + 1, np.int64), [], max(DEPTH, window)
    for a in range(0, len(text), shard):
        seq = text[a : a + shard + depth]
        dense = seq if seq.max() <= len(seq) else np.unique(seq, return_inverse=True)[1]
        order = suffix_array(dense, min(shard, len(seq)), depth)
        which, lo, hi = search(seq, order, query, begins, sizes)
        if not len(which):
            continue
        _, one = np.unique(np.stack([lo, sizes[which]]), axis=1, return_index=True)
        hit, owner = spread(lo[one], hi[one])
        np.add.at(cover, order[hit] + a, 1)
        np.add.at(cover, order[hit] + a + sizes[which[one]][owner], -1)
        ends = np.cumsum(hi - lo)
        for part in np.split(np.arange(len(which)), np.searchsorted(ends, np.arange(PAIRS, ends[-1], PAIRS))):
            hit, owner = spread(lo[part], hi[part])
            start, begin = order[hit] + a, begins[which[part]][owner]
            item = item_of[begin]
            size = extended(text, query, start, begin, items.first[1:][item], sizes[which[part]][owner])
            d = doc[np.searchsorted(place, start)]
            matches.append(longest([d, item, size, begin - items.first[:-1][item], start - d - found.first[d]]))
    whole = [np.concatenate(x) for x in zip(*matches, strict=True)] if matches else [np.zeros(0, np.int64)] * 5
    return np.cumsum(cover[:-1])[place] > 0, longest(whole)


def longest(matches: list[np.ndarray]) -> list[np.ndarray]:
    """For each document and item the longest match; ties by the earliest word of the item, then of the document."""
    doc, item, size, begin, start = matches
    order = np.lexsort((start, begin, -size, item, doc))
    top = np.ones(len(order), bool)
    top[1:] = (np.diff(doc[order]) != 0) | (np.diff(item[order]) != 0)
    return [x[order[top]] for x in matches]


def lists(owner: np.ndarray, n: int, rows: list[pa.Array], kind: pa.StructType) -> pa.Array:
    """A list of rows for each of ``n`` documents; ``owner``, in order, says whose each row is."""
    cut = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
    return pa.ListArray.from_arrays(cut, pa.StructArray.from_arrays(rows, fields=list(kind)))


def scanner(items: Items, window: int, shard: int) -> Callable[[Column], Column]:
    ids = pa.array(items.ids, pa.string())

    @F.arrow_udf(SCAN)
    def scan(text: pa.Array) -> pa.Array:
        out = []
        for a, b, found in words.each_piece(text, words.ALPHANUMERIC):
            hits, (doc, item, size, begin, start) = scan_words(found, items, window, shard)
            starts, ends = words.runs(hits, found.first)
            owner = np.searchsorted(found.first, starts, "right") - 1
            spans = [pa.array(starts - found.first[owner]), pa.array(ends - 1 - found.first[owner])]
            matches = [ids.take(pa.array(item)), pa.array(size), pa.array(begin), pa.array(start)]
            out.append((pa.array(np.diff(found.first)), lists(owner, b - a, spans, SPAN), lists(doc, b - a, matches, MATCH)))
        fields = [pa.int64(), pa.list_(SPAN), pa.list_(MATCH)]
        columns = [pa.concat_arrays(x) for x in zip(*out, strict=True)] if out else [pa.array([], k) for k in fields]
        return pa.StructArray.from_arrays(columns, ["n_words", "hits", "matches"])

    return scan


def blocks(benchmark: DataFrame, item_id: str, text: str, size: int) -> list[Items]:
    """The items in blocks of about ``size`` bytes, the only data that passes the driver, one block at a time."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = 1 + total // size
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [read_items([tuple(r) for r in rows.filter(block == i).collect()]) for i in range(n)]


def hit_words(spans: Column) -> Column:
    """How many words the spans cover together."""
    def add(so_far: Column, span: Column) -> Column:
        fresh = F.greatest(span["last"] - F.greatest(span["first"] - 1, so_far["last"]), F.lit(0).cast("bigint"))
        return F.struct(
            (so_far["n"] + fresh).alias("n"), F.greatest(so_far["last"], span["last"]).alias("last")
        )

    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("last"))
    return F.aggregate(F.array_sort(spans), start, add)["n"]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    name: str = "scan",
    shard: int = SHARD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a column ``name``: n_words, n_hit and matches of each document against the benchmark.

    ``matches`` has, for each item of which a window occurs, the longest verbatim match: item_id (as text), n_words,
    item_word and doc_word (where it begins). A window is ``window`` consecutive words of an item, or all words of a
    shorter one. A null text has no words. An item with a null text or without words matches nothing; hits of an item
    without an id count, its match has a null id. Rows of the benchmark that share an id are separate items with that
    id. Repeated documents are scanned each. A column of ``docs`` called ``name`` is replaced.
    """
    parts = [scanner(items, window, shard)(F.col(text)) for items in blocks(benchmark, item_id, item_text, block_bytes)]
    names, out = [], docs
    for part in parts:
        names.append(free_name(out, "_part"))
        out = out.withColumn(names[-1], part)
    hits, matches = (F.flatten(F.array(*[F.col(n)[field] for n in names])) for field in ("hits", "matches"))
    result = F.struct(F.col(names[0])["n_words"].alias("n_words"), hit_words(hits).alias("n_hit"), matches.alias("matches"))
    return out.withColumn(name, result).drop(*names)


def is_contaminated(scan: Column, share: int = SHARE) -> Column:
    """True when hit words make up at least one in ``share`` of the words."""
    return (scan["n_hit"] > 0) & (scan["n_hit"] * share >= scan["n_words"])


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones; the columns stay as they are."""
    name = free_name(docs, "_scan")
    return scan(docs, benchmark, name=name, **options).filter(~is_contaminated(F.col(name))).drop(name)


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the matches."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = scan(rows, benchmark, **options)
    ids = F.array_sort(F.array_distinct(F.filter(F.col("scan")["matches"]["item_id"], lambda i: i.isNotNull())))
    return found.select(
        "doc_id", "scan.n_words", "scan.n_hit",
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("scan")).alias("contaminated"),
        F.col("scan")["matches"].alias("matches"),
    )
