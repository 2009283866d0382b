"""SentencePiece encoding and decoding of whole texts, by vectorised merge rounds over flat arrays.

A piece model of the BPE kind joins, again and again, the neighbouring pair whose joint piece has the best score, the
leftmost of equals. Here all texts of a batch are one flat array of symbols, cut into words where no piece of the vocabulary holds
the two characters side by side, so that nothing ever joins across a cut. Each round finds the least pair rank of every
word, joins the leftmost pairs of that rank in all words at once, and compacts the arrays; words without a pair are done.

Where a joint symbol could at once join with a neighbour at a rank no worse than the round's, one-by-one order would do that
before the pairs further right. Such joins end the round of their word, so the result is that of one join at a time.
"""

from __future__ import annotations

import codecs
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import free_name
from marketstream.llm.words import GOLDEN, mix, pieces, run_hashes, texts_of

SPACE = "▁"
#: More than any rank.
NONE = np.int32(2**31 - 1)
#: A place whose character was joined to the one before.
GONE = -2
#: Texts are encoded in pieces of about so many bytes.
STEP_BYTES = 1 << 18
#: Equal words meet in one of 2 ** SLOT_BITS slots.
SLOT_BITS = 18
#: Ids that are decoded at once.
STEP_IDS = 1 << 17
#: What decoding gives for the unknown id.
UNKNOWN = " ⁇ "


#: An odd number that spreads keys over the table, 2 ** 32 divided by the golden ratio.
SPREAD = np.uint32(2654435769)


class Lookup(NamedTuple):
    """A hash table of whole numbers from 0 below 2 ** 31, probed for many keys at once."""

    entries: np.ndarray  #: key * 2 ** 32 + value, or -1: key and value come from one place of memory

    @classmethod
    def of(cls, found: dict[int, int]) -> Lookup:
        entries = np.full(1 << max(4, (4 * len(found)).bit_length()), -1, np.int64)
        keys, values = (np.fromiter(x, np.int64, len(found)) for x in (found, found.values()))
        new = keys << 32 | values
        at = cls.places(keys.astype(np.int32), len(entries))
        while len(new):
            first = np.zeros(len(at), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = first & (entries[at] == -1)
            entries[at[put]] = new[put]
            new, at = new[~put], (at[~put] + 1) & (len(entries) - 1)
        return cls(entries)

    @staticmethod
    def places(keys: np.ndarray, size: int) -> np.ndarray:
        return (keys.view(np.uint32) * SPREAD >> np.uint32(33 - size.bit_length())).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self.places(keys, len(self.entries))
        there = self.entries.take(at)
        other = np.flatnonzero(((there >> 32) != keys) & (there != -1))
        while len(other):
            next_ = (at[other] + 1) & (len(self.entries) - 1)
            at[other], found = next_, self.entries.take(next_)
            there[other] = found
            other = other[((found >> 32) != keys[other]) & (found != -1)]
        return there.astype(np.int32)


class Model(NamedTuple):
    symbols: np.ndarray  #: by code point: the symbol of a character that occurs in a piece, else -1
    n_pieces: int  #: symbols below are piece ids, those from here on are characters that are no piece
    n_symbols: int
    pairs: Lookup  #: left symbol * n_symbols + right symbol -> the joint piece
    beside: Lookup  #: the same key of two characters that some piece holds side by side
    rank: np.ndarray  #: by piece: 0 for the best score, equal for equal scores; the last value stands for no piece
    hasty: np.ndarray  #: by piece: whether it can be part of a piece of no worse rank
    byte_ids: np.ndarray  #: by byte: its piece
    surfaces: np.ndarray  #: the bytes that each id decodes to, one after the other
    surface_ends: np.ndarray
    leading: np.ndarray  #: by id: whether it begins with the space sign
    silent: np.ndarray  #: by id: whether it decodes to nothing


@lru_cache(maxsize=2)
def model_of(proto: bytes) -> Model:
    """The tables of a serialised model. Only BPE models with byte fallback and without normalisation are supported."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    ids = range(sp.get_piece_size())
    names = [sp.id_to_piece(i) for i in ids]
    kind = {i: "b" if sp.is_byte(i) else "c" if sp.is_control(i) else "?" if sp.is_unknown(i) else "u" if sp.is_unused(i) else "n" for i in ids}
    if sp.normalize(" ﬁ  Á ") != f"{SPACE * 2}ﬁ{SPACE * 2}Á{SPACE}" or list(kind.values()).count("b") != 256:
        raise ValueError("the model must keep texts as they are, with a space in front, and have a piece for every byte")
    if "u" in kind.values():
        raise ValueError("models with unused pieces are not supported")
    normal = {names[i]: i for i in ids if kind[i] == "n"}
    symbol = {c: normal[c] for c in normal if len(c) == 1}
    others = sorted({c for name in normal for c in name} - set(symbol))
    symbol |= {c: len(names) + i for i, c in enumerate(others)}
    n = len(names) + len(others)
    if n * n >= 1 << 31:
        raise ValueError("the vocabulary is too large")
    known = normal | symbol
    pairs, beside = {}, {}
    scores = np.array([sp.get_score(i) for i in ids])
    rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
    hasty = np.zeros(len(names), bool)
    for name, i in normal.items():
        for at in range(1, len(name)):
            beside[symbol[name[at - 1]] * n + symbol[name[at]]] = 1
            left, right = known.get(name[:at]), known.get(name[at:])
            if left is not None and right is not None:
                pairs[left * n + right] = i
                for part in (left, right):
                    if part < len(names) and rank[i] <= rank[part]:
                        hasty[part] = True
    by_code = np.full(0x110000, -1, np.int32)
    by_code[[ord(c) for c in symbol]] = list(symbol.values())
    byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
    raw = [name.replace(SPACE, " ").encode() if kind[i] == "n" else UNKNOWN.encode() if kind[i] == "?" else b"" for i, name in enumerate(names)]
    for b, i in enumerate(byte_ids):
        raw[i] = bytes([b])
    return Model(
        by_code, len(names), n, Lookup.of(pairs), Lookup.of(beside), np.append(rank, NONE), hasty, byte_ids,
        np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw]),
        np.array([kind[i] == "n" and name.startswith(SPACE) for i, name in enumerate(names)]),
        np.array([kind[i] == "c" for i in ids]),
    )


def leftmost(at: np.ndarray) -> np.ndarray:
    """Of places in rising order, those that one-by-one joins from the left would use: every second of a run."""
    begins = np.r_[True, np.diff(at) != 1]
    in_run = at - np.repeat(at[begins], np.diff(np.r_[np.flatnonzero(begins), len(at)]))
    return at[in_run % 2 == 0]


def join_all(symbols: np.ndarray, starts: np.ndarray, model: Model) -> np.ndarray:
    """The symbols after all joins, at the place of their first character; other places are ``GONE``.

    ``starts`` marks the first symbol of each word.
    """
    out = symbols.copy()
    n = np.int32(model.n_symbols)

    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return model.pairs.get(left * n + right)

    place = np.flatnonzero(~(starts & np.r_[starts[1:], True])).astype(np.int32)
    symbol, first = symbols[place], starts[place]
    piece = np.full(len(place), -1, np.int32)
    inner = np.flatnonzero(~first[1:])
    piece[inner] = joined(symbol[inner], symbol[inner + 1])
    while len(place):
        rank = model.rank[piece]
        heads = np.flatnonzero(first)
        best = np.minimum.reduceat(rank, heads)
        sizes = np.diff(heads, append=len(place))
        going = best != NONE
        if not going.any():
            break
        at = leftmost(np.flatnonzero(rank == np.repeat(np.where(going, best, -1), sizes)))
        new = piece[at]
        if model.hasty[new].any():
            # Neighbours as they are when the joins to the left are made and those to the right are not.
            linked = np.r_[False, at[1:] == at[:-1] + 2]
            before = np.where(linked, np.r_[new[:1], new[:-1]], symbol[np.maximum(at - 1, 0)])
            after = np.minimum(at + 2, len(symbol) - 1)
            soon = np.minimum(
                np.where(first[at], NONE, model.rank[joined(before, new)]),
                np.where((at + 2 < len(symbol)) & ~first[after], model.rank[joined(new, symbol[after])], NONE),
            )
            word = np.searchsorted(heads, at, "right") - 1
            ends = np.flatnonzero(soon <= best[word])
            until = np.full(len(sizes), len(symbol))
            np.minimum.at(until, word[ends], at[ends])
            kept = at <= until[word]
            at, new = at[kept], new[kept]
        out[place[at]], out[place[at + 1]] = new, GONE
        symbol[at] = new
        # Each joint symbol and the one before it, which may be a joint symbol too, meet new neighbours.
        touched = np.zeros(len(place), bool)
        touched[at] = True
        touched[at[~first[at]] - 1] = True
        stays = np.repeat(going, sizes)
        stays[at + 1] = False
        left = np.flatnonzero(stays)
        place, symbol, first, piece, touched = (x.take(left) for x in (place, symbol, first, piece, touched))
        again = np.flatnonzero(touched)
        piece[again] = -1
        some = again[~np.append(first, True)[again + 1]]
        piece[some] = joined(symbol[some], symbol[some + 1])
    return out


def join_once(symbols: np.ndarray, starts: np.ndarray, model: Model) -> np.ndarray:
    """``join_all``, but equal words are joined once.

    Words meet by a hash in a table of slots, each of which keeps one word; the others of its hash are compared with it
    symbol by symbol and take its result. Words that lost their slot to one of another hash are joined themselves.
    """
    heads = np.flatnonzero(starts)
    sizes = np.diff(heads, append=len(starts))
    hashes = run_hashes(mix(symbols.astype(np.uint64) * GOLDEN), heads, heads + sizes)
    slots = np.zeros(1 << SLOT_BITS, np.int64)
    slot = hashes >> np.uint64(64 - SLOT_BITS)
    me = np.arange(len(heads))
    slots[slot] = me
    other = slots[slot]
    other = np.where((hashes[other] == hashes) & (sizes[other] == sizes), other, me)
    source = np.arange(len(symbols)) + np.repeat(heads[other] - heads, sizes)
    if not (symbols[source] == symbols).all():
        return join_all(symbols, starts, model)
    chosen = np.repeat(other == me, sizes)
    out = np.empty_like(symbols)
    out[chosen] = join_all(symbols[chosen], starts[chosen], model)
    return out[source]


def whole_words(starts: np.ndarray, step: int) -> list[int]:
    """The ends of parts of about ``step`` symbols that cut no word, so that a long text needs no more memory at once."""
    heads = np.r_[np.flatnonzero(starts), len(starts)]
    return np.unique(heads[np.searchsorted(heads, np.r_[0 : len(starts) : step, len(starts)])]).tolist()


def utf8_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each code point, and how many."""
    size = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    text = codes.astype("<u4").tobytes().decode("utf-32-le")
    return np.frombuffer(text.encode(), np.uint8), size


def encode(data: np.ndarray, offsets: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after the other, and where each text's begin. ``data`` are UTF-8 bytes."""
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n_before = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets]
    full = np.diff(n_before) > 0
    begins = n_before[:-1][full]
    codes = np.insert(codes, begins, ord(SPACE))
    codes[codes == 0x20] = ord(SPACE)
    begins = begins + np.arange(len(begins))
    symbols = model.symbols[codes]
    known = symbols >= 0
    starts = ~np.r_[False, known[1:] & known[:-1]][: len(codes)]
    starts[begins] = True
    inner = np.flatnonzero(~starts)
    for some in (inner[i : i + STEP_BYTES] for i in range(0, len(inner), STEP_BYTES)):
        starts[some] = model.beside.get(symbols[some - 1] * np.int32(model.n_symbols) + symbols[some]) < 0
    edges = whole_words(starts, STEP_BYTES)
    out = np.concatenate([join_once(symbols[a:b], starts[a:b], model) for a, b in zip(edges, edges[1:], strict=False)] or [symbols])
    place = np.flatnonzero(out != GONE)
    found = out[place]
    spelt = (found < 0) | (found >= model.n_pieces)  # by its bytes
    raw, size = utf8_of(codes[place[spelt]])
    width = np.ones(len(found), np.int64)
    width[spelt] = size
    ids = np.repeat(found, width)
    ids[np.repeat(spelt, width)] = model.byte_ids[raw]
    n_ids = np.zeros(len(full), np.int64)
    if len(begins):
        n_ids[full] = np.add.reduceat(width, np.searchsorted(place, begins))
    return ids, np.r_[0, np.cumsum(n_ids)]


def spans_of(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> bytes:
    """The bytes of all spans, one after the other."""
    ends = np.cumsum(size)
    return data[np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)].tobytes()


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("each-byte", _each_byte)


def decode(ids: np.ndarray, offsets: np.ndarray, model: Model) -> list[str]:
    """The text of each run of ids. Bytes that are no UTF-8 give U+FFFD each; ids outside the model are an error."""
    if len(ids) and not (0 <= ids.min() and ids.max() < model.n_pieces):
        raise ValueError("an id is not of the model")
    begin = np.r_[0, model.surface_ends[:-1]][ids]
    size = model.surface_ends[ids] - begin
    # The first id of a text that says anything loses the space that encoding put in front.
    heard = np.flatnonzero(~model.silent[ids])
    at = np.searchsorted(heard, offsets[:-1])
    some = at < len(heard)
    head = heard[at[some]]
    head = head[(head < offsets[1:][some]) & model.leading[ids[head]]]
    begin[head] += 1
    size[head] -= 1
    ends = np.cumsum(size)
    steps = (slice(i, i + STEP_IDS) for i in range(0, len(ids), STEP_IDS))
    data = b"".join(spans_of(model.surfaces, begin[part], size[part]) for part in steps)
    # A silent id says nothing, but bytes before and after it are no character together.
    cuts = np.union1d(offsets, np.flatnonzero(model.silent[ids]))
    edges = np.r_[0, ends][cuts].tolist()
    parts = [data[a:b].decode("utf-8", "each-byte") for a, b in zip(edges, edges[1:], strict=False)]
    at = np.searchsorted(cuts, offsets).tolist()
    return ["".join(parts[a:b]) for a, b in zip(at, at[1:], strict=False)]


def read_model(path: str) -> bytes:
    """The serialised model: it has a fixed size and travels with the functions below, so executors need no file."""
    return sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto()


def encoded(text: Column, proto: bytes) -> Column:
    """The piece ids of each text as an array of int, without begin or end ids; null and empty texts have none."""

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        model = model_of(proto)
        data, offsets = texts_of(texts)
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for a, b in pieces(offsets, STEP_BYTES):
            part = offsets[a : b + 1]
            found, firsts = encode(data[part[0] : part[-1]], part - part[0], model)
            ids.append(found.astype(np.int32, copy=False))
            sizes.append(np.diff(firsts))
        ends = np.cumsum(np.concatenate(sizes)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))

    return ids_of(text)


def decoded(ids: Column, proto: bytes) -> Column:
    """The text of each array of ids; null and empty arrays give the empty text, null ids count as unknown."""

    @F.arrow_udf("string")
    def texts_of_ids(lists: pa.Array) -> pa.Array:
        model = model_of(proto)
        out = [pa.array([], pa.string())]
        sizes = pc.coalesce(pc.list_value_length(lists), pa.scalar(0, pa.int32())).to_numpy(zero_copy_only=False)
        offsets = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
        for a, b in pieces(offsets, STEP_IDS):
            values = lists.slice(a, b - a).flatten().fill_null(0).to_numpy(zero_copy_only=False)
            out.append(pa.array(decode(values, offsets[a : b + 1] - offsets[a], model), pa.string()))
        return pa.concat_arrays(out)

    return texts_of_ids(ids)


def tokenised(docs: DataFrame, path: str, text: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text in ``name``; a column of that name is replaced, rows stay as they are."""
    return docs.withColumn(name, encoded(F.col(text), read_model(path)))


def report(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 and decoded_sha256, over the decimal ids and the decoded text.

    A null text is empty. Rows that share an id, or have none, are documents of their own.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ids = free_name(rows, "ids")
    found = tokenised(rows, path, name=ids).drop("text").withColumn("decoded", decoded(F.col(ids), read_model(path)))
    return found.select(
        "doc_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
