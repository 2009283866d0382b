"""JSON arrays in files of any size, read by many tasks.

An array has no line breaks to split at, and a byte in its middle may be text, a key or a border of an element. What it is
follows from all bytes before: an odd number of quotes before it means that it is inside a string, and the brackets outside strings
give its depth. Both are sums, so ranges of bytes are summed up side by side, for either way a range may begin; a prefix
sum over ranges, one row each, tells how every range does begin; then each range finds the commas at depth one in itself.
Elements within a range are never moved. Only the pieces at the ranges' edges meet, two a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstream.operators import membership
from marketstream.session import materialise

QUOTE, BACKSLASH, COMMA = b'"'[0], b"\\"[0], b","[0]
STEP = np.zeros(256, np.int64)
STEP[list(b"[{")], STEP[list(b"]}")] = 1, -1

RANGE = ["file", "block"]
SUMMARY = "file string, block bigint, quotes bigint, outside bigint, inside bigint"
PIECE = "file string, block bigint, n bigint, begin string, text string, end string"


def marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte whether the number of quotes up to and with it is odd, not counting escaped ones, and its step in depth."""
    quotes = np.flatnonzero(data == QUOTE)
    if len(quotes) and (data == BACKSLASH).any():
        # A quote is escaped when an odd number of backslashes stands right in front of it.
        plain = np.r_[-1, np.flatnonzero(data != BACKSLASH)]
        before = plain[np.searchsorted(plain, quotes) - 1]
        quotes = quotes[(quotes - before) % 2 == 1]
    odd = np.zeros(len(data), np.int8)
    odd[quotes] = 1
    return np.cumsum(odd, dtype=np.int64) % 2 == 1, STEP[data]


def batches_of(batches: Iterator[pa.RecordBatch], separator: str) -> Iterator[tuple[tuple[str, int], bytes, dict]]:
    """The bytes of each range, batch by batch, with the batch's first row as a dictionary.

    A row ends where a separator was, so every row but a file's first begins with one.
    """
    last = None
    for batch in batches:
        names = batch.schema.names
        values, keys = batch.column(names.index("value")), [batch.column(names.index(k)).to_pylist() for k in RANGE]
        place = list(zip(*keys, strict=True))
        edges = [i for i in range(len(place)) if i == 0 or place[i] != place[i - 1]] + [len(place)]
        for a, b in zip(edges, edges[1:], strict=False):
            text = separator.join(values.slice(a, b - a).to_pylist())
            whole = place[a] == last or place[a][1] > 0
            last = place[a]
            yield last, (separator + text if whole else text).encode(), batch.slice(a, 1).to_pylist()[0]


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (c.split() for c in schema.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)], schema=pa.schema(fields))


def _summaries(separator: str):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[int]] = {}
        for key, text, _ in batches_of(batches, separator):
            odd, step = marks(np.frombuffer(text, np.uint8))
            total = found.setdefault(key, [0, 0, 0])
            # Places are outside or inside by the quotes since the range's begin.
            outside, inside = int(step[~odd].sum()), int(step[odd].sum())
            swap = total[0] % 2
            total[0] += int(odd[-1]) if len(odd) else 0
            total[1] += inside if swap else outside
            total[2] += outside if swap else inside
        yield batch_of([(*key, *total) for key, total in found.items()], SUMMARY)

    return sums


def _pieces(separator: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rest, begin, n, odd_before, depth_before = None, b"", None, 0, False, 0

        def piece(text: bytes, end: str | None) -> tuple:
            return (*key, n, begin, text.decode(), end)

        for place, text, row in batches_of(batches, separator):
            out = []
            if place != key:
                if key is not None:
                    out.append(piece(rest, None))
                key, rest, begin, n = place, b"", None, 0
                odd_before, depth_before = bool(row["odd"]), row["depth"]
            data = np.frombuffer(text, np.uint8)
            odd, step = marks(data)
            outside = odd == odd_before
            depth = depth_before + np.cumsum(np.where(outside, step, 0))
            # Commas at depth one, and the brackets from and to depth zero.
            border = outside & (((data == COMMA) & (depth <= 1)) | ((step == 1) & (depth <= 1)) | ((step == -1) & (depth <= 0)))
            at = 0
            for i in np.flatnonzero(border).tolist():
                sign = chr(data[i])
                if sign not in "[,]" or depth[i] < 0 or (sign == "," and depth[i] < 1):
                    raise ValueError(f"malformed JSON array {key[0]}: {sign!r} at depth {depth[i]}")
                out.append(piece(rest + text[at:i], sign))
                rest, at, begin, n = b"", i + 1, sign, n + 1
            rest += text[at:]
            if len(data):
                odd_before, depth_before = bool(odd[-1]) != odd_before, int(depth[-1])
            if out:
                yield batch_of(out, PIECE)
        if key is not None:
            yield batch_of([piece(rest, None)], PIECE)

    return cut


def _joined(pieces: DataFrame) -> DataFrame:
    """Pieces with both borders as they are; those at edges put together along each file."""
    whole = F.col("begin").isNotNull() & F.col("end").isNotNull()
    along = W.partitionBy("file").orderBy("block", "n")
    edges = pieces.filter(~whole).withColumn("_run", F.count("begin").over(along.rowsBetween(W.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("block", "n", "text")))
    met = edges.groupBy("file", "_run").agg(
        F.max("begin").alias("begin"), F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"), F.max("end").alias("end"))
    return pieces.filter(whole).select("file", "begin", "text", "end").unionByName(met.drop("_run"))


def elements(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """The text of each element of the arrays at ``path``, ``file, text``; an error where a file is not one array.

    ``separator`` is any one sign that arrays of this kind often have, such as the end of an object; it only decides how long the
    pieces are in which files are read. Quotes and backslashes cannot be, as an escape would be cut in two.
    """
    if len(separator) != 1 or separator in ('"', "\\"):
        raise ValueError("the separator is one sign, but no quote and no backslash")
    lines = spark.read.text(path, lineSep=separator).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    sums = lines.mapInArrow(_summaries(separator), SUMMARY).groupBy(*RANGE).agg(*[F.sum(c).alias(c) for c in ("quotes", "outside", "inside")])
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    begins = sums.withColumn("odd", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1)
    step = F.when(F.col("odd"), F.col("inside")).otherwise(F.col("outside"))
    begins = begins.withColumn("_step", step).withColumn("depth", F.coalesce(F.sum("_step").over(earlier), F.lit(0)))
    begins = materialise(begins.select(*RANGE, "odd", "depth"), "json-ranges")
    if membership.is_small(begins):
        known = lines.join(F.broadcast(begins), RANGE)
    else:
        order = lines.withColumn("_row", F.monotonically_increasing_id()).join(begins, RANGE)
        known = order.repartition(*RANGE).sortWithinPartitions(*RANGE, "_row").drop("_row")
    found = _joined(materialise(known.mapInArrow(_pieces(separator), PIECE), "json-pieces"))
    blank = F.col("text").rlike(r"^\s*$")
    empty = blank & (F.col("begin") == "[") & (F.col("end") == "]")
    inner = F.col("begin").isin("[", ",") & F.col("end").isin(",", "]") & ~blank
    margin = blank & ((F.col("begin").isNull() & (F.col("end") == "[")) | ((F.col("begin") == "]") & F.col("end").isNull()))
    wrong = F.raise_error(F.concat(F.lit("malformed JSON array "), "file"))
    checked = F.when(F.coalesce(inner, F.lit(False)), F.col("text")).when(F.coalesce(empty | margin, F.lit(False)), F.lit(None)).otherwise(wrong)
    return found.select("file", checked.alias("text")).filter(F.col("text").isNotNull())


def read(spark: SparkSession, path: str, kind: T.DataType, separator: str = "}") -> DataFrame:
    """The elements of the arrays at ``path`` as one column ``element``; one that is not of ``kind`` is an error."""
    alone = F.concat(F.lit("["), "text", F.lit("]"))
    parsed = F.from_json(alone, T.ArrayType(kind), {"mode": "FAILFAST"})
    return elements(spark, path, separator).select(F.explode(parsed).alias("element"))
