"""Line dedup by a tree of templates: recurring templates across documents are dropped.

The tree has a fixed depth: a line goes by its number of tokens, then by its leading tokens, to a leaf. Tokens with a digit count
as variable everywhere. Within a leaf, a token is fixed where enough documents have it at the same position and variable
where they do not; a line with its variable tokens blanked is its template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketstream.functions.codec import computed_once
from marketstream.llm.common import written
from marketstream.operators.membership import filtered_join, join_set

VARIABLE = "<*>"
#: Leading tokens that choose the leaf.
LEADING = 3
#: A template recurs when it stands in so many documents; as many make a token of a leaf fixed.
LEAST_DOCUMENTS = 10
#: A template has at least so many fixed tokens; one of variable tokens alone says nothing about a line.
LEAST_FIXED = 1

TOKEN = r"[^\x09-\x0D\x20]+"


def masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), VARIABLE).otherwise(t))


def parsed(docs: DataFrame, doc_id: str, text: str, leading: int) -> DataFrame:
    """One row per line that has a token: doc (a hash of id and text), line (from 0), leaf and tokens."""
    lines = docs.select(F.xxhash64(doc_id, text).alias("doc"), F.posexplode(F.split(text, "\n")).alias("line", "value"))
    tokens = computed_once(lines, "tokens", F.regexp_extract_all("value", F.lit(TOKEN), F.lit(0)))
    leaf = F.xxhash64(F.size("tokens"), masked(F.slice("tokens", 1, leading)))
    return tokens.filter(F.size("tokens") > 0).select("doc", "line", leaf.alias("leaf"), "tokens")


def by_hash(masked: Column) -> list[Column]:
    """128 bits that stand for a masked line or a template in every step that compares them."""
    return [F.xxhash64(masked).alias("h1"), F.xxhash64(F.lit("second"), masked).alias("h2")]


LINE = ["leaf", "h1", "h2"]


def recurring(lines: DataFrame, least: int, fixed: int) -> DataFrame:
    """The lines (doc, line) of ``lines`` whose template stands in at least ``least`` documents.

    Only whether a count reaches ``least`` matters. So of the documents of a line ``least`` are enough, and the others are left
    out before the shuffle; a line that has as many recurs by itself, and only the few documents of rarer lines have to be
    put together by template.
    """
    leaves = lines.select("leaf", "doc").distinct().groupBy("leaf").count().filter(F.col("count") >= least).select("leaf")
    # Only lines in leaves of several documents can recur.
    shared = join_set(lines, written(leaves, "leaves"), "leaf", "left_semi")
    shared = written(shared.select("doc", "line", "leaf", F.array_join(masked(F.col("tokens")), " ").alias("masked")), "shared-lines")
    hashed = shared.select("doc", "line", "leaf", *by_hash(F.col("masked")))
    nth = F.dense_rank().over(Window.partitionBy(*LINE).orderBy("doc"))
    some = hashed.select(*LINE, "doc").withColumn("nth", nth).filter(F.col("nth") <= least).select(*LINE, "doc").distinct()
    some = written(some, "documents-of-lines")
    counts = some.groupBy(*LINE).agg(F.count("*").alias("docs"))
    texts = shared.select("leaf", "masked").distinct().select("leaf", "masked", *by_hash(F.col("masked")))
    different = written(texts.join(counts, LINE), "different-lines")
    at = different.select(*LINE, "docs", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    common = at.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("together")).filter(F.col("together") >= least)
    is_fixed = F.col("together").isNotNull() & (F.col("token") != VARIABLE)
    kept = at.join(common, ["leaf", "place", "token"], "left").select(
        *LINE, "docs", F.struct("place", F.when(is_fixed, F.col("token")).otherwise(VARIABLE).alias("token")).alias("at")
    )
    # As many rows as a line has tokens meet here.
    whole = kept.groupBy(*LINE, "docs").agg(F.array_sort(F.collect_list("at"))["token"].alias("tokens"))
    n_fixed = F.size(F.filter("tokens", lambda t: t != VARIABLE))
    template = F.struct("leaf", *by_hash(F.array_join("tokens", " "))).alias("template")
    templates = written(whole.filter(n_fixed >= fixed).select(*LINE, "docs", template), "templates")
    rare = some.join(templates.filter(F.col("docs") < least), LINE).select("template", "doc").distinct()
    often = rare.groupBy("template").count().filter(F.col("count") >= least).select("template")
    often = written(often.union(templates.filter(F.col("docs") >= least).select("template")).distinct(), "recurring")
    key = F.struct(*LINE).alias("key")
    drop = written(join_set(templates, often, "template", "left_semi").select(key), "lines-to-drop")
    return join_set(hashed.select("doc", "line", key), drop, "key", "left_semi").select("doc", "line")


def without(text: Column, gone: Column) -> Column:
    """``text`` without the lines that ``gone`` marks by a 1 at their place; null stays null, and a null ``gone`` keeps all."""
    is_gone = lambda i: F.coalesce(F.substring(gone, i + 1, F.lit(1)) == F.lit(b"1"), F.lit(False))
    return F.array_join(F.filter(F.split(text, "\n"), lambda line, i: ~is_gone(i)), "\n")


def as_marks(numbers: Column) -> Column:
    """Line numbers, rising, as bytes: 1 at each of them, 0 before and between. A place is then found without a search."""
    def until(n: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(numbers, i - 1))
        return F.concat(F.repeat(F.lit("0"), n - before - 1), F.lit("1"))

    return F.array_join(F.transform(numbers, until), "").cast("binary")


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    leading: int = LEADING, least: int = LEAST_DOCUMENTS, fixed: int = LEAST_FIXED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped and text without the lines of recurring templates.

    Every line of a recurring template goes, the first included. Lines without a token stay. A null text has no lines and
    stays null; an empty one has one line. Rows that repeat id and text are one document and get the same result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    gone = recurring(parsed(rows, "doc_id", "text", leading), least, fixed)
    # As many rows as a document has lines meet here.
    numbers = written(gone.distinct().groupBy("doc").agg(F.array_sort(F.collect_list("line")).alias("numbers")), "lines-of-documents")
    lists = numbers.select("doc", F.size("numbers").alias("n"), as_marks(F.col("numbers")).alias("gone"))
    # Texts that keep all their lines stay where they are. The others are joined in one way at every size.
    keyed = filtered_join(rows.withColumn("doc", F.xxhash64("doc_id", "text")), lists.hint("merge"), "doc", "left")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    return keyed.select(
        "doc_id", n_lines.cast("bigint").alias("n_lines"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_dropped"), without(F.col("text"), F.col("gone")).alias("text"),
    )
