"""Repeated lines: a line that several documents hold stays in the first of them only.

1. Texts are exploded into lines. A line's key is the line without white space at its ends and
   with A-Z in lower case; keys of fewer than LEAST_CHARS code points are left alone.
2. Keys are hashed (128 bits), and the distinct documents of each hash are counted. A task hands
   on one row per hash and document, then one per hash, so a line that most documents hold
   is never gathered in one place.
3. Lines whose hash is in LEAST_DOCS documents or more are dropped, unless they are in the
   document with the smallest doc_id that holds it, which keeps all of them.
4. Texts are put together again, by position, from the stretches between dropped lines.

Lines end at a line feed; a null or empty text is one empty line. White space is space, tab,
line feed, vertical tab, form feed and carriage return. Rows without a doc_id hold no line for
others and lose none. Rows of one doc_id are one document: repeated rows, or texts that
share an id, don't make a line repeated, and each row loses its own lines. Empty tables give
no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.stored import stored
from wattledger.operators.joins import join_groups

LEAST_CHARS = 10
LEAST_DOCS = 2

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def hashed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, text_hash, place (from 0), line (16 bytes): the lines that may be dropped."""
    key = line_key(F.col("line"))
    return (
        docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            F.posexplode(_lines(F.col("text"))).alias("place", "line"),
        )
        .where(F.length(key) >= least_chars)
        .select("doc_id", "text_hash", "place", F.unhex(F.md5(F.encode(key, "UTF-8"))).alias("line"))
    )


def dropped_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """doc_id, text_hash, places (sorted): the lines that each text loses."""
    # Splitting and hashing whole texts is the work here; it is done once.
    lines = stored(hashed_lines(docs, least_chars), "lines")
    repeated = stored(
        lines.select("line", "doc_id")
        .distinct()
        .groupBy("line")
        .agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_id"))
        .where(F.col("n_docs") >= least_docs)
        .select("line", "first_id"),
        "repeated-lines",
    )
    return (
        join_groups(lines, repeated, ["line"], ["doc_id", "place"])
        .where(F.col("doc_id") != F.col("first_id"))
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set("place")).alias("places"))
    )


def _without(lines: Column, places: Column) -> Column:
    """The lines between the dropped places: one slice for each stretch, so a long text takes
    time in proportion to its lines."""
    before = F.concat(F.array(F.lit(-1)), places)
    after = F.concat(places, F.array(F.size(lines)))
    return F.flatten(F.zip_with(before, after, lambda a, b: F.slice(lines, a + 2, b - a - 1)))


def keep_first(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped, kept (the lines that stay, joined by line
    feeds), for every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dropped = stored(dropped_lines(docs, least_chars, least_docs), "dropped-lines")
    lines = _lines(F.col("text"))
    none = F.col("places").isNull()
    return (
        docs.withColumn("text_hash", F.xxhash64("text"))
        .join(dropped, ["doc_id", "text_hash"], "left")
        .select(
            "doc_id",
            F.size(lines).cast("long").alias("n_lines"),
            F.when(none, 0).otherwise(F.size("places")).cast("long").alias("n_dropped"),
            F.when(none, F.coalesce("text", F.lit("")))
            .otherwise(F.array_join(_without(lines, F.col("places")), "\n"))
            .alias("kept"),
        )
    )
