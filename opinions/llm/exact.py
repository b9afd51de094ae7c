"""Exact dedup by chunk recipes: texts become ordered lists of verified chunk identifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinions.llm.common import written

#: White space that does not count: space, tab, line feed, vertical tab, form feed, carriage return.
IGNORED = " \t\n\x0b\x0c\r"
#: A chunk ends at the end of a sentence once it is LEAST characters long.
LEAST, MOST = 512, 8192
ENDS = ".!?\u2026\u3002\uff01\uff1f\u061f\u0964"
SENTENCES = rf"(?s).{{{LEAST},}}?(?:[{ENDS}]|\z)|.+"
#: Where none ends within MOST characters, it ends after one of about MARKS windows of WINDOW characters, which their hash
#: chooses, and after MOST characters only where that finds none. The mark is white space, which no normalised text has.
WINDOW, MARKS, MARK = 8, 1024, "\n"
MARKED = rf"(?s)[^{MARK}](?:.{{{LEAST - 1},{MOST - 1}}}?(?:{MARK}|\z)|.{{0,{MOST - 1}}}{MARK}?)"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    kept = F.coalesce(text, F.lit(""))
    for space in IGNORED:
        kept = F.replace(kept, F.lit(space), F.lit(""))
    return kept


def marked(run: Column) -> Column:
    """``run`` with a MARK after every window of WINDOW characters that its hash chooses, wherever the window stands."""

    def mark(letters: Column) -> Column:
        def ended(letter: Column, i: Column) -> Column:
            window = F.xxhash64(*[F.get(letters, i - k) for k in range(WINDOW)])
            return F.when(F.pmod(window, F.lit(MARKS)) == 0, F.concat(letter, F.lit(MARK))).otherwise(letter)

        return F.array_join(F.transform(letters, ended), "")

    return F.transform(F.array(F.split(run, "")), mark)[0]  # the letters are bound once


def chunks(text: Column) -> Column:
    """Content-defined chunks of a normalised text, in order; their concatenation is the text.

    Sentences decide first. A run of more than MOST characters without the end of one (a list, code, encoded data) is cut
    by its own characters; so an insertion changes the chunks around it and hardly any later ones.
    """

    def cut(run: Column) -> Column:
        pieces = F.regexp_extract_all(marked(run), F.lit(MARKED), F.lit(0))
        recut = F.transform(pieces, lambda c: F.replace(c, F.lit(MARK), F.lit("")))
        return F.when(F.length(run) <= MOST, F.array(run)).otherwise(recut)

    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(SENTENCES), F.lit(0)), cut))


def identifier(chunk: Column) -> Column:
    """96 bits from two unrelated hash functions."""
    return F.struct(F.xxhash64(chunk).alias("a"), F.hash(chunk).alias("b"))


def ambiguous(cut: DataFrame) -> DataFrame:
    """Identifiers that stand for several texts, among all chunks (``h``, ``chunk``).

    Every distinct chunk moves once. Copies are combined before the shuffle, so a chunk that a third of
    all documents share arrives once from each task.
    """
    distinct = cut.groupBy("h", "chunk").agg(F.lit(1).alias("one"))
    return distinct.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")


def deduplicated(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    identify: Callable[[Column], Column] = identifier,
) -> DataFrame:
    """Group texts that are equal apart from white space: key, keep_id, group_size, kept, text_sha256.

    A text is cut into content-defined chunks and becomes the ordered list of their identifiers. These
    are verified first: all distinct chunks are compared by identifier, and only if none stands for
    two texts do lists of identifiers decide; else the chunks themselves stay in the lists. Equal lists
    then always mean equal texts. Long documents move once, as distinct chunks; groups are found and
    joined by lists of identifiers.

    Of equal texts the row with the most characters stays, then the one with the smallest key. A null
    text counts as empty, and all empty texts are one group. Rows that repeat a key get the same
    decision each, a null key sorts first, other columns are ignored, an empty table gives no rows.
    """
    clean = docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.length(text), F.lit(0)).alias("size"),
        normalised(F.col(text)).alias("norm"),
    )
    listed = clean.select("id", "size", F.sha2("norm", 256).alias("sha"), chunks(F.col("norm")).alias("recipe"))
    lists = written(listed.withColumn("recipe", F.transform("recipe", identify)))
    cut = clean.select(F.explode(chunks(F.col("norm"))).alias("chunk"))
    if not written(ambiguous(cut.select(identify(F.col("chunk")).alias("h"), "chunk"))).isEmpty():
        lists = listed
    first = F.min(F.struct((-F.col("size")).alias("size"), F.col("id")))
    groups = written(
        lists.groupBy("recipe")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("recipe").alias("_recipe"), F.col("first.id").alias("keep"), "n")
    )
    joined = lists.join(groups, F.col("recipe") == F.col("_recipe"), "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return joined.select(
        F.col("id").alias(key),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
