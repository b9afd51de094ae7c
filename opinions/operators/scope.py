"""Which mentions count: null users, rival subjects, region scope and the three populations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinions.functions.text import mentions_word
from opinions.functions.values import parse_join_date

POPULATIONS = ("mentions", "users", "established")
ORDERS = ("dedup_first", "positive_first")


def keep_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Drop every column that is not wanted; wanted columns that are absent are ignored."""
    return df.select(*[c for c in df.columns if c in set(wanted)])


def drop_missing_user(df: DataFrame) -> DataFrame:
    # Not na.drop: its predicate is not pushed into the scan.
    return df.filter(F.col("user_id").isNotNull())


def exclude_cross_mention(df: DataFrame, rivals: dict[str, str], text: str = "text") -> DataFrame:
    """Drop texts that name the rival of their own subject; null texts go too."""
    hit = F.lit(False)
    for subject, word in rivals.items():
        hit = hit | ((F.col("subject") == subject) & mentions_word(F.col(text), word))
    return df.filter(F.col(text).isNotNull() & ~hit)


def region_scope(df: DataFrame, countries: Sequence[str], excluded: Sequence[str]) -> DataFrame:
    """Mentions from the listed countries and from a known, not excluded region."""
    return (
        df.filter(F.col("country").isin(*countries))
        .filter(F.col("region").isNotNull() & ~F.col("region").isin(*excluded))
        .withColumn("join_date", parse_join_date(F.col("user_join_date")))
    )


def one_per_user(df: DataFrame, keep: str = "first") -> DataFrame:
    """One row per subject and user, by time and then id.

    Written as a rank filter: Spark limits each task's rows per user before the shuffle, so a very
    active user sends at most one row per task.
    """
    order = ["ts", "mention_id"]
    by = [F.asc(c) for c in order] if keep == "first" else [F.desc(c) for c in order]
    w = Window.partitionBy("subject", "user_id").orderBy(*by)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def joined_before(df: DataFrame, cutoff: str) -> DataFrame:
    return df.filter(F.col("join_date") < F.lit(cutoff).cast("date"))


def positives(df: DataFrame) -> DataFrame:
    return df.filter(F.col("polarity") == 1)


def population(
    scoped: DataFrame, kind: str, cutoff: str | None = None, order: str = "dedup_first"
) -> DataFrame:
    """All mentions, one per user, or one per long-standing user.

    ``dedup_first`` keeps each user's first mention of any polarity. ``positive_first`` looks at
    positive mentions only and keeps each user's last one.
    """
    if kind not in POPULATIONS:
        raise ValueError(f"population must be one of {POPULATIONS}")
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    if kind == "established" and cutoff is None:
        raise ValueError("established users need a cutoff date")
    if order == "positive_first":
        scoped = positives(scoped)
    if kind == "mentions":
        return scoped
    users = one_per_user(scoped, "first" if order == "dedup_first" else "last")
    return users if kind == "users" else joined_before(users, cutoff)
