"""Labels, dates, ratios and keys as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JOIN_DATE_FORMATS = ("M-d-yyyy", "yyyy-M-d", "yyyy-M-d H:m:s")


def polarity_of(compound: Column) -> Column:
    return F.when(compound > 0, 1).when(compound < 0, -1).otherwise(0)


def recode(c: Column, mapping: Mapping[int, int], keep_unmatched: bool) -> Column:
    """Map label values; others become null or stay."""
    out = None
    for old, new in mapping.items():
        out = F.when(c == old, new) if out is None else out.when(c == old, new)
    return out.otherwise(c) if keep_unmatched else out


def joint_class(subject: Column, polarity: Column, subjects: Sequence[str]) -> Column:
    """One class id over all subjects: 0 neutral, then (negative, positive) per subject."""
    out = F.when(polarity == 0, 0)
    for i, s in enumerate(subjects):
        out = out.when((subject == s) & (polarity == -1), 2 * i + 1)
        out = out.when((subject == s) & (polarity == 1), 2 * i + 2)
    return out


def leader_of(sides: Sequence[Column], names: Sequence[str], tie: str = "first") -> Column:
    """Name of the largest of two or more sides; of those that draw, the first or the last one is named."""
    if tie not in ("first", "last"):
        raise ValueError("tie must be 'first' or 'last'")
    if len(sides) < 2 or len(sides) != len(names):
        raise ValueError("a leader needs two or more sides, each with a name")
    most = F.greatest(*sides)
    named = list(zip(sides, names)) if tie == "first" else list(zip(sides, names))[::-1]
    return F.coalesce(*[F.when(side == most, name) for side, name in named])


def parse_join_date(c: Column, formats: Sequence[str] = JOIN_DATE_FORMATS) -> Column:
    """Date written with / or -, in any of ``formats``; null if none fits."""
    text = F.replace(c, F.lit("/"), F.lit("-"))
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


#: Notations that a column of dates may have, the likelier one of two that fit equally often first.
DATE_NOTATIONS = ("M-d-yyyy", "d-M-yyyy", "yyyy-M-d", "yyyy-d-M", "yyyy-M-d H:m:s", "d-M-yyyy H:m:s", "M-d-yyyy H:m:s", "d MMM yyyy", "MMM d, yyyy")


def _dates(c: Column, notations: Sequence[str]) -> list[Column]:
    text = F.regexp_replace(F.trim(c), "[/.]", "-")
    return [F.try_to_date(text, f) for f in notations]


def date_notations(df: DataFrame, column: str, notations: Sequence[str] = DATE_NOTATIONS) -> DataFrame:
    """notation, fits, alone, place: how many values each notation reads, how many only it does, and its place.

    One pass over the rows. The notation that reads most has place 1; of equals the one that reads more alone, then the one
    named earlier.
    """
    read = df.select(F.array(*_dates(F.col(column), notations)).alias("d"))
    only = F.size(F.filter("d", lambda x: x.isNotNull())) == 1
    counts = [
        F.struct(
            F.count_if(F.col("d")[i].isNotNull()).alias("fits"),
            F.count_if(F.col("d")[i].isNotNull() & only).alias("alone"),
            F.lit(-i).alias("named"),
            F.lit(f).alias("notation"),
        )
        for i, f in enumerate(notations)
    ]
    ordered = read.agg(F.reverse(F.array_sort(F.array(*counts))).alias("o"))
    return ordered.select(F.posexplode("o").alias("place", "o")).select(
        "o.notation", "o.fits", "o.alone", (F.col("place") + 1).alias("place")
    )


def parse_dates(df: DataFrame, column: str, name: str, notations: Sequence[str] = DATE_NOTATIONS) -> DataFrame:
    """Add ``name``, the date by the notation in use, and ``<name>_unsure``, whether another that is in use reads another day.

    A notation is in use if it reads some value that no other does, or reads the most. A value that several read goes by
    the one with the better place. A row a notation comes to the driver.
    """
    ranked = sorted(date_notations(df, column, notations).collect(), key=lambda r: r["place"])
    used = [r["notation"] for r in ranked if r["alone"] or (r["place"] == 1 and r["fits"])]
    if not used:
        return df.select("*", F.lit(None).cast("date").alias(name), F.lit(False).alias(f"{name}_unsure"))
    dates = F.filter(F.array(*_dates(F.col(column), used)), lambda x: x.isNotNull())
    return df.select("*", F.get(dates, F.lit(0)).alias(name), (F.size(F.array_distinct(dates)) > 1).alias(f"{name}_unsure"))


def to_int(c: Column) -> Column:
    return F.trim(c).try_cast("int")


def to_double(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def ratio(a: Column, b: Column) -> Column:
    """a / b, null when b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def in_test_split(key: Column, folds: int = 5) -> Column:
    """Membership of the held-out fold; depends on the key alone, so reruns agree."""
    return F.pmod(key, F.lit(folds)) == 0
