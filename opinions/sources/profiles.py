"""Language profiles as stored tables, learned once and read by later jobs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How texts are cleaned and cut before they are counted. A change there needs a new number.
FORMAT = 1
WORDS = T.StructType([T.StructField(n, t) for n, t in (("lang", T.StringType()), ("word", T.StringType()), ("c", T.LongType()))])
PROFILES = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("gram", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.LongType()),
        T.StructField("v", T.LongType()),
        T.StructField("logp", T.DoubleType()),
    ]
)


class Stored(NamedTuple):
    words: DataFrame
    profiles: DataFrame


def write_profiles(words: DataFrame, profiles: DataFrame, path: str, format: int = FORMAT) -> None:
    """Store ``word_counts`` and ``langid_profiles`` under ``path``, where nothing may be yet.

    The row that names the format comes last, so a write that broke off cannot be read.
    """
    words.select(WORDS.fieldNames()).write.parquet(f"{path}/words")
    profiles.select(PROFILES.fieldNames()).write.parquet(f"{path}/profiles")
    spark = words.sparkSession
    known = spark.read.schema(PROFILES).parquet(f"{path}/profiles")
    sums = known.agg(F.count(F.lit(1)).alias("grams"), F.count_distinct("lang").alias("langs"))
    sums.select(F.lit(format).alias("format"), "grams", "langs").coalesce(1).write.parquet(f"{path}/about")


def read_profiles(spark: SparkSession, path: str) -> Stored:
    """What ``write_profiles`` has stored; another format, or tables that are not whole, are refused."""
    about = spark.read.schema("format int, grams long, langs long").parquet(f"{path}/about").first()
    if about is None or about["format"] != FORMAT:
        raise ValueError(f"profiles of format {about and about['format']} cannot be read, only {FORMAT}")
    profiles = spark.read.schema(PROFILES).parquet(f"{path}/profiles")
    if profiles.count() != about["grams"]:
        raise ValueError("the profiles are not whole")
    return Stored(spark.read.schema(WORDS).parquet(f"{path}/words"), profiles)
