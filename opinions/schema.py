"""Table schemas. Every reader declares its schema; nothing is inferred."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw CSV exports carry strings only; typed columns are derived on purpose later.
RAW_MENTION = _strings("user_id", "text", "user_join_date", "city", "country", "region", "region_code")

OUTCOME = _strings("region", "winner", "weight", "votes_a", "votes_b")

MENTION = T.StructType(
    [
        T.StructField("mention_id", T.LongType()),
        T.StructField("subject", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("user_join_date", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

LEXICON = T.StructType(
    [T.StructField("token", T.StringType()), T.StructField("valence", T.DoubleType())]
)
