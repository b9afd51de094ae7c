"""Sharding by jump consistent hashing: a stable key and the number of shards decide, with no ring table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from opinions.llm.common import with_rank

#: Fixed values of the published algorithm (Lamping and Veach, 2014).
MULTIPLIER = 2862933555777941757
#: Bytes that a row costs besides its text.
ROW_BYTES = 16


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key. A key's jumps end after about ln(shards) steps; all keys jump together."""
    state = keys.astype(np.uint64)
    shard = np.full(len(state), -1, np.int64)
    target = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = target[moving]
        state[moving] = state[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        target[moving] = ((shard[moving] + 1) * (2.0**31 / draw)).astype(np.int64)
        moving = moving[target[moving] < shards]
    return shard.astype(np.int32)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a key column of any type; a null key is a key like any other."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @pandas_udf("int")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(jump(batch.to_numpy(np.int64).view(np.uint64), shards))

    return place(F.xxhash64(key))


def sharded(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Place every row in a shard and in a slot of it: key, size, text_crc32, law, shard, slot, grown_shard.

    ``grown_shard`` is the shard once one more is appended: the same, or the new one. Texts stay where
    they are; only sizes and checksums are shuffled, spread over parts of each shard. A null text has
    no bytes, a null key is one more key, rows that repeat a key take a slot each, other columns are
    ignored, and an empty table gives an empty result.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    placed = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(content) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        jump_shard(F.col(key), shards).alias("shard"),
        jump_shard(F.col(key), shards + 1).alias("grown_shard"),
    )
    return with_rank(placed, ["shard"], ["_key"], "slot").select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
