"""SimHash near-dedup: pigeonhole blocks bring close fingerprints together, the distance is verified."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import pandas_udf

from opinions.llm.common import tidy, written
from opinions.llm.components import components

SHINGLE = 3
SEED = 42
BITS = 64
#: Fingerprints link at this many differing bits or fewer.
DISTANCE = 3
#: Blocks with at most so many fingerprints are compared pair by pair inside a task.
SMALL = 1024
#: Expected partners by chance in a block; with more fingerprints, blocks get more bits.
CROWD = 0.25


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text: words between ASCII white space, A-Z lower-cased, shingles with repeats."""
    words = text.lower().split()  # of bytes: these are ASCII operations
    if not words:
        return 0
    parts = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64)
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65536):  # a bounded piece at a time
        bits = np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp) of whole texts; the 64 bits are held in a signed long. Null and empty texts have 0."""
    schema = T.StructType([T.StructField("id", docs.schema[key].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            made = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["id", "fp"])

    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, schema)


def blocks_for(n: int, distance: int = DISTANCE) -> int:
    """Number of blocks of bits: fewer make fewer tables, more make longer keys. Results don't depend on it."""
    blocks = distance + 1
    while blocks < 2 * distance + 4 and n > CROWD * 2 ** (BITS * (blocks - distance) / blocks):
        blocks += 1
    return blocks


def masks(blocks: int, distance: int = DISTANCE) -> list[int]:
    """Bits that a table compares: all but ``distance`` blocks. Close pairs agree on one mask at least."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    return [sum(c) for c in combinations(block, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def linked(members: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint that has a link to another, and the least one that links of this block reach."""
    close = np.bitwise_count(members[:, None] ^ members[None, :]) <= distance
    order = np.arange(len(members))
    label = order.copy()
    while True:
        nearest = np.where(close, label[None, :], len(members)).min(axis=1)
        nearest = nearest[nearest]
        if (nearest == label).all():
            break
        label = nearest
    other = label != order
    return members[other], members[label[other]]


LINKS = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


@pandas_udf(LINKS)
def _links(blocks: pd.Series) -> pd.Series:
    out = []
    for held in blocks:
        a, b = linked(np.sort(np.asarray(held, np.int64)).view(np.uint64))
        out.append([{"a": int(x), "b": int(y)} for x, y in zip(a.view(np.int64), b.view(np.int64))])
    return pd.Series(out)


def _flips(fp: Column, mask: int) -> Column:
    """(value, near) for the fingerprint with no, one (near) or two bits outside the mask flipped."""
    free = [_signed(1 << i) for i in range(BITS) if not mask >> i & 1]
    near = [0, *free]
    far = [_signed((x ^ y) % (1 << BITS)) for x, y in combinations(free, 2)]
    every = F.transform(
        F.array(*[F.lit(x).cast("long") for x in near]), lambda x: F.struct(fp.bitwiseXOR(x).alias("value"), F.lit(True).alias("near"))
    )
    rest = F.transform(
        F.array(*[F.lit(x).cast("long") for x in far]), lambda x: F.struct(fp.bitwiseXOR(x).alias("value"), F.lit(False).alias("near"))
    )
    return F.concat(every, rest)


def crowded_links(crowd: DataFrame, mask_of: list[int]) -> DataFrame:
    """Links (a, b) within blocks of any size, without comparing pairs; connected exactly as all links are.

    Two fingerprints differ in at most three bits if and only if some value is at most one flip from
    one of them and at most two from the other. Each fingerprint names its values; under a value, all that name it
    link to the least one that is near it. A value has few namers, as they all lie within two flips.
    """
    parts = []
    for t, mask in enumerate(mask_of):
        own = crowd.filter(F.col("t") == t).select("fp", F.explode(_flips(F.col("fp"), mask)).alias("f"))
        parts.append(own.select(F.lit(t).alias("t"), "fp", "f.value", "f.near"))
    named = parts[0]
    for p in parts[1:]:
        named = named.unionByName(p)
    hub = F.min(F.when(F.col("near"), F.col("fp")))
    # At most 1 + 48 + 48 * 47 / 2 namers of a value.
    held = named.groupBy("t", "value").agg(hub.alias("b"), F.collect_list("fp").alias("all")).filter(
        F.col("b").isNotNull() & (F.size("all") > 1)
    )
    return held.select(F.explode("all").alias("a"), "b").filter("a <> b")


def links(distinct: DataFrame, n: int, small: int = SMALL) -> DataFrame:
    """Links (a, b) between distinct fingerprints (``fp``) that connect exactly those within DISTANCE.

    One row per fingerprint and table is shuffled. Blocks of one are dropped by their count; those of up to
    ``small`` are compared in place and emit at most a link per member, larger ones go by ``crowded_links``.
    """
    mask_of = masks(blocks_for(n))
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("k")) for t, m in enumerate(mask_of)])
    members = distinct.select("fp", F.explode(keys).alias("x")).select("fp", "x.t", "x.k")
    sizes = written(members.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    held = members.join(sizes, ["t", "k"])
    few = held.filter(F.col("n") <= small).groupBy("t", "k").agg(F.collect_list("fp").alias("all"))
    near = few.select(F.explode(_links("all")).alias("l")).select("l.a", "l.b")
    if sizes.filter(F.col("n") > small).isEmpty():
        return near
    return near.unionByName(crowded_links(held.filter(F.col("n") > small), mask_of))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", small: int = SMALL) -> DataFrame:
    """Near-duplicate class of every document: key, fingerprint (hex), component_id.

    Equal fingerprints are one node, so copies cost nothing further. Nodes link at DISTANCE or fewer
    differing bits, and a class is everything links reach; its id is the smallest key in it.

    Null and empty texts have fingerprint zero and link like any other. Rows that repeat a key
    are returned each, with their own fingerprint. A null key is the smallest. Other columns are
    ignored; an empty table gives no rows.
    """
    own = written(fingerprints(docs, key, text))
    least = F.min(F.struct(F.col("id")))
    nodes = written(own.groupBy("fp").agg(least.alias("first")))
    root = components(links(nodes.select("fp"), nodes.count(), small))
    placed = nodes.join(root.withColumnRenamed("a", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    placed = written(placed)
    class_id = placed.groupBy("root").agg(F.min("first").alias("least"))
    named = written(placed.join(written(class_id), "root").select("fp", F.col("least.id").alias("component_id")))
    return own.join(named, "fp").select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
