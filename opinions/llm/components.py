"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinions.llm.common import written


def _checksum(links: DataFrame) -> tuple:
    """Number of links and a sum over their hashes, which no order of rows changes."""
    half = F.xxhash64("a", "b").bitwiseAND(F.lit(0xFFFFFFFF))
    return tuple(links.agg(F.count(F.lit(1)), F.sum(half)).first())


def _stars(rows: DataFrame) -> DataFrame:
    """Rows (u, v) with the least node that u sees, itself included, as m.

    The least nodes are written before they are joined, so that adaptive execution can split the rows of a
    node with very many links.
    """
    least = written(rows.groupBy("u").agg(F.least(F.min("u"), F.min("v")).alias("m")))
    return rows.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(a, root) for every node ``a`` of the links (a, b) that is not the least node of its component.

    Large stars and small stars in turn (Kiveris et al., 2014): every node links its neighbours to the
    least node it sees, until nothing changes; the rounds grow with the logarithm of the size. Links stay
    distributed and each round is written to the shared folder. A link of a node to itself is ignored.
    """
    clean = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(clean)
    seen = _checksum(now)
    while seen[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = written(_stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = _stars(large)
        small = (
            down.select(F.explode(F.array(F.col("u"), F.col("v"))).alias("a"), F.col("m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        now = written(small)
        before, seen = seen, _checksum(now)
        if before == seen:
            break
    return now.select("a", F.col("b").alias("root"))
