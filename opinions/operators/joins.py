"""Joins against dimensions whose size is checked before it is relied on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``dim`` with a job that stops after ``max_rows`` rows."""
    strings = [F.coalesce(F.octet_length(n), F.lit(0)) for n, t in dim.dtypes if t == "string"]
    width = F.lit(16 * len(dim.columns))
    for s in strings:
        width = width + s
    rows, size = dim.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_join(facts: DataFrame, dim: DataFrame, on: Mapping[str, str], *, small: bool) -> DataFrame:
    """Left-join ``facts`` to a dimension that is unique on its key; the key columns of the
    dimension are dropped. ``on`` maps columns of the facts to columns of the dimension.

    A dimension that passed ``fits_broadcast`` is broadcast. A larger one is joined by shuffle: each of
    its rows moves once, and adaptive execution splits the facts of a key that fills a task far above
    the others (``spark.sql.adaptive.skewJoin``), reading the dimension's part for each split.
    """
    keys = {f"_key{i}": name for i, name in enumerate(on.values())}
    side = dim.withColumnsRenamed({name: k for k, name in keys.items()})
    match = [F.col(f) == F.col(k) for f, k in zip(on, keys)]
    return facts.join(F.broadcast(side) if small else side, match, "left").drop(*keys)
