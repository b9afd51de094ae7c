"""Terms as counts of buckets, in Arrow arrays."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa


def bucket_vectors(words: pa.ListArray, width: int) -> pa.StructArray:
    """For each array of terms how many fall into each of ``width`` buckets, as Spark's sparse vectors. A term's bucket is that of
    ``models.bucket``; it is worked out once a batch for each different term."""
    n, at = len(words), words.offsets.to_numpy()
    coded = words.values.slice(at[0], at[-1] - at[0]).cast(pa.binary()).dictionary_encode()
    of_term = [int.from_bytes(hashlib.md5(t, usedforsecurity=False).digest()[:4]) % width for t in coded.dictionary.to_pylist()]
    held = coded.indices.is_valid().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), np.diff(at))[held]
    cells = row * width + np.array(of_term, np.int64)[coded.indices.drop_null().to_numpy()]
    cells, counts = np.unique(cells, return_counts=True)
    starts = pa.array(np.searchsorted(cells, np.arange(n + 1) * width).astype(np.int32))
    indices = pa.ListArray.from_arrays(starts, pa.array((cells % width).astype(np.int32)))
    values = pa.ListArray.from_arrays(starts, pa.array(counts.astype(float)))
    parts = [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, width, np.int32)), indices, values]
    return pa.StructArray.from_arrays(parts, ["type", "size", "indices", "values"])
