"""Suffix-array dedup of repeated passages, over anchored suffixes in range-partitioned buckets.

A passage of LENGTH bytes that occurs twice has the same anchor in both places: the GRAM bytes in it with the
least hash. So it is enough to sort the suffixes at anchors, about one byte in 35, and of these only such
whose gram occurs again. All passages with one anchor form a strand of up to LENGTH - GRAM + 1 start positions.

1. Every document is cut into strands (numpy, inside the task that scans it). Strands that repeat within a batch
   are settled there; one row for each gram and batch is shuffled by the gram's hash, so a gram that
   a third of all documents hold costs its task a row for each batch only.
2. Grams seen once are dropped. Where all strands of a gram are alike, all but the first are repeats. The
   rest are sorted: splitters sampled by Spark range-partition them by the suffix at the anchor. Within a bucket Spark
   brings the strands into the order of their suffixes; run by run, their passages are sorted by multikey quicksort,
   and the first of equal passages stays.
3. A run's end may lie between strands that share a passage. Passages whose bytes from the anchor on begin
   the run's least or greatest suffix are compared once more, across runs and buckets.
4. The repeats of a document are joined to its text, and the bytes that they cover are removed.
"""

from __future__ import annotations

import hashlib
import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinions.llm.common import written

LENGTH = 100
GRAM = 32
#: Passages that one anchor can serve.
REACH = LENGTH - GRAM + 1
#: Bytes of a document that are hashed at a time.
PIECE = 1 << 20
#: Strands whose passages are sorted together, about.
RUN = 30_000
#: Strands of a bucket, about: some 130 MB that Spark sorts, with spilling, and hands on in runs.
BUCKET = 1_000_000
#: How far a sort has compared, in steps of eight bytes; the last step overlaps the one before.
STEPS = (*range(0, LENGTH - 7, 8), LENGTH - 8)

#: Kinds of strands: to be looked up by gram, to be sorted, and repeated as a whole.
LOOKUP, SORT, REPEAT = 0, 1, 2


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every position, by doubling: the hash of 2n bytes from those of n and n."""
    h = data.astype(np.uint64) + np.uint64(1)
    width = 1
    while width < GRAM:
        left, right = h[:-width], h[width:]
        h = ((left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + (left >> np.uint64(29)) + np.uint64(width))) * np.uint64(
            0xD6E8FEB86659FD93
        )
        width *= 2
    return h ^ (h >> np.uint64(32))


def strands(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, n, anchor, gram hash): the n passages from ``start`` on have their least gram at ``anchor``."""
    found = []
    for base in range(0, len(data) - LENGTH + 1, PIECE):
        h = gram_hashes(data[base : base + PIECE + LENGTH - 1])
        low = np.uint64((1 << 24) - 1)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # ties go to the leftmost gram
        width = 1
        while 2 * width <= REACH:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < REACH:
            least = np.minimum(least[: width - REACH], least[REACH - width :])
        anchor = (least & low).astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        n = np.diff(np.append(start, len(anchor)))
        found.append((start + base, n, anchor[start] + base, h[anchor[start]]))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _order(keys: list) -> np.ndarray:
    """Rank of each key, the same for equal keys; null first, structs by their fields."""

    def sortable(k):
        return tuple(map(sortable, k.values())) if isinstance(k, dict) else (k is not None, k)

    keys = [sortable(k) for k in keys]
    rank = {k: i for i, k in enumerate(sorted(set(keys)))}
    return np.fromiter((rank[k] for k in keys), np.int64, len(keys))


def _place(start: np.ndarray, n: np.ndarray, into: np.ndarray, several: np.ndarray) -> np.ndarray:
    """Start, number of passages, place of the anchor and a flag in one number, ordered by start."""
    return start << 16 | n << 8 | into << 1 | several


#: What ``_place`` packs, in SQL.
START, COUNT = "shiftright(at, 16)", "(shiftright(at, 8) & 255)"


def _bytes_at(held: list[bytes], row: np.ndarray, start: np.ndarray, n: np.ndarray, i: int) -> bytes:
    return held[row[i]][start[i] : start[i] + n[i] + LENGTH - 1]


def _strand_rows(rows: DataFrame) -> DataFrame:
    """(h, c, id, at, kind) for all strands; c hashes a strand's bytes. Only strands to be looked up have h and c.

    A kind depends on what else is in a batch, so the kinds belong together only if they come from one run.
    """
    names = ["h", "c", "id", "at", "kind"]
    types = [T.LongType(), T.LongType(), rows.schema["id"].dataType, T.LongType(), T.IntegerType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            rank = _order(ids.to_pylist())
            parts, held = [], texts.to_pylist()
            for row, text in enumerate(held):
                if len(text) < LENGTH:
                    continue
                start, n, anchor, h = strands(np.frombuffer(text, np.uint8))
                ends = (start + n + LENGTH - 1).tolist()
                c = np.fromiter(
                    (xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(start.tolist(), ends)), np.uint64, len(start)
                )
                parts.append((h, c, np.full(len(h), row), start, n, anchor - start))
            if not parts:
                continue
            h, c, row, start, n, into = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((start, rank[row], c, h))
            h, c, row, start, n, into = (x[order] for x in (h, c, row, start, n, into))
            gram = np.concatenate(([True], h[1:] != h[:-1]))
            fresh = gram | np.concatenate(([True], c[1:] != c[:-1]))
            for i in np.flatnonzero(~fresh).tolist():
                fresh[i] = _bytes_at(held, row, start, n, i) != _bytes_at(held, row, start, n, i - 1)
            group = np.cumsum(gram) - 1
            several = (np.bincount(group, weights=fresh) > 1)[group]
            kind = np.where(gram, LOOKUP, np.where(fresh, SORT, REPEAT))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64), mask=~gram),
                    pa.array(c.view(np.int64), mask=~gram),
                    ids.take(pa.array(row)),
                    pa.array(_place(start, n, into, several.astype(np.int64))),
                    pa.array(kind.astype(np.int32)),
                ],
                names=names,
            )

    return rows.select("id", "text").mapInArrow(run, schema)


def _settled(lookups: DataFrame) -> DataFrame:
    """(id, at, kind) of strands whose gram occurs in several batches, or with several contents in one."""
    own = F.struct("id", "at")
    same = Window.partitionBy("h")
    seen = lookups.select(
        "id",
        "at",
        F.count(F.lit(1)).over(same).alias("n"),
        ((F.min("c").over(same) != F.max("c").over(same)) | (F.max(F.col("at").bitwiseAND(1)).over(same) == 1)).alias(
            "several"
        ),
        (own > F.min(own).over(same)).alias("later"),
    )
    kind = F.when(F.col("several"), SORT).when((F.col("n") > 1) & F.col("later"), REPEAT)
    return seen.select("id", "at", kind.alias("kind")).filter("kind IS NOT NULL")


def _packed_texts(rows: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle."""
    schema = T.StructType([rows.schema["id"], T.StructField("packed", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [press.compress(t.as_py()) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "packed"])

    return rows.select("id", "text").mapInArrow(run, schema)


def _with_bytes(texts: DataFrame, strand: DataFrame) -> DataFrame:
    """(id, start, into, s): the bytes of strands, read from their documents."""
    per_doc = strand.groupBy("id").agg(F.collect_list("at").alias("ats"))
    schema = T.StructType(
        [
            texts.schema["id"],
            T.StructField("start", T.LongType()),
            T.StructField("into", T.IntegerType()),
            T.StructField("s", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, starts, into, held = [], [], [], []
            for row, (packed, ats) in enumerate(zip(batch.column(1), batch.column(2))):
                text = press.decompress(packed.as_py())
                for at in ats.as_py():
                    start = at >> 16
                    rows.append(row)
                    starts.append(start)
                    into.append((at & 255) >> 1)
                    held.append(text[start : start + (at >> 8 & 255) + LENGTH - 1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(into, pa.int32()),
                    pa.array(held, pa.binary()),
                ],
                names=["id", "start", "into", "s"],
            )

    return texts.join(per_doc, "id").select("id", "packed", "ats").mapInArrow(run, schema)


def multikey_sorted(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passages (indices into ``at``) that equal another one, equal ones together, and their group.

    Multikey quicksort, breadth first: eight bytes are one character; each round sorts the groups that are
    still equal by their next character and goes on with those of more than one member. Equal passages
    keep the order of ``at``. ``data`` has eight bytes more than the passages need.
    """
    words = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    left, group = np.arange(len(at)), np.zeros(len(at), np.int64)
    for step in STEPS:
        char = words[at[left] + step].astype(np.uint64)
        order = np.lexsort((char, group))
        left, group, char = left[order], group[order], char[order]
        first = np.concatenate(([True], (group[1:] != group[:-1]) | (char[1:] != char[:-1])))[: len(left)]
        group = np.cumsum(first) - 1
        tied = (np.bincount(group) > 1)[group] if len(left) else first
        left, group = left[tied], group[tied]
    return left, group


def run_repeats(held: list[bytes], start: np.ndarray, into: np.ndarray):
    """Repeats in a run whose strands are in order: (row, from, to) of all but the first of equal passages,
    and (row, from, passage) of first ones that other runs may hold too."""
    n = np.array([len(s) - LENGTH + 1 for s in held])
    data = np.frombuffer(b"".join(held) + bytes(8), np.uint8)
    base = np.cumsum([0] + [len(s) for s in held[:-1]])
    row = np.repeat(np.arange(len(held)), n)
    shift = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    left, group = multikey_sorted(data, base[row] + shift)
    later = np.concatenate(([False], group[1:] == group[:-1]))[: len(left)]
    repeated = np.zeros(len(row), bool)
    repeated[left[later]] = True
    hit = np.flatnonzero(repeated)
    new = np.concatenate(([True], (np.diff(hit) != 1) | (row[hit[1:]] != row[hit[:-1]])))[: len(hit)]
    end = np.append(np.flatnonzero(new)[1:], len(hit)) - 1 if len(hit) else np.zeros(0, np.int64)
    ranges = (row[hit[new]], start[row[hit[new]]] + shift[hit[new]], start[row[hit[end]]] + shift[hit[end]] + LENGTH)
    suffix = [s[i:] for s, i in zip(held, into.tolist())]
    ends = min(suffix), max(suffix)
    heads = {e[:GRAM] for e in ends}
    first_passage = np.cumsum(n) - n
    edges = []
    for i, s in enumerate(suffix):
        if s[:GRAM] in heads:
            shared = max(len(os.path.commonprefix([s, e])) for e in ends)
            for w in range(min(int(n[i]), shared - LENGTH + int(into[i]) + 1)):
                if not repeated[first_passage[i] + w]:
                    edges.append((i, int(start[i]) + w, held[i][w : w + LENGTH]))
    return ranges, edges


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of all batches in tables of ``size`` rows, the last one shorter."""
    waiting, rows = [], 0
    for batch in batches:
        while rows + batch.num_rows >= size:
            yield pa.Table.from_batches([*waiting, batch.slice(0, size - rows)])
            batch, waiting, rows = batch.slice(size - rows), [], 0
        if batch.num_rows:
            waiting.append(batch)
            rows += batch.num_rows
    if waiting:
        yield pa.Table.from_batches(waiting)


def _sorted_buckets(strand: DataFrame, buckets: int, run_size: int) -> DataFrame:
    """(id, start, stop, edge): ranges of repeats, and passages at a run's ends as ``edge``."""
    schema = T.StructType(
        [
            strand.schema["id"],
            T.StructField("start", T.LongType()),
            T.StructField("stop", T.LongType()),
            T.StructField("edge", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, run_size):
            rank = _order(table.column("id").to_pylist())
            table = table.take(pa.array(np.lexsort((table.column("start").to_numpy(), rank))))
            ids = table.column("id").combine_chunks()
            start = table.column("start").to_numpy()
            (row, lo, hi), edges = run_repeats(table.column("s").to_pylist(), start, table.column("into").to_numpy())
            rows = np.concatenate((row, np.array([e[0] for e in edges], np.int64))).astype(np.int64)
            starts = np.concatenate((lo, np.array([e[1] for e in edges], np.int64))).astype(np.int64)
            stops = np.concatenate((hi, np.array([e[1] + LENGTH for e in edges], np.int64))).astype(np.int64)
            passages = pa.array([None] * len(row) + [e[2] for e in edges], pa.binary())
            made = pa.Table.from_arrays(
                [ids.take(pa.array(rows)), pa.array(starts), pa.array(stops), passages],
                names=["id", "start", "stop", "edge"],
            )
            yield from made.to_batches(max_chunksize=10_000)

    # Spark keeps a sample of these keys on the driver, so they are no longer than needed.
    keyed = strand.withColumns({"suffix": F.expr(f"substring(s, into + 1, {LENGTH})"), "other": F.xxhash64("s")})
    dealt = keyed.repartitionByRange(buckets, "suffix", "other").sortWithinPartitions("suffix", "other", "id", "start")
    return dealt.select("id", "start", "into", "s").mapInArrow(run, schema)


def _cut(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """Remove the ranges of every document: id, n_bytes, n_removed, spans, kept."""
    per_doc = ranges.groupBy("id").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("ranges"))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    schema = T.StructType(
        [
            texts.schema["id"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("kept", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out = {name: [] for name in schema.names[1:]}
            for packed, ranges in zip(batch.column(1), batch.column(2)):
                text = press.decompress(packed.as_py())
                spans: list[dict] = []
                for r in ranges.as_py() or []:
                    if spans and r["start"] <= spans[-1]["stop"]:
                        spans[-1]["stop"] = max(spans[-1]["stop"], r["stop"])
                    else:
                        spans.append(dict(r))
                at = [0, *(x for s in spans for x in (s["start"], s["stop"])), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(at[::2], at[1::2]))
                for name, x in zip(out, (len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept)):
                    out[name].append(x)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.string()]
            kinds.append(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, k) for v, k in zip(out.values(), kinds))], names=schema.names
            )

    joined = texts.join(per_doc.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
    return joined.select("id", "packed", "ranges").mapInArrow(run, schema)


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", bucket: int = BUCKET, run: int = RUN
) -> DataFrame:
    """Remove every byte covered by LENGTH bytes that also start earlier in the corpus.

    Earlier means in a document with a smaller key, or before in the same document. Passages are judged on
    the input. Returns key, n_bytes, n_removed, spans (maximal removed runs of bytes), kept_sha256 and kept.

    A null text counts as empty; texts under LENGTH bytes have no passage and stay whole. A null key comes
    first. Rows that repeat a key with another text are documents of their own, in the order of a
    hash of their texts; rows that repeat key and text are one document, reported once for each row. Other
    columns are ignored; an empty table gives no rows. Strands of a batch are repeats only if their bytes are equal; across
    batches they count as equal by 128 bits: the hash of their gram and that of all their bytes.
    """
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    odd = not rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR id IS NULL").isEmpty()
    if odd:
        every = rows.select(F.struct("id", F.xxhash64("text").alias("t")).alias("id"), "text")
        result = _removed(every.dropDuplicates(["id"]), bucket, run).withColumnRenamed("id", "_id")
        result = every.select("id").join(result, F.col("id") == F.col("_id")).drop("_id")
        result = result.withColumn("id", F.col("id.id"))
    else:
        result = _removed(rows, bucket, run)
    return result.withColumnRenamed("id", key)


def _removed(rows: DataFrame, bucket: int, run: int) -> DataFrame:
    texts = _packed_texts(rows)
    cut = written(_strand_rows(rows))
    settled = written(_settled(cut.filter(F.col("kind") == LOOKUP).drop("kind")))
    inside = cut.filter(F.col("kind") != LOOKUP).select("id", "at", "kind")
    strand = settled.unionByName(inside)
    to_sort = strand.filter(F.col("kind") == SORT)
    own = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(own, math.ceil(to_sort.count() / bucket))
    marks = written(_sorted_buckets(_with_bytes(texts, to_sort), buckets, run))
    edges = marks.filter("edge IS NOT NULL")
    first = edges.groupBy("edge").agg(F.min(F.struct("id", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    shared = written(first.filter("n > 1").drop("n"))
    again = edges.join(shared, "edge").filter(F.struct("id", "start") > F.col("first"))
    whole = strand.filter(F.col("kind") == REPEAT).select("id", F.expr(START).alias("start"), F.expr(COUNT).alias("n"))
    whole = whole.select("id", "start", (F.col("start") + F.col("n") + (LENGTH - 1)).alias("stop"))
    ranges = whole.unionByName(marks.filter("edge IS NULL").drop("edge")).unionByName(again.select("id", "start", "stop"))
    return _cut(texts, ranges)
