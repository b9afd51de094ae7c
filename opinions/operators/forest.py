"""Growing Spark ML's random forest on sparse counts.

Spark's own trainer keeps four bytes for every feature of every training text. The trainer here keeps a text's terms only, and
grows the same trees: the same thresholds, bootstrap weights, features of a node and order of nodes, so the model is the
one that ``RandomForestClassifier`` fits to the same rows (tested tree by tree). A scan per group of nodes sums the weights of classes by
node, feature and bin where a text has the feature; what the texts without it weigh is the difference to the node's own sums.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise
from typing import TYPE_CHECKING, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinions.operators.durable import durable, shared_folder
from opinions.operators.shipping import shipped

if TYPE_CHECKING:  # Python workers read this module, too, and need not load Spark ML
    from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier

#: Rows that Spark draws at least to find thresholds.
SAMPLE = 10_000
EPSILON = float(np.finfo(float).eps)
#: Cells of a worker's tables of bins and weights, and candidates that it compares at once.
CELLS, CANDIDATES = 1 << 23, 1 << 16
#: Tasks of a scan at most, or four a core: each adds up its counts before they are shuffled.
SCAN_TASKS = 64

TEXTS = "label int, idx binary, bins binary, bag binary"
SUMS = "node int, total binary, at binary, n binary"
BEST = "node int, place int, cut int, gain double, left array<long>, right array<long>"


class Random:
    """``java.util.Random``."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & (1 << 48) - 1
        return (self.state >> 16) - ((self.state >> 47) << 32)

    def long(self) -> int:
        return (((self._next() << 32) + self._next()) + (1 << 63)) % (1 << 64) - (1 << 63)


def _murmur(words: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """Scala's hash of eight bytes, given as two words of four (low byte first)."""
    mask = np.uint64(0xFFFFFFFF)

    def turned(x, by):
        return ((x << np.uint64(by)) | (x >> np.uint64(32 - by))) & mask

    h = np.zeros(len(words), np.uint64) + np.asarray(seed, np.uint64)
    for word in words.T:
        h ^= turned(word * np.uint64(0xCC9E2D51) & mask, 15) * np.uint64(0x1B873593) & mask
        h = (turned(h, 13) * np.uint64(5) + np.uint64(0xE6546B64)) & mask
    h ^= np.uint64(8)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor) & mask
    return h ^ (h >> np.uint64(16))


def _xorshift_state(seeds: Sequence[int]) -> np.ndarray:
    """What Spark's ``XORShiftRandom`` starts from."""
    words = np.array(seeds, np.int64).astype(">i8").view("<u4").reshape(-1, 2).astype(np.uint64)
    low = _murmur(words, 0x3C074A61)
    return (_murmur(words, low) << np.uint64(32)) | low


def _step(state: np.ndarray, spare: np.ndarray) -> None:
    for shift, by in ((np.left_shift, 21), (np.right_shift, 35), (np.left_shift, 4)):
        shift(state, np.uint64(by), out=spare)
        np.bitwise_xor(state, spare, out=state)


def sample_seed(seed: int) -> int:
    """``new XORShiftRandom(seed).nextInt()``."""
    state = _xorshift_state([seed])
    _step(state, state.copy())
    return int(state[0].astype(np.uint32).astype(np.int32))


def _moved(states: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The states times a matrix of bits, of which ``columns`` has a number a column."""
    out = np.zeros_like(states)
    for bit, column in enumerate(columns):
        out ^= column * ((states >> np.uint64(bit)) & np.uint64(1))
    return out


def _steps(n: int) -> np.ndarray:
    """The columns of n steps of the generator, each of which is a matrix."""
    unit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    out, power = unit.copy(), unit.copy()
    _step(power, unit)
    while n:
        out = _moved(out, power) if n & 1 else out
        power = _moved(power, power)
        n >>= 1
    return out


def reservoirs(seeds: Sequence[int], n: int, k: int, wide: int = 1 << 15) -> np.ndarray:
    """For each seed the k of range(n) that ``SamplingUtils.reservoirSampleAndCount`` draws, in its order.

    The items after the first k are cut into lanes, whose generators go ahead together. Two steps an item give the 53 bits of a number
    below 1, which the item's position from 1 on turns into a place; its upper 26 bits tell of most items that it is none of the k.
    """
    held = np.tile(np.arange(k, dtype=np.int32), (len(seeds), 1))
    lanes = max(1, min(128, wide // len(seeds)))
    each = -(-(n - k) // lanes)
    states = [_xorshift_state(seeds)]
    columns = _steps(2 * each)
    for _ in range(lanes - 1):
        states.append(_moved(states[-1], columns))
    state = np.array(states)
    spare, upper, below = np.empty_like(state), np.empty_like(state), np.empty(state.shape, bool)
    first = k + each * np.arange(lanes)
    found = []
    for i in range(each):
        _step(state, spare)
        np.bitwise_and(state, np.uint64((1 << 26) - 1), out=upper)
        limit = np.ceil(k / (first + i + 1) * (1 << 26)).astype(np.uint64)[:, None]
        np.less_equal(upper, limit, out=below)
        at = np.flatnonzero(below.ravel())
        high = upper.ravel()[at]
        _step(state, spare)
        drawn = (high << np.uint64(27)) + (state.ravel()[at] & np.uint64((1 << 27) - 1))
        lane, row = np.divmod(at, len(seeds))
        item = first[lane] + i
        place = (drawn.astype(float) * 2.0**-53 * (item + 1)).astype(np.int64)
        kept = (place < k) & (item < n)
        found.append((item[kept], row[kept], place[kept]))
    if found:
        item, row, place = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(item, kind="stable")  # where a place comes twice, the later item stays
        held[row[order], place[order]] = item[order]
    return held


def scala_order(keys: Iterable[int]) -> list[int]:
    """The order in which a Scala map of these small numbers, made from a mutable one, gives them."""
    keys = sorted(keys)
    if len(keys) <= 4:
        return sorted(keys, key=lambda k: (k & 15, k))
    mask = (1 << 32) - 1

    def improved(k):
        h = (k + ~(k << 9)) & mask
        h ^= h >> 14
        h = (h + (h << 4)) & mask
        return h ^ (h >> 10)

    def walked(some, shift):
        slots: dict[int, list] = {}
        for k in some:
            slots.setdefault(improved(k) >> shift & 31, []).append(k)
        alone = [slots[s][0] for s in sorted(slots) if len(slots[s]) == 1]
        return alone + [k for s in sorted(slots) if len(slots[s]) > 1 for k in walked(slots[s], shift + 5)]

    return walked(keys, 0)


# --- Thresholds --------------------------------------------------------------------------------------


def _vectors(column: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """starts, indices and values of the vectors in an Arrow column."""
    if column.field("type").to_numpy(zero_copy_only=False).any():  # dense ones have no indices
        rows = [(r["indices"] if r["indices"] is not None else range(len(r["values"])), r["values"]) for r in column.to_pylist()]
        starts = np.cumsum([0, *[len(v) for _, v in rows]])
        return starts, np.array([i for x, _ in rows for i in x], np.int32), np.array([v for _, x in rows for v in x], float)
    at = column.field("indices").offsets.to_numpy()
    held = [column.field(k).values.to_numpy(zero_copy_only=False)[at[0] : at[-1]] for k in ("indices", "values")]
    return at - at[0], *held


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """f, v, n: how often a batch's vectors have a value other than zero of a feature."""
    for batch in batches:
        _, f, v = _vectors(batch.column(0))
        order = np.lexsort((v, f))
        order = order[v[order] != 0]
        f, v = f[order].astype(np.int32), v[order]
        first = np.flatnonzero(np.concatenate([[True], (f[1:] != f[:-1]) | (v[1:] != v[:-1])])[: len(f)])
        n = np.diff(np.append(first, len(f)))
        yield pa.RecordBatch.from_arrays([pa.array(f[first]), pa.array(v[first]), pa.array(n, pa.int64())], ["f", "v", "n"])


def _cuts(values: np.ndarray, n: np.ndarray, rows: float, splits: int) -> list[float]:
    """The thresholds of one feature, from its values other than zero in the sample and how often they occur."""
    counts = list(zip(values.tolist(), n.tolist()))
    if rows - n.sum() > EPSILON * n.sum() * 100:
        counts = sorted([*counts, (0.0, rows - float(n.sum()))])
    middle = [(a + b) / 2.0 for (a, _), (b, _) in pairwise(counts)]
    if len(middle) <= splits:
        return middle
    stride = rows / (splits + 1)
    out, current, target = [], counts[0][1], stride
    for i in range(1, len(counts)):
        before, current = current, current + counts[i][1]
        if abs(before - target) < abs(current - target):
            out.append(middle[i - 1])
            target += stride
    return out


def thresholds(train: DataFrame, width: int, rows: int, most: int, seed: int) -> np.ndarray:
    """A row a feature: its thresholds, then infinities. They come from a sample of some 10,000 rows, as
    Spark's do, and part a feature's values into ``most`` bins at most."""
    spark = train.sparkSession
    features = train.select(F.unwrap_udt("features").alias("features"))
    bins = min(most, rows)
    share = min(1.0, max(bins * bins, SAMPLE) / rows)
    if share < 1:
        # The JVM's sample of the rows: it is the one that Spark's forest draws.
        drawn = features._jdf.toJavaRDD().sample(False, share, sample_seed(seed))
        features = DataFrame(spark._jsparkSession.createDataFrame(drawn, features._jdf.schema()), spark)
    counts = features.mapInArrow(_counted, "f int, v double, n long").groupBy("f", "v").agg(F.sum("n").alias("n")).toArrow()
    f, v, n = (counts.column(c).to_numpy() for c in ("f", "v", "n"))
    order = np.lexsort((v, f))
    f, v, n = f[order], v[order], n[order]
    at = np.searchsorted(f, np.arange(width + 1))
    cuts = [_cuts(v[a:b], n[a:b], share * rows, bins - 1) if b > a else [] for a, b in pairwise(at.tolist())]
    out = np.full((width, max(1, *map(len, cuts))), np.inf)
    for i, c in enumerate(cuts):
        out[i, : len(c)] = c
    if out.min() < 0:
        raise ValueError("features are counts: none is below zero")
    return out


# --- Training texts: their bins above the first, and how often each tree draws them --------------------


def _binned(batches: Iterator[pa.RecordBatch], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A text as bytes: its label, then features, then their bins."""
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int32)
        starts, idx, values = _vectors(batch.column(1))
        bins = np.zeros(len(idx), np.uint8)
        for c in range(cuts.shape[1]):
            bins += cuts[idx, c] < values
        kept = bins > 0
        starts = np.concatenate([[0], np.cumsum(kept)])[starts]
        idx, bins = idx[kept].astype(np.int32), bins[kept]
        rows = [labels[i : i + 1].tobytes() + idx[a:b].tobytes() + bins[a:b].tobytes() for i, (a, b) in enumerate(pairwise(starts.tolist()))]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["row"])


#: Before an array of bytes and one of numbers in Java's serialization, and the length of either's description after its name.
_BYTES, _INTS, _REST = b"\x00\x02[B", b"\x00\x02[I", 13


def _drawn(batches: Iterator[pa.RecordBatch], trees: int) -> Iterator[pa.RecordBatch]:
    """TEXTS from Spark's bagged points, which come in Java's serialization: the text's bytes, then its weight in each tree."""
    for batch in batches:
        found = []
        for value in batch.column(0):
            raw = memoryview(value.as_buffer())
            begin = bytes(raw[:400]).index(_BYTES) + len(_BYTES) + _REST + 4
            end = begin + int.from_bytes(raw[begin - 4 : begin])
            at = end + 2 + len(_INTS) + _REST + 4
            assert bytes(raw[end + 2 : end + 2 + len(_INTS)]) == _INTS and int.from_bytes(raw[at - 4 : at]) == trees
            n = (end - begin - 4) // 5
            label = int.from_bytes(raw[begin : begin + 4], "little")
            bag = np.frombuffer(raw[at : at + 4 * trees], ">i4").astype(np.uint8).tobytes()
            found.append((label, bytes(raw[begin + 4 : begin + 4 + 4 * n]), bytes(raw[begin + 4 + 4 * n : end]), bag))
        columns = list(zip(*found)) or [[]] * 4
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["label", "idx", "bins", "bag"])


def bagged_texts(train: DataFrame, label: str, cuts: np.ndarray, trees: int, seed: int) -> DataFrame:
    """TEXTS, a row a training text, written once. A text takes five bytes for each of its terms that has a bin above the first,
    and one for each tree."""
    spark = train.sparkSession
    jvm = spark._jvm
    shared = spark.sparkContext.broadcast(cuts)
    narrow = train.select(F.col(label).cast("int"), F.unwrap_udt("features").alias("features"))
    rows = narrow.mapInArrow(lambda batches: _binned(batches, shared.value), "row binary")
    # Spark's own draws, which depend on a row's place: its partition and the rows before it there.
    impl, encoders = jvm.org.apache.spark.ml.tree.impl.BaggedPoint, jvm.org.apache.spark.sql.Encoders
    one = getattr(impl, "convertToBaggedRDD$default$5")()
    points = impl.convertToBaggedRDD(getattr(rows._jdf, "as")(encoders.BINARY()).rdd(), 1.0, trees, True, one, seed)
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    kind = jvm.java.lang.Class.forName("org.apache.spark.ml.tree.impl.BaggedPoint", True, loader)
    bagged = DataFrame(spark._jsparkSession.createDataset(points, encoders.javaSerialization(kind)).toDF(), spark)
    return durable(bagged.mapInArrow(lambda batches: _drawn(batches, trees), TEXTS))


# --- A scan: sums of a group's nodes ---------------------------------------------------------------------


class Group(NamedTuple):
    """What a scan needs. Nodes of all trees have numbers; those that it sums have places, too."""

    trees: int
    classes: int
    feature: np.ndarray  # of a node, -1 if it isn't split
    cut: np.ndarray  # a text with a higher bin goes right
    left: np.ndarray  # the right child is the next number
    place: np.ndarray  # of a node, -1 if it isn't summed
    tree: np.ndarray  # of a place
    subset: np.ndarray  # of a place: its features
    splits: np.ndarray  # of a feature: how many thresholds it has

    def layout(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the sums of a place's feature begin, and those of a place. A feature has a row of classes for each bin but the first."""
        sizes = self.splits[self.subset] * self.classes
        ends = np.cumsum(sizes.ravel())
        return ends.reshape(sizes.shape) - sizes, np.concatenate([[0], ends.reshape(sizes.shape)[:, -1]])


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """starts and content of a binary column."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    size = np.dtype(kind).itemsize
    return ((at - at[0]) // size).astype(np.int64), np.frombuffer(whole.tobytes(), kind)


def _summed(batches: Iterator[pa.RecordBatch], g: Group) -> Iterator[pa.RecordBatch]:
    """SUMS of a task's texts; at and n are the sums above zero of a node, by place in its own part of the layout."""
    begins, node_at = g.layout()
    count, width = len(g.tree), len(g.splits)
    order = np.argsort(g.subset.ravel(), kind="stable")
    asked = np.searchsorted(g.subset.ravel()[order], np.arange(width + 1))  # by feature: the places that ask for it
    places, begin_of = order // g.subset.shape[1], begins.ravel()[order]
    sums, totals = np.zeros(node_at[-1], np.int64), np.zeros(count * g.classes, np.int64)
    step = max(1, min(CELLS // width, CELLS // count))
    dense, weight = np.zeros(step * width, np.uint8), np.zeros(step * count, np.uint8)  # by text, of each feature and of each place
    for batch in batches:
        labels = batch.column(0).to_numpy()
        starts, idx = _flat(batch.column(1), np.int32)
        bins = _flat(batch.column(2), np.uint8)[1]
        bags = _flat(batch.column(3), np.uint8)[1].reshape(-1, g.trees)
        for a in range(0, len(labels), step):
            texts = np.arange(len(labels[a : a + step]))
            label, bag = labels[a : a + step].astype(np.int64), bags[a : a + step].ravel()
            terms = slice(starts[a], starts[a + len(texts)])
            f, up, doc = idx[terms].astype(np.int64), bins[terms], np.repeat(texts, np.diff(starts[a : a + len(texts) + 1]))
            cells = doc * width + f
            dense[cells] = up
            drawn = np.flatnonzero(bag)
            who, node = drawn // g.trees, drawn % g.trees
            while len(on := np.flatnonzero((asks := g.feature[node]) >= 0)):
                at = node[on]
                node[on] = g.left[at] + (dense[who[on] * width + asks[on]] > g.cut[at])
            dense[cells] = 0
            here = g.place[node]
            on = np.flatnonzero(here >= 0)
            here, who, drawn = here[on], who[on], bag[drawn[on]]
            totals += np.bincount(here * g.classes + label[who], drawn, len(totals)).astype(np.int64)
            held = who * count + here
            weight[held] = drawn
            n = asked[f + 1] - asked[f]
            ends = np.cumsum(n)
            lo = 0
            while lo < len(f):  # as many terms as have about CANDIDATES places that ask for them
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CANDIDATES, side="right")))
                some, upto = n[lo:hi], ends[lo:hi] - ends[lo] + n[lo]
                near = np.arange(upto[-1]) + np.repeat(asked[f[lo:hi]] - upto + some, some)
                w = weight[np.repeat(doc[lo:hi] * count, some) + places[near]]
                hit = np.flatnonzero(w)
                term = lo + np.searchsorted(upto, hit, side="right")
                at = begin_of[near[hit]] + (up[term].astype(np.int64) - 1) * g.classes + label[doc[term]]
                np.add.at(sums, at, w[hit].astype(np.int64))
                lo = hi
            weight[held] = 0
    totals = totals.reshape(count, g.classes)
    rows = []
    for p in np.flatnonzero(totals.any(axis=1)).tolist():
        part = sums[node_at[p] : node_at[p + 1]]
        at = np.flatnonzero(part)
        rows.append((p, totals[p].tobytes(), at.astype(np.int32).tobytes(), part[at].tobytes()))
        if len(rows) == 500:
            yield _sum_rows(rows)
            rows = []
    yield _sum_rows(rows)


def _sum_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["node", "total", "at", "n"])


def gini(counts: np.ndarray) -> np.ndarray:
    """Of rows of class counts; 0 for none. Class by class, so that every bit is as Spark's."""
    whole = counts.sum(axis=-1)
    out = np.ones(whole.shape)
    for c in range(counts.shape[-1]):
        share = counts[..., c] / np.maximum(whole, 1)
        out -= share * share
    return np.where(whole > 0, out, 0.0)


def best_split(total: np.ndarray, sums: np.ndarray, splits: np.ndarray) -> tuple[int, int, float, np.ndarray, np.ndarray] | None:
    """place of the feature, threshold, gain and class counts on either side of the first best split; None without a valid one.

    ``sums`` has a row of classes for each bin but the first of each feature, ``splits`` the number of these rows by feature.
    """
    if not len(sums):
        return None
    ends = np.cumsum(splits)
    upto = np.concatenate([np.zeros((1, sums.shape[1]), np.int64), np.cumsum(sums, axis=0)])
    right = np.repeat(upto[ends], splits, axis=0) - upto[:-1]
    left = total - right
    l, r = left.sum(axis=1), right.sum(axis=1)
    whole = float(total.sum())
    gains = gini(total) - l / whole * gini(left) - r / whole * gini(right)
    gains[(l < 1) | (r < 1) | (gains < 0)] = -np.inf
    i = int(np.argmax(gains))
    if gains[i] == -np.inf:
        return None
    place = int(np.searchsorted(ends, i, side="right"))
    return place, i - int(ends[place] - splits[place]), float(gains[i]), left[i], right[i]


def best_splits(texts: DataFrame, group: Group) -> dict[int, dict]:
    """BEST by place, for nodes of the group that have texts. A place, a cut and a gain are null where no split is valid;
    left then holds the node's counts."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast(group)
    tasks = max(SCAN_TASKS, 4 * context.defaultParallelism)

    def best(table: pa.Table) -> pa.Table:
        g = shared.value
        p = table.column("node")[0].as_py()
        splits = g.splits[g.subset[p]]
        sums, total = np.zeros(int(splits.sum()) * g.classes, np.int64), np.zeros(g.classes, np.int64)
        for t, at, n in zip(*(table.column(c).to_pylist() for c in ("total", "at", "n"))):
            total += np.frombuffer(t, np.int64)
            sums[np.frombuffer(at, np.int32)] += np.frombuffer(n, np.int64)
        found = best_split(total, sums.reshape(-1, g.classes), splits) or (None, None, None, total, np.zeros_like(total))
        place, cut, gain, left, right = found
        row = {"node": p, "place": place, "cut": cut, "gain": gain, "left": left.tolist(), "right": right.tolist()}
        return pa.Table.from_pylist([row], schema=_BEST)

    sums = texts.coalesce(tasks).mapInArrow(lambda batches: _summed(batches, shared.value), SUMS)
    rows = sums.groupBy("node").applyInArrow(best, BEST).collect()
    shared.destroy()
    return {r["node"]: r.asDict() for r in rows}


_BEST = pa.schema(
    [("node", pa.int32()), ("place", pa.int32()), ("cut", pa.int32()), ("gain", pa.float64())]
    + [(side, pa.list_(pa.int64())) for side in ("left", "right")]
)


# --- The forest ------------------------------------------------------------------------------------------


class Node:
    def __init__(self, number: int, tree: int, level: int, counts: np.ndarray | None, leaf: bool = False):
        self.number, self.tree, self.level, self.counts, self.leaf = number, tree, level, counts, leaf
        self.valid, self.gain, self.feature, self.threshold, self.children = True, None, None, None, ()


def _chosen(stack: list[Node], random: Random, splits: np.ndarray, classes: int, room: int) -> tuple[list[Node], np.ndarray]:
    """The nodes of the next group, which leave the stack, and the features of each.

    As in Spark a group has ``room`` bytes for eight bytes a class and bin; the features of the node that finds no room are drawn
    again for the next group.
    """
    k = int(np.ceil(np.sqrt(len(splits))))
    nodes: list[Node] = []
    subsets: list[np.ndarray] = []
    used = 0
    while stack:
        ahead = Random(0)
        ahead.state = random.state
        for subset in reservoirs([ahead.long() for _ in stack[:512]], len(splits), k):
            random.long()
            size = int((splits[subset] + 1).sum()) * classes * 8
            if used and used + size > room:
                return nodes, np.array(subsets)
            nodes.append(stack.pop(0))
            subsets.append(subset)
            used += size
    return nodes, np.array(subsets)


def grown(texts: DataFrame, cuts: np.ndarray, classes: int, trees: int, seed: int, depth: int, room: int) -> list[Node]:
    """The roots of the trees."""
    splits = np.isfinite(cuts).sum(axis=1)
    nodes = [Node(i, i, 0, None) for i in range(trees)]
    roots, stack, random = list(nodes), nodes[::-1], Random(seed)
    while stack:
        chosen, subsets = _chosen(stack, random, splits, classes, room)
        feature, cut, left, place = np.full((4, len(nodes)), -1, np.int32)
        for node in nodes:
            if node.children:
                feature[node.number], left[node.number] = node.feature, node.children[0].number
                cut[node.number] = np.searchsorted(cuts[node.feature], node.threshold)
        place[[n.number for n in chosen]] = np.arange(len(chosen))
        group = Group(trees, classes, feature, cut, left, place, np.array([n.tree for n in chosen]), subsets, splits)
        found = best_splits(texts, group)
        by_tree: dict[int, list[tuple[Node, int]]] = {}
        for p, node in enumerate(chosen):
            by_tree.setdefault(node.tree, []).append((node, p))
        for node, p in (x for tree in scala_order(by_tree) for x in by_tree[tree]):
            r = found.get(p)
            sides = [np.array(r[s] if r else [0] * classes, np.int64) for s in ("left", "right")]
            node.counts = sides[0] + sides[1]
            node.valid = bool(r) and r["place"] is not None
            if not node.valid or r["gain"] <= 0 or node.level == depth:
                continue
            node.gain, node.feature = r["gain"], int(subsets[p][r["place"]])
            node.threshold = float(cuts[node.feature, r["cut"]])
            last = node.level + 1 == depth
            node.children = tuple(Node(len(nodes) + i, node.tree, node.level + 1, c, last or abs(gini(c)) < EPSILON) for i, c in enumerate(sides))
            nodes += node.children
            for child in node.children:
                if not child.leaf:
                    stack.insert(0, child)
    return roots


def _pruned(node: Node) -> Node:
    """Siblings that both are leaves and predict the same class are one leaf."""
    if node.children:
        node.children = tuple(map(_pruned, node.children))
        if not any(c.children for c in node.children) and len({int(np.argmax(c.counts)) for c in node.children}) == 1:
            node.children = ()
    return node


def _rows(root: Node) -> list[tuple]:
    """The nodes of a tree as Spark stores them: numbered from the root, left before right."""
    out: list = []

    def put(node: Node) -> int:
        i = len(out)
        out.append(None)
        children = [put(c) for c in node.children]
        impurity = float(gini(node.counts)) if node.valid else -1.0
        split = (node.feature, [node.threshold], -1) if children else (-1, [], -1)
        sums = (node.counts.astype(float).tolist(), int(node.counts.sum()))
        out[i] = (i, float(np.argmax(node.counts)), impurity, *sums, node.gain if children else -1.0, *(children or (-1, -1)), split)
        return i

    put(_pruned(root))
    return [(root.tree, r) for r in out]


_NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double,"
    " leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def as_model(spark: SparkSession, roots: list[Node], estimator: RandomForestClassifier, width: int, classes: int) -> RandomForestClassificationModel:
    """Spark's model of these trees. It is read from Spark's own format, whose other parts a forest of bare roots gives."""
    from pyspark.ml.classification import RandomForestClassificationModel
    from pyspark.ml.linalg import Vectors

    column, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    bare = spark.createDataFrame([(Vectors.dense([0.0]), float(c)) for c in range(classes)], [column, label]).coalesce(1)
    path = f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    estimator.fit(bare).write().save(f"{path}/bare")
    told = json.loads(spark.read.text(f"{path}/bare/metadata").first()[0]) | {"numFeatures": width}
    spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.text(f"{path}/whole/metadata")
    spark.read.parquet(f"{path}/bare/treesMetadata").write.parquet(f"{path}/whole/treesMetadata")
    rows = [r for root in roots for r in _rows(root)]
    spark.createDataFrame(rows, _NODE).coalesce(1).write.parquet(f"{path}/whole/data")
    return RandomForestClassificationModel.load(f"{path}/whole")


def fit(train: DataFrame, estimator: RandomForestClassifier) -> RandomForestClassificationModel:
    """What ``estimator.fit(train)`` returns, for an estimator with a label, features, trees, a seed, a depth, bins and memory and
    otherwise Spark's defaults. ``train`` is read four times in the same partitions, so it should be ``durable``; its features are counts."""
    label, trees, seed = estimator.getLabelCol(), estimator.getNumTrees(), estimator.getSeed()
    train = train.select(label, F.col(estimator.getFeaturesCol()).alias("features"))
    rows, most = train.agg(F.count(F.lit(1)), F.max(label)).first()
    if not rows or trees == 1:  # an error or a tree of all features, which is Spark's
        return estimator.fit(train)
    shipped(train.sparkSession)
    size = F.unwrap_udt("features")
    width, classes = train.select(F.coalesce(size["size"], F.size(size["values"]))).first()[0], int(most) + 1
    cuts = thresholds(train, width, rows, estimator.getMaxBins(), seed)
    texts = bagged_texts(train, label, cuts, trees, seed)
    roots = grown(texts, cuts, classes, trees, seed, estimator.getMaxDepth(), estimator.getMaxMemoryInMB() << 20)
    return as_model(train.sparkSession, roots, estimator, width, classes)
