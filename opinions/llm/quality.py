"""Quality of documents from a linear-chain conditional random field over their lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinions.llm.common import sampled, tidy

#: Labelled documents that the model learns from, and lines of each, at most.
SAMPLE = 4000
SAMPLE_LINES = 64
#: Lines that follow one another in a sample of a longer document's lines.
RUN = 16
#: Score from which a document counts as good.
THRESHOLD = 0.3
#: Bytes of text whose lines are measured together.
GROUP = 2_000_000
STEPS, RATE, DECAY = 250, 0.1, 1e-3

LOWER, UPPER, DIGIT, MARK, SYMBOL, POINT, OTHER, SPACE, BREAK = range(9)


def _classes() -> np.ndarray:
    table = np.full(256, SYMBOL, np.uint8)
    table[128:] = OTHER
    for kind, chars in (
        (LOWER, bytes(range(97, 123))),
        (UPPER, bytes(range(65, 91))),
        (DIGIT, b"0123456789"),
        (MARK, b"!"),
        (POINT, b".,;:?'\"()-"),
        (SPACE, b" \t\x0b\x0c\r"),
        (BREAK, b"\n"),
    ):
        table[list(chars)] = kind
    return table


CLASSES = _classes()
#: Own features of a line: shares of LOWER to SPACE, then those named here.
NAMED = ("length", "repeated_words", "odd_word_ends", "word_length", "closed", "seen_before", "empty")
FLAGS = ("many_upper", "many_repeated", "many_odd_ends", "many_symbols")
OWN = SPACE + 1 + len(NAMED) + len(FLAGS)
FEATURES = 1 + 3 * OWN
SEEN = SPACE + 1 + NAMED.index("seen_before")
#: Lines of a text that are measured together at most.
LONG = 20_000


def measured(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of every line, the number of bytes of each, and the number of lines of each text."""
    lines = np.array([t.count(b"\n") + 1 for t in texts])
    data = np.frombuffer(b"\n".join(texts) + b"\n" + bytes(8), np.uint8)
    kind = CLASSES[data[:-8]]
    end = np.flatnonzero(kind == BREAK)
    start = np.concatenate(([0], end[:-1] + 1))
    size = end - start
    out = np.zeros((len(end), OWN), np.float64)
    bytes_of = np.maximum(size, 1)
    for k in range(SPACE + 1):
        out[:, k] = np.add.reduceat((kind == k).view(np.uint8), start, dtype=np.int64) / bytes_of
    blank = kind >= SPACE
    edge = np.diff(np.concatenate(([True], blank)).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    length = last - first
    head = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    prefix = head[first].astype(np.uint64) >> (8 * (8 - np.minimum(length, 8))).astype(np.uint64)
    suffix = np.where(length > 8, head[np.maximum(last - 8, 0)].astype(np.uint64), 0)
    of = np.searchsorted(end, first)
    words = np.maximum(np.bincount(of, minlength=len(end)), 1)
    same = np.zeros(len(first), bool)
    same[1:] = (of[1:] == of[:-1]) & (length[1:] == length[:-1]) & (prefix[1:] == prefix[:-1]) & (suffix[1:] == suffix[:-1])
    odd = np.isin(kind[last - 1], (MARK, SYMBOL))
    repeated = np.bincount(of, weights=same, minlength=len(end)) / words
    ends = np.bincount(of, weights=odd, minlength=len(end)) / words
    closing = np.where(size > 0, data[np.maximum(end - 1, 0)], 32)
    doc = np.repeat(np.arange(len(texts)), lines)
    seen = np.zeros(len(end), bool)
    seen_lines: dict = {}
    for i, (d, a, b) in enumerate(zip(doc.tolist(), start.tolist(), end.tolist())):
        if a < b:
            key = (d, data[a:b].tobytes())
            seen[i] = seen_lines.setdefault(key, i) != i
    named = (
        np.log1p(size) / 6,
        repeated,
        ends,
        np.bincount(of, weights=length, minlength=len(end)) / words / 10,
        np.isin(closing, list(b".!?")),
        seen,
        size == 0,
    )
    flags = (out[:, UPPER] > 0.3, repeated > 0.2, ends > 0.2, out[:, SYMBOL] > 0.03)
    for i, x in enumerate((*named, *flags)):
        out[:, SPACE + 1 + i] = x
    return out, size, lines


def with_neighbours(own: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """A constant, a line's own features, and those of the lines before and after it; zero beyond the ends."""
    first = np.cumsum(lines) - lines
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    before[first] = 0
    after[:-1] = own[1:]
    after[first + lines - 1] = 0
    return np.concatenate((np.ones((len(own), 1)), own, before, after), axis=1)


@dataclass(frozen=True)
class Chain:
    """Log-odds weights of a good line, and log potentials of the first state and of pairs (bad 0, good 1)."""

    weights: np.ndarray
    start: np.ndarray
    pairs: np.ndarray

    @staticmethod
    def blank() -> Chain:
        return Chain(np.zeros(FEATURES), np.zeros(2), np.zeros((2, 2)))


def marginals(chain: Chain, x: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all sequences at once: P(good) of every line, expected pairs, expected first states.

    Sequences stand in order of falling length, so those that still run at a step are a prefix.
    """
    order = np.argsort(-lines, kind="stable")
    first, n = (np.cumsum(lines) - lines)[order], lines[order]
    steps = int(n[0]) if len(n) else 0
    running = np.searchsorted(-n, -np.arange(steps), side="left")
    with np.errstate(over="ignore"):
        good = 1 / (1 + np.exp(-(x @ chain.weights)))
    local = np.stack((1 - good, good), axis=1) + 1e-12
    move = np.exp(chain.pairs)
    ahead, scale = np.empty_like(local), np.empty(len(local))
    for t in range(steps):
        at = first[: running[t]] + t
        now = (np.exp(chain.start) if t == 0 else ahead[at - 1] @ move) * local[at]
        scale[at] = now.sum(axis=1)
        ahead[at] = now / scale[at, None]
    back = np.ones_like(local)
    pairs = np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        at = first[: running[t]] + t
        coming = local[at] * back[at] / scale[at, None]
        pairs += move * (ahead[at - 1].T @ coming)
        back[at - 1] = coming @ move.T
    both = ahead * back
    both /= both.sum(axis=1, keepdims=True)
    return both[:, 1], pairs, both[first].sum(axis=0) if len(first) else np.zeros(2)


def trained(own: np.ndarray, lines: np.ndarray, good: np.ndarray, steps: int = STEPS) -> Chain:
    """Fit a chain to lines with labels ``good`` by the gradient of the conditional likelihood (Adam)."""
    if not len(own) or good.all() or not good.any():
        return Chain.blank()
    x = with_neighbours(own, lines)
    first = np.zeros(len(own), bool)
    first[np.cumsum(lines) - lines] = True
    y = good.astype(np.int64)
    inner = np.flatnonzero(~first)
    seen_pairs = np.bincount(2 * y[inner - 1] + y[inner], minlength=4).reshape(2, 2)
    seen_first = np.bincount(y[first], minlength=2)
    theta = np.zeros(FEATURES + 2 + 4)
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, steps + 1):
        chain = Chain(theta[:FEATURES], theta[FEATURES : FEATURES + 2], theta[FEATURES + 2 :].reshape(2, 2))
        p, pairs, begin = marginals(chain, x, lines)
        slope = np.concatenate((x.T @ (y - p), seen_first - begin, (seen_pairs - pairs).ravel())) / len(lines)
        slope -= DECAY * theta
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        theta = theta + RATE * (mean / (1 - 0.9**i)) / (np.sqrt(spread / (1 - 0.99**i)) + 1e-8)
    return Chain(theta[:FEATURES], theta[FEATURES : FEATURES + 2], theta[FEATURES + 2 :].reshape(2, 2))


def spliced(own: np.ndarray, lines: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, and besides each bad one joined to a good one, so that the chain sees labels change."""
    first = np.cumsum(lines) - lines
    label = good[first]
    parts = [(own, lines, good)]
    fine, poor = np.flatnonzero(label), np.flatnonzero(~label)
    for i, (a, b) in enumerate(zip(fine, poor)):
        pair = (a, b) if i % 2 else (b, a)
        rows = np.concatenate([np.arange(first[k], first[k] + lines[k]) for k in pair])
        parts.append((own[rows], np.array([len(rows)]), good[rows]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def scores(chain: Chain, texts: list[bytes]) -> np.ndarray:
    """Quality of each text: P(good) of its lines, weighted by their bytes; a line counts one byte more."""
    out = []
    group: list[bytes] = []
    size = 0
    for i, t in enumerate(texts):
        group.append(t)
        size += len(t)
        if size >= GROUP or i == len(texts) - 1:
            own, length, lines = measured(group)
            p, _, _ = marginals(chain, with_neighbours(own, lines), lines)
            first = np.cumsum(lines) - lines
            weight = length + 1.0
            out.append(np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first))
            group, size = [], 0
    return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


def long_score(chain: Chain, text: bytes) -> float:
    """``scores`` of one text with very many lines: features are made for LONG lines at a time, and what stays of a line are a few
    numbers. Lines seen before are known by a hash."""
    end = np.append(np.flatnonzero(np.frombuffer(text, np.uint8) == 10), len(text))
    n = len(end)
    odds, weight = np.full(n, chain.weights[0]), np.empty(n)
    own_w, before_w, after_w = chain.weights[1:].reshape(3, OWN)
    seen: set[int] = set()
    for a in range(0, n, LONG):
        b = min(a + LONG, n)
        first = int(end[a - 1]) + 1 if a else 0
        own, size, _ = measured([text[first : end[b - 1]]])
        at = first
        for i, stop in enumerate(end[a:b].tolist()):
            if stop > at:
                known = xxhash.xxh64_intdigest(text[at:stop])
                own[i, SEEN] = known in seen
                seen.add(known)
            at = stop + 1
        odds[a:b] += own @ own_w
        odds[a + 1 : b + 1] += (own @ before_w)[: n - a - 1]
        odds[max(a - 1, 0) : b - 1] += (own @ after_w)[0 if a else 1 :]
        weight[a:b] = size + 1.0
    with np.errstate(over="ignore"):
        good = 1 / (1 + np.exp(-odds))
    (m00, m01), (m10, m11) = np.exp(chain.pairs).tolist()
    ahead, out = np.empty(n), np.empty(n)
    s0, s1 = np.exp(chain.start).tolist()
    for t in range(n):
        g = float(good[t])
        s0, s1 = s0 * (1 - g + 1e-12), s1 * (g + 1e-12)
        f = s1 / (s0 + s1)
        ahead[t] = f
        s0, s1 = (1 - f) * m00 + f * m10, (1 - f) * m01 + f * m11
    b0 = b1 = 1.0
    for t in range(n - 1, -1, -1):
        f, g = float(ahead[t]), float(good[t])
        out[t] = f * b1 / ((1 - f) * b0 + f * b1)
        c0, c1 = (1 - g + 1e-12) * b0, (g + 1e-12) * b1
        b0, b1 = m00 * c0 + m01 * c1, m10 * c0 + m11 * c1
        b0, b1 = b0 / (b0 + b1), b1 / (b0 + b1)
    return float(np.clip((out * weight).sum() / weight.sum(), 0, 1))


def mixed_scores(chain: Chain, texts: Iterator[bytes]) -> np.ndarray:
    """Quality of each text, those with more than LONG lines one by one."""
    out: list[float] = []
    run: list[bytes] = []
    for t in texts:
        if t.count(b"\n") < LONG:
            run.append(t)
            continue
        out += [*scores(chain, run), long_score(chain, t)]
        run = []
    return np.array([*out, *scores(chain, run)])


def score(chain: Chain, text: Column) -> Column:
    """Quality between 0 and 1 of a text column; null is scored as the empty text."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tidy()
        for batch in batches:
            yield pa.array(mixed_scores(chain, (t.as_py() or b"" for t in batch.cast(pa.binary()))), pa.float64())

    return run(text.cast("string"))


def held_out(key: Column) -> Column:
    """One document in five, by a checksum of its key; their labels are never learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def places(lines: int, most: int, key: int) -> np.ndarray:
    """Lines to learn from: all, or of a longer document runs from all over it, one in each of equal parts, placed by its key."""
    if lines <= most:
        return np.arange(lines)
    run = min(RUN, most)
    parts = np.linspace(0, lines, most // run + 1).astype(np.int64)
    start = np.random.default_rng(key % 2**64).integers(parts[:-1], parts[1:] - run + 1)
    return (start[:, None] + np.arange(run)).ravel()


def lines_to_learn(text: bytes, most: int, key: int) -> np.ndarray:
    """Own features of ``places`` of a text; a text of very many lines is measured LONG lines at a time."""
    n = text.count(b"\n") + 1
    at = places(n, most, key)
    if n <= LONG:
        return measured([text])[0][at]
    end = np.append(np.flatnonzero(np.frombuffer(text, np.uint8) == 10), len(text))
    out = []
    for a in range(0, n, LONG):
        b = min(a + LONG, n)
        some = at[(at >= a) & (at < b)]
        if len(some):  # of lines seen before, only those nearby are known here
            own, _, _ = measured([text[int(end[a - 1]) + 1 if a else 0 : end[b - 1]]])
            out.append(own[some - a])
    return np.concatenate(out)


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    sample_lines: int = SAMPLE_LINES,
) -> Chain:
    """Learn from at most ``sample`` labelled documents that are not held out, and ``sample_lines`` lines of each,
    in runs from all over it.

    The sample is the least by a hash of the key, so it is the same in every run. Its keys are broadcast, the
    lines are measured where the texts are, and only their features come to the driver. All lines of
    a document carry its label. Null labels and keys are left out; without both labels the model is blank, and
    every score is one half.
    """
    usable = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label")).filter(
        F.col("_label").isin(0, 1) & F.col("_key").isNotNull() & ~held_out(F.col("_key"))
    )
    some = sampled(usable.groupBy("_key").agg(F.min("_label").alias("_label")), "_key", sample)
    schema = T.StructType(
        [T.StructField("key", T.LongType()), T.StructField("good", T.BooleanType()), T.StructField("own", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(2).cast(pa.binary())):
                rows.append(lines_to_learn(t.as_py() or b"", sample_lines, k).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=schema.names)

    found = docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_text")).join(
        F.broadcast(some), F.col("_k") == F.col("_key")
    )
    order = F.xxhash64("_k").alias("key")
    measures = found.select(order, (F.col("_label") == 1).alias("good"), "_text").mapInArrow(run, schema)
    # One key may have many rows.
    rows = measures.orderBy("key", "own").limit(sample).collect()
    owns = [np.frombuffer(r["own"], "<f8").reshape(-1, OWN) for r in rows]
    if not owns:
        return Chain.blank()
    lines = np.array([len(o) for o in owns])
    good = np.repeat(np.array([r["good"] for r in rows]), lines)
    return trained(*spliced(np.concatenate(owns), lines, good))


def classified(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Score every whole text: key, held_out, score, predicted.

    Each line is good or bad in a chain that knows the features of the line and its neighbours; the score is
    the share of bytes in good lines, by marginals. Empty and null texts are one empty line. Rows that repeat a
    key are scored each, a null key is not held out, other columns are ignored, an empty table gives no rows.
    """
    chain = fitted(docs, labels, key, text, label)
    made = docs.select(F.col(key).alias(key), held_out(F.col(key)).alias("held_out"), score(chain, F.col(text)).alias("score"))
    return made.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
