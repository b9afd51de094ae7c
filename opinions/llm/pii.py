"""Personal data: spans that rules define, and spans that a character tagger adds."""

from __future__ import annotations

import heapq
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinions.llm import tagger
from opinions.llm.common import about

KINDS = ("email", "ip", "card", "phone")
#: Characters in a window, and from one window to the next. Longer spans are read in windows of twice the size, and so on.
WINDOW, STRIDE = 96, 48
#: Windows that the tagger learns from, and windows of one document, at most; documents searched for them, about.
SAMPLE, PER_DOCUMENT, DOCUMENTS = 800, 6, 8000
#: Least mean marginal of a span that the tagger adds.
SURE = 0.5
#: Windows decoded at a time.
TOGETHER = 256

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Every kind holds one of these.
SIGN = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # start, kind, end


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind: int, text: str) -> bool:
    """Whether a text found as a kind is one: parts at most 255, a card's length and checksum, a phone's length."""
    digits = _digits(text)
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == 3:
        return 10 <= len(digits) <= 15
    name, at, host = text.partition("@")
    return bool(name.strip() and at and "." in host.strip(" .") and "@" not in host)


def base_spans(text: str) -> list[Span]:
    """Spans by rule, per kind leftmost and not overlapping, in code points. Time is linear in the text."""
    found: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            found.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    if SIGN.search(text):
        for kind, rule in ((1, IP), (2, CARD), (3, PHONE)):
            found += [(m.start(), kind, m.end()) for m in rule.finditer(text) if valid(kind, m[0])]
    return sorted(found)


def open_windows(text: str, spans: list[Span]) -> list[int]:
    """Starts of the windows that hold a sign outside of ``spans``. Any other span would lie in one of them,
    as spans that are added must not touch those of the rules."""
    taken = iter(sorted((a, b) for a, _, b in spans))
    near, a, b = set(), -1, -1
    for m in SIGN.finditer(text):
        i = m.start()
        while i >= b and (nxt := next(taken, None)):
            a, b = nxt[0], max(b, nxt[1])
        if not a <= i < b:
            near |= {i // STRIDE, max(i // STRIDE - 1, 0)}
    return [k * STRIDE for k in sorted(near)]


def tag_row(start: int, spans: list[Span]) -> list[int]:
    """Tags of a window: 0 outside, 1 + 2 * kind at a span's start, 2 + 2 * kind inside. Cut and overlapped spans get none."""
    tags, free = [0] * WINDOW, start
    for a, kind, b in spans:
        if a >= max(start, free) and b <= start + WINDOW:
            tags[a - start : b - start] = [1 + 2 * kind] + [2 + 2 * kind] * (b - a - 1)
            free = b
    return tags


def varied(text: str, kind: int, rng: random.Random) -> str:
    """Another way of writing a span of a kind, which the rules may not know."""
    d = _digits(text)
    if kind == 0:
        name, _, host = text.partition("@")
        return rng.choice([f"{name} @ {host}", f"{name}@ {host}"])
    if kind == 1:
        return ".".join(str(rng.randint(1, 255)) for _ in range(4))
    if kind == 2:
        return rng.choice(". /").join(d[i : i + 4] for i in range(0, len(d), 4))
    d = "".join(rng.choice("0123456789") for _ in range(10))
    return rng.choice([f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"00{d} "]).strip()


def examples(windows: list[str], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags to learn from: labelled windows as they are, and with one span written in another way.

    Numbers that look like a card but fail its checksum are blanked; nothing but the checksum tells them apart.
    """
    rng = random.Random(seed)
    texts, tags = [], []
    for text in windows:
        text = CARD.sub(lambda m: m[0] if valid(2, m[0]) or len(_digits(m[0])) < 14 else "x" * len(m[0]), text)
        spans = base_spans(text)
        texts.append(text)
        tags.append(tag_row(0, spans))
        if spans:
            start, kind, end = rng.choice(spans)
            new = varied(text[start:end], kind, rng)
            text = (text[:start] + new + text[end:])[:WINDOW]
            span = (start, kind, start + len(new))
            rest = [s for s in base_spans(text) if s[2] <= span[0] or s[0] >= span[2]]
            texts.append(text)
            tags.append(tag_row(0, sorted([*rest, span])))
    return tagger.coded(texts, WINDOW), np.array(tags, np.int64).reshape(-1, WINDOW)


def proposals(
    model: tagger.Tagger,
    windows: list[tuple[int, int, str, bool, bool]],
    width: int = WINDOW,
    least: int = 0,
    cut: dict[int, list[Span]] | None = None,
    whole: dict[int, list[Span]] | None = None,
) -> dict[int, dict[Span, float]]:
    """Spans by document from (document, start, text, first, last) windows, with the sum of their marginals.

    A span that touches an inner end of its window goes to ``cut``, any other to ``whole``; the next window holds all of
    it, or a wider one. Spans under ``least`` characters are left to narrower windows.
    """
    found: dict[int, dict[Span, float]] = {}
    together = max(TOGETHER * WINDOW // width, 1)
    for i in range(0, len(windows), together):
        some = windows[i : i + together]
        path, sure = tagger.decoded(model, tagger.coded([w[2] for w in some], width))
        for (doc, at, text, first, last), tags, p in zip(some, path, sure):
            begin = np.flatnonzero(tags % 2 == 1)
            for a in begin.tolist():
                kind, b = int(tags[a]) // 2, a + 1
                while b < len(text) and tags[b] == 2 + 2 * kind:
                    b += 1
                inner = (a == 0 and not first) or (b >= len(text) and not last)
                seen = cut if inner else whole
                if seen is not None:
                    seen.setdefault(doc, []).append((at + a, kind, at + b))
                if inner or b - a < least:
                    continue
                score = float(p[a:b].mean())
                while b > a and text[b - 1] == " ":
                    b -= 1
                if score >= SURE and valid(kind, text[a:b]):
                    spans = found.setdefault(doc, {})
                    spans[at + a, kind, at + b] = spans.get((at + a, kind, at + b), 0.0) + score
    return found


def _reach(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts in order, and the greatest end up to each."""
    spans = sorted(spans)
    ends: list[int] = []
    for s in spans:
        ends.append(max(s[2], ends[-1]) if ends else s[2])
    return [s[0] for s in spans], ends


def unsettled(cut: list[Span], whole: list[Span], base: list[Span]) -> list[Span]:
    """Cut spans that touch none of ``base`` and that no other window has seen whole."""
    base_starts, base_ends = _reach(base)
    of_kind = {kind: _reach([s for s in whole if s[1] == kind]) for kind in range(len(KINDS))}
    out = []
    for a, kind, b in cut:
        starts, ends = of_kind[kind]
        i, j = bisect_left(base_starts, b), bisect_right(starts, a)
        if not (i and base_ends[i - 1] > a) and not (j and ends[j - 1] >= b):
            out.append((a, kind, b))
    return out


def all_proposals(model: tagger.Tagger, texts: list[str], base: list[list[Span]]) -> dict[int, dict[Span, float]]:
    """Proposals of any length by document. Where a span is cut by all windows that see it, windows of twice the size are
    read, until they hold it or the whole text."""
    found: dict[int, dict[Span, float]] = {}
    width, stride, least = WINDOW, STRIDE, 0
    starts = [(i, at) for i, (t, b) in enumerate(zip(texts, base)) for at in open_windows(t, b)]
    while starts:
        windows = [(i, at, texts[i][at : at + width], at == 0, at + width >= len(texts[i])) for i, at in starts]
        cut: dict[int, list[Span]] = {}
        whole: dict[int, list[Span]] = {}
        for i, spans in proposals(model, windows, width, least, cut, whole).items():
            sums = found.setdefault(i, {})
            for span, x in spans.items():
                sums[span] = sums.get(span, 0.0) + x
        # Spans shorter than a stride lie within some window of that stride.
        width, stride, least = 2 * width, 2 * stride, stride
        left = [(i, a // stride) for i in cut for a, _, _ in unsettled(cut[i], whole.get(i, []), base[i])]
        starts = sorted({(i, max(k - back, 0) * stride) for i, k in left for back in (0, 1)})
    return found


def reconciled(spans: dict[Span, float], base: list[Span]) -> list[Span]:
    """Of overlapping proposals of all windows, the ones with the greatest sums; none touches a span by rule.

    Kept spans don't overlap, so only the neighbours of a proposal's place among them are compared.
    """
    starts, ends = _reach(base)
    kept: list[Span] = []
    for span in sorted(spans, key=lambda s: (-spans[s], s)):
        i = bisect_left(starts, span[2])
        if i and ends[i - 1] > span[0]:
            continue
        at = bisect_left(kept, span)
        if (at and kept[at - 1][2] > span[0]) or (at < len(kept) and kept[at][0] < span[2]):
            continue
        kept.insert(at, span)
    return kept


def fitted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tagger.Tagger:
    """Train on at most SAMPLE windows, PER_DOCUMENT of a document, labelled by the rules.

    They come from some DOCUMENTS documents with low hashes of their keys, so every run learns the same; only the
    windows leave the tasks.
    """
    some = about(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")), "key", DOCUMENTS)
    hashed = some.select(F.xxhash64("key").alias("key"), "text")
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("window", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, windows = [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = {m.start() // STRIDE * STRIDE for m in SIGN.finditer(t or "")}
                # From all over the text: those whose place has the least hash.
                at = heapq.nsmallest(PER_DOCUMENT, at, key=lambda i: (xxhash.xxh64_intdigest(f"{k}:{i}"), i))
                keys += [k] * len(at)
                windows += [t[i : i + WINDOW] for i in at]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(windows, pa.string())], names=schema.names)

    rows = hashed.mapInArrow(run, schema).orderBy("key", "window").limit(SAMPLE).collect()
    return tagger.trained(*examples([r["window"] for r in rows]), 1 + 2 * len(KINDS))


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])


def found(docs: DataFrame, model: tagger.Tagger, key: str = "doc_id", text: str = "text", redact: bool = False) -> DataFrame:
    """Personal data of whole texts: key, base and added (arrays of kind, start, stop in code points), by start.

    ``base`` holds what the rules define. ``added`` holds what the tagger finds besides, in overlapping windows, wider
    ones around longer spans, that are decoded one by one and reconciled over the whole document; each passes its kind's check and touches
    no span of ``base``. ``redact`` adds the text with every span replaced by its kind in angle brackets.

    Null and empty texts have no spans. Rows that repeat a key are documents of their own, a null key is a
    key, other columns are ignored, an empty table gives no rows.
    """
    fields = [T.StructField(key, docs.schema[key].dataType)]
    fields += [T.StructField("base", T.ArrayType(SPAN)), T.StructField("added", T.ArrayType(SPAN))]
    if redact:
        fields.append(T.StructField("redacted", T.StringType()))
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def named(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            more = all_proposals(model, texts, base)
            added = [reconciled(more.get(i, {}), b) for i, b in enumerate(base)]
            out = [batch.column(0), pa.array(map(named, base), spans_type), pa.array(map(named, added), spans_type)]
            if redact:
                out.append(pa.array([redacted(t, [*b, *a]) for t, b, a in zip(texts, base, added)], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])

    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, T.StructType(fields))


def redacted(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for a, kind, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])
