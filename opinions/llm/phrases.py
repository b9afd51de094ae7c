"""Phrase collocations by best-first branch and bound.

A phrase's score at any cut is at most 1000 * n / (count of what stands before the cut), as what stands behind it occurs as often
as the phrase or more. The count of a prefix thus bounds all phrases that grow from it, and its first word bounds them
best. The frontier are words in the order of that bound, rarest first. It is expanded block by block: prefixes grow a word at
a time, those that occur too seldom are cut off. Once a language has its full number of surviving scores, words whose bound is
below the last of them are never expanded, which in large collections are nearly all occurrences.

Texts are split twice, to count words and to write them as hashes of 64 bits, tested to be unique among all that matter; words that
occur too seldom end a piece there. All later scans read these rows. Tasks see at most ``BLOCK`` prefixes at
a time, and of all frequent words a bit map of fixed size; what they leave is combined in the task and counted by Spark.
"""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinions.llm.common import grouped, written

LONGEST, LEAST, TOP = 5, 100, 2000
#: Prefixes or phrases that tasks look for at once: 24 MB at most.
BLOCK = 500_000
#: Bits of the map of frequent words: 2 MB. Words that share a bit are counted in vain, no more.
BITS = 24
#: Share of a language's words that the first block of the frontier may cover; the second is all that is not settled then.
FIRST = 1 / 8
#: Words that are worked on together, words to a row of the encoded texts, and different words that a task remembers.
RUN, ROW, REMEMBERED = 1_000_000, 500, 500_000
#: Bytes of text that are split at once.
PART = 2_000_000

HASHES = tuple(f"h{i}" for i in range(1, LONGEST + 1))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CLEAN = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\t", b"\n" * 10 + b" ")
_EMPTY, _BREAK = 0, 1


class Words(dict):
    """Slots of words: 0 no word, 1 the end of a piece, others in the order of their first sight."""

    def __init__(self, lang: str, seed: int):
        self.seed = xxhash.xxh64_intdigest(lang.encode(), seed)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.update({b"": _EMPTY, b"\n": _BREAK})
        self.names: list[bytes] = [b"", b"\n"]
        self.hashes = array("Q", [0, 0])

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed) or 1)
        return slot


def _parts(raw: bytes) -> Iterator[bytes]:
    """A text in parts that end at blanks."""
    start = 0
    while len(raw) - start > 2 * PART:
        end = raw.find(b" ", start + PART)
        if end < 0:
            break
        yield raw[start:end]
        start = end
    yield raw[start:] if start else raw


def slots(raw: bytes, words: Words) -> np.ndarray:
    """Slots of a text's words and piece ends, in order."""
    found = []
    for part in _parts(raw):
        tokens = part.lower().translate(_CLEAN).replace(b"\n", b" \n ").split(b" ")
        here = np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))
        found.append(here[here != _EMPTY])
    return found[0] if len(found) == 1 else np.concatenate(found)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """Languages of a batch and runs of their texts, parted by line ends."""
    by_lang: dict[str, list[int]] = {}
    for row, lang in enumerate(batch.column(0).to_pylist()):
        by_lang.setdefault(lang, []).append(row)
    texts = batch.column(1).cast(pa.large_binary())
    for lang, rows in by_lang.items():
        for run in grouped((texts[r].as_py() for r in rows), PART):
            yield lang, b"\n".join(run)


def _read(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )


def word_counts(read: DataFrame, seed: int) -> DataFrame:
    """lang, word, h, n: all words of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Words] = {}
        sums: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, words in known.items():
                seen = np.flatnonzero(sums[lang])
                seen = seen[seen > _BREAK]
                hashes = np.array(words.hashes, np.uint64)[seen].view(np.int64)
                names = pa.array([words.names[s] for s in seen.tolist()], pa.binary()).cast(pa.string())
                langs = pa.array([lang] * len(seen), pa.string())
                yield pa.RecordBatch.from_arrays([langs, names, pa.array(hashes), pa.array(sums[lang][seen])], names=["lang", "word", "h", "n"])
            known.clear()
            sums.clear()

        for batch in batches:
            for lang, raw in _runs(batch):
                if lang not in known:
                    known[lang], sums[lang] = Words(lang, seed), np.zeros(0, np.int64)
                here = slots(raw, known[lang])
                more = np.bincount(here, minlength=max(len(known[lang]), len(sums[lang]))).astype(np.int64)
                more[: len(sums[lang])] += sums[lang]
                sums[lang] = more
                if sum(map(len, known.values())) > REMEMBERED:
                    yield from flush()
        yield from flush()

    rows = read.mapInArrow(count, "lang string, word string, h long, n long")
    return rows.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


def _pieces(words: np.ndarray) -> np.ndarray:
    """Words between zeros, without words that stand alone and without zeros in a row; it begins and ends with one."""
    padded = np.concatenate([[np.uint64(0)], words, [np.uint64(0)]])
    there = padded != 0
    joined = there.copy()
    joined[1:-1] &= there[:-2] | there[2:]
    kept = joined.copy()
    kept[0] = True
    kept[1:] |= joined[:-1]  # the zero behind a piece
    return np.where(joined, padded, np.uint64(0))[kept]


def _rows(words: np.ndarray) -> pa.ListArray:
    """Pieces in rows of about ROW words; each row ends with the zero behind a piece."""
    zeros = np.flatnonzero(words == 0)
    at = np.searchsorted(zeros, np.arange(ROW, len(words), ROW))
    ends = np.unique(np.append(zeros[at[at < len(zeros)]] + 1, len(words)))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(words.view(np.int64)))


def encoded(read: DataFrame, frequent: np.ndarray, seed: int) -> DataFrame:
    """w: the texts as hashes of their frequent words, in rows of pieces, with 0 between pieces."""
    sent = read.sparkSession.sparkContext.broadcast(frequent)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Words] = {}
        for batch in batches:
            for lang, raw in _runs(batch):
                words = known.setdefault(lang, Words(lang, seed))
                here = slots(raw, words)
                hashes = np.array(words.hashes, np.uint64)
                hashes[~_holds(sent.value, hashes)] = 0
                hashes[:2] = 0
                found = _pieces(hashes[here])
                if len(found) > 1:
                    yield pa.RecordBatch.from_arrays([_rows(found)], names=["w"])
                if sum(map(len, known.values())) > REMEMBERED:
                    known.clear()

    return read.mapInArrow(encode, "w array<long>")


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Hashes of many rows one after the other, in runs of RUN words or more; a row is never cut."""
    held, size = [np.zeros(1, np.uint64)], 0
    for batch in batches:
        words = batch.column(0).flatten().to_numpy().view(np.uint64)
        held.append(words)
        size += len(words)
        if size >= RUN:
            yield np.concatenate(held)
            held, size = [np.zeros(1, np.uint64)], 0
    if size:
        yield np.concatenate(held)


def _mixed(parts: Sequence[np.ndarray]) -> np.ndarray:
    """One number for each row of hashes; rows that share it are told apart by their hashes."""
    key = parts[0].copy()
    for p in parts[1:]:
        key *= _MIX
        key += p
    return key


def _bit(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes & np.uint64(size - 1)).astype(np.int64)


def _holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _bit(hashes, 8 * len(bits))
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _bit_map(hashes: np.ndarray) -> np.ndarray:
    flags = np.zeros(1 << BITS, np.uint8)
    flags[_bit(hashes, 1 << BITS)] = 1
    return np.packbits(flags, bitorder="little")


class Sought(NamedTuple):
    """Phrases of one length, in the order of their mixed number."""

    key: np.ndarray
    parts: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, parts: np.ndarray) -> Sought:
        key = _mixed(list(parts))
        order = np.argsort(key, kind="stable")
        return cls(key[order], parts[:, order], _bit_map(parts[0]))

    def find(self, words: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places where one of the phrases begins, and which it is."""
        places = places[_holds(self.first, words[places])]
        length = len(self.parts)
        if not len(places) or not len(self.key):
            return places[:0], places[:0]
        key = _mixed([words[places + j] for j in range(length)])
        at = np.searchsorted(self.key, key)
        which, found = [], []
        while len(places):  # phrases that share a number are tried one after the other
            same = (at < len(self.key)) & (self.key[np.minimum(at, len(self.key) - 1)] == key)
            places, key, at = places[same], key[same], at[same]
            hit = np.ones(len(places), bool)
            for j in range(length):
                hit &= self.parts[j][at] == words[places + j]
            found.append(places[hit])
            which.append(at[hit])
            places, key, at = places[~hit], key[~hit], at[~hit] + 1
        return np.concatenate(found), np.concatenate(which)


def _windows(words: np.ndarray, length: int) -> np.ndarray:
    """Places from which ``length`` words stand in one piece."""
    whole = words != 0
    good = whole[: len(words) - length + 1].copy()
    for j in range(1, length):
        good &= whole[j : len(words) - length + 1 + j]
    return np.flatnonzero(good)


def _counted(parts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Different rows of hashes and how often each occurs; a row may come more than once."""
    order = np.argsort(_mixed(parts))
    parts = [p[order] for p in parts]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for p in parts:
        new[1:] |= p[1:] != p[:-1]
    at = np.flatnonzero(new)
    return [p[at] for p in parts], np.diff(np.append(at, len(order)))


def _columns(parts: Sequence[np.ndarray]) -> list[pa.Array]:
    """h1 to h5, with 0 behind the last word."""
    none = np.zeros(len(parts[0]), np.int64)
    return [pa.array(p.view(np.int64)) for p in parts] + [pa.array(none)] * (LONGEST - len(parts))


def _chunks(table: DataFrame, length: int) -> Iterator[np.ndarray]:
    """The first ``length`` hashes of all rows, some BLOCK rows at a time."""
    rows = table.count()
    n = -(-rows * 5 // (4 * BLOCK))
    for i in range(n):
        some = table if n == 1 else table.filter(F.pmod(F.xxhash64(*HASHES), F.lit(n)) == i)
        columns = some.select(*HASHES[:length]).toArrow()
        yield np.stack([c.to_numpy().view(np.uint64) for c in columns.columns])


_PHRASE = ", ".join(f"{h} long" for h in HASHES)


def grown(texts: DataFrame, prefixes: DataFrame, length: int, least: int) -> DataFrame | None:
    """h1..h5, n: the phrases of one word more than ``prefixes`` that begin with one of them and occur often enough."""
    spark = texts.sparkSession
    found = None
    for chunk in _chunks(prefixes, length):
        sent = spark.sparkContext.broadcast(Sought.of(chunk))

        def grow(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sought = sent.value
            for words in _flat(batches):
                places, _ = sought.find(words, _windows(words, length + 1))
                if len(places):
                    parts, n = _counted([words[places + j] for j in range(length + 1)])
                    yield pa.RecordBatch.from_arrays([*_columns(parts), pa.array(n)], names=[*HASHES, "n"])

        rows = texts.mapInArrow(grow, _PHRASE + ", n long")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return None
    return written(found.groupBy(*HASHES).agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


_AROUND = ("left_least", "left_most", "right_least", "right_most")


def surrounded(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """h1..h5, n and the least and greatest hash of the words before and behind each of ``phrases`` (0: none)."""
    spark = texts.sparkSession
    found = None
    for chunk in _chunks(phrases, LONGEST):
        lengths = (chunk != 0).sum(0)
        several = [Sought.of(chunk[:k, lengths == k]) for k in range(2, LONGEST + 1) if (lengths == k).any()]
        sent = spark.sparkContext.broadcast(several)

        def look(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sizes = [len(sought.key) for sought in sent.value]
            count = [np.zeros(k, np.int64) for k in sizes]
            low = [np.full((2, k), np.iinfo(np.int64).max) for k in sizes]
            high = [np.full((2, k), np.iinfo(np.int64).min) for k in sizes]
            for words in _flat(batches):
                for sought, n, least, most in zip(sent.value, count, low, high):
                    length = len(sought.parts)
                    places, which = sought.find(words, _windows(words, length))
                    n += np.bincount(which, minlength=len(n))
                    for side, at in enumerate((places - 1, places + length)):
                        near = words[at].view(np.int64)
                        np.minimum.at(least[side], which, near)
                        np.maximum.at(most[side], which, near)
            for sought, n, least, most in zip(sent.value, count, low, high):
                seen = np.flatnonzero(n)
                around = [pa.array(x[seen]) for x in (least[0], most[0], least[1], most[1])]
                columns = [*_columns([p[seen] for p in sought.parts]), pa.array(n[seen]), *around]
                yield pa.RecordBatch.from_arrays(columns, names=[*HASHES, "n", *_AROUND])

        rows = texts.mapInArrow(look, f"{_PHRASE}, n long, " + ", ".join(f"{a} long" for a in _AROUND))
        found = rows if found is None else found.unionByName(rows)
    sides = [(F.min if a.endswith("least") else F.max)(a).alias(a) for a in _AROUND]
    return written(found.groupBy(*HASHES).agg(F.sum("n").alias("n"), *sides))


def _padded(hashes: Sequence[Column]) -> list[Column]:
    return [*hashes, *[F.lit(0).cast("long")] * (LONGEST - len(hashes))]


def _suffixes() -> Column:
    """All ends of a phrase that are shorter than it, as arrays of five hashes with the number of the cut before them."""
    return F.array(*[F.struct(F.lit(k).alias("k"), F.array(*_padded([F.col(h) for h in HASHES[k:]])).alias("end")) for k in range(1, LONGEST)])


def _named(table: DataFrame, array: str, names: Sequence[str]) -> DataFrame:
    return table.select("*", *[F.col(array)[i].alias(n) for i, n in enumerate(names)]).drop(array)


def scored(candidates: DataFrame, around: DataFrame, words: DataFrame, prefixes: DataFrame, totals: DataFrame) -> DataFrame:
    """Surviving candidates with their least score: lang, h1..h5, a, l, r, n, score.

    A longer candidate that occurs as often as this one stands around it everywhere; then the word before it, or the one
    behind it, is always the same.
    """
    one = [F.col("h").alias("h1"), *[F.lit(0).cast("long").alias(h) for h in HASHES[1:]]]
    single = words.select(*one, "n")
    same = ((F.col("left_least") == F.col("left_most")) & (F.col("left_least") != 0)) | (
        (F.col("right_least") == F.col("right_most")) & (F.col("right_least") != 0)
    )
    alive = candidates.join(around.filter((F.col(HASHES[-1]) != 0) | ~same).select(*HASHES), [*HASHES], "left_semi")
    lang = words.join(totals, "lang").select(F.col("h").alias("h1"), "lang", "total")
    alive = alive.join(lang, "h1").withColumnRenamed("n", "a")
    cuts = alive.select("*", F.explode(_suffixes()).alias("cut")).filter("cut.end[0] <> 0")
    cuts = cuts.select(*alive.columns, F.col("cut.k").alias("k"), F.col("cut.end").alias("end"))
    behind, before = [f"e{i}" for i in range(LONGEST)], [f"b{i}" for i in range(LONGEST)]
    cuts = _named(cuts, "end", behind)
    begin = [F.when(F.col("k") > i, F.col(h)).otherwise(F.lit(0)).alias(b) for i, (h, b) in enumerate(zip(HASHES, before))]
    cuts = cuts.select("*", *begin)
    ends = single.unionByName(around.select(*HASHES, "n")).toDF(*behind, "r")
    starts = single.unionByName(prefixes.select(*HASHES, "n")).toDF(*before, "l")
    cuts = cuts.join(ends, behind).join(starts, before)
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "total", "l", "r")}
    score = F.call_function("div", F.lit(1000).cast("decimal(5,0)") * wide["a"] * wide["total"], wide["l"] * wide["r"])
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    kept = cuts.groupBy("lang", *HASHES, "a", F.col("total").alias("n")).agg(least)
    return kept.select("lang", *HASHES, "a", "cut.l", "cut.r", "n", "cut.score")


def _last_scores(found: DataFrame, top: int) -> dict[str, int]:
    """The score of rank ``top`` of each language that has so many."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"))
    ranked = found.select("lang", "score", F.row_number().over(order).alias("rank")).filter(F.col("rank") <= top)
    return {r["lang"]: r["score"] for r in ranked.filter(F.col("rank") == top).collect()}


def _cutoffs(words: DataFrame, totals: DataFrame, share: float) -> DataFrame:
    """lang, cutoff: words up to this count cover at most ``share`` of a language, by steps of a sixteenth of a doubling."""
    step = F.floor(F.log2(F.col("n")) * 16).alias("step")
    bins = words.groupBy("lang", step).agg(F.sum("n").alias("held"), F.max("n").alias("most"))  # some 700 a language
    before = Window.partitionBy("lang").orderBy("step")
    sums = bins.withColumn("held", F.sum("held").over(before)).join(totals, "lang")
    return sums.filter(F.col("held") <= F.col("total") * share).groupBy("lang").agg(F.max("most").alias("cutoff"))


def _with_words(found: DataFrame, words: DataFrame) -> DataFrame:
    """Add ``phrase``."""
    rows = found.select(*HASHES, F.posexplode(F.array(*HASHES)).alias("pos", "h")).filter("h <> 0")
    named = rows.join(words.select("h", "word"), "h").groupBy(*HASHES).agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("said"))
    return found.join(named.select(*HASHES, F.array_join(F.transform("said", lambda s: s["word"]), " ").alias("phrase")), [*HASHES])


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A-Z are lower-cased, texts split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words at blanks and tabs. A phrase of 2 to 5
    words that occurs ``least`` times or more (``a``) has the score floor(1000 * a * n / (l * r)) of its worst cut into parts that
    occur l and r times; n counts the language's words. A phrase goes if a longer one holds it and occurs as often.
    Order: score, a (both descending), phrase by its bytes. A null text is empty, a null language ``und``; repeated rows count each,
    other columns are ignored, an empty table gives no rows.
    """
    read = _read(docs, lang, text)
    for seed in itertools.count():
        counts = written(word_counts(read, seed))
        twice = counts.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
        if twice.filter((F.col("k") > 1) & (F.col("n") >= least)).isEmpty():
            break
    totals = written(counts.groupBy("lang").agg(F.sum("n").alias("total")))
    words = written(counts.filter(F.col("n") >= least))
    none = "lang string, " + _PHRASE + ", a long, l long, r long, n long, score long"
    found = read.sparkSession.createDataFrame([], none)
    byte, bit = F.expr(f"shiftright(h & {(1 << BITS) - 1}L, 3)"), F.expr("shiftleft(1, cast(h & 7L AS int))")
    held = words.groupBy(byte.alias("byte")).agg(F.bit_or(bit).alias("bits"))
    held = held.toArrow()  # at most 2^21 rows
    frequent = np.zeros(1 << (BITS - 3), np.uint8)
    frequent[held["byte"].to_numpy()] = held["bits"].to_numpy().astype(np.uint8)
    texts = written(encoded(read, frequent, seed))

    bound = F.floor(F.lit(1000) * F.col("total") / F.col("n"))  # of doubles: one too low at most
    frontier = words.join(totals, "lang").join(written(_cutoffs(words, totals, FIRST)), "lang", "left")
    frontier = written(frontier.select("h", "n", "lang", bound.alias("bound"), (F.col("n") <= F.coalesce("cutoff", F.lit(0))).alias("first")))
    for first in (True, False):
        last = _last_scores(found, top)
        open_words = frontier.filter(F.col("first") == first)
        if last:
            known = F.create_map(*[F.lit(x) for item in last.items() for x in item])
            open_words = open_words.filter(F.col("bound") + 1 >= F.coalesce(F.try_element_at(known, F.col("lang")), F.lit(0)))
        level = open_words.select(F.col("h").alias("h1"), *[F.lit(0).cast("long").alias(h) for h in HASHES[1:]])
        levels = []
        for length in range(1, LONGEST):
            level = grown(texts, level, length, least)
            if level is None or level.isEmpty():
                break
            levels.append(level)
        if not levels:
            continue
        candidates = levels[0]
        for more in levels[1:]:
            candidates = candidates.unionByName(more)
        ends = candidates.select(F.explode(_suffixes()).alias("cut")).filter("cut.end[1] <> 0")
        ends = _named(ends.select(F.col("cut.end").alias("end")), "end", HASHES)
        sought = written(candidates.select(*HASHES).unionByName(ends).distinct())
        around = surrounded(texts, sought)
        found = found.unionByName(written(scored(candidates, around, words, candidates, totals)))
    last = _last_scores(found, top)
    if last:
        known = F.create_map(*[F.lit(x) for item in last.items() for x in item])
        found = found.filter(F.col("score") >= F.coalesce(F.try_element_at(known, F.col("lang")), F.lit(0)))
    named = _with_words(found, words)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
