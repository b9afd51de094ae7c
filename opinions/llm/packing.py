"""Best-fit packing: the histogram of lengths is packed, then documents take the planned places by rank."""

from __future__ import annotations

import bisect
import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinions.llm import common
from opinions.llm.common import BYTES, grouped, with_rank, written
from opinions.llm.tokens import END as NO_PAIR
from opinions.llm.tokens import Merges, arranged, merged, ranked

CAPACITY = 4096
#: Id after every document.
END = 1
#: Words of each of the two generations whose ids a worker remembers, about 150 bytes each.
REMEMBERED = 150_000
#: Bytes of a long text that are split into words at once.
PART = 4_000_000


class Place(NamedTuple):
    """Documents of a length with ranks from ``first`` on take ``n`` places, ``per`` in each sequence."""

    length: int
    first: int
    n: int
    per: int
    sequence: int
    offset: int


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Place]:
    """Best fit, longest first, over counts of lengths instead of documents.

    Sequences with the same room are kept as ranges of numbers, so the work and the plan follow the
    number of different lengths (at most ``capacity``), not the number of documents.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []  # sorted keys of room
    places: list[Place] = []
    opened = 0

    def add(left: int, start: int, n: int) -> None:
        if left and n:
            if left not in room:
                bisect.insort(rooms, left)
                room[left] = []
            room[left].append((start, n))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError("a piece must fit a sequence")
        todo, rank = counts[length], 0
        while todo:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                n = -(-todo // (capacity // length))
                add(capacity, opened, n)
                opened += n
                continue
            left = rooms[at]
            start, n = room[left].pop()
            if not room[left]:
                del room[left], rooms[at]
            per = min(left // length, todo)
            full = min(n, todo // per)
            places.append(Place(length, rank, full * per, per, start, capacity - left))
            add(left - per * length, start, full)
            add(left, start + full, n - full)
            todo, rank = todo - full * per, rank + full * per
    return places


@functools.cache
def _tokenizer(path: str):
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


#: Words of Latin-1 letters as UTF-8, which a normalizer may put in lower case and no more.
LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: What may follow a word's last letter; the tokenizer parts it from the letter and keeps it together.
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _model_ids(tokenizer, word: bytes) -> bytes:
    """Ids of a word of LETTERS, from the model alone."""
    if word.isascii():
        text = word.lower().decode()
    else:
        text = word.decode().lower().encode().decode("latin-1").translate(BYTES)
    return _packed([t.id for t in tokenizer.model.tokenize(text)])


def _text_ids(tokenizer, text: bytes) -> bytes:
    return _packed(tokenizer.encode(text.decode(), add_special_tokens=False).ids)


@functools.cache
def _traits(path: str) -> tuple[bool, bool]:
    """Whether a text's ids are its words' ids, and whether words of letters can be told apart from marks
    behind them and be encoded by the model alone."""
    tokenizer = _tokenizer(path)
    probe = "The Thndou, of.  it's\n\tthe 4.0 \u00c9l\u00e8ve stra\u00dfe!! END.*** ''x'. a-|".encode()
    words = probe.split()
    wordwise = _text_ids(tokenizer, probe) == b"".join(_text_ids(tokenizer, w) for w in words)
    stems = [(w.rstrip(MARKS), w) for w in words if LETTERS.fullmatch(w.rstrip(MARKS))]
    return wordwise, wordwise and all(
        _text_ids(tokenizer, w) == _model_ids(tokenizer, stem) + _text_ids(tokenizer, w[len(stem) :]) for stem, w in stems
    )


class WordMerges(NamedTuple):
    """The merges of a vocabulary with word ends: the symbol of each byte inside a word and at its end."""

    inside: np.ndarray
    closing: np.ndarray
    table: Merges


@functools.cache
def _word_merges(path: str) -> WordMerges | None:
    """None for a vocabulary of another kind."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        return None
    vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
    letters = [chr(BYTES.get(b, b)) for b in range(256)]
    if not all(c in vocab and c + end in vocab for c in letters):
        return None
    size = max(vocab.values()) + 1
    parts = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    table = arranged([(vocab[a], vocab[b], vocab[a.removesuffix(end) + b if end else a + b]) for a, b in parts], size)
    inside, closing = (np.array([vocab[c + e] for c in letters], np.int32) for e in ("", end))
    return WordMerges(inside, closing, Merges(size, inside, None, *table, None, None))


def _ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of runs that begin at ``starts``, one after the other."""
    return np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))


#: Lower case of bytes: A-Z, and the second byte of a Latin-1 capital.
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(MARKS)] = True
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Second bytes of letters behind 0xC3.
_IS_SECOND = np.zeros(256, bool)
_IS_SECOND[[*range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)]] = True


def _stems(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words in lower case, their lengths, and how many bytes of letters stand before marks alone;
    0 where a word is built otherwise."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    lead = data == 0xC3
    second = np.r_[False, lead[:-1]] & _IS_SECOND[data]
    letter = _IS_LETTER[data] | second | (lead & np.r_[second[1:], False])
    starts = np.cumsum(lens) - lens
    sums = np.add.reduceat(letter, starts, dtype=np.int64)
    marks = np.add.reduceat(_IS_MARK[data], starts, dtype=np.int64)
    turns = letter[1:] & ~letter[:-1]  # a letter behind another byte
    turns = np.r_[False, turns]
    turns[starts] = False
    plain = (sums + marks == lens) & letter[starts] & (np.add.reduceat(turns, starts, dtype=np.int64) == 0)
    low = np.where(second & (data <= 0x9E), data + 32, _LOWER[data]).astype(np.uint8)
    return low, lens, np.where(plain, sums, 0)


def _batch_ids(low: np.ndarray, starts: np.ndarray, lens: np.ndarray, merges: WordMerges) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids and ids of words of letters in lower case, all merged together."""
    data, ends = low[_ragged(starts, lens)], np.cumsum(lens) - 1
    symbols = merges.inside[data]
    symbols[ends] = merges.closing[data[ends]]
    m = merges.table
    rank = np.append(ranked(symbols[:-1], symbols[1:], m.size, m.pairs, m.ranks), NO_PAIR).astype(np.int32)
    rank[ends] = NO_PAIR
    return merged(symbols, lens, rank, m)


class _Slots(dict):
    """Slots of words in the order of their first sight; new ones are kept in ``fresh`` until they are learned."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = len(self)
        self.fresh.append(word)
        return slot


class Known:
    """Ids of words, one after the other in an array. A full generation becomes the old one, from which words that are seen
    again are copied, so frequent words are encoded once."""

    def __init__(self, path: str):
        self.path = path
        self.tokenizer = _tokenizer(path)
        self.merges = _word_merges(path) if _traits(path)[1] else None
        self.marks: dict[bytes, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.old = (_Slots(), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4"))
        self.slots, (_, self.starts, self.lens, self.ids) = _Slots(), self.old

    def turn(self) -> None:
        if len(self.slots) > REMEMBERED:
            old = (self.slots, self.starts, self.lens, self.ids)
            self.clear()
            self.old = old

    def of_text(self, text: bytes) -> np.ndarray:
        """Slots of a text's words."""
        found, start = [], 0
        while len(text) - start > 2 * PART and (end := text.find(b" ", start + PART)) >= 0:
            words = text[start:end].split()
            found.append(np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words)))
            self.learn()
            start = end
        words = (text[start:] if start else text).split()
        found.append(np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words)))
        return found[0] if len(found) == 1 else np.concatenate(found)

    def learn(self) -> None:
        """Add the ids of all fresh words."""
        words, self.slots.fresh = self.slots.fresh, []
        if not words:
            return
        n = len(words)
        slots, starts, lens, ids = self.old
        told = np.fromiter((slots.get(w, -1) for w in words), np.int64, n) if slots else np.full(n, -1)
        first = np.zeros(n, np.int64)  # ids of the word, or of its letters
        behind = np.zeros(n, np.int64)  # ids of the marks behind its letters
        kept = np.flatnonzero(told >= 0)
        first[kept] = lens[told[kept]]
        rest = np.flatnonzero(told < 0)
        absent = [words[i] for i in rest.tolist()]
        letters = np.zeros(len(absent), np.int64)
        if self.merges and absent:
            low, sizes, letters = _stems(absent)
        plain = np.flatnonzero(letters > 0)
        tails: list[np.ndarray] = []
        marked = plain[:0]
        if len(plain):
            begin = np.cumsum(sizes) - sizes
            first[rest[plain]], stem_ids = _batch_ids(low, begin[plain], letters[plain], self.merges)
            marked = plain[letters[plain] < sizes[plain]]
            for i, k in zip(marked.tolist(), letters[marked].tolist()):
                mark = absent[i][k:]
                if mark not in self.marks:
                    self.marks[mark] = np.frombuffer(_text_ids(self.tokenizer, mark), "<u4")
                tails.append(self.marks[mark])
            behind[rest[marked]] = list(map(len, tails))
        odd = np.flatnonzero(letters == 0)
        others = [np.frombuffer(_text_ids(self.tokenizer, absent[i]), "<u4") for i in odd.tolist()]
        first[rest[odd]] = list(map(len, others))

        total = first + behind
        place = np.cumsum(total) - total
        new = np.empty(int(total.sum()), "<u4")
        new[_ragged(place[kept], first[kept])] = ids[_ragged(starts[told[kept]], first[kept])]
        if len(plain):
            new[_ragged(place[rest[plain]], first[rest[plain]])] = stem_ids
        if tails:
            new[_ragged((place + first)[rest[marked]], behind[rest[marked]])] = np.concatenate(tails)
        if others:
            new[_ragged(place[rest[odd]], first[rest[odd]])] = np.concatenate(others)
        self.starts = np.append(self.starts, len(self.ids) + place)
        self.lens = np.append(self.lens, total)
        self.ids = np.append(self.ids, new)


@functools.cache
def _known(path: str) -> Known:
    known = Known(path)
    common.REMEMBERED.append(known)
    return known


def encoded(texts: list[bytes], path: str) -> Iterator[bytes]:
    """Ids of every UTF-8 text, as little-endian unsigned 32-bit numbers.

    Where a tokenizer drops white space and never joins what it separates, each word is encoded once and
    remembered, and a text is the concatenation of its words' ids. Any other tokenizer gets whole texts.
    """
    if not _traits(path)[0]:
        yield from (_text_ids(_tokenizer(path), t) for t in texts)
        return
    known = _known(path)
    known.turn()
    slots = [known.of_text(t) for t in texts]
    known.learn()
    for s in slots:
        yield known.ids[_ragged(known.starts[s], known.lens[s])].tobytes()


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end: int = END,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Ids of whole texts, cut only where a document is longer than a sequence: key, piece, start, length, ids_crc32.

    Each document ends with ``end``; a null or empty text is that id alone. ``keep_ids`` adds the ids.
    """
    fields = [
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    closing = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).cast(pa.binary())
            row = 0
            for run in grouped(t.as_py() for t in texts):
                rows, out = [], ([], [], [], [], [])
                for ids in encoded(run, tokenizer):
                    ids += closing
                    for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        rows.append(row)
                        for values, x in zip(out, (i, at // 4, len(part) // 4, zlib.crc32(part), part)):
                            values.append(x)
                    row += 1
                made = [pa.array(out[0], pa.int32())] + [pa.array(v, pa.int64()) for v in out[1:4]]
                if keep_ids:
                    made.append(pa.array(out[4], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows, pa.int64())), *made], names=[f.name for f in fields]
                )

    return docs.select(key, F.col(text).cast("string")).mapInArrow(cut, T.StructType(fields))


def packed(cut: DataFrame, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """Add sequence_id and offset to pieces; sequences have at most ``capacity`` ids and no gaps.

    The counts of lengths (at most ``capacity`` rows) go to the driver and are planned there. Pieces are
    ranked within their length, in parts, so a length that a third of all pieces have is no task's alone,
    and join the plan on length and rank. The plan grows with the number of lengths only; it is broadcast.
    Rows that repeat a key are documents of their own; an empty table gives no rows.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(
        plan(counts, capacity), "_length long, first long, n long, per long, base long, room long"
    )
    ranked = with_rank(cut, ["length"], [key, "piece"], "_rank")
    taken = ranked.join(
        F.broadcast(places),
        (F.col("length") == F.col("_length"))
        & (F.col("_rank") >= F.col("first"))
        & (F.col("_rank") < F.col("first") + F.col("n")),
    )
    nth = F.col("_rank") - F.col("first")
    return taken.select(
        *cut.columns,
        (F.col("base") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("room") + (nth % F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )


def sequences(placed: DataFrame) -> DataFrame:
    """Token sequences of pieces that carry their ids: sequence_id, length, ids (little-endian, 32 bits each)."""
    part = F.struct("offset", "length", "ids")
    held = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return held.select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("length"),
        F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"),
    )


def best_fit(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Pack whole documents into as few sequences of ``capacity`` ids as best fit finds.

    Returns per piece key, piece, start, length, ids_crc32, sequence_id, offset. Texts are encoded once;
    what is shuffled are the narrow pieces. Only documents longer than a sequence are cut. Null and empty texts
    are one id, a null key is a key, other columns are ignored.
    """
    cut = pieces(docs, tokenizer, capacity, END, key, text, keep_ids)
    return packed(written(cut), capacity, key)
