"""Token counts by rank-synchronous merging: all pre-tokens of a batch are ragged arrays of symbols, and every round merges,
in each of them at once, the pair of lowest rank that it holds."""

from __future__ import annotations

import functools
import itertools
import json
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinions.llm import common
from opinions.llm.common import BYTES, grouped

LIMIT = 512
#: Pre-tokens of each of the two generations that a worker remembers, some 120 bytes each.
REMEMBERED = 300_000
#: Pre-tokens of a text that are held at once.
HELD = 200_000
#: Rank of a pair that never merges, and of the last symbol of a sequence, which has no pair.
NEVER, END = 2**31 - 2, 2**31 - 1

_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# --- Fixed value: the published pattern that byte-level vocabularies split texts with, white space written out ---
PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# -----------------------------------------------------------------------------------------------------------------
#: Characters whose classes are the same in every version of Unicode that a library may hold.
STABLE = regex.compile(r"[\x00-\u024f\u2000-\u2064\u3000-\u3003\u4e00-\u9fa5\uac00-\ud7a3]*")


class Merges(NamedTuple):
    """A vocabulary as arrays. ``ranks`` of the sorted ``pairs`` (left * size + right); ``result`` by rank."""

    size: int
    letters: np.ndarray
    first: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    result: np.ndarray
    #: Ranks whose result takes part in a merge of lower rank: such merges are made one by one.
    single: np.ndarray
    special: regex.Pattern | None
    library: object


def arranged(merges: Sequence[tuple[int, int, int]], size: int) -> tuple[np.ndarray, ...]:
    """pairs, ranks, result, single of merges (left, right, result) in the order of their rank."""
    left, right, result = (np.array([m[i] for m in merges], np.int64) for i in range(3))
    key = left * size + right
    order = np.argsort(key, kind="stable")
    used = np.full(size, NEVER, np.int64)
    rank = np.arange(len(merges))
    np.minimum.at(used, left, rank)
    np.minimum.at(used, right, rank)
    return key[order], order.astype(np.int32), result.astype(np.int32), used[result] < rank


@functools.cache
def loaded(path: str) -> Merges:
    """A byte-level vocabulary with merges, as the tokenizers library stores it; others are refused."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    model, split = stored["model"], stored["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    odd = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    added = stored["added_tokens"]
    if model["type"] != "BPE" or not plain or odd or stored["normalizer"] or any(
        a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added
    ):
        raise ValueError("only byte-level vocabularies with plain merges are known here")
    vocab = model["vocab"]
    size = max(vocab.values()) + 1
    parts = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    table = arranged([(vocab[a], vocab[b], vocab[a + b]) for a, b in parts], size)
    letters = np.array([vocab[chr(BYTES.get(b, b))] for b in range(256)], np.int32)
    first = ranked(letters.repeat(256), np.tile(letters, 256), size, *table[:2]).reshape(256, 256)
    names = sorted((a["content"] for a in added), key=len, reverse=True)
    special = regex.compile("|".join(map(regex.escape, names))) if names else None
    return Merges(size, letters, first, *table, special, Tokenizer.from_file(path))


def ranked(left: np.ndarray, right: np.ndarray, size: int, pairs: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Ranks of pairs of symbols."""
    key = left.astype(np.int64) * size + right
    if not len(pairs):
        return np.full(len(key), NEVER, np.int32)
    at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
    return np.where(pairs[at] == key, ranks[at], NEVER).astype(np.int32)


def merged(symbols: np.ndarray, lens: np.ndarray, rank: np.ndarray, m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """How many symbols are left of each sequence when nothing merges any more, and these symbols.

    ``symbols`` holds the sequences one after the other, ``lens`` (all above 0) their lengths and ``rank`` the rank of every
    symbol with its successor. A sequence's places of its lowest rank merge together, from the left where they overlap;
    only if the new symbol could merge at a lower rank still is its first place merged alone. So each round does to every
    sequence what merging one pair after the other would do. Finished sequences leave the arrays.
    """
    out = lens.astype(np.int64)
    which = np.arange(len(lens))
    lens = lens.astype(np.int64)
    owner, left = [which[:0]], [symbols[:0]]
    while len(lens):
        starts = np.cumsum(lens) - lens
        low = np.minimum.reduceat(rank, starts)
        live = low < NEVER
        if not live.all():
            out[which[~live]] = lens[~live]
            kept = live.repeat(lens)
            owner.append(which[~live].repeat(lens[~live]))
            left.append(symbols[~kept])
            symbols, rank, lens, which, low = symbols[kept], rank[kept], lens[live], which[live], low[live]
            if not len(lens):
                break
            starts = np.cumsum(lens) - lens
        hit = rank == low.repeat(lens)
        if (hit[1:] & hit[:-1]).any():  # a pair of equal symbols in a run of them
            places = np.flatnonzero(hit)
            begins = np.r_[True, np.diff(places) != 1]
            run = np.cumsum(begins) - 1
            hit[places[(np.arange(len(places)) - np.flatnonzero(begins)[run]) % 2 == 1]] = False
        alone = m.single[low]
        if alone.any():
            places = np.flatnonzero(hit)
            holder = np.searchsorted(starts, places, "right") - 1
            later = np.r_[False, holder[1:] == holder[:-1]]
            hit[places[later & alone[holder]]] = False
        places = np.flatnonzero(hit)
        symbols[places] = m.result[rank[places]]
        ends = rank[places + 1] == END
        lens = lens - np.add.reduceat(hit, starts, dtype=np.int64)
        kept = np.ones(len(symbols), bool)
        kept[places + 1] = False
        symbols, rank = symbols[kept], rank[kept]
        now = places - np.arange(len(places))  # where the merged symbols stand after the removal
        rank[now[ends]] = END
        before = now[now > 0] - 1
        changed = np.r_[now[~ends], before[rank[before] != END]]
        rank[changed] = ranked(symbols[changed], symbols[changed + 1], m.size, m.pairs, m.ranks)
    return out, np.concatenate(left)[np.argsort(np.concatenate(owner), kind="stable")]


def survivors(symbols: np.ndarray, lens: np.ndarray, rank: np.ndarray, m: Merges) -> np.ndarray:
    """Symbols that are left of each sequence."""
    return merged(symbols, lens, rank, m)[0]


def word_counts(words: Sequence[str], m: Merges) -> list[int]:
    """Tokens of each pre-token."""
    raw = [w.encode() for w in words]
    lens = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    if not len(data):
        return []
    rank = np.append(m.first[data[:-1], data[1:]], END).astype(np.int32)
    rank[np.cumsum(lens) - 1] = END
    return survivors(m.letters[data], lens, rank, m).tolist()


def pre_tokens(text: str, m: Merges) -> Iterator[list[str]]:
    """The pre-tokens of a text, in runs of HELD at most."""
    if not STABLE.fullmatch(text):
        yield [text[a:b] for _, (a, b) in m.library.pre_tokenizer.pre_tokenize_str(text)]
    elif len(text) <= 4 * HELD:
        yield PATTERN.findall(text)
    else:
        found = (x.group() for x in PATTERN.finditer(text))
        while run := list(itertools.islice(found, HELD)):
            yield run


class Counter:
    """Counts tokens; remembers pre-tokens in two generations, so frequent ones stay when the table is full."""

    def __init__(self, path: str):
        self.merges = loaded(path)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        common.REMEMBERED += [self.young, self.old]

    def _learn(self, words: set[str]) -> None:
        if len(self.young) > REMEMBERED:
            self.old.clear()
            self.old.update(self.young)
            self.young.clear()
        new = words - self.young.keys()
        told = new & self.old.keys()
        for w in told:
            self.young[w] = self.old[w]
        fresh = list(new - told)
        self.young.update(zip(fresh, word_counts(fresh, self.merges)))

    def _sum(self, runs: list[list[str]]) -> list[int]:
        self._learn(set().union(*runs))
        return [sum(map(self.young.__getitem__, run)) for run in runs]

    def counts(self, texts: Iterable[str]) -> list[int]:
        """Tokens of every text. Special strings are one token and part what stands around them."""
        out: list[int] = []
        held: list[list[str]] = []
        owner: list[int] = []
        size = 0
        for n, text in enumerate(texts):
            special = self.merges.special
            parts = special.split(text) if special else [text]
            out.append(len(parts) - 1)
            for run in itertools.chain.from_iterable(pre_tokens(p, self.merges) for p in parts if p):
                held.append(run)
                owner.append(n)
                size += len(run)
                if size >= HELD:
                    for i, x in zip(owner, self._sum(held)):
                        out[i] += x
                    held, owner, size = [], [], 0
        for i, x in zip(owner, self._sum(held)):
            out[i] += x
        return out


@functools.cache
def _counter(path: str) -> Counter:
    return Counter(path)


def counted(docs: DataFrame, tokenizer: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_tokens, over_limit of every row's whole text, as the vocabulary's library counts tokens.

    Nothing is shuffled. A null or empty text has no bytes and no tokens, repeated rows are counted one by one, a null key is a
    key, other columns are ignored, and an empty table gives an empty result. A very long text is read in runs
    of pre-tokens; a very long pre-token takes a round for each different rank that merges in it.
    """
    fields = [
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary())
            n_tokens: list[int] = []
            for run in grouped(x.as_py() for x in raw):
                n_tokens += counter.counts(t.decode() for t in run)
            tokens = pa.array(n_tokens, pa.int64())
            size = pc.fill_null(pc.cast(pc.binary_length(raw), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size, tokens, pc.greater(tokens, limit)], names=[f.name for f in fields]
            )

    return docs.select(key, F.col(text).cast("string")).mapInArrow(count, T.StructType(fields))
