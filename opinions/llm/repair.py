"""Conversation structure repair: the cheapest edits that give a conversation a legal order of roles, and of those with equal
cost the ones whose audit comes first.

Costs come from a backward dynamic programme over (row, state). The arcs that keep to the least cost form a graph, whose
nodes are ranked by the audit that starts there: first by one letter, then by two, four and so on, a node's pointer doubling
along. The ranks choose each node's arc, and the doubled pointers read the paths of all conversations at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What an edit costs, and an undeleted row whose text is cut off.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: Edits by their initials in the order of ASCII; 0 ends an audit.
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
D, I, K, R = 1, 2, 3, 4  # noqa: E741
#: States: nothing said, system, user, assistant. Where the next user or assistant turn leads, and what a role leads to.
NEXT = np.array([2, 2, 3, 2])
NO = -1
KEEP = np.array([[1, 2, NO, NO], [NO, 2, NO, NO], [NO, NO, 3, NO], [NO, 2, NO, NO]])  # state, initial s u a other
SPOKEN = {2: "user", 3: "assistant"}
FAR = 1 << 40
SPACE = " \t\n\x0b\x0c\r"
CLOSING = (".", "!", "?")


class Plan(NamedTuple):
    """Per conversation ``cost`` and ``size``, the number of edits; per edit its letter, the row it edits or is
    inserted before, and the state after it."""

    cost: np.ndarray
    size: np.ndarray
    letter: np.ndarray
    row: np.ndarray
    state: np.ndarray


def costs(initial: np.ndarray, banned: np.ndarray, cut: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Least cost from before each row on, for each state; a conversation has a row of costs more than rows.

    Conversations take each step together, from their ends; long ones go on while short ones are done.
    """
    first = np.cumsum(lens) - lens
    node = first + np.arange(len(lens))
    out = np.empty((len(initial) + len(lens), 4), np.int64)
    order = np.argsort(-lens, kind="stable")
    now = np.tile(np.array([0, 2 * INSERT, INSERT, 0], np.int64), (len(lens), 1))
    out[(node + lens)[order]] = now
    longest = lens[order]
    for step in range(int(longest[0]) if len(lens) else 0):
        k = int(np.searchsorted(-longest, -step, "left"))  # conversations with more rows than steps
        chosen = order[:k]
        at = first[chosen] + lens[chosen] - 1 - step
        after = now[:k]
        kept = KEEP[:, initial[at]].T
        extra = np.where(banned[at], FAR, CUT * cut[at])[:, None]
        keep = np.where(kept == NO, FAR, np.take_along_axis(after, np.maximum(kept, 0), 1)) + extra
        best = np.minimum(np.minimum(after + DELETE, keep), after[:, NEXT] + REROLE + extra)
        u, a = np.minimum(best[:, 2], best[:, 3] + INSERT), np.minimum(best[:, 3], best[:, 2] + INSERT)
        now[:k] = np.stack([np.minimum(best[:, 0], u + INSERT), np.minimum(best[:, 1], u + INSERT), u, a], 1)
        out[node[chosen] + lens[chosen] - 1 - step] = now[:k]
    return out


def arcs(cost: np.ndarray, initial: np.ndarray, banned: np.ndarray, cut: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Target of the optimal arc of each letter out of each node (four to a row of ``cost``), NO where there is none."""
    n = len(cost)
    last = np.zeros(n, bool)
    last[np.cumsum(lens + 1) - 1] = True
    rows = np.flatnonzero(~last)
    out = np.full((n, 4, 5), NO, np.int64)
    here = np.arange(n)[:, None] * 4
    out[:, :, I] = np.where(cost == cost[:, NEXT] + INSERT, here + NEXT, NO)
    now, after, below = cost[rows], cost[rows + 1], (rows + 1)[:, None] * 4
    free = ~banned[:, None]
    extra = (CUT * cut)[:, None]
    out[rows, :, D] = np.where(now == after + DELETE, below + np.arange(4), NO)
    kept = KEEP[:, initial].T
    fits = free & (kept != NO) & (now == np.take_along_axis(after, np.maximum(kept, 0), 1) + extra)
    out[rows, :, K] = np.where(fits, below + kept, NO)
    out[rows, :, R] = np.where(free & (now == after[:, NEXT] + REROLE + extra), below + NEXT, NO)
    return out.reshape(4 * n, 5)


def ranks(letter: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Rank of every node by its whole audit, its pointers over 1, 2, 4, ... letters, and the length of its audit.

    The letters out of a node differ, so its least letter leads to one node, and the least audit of twice the length is the
    least one from here and then the least one from where that ends.
    """
    rank, pointers, length = letter.astype(np.int64), [target], (letter > 0).astype(np.int64)
    while True:
        jump = pointers[-1]
        length = length + length[jump]
        _, rank = np.unique(rank * (len(rank) + 5) + rank[jump], return_inverse=True)
        if not letter[jump].any():  # every audit has come to its end
            return rank, pointers, length
        pointers.append(jump[jump])


def planned(initial: np.ndarray, banned: np.ndarray, cut: np.ndarray, lens: np.ndarray) -> Plan:
    """The cheapest edits of conversations, whose rows stand one after the other."""
    lens = lens.astype(np.int64)
    cost = costs(initial, banned, cut, lens)
    out = arcs(cost, initial, banned, cut, lens)
    nodes = np.arange(len(out))
    some = out[:, 1:] != NO
    letter = np.where(some.any(1), some.argmax(1) + 1, 0)
    rank, _, _ = ranks(letter, np.where(letter > 0, out[nodes, letter], nodes))
    # Of each node's arcs the one whose letter and remaining audit come first.
    order = np.where(out == NO, FAR * 8, np.arange(5) * (len(out) + 1) + rank[np.maximum(out, 0)])
    letter = np.where(some.any(1), order.argmin(1), 0)
    target = np.where(letter > 0, out[nodes, letter], nodes)
    _, pointers, length = ranks(letter, target)
    roots = 4 * (np.cumsum(lens + 1) - lens - 1)
    size = length[roots]
    owner = np.arange(len(lens)).repeat(size)
    step = np.arange(len(owner)) - (np.cumsum(size) - size).repeat(size)
    place = roots[owner]
    for bit, jump in enumerate(pointers):
        odd = (step >> bit) & 1 == 1
        place[odd] = jump[place[odd]]
    return Plan(cost[roots // 4, 0], size, letter[place], place // 4 - owner, target[place] % 4)


def _code(role: str) -> int:
    return {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)


def _faults(roles: Sequence[str], texts: Sequence[str]) -> list[int]:
    """First fault of each row of a conversation: 1 blank, 2 duplicate, 3 cut off, 0 none."""
    seen: set[tuple[str, str]] = set()
    out = []
    for said in zip(roles, texts):
        bare = said[1].rstrip(SPACE)
        out.append(1 if not bare else 2 if said in seen else 0 if bare.endswith(CLOSING) else 3)
        seen.add(said)
    return out


def repaired(
    turns: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: str | None = None,
) -> DataFrame:
    """key, n_turns, gaps, blank, duplicate, truncated, illegal, cost, audit, turns per conversation.

    Rows stand in the order of their turn, nulls first, then by role and text. ``gaps`` counts turn numbers that are missing
    between the first and the last; a row's first fault counts: no visible character, role and text seen before, no
    ``.``, ``!`` or ``?`` at the end. ``illegal`` counts neighbours whose role initials are not su, ua or au. ``turns``, an array of
    role and text, is the conversation after the edits whose initials are the ``audit``: Keep, Rerole, Delete (blank
    and duplicate rows must go) and Insert. Its role initials are ``(s?(ua)+)?``.

    A null role or text is one space, a null key is a key, repeated rows are duplicates, other columns are ignored and an
    empty table gives none. Rows where the column ``present`` is not true don't count, but their conversation is returned,
    without turns if it has no others. A conversation is one row and thus one task's work.
    """
    said = F.struct(
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    if present is not None:
        said = F.when(F.col(present), said)
    rows = turns.select(F.col(key).alias("_key"), said.alias("_said"))
    held = rows.groupBy("_key").agg(F.sort_array(F.collect_list("_said")).alias("_rows"))
    numbers = ("n_turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    spoken = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    schema = T.StructType(
        [
            T.StructField(key, turns.schema[key].dataType),
            *[T.StructField(n, T.LongType()) for n in numbers],
            T.StructField("audit", T.StringType()),
            T.StructField("turns", spoken),
        ]
    )
    names = schema.fieldNames()

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                yield _repaired_batch(batch.column(0)[at : at + 1000], batch.column(1)[at : at + 1000], names)

    return held.mapInArrow(repair, schema)


def _sums(values: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Sum of each run of values."""
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(lens)
    return total[ends] - total[ends - lens]


def _repaired_batch(keys: pa.Array, held: pa.ListArray, names: Sequence[str]) -> pa.RecordBatch:
    lens = held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = held.flatten()
    numbers, roles, texts = flat.field(0), flat.field(1).to_pylist(), flat.field(2)
    plain = texts.to_pylist()
    ends = np.cumsum(lens)
    first = ends - lens
    fault = np.array([f for a, b in zip(first, ends) for f in _faults(roles[a:b], plain[a:b])], np.int64)
    initial = np.fromiter(map(_code, roles), np.int64, len(roles))
    known = ~numbers.is_null().to_numpy(zero_copy_only=False)
    turn = numbers.fill_null(0).to_numpy(zero_copy_only=False)
    gaps = np.zeros(len(lens), np.int64)
    for c, (a, b) in enumerate(zip(first, ends)):
        there = turn[a:b][known[a:b]]
        if len(there):
            gaps[c] = int(there.max()) - int(there.min()) + 1 - len(np.unique(there))
    follows = np.ones(len(roles), bool)
    follows[first[lens > 0]] = False
    legal = np.zeros(len(roles), bool)
    before, here = initial[:-1], initial[1:]
    legal[1:] = ((here == 1) & ((before == 0) | (before == 2))) | ((before == 1) & (here == 2))
    plan = planned(initial, (fault == 1) | (fault == 2), (fault == 3).astype(np.int64), lens)

    stop = np.cumsum(plan.size)
    letters = LETTERS[plan.letter].tobytes().decode()
    audit = [letters[b - n : b] for b, n in zip(stop.tolist(), plan.size.tolist())]
    stays = plan.letter != D
    source = np.where(plan.letter == I, -1, plan.row)[stays]
    said = [
        roles[row] if letter == K else SPOKEN[state]
        for letter, row, state in zip(plan.letter[stays].tolist(), source.tolist(), plan.state[stays].tolist())
    ]
    words = texts.take(pa.array(source, pa.int64(), mask=source < 0)).fill_null("").cast(pa.string())
    spoken = pa.StructArray.from_arrays([pa.array(said, pa.string()), words], names=["role", "text"])
    offsets = np.r_[0, np.cumsum(_sums(stays, plan.size))]
    columns = [
        keys,
        *[
            pa.array(x, pa.int64())
            for x in (lens, gaps, *[_sums(fault == f, lens) for f in (1, 2, 3)], _sums(follows & ~legal, lens), plan.cost)
        ],
        pa.array(audit, pa.string()),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spoken),
    ]
    return pa.RecordBatch.from_arrays(columns, names=list(names))
