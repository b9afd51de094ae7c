"""Repaired conversations against a search of all edits in the order of cost and audit."""

import hashlib
import heapq
import random
import zlib

import numpy as np
import pytest

from opinions.llm import queries, repair

STEP = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    out = []
    for i, (role, text) in enumerate(rows):
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in rows[:i] else None if bare[-1] in ".!?" else "truncated")
    return out


def searched(rows):
    """Cost, audit and turns of the first end that a search by (cost, audit) reaches."""
    bad = faults(rows)
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, said = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, list(said)
        if (i, state) in done:
            continue
        done.add((i, state))
        for name in ("user", "assistant"):
            if name[0] in STEP[state]:
                heapq.heappush(queue, (cost + 3, audit + "I", i, name[0], said + ((name, ""),)))
        if i == len(rows):
            continue
        heapq.heappush(queue, (cost + 4, audit + "D", i + 1, state, said))
        if bad[i] in ("blank", "duplicate"):
            continue
        role, text = rows[i]
        more = 3 * (bad[i] == "truncated")
        if role[:1] in STEP[state]:
            heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[0], said + ((role, text),)))
        for name in ("user", "assistant"):
            if name[0] in STEP[state]:
                heapq.heappush(queue, (cost + 3 + more, audit + "R", i + 1, name[0], said + ((name, text),)))


def plain(rows):
    """All result columns but the key, from (turn, role, text) in any order."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    said = [r[1:] for r in rows]
    bad = faults(said)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
    cost, audit, turns = searched(said)
    return (len(rows), gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit, turns)


def read(rows):
    return {r["conv_id"]: (*tuple(r)[1:9], [tuple(t) for t in r["turns"]]) for r in rows}


def conversation(rng):
    roles = rng.choice([["user", "assistant"], ["user", "assistant", "system", "tool"], ["system", "assistant"], ["user", None, "", "ux"]])
    words = ["a.", "b!", "c", "d? ", " ", "", None, "e.", "f", "g"]
    n = rng.choice([0, 1, 2, 3, 5, 8, 14])
    return [(rng.choice([i, i, i, None, 40]), rng.choice(roles), rng.choice(words) if rng.random() < 0.5 else f"t{i}.") for i in range(n)]


def test_conversations_equal_the_search(spark):
    rng = random.Random(1)
    talks = {c: conversation(rng) for c in range(400)}
    rows = [(c, *r) for c, talk in talks.items() for r in talk]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert read(repair.repaired(df).collect()) == {c: plain(t) for c, t in talks.items() if t}


@pytest.mark.parametrize("seed", range(3))
def test_plans_of_long_conversations(seed):
    """Thousands of rows beside short ones: the cost, that the audit gives a legal order and costs that much."""
    rng = np.random.default_rng(seed)
    lens = np.array([5000, 3, 0, 700, 1])
    n = lens.sum()
    initial, banned, cut = rng.integers(0, 4, n), rng.random(n) < 0.1, (rng.random(n) < 0.2).astype(np.int64)
    cut[banned] = 0
    plan = repair.planned(initial, banned, cut, lens)
    at, first = 0, 0
    for c, k in enumerate(lens):
        state, row, cost = 0, first, 0
        for j in range(at, at + plan.size[c]):
            letter = plan.letter[j]
            assert plan.row[j] == row
            cost += {repair.D: 4, repair.I: 3, repair.K: 0, repair.R: 3}[letter]
            if letter in (repair.K, repair.R):
                assert not banned[row]
                cost += 3 * cut[row]
            state = state if letter == repair.D else repair.KEEP[state, initial[row]] if letter == repair.K else repair.NEXT[state]
            assert state == plan.state[j] and state >= 0
            row += letter != repair.I
        assert row == first + k and state in (0, 3) and cost == plan.cost[c]
        at, first = at + plan.size[c], first + k


def test_odd_tables(spark):
    schema = "conv_id long, turn int, role string, text string, _key string, audit string, here boolean"
    rows = [(None, 1, "user", "x.", "k", "a", True), (None, 2, "assistant", "y.", "k", "a", True), (1, 0, "user", "z.", "k", "a", False),
            (2, None, None, None, None, None, None), (3, 5, "user", "long " * 200_000 + ".", "k", "a", True)]
    df = spark.createDataFrame(rows, schema)
    got = read(repair.repaired(df, present="here").collect())
    assert got[None] == (2, 0, 0, 0, 0, 0, 0, "KK", [("user", "x."), ("assistant", "y.")])
    assert got[1] == got[2] == (0, 0, 0, 0, 0, 0, 0, "", [])
    assert got[3][6:8] == (3, "KI")
    assert repair.repaired(df.limit(0)).count() == 0


def test_whole_table(spark, sf):
    """The query against the damage written out row by row."""
    talks = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        conv, turn, role, text = (" " if r[c] is None else r[c] for c in ("conv_id", "turn", "role", "text"))
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        row = (r["turn"], "user" if kind == 4 else role, text)
        talks.setdefault(r["conv_id"], []).extend([row] * {0: 0, 3: 2}.get(kind, 1))
    want = {}
    for c, rows in talks.items():
        _, gaps, blank, duplicate, truncated, illegal, cost, audit, turns = plain(rows)
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in turns).encode()).hexdigest()
        want[c] = (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r["conv_id"]: tuple(r[n] for n in names) for r in queries.QUERIES["op13_repair"](spark, sf).collect()}
    assert got == want
