"""Rules against the patterns as stated, the tagger against its slope, all paths and held-out spans."""

import hashlib
import itertools
import random
import time
import re

import numpy as np
import pytest

import __spark_entry__ as entry
from opinions.llm import pii, tagger

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * 2 if i % 2 else int(c) for i, c in enumerate(digits[::-1])]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_rules_equal_the_patterns():
    rng = random.Random(0)
    bits = ["a", "b.c", "@", "@x.de", ".", "-", " ", "+1", "(", ")", "4111 1111 1111 1111", "4111111111111112", "1.2.3.4", "255", "256",
            "0", "9", "12", "+49 (30) 555-2671", "+", "é", "_%", "1.2", "0000000000000000", "\n", "@@", "a@b", "00001.02.3.4"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_rules_take_linear_time():
    for part in ("a", "1", "1.", "@", "a@", "+1", "1-", "a.", "a@a.", "1 "):
        pii.base_spans(part * 200_000)


def test_slope_of_the_loss():
    rng = np.random.default_rng(0)
    small = tagger.Tagger.fresh(5, 4, 3)
    small = tagger.Tagger({n: v.astype(np.float64) for n, v in small.theta.items()}, 5)
    codes = rng.integers(0, tagger.SYMBOLS, (3, 7))
    tags = np.array([[0, 1, 2, 2, 0, 3, 4], [1, 0, 3, 0, 0, 1, 2], [0] * 7])
    _, slope = tagger.loss_and_slope(small, codes, tags)
    for name, value in small.theta.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            at = (int(codes[0, 2]), at[1]) if name == "embed" else at
            ends = []
            for step in (1e-2, -1e-2):
                moved = value.copy()
                moved[at] += step
                ends.append(tagger.loss_and_slope(tagger.Tagger({**small.theta, name: moved}, 5), codes, tags)[0])
            assert slope[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-2, abs=4e-3), name


def test_decoding_equals_the_best_of_all_paths():
    rng = np.random.default_rng(2)
    small = tagger.Tagger.fresh(3, 4, 3)
    small.theta["move"][:] = rng.normal(size=(3, 3))
    codes = rng.integers(0, tagger.SYMBOLS, (4, 5))
    path, sure = tagger.decoded(small, codes)
    for row in range(4):
        losses = {}
        for tags in itertools.product(range(3), repeat=5):
            losses[tags] = tagger.loss_and_slope(small, codes[row : row + 1], np.array([tags]))[0]
        best = min(losses, key=losses.get)
        assert path[row].tolist() == list(best)
        for t in range(5):
            share = sum(np.exp(-v) for k, v in losses.items() if k[t] == best[t])
            assert sure[row][t] == pytest.approx(share, abs=1e-3)


def test_windows_and_reconciliation():
    text = "x" * 100 + " 4.0 " + "y" * 200 + "a@b.de"
    base = pii.base_spans(text)
    assert pii.open_windows(text, base) == [48, 96]
    assert pii.open_windows("1.2.3.4", [(0, 1, 7)]) == []
    spans = {(0, 3, 12): 0.9, (5, 2, 20): 1.5, (30, 0, 40): 0.6, (50, 3, 62): 0.7}
    assert pii.reconciled(spans, [(38, 0, 45)]) == [(5, 2, 20), (50, 3, 62)]
    assert pii.redacted("call +1 now", [(5, 3, 7)]) == "call <phone> now"


@pytest.fixture(scope="module")
def model(spark):
    return pii.fitted(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_learned_spans(spark, sf, model):
    """Forms that no rule knows are found in documents that were not seen, and next to nothing else."""
    rng = random.Random(1)
    hits = false = total = 0
    for i in range(60):
        filler = " ".join(rng.choice(["thndou", "the", "anre,", "ofhe.", "Inth"]) for _ in range(60))
        phone = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        at = rng.randint(0, len(filler))
        text = f"{filler[:at]} {phone} {filler[at:]} Version 2.0."
        found = pii.proposals(model, [(0, w, text[w : w + 96], w == 0, w + 96 >= len(text)) for w in pii.open_windows(text, [])])
        spans = pii.reconciled(found.get(0, {}), [])
        want = (at + 1, 3, at + 1 + len(phone))
        total += 1
        hits += want in spans
        false += sum(s != want for s in spans)
    assert hits >= 0.8 * total and false <= 0.1 * total


def test_odd_rows(spark, texts, model):
    rows = [(1, None), (2, ""), (None, "jd@x.org"), (3, "é +1 (415) 555-2671"), (3, "é +1 (415) 555-2671"), (4, "a " * 60_000 + "1.2.3.4")]
    got = pii.found(texts(rows), model, redact=True)
    assert got.columns == ["doc_id", "base", "added", "redacted"]
    rows_got = sorted(got.collect(), key=repr)
    assert len(rows_got) == 6
    by = {r["doc_id"]: r for r in rows_got}
    assert by[3]["base"] == [("phone", 2, 19)] and by[3]["redacted"] == "é <phone>"
    assert by[4]["base"] == [("ip", 120_000, 120_007)] and by[1]["base"] == [] and by[None]["base"] == [("email", 0, 8)]
    assert pii.found(texts([]), model).count() == 0
    assert pii.fitted(texts([])).tags == 9


def test_query(spark, sf):
    got = {r["doc_id"]: r for r in entry.queries()["op1_pii"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        spans = plain_spans(r["text"] or "")
        listed = [f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in spans]
        row = got[r["doc_id"]]
        assert [row[f"n_{k}"] for k, _ in PATTERNS] == [sum(s[1] == i for s in spans) for i in range(4)]
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row["spans"].split(","))  if listed else True
        starts = [int(s.split(":")[1]) for s in row["spans"].split(",") if s]
        assert starts == sorted(starts) and len(starts) == len(spans) + row["n_added"]


@pytest.mark.parametrize("size", [47, 53, 60, 95, 150, 700])
def test_long_spans_at_all_offsets(monkeypatch, size):
    """With a tagger that marks every run of small letters as an e-mail address."""

    def decoded(model, windows):
        tags = np.zeros((len(windows), max(map(len, windows))), np.int64)
        for row, text in zip(tags, windows):
            for run in re.finditer("[a-z.@ ]+", text):
                row[run.start() : run.end()] = [1] + [2] * (run.end() - run.start() - 1)
        return tags, np.ones(tags.shape)

    monkeypatch.setattr(pii.tagger, "coded", lambda texts, width: texts)
    monkeypatch.setattr(pii.tagger, "decoded", decoded)
    span = "firstname.lastname @ dept" + ".institute" * 70
    span = span[:size - 4].rstrip(".") + ".org"
    texts = ["X" * k + span + "X" * 1000 for k in range(200, 248)]
    narrow = [(i, w, t[w : w + 96], w == 0, w + 96 >= len(t)) for i, t in enumerate(texts) for w in pii.open_windows(t, [])]
    assert (len(pii.proposals(None, narrow)) < 48) == (size > 47)  # a window alone loses some
    found = pii.all_proposals(None, texts, [[]] * 48)
    assert [pii.reconciled(found.get(i, {}), []) for i in range(48)] == [[(k, 0, k + len(span))] for k in range(200, 248)]


def test_many_spans_are_reconciled_in_little_time():
    """20,000 spans by rule and as many proposals; and the same spans as comparing each with all."""
    rng = random.Random(9)
    base = [(40 * i, 0, 40 * i + 12) for i in range(20_000)]
    spans = {(a, rng.randrange(4), a + rng.randint(1, 30)): rng.random() for a in rng.sample(range(800_000), 20_000)}
    started = time.perf_counter()
    kept = pii.reconciled(spans, base)
    assert time.perf_counter() - started < 1 and len(kept) > 1000

    def slow(spans, base):
        out = []
        for span in sorted(spans, key=lambda s: (-spans[s], s)):
            if all(span[2] <= a or b <= span[0] for a, _, b in (*out, *base)):
                out.append(span)
        return sorted(out)

    for _ in range(50):
        few = {(a, rng.randrange(4), a + rng.randint(1, 9)): rng.choice([1.0, rng.random()]) for a in rng.choices(range(60), k=25)}
        rules = sorted((a, rng.randrange(4), a + rng.randint(1, 9)) for a in rng.choices(range(60), k=4))
        assert pii.reconciled(few, rules) == slow(few, rules)
