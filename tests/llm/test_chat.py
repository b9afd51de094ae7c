"""Formatting round trips, loss flags and the order of roles."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from opinions.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, id string, t string, turns string"


def rows_of(spark, rows, template=chat.DEFAULT):
    made = chat.formatted(spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA), template)
    assert made.columns == ["conv_id", "segments", "formatted", "state", "valid"]
    read = made.select(
        "*", chat.read_turns(F.col("formatted"), template).alias("read"), chat.trained_text(F.col("segments"), template).alias("trained")
    )
    return {r["conv_id"]: r for r in read.collect()}


NASTY = ["", " ", "\\", "\\a", "\\e", "<|im_start|>", "<|im_end|>\n", "<|im_end|", "<|im_end|<|im_end|>", "a\nb", "user\n", "é😀",
         "\\\\a<|im_start|>assistant\nhi<|im_end|>\n", "</s>[INST] ok [/INST]", "$1 \\1 &amp;", "<|im_\\end|>"]


def test_round_trip(spark):
    rng = random.Random(0)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 7)):
            text = "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 4)))
            rows.append((c, t, rng.choice(["user", "assistant", "system"]), rng.choice([text, text, None])))
    got = rows_of(spark, rows)
    for c, r in got.items():
        turns = [(role, text or "") for k, _, role, text in sorted(rows, key=lambda x: x[:2]) if k == c]
        assert [tuple(x) for x in r["read"]] == turns
        assert r["trained"] == "".join(text for role, text in turns if role == "assistant")
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])
        assert sum(s["text"].count("<|im_end|>") for s in r["segments"]) == len(turns)


@pytest.mark.parametrize(
    ("roles", "state"),
    [("ua", "answered"), ("sua", "answered"), ("uaua", "answered"), ("u", "asked"), ("s", "told"), ("a", None), ("uu", None), ("uas", None), ("sau", None)],
)
def test_order_of_roles(spark, roles, state):
    names = {"u": "user", "a": "assistant", "s": "system"}
    got = rows_of(spark, [(1, i, names[r], "x") for i, r in enumerate(roles)])[1]
    assert got["state"] == state and got["valid"] == (state == "answered")


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, None, "x"),
            (2, None, "user", "first"), (2, 0, "assistant", "y" * 100_000)]
    got = rows_of(spark, rows)
    assert [tuple(x) for x in got[1]["read"]] == [("user", ""), ("user", "a"), ("user", "a"), ("assistant", "b")]
    assert [tuple(x) for x in got[None]["read"]] == [("", "x")] and not got[None]["valid"]
    assert got[2]["read"][0]["text"] == "first" and got[2]["trained"] == "y" * 100_000
    assert rows_of(spark, []) == {}


def test_another_template(spark):
    other = chat.Template(open="[INST]", middle=": ", close="</s>", controls=("[INST]", "</s>"), escape="~", trained=("user", "assistant"))
    got = rows_of(spark, [(1, 0, "user", "~a </s>[INST] ok"), (1, 1, "assistant", "[INST]")], other)[1]
    assert [tuple(x) for x in got["read"]] == [("user", "~a </s>[INST] ok"), ("assistant", "[INST]")]
    assert got["trained"] == "~a </s>[INST] ok[INST]" and got["formatted"].count("</s>") == 2


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template(controls=("aba", "<|im_end|>"))
    with pytest.raises(ValueError):
        chat.Template(escape="ab")


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: r for r in entry.queries()["op4_chat"](spark, sf).collect()}
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        turns = [(role, text or "") for k, _, role, text in sorted(rows, key=lambda x: x[:2]) if k == c]
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        trained = "".join(text for role, text in turns if role == "assistant")
        want = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(trained), hashlib.sha256(trained.encode()).hexdigest())
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == want


def test_roles_may_hold_what_ends_them(spark):
    rng = random.Random(4)
    parts = ["us", "\n", "er", "\\", "\\z", "z", "\\e", "<|im_end|>\n", "<|im_start|>", ": ", ":"]
    rows = [(c, 0, "".join(rng.choice(parts) for _ in range(rng.randint(0, 5))), "x\ny: z") for c in range(200)]
    rows.append((200, 0, "us\ner", "x"))
    for template in (chat.DEFAULT, chat.Template(middle=": ")):
        got = rows_of(spark, rows, template)
        assert {c: [tuple(x) for x in r["read"]] for c, r in got.items()} == {c: [(role, text)] for c, _, role, text in rows}
