"""Chat formatting: a state machine checks the order of roles, a template turns turns into segments."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENTS = "array<struct<text:string,loss:boolean>>"


@dataclass(frozen=True)
class Template:
    """How a conversation is written, and which order of roles is valid.

    A turn becomes ``open + role + middle``, its escaped text, and ``close``. ``escape`` stands before a
    letter for every control string inside a text: "e" for itself, then "a", "b", ... in the order of
    ``controls``, and "z" for ``middle`` inside a role. A control string may begin with a character that it does not hold again, so it can't
    start inside another one's beginning; then a text never closes its turn.
    """

    open: str = "<|im_start|>"
    middle: str = "\n"
    close: str = "<|im_end|>\n"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>")
    escape: str = "\\"
    trained: tuple[str, ...] = ("assistant",)
    start: str = "start"
    #: (state, role) to the next state; a missing pair breaks the order.
    moves: Mapping[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "told",
            ("start", "user"): "asked",
            ("told", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    final: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        if not all(c and c[0] not in c[1:] and self.escape not in c for c in self.controls):
            raise ValueError("a control string must not hold its first character again, nor the escape")
        if not self.middle or self.escape in self.middle:
            raise ValueError("middle ends a role, so it is a string without the escape")
        if len(self.escape) != 1 or not all(any(c in s for c in self.controls) for s in (self.open, self.close)):
            raise ValueError("the escape is one character; open and close each hold a control string")

    def codes(self) -> list[tuple[str, str]]:
        return [(c, self.escape + chr(ord("a") + i if i < 4 else ord("b") + i)) for i, c in enumerate(self.controls)]


DEFAULT = Template()


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    """A text without control strings, from which ``unescaped`` gets it back."""
    text = F.replace(text, F.lit(template.escape), F.lit(template.escape + "e"))
    for control, code in template.codes():
        text = F.replace(text, F.lit(control), F.lit(code))
    return text


def unescaped(text: Column, template: Template = DEFAULT) -> Column:
    for control, code in template.codes():
        text = F.replace(text, F.lit(code), F.lit(control))
    return F.replace(text, F.lit(template.escape + "e"), F.lit(template.escape))


def escaped_role(role: Column, template: Template = DEFAULT) -> Column:
    """A role without control strings and without ``middle``, which ends it."""
    return F.replace(escaped(role, template), F.lit(template.middle), F.lit(template.escape + "z"))


def unescaped_role(role: Column, template: Template = DEFAULT) -> Column:
    return unescaped(F.replace(role, F.lit(template.escape + "z"), F.lit(template.middle)), template)


def role_state(roles: Column, template: Template = DEFAULT) -> Column:
    """State after all roles; null once an order was broken."""
    moves = F.create_map(*[F.lit(x) for (s, r), to in template.moves.items() for x in (f"{s}\n{r}", to)])
    return F.aggregate(
        roles, F.lit(template.start), lambda s, r: F.when(s.isNotNull(), F.element_at(moves, F.concat(s, F.lit("\n"), r)))
    )


def formatted(
    turns: DataFrame,
    template: Template = DEFAULT,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: key, segments (text, loss), formatted, state, valid.

    Segments alternate between template text and escaped turn text; ``loss`` marks the texts that a model
    is trained on. ``formatted`` is their concatenation. ``valid`` tells whether the roles follow the
    state machine to a final state; a conversation that breaks it is formatted all the same.

    Turns are ordered by number, then role, then text, so ties and repeated rows have one order; a null
    number comes first. A null text counts as empty, and a null role as the empty role, which no order
    allows. A null key is one conversation. Other columns are ignored; an empty table gives no rows.
    """
    rows = turns.select(
        F.col(key).alias("id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    conversations = rows.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t):
        head = F.concat(F.lit(template.open), escaped_role(t["role"], template), F.lit(template.middle))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(t["text"], template).alias("text"), t["role"].isin(*template.trained).alias("loss")),
            F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
        )

    made = conversations.select(
        "id",
        F.flatten(F.transform("turns", segments)).cast(SEGMENTS).alias("segments"),
        role_state(F.transform("turns", lambda t: t["role"]), template).alias("state"),
    )
    return made.select(
        F.col("id").alias(key),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "state",
        F.coalesce(F.col("state").isin(*template.final), F.lit(False)).alias("valid"),
    )


def read_turns(text: Column, template: Template = DEFAULT) -> Column:
    """The (role, text) turns of a formatted conversation."""
    # Turns end with ``close``; ``middle`` ends the role at its first place.
    quoted = "".join("\\" + c if not c.isalnum() and c != "\n" else c for c in template.close)
    bodies = F.filter(F.split(text, quoted), lambda b: b != "")

    def turn(body):
        rest = F.substr(body, F.lit(len(template.open) + 1))
        at = F.instr(rest, template.middle)
        return F.struct(
            unescaped_role(F.substr(rest, F.lit(1), at - 1), template).alias("role"),
            unescaped(F.substr(rest, at + len(template.middle)), template).alias("text"),
        )

    return F.transform(bodies, turn)


def trained_text(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss mask, as it was before escaping, with nothing between."""
    marked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(marked, lambda s: unescaped(s["text"], template)), "")
