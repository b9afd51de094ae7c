"""Porter stemming (Porter 1980, with the extensions customary in Python toolkits) as columns.

A word is a run of consonant groups C and vowel groups V, where y is a consonant at the start of a
word and after a vowel. Written as regexes over a word whose leading y is marked as Y, the measure
conditions of the algorithm become plain pattern tests, so stemming stays inside Spark expressions.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
MEASURE_1 = f"^(?:{_C})?(?:{_V}{_C})"
MEASURE_2 = f"^(?:{_C})?(?:{_V}{_C}){{2}}"
MEASURE_IS_1 = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
HAS_VOWEL = f"^(?:{_C})?[aeiouy]"
ENDS_CONSONANT = f"^(?:{_C})?(?:{_V}{_C})*$"
SHORT_END = f"^(?:(?:{_C}(?:{_V}{_C})*|(?:{_V}{_C})+)[aeiouy][^aeiouwxyY]|[aeiou][^aeiou])$"

# --- Fixed values: suffix tables of the published algorithm and its irregular words ---------------
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)
# ------------------------------------------------------------------------------------------------


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _first(tests: Iterable[tuple[Column, Column | str]]) -> Column:
    """Value of the first test that holds, else an empty string."""
    out = None
    for hit, value in tests:
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise("")


def _ending(word: Column, suffixes: Iterable[str]) -> Column:
    """The longest listed suffix that ends the word, else an empty string."""
    groups: dict[str, list[str]] = {}
    for s in sorted(suffixes, key=len, reverse=True):
        groups.setdefault(s[-1], []).append(s)
    # One letter rules out most suffixes at once.
    return _first(
        (word.endswith(letter), _first((word.endswith(s), s) for s in group))
        for letter, group in groups.items()
    )


def _rewrite(
    word: Column, suffixes: Iterable[str], rule: Callable[[Column, Column, Column], Column]
) -> Column:
    """``rule(word, rest, suffix)`` for a word with a listed suffix; other words stay as they are."""

    def with_suffix(w: Column, sfx: Column) -> Column:
        rest = F.left(w, F.length(w) - F.length(sfx))
        return F.when(sfx == "", w).otherwise(_let(rest, lambda r: rule(w, r, sfx)))

    return _let(word, lambda w: _let(_ending(w, suffixes), lambda sfx: with_suffix(w, sfx)))


def _swap(key: Column, table: dict[str, str]) -> Column:
    out = None
    for old, new in table.items():
        out = F.when(key == old, new) if out is None else out.when(key == old, new)
    return out


def _plus(word: Column, tail: str) -> Column:
    return F.concat(word, F.lit(tail))


def _tail(word: Column) -> Column:
    return F.right(word, F.length(word) - 1)


def _cut(word: Column, n: int) -> Column:
    return F.left(word, F.length(word) - n)


def step_1a(w: Column) -> Column:
    """Plural endings."""
    return (
        F.when(w.endswith("ies") & (F.length(w) == 4), _cut(w, 1))
        .when(w.endswith("sses") | w.endswith("ies"), _cut(w, 2))
        .when(w.endswith("s") & ~w.endswith("ss"), _cut(w, 1))
        .otherwise(w)
    )


def _past(w: Column, rest: Column, sfx: Column) -> Column:
    """Past and progressive endings."""
    last, pair = F.right(rest, F.lit(1)), F.right(rest, F.lit(2))
    double = (F.length(rest) > 1) & (pair == F.concat(last, last)) & rest.rlike(ENDS_CONSONANT)
    return (
        F.when(sfx == "ied", F.when(F.length(w) == 4, _plus(rest, "ie")).otherwise(_plus(rest, "i")))
        .when(sfx == "eed", F.when(rest.rlike(MEASURE_1), _plus(rest, "ee")).otherwise(w))
        .when(~rest.rlike(HAS_VOWEL), w)
        .when(pair.isin("at", "bl", "iz"), _plus(rest, "e"))
        .when(double, F.when(last.isin("l", "s", "z"), rest).otherwise(_cut(rest, 1)))
        .when(rest.rlike(MEASURE_IS_1) & rest.rlike(SHORT_END), _plus(rest, "e"))
        .otherwise(rest)
    )


def _final_y(w: Column, rest: Column, sfx: Column) -> Column:
    soft = (F.length(rest) > 1) & rest.rlike(ENDS_CONSONANT)
    return F.when(soft, _plus(rest, "i")).otherwise(w)


def _alli(w: Column, rest: Column, sfx: Column) -> Column:
    """-alli becomes -al, which may then end in a suffix of the next table."""
    return F.when(rest.rlike(MEASURE_1), _plus(rest, "al")).otherwise(w)


def _double_suffix(w: Column, rest: Column, sfx: Column) -> Column:
    measured = F.when(sfx == "logi", _plus(rest, "l")).otherwise(rest)
    fits = (sfx != "alli") & measured.rlike(MEASURE_1)
    return F.when(fits, F.concat(rest, _swap(sfx, STEP_2))).otherwise(w)


def _adjective(w: Column, rest: Column, sfx: Column) -> Column:
    return F.when(rest.rlike(MEASURE_1), F.concat(rest, _swap(sfx, STEP_3))).otherwise(w)


def _bare(w: Column, rest: Column, sfx: Column) -> Column:
    open_end = (sfx != "ion") | rest.endswith("s") | rest.endswith("t")
    return F.when(open_end & rest.rlike(MEASURE_2), rest).otherwise(w)


def _final_e(w: Column, rest: Column, sfx: Column) -> Column:
    mute = rest.rlike(MEASURE_2) | (rest.rlike(MEASURE_IS_1) & ~rest.rlike(SHORT_END))
    return F.when(mute, rest).otherwise(w)


def _double_l(w: Column, rest: Column, sfx: Column) -> Column:
    return _let(_cut(w, 1), lambda r: F.when(r.rlike(MEASURE_2), r).otherwise(w))


#: Every suffix that a step takes off or changes; the irregular words end in one too.
ENDINGS = sorted({"s", "ed", "ing", "y", "alli", "e", "ll", *STEP_2, *STEP_3, *STEP_4})


def ends_in_suffix(word: Column) -> Column:
    """Whether any step may change the word; all words that it says no to are their own stems."""
    groups: dict[str, list[str]] = {}
    for s in ENDINGS:
        # A suffix that ends in another listed one says nothing new.
        if not any(s != t and s.endswith(t) for t in ENDINGS):
            groups.setdefault(s[-1], []).append(s)
    tests = [
        word.endswith(letter) & functools.reduce(Column.__or__, [word.endswith(s) for s in group])
        for letter, group in groups.items()
    ]
    return functools.reduce(Column.__or__, tests)


def stem(word: Column) -> Column:
    """Stem of a lower-case word. A word without any listed suffix is its stem and costs a few comparisons."""

    def regular(raw: Column) -> Column:
        w = F.when(raw.startswith("y"), F.concat(F.lit("Y"), _tail(raw))).otherwise(raw)
        w = _let(w, step_1a)
        w = _rewrite(w, ("ied", "eed", "ed", "ing"), _past)
        w = _rewrite(w, ("y",), _final_y)
        w = _rewrite(w, ("alli",), _alli)
        w = _rewrite(w, STEP_2, _double_suffix)
        w = _rewrite(w, STEP_3, _adjective)
        w = _rewrite(w, STEP_4, _bare)
        w = _rewrite(w, ("e",), _final_e)
        w = _rewrite(w, ("ll",), _double_l)
        return _let(w, lambda s: F.when(raw.startswith("y"), F.concat(F.lit("y"), _tail(s))).otherwise(s))

    whole = _let(
        word,
        lambda raw: F.when(F.length(raw) <= 2, raw)
        .when(raw.isin(list(IRREGULAR)), _swap(raw, IRREGULAR))
        .otherwise(regular(raw)),
    )
    return F.when(ends_in_suffix(word), whole).otherwise(word)
