"""Cleaning and tokenizing as column expressions.

Two cleaning families exist and differ: ``social`` feeds the sentiment scorer, ``bow`` feeds word
counts. Regexes avoid the classes that engines define differently: ``\\w``, ``\\d``, ``\\s`` and
``.`` are written out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinions.rules import EDGE_RUNS, STOPWORD_EXCEPTIONS

# --- Fixed values: the patterns of both cleaning families ----------------------------------------
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]"
NOT_SPACE = r"[^\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]"
PUNCT = r"[!-/:-@\[-`{-~]"
NOT_PUNCT = r"[^!-/:-@\[-`{-~]"
REPOST = f"RT @{WORD}*:"
NAME_OR_AT = f"@{WORD}*"
NAME = f"@{WORD}+"
SHORT_URL = "https?://[A-Za-z0-9./]*"
URL = f"http[^\n]?://{NOT_SPACE}+{SPACE}?"
DIGITS = r"\p{Nd}+"
UPPER, LOWER = r"\p{Lu}", r"[\p{Ll}\p{Lt}]"
# Of a text with a blank before it: a blank and then a token (two or more characters) that is_upper holds for, or does not.
UPPER_TOKEN = r" (?=[^ \p{Lu}\p{Ll}\p{Lt}]*+\p{Lu})[^ \p{Ll}\p{Lt}]{2,}+(?: |\z)"
OTHER_TOKEN = r" (?=[^ ]{2})(?:[^ \p{Ll}\p{Lt}]*+[\p{Ll}\p{Lt}]|[^ \p{Lu}]++(?: |\z))"
# -------------------------------------------------------------------------------------------------

_RUNS = "|".join(
    "".join("\\" + ch for ch in run) for run in sorted(EDGE_RUNS, key=len, reverse=True)
)
#: The ``$`` of ``EDGE_PATTERN`` also stands before one of these.
LINE_ENDS = "\n\r\x85\u2028\u2029"
EDGE_PATTERN = f"^(?:(?:{_RUNS})({NOT_PUNCT}{{2,}}+)|({NOT_PUNCT}{{2,}}+)(?:{_RUNS}))$"


def strip_repost(c: Column) -> Column:
    return F.regexp_replace(c, REPOST, "")


def strip_mentions(c: Column, bare_at: bool = True) -> Column:
    """Remove @names; with ``bare_at`` a lone @ goes too."""
    return F.regexp_replace(c, NAME_OR_AT if bare_at else NAME, "")


def strip_short_urls(c: Column) -> Column:
    return F.regexp_replace(c, SHORT_URL, "")


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL, "")


def strip_newlines(c: Column) -> Column:
    # Cut and joined: the fastest way, as Spark searches a single character without a regex.
    return F.array_join(F.split(c, "\n"), "")


def remove_punct(c: Column) -> Column:
    return F.regexp_replace(c, PUNCT, "")


def blank_punct(c: Column) -> Column:
    return F.translate(c, string.punctuation, " " * len(string.punctuation))


def strip_underscores(c: Column) -> Column:
    return F.replace(c, F.lit("_"), F.lit(""))


def strip_digits(c: Column) -> Column:
    return F.regexp_replace(c, DIGITS, "")


def clean_social(c: Column) -> Column:
    """Repost marker, @names, links and line breaks removed; case and punctuation kept."""
    c = c.cast("string")
    return strip_newlines(strip_short_urls(strip_mentions(strip_repost(c))))


def clean_bow(c: Column) -> Column:
    """Lower-case words with single blanks between them; no names, links, digits, punctuation."""
    return F.array_join(bow_words(c), " ")


def bow_pieces(c: Column) -> Column:
    """The words of ``bow_words`` and perhaps empty strings; never an empty array of a text that is not null."""
    c = strip_urls(strip_mentions(c.cast("string"), bare_at=False))
    c = F.lower(strip_digits(blank_punct(strip_underscores(c))))
    return F.split(c, f"{SPACE}+")


def bow_words(c: Column) -> Column:
    return F.filter(bow_pieces(c), lambda w: w != "")


def telling(word: Column, stopwords: list[str]) -> Column:
    """Whether a word has two or more letters and is no stop word; opinion words are none."""
    banned = [w for w in stopwords if w not in STOPWORD_EXCEPTIONS]
    return (F.length(word) > 1) & ~word.isin(banned)


def drop_stopwords(words: Column, stopwords: list[str]) -> Column:
    """Keep words of two or more letters that are not stop words; opinion words always stay."""
    return F.filter(words, lambda w: telling(w, stopwords))


def exploded(pieces: Column, of: str = "string") -> Column:
    """The elements of an array, in rows. Without functions of elements in it, the explosion is generated code; concat keeps
    Spark from testing the array for emptiness, and so making it twice."""
    return F.explode(F.concat(pieces, F.array().cast(f"array<{of}>")))


def tokens_min2(c: Column) -> Column:
    """Split on single blanks, keep pieces of two or more characters."""
    return F.filter(F.split(c, " "), lambda t: F.length(t) > 1)


def bare_token_set(c: Column) -> Column:
    """Distinct tokens of a punctuation-free text."""
    return F.array_distinct(tokens_min2(F.regexp_replace(remove_punct(c), "\n", " ")))


def strip_edge(tok: Column) -> Column:
    """Take one listed punctuation run off one edge of an otherwise punctuation-free token."""
    # Few tokens have a mark at an edge, and only those with a line break there need EDGE_PATTERN.
    marks = [*string.punctuation, *LINE_ENDS]
    edged = F.substring(tok, 1, 1).isin(*marks) | F.substring(tok, -1, 1).isin(*marks)
    body = F.btrim(tok, F.lit(string.punctuation))
    first, last = tok.startswith(body), tok.endswith(body)
    n = F.length(tok) - F.length(body)
    run = F.when(first, F.right(tok, n)).when(last, F.left(tok, n))
    bare = F.when(run.isin(*EDGE_RUNS) & (F.length(body) > 1) & ~body.rlike(PUNCT), body).otherwise(tok)
    return (
        F.when(~edged, tok)
        .when(F.btrim(tok, F.lit(LINE_ENDS)) == tok, bare)
        .otherwise(F.regexp_replace(tok, EDGE_PATTERN, "$1$2"))
    )


def scorer_tokens(cleaned: Column) -> Column:
    return F.transform(tokens_min2(cleaned), strip_edge)


def lower_tokens(toks: Column) -> Column:
    """The tokens in lower case, made at once: no token holds a blank. Without any token, one empty string."""
    return F.split(F.lower(F.array_join(toks, " ")), " ")


def mixed_case(cleaned: Column) -> Column:
    """Whether some tokens of a cleaned text are upper-case (``is_upper``) and some are not; edge punctuation does not matter."""
    spaced = F.concat(F.lit(" "), cleaned)
    return spaced.rlike(UPPER_TOKEN) & spaced.rlike(OTHER_TOKEN)


def is_upper(tok: Column) -> Column:
    """Some upper-case letter and no lower-case one."""
    return tok.rlike(UPPER) & ~tok.rlike(LOWER)


def mentions_word(c: Column, word: str) -> Column:
    return F.lower(c).contains(word.lower())
