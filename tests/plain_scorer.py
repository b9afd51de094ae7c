"""A second, sequential scorer, written from the rule table for comparison only.

The rules are rows of a table that one loop applies; nothing is shared with the package but the rule lists.
"""

from __future__ import annotations

import math
import re
import string
import unicodedata

PUNCT = set(string.punctuation)
RUNS = (". ! ? , ; : - ' \" !! !!! ?? ??? ?!? !?! ?!?! !?!?").split()


def bare(token):
    """The token without one listed run at one edge, if the rest holds no punctuation."""
    body = "".join(ch for ch in token if ch not in PUNCT)
    if len(body) > 1 and any(token in (run + body, body + run) for run in RUNS):
        return body
    return token


def clean(text):
    for pattern in (r"RT @\w*:", r"@\w*", r"https?://[A-Za-z0-9./]*", r"\n"):
        text = re.sub(pattern, "", text)
    return text


def tokens(text):
    return [bare(t) for t in clean(text).split(" ") if len(t) > 1]


def shouting(token):
    kinds = {unicodedata.category(ch) for ch in token}
    return "Lu" in kinds and not kinds & {"Ll", "Lt"}


class Place:
    """A token at its first place: ``at(0)`` is the token, ``at(-1)`` the one before it, None beyond the ends."""

    def __init__(self, ts, tok, mixed, lex):
        self.ts, self.here, self.mixed, self.lex = ts, ts.index(tok), mixed, lex

    def at(self, by):
        i = self.here + by
        return self.ts[i] if 0 <= i < len(self.ts) else None

    def low(self, by):
        return (self.at(by) or "").lower()

    def free(self, by):
        """There is a token, and the lexicon does not know it."""
        return self.at(by) is not None and self.low(by) not in self.lex

    def phrase(self, first, last):
        words = [self.at(i) for i in range(first, last + 1)]
        return " ".join(words) if all(words) else None


def rows(r):
    """The rule table: (which places a row covers, its condition, its effect on the value), in order.

    Rows of one group name exclude each other: the first that holds is applied.
    """
    sign = lambda v: 1 if v > 0 else -1
    table = [("caps", lambda p: p.mixed and shouting(p.at(0)), lambda v, p: v + sign(v) * r.caps_step)]

    def lift(by, weight):
        def effect(v, p):
            step = r.boosters[p.low(by)] * (-1 if v < 0 else 1)
            loud = r.caps_step * sign(v) if p.mixed and shouting(p.at(by)) else 0
            return v + (step + loud) * weight

        return effect

    def times(factor):
        return lambda v, p: v * factor

    def denies(by):
        return lambda p: p.free(by) and (p.low(by) in r.negators or r.contraction in p.low(by))

    def never(by, *links):
        return lambda p: p.free(by) and any(all(p.at(i) in words for i, words in need) for need in links)

    so, no_more = r.never_links, (r.never_word,)
    special = {
        -2: [(never(-2, [(-2, no_more), (-1, so)]), times(r.never_factors[0]))],
        -3: [(never(-3, [(-1, so)], [(-3, no_more), (-2, so)]), times(r.never_factors[1]))],
    }
    for by, weight in zip((-1, -2, -3), r.distance_factors):
        table.append((f"boost{by}", lambda p, by=by: p.free(by) and p.low(by) in r.boosters, lift(by, weight)))
        for condition, effect in [*special.get(by, []), (denies(by), times(r.negation_factor))]:
            table.append((f"deny{by}", condition, effect))
    for first, last in ((0, 2), (0, 1), (-1, 0), (-2, 0), (-2, -1), (-3, -1), (-3, -2)):
        span = (first, last)
        table.append(
            ("idiom", lambda p, s=span: p.free(-3) and p.phrase(*s) in r.idioms, lambda v, p, s=span: r.idioms[p.phrase(*s)])
        )
    pair = lambda p: p.free(-3) and (p.phrase(-3, -2) in r.boosters or p.phrase(-2, -1) in r.boosters)
    table.append(("damp", pair, lambda v, p: v + r.bigram_step))
    least = lambda p: p.free(-1) and p.low(-1) == r.least_word and p.low(-2) not in r.least_exempt
    table.append(("least", least, times(r.negation_factor)))
    return table


class Plain:
    def __init__(self, lexicon, rules):
        self.lex, self.r, self.table = lexicon, rules, rows(rules)

    def word(self, ts, tok, mixed):
        place, r = Place(ts, tok, mixed, self.lex), self.r
        softened = place.low(0) == r.softener[0] and place.low(1) == r.softener[1]
        if place.low(0) not in self.lex or place.low(0) in r.boosters or softened:
            return 0.0
        value, done = self.lex[place.low(0)], set()
        for group, holds, effect in self.table:
            if group not in done and holds(place):
                done.add(group)
                value = effect(value, place)
        return value

    def scores(self, text):
        """neg, neu, pos, compound."""
        r, body = self.r, clean(text)
        ts = tokens(text)
        if not ts:
            return 0.0, 0.0, 0.0, 0.0
        loud = sum(map(shouting, ts))
        each = [self.word(ts, tok, 0 < loud < len(ts)) for tok in ts]
        lows = [t.lower() for t in ts]
        if r.contrast_word in lows:
            p = lows.index(r.contrast_word)
            each = [s * (r.contrast_factors[0] if i < p else r.contrast_factors[1] if i > p else 1) for i, s in enumerate(each)]
        asks = body.count("?")
        emph = min(body.count("!"), r.exclaim_cap) * r.exclaim_step
        emph += 0 if asks < 2 else asks * r.question_step if asks < 4 else r.question_cap
        total = round(sum(each), 9)
        up = round(sum(s + 1 for s in each if s > 0), 9)
        down = round(sum(1 - s for s in each if s < 0), 9)
        flat = sum(s == 0 for s in each)
        total += emph * ((total > 0) - (total < 0))
        up, down = up + emph * (up > down), down + emph * (down > up)
        mass = up + down + flat
        return (
            round(down / mass, 3),
            round(flat / mass, 3),
            round(up / mass, 3),
            round(total / math.sqrt(total * total + r.squash), 4),
        )
