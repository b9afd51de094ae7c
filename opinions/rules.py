"""Fixed rule lists of the sentiment model, and the region code table.

The lists belong to a published rule-based sentiment model for social media text (ICWSM 2014).
They are small constants, so the scorer turns them into literal predicates instead of joins; only
the lexicon, which is an input table, is joined.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -------------------------------------------------------------------------------
# Intensifiers raise the strength of the next scored word, dampeners lower it.
STEP = 0.293

NEGATORS = tuple(
    """
    aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't
    doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't
    mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt
    uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't
    wouldn't rarely seldom despite
    """.split()
)

INTENSIFIERS = tuple(
    """
    absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely
    especially exceptionally extremely fabulously flipping flippin fricking frickin frigging friggin
    fully fucking greatly hella highly hugely incredibly intensely majorly more most particularly
    purely quite really remarkably so substantially thoroughly totally tremendously uber unbelievably
    unusually utterly very
    """.split()
)

DAMPENERS = (
    "almost", "barely", "hardly", "just enough", "kind of", "kinda", "kindof", "kind-of", "less",
    "little", "marginally", "occasionally", "partly", "scarcely", "slightly", "somewhat", "sort of",
    "sorta", "sortof", "sort-of",
)

IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "yeah right": -2.0,
    "cut the mustard": 2.0,
    "kiss of death": -1.5,
    "hand to mouth": -2.0,
}

# Punctuation runs that are taken off one edge of a token.
EDGE_RUNS = (
    ".", "!", "?", ",", ";", ":", "-", "'", '"', "!!", "!!!", "??", "???", "?!?", "!?!", "?!?!", "!?!?",
)

# Region names and codes.
REGION_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "District of Columbia": "DC",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL",
    "Indiana": "IN", "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA",
    "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN",
    "Mississippi": "MS", "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV",
    "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY",
    "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR",
    "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD",
    "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA",
    "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}
# The one region that has a code but is not part of the dense region list.
REGION_WITHOUT_ROW = "District of Columbia"
# Words a stop-word filter must keep, because they carry opinion.
STOPWORD_EXCEPTIONS = ("n't", "not", "no")
CAPS_STEP = 0.733
NEGATION_FACTOR = -0.74
DISTANCE_FACTORS = (1.0, 0.95, 0.9)
NEVER_FACTORS = (1.5, 1.25)
CONTRAST_FACTORS = (0.5, 1.5)
EXCLAIM_STEP, EXCLAIM_CAP = 0.292, 4
QUESTION_STEP, QUESTION_CAP = 0.18, 0.96
SQUASH = 15.0
# ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleSet:
    """Word lists and constants of the scorer; every field can be replaced."""

    boosters: dict[str, float] = field(
        default_factory=lambda: {w: STEP for w in INTENSIFIERS} | {w: -STEP for w in DAMPENERS}
    )
    negators: tuple[str, ...] = NEGATORS
    contraction: str = "n't"
    idioms: dict[str, float] = field(default_factory=lambda: dict(IDIOMS))
    contrast_word: str = "but"
    least_word: str = "least"
    least_exempt: tuple[str, ...] = ("at", "very")
    never_word: str = "never"
    never_links: tuple[str, ...] = ("so", "this")
    softener: tuple[str, str] = ("kind", "of")
    caps_step: float = CAPS_STEP
    negation_factor: float = NEGATION_FACTOR
    bigram_step: float = -STEP
    distance_factors: tuple[float, float, float] = DISTANCE_FACTORS
    never_factors: tuple[float, float] = NEVER_FACTORS
    contrast_factors: tuple[float, float] = CONTRAST_FACTORS
    exclaim_step: float = EXCLAIM_STEP
    exclaim_cap: int = EXCLAIM_CAP
    question_step: float = QUESTION_STEP
    question_cap: float = QUESTION_CAP
    squash: float = SQUASH
