"""The derived tables of ``catalog.tables`` as SQL. Text patterns and stemming tables are the package's, as these are fixed values."""

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]"
NOT_SPACE = r"[^\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]"

CTES: dict[str, str] = {}

CTES["authors"] = """
SELECT c_custkey AS user_id, n_name AS region, r_name AS country,
  CASE WHEN c_custkey % 5 = 0 THEN strftime(joined, '%m/%d/%Y')
       WHEN c_custkey % 5 = 1 THEN strftime(joined, '%m-%d-%Y')
       WHEN c_custkey % 5 = 2 THEN strftime(joined, '%-m/%-d/%Y')
       WHEN c_custkey % 5 = 3 THEN strftime(joined, '%Y-%m-%d %H:%M:%S')
       WHEN c_custkey % 3 = 0 THEN 'unknown'
       ELSE strftime(joined, '%m/%d/%Y') END AS user_join_date
FROM customer
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS joined FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
"""

CTES["raw_mentions"] = """
SELECT event_id AS mention_id, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS subject,
  CASE WHEN event_id % 29 <> 0 THEN e.user_id END AS user_id, ts,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 1 WHEN event_type = 'error' THEN -1 ELSE 0 END AS polarity,
  CASE WHEN event_id % 31 <> 0 THEN a.region END AS region, a.country, a.user_join_date
FROM events e LEFT JOIN authors a ON a.user_id = e.user_id
"""

CTES["mentions"] = "SELECT * FROM raw_mentions WHERE user_id IS NOT NULL"

CTES["scoped"] = """
SELECT *, CAST(coalesce(
    try_strptime(replace(user_join_date, '/', '-'), '%m-%d-%Y'),
    try_strptime(user_join_date, '%Y-%m-%d %H:%M:%S')) AS DATE) AS join_date
FROM mentions
WHERE country IN ('AMERICA', 'EUROPE', 'ASIA') AND region NOT IN ('NATION_1', 'NATION_7')
"""

# Each date in each notation, and how many of them read it.
CTES["dated"] = """
SELECT *, count(day) OVER (PARTITION BY user_id) AS several FROM (
  SELECT user_id, user_join_date, i, notation, CAST(CASE i
      WHEN 1 THEN try_strptime(written, '%m-%d-%Y') WHEN 2 THEN try_strptime(written, '%d-%m-%Y')
      WHEN 3 THEN try_strptime(written, '%Y-%m-%d') ELSE try_strptime(written, '%Y-%m-%d %H:%M:%S') END AS DATE) AS day
  FROM (SELECT user_id, user_join_date, regexp_replace(trim(user_join_date), '[/.]', '-', 'g') AS written FROM authors),
    (VALUES (1, 'M-d-yyyy'), (2, 'd-M-yyyy'), (3, 'yyyy-M-d'), (4, 'yyyy-M-d H:m:s')) f(i, notation))
"""

# First mention of any polarity per user; and last positive mention per user.
CTES["pop_mentions"] = "SELECT * FROM scoped"
CTES["pop_users"] = """
SELECT * FROM scoped QUALIFY row_number() OVER (PARTITION BY subject, user_id ORDER BY ts, mention_id) = 1
"""
CTES["pop_established"] = "SELECT * FROM pop_users WHERE join_date < DATE '1996-01-01'"
CTES["pos_mentions"] = "SELECT * FROM scoped WHERE polarity = 1"
CTES["pos_users"] = """
SELECT * FROM pos_mentions
QUALIFY row_number() OVER (PARTITION BY subject, user_id ORDER BY ts DESC, mention_id DESC) = 1
"""
CTES["pos_established"] = "SELECT * FROM pos_users WHERE join_date < DATE '1996-01-01'"

CTES["outcome"] = """
SELECT n_name AS region, CASE WHEN a >= b THEN 'a' ELSE 'b' END AS winner,
  CASE WHEN n_nationkey = 13 THEN 'n/a'
       WHEN n_nationkey % 6 = 0 THEN ' ' || CAST(people AS VARCHAR)
       ELSE CAST(people AS VARCHAR) END AS weight,
  CAST(a AS VARCHAR) AS votes_a, CAST(b AS VARCHAR) AS votes_b
FROM (
  SELECT c_nationkey, count(DISTINCT c_custkey) AS people,
    coalesce(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (o_orderstatus = 'F'), 0) AS a,
    coalesce(sum(CAST(o_totalprice AS DECIMAL(18, 2))) FILTER (o_orderstatus = 'O'), 0) AS b
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_nationkey)
JOIN nation ON c_nationkey = n_nationkey
"""

CTES["regions"] = """
SELECT n_name AS region, CASE WHEN n_nationkey <> 24 THEN 'N' || n_nationkey END AS region_code FROM nation
"""

for _p in ("mentions", "users", "established"):
    CTES[f"both_{_p}"] = f"""
    SELECT a.region, n_a, n_b
    FROM (SELECT region, count(*) AS n_a FROM pop_{_p} WHERE polarity = 1 AND subject = 'a' GROUP BY region) a
    JOIN (SELECT region, count(*) AS n_b FROM pop_{_p} WHERE polarity = 1 AND subject = 'b' GROUP BY region) b
      ON a.region = b.region
    """
    CTES[f"leader_{_p}"] = f"""
    SELECT *, CASE WHEN n_a < n_b THEN 'b' ELSE 'a' END AS leader FROM both_{_p}
    """
    CTES[f"weighted_{_p}"] = f"SELECT l.*, weight FROM leader_{_p} l JOIN outcome o ON o.region = l.region"
    CTES[f"board_{_p}"] = f"""
    SELECT region, n_a, n_b, CASE WHEN n_b <> 0 THEN n_a / n_b END AS ratio,
      CASE WHEN n_a - n_b > 0 THEN 'a' ELSE 'b' END AS leader
    FROM (
      SELECT r.region, count(*) FILTER (p.subject = 'a') AS n_a, count(*) FILTER (p.subject = 'b') AS n_b
      FROM regions r LEFT JOIN pos_{_p} p ON p.region = r.region GROUP BY r.region)
    """

CTES["measured"] = """
SELECT n_a, n_b, ratio AS ratio_texts, TRY_CAST(trim(weight) AS INT) AS weight, CASE WHEN TRY_CAST(votes_b AS DOUBLE) <> 0
  THEN TRY_CAST(votes_a AS DOUBLE) / TRY_CAST(votes_b AS DOUBLE) END AS ratio_actual
FROM board_established b JOIN outcome o ON o.region = b.region
"""

CTES["texts"] = r"""
SELECT doc_id AS mention_id,
  CASE WHEN CAST(substr(source, 4) AS INT) % 2 = 0 THEN 'a' ELSE 'b' END AS subject,
  CASE doc_id % 5
    WHEN 0 THEN 'RT @' || source || ': ' || text || ' why??'
    WHEN 1 THEN text || ' https://ex.org/' || source || '?id=' || n_chars || ' more_or_less'
    WHEN 2 THEN '"' || text || '!!! @' || source || 'é1 don''t?!?'
    WHEN 3 THEN 'IT''S THAT GOOD! NOT ' || upper(lang) || ' ' || text || ' THAN 4? 5? 6? 7?'
    ELSE text END AS text,
  lang, source
FROM documents
"""

CTES["cleaned"] = rf"""
SELECT mention_id, lang, replace(
    regexp_replace(
      regexp_replace(
        regexp_replace(text, 'RT @{WORD}*:', '', 'g'),
        '@{WORD}*', '', 'g'),
      'https?://[A-Za-z0-9./]*', '', 'g'),
    chr(10), '') AS text
FROM texts
"""

CTES["lexicon"] = """
SELECT token, CAST((length(token) * 7 + ascii(token)) % 9 - 4 AS DOUBLE) AS valence
FROM (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS token FROM benchmark)
WHERE length(token) >= 4 AND (length(token) * 7 + ascii(token)) % 9 <> 4
"""

_RUNS = r"\?!\?!|!\?!\?|!!!|\?\?\?|\?!\?|!\?!|!!|\?\?|\.|!|\?|,|;|:|-|''|\""
_BODY = "[^[:punct:]]{2,}"
EDGE = f"^(?:(?:{_RUNS})({_BODY})|({_BODY})(?:{_RUNS}))$"

# One row per token: position from 1, first position of the same token, neighbours there.
CTES["token_rows"] = rf"""
SELECT mention_id, generate_subscripts(toks, 1) AS pos, unnest(toks) AS raw,
  unnest(list_transform(toks, lambda x: regexp_replace(x, '{EDGE}', '\1\2'))) AS tok
FROM (SELECT mention_id, list_filter(string_split(text, ' '), lambda x: length(x) > 1) AS toks FROM cleaned)
"""

CTES["token_near"] = """
SELECT mention_id, pos, tok, lower(tok) AS low,
  lag(tok, 1) OVER w AS b1, lag(tok, 2) OVER w AS b2, lag(tok, 3) OVER w AS b3,
  lead(tok, 1) OVER w AS a1, lead(tok, 2) OVER w AS a2,
  min(pos) OVER (PARTITION BY mention_id, tok) AS first,
  min(CASE WHEN lower(tok) = 'from' THEN pos END) OVER (PARTITION BY mention_id) AS turn_at,
  count(*) OVER (PARTITION BY mention_id) AS n,
  count(*) FILTER (regexp_matches(tok, '\\p{Lu}') AND NOT regexp_matches(tok, '[\\p{Ll}\\p{Lt}]'))
    OVER (PARTITION BY mention_id) AS caps
FROM token_rows
WINDOW w AS (PARTITION BY mention_id ORDER BY pos)
""".replace("\\\\", "\\")

CTES["doc_stats"] = """
SELECT c.mention_id, coalesce(n, 0) AS n, coalesce(caps, 0) AS caps,
  length(text) - length(replace(text, '!', '')) AS exclaims,
  length(text) - length(replace(text, '?', '')) AS asks
FROM cleaned c LEFT JOIN (SELECT DISTINCT mention_id, n, caps FROM token_near) t ON t.mention_id = c.mention_id
"""

CTES["emphasis"] = """
SELECT *, least(exclaims, 4) * 0.292::DOUBLE
  + CASE WHEN asks <= 1 THEN 0 WHEN asks <= 3 THEN asks * 0.18::DOUBLE ELSE 0.96::DOUBLE END AS emph
FROM doc_stats
"""

_UP = r"(regexp_matches({0}, '\p{{Lu}}') AND NOT regexp_matches({0}, '[\p{{Ll}}\p{{Lt}}]'))"


def _lift(word: str) -> str:
    return (
        f"CASE WHEN lower({word}) IN ('is', 'by', 'this') THEN 0.293::DOUBLE "
        f"WHEN lower({word}) IN ('of', 'on') THEN -0.293::DOUBLE END"
    )


def _no(word: str) -> str:
    return f"(lower({word}) IN ('no', 'not', 'for') OR contains(lower({word}), 'n''t'))"


# Scores of tokens at their first position.
CTES["first_hits"] = f"""
SELECT t.mention_id, t.first, t.tok, t.b1, t.b2, t.b3, t.a1, t.a2, l.valence,
  caps BETWEEN 1 AND n - 1 AS mixed,
  caps BETWEEN 1 AND n - 1 AND {_UP.format("tok")} AS shout,
  b1 IS NOT NULL AND l1.token IS NULL AS free1,
  b2 IS NOT NULL AND l2.token IS NULL AS free2,
  b3 IS NOT NULL AND l3.token IS NULL AS free3
FROM token_near t JOIN lexicon l ON l.token = t.low
LEFT JOIN lexicon l1 ON l1.token = lower(b1)
LEFT JOIN lexicon l2 ON l2.token = lower(b2)
LEFT JOIN lexicon l3 ON l3.token = lower(b3)
WHERE pos = first
"""

CTES["step0"] = """
SELECT *, valence + CASE WHEN shout THEN CASE WHEN valence > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0 END AS v_caps
FROM first_hits
"""


def _boost(k: int, run: str, factor: float) -> str:
    b = f"b{k}"
    return f"""CASE WHEN free{k} AND {_lift(b)} IS NOT NULL THEN {factor}::DOUBLE * (
      CASE WHEN {run} < 0 THEN -({_lift(b)}) ELSE {_lift(b)} END
      + CASE WHEN mixed AND {_UP.format(b)} THEN CASE WHEN {run} > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END ELSE 0 END)
      ELSE 0 END AS boost{k}"""


_FLIP = {
    1: f"CASE WHEN free1 AND {_no('b1')} THEN -0.74::DOUBLE ELSE 1 END",
    2: f"""CASE WHEN NOT free2 THEN 1 WHEN b2 = 'was' AND b1 IN ('as', 'be') THEN 1.5::DOUBLE
      WHEN {_no('b2')} THEN -0.74::DOUBLE ELSE 1 END""",
    3: f"""CASE WHEN NOT free3 THEN 1
      WHEN (b3 = 'was' AND b2 IN ('as', 'be')) OR b1 IN ('as', 'be') THEN 1.25::DOUBLE
      WHEN {_no('b3')} THEN -0.74::DOUBLE ELSE 1 END""",
}
for _k, _factor in ((1, 1.0), (2, 0.95), (3, 0.9)):
    _run = "v_caps" if _k == 1 else f"v{_k - 1}"
    CTES[f"step{_k}"] = f"""
    SELECT *, ({_run} + boost{_k}) * {_FLIP[_k]} AS v{_k}
    FROM (SELECT *, {_boost(_k, _run, _factor)} FROM step{_k - 1})
    """

CTES["idioms"] = """
SELECT * FROM (VALUES ('and the', 3.0::DOUBLE), ('the that', 1.5::DOUBLE), ('of and', -2.0::DOUBLE),
  ('that the', -1.5::DOUBLE), ('with the of', 2.0::DOUBLE), ('that is the', 2.5::DOUBLE)) v(phrase, value)
"""


def _idiom(*words: str) -> str:
    return f"(SELECT value FROM idioms WHERE phrase = {chr(32).join(words).replace(' ', chr(32) + '||' + repr(' ') + '||' + chr(32))})"


CTES["bench_words"] = """
SELECT list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: w <> '') AS w FROM benchmark
"""
CTES["bench_phrases"] = """
SELECT phrase, CAST((length(phrase) * 7 + ascii(phrase)) % 9 - 4 AS DOUBLE) AS value, length(phrase) % 5 = 0 AS damps
FROM (
  SELECT DISTINCT array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bench_words, (VALUES (2), (3)) s(k) WHERE len(w) >= k))
"""
CTES["phrase_hits"] = """
SELECT s.mention_id, t.pos, idiom, damp, coalesce(idiom, v3) + damp AS v_idiom
FROM (
  SELECT x.mention_id, x.tok, v3,
    CASE WHEN free3 THEN coalesce(p1.value, p2.value, p3.value, p4.value, p5.value, p6.value, p7.value) END AS idiom,
    CASE WHEN free3 AND (coalesce(p7.damps, false) OR coalesce(p5.damps, false)) THEN -0.293::DOUBLE ELSE 0 END AS damp
  FROM step3 x
  LEFT JOIN bench_phrases p1 ON p1.phrase = tok || ' ' || a1 || ' ' || a2
  LEFT JOIN bench_phrases p2 ON p2.phrase = tok || ' ' || a1
  LEFT JOIN bench_phrases p3 ON p3.phrase = b1 || ' ' || tok
  LEFT JOIN bench_phrases p4 ON p4.phrase = b2 || ' ' || b1 || ' ' || tok
  LEFT JOIN bench_phrases p5 ON p5.phrase = b2 || ' ' || b1
  LEFT JOIN bench_phrases p6 ON p6.phrase = b3 || ' ' || b2 || ' ' || b1
  LEFT JOIN bench_phrases p7 ON p7.phrase = b3 || ' ' || b2) s
JOIN token_near t ON t.mention_id = s.mention_id AND t.tok = s.tok
"""

CTES["step4"] = f"""
SELECT *, coalesce(idiom, v3) + damp AS v_idiom FROM (
  SELECT *, CASE WHEN free3 THEN coalesce({_idiom('tok', 'a1', 'a2')}, {_idiom('tok', 'a1')},
      {_idiom('b1', 'tok')}, {_idiom('b2', 'b1', 'tok')}, {_idiom('b2', 'b1')},
      {_idiom('b3', 'b2', 'b1')}, {_idiom('b3', 'b2')}) END AS idiom,
    CASE WHEN free3 AND ((b3 || ' ' || b2) IN ('to the', 'of the') OR (b2 || ' ' || b1) IN ('to the', 'of the'))
      THEN -0.293::DOUBLE ELSE 0 END AS damp
  FROM step3)
"""

CTES["step5"] = """
SELECT *, CASE WHEN lower(tok) IN ('is', 'by', 'this', 'of', 'on') OR (lower(tok) = 'that' AND coalesce(lower(a1), '') = 'of')
    THEN 0 ELSE v_least END AS score
FROM (
  SELECT *, CASE WHEN free1 AND lower(b1) = 'at' AND (b2 IS NULL OR lower(b2) NOT IN ('the', 'on'))
    THEN v_idiom * -0.74::DOUBLE ELSE v_idiom END AS v_least
  FROM step4)
"""

# Every occurrence of a scored token.
CTES["hits"] = """
SELECT s.*, t.pos, coalesce(t.turn_at, 0) AS turn,
  score * CASE WHEN t.pos < turn_at THEN 0.5::DOUBLE WHEN t.pos > turn_at THEN 1.5::DOUBLE ELSE 1 END AS weighted
FROM step5 s JOIN token_near t ON t.mention_id = s.mention_id AND t.tok = s.tok
"""

CTES["sums"] = """
SELECT e.mention_id, any_value(n) AS n, any_value(emph) AS emph,
  coalesce(sum(weighted), 0) AS total,
  coalesce(sum(weighted + 1) FILTER (weighted > 0), 0) AS up,
  coalesce(-sum(weighted - 1) FILTER (weighted < 0), 0) AS down,
  any_value(n) - count(*) FILTER (weighted <> 0) AS flat
FROM emphasis e LEFT JOIN hits h ON h.mention_id = e.mention_id
GROUP BY e.mention_id
"""

CTES["scores"] = """
SELECT mention_id,
  CASE WHEN n = 0 THEN 0 ELSE round(down2 / (up2 + down2 + flat), 3) END AS neg,
  CASE WHEN n = 0 THEN 0 ELSE round(flat / (up2 + down2 + flat), 3) END AS neu,
  CASE WHEN n = 0 THEN 0 ELSE round(up2 / (up2 + down2 + flat), 3) END AS pos,
  CASE WHEN n = 0 THEN 0 ELSE round(total2 / sqrt(total2 * total2 + 15), 4) + 0.0::DOUBLE END AS compound
FROM (
  SELECT *,
    CASE WHEN round(total, 9) > 0 THEN total + emph WHEN round(total, 9) < 0 THEN total - emph ELSE 0 END AS total2,
    CASE WHEN round(up, 9) > round(down, 9) THEN up + emph ELSE up END AS up2,
    CASE WHEN round(down, 9) > round(up, 9) THEN down + emph ELSE down END AS down2
  FROM sums)
"""

CTES["gram_counts"] = r"""
SELECT mention_id, lang, gram, count(*) AS c
FROM (
  SELECT mention_id, lang, unnest(list_transform(generate_series(1, length(word) - size + 1), lambda i: substring(word, i, size))) AS gram
  FROM (SELECT mention_id, lang, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS word FROM cleaned),
    (VALUES (1), (2), (3)) s(size)
  WHERE length(word) >= size)
GROUP BY mention_id, lang, gram
"""

CTES["profiles"] = """
SELECT lang, gram, n, ln((n + 1) / (sum(n) OVER (PARTITION BY lang) + v)) AS logp,
  ln(1 / (sum(n) OVER (PARTITION BY lang) + v)) AS floor
FROM (
  SELECT *, count(DISTINCT gram) OVER () AS v FROM (
    SELECT lang, gram, sum(c) AS n FROM gram_counts GROUP BY lang, gram))
"""

# The same from four folds, for the texts of the fifth.
CTES["held_profiles"] = """
SELECT lang, gram, n, ln((n + 1) / (sum(n) OVER (PARTITION BY lang) + v)) AS logp,
  ln(1 / (sum(n) OVER (PARTITION BY lang) + v)) AS floor
FROM (
  SELECT *, count(DISTINCT gram) OVER () AS v FROM (
    SELECT lang, gram, sum(c) AS n FROM gram_counts WHERE mention_id % 5 <> 0 GROUP BY lang, gram))
"""
CTES["held_pred"] = """
SELECT c.mention_id, pred, best FROM cleaned c LEFT JOIN (
  SELECT mention_id, g.lang AS pred, round(sum(c * coalesce(p.logp, g.floor)), 6) AS best
  FROM gram_counts d
  JOIN (SELECT DISTINCT gram FROM held_profiles) k ON k.gram = d.gram
  CROSS JOIN (SELECT DISTINCT lang, floor FROM held_profiles) g
  LEFT JOIN held_profiles p ON p.gram = d.gram AND p.lang = g.lang
  GROUP BY mention_id, g.lang
  QUALIFY row_number() OVER (PARTITION BY mention_id ORDER BY best DESC, g.lang) = 1) l ON l.mention_id = c.mention_id
WHERE c.mention_id % 5 = 0
"""

CTES["lang_scores"] = """
SELECT mention_id, g.lang, round(sum(c * coalesce(p.logp, g.floor)), 6) AS s
FROM gram_counts d
JOIN (SELECT DISTINCT gram FROM profiles) k ON k.gram = d.gram
CROSS JOIN (SELECT DISTINCT lang, floor FROM profiles) g
LEFT JOIN profiles p ON p.gram = d.gram AND p.lang = g.lang
GROUP BY mention_id, g.lang
"""

CTES["lang_pred"] = """
SELECT c.mention_id, pred, best FROM cleaned c LEFT JOIN (
  SELECT mention_id, lang AS pred, s AS best FROM lang_scores
  QUALIFY row_number() OVER (PARTITION BY mention_id ORDER BY s DESC, lang) = 1) l ON l.mention_id = c.mention_id
"""

CTES["bow_texts"] = rf"""
SELECT mention_id, list_filter(regexp_split_to_array(lower(
  regexp_replace(translate(replace(
    regexp_replace(regexp_replace(text, '@{WORD}+', '', 'g'), 'http[^\n]?://{NOT_SPACE}+{SPACE}?', '', 'g'),
    '_', ''), '!"#$%&''()*+,-./:;<=>?@[\]^`{{|}}~', '                               '),
  '\p{{Nd}}+', '', 'g')), '{SPACE}+'), lambda w: w <> '') AS words
FROM texts
"""

# --- Fixed values: Spark's default English stop words ---------------------------------------------
STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()
# ------------------------------------------------------------------------------------------------
_IN = ", ".join("'" + w.replace("'", "''") + "'" for w in STOPWORDS)

CTES["stopwords"] = f"SELECT unnest([{_IN}]) AS word"

CTES["word_counts"] = """
SELECT mention_id, word, count(*) AS n
FROM (SELECT mention_id, unnest(words) AS word FROM bow_texts)
WHERE length(word) > 1 AND (word IN ('not', 'no') OR word NOT IN (SELECT word FROM stopwords))
GROUP BY mention_id, word
"""

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_M1 = f"^({_C})?{_V}{_C}"
_M2 = f"^({_C})?{_V}{_C}{_V}{_C}"
_M1_ONLY = f"^({_C})?{_V}{_C}({_V})?$"
_CVC = f"^({_C}({_V}{_C})*|({_V}{_C})+)[aeiouy][^aeiouwxyY]$"
_VC = "^[aeiou][^aeiou]$"
_VOWEL = f"^({_C})?[aeiouy]"
_CONS = f"^({_C})?({_V}{_C})*$"
_S2 = (
    "ational|tional|enci|anci|izer|bli|alli|entli|eli|ousli|ization|ation|ator|alism|iveness|fulness|"
    "ousness|aliti|iviti|biliti|fulli|logi"
)
_T2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive",
    "biliti": "ble", "fulli": "ful", "logi": "log",
}
_T3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_S4 = "al|ance|ence|er|ic|able|ible|ant|ement|ment|ent|ion|ou|ism|ate|iti|ous|ive|ize"
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}


def _case(key: str, table: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items()) + " END"


CTES["vocab"] = "SELECT DISTINCT word FROM word_counts"
CTES["stem1"] = """
SELECT word, CASE
  WHEN regexp_matches(w, '^.ies$') THEN regexp_replace(w, 's$', '')
  WHEN regexp_matches(w, '(ss|i)es$') THEN regexp_replace(w, 'es$', '')
  WHEN regexp_matches(w, '[^s]s$') THEN regexp_replace(w, 's$', '')
  ELSE w END AS w
FROM (SELECT word, regexp_replace(word, '^y', 'Y') AS w FROM vocab)
"""
CTES["stem2"] = f"""
SELECT word, CASE
  WHEN sfx = '' THEN w
  WHEN sfx = 'ied' THEN CASE WHEN length(w) = 4 THEN r || 'ie' ELSE r || 'i' END
  WHEN sfx = 'eed' THEN CASE WHEN regexp_matches(r, '{_M1}') THEN r || 'ee' ELSE w END
  WHEN NOT regexp_matches(r, '{_VOWEL}') THEN w
  WHEN regexp_matches(r, '(at|bl|iz)$') THEN r || 'e'
  WHEN length(r) > 1 AND r[-1] = r[-2] AND regexp_matches(r, '{_CONS}')
    THEN CASE WHEN r[-1] IN ('l', 's', 'z') THEN r ELSE r[1:-2] END
  WHEN regexp_matches(r, '{_M1_ONLY}') AND (regexp_matches(r, '{_CVC}') OR regexp_matches(r, '{_VC}')) THEN r || 'e'
  ELSE r END AS w
FROM (SELECT word, w, regexp_extract(w, '(ied|eed|ed|ing)$') AS sfx, regexp_replace(w, '(ied|eed|ed|ing)$', '') AS r FROM stem1)
"""
CTES["stem3"] = f"""
SELECT word, CASE WHEN w LIKE '%alli' AND regexp_matches(left(w, length(w) - 4), '{_M1}') THEN left(w, length(w) - 2) ELSE w END AS w
FROM (SELECT word, CASE WHEN w LIKE '__%y' AND regexp_matches(left(w, length(w) - 1), '{_CONS}')
    THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM stem2)
"""
CTES["stem4"] = f"""
SELECT word, CASE WHEN sfx NOT IN ('', 'alli') AND regexp_matches(CASE WHEN sfx = 'logi' THEN r || 'l' ELSE r END, '{_M1}')
  THEN r || {_case('sfx', _T2)} ELSE w END AS w
FROM (SELECT word, w, regexp_extract(w, '^(.*?)({_S2})$', 1) AS r, regexp_extract(w, '^(.*?)({_S2})$', 2) AS sfx FROM stem3)
"""
_S3 = "|".join(_T3)
CTES["stem5"] = f"""
SELECT word, CASE WHEN sfx <> '' AND regexp_matches(r, '{_M1}') THEN r || {_case('sfx', _T3)} ELSE w END AS w
FROM (SELECT word, w, regexp_extract(w, '^(.*?)({_S3})$', 1) AS r, regexp_extract(w, '^(.*?)({_S3})$', 2) AS sfx FROM stem4)
"""
CTES["stem6"] = f"""
SELECT word, CASE WHEN sfx <> '' AND regexp_matches(r, '{_M2}') AND (sfx <> 'ion' OR regexp_matches(r, '[st]$')) THEN r ELSE w END AS w
FROM (SELECT word, w, regexp_extract(w, '^(.*?)({_S4})$', 1) AS r, regexp_extract(w, '^(.*?)({_S4})$', 2) AS sfx FROM stem5)
"""
CTES["stem7"] = f"""
SELECT word, CASE WHEN w LIKE '%ll' AND regexp_matches(left(w, length(w) - 1), '{_M2}') THEN left(w, length(w) - 1) ELSE w END AS w
FROM (
  SELECT word, CASE WHEN w LIKE '%e' AND (regexp_matches(r, '{_M2}') OR (regexp_matches(r, '{_M1_ONLY}')
      AND NOT regexp_matches(r, '{_CVC}') AND NOT regexp_matches(r, '{_VC}'))) THEN r ELSE w END AS w
  FROM (SELECT word, w, left(w, length(w) - 1) AS r FROM stem6))
"""
CTES["stems"] = f"""
SELECT word, coalesce({_case('word', _IRREGULAR)}, CASE WHEN length(word) <= 2 THEN word ELSE regexp_replace(w, '^Y', 'y') END) AS stem
FROM stem7
"""

CTES["bag"] = """
SELECT mention_id, stem AS term, CAST(sum(n) AS BIGINT) AS n
FROM word_counts c JOIN stems s ON s.word = c.word GROUP BY mention_id, stem
"""

CTES["term_freq"] = "SELECT term, CAST(sum(n) AS BIGINT) AS freq FROM bag GROUP BY term"

CTES["labelled"] = """
SELECT l.doc_id AS mention_id, quality + 2 * toxic AS label, l.doc_id % 5 = 0 AS test FROM labels l JOIN documents d ON d.doc_id = l.doc_id
"""
# The classifiers know the terms of the labelled texts only.
CTES["lbag"] = "SELECT b.*, label, test FROM bag b JOIN labelled l ON l.mention_id = b.mention_id"

# The joint class of subject and polarity, over all texts.
CTES["jlabelled"] = """
SELECT t.mention_id, t.mention_id % 5 = 0 AS test, CASE WHEN compound = 0 THEN 0 ELSE
  CASE subject WHEN 'a' THEN 1 ELSE 3 END + CASE WHEN compound > 0 THEN 1 ELSE 0 END END AS label
FROM texts t JOIN scores s ON s.mention_id = t.mention_id
"""
CTES["jbag"] = "SELECT b.*, label, test FROM bag b JOIN jlabelled l ON l.mention_id = b.mention_id"


def _bayes(p: str) -> None:
    """Tables of multinomial naive Bayes over ``{p}labelled`` and ``{p}bag`` (``lbag`` for the labels)."""
    bag = "jbag" if p else "lbag"
    CTES[f"{p}nb_theta"] = f"""
SELECT label, term, ln((n + 1) / (sum(n) OVER (PARTITION BY label) + count(*) OVER (PARTITION BY label))) AS theta
FROM (
  SELECT c.label, v.term, coalesce(sum(b.n), 0) AS n
  FROM (SELECT DISTINCT label FROM {p}labelled WHERE NOT test) c
  CROSS JOIN (SELECT DISTINCT term FROM {bag}) v
  LEFT JOIN {bag} b ON b.label = c.label AND b.term = v.term AND NOT b.test
  GROUP BY c.label, v.term)
"""
    CTES[f"{p}nb_pred"] = f"""
SELECT mention_id, label, prediction FROM (
  SELECT t.mention_id, t.label, p.label AS prediction, pi + coalesce(s, 0) AS score
  FROM (SELECT * FROM {p}labelled WHERE test) t
  CROSS JOIN (
    SELECT label, ln((count(*) + 1) / ((SELECT count(*) FROM {p}labelled WHERE NOT test) + count(*) OVER ())) AS pi
    FROM {p}labelled WHERE NOT test GROUP BY label) p
  LEFT JOIN (
    SELECT b.mention_id, h.label, sum(b.n * theta) AS s
    FROM {bag} b JOIN {p}nb_theta h ON h.term = b.term WHERE b.test GROUP BY b.mention_id, h.label) d
    ON d.mention_id = t.mention_id AND d.label = p.label)
QUALIFY row_number() OVER (PARTITION BY mention_id ORDER BY score DESC, prediction) = 1
"""


_bayes("")
_bayes("j")

# Gaussian naive Bayes over all terms. A text has few of them: the density at zero is summed once per class,
# and each term that a text has replaces its share of that sum.
CTES["moments"] = """
SELECT b.label, term, sum(n) / any_value(c.k) AS mu, sum(n * n) / any_value(c.k) - (sum(n) / any_value(c.k)) ** 2 AS var
FROM lbag b JOIN (SELECT label, count(*) AS k FROM labelled WHERE NOT test GROUP BY label) c ON c.label = b.label
WHERE NOT test GROUP BY b.label, term
"""
CTES["eps"] = """
SELECT 1e-9 * max(q / k - (s / k) ** 2) AS e
FROM (SELECT term, sum(n) AS s, sum(n * n) AS q FROM lbag WHERE NOT test GROUP BY term),
  (SELECT count(*) AS k FROM labelled WHERE NOT test)
"""
CTES["gauss"] = """
SELECT c.label, v.term, coalesce(mu, 0) AS mu, coalesce(var, 0) + e AS var
FROM (SELECT DISTINCT label FROM labelled WHERE NOT test) c CROSS JOIN (SELECT DISTINCT term FROM lbag) v CROSS JOIN eps
LEFT JOIN moments m ON m.label = c.label AND m.term = v.term
"""
CTES["gauss_pred"] = """
SELECT mention_id, label, prediction FROM (
  SELECT t.mention_id, t.label, p.label AS prediction, pi + at_zero + coalesce(s, 0) AS score
  FROM (SELECT * FROM labelled WHERE test) t
  CROSS JOIN (SELECT label, ln(count(*) / (SELECT count(*) FROM labelled WHERE NOT test)) AS pi
    FROM labelled WHERE NOT test GROUP BY label) p
  JOIN (SELECT label, sum(-0.5 * ln(2 * pi() * var) - mu * mu / (2 * var)) AS at_zero FROM gauss GROUP BY label) z
    ON z.label = p.label
  LEFT JOIN (
    SELECT b.mention_id, g.label, sum(mu * mu / (2 * var) - (n - mu) * (n - mu) / (2 * var)) AS s
    FROM lbag b JOIN gauss g ON g.term = b.term JOIN (SELECT DISTINCT term FROM moments) k ON k.term = b.term
    WHERE b.test GROUP BY b.mention_id, g.label) d
    ON d.mention_id = t.mention_id AND d.label = p.label)
QUALIFY row_number() OVER (PARTITION BY mention_id ORDER BY score DESC, prediction) = 1
"""
