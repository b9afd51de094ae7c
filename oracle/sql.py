"""SQL twin of every query that SQL can express."""

from __future__ import annotations

import re

from oracle.tables import CTES

# Read more than once, or too large to inline.
HELD = {
    "token_rows", "token_near", "first_hits", "step5", "gram_counts", "profiles", "word_counts", "vocab",
    "stems", "bag", "lbag", "jbag", "jlabelled", "moments", "gauss", "cleaned", "bench_phrases", "step3", "hits", "nb_theta", "jnb_theta",
}


def _needs(sql: str) -> set[str]:
    return {w for w in re.findall(r"[a-z_0-9]+", sql) if w in CTES}


def build(final: str) -> str:
    """``final`` behind the derived tables it reads, directly or through others."""
    todo, used = [final], set()
    while todo:
        for name in _needs(todo.pop()) - used:
            used.add(name)
            todo.append(CTES[name])
    parts = [
        f"{n} AS {'MATERIALIZED ' if n in HELD else ''}({CTES[n].strip()})" for n in CTES if n in used
    ]
    return f"WITH {', '.join(parts)} {final}" if parts else final


def _exact(name: str) -> str:
    return f"round({name}, 12) + 0.0::DOUBLE AS {name}"


_MEASURED = ("n_a", "n_b", "ratio_texts", "ratio_actual", "weight")

FINAL: dict[str, str] = {
    "scan_mentions": "SELECT mention_id, subject, user_id, polarity, country, region, user_join_date FROM raw_mentions",
    "capped_sample": "SELECT mention_id, subject, polarity FROM mentions ORDER BY mention_id LIMIT 1000",
    "project_mentions": "SELECT user_join_date, user_id, region FROM raw_mentions",
    "drop_missing_user": "SELECT mention_id, user_id, region FROM mentions",
    "region_scope": "SELECT mention_id, subject, user_id, polarity, country, region, join_date FROM scoped",
    "established_users": "SELECT mention_id, user_id, join_date FROM scoped WHERE join_date < DATE '1996-01-01'",
    "unique_users": "SELECT subject, user_id, mention_id, polarity FROM pop_users",
    "keep_last_per_user": "SELECT subject, user_id, mention_id, polarity FROM pos_users",
    "parse_join_date": """
        SELECT user_id, user_join_date, CAST(coalesce(
          try_strptime(replace(user_join_date, '/', '-'), '%m-%d-%Y'),
          try_strptime(user_join_date, '%Y-%m-%d %H:%M:%S')) AS DATE) AS join_date FROM authors""",
    "join_date_parts": """
        SELECT user_id, CAST(year(x) AS INT) AS y, CAST(month(x) AS INT) AS m, CAST(day(x) AS INT) AS d FROM (
          SELECT user_id, coalesce(try_strptime(replace(user_join_date, '/', '-'), '%m-%d-%Y'),
            try_strptime(user_join_date, '%Y-%m-%d %H:%M:%S')) AS x FROM authors)""",
    "recode_labels": """
        SELECT mention_id, CASE polarity WHEN -1 THEN 0 WHEN 0 THEN 2 WHEN 1 THEN 1 END AS zero_two_one,
          CASE polarity WHEN -1 THEN 1 WHEN 1 THEN 2 ELSE polarity END AS kept,
          CASE polarity WHEN -1 THEN 3 WHEN 1 THEN 4 END AS nulled FROM mentions""",
    "joint_class": """
        SELECT mention_id, CASE WHEN polarity = 0 THEN 0 WHEN subject = 'a' AND polarity = -1 THEN 1
          WHEN subject = 'a' THEN 2 WHEN polarity = -1 THEN 3 ELSE 4 END AS class FROM mentions""",
    "union_corpora": """
        SELECT mention_id, subject, polarity, ts, CASE WHEN subject = 'b' THEN 'B' END AS origin
        FROM mentions WHERE subject IN ('a', 'b')""",
    "key_split": "SELECT mention_id, CASE WHEN mention_id % 5 = 0 THEN 1 ELSE 0 END AS test FROM mentions",
    "region_code_lookup": """
        SELECT m.region, mention_id, region_code FROM mentions m LEFT JOIN regions r ON r.region = m.region""",
    "region_polarity_counts": """
        SELECT subject, region, polarity, count(user_id) AS n FROM mentions WHERE region IS NOT NULL
        GROUP BY subject, region, polarity""",
    "positive_by_region_top10": "SELECT * FROM both_mentions ORDER BY region LIMIT 10",
    "leader_flag": """
        SELECT *, CASE WHEN n_a >= n_b THEN 'a' ELSE 'b' END AS tie_first, CASE WHEN n_a > n_b THEN 'a' ELSE 'b' END AS tie_second
        FROM (SELECT region, count(*) FILTER (subject = 'a') AS n_a, count(*) FILTER (subject = 'b') AS n_b
          FROM mentions WHERE polarity = 1 AND region IS NOT NULL GROUP BY region) WHERE n_a > 0 AND n_b > 0""",
    "date_notations": """
        SELECT notation, fits, alone, CAST(row_number() OVER (ORDER BY fits DESC, alone DESC, i) AS INT) AS place FROM (
          SELECT i, notation, count(*) FILTER (day IS NOT NULL) AS fits, count(*) FILTER (day IS NOT NULL AND several = 1) AS alone
          FROM dated GROUP BY i, notation)""",
    "dates_by_notation": """
        SELECT user_id, any_value(user_join_date) AS user_join_date, first(day ORDER BY fits DESC, alone DESC, i) FILTER (day IS NOT NULL) AS day,
          CASE WHEN count(DISTINCT day) > 1 THEN 1 ELSE 0 END AS unsure
        FROM (
          SELECT *, count(day) OVER (PARTITION BY i) AS fits, count(*) FILTER (day IS NOT NULL AND several = 1) OVER (PARTITION BY i) AS alone
          FROM dated)
        WHERE alone > 0 OR fits = (SELECT max(n) FROM (SELECT count(day) AS n FROM dated GROUP BY i))
        GROUP BY user_id""",
    "cast_weights": """
        SELECT region, weight, TRY_CAST(trim(weight) AS INT) AS as_int,
          round(TRY_CAST(votes_a AS DOUBLE), 2) AS votes FROM outcome""",
    "winner_weight_counts": """
        SELECT winner, TRY_CAST(trim(weight) AS INT) AS weight, count(*) AS n FROM outcome GROUP BY 1, 2""",
    "actual_weights": """
        SELECT team, CAST(coalesce(sum(TRY_CAST(trim(weight) AS INT)), 0) AS BIGINT) AS weight
        FROM (VALUES ('a'), ('b')) s(team) LEFT JOIN outcome ON winner = team GROUP BY team""",
    "outcome_ratio": """
        SELECT region, CASE WHEN TRY_CAST(votes_b AS DOUBLE) <> 0
          THEN round(TRY_CAST(votes_a AS DOUBLE) / TRY_CAST(votes_b AS DOUBLE), 6) END AS ratio_actual FROM outcome""",
    "ratio_correlation": """
        SELECT round(covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0), 6) AS r, count(*) AS regions FROM (
          SELECT ratio AS y, CASE WHEN TRY_CAST(votes_b AS DOUBLE) <> 0
            THEN TRY_CAST(votes_a AS DOUBLE) / TRY_CAST(votes_b AS DOUBLE) END AS x
          FROM board_established b JOIN outcome o ON o.region = b.region) WHERE x IS NOT NULL AND y IS NOT NULL""",
    "correlation_matrix": f"""
        {" UNION ALL ".join(
            f"SELECT '{x}' AS x, '{y}' AS y, round(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0), 6) + 0.0::DOUBLE AS r, "
            f"count(*) AS n FROM measured WHERE {x} IS NOT NULL AND {y} IS NOT NULL"
            for x in _MEASURED for y in _MEASURED)}""",
    "lexicon_dim": "SELECT token, valence FROM lexicon",
    "exclude_cross_mention": """
        SELECT mention_id, subject FROM texts
        WHERE NOT (subject = 'a' AND contains(lower(text), 'tionou')) AND NOT (subject = 'b' AND contains(lower(text), 'erwh'))""",
    "clean_social": "SELECT mention_id, text FROM cleaned WHERE text <> ''",
    "clean_bow": "SELECT mention_id, array_to_string(words, ' ') AS text FROM bow_texts",
    "remove_punct": "SELECT mention_id, regexp_replace(text, '[[:punct:]]', '', 'g') AS text FROM texts",
    "tokens_min2": "SELECT mention_id, CAST(pos - 1 AS INT) AS pos, raw AS tok FROM token_rows",
    "strip_edge_punct": "SELECT raw AS tok, count(*) AS n, any_value(tok) AS bare FROM token_rows GROUP BY raw",
    "bare_token_set": """
        SELECT DISTINCT mention_id, tok FROM (
          SELECT mention_id, unnest(string_split(regexp_replace(text, '[[:punct:]]', '', 'g'), ' ')) AS tok FROM cleaned)
        WHERE length(tok) > 1""",
    "allcaps_differential": """
        SELECT mention_id, CAST(n AS INT) AS n, CASE WHEN caps BETWEEN 1 AND n - 1 THEN 1 ELSE 0 END AS mixed FROM doc_stats""",
    "punctuation_emphasis": """
        SELECT mention_id, CAST(exclaims AS INT) AS exclaims, CAST(asks AS INT) AS asks, round(emph, 6) AS emph FROM emphasis""",
    "token_context": "SELECT mention_id, CAST(pos AS INT) AS pos, tok, b1, b2, b3, a1, a2 FROM token_near",
    "least_bigram": """
        SELECT mention_id, CAST(pos AS INT) AS pos, b1, tok FROM token_near WHERE lower(tok) = 'at' AND lower(b1) <> 'the'""",
    "token_ngrams": """
        SELECT b1 || ' ' || tok AS two, b2 || ' ' || b1 || ' ' || tok AS three, count(*) AS n
        FROM token_near WHERE b1 IS NOT NULL GROUP BY 1, 2""",
    "lexicon_hits": "SELECT mention_id, CAST(pos AS INT) AS pos, tok, valence FROM hits",
    "first_context_score": f"SELECT mention_id, CAST(pos AS INT) AS pos, CAST(first AS INT) AS first, tok, {_exact('score')} FROM hits",
    "caps_effect": f"SELECT mention_id, CAST(pos AS INT) AS pos, CAST(shout AS INT) AS shout, {_exact('v_caps')} FROM hits",
    "booster_effect": f"SELECT mention_id, CAST(pos AS INT) AS pos, {_exact('boost1')}, {_exact('boost2')}, {_exact('boost3')} FROM hits",
    "negation_effect": f"SELECT mention_id, CAST(pos AS INT) AS pos, {_exact('v1')}, {_exact('v2')}, {_exact('v3')} FROM hits",
    "idiom_override": f"SELECT mention_id, CAST(pos AS INT) AS pos, {_exact('idiom')}, {_exact('damp')}, {_exact('v_idiom')} FROM hits",
    "phrase_table": f"""
        SELECT mention_id, CAST(pos AS INT) AS pos, {_exact('idiom')}, {_exact('damp')}, {_exact('v_idiom')} FROM phrase_hits""",
    "least_rule": f"SELECT mention_id, CAST(pos AS INT) AS pos, {_exact('v_idiom')}, {_exact('v_least')} FROM hits",
    "contrast_reweight": f"""
        SELECT mention_id, CAST(pos AS INT) AS pos, CAST(turn AS INT) AS turn, {_exact('score')}, {_exact('weighted')} FROM hits""",
    "sentiment_scores": """
        SELECT *, CASE WHEN compound > 0 THEN 1 WHEN compound < 0 THEN -1 ELSE 0 END AS polarity FROM scores""",
    "sentiment_label": """
        SELECT mention_id, CASE WHEN compound > 0 THEN 1 WHEN compound < 0 THEN -1 ELSE 0 END AS polarity FROM scores""",
    "langid_profiles": "SELECT lang, gram, CAST(n AS BIGINT) AS n, round(logp, 6) AS logp FROM profiles",
    "langid_predict": "SELECT mention_id, pred, round(best, 3) AS best FROM lang_pred",
    "langid_held_out": "SELECT mention_id, pred, round(best, 3) AS best FROM held_pred",
    "langid_filter": "SELECT mention_id, pred FROM lang_pred WHERE pred = 'en'",
    "scored_mentions": """
        SELECT t.mention_id, t.subject, t.mention_id + 1 AS user_id, a.user_join_date, a.country,
          CASE WHEN t.mention_id % 31 <> 0 THEN a.region END AS region, neg, neu, pos, compound,
          CASE WHEN compound > 0 THEN 1 WHEN compound < 0 THEN -1 ELSE 0 END AS polarity
        FROM texts t
        LEFT JOIN authors a ON a.user_id = t.mention_id + 1
        JOIN scores s ON s.mention_id = t.mention_id
        JOIN lang_pred l ON l.mention_id = t.mention_id AND pred = 'en'
        JOIN cleaned c ON c.mention_id = t.mention_id AND c.text <> ''
        WHERE t.mention_id % 29 <> 0
          AND NOT (subject = 'a' AND contains(lower(t.text), 'tionou'))
          AND NOT (subject = 'b' AND contains(lower(t.text), 'erwh'))""",
    "stopword_table": """
        SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM bow_texts)
        WHERE word IN (SELECT word FROM stopwords) GROUP BY word""",
    "stopword_filter": "SELECT mention_id, word, n FROM word_counts",
    "stem_step1a": """
        SELECT word, CASE WHEN regexp_matches(word, '^.ies$') THEN regexp_replace(word, 's$', '')
          WHEN regexp_matches(word, '(ss|i)es$') THEN regexp_replace(word, 'es$', '')
          WHEN regexp_matches(word, '[^s]s$') THEN regexp_replace(word, 's$', '') ELSE word END AS stem FROM vocab""",
    "stem_vocab": "SELECT word, stem FROM stems",
    "bag_of_words": "SELECT mention_id, term, n FROM bag",
    "term_topk": "SELECT term, freq FROM term_freq ORDER BY freq DESC, term LIMIT 20",
    "nb_multinomial": "SELECT mention_id, label, prediction FROM nb_pred",
    "nb_joint_class": "SELECT mention_id, label, prediction FROM jnb_pred",
    "feature_collisions": """
        SELECT terms_in_bucket, count(*) AS buckets, CAST(sum(terms_in_bucket) AS BIGINT) AS terms FROM (
          SELECT bucket, count(*) AS terms_in_bucket FROM (
            SELECT DISTINCT term, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % width AS bucket FROM lbag, (
              SELECT CAST(least(32768, 2 ** greatest(4, ceil(log2(count(DISTINCT term))))) AS BIGINT) AS width FROM lbag))
          GROUP BY bucket)
        GROUP BY terms_in_bucket""",
    "nb_gaussian": "SELECT mention_id, label, prediction FROM gauss_pred",
    "nb_accuracy": """
        SELECT 'multinomial' AS model, round(avg(CAST(prediction = label AS DOUBLE)), 6) AS accuracy, count(*) AS n FROM nb_pred
        UNION ALL SELECT 'gaussian', round(avg(CAST(prediction = label AS DOUBLE)), 6), count(*) FROM gauss_pred""",
}

for _p in ("mentions", "users", "established"):
    FINAL |= {
        f"polarity_distribution_{_p}": f"""
            SELECT a.polarity, n_a, n_b
            FROM (SELECT polarity, count(*) AS n_a FROM pop_{_p} WHERE subject = 'a' GROUP BY polarity) a
            JOIN (SELECT polarity, count(*) AS n_b FROM pop_{_p} WHERE subject = 'b' GROUP BY polarity) b
              ON a.polarity = b.polarity""",
        f"positive_by_region_{_p}": f"SELECT * FROM both_{_p}",
        f"leader_{_p}": f"SELECT * FROM leader_{_p}",
        f"weights_join_{_p}": f"SELECT * FROM weighted_{_p}",
        f"weight_totals_{_p}": f"""
            SELECT leader, CAST(sum(TRY_CAST(trim(weight) AS INT)) AS BIGINT) AS weight FROM weighted_{_p} GROUP BY leader""",
        f"region_scoreboard_{_p}": f"SELECT region, n_a, n_b, round(ratio, 6) AS ratio, leader FROM board_{_p}",
        f"outcome_agreement_{_p}": f"""
            SELECT count(*) FILTER (leader = winner) AS same FROM board_{_p} b JOIN outcome o ON o.region = b.region""",
        f"predicted_weights_{_p}": f"""
            SELECT team, CAST(coalesce(sum(TRY_CAST(trim(weight) AS INT)), 0) AS BIGINT) AS weight
            FROM (VALUES ('a'), ('b')) s(team)
            LEFT JOIN (SELECT leader, weight FROM board_{_p} b JOIN outcome o ON o.region = b.region) ON leader = team
            GROUP BY team""",
        f"region_mentions_both_{_p}": f"""
            SELECT region, n_a, n_b FROM board_{_p} WHERE n_a > 0 AND n_b > 0 ORDER BY n_a DESC, region""",
        f"region_ratio_map_{_p}": f"""
            SELECT region_code, round(ratio, 6) AS ratio FROM board_{_p} b LEFT JOIN regions r ON r.region = b.region""",
    }


def queries() -> dict[str, str]:
    return {name: build(final) for name, final in FINAL.items()}
