"""Queries over labelled mentions: scope, populations, regions, outcome."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as t
from opinions.functions import values as v
from opinions.operators import scope
from opinions.plans import regional as r
from opinions.sources.io import first_rows

S = t.SUBJECTS
QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def scoped(spark, d):
    return scope.region_scope(t.mentions(spark, d), t.COUNTRIES, t.EXCLUDED)


def pop(spark, d, kind, order="dedup_first"):
    return scope.population(scoped(spark, d), kind, t.CUTOFF, order)


def board(spark, d, kind):
    spine = t.regions(spark, d).select("region")
    return r.scoreboard(pop(spark, d, kind, "positive_first"), spine, S)


@query
def scan_mentions(spark, d):
    return t.raw_mentions(spark, d).select("mention_id", "subject", "user_id", "polarity", "country", "region", "user_join_date")


@query
def capped_sample(spark, d):
    cols = ["mention_id", "subject", "polarity"]
    return first_rows(t.mentions(spark, d).select(*cols), 1000, "mention_id")


@query
def project_mentions(spark, d):
    wanted = ["user_join_date", "user_id", "country", "region", "city"]
    return scope.keep_columns(t.raw_mentions(spark, d), wanted).drop("country")


@query
def drop_missing_user(spark, d):
    return scope.drop_missing_user(t.raw_mentions(spark, d)).select("mention_id", "user_id", "region")


@query
def region_scope(spark, d):
    return scoped(spark, d).select("mention_id", "subject", "user_id", "polarity", "country", "region", "join_date")


@query
def established_users(spark, d):
    return scope.joined_before(scoped(spark, d), t.CUTOFF).select("mention_id", "user_id", "join_date")


@query
def unique_users(spark, d):
    return scope.one_per_user(scoped(spark, d), "first").select("subject", "user_id", "mention_id", "polarity")


@query
def keep_last_per_user(spark, d):
    out = scope.one_per_user(scope.positives(scoped(spark, d)), "last")
    return out.select("subject", "user_id", "mention_id", "polarity")


@query
def parse_join_date(spark, d):
    people = t.authors(spark, d)
    return people.select(F.col("author_id").alias("user_id"), "user_join_date", v.parse_join_date(F.col("user_join_date")).alias("join_date"))


@query
def join_date_parts(spark, d):
    day = v.parse_join_date(F.col("user_join_date"))
    return t.authors(spark, d).select(
        F.col("author_id").alias("user_id"), F.year(day).alias("y"), F.month(day).alias("m"), F.dayofmonth(day).alias("d")
    )


@query
def recode_labels(spark, d):
    p = F.col("polarity")
    return t.mentions(spark, d).select(
        "mention_id",
        v.recode(p, {-1: 0, 0: 2, 1: 1}, False).alias("zero_two_one"),
        v.recode(p, {-1: 1, 1: 2}, True).alias("kept"),
        v.recode(p, {-1: 3, 1: 4}, False).alias("nulled"),
    )


@query
def joint_class(spark, d):
    return t.mentions(spark, d).select(
        "mention_id", v.joint_class(F.col("subject"), F.col("polarity"), S).alias("class")
    )


@query
def union_corpora(spark, d):
    """Both corpora whole, by column name; the second one has a column that the first lacks."""
    m = t.mentions(spark, d).select("mention_id", "subject", "polarity", "ts")
    a, b = (m.filter(F.col("subject") == s) for s in S)
    second = b.select("ts", "polarity", "subject", "mention_id", F.upper("subject").alias("origin"))
    return a.unionByName(second, allowMissingColumns=True)


@query
def key_split(spark, d):
    return t.mentions(spark, d).select(
        "mention_id", v.in_test_split(F.col("mention_id")).cast("int").alias("test")
    )


@query
def region_code_lookup(spark, d):
    m = t.mentions(spark, d).select("mention_id", "region")
    return r.with_region_code(m, t.regions(spark, d))


@query
def region_polarity_counts(spark, d):
    return r.region_polarity_counts(t.mentions(spark, d))


@query
def positive_by_region_top10(spark, d):
    return first_rows(r.positive_by_region(pop(spark, d, "mentions"), S), 10, "region")


@query
def leader_flag(spark, d):
    both = r.positive_by_region(t.mentions(spark, d), S)
    sides = [F.col("n_a"), F.col("n_b")]
    return both.select(
        "region",
        "n_a",
        "n_b",
        v.leader_of(sides, S, "first").alias("tie_first"),
        v.leader_of(sides, S, "last").alias("tie_second"),
    )


@query
def cast_weights(spark, d):
    return t.outcome(spark, d).select(
        "region", "weight", v.to_int(F.col("weight")).alias("as_int"), F.round(v.to_double(F.col("votes_a")), 2).alias("votes")
    )


@query
def winner_weight_counts(spark, d):
    return r.winner_weight_counts(t.outcome(spark, d))


@query
def actual_weights(spark, d):
    return r.actual_weights(t.outcome(spark, d), S)


@query
def ratio_correlation(spark, d):
    out = r.ratio_correlation(board(spark, d, "established"), t.outcome(spark, d))
    return out.withColumn("r", F.round("r", 6))


@query
def correlation_matrix(spark, d):
    out = r.outcome_correlations(board(spark, d, "established"), t.outcome(spark, d))
    return out.withColumn("r", F.round("r", 6) + 0.0)


NOTATIONS = ("M-d-yyyy", "d-M-yyyy", "yyyy-M-d", "yyyy-M-d H:m:s")


@query
def date_notations(spark, d):
    return v.date_notations(t.authors(spark, d), "user_join_date", NOTATIONS)


@query
def dates_by_notation(spark, d):
    found = v.parse_dates(t.authors(spark, d), "user_join_date", "day", NOTATIONS)
    return found.select(F.col("author_id").alias("user_id"), "user_join_date", "day", F.col("day_unsure").cast("int").alias("unsure"))


@query
def outcome_ratio(spark, d):
    out = r.outcome_ratio(t.outcome(spark, d))
    return out.withColumn("ratio_actual", F.round("ratio_actual", 6))


def _per_population(kind):
    def both(spark, d):
        return r.positive_by_region(pop(spark, d, kind), S)

    def leaders(spark, d):
        return r.with_leader(both(spark, d), S)

    def weighted(spark, d):
        return r.weights_join(leaders(spark, d), t.outcome(spark, d))

    def rounded(spark, d):
        return board(spark, d, kind).withColumn("ratio", F.round("ratio", 6))

    return {
        "polarity_distribution": lambda s, d: r.polarity_distribution(pop(s, d, kind), S),
        "positive_by_region": both,
        "leader": leaders,
        "weights_join": weighted,
        "weight_totals": lambda s, d: r.weight_totals(weighted(s, d)),
        "region_scoreboard": rounded,
        "outcome_agreement": lambda s, d: r.outcome_agreement(board(s, d, kind), t.outcome(s, d)),
        "predicted_weights": lambda s, d: r.predicted_weights(board(s, d, kind), t.outcome(s, d), S),
        "region_mentions_both": lambda s, d: r.region_mentions_both(pop(s, d, kind, "positive_first"), S),
        "region_ratio_map": lambda s, d: r.with_region_code(rounded(s, d), t.regions(s, d)).select(
            "region_code", "ratio"
        ),
    }


for _kind in scope.POPULATIONS:
    for _name, _fn in _per_population(_kind).items():
        QUERIES[f"{_name}_{_kind}"] = _fn
