"""Support per region and its comparison with a known outcome.

The subjects stay in one table: each summary is a single grouped pass with one conditional count per
subject, instead of one aggregate per subject joined afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinions.functions.values import leader_of, ratio, to_double, to_int
from opinions.operators.scope import positives


def counts_by(df: DataFrame, key: str, subjects: Sequence[str], in_all: bool) -> DataFrame:
    """Rows per key, one column per subject; ``in_all`` keeps keys that every subject has."""
    out = df.groupBy(key).agg(
        *[F.count_if(F.col("subject") == s).alias(f"n_{s}") for s in subjects]
    )
    if in_all:
        for s in subjects:
            out = out.filter(F.col(f"n_{s}") > 0)
    return out


def polarity_distribution(pop: DataFrame, subjects: Sequence[str]) -> DataFrame:
    return counts_by(pop, "polarity", subjects, in_all=True)


def positive_by_region(pop: DataFrame, subjects: Sequence[str], in_all: bool = True) -> DataFrame:
    return counts_by(positives(pop).filter("region IS NOT NULL"), "region", subjects, in_all)


def with_leader(by_region: DataFrame, subjects: Sequence[str], tie: str = "first") -> DataFrame:
    return by_region.withColumn("leader", leader_of([F.col(f"n_{s}") for s in subjects], subjects, tie))


def weights_join(leaders: DataFrame, outcome: DataFrame) -> DataFrame:
    return leaders.join(outcome.select("region", "weight"), "region")


def weight_totals(weighted: DataFrame) -> DataFrame:
    return weighted.groupBy("leader").agg(F.sum(to_int(F.col("weight"))).alias("weight"))


def region_polarity_counts(df: DataFrame) -> DataFrame:
    return (
        df.filter("region IS NOT NULL")
        .groupBy("subject", "region", "polarity")
        .agg(F.count("user_id").alias("n"))
    )


def region_mentions_both(pos: DataFrame, subjects: Sequence[str]) -> DataFrame:
    """Regions in which every subject has positive mentions, most mentions first."""
    out = positive_by_region(pos, subjects, in_all=True)
    return out.orderBy(F.desc(f"n_{subjects[0]}"), "region")


def scoreboard(pos: DataFrame, spine: DataFrame, subjects: Sequence[str]) -> DataFrame:
    """Every region of the spine with all counts, the ratio of the first two and the leader (a draw goes to
    the last subject)."""
    counts = positive_by_region(pos, subjects, in_all=False)
    cols = [f"n_{s}" for s in subjects]
    out = spine.join(counts, "region", "left").na.fill(0, subset=cols)
    out = out.withColumn("ratio", ratio(F.col(cols[0]), F.col(cols[1])))
    return with_leader(out, subjects, tie="last")


def with_region_code(df: DataFrame, region_dim: DataFrame) -> DataFrame:
    return df.join(region_dim.select("region", "region_code"), "region", "left")


def outcome_agreement(board: DataFrame, outcome: DataFrame) -> DataFrame:
    both = board.select("region", "leader").join(outcome.select("region", "winner"), "region")
    return both.agg(F.count_if(F.col("leader") == F.col("winner")).alias("same"))


def _two_row_summary(df: DataFrame, winner: str, subjects: Sequence[str]) -> DataFrame:
    """One row per subject with its weight total, zero if it won nothing."""
    totals = df.agg(
        *[
            F.coalesce(F.sum(F.when(F.col(winner) == s, to_int(F.col("weight")))), F.lit(0)).alias(s)
            for s in subjects
        ]
    )
    return totals.unpivot([], list(subjects), "team", "weight")


def actual_weights(outcome: DataFrame, subjects: Sequence[str]) -> DataFrame:
    return _two_row_summary(outcome, "winner", subjects)


def predicted_weights(board: DataFrame, outcome: DataFrame, subjects: Sequence[str]) -> DataFrame:
    return _two_row_summary(weights_join(board, outcome), "leader", subjects)


def winner_weight_counts(outcome: DataFrame) -> DataFrame:
    return outcome.groupBy("winner", to_int(F.col("weight")).alias("weight")).agg(
        F.count(F.lit(1)).alias("n")
    )


def outcome_ratio(outcome: DataFrame) -> DataFrame:
    a, b = to_double(F.col("votes_a")), to_double(F.col("votes_b"))
    return outcome.select("region", ratio(a, b).alias("ratio_actual"))


def ratio_correlation(board: DataFrame, outcome: DataFrame) -> DataFrame:
    """Pearson correlation of the text ratio with the outcome ratio over regions that have both."""
    both = board.select("region", F.col("ratio").alias("ratio_texts")).join(
        outcome_ratio(outcome), "region"
    )
    both = both.na.drop(subset=["ratio_texts", "ratio_actual"])
    # Spark's own corr fails in ANSI mode where a column is constant; null says it better.
    spread = F.stddev_pop("ratio_actual") * F.stddev_pop("ratio_texts")
    r = F.try_divide(F.covar_pop("ratio_actual", "ratio_texts"), spread)
    return both.agg(r.alias("r"), F.count(F.lit(1)).alias("regions"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """x, y, r, n for each pair of numeric columns: Pearson's correlation over the rows that have both, and their number.

    All moments of all pairs come from one pass over the rows. ``r`` is null where a column is constant over those rows.
    """
    pairs = [(x, y) for i, x in enumerate(columns) for y in columns[i:]]
    moments = []
    for i, (x, y) in enumerate(pairs):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        a, b = (F.when(both, F.col(c).cast("double")) for c in (x, y))
        r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
        moments.append(F.struct(r.alias("r"), F.count_if(both).alias("n")).alias(f"p{i}"))
    cells = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"p{i}.r").alias("r"), F.col(f"p{i}.n").alias("n"))
        for i, (x, y) in enumerate(pairs)
        for a, b in {(x, y), (y, x)}
    ]
    return df.agg(*moments).select(F.inline(F.array(*cells)))


def outcome_correlations(board: DataFrame, outcome: DataFrame) -> DataFrame:
    """``correlation_matrix`` of the regions' counts and ratio with the outcome's ratio and weight."""
    known = outcome_ratio(outcome).join(outcome.select("region", to_int(F.col("weight")).alias("weight")), "region")
    counts = [c for c in board.columns if c.startswith("n_")]
    both = board.select("region", *counts, F.col("ratio").alias("ratio_texts")).join(known, "region")
    return correlation_matrix(both, [*counts, "ratio_texts", "ratio_actual", "weight"])
