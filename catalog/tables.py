"""Model tables derived from the driver's parquet tables; the SQL twins are in ``oracle.tables``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinions.operators.durable import durable
from opinions.operators.joins import fits_broadcast, lookup_join
from opinions.rules import RuleSet
from opinions.sources.io import fill_cluster, read_parquet

SUBJECTS = ("a", "b")
COUNTRIES = ("AMERICA", "EUROPE", "ASIA")
EXCLUDED = ("NATION_1", "NATION_7")
CUTOFF = "1996-01-01"
LANGS = ("de", "en", "es", "fr")
# Frequent invented words stand for the names of the rivals.
RIVALS = {"a": "tionou", "b": "erwh"}

# The driver's texts are invented words, so the rules get a word list that occurs in them.
RULES = RuleSet(
    boosters={"is": 0.293, "by": 0.293, "this": 0.293, "of": -0.293, "on": -0.293, "to the": -0.293, "of the": -0.293},
    negators=("no", "not", "for"),
    idioms={
        "and the": 3.0,
        "the that": 1.5,
        "of and": -2.0,
        "that the": -1.5,
        "with the of": 2.0,
        "that is the": 2.5,
    },
    contrast_word="from",
    least_word="at",
    least_exempt=("the", "on"),
    never_word="was",
    never_links=("as", "be"),
    softener=("that", "of"),
)


# Declared schemas: no job per table just to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """author_id, region, country, user_join_date (text in several notations)."""
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    # Countries and regions are a fixed handful of rows.
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    first_order = (
        read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("joined"))
    )
    d = F.col("joined")
    notation = F.pmod(F.col("c_custkey"), F.lit(5))
    written = (
        F.when(notation == 0, F.date_format(d, "MM/dd/yyyy"))
        .when(notation == 1, F.date_format(d, "MM-dd-yyyy"))
        .when(notation == 2, F.date_format(d, "M/d/yyyy"))
        .when(notation == 3, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(F.pmod(F.col("c_custkey"), F.lit(3)) == 0, F.lit("unknown"))
        .otherwise(F.date_format(d, "MM/dd/yyyy"))
    )
    return (
        customer.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(first_order, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("author_id"),
            F.col("n_name").alias("region"),
            F.col("r_name").alias("country"),
            written.alias("user_join_date"),
        )
    )


def with_authors(spark: SparkSession, sf_dir: str, facts: DataFrame) -> DataFrame:
    """Attach the author row; some mentions have no user or no known region."""
    people = durable(authors(spark, sf_dir))
    out = lookup_join(facts, people, {"user_id": "author_id"}, small=fits_broadcast(people))
    return out.withColumn(
        "user_id", F.when(F.col("mention_id") % 29 != 0, F.col("user_id"))
    ).withColumn("region", F.when(F.col("mention_id") % 31 != 0, F.col("region")))


def raw_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as labelled mentions."""
    kind = F.col("event_type")
    facts = read(spark, sf_dir, "events").select(
        F.col("event_id").alias("mention_id"),
        F.when(F.col("event_id") % 2 == 0, "a").otherwise("b").alias("subject"),
        "user_id",
        "ts",
        F.when(kind.isin("purchase", "signup"), 1).when(kind == "error", -1).otherwise(0).alias("polarity"),
    )
    return with_authors(spark, sf_dir, facts)


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_mentions(spark, sf_dir).filter("user_id IS NOT NULL")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the marks of social media posts added: reposts, names, links, emphasis."""
    lit = F.lit
    k = F.col("doc_id") % 5
    decorated = (
        F.when(k == 0, F.concat(lit("RT @"), F.col("source"), lit(": "), F.col("text"), lit(" why??")))
        .when(
            k == 1,
            F.concat(
                F.col("text"), lit(" https://ex.org/"), F.col("source"), lit("?id="), F.col("n_chars"), lit(" more_or_less")
            ),
        )
        .when(k == 2, F.concat(lit('"'), F.col("text"), lit("!!! @"), F.col("source"), lit("é1 don't?!?")))
        .when(
            k == 3,
            F.concat(lit("IT'S THAT GOOD! NOT "), F.upper("lang"), lit(" "), F.col("text"), lit(" THAN 4? 5? 6? 7?")),
        )
        .otherwise(F.col("text"))
    )
    docs = fill_cluster(read(spark, sf_dir, "documents"), "doc_id")
    return docs.select(
        F.col("doc_id").alias("mention_id"),
        F.when(F.regexp_extract("source", "([0-9]+)", 1).cast("int") % 2 == 0, "a").otherwise("b").alias("subject"),
        decorated.alias("text"),
        "lang",
        "source",
    )


def text_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with an author number; some have none. Author columns are attached after scoring, so
    that they are never joined to the texts themselves."""
    author = F.when(F.col("mention_id") % 29 != 0, F.col("mention_id") + 1)
    return texts(spark, sf_dir).select("mention_id", "subject", author.alias("user_id"), "text")


def outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region, winner, weight, votes_a, votes_b; text columns, some of them dirty."""
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    spent = F.col("o_totalprice").cast("decimal(18,2)")
    votes = (
        read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.sum(F.when(F.col("o_orderstatus") == "F", spent)).alias("a"),
            F.sum(F.when(F.col("o_orderstatus") == "O", spent)).alias("b"),
        )
    )
    zero = F.lit(0).cast("decimal(28,2)")
    per_nation = (
        customer.join(votes, F.col("c_custkey") == F.col("o_custkey"), "left")
        .groupBy("c_nationkey")
        .agg(
            F.count(F.lit(1)).alias("people"),
            F.coalesce(F.sum("a"), zero).cast("decimal(28,2)").alias("a"),
            F.coalesce(F.sum("b"), zero).cast("decimal(28,2)").alias("b"),
        )
    )
    key = F.col("n_nationkey")
    weight = (
        F.when(key == 13, "n/a")
        .when(key % 6 == 0, F.concat(F.lit(" "), F.col("people").cast("string")))
        .otherwise(F.col("people").cast("string"))
    )
    return (
        per_nation.join(F.broadcast(read(spark, sf_dir, "nation")), F.col("c_nationkey") == key)
        .select(
            F.col("n_name").alias("region"),
            F.when(F.col("a") >= F.col("b"), "a").otherwise("b").alias("winner"),
            weight.alias("weight"),
            F.col("a").cast("string").alias("votes_a"),
            F.col("b").cast("string").alias("votes_b"),
        )
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region, region_code; one region has no code."""
    key = F.col("n_nationkey")
    return read(spark, sf_dir, "nation").select(
        F.col("n_name").alias("region"),
        F.when(key != 24, F.concat(F.lit("N"), key.cast("string"))).alias("region_code"),
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """token, valence from the words of ``benchmark``."""
    words = read(spark, sf_dir, "benchmark").select(
        F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("token")
    )
    value = ((F.length("token") * 7 + F.ascii("token")) % 9 - 4).cast("double")
    return (
        words.filter(F.length("token") >= 4).distinct().withColumn("valence", value).filter("valence <> 0")
    )


def phrase_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """phrase, valence, damps from the two- and three-word phrases of ``benchmark``."""
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w != "")
    held = read(spark, sf_dir, "benchmark").select(words.alias("w"))

    def runs(k):
        some = F.transform("w", lambda _, i: F.slice("w", i + 1, k))
        return F.transform(F.filter(some, lambda p: F.size(p) == k), lambda p: F.array_join(p, " "))

    phrases = held.select(F.explode(F.concat(runs(2), runs(3))).alias("phrase")).distinct()
    value = ((F.length("phrase") * 7 + F.ascii("phrase")) % 9 - 4).cast("double")
    return phrases.select("phrase", value.alias("valence"), (F.length("phrase") % 5 == 0).alias("damps"))


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mention_id, label in 0..3."""
    return read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("mention_id"), (F.col("quality") + 2 * F.col("toxic")).alias("label")
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mention_id, text, label; the narrow labels are broadcast if they are measured to be small."""
    side = marks(spark, sf_dir)
    side = F.broadcast(side) if fits_broadcast(side) else side
    return texts(spark, sf_dir).select("mention_id", "text").join(side, "mention_id")
