"""Review-shaped views of the driver tables.

The tables hold no ratings or users, so those columns are derived by arithmetic
on ids; texts, languages and sources are the tables' own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glosa.functions.lexicons import Lexicon, content_tokens
from glosa.functions.text import normalize_text, rating_label, word_tokens
from glosa.session import spread


# Given schemas spare the job that infers them.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per document: ids, user, rating (some null), comment, time, language, label."""
    d = spread(table(spark, sf_dir, "documents"))
    rating = F.when(
        F.col("doc_id") % 23 != 0, (10 + (F.col("doc_id") * 37) % 91).cast("double") / F.lit(10.0)
    )
    return d.select(
        F.col("doc_id").alias("review_id"),
        F.substring("source", 4, 20).cast("bigint").alias("game_id"),
        F.concat(F.lit("user"), (F.col("doc_id") % 137).cast("string")).alias("username"),
        rating.alias("rating"),
        F.col("text").alias("comment"),
        (F.lit(1700000000) + F.col("doc_id") * 3600).alias("ts"),
        "lang",
    ).withColumn("label", rating_label(F.col("rating")))


def with_tokens(df: DataFrame) -> DataFrame:
    """Add clean_text and the content tokens of every row."""
    cleaned = df.withColumn("clean_text", normalize_text(F.col("comment")))
    words = cleaned.withColumn("_words", word_tokens(F.col("clean_text")))
    return words.withColumn("tokens", content_tokens("_words", "lang")).drop("_words")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_tokens(reviews(spark, sf_dir))


def crawler_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First source: two thirds of the reviews, some with a lower-case note prefix."""
    r = reviews(spark, sf_dir).filter("review_id % 3 <> 0")
    comment = F.when(F.col("review_id") % 5 == 0, F.concat(F.lit("note: "), "comment")).otherwise(F.col("comment"))
    return r.select("game_id", "username", "rating", comment.alias("comment"), "ts", F.col("review_id").alias("seq"))


def api_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second source: overlaps the first in a third of the reviews, with other casing and spacing."""
    r = reviews(spark, sf_dir).filter("review_id % 3 <> 1")
    comment = F.concat(
        F.when(F.col("review_id") % 5 == 0, F.lit(" NOTE: ")).otherwise(F.lit(" ")), F.col("comment")
    )
    return r.select(
        "game_id", F.upper("username").alias("username"), "rating", comment.alias("comment"),
        F.lit(None).cast("bigint").alias("ts"), F.col("review_id").alias("seq"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per part, in the shape of the metadata files."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("game_id"),
        F.col("p_name").alias("name"),
        (1900 + F.col("p_size")).cast("string").alias("yearpublished"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("description"),
        F.array(F.col("p_brand")).alias("publishers"),
        F.struct(
            F.split("p_name", " ").alias("mechanics"),
            F.array(F.col("p_type")).alias("categories"),
            F.array(F.concat(F.lit("size"), (F.col("p_size") % 7).cast("string"))).alias("families"),
        ).alias("classifications"),
    )


def game_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of three quarters of the items; every fifth name is null, rows come twice."""
    p = table(spark, sf_dir, "part").filter("p_partkey % 4 <> 3")
    row = p.select(
        F.col("p_partkey").alias("game_id"),
        F.when(F.col("p_partkey") % 5 != 0, F.upper("p_name")).alias("name"),
        (F.col("p_partkey") * 7 % 1009 + 1).alias("rank"),
        (F.col("p_retailprice") / 100).alias("bayesaverage"),
        F.when(F.col("p_partkey") % 6 == 0, F.lit(float("nan"))).otherwise(F.col("p_size") / 5.0).alias("average"),
        (F.col("p_partkey") % 2).cast("string").alias("is_expansion"),
        F.col("p_size").cast("bigint").alias("strategygames_rank"),
    )
    return row.withColumn("seq", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "rank", F.col("rank") + F.col("seq") * 100000
    )


def game_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review counts per item as text, some as ``12.0``, some ``N/A``."""
    r = reviews(spark, sf_dir).filter("game_id % 3 <> 2")
    agg = r.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("all_n"), F.count("rating").alias("rated_n"),
    )
    return agg.select(
        "game_id",
        F.when(F.col("game_id") % 5 == 0, F.concat(F.col("all_n").cast("string"), F.lit(".0")))
        .when(F.col("game_id") % 7 == 0, F.lit("N/A")).otherwise(F.col("all_n").cast("string")).alias("total_all"),
        F.col("rated_n").cast("string").alias("total_rated"),
        F.lit(0).alias("seq"),
    )


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns with tags and entities derived from their words.

    The head of the word at position p is the word at position p div 2; the tag
    follows the word length; capitalised words are entities.
    """
    c = spread(table(spark, sf_dir, "conversations"))
    words = c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), F.col("text").alias("comment"),
        word_tokens(F.col("text")).alias("tokens"),
        F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0)).alias("names"),
    )

    def tag(t: Column) -> Column:
        n = F.length(t) % 5
        return F.when(n == 0, "ADJ").when(n == 1, "ADV").when(n == 2, "NOUN").when(n == 3, "VERB").otherwise("X")

    def label(t: Column) -> Column:
        n = F.length(t) % 3
        return F.when(n == 0, "PERSON").when(n == 1, "ORG").otherwise("GPE")

    return words.withColumn("tags", F.transform("tokens", lambda t, i: F.struct(
        t.alias("text"), tag(t).alias("pos"),
        F.get(F.col("tokens"), F.floor(i / 2).cast("int")).alias("head"),
    ))).withColumn(
        "entities", F.transform("names", lambda t: F.struct(t.alias("text"), label(t).alias("label")))
    ).drop("names")


# Word sets that occur in the generated prose, one per role.
PROSE_LEXICON = Lexicon(
    positive="re er en vi ble thor thon".split(),
    negative="th nd tion oned onre re".split(),
    intensifiers="an ha st eau".split(),
    mitigators="ti ou ea".split(),
    negations="es ed ere ier".split(),
    hedge_words="e ing ly".split(),
    propositional="nt oi ent e".split(),
    relational="sh hea ee".split(),
    discourse="wh elle te".split(),
    certainty="at".split(),
    domain={"parts": "orre st er".split(), "play": "ch sch que".split()},
    valence={"re": 1.9, "er": 2.3, "en": 1.5, "vi": 3.1, "th": -1.9, "nd": -2.5, "tion": -1.5, "ble": 0.4, "the": -0.6},
)
