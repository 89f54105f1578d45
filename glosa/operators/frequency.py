"""Token counts, n-grams, concordances and positions over a corpus.

Counting explodes the token array and groups: Spark combines map-side, so the
hottest token costs each task one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from glosa.functions import tokens as K
from glosa.operators.skew import chunk_of, running_offset
from glosa.session import cut_lineage


def token_stream(df: DataFrame, *keep: str, tokens: str = "tokens") -> DataFrame:
    """One row per token with its position in the document."""
    return df.select(*keep, F.posexplode(K.elements(tokens)).alias("pos", "token"))


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    return (
        df.select(F.explode(K.elements(tokens)).alias("t"))
        .groupBy(F.lower("t").alias("token"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_common(counts: DataFrame, n: int = 20, item: str = "token") -> DataFrame:
    """Top ``n`` by count, ties in alphabetical order."""
    return counts.orderBy(F.desc("n"), item).limit(n)


def hapaxes(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    return token_counts(df, tokens).filter("n = 1").select("token")


def word_lengths(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    return (
        df.select(F.explode(K.elements(tokens)).alias("t"))
        .groupBy(F.length("t").cast("bigint").alias("length"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def lexical_diversity(df: DataFrame, *groups: str, tokens: str = "tokens", approximate: bool = False) -> DataFrame:
    """Tokens, types and their ratio per group, 0 for an empty corpus.

    Exact types are counted in two steps, first per (group, token), so one large
    group is spread over all tasks.
    """
    stream = df.select(*groups, F.explode(K.elements(tokens)).alias("token"))
    if approximate:
        agg = stream.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("tokens"), F.approx_count_distinct("token").alias("types")
        )
    else:
        per_token = stream.groupBy(*groups, "token").agg(F.count(F.lit(1)).alias("n"))
        agg = per_token.groupBy(*groups).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types")
        )
    ratio = F.when(F.col("tokens") > 0, F.col("types") / F.col("tokens")).otherwise(0.0)
    return agg.withColumn("diversity", ratio)


def ngram_counts(df: DataFrame, n: int, tokens: str = "tokens") -> DataFrame:
    """Counts of n-grams inside documents; none for n <= 0."""
    grams = K.ngrams(F.transform(tokens, F.lower), n)
    return df.select(F.explode(grams).alias("ngram")).groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))


def ngrams_across_documents(
    df: DataFrame, n: int, game: str = "game_id", row_id: str = "review_id", tokens: str = "tokens"
) -> DataFrame:
    """Counts of n-grams over all documents written one after the other.

    Every non-empty document borrows the next n-1 tokens from its successors,
    found by equi-joins on its dense rank.
    """
    if n <= 1:
        return ngram_counts(df, n, tokens)
    lowered = df.select(game, row_id, F.transform(tokens, F.lower).alias("tk"), F.lit(1).alias("one"))
    # Read several times below; filtered behind the write, since a filter before it tokenises every text once more.
    filled = cut_lineage(lowered).filter(F.size("tk") > 0)
    ranked = running_offset(filled, game, row_id, "one", "rank")
    lookahead = n - 1
    heads = ranked.select(
        F.explode(F.sequence(F.lit(1), F.lit(lookahead))).alias("step"),
        F.col("rank").alias("r"),
        F.slice("tk", 1, lookahead).alias("head"),
    ).select((F.col("r") - F.col("step")).alias("rank"), "step", "head")
    following = heads.groupBy("rank").agg(
        F.slice(
            F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("step", "head"))), lambda x: x["head"])),
            1, lookahead,
        ).alias("tail")
    )
    joined = ranked.join(following, "rank", "left").select(
        F.concat("tk", F.coalesce("tail", F.array().cast("array<string>"))).alias("tk")
    )
    return joined.select(F.explode(K.ngrams(F.col("tk"), n)).alias("ngram")).groupBy("ngram").agg(
        F.count(F.lit(1)).alias("n")
    )


def collocations(df: DataFrame, top_n: int = 20, tokens: str = "tokens") -> DataFrame:
    return most_common(ngram_counts(df, 2, tokens), top_n, "ngram")


def contexts(df: DataFrame, word: str, window: int, *keep: str, tokens: str = "tokens") -> DataFrame:
    """Concordance rows: left words, hit, right words, position."""
    hits = K.concordance(F.col(tokens), word, window)
    return df.select(*keep, F.inline(hits))


def common_contexts(df: DataFrame, words: list[str], window: int = 1, tokens: str = "tokens") -> DataFrame:
    """Counts of ``left _ right`` over the hits of any of the words."""
    found = K.word_contexts(F.col(tokens), words, window)
    return df.select(F.explode(found).alias("context")).groupBy("context").agg(F.count(F.lit(1)).alias("n"))


def dispersion(
    df: DataFrame, words: list[str], game: str = "game_id", row_id: str = "review_id", tokens: str = "tokens"
) -> DataFrame:
    """Corpus-wide offset of every hit of the given words.

    Only document lengths take part in the running sum, not tokens.
    """
    wanted = [w.lower() for w in words]
    lengths = df.select(
        game, row_id, F.size(tokens).cast("bigint").alias("len"),
        F.filter(
            F.transform(tokens, lambda t, i: F.struct(i.alias("pos"), F.lower(t).alias("word"))),
            lambda h: h["word"].isin(*wanted),
        ).alias("hits"),
    )
    placed = running_offset(cut_lineage(lengths), game, row_id, "len", "start")
    return placed.select(F.explode(K.elements("hits")).alias("h"), "start").select(
        (F.col("start") + F.col("h.pos")).alias("offset"), F.col("h.word").alias("word")
    )


def running_frequency(counts: DataFrame, n: int = 30, item: str = "token") -> DataFrame:
    """Top ``n`` counts with their running total; the window sees ``n`` rows."""
    w = Win.orderBy(F.desc("n"), item).rowsBetween(Win.unboundedPreceding, 0)
    return most_common(counts, n, item).withColumn("cumulative", F.sum("n").over(w))


def lexicon_hits(df: DataFrame, lexicon: DataFrame, *keys: str, tokens: str = "tokens") -> DataFrame:
    """Matches of a lexicon table of any size: rows (keys, name, section, token, n).

    Tokens are counted inside each document first, so the join moves distinct
    words only; Catalyst broadcasts the lexicon when its size allows.
    """
    words = df.select(*keys, F.explode(K.term_counts(F.col(tokens))).alias("c")).select(
        *keys, F.col("c.term").alias("token"), F.col("c.n").cast("bigint").alias("n")
    )
    terms = lexicon.select("name", "section", F.col("term").alias("token")).distinct()
    return words.join(terms, "token").select(*keys, "name", "section", "token", "n")


def length_summary(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Minimum, maximum and mean document length of documents that have tokens."""
    n = F.size(tokens).cast("bigint")
    return df.filter(n > 0).agg(
        F.min(n).alias("min_len"), F.max(n).alias("max_len"), F.avg(n).alias("mean_len")
    )


def join_texts(df: DataFrame, group: str, row_id: str, text: Column) -> DataFrame:
    """Texts of a group in id order, cut into chunks of 1024 rows.

    A whole group in one string would have to pass through one task; chunks keep
    the order, and writing them in order gives the joined text.
    """
    rows = chunk_of(df, group, row_id, 1024, "chunk")
    return (
        rows.groupBy(group, "chunk")
        .agg(F.sort_array(F.collect_list(F.struct(F.col(row_id).alias("i"), text.alias("t")))).alias("rows"))
        .select(group, "chunk", F.array_join(F.transform("rows", lambda r: r["t"]), "\n").alias("text"))
    )
