"""The corpus build and the model run, each as one chain of operators."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosa.functions import text as T
from glosa.functions.features import extract_features
from glosa.functions.lexicons import Lexicon, content_tokens
from glosa.operators import balance as B
from glosa.operators.corpus import Corpus, validity_counts
from glosa.operators.language import detect_language
from glosa.operators.merge import build_metadata, merge_reviews
from glosa.session import cut_lineage


def process_reviews(
    df: DataFrame, names: DataFrame | None = None, lower: bool = True, language: PipelineModel | None = None
) -> DataFrame:
    """Patterns, clean text, language, sentences and tokens of every review.

    Blank texts get the empty result: language ``unknown`` and empty arrays.
    ``df`` has comment and lang; ``names`` adds item names for thing tags; ``language`` finds the
    language of clean texts that come without one.
    """
    if names is not None:
        from glosa.operators.merge import attach_thing_names

        df = attach_thing_names(df, names, "review_id", "comment")
    thing = F.col("thing_names") if names is not None else None
    blank = T.is_blank(F.col("comment"))
    none = F.array().cast("array<string>")
    cleaned = df.withColumn("clean_text", T.normalize_text(F.col("comment"), lower=lower, names=thing))
    if language is not None:
        missing = F.col("lang").isNull()
        cleaned = detect_language(language, cleaned, "clean_text", out="_found", where=missing)
        cleaned = cleaned.withColumn("lang", F.coalesce("lang", "_found")).drop("_found")
    cleaned = cleaned.withColumn("_words", T.word_tokens(F.col("clean_text")))
    return (
        cleaned.withColumn("tokens", F.when(blank, none).otherwise(content_tokens("_words", "lang")))
        .withColumn("lang", F.when(blank, F.lit("unknown")).otherwise(T.language_code(F.col("lang"))))
        .withColumn("sentences", F.when(blank, none).otherwise(T.sentences(F.col("comment"))))
        .withColumn("patterns", T.special_patterns(F.coalesce("comment", F.lit(""))))
        .drop("_words", "thing_names")
    )


def build_corpus(
    crawler: DataFrame,
    api: DataFrame,
    games: DataFrame,
    ranks: DataFrame,
    stats: DataFrame,
    source: str = "combined",
    min_tokens: int = 3,
    strategy: str | None = "undersample",
    synonyms: B.Synonyms | None = None,
    lexicon: Lexicon | None = None,
    with_features: bool = True,
    language: PipelineModel | None = None,
) -> tuple[Corpus, DataFrame, DataFrame]:
    """Merge, process, filter and balance; returns (corpus, validity counts, balance report).

    ``crawler`` and ``api`` may carry ``lang``; texts without one get the language that the
    model ``language`` finds, or English if there is no model.
    Item references in texts become the names that ``games`` holds.
    The processed rows are written once to the shared folder: filtering,
    balancing and reporting all read them.
    """
    merged = merge_reviews(crawler, api, source)
    rows = merged.withColumn("label", T.rating_label(F.col("rating"))).withColumn(
        "review_id", F.pmod(F.xxhash64("game_id", F.lower(F.trim("username")), "comment"), F.lit(1 << 62))
    )
    if "lang" not in rows.columns:
        rows = rows.withColumn("lang", F.lit(None if language is not None else "en").cast("string"))
    names = None
    if "name" in games.columns:
        names = games.groupBy(F.col("game_id").alias("id")).agg(F.min("name").alias("name"))
    processed = process_reviews(rows, names, language=language).drop("sentences", "patterns")
    if with_features:
        processed = extract_features(processed, lexicon)
    processed = cut_lineage(processed)
    counts = validity_counts(processed, min_tokens)
    valid = Corpus(processed).valid(min_tokens).documents
    final = valid if strategy is None else B.balance(valid, strategy, synonyms=synonyms)
    marked = final if strategy is not None else final.withColumn("is_augmented", F.lit(False))
    report = B.balance_report(valid, marked)
    return Corpus(final, build_metadata(games, ranks, stats)), counts, report
