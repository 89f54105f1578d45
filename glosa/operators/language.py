"""Language of a text by naive Bayes over an explicit vocabulary of character n-grams.

The vocabulary holds the most frequent pairs and triples of characters of the training rows; the
model is one count per (n-gram, language) and small enough for every executor.  Texts become
count vectors row by row on the JVM, whole texts at a time.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizerModel, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosa.functions import tokens as K
from glosa.functions.text import is_blank, let
from glosa.operators.vectors import to_ml_vector
from glosa.session import cut_lineage

VOCABULARY = 5000
THRESHOLD = 0.70


def _flat(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "\n", " ")))


def _split(flat: Column) -> Column:
    return F.filter(F.split(flat, ""), lambda c: c != "")


def characters(text: Column) -> Column:
    """Characters of the whole text, lower-cased."""
    return _split(_flat(text))


def character_grams(text: Column) -> Column:
    """Pairs and triples of neighbouring characters, one entry per occurrence.

    A pattern that looks ahead finds them without an array of characters; it steps by UTF-16 units,
    so texts with characters beyond 16 bits take the way over the array.
    """

    def by_pattern(t: Column, n: int) -> Column:
        return F.regexp_extract_all(t, F.lit("(?s)(?=(" + "." * n + "))"), F.lit(1))

    def by_characters(t: Column) -> Column:
        return let(_split(t), lambda c: F.concat(K.ngrams(c, 2, ""), K.ngrams(c, 3, "")))

    def run(t: Column) -> Column:
        wide = t.rlike(r"[\x{10000}-\x{10FFFF}]")
        return F.when(wide, by_characters(t)).otherwise(F.concat(by_pattern(t, 2), by_pattern(t, 3)))

    return let(_flat(text), run)


def gram_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n): the n-grams of the rows with a text and a language, and under a null gram the texts of the language.

    The text is looked at inside one expression: a filter on it would clean it once more.
    """
    none = F.array().cast("array<string>")
    grams = let(F.col(text), lambda t: F.when(is_blank(t), none).otherwise(
        F.concat(F.array(F.lit(None).cast("string")), character_grams(t))))
    rows = df.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), grams.alias("grams"))
    return rows.select("lang", F.explode(K.elements("grams")).alias("gram")).groupBy("gram", "lang").agg(F.count(F.lit(1)).alias("n"))


def train_language_model(df: DataFrame, text: str = "comment", lang: str = "lang", size: int = VOCABULARY) -> PipelineModel:
    """Vocabulary, language numbers and naive Bayes, fitted on the rows with a text and a language.

    One pass over the texts counts the n-grams of every language; naive Bayes learns from sums only, so it is
    fitted on those: a row with the counts of a language, and one without any that weighs as much as its other texts.
    """
    counted = cut_lineage(gram_counts(df, text, lang))
    totals = counted.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("n").alias("n"))
    known = [r.gram for r in totals.orderBy(F.desc("n"), "gram").limit(size).collect()]
    if not known:
        raise ValueError("no text with a language to learn from")
    places = df.sparkSession.createDataFrame(list(enumerate(known)), "idx int, gram string")
    entries = counted.join(F.broadcast(places), "gram", "left").groupBy("lang").agg(
        F.sort_array(F.collect_list(F.when(F.col("idx").isNotNull(), F.struct("idx", F.col("n").cast("double").alias("n"))))).alias("es"),
        F.sum(F.when(F.col("gram").isNull(), F.col("n"))).cast("double").alias("texts"))
    summed = entries.select("lang", F.explode(F.array(
        F.struct(F.lit(1.0).alias("weight"), F.col("es.idx").alias("i"), F.col("es.n").alias("v")),
        F.struct((F.col("texts") - 1).alias("weight"), F.array().cast("array<int>").alias("i"), F.array().cast("array<double>").alias("v")))).alias("s"))
    learned = cut_lineage(summed.select("lang", "s.weight", to_ml_vector(F.col("s.i"), F.col("s.v"), len(known)).alias("counts")))
    languages = StringIndexer(inputCol="lang", outputCol="label_idx", stringOrderType="alphabetAsc").fit(learned)
    bayes = NaiveBayes(labelCol="label_idx", featuresCol="counts", weightCol="weight").fit(languages.transform(learned))
    return PipelineModel([CountVectorizerModel.from_vocabulary(known, "grams", "counts"), languages, bayes])


def detect_language(model: PipelineModel, df: DataFrame, text: str = "comment", threshold: float = THRESHOLD,
                    default: str = "en", out: str = "detected", where: Column | None = None) -> DataFrame:
    """Add the most likely language; ``default`` for blank texts and below the threshold.

    Rows for which ``where`` does not hold are not looked at and get null.
    """
    vocabulary, languages, bayes = model.stages
    wanted = F.lit(True) if where is None else where
    none = F.array().cast("array<string>")
    staged = df.withColumn("grams", F.when(wanted, character_grams(F.col(text))).otherwise(none))
    scored = bayes.transform(vocabulary.transform(staged)).withColumn("_p", F.unwrap_udt("probability")["values"])
    best = F.get(F.array(*[F.lit(x) for x in languages.labels]), F.col("prediction").cast("int"))
    sure = ~is_blank(F.col(text)) & (F.array_max("_p") >= threshold)
    found = F.when(wanted, F.when(sure, best).otherwise(F.lit(default)))
    return scored.withColumn("_found", found).select(*df.columns, F.col("_found").alias(out))
