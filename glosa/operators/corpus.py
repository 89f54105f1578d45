"""Query API of a corpus: every method is a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glosa.functions import tokens as K
from glosa.functions.text import number_or_null
from glosa.operators import frequency as Q
from glosa.operators.skew import first_n
from glosa.session import cut_lineage

CLASSIFICATION_FIELDS = ("mechanics", "categories", "families")


class Corpus:
    """Documents (game_id, review_id, username, rating, comment, label, lang, tokens, ...) and games.

    Document order is (game_id, review_id).
    """

    def __init__(self, documents: DataFrame, games: DataFrame | None = None):
        self.documents, self.games = documents, games

    # ------------------------------------------------------------ selection
    def select(self, game_ids: list | None = None, categories: list[str] | None = None) -> Corpus:
        docs = self.documents
        if game_ids is not None:
            docs = docs.filter(F.col("game_id").isin(*game_ids))
        if categories is not None:
            docs = docs.filter(F.col("label").isin(*categories))
        return Corpus(docs, self.games)

    def filter_by_language(self, lang: str) -> Corpus:
        return Corpus(self.documents.filter(F.col("lang") == lang), self.games)

    def filter_by_game(self, game_ids: list | DataFrame) -> Corpus:
        """Accepts a list, or a frame with ``game_id`` for long lists (semi join)."""
        if isinstance(game_ids, DataFrame):
            return Corpus(self.documents.join(game_ids, "game_id", "left_semi"), self.games)
        return self.select(game_ids=game_ids)

    def filter_by_label(self, labels: list[str]) -> Corpus:
        return self.select(categories=labels)

    def documents_by_label(self, label: str) -> DataFrame:
        return self.select(categories=[label]).documents

    def documents_by_game(self, game_id) -> DataFrame:
        return self.select(game_ids=[game_id]).documents

    def valid(self, min_tokens: int = 3) -> Corpus:
        """Documents with clean text and at least ``min_tokens`` tokens."""
        return Corpus(self.documents.filter(valid_document(min_tokens)), self.games)

    # ---------------------------------------------------------- projections
    def raw(self) -> DataFrame:
        return self.documents.select("game_id", "review_id", F.col("comment").alias("raw_text"))

    def raw_join(self) -> DataFrame:
        return Q.join_texts(self.documents, "game_id", "review_id", F.col("comment"))

    def ratings(self) -> DataFrame:
        return self.documents.select("review_id", "rating")

    def users(self) -> DataFrame:
        return self.documents.select("review_id", "username")

    def words(self) -> DataFrame:
        return Q.token_stream(self.documents, "game_id", "review_id")

    def sents(self) -> DataFrame:
        from glosa.functions.text import sentences

        return self.documents.select("review_id", F.posexplode(sentences(F.col("comment"))).alias("pos", "sentence"))

    def game_ids(self) -> DataFrame:
        return self.documents.select("game_id")

    def categories(self) -> DataFrame:
        return self.documents.select("label").distinct().orderBy("label")

    def games_list(self) -> DataFrame:
        source = self.documents if self.games is None else self.games
        return source.select("game_id").filter("game_id IS NOT NULL").distinct().orderBy("game_id")

    # --------------------------------------------------------- aggregations
    def label_distribution(self, game_id=None) -> DataFrame:
        docs = self.documents if game_id is None else self.documents_by_game(game_id)
        return docs.filter("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("n"))

    def label_distribution_by_game(self) -> DataFrame:
        """Counts per (game, label) and, with ``is_total`` 1, per label, in one pass over two grouping sets."""
        labelled = self.documents.filter("label IS NOT NULL")
        return labelled.groupingSets([["game_id", "label"], ["label"]], "game_id", "label").agg(
            F.count(F.lit(1)).alias("n"), F.grouping("game_id").cast("int").alias("is_total"))

    review_counts_by_category = label_distribution

    def rating_distribution(self, game_id=None) -> DataFrame:
        docs = self.documents if game_id is None else self.documents_by_game(game_id)
        return docs.filter("rating IS NOT NULL").groupBy("rating").agg(F.count(F.lit(1)).alias("n"))

    def unique_users(self) -> DataFrame:
        """Distinct users; null counts as one user."""
        return self.documents.select("username").distinct()

    def num_unique_users(self) -> DataFrame:
        return self.unique_users().agg(F.count(F.lit(1)).alias("n"))

    def repeat_users(self) -> DataFrame:
        counts = self.documents.groupBy("username").agg(F.count(F.lit(1)).alias("n"))
        return counts.filter("n > 1")

    def num_repeat_users(self) -> DataFrame:
        return self.repeat_users().agg(F.count(F.lit(1)).alias("n"))

    def frequency_distribution(self) -> DataFrame:
        return Q.token_counts(self.documents)

    def most_common(self, n: int = 20) -> DataFrame:
        return Q.most_common(self.frequency_distribution(), n)

    def hapaxes(self) -> DataFrame:
        return Q.hapaxes(self.documents)

    def word_length_distribution(self) -> DataFrame:
        return Q.word_lengths(self.documents)

    def ngrams(self, n: int = 2, cross_document: bool = False) -> DataFrame:
        return Q.ngrams_across_documents(self.documents, n) if cross_document else Q.ngram_counts(self.documents, n)

    def bigrams(self) -> DataFrame:
        return self.ngrams(2)

    def trigrams(self) -> DataFrame:
        return self.ngrams(3)

    def collocations(self, top_n: int = 20) -> DataFrame:
        return Q.collocations(self.documents, top_n)

    def lexical_diversity(self) -> DataFrame:
        return Q.lexical_diversity(self.documents)

    def category_stats(self) -> DataFrame:
        return Q.lexical_diversity(self.documents.filter("label IS NOT NULL"), "label")

    def contexts(self, word: str, window: int = 5) -> DataFrame:
        return Q.contexts(self.documents, word, window, "game_id", "review_id")

    def common_contexts(self, words: list[str], window: int = 1) -> DataFrame:
        return Q.common_contexts(self.documents, words, window)

    def lexical_dispersion(self, words: list[str]) -> DataFrame:
        return Q.dispersion(self.documents, words)

    # -------------------------------------------------------- item metadata
    def stats_field(self, field: str, game_id=None) -> DataFrame:
        """Sum of a count over items; unreadable values add 0, ``reviews`` falls back to ``review``."""
        games = self.games if game_id is None else self.games.filter(F.col("game_id") == game_id)
        names = {f.name for f in games.schema["stats"].dataType.fields}
        other = field.replace("reviews", "review")
        found = field if field in names else other if other in names else None
        value = number_or_null(F.col(f"stats.{found}"), "bigint") if found else F.lit(None).cast("bigint")
        return games.agg(F.coalesce(F.sum(F.coalesce(value, F.lit(0))), F.lit(0)).alias("total"))

    def num_reviews(self, game_id=None) -> DataFrame:
        return self.stats_field("num_reviews", game_id)

    def num_reviews_commented(self, game_id=None) -> DataFrame:
        return self.stats_field("num_reviews_commented", game_id)

    def num_reviews_rated(self, game_id=None) -> DataFrame:
        return self.stats_field("num_reviews_rated", game_id)

    def num_reviews_rated_and_commented(self, game_id=None) -> DataFrame:
        return self.stats_field("num_reviews_rated_and_commented", game_id)

    def all_classifications(self, field: str = "mechanics") -> DataFrame:
        if field not in CLASSIFICATION_FIELDS:
            raise ValueError(f"field must be one of {CLASSIFICATION_FIELDS}")
        return self.games.select(F.explode(f"classifications.{field}").alias(field)).distinct().orderBy(field)

    def classifications_by_game(self, game_id) -> DataFrame:
        none = F.array().cast("array<string>")
        one = self.games.filter(F.col("game_id") == game_id)
        return one.select(*[F.coalesce(f"classifications.{f}", none).alias(f) for f in CLASSIFICATION_FIELDS])

    def metadata_for(self, game_id) -> DataFrame:
        return self.games.filter(F.col("game_id") == game_id)

    def _lookup(self, path: str, game_id=None) -> DataFrame:
        """One row: the value of one item; without an id, of the only item, else null."""
        out = path.split(".")[-1]
        if game_id is not None:
            return self.metadata_for(game_id).select(F.col(path).alias(out))
        only = F.when(F.count(F.lit(1)) == 1, F.max(path))
        return self.games.agg(only.alias(out))

    def overall_rank(self, game_id=None) -> DataFrame:
        return self._lookup("rankings.overall_rank", game_id)

    def strategy_rank(self, game_id=None) -> DataFrame:
        return self._lookup("rankings.strategygames_rank", game_id)

    def complexity_poll_avg(self, game_id=None) -> DataFrame:
        return self._lookup("polls.complexity_poll.poll_avg", game_id)

    def avg_rating(self, game_id=None) -> DataFrame:
        return self._lookup("stats.avg_rating", game_id)

    def bayes_average(self, game_id=None) -> DataFrame:
        return self._lookup("stats.bayes_average", game_id)

    def first_per_game(self, n: int) -> DataFrame:
        return first_n(self.documents, ["game_id"], n, "review_id")


def valid_document(min_tokens: int = 3):
    return (F.coalesce("clean_text", F.lit("")) != "") & (F.size("tokens") >= min_tokens)


def validity_counts(df: DataFrame, min_tokens: int = 3) -> DataFrame:
    """Kept and discarded documents per item."""
    ok = valid_document(min_tokens)
    return df.groupBy("game_id").agg(
        F.count_if(ok).alias("kept"), F.count_if(~ok).alias("discarded")
    )


def default_games(spark: SparkSession, ranks: DataFrame, last: int = 509, top: int = 100) -> DataFrame:
    """Ids 1..``last`` and the ``top`` best-ranked ids, without repeats."""
    best = ranks.filter("rank IS NOT NULL").orderBy("rank", "game_id").limit(top).select("game_id")
    return spark.range(1, last + 1).select(F.col("id").alias("game_id")).unionByName(best).distinct()


NUMBERS = ("num_reviews", "num_reviews_rated", "num_reviews_commented", "num_reviews_rated_and_commented")


def report_counts(documents: DataFrame, pair: tuple[str, str] = ("good", "bad"), kinds: tuple[str, ...] | None = None) -> DataFrame:
    """(kind, item, label, n): users, ratings, labels, tokens per label, n-grams and contexts, all or the ``kinds`` named, counted in one pass.

    All occurrences go into one aggregation, which combines map-side.  The item leads the key: rows that do not fit into
    memory are sorted by it, and few kinds would leave every comparison to the whole row.
    """
    none = F.lit(None).cast("string")

    def entry(kind: str, item: Column, label: Column = none) -> Column:
        return F.struct(F.lit(kind).alias("kind"), item.cast("string").alias("item"), label.alias("label"))

    def each(kind: str, items: Column, label: Column = none) -> Column:
        return F.transform(items, lambda item: entry(kind, item, label))

    lower = F.transform("tokens", F.lower)
    found = {
        "user": F.array(entry("user", F.col("username"))), "rating": F.array(entry("rating", F.col("rating"))),
        "label": F.array(entry("label", F.col("label"))), "token": each("token", F.col("tokens"), F.col("label")),
        "bigram": each("bigram", K.ngrams(lower, 2)), "trigram": each("trigram", K.ngrams(lower, 3)),
        "context": each("context", K.word_contexts(F.col("tokens"), list(pair), 2)),
    }
    parts = F.concat(*[found[k] for k in kinds or found])
    counted = documents.select(F.inline(parts)).groupBy("item", "label", "kind").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("kind", "item", "label", "n")


#: N-grams that the report shows at most.
REPORT_TOP = 10


class CorpusReport(Mapping):
    """The fixed bundle of corpus statistics, by name; a member is planned when it is asked for.

    The counted members but n-grams and contexts share one pass over the documents, made when the first of them is asked
    for and written to the shared folder.  N-grams and contexts are as many as the tokens, and only the most frequent are
    shown: they are counted by themselves, and no others written.  The sample, the contexts and the dispersion read the documents once each.
    """

    def __init__(self, corpus: Corpus, word: str = "game", pair: tuple[str, str] = ("good", "bad"),
                 dispersed: tuple[str, ...] = ("good", "game", "player")) -> None:
        self.corpus, self.word, self.pair, self.dispersed = corpus, word, pair, dispersed
        self._members: dict[str, Callable[[], DataFrame]] = {
            "unique_users": lambda: self._kind("user").agg(F.count(F.lit(1)).alias("n")),
            "repeat_users": lambda: self._kind("user").filter("n > 1").agg(F.count(F.lit(1)).alias("n")),
            "repeat_user_names": lambda: self._kind("user").filter("n > 1").select(F.col("item").alias("username")).orderBy("username").limit(10),
            "rating_distribution": lambda: self._kind("rating").filter("item IS NOT NULL").select(
                F.col("item").cast("double").alias("rating"), "n").orderBy(F.desc("n"), "rating").limit(10),
            "sample_text": lambda: corpus.raw().orderBy("game_id", "review_id").limit(5),
            "contexts": lambda: corpus.contexts(word, 3).orderBy("game_id", "review_id", "pos").limit(5),
            "common_contexts": lambda: Q.most_common(corpus.common_contexts(list(pair), 2), 5, "context"),
            "most_common": lambda: Q.most_common(self._tokens(), 15),
            "dispersion": lambda: corpus.lexical_dispersion(list(dispersed)),
            "hapaxes": lambda: self._tokens().filter("n = 1").select("token").orderBy("token").limit(20),
            "word_lengths": lambda: self._kind("token").groupBy(F.length("item").cast("bigint").alias("length")).agg(
                F.sum("n").alias("n")).orderBy("length").limit(10),
            "bigrams": lambda: Q.most_common(self.top_bigrams, REPORT_TOP, "ngram"),
            "trigrams": lambda: Q.most_common(self.top_trigrams, 5, "ngram"),
            "collocations": lambda: Q.most_common(self.top_bigrams, REPORT_TOP, "ngram"),
            "category_stats": self._categories,
            "label_distribution": lambda: self._kind("label").filter("item IS NOT NULL").select(F.col("item").alias("label"), "n"),
            "frequency": lambda: Q.most_common(self._tokens(), 30),
        }
        if corpus.games is not None:
            self._members.update({name: getattr(corpus, name) for name in NUMBERS})

    @cached_property
    def counts(self) -> DataFrame:
        return cut_lineage(report_counts(self.corpus.documents, self.pair, ("user", "rating", "label", "token")))

    @cached_property
    def top_bigrams(self) -> DataFrame:
        return cut_lineage(self.corpus.collocations(REPORT_TOP))

    @cached_property
    def top_trigrams(self) -> DataFrame:
        return cut_lineage(Q.most_common(self.corpus.trigrams(), REPORT_TOP, "ngram"))

    def _kind(self, kind: str) -> DataFrame:
        return self.counts.filter(F.col("kind") == kind)

    def _tokens(self) -> DataFrame:
        return self._kind("token").groupBy(F.lower("item").alias("token")).agg(F.sum("n").alias("n"))

    def _categories(self) -> DataFrame:
        sums = self._kind("token").filter("label IS NOT NULL").groupBy("label").agg(
            F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types"))
        return sums.withColumn("diversity", F.when(F.col("tokens") > 0, F.col("types") / F.col("tokens")).otherwise(0.0))

    def __getitem__(self, name: str) -> DataFrame:
        return self._members[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._members)

    def __len__(self) -> int:
        return len(self._members)


def corpus_report(corpus: Corpus, word: str = "game", pair: tuple[str, str] = ("good", "bad"),
                  dispersed: tuple[str, ...] = ("good", "game", "player")) -> CorpusReport:
    return CorpusReport(corpus, word, pair, dispersed)
