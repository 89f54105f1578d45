"""Queries whose rows hold what the given tables lack, derived from them: patterns, opinion phrases, entities with scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from glosa.functions import features as X
from glosa.functions import sentiment as S
from glosa.functions import text as T
from glosa.operators import merge as M
from glosa.operators import models as Ml
from glosa.plans import bayes_sql as Bs
from glosa.plans import corpus_queries as Cq
from glosa.plans import model_queries as Mq
from glosa.plans import oracle_parts as P
from glosa.plans import text_queries as Tq
from glosa.plans import views as V
from glosa.plans.registry import query
from glosa.session import scratch_dir
from glosa.sources import writers
from glosa.sources.store import ReviewStore

# ------------------------------------------------------------------- patterns
PATTERNS = {
    "emails": ("mail{}@example.org", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"),
    "dates": ("0{}/11/2024", r"\b\d{2}[/-]\d{2}[/-]\d{4}\b"),
    "hashtags": ("#Tag_{}", r"#[\pL\pN_]+"),
    "mentions": ("@user{}", r"@[\pL\pN_]+"),
    "urls": ("https://example.org/p?id={}", P.URL_RE2),
    "emojis": ("\U0001f600", "\U0001f600"),
}


@query(lambda: P.with_reviews("SELECT review_id, " + ", ".join(
    f"array_to_string(regexp_extract_all(t, {P.lit(regex)}), '|') AS {name}" for name, (_, regex) in PATTERNS.items())
    + " FROM (SELECT review_id, comment || " + " || ".join(
        f"' ' || replace({P.lit(example)}, '{{}}', CAST(review_id % 9 AS VARCHAR))" for example, _ in PATTERNS.values()) + " AS t FROM rev)"))
def pattern_contents(spark, sf):
    """Every kind of pattern occurs in every text."""
    digit = (F.col("review_id") % 9).cast("string")
    extra = [F.replace(F.lit(example), F.lit("{}"), digit) for example, _ in PATTERNS.values()]
    r = V.reviews(spark, sf).select("review_id", F.concat_ws(" ", "comment", *extra).alias("t"))
    found = r.select("review_id", T.special_patterns(F.col("t")).alias("p"))
    return found.select("review_id", *[F.array_join(f"p.{n}", "|").alias(n) for n in PATTERNS])


# --------------------------------------------------------------------- opinion
def _opinion_texts() -> str:
    words = Tq.L.W
    return f"""
op AS (SELECT review_id, CASE WHEN review_id % 4 = 3 THEN comment ELSE comment || ' ' || t || ' ' || m END AS comment FROM (
  SELECT review_id, comment, ({[p for p in words.FIRST_PERSON_PHRASES + words.APPEARANCE_PHRASES]!r})[1 + review_id % {len(words.FIRST_PERSON_PHRASES + words.APPEARANCE_PHRASES)}] AS t,
    ({[w for w in Tq.LEX.terms_of('subjective')]!r})[1 + review_id % {len(Tq.LEX.terms_of('subjective'))}] AS m FROM rev)),
ow AS (SELECT review_id, comment, regexp_extract_all(lower(comment), '[\\pL\\pN_]+') AS tokens FROM op)"""


@query(lambda: P.with_reviews("""
SELECT review_id, f + e + a AS marker_count, round((f + e + a) / CAST(greatest(len(tokens), 1) AS DOUBLE), 6) AS marker_density,
  f AS first_person_opinion_count, e AS epistemic_count, a AS appearance_count, array_to_string(list_sort(s), '|') AS marker_words
FROM (SELECT review_id, tokens, """ + Tq._phrases("lower(comment)", Tq.L.W.FIRST_PERSON_PHRASES) + " AS f, len(list_filter(tokens, lambda w: "
      + P.in_list("w", Tq.L.W.EPISTEMIC_MARKERS) + ")) AS e, " + Tq._phrases("lower(comment)", Tq.L.W.APPEARANCE_PHRASES) + " AS a, list_distinct(list_filter(tokens, lambda w: "
      + P.in_list("w", Tq.LEX.terms_of("subjective")) + ")) AS s FROM ow)", _opinion_texts().strip()))
def opinion_contents(spark, sf):
    """Opinion phrases and marker words of texts that hold some: counts, density and the words of the sparse feature."""
    words = Tq.L.W
    phrases = list(words.FIRST_PERSON_PHRASES) + list(words.APPEARANCE_PHRASES)
    terms = list(Tq.LEX.terms_of("subjective"))

    def pick(items):
        return F.get(F.array(*[F.lit(i) for i in items]), (F.col("review_id") % len(items)).cast("int"))

    more = F.concat_ws(" ", "comment", pick(phrases), pick(terms))
    r = V.reviews(spark, sf).select("review_id", F.when(F.col("review_id") % 4 == 3, F.col("comment")).otherwise(more).alias("comment"))
    marked = r.withColumn("tokens", T.word_tokens(F.col("comment"))).withColumn("marks", Tq.LEX.marks("tokens"))
    name = "subjectivity.marker_word="
    found = F.filter(X.word_features(F.col("tokens"), F.col("marks"), Tq.LEX), lambda p: p["feature"].startswith(name))
    staged = marked.select(
        "review_id", X.subjectivity(F.col("marks"), F.col("comment"), Tq.LEX).alias("s"),
        F.array_join(F.array_sort(F.transform(found, lambda p: F.replace(p["feature"], F.lit(name), F.lit("")))), "|").alias("marker_words"))
    return Tq._long(staged).join(staged.select("review_id", "marker_words"), "review_id")


@query(lambda: f"WITH {Tq.TAGGED.strip()},\nrev AS (SELECT doc_id AS review_id, comment FROM conv),\n" + ",\n".join([
    Tq.SENTENCES.strip(), Tq._scored("words", "review_id, sid").strip(), """
compound AS (SELECT parts.review_id, parts.sid, coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15) AS c
  FROM parts LEFT JOIN (SELECT review_id, sid, sum(score) AS s FROM scored GROUP BY review_id, sid) t
  ON t.review_id = parts.review_id AND t.sid = parts.sid)""".strip()]) + """
SELECT doc_id, len(names) AS total, round(CASE WHEN len(names) > 0 THEN coalesce(m, 0) ELSE 0 END, 6) AS avg_sentiment_near
FROM conv LEFT JOIN (SELECT review_id, avg(c) AS m FROM compound GROUP BY review_id) ON review_id = doc_id""")
def entity_sentiment(spark, sf):
    """Mean sentence score of the turns that name an entity."""
    d = S.with_sentence_scores(V.tagged(spark, sf), "comment", Tq.LEX, "scores")
    return d.select("doc_id", X.entity_summary(F.col("entities"), F.col("tokens"), F.col("scores")).alias("e")).select(
        "doc_id", F.col("e.total").cast("bigint").alias("total"), F.round("e.avg_sentiment_near", 6).alias("avg_sentiment_near"))


# ------------------------------------------------------------- store and files
@query(P.with_reviews("""
SELECT 'reviews' AS part, game_id, review_id AS id, NULL AS name FROM (SELECT * FROM lab WHERE game_id = 3 AND label = 'positive' ORDER BY review_id LIMIT 4)
UNION ALL SELECT 'metadata', game_id, NULL, name FROM meta WHERE game_id = 3
UNION ALL SELECT 'cleared', 0, 0, NULL""", Cq.META))
def store_lookup(spark, sf):
    """Reviews and metadata of one item, and what a cleared store holds."""
    store = ReviewStore(spark, scratch_dir(spark, "store"))
    store.save(V.reviews(spark, sf), M.build_metadata(V.games(spark, sf), V.game_ranks(spark, sf), V.game_stats(spark, sf)))
    none, no_id = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    reviews = store.reviews_by_game(3, "positive", 4).select(F.lit("reviews").alias("part"), "game_id", F.col("review_id").alias("id"), none.alias("name"))
    items = store.game_metadata(3).select(F.lit("metadata").alias("part"), "game_id", no_id.alias("id"), F.col("game_info.name").alias("name"))
    other = ReviewStore(spark, scratch_dir(spark, "store"))
    other.save(V.reviews(spark, sf), V.games(spark, sf).select("game_id"))
    other.clear()
    left = other.reviews().agg(F.count(F.lit(1)).alias("id"))
    return reviews.unionByName(items).unionByName(
        left.select(F.lit("cleared").alias("part"), F.lit(0).cast("bigint").alias("game_id"), "id", none.alias("name")))


@query(lambda: P.with_docs("""
SELECT CAST(game_id AS VARCHAR) AS game_id, count(*) AS n, CAST(sum(len(tokens)) AS BIGINT) AS n_tokens, min(name) AS name
FROM docs JOIN meta USING (game_id) GROUP BY game_id""", Cq.META))
def flat_corpus(spark, sf):
    """The two flat files of a corpus, written and read."""
    path = scratch_dir(spark, "flat")
    metadata = M.build_metadata(V.games(spark, sf), V.game_ranks(spark, sf), V.game_stats(spark, sf))
    writers.write_flat_corpus(V.documents(spark, sf), metadata, path)
    rows = spark.read.schema("game_id string, processed struct<tokens_no_stopwords: array<string>>").json(f"{path}/reviews")
    names = spark.read.schema("game_id bigint, game_info struct<name: string>").json(f"{path}/metadata")
    counted = rows.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("processed.tokens_no_stopwords").cast("bigint")).alias("n_tokens"))
    return counted.join(names.select(F.col("game_id").cast("string").alias("game_id"), "game_info.name"), "game_id")


# ------------------------------------------------------------------- encodings
@query(P.with_reviews("""
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS DOUBLE) AS label_idx, label AS predicted, n
FROM (SELECT label, count(*) AS n FROM lab WHERE label IS NOT NULL GROUP BY label)"""))
def label_codes(spark, sf):
    """Labels to alphabetical numbers and back."""
    rows = V.reviews(spark, sf).filter("label IS NOT NULL").select("label")
    indexer, back = Ml.label_stages(Mq.LABELS)
    coded = indexer.fit(rows).transform(rows).withColumn("prediction", F.col("label_idx"))
    return back.transform(coded).groupBy("label", "label_idx", "predicted").agg(F.count(F.lit(1)).alias("n"))


@query(lambda: P.with_docs("""
SELECT subset, size, count(*) AS n FROM base, (
  SELECT 'ngrams' AS subset, count(*) FILTER (WHERE block = 't') AS size FROM (SELECT DISTINCT block, f FROM x)
  UNION ALL SELECT 'opinion', count(*) FILTER (WHERE block = 'o') FROM (SELECT DISTINCT block, f FROM x)
  UNION ALL SELECT 'combined', count(*) FROM (SELECT DISTINCT block, f FROM x)) GROUP BY ALL""", *Bs.vectors_cte(50)))
def feature_subsets(spark, sf):
    """Sizes of the vectors of the three subsets."""
    rows = Mq._countable(spark, sf, 50)
    out = None
    for subset in Ml.SUBSETS:
        parts = F.unwrap_udt("v")
        staged = Ml.subset_stage(subset, "v").transform(rows)
        one = staged.groupBy(F.lit(subset).alias("subset"), F.coalesce(parts["size"], F.size(parts["values"])).cast("bigint").alias("size")).agg(
            F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out
