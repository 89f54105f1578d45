"""Corpus selections, counts, frequencies, contexts and item metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosa.functions import text as T
from glosa.operators import corpus as C
from glosa.operators import frequency as Q
from glosa.operators import merge as M
from glosa.plans import oracle_parts as P
from glosa.plans import views as V
from glosa.plans.build import process_reviews
from glosa.plans.registry import query
from glosa.session import cut_lineage
from glosa.sources.store import category_totals


def _docs(spark: SparkSession, sf: str) -> C.Corpus:
    return C.Corpus(V.documents(spark, sf))


def _reviews(spark: SparkSession, sf: str) -> C.Corpus:
    return C.Corpus(V.reviews(spark, sf))


# ------------------------------------------------------------ labels, filters
@query(P.with_reviews("""
SELECT game_id, label, count(*) AS n, 0 AS is_total FROM lab WHERE label IS NOT NULL GROUP BY game_id, label
UNION ALL SELECT NULL, label, count(*), 1 FROM lab WHERE label IS NOT NULL GROUP BY label"""))
def label_distribution(spark, sf):
    return _reviews(spark, sf).label_distribution_by_game()


@query(P.with_reviews("""
SELECT review_id, game_id, label, lang FROM lab
WHERE game_id IN (SELECT p_partkey FROM part WHERE p_size % 2 = 0)
  AND label IN ('positive', 'negative') AND lang = 'en'"""))
def corpus_filters(spark, sf):
    chosen = V.table(spark, sf, "part").filter("p_size % 2 = 0").select(F.col("p_partkey").alias("game_id"))
    picked = _reviews(spark, sf).filter_by_game(chosen).filter_by_label(["positive", "negative"])
    return picked.filter_by_language("en").documents.select("review_id", "game_id", "label", "lang")


@query(P.with_reviews("""
SELECT game_id, chunk, string_agg(comment, chr(10) ORDER BY review_id) AS text
FROM (SELECT *, (row_number() OVER (PARTITION BY game_id ORDER BY review_id) - 1) // 1024 AS chunk FROM rev)
GROUP BY game_id, chunk"""))
def raw_join(spark, sf):
    return _reviews(spark, sf).raw_join()


@query(P.with_reviews("SELECT review_id, game_id, comment AS raw_text, rating, username FROM rev"))
def raw_rating_user_columns(spark, sf):
    c = _reviews(spark, sf)
    return c.documents.select("review_id", "game_id", F.col("comment").alias("raw_text"), "rating", "username")


@query(lambda: P.with_docs("SELECT game_id, review_id, pos AS pos, token FROM toks"))
def token_stream(spark, sf):
    return _docs(spark, sf).words().select("game_id", "review_id", F.col("pos").cast("bigint").alias("pos"), "token")


@query("""
SELECT event_id, CASE WHEN user_id % 4 IN (0, 1) THEN CAST(user_id % 4 AS INTEGER) END AS flag,
  CASE WHEN code IN ('en','es','pt','fr','de','it','nl') THEN code ELSE 'en' END AS code,
  CASE event_type WHEN 'view' THEN 'spanish' WHEN 'click' THEN 'french' ELSE 'english' END AS stop_list
FROM (SELECT event_id, user_id, event_type,
        CASE event_type WHEN 'view' THEN 'es' WHEN 'click' THEN 'fr' WHEN 'error' THEN 'xx' ELSE 'unknown' END AS code
      FROM events)""")
def flag_and_language_codes(spark, sf):
    e = V.spread(V.table(spark, sf, "events"))
    raw = F.when(F.col("event_type") == "view", "es-ES").when(F.col("event_type") == "click", "FR").when(
        F.col("event_type") == "error", "xx-YY").when(F.col("event_type") == "signup", "unknown")
    code = T.language_code(raw)
    return e.select(
        "event_id",
        T.flag_value(F.concat(F.lit(" "), (F.col("user_id") % 4).cast("string"), F.lit(" "))).alias("flag"),
        code.alias("code"),
        T.stopword_language(F.substring_index(F.lower(raw), "-", 1)).alias("stop_list"),
    )


@query(lambda: P.with_docs("""
SELECT review_id, CASE WHEN blank THEN 'unknown' ELSE lang END AS language,
  CASE WHEN blank THEN '' ELSE clean_text END AS clean_text,
  CASE WHEN blank THEN 0 ELSE len(tokens) END AS n_tokens,
  CASE WHEN blank THEN 0 ELSE len(list_filter(string_split(regexp_replace(comment, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '')) END AS n_sentences,
  CASE WHEN blank THEN 0 ELSE len(regexp_extract_all(comment, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}')) END AS n_emails
FROM (SELECT *, review_id % 11 = 0 AS blank FROM docs)"""))
def empty_defaults(spark, sf):
    comment = F.when(F.col("review_id") % 11 == 0, F.lit("  \n ")).otherwise(F.col("comment"))
    done = process_reviews(V.reviews(spark, sf).withColumn("comment", comment))
    return done.select(
        "review_id", F.col("lang").alias("language"), "clean_text",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.size("sentences").cast("bigint").alias("n_sentences"),
        F.size("patterns.emails").cast("bigint").alias("n_emails"),
    )


@query(lambda: P.with_docs("""
SELECT lang, count(*) AS n, min(len(tokens)) AS min_len, max(len(tokens)) AS max_len,
       round(avg(len(tokens)), 6) AS mean_len
FROM docs WHERE len(tokens) > 0 GROUP BY lang
UNION ALL SELECT NULL, count(*), min(len(tokens)), max(len(tokens)), round(avg(len(tokens)), 6)
FROM docs WHERE len(tokens) > 0"""))
def language_and_length_summary(spark, sf):
    # A filter on the length would be pushed below it, and every text tokenised twice.
    size = F.size("tokens").cast("bigint")
    d = V.documents(spark, sf).select("lang", F.nullif(size, F.lit(0).cast("bigint")).alias("len"))
    return d.rollup("lang").agg(
        F.count("len").alias("n"), F.min("len").alias("min_len"), F.max("len").alias("max_len"),
        F.round(F.avg("len"), 6).alias("mean_len"),
    ).filter("n > 0")


@query(P.with_reviews("SELECT DISTINCT game_id, label FROM lab WHERE label IS NOT NULL"))
def distinct_categories(spark, sf):
    return V.reviews(spark, sf).filter("label IS NOT NULL").select("game_id", "label").distinct().orderBy("game_id", "label")


@query("""
WITH best AS (SELECT p_partkey AS game_id FROM part WHERE p_partkey % 4 <> 3
              ORDER BY p_partkey * 7 % 1009 + 1, p_partkey LIMIT 100)
SELECT p_partkey AS game_id, p_name AS name FROM part
WHERE p_partkey BETWEEN 1 AND 509 OR p_partkey IN (SELECT game_id FROM best)""")
def default_game_set(spark, sf):
    ranks = M.keep_first(V.game_ranks(spark, sf), "game_id", "seq")
    wanted = C.default_games(spark, ranks)
    return V.games(spark, sf).join(wanted, "game_id", "left_semi").select("game_id", "name")


META = """
r AS (SELECT p_partkey AS game_id, CASE WHEN p_partkey % 5 <> 0 THEN upper(p_name) END AS name,
        p_partkey * 7 % 1009 + 1 AS rank, p_retailprice / 100 AS bayesaverage,
        CASE WHEN p_partkey % 6 <> 0 THEN p_size / CAST(5 AS DOUBLE) END AS average,
        p_partkey % 2 = 1 AS is_expansion, CAST(p_size AS BIGINT) AS strategygames_rank
      FROM part WHERE p_partkey % 4 <> 3),
s AS (SELECT game_id, CASE WHEN game_id % 5 = 0 THEN CAST(count(*) AS VARCHAR) || '.0'
                           WHEN game_id % 7 = 0 THEN 'N/A' ELSE CAST(count(*) AS VARCHAR) END AS total_all,
        CAST(count(rating) AS VARCHAR) AS total_rated
      FROM rev WHERE game_id % 3 <> 2 GROUP BY game_id),
meta AS (SELECT p.p_partkey AS game_id, CASE WHEN r.game_id IS NOT NULL THEN r.name ELSE p.p_name END AS name,
           CAST(1900 + p.p_size AS VARCHAR) AS yearpublished, nullif(p.p_brand, 'Brand#1') AS description,
           r.rank, r.average, r.bayesaverage, coalesce(r.is_expansion, FALSE) AS is_expansion,
           r.strategygames_rank, s.total_all, s.total_rated,
           string_split(p.p_name, ' ') AS mechanics, p.p_type AS category,
           'size' || CAST(p.p_size % 7 AS VARCHAR) AS family
         FROM part p LEFT JOIN r ON r.game_id = p.p_partkey LEFT JOIN s ON s.game_id = p.p_partkey)"""


def _metadata(spark, sf):
    return M.build_metadata(V.games(spark, sf), V.game_ranks(spark, sf), V.game_stats(spark, sf))


@query(P.with_reviews("""
SELECT game_id, name, yearpublished, description, is_expansion, rank AS overall_rank, strategygames_rank,
  round(average, 6) AS avg_rating, round(bayesaverage, 6) AS bayes_average, total_all AS num_reviews,
  total_rated AS num_reviews_rated, array_to_string(mechanics, '|') AS mechanics FROM meta""", META))
def game_metadata_merge(spark, sf):
    m = _metadata(spark, sf)
    return m.select(
        "game_id", "game_info.name", "game_info.yearpublished", "game_info.description", "game_info.is_expansion",
        "rankings.overall_rank", "rankings.strategygames_rank",
        F.round("stats.avg_rating", 6).alias("avg_rating"), F.round("stats.bayes_average", 6).alias("bayes_average"),
        "stats.num_reviews", "stats.num_reviews_rated",
        F.array_join("classifications.mechanics", "|").alias("mechanics"),
    )


@query(P.with_reviews("""
SELECT game_id, rank AS overall_rank, round(average, 6) AS avg_rating,
  array_to_string(mechanics, '|') AS mechanics, category AS categories, family AS families,
  CAST(NULL AS BIGINT) AS only_rank
FROM meta""", META))
def metadata_lookups(spark, sf):
    c = C.Corpus(V.reviews(spark, sf), _metadata(spark, sf))
    only = c.overall_rank().scalar()  # null: many items
    return c.games.select(
        "game_id", "rankings.overall_rank", F.round("stats.avg_rating", 6).alias("avg_rating"),
        *[F.array_join(f"classifications.{k}", "|").alias(k) for k in C.CLASSIFICATION_FIELDS],
        only.alias("only_rank"),
    )


@query(P.with_reviews("""
SELECT 'num_reviews' AS field, CAST(sum(coalesce(TRY_CAST(TRY_CAST(total_all AS DOUBLE) AS BIGINT), 0)) AS BIGINT) AS total FROM meta
UNION ALL SELECT 'num_reviews_rated', CAST(sum(coalesce(TRY_CAST(TRY_CAST(total_rated AS DOUBLE) AS BIGINT), 0)) AS BIGINT) FROM meta
UNION ALL SELECT 'num_reviews_commented', 0""", META))
def stats_field_sum(spark, sf):
    c = C.Corpus(V.reviews(spark, sf), _metadata(spark, sf))
    out = None
    for name in ("num_reviews", "num_reviews_rated", "num_reviews_commented"):
        one = c.stats_field(name).select(F.lit(name).alias("field"), "total")
        out = one if out is None else out.unionByName(one)
    return out


@query("""
SELECT DISTINCT 'mechanics' AS field, unnest(string_split(p_name, ' ')) AS value FROM part
UNION ALL SELECT DISTINCT 'categories', p_type FROM part
UNION ALL SELECT DISTINCT 'families', 'size' || CAST(p_size % 7 AS VARCHAR) FROM part""")
def classifications_flat(spark, sf):
    c = C.Corpus(V.reviews(spark, sf), V.games(spark, sf))
    out = None
    for name in C.CLASSIFICATION_FIELDS:
        one = c.all_classifications(name).select(F.lit(name).alias("field"), F.col(name).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


# --------------------------------------------------------------- aggregations
@query(P.with_reviews("""
SELECT label AS category, count(*) AS n, round(avg(rating), 6) AS mean_rating, 0 AS is_total FROM lab GROUP BY label
UNION ALL SELECT NULL, count(*), round(avg(rating), 6), 1 FROM lab"""))
def store_stats(spark, sf):
    r = V.reviews(spark, sf).withColumnRenamed("label", "category")
    return category_totals(r).withColumn("mean_rating", F.round("mean_rating", 6))


@query(P.with_reviews("SELECT rating, count(*) AS n FROM rev WHERE rating IS NOT NULL GROUP BY rating"))
def rating_distribution(spark, sf):
    return _reviews(spark, sf).rating_distribution()


@query(P.with_reviews("SELECT rating, count(*) AS n FROM rev WHERE rating IS NOT NULL GROUP BY rating ORDER BY n DESC, rating LIMIT 10"))
def rating_topk(spark, sf):
    return _reviews(spark, sf).rating_distribution().orderBy(F.desc("n"), "rating").limit(10)


@query(P.with_reviews("SELECT username, count(*) AS n FROM rev GROUP BY username HAVING count(*) > 1"))
def repeat_users(spark, sf):
    return _reviews(spark, sf).repeat_users()


@query(P.with_reviews("SELECT count(*) AS n FROM (SELECT DISTINCT username FROM rev)"))
def unique_users(spark, sf):
    return _reviews(spark, sf).num_unique_users()


@query(lambda: P.with_docs("""
SELECT label, count(*) AS tokens, count(DISTINCT token) AS types,
       round(count(DISTINCT token) / CAST(count(*) AS DOUBLE), 6) AS diversity
FROM toks WHERE label IS NOT NULL GROUP BY label"""))
def category_lexical_stats(spark, sf):
    return _docs(spark, sf).category_stats().withColumn("diversity", F.round("diversity", 6))


@query(lambda: P.with_docs("""
SELECT count(*) AS tokens, count(DISTINCT token) AS types,
       round(count(DISTINCT token) / CAST(count(*) AS DOUBLE), 6) AS diversity FROM toks"""))
def type_token_ratio(spark, sf):
    return _docs(spark, sf).lexical_diversity().withColumn("diversity", F.round("diversity", 6))


@query(lambda: P.with_docs("SELECT token, count(*) AS n FROM toks GROUP BY token ORDER BY n DESC, token LIMIT 50"))
def token_frequency_topk(spark, sf):
    return _docs(spark, sf).most_common(50)


@query(lambda: P.with_docs("""
SELECT token, n, CAST(sum(n) OVER (ORDER BY n DESC, token ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative
FROM (SELECT token, count(*) AS n FROM toks GROUP BY token ORDER BY n DESC, token LIMIT 30)"""))
def frequency_running_total(spark, sf):
    return Q.running_frequency(_docs(spark, sf).frequency_distribution(), 30)


@query(lambda: P.with_docs("SELECT token FROM toks GROUP BY token HAVING count(*) = 1"))
def hapaxes(spark, sf):
    return _docs(spark, sf).hapaxes()


@query(lambda: P.with_docs("SELECT len(token) AS length, count(*) AS n FROM toks GROUP BY len(token)"))
def word_length_distribution(spark, sf):
    return _docs(spark, sf).word_length_distribution()


GRAM = """
grams AS (SELECT token || ' ' || lead(token, 1) OVER w AS two,
                 token || ' ' || lead(token, 1) OVER w || ' ' || lead(token, 2) OVER w AS three
          FROM toks WINDOW w AS (PARTITION BY review_id ORDER BY pos))"""


@query(lambda: P.with_docs("SELECT two AS ngram, count(*) AS n FROM grams WHERE two IS NOT NULL GROUP BY two ORDER BY n DESC, ngram LIMIT 50", GRAM))
def bigram_topk(spark, sf):
    return _docs(spark, sf).collocations(50)


@query(lambda: P.with_docs("SELECT three AS ngram, count(*) AS n FROM grams WHERE three IS NOT NULL GROUP BY three ORDER BY n DESC, ngram LIMIT 50", GRAM))
def trigram_topk(spark, sf):
    return Q.most_common(_docs(spark, sf).trigrams(), 50, "ngram")


@query(lambda: P.with_docs("""
SELECT three AS ngram, count(*) AS n FROM (
  SELECT token || ' ' || lead(token, 1) OVER w || ' ' || lead(token, 2) OVER w AS three
  FROM toks WINDOW w AS (ORDER BY game_id, review_id, pos))
WHERE three IS NOT NULL GROUP BY three"""))
def ngrams_across_documents(spark, sf):
    return _docs(spark, sf).ngrams(3, cross_document=True)


@query(lambda: P.with_docs("""
SELECT t.game_id, t.review_id, t.pos, array_to_string(tokens[greatest(pos - 3, 0) + 1 : pos], ' ') AS "left",
       token AS hit, array_to_string(tokens[pos + 2 : pos + 4], ' ') AS "right"
FROM toks t JOIN docs d USING (review_id) WHERE token = 'rewh'"""))
def kwic_contexts(spark, sf):
    return _docs(spark, sf).contexts("ReWh", 3).withColumn("pos", F.col("pos").cast("bigint"))


@query(lambda: P.with_docs("""
SELECT array_to_string(list_concat(list_concat(tokens[greatest(pos - 2, 0) + 1 : pos], ['_']), tokens[pos + 2 : pos + 3]), ' ') AS context,
       count(*) AS n
FROM toks t JOIN docs d USING (review_id) WHERE token IN ('re', 'th') GROUP BY 1"""))
def common_contexts(spark, sf):
    return _docs(spark, sf).common_contexts(["re", "TH"], 2)


@query(lambda: P.with_docs("""
SELECT pos + start AS "offset", token AS word FROM toks JOIN (
  SELECT review_id, coalesce(sum(len(tokens)) OVER (ORDER BY game_id, review_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM docs) USING (review_id)
WHERE token IN ('re', 'rewh', 'thatin')"""))
def dispersion_positions(spark, sf):
    return _docs(spark, sf).lexical_dispersion(["re", "rewh", "thatin"])


@query(lambda: P.with_docs("""
SELECT game_id, count(*) FILTER (WHERE ok) AS kept, count(*) FILTER (WHERE NOT ok) AS discarded
FROM (SELECT game_id, clean_text <> '' AND len(tokens) >= 20 AS ok FROM docs) GROUP BY game_id"""))
def valid_reviews(spark, sf):
    return C.validity_counts(V.documents(spark, sf), 20)


REPORT_SQL = """
SELECT 'most_common' AS member, token AS item, n FROM (SELECT token, count(*) AS n FROM toks GROUP BY token ORDER BY n DESC, token LIMIT 15)
UNION ALL SELECT 'frequency', token, n FROM (SELECT token, count(*) AS n FROM toks GROUP BY token ORDER BY n DESC, token LIMIT 30)
UNION ALL SELECT 'hapaxes', token, 1 FROM (SELECT token FROM toks GROUP BY token HAVING count(*) = 1 ORDER BY token LIMIT 20)
UNION ALL SELECT 'bigrams', two, n FROM (SELECT two, count(*) AS n FROM grams WHERE two IS NOT NULL GROUP BY two ORDER BY n DESC, two LIMIT 10)
UNION ALL SELECT 'trigrams', three, n FROM (SELECT three, count(*) AS n FROM grams WHERE three IS NOT NULL GROUP BY three ORDER BY n DESC, three LIMIT 5)
UNION ALL SELECT 'collocations', two, n FROM (SELECT two, count(*) AS n FROM grams WHERE two IS NOT NULL GROUP BY two ORDER BY n DESC, two LIMIT 10)
UNION ALL SELECT 'label_distribution', label, count(*) FROM lab WHERE label IS NOT NULL GROUP BY label
UNION ALL SELECT 'rating_distribution', CAST(rating AS VARCHAR), n FROM (SELECT rating, count(*) AS n FROM rev WHERE rating IS NOT NULL GROUP BY rating ORDER BY n DESC, rating LIMIT 10)
UNION ALL SELECT 'word_lengths', CAST(l AS VARCHAR), n FROM (SELECT len(token) AS l, count(*) AS n FROM toks GROUP BY 1 ORDER BY l LIMIT 10)
UNION ALL SELECT 'category_stats', label, count(*) FROM toks WHERE label IS NOT NULL GROUP BY label
UNION ALL SELECT 'category_types', label, count(DISTINCT token) FROM toks WHERE label IS NOT NULL GROUP BY label
UNION ALL SELECT 'unique_users', '', count(DISTINCT username) FROM rev
UNION ALL SELECT 'repeat_users', '', count(*) FROM (SELECT username FROM rev GROUP BY username HAVING count(*) > 1)
UNION ALL SELECT 'repeat_user_names', username, 0 FROM (SELECT username FROM rev GROUP BY username HAVING count(*) > 1 ORDER BY username LIMIT 10)
UNION ALL SELECT 'sample_text', comment, review_id FROM (SELECT * FROM rev ORDER BY game_id, review_id LIMIT 5)
UNION ALL SELECT 'contexts', l || '|' || token || '|' || r, pos FROM (
  SELECT token, pos, array_to_string(tokens[greatest(pos - 3, 0) + 1 : pos], ' ') AS l, array_to_string(tokens[pos + 2 : pos + 4], ' ') AS r
  FROM toks t JOIN docs d USING (review_id) WHERE token = 're' ORDER BY t.game_id, t.review_id, pos LIMIT 5)
UNION ALL SELECT 'common_contexts', c, n FROM (
  SELECT array_to_string(list_concat(list_concat(tokens[greatest(pos - 2, 0) + 1 : pos], ['_']), tokens[pos + 2 : pos + 3]), ' ') AS c, count(*) AS n
  FROM toks t JOIN docs d USING (review_id) WHERE token IN ('re', 'th') GROUP BY 1 ORDER BY n DESC, c LIMIT 5)
UNION ALL SELECT 'dispersion', token, pos + start FROM toks JOIN (
  SELECT review_id, coalesce(sum(len(tokens)) OVER (ORDER BY game_id, review_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM docs)
  USING (review_id) WHERE token IN ('re', 'th')
UNION ALL SELECT 'num_reviews', '', CAST(sum(coalesce(TRY_CAST(TRY_CAST(total_all AS DOUBLE) AS BIGINT), 0)) AS BIGINT) FROM meta
UNION ALL SELECT 'num_reviews_rated', '', CAST(sum(coalesce(TRY_CAST(TRY_CAST(total_rated AS DOUBLE) AS BIGINT), 0)) AS BIGINT) FROM meta
UNION ALL SELECT 'num_reviews_commented', '', 0
UNION ALL SELECT 'num_reviews_rated_and_commented', '', 0"""


@query(lambda: P.with_docs(REPORT_SQL, GRAM, META))
def corpus_report(spark, sf):
    """All members of the report; the documents are tokenised once and read four times."""
    docs = cut_lineage(V.documents(spark, sf).drop("clean_text"))
    members = C.corpus_report(C.Corpus(docs, _metadata(spark, sf)), word="re", pair=("re", "th"), dispersed=("re", "th"))
    zero = F.lit(0).cast("bigint")
    shape = {
        "most_common": ("token", "n"), "frequency": ("token", "n"), "hapaxes": ("token", F.lit(1)), "bigrams": ("ngram", "n"),
        "trigrams": ("ngram", "n"), "collocations": ("ngram", "n"), "label_distribution": ("label", "n"),
        "rating_distribution": ("rating", "n"), "word_lengths": ("length", "n"), "category_stats": ("label", "tokens"),
        "unique_users": (F.lit(""), "n"), "repeat_users": (F.lit(""), "n"), "repeat_user_names": ("username", zero),
        "sample_text": ("raw_text", "review_id"), "contexts": (F.concat_ws("|", "left", "hit", "right"), "pos"),
        "common_contexts": ("context", "n"), "dispersion": ("word", "offset"), **{name: (F.lit(""), "total") for name in C.NUMBERS},
    }
    assert set(shape) == set(members)

    def rows(name: str, member: DataFrame, item, count) -> DataFrame:
        column = lambda c: F.col(c) if isinstance(c, str) else c
        return member.select(F.lit(name).alias("member"), column(item).cast("string").alias("item"), column(count).cast("bigint").alias("n"))

    parts = [rows(name, members[name], *columns) for name, columns in shape.items()]
    parts.append(rows("category_types", members["category_stats"], "label", "types"))
    return reduce(DataFrame.unionByName, parts)
