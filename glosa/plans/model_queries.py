"""Balancing, splitting, vectors, metrics and models."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosa.functions import features as X
from glosa.operators import balance as B
from glosa.operators import language as La
from glosa.operators import metrics as E
from glosa.operators import models as Ml
from glosa.operators import split as Sp
from glosa.operators import vectors as Vx
from glosa.operators.skew import portable_key
from glosa.plans import bayes_sql as Bs
from glosa.plans import build
from glosa.plans import oracle_parts as P
from glosa.plans import text_queries as T
from glosa.plans import views as V
from glosa.plans.registry import query
from glosa.session import cut_lineage, scratch_dir
from glosa.sources import writers

# ------------------------------------------------------------------- balancing
COUNTS = "cnt AS (SELECT game_id, label, count(*) AS n FROM lab WHERE label IS NOT NULL GROUP BY game_id, label)"
UNDER = f"""{COUNTS},
goal AS (SELECT game_id, min(n) AS target FROM cnt GROUP BY game_id),
kept AS (SELECT lab.*, FALSE AS is_augmented FROM lab JOIN goal USING (game_id) WHERE label IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY game_id, label ORDER BY {P.KEY}, review_id) <= target)"""


@query(P.with_reviews("SELECT review_id, game_id, label, is_augmented FROM kept", UNDER))
def undersample(spark, sf):
    return B.balance(V.reviews(spark, sf), "undersample").select("review_id", "game_id", "label", "is_augmented")


HYBRID = f"""{COUNTS},
span AS (SELECT game_id, min(n) AS lo, max(n) AS hi FROM cnt GROUP BY game_id),
goal AS (SELECT game_id, greatest(CAST(floor(hi * CASE WHEN hi / CAST(lo AS DOUBLE) > 10 THEN 0.5 WHEN hi / CAST(lo AS DOUBLE) > 5 THEN 0.6
           WHEN hi / CAST(lo AS DOUBLE) > 2 THEN 0.75 ELSE 1.0 END) AS BIGINT), 5) AS target FROM span),
kept AS (SELECT lab.* FROM lab JOIN goal USING (game_id) WHERE label IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY game_id, label ORDER BY {P.KEY}, review_id) <= target)"""


@query(P.with_reviews("SELECT review_id, game_id, label FROM kept", HYBRID))
def hybrid_balance(spark, sf):
    return B.balance(V.reviews(spark, sf), "hybrid", min_samples=5).select("review_id", "game_id", "label")


REPORT = """
rep AS (SELECT game_id, {before}, {after}, ta AS total_after, 0 AS augmented_count, {tb} AS total_before, {cut} AS subsampled_count
  FROM (SELECT game_id, {cb} FROM lab GROUP BY game_id) b JOIN (SELECT game_id, count(*) AS ta, {ca} FROM kept GROUP BY game_id) a USING (game_id))"""


def _report() -> str:
    cats = B.CATEGORIES
    return UNDER + "," + REPORT.format(
        before=", ".join(f"{c}_before" for c in cats), after=", ".join(f"{c}_after" for c in cats),
        tb=" + ".join(f"{c}_before" for c in cats), cut=" + ".join(f"greatest({c}_before - {c}_after, 0)" for c in cats),
        cb=", ".join(f"count(*) FILTER (WHERE label = '{c}') AS {c}_before" for c in cats),
        ca=", ".join(f"count(*) FILTER (WHERE label = '{c}') AS {c}_after" for c in cats),
    )


@query(lambda: P.with_reviews("SELECT * FROM rep", _report()))
def balance_report(spark, sf):
    r = V.reviews(spark, sf)
    return B.balance_report(r, B.balance(r, "undersample")).withColumn("augmented_count", F.col("augmented_count").cast("int"))


@query(lambda: P.with_reviews("""
SELECT CAST(sum(positive_before) AS BIGINT) AS positive_before, CAST(sum(positive_after) AS BIGINT) AS positive_after,
  CAST(sum(total_before) AS BIGINT) AS total_before, CAST(sum(total_after) AS BIGINT) AS total_after,
  CAST(sum(subsampled_count) AS BIGINT) AS subsampled_count,
  round(greatest(sum(positive_after), sum(neutral_after), sum(negative_after)) / CAST(least(sum(positive_after), sum(neutral_after), sum(negative_after)) AS DOUBLE), 6) AS balance_ratio_max_min
FROM rep""", _report()))
def balance_summary(spark, sf):
    r = V.reviews(spark, sf)
    total = B.global_balance(B.balance_report(r, B.balance(r, "undersample")))
    return total.select("positive_before", "positive_after", "total_before", "total_after", "subsampled_count",
                        F.round("balance_ratio_max_min", 6).alias("balance_ratio_max_min"))


# Replacement words that occur in the generated prose.
SYNONYMS = {"en": {"the": ["thee", "tha"], "of": ["from"]}, "de": {"die": ["diese", "jene"]}, "fr": {"la": ["cette"]}}


def _swap(lang: str) -> str:
    cases = "".join(
        f" WHEN {P.lit(t)} THEN [" + ", ".join(P.lit(a) for a in alts) + f"][CAST((review_id * 31 + v * 17 + (i - 1) * 7) % {len(alts)} AS INTEGER) + 1]"
        for t, alts in SYNONYMS[lang].items())
    return f"array_to_string(list_transform(string_split(trim(comment), ' '), lambda w, i: CASE lower(w){cases} ELSE w END), ' ')"


def _variant() -> str:
    return f"trim(CASE lang WHEN 'de' THEN {_swap('de')} WHEN 'fr' THEN {_swap('fr')} ELSE {_swap('en')} END)"


GROW = f"""{COUNTS},
goal AS (SELECT game_id, max(n) AS target FROM cnt GROUP BY game_id),
ranked AS (SELECT lab.*, n, target, row_number() OVER (PARTITION BY game_id, label ORDER BY {P.KEY}, review_id) AS rk
  FROM lab JOIN cnt USING (game_id, label) JOIN goal USING (game_id)),
made AS (SELECT *, unnest(range(CAST((target - n) // n + CASE WHEN rk <= (target - n) % n THEN 1 ELSE 0 END AS BIGINT))) AS v FROM ranked)"""


@query(lambda: P.with_reviews(f"""
SELECT game_id, label, comment, FALSE AS is_augmented, CAST(NULL AS BIGINT) AS augmented_from FROM lab WHERE label IS NOT NULL
UNION ALL SELECT game_id, label, t, TRUE, review_id FROM (SELECT *, {_variant()} AS t FROM made)
WHERE len(trim(comment)) >= 5 AND t <> '' AND t <> trim(comment)""", GROW))
def synonym_augment(spark, sf):
    grown = B.balance(V.reviews(spark, sf), "oversample", synonyms=B.Synonyms(SYNONYMS))
    return grown.select("game_id", "label", "comment", "is_augmented", "augmented_from")


@query(lambda: P.with_reviews(f"""
SELECT review_id, len(vs) AS n_variants, array_to_string(vs, '#') AS variants FROM (
  SELECT review_id, CASE WHEN len(trim(comment)) < 5 THEN [] ELSE list_filter(
     CASE WHEN a = b THEN [a] ELSE [a, b] END, lambda x: x <> '' AND x <> trim(comment)) END AS vs
  FROM (SELECT review_id, comment, {_variant().replace('v * 17', '0 * 17')} AS a, {_variant().replace('v * 17', '1 * 17')} AS b
        FROM (SELECT review_id, trim(comment) AS comment, lang FROM rev)))"""))
def augment_variants(spark, sf):
    r = V.reviews(spark, sf).withColumn("comment", F.trim("comment"))
    made = B.augment(F.col("comment"), F.col("lang"), F.col("review_id"), B.Synonyms(SYNONYMS), 2)
    return r.select("review_id", made.alias("vs")).select(
        "review_id", F.size("vs").cast("bigint").alias("n_variants"), F.array_join("vs", "#").alias("variants"))


@query(P.with_reviews("""
SELECT review_id, game_id, star FROM stars JOIN base USING (game_id)
QUALIFY row_number() OVER (PARTITION BY game_id, star ORDER BY ts DESC, review_id) <= CASE WHEN star IN (5, 6) THEN 2 * lim ELSE lim END""",
"""stars AS (SELECT *, CAST(floor(rating) AS BIGINT) AS star FROM rev WHERE trim(comment) <> '' AND floor(rating) BETWEEN 1 AND 10),
base AS (SELECT game_id, least(count(*) FILTER (WHERE star = 1), count(*) FILTER (WHERE star = 2), count(*) FILTER (WHERE star = 10)) AS lim
  FROM stars GROUP BY game_id HAVING lim > 0)"""))
def rating_cap(spark, sf):
    return B.rating_cap(V.reviews(spark, sf)).select("review_id", "game_id", "star")


# -------------------------------------------------------------------- splitting
SIZES = """
n0 AS (SELECT label, count(*) AS n FROM lab WHERE label IS NOT NULL GROUP BY label),
t0 AS (SELECT *, ceil(0.15::DOUBLE * sum(n) OVER ()) AS want, ceil(0.15::DOUBLE * sum(n) OVER ()) * n / sum(n) OVER () AS ex FROM n0),
t1 AS (SELECT label, n, CAST(floor(ex) + CASE WHEN row_number() OVER (ORDER BY round(ex - floor(ex), 9) DESC, label) <= want - sum(floor(ex)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS test FROM t0),
v0 AS (SELECT *, n - test AS rest, ceil((0.15::DOUBLE / (0.70::DOUBLE + 0.15::DOUBLE)) * sum(n - test) OVER ()) AS want,
         ceil((0.15::DOUBLE / (0.70::DOUBLE + 0.15::DOUBLE)) * sum(n - test) OVER ()) * (n - test) / sum(n - test) OVER () AS ex FROM t1),
sizes AS (SELECT label, n, test, rest, CAST(floor(ex) + CASE WHEN row_number() OVER (ORDER BY round(ex - floor(ex), 9) DESC, label) <= want - sum(floor(ex)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS val FROM v0)"""


@query(P.with_reviews(f"""
SELECT review_id, label, CASE WHEN rk <= rest - val THEN 'train' WHEN rk <= rest THEN 'val' ELSE 'test' END AS split
FROM (SELECT review_id, label, rest, val, row_number() OVER (PARTITION BY label ORDER BY {P.KEY}, review_id) AS rk FROM lab JOIN sizes USING (label))""",
SIZES.strip()))
def stratified_split(spark, sf):
    r = V.reviews(spark, sf).filter("label IS NOT NULL")
    return Sp.stratified_split(r).select("review_id", "label", "split")


@query(P.with_reviews("""
SELECT 'train' AS split, label, rest - val AS n FROM sizes UNION ALL SELECT 'val', label, val FROM sizes
UNION ALL SELECT 'test', label, test FROM sizes""", SIZES.strip()))
def split_distribution(spark, sf):
    r = V.reviews(spark, sf).filter("label IS NOT NULL")
    return Sp.split_distribution(Sp.stratified_split(r))


# ----------------------------------------------------------------------- vectors
TFIDF = """
grams AS (SELECT review_id, lang || '_' || token AS term, lang || '_' || token || ' ' || lang || '_' || lead(token) OVER (PARTITION BY review_id ORDER BY pos) AS two FROM toks),
terms AS (SELECT review_id, term, count(*) AS tf FROM (SELECT review_id, term FROM grams UNION ALL SELECT review_id, two FROM grams WHERE two IS NOT NULL) GROUP BY ALL),
top AS (SELECT term, sum(tf) AS total, count(*) AS df FROM terms GROUP BY term ORDER BY total DESC, term LIMIT 300),
vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, ln((1 + (SELECT count(*) FROM docs)) / CAST(1 + df AS DOUBLE)) + 1 AS idf FROM top),
w AS (SELECT review_id, idx, tf * idf AS x FROM terms JOIN vocab USING (term))"""


@query(lambda: P.with_docs("SELECT review_id, idx AS idx, round(x / sqrt(sum(x * x) OVER (PARTITION BY review_id)), 6) AS value FROM w", TFIDF.strip()))
def tfidf_topk(spark, sf):
    docs = cut_lineage(V.documents(spark, sf).select("review_id", "lang", "tokens"))
    vocabulary = cut_lineage(Vx.fit_vocabulary(docs, docs.count(), 300))
    rows = Vx.vector_rows(Vx.tfidf(docs, vocabulary, "review_id", 300), "review_id")
    return rows.select("review_id", F.col("idx").cast("bigint").alias("idx"), F.round("value", 6).alias("value"))


@query("""
SELECT event_id, idx, value FROM (
  SELECT event_id, 'event_type=' || event_type AS feature, CAST(1 AS DOUBLE) AS value FROM events
  UNION ALL SELECT event_id, 'user=u' || CAST(user_id AS VARCHAR), 1 FROM events UNION ALL SELECT event_id, 'value', value FROM events) x
JOIN (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx FROM (
  SELECT DISTINCT 'event_type=' || event_type AS feature FROM events UNION SELECT DISTINCT 'user=u' || CAST(user_id AS VARCHAR) FROM events
  UNION SELECT 'value' FROM events)) v USING (feature)""")
def dict_vectorise(spark, sf):
    e = V.spread(V.table(spark, sf, "events"))
    raw = F.create_map(
        F.lit("event_type"), F.col("event_type"), F.lit("user"), F.concat(F.lit("u"), F.col("user_id").cast("string")),
        F.lit("value"), F.col("value").cast("string"))
    rows = e.select("event_id", Vx.one_hot(raw).alias("features"))
    vocabulary = Vx.feature_vocabulary(rows)
    out = Vx.vector_rows(Vx.feature_vectors(rows, vocabulary, "event_id"), "event_id")
    return out.select("event_id", F.col("idx").cast("bigint").alias("idx"), "value")


@query("""
WITH r AS (SELECT event_id, event_type AS idx, value - 20 AS value FROM events),
sh AS (SELECT event_id, idx, value - (SELECT least(min(value), 0) FROM r) AS v, value FROM r)
SELECT event_id, idx, round(v / max(abs(v)) OVER (PARTITION BY idx), 6) AS max_abs,
  round(value / sqrt(sum(value * value) OVER (PARTITION BY idx) / (SELECT count(*) FROM r)
    - power(sum(value) OVER (PARTITION BY idx) / (SELECT count(*) FROM r), 2)), 6) AS standard
FROM sh""")
def shift_scale(spark, sf):
    rows = V.spread(V.table(spark, sf, "events")).select("event_id", F.col("event_type").alias("idx"), (F.col("value") - 20).alias("value"))
    positive = Vx.max_abs_scale(Vx.shift_to_positive(rows)).withColumnRenamed("value", "max_abs")
    standard = Vx.standard_scale(rows, rows.count()).withColumnRenamed("value", "standard")
    return positive.join(standard, ["event_id", "idx"]).select(
        "event_id", "idx", F.round("max_abs", 6).alias("max_abs"), F.round("standard", 6).alias("standard"))


# ----------------------------------------------------------------------- metrics
PRED = """
pred AS (SELECT 'm' || CAST(review_id % 4 AS VARCHAR) AS model, 's' || CAST(game_id % 3 AS VARCHAR) AS features, label,
  CASE review_id * 7 % 10 WHEN 0 THEN 'neutral' WHEN 1 THEN 'negative' WHEN 2 THEN 'positive' ELSE label END AS prediction
  FROM lab WHERE label IS NOT NULL)"""
CLASSES = """
cls AS (SELECT g, class, sum(s) AS support, sum(p) AS predicted, sum(h) AS hit FROM (
  SELECT {g} AS g, label AS class, 1 AS s, 0 AS p, CASE WHEN label = prediction THEN 1 ELSE 0 END AS h FROM pred
  UNION ALL SELECT {g}, prediction, 0, 1, 0 FROM pred) GROUP BY g, class),
rep AS (SELECT g, class, support, hit, pr, re, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f1 FROM (
  SELECT *, CASE WHEN predicted > 0 THEN hit / CAST(predicted AS DOUBLE) ELSE 0 END AS pr, CASE WHEN support > 0 THEN hit / CAST(support AS DOUBLE) ELSE 0 END AS re FROM cls)),
summ AS (SELECT g, sum(hit) / CAST(sum(support) AS DOUBLE) AS accuracy, sum(pr * support) / sum(support) AS prec, sum(re * support) / sum(support) AS rec, sum(f1 * support) / sum(support) AS f FROM rep GROUP BY g)"""


def _predictions(spark, sf):
    r = V.reviews(spark, sf).filter("label IS NOT NULL")
    k = F.col("review_id") * 7 % 10
    guess = F.when(k == 0, "neutral").when(k == 1, "negative").when(k == 2, "positive").otherwise(F.col("label"))
    return r.select(
        F.concat(F.lit("m"), (F.col("review_id") % 4).cast("string")).alias("model"),
        F.concat(F.lit("s"), (F.col("game_id") % 3).cast("string")).alias("features"), "label", guess.alias("prediction"))


@query(P.with_reviews("""
SELECT label, count(*) FILTER (WHERE prediction = 'negative') AS pred_negative, count(*) FILTER (WHERE prediction = 'neutral') AS pred_neutral,
  count(*) FILTER (WHERE prediction = 'positive') AS pred_positive FROM pred GROUP BY label""", PRED.strip()))
def confusion_matrix(spark, sf):
    return E.confusion_matrix(_predictions(spark, sf), list(B.CATEGORIES))


@query(P.with_reviews("""
SELECT class, round(pr, 6) AS "precision", round(re, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM rep""",
PRED.strip(), CLASSES.format(g="1").strip()))
def class_report(spark, sf):
    r = E.class_report(_predictions(spark, sf))
    return r.select("class", *[F.round(n, 6).alias(n) for n in ("precision", "recall", "f1")], "support")


@query(P.with_reviews("""
SELECT split_part(g, '/', 1) AS model, split_part(g, '/', 2) AS features, round(accuracy, 6) AS accuracy, round(prec, 6) AS "precision",
  round(rec, 6) AS recall, round(f, 6) AS f1, round((accuracy + prec + rec + f) / 4, 6) AS test_composite FROM summ""",
PRED.strip(), CLASSES.format(g="model || '/' || features").strip()))
def results_ranking(spark, sf):
    scores = E.summary_metrics(_predictions(spark, sf), "model", "features").withColumnRenamed("composite", "test_composite")
    rounded = scores.select("model", "features", *[
        F.round(n, 6).alias(n) for n in ("accuracy", "precision", "recall", "f1", "test_composite")])
    return E.rank_results(rounded)


# ------------------------------------------------------------------------ models
LABELS = list(B.CATEGORIES)


def _prepared(spark, sf, max_features: int = 200):
    """Vectorised and split reviews, written once; every model below reads them."""
    docs = cut_lineage(V.documents(spark, sf).filter("label IS NOT NULL").select("review_id", "game_id", "label", "lang", "comment", "tokens"))
    wide = cut_lineage(X.extract_features(docs, V.PROSE_LEXICON).filter(F.size("tokens") > 0))
    vectors = Ml.ReviewVectorizer(max_features=max_features).fit(wide).transform(wide)
    return cut_lineage(Sp.stratified_split(vectors.select("review_id", "label", "ngrams", "opinion")))


def _countable(spark, sf, max_features: int):
    """As ``_prepared``, with the features that ``bayes_sql`` restates: all terms, word features and valence."""
    docs = V.documents(spark, sf).filter("label IS NOT NULL")
    # Filtered behind the write: a filter on tokens before it cleans every text once more.
    wide = cut_lineage(T.opinion_features(docs.select("review_id", "label", "lang", "comment", "tokens"))).filter("size(tokens) > 0")
    vectors = Ml.ReviewVectorizer(max_features=max_features).fit(wide).transform(wide)
    return cut_lineage(Sp.stratified_split(vectors.select("review_id", "label", "ngrams", "opinion")))


PARTS = SIZES.strip().replace("FROM lab WHERE label IS NOT NULL", "FROM base") + f""",
main AS (SELECT 0 AS run, review_id, label, CASE WHEN rk <= rest - val THEN 'train' WHEN rk <= rest THEN 'val' ELSE 'test' END AS split
  FROM (SELECT review_id, label, rest, val, row_number() OVER (PARTITION BY label ORDER BY {P.KEY}, review_id) AS rk FROM base JOIN sizes USING (label)))"""
COLUMNS = ("accuracy", "precision", "recall", "f1", "composite")


def _nb_sql() -> str:
    metrics = ", ".join(
        f"round(max({sql}) FILTER (WHERE split = '{split}'), 6) AS \"{split}_{name}\"" for split in ("val", "test")
        for name, sql in zip(COLUMNS, ("accuracy", "prec", "rec", "f", "(accuracy + prec + rec + f) / 4")))
    subsets = {"ngrams": "t", "opinion": "o", "combined": "to"}
    return P.with_docs(
        f"SELECT 'naive_bayes' AS model, split_part(g, '/', 1) AS features, {metrics} FROM (SELECT *, split_part(g, '/', 2) AS split FROM summ) GROUP BY ALL",
        *Bs.vectors_cte(5000), PARTS, "part AS (SELECT * FROM main)", *Bs.scores_cte(subsets, [1.0]),
        CLASSES.format(g="subset || '/' || split").strip())


@query(_nb_sql)
def nb_train_eval(spark, sf):
    """All three feature subsets at the full settings, judged on validation and test rows."""
    rows = _countable(spark, sf, 5000)
    parts = {s: rows.filter(F.col("split") == s) for s in Sp.SPLITS}
    fitted, failed = Ml.train_models(parts["train"], LABELS, ("naive_bayes",))
    if failed:
        raise RuntimeError(str(failed))
    found = Ml.evaluate_all(fitted, parts["val"], parts["test"])
    return found.select("model", "features", *[F.round(f"{s}_{c}", 6).alias(f"{s}_{c}") for s in ("val", "test") for c in COLUMNS])


def _tune_sql() -> str:
    folds = """folded AS (SELECT review_id, label, CASE WHEN rk <= n * 1 // 3 THEN 0 WHEN rk <= n * 2 // 3 THEN 1 ELSE 2 END AS fold
  FROM (SELECT review_id, label, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (PARTITION BY label ORDER BY """ + P.KEY + """, review_id) AS rk
        FROM main WHERE split = 'train')),
part AS (SELECT run, review_id, label, CASE WHEN fold = run THEN 'held' ELSE 'train' END AS split FROM folded CROSS JOIN (SELECT unnest([0, 1, 2]) AS run))"""
    return P.with_docs("""
SELECT lam AS smoothing, round(avg(c), 6) AS composite, lam = (SELECT lam FROM mean ORDER BY round(c, 9) DESC, lam LIMIT 1) AS chosen,
  (SELECT count(*) FROM folded WHERE fold = 0) AS rows_0, (SELECT count(*) FROM folded WHERE fold = 1) AS rows_1, (SELECT count(*) FROM folded WHERE fold = 2) AS rows_2
FROM point GROUP BY lam""", *Bs.vectors_cte(5000), PARTS, folds, *Bs.scores_cte({"ngrams": "t"}, Ml.GRIDS["naive_bayes"]["smoothing"]),
        CLASSES.format(g="CAST(run AS VARCHAR) || '/' || CAST(lam AS VARCHAR)").strip(), """
point AS (SELECT CAST(split_part(g, '/', 2) AS DOUBLE) AS lam, (accuracy + prec + rec + f) / 4 AS c FROM summ),
mean AS (SELECT lam, avg(c) AS c FROM point GROUP BY lam)""".strip())


@query(_tune_sql)
def tune_grid(spark, sf):
    """The whole grid of naive Bayes on the same three folds of the training rows: scores, fold sizes, the point chosen."""
    train = _countable(spark, sf, 5000).filter("split = 'train'").drop("split")
    scores = Ml.search_grid(train, "naive_bayes", "ngrams", LABELS)
    chosen = Ml.best_point(scores)
    sizes = Ml.fold_numbers(train).groupBy().pivot("fold", [0, 1, 2]).count().toDF("rows_0", "rows_1", "rows_2")
    points = spark.createDataFrame(
        [(s.params["smoothing"], s.mean, s is chosen) for s in scores], "smoothing double, composite double, chosen boolean")
    return points.crossJoin(F.broadcast(sizes)).withColumn("composite", F.round("composite", 6))


def _majority_sql(model: str, subsets: tuple[str, ...]) -> str:
    rows = ", ".join(f"('{model}', '{s}')" for s in subsets)
    return P.with_docs(f"""
SELECT model, features, n_train, n_val, n_test, TRUE AS not_below_majority FROM (VALUES {rows}) AS m(model, features),
  (SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'val') AS n_val, count(*) FILTER (WHERE split = 'test') AS n_test FROM main)""",
        Bs.BASE, PARTS)


def _against_majority(spark, sf, model: str, max_features: int = 200, **settings):
    """Split sizes, and whether the fitted model is right on its training rows at least as often as the largest class."""
    rows = _prepared(spark, sf, max_features)
    train = rows.filter("split = 'train'")
    fitted, failed = Ml.train_models(train, LABELS, (model,), overrides={model: settings})
    if failed:
        raise RuntimeError(str(failed))
    share = train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg((F.max("n") / F.sum("n")).alias("majority"))
    sizes = rows.agg(*[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in Sp.SPLITS])
    scores = reduce(DataFrame.unionByName, [Ml.evaluate(chain, train, model=m, features=s) for (m, s), chain in fitted.items()])
    return scores.crossJoin(F.broadcast(share)).crossJoin(F.broadcast(sizes)).select(
        "model", "features", "n_train", "n_val", "n_test", (F.col("accuracy") >= F.col("majority")).alias("not_below_majority"))


@query(lambda: _majority_sql("random_forest", Ml.SUBSETS))
def forest_train_eval(spark, sf):
    return _against_majority(spark, sf, "random_forest", numTrees=10, maxDepth=5)


@query(lambda: _majority_sql("linear_sgd", Ml.SUBSETS))
def svc_train_eval(spark, sf):
    return _against_majority(spark, sf, "linear_sgd", maxIter=10)


@query(lambda: _majority_sql("boosted_trees", Ml.SUBSETS))
def boosted_train_eval(spark, sf):
    """All three feature subsets at the full settings."""
    return _against_majority(spark, sf, "boosted_trees", 5000)


@query(lambda: P.with_docs("""
SELECT label, n, documents, ngram_features, opinion_features, 12::BIGINT AS trained, 12::BIGINT AS combinations, 12::BIGINT AS ranked
FROM (SELECT label, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS documents FROM base GROUP BY label),
  (SELECT count(*) FILTER (WHERE block = 't') AS ngram_features, count(*) FILTER (WHERE block = 'o') AS opinion_features FROM (SELECT DISTINCT block, f FROM x))""",
    *Bs.vectors_cte(5000)))
def model_run(spark, sf):
    """Four models on three subsets as one chain at the full settings: trained, evaluated, ranked, written; the summary is read back."""
    path = scratch_dir(spark, "models")
    Ml.run_models(_countable(spark, sf, 5000), LABELS, path)
    ranked = spark.read.option("header", True).csv(f"{path}/results").agg(F.count(F.lit(1)).alias("ranked"))
    summary = spark.read.json(f"{path}/summary").select(
        F.inline("classes"), "documents", "ngram_features", "opinion_features", "trained", "combinations")
    return summary.crossJoin(F.broadcast(ranked))


@query(lambda: P.with_docs("SELECT review_id, label, TRUE AS same FROM main WHERE split = 'test'", Bs.BASE, PARTS))
def splits_and_models_persist(spark, sf):
    """Splits and a fitted chain saved, loaded and applied again: the test rows, and whether both chains agree on them."""
    rows = _prepared(spark, sf)
    split_path, model_path = scratch_dir(spark, "splits"), scratch_dir(spark, "model")
    writers.write_splits(rows, split_path)
    parts = writers.read_splits(spark, split_path)
    chain = Ml.training_chain("random_forest", "ngrams", list(B.CATEGORIES), numTrees=5, maxDepth=4).fit(parts["train"])
    chain.write().overwrite().save(model_path)
    first, again = (c.transform(parts["test"]).select("review_id", "label", "predicted") for c in (chain, PipelineModel.load(model_path)))
    both = first.join(again.select("review_id", F.col("predicted").alias("loaded")), "review_id")
    return both.select("review_id", "label", (F.col("predicted") == F.col("loaded")).alias("same"))


# ------------------------------------------------------------ language detection
KNOWN = 3006477107  # seven tenths of the key space


def _language_sql(rows: str, default: str, columns: str) -> list[str]:
    """CTEs over ``rows`` (review_id, lang, t, known): fit on known rows, found(review_id, detected) for the others."""
    return [rows, f"""
chars AS (SELECT review_id, lang, known, list_filter(string_split(lower(trim(replace(t, chr(10), ' '))), ''), lambda c: c <> '') AS c FROM src),
grams AS (SELECT review_id, lang, known, unnest(list_concat(
    list_transform(range(1, len(c)), lambda i: c[i] || c[i + 1]), list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2]))) AS g FROM chars),
vocab AS (SELECT g FROM grams WHERE known GROUP BY g ORDER BY count(*) DESC, g LIMIT 5000),
cnt AS (SELECT review_id, lang, known, g, count(*) AS n FROM grams SEMI JOIN vocab USING (g) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS docs, sum(count(*)) OVER () AS every, count(*) OVER () AS k FROM src WHERE known AND trim(t) <> '' GROUP BY lang),
mass AS (SELECT lang, sum(n) AS total FROM cnt WHERE known GROUP BY lang),
theta AS (SELECT l.lang, v.g, ln(coalesce(c.n, 0) + 1) - ln(coalesce(m.total, 0) + (SELECT count(*) FROM vocab)) AS w
  FROM langs l CROSS JOIN vocab v LEFT JOIN mass m ON m.lang = l.lang
  LEFT JOIN (SELECT lang, g, sum(n) AS n FROM cnt WHERE known GROUP BY lang, g) c ON c.lang = l.lang AND c.g = v.g),
score AS (SELECT s.review_id, l.lang, ln(l.docs + 1) - ln(l.every + l.k) + coalesce(x.s, 0) AS s
  FROM src s CROSS JOIN langs l LEFT JOIN (SELECT c.review_id, t.lang, sum(c.n * t.w) AS s FROM cnt c JOIN theta t ON t.g = c.g WHERE NOT c.known GROUP BY ALL) x
    ON x.review_id = s.review_id AND x.lang = l.lang WHERE NOT s.known),
prob AS (SELECT review_id, lang, exp(s - max(s) OVER (PARTITION BY review_id)) / sum(exp(s - max(s) OVER (PARTITION BY review_id))) OVER (PARTITION BY review_id) AS p
  FROM (SELECT *, s - max(s) OVER (PARTITION BY review_id) AS d FROM score)),
found AS (SELECT src.review_id, {columns}, CASE WHEN trim(t) = '' OR t IS NULL OR p < 0.7 THEN '{default}' ELSE b.lang END AS detected
  FROM src JOIN (SELECT review_id, arg_max(lang, p) AS lang, max(p) AS p FROM prob GROUP BY review_id) b USING (review_id) WHERE NOT known)""".strip().replace(
        "exp(s - max(s) OVER (PARTITION BY review_id)) / sum(exp(s - max(s) OVER (PARTITION BY review_id))) OVER (PARTITION BY review_id)",
        "exp(d) / sum(exp(d)) OVER (PARTITION BY review_id)")]


@query(lambda: P.with_reviews("SELECT review_id, lang, detected FROM found", *_language_sql(
    f"src AS (SELECT review_id, lang, comment AS t, {P.KEY} < {KNOWN} AS known FROM rev)", "en", "src.lang AS lang")))
def detect_language(spark, sf):
    """Languages of the held-out reviews, learned from seven tenths of them."""
    r = V.reviews(spark, sf).select("review_id", "comment", "lang")
    known = portable_key(F.col("review_id")) < KNOWN
    model = La.train_language_model(r.filter(known))
    return La.detect_language(model, r.filter(~known)).select("review_id", "lang", "detected")


@query(lambda: P.with_docs("""
SELECT review_id, CASE WHEN comment IS NULL OR trim(comment) = '' THEN 'unknown' ELSE lang END AS lang FROM docs WHERE review_id % 3 <> 0
UNION ALL SELECT review_id, CASE WHEN comment IS NULL OR trim(comment) = '' THEN 'unknown' ELSE detected END FROM found""", *_language_sql(
    "src AS (SELECT review_id, lang, comment, clean_text AS t, review_id % 3 <> 0 AS known FROM docs)", "en", "src.comment AS comment")))
def build_languages(spark, sf):
    """The processing step of the build on reviews of which a third comes without a language."""
    r = V.reviews(spark, sf)
    given = r.withColumn("lang", F.when(F.col("review_id") % 3 != 0, F.col("lang")))
    cleaned = V.with_tokens(r).filter("review_id % 3 <> 0")
    model = La.train_language_model(cleaned, "clean_text")
    return build.process_reviews(given, language=model).select("review_id", "lang")
