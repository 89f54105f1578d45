"""Cleaning, pattern extraction, sentence and lexicon queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from glosa.functions import features as X
from glosa.functions import lexicons as L
from glosa.functions import sentiment as S
from glosa.functions import text as T
from glosa.functions import tokens as K
from glosa.functions.dates import parse_review_time
from glosa.operators import frequency as Q
from glosa.operators import merge as M
from glosa.plans import oracle_parts as P
from glosa.plans import views as V
from glosa.plans.registry import oracle_sql_of, query
from glosa.session import scratch_dir

LEX = V.PROSE_LEXICON


# ------------------------------------------------------------------- cleaning
@query(lambda: P.with_reviews("SELECT review_id, clean_text FROM clean", P.clean_cte("rev", "review_id", "comment")))
def normalise_text(spark, sf):
    return V.reviews(spark, sf).select("review_id", T.normalize_text(F.col("comment")).alias("clean_text"))


@query(lambda: "WITH " + P.clean_cte("pages", "page_id", "html").strip() + "\nSELECT page_id, clean_text FROM clean")
def normalise_pages(spark, sf):
    p = V.spread(V.table(spark, sf, "pages"))
    return p.select("page_id", T.normalize_text(F.col("html")).alias("clean_text"))


@query(P.with_reviews(f"SELECT review_id, {P.collapse_ascii('comment')} AS collapsed FROM rev"))
def collapse_repeats(spark, sf):
    r = V.reviews(spark, sf)
    return r.select("review_id", T.collapse_repeats(F.col("comment"), ascii_only=True).alias("collapsed"))


def _keep_accents_sql() -> str:
    base = P.punctuation_space(P.collapse_ascii(P.markup("comment")))
    return P.with_reviews(
        f"SELECT review_id, {P.abbreviations('t')} AS clean_text FROM (SELECT review_id, lower({base}) AS t FROM rev)"
    )


@query(_keep_accents_sql)
def accent_preserving_normalise(spark, sf):
    return V.reviews(spark, sf).select("review_id", T.normalize_keep_accents(F.col("comment")).alias("clean_text"))


@query(P.with_reviews(r"""
SELECT review_id,
  array_to_string(regexp_extract_all(comment, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}'), '|') AS emails,
  array_to_string(regexp_extract_all(comment, '\b\d{2}[/-]\d{2}[/-]\d{4}\b'), '|') AS dates,
  array_to_string(regexp_extract_all(comment, '\+?\d{1,3}[-.\s]?\(?\d{1,4}\)?[-.\s]?\d{4,10}'), '|') AS phones,
  array_to_string(regexp_extract_all(comment, '#[\pL\pN_]+'), '|') AS hashtags,
  array_to_string(regexp_extract_all(comment, '@[\pL\pN_]+'), '|') AS mentions,
  array_to_string(regexp_extract_all(comment, '""" + P.URL_RE2 + r"""'), '|') AS urls
FROM rev"""))
def special_patterns(spark, sf):
    r = V.reviews(spark, sf).select("review_id", T.special_patterns(F.col("comment")).alias("p"))
    names = ("emails", "dates", "phones", "hashtags", "mentions", "urls")
    return r.select("review_id", *[F.array_join(f"p.{n}", "|").alias(n) for n in names])


@query(P.with_reviews(r"""
SELECT review_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM (
  SELECT review_id, list_filter(string_split(regexp_replace(comment, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
                                lambda x: trim(x) <> '') AS s FROM rev)"""))
def sentence_split(spark, sf):
    r = V.reviews(spark, sf)
    return r.select("review_id", F.posexplode(T.sentences(F.col("comment"))).alias("pos", "sentence")).select(
        "review_id", "sentence", F.col("pos").cast("bigint").alias("pos")
    )


@query(P.with_reviews("""
SELECT review_id, CASE WHEN review_id % 2 = 0 THEN coalesce(a.p_name, '') || ' ' || comment || ' ' || coalesce(b.p_name, '')
                       ELSE comment END AS replaced
FROM rev LEFT JOIN part a ON a.p_partkey = game_id LEFT JOIN part b ON b.p_partkey = review_id * 7"""))
def thing_tag_replace(spark, sf):
    tagged = F.concat(
        F.lit("[thing="), F.col("game_id").cast("string"), F.lit("][/thing] "), F.col("comment"),
        F.lit(" [thing="), (F.col("review_id") * 7).cast("string"), F.lit("][/thing]"),
    )
    r = V.reviews(spark, sf).withColumn("comment", F.when(F.col("review_id") % 2 == 0, tagged).otherwise(F.col("comment")))
    names = V.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    done = M.attach_thing_names(r.select("review_id", "comment"), names, "review_id", "comment")
    return done.select("review_id", T.replace_thing_tags(F.col("comment"), F.col("thing_names")).alias("replaced"))


# Shape of the derived date texts, by event id: today, yesterday, D Mon YYYY
# (English, Spanish, four-letter), unknown month, impossible day, free text.
@query("""
SELECT event_id, CASE k
    WHEN 0 THEN epoch(date_trunc('day', ts))::BIGINT + 3600 * h + 60 * m
    WHEN 1 THEN epoch(date_trunc('day', ts))::BIGINT - 86400 + 3600 * h + 60 * m
    WHEN 2 THEN epoch(make_timestamp(2000 + m % 25, 2, 1 + h, 0, 0, 0))::BIGINT
    WHEN 3 THEN epoch(make_timestamp(2000 + m % 25, 1, 1 + h, 0, 0, 0))::BIGINT
    WHEN 4 THEN epoch(make_timestamp(2000 + m % 25, 9, 1 + h, 0, 0, 0))::BIGINT
  END AS epoch_seconds
FROM (SELECT event_id, ts, event_id % 8 AS k, user_id % 24 AS h, event_id % 60 AS m FROM events)""")
def parse_relative_timestamp(spark, sf):
    h, m, k = F.col("user_id") % 24, F.col("event_id") % 60, F.col("event_id") % 8
    year = (2000 + m % 25).cast("string")
    day = (1 + h).cast("string")
    clock = F.concat(h.cast("string"), F.lit(":"), F.lpad(m.cast("string"), 2, "0"))
    raw = (
        F.when(k == 0, F.concat(F.lit("Today at "), clock))
        .when(k == 1, F.concat(F.lit(" Last updated: Yesterday at "), clock))
        .when(k == 2, F.concat(F.lit("Last updated: "), day, F.lit(" Feb "), year))
        .when(k == 3, F.concat(day, F.lit(" ENE "), year))
        .when(k == 4, F.concat(day, F.lit(" Sept "), year))
        .when(k == 5, F.concat(day, F.lit(" Foo "), year))
        .when(k == 6, F.concat(F.lit("31 Feb "), year))
        .otherwise(F.lit("long ago"))
    )
    now = F.col("ts").cast("timestamp")
    return V.spread(V.table(spark, sf, "events")).select("event_id", parse_review_time(raw, now).alias("epoch_seconds"))


# ------------------------------------------------------------------- lexicons
def _hits(name: str, section: str, terms) -> str:
    return f"SELECT '{name}' AS name, '{section}' AS section, t AS token FROM (SELECT unnest([" + ", ".join(
        P.lit(t) for t in terms) + "]) AS t)"


def _lexicon_cte() -> str:
    parts = [_hits(n, "", getattr(LEX, n)) for n in LEX.flat_names()]
    parts += [_hits("domain", s, ts) for s, ts in LEX.domain.items()]
    return "lexicon AS (" + " UNION ALL ".join(parts) + ")"


@query(lambda: P.with_docs("""
SELECT review_id, name, section, token, count(*) AS n FROM toks JOIN lexicon USING (token)
GROUP BY review_id, name, section, token""", _lexicon_cte()))
def lexicon_hits(spark, sf):
    return Q.lexicon_hits(V.documents(spark, sf), LEX.table(spark), "review_id")


@query(lambda: P.with_docs(f"""
SELECT token, count(*) AS n, bool_or({P.lex('token', *P.HEDGE)}) AS is_hedge, bool_or({P.lex('token', *P.SENT)}) AS is_sentiment
FROM toks WHERE {P.lex('token', *P.HEDGE, *P.SENT)} GROUP BY token"""))
def lexicon_union(spark, sf):
    hedges = spark.createDataFrame([(t,) for t in LEX.hedge_words], "token string")
    for more in (LEX.propositional, LEX.relational, LEX.discourse):
        hedges = hedges.union(spark.createDataFrame([(t,) for t in more], "token string"))
    sentiment = spark.createDataFrame([(t,) for t in LEX.positive + LEX.negative], "token string")
    union = hedges.withColumn("h", F.lit(True)).unionByName(sentiment.withColumn("h", F.lit(False))).groupBy("token").agg(
        F.bool_or("h").alias("is_hedge"), F.bool_or(~F.col("h")).alias("is_sentiment")
    )
    return Q.token_counts(V.documents(spark, sf)).join(union, "token")


@query("""
WITH words AS (SELECT DISTINCT lower(p_type) AS section, lower(unnest(string_split(p_name, ' '))) AS term FROM part)
SELECT section, term FROM words
UNION ALL SELECT 'misc', 'loose ' || lower(p_type) FROM part GROUP BY p_type
UNION ALL SELECT '(flat)', term FROM words GROUP BY term""")
def lexicon_load(spark, sf):
    """Lexicon files written from the part table and read back by both loaders."""
    words = V.table(spark, sf, "part").select("p_type", F.explode(F.split("p_name", " ")).alias("w")).distinct()
    per_type = words.groupBy("p_type").agg(F.concat_ws("\n", F.sort_array(F.collect_set(F.upper("w")))).alias("w"))
    path = scratch_dir(spark, "lexicon")
    # One file per section, so a leading term without a header stands at the top of its file.
    per_type.select("p_type", F.concat(
        F.lit("; generated\nLoose "), F.col("p_type"), F.lit("\n\n[ "), F.col("p_type"), F.lit(" ]\n  "), F.col("w")
    ).alias("value")).repartition("p_type").write.partitionBy("p_type").text(path)
    flat_path = scratch_dir(spark, "flat")
    words.select(F.concat(F.lit(" "), F.upper("w"), F.lit(" \n# "), F.col("w"), F.lit("\n[skip]\n")).alias("value")).write.text(flat_path)
    sections = L.load_sections(spark, path).select("section", "term")
    return sections.unionByName(L.load_flat(spark, flat_path).select(F.lit("(flat)").alias("section"), "term"))


# ------------------------------------------------------------------- features
def _marked(spark, sf):
    return X.with_marks(V.documents(spark, sf), LEX)


def _long(df, *fields: str):
    """bigint and rounded double columns of a struct ``s``."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema["s"].dataType.fields}
    wanted = fields or tuple(kinds)
    return df.select("review_id", *[
        (F.round(f"s.{n}", 6) if kinds[n] == "double" else F.col(f"s.{n}").cast("bigint")).alias(n) for n in wanted
    ])


def _count(*names: str) -> str:
    return f"count(*) FILTER (WHERE {P.lex('token', *names)})"


PER_DOC = "FROM docs LEFT JOIN toks USING (review_id) GROUP BY docs.review_id"


@query(lambda: P.with_docs(f"""
SELECT review_id, p AS pos_count, n AS neg_count, p + n AS total, round(p / CAST(greatest(p + n, 1) AS DOUBLE), 6) AS pos_ratio,
  g AS negations, round(g / CAST(greatest(p + n, 1) AS DOUBLE), 6) AS negation_ratio,
  t AS num_tokens_no_stop, round(c / CAST(greatest(t, 1) AS DOUBLE), 6) AS avg_token_no_stop_length
FROM (SELECT docs.review_id AS review_id, {_count('positive')} AS p, {_count('negative')} AS n, {_count('negations')} AS g,
        count(token) AS t, coalesce(sum(len(token)), 0) AS c {PER_DOC})"""))
def sentiment_counts(spark, sf):
    d = _marked(spark, sf)
    s, n, t = X.polarity(F.col("marks"), LEX), X.negation(F.col("marks"), LEX), X.token_shape(F.col("tokens"))
    staged = d.select("review_id", s.alias("a"), n.alias("b"), t.alias("c"))
    return _long(staged.select("review_id", F.struct(
        "a.*", F.col("b.count").alias("negations"), F.col("b.sentiment_ratio").alias("negation_ratio"), "c.*"
    ).alias("s")))


NEXT = """
near AS (SELECT review_id, pos, token, lead(token, 1) OVER w AS n1, lead(token, 2) OVER w AS n2, lead(token, 3) OVER w AS n3,
                lag(token, 1) OVER w AS p1
         FROM toks WINDOW w AS (PARTITION BY review_id ORDER BY pos))"""


@query(lambda: P.with_docs(f"""
SELECT docs.review_id AS review_id, {_count(*P.SENT)} AS sentiment_unigram_count,
  count(*) FILTER (WHERE {P.lex('token', 'domain')} AND {P.lex('n1', *P.SENT)}) AS domain_sentiment_bigram_count,
  count(*) FILTER (WHERE {P.lex('token', 'domain')} AND {P.lex('n1', *P.SENT)} AND {P.lex('n2', *P.SENT)}) AS domain_sentiment_trigram_count
FROM docs LEFT JOIN near USING (review_id) GROUP BY docs.review_id""", NEXT))
def domain_bigrams(spark, sf):
    d = _marked(spark, sf).select("review_id", X.domain_sentiment(F.col("marks"), LEX).alias("s"))
    return _long(d)


@query(lambda: P.with_docs("""
SELECT review_id, section, token, count(*) AS n FROM toks JOIN lexicon USING (token)
WHERE name = 'domain' GROUP BY review_id, section, token""", _lexicon_cte()))
def domain_hits(spark, sf):
    d = _marked(spark, sf)
    parts = F.concat(*[_section(s) for s in LEX.domain])
    return d.select("review_id", F.inline(parts))


def _section(name: str):
    counts = K.term_counts(K.marked_words(F.col("tokens"), F.col("marks"), LEX.mask(f"domain.{name}")))
    return F.transform(counts, lambda c: F.struct(
        F.lit(name).alias("section"), c["term"].alias("token"), c["n"].cast("bigint").alias("n")
    ))


@query(lambda: P.with_docs(f"""
SELECT review_id, h AS "count", hw AS count_type_hedge_words, pr AS count_type_propositional, re AS count_type_relational,
  di AS count_type_discourse_markers, round(h / CAST(greatest(t, 1) AS DOUBLE), 6) AS density,
  round(pr / CAST(greatest(h, 1) AS DOUBLE), 6) AS prop_propositional, round(re / CAST(greatest(h, 1) AS DOUBLE), 6) AS prop_relational,
  round(di / CAST(greatest(h, 1) AS DOUBLE), 6) AS prop_discourse
FROM (SELECT docs.review_id AS review_id, {_count(*P.HEDGE)} AS h, {_count('hedge_words')} AS hw, {_count('propositional')} AS pr,
  {_count('relational')} AS re, {_count('discourse')} AS di, count(token) AS t {PER_DOC})"""))
def hedge_counts(spark, sf):
    d = _marked(spark, sf).select("review_id", X.hedging(F.col("marks"), LEX).alias("s"))
    names = [f.name for f in d.schema["s"].dataType.fields if not f.name.startswith("nearby")]
    return _long(d, *names)


BAND = f"""
hedge AS (SELECT review_id, pos AS hpos FROM toks WHERE {{hedge}}),
sent AS (SELECT review_id, pos AS spos, token FROM toks WHERE {{sent}}),
band AS (SELECT hedge.review_id, token FROM hedge JOIN sent ON sent.review_id = hedge.review_id AND spos BETWEEN hpos - 3 AND hpos + 3)"""


def _band() -> str:
    return BAND.format(hedge=P.lex("token", *P.HEDGE), sent=P.lex("token", *P.SENT))


@query(lambda: P.with_docs(f"""
SELECT d.review_id, coalesce(b.n, 0) AS nearby_sentiment_count,
  round(coalesce(b.n, 0) / CAST(greatest(d.s, 1) AS DOUBLE), 6) AS nearby_sentiment_ratio
FROM (SELECT docs.review_id AS review_id, {_count('positive')} + {_count('negative')} AS s {PER_DOC}) d
LEFT JOIN (SELECT review_id, count(*) AS n FROM band GROUP BY review_id) b USING (review_id)""", _band()))
def hedge_window_join(spark, sf):
    d = _marked(spark, sf).select("review_id", X.hedging(F.col("marks"), LEX).alias("s"))
    return _long(d, "nearby_sentiment_count", "nearby_sentiment_ratio")


@query(lambda: P.with_docs("SELECT review_id, token AS word, count(*) AS n FROM band GROUP BY review_id, token", _band()))
def hedge_nearby_words(spark, sf):
    d = _marked(spark, sf)
    words = K.term_counts(X.nearby_sentiment_words(F.col("tokens"), F.col("marks"), LEX))
    return d.select("review_id", F.inline(words)).select(
        "review_id", F.col("term").alias("word"), F.col("n").cast("bigint").alias("n"))


@query(lambda: P.with_docs(f"""
SELECT review_id, word, count(*) AS n FROM (
  SELECT review_id, unnest([n1, n2, n3]) AS word FROM near WHERE {P.lex('token', 'negations')})
WHERE word IS NOT NULL GROUP BY review_id, word""", NEXT))
def negation_scope(spark, sf):
    d = _marked(spark, sf)
    words = K.term_counts(X.negation_scope(F.col("tokens"), F.col("marks"), LEX))
    return d.select("review_id", F.inline(words)).select(
        "review_id", F.col("term").alias("word"), F.col("n").cast("bigint").alias("n"))


def _flips(name: str) -> str:
    return " + ".join(
        f"count(*) FILTER (WHERE {P.lex('token', 'negations')} AND {P.lex(c, name)})" for c in ("n1", "n2", "n3"))


def _boost(name: str) -> str:
    return f"count(*) FILTER (WHERE {P.lex('token', name)} AND {P.lex('p1', 'intensifiers')})"


@query(lambda: P.with_docs(f"""
SELECT review_id, CAST(p - fp + fn + b / 2 AS DOUBLE) AS adjusted_pos_count, CAST(n + fp - fn + b / 2 AS DOUBLE) AS adjusted_neg_count,
  CAST(p - n - 2 * fp + 2 * fn AS DOUBLE) AS adjusted_net_sentiment, b AS intensifier_boost, fp + fn AS negation_flips
FROM (SELECT docs.review_id AS review_id, {_count('positive')} AS p, {_count('negative')} AS n, {_flips('positive')} AS fp,
        {_flips('negative')} AS fn, CAST(0.5 AS DOUBLE) * ({_boost('positive')} + {_boost('negative')}) AS b
      FROM docs LEFT JOIN near USING (review_id) GROUP BY docs.review_id)""", NEXT))
def compositional_polarity(spark, sf):
    d = _marked(spark, sf).select("review_id", X.compositional(F.col("marks"), LEX).alias("s"))
    return _long(d)


SENTENCES = r"""
parts AS (SELECT review_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS sid FROM (
  SELECT review_id, list_filter(string_split(regexp_replace(comment, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
                                lambda x: trim(x) <> '') AS s FROM rev)),
words AS (SELECT review_id, sid, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (
  SELECT review_id, sid, regexp_extract_all(lower(sentence), '[\pL\pN_]+') AS w FROM parts))"""


def _scored(source: str, keys: str) -> str:
    boosts = " + ".join(
        f"CASE WHEN {P.lex(f'b{i}', 'intensifiers')} THEN CAST({0.293 * d!r} AS DOUBLE) ELSE 0 END"
        for i, d in enumerate((1.0, 0.95, 0.9), start=1))
    negated = " OR ".join(f"coalesce({P.lex(f'b{i}', 'negations')}, FALSE)" for i in (1, 2, 3))
    return f"""
scored AS (SELECT {keys}, pos, CASE WHEN v = 0 THEN v
      WHEN {negated} THEN (v + sign(v) * ({boosts})) * CAST(-0.74 AS DOUBLE) ELSE v + sign(v) * ({boosts}) END AS score
  FROM (SELECT {keys}, pos, {P.valence_case('token')} AS v, lag(token, 1) OVER w AS b1, lag(token, 2) OVER w AS b2, lag(token, 3) OVER w AS b3
        FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY pos)))"""


def _sentence_sql() -> str:
    return P.with_reviews("""
SELECT review_id, count(c) AS num_sentences, round(coalesce(avg(c), 0), 6) AS avg_sentiment,
  round(CASE WHEN count(c) > 1 THEN var_pop(c) ELSE 0 END, 6) AS sentiment_variance,
  round(coalesce(arg_min(c, sid), 0), 6) AS first_sentence, round(coalesce(arg_max(c, sid), 0), 6) AS last_sentence,
  round(coalesce(max(c), 0), 6) AS max_sentence, round(coalesce(min(c), 0), 6) AS min_sentence
FROM rev LEFT JOIN compound USING (review_id) GROUP BY review_id""", SENTENCES.strip(), _scored("words", "review_id, sid").strip(), """
compound AS (SELECT parts.review_id, parts.sid, coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15) AS c
  FROM parts LEFT JOIN (SELECT review_id, sid, sum(score) AS s FROM scored GROUP BY review_id, sid) t
  ON t.review_id = parts.review_id AND t.sid = parts.sid)""".strip())


@query(_sentence_sql)
def sentence_valence(spark, sf):
    d = S.with_sentence_scores(V.reviews(spark, sf).select("review_id", "comment"), "comment", LEX, "scores")
    return _long(d.select("review_id", S.sentence_summary(F.col("scores")).alias("s")))


TEXT_WORDS = r"""
words AS (SELECT review_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM (
  SELECT review_id, regexp_extract_all(lower(comment), '[\pL\pN_]+') AS w FROM rev))"""


def _text_valence_sql() -> str:
    return P.with_reviews("""
SELECT review_id, round(s / sqrt(s * s + 15), 6) AS compound, round(CASE WHEN w > 0 THEN p / w ELSE 0 END, 6) AS pos,
  round(CASE WHEN w > 0 THEN u / w ELSE 0 END, 6) AS neu, round(CASE WHEN w > 0 THEN g / w ELSE 0 END, 6) AS neg
FROM (SELECT *, p + g + u AS w FROM (
  SELECT review_id, coalesce(sum(score), 0) AS s, coalesce(sum(score + 1) FILTER (WHERE score > 0), 0) AS p,
    coalesce(sum(abs(score - 1)) FILTER (WHERE score < 0), 0) AS g, CAST(count(*) FILTER (WHERE score = 0) AS DOUBLE) AS u
  FROM rev LEFT JOIN scored USING (review_id) GROUP BY review_id))""", TEXT_WORDS.strip(), _scored("words", "review_id").strip())


def opinion_ctes() -> list[str]:
    """CTEs that end in opinion(review_id, feature, value): word features and the valence of the text."""
    valence = """SELECT review_id, 'valence.compound', s / sqrt(s * s + 15)
  FROM (SELECT review_id, coalesce(sum(score), 0) AS s FROM rev LEFT JOIN scored USING (review_id) GROUP BY review_id)"""
    parts = "\nUNION ALL ".join([*feature_parts(), valence])
    return [_band(), NEXT, TEXT_WORDS.strip(), _scored("words", "review_id").strip(), f"opinion AS ({parts})"]


def opinion_features(df):
    """``features`` of ``opinion_ctes``, for rows with review_id, comment and tokens."""
    marked = df.withColumn("marks", LEX.marks("tokens"))
    scored = S.with_text_scores(marked, "comment", LEX, "_scores")
    valence = F.struct(F.lit("valence.compound").alias("feature"), S.valence_scores(F.col("_scores"))["compound"].alias("value"))
    words = X.word_features(F.col("tokens"), F.col("marks"), LEX)
    return scored.withColumn("features", F.map_from_entries(F.concat(F.array(valence), words))).drop("marks", "_scores")


@query(_text_valence_sql)
def text_valence(spark, sf):
    d = S.with_text_scores(V.reviews(spark, sf).select("review_id", "comment"), "comment", LEX, "scores")
    return _long(d.select("review_id", S.valence_scores(F.col("scores")).alias("s")))


@query(lambda: P.with_docs("""
SELECT review_id, round(coalesce(types, 0) / CAST(greatest(len(tokens), 1) AS DOUBLE), 6) AS ttr,
  round(coalesce(once, 0) / CAST(greatest(len(tokens), 1) AS DOUBLE), 6) AS hapax_ratio, round(coalesce(e, 0), 6) AS entropy
FROM docs LEFT JOIN (
  SELECT review_id, count(*) AS types, count(*) FILTER (WHERE n = 1) AS once,
    -sum(n / CAST(total AS DOUBLE) * log2(n / CAST(total AS DOUBLE) + 1e-10)) AS e
  FROM (SELECT review_id, token, count(*) AS n, sum(count(*)) OVER (PARTITION BY review_id) AS total
        FROM toks GROUP BY review_id, token) GROUP BY review_id) USING (review_id)"""))
def lexical_diversity_features(spark, sf):
    d = V.documents(spark, sf).select("review_id", X.lexical_diversity(F.col("tokens")).alias("s"))
    return _long(d)


def _phrases(column: str, phrases) -> str:
    return " + ".join(
        f"CAST((len({column}) - len(replace({column}, {P.lit(p)}, ''))) / {len(p)} AS BIGINT)" for p in phrases)


# Function words of the generated prose stand in for opinion phrases.
PROSE_FIRST = ["the re", "of the", "de la"]
PROSE_APPEAR = ["and ", "ere "]


@query(P.with_reviews(f"""
SELECT review_id, {_phrases('t', PROSE_FIRST)} AS first_phrases, {_phrases('t', PROSE_APPEAR)} AS appear_phrases,
  len(comment) - len(replace(comment, '!', '')) AS exclamations,
  len(regexp_extract_all(comment, '!{{2,}}|\\?{{2,}}|\\.{{2,}}|,{{2,}}')) AS repeated_punct
FROM (SELECT *, lower(comment) AS t FROM rev)"""))
def subjectivity_and_punctuation(spark, sf):
    r = V.reviews(spark, sf).withColumn("t", F.lower("comment"))
    return r.select(
        "review_id",
        T.phrase_count(F.col("t"), PROSE_FIRST).cast("bigint").alias("first_phrases"),
        T.phrase_count(F.col("t"), PROSE_APPEAR).cast("bigint").alias("appear_phrases"),
        T.exclamations(F.col("comment")).cast("bigint").alias("exclamations"),
        T.repeated_punctuation(F.col("comment")).cast("bigint").alias("repeated_punct"),
    )


@query(lambda: P.with_docs("""
SELECT review_id, f + e + a AS marker_count, round((f + e + a) / CAST(greatest(len(tokens), 1) AS DOUBLE), 6) AS marker_density,
  f AS first_person_opinion_count, e AS epistemic_count, a AS appearance_count
FROM (SELECT review_id, tokens, """ + _phrases("lower(comment)", L.W.FIRST_PERSON_PHRASES) + " AS f, len(list_filter(tokens, lambda w: "
      + P.in_list("w", L.W.EPISTEMIC_MARKERS) + ")) AS e, " + _phrases("lower(comment)", L.W.APPEARANCE_PHRASES) + " AS a FROM docs)"))
def subjectivity(spark, sf):
    d = _marked(spark, sf).select("review_id", X.subjectivity(F.col("marks"), F.col("comment"), LEX).alias("s"))
    return _long(d)


@query(P.with_reviews(r"""
SELECT review_id, w AS words, complex_words, round(CASE WHEN w = 0 THEN 0 ELSE 0.39::DOUBLE * w / s + 11.8::DOUBLE * y / w - 15.59::DOUBLE END, 6) AS fk_grade,
  round(CASE WHEN w = 0 THEN 0 ELSE 206.835::DOUBLE - 1.015::DOUBLE * w / s - 84.6::DOUBLE * y / w END, 6) AS ease
FROM (SELECT review_id, len(g) AS w, greatest(ns, 1) AS s, coalesce(list_sum(g), 0) AS y, len(list_filter(g, lambda x: x >= 3)) AS complex_words
  FROM (SELECT review_id,
      list_transform(regexp_extract_all(lower(comment), '[\pL\pN_]+'), lambda w: greatest(len(regexp_extract_all(w, '[aeiouy]+')), 1)) AS g,
      len(list_filter(string_split(regexp_replace(comment, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '')) AS ns
    FROM rev))"""))
def readability(spark, sf):
    return _long(V.reviews(spark, sf).select("review_id", T.readability(F.col("comment")).alias("s")))


# ----------------------------------------------------- supplied tags, entities
TAGGED = r"""
conv AS (SELECT conv_id * 1000 + turn AS doc_id, text AS comment, regexp_extract_all(lower(text), '[\pL\pN_]+') AS tokens,
           regexp_extract_all(text, '[A-Z][a-z]+') AS names FROM conversations),
tags AS (SELECT doc_id, pos, token, tokens[pos // 2 + 1] AS head,
           CASE len(token) % 5 WHEN 0 THEN 'ADJ' WHEN 1 THEN 'ADV' WHEN 2 THEN 'NOUN' WHEN 3 THEN 'VERB' ELSE 'X' END AS tag
         FROM (SELECT doc_id, tokens, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos FROM conv)),
ents AS (SELECT doc_id, name, CASE len(name) % 3 WHEN 0 THEN 'PERSON' WHEN 1 THEN 'ORG' ELSE 'GPE' END AS label
         FROM (SELECT doc_id, unnest(names) AS name FROM conv))"""


@query(f"""WITH {TAGGED.strip()}
SELECT c.doc_id, round(coalesce(a, 0) / CAST(greatest(coalesce(t, 0), 1) AS DOUBLE), 6) AS adj_ratio,
  round(coalesce(n, 0) / CAST(greatest(coalesce(t, 0), 1) AS DOUBLE), 6) AS noun_ratio,
  round(coalesce(v, 0) / CAST(greatest(coalesce(t, 0), 1) AS DOUBLE), 6) AS verb_ratio,
  round(coalesce(d, 0) / CAST(greatest(coalesce(t, 0), 1) AS DOUBLE), 6) AS adv_ratio,
  coalesce(e, 0) AS total, coalesce(u, 0) AS unique_labels, round(coalesce(e, 0) / CAST(greatest(coalesce(t, 0), 1) AS DOUBLE), 6) AS density
FROM conv c LEFT JOIN (SELECT doc_id, count(*) AS t, count(*) FILTER (WHERE tag = 'ADJ') AS a, count(*) FILTER (WHERE tag = 'NOUN') AS n,
    count(*) FILTER (WHERE tag = 'VERB') AS v, count(*) FILTER (WHERE tag = 'ADV') AS d FROM tags GROUP BY doc_id) g USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS e, count(DISTINCT label) AS u FROM ents GROUP BY doc_id) h USING (doc_id)""")
def pos_entity_features(spark, sf):
    d = V.tagged(spark, sf)
    staged = d.select("doc_id", X.pos_ratios(F.col("tags")).alias("p"), X.entity_summary(
        F.col("entities"), F.col("tokens"), F.array().cast("array<double>")).alias("e"))
    return staged.select(
        "doc_id", *[F.round(f"p.{n}", 6).alias(n) for n in ("adj_ratio", "noun_ratio", "verb_ratio", "adv_ratio")],
        F.col("e.total").cast("bigint").alias("total"), F.col("e.unique_labels").cast("bigint").alias("unique_labels"),
        F.round("e.density", 6).alias("density"),
    )


@query(f"""WITH {TAGGED.strip()}
SELECT doc_id, 'entity.text=' || lower(name) AS feature, CAST(count(*) AS DOUBLE) AS value FROM ents GROUP BY doc_id, lower(name)
UNION ALL SELECT doc_id, 'entity.label=' || label, CAST(count(*) AS DOUBLE) FROM ents GROUP BY doc_id, label
UNION ALL SELECT doc_id, 'entity.count.' || lower(label), CAST(count(*) AS DOUBLE) FROM ents GROUP BY doc_id, label""")
def entity_feature_rows(spark, sf):
    return V.tagged(spark, sf).select("doc_id", F.inline(X.entity_features(F.col("entities"))))


@query(f"""WITH RECURSIVE {TAGGED.strip()},
last AS (SELECT doc_id, token, arg_max(head, pos) AS head FROM tags GROUP BY doc_id, token),
walk AS (
  SELECT doc_id, token, token AS cur, 0 AS depth, [token] AS seen FROM last
  UNION ALL
  SELECT w.doc_id, w.token, l.head, w.depth + 1, list_append(w.seen, l.head)
  FROM walk w JOIN last l ON l.doc_id = w.doc_id AND l.token = w.cur
  WHERE l.head <> w.cur AND w.depth <= 100 AND NOT list_contains(w.seen[1:-2], w.cur)),
depths AS (SELECT doc_id, token, max(depth) AS depth FROM walk GROUP BY doc_id, token)
SELECT doc_id, count(*) AS num_dependencies, round(avg(depth), 6) AS avg_dep_depth, max(depth)::BIGINT AS max_dep_depth
FROM tags JOIN depths USING (doc_id, token) GROUP BY doc_id""")
def head_depth(spark, sf):
    d = V.tagged(spark, sf).filter(F.size("tags") > 0)
    staged = d.select("doc_id", X.head_depths(
        F.transform("tags", lambda t: t["text"]), F.transform("tags", lambda t: t["head"])).alias("depths"))
    return staged.select("doc_id", X.dependency_shape(F.col("depths")).alias("s"), F.array_max("depths").alias("m")).select(
        "doc_id", F.col("s.num_dependencies").cast("bigint").alias("num_dependencies"),
        F.round("s.avg_dep_depth", 6).alias("avg_dep_depth"), F.col("m").cast("bigint").alias("max_dep_depth"),
    )


# ------------------------------------------------------------------- long form
def feature_parts() -> list[str]:
    """(review_id, feature, value) of the word features, over toks, band and near."""
    single = {
        "hedge.words": ("hedge_words",), "hedge.propositional": ("propositional",), "hedge.relational": ("relational",),
        "hedge.discourse_marker": ("discourse",), "hedge.all": P.HEDGE, "lexicon.intensifier": ("intensifiers",),
        "lexicon.mitigator": ("mitigators",), "lexicon.negation": ("negations",), "lexicon.pos_word": ("positive",),
        "lexicon.neg_word": ("negative",), "domain.parts": ("domain.parts",), "domain.play": ("domain.play",),
    }
    parts = [
        f"SELECT review_id, '{p}=' || token AS feature, CAST(count(*) AS DOUBLE) AS value FROM toks WHERE {P.lex('token', *n)} GROUP BY review_id, token"
        for p, n in single.items()
    ]
    parts.append("SELECT review_id, 'hedge.nearby_sentiment_words=' || token, CAST(count(*) AS DOUBLE) FROM band GROUP BY review_id, token")
    parts.append(
        "SELECT review_id, 'negation.scope_word=' || word, CAST(count(*) AS DOUBLE) FROM (SELECT review_id, unnest([n1, n2, n3]) AS word "
        f"FROM near WHERE {P.lex('token', 'negations')}) WHERE word IS NOT NULL GROUP BY review_id, word")
    return parts


def _feature_sql() -> str:
    return P.with_docs("\nUNION ALL ".join(feature_parts()), _band(), NEXT)


@query(_feature_sql)
def feature_map_long(spark, sf):
    d = _marked(spark, sf)
    return d.select("review_id", F.inline(X.word_features(F.col("tokens"), F.col("marks"), LEX)))


#: Features of every review by the query whose SQL restates them.
PARTS = {
    "sentiment_counts": {
        **{f"sentiment.{n}": n for n in ("pos_count", "neg_count", "total", "pos_ratio")}, "negation.count": "negations",
        "negation.sentiment_ratio": "negation_ratio", **{f"syntactic.{n}": n for n in ("num_tokens_no_stop", "avg_token_no_stop_length")}},
    "text_valence": {f"vader.{n}": n for n in ("compound", "pos", "neu", "neg")},
    "lexical_diversity_features": {f"lexical.{n}": n for n in ("ttr", "hapax_ratio", "entropy")},
    "sentence_valence": {
        **{f"sentence.{n}": n for n in ("avg_sentiment", "num_sentences", "sentiment_variance")},
        **{f"sentiment.{n}": n for n in ("first_sentence", "last_sentence", "max_sentence", "min_sentence")}},
    "readability": {f"readability.{n}": n for n in ("fk_grade", "ease")},
    "hedge_counts": {
        **{f"hedge.{n}": f'"{n}"' for n in ("count", "density", "prop_propositional", "prop_relational", "prop_discourse")},
        **{f"hedge.count_type.{n}": f"count_type_{n}" for n in ("hedge_words", "propositional", "relational", "discourse_markers")}},
    "hedge_window_join": {f"hedge.{n}": n for n in ("nearby_sentiment_count", "nearby_sentiment_ratio")},
    "compositional_polarity": {f"compositional.{n}": n for n in (
        "adjusted_pos_count", "adjusted_neg_count", "adjusted_net_sentiment", "intensifier_boost", "negation_flips")},
    "subjectivity": {f"subjectivity.{n}": n for n in (
        "marker_count", "marker_density", "first_person_opinion_count", "epistemic_count", "appearance_count")},
    "subjectivity_and_punctuation": {"punct.exclamation_count": "exclamations", "punct.repeated_punct_count": "repeated_punct"},
    "domain_bigrams": {n: n for n in ("sentiment_unigram_count", "domain_sentiment_bigram_count", "domain_sentiment_trigram_count")},
}


def _batch_sql() -> str:
    known = oracle_sql_of(*PARTS, "feature_map_long")
    parts = [f"SELECT review_id, unnest([{', '.join(P.lit(f) for f in fields)}]) AS feature, "
             f"unnest([{', '.join(f'CAST({c} AS DOUBLE)' for c in fields.values())}]) AS value FROM ({known[name]})" for name, fields in PARTS.items()]
    parts.append(f"SELECT review_id, 'readability.complex_word_ratio', round(complex_words / CAST(greatest(num_tokens_no_stop, 1) AS DOUBLE), 6) "
                 f"FROM ({known['readability']}) JOIN ({known['sentiment_counts']}) USING (review_id)")
    parts.append(f"SELECT review_id, feature, value FROM ({known['feature_map_long']})")
    every = "\nUNION ALL ".join(parts)
    return f"SELECT review_id, feature, value + CAST(0 AS DOUBLE) AS value FROM ({every}) SEMI JOIN (SELECT doc_id AS review_id FROM documents WHERE trim(text) <> '') USING (review_id)"


@query(_batch_sql)
def features_batch(spark, sf):
    """Every scalar and sparse feature of every review, blanks skipped."""
    d = V.documents(spark, sf).filter(~T.is_blank(F.col("comment")))
    rows = X.feature_rows(X.extract_features(d.select("review_id", "comment", "tokens"), LEX), "review_id")
    return rows.withColumn("value", F.round("value", 6) + 0.0)  # no negative zeros
