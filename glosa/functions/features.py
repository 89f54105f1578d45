"""Linguistic features of one review.

Tokens are matched once against every term set: ``marks`` is an array parallel
to the tokens that holds one bit per set.  The features below are arithmetic on
that array.  All work stays inside the row, so feature extraction adds no
shuffle; it widens the scan stage.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from glosa.functions import sentiment as S
from glosa.functions import text as T
from glosa.functions import tokens as K
from glosa.functions import word_lists as W
from glosa.functions.lexicons import Lexicon
from glosa.functions.text import let

HEDGE_WINDOW = 3
NEGATION_WINDOW = 3
DEPTH_LIMIT = 100
SENTIMENT = ("positive", "negative")
HEDGES = ("hedge_words", "propositional", "relational", "discourse")


def _ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.greatest(whole, F.lit(1))


def polarity(marks: Column, lexicon: Lexicon) -> Column:
    """Struct pos_count, neg_count, total, pos_ratio."""
    return let(
        let(K.nonzero(marks), lambda hits: F.struct(
            K.count_marked(hits, lexicon.mask("positive")).alias("p"),
            K.count_marked(hits, lexicon.mask("negative")).alias("n"),
        )),
        lambda s: F.struct(
            s["p"].alias("pos_count"),
            s["n"].alias("neg_count"),
            (s["p"] + s["n"]).alias("total"),
            _ratio(s["p"], s["p"] + s["n"]).alias("pos_ratio"),
        ),
    )


def token_shape(tokens: Column) -> Column:
    """Struct num_tokens_no_stop, avg_token_no_stop_length."""
    chars = F.aggregate(tokens, F.lit(0), lambda a, t: a + F.length(t))
    return F.struct(
        F.size(tokens).alias("num_tokens_no_stop"),
        _ratio(chars, F.size(tokens)).alias("avg_token_no_stop_length"),
    )


def lexical_diversity(tokens: Column) -> Column:
    """Struct ttr, hapax_ratio, entropy (bits)."""

    def from_runs(runs: Column) -> Column:
        return let(F.greatest(F.size(tokens), F.lit(1)), lambda n: of_length(runs, n))

    def of_length(runs: Column, n: Column) -> Column:
        def bits(total: Column, count: Column) -> Column:
            return total - count / n * F.log2(count / n + 1e-10)

        return F.struct(
            _ratio(F.size(runs), n).alias("ttr"),
            _ratio(F.size(F.filter(runs, lambda c: c == 1)), n).alias("hapax_ratio"),
            F.aggregate(runs, F.lit(0.0), bits).alias("entropy"),
        )

    return let(K.run_lengths(tokens), from_runs)


def hedging(marks: Column, lexicon: Lexicon) -> Column:
    """Hedge counts by type, density, shares, and sentiment words near hedges.

    A sentiment word counts once for every hedge it is near.
    """
    sentiment, hedges = lexicon.mask(*SENTIMENT), lexicon.mask(*HEDGES)
    near = F.aggregate(
        K.positions(marks, hedges),
        F.lit(0),
        lambda a, i: a + K.count_marked(K.around(marks, i, HEDGE_WINDOW, HEDGE_WINDOW), sentiment),
    )
    counts = let(K.nonzero(marks), lambda hits: F.struct(
        K.count_marked(hits, hedges).alias("all"),
        *[K.count_marked(hits, lexicon.mask(h)).alias(h) for h in HEDGES],
        (K.count_marked(hits, lexicon.mask("positive"))
         + K.count_marked(hits, lexicon.mask("negative"))).alias("sent"),
        near.alias("near"),
    ))
    return let(
        counts,
        lambda c: F.struct(
            c["all"].alias("count"),
            c["hedge_words"].alias("count_type_hedge_words"),
            c["propositional"].alias("count_type_propositional"),
            c["relational"].alias("count_type_relational"),
            c["discourse"].alias("count_type_discourse_markers"),
            _ratio(c["all"], F.size(marks)).alias("density"),
            c["near"].alias("nearby_sentiment_count"),
            _ratio(c["near"], c["sent"]).alias("nearby_sentiment_ratio"),
            _ratio(c["propositional"], c["all"]).alias("prop_propositional"),
            _ratio(c["relational"], c["all"]).alias("prop_relational"),
            _ratio(c["discourse"], c["all"]).alias("prop_discourse"),
        ),
    )


def nearby_sentiment_words(tokens: Column, marks: Column, lexicon: Lexicon) -> Column:
    """Sentiment words within three tokens of a hedge, once per hedge they are near."""
    sentiment = lexicon.mask(*SENTIMENT)
    return F.flatten(F.transform(
        K.positions(marks, lexicon.mask(*HEDGES)),
        lambda i: let(
            K.around(marks, i, HEDGE_WINDOW, HEDGE_WINDOW),
            lambda near: K.marked_words(K.around(tokens, i, HEDGE_WINDOW, HEDGE_WINDOW), near, sentiment),
        ),
    ))


def negation_scope(tokens: Column, marks: Column, lexicon: Lexicon) -> Column:
    """The three tokens after each negation, duplicates kept."""
    return F.flatten(F.transform(
        K.positions(marks, lexicon.mask("negations")), lambda i: K.following(tokens, i, NEGATION_WINDOW)
    ))


def negation(marks: Column, lexicon: Lexicon) -> Column:
    """Struct count, sentiment_ratio."""
    hits = K.count_marked(marks, lexicon.mask("negations"))
    sent = K.count_marked(marks, lexicon.mask("positive")) + K.count_marked(marks, lexicon.mask("negative"))
    return F.struct(hits.alias("count"), _ratio(hits, sent).alias("sentiment_ratio"))


def compositional(marks: Column, lexicon: Lexicon) -> Column:
    """Sentiment counts after negation flips and booster weight.

    Each (negation, sentiment word among its next three tokens) pair moves one
    count to the other side; each booster directly before a sentiment word adds
    0.5, shared by both sides.
    """
    scopes = F.transform(
        K.positions(marks, lexicon.mask("negations")), lambda i: K.following(marks, i, NEGATION_WINDOW)
    )
    boosters = lexicon.mask("intensifiers")

    def build(scope: Column) -> Column:
        def flips(name: str) -> Column:
            return F.aggregate(scope, F.lit(0), lambda a, ms: a + K.count_marked(ms, lexicon.mask(name)))

        def boosted(name: str) -> Column:
            return F.size(F.filter(
                marks,
                lambda m, i: (m.bitwiseAND(F.lit(lexicon.mask(name))) != 0)
                & F.coalesce(F.get(marks, i - 1).bitwiseAND(F.lit(boosters)) != 0, F.lit(False)),
            ))

        parts = F.struct(
            K.count_marked(marks, lexicon.mask("positive")).alias("p"),
            K.count_marked(marks, lexicon.mask("negative")).alias("n"),
            flips("positive").alias("fp"),
            flips("negative").alias("fn"),
            (0.5 * (boosted("positive") + boosted("negative"))).alias("b"),
        )

        def combine(s: Column) -> Column:
            pos = s["p"] - s["fp"] + s["fn"]
            neg = s["n"] + s["fp"] - s["fn"]
            return F.struct(
                (pos + s["b"] / 2).alias("adjusted_pos_count"),
                (neg + s["b"] / 2).alias("adjusted_neg_count"),
                (pos - neg).cast("double").alias("adjusted_net_sentiment"),
                s["b"].alias("intensifier_boost"),
                (s["fp"] + s["fn"]).alias("negation_flips"),
            )

        return let(parts, combine)

    return let(scopes, build)


def subjectivity(marks: Column, raw_text: Column, lexicon: Lexicon) -> Column:
    """Opinion phrases of the raw text and epistemic tokens."""

    def build(lowered: Column) -> Column:
        parts = F.struct(
            T.phrase_count(lowered, W.FIRST_PERSON_PHRASES).alias("first"),
            K.count_marked(marks, lexicon.mask("epistemic")).alias("epistemic"),
            T.phrase_count(lowered, W.APPEARANCE_PHRASES).alias("appear"),
        )
        return let(
            parts,
            lambda s: F.struct(
                (s["first"] + s["epistemic"] + s["appear"]).alias("marker_count"),
                _ratio(s["first"] + s["epistemic"] + s["appear"], F.size(marks)).alias("marker_density"),
                s["first"].alias("first_person_opinion_count"),
                s["epistemic"].alias("epistemic_count"),
                s["appear"].alias("appearance_count"),
            ),
        )

    return let(F.lower(raw_text), build)


def domain_sentiment(marks: Column, lexicon: Lexicon) -> Column:
    """Sentiment words, and domain words followed by one or by two sentiment words."""
    sentiment = lexicon.mask(*SENTIMENT)

    def sent(i: Column) -> Column:
        return F.coalesce(F.get(marks, i).bitwiseAND(F.lit(sentiment)) != 0, F.lit(False))

    return let(
        F.filter(K.positions(marks, lexicon.mask("domain")), lambda i: sent(i + 1)),
        lambda pairs: F.struct(
            K.count_marked(marks, sentiment).alias("sentiment_unigram_count"),
            F.size(pairs).alias("domain_sentiment_bigram_count"),
            F.size(F.filter(pairs, lambda i: sent(i + 2))).alias("domain_sentiment_trigram_count"),
        ),
    )


# ------------------------------------------------- features of supplied tags
def pos_ratios(tags: Column) -> Column:
    """Shares of four parts of speech over ``array<struct<..., pos, ...>>``."""
    n = F.size(tags)

    def share(tag: str) -> Column:
        return _ratio(F.size(F.filter(tags, lambda t: t["pos"] == tag)), n)

    return F.struct(
        share("ADJ").alias("adj_ratio"),
        share("ADV").alias("adv_ratio"),
        share("NOUN").alias("noun_ratio"),
        share("VERB").alias("verb_ratio"),
    )


def entity_summary(entities: Column, tokens: Column, scores: Column) -> Column:
    """Totals over ``array<struct<text,label>>``; mean sentence score when any entity exists."""
    n = F.size(entities)
    mean = F.when(
        F.size(scores) > 0, F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores)
    ).otherwise(0.0)
    return F.struct(
        n.alias("total"),
        F.size(F.array_distinct(F.transform(entities, lambda e: e["label"]))).alias("unique_labels"),
        _ratio(n, F.size(tokens)).alias("density"),
        F.when(n > 0, mean).otherwise(0.0).alias("avg_sentiment_near"),
    )


def _depths(parent: dict[str, str]) -> dict[str, int]:
    """Depth of every word of a word -> head map, in one pass over its links.

    A root (own head) has depth 0 and a word under an unknown head depth 1.
    Words on a loop have the length of the loop; any other word is one deeper
    than its head.
    """
    depth = {w: 0 for w, h in parent.items() if h == w}
    for start in parent:
        trail: dict[str, int] = {}
        node = start
        while node in parent and node not in depth and node not in trail:
            trail[node] = len(trail)
            node = parent[node]
        path = list(trail)
        if node in trail:  # the trail ran into itself: a loop not seen before
            loop = path[trail[node]:]
            depth.update(dict.fromkeys(loop, len(loop)))
            path = path[: trail[node]]
        below = depth.get(node, 0)
        for up, word in enumerate(reversed(path), start=1):
            depth[word] = below + up
    return depth


@F.pandas_udf(ArrayType(IntegerType()))
def head_depths(tokens: pd.Series, heads: pd.Series) -> pd.Series:
    """Steps from each token to its root, following word -> head by text.

    The last head of a repeated word wins; depths end at ``DEPTH_LIMIT`` + 1.
    """

    def row(words, above) -> list[int]:
        depth = _depths(dict(zip(words, above)))
        return [min(depth[w], DEPTH_LIMIT + 1) for w in words]

    return pd.Series([row(t, h) for t, h in zip(tokens, heads)])


def dependency_shape(depths: Column) -> Column:
    """Struct avg_dep_depth, num_dependencies from an array of depths."""
    return F.struct(
        _ratio(F.aggregate(depths, F.lit(0), lambda a, x: a + x), F.size(depths)).alias("avg_dep_depth"),
        F.size(depths).alias("num_dependencies"),
    )


# ------------------------------------------------------------- sparse features
def counted(words: Column) -> Column:
    """Array of (feature, value) pairs from feature names with repeats."""
    return F.transform(
        K.term_counts(words),
        lambda c: F.struct(c["term"].alias("feature"), c["n"].cast("double").alias("value")),
    )


def _prefixed(prefix: str, words: Column) -> Column:
    return F.transform(words, lambda w: F.concat(F.lit(prefix), w))


def word_features(tokens: Column, marks: Column, lexicon: Lexicon) -> Column:
    """All open-ended ``prefix=word`` counts of a row as (feature, value) pairs."""
    names = {
        "hedge.words": ["hedge_words"],
        "hedge.propositional": ["propositional"],
        "hedge.relational": ["relational"],
        "hedge.discourse_marker": ["discourse"],
        "hedge.all": list(HEDGES),
        "lexicon.intensifier": ["intensifiers"],
        "lexicon.mitigator": ["mitigators"],
        "lexicon.negation": ["negations"],
        "lexicon.pos_word": ["positive"],
        "lexicon.neg_word": ["negative"],
        "subjectivity.marker_word": ["subjective"],
        **{f"domain.{s}": [f"domain.{s}"] for s in lexicon.domain},
    }
    pairs = F.zip_with(tokens, marks, lambda t, m: F.struct(t.alias("t"), m.alias("m")))
    hits = F.filter(pairs, lambda h: h["m"] != 0)
    labelled = F.flatten(F.transform(hits, lambda h: F.array_compact(F.array(*[
        F.when(h["m"].bitwiseAND(F.lit(lexicon.mask(*n))) != 0, F.concat(F.lit(p + "="), h["t"]))
        for p, n in names.items()
    ]))))
    near = _prefixed("hedge.nearby_sentiment_words=", nearby_sentiment_words(tokens, marks, lexicon))
    scope = _prefixed("negation.scope_word=", negation_scope(tokens, marks, lexicon))
    return counted(F.concat(labelled, near, scope))


def entity_features(entities: Column) -> Column:
    """``entity.text=``, ``entity.label=`` and ``entity.count.`` pairs."""
    return counted(F.concat(
        F.transform(entities, lambda e: F.concat(F.lit("entity.text="), F.lower(e["text"]))),
        F.transform(entities, lambda e: F.concat(F.lit("entity.label="), e["label"])),
        F.transform(entities, lambda e: F.concat(F.lit("entity.count."), F.lower(e["label"]))),
    ))


# -------------------------------------------------------------------- assembly
# Output keys whose group differs from the struct they come from.
SENTENCE_KEYS = {
    "num_sentences": "sentence.num_sentences", "avg_sentiment": "sentence.avg_sentiment",
    "sentiment_variance": "sentence.sentiment_variance", "first_sentence": "sentiment.first_sentence",
    "last_sentence": "sentiment.last_sentence", "max_sentence": "sentiment.max_sentence",
    "min_sentence": "sentiment.min_sentence",
}


def feature_key(group: str, name: str) -> str:
    if group == "sentence":
        return SENTENCE_KEYS[name]
    if group == "domain_sentiment":
        return name
    if group == "dependency":
        return f"syntactic.{name}"
    return f"{group}.{name}".replace("count_type_", "count_type.")


def with_marks(df: DataFrame, lexicon: Lexicon, tokens: str = "tokens") -> DataFrame:
    return df.withColumn("marks", lexicon.marks(tokens))


def extract_features(
    df: DataFrame,
    lexicon: Lexicon | None = None,
    tokens: str = "tokens",
    raw_text: str = "comment",
    tags: str | None = None,
    entities: str | None = None,
) -> DataFrame:
    """Add ``features map<string,double>``, every scalar and sparse feature of each row.

    ``tags`` names a column ``array<struct<text,pos,tag,dep,head>>`` and
    ``entities`` one ``array<struct<text,label>>``; both are produced upstream.
    """
    lex = lexicon or Lexicon()
    work = df.withColumn("_tk", F.coalesce(F.col(tokens), F.array().cast("array<string>")))
    work = work.withColumn("_raw", F.coalesce(F.col(raw_text), F.lit(""))).withColumn("_mk", lex.marks("_tk"))
    # The tokens of the sentences, one after the other, are the tokens of the text: every text is taken apart once.
    work = work.withColumn("_sent", F.transform(T.sentences(F.col("_raw")), T.word_tokens))
    work = S.sentence_scores(work, "_sent", lex, "_scores", "_tokscores")
    work = work.withColumn("_read", T.readability_of(F.flatten("_sent"), F.size("_sent")))
    if tags:
        work = work.withColumn("_depths", head_depths(
            F.transform(tags, lambda t: t["text"]), F.transform(tags, lambda t: t["head"])
        ))
    tk, mk, raw = F.col("_tk"), F.col("_mk"), F.col("_raw")
    groups: dict[str, Column] = {
        "sentiment": polarity(mk, lex),
        "vader": S.valence_scores(F.col("_tokscores")),
        "syntactic": token_shape(tk),
        "lexical": lexical_diversity(tk),
        "sentence": S.sentence_summary(F.col("_scores")),
        "readability": F.struct(
            F.col("_read.fk_grade").alias("fk_grade"),
            F.col("_read.ease").alias("ease"),
            _ratio(F.col("_read.complex_words"), F.size(tk)).alias("complex_word_ratio"),
        ),
        "hedge": hedging(mk, lex),
        "negation": negation(mk, lex),
        "compositional": compositional(mk, lex),
        "subjectivity": subjectivity(mk, raw, lex),
        "punct": F.struct(
            T.exclamations(raw).alias("exclamation_count"),
            T.repeated_punctuation(raw).alias("repeated_punct_count"),
        ),
        "domain_sentiment": domain_sentiment(mk, lex),
    }
    if tags:
        groups["pos"] = pos_ratios(F.col(tags))
        groups["dependency"] = dependency_shape(F.col("_depths"))
    if entities:
        groups["entity"] = entity_summary(F.col(entities), tk, F.col("_scores"))
    staged = work.select(
        *df.columns,
        *[c.alias(f"_g_{n}") for n, c in groups.items()],
        word_features(tk, mk, lex).alias("_words"),
        *([entity_features(F.col(entities)).alias("_ents")] if entities else []),
    )
    numeric = [
        F.struct(
            F.lit(feature_key(name, fld.name)).alias("feature"),
            F.col(f"_g_{name}.{fld.name}").cast("double").alias("value"),
        )
        for name in groups
        for fld in staged.schema[f"_g_{name}"].dataType.fields
    ]
    pairs = F.concat(F.array(*numeric), F.col("_words"), *([F.col("_ents")] if entities else []))
    return staged.select(*df.columns, F.map_from_entries(pairs).alias("features"))


def feature_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Long form (keys..., feature, value) of the feature map."""
    return df.select(*keys, F.inline(F.map_entries("features")).alias("feature", "value"))
