import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glosa.functions import features as X
from glosa.functions import lexicons as L
from glosa.functions import sentiment as S
from glosa.functions import tokens as K
from glosa.functions import word_lists as W

LEX = L.Lexicon(
    positive=["good", "great"], negative=["bad", "good2"], intensifiers=["very"], mitigators=["slightly"], negations=["not"],
    hedge_words=["maybe"], propositional=["might"], relational=["think"], discourse=["but"], certainty=[],
    domain={"parts": ["cards"]}, valence={"good": 2.0, "bad": -2.0},
)
WORDS = st.lists(st.sampled_from(["good", "great", "bad", "very", "not", "maybe", "might", "but", "cards", "x", "y"]), max_size=25)


def docs(spark, lists):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "review_id bigint, tokens array<string>")
    return X.with_marks(df, LEX)


def expected_compositional(tokens):
    pos = [i for i, t in enumerate(tokens) if t in LEX.positive]
    neg = [i for i, t in enumerate(tokens) if t in LEX.negative]
    p, n, flips = len(pos), len(neg), 0
    for i, t in enumerate(tokens):
        if t in LEX.negations:
            hp = sum(i < j <= i + 3 for j in pos)
            hn = sum(i < j <= i + 3 for j in neg)
            p, n, flips = p - hp + hn, n + hp - hn, flips + hp + hn
    boost = 0.5 * sum(j > 0 and tokens[j - 1] in LEX.intensifiers for j in pos + neg)
    return p + boost / 2, n + boost / 2, float(p - n), boost, flips


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(WORDS, min_size=1, max_size=15))
def test_marks_features_against_brute_force(spark, lists):
    tk, mk = F.col("tokens"), F.col("marks")
    rows = docs(spark, lists).select(
        "tokens", X.compositional(mk, LEX).alias("c"), X.hedging(mk, LEX).alias("h"),
        X.nearby_sentiment_words(tk, mk, LEX).alias("near"), X.negation_scope(tk, mk, LEX).alias("scope"),
        X.lexical_diversity(tk).alias("l"), X.domain_sentiment(mk, LEX).alias("d"), K.term_counts(tk).alias("tc"),
    ).collect()
    sent, hedges = set(LEX.sentiment), set(LEX.all_hedges)
    for r in rows:
        t = r.tokens
        assert tuple(r.c) == expected_compositional(t)
        near = [w for i, x in enumerate(t) if x in hedges for w in t[max(0, i - 3):i + 4] if w in sent]
        assert r.near == near and r.h.nearby_sentiment_count == len(near)
        assert r.h["count"] == sum(x in hedges for x in t)
        assert r.scope == [w for i, x in enumerate(t) if x in LEX.negations for w in t[i + 1:i + 4]]
        counts = Counter(t)
        assert {c.term: c.n for c in r.tc} == dict(counts)
        n = max(len(t), 1)
        assert math.isclose(r.l.ttr, len(counts) / n) and math.isclose(r.l.hapax_ratio, sum(c == 1 for c in counts.values()) / n)
        assert math.isclose(r.l.entropy, -sum(c / n * math.log2(c / n + 1e-10) for c in counts.values()), abs_tol=1e-9)
        assert r.d.domain_sentiment_bigram_count == sum(a == "cards" and b in sent for a, b in zip(t, t[1:]))
        assert r.d.domain_sentiment_trigram_count == sum(
            a == "cards" and b in sent and c in sent for a, b, c in zip(t, t[1:], t[2:]))


def test_concordance_and_contexts(spark):
    tk = ["a", "Good", "b", "c", "good"]
    df = docs(spark, [tk])
    hits = df.select(K.concordance(F.col("tokens"), "GOOD", 2).alias("h")).first().h
    assert [(h.left, h.hit, h.right) for h in hits] == [("a", "Good", "b c"), ("b c", "good", "")]
    found = df.select(K.word_contexts(F.col("tokens"), ["good", "zzz"], 1).alias("h")).first().h
    assert found == ["a _ b", "c _"]
    with pytest.raises(ValueError):
        K.word_contexts(F.col("tokens"), ["good"])


def test_ngrams_edges(spark):
    df = docs(spark, [["a", "b"], ["a"], []])
    assert [r[0] for r in df.select(K.ngrams(F.col("tokens"), 2)).collect()] == [["a b"], [], []]
    assert [r[0] for r in df.select(K.ngrams(F.col("tokens"), 0)).collect()] == [[], [], []]


def test_valence_rules(spark):
    df = spark.createDataFrame([("very good",), ("not good",), ("x y very z good",), ("",)], "t string")
    rows = S.with_text_scores(df, "t", LEX, "s").select(S.valence_scores(F.col("s")).alias("v"), "s").collect()
    assert math.isclose(rows[0].s[1], 2.293) and math.isclose(rows[1].s[1], -1.48)
    assert math.isclose(rows[2].s[4], 2.0 + 0.293 * 0.95)
    assert tuple(rows[3].v) == (0.0, 0.0, 0.0, 0.0)
    s = 2.293
    assert math.isclose(rows[0].v.compound, s / math.sqrt(s * s + 15)) and math.isclose(rows[0].v.pos, 3.293 / 4.293)


def test_sentence_summary_defaults(spark):
    df = spark.createDataFrame([([],), ([0.5],), ([1.0, 0.0],)], "v array<double>")
    rows = [tuple(r[0]) for r in df.select(S.sentence_summary(F.col("v"))).collect()]
    assert rows[0] == (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    assert rows[1] == (1, 0.5, 0.0, 0.5, 0.5, 0.5, 0.5)
    assert rows[2] == (2, 0.5, 0.25, 1.0, 0.0, 1.0, 0.0)


def test_head_depths(spark):
    rows = [
        (["a", "b", "c"], ["b", "c", "c"]),      # chain to a self-headed root
        (["a", "b"], ["b", "a"]),                # cycle
        (["a", "a"], ["x", "a"]),                # last head wins: a -> a
        (["a"], ["unknown"]),
    ]
    df = spark.createDataFrame(rows, "t array<string>, h array<string>")
    got = [r[0] for r in df.select(X.head_depths("t", "h")).collect()]
    assert got == [[2, 1, 0], [2, 2], [0, 0], [1]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcdefgh"), st.sampled_from("abcdefghz")), max_size=12))
def test_depths_against_a_plain_walk(pairs):
    parent = dict(pairs)
    for word in parent:
        walk, node = [], word
        while node in parent and node not in walk and parent[node] != node:
            walk.append(node)
            node = parent[node]
        assert X._depths(parent)[word] == len(walk)


def test_long_head_chain_is_capped(spark):
    words = [f"w{i}" for i in range(200)]
    df = spark.createDataFrame([(words, words[1:] + [words[-1]])], "t array<string>, h array<string>")
    assert df.select(X.head_depths("t", "h")).first()[0][0] == 101


def test_extract_features_keys(spark):
    df = spark.createDataFrame(
        [(1, "I think the cards are not very good! Really?!", ["think", "cards", "not", "very", "good"],
          [("cards", "NOUN", "are")], [("Bob", "PERSON"), ("Bob", "PERSON")]), (2, "", None, [], [])],
        "review_id bigint, comment string, tokens array<string>, tags array<struct<text:string,pos:string,head:string>>, "
        "entities array<struct<text:string,label:string>>")
    rows = X.extract_features(df, LEX, tags="tags", entities="entities").orderBy("review_id").collect()
    f = rows[0].features
    assert f["sentiment.pos_count"] == 1 and f["negation.count"] == 1 and f["compositional.adjusted_neg_count"] == 1.25
    assert f["entity.text=bob"] == 2 and f["entity.count.person"] == 2 and f["entity.label=PERSON"] == 2
    assert f["pos.noun_ratio"] == 1 and f["syntactic.num_dependencies"] == 1 and f["subjectivity.first_person_opinion_count"] == 1
    assert f["hedge.relational=think"] == 1 and f["domain.parts=cards"] == 1 and f["punct.exclamation_count"] == 2
    assert "negation.scope_word=good" in f and "lexicon.intensifier=very" in f
    empty = rows[1].features
    assert empty["lexical.ttr"] == 0 and not any("=" in k for k in empty)


def test_default_lexicon():
    lex = L.Lexicon()
    assert {len(W.NEGATIONS), len(W.MITIGATORS), len(W.CERTAINTY_MARKERS)} == {59, 15, 14}
    assert set(lex.hedge_words) <= set(lex.all_hedges)
    with pytest.raises(ValueError):
        L.Lexicon(positive=[f"w{i}" for i in range(L.MAX_TERMS + 1)])


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "flat.txt").write_text("# note\n; note\n[skip]\n Good \n\ngood\nBAD\n", encoding="utf-8")
    assert sorted(r.term for r in L.load_flat(spark, str(tmp_path / "flat.txt")).collect()) == ["bad", "good"]
    (tmp_path / "s.txt").write_text("Loose\n; c\n[ Parts ]\nCards\n\tDice\n[Play]\nTurn\n", encoding="utf-8")
    rows = sorted(tuple(r) for r in L.load_sections(spark, str(tmp_path / "s.txt")).collect())
    assert rows == [("misc", "loose"), ("parts", "cards"), ("parts", "dice"), ("play", "turn")]


def test_lexicon_table_round_trip(spark):
    again = L.Lexicon.from_table(LEX.table(spark), valence=LEX.valence)
    assert set(again.positive) == set(LEX.positive) and again.domain == LEX.domain
