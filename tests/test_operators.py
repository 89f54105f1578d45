import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glosa.operators import balance as B
from glosa.operators import corpus as C
from glosa.operators import frequency as Q
from glosa.operators import merge as M
from glosa.operators import metrics as E
from glosa.operators import skew as K
from glosa.operators import split as Sp
from glosa.operators import vectors as Vx

MERGE_SCHEMA = "game_id bigint, username string, rating string, comment string, ts bigint, seq bigint"


# ------------------------------------------------------------------------ skew
@pytest.mark.parametrize("digits", [
    lambda key: K.key_bucket(key, 1), lambda key: K.key_bucket(key, 16), K.key_digits,
    lambda key: [K.key_bucket(key, 4), F.shiftright(key, 26).bitwiseAND(F.lit(15)), F.shiftright(key, 20).bitwiseAND(F.lit(63))],
])
def test_slots_match_a_plain_ranking(spark, digits):
    rng = random.Random(9)
    groups = ["hot"] * 700 + ["a"] * 40 + ["b"] * 3 + [None] * 10
    rows = [(i, g) for i, g in enumerate(groups)]
    rng.shuffle(rows)
    cuts = {"hot": [100, 250, 250, 690], "a": [0, 40], "b": [5], None: [4]}
    df = spark.createDataFrame(rows, "id bigint, g string")
    quotas = spark.createDataFrame(list(cuts.items()), "g string, cuts array<bigint>")
    key = K.portable_key(F.col("id"))
    got = K.assign_slots(df, ["g"], quotas, key, F.col("id"), digits(key)).collect()
    assert len(got) == len(rows)
    hashed = lambda i: (i * 2654435761 + 42) % (1 << 32)
    members = defaultdict(list)
    for i, g in rows:
        members[g].append(i)
    want = {}
    for g, ids in members.items():
        for rank, i in enumerate(sorted(ids, key=lambda i: (hashed(i), i)), start=1):
            want[i] = sum(c < rank for c in cuts[g])
    assert {r.id: r.slot for r in got} == want


def test_first_rows_by_id_digits(spark):
    rng = random.Random(3)
    ids = [*range(-40, 40), *(rng.getrandbits(63) * rng.choice((1, -1)) for _ in range(300)), 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(g, i) for g in (1, None) for i in set(ids)], "g bigint, id bigint")
    got = defaultdict(list)
    for r in K.first_n(df, ["g"], 150, "id").collect():
        got[r.g].append(r.id)
    assert {g: sorted(v) for g, v in got.items()} == {g: sorted(set(ids))[:150] for g in (1, None)}
    order = df.select("id", F.struct(*K.id_digits(F.col("id"))).alias("d")).distinct().collect()
    assert [r.id for r in sorted(order, key=lambda r: (tuple(r.d), r.id))] == sorted(set(ids))


def test_cuts_read_the_input_three_times(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 7 AS g").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    seen = []

    def quotas(sizes):
        seen.append({r.g: r.n for r in sizes.collect()})
        return sizes.select("g", F.array(F.lit(5).cast("bigint"), F.lit(9).cast("bigint")).alias("cuts"))

    key = K.portable_key(F.col("id"))
    slots = K.assign_slots(df, ["g"], quotas, key, F.col("id"), K.key_digits(key))
    assert seen == [{g: 143 if g < 6 else 142 for g in range(7)}]
    # Two passes are written by now; the plan left over reads the table once.
    plan = slots._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [id") == 1
    assert {(r.g, r.slot): r["count"] for r in slots.groupBy("g", "slot").count().collect()}[3, 1] == 4


def test_prefix_sums_over_many_partitions(spark):
    df = spark.createDataFrame([(f"k{i:03}", i * i % 17) for i in range(200)], "k string, v bigint").repartition(7)
    got = {r.k: r.s for r in K.prefix_sums(df, "k", "v", "s").collect()}
    total = 0
    for i in range(200):
        assert got[f"k{i:03}"] == total
        total += i * i % 17


def test_running_offset_is_a_prefix_sum(spark):
    rows = [(i % 3, i * 7919 % 100003, i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "g bigint, id bigint, v bigint")
    for bits in (3, 16):
        got = {(r.g, r.id): r.o for r in K.running_offset(df, "g", "id", "v", "o", bits).collect()}
        total = 0
        for g, i, v in sorted(rows):
            assert got[g, i] == total
            total += v


# ----------------------------------------------------------------------- merge
def merge(spark, crawler, api, source="combined"):
    c = spark.createDataFrame(crawler, MERGE_SCHEMA)
    a = spark.createDataFrame(api, MERGE_SCHEMA)
    return M.merge_reviews(c, a, source)


def test_merge_rules(spark):
    crawler = [
        (1, "Ann", "7", "Great: game", 10, 0), (1, " ann", "8", "great: GAME", 11, 1), (1, "Bob", None, "ok", 12, 2),
        (1, None, "5", "x", 13, 3),
    ]
    api = [
        (1, "ANN", "1", "GREAT:  game", None, 0),      # colon: lends its comment
        (1, "ann", "2", "great: game!", None, 1),      # other key
        (1, "bob", "N/A", "OK", None, 2),              # unrated: dropped
        (1, "bob", "3", "OK", None, 3),                # no colon: crawler comment stays
        (1, "Cid", "4", "new", None, 4), (1, "cid", "9", "NEW", None, 5), (2, "Ann", "7", "Great: game", None, 6),
    ]
    rows = {(r.game_id, r.username, r.comment): r for r in merge(spark, crawler, api).collect()}
    assert (1, " ann", "GREAT:  game") in rows  # last crawler row, API comment
    ann = rows[1, " ann", "GREAT:  game"]
    assert ann.rating == 8.0 and ann.ts == 11 and ann.seq == 0
    assert rows[1, "Bob", "ok"].rating is None
    assert rows[1, "Cid", "new"].rating == 4.0 and rows[1, "Cid", "new"].ts is None
    assert (1, "unknown", "x") in rows and (2, "Ann", "Great: game") in rows
    assert len(rows) == 6


def test_late_colon_replaces_an_inserted_comment(spark):
    api = [(1, "u", "4", "a : b", None, 0), (1, "u", "5", "A : B", None, 1)]
    row = merge(spark, [], api).first()
    assert row.comment == "A : B" and row.rating == 4.0


def test_merge_sources(spark):
    crawler, api = [(1, "a", "1", "x", 5, 0)], [(1, "b", "2", "y", 9, 0), (1, "c", None, "z", 9, 1)]
    assert [r.username for r in merge(spark, crawler, api, "crawler").collect()] == ["a"]
    only = merge(spark, crawler, api, "api").collect()
    assert [(r.username, r.ts) for r in only] == [("b", None)]
    with pytest.raises(ValueError):
        merge(spark, crawler, api, "other")


def test_metadata_precedence(spark):
    games = spark.createDataFrame([(1, "api", "2000"), (2, "api2", None)], "game_id bigint, name string, yearpublished string")
    ranks = spark.createDataFrame(
        [(1, None, 5, float("nan"), 0), (1, "second", 6, 1.0, 1)], "game_id bigint, name string, rank bigint, average double, seq int")
    stats = spark.createDataFrame([(2, "12.0", 0)], "game_id bigint, total_all string, seq int")
    rows = {r.game_id: r for r in M.build_metadata(games, ranks, stats).collect()}
    assert rows[1].game_info.name is None and rows[1].rankings.overall_rank == 5 and rows[1].stats.avg_rating is None
    assert rows[2].game_info.name == "api2" and rows[2].stats.num_reviews == "12.0"
    assert rows[1].classifications.mechanics == [] and rows[1].game_info.designers == []


def test_thing_names_join(spark):
    df = spark.createDataFrame([(1, "[thing=7][/thing] x [thing=8][/thing]"), (2, "plain"), (3, None)], "review_id bigint, comment string")
    names = spark.createDataFrame([(7, "Seven"), (9, "Nine")], "id bigint, name string")
    got = {r.review_id: r.thing_names for r in M.attach_thing_names(df, names, "review_id", "comment").collect()}
    assert got == {1: {7: "Seven"}, 2: None, 3: None}


# ----------------------------------------------------------------------- corpus
def corpus(spark):
    rows = [
        (1, 10, "u", 8.0, "positive", "en", ["a", "b", "a"]), (1, 11, "v", 3.0, "negative", "es", ["b"]),
        (2, 12, "u", None, None, "en", []), (2, 13, None, 6.0, "neutral", "en", ["C", "a"]),
    ]
    return C.Corpus(spark.createDataFrame(
        rows, "game_id bigint, review_id bigint, username string, rating double, label string, lang string, tokens array<string>"))


def test_corpus_queries(spark):
    c = corpus(spark)
    assert {r.label: r.n for r in c.label_distribution().collect()} == {"positive": 1, "negative": 1, "neutral": 1}
    assert {r.token: r.n for r in c.frequency_distribution().collect()} == {"a": 3, "b": 2, "c": 1}
    assert [r.token for r in c.most_common(2).collect()] == ["a", "b"]
    assert [r.token for r in c.hapaxes().collect()] == ["c"]
    assert c.num_unique_users().first().n == 3 and [r.username for r in c.repeat_users().collect()] == ["u"]
    assert c.rating_distribution(1).count() == 2
    div = c.lexical_diversity().first()
    assert (div.tokens, div.types) == (6, 3)
    empty = c.filter_by_language("de").lexical_diversity().first()
    assert (empty.tokens, empty.types, empty.diversity) == (0, 0, 0.0)
    assert c.select([1], ["positive"]).documents.count() == 1
    assert c.ngrams(0).count() == 0


def test_ngrams_across_documents(spark):
    c = corpus(spark)
    flat = ["a", "b", "a", "b", "c", "a"]
    for n in (2, 3, 4):
        got = {r.ngram: r.n for r in c.ngrams(n, cross_document=True).collect()}
        assert got == dict(Counter(" ".join(flat[i:i + n]) for i in range(len(flat) - n + 1)))


def test_dispersion(spark):
    got = sorted((r.word, r.offset) for r in corpus(spark).lexical_dispersion(["a", "C"]).collect())
    assert got == [("a", 0), ("a", 2), ("a", 5), ("c", 4)]


def test_single_item_lookups(spark):
    games = spark.createDataFrame([(1, (3,))], "game_id bigint, rankings struct<overall_rank:bigint>")
    docs = corpus(spark).documents
    assert C.Corpus(docs, games).overall_rank().first()[0] == 3
    two = games.union(spark.createDataFrame([(2, (4,))], games.schema))
    assert C.Corpus(docs, two).overall_rank().first()[0] is None and C.Corpus(docs, two).overall_rank(2).first()[0] == 4
    with pytest.raises(ValueError):
        C.Corpus(docs, two).all_classifications("other")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=6), min_size=1, max_size=8))
def test_bigrams_are_tokens_minus_documents(spark, lists):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "review_id bigint, tokens array<string>")
    total = Q.ngram_counts(df, 2).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    assert total == sum(len(t) for t in lists) - sum(bool(t) for t in lists)


# ---------------------------------------------------------------------- balance
def reviews(spark, spec):
    rows, i = [], 0
    for game, label, n in spec:
        for _ in range(n):
            rows.append((i, game, label, f"the word {i}", "en"))
            i += 1
    return spark.createDataFrame(rows, "review_id bigint, game_id bigint, label string, comment string, lang string")


def counts(df):
    return Counter((r.game_id, r.label) for r in df.collect())


def test_undersample_hits_the_target(spark):
    df = reviews(spark, [(1, "positive", 30), (1, "neutral", 7), (1, "negative", 12), (2, "positive", 4), (2, None, 3), (3, None, 5)])
    got = counts(B.balance(df, "undersample"))
    assert got == {(1, "positive"): 7, (1, "neutral"): 7, (1, "negative"): 7, (2, "positive"): 4, (3, None): 5}


def test_hybrid_ladder_and_floor(spark):
    df = reviews(spark, [(1, "positive", 100), (1, "neutral", 60), (1, "negative", 9)])
    assert counts(B.balance(df, "hybrid")) == {(1, "positive"): 50, (1, "neutral"): 50, (1, "negative"): 9}
    assert counts(B.balance(df, "hybrid", min_samples=80))[1, "positive"] == 80


def test_oversample_needs_synonyms(spark):
    df = reviews(spark, [(1, "positive", 9), (1, "negative", 2)])
    assert counts(B.balance(df, "oversample")) == {(1, "positive"): 9, (1, "negative"): 2}
    grown = B.balance(df, "oversample", synonyms=B.Synonyms({"en": {"the": ["a", "this"]}}))
    assert counts(grown) == {(1, "positive"): 9, (1, "negative"): 9}
    made = grown.filter("is_augmented").collect()
    assert len(made) == 7 and all(not r.comment.startswith("the") and r.augmented_from is not None for r in made)


def test_many_copies_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(B, "COPIES_PER_TASK_ROW", 10)
    df = reviews(spark, [(1, "positive", 57), (1, "negative", 1)])
    grown = B.balance(df, "oversample", synonyms=B.Synonyms({"en": {"the": ["a"]}}))
    assert counts(grown) == {(1, "positive"): 57, (1, "negative"): 57}


def test_texts_without_synonyms_fall_short(spark):
    df = reviews(spark, [(1, "positive", 5), (1, "negative", 1)])
    grown = B.balance(df, "oversample", synonyms=B.Synonyms({"en": {"zzz": ["a"]}}))
    assert counts(grown)[1, "negative"] == 1
    with pytest.raises(ValueError):
        B.balance(df, "other")


def test_report_totals(spark):
    df = reviews(spark, [(1, "positive", 6), (1, "neutral", 3), (1, "negative", 3)])
    report = B.balance_report(df, B.balance(df, "undersample"))
    row, total = report.first(), B.global_balance(report).first()
    assert (row.total_before, row.total_after, row.subsampled_count) == (12, 9, 3)
    assert total.balance_ratio_max_min == 1.0


def test_rating_cap_skips_items_without_extremes(spark):
    rows = [(i, 1, float(r), i, "c") for i, r in enumerate([1, 1, 2, 2, 5, 5, 5, 5, 5, 10, 10, 10, 7, 7, 7])]
    rows += [(100 + i, 2, float(r), i, "c") for i, r in enumerate([1, 2, 9])]
    df = spark.createDataFrame(rows, "review_id bigint, game_id bigint, rating double, ts bigint, comment string")
    got = B.rating_cap(df).collect()
    assert Counter(r.star for r in got) == {1: 2, 2: 2, 5: 4, 7: 2, 10: 2} and {r.game_id for r in got} == {1}
    assert sorted(r.review_id for r in got if r.star == 7) == [13, 14]  # newest first


# ------------------------------------------------------------------------ split
def test_split_sizes_of_the_documented_corpus(spark):
    df = spark.range(31878).select(F.col("id").alias("review_id"), F.element_at(
        F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive")), (F.col("id") % 3 + 1).cast("int")).alias("label"))
    sizes = {r.label: (r.train, r.val, r.test) for r in Sp.split_sizes(df).collect()}
    assert set(sizes.values()) == {(7438, 1594, 1594)}
    got = Counter(r.split for r in Sp.stratified_split(df).collect())
    assert got == {"train": 22314, "val": 4782, "test": 4782}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 60), min_size=1, max_size=4))
def test_split_sizes_sum_up(spark, sizes):
    df = reviews(spark, [(1, f"c{i}", n) for i, n in enumerate(sizes)])
    rows = Sp.split_sizes(df, ratios=(7, 1.5, 1.5)).collect()
    assert all(r.train + r.val + r.test == r.n for r in rows)
    assert sum(r.test for r in rows) == math.ceil(0.15 * sum(sizes))


# ---------------------------------------------------------------------- vectors
def test_tfidf_by_hand(spark):
    docs = [(1, "en", ["good", "game", "good"]), (2, "en", ["bad", "game"]), (3, "en", ["game"])]
    df = spark.createDataFrame(docs, "review_id bigint, lang string, tokens array<string>")
    vocab = Vx.fit_vocabulary(df, 3, 4)
    names = [r.term for r in vocab.orderBy("idx").collect()]
    assert names == ["en_bad", "en_bad en_game", "en_game", "en_good"]
    got = {r.review_id: dict(zip(r.indices, r["values"])) for r in Vx.tfidf(df, vocab, max_features=4).collect()}
    idf = lambda n: math.log(4 / (1 + n)) + 1
    raw = {2: 1 * idf(3), 3: 2 * idf(1)}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert got[1] == pytest.approx({k: v / norm for k, v in raw.items()}) and got[3] == {2: 1.0}


def test_feature_map_vectors(spark):
    df = spark.createDataFrame([(1, {"b": "2", "k": "x"}), (2, {"a": "1"})], "review_id bigint, f map<string,string>")
    rows = df.select("review_id", Vx.one_hot(F.col("f")).alias("features"))
    vocab = Vx.feature_vocabulary(rows)
    assert [r.feature for r in vocab.orderBy("idx").collect()] == ["a", "b", "k=x"]
    got = {r.review_id: (r.indices, r["values"]) for r in Vx.feature_vectors(rows, vocab, "review_id").collect()}
    assert got == {1: ([1, 2], [2.0, 1.0]), 2: ([0], [1.0])}


def test_shift_only_when_negative(spark):
    rows = spark.createDataFrame([(0, -2.0), (1, 3.0)], "idx bigint, value double")
    assert sorted(r.value for r in Vx.shift_to_positive(rows).collect()) == [0.0, 5.0]
    up = rows.filter("value > 0")
    assert [r.value for r in Vx.shift_to_positive(up).collect()] == [3.0]


# ---------------------------------------------------------------------- metrics
def test_metrics_with_an_unpredicted_class(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")]
    df = spark.createDataFrame(rows, "label string, prediction string")
    rep = {r["class"]: r for r in E.class_report(df).collect()}
    assert rep["c"].precision == 0 and rep["c"].f1 == 0 and rep["b"].precision == pytest.approx(1 / 3)
    got = E.summary_metrics(df).first()
    assert got.accuracy == 0.5 and got.recall == 0.5 and got.precision == pytest.approx((2 * 1 + 1 / 3) / 4)
    table = {r.label: (r.pred_a, r.pred_b, r.pred_c) for r in E.confusion_matrix(df, ["c", "b", "a"]).collect()}
    assert table == {"a": (1, 1, 0), "b": (0, 1, 0), "c": (0, 1, 0)}


def test_naive_bayes_takes_negative_features(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.linalg import Vectors

    from glosa.operators import models as Ml

    rows = [(Vectors.sparse(2, {0: float(1 + i % 3)}), Vectors.dense([-1.0 - i, 2.0]), ["negative", "positive"][i % 2]) for i in range(12)]
    df = spark.createDataFrame(rows, ["ngrams", "opinion", "label"])
    fitted, failed = Ml.train_models(df, ["negative", "positive"], models=("naive_bayes",))
    assert not failed and len(fitted) == 3
    path = str(tmp_path / "chain")
    fitted["naive_bayes", "combined"].write().save(path)
    before = fitted["naive_bayes", "combined"].transform(df).select("predicted").collect()
    assert PipelineModel.load(path).transform(df).select("predicted").collect() == before


def test_chain_equals_join(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["en", "de"]), rng.choices("abcdef", k=rng.randint(0, 30))) for i in range(80)] + [(80, "en", None)]
    df = spark.createDataFrame(rows, "review_id long, lang string, tokens array<string>")
    vocab = Vx.fit_vocabulary(df, df.count(), None)
    slow = {r.review_id: (r.indices, r["values"]) for r in Vx.tfidf(df, vocab, max_features=None).collect()}
    fast = {r.review_id: (r.indices, r["values"]) for r in Vx.tfidf(df, vocab, max_features=1000).collect()}
    assert slow.keys() == fast.keys()
    for key, (places, values) in slow.items():
        assert fast[key][0] == places and fast[key][1] == pytest.approx(values)
    plan = Vx.tfidf(df, vocab, max_features=1000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_document_frequency_in_the_same_pass(spark):
    df = spark.createDataFrame([(1, "en", ["a", "a", "b"]), (2, "en", ["a"])], "review_id long, lang string, tokens array<string>")
    got = {r.term: (r.idx, r.total, r.df) for r in Vx.fit_vocabulary(df, 2, 10, ngram_range=(1, 1)).collect()}
    assert got == {"en_a": (0, 3, 2), "en_b": (1, 1, 1)}


def test_vectors_and_arrays_on_the_jvm(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(1, [0, 3], [1.5, -2.0]), (2, None, None)]
    df = spark.createDataFrame(rows, "id int, i array<int>, v array<double>").withColumn("s", Vx.to_ml_vector(F.col("i"), F.col("v"), 5))
    dense = spark.createDataFrame([(1, Vectors.dense([0.0, -1.0])), (2, Vectors.sparse(5, [4], [0.1]))], ["id", "w"])
    both = df.join(dense, "id").select("id", "s", Vx.with_values(F.col("w"), lambda x: x + 1).alias("up"), Vx.stored_values(F.col("s")).alias("x"))
    got = {r.id: r for r in both.collect()}
    assert got[1].s == Vectors.sparse(5, [0, 3], [1.5, -2.0]) and got[2].s == Vectors.sparse(5, [], [])
    assert got[1].up == Vectors.sparse(2, [0, 1], [1.0, 0.0]) and got[2].up == Vectors.sparse(5, [4], [1.1])
    assert got[1].x == [1.5, -2.0]
    assert "Python" not in both._jdf.queryExecution().executedPlan().toString()


def test_common_feature_names_are_not_joined(spark):
    rows = [(i, {"len": float(i), f"user=u{i}": 1.0}) for i in range(600)]
    df = spark.createDataFrame(rows, "review_id long, features map<string,double>")
    vocab = Vx.feature_vocabulary(df)
    number = {r.feature: r.idx for r in vocab.collect()}
    joined = df.withColumn("features", F.map_concat("features", F.create_map(F.lit("unknown"), F.lit(3.0))))
    got = {r.review_id: dict(zip(r.indices, r["values"])) for r in Vx.feature_vectors(joined, vocab, "review_id").collect()}
    assert got == {i: {number["len"]: float(i), number[f"user=u{i}"]: 1.0} for i in range(600)}


def test_report_counts_once_and_lazily(spark, tmp_path):
    from glosa.operators.corpus import Corpus, corpus_report, report_counts

    rows = [(1, 1, None, 7.0, "positive", "a", ["re", "th", "re"]), (1, 2, "u", None, None, "b", ["th"]), (2, 3, "u", 7.0, "positive", "c", [])]
    df = spark.createDataFrame(rows, "game_id long, review_id long, username string, rating double, label string, comment string, tokens array<string>")
    got = {(r.kind, r.item, r.label): r.n for r in report_counts(df, ("re", "th")).collect()}
    assert got["user", "u", None] == 2 and got["user", None, None] == 1 and got["token", "re", "positive"] == 2
    assert got["bigram", "re th", None] == 1 and got["rating", "7.0", None] == 2 and got["context", "_ th re", None] == 1
    report = corpus_report(Corpus(df), "re", ("re", "th"), ("re",))
    assert "counts" not in vars(report) and len(report) == 17 and "num_reviews" not in report
    assert report["unique_users"].first().n == 2 and report["repeat_users"].first().n == 1
    assert "counts" in vars(report)
    stats = {r.label: (r.tokens, r.types) for r in report["category_stats"].collect()}
    assert stats == {"positive": (3, 2)}
    plan = report["trigrams"]._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan  # the documents are not read again


# --------------------------------------------------------------------- session
def test_a_written_result_leaves_no_shuffle_files(spark):
    """The files of the shuffles before a write are gone with it, and the session's setting is as it was."""
    import time

    from glosa import session

    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def files():
        found = env.blockManager().diskBlockManager().getAllFiles()
        return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}

    before = files()
    out = session.cut_lineage(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    assert spark.conf.get(session.CLEANUP, "false") == "false"
    assert sorted(r["count"] for r in out.collect()) == [714] * 5 + [715] * 2
