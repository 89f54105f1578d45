"""Steps that many queries share: the same results as plain rules, and no work done twice."""

import math
import random
import re

from pyspark.sql import functions as F

from glosa.functions import text as T
from glosa.functions import tokens as K
from glosa.operators import language as La
from glosa.operators import vectors as Vx
from glosa.plans import corpus_queries

ODD = [*"ab  1_.ß", "Æ", "«", "…", "é", "ж", "щ", "か", "中", "́", "ﬁ", "😀", "𝒳", "etc", " etc ", "info", "\n", " "]


def odd_texts(n=300):
    rng = random.Random(5)
    return ["", "a", "😀", "ab", "etc", *["".join(rng.choices(ODD, k=rng.randint(0, 25))) for _ in range(n)]]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_character_grams_by_pattern(spark):
    df = spark.createDataFrame([(t,) for t in odd_texts()], "t string")
    assert "(?=(..))" in plan_of(df.select(La.character_grams(F.col("t")).alias("g")))
    for row in df.select(La.characters(F.col("t")).alias("c"), La.character_grams(F.col("t")).alias("g")).collect():
        assert row.g == ["".join(row.c[i : i + n]) for n in (2, 3) for i in range(len(row.c) - n + 1)]


def test_ngrams_without_slices_of_every_place(spark):
    rows = [(None,), ([],), (["a"],), (["a", "b"],), (["a", None, "c", "d"],)]
    df = spark.createDataFrame(rows, "t array<string>").select("t", K.ngrams(F.col("t"), 3).alias("g"))
    assert "sequence" not in plan_of(df)
    assert [r.g for r in df.collect()] == [[], [], [], [], ["a c", "c d"]]


def test_transliteration_of_single_letters(spark):
    source, target, longer = T._latin_tables()
    table = {**dict(zip(source, target)), **longer, **T.SPECIAL_LETTERS, **T._script_tables()}
    kept = re.compile(r"[^\W_]")
    letter = lambda c: c if c < "\x80" else table.get(c, c if kept.match(c) and c != "́" else "")
    df = spark.createDataFrame([(t,) for t in odd_texts()], "t string").select("t", T.transliterate(F.col("t")).alias("out"))
    assert plan_of(df).count("replace(") <= 2  # one for what is dropped, not one pass for each letter
    for r in df.collect():
        assert r.out == "".join(letter(c) for c in r.t), r.t


def test_abbreviations_only_where_they_are(spark):
    df = spark.createDataFrame([(t,) for t in odd_texts()], "t string").select("t", T.expand_abbreviations(F.col("t")).alias("out"))
    for r in df.collect():
        words = re.sub(r"\s+", " ", r.t).strip(" ").split(" ")
        assert r.out == " ".join(T.ABBREVIATIONS.get(w, w) for w in words).strip(" "), r.t


def test_lengths_tokenise_once(spark, sf):
    plan = plan_of(corpus_queries.language_and_length_summary(spark, sf))
    assert "size(" in plan and not [x for x in plan.splitlines() if "Filter" in x and "regexp_extract_all" in x]


def test_terms_are_sorted_without_a_comparator(spark):
    rows = [(1, ["b", "a", "b"], "en"), (2, ["a"], "en"), (3, [], "en")]
    found = Vx.fit_vocabulary(spark.createDataFrame(rows, "review_id long, tokens array<string>, lang string"), 3, 10)
    assert "sort_array(" in plan_of(found) and "array_sort(" not in plan_of(found)
    assert {r.term: (r.idx, r.total, r.df) for r in found.collect()} == {
        "en_a": (0, 2, 2), "en_a en_b": (1, 1, 1), "en_b": (2, 2, 1), "en_b en_a": (3, 1, 1)}


def test_report_writes_no_rare_ngrams(spark, monkeypatch):
    from glosa.operators import corpus as C

    written, cut = [], C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df: written.append(cut(df)) or written[-1])
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, 1, "u", 7.0, "positive", words), (1, 2, "u", None, None, ["w0", "w1"])],
                                 "game_id bigint, review_id bigint, username string, rating double, label string, tokens array<string>")
    report = C.corpus_report(C.Corpus(docs))
    assert report["bigrams"].collect()[0].asDict() == {"ngram": "w0 w1", "n": 2} and report["trigrams"].count() == 5
    assert {r.token: r.n for r in report["most_common"].collect()}["w0"] == 2
    assert not any("bigram" in str(r) for df in written for r in df.collect()) and max(df.count() for df in written) < 60


def test_features_take_a_text_apart_once(spark):
    from glosa.functions import features as X
    from glosa.functions import sentiment as S
    from glosa.functions.lexicons import Lexicon

    text = "Very good game! It is not bad.  GREAT fun, einßig gut. \t ok"
    df = spark.createDataFrame([(text,), ("",), (None,)], "comment string").withColumn("tokens", T.word_tokens(F.col("comment")))
    made = X.extract_features(df, Lexicon())
    assert plan_of(made).count("split(") == 1
    alone = S.with_text_scores(df.withColumn("raw", F.coalesce("comment", F.lit(""))), "raw", Lexicon(), "s").select(
        "comment", S.valence_scores(F.col("s")).alias("v"), T.readability(F.col("raw")).alias("r"))
    got = {r.comment: r.features for r in made.collect()}
    for row in alone.collect():
        for name in ("compound", "pos", "neu", "neg"):
            assert got[row.comment][f"vader.{name}"] == row.v[name]
        assert got[row.comment]["readability.ease"] == row.r.ease


def test_language_model_from_sums(spark):
    texts = [("en", "the cat and the dog"), ("de", "der Hund und die Katze"), ("de", "ja"), ("fr", "x"), ("en", " "), (None, "the")]
    model = La.train_language_model(spark.createDataFrame(texts, "lang string, comment string"), size=20)
    vocabulary, languages, bayes = model.stages
    docs, grams = {"en": 1, "de": 2, "fr": 1}, {}
    for lang, text in texts:
        if lang and text.strip():
            low = text.lower()
            for gram in [low[i : i + n] for n in (2, 3) for i in range(len(low) - n + 1)]:
                grams[lang, gram] = grams.get((lang, gram), 0) + 1
    assert languages.labels == ["de", "en", "fr"] and bayes.getWeightCol() == "weight"
    for i, lang in enumerate(languages.labels):
        assert abs(bayes.pi[i] - math.log((docs[lang] + 1) / (4 + 3))) < 1e-9
        known = [grams.get((lang, g), 0) for g in vocabulary.vocabulary]
        for j, n in enumerate(known):
            assert abs(bayes.theta[i, j] - math.log((n + 1) / (sum(known) + len(known)))) < 1e-9


def test_tokens_are_not_made_in_a_filter(spark, monkeypatch):
    written = []
    from glosa.operators import frequency as Q

    monkeypatch.setattr(Q, "cut_lineage", lambda df: written.append(plan_of(df)) or df)
    rows = [(1, 1, "a b"), (1, 2, ""), (2, 3, "c")]
    df = spark.createDataFrame(rows, "game_id bigint, review_id bigint, t string").select("game_id", "review_id", T.word_tokens(F.col("t")).alias("tokens"))
    got = {r.ngram: r.n for r in Q.ngrams_across_documents(df, 2).collect()}
    assert got == {"a b": 1, "b c": 1} and "Filter" not in written[0]


def test_cleaning_steps_are_left_out_where_they_change_nothing(spark):
    steps = {T.strip_tags: r"<[^>]+>", T.strip_bbcode: r"\[/?[a-zA-Z]+\]", T.mask_urls: T.URL}
    texts = [*odd_texts(), "a<b>c[x]d", "HTTP://x.y z wWw2.q", "www", "a!!!b..c??", "".join(map(chr, range(0xC0, 0x180)))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for step, pattern in steps.items():
        assert "contains(" in plan_of(df.select(step(F.col("t")))).lower()
        mark = "URL" if step is T.mask_urls else " "
        assert df.filter(step(F.col("t")) != F.regexp_replace("t", pattern, mark)).count() == 0
    many = F.lit("".join(map(chr, range(0x4E00, 0x4E00 + T.FEW_LETTERS + 1))))  # these go the other way
    assert df.filter(F.concat(T.transliterate(F.col("t")), many) != T.transliterate(F.concat("t", many))).count() == 0


def test_model_rows_are_cleaned_once(spark, sf, monkeypatch):
    from glosa.plans import model_queries as Mq

    written, cut = [], Mq.cut_lineage
    monkeypatch.setattr(Mq, "cut_lineage", lambda df: written.append(df) or cut(df))
    rows = Mq._countable(spark, sf, 20)
    conditions = [line for line in plan_of(written[0]).splitlines() if "Filter" in line]
    assert not any("size(" in line for line in conditions)
    assert rows.count() == written[0].filter("size(tokens) > 0 AND label IS NOT NULL").count()


def test_running_offsets_shuffle_the_rows_once(spark):
    """The join with the starts of blocks and the window inside them share one shuffle; null groups count like others."""
    from glosa.operators.skew import running_offset

    rows = spark.createDataFrame(
        [(g, i, 1, "text") for i, g in enumerate([1, 1, None, 2, None, 1])], "g bigint, id bigint, v bigint, t string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = running_offset(rows, "g", "id", "v", "o", per_group=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4  # the rows, the blocks, their groups, the starts
        assert sorted((r.id, r.o) for r in found.collect()) == [(0, 0), (1, 1), (2, 0), (3, 0), (4, 1), (5, 2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_corpus_is_compressed_and_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    from glosa import session
    from glosa.sources import readers, writers

    docs = spark.range(300).selectExpr("id % 7 AS game_id", "id AS review_id", "concat('u', id) AS username", "1D AS rating", "repeat('text ', 50) AS comment")
    games = spark.range(7).selectExpr("id AS game_id", "named_struct('name', 'n') AS game_info")
    seen, text = [], type(docs.write).text
    monkeypatch.setattr(type(docs.write), "text", lambda self, *a, **k: seen.append(spark.conf.get(session.CLEANUP)) or text(self, *a, **k))
    writers.write_corpus(docs, games, str(tmp_path / "c"), per_record=4)
    files = [f for f in (tmp_path / "c").iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".gz") for f in files) and sum(f.stat().st_size for f in files) < 300 * 250 / 3
    assert seen == ["true"]
    assert readers.read_corpus(spark, str(tmp_path / "c"))[1].count() == 300


def test_corpus_records_are_shuffled_as_json(spark):
    """Nested rows take more room in a shuffle than their JSON: the records are one text each."""
    from glosa.sources import writers

    docs = spark.createDataFrame([(1, i, "u", 1.0, 'a "b"\n}') for i in (2, 0, 1)], "game_id bigint, review_id bigint, username string, rating double, comment string")
    games = spark.createDataFrame([(1, "n")], "game_id bigint, name string")
    lines = writers.corpus_records(docs, games, per_record=2)
    assert lines.columns == ["value"]
    read = spark.read.json(lines.rdd.map(lambda r: r.value)).collect()
    found = sorted((r["first"], [x.review_id for x in r.reviews], {x.raw_text for x in r.reviews}) for r in read if r.reviews)
    assert found == [(0, [0, 1], {'a "b"\n}'}), (2, [2], {'a "b"\n}'})]
    assert [(r.game_id, r.metadata.name) for r in read if r.metadata] == [(1, "n")]
