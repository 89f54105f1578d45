import html

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glosa.functions import text as T
from glosa.functions.dates import parse_review_time


def one(spark, value, expr, kind="string"):
    row = spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("o")).first()
    return row.o


def test_markup_and_urls(spark):
    text = "This is a <b>bold</b> and [i]italic[/i] review. Visit https://example.com!"
    out = one(spark, text, T.normalize_text)
    assert out == "this is a bold and italic review. visit url"
    assert "[size=7]" in one(spark, "x [size=7]y[/size]", T.normalize_text)


def test_lower_is_honoured(spark):
    assert one(spark, "Catan is GREAT!!!", lambda c: T.normalize_text(c, lower=False)) == "Catan is GREAT!!"


def test_blank_texts(spark):
    for blank in (None, "", "  \n\t"):
        assert one(spark, blank, T.normalize_text) == ""


@pytest.mark.parametrize("text", [
    "a &amp; b", "&amp;lt;", "&lt;b&gt;", "&#65;&#x41;", "&notit;", "&copy2020", "&zzz;", "&#128;", "&#0;", "&#xD800;",
    "&#128512;", "no entity", "&", "&amp", "a&nbsp;b", "&#11;x", "&#99999999999;",
])
def test_entities_match_the_standard_library(spark, text):
    assert one(spark, text, T.unescape_html) == html.unescape(text)


@pytest.mark.parametrize("text,kept", [
    ("c'est incroyable! très intéressant", "c'est incroyable! très intéressant"),
    ("¡Hola! ¿Cómo estás? ñoño español", "cómo estás? ñoño español"),
    ("Äußerst schön und größer", "äußerst schön und größer"),
    ("Je n'ai cependant pas vraiment l'envie", "je n'ai cependant pas vraiment l'envie"),
])
def test_accents_survive(spark, text, kept):
    assert kept in one(spark, text, T.normalize_keep_accents)


def test_accents_are_transliterated(spark):
    assert one(spark, "Äußerst schön & größer, Œuvre", T.normalize_text) == "ausserst schon & grosser, oeuvre"


def test_repeats(spark):
    assert one(spark, "soooo 1111 !!!! ????? .....", T.normalize_text) == "soo 11 !! ?? ."
    assert one(spark, "ééé aaa", lambda c: T.collapse_repeats(c, ascii_only=True)) == "ééé aa"


def test_abbreviations_match_whole_tokens(spark):
    assert one(spark, "30 mins etc etc. Dr", T.normalize_text) == "30 minutes etcétera etc. dr"


def test_problem_characters(spark):
    assert one(spark, "a​b\u0007c ‘x’ – …", T.remove_problem_characters) == "abc 'x' - ..."


def test_emoji_become_names(spark):
    assert one(spark, "ok \U0001F600", T.name_emoji) == "ok :grinning_face:"


def test_thing_tags(spark):
    df = spark.createDataFrame([("[thing=123][/thing] and [thing=999][/thing]!",)], "v string")
    names = F.expr("map(123L, 'Catan')")
    assert df.select(T.replace_thing_tags(F.col("v"), names)).first()[0] == "Catan and !"
    assert df.select(T.replace_thing_tags(F.col("v"))).first()[0] == " and !"


def test_patterns(spark):
    text = "mail me@example.com on 12/05/2024 or +34 678123456, see www.example.org #fun @you \U0001F600"
    got = one(spark, text, T.special_patterns)
    assert got.emails == ["me@example.com"] and got.dates == ["12/05/2024"]
    assert got.hashtags == ["#fun"] and got.mentions == ["@example", "@you"]
    assert got.urls == ["www.example.org"] and got.emojis == ["\U0001F600"]
    assert any("678123456" in p for p in got.phones)


def test_sentences_and_tokens(spark):
    assert [s.strip() for s in one(spark, "One. Two!  Three? ", T.sentences)] == ["One.", "Two!", "Three?"]
    assert one(spark, "Éçeau d'été_2!", T.word_tokens) == ["éçeau", "d", "été_2"]


@pytest.mark.parametrize("code,want", [("es-ES", "es"), ("unknown", "en"), (None, "en"), ("xx", "en"), ("FR", "fr")])
def test_language_codes(spark, code, want):
    assert one(spark, code, T.language_code) == want


def test_stopword_language(spark):
    assert one(spark, "xx", T.stopword_language) == "english"
    assert one(spark, "de", T.stopword_language) == "german"


@pytest.mark.parametrize("rating,want", [
    (7.0, "positive"), (6.9, "neutral"), (5.0, "neutral"), (4.99, "negative"), (None, None), (float("nan"), "negative"),
])
def test_rating_label(spark, rating, want):
    assert one(spark, rating, T.rating_label, "double") == want


def test_flags(spark):
    assert [one(spark, v, T.flag_value) for v in (" 1 ", "0", "true", "2", None)] == [1, 0, None, None, None]
    assert one(spark, True, lambda c: T.flag_value(c, boolean=True), "boolean") == 1


def test_tolerant_numbers(spark):
    as_int = lambda c: T.number_or_null(c, "bigint")
    assert [one(spark, v, as_int) for v in ("12.0", "7", "N/A", "x", None)] == [12, 7, None, None, None]


def test_readability_of_empty_text(spark):
    got = one(spark, "", T.readability)
    assert (got.fk_grade, got.ease, got.complex_words, got.words) == (0.0, 0.0, 0, 0)


@pytest.mark.parametrize("raw,want", [
    ("Today at 10:05", 1705313100), ("yesterday at 0:00", 1705190400), ("Last updated: 5 Jan 2024", 1704412800),
    ("5 ene 2024", 1704412800), ("31 feb 2024", None), ("5 foo 2024", None), ("whenever", None), (None, None),
    ("today at 25:00", None),
])
def test_review_times(spark, raw, want):
    now = F.lit("2024-01-15 12:00:00").cast("timestamp")
    assert one(spark, raw, lambda c: parse_review_time(c, now)) == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aAé!? .\n<>b&#12", max_size=40), min_size=1, max_size=20))
def test_space_and_punctuation_steps_are_idempotent(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    once = df.select(T.collapse_space(T.collapse_punctuation(F.col("v"))).alias("a"))
    rows = once.select("a", T.collapse_space(T.collapse_punctuation(F.col("a"))).alias("b")).collect()
    assert all(r.a == r.b for r in rows)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="&;#xamplt1aF0 ", max_size=25), min_size=1, max_size=20))
def test_entities_match_on_random_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    rows = df.select("v", T.unescape_html(F.col("v")).alias("o")).collect()
    assert all(r.o == html.unescape(r.v) for r in rows)


def test_other_scripts_survive(spark):
    from pyspark.sql import functions as F

    from glosa.functions.text import merge_key, normalize_text

    rows = [(1, "Отличная игра для семьи"), (2, "Ужасные правила и скука"), (3, "Καλό παιχνίδι"), (4, "ゲーム 面白い です"), (5, "&#0000000065;&#x000041; ok")]
    df = spark.createDataFrame(rows, "id int, t string").select("id", normalize_text(F.col("t")).alias("c"), merge_key(F.lit("u"), F.col("t")).alias("k"))
    out = {r.id: r for r in df.collect()}
    assert out[1].c == "otlichnaia igra dlia sem'i" and out[3].c == "kalo paikhnidi" and out[5].c == "aa ok"
    assert "geemu" in out[4].c or "ge" in out[4].c
    assert "面白" in out[4].c and out[1].k != out[2].k
