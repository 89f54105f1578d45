"""Fingerprints and language scores against the same rules in plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter

import regex
from pyspark.sql import functions as F

from glosa.llm import langid, spotsigs

SF = "/root/testdata/sf0.001"


def chains(text: str) -> list[tuple[str, ...]]:
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    found = []
    for i, w in enumerate(words):
        if w in spotsigs.ANCHORS:
            behind = [x for x in words[i + 1 : i + 1 + spotsigs.REACH] if x not in spotsigs.ANCHORS][: spotsigs.CHAIN]
            if len(behind) == spotsigs.CHAIN:
                found.append((w, *behind))
    return found


def test_signatures_are_the_chains_behind_anchors(spark):
    rng = random.Random(4)
    words = [*spotsigs.ANCHORS[:25], *["".join(rng.choices("abcdef", k=4)) for _ in range(40)]]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(120)]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").where("text IS NOT NULL").limit(60).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r.s for r in df.select("i", spotsigs.spots(F.col("text")).alias("s")).collect()}
    every = sorted({c for t in texts for c in chains(t)})
    rows = spark.createDataFrame([(n, list(c)) for n, c in enumerate(every)], "n int, c array<string>")
    code = {every[r.n]: r.h for r in rows.select("n", F.hash("c").alias("h")).collect()}
    with_chains = 0
    for i, text in enumerate(texts):
        mine = chains(text)
        if mine:
            with_chains += 1
            assert got[i] == sorted({code[c] for c in mine})
    assert with_chains > 100


def grams(text: str) -> Counter:
    letters = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    flat = " " + " ".join(letters.split()) + " "
    return Counter(flat[i : i + n] for n in langid.ORDERS for i in range(len(flat) - n + 1))


def test_bayes_by_hand(spark):
    """With so many features that no two n-grams share one, the scores are those of plain naive Bayes."""
    train = [("en", "the cat and the hat"), ("en", "then they thought"), ("de", "der Hund und die Katze"), ("fr", "le chat noir"), (None, "zzz")]
    features, alpha = 1 << 22, 0.5
    counts = langid.train(spark.createDataFrame(train, "lang string, text string"), features=features)
    model = langid.matrix(counts, features, alpha)
    sums = {}
    for lang, text in train:
        if lang:
            sums.setdefault(lang, Counter()).update(grams(text))
    texts = ["the dog", "die Maus", "le chien et le chat", "123", "", "Hund"]
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        if not any(c.isalpha() for c in text):
            assert got[i].lang_pred == langid.UNKNOWN and got[i].score == 0
            continue
        logs = {lang: sum(n * math.log((c[g] + alpha) / (sum(c.values()) + alpha * features)) for g, n in grams(text).items()) for lang, c in sums.items()}
        best = max(sorted(logs), key=logs.get)
        assert got[i].lang_pred == best
        assert math.isclose(got[i].score, 1 / sum(math.exp(v - logs[best]) for v in logs.values()), rel_tol=1e-3)


def test_ties_go_to_the_first_language(spark):
    rows = [("b", "abc"), ("a", "abc")]
    model = langid.matrix(langid.train(spark.createDataFrame(rows, "lang string, text string")))
    assert langid.predict(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), model).first().lang_pred == "a"
