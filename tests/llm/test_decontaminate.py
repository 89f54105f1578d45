"""Decontamination against plain edit distances at every place of small texts."""

from __future__ import annotations

import random

from glosa.llm import decontaminate as D


def least_edits(item: str, text: str, most: int) -> int:
    """Of the item against every stretch of the text that starts and ends at word edges."""
    n, best = len(text), 1 << 30
    ends = {i for i in range(1, n + 1) if i == n or text[i] == " "}
    for start in (i for i in range(n) if i == 0 or text[i - 1] == " "):
        row = list(range(len(item) + 1))
        for j in range(start, n):
            new = [j - start + 1]
            for i, ch in enumerate(item, 1):
                new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (ch != text[j])))
            row = new
            if j + 1 in ends:
                best = min(best, row[-1])
            if min(row) > most:
                break
    return best


def edited(rng, item: str) -> str:
    out = list(item)
    for _ in range(rng.randint(0, len(item) // 10 + 1)):
        place, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.33:
            out[place] = rng.choice("abcdefgh")
        elif kind < 0.66:
            out.insert(place, rng.choice("abcdefgh"))
        else:
            out.pop(place)
    return "".join(out)


def test_no_occurrence_within_the_budget_is_lost():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 8))) for _ in range(60)]
    true = 0
    for _ in range(40):
        items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(4)]
        texts = []
        for _ in range(6):
            text = " ".join(rng.choices(words, k=rng.randint(0, 25)))
            if rng.random() < 0.8:
                text += " " + edited(rng, rng.choice(items)[1]) + " " + " ".join(rng.choices(words, k=3))
            texts.append(" ".join(text.split()))
        index = D.Index(items, 0.1)
        c, _, bounds = D.normalise(D.letters(), texts)
        got = {(t, i): edits for t, i, _, _, edits in D._hits(index, c, bounds)}
        want = {}
        for t, text in enumerate(texts):
            for i, (_, item) in enumerate(items):
                edits = least_edits(item, text, D.budget(len(item), 0.1))
                if edits <= D.budget(len(item), 0.1):
                    want[t, i] = edits
        assert got == want
        true += len(want)
    assert true > 120


def test_short_items_are_not_found_inside_words(spark):
    docs = spark.createDataFrame([(1, "garden red"), (2, "an E!"), (3, "e")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "e")], "item_id long, text string")
    got = sorted((r.doc_id, r.start, r.end, r.edits) for r in D.find_leaks(docs, items).collect())
    assert got == [(2, 3, 4, 0), (3, 0, 1, 0)]


def test_other_columns_stay_whatever_their_names(spark):
    docs = spark.createDataFrame([(1, "one two three", 5, 6), (2, "something else", 7, 8)], "doc_id long, text string, _u long, __u long")
    items = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    left = D.without_leaks(docs, items)
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == [(2, "something else", 7, 8)]
