"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from glosa.llm import collocations


def by_counting(rows, threshold, top, longest=5):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[\x20\x09]", piece) if w]
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= threshold}
        inside = {(g[i:j], a) for g, a in candidates.items() for i in range(len(g)) for j in range(i + 1, len(g) + 1) if j - i < len(g)}
        lines = []
        for g, a in candidates.items():
            if (g, a) in inside:
                continue
            score, k = min((1000 * a * totals[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            lines.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(lines)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def some_rows(seed, number, letters="abcdé"):
    rng = random.Random(seed)
    rows = []
    for _ in range(number):
        words = rng.choices(letters, weights=range(1, len(letters) + 1), k=rng.randint(0, 40))
        if rng.random() < 0.5:
            words[3:3] = ["Once", "upon", "a", "time", "there"]
        marks = rng.choices([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b"], k=len(words))
        rows.append((rng.choice(["x", "y", None]), "".join(w + m for w, m in zip(words, marks))))
    return rows


def found(spark, rows, threshold, top, parts=5):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    return sorted(tuple(r) for r in collocations.collocations(df, threshold, top).collect())


@pytest.mark.parametrize(("seed", "threshold", "top"), [(1, 4, 2000), (2, 2, 10)])
def test_equal_to_counting(spark, seed, threshold, top):
    rows = some_rows(seed, 120)
    assert found(spark, rows, threshold, top) == by_counting(rows, threshold, top)


def test_small_shards_and_hot_language(spark, monkeypatch):
    rows = [("x", t) for _, t in some_rows(3, 100)] + [("x", "to be or not to be " * 30)] * 20
    expected = by_counting(rows, 5, 50)
    assert found(spark, rows, 5, 50, parts=9) == expected


def test_shards_are_cut_at_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_TOKENS", 10)
    shard = collocations._Shard("x")
    shard.add([b"a b c, d e f g h i j k l m, n o p q", b"r s t u v w x"])
    rows = shard.rows(1, 3).to_pylist()
    bodies = [collocations.unsqueeze(r["body"]) for r in rows if r["bucket"] == -1]
    assert len(bodies) > 1 and all(b[-1] == 0 for b in bodies)
    assert np.array_equal(np.concatenate(bodies), np.concatenate(shard.parts))


def test_cut_shards_count_the_same(monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_TOKENS", 60)
    rows = [("x", t) for _, t in some_rows(6, 60)]
    # The limit would not reach the workers, so the steps are run here.
    shard = collocations._Shard("x")
    shard.add([t.encode() for _, t in rows])
    table = pa.Table.from_batches([shard.rows(1, 3)])
    of = lambda t, low: t.filter(pa.compute.less(t.column("bucket"), 0) if low else pa.compute.greater_equal(t.column("bucket"), 0))
    buckets = lambda t: [t.filter(pa.compute.equal(t.column("bucket"), b)) for b in sorted(set(t.column("bucket").to_pylist()))]
    words = pa.concat_tables([collocations._merge_words(t, 4) for t in buckets(of(table, False))])
    known = words.filter(pa.compute.is_valid(words.column("shard"))).select(["shard", "bucket", "body"])
    texts = of(table, True).rename_columns(["of", "lang", "bucket", "body", "extra"])
    dense = collocations._known_texts(known, texts)
    merged = pa.concat_tables([collocations._merge_pairs(t, 4) for t in buckets(collocations._pairs(dense, 3))])
    two = [r for r in merged.to_pylist() if r["shard"] is None]
    flags = merged.filter(pa.compute.is_valid(merged.column("shard")))
    phrases = collocations._phrases(flags, dense.rename_columns(["of", "lang", "bucket", "body", "extra"]), 3)
    merged = pa.concat_tables([collocations._merge_phrases(t, 4) for t in buckets(phrases)])
    ids = {r["id"]: r["word"] for r in words.to_pylist() if r["id"] is not None}
    got = {" ".join(ids[r[w]] for w in collocations.WORDS if r[w] >= 0): r["f"] for r in merged.to_pylist()}
    got |= {f"{ids[r['x']]} {ids[r['y']]}": r["f"] for r in two}
    expected = {r[2]: r[3] for r in by_counting(rows, 4, 10**6)}
    assert expected.items() <= got.items() and len(got) >= len(expected) > 20


def test_trees_are_packed_and_unpacked():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 4, 300)
    grams = sorted({tuple(text[i : i + m]) + (-1,) * (5 - m) for m in (3, 4, 5) for i in range(len(text) - m + 1)})
    rows = np.array([[*g, 7, 3] for g in grams]).T
    assert np.array_equal(collocations._unpack_tree(*collocations._pack_tree(rows)), rows)


def test_rows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(collocations, "_hash", lambda *c: np.zeros(len(c[0]), np.uint64))
    rows = np.array([[1, 2, 1, 2, 1], [5, 5, 6, 5, 5]])
    order, new = collocations._same(rows)
    assert new.sum() == 3 and len(set(map(tuple, rows[:, order[new]].T.tolist()))) == 3


def test_index_counts_and_extensions():
    rng = np.random.default_rng(4)
    text = np.append(rng.integers(0, 4, 400), 0)
    index = collocations.Index(text, 4, 5)
    state = index.words()
    words = text.tolist()
    for length in range(1, 6):
        if length > 1:
            state = index.extend_left(*state)
        grams = Counter(tuple(words[i : i + length]) for i in range(len(words) - length + 1) if 0 not in words[i : i + length])
        phrases = list(zip(*[p.tolist() for p in index.phrase(state[0], length)]))
        assert dict(zip(phrases, state[1].tolist())) == grams
        left, right = index.extensions(*state)
        for g, a, b in zip(phrases, left.tolist(), right.tolist()):
            at = [i for i in range(len(words) - length + 1) if tuple(words[i : i + length]) == g]
            before, behind = {words[i - 1] for i in at}, {words[i + length] for i in at}
            assert a == (before.pop() if len(before) == 1 else 0)
            assert b == (behind.pop() if len(behind) == 1 else 0)


def test_products_beyond_64_bits(spark):
    a, n = 3 * 10**12, 10**13
    words = collocations.WORDS
    known = spark.createDataFrame([(1, "x", "p", a + 1), (2, "x", "q", a + 2)], "id long, lang string, word string, f long")
    phrases = spark.createDataFrame([(1, 2, -1, -1, -1, a, False)], ", ".join(f"{w} long" for w in words) + ", f long, inside boolean")
    totals = spark.createDataFrame([("x", n)], "lang string, n long")
    row = collocations.scored(known, phrases, totals).first()
    assert (row.phrase, row.l, row.r, row.score) == ("p q", a + 1, a + 2, 1000 * a * n // ((a + 1) * (a + 2)))


def test_ties_null_empty_and_other_columns(spark):
    rows = [("x", "b a, d c", 1), ("x", "b a, d c", 2), (None, None, 3), ("x", "", 4), ("x", " ,.\n", 5)]
    df = spark.createDataFrame(rows, "lang string, text string, score long")
    got = [tuple(r) for r in collocations.collocations(df, 2, 5).orderBy("rank").collect()]
    assert got == [("x", 1, "b a", 2, 2, 2, 8, 4000), ("x", 2, "d c", 2, 2, 2, 8, 4000)]
    assert collocations.collocations(df.limit(0), 2, 5).collect() == []


def test_very_long_text(spark):
    text = "one two three " * 100_000
    got = {r.phrase: r.a for r in collocations.collocations(spark.createDataFrame([("x", text)], "lang string, text string"), 100, 50).collect()}
    assert got["one two three one two"] == 99_999
