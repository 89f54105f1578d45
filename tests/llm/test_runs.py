"""Periodic runs against a brute-force search over all periods."""

from __future__ import annotations

import hashlib
import random
from zlib import crc32

import pytest

from glosa.llm import queries, runs

SF = "/root/testdata/sf0.001"


def by_brute_force(words, min_words=6, times=4):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_words, times * q):
                found.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def some_documents(rng, number):
    out = []
    for _ in range(number):
        n, letters = rng.randint(0, 60), rng.randint(1, 4)
        words = [bytes([97 + rng.randrange(letters)]) for _ in range(n)]
        if n and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, 6)
            words[a:] = (words[a : a + p] * 60)[: n - a]
            if rng.random() < 0.5:
                words += [b"z", *words[a:]]
        out.append(words)
    return out


def test_equal_to_all_periods():
    rng = random.Random(5)
    for _ in range(400):
        documents = some_documents(rng, rng.randint(0, 5))
        assert runs.runs_of(documents) == [by_brute_force(d) for d in documents]


def test_long_lists_meet():
    words = [b"a", b"b", b"c", b"d", b"e", b"f", b"x"] * 300 + [b"a", b"b", b"c", b"d", b"e", b"f", b"y"] * 300
    assert runs.runs_of([words])[0] == by_brute_force(words)


def test_very_long_text():
    words = [b"a"] * 400_000 + [b"b", b"c"] * 200_000
    assert runs.runs_of([words])[0] == [(0, 400_000, 1), (400_000, 400_000, 2)]


def echoed(doc_id, text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    h = crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_by_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op13_runs(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        words = echoed(doc_id, text)
        if len(words) > 3000:
            continue
        found = by_brute_force(words)
        row = got[doc_id]
        assert row.n_runs == len(found)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert row.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if found else None)


def test_null_empty_repeated_and_other_columns(spark):
    rows = [(1, None, 1), (2, "", 2), (3, " \t\n", 3), (4, "a a a a a a", 4), (4, "a a a a a a", 4), (None, "b c " * 4, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs long")
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(df).collect())
    assert got == [
        ("1", 0, [], ""), ("2", 0, [], ""), ("3", 0, [], ""),
        ("4", 6, [(0, 6, 1)], "a"), ("4", 6, [(0, 6, 1)], "a"), ("None", 8, [(0, 8, 2)], "b c")]
    assert runs.periodic_runs(df.limit(0)).collect() == []
    assert runs.with_echoes(df.limit(0)).collect() == []


def test_ties_take_the_first(spark):
    df = spark.createDataFrame([(1, "a a a a a a x b b b b b b")], "doc_id long, text string")
    found = runs.periodic_runs(df)
    assert tuple(found.select(runs.strongest(found["runs"]).alias("r")).first().r) == (0, 6, 1)


def test_limits_are_checked(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        runs.periodic_runs(df, min_words=4)
