"""Columns of the caller survive, whatever they are called."""

from __future__ import annotations

import pytest

from glosa.llm import neardup, ngram_quality, suffixes
from glosa.llm.tables import fresh

CLASHING = ["_u", "_v", "__u", "_packed", "_size", "_ranges", "u", "v", "g", "root"]


@pytest.fixture
def docs(spark):
    texts = ["same words in this text " * 20, "same words in this text " * 20, "another one that stands alone"]
    rows = [(i, t, *range(len(CLASHING))) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in CLASHING))


def test_fresh_names(docs):
    assert fresh(docs, "u", "x") == ["___u", "_x"]


def test_near_duplicates_keep_columns(docs):
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2]


def test_repeats_keep_columns(docs):
    done = suffixes.remove_repeats(docs)
    assert done.columns[: len(docs.columns)] == docs.columns
    assert {r.doc_id: r.n_removed for r in done.collect()}[2] == 0


def test_quality_keeps_columns(docs):
    docs = docs.withColumn("lang", docs["text"].substr(1, 2))
    kept = ngram_quality.keep_good(docs, docs.select("doc_id"))
    assert kept.columns == docs.columns and all(r["g"] == 8 for r in kept.collect())
