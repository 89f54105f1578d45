"""The corpus pipeline on odd tables: nothing, nulls, repeated rows, other columns."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def write(spark, path, docs):
    rows = [(d, t, lang, "src1", None if t is None else len(t)) for d, t, lang in docs]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    labels = [(d, 1, 0) for d, t, _ in docs if d is not None and t]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "the item that must not be learned by heart"), (2, None)], "item_id bigint, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return str(path)


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path / "e", [])).count() == 0


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rng = random.Random(2)
    plain = [(i, prose(rng, 120), "en") for i in range(6)]
    copy = (20, plain[0][1], "en")
    leak = (21, prose(rng, 40) + " The item that must NOT be learned by heart. " + prose(rng, 40), None)
    odd = [(30, None, "en"), (31, "", None), (None, prose(rng, 30), "en"), plain[1]]
    path = write(spark, tmp_path_factory.mktemp("odd") / "t", [*plain, copy, leak, *odd])
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = f"{path}/{name}"
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        seen[name] = docs
    return seen


def test_all_but_the_last_stage_return_the_columns_of_documents(stages):
    for name, docs in list(stages.items())[:-1]:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_copies_and_repeated_rows_leave_one(stages):
    left = [r.doc_id for r in stages["near_duplicates"].collect()]
    assert 0 in left and 20 not in left and left.count(1) == 1


def test_leaks_go_and_clean_documents_stay(stages):
    left = {r.doc_id for r in stages["decontamination"].collect()}
    assert 21 not in left and set(range(6)) <= left


def test_every_document_left_is_packed(stages):
    packed = {r.doc_id for r in stages["packing"].collect()}
    assert packed == {r.doc_id for r in stages["decontamination"].collect()}
