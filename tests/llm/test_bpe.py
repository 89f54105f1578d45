"""Byte-level BPE against the library itself, and round trips."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest

from glosa.llm import bpe, queries

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})


def both_ways(df):
    done = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH)
    return sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in done.collect()), key=str)


def test_query_equals_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op12_bpe(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = library.encode_ordinary(text)
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_texts_equal_library(spark, library):
    rng = random.Random(7)
    letters = "ab Z 9'é中\U0001f600́\n\t   \x1c\x85٠.,!<|endoftext|>'s 'll"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert both_ways(df) == sorted(((i, library.encode_ordinary(t), t.encode()) for i, t in enumerate(texts)), key=str)


def test_null_empty_repeated_and_very_long(spark, library, monkeypatch):
    long = "many words, " * 120_000 + "x" * 200_000 + " " * 70_000
    rows = [(1, None, "k"), (2, "", "k"), (3, "same", "k"), (3, "same", "k"), (None, "no id", "k"), (5, long, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    expected = sorted(((k, library.encode_ordinary(t or ""), (t or "").encode()) for k, t, _ in rows), key=str)
    assert both_ways(df) == expected
    assert both_ways(df.limit(0)) == []


def test_blocks_with_many_buckets(library):
    import pyarrow as pa
    import regex

    texts = [f"word{i} and word{i + 1} again" for i in range(50)] + ["", " "]
    block = bpe._Block(0, 7)
    rows = pa.Table.from_batches([block.add(list(range(52)), texts, regex.compile(public_tokenizers.PATTERN).findall), block.words()])
    buckets = rows.filter(pa.compute.greater_equal(rows.column("bucket"), 0))
    merged = pa.concat_tables([bpe._merge(buckets.slice(i, 1), PATH) for i in reversed(range(buckets.num_rows))])
    done = bpe._assemble(merged, rows.filter(pa.compute.less(rows.column("bucket"), 0)))
    assert done.column("ids").to_pylist() == [library.encode_ordinary(t) for t in texts]


def test_decode_keeps_columns_and_refuses_strange_ids(spark):
    df = spark.createDataFrame([(1, [64, 65], "x"), (2, None, "y")], "doc_id long, ids array<int>, decoded string")
    got = {r.doc_id: r for r in bpe.decode(df, PATH).collect()}
    assert got[2].decoded == b"" and got[1].ids == [64, 65]
    with pytest.raises(Exception, match="vocabulary|take"):
        bpe.decode(spark.createDataFrame([(1, [70_000])], "doc_id long, ids array<int>"), PATH).collect()
