"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

1. Texts are cut into pre-tokens (words) by the vocabulary's pattern.  The documents of a split
   form blocks; a block numbers its distinct words in order, and a document becomes the sequence of its
   words' numbers, which keeps their positions.  Blocks are written to the shared folder once, in buckets of their
   own, so texts are not shuffled.
2. The distinct words of all blocks are shuffled by a hash of the word: a block sends one packed row per
   bucket of words, ``BUCKETS`` buckets per shuffle partition.  In its bucket a word meets its equals of all
   blocks and is merged once.  A word that occurs everywhere is one entry per block, not one per occurrence.
3. The ids go back to their blocks, bucket by bucket, and every block puts its documents together by position.

Decoding joins the table of token bytes, which has one row per id of the vocabulary and so is
small enough for every task, to the ids by position.

A block ends after ``BLOCK_WORDS`` distinct words or ``BLOCK_TOKENS`` pre-tokens, at the end of a
document, so a task holds one block of documents, or one document, at a time.  A lost executor
costs its own part of a shuffle; the blocks' numbers come from the shared folder and cannot change.

Defined results: null or empty text has no ids and decodes to no bytes; repeated rows are
encoded each for itself; an empty table gives no rows; a null id stays null; other columns are
ignored.  A null list of ids decodes to no bytes; an id outside the vocabulary fails.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosa.llm.buffers import column, row_ranges, slices, squeeze, unsqueeze, utf8
from glosa.llm.tables import bucketed, quoted

BLOCK_WORDS = 1 << 18
BLOCK_TOKENS = 1 << 20
BUCKETS = 4
#: Word rows have a bucket and words; text rows have the bucket -1 and some documents; one row has
#: the bucket -2 and the bucket of every word of the block.
BLOCK_FIELDS = "block bigint, bucket int, doc_ids array<bigint>, counts array<int>, body binary"
#: Separates words: it never occurs in UTF-8.
_GAP = b"\xff"


@cache
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file: one base64 token and its id a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(number) for token, number in map(bytes.split, lines)}


@cache
def _merger(path: str):
    """Merges whole words: its own pattern takes any text as one piece."""
    import tiktoken

    return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks(path), special_tokens={})


class _Block:
    """Distinct words of the documents so far, and the documents as their numbers."""

    def __init__(self, name: int, buckets: int) -> None:
        self.name, self.buckets, self.numbers, self.tokens = name, buckets, {}, 0

    def add(self, keys: list, texts: list[str], cut) -> pa.RecordBatch:
        words, counts = [], []
        for text in texts:
            found = cut(text)
            counts.append(len(found))
            words += found
        numbers = self.numbers
        for word in dict.fromkeys(words):
            if word not in numbers:
                numbers[word] = len(numbers)
        self.tokens += len(words)
        body = squeeze(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        return self._rows([-1], [keys], [counts], [body])

    def words(self) -> pa.RecordBatch:
        words = [w.encode() for w in self.numbers]
        of = np.fromiter(map(crc32, words), np.int64, len(words)) % self.buckets
        order = np.argsort(of, kind="stable")
        buckets, first = np.unique(of[order], return_index=True)
        packed = []
        for at, end in zip(first.tolist(), [*first[1:].tolist(), len(order)]):
            packed.append(zstandard.ZstdCompressor(level=3).compress(_GAP.join([words[i] for i in order[at:end].tolist()])))
        none = [None] * (len(buckets) + 1)
        return self._rows([-2, *buckets.tolist()], none, none, [squeeze(of), *packed])

    def _rows(self, bucket: list, doc_ids: list, counts: list, body: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([self.name] * len(bucket), pa.int64()), pa.array(bucket, pa.int32()),
             pa.array(doc_ids, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32())), pa.array(body, pa.binary())],
            ["block", "bucket", "doc_ids", "counts", "body"])


def _blocks(batches: Iterable[pa.RecordBatch], pattern: str, buckets: int) -> Iterator[pa.RecordBatch]:
    import regex

    cut = regex.compile(pattern).findall
    name = TaskContext.get().partitionId() << 32
    block = _Block(name, buckets)
    for batch in slices(batches):
        _, offsets = utf8(batch.column(1))
        for i, j in row_ranges(offsets):
            keys = batch.column(0).slice(i, j - i).to_pylist()
            yield block.add(keys, batch.column(1).slice(i, j - i).fill_null("").to_pylist(), cut)
            if len(block.numbers) >= BLOCK_WORDS or block.tokens >= BLOCK_TOKENS:
                yield block.words()
                name += 1
                block = _Block(name, buckets)
    yield block.words()


def _merge(rows: pa.Table, path: str) -> pa.Table:
    """The words of one bucket from all blocks -> the number of ids of every word, and the ids."""
    encode = _merger(path).encode_ordinary
    merged: dict[bytes, bytes] = {}
    counts, ids = [], []
    for body in rows.column("body"):
        words = zstandard.ZstdDecompressor().decompress(body.as_py()).split(_GAP)
        for word in words:
            if word not in merged:
                merged[word] = np.asarray(encode(word.decode()), "<i4").tobytes()
        found = list(map(merged.__getitem__, words))
        counts.append(squeeze(np.fromiter(map(len, found), np.int64, len(found)) // 4))
        ids.append(squeeze(np.frombuffer(b"".join(found), "<i4")))
    return pa.table({"block": rows.column("block"), "bucket": rows.column("bucket"),
                     "n_ids": pa.array(counts, pa.binary()), "ids": pa.array(ids, pa.binary())})


def _assemble(words: pa.Table, texts: pa.Table) -> pa.Table:
    """The merged buckets and the texts of one block -> (doc_id, ids)."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    words = words.sort_by("bucket")
    counts = [unsqueeze(c.as_py()) for c in words.column("n_ids")]
    ids = [unsqueeze(c.as_py()) for c in words.column("ids")]
    offsets = np.concatenate(([0], np.cumsum(np.concatenate([*counts, np.zeros(0, np.int64)]))))
    lists = pa.LargeListArray.from_arrays(
        pa.array(offsets), pa.array(np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int32)))
    kinds = texts.column("bucket").to_numpy()
    place = np.empty(len(lists), np.int64)
    for row in np.flatnonzero(kinds == -2).tolist():
        # Inside a bucket, words stand in the order of their numbers.
        place[np.argsort(unsqueeze(texts.column("body")[row].as_py()), kind="stable")] = np.arange(len(lists))
    done = []
    for row in np.flatnonzero(kinds == -1).tolist():
        keys = texts.column("doc_ids")[row].values
        number = texts.column("counts")[row].values.to_numpy(zero_copy_only=False)
        found = lists.take(pa.array(place[unsqueeze(texts.column("body")[row].as_py())]))
        ends = found.offsets.to_numpy()[np.concatenate(([0], np.cumsum(number)))]
        done.append(pa.RecordBatch.from_arrays(
            [keys, pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), found.flatten())], schema=schema))
    return pa.Table.from_batches(done, schema)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: doc_id and ``ids`` (array<int>) by the rank file at ``path``; ``pattern`` cuts the text into words."""
    given = docs.select(quoted(key).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = bucketed(given.mapInArrow(lambda batches: _blocks(batches, pattern, buckets), BLOCK_FIELDS), "block")
    merged = blocks.where("bucket >= 0").select("block", "bucket", "body").groupBy("bucket").applyInArrow(
        lambda rows: _merge(rows, path), "block bigint, bucket int, n_ids binary, ids binary")
    texts = blocks.where("bucket < 0").select(F.col("block").alias("of"), "bucket", "doc_ids", "counts", "body")
    return merged.groupBy("block").cogroup(texts.groupBy("of")).applyInArrow(_assemble, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """All columns of ``encoded`` but for one named decoded, and ``decoded``: the bytes of its ``ids``, one after the other."""

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path)
        tokens: list[bytes | None] = [None] * (max(table.values(), default=-1) + 1)
        for token, number in table.items():
            tokens[number] = token
        tokens = pa.array(tokens, pa.large_binary())
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.slice(at, 512)
                lists = column(some, "_ids").fill_null([])
                found = tokens.take(lists.flatten())
                if found.null_count:
                    raise ValueError("an id is not in the vocabulary")
                data, offsets = utf8(found)
                ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
                decoded = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(some), [None, pa.py_buffer(offsets[ends].tobytes()), pa.py_buffer(data.tobytes())])
                rest = [c for c in some.schema.names if c != "_ids"]
                yield pa.RecordBatch.from_arrays([column(some, c) for c in rest] + [decoded.cast(pa.binary())], [*rest, "decoded"])

    keep = [c for c in encoded.columns if c.lower() != "decoded"]
    given = encoded.select(*[quoted(c) for c in keep], quoted(ids).alias("_ids"))
    fields = encoded.select(*[quoted(c) for c in keep]).schema.add("decoded", "binary")
    return given.mapInArrow(joined, fields)
