"""Packing by power-of-two decomposition.

A document of L tokens is split into pieces of ``max_len`` tokens and, for the rest,
of the powers of two in L's binary form.  Pieces of one length form a bucket, and a
sequence is one piece: no sequence crosses documents and none needs padding.

Everything happens in one pass without a shuffle, so a lost executor costs the
repetition of its own splits.  Sequence numbers come from the partition and the row in
it (``monotonically_increasing_id``) and are unique, not dense.

Defined results: null or empty text is the end token alone (one piece of length 1);
repeated rows are packed each for itself; an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosa.llm.tables import quoted

#: Words whose ids a task remembers; when full, the memory is emptied.
REMEMBERED = 400_000
FIELDS = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _byte_letters() -> list[int]:
    """Code points that stand for the 256 bytes in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = list(range(256)), 256
    for b in range(256):
        if b not in plain:
            table[b], spare = spare, spare + 1
    return table


class WordTokenizer:
    """Ids of a text as little-endian 32-bit words, remembering the ids of each word.

    The vocabulary never joins text across a blank or a line feed, nor a letter with the
    comma or full stop behind it, so the ids of a text are those of such parts in order.
    Words of Latin letters skip the general normalising and splitting rules, which leave
    them whole: they are lower-cased and merged directly.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._bytes = dict(enumerate(_byte_letters()))
        self._ids: dict[str, bytes] = {}
        self._latin: dict[str, bytes] = {}

    def _whole(self, words: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def _letters(self, word: str) -> bytes:
        """Ids of a word of Latin letters."""
        low = word.lower()
        ids = self._latin.get(low)
        if ids is None:
            form = low if low.isascii() else low.encode().decode("latin-1").translate(self._bytes)
            ids = self._latin[low] = array("I", [t.id for t in self._model.tokenize(form)]).tobytes()
        return ids

    def _learn(self, new: set[str]) -> None:
        if not self._latin:
            self._latin.update(zip(",.", self._whole([",", "."])))
        rest = []
        for word in new:
            stem, tail = (word[:-1], word[-1]) if word[-1:] in (",", ".") and word[-1:] else (word, "")
            # Below U+0250 every letter is composed and has one lower-case letter, but for U+0130.
            if stem.isalpha() and (stem.isascii() or (max(stem) < "\u0250" and "\u0130" not in stem)):
                self._ids[word] = self._letters(stem) + (self._latin[tail] if tail else b"")
            else:
                rest.append(word)
        for at in range(0, len(rest), 20_000):
            some = rest[at : at + 20_000]
            self._ids.update(zip(some, self._whole(some)))

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        new = set().union(*parts).difference(self._ids) if parts else set()
        if len(self._ids) + len(new) > REMEMBERED:
            self._ids.clear()
            self._latin.clear()
            new = set().union(*parts)
        self._learn(new)
        ids = self._ids.__getitem__
        return [b"".join(map(ids, p)) for p in parts]


def piece_lengths(tokens: int, max_len: int) -> list[int]:
    """``max_len`` as often as it fits, then the binary digits of the rest, largest first."""
    whole, rest = divmod(tokens, max_len)
    return [max_len] * whole + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(
    docs: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id",
    max_len: int = 4096, end_id: int = 2, with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents; ``bucket`` is the sequence length, ``ids`` are given on request.

    ``max_len`` must be a power of two.
    """
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    end = np.asarray([end_id], "<u4").tobytes()

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.slice(at, 256)
                keys = some.column(0).to_pylist()
                rows: list[tuple] = []
                for k, ids in zip(keys, tokenizer.encode(some.column(1).fill_null("").to_pylist())):
                    ids += end
                    total, start = len(ids) // 4, 0
                    for n in piece_lengths(total, max_len):
                        piece = ids[4 * start : 4 * (start + n)]
                        rows.append((k, start, n, crc32(piece), total, piece))
                        start += n
                columns = list(zip(*rows))
                arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(p, "<i4") for p in columns[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    given = docs.select(quoted(key).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    out = given.mapInArrow(pieces, FIELDS + (", ids array<int>" if with_ids else ""))
    return out.select(
        *[F.col(c) for c in out.columns],
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        F.col("length").alias("bucket"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Store the sequences with one folder per length, so that a loader reads equal lengths together."""
    packed.write.partitionBy("bucket").parquet(path)
