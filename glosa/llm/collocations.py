"""Phrase collocations from FM-indexes over word ids, one per shard, summed across shards.

1. The documents of a split form shards, one per language at a time; a shard numbers its own words and
   is cut at piece borders.  Word counts are summed over all shards; only words that reach the threshold
   can stand in a candidate, and their corpus-wide ids go back to the shards.
2. Every shard indexes its text of such words (all others separate pieces) to depth two.  Extending the
   interval of every word to the left in the Burrows-Wheeler transform gives the shard's pairs with
   counts.  The shards are told which of their pairs reach the threshold in sum.
3. Every shard keeps the stretches in which all neighbouring words are such pairs and indexes them in both
   directions to depth five.  Intervals of pairs are extended to phrases of three, four and five words;
   the interval in the text tells whether all occurrences have one word on the left, the one in the reversed
   text whether they have one on the right.
4. Counts are summed.  A phrase lies inside a longer candidate of the same count if and only if an extension by one
   word has that count.  Only phrases that had a single extension on one side in every shard can have such a
   one; they are compared with the summed counts of their left and right extensions, and dropped.  Counts
   of the two parts of every cut are joined from the same table, and the score is computed in decimals of 38 digits.

What shards send to be summed (words, pairs, phrases) is shuffled by a hash of the word, pair or phrase, ``BUCKETS``
buckets per shuffle partition: a shard packs what belongs to one bucket into one compressed row, and equal ones of all
shards meet in their bucket.  The texts stay where they were written, bucketed by shard.  A frequent word, pair or phrase is one entry per shard, never one per occurrence.
The sorting depth is limited, so equal stretches of any length cost nothing extra.  The list per language is ranked in two
steps, over hashed slots first, so a language that holds most candidates passes a bounded number of rows to one task.

Defined results: null or empty text has no words; a null language counts as ``und``; repeated
rows count each; ties go to the greater count, then to the phrase in byte order; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from glosa.llm.buffers import mix, row_ranges, slices, squeeze, unsqueeze, utf8
from glosa.llm.tables import bucketed, quoted
from glosa.session import cut_lineage

LONGEST = 5
#: Words of the open shards of a task, and distinct words of one shard, before the largest is closed.
SHARD_TOKENS, SHARD_WORDS = 1 << 22, 1 << 19
BUCKETS, SLOTS = 4, 64
#: A byte that never occurs in UTF-8 stands for the end of a piece.
_END = b"\xff"
_FORM = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz " + _END * 10)
#: Rows of shards: packed entries of one bucket; texts have the bucket -1, the buckets of a shard's words -2.
SHARD_FIELDS = "shard bigint, lang string, bucket int, body binary, extra binary"
WORDS = [f"w{i + 1}" for i in range(LONGEST)]
_SHARD = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("bucket", pa.int32()), ("body", pa.binary()), ("extra", pa.binary())])
#: Merged words: rows for the shards have a shard, rows of the vocabulary an id, totals a language alone.
WORD_FIELDS = "shard bigint, bucket int, body binary, id bigint, lang string, word string, f bigint"
_WORD = pa.schema([("shard", pa.int64()), ("bucket", pa.int32()), ("body", pa.binary()), ("id", pa.int64()),
                   ("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])
#: Merged pairs: rows for the shards have a shard, frequent pairs have none.
PAIR_FIELDS = "shard bigint, bucket int, body binary, x bigint, y bigint, f bigint"
_PAIR = pa.schema([("shard", pa.int64()), ("bucket", pa.int32()), ("body", pa.binary()), ("x", pa.int64()), ("y", pa.int64()), ("f", pa.int64())])
PHRASE_FIELDS = ", ".join(f"{w} bigint" for w in WORDS) + ", f bigint, single boolean"
_PHRASE = pa.schema([*((w, pa.int64()) for w in WORDS), ("f", pa.int64()), ("single", pa.bool_())])


def _pack(*columns: np.ndarray) -> bytes:
    """64-bit columns as planes of bytes, most of which are nearly constant, compressed."""
    planes = np.stack([np.asarray(c, "<i8") for c in columns]).view(np.uint8).reshape(len(columns), -1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.transpose(0, 2, 1)).tobytes())


def _unpack(body: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8").reshape(columns, -1)


def _hash(*columns: np.ndarray) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64) + np.uint64(1))
    return h


def _by_bucket(buckets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by bucket, and (bucket, first, last) of every bucket present."""
    order = np.argsort(buckets, kind="stable")
    present, first = np.unique(buckets[order], return_index=True)
    return order, list(zip(present.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]))


def _same(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns x rows -> an order in which equal rows are neighbours, and where a new row starts."""
    h = _hash(*columns)
    order = np.argsort(h, kind="stable")
    h, by_hash = h[order], columns[:, order]
    new, other = np.ones(len(h), bool), np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    other[1:] = (by_hash[:, 1:] != by_hash[:, :-1]).any(axis=0)
    if not np.array_equal(new, other):  # different rows of one hash
        order = np.lexsort(columns)
        by_hash = columns[:, order]
        other[1:] = (by_hash[:, 1:] != by_hash[:, :-1]).any(axis=0)
    return order, other


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class _Shard:
    """Numbered words of one language; 0 ends a piece."""

    def __init__(self, lang: str) -> None:
        self.lang, self.numbers, self.parts, self.tokens = lang, {_END: 0}, [], 0

    def add(self, texts: list[bytes]) -> None:
        words = _END.join([*texts, b""]).translate(_FORM).replace(_END, b" " + _END + b" ").split()
        numbers = self.numbers
        for word in dict.fromkeys(words):
            if word not in numbers:
                numbers[word] = len(numbers)
        self.parts.append(_single_ends(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))))
        self.tokens += len(self.parts[-1])

    def rows(self, name: int, buckets: int) -> pa.RecordBatch:
        text = np.concatenate(self.parts)
        counts = np.bincount(text, minlength=len(self.numbers))[1:]
        words = list(self.numbers)[1:]
        of = np.fromiter(map(crc32, words), np.int64, len(words)) % buckets
        rows = [(name, self.lang, -2, squeeze(of), None)]
        # A text longer than a shard is cut at ends of pieces.
        first = 0
        while first < len(text):
            ends = np.flatnonzero(text[first + SHARD_TOKENS :] == 0)
            last = first + SHARD_TOKENS + int(ends[0]) + 1 if len(ends) else len(text)
            rows.append((name, self.lang, -1, squeeze(text[first:last]), None))
            first = last
        order, present = _by_bucket(of)
        for bucket, at, end in present:
            some = order[at:end]
            packed = zstandard.ZstdCompressor(level=3).compress(_END.join([words[i] for i in some.tolist()]))
            rows.append((name, self.lang, bucket, packed, _pack(counts[some])))
        return _table(rows, _SHARD).combine_chunks().to_batches()[0]


def _single_ends(text: np.ndarray) -> np.ndarray:
    """Without ends that follow an end or start the text."""
    keep = text != 0
    keep[1:] |= text[:-1] != 0
    return text[keep]


def _shards(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    name = TaskContext.get().partitionId() << 32
    open_: dict[str, _Shard] = {}

    def close(shard: _Shard) -> pa.RecordBatch:
        nonlocal name
        del open_[shard.lang]
        name += 1
        return shard.rows(name, buckets)

    for batch in slices(batches):
        data, offsets = utf8(batch.column(1))
        for i, j in row_ranges(offsets):
            by_lang: dict[str, list[bytes]] = {}
            langs = batch.column(0).slice(i, j - i).to_pylist()
            for lang, a, b in zip(langs, offsets[i:j].tolist(), offsets[i + 1 : j + 1].tolist()):
                by_lang.setdefault(lang, []).append(data[a:b].tobytes())
            for lang, texts in by_lang.items():
                shard = open_.setdefault(lang, _Shard(lang))
                shard.add(texts)
                if len(shard.numbers) > SHARD_WORDS:
                    yield close(shard)
            while sum(s.tokens for s in open_.values()) > SHARD_TOKENS:
                yield close(max(open_.values(), key=lambda s: s.tokens))
    for shard in list(open_.values()):
        yield close(shard)


class Index:
    """FM-index of a text over 0 .. letters - 1 that ends with 0, its suffixes sorted to ``depth`` symbols.

    An interval is the rows of the suffixes that start with a phrase of at most ``depth`` symbols.
    With ``both`` the reversed text is indexed too, and intervals are kept in step.
    """

    def __init__(self, text: np.ndarray, letters: int, depth: int, both: bool = True) -> None:
        self.text, self.letters, self.both = text, letters, both
        self.places = _sorted(text, letters, depth)
        self.bwt = text[self.places - 1]
        self.step = np.empty(len(text), np.int64)
        self.step[np.argsort(self.bwt, kind="stable")] = np.arange(len(text))
        self.heads = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=letters))))
        self._left_turns = _turns(self.bwt)
        if both:
            back = text[::-1]
            self.back = back[_sorted(back, letters, depth) - 1]
            self._right_turns = _turns(self.back)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals (low, count, low in the reversed text) of all single words."""
        low, high = self.heads[1:-1], self.heads[2:]
        found = high > low
        return low[found], (high - low)[found], low[found]

    def extend_left(self, low: np.ndarray, count: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of all phrases one word longer on the left, for any number of disjoint intervals at once."""
        owner = np.repeat(np.arange(len(low)), count)
        starts = np.cumsum(count) - count
        rows = np.arange(len(owner)) + np.repeat(low - starts, count)
        key = owner * self.letters + self.bwt[rows]
        key, first, number = np.unique(key, return_index=True, return_counts=True)
        owner, word = np.divmod(key, self.letters)
        # Smaller words of the same phrase come first in the reversed text.
        before = np.cumsum(number) - number
        base = np.zeros(len(low), np.int64)
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        base[owner[heads]] = before[heads]
        inside = word > 0
        back = back[owner] + before - base[owner]
        return self.step[rows[first]][inside], number[inside], back[inside]

    def phrase(self, low: np.ndarray, length: int) -> list[np.ndarray]:
        at = self.places[low]
        return [self.text[at + k] for k in range(length)]

    def extensions(self, low: np.ndarray, count: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The one word to the left, and to the right, of all occurrences; 0 if there are several or an end."""
        left = np.where(self._left_turns[low] == self._left_turns[low + count - 1], self.bwt[low], 0)
        right = np.where(self._right_turns[back] == self._right_turns[back + count - 1], self.back[back], 0)
        return left, right


def _turns(symbols: np.ndarray) -> np.ndarray:
    """Changes of symbol up to every place: equal numbers mean one symbol in between."""
    return np.cumsum(np.diff(symbols, prepend=symbols[:1]) != 0)


def _sorted(text: np.ndarray, letters: int, depth: int) -> np.ndarray:
    """Rotations in the order of their first ``depth`` symbols."""
    rank, names, width = text, letters, 1
    order = None
    while width < depth:
        step = min(width, depth - width)
        # The last window may overlap the first: their common symbols agree anyway.
        key = rank * names + np.roll(rank, -step)
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.cumsum(np.diff(key, prepend=key[:1]) != 0)
        rank = np.empty(len(text), np.int64)
        rank[order] = new
        names, width = int(new[-1]) + 1, width + step
    return order if order is not None else np.argsort(text, kind="stable")


def _ended(text: np.ndarray) -> np.ndarray:
    return text if len(text) and text[-1] == 0 else np.append(text, 0)


def _merge_words(rows: pa.Table, threshold: int) -> pa.Table:
    """The words of one bucket from all shards -> ids for the shards, frequent words, words per language."""
    totals: dict[str, dict[bytes, int]] = {}
    seen = []
    for lang, body, extra in zip(*(rows.column(c).to_pylist() for c in ("lang", "body", "extra"))):
        words = zstandard.ZstdDecompressor().decompress(body).split(_END)
        count = totals.setdefault(lang, {})
        for word, n in zip(words, _unpack(extra, 1)[0].tolist()):
            count[word] = count.get(word, 0) + n
        seen.append((lang, words))
    bucket = rows.column("bucket")[0].as_py() if rows.num_rows else 0
    places: dict[str, dict[bytes, int]] = {}
    done, number = [], 0
    for lang in sorted(totals):
        done.append((None, None, None, None, lang, None, sum(totals[lang].values())))
        place = places[lang] = {}
        # Common words first: small numbers pack well.
        for word in sorted((w for w, n in totals[lang].items() if n >= threshold), key=lambda w: (-totals[lang][w], w)):
            number += 1
            place[word] = number
            done.append((None, None, None, (bucket << 32) + number, lang, word.decode(), totals[lang][word]))
    for shard, (lang, words) in zip(rows.column("shard").to_pylist(), seen):
        place = places[lang]
        done.append((shard, bucket, squeeze(np.fromiter((place.get(w, 0) for w in words), np.int64, len(words))), None, None, None, None))
    return _table(done, _WORD)


def _known_texts(known: pa.Table, texts: pa.Table) -> pa.Table:
    """The ids of its words and the texts of one shard -> its texts over the known words, and their ids."""
    known = known.sort_by("bucket")
    ids = [np.where(k > 0, (b << 32) + k, 0) for b, k in (
        (b, unsqueeze(k)) for b, k in zip(known.column("bucket").to_pylist(), known.column("body").to_pylist()))]
    kinds = texts.column("bucket").to_numpy()
    bodies = texts.column("body")
    ids = np.concatenate([*ids, np.zeros(0, np.int64)])
    number = np.zeros(len(ids) + 1, np.int64)
    for row in np.flatnonzero(kinds == -2).tolist():
        # Inside a bucket, words stand in the order of their numbers.
        number[1 + np.argsort(unsqueeze(bodies[row].as_py()), kind="stable")] = ids
    ids = np.unique(ids[ids > 0])
    dense = np.where(number > 0, np.searchsorted(ids, number) + 1, 0)
    rows = []
    for row in np.flatnonzero(kinds == -1).tolist():
        text = _ended(_single_ends(dense[unsqueeze(bodies[row].as_py())]))
        rows.append((texts.column("of")[0].as_py(), None, -1, squeeze(text), _pack(ids)))
    return _table(rows, _SHARD)


def _pairs(texts: pa.Table, buckets: int) -> pa.Table:
    """The texts of one shard -> its pairs with counts, by bucket."""
    found = []
    for body, known in zip(texts.column("body").to_pylist(), texts.column("extra").to_pylist()):
        text, ids = unsqueeze(body), _unpack(known, 1)[0]
        if len(text) > 1:
            index = Index(text, len(ids) + 1, 2, both=False)
            low, count, _ = index.extend_left(*index.words())
            found.append(np.stack([*(ids[w - 1] for w in index.phrase(low, 2)), count]))
    name = texts.column("shard")[0].as_py()
    return _table([(name, None, bucket, _pack_sorted(part), None) for bucket, part in _by_hash(found, 2, buckets)], _SHARD)


def _by_hash(found: list[np.ndarray], width: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of all texts of a shard by the bucket of their first ``width`` ids, sorted by all ids (all columns).

    A shard has more than one text only if it was cut; what both hold is sent twice and summed there.
    """
    if not found:
        return
    rows = np.concatenate(found, axis=1)
    rows = rows[:, np.lexsort(rows[::-1])]
    order, present = _by_bucket((_hash(*rows[:width]) % np.uint64(buckets)).astype(np.int64))
    for bucket, at, end in present:
        yield bucket, rows[:, order[at:end]]


def _pack_sorted(rows: np.ndarray) -> bytes:
    """Rows sorted by their first column, which is kept as differences."""
    return _pack(np.diff(rows[0], prepend=0), *rows[1:])


def _unpack_sorted(body: bytes, columns: int) -> np.ndarray:
    rows = _unpack(body, columns)
    return np.concatenate([np.cumsum(rows[:1], axis=1), rows[1:]])


def _merge_pairs(rows: pa.Table, threshold: int) -> pa.Table:
    """The pairs of one bucket from all shards -> the frequent ones among each shard's pairs."""
    parts = [_unpack_sorted(b, 3) for b in rows.column("body").to_pylist()]
    every = np.concatenate(parts, axis=1)
    order, new = _same(every[:2])
    total = np.add.reduceat(every[2][order], np.flatnonzero(new))
    frequent = np.empty(len(order), bool)
    frequent[order] = (total >= threshold)[np.cumsum(new) - 1]
    heads = order[new][total >= threshold]
    done, at = [(None, None, None, x, y, f) for x, y, f in zip(*every[:2, heads].tolist(), total[total >= threshold].tolist())], 0
    for shard, bucket, part in zip(rows.column("shard").to_pylist(), rows.column("bucket").to_pylist(), parts):
        mine = frequent[at : at + part.shape[1]]
        at += part.shape[1]
        if mine.any():
            done.append((shard, bucket, _pack_sorted(part[:2, mine]), None, None, None))
    return _table(done, _PAIR)


def _phrases(frequent: pa.Table, texts: pa.Table, buckets: int) -> pa.Table:
    """The frequent pairs and the texts of one shard -> its phrases of three to five words, by bucket."""
    pairs = [_unpack_sorted(b, 2) for b in frequent.column("body").to_pylist()]
    pairs = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    rows, found = [], []
    for body, known in zip(texts.column("body").to_pylist(), texts.column("extra").to_pylist()) if pairs.shape[1] else ():
        ids = _unpack(known, 1)[0]
        letters = len(ids) + 1
        x, y = np.searchsorted(ids, pairs) + 1
        wanted = np.unique(x * letters + y)
        text = unsqueeze(body)
        key = text[:-1] * letters + text[1:]
        joined = np.zeros(len(text), bool)
        if len(key):
            joined[:-1] = wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key
        kept = joined.copy()
        kept[1:] |= joined[:-1]
        text = _ended(_stretches(text, kept, joined))
        index = Index(text, letters, LONGEST)
        intervals = index.extend_left(*index.words())
        for length in range(3, LONGEST + 1):
            intervals = index.extend_left(*intervals)
            low, count, _ = intervals
            columns = [ids[w - 1] for w in index.phrase(low, length)] + [np.full(len(low), -1)] * (LONGEST - length)
            left, right = index.extensions(*intervals)
            found.append(np.stack([*columns, count, (left > 0) + 2 * (right > 0)]))
    name = texts.column("of")[0].as_py()
    return _table([(name, None, bucket, *_pack_tree(part)) for bucket, part in _by_hash(found, 3, buckets)], _SHARD)


def _pack_tree(rows: np.ndarray) -> tuple[bytes, bytes]:
    """Phrases of three and more words as a tree: behind a phrase come those that go on from it, with their last word alone."""
    order = (rows[:LONGEST] >= 0).sum(axis=0)
    return (_pack(order, rows[order - 1, np.arange(len(order))], rows[LONGEST], rows[LONGEST + 1]),
            _pack_sorted(rows[:2, order == 3]))


def _unpack_tree(body: bytes, heads: bytes) -> np.ndarray:
    """Words, count and sides of every phrase."""
    order, last, n, sides = _unpack(body, 4)
    place = np.arange(len(order))
    words = np.full((LONGEST, len(order)), -1, np.int64)
    words[:2, order == 3] = _unpack_sorted(heads, 2)
    words[order - 1, place] = last
    for length in range(4, LONGEST + 1):
        mine = np.flatnonzero(order == length)
        parent = np.maximum.accumulate(np.where(order == length - 1, place, 0))[mine]
        words[: length - 1, mine] = words[: length - 1, parent]
    return np.concatenate([words, n[None], sides[None]])


def _merge_phrases(rows: pa.Table, threshold: int) -> pa.Table:
    """The phrases of one bucket from all shards -> the frequent ones, and whether all shards saw a single extension on one side."""
    every = np.concatenate([_unpack_tree(b, h) for b, h in zip(rows.column("body").to_pylist(), rows.column("extra").to_pylist())], axis=1)
    order, new = _same(every[:LONGEST])
    every, heads = every[:, order], np.flatnonzero(new)
    f = np.add.reduceat(every[LONGEST], heads)
    single = np.bitwise_and.reduceat(every[LONGEST + 1], heads) > 0
    kept = f >= threshold
    return pa.Table.from_arrays([*(pa.array(w[heads][kept]) for w in every[:LONGEST]), pa.array(f[kept]), pa.array(single[kept])], schema=_PHRASE)


def _stretches(text: np.ndarray, kept: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """The kept symbols, with an end behind each that is not joined to the next one."""
    at = np.flatnonzero(kept)
    size = 1 + ~joined[at]
    out = np.zeros(int(size.sum()), np.int64)
    out[np.cumsum(size) - size] = text[at]
    return out


def phrase_counts(docs: DataFrame, threshold: int, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals): frequent words (id, lang, word, f); phrases of two to five ids with their
    count ``f`` and ``inside`` (they lie in a longer phrase of the same count); all words per language, ``n``."""
    given = docs.select(F.coalesce(quoted(lang).cast("string"), F.lit("und")).alias("lang"), quoted(text).alias("text"))
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries, kept = F.col("bucket") >= 0, [F.col("shard").alias("of"), "lang", "bucket", "body", "extra"]

    shards = bucketed(given.mapInArrow(lambda batches: _shards(batches, buckets), SHARD_FIELDS), "shard")
    words = cut_lineage(shards.where(entries).groupBy("bucket").applyInArrow(lambda rows: _merge_words(rows, threshold), WORD_FIELDS))
    back = words.where("shard IS NOT NULL").select("shard", "bucket", "body")
    texts = bucketed(back.groupBy("shard").cogroup(shards.where(~entries).select(*kept).groupBy("of")).applyInArrow(
        _known_texts, SHARD_FIELDS), "shard")
    pairs = texts.groupBy("shard").applyInArrow(lambda some: _pairs(some, buckets), SHARD_FIELDS)
    merged = cut_lineage(pairs.groupBy("bucket").applyInArrow(lambda rows: _merge_pairs(rows, threshold), PAIR_FIELDS))
    frequent = merged.where("shard IS NOT NULL").select("shard", "bucket", "body")
    phrases = frequent.groupBy("shard").cogroup(texts.select(*kept).groupBy("of")).applyInArrow(
        lambda some, of: _phrases(some, of, buckets), SHARD_FIELDS)
    longer = phrases.groupBy("bucket").applyInArrow(lambda rows: _merge_phrases(rows, threshold), PHRASE_FIELDS)
    two = merged.where("shard IS NULL").select(
        F.col("x").alias("w1"), F.col("y").alias("w2"), *[F.lit(-1).cast("bigint").alias(w) for w in WORDS[2:]], "f", F.lit(True).alias("single"))
    summed = cut_lineage(longer.unionByName(two))
    totals = words.where("shard IS NULL AND id IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    return words.where("id IS NOT NULL").select("id", "lang", "word", "f"), marked_inside(summed), totals


def marked_inside(phrases: DataFrame) -> DataFrame:
    """``inside`` for ``single``: the phrase has an extension by one word of the same count."""
    w = F.filter(F.array(*WORDS), lambda i: i >= 0)
    parts = phrases.select("f", w.alias("w")).where(F.size("w") > 2).select("f", F.explode(F.array(
        F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"))).alias("part"))
    most = parts.groupBy(*[F.coalesce(F.get("part", F.lit(i)), F.lit(-1)).alias(f"_{n}") for i, n in enumerate(WORDS)]).agg(F.max("f").alias("_f"))
    same = [F.col(n) == F.col(f"_{n}") for n in WORDS]
    both = phrases.join(most, reduce(and_, [*same, F.col("single"), F.col("f") == F.col("_f")]), "left")
    return both.select(*WORDS, "f", F.col("_f").isNotNull().alias("inside"))


def _parts() -> Column:
    """(kind, k, ids) of a phrase ``w`` of ``m`` words: first k words, the rest behind them, and the inner words."""
    return F.expr(
        "concat(transform(sequence(1, m - 1), k -> struct('l' AS kind, k AS k, slice(w, 1, k) AS part)),"
        " transform(sequence(1, m - 1), k -> struct('r' AS kind, k AS k, slice(w, k + 1, m - k) AS part)),"
        " transform(filter(sequence(1, m), k -> k > 1 AND k < m), k -> struct('w' AS kind, k AS k, slice(w, k, 1) AS part)))")


def scored(known: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Per phrase that is not inside another: lang, phrase, a, l, r, n, score of its weakest cut."""
    nothing = [F.lit(-1).cast("bigint").alias(w) for w in WORDS[1:]]
    counts = phrases.select(*WORDS, "f", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("word")).unionByName(
        known.select(F.col("id").alias(WORDS[0]), *nothing, "f", "lang", "word"))
    part_of = [f"p{w}" for w in WORDS]
    whole = phrases.where("NOT inside").withColumn("w", F.filter(F.array(*WORDS), lambda i: i >= 0)).withColumn("m", F.size("w"))
    parts = whole.select(*WORDS, F.col("f").alias("a"), "m", F.inline(_parts()))
    parts = parts.select(*WORDS, "a", "m", "kind", "k", *[F.coalesce(F.get("part", F.lit(i)), F.lit(-1)).alias(p) for i, p in enumerate(part_of)])
    # Ends of the phrase are parts of one word themselves.
    looked_up = parts.join(counts.toDF(*part_of, "f", "lang", "word"), part_of)
    cuts = range(1, LONGEST)
    columns = [F.max(F.expr(f"CASE WHEN kind = '{s}' AND k = {k} THEN f END")).alias(f"{s}{k}") for s in "lr" for k in cuts]
    place = "CASE kind WHEN 'l' THEN 1 WHEN 'r' THEN m ELSE k END"
    columns += [F.max(F.expr(f"CASE WHEN word IS NOT NULL AND {place} = {i} THEN word END")).alias(f"t{i}") for i in range(1, LONGEST + 1)]
    found = looked_up.groupBy(*WORDS, "a").agg(F.max("lang").alias("lang"), *columns)
    found = found.withColumn("phrase", F.concat_ws(" ", *[f"t{i}" for i in range(1, LONGEST + 1)])).join(totals, "lang")
    wide = "CAST({} AS DECIMAL(38, 0))".format
    cut = [F.when(F.col(f"l{k}").isNotNull(), F.struct(
        F.expr(f"{wide('1000')} * a * n div ({wide(f'l{k}')} * r{k})").alias("score"), F.lit(k).alias("k"),
        F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in cuts]
    return found.withColumn("cut", F.least(*cut)).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def best(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of every language with their rank, chosen in hashed slots first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slots = Win.partitionBy("lang", "slot").orderBy(*order)
    some = phrases.withColumn("slot", F.pmod(F.xxhash64("phrase"), F.lit(SLOTS)))
    some = some.withColumn("rank", F.row_number().over(slots)).where(F.col("rank") <= top).drop("slot")
    return some.withColumn("rank", F.row_number().over(Win.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, threshold: int = 100, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the strongest phrases of every language."""
    return best(scored(*phrase_counts(docs, threshold, text, lang)), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
