"""Periodic runs of words by maximal-pair enumeration over an LCP-interval tree.

A run is a stretch of consecutive words whose smallest period is q (words q apart are
identical), of at least ``min_words`` words and ``min_exponent`` periods, that no
neighbouring word extends.  A run of length L and period q is the maximal pair
(start, start + q) with L - q common words: the words left of both places differ, and so
do the words behind the common part.  So runs are exactly the maximal pairs whose distance
satisfies the length limits, and nothing is ever extended word by word:

1. The suffixes of a buffer of documents are sorted by prefix doubling in NumPy; a document has its own
   word numbers, so suffixes of different documents share nothing.  A pair needs at least ``FLOOR`` common
   words, so only suffixes that share so many with another one of their document go on.
2. LCP values of neighbours come from the ranks of the doubling levels.
3. The LCP-interval tree is walked bottom-up.  Every interval has its places in order, and the class of a
   place is the word on its left.  When the lists of two children meet, places of different children that
   become neighbours are the pairs at the interval's LCP value; those of different class whose distance is
   at most a third of the common words (for four periods) are kept.  Farther places of a list need no look:
   places closer than half of the common words are evenly spaced, so the nearest one has the smallest period.

Short lists are put into long ones, so a document of n words costs about n log n steps.  Nothing
is shuffled and nothing crosses documents; a lost executor costs its own splits again.

Defined results: null or white-space text has no words, no runs, and the empty string as
collapsed text; repeated rows are answered each for itself; an empty table gives no rows;
a null id stays null; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosa.llm.buffers import LIMIT
from glosa.llm.tables import quoted

SPACES = "[\\x20\\x09-\\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
FIELDS = f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string"
#: Suffixes are compared from this depth on; the limits below must imply more common words.
FLOOR = 4

Run = tuple[int, int, int]


def sort_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of suffixes that share ``FLOOR`` symbols with another one, in order, with LCP and groups.

    Returns (places, lcp with the place before, True where a group starts).  Groups are the
    classes of equal first ``FLOOR`` symbols.  The last symbol must occur once.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    small = np.int32 if n < 1 << 31 else np.int64
    ranks = [_ranked(symbols[order], order, np.zeros(n, small), np.zeros(n, small))]
    live, places, width = _shared(order, ranks[0]), None, 1
    while len(live):
        rank = ranks[-1]
        old = rank[live].astype(np.int64)
        key = old * n + rank[live + width]
        by = np.argsort(key, kind="stable")
        live, old, key = live[by], old[by], key[by]
        ranks.append(_ranked(key, live, old, rank))
        live = _shared(live, ranks[-1])
        width *= 2
        if width == FLOOR:
            places = live
    if places is None or not len(places):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, bool)
    places = places[np.argsort(ranks[-1][places], kind="stable")]
    group = ranks[FLOOR.bit_length() - 1][places]
    lcp = np.zeros(len(places), np.int64)
    left, right = places[:-1], places[1:]
    common = np.zeros(len(left), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        same = ranks[level][left + common] == ranks[level][right + common]
        common += same.astype(np.int64) << level
    lcp[1:] = common
    first = np.ones(len(places), bool)
    first[1:] = group[1:] != group[:-1]
    return places, lcp, first


def _ranked(key: np.ndarray, at: np.ndarray, old: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Ranks after sorting ``at`` by ``key``: the old group's rank plus the offset inside the group."""
    number = np.arange(len(at))
    new = np.ones(len(at), bool)
    new[1:] = key[1:] != key[:-1]
    group = np.ones(len(at), bool)
    group[1:] = old[1:] != old[:-1]
    start = np.maximum.accumulate(np.where(new, number, 0))
    base = np.maximum.accumulate(np.where(group, number, 0))
    out = rank.copy()
    out[at] = old + start - base
    return out


def _shared(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The members of groups of at least two."""
    mine = rank[at]
    same = mine[1:] == mine[:-1]
    many = np.zeros(len(at), bool)
    many[1:] |= same
    many[:-1] |= same
    return at[many]


class Pairs:
    """Bottom-up walk over LCP intervals; ``found`` maps (start, length) to the smallest period."""

    def __init__(self, left: list[int], min_words: int, min_exponent: int) -> None:
        self.left, self.min_words, self.times = left, min_words, min_exponent - 1
        self.found: dict[tuple[int, int], int] = {}

    def _try(self, i: int, j: int, common: int) -> None:
        d = j - i
        if d * self.times <= common and common + d >= self.min_words and self.left[i] != self.left[j]:
            key = (i, common + d)
            if d < self.found.get(key, d + 1):
                self.found[key] = d

    def meet(self, one: list[int], two: list[int], common: int) -> list[int]:
        """Both children's places in order; pairs that become neighbours are tried."""
        if len(one) < len(two):
            one, two = two, one
        if len(two) > 64 and len(two) * 16 > len(one):
            mine = set(two)
            both = sorted(one + two)
            reach = common // self.times
            for i, j in zip(both, both[1:]):
                if j - i <= reach and (i in mine) != (j in mine):
                    self._try(i, j, common)
            return both
        previous = -1
        spots = []
        for x in two:
            spot = bisect_left(one, x)
            spots.append(spot)
            if spot and one[spot - 1] > previous:
                self._try(one[spot - 1], x, common)
            previous = x
        for k, x in enumerate(two):
            spot = spots[k]
            if spot < len(one) and (k + 1 == len(two) or two[k + 1] > one[spot]):
                self._try(x, one[spot], common)
        for x, spot in zip(reversed(two), reversed(spots)):
            one.insert(spot, x)
        return one

    def walk(self, places: list[int], lcp: list[int], first: list[bool]) -> None:
        """All groups of equal first ``FLOOR`` words, each a tree of its own."""
        stack: list[tuple[int, list[int]]] = []
        done: list[int] = []
        for place, common, new in zip(places, lcp, first):
            if new:
                while stack:
                    depth, open_ = stack.pop()
                    done = self.meet(open_, done, depth)
            else:
                while stack and stack[-1][0] > common:
                    depth, open_ = stack.pop()
                    done = self.meet(open_, done, depth)
                if stack and stack[-1][0] == common:
                    stack[-1] = (common, self.meet(stack[-1][1], done, common))
                else:
                    stack.append((common, done))
            done = [place]
        while stack:
            depth, open_ = stack.pop()
            done = self.meet(open_, done, depth)


def runs_of(documents: list[list[bytes]], min_words: int = 6, min_exponent: int = 4) -> list[list[Run]]:
    """Runs (start, length, period) of every document's words, by start, then period."""
    parts, base, starts = [], 0, []
    for words in documents:
        numbers = dict(zip(dict.fromkeys(words), range(base + 1, base + 1 + len(words))))
        starts.append(sum(map(len, parts[-1:])) + (starts[-1] if starts else 0))
        # A separator of its own, then the words: it is the left word of the first one.
        parts.append(np.fromiter([base, *map(numbers.__getitem__, words)], np.int64, len(words) + 1))
        base += len(numbers) + 1
    out: list[list[Run]] = [[] for _ in documents]
    if not parts:
        return out
    symbols = np.concatenate([*parts, np.array([base], np.int64)])
    places, lcp, first = sort_suffixes(symbols)
    if not len(places):
        return out
    pairs = Pairs(symbols[np.arange(-1, len(symbols) - 1)].tolist(), min_words, min_exponent)
    pairs.walk(places.tolist(), lcp.tolist(), first.tolist())
    bounds = np.asarray(starts)
    for (start, length), period in pairs.found.items():
        doc = int(np.searchsorted(bounds, start, side="right")) - 1
        out[doc].append((start - starts[doc] - 1, length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run contains behind its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def _batches(batches: Iterable[pa.RecordBatch], min_words: int, min_exponent: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        for at, texts in _pieces(batch.column(1)):
            documents = [t.split() for t in texts]
            runs = runs_of(documents, min_words, min_exponent)
            flat = np.asarray([r for found in runs for r in found], np.int64).reshape(-1, 3)
            ends = np.concatenate(([0], np.cumsum([len(found) for found in runs]))).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(kind.value_type))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(texts)), pa.array([len(d) for d in documents], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), spans, type=kind),
                 pa.array([b" ".join(collapsed(d, r)) for d, r in zip(documents, runs)], pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Rows in ranges of about ``LIMIT`` bytes (whole texts): first row, texts as bytes."""
    first, some, size = 0, [], 0
    for row, text in enumerate(texts.cast(pa.binary())):
        value = text.as_py() or b""
        some.append(value)
        size += len(value)
        if size >= LIMIT:
            yield first, some
            first, some, size = row + 1, [], 0
    if some:
        yield first, some


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = 6, min_exponent: int = 4) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text.

    A word is left out of the collapsed text if a run contains it behind its first period; the
    others are joined by one blank.  ``min_exponent`` is the least number of periods; the
    limits must imply more than ``FLOOR`` common words.
    """
    if min_exponent < 3 or min_words - min_words // min_exponent <= FLOOR:
        raise ValueError("needs min_exponent >= 3 and limits that imply more than four common words")
    given = docs.select(quoted(key).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    return given.mapInArrow(lambda batches: _batches(batches, min_words, min_exponent), FIELDS)


def with_echoes(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text) with echoes in a tenth of the documents, chosen by the checksum of the id.

    There every word from place a on becomes one of the p words from a on, over and over.
    Other texts, and texts without words, stay as they are.
    """
    id_ = quoted(key).cast("bigint")
    rows = docs.select(id_.alias("doc_id"), quoted(text).alias("text"), F.crc32(id_.cast("string").cast("binary")).alias("_h"))
    rows = rows.withColumn("_g", F.expr("_h div 10"))
    words = F.filter(F.split(F.when(F.expr("_h % 10 = 0"), F.col("text")), SPACES, -1), lambda w: w != "")
    rows = rows.withColumn("_w", words)
    rows = rows.withColumn("_n", F.size("_w").cast("bigint")).withColumn("_a", F.when(F.expr("_n > 0"), F.expr("_g % _n")))
    rows = rows.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    echo = F.expr(
        "array_join(concat(slice(_w, 1, int(_a)), slice(flatten(array_repeat(slice(_w, int(_a + 1), int(_p)), "
        "int((_n - _a) div _p + 1))), 1, int(_n - _a))), ' ')")
    return rows.select("doc_id", F.when(F.col("_a").isNotNull(), echo).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """The run of greatest exact length over period; the first one of equals; null without runs."""
    return F.aggregate(
        runs, F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
