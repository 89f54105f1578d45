"""Benchmark decontamination by q-gram filtering and banded alignment.

An item of m characters that occurs in a text with at most k = floor(rate * m) edits
shares at least m - q + 1 - k * q of its q-grams with it, and all of them lie on diagonals
(place in the text minus place in the item) within a band of k.  Shared q-grams are
counted per text in overlapping bands of twice that width; bands that reach the bound are kept, neighbouring
ones as one region, and all regions of a buffer are verified by banded alignments side by side, so no
occurrence within the budget is missed.  q is the largest value up to ``Q`` for which the bound is at
least one (m / (k + 1)).

An occurrence starts and ends at word edges: letters and digits between the aligned place and the edges of its
first and last word count as edits, so a short item is not found inside longer words.

Texts and items are compared after case folding, with every run of characters that are neither letters nor
digits as one blank.  The benchmark is a stated query set: it is read in blocks of about ``BLOCK`` characters, and
every block is held against all whole texts, so memory does not grow with it.

Defined results: null or empty texts and items without a letter or digit have no hits;
repeated documents or items each have their own hits; of overlapping hits of one item
that with the fewest edits, then the first, is given; an empty table gives no rows; other
columns are ignored by ``find_leaks`` and passed on by ``without_leaks``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosa.llm.buffers import column, mix, row_ranges, utf8
from glosa.llm.tables import fresh, named_rows, quoted
from glosa.session import cut_lineage

Q = 8
RATE = 0.1
BLOCK = 2_000_000
BITS = 20
BLANK, EDGE = 32, 1
FIELDS = "u bigint, v int, item_id bigint, start bigint, end bigint, edits int, item_chars int"


@cache
def letters() -> np.ndarray:
    """Code point -> lower-cased letter or digit, or blank; made once a worker."""
    table = np.full(0x110000, BLANK, np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalnum():
            table[cp] = ord(ch.lower()[0])
    return table


def normalise(table: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised characters of all texts between edge symbols, their places in the joined texts, and each text's bounds."""
    joined = "\x01" + "\x01".join(texts) + "\x01"
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = table[raw]
    ends = np.cumsum([0] + [len(t) + 1 for t in texts])
    points[ends] = EDGE
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != BLANK) | ((points[:-1] != BLANK) & (points[:-1] != EDGE))
    keep[:-1] &= (points[:-1] != BLANK) | (points[1:] != EDGE)
    place = np.flatnonzero(keep)
    return points[place].astype(np.int64), place, np.searchsorted(place, ends)


def budget(m: int, rate: float) -> int:
    return int(rate * m + 1e-9)


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, by doubling."""
    if len(c) < q:
        return np.zeros(0, np.uint64)
    base = 0x9E3779B97F4A7C15
    parts, have, powers = {1: c.astype(np.uint64) + np.uint64(7)}, 1, {1: base}
    while 2 * have <= q:
        h = parts[have]
        parts[2 * have] = h[: len(h) - have] * np.uint64(powers[have]) + h[have:]
        powers[2 * have] = powers[have] ** 2 % (1 << 64)
        have *= 2
    out, size = parts[have], have
    while size < q:
        step = 1 << ((q - size).bit_length() - 1)
        h = parts[step]
        out = out[: len(c) - size - step + 1] * np.uint64(powers[step]) + h[size : size + len(c) - size - step + 1]
        size += step
    return mix(out)


class Index:
    """q-grams of a block of items, one table per q."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        table = letters()
        self.ids, self.items, self.k = [], [], []
        by_q: dict[int, list[int]] = {}
        for key, text in items:
            c, _, _ = normalise(table, [text or ""])
            c = c[c != EDGE]
            if not len(c):
                continue
            k = budget(len(c), rate)
            by_q.setdefault(max(1, min(Q, len(c) // (k + 1))), []).append(len(self.items))
            self.ids.append(key)
            self.items.append(c)
            self.k.append(k)
        self.k = np.asarray(self.k, np.int64)
        self.m = np.asarray([len(c) for c in self.items], np.int64)
        self.tables = []
        for q, members in by_q.items():
            hashes = [grams(self.items[i], q) for i in members]
            h = np.concatenate(hashes)
            item = np.repeat(members, [len(x) for x in hashes])
            pos = np.concatenate([np.arange(len(x)) for x in hashes])
            order = np.argsort(h, kind="stable")
            h, item, pos = h[order], item[order], pos[order]
            seen = np.zeros(1 << BITS, bool)
            seen[(h >> np.uint64(64 - BITS)).astype(np.int64)] = True
            self.tables.append((q, seen, h, item, pos))

    def regions(self, c: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """(text, item, first diagonal, diagonals) rows of the places where bands reach their bound.

        Neighbouring bands of a text and an item are one region, of at most half an item's length.
        """
        for q, seen, h, item, pos in self.tables:
            g = grams(c, q)
            if not len(g):
                continue
            at = np.flatnonzero(seen[(g >> np.uint64(64 - BITS)).astype(np.int64)])
            low = np.searchsorted(h, g[at], side="left")
            n = np.searchsorted(h, g[at], side="right") - low
            at, low, n = at[n > 0], low[n > 0], n[n > 0]
            if not len(at):
                continue
            row = np.repeat(np.arange(len(at)), n)
            entry = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            it = item[entry]
            width = np.maximum(self.k, 1)[it]
            band = (at[row] - pos[entry] + self.m[it]) // width
            bound = np.maximum(self.m - q + 1 - self.k * q, 1)
            # Coarse counts in hashed cells only overstate, so they may sieve first.
            own = (mix((it << 40 | band).astype(np.uint64)) >> np.uint64(44)).astype(np.int64)
            prior = (mix((it << 40 | (band - 1)).astype(np.uint64)) >> np.uint64(44)).astype(np.int64)
            after = (mix((it << 40 | (band + 1)).astype(np.uint64)) >> np.uint64(44)).astype(np.int64)
            count = np.bincount(own, minlength=1 << 20)
            ok = count[own] + np.maximum(count[prior], count[after]) >= bound[it]
            if not ok.any():
                continue
            it, band, text = it[ok], band[ok], np.searchsorted(bounds, at[row][ok], side="right") - 1
            pair, which = np.unique(np.stack((text, it)), axis=1, return_inverse=True)
            key = which.ravel() << 40
            cells, hits = np.unique(np.concatenate((key | band, key | np.maximum(band - 1, 0))), return_counts=True)
            which, band = cells >> 40, cells & ((1 << 40) - 1)
            full = hits >= bound[pair[1, which]]
            which, band = which[full], band[full]
            if not len(which):
                continue
            k, m = self.k[pair[1, which]], self.m[pair[1, which]]
            most = np.maximum(m // 2 // np.maximum(k, 1), 1)
            new = np.ones(len(which), bool)
            new[1:] = (which[1:] != which[:-1]) | (band[1:] > band[:-1] + 1)
            # Long chains are cut again, so that a region holds no two occurrences side by side.
            head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            new |= (band - band[head]) % most == 0
            heads = np.flatnonzero(new)
            last = band[np.concatenate((heads[1:], [len(band)])) - 1]
            wide = np.maximum(k, 1)[heads]
            yield np.stack((pair[0, which[heads]], pair[1, which[heads]], band[heads] * wide - m[heads], (last - band[heads] + 2) * wide))


def align_all(
    items: list[np.ndarray], c: np.ndarray, edges: tuple[np.ndarray, np.ndarray], first: np.ndarray, width: np.ndarray,
    low: np.ndarray, high: np.ndarray, most: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """``align`` for many items at once: item j inside c[low[j]:high[j]] on its ``width[j]`` diagonals from ``first[j]`` on.

    Returns least edits (more than ``most`` if none fit) and ends in c.  Occurrences start and end at word edges:
    ``edges`` are the ``edge_distances``, which both ends cost.  Lanes that end or exceed their limit leave.
    """
    back, ahead = edges
    big = 1 << 30
    size = np.asarray([len(i) for i in items])
    edits, end = np.full(len(items), big), np.zeros(len(items), np.int64)
    lane = np.argsort(-size, kind="stable")
    wide = int(width.max())
    chars = np.full((len(items), int(size.max())), -1, np.int64)
    for j, item in enumerate(items):
        chars[j, : len(item)] = item
    step = np.arange(wide)
    place = first[lane, None] + step
    free = (step < width[lane, None]) & (place >= low[lane, None]) & (place <= high[lane, None])
    row = np.where(free, back[np.clip(place, 0, len(c) - 1)], big)
    lo, hi, limit, of = low[lane, None], high[lane, None], most[lane], size[lane]
    outside = step >= width[lane, None]
    for i in range(int(size.max())):
        same = c[np.clip(place, 0, len(c) - 1)] == chars[lane, i][:, None]
        new = np.where((place >= lo) & (place < hi), row + ~same, big)
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)  # item character left out
        place = place + 1
        stop = outside | (place < lo) | (place > hi)
        new[stop] = big
        new = np.minimum.accumulate(new - step, axis=1) + step  # text character left over
        new[stop] = big
        row, least = new, new.min(axis=1)
        done = of == i + 1
        if done.any():
            last = row[done] + ahead[np.clip(place[done], 0, len(c) - 1)]
            at = last.argmin(axis=1)
            edits[lane[done]] = last[np.arange(len(at)), at]
            stops = place[done, at]
            end[lane[done]] = stops + ahead[np.clip(stops, 0, len(c) - 1)]
        stay = ~done & (least <= limit)
        if not stay.all():
            lane, place, row, lo, hi, limit, of, outside = (x[stay] for x in (lane, place, row, lo, hi, limit, of, outside))
            if not len(lane):
                break
    return edits, end


def align(item: np.ndarray, text: np.ndarray, first: int, width: int, most: int, tail: np.ndarray | None = None) -> tuple[int, int]:
    """Least edits of the whole item inside ``text`` on diagonals [first, first + width), and where that ends.

    Free start and end in the text; only the band is computed.  With ``tail``, the occurrence starts at 0, and an
    end at place p costs ``tail[p]`` more edits.
    """
    n, big = len(text), 1 << 30
    diagonals = np.arange(first, first + width)
    inside = (diagonals >= 0) & (diagonals <= n) if tail is None else diagonals == 0
    row = np.where(inside, 0, big)
    step = np.arange(width)
    padded = np.concatenate((text, [-1]))
    for i, ch in enumerate(item.tolist()):
        place = diagonals + i  # text character used by the diagonal move
        fits = (place >= 0) & (place < n)
        same = padded[np.where(fits, place, n)] == ch
        new = np.where(fits, row + ~same, big)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)  # item character left out
        ends = place + 1
        new = np.where((ends >= 0) & (ends <= n), new, big)
        new = np.minimum.accumulate(new - step) + step  # text character left over
        row = np.where((ends >= 0) & (ends <= n), new, big)
        if row.min() > most:
            return big, 0
    if tail is not None:
        row = row + tail[np.clip(diagonals + len(item), 0, n)]
    best = int(row.argmin())
    return int(row[best]), first + best + len(item)


def edge_distances(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place: letters back to the start of its word, and letters on to the end of it."""
    gap = (c == BLANK) | (c == EDGE)
    place = np.arange(len(c))
    last = np.maximum.accumulate(np.where(gap, place, 0))
    ahead = np.minimum.accumulate(np.where(gap, place, len(c))[::-1])[::-1]
    back = np.zeros(len(c), np.int64)
    back[1:] = place[1:] - last[:-1] - 1
    return back, ahead - place


#: Regions that are aligned side by side.
LANES = 256


def _hits(index: Index, c: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) in normalised places; of overlapping hits the best one."""
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    edges = edge_distances(c)
    for text, item, first, width in index.regions(c, bounds):
        k, m = index.k[item], index.m[item]
        # The occurrence may start k places before the band or end as far behind it.
        low, high = bounds[text] + 1, bounds[text + 1]
        first, width = first - k, width + 2 * k
        fits = (first + width > low) & (first < high) & (high - low >= m - k)
        text, item, first, width, low, high = (x[fits] for x in (text, item, first, width, low, high))
        order = np.argsort(index.m[item], kind="stable")
        for at in range(0, len(order), LANES):
            some = order[at : at + LANES]
            limit = index.k[item[some]]
            edits, ends = align_all(
                [index.items[i] for i in item[some].tolist()], c, edges, first[some], width[some], low[some], high[some], limit)
            for j in np.flatnonzero(edits <= limit).tolist():
                t, i, least, end = int(text[some[j]]), int(item[some[j]]), int(edits[j]), int(ends[j])
                start = max(int(low[some[j]]), end - int(index.m[i]) - int(index.k[i]))
                tail = edges[0][start : end + 1][::-1]
                again, length = align(index.items[i][::-1], c[start:end][::-1], -least, 2 * least + 1, least, tail)
                if again <= least:
                    start = end - length
                    found.setdefault((t, i), []).append((least, start - int(edges[0][start]), end))
    for (text, i), hits in found.items():
        taken: list[tuple[int, int]] = []
        for edits, start, end in sorted(set(hits)):
            if all(end <= s or start >= e for s, e in taken):
                taken.append((start, end))
                yield text, i, start, end, edits


_made: dict[str, Index] = {}


def _index(name: str, items: list[tuple[int, str]], rate: float) -> Index:
    """The index of a block of items, kept by the worker until it is given another one."""
    if name not in _made:
        _made.clear()
        _made[name] = Index(items, rate)
    return _made[name]


def _search(batches: Iterable[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """(u, v, text) -> ``FIELDS``; places are characters of the original text."""
    table = letters()
    for batch in batches:
        u, v, col = column(batch, "u").to_pylist(), column(batch, "v").to_pylist(), column(batch, "text").fill_null("")
        _, offsets = utf8(col)
        rows = []
        for i, j in row_ranges(offsets):
            texts = col.slice(i, j - i).to_pylist()
            c, place, bounds = normalise(table, texts)
            for text, item, start, end, edits in _hits(index, c, bounds):
                origin = place[bounds[text]] + 1
                rows.append((u[i + text], v[i + text], index.ids[item], int(place[start] - origin), int(place[end - 1] + 1 - origin),
                             edits, int(index.m[item])))
        if rows:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), kinds)], ["u", "v", "item_id", "start", "end", "edits", "item_chars"])


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``FIELDS``: every occurrence of an item within its edit budget; u and v name the row of ``docs``."""
    texts = named_rows(docs.select(quoted("doc_id").alias("doc_id"), quoted("text").alias("text")), "doc_id", "text", "u", "v").where("text IS NOT NULL")
    items = benchmark.select(quoted("item_id").cast("bigint").alias("item_id"), quoted("text").alias("text")).where("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = 1 + chars // BLOCK
    out = None
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        shared = docs.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in rows])

        def search(batches, shared=shared, name=uuid.uuid4().hex):
            yield from _search(batches, _index(name, shared.value, rate))

        part = texts.mapInArrow(search, FIELDS)
        out = part if out is None else out.unionByName(part)
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, start, end (characters), edits, similarity of all hits."""
    ids = named_rows(docs.select(quoted("doc_id").alias("doc_id"), quoted("text").alias("text")), "doc_id", "text", "u", "v").drop("text")
    found = cut_lineage(leaks(docs, benchmark, rate).distinct())
    return ids.join(found, ["u", "v"]).select(
        "doc_id", "item_id", "start", "end", "edits", (1 - F.col("edits") / F.col("item_chars")).alias("similarity"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    row = fresh(docs, "u", "v")
    found = cut_lineage(leaks(docs, benchmark, rate).select(*[F.col(own).alias(name) for own, name in zip("uv", row)]).distinct())
    return named_rows(docs, "doc_id", "text", *row).join(found, row, "left_anti").select(*[quoted(c) for c in docs.columns])
