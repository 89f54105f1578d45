"""Exact substring removal: a depth-limited radix sort of suffixes.

Suffixes are ordered through ``depth`` bytes only, by passes from the most significant
digit on; a suffix whose digit occurs once is settled and leaves, and groups that are
equal through all passes are exactly the repeated windows of ``depth`` bytes.

One suffix stands for a run of neighbouring windows.  Of the ``GRAM``-byte strings inside
a window the one with the least hash is the window's anchor; equal windows have equal
anchors at equal offsets, so sorting the anchored strings sorts the windows, with about
2.3 suffixes per 200 bytes in place of 200.  The passes:

1. the anchor string: anchors that occur once drop out;
2. the whole run, i.e. the string under all windows of an anchor: equal runs are settled
   as repeated, which covers the inside of every copy;
3. the rest, runs at the edges of a copy, by single windows: groups of up to ``GROUP``
   different strings in one place, larger ones first by blocks of ``BLOCK`` windows and then,
   where a block is alone, by windows, each counted with map-side combination.

Runs that repeat inside one document leave it once, marked; their places are found again
from the text at the end.  Digits are hashes of 64 bits, compared only inside groups with an
equal anchor hash.  Groups are counted with map-side combination, so a hot passage sends one row
per task and not one per copy; only strings of pass 3 carry text, one per different run.
Texts are shuffled compressed.

Defined results: null text is empty; texts below ``depth`` bytes lose nothing; a repeated
row counts as another copy and loses its text like one; ties do not arise, since every
copy of a repeated window is removed; an empty table gives no rows; columns of the input
that have a result's name are replaced by it, all others are passed on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosa.llm.buffers import Rolling, column, mix, row_ranges, sliding_min, utf8
from glosa.llm.tables import fresh, named_rows, quoted, without
from glosa.session import cut_lineage

PIECE = 1 << 20
GRAM = 32
BLOCK = 16
GROUP = 4000
#: u, v name a text; a run is ``at << 17 | many << 16 | windows << 8 | lead``: place of the first
#: window, whether the text holds the run again, number of windows, bytes from the first window to the anchor.
RUN_FIELDS = "u bigint, v int, run bigint, digit bigint, whole bigint"
RESULTS = ["n_bytes", "n_removed", "n_spans", "kept"]
_LOW = np.uint64(0xFFFFFF)


def _runs(rolling: Rolling, depth: int, gram: int, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first window, windows, lead, anchor hash, run hash) of all texts in a buffer."""
    n = len(data)
    if n < depth:
        return
    prefix = rolling.prefix(data)
    grams = mix(rolling.grams(prefix, gram))
    least = sliding_min((grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64), depth - gram + 1)
    anchor = (least & _LOW).astype(np.int64)
    mark = np.zeros(n + 2, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= depth)
    np.add.at(mark, offsets[long], 1)
    np.add.at(mark, offsets[long + 1] - depth + 1, -1)
    valid = np.cumsum(mark[: len(anchor)]) > 0
    cut = np.ones(len(anchor) + 1, bool)
    cut[1:-1] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    places = np.flatnonzero(cut)
    first, last = places[:-1], places[1:] - 1
    real = valid[first]
    first, last = first[real], last[real]
    at = anchor[first]
    row = np.searchsorted(offsets, first, side="right") - 1
    shape = ((last - first + 1) << 8 | (at - first)).astype(np.uint64)
    whole = mix(rolling.span(prefix, first, last + depth) + mix(shape))
    yield row, first, last - first + 1, at - first, grams[at], whole


def _pieces(data: np.ndarray, offsets: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Buffers of about ``PIECE`` bytes with their texts' bounds; very long texts go in overlapping pieces."""
    for i, j in row_ranges(offsets, PIECE):
        here = offsets[i : j + 1]
        # Windows that start in [low, low + PIECE) need depth - 1 bytes more.
        for low in range(0, max(int(here[-1] - here[0]), 1), PIECE):
            start = int(here[0]) + low
            part = data[start : min(start + PIECE + depth - 1, int(here[-1]))]
            yield part, np.clip(here - start, 0, len(part)), i, start


def _distinct(row: np.ndarray, digit: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of every different run of a text, and for all runs whether their text holds them again."""
    order = np.lexsort((whole, digit, row))
    same = np.zeros(len(order), bool)
    same[1:] = (row[order][1:] == row[order][:-1]) & (digit[order][1:] == digit[order][:-1]) & (whole[order][1:] == whole[order][:-1])
    group = np.cumsum(~same) - 1
    many = np.zeros(len(order), bool)
    many[order] = (np.bincount(group) > 1)[group] if len(order) else many
    return order[~same], many


def anchored_runs(depth: int):
    """mapInArrow function (u, v, text) -> ``RUN_FIELDS``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(11, PIECE + 2 * depth)
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            u, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part, bounds, i, start in _pieces(data, offsets, depth):
                for row, first, windows, lead, digit, whole in _runs(rolling, depth, GRAM, part, bounds):
                    at = first + start - offsets[i + row]
                    pick, many = _distinct(row, digit, whole)
                    packed = (at << 17 | many.astype(np.int64) << 16 | windows << 8 | lead)[pick]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(u[i + row[pick]]), pa.array(v[i + row[pick]]), pa.array(packed),
                         pa.array(digit[pick].view(np.int64)), pa.array(whole[pick].view(np.int64))],
                        ["u", "v", "run", "digit", "whole"])

    return run


def _own_repeats(rolling: Rolling, data: np.ndarray, offsets: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Byte ranges (in the buffer) under runs that their own text holds again."""
    for part, bounds, _, start in _pieces(data, offsets, depth):
        for row, first, windows, _, digit, whole in _runs(rolling, depth, GRAM, part, bounds):
            _, many = _distinct(row, digit, whole)
            yield start + first[many], start + first[many] + windows[many] + depth - 1


def _strings(batches: Iterable[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Compressed text and its wanted runs -> one row per run with the bytes under it."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        runs, texts = column(batch, "runs").to_pylist(), column(batch, "packed")
        u, v = column(batch, "u").to_pylist(), column(batch, "v").to_pylist()
        rows: list[tuple] = []
        size = 0
        for r, wanted in enumerate(runs):
            text = expand.decompress(texts[r].as_py())
            for item in wanted:
                run = item["run"]
                at = (run >> 17)
                string = text[at : at + ((run >> 8) & 0xFF) + depth - 1]
                rows.append((u[r], v[r], run, item["digit"], item["open"], item["hot"], string))
                size += len(string)
                if size > PIECE:
                    yield _string_rows(rows)
                    rows, size = [], 0
        if rows:
            yield _string_rows(rows)


def _string_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["u", "v", "run", "digit", "open", "hot", "string"])


def _blocks(windows: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, end) of all blocks; cut where the distance to the anchor is a multiple of ``BLOCK``."""
    head = np.minimum(lead % BLOCK + 1, windows)
    count = 1 + (windows - head + BLOCK - 1) // BLOCK
    row = np.repeat(np.arange(len(count)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    low = np.where(k == 0, 0, head[row] + (k - 1) * BLOCK)
    return row, low, np.minimum(head[row] + k * BLOCK, windows[row])


def _parts(depth: int, single: bool):
    """mapInArrow function: strings -> their blocks, or the single windows of the blocks listed in ``blocks``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(12, PIECE)
        for batch in batches:
            for at in range(0, len(batch), 4096):
                some = batch.slice(at, 4096)
                data, offsets = utf8(column(some, "string"))
                runs = column(some, "run").to_numpy()
                windows, lead = (runs >> 8) & 0xFF, runs & 0xFF
                prefix = rolling.prefix(data)
                if single:
                    lists = column(some, "blocks")
                    row = np.repeat(np.arange(len(some)), lists.value_lengths().to_numpy(zero_copy_only=False))
                    cells = lists.flatten()
                    first, last = (cells.field(n).to_numpy() for n in ("low", "high"))
                    alone = cells.field("alone")
                    count = last - first
                    of = np.repeat(np.arange(len(count)), count)
                    low = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[of]
                    row, high, alone = row[of], low + 1, alone.take(pa.array(of))
                else:
                    row, low, high = _blocks(windows, lead)
                    alone = column(some, "open").take(pa.array(row))
                start = offsets[row] + low
                shape = ((lead[row] - low) << 8 | (high - low)).astype(np.uint64)
                key = mix(rolling.span(prefix, start, start + (high - low) + depth - 1) + mix(shape))
                names = ["u", "v", "run", "digit"]
                out = [column(some, n).take(pa.array(row)) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*out, alone, pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.array(key.view(np.int64))],
                    [*names, "open", "low", "high", "part"])

    return run


STRING_FIELDS = "u bigint, v int, run bigint, digit bigint, open boolean, hot boolean, string binary"
PART_FIELDS = "u bigint, v int, run bigint, digit bigint, open boolean, low int, high int, part bigint"


def _grouped(batches: Iterable[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Strings sorted by digit, whole groups at a time -> (u, v, low, high) under their repeated windows."""
    rolling = Rolling(12, PIECE)

    def resolve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        data, offsets = utf8(table.column("string"))
        run, digit = table.column("run").to_numpy(), table.column("digit").to_numpy().view(np.uint64)
        windows, lead = (run >> 8) & 0xFF, run & 0xFF
        row = np.repeat(np.arange(len(run)), windows)
        w = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        prefix = rolling.prefix(data)
        start = offsets[row] + w
        key = mix(rolling.span(prefix, start, start + depth) + mix((lead[row] - w).astype(np.uint64) + digit[row]))
        order = np.argsort(key, kind="stable")
        twice = np.zeros(len(key), bool)
        same = key[order][1:] == key[order][:-1]
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        twice &= table.column("open").to_numpy(zero_copy_only=False)[row]
        # Neighbouring windows of a string make one range.
        first = twice.copy()
        first[1:] &= ~(twice[:-1] & (row[1:] == row[:-1]))
        last = twice.copy()
        last[:-1] &= ~(twice[1:] & (row[1:] == row[:-1]))
        a, b = np.flatnonzero(first), np.flatnonzero(last)
        of = row[a]
        at = run[of] >> 17
        return pa.RecordBatch.from_arrays(
            [pa.array(table.column("u").to_numpy()[of]), pa.array(table.column("v").to_numpy()[of]),
             pa.array(at + w[a]), pa.array(at + w[b] + depth)], ["u", "v", "low", "high"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        at = 0
        while at < len(batch):
            part = batch.slice(at, 2048)
            at += len(part)
            digits = column(part, "digit").to_numpy()
            # Up to the last change of digit everything held is whole groups.
            change = np.flatnonzero(digits[1:] != digits[:-1]) + 1
            cut = int(change[-1]) if len(change) else 0
            before = held and column(held[-1], "digit")[-1].as_py() != digits[0]
            if rows > 2048 and (cut or before):
                yield resolve([*held, part.slice(0, cut)] if cut else held)
                held, rows, part = [], 0, part.slice(cut)
            held.append(part)
            rows += len(part)
    if rows:
        yield resolve(held)


RANGES = "u bigint, v int, low bigint, high bigint"


def _ranges(rows: DataFrame, low: str, high: str, depth: int) -> DataFrame:
    """Bytes under the windows [low, high) of a run."""
    return rows.selectExpr("u", "v", f"(run >> 17) + {low} AS low", f"(run >> 17) + {high} + {depth - 1} AS high")


def repeated_ranges(texts: DataFrame, packed: DataFrame, depth: int) -> DataFrame:
    """(u, v, text) and (u, v, packed) -> (u, v, low, high): byte ranges under repeated windows.

    Ranges may overlap; runs that one text holds twice are left to ``_own_repeats``.
    """
    runs = texts.where(F.octet_length("text") >= depth).mapInArrow(anchored_runs(depth), RUN_FIELDS)
    copies = F.sum(F.expr("1 + ((run >> 16) & 1)"))

    # Pass 1: anchor strings.
    digits = cut_lineage(runs.groupBy("digit").agg(copies.alias("n")).where("n > 1").select("digit"))
    alive = cut_lineage(runs.join(digits, "digit"))

    # Pass 2: whole runs; of equal runs that of the least u stands for all in pass 3.
    wholes = cut_lineage(alive.groupBy("digit", "whole").agg(copies.alias("n"), F.min("u").alias("one")))
    mixed = cut_lineage(wholes.groupBy("digit").agg(F.min("n").alias("least"), F.count("*").alias("kinds")).where(
        "least = 1 AND kinds > 1").select("digit", "kinds"))
    known = cut_lineage(wholes.join(mixed, "digit", "left").where("n > 1 OR kinds IS NOT NULL"))
    judged = cut_lineage(alive.join(known, ["digit", "whole"]).selectExpr(
        "u", "v", "run", "n > 1 AS settled", f"CASE WHEN u = one AND kinds IS NOT NULL THEN digit END AS digit", f"kinds > {GROUP} AS hot"))
    found = _ranges(judged.where("settled"), "0", "((run >> 8) & 255)", depth)

    # Pass 3: the strings of different runs, where an anchor has several and one of them is alone.
    wanted = judged.where("digit IS NOT NULL").groupBy("u", "v").agg(
        F.collect_set(F.expr("struct(run, digit, NOT settled AS open, hot)")).alias("runs"))
    strings = cut_lineage(packed.join(wanted, ["u", "v"]).select("u", "v", "packed", "runs").mapInArrow(
        lambda batches: _strings(batches, depth), STRING_FIELDS))
    found = found.unionByName(strings.where("NOT hot").repartition("digit").sortWithinPartitions("digit").mapInArrow(
        lambda batches: _grouped(batches, depth), RANGES))
    hot = strings.where("hot")
    return found if hot.isEmpty() else found.unionByName(_hot_ranges(hot, depth))


def _hot_ranges(strings: DataFrame, depth: int) -> DataFrame:
    """Pass 3 for anchors with very many different strings."""
    blocks = cut_lineage(strings.mapInArrow(_parts(depth, False), PART_FIELDS).withColumn(
        "place", F.expr(f"((run & 255) - low) DIV {BLOCK}")))
    parts = cut_lineage(blocks.groupBy("digit", "place", "part").agg(
        F.count("*").alias("n"), F.min(F.struct("u", "v", "run", "low", "high")).alias("one"),
        F.bool_or("open").alias("open")))
    repeated = cut_lineage(parts.where("n > 1").select("digit", "part"))
    found = _ranges(blocks.where("open").join(repeated, ["digit", "part"]), "low", "high", depth)

    # Single windows, one block of every kind, where an open one is alone and has company.
    places = parts.groupBy("digit", "place").agg(
        F.count("*").alias("kinds"), F.bool_or(F.col("open") & (F.col("n") == 1)).alias("needs")).where(
        "needs AND kinds > 1").select("digit", "place")
    listed = parts.join(cut_lineage(places), ["digit", "place"]).selectExpr(
        "one.u", "one.v", "one.run", "one.low", "one.high", "open AND n = 1 AS alone").groupBy("u", "v", "run").agg(
        F.collect_list(F.struct("low", "high", "alone")).alias("blocks"))
    singles = cut_lineage(strings.dropDuplicates(["u", "v", "run"]).join(listed, ["u", "v", "run"]).mapInArrow(
        _parts(depth, True), PART_FIELDS))
    twice = cut_lineage(singles.groupBy("digit", "part").agg(F.count("*").alias("n")).where("n > 1").select("digit", "part"))
    return found.unionByName(_ranges(singles.where("open").join(twice, ["digit", "part"]), "low", "high", depth))


def _as_text(kept: pa.Array) -> pa.Array:
    """Strings; of a character that lost a byte the other bytes are left out."""
    return pa.array([b.decode("utf-8", "ignore") for b in kept.to_pylist()], pa.string())


def _remove(
    batches: Iterable[pa.RecordBatch], passed: list[str], text: str, depth: int, as_text: bool, added: tuple[str, str, str]
) -> Iterator[pa.RecordBatch]:
    """Rows with compressed text and ranges -> the passed columns and ``RESULTS``."""
    import zstandard

    expand, rolling = zstandard.ZstdDecompressor(), Rolling(11, PIECE + 2 * depth)
    for whole in batches:
        sizes = np.cumsum([0] + column(whole, added[1]).to_pylist())
        for i, j in row_ranges(sizes, 4 * PIECE):
            batch = whole.slice(i, j - i)
            packed = [p if p is None else expand.decompress(p) for p in column(batch, added[0]).to_pylist()]
            raw = pa.array(packed, pa.large_binary())
            data, offsets = utf8(raw)
            lists = column(batch, added[2])
            cells = lists.flatten()
            row = np.repeat(np.arange(len(batch)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            low, high = (cells.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("low", "high"))
            mark = np.zeros(len(data) + 1, np.int32)
            np.add.at(mark, offsets[row] + low, 1)
            np.add.at(mark, offsets[row] + high, -1)
            for a, b in _own_repeats(rolling, data, offsets, depth):
                np.add.at(mark, a, 1)
                np.add.at(mark, b, -1)
            gone = np.cumsum(mark)[:-1] > 0
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            heads = offsets[:-1][np.diff(offsets) > 0]
            first[heads] = gone[heads]
            of = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])
            removed, size = of(gone), np.diff(offsets)
            kept = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(batch),
                [None, pa.py_buffer(np.concatenate(([0], np.cumsum(size - removed)))), pa.py_buffer(data[~gone])]).cast(pa.binary())
            columns = [raw.cast(pa.binary()).cast(pa.string()) if n == text else column(batch, n) for n in passed]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(size), pa.array(removed), pa.array(of(first)), _as_text(kept) if as_text else kept],
                [*passed, *RESULTS])


def _compressed(batches: Iterable[pa.RecordBatch], text: str, added: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """The text column as Zstandard frames (null stays null), with its size in bytes."""
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        raw = column(batch, text).cast(pa.binary()).to_pylist()
        rest = [n for n in batch.schema.names if n != text]
        yield pa.RecordBatch.from_arrays(
            [*(column(batch, n) for n in rest), pa.array([None if b is None else press.compress(b) for b in raw], pa.binary()),
             pa.array([len(b or b"") for b in raw], pa.int64())], [*rest, *added])


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", depth: int = 200, as_text: bool = False) -> DataFrame:
    """All rows with n_bytes, n_removed, n_spans and ``kept``, the bytes left of the text (or their whole characters).

    ``depth`` is at most 250 above ``GRAM``.
    """
    if not GRAM < depth <= GRAM + 250:
        raise ValueError(f"depth must be in {GRAM + 1}..{GRAM + 250}")
    # 96 bits name a text: rows equal in id and text share their result.
    u, v, pack, size, cut = fresh(docs, "u", "v", "packed", "size", "ranges")
    passed = without(docs, RESULTS).columns
    source = named_rows(docs, key, text, u, v).select(*[quoted(c) for c in passed], u, v)
    schema = source.drop(text).schema.add(pack, "binary").add(size, "long")
    packed = source.mapInArrow(lambda batches: _compressed(batches, text, (pack, size)), schema)
    texts = named_rows(docs.select(quoted(key).alias("key"), quoted(text).alias("text")), "key", "text", "u", "v").select(
        "u", "v", F.coalesce("text", F.lit("")).alias("text"))
    slim = packed.select(F.col(u).alias("u"), F.col(v).alias("v"), F.col(pack).alias("packed"))
    ranges = repeated_ranges(texts, slim, depth).groupBy("u", "v").agg(
        F.collect_set(F.struct("low", "high")).alias(cut)).select(F.col("u").alias(u), F.col("v").alias(v), cut)
    schema = docs.select(*[quoted(c) for c in passed]).schema
    for name, kind in zip(RESULTS, ("long", "long", "long", "string" if as_text else "binary")):
        schema = schema.add(name, kind)
    return packed.join(ranges, [u, v], "left").mapInArrow(
        lambda batches: _remove(batches, passed, text, depth, as_text, (pack, size, cut)), schema)
