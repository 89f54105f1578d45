"""Quality filter: an interpolated modified Kneser-Ney character model of trusted text.

The model is a trigram model over an alphabet of ``SYMBOLS`` symbols (code points below
``PLAIN`` stand for themselves, others share the remaining symbols by a hash).  It is trained
on whole trusted texts and scores every whole document:

* documents are cut into blocks of about 1 MB; each block keeps, for every shard, its distinct
  trigrams with their counts per document, packed, so one row serves hundreds of documents;
* training takes the counts of the trusted documents out of the blocks (the places of trusted rows in a
  block are a small table, joined by block, so no text is moved), adds them up inside each task and sums them
  over the table; discounts and continuation counts are aggregations of that table;
* the lower orders have at most ``SYMBOLS`` squared probabilities by construction and are
  broadcast; the trigram counts are not bounded in this way and stay sharded by context;
* a shard's counts are joined to the blocks by a stream over (shard, salt); salts grow
  with the number of blocks, so no shard gathers the corpus in one task;
* per-block score vectors of the shards are added up to one value per document.

A document's score is its mean negative log-probability per character (the log of its
perplexity), drawn towards its language's mean by ``SHRINK`` characters, so that very short texts
are not judged on a handful of letters.  A document is rejected above the ``quantile`` of
the trusted scores in its language, plus ``margin``; a language without trusted text uses
the quantile over all languages.

Every labelled row that is trusted is learned from and counts for the limits, whatever their number.

Defined results: null or empty text has no score and is rejected; a null language is a
language of its own; repeated rows share their score and count in the quantiles as often
as they occur; without trusted rows nothing with a text is rejected; an empty table gives no rows; other columns
are passed on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glosa.llm.buffers import column, mix, row_ranges, utf8
from glosa.llm.tables import fresh, named_rows, quoted
from glosa.session import cut_lineage

SYMBOLS, PLAIN = 1024, 768
SHARDS = 16
SHRINK = 100
#: Trigrams a training task adds up before it hands them on.
HELD = 1 << 20
#: Blocks that one task of the join scores.
BLOCKS_A_TASK = 256
#: Scores are compared in steps of this many nats.
STEP = 0.001


def _symbols() -> np.ndarray:
    points = np.arange(0x110000, dtype=np.uint64)
    rest = np.uint64(PLAIN) + mix(points) % np.uint64(SYMBOLS - PLAIN)
    return np.where(points < PLAIN, points, rest).astype(np.int64)


def _trigrams(table: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram of every character (two pad symbols before each text) and its text."""
    joined = "\0\0" + "\0\0".join(texts)
    s = table[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(len(owner)) + 2 * (owner + 1)
    return s[at - 2] << 20 | s[at - 1] << 10 | s[at], owner


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, list[str]]]:
    col = column(batch, name).fill_null("")
    _, offsets = utf8(col)
    for i, j in row_ranges(offsets):
        for k in range(i, j, 1 << 14):
            end = min(j, k + (1 << 14))
            yield k, end, col.slice(k, end - k).to_pylist()


def _places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heads of blocks (block, u, v as bytes) -> (block, place, u, v), one row per document."""
    for batch in batches:
        for block, a, b in zip(*(column(batch, n).to_pylist() for n in ("block", "a", "b"))):
            u, v = np.frombuffer(a, np.int64), np.frombuffer(b, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(u), block)), pa.array(np.arange(len(u), dtype=np.int32)), pa.array(u), pa.array(v)],
                ["block", "place", "u", "v"])


def _unpacked(expand, a: bytes, b: bytes, c: bytes, d: bytes) -> tuple[np.ndarray, ...]:
    """Distinct trigrams of a packed row, the documents each occurs in, their places and counts."""
    raw = [np.frombuffer(expand.decompress(x), t) for x, t in ((a, np.uint32), (b, np.uint32), (c, np.uint16), (d, np.uint32))]
    return np.cumsum(raw[0].astype(np.int64)), *raw[1:]


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows with the places that count -> (id, n), added up inside the task."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def added() -> tuple[np.ndarray, np.ndarray]:
        ids, place = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        return ids, np.bincount(place, np.concatenate([n for _, n in held])).astype(np.int64)

    def give(ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["id", "n"])

    for batch in batches:
        for *packed, places in zip(*(column(batch, n).to_pylist() for n in ("a", "b", "c", "d", "places"))):
            ids, documents, own, count = _unpacked(expand, *packed)
            counts = np.zeros(1 << 14, bool)
            counts[places] = True
            at = np.flatnonzero(counts[own])
            held.append((np.repeat(ids, documents)[at], count[at].astype(np.int64)))
            if sum(len(x) for x, _ in held) > HELD:
                held = [added()]
                if 2 * len(held[0][0]) > HELD:
                    yield give(*held.pop())
    if held:
        yield give(*added())


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of one, two, and more."""
    one = counts.agg(*[F.sum(F.when(F.col("n") == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n = [float(x or 0) for x in one]
    if not all(n):
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.05), k + 0.95) for k in (0, 1, 2)]


def _level(counts: DataFrame, context: str) -> tuple[DataFrame, DataFrame]:
    """(id, alpha, context) and (context, gamma) of one order: discounted shares and back-off weights."""
    d = _discounts(counts)
    paid = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
    rows = counts.withColumn("context", F.expr(context)).withColumn("paid", paid)
    totals = cut_lineage(rows.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("paid") / F.sum("n")).alias("gamma")))
    alpha = rows.join(totals, "context").select("id", "context", ((F.col("n") - F.col("paid")) / F.col("total")).alias("alpha"))
    return alpha, totals.select("context", "gamma")


class KneserNey:
    """Trigram table (id, n) -> broadcastable lower orders and sharded trigram rows."""

    def __init__(self, counts: DataFrame) -> None:
        self.counts = counts
        pairs = cut_lineage(counts.groupBy(F.expr(f"id % {1 << 20}").alias("id")).agg(F.count("*").alias("n")))
        ones = cut_lineage(pairs.groupBy(F.expr(f"id % {SYMBOLS}").alias("id")).agg(F.count("*").alias("n")))
        self.lower = self._lower(pairs, ones)

    @staticmethod
    def _lower(pairs: DataFrame, ones: DataFrame) -> np.ndarray:
        """p(c | b) for all pairs of symbols; the rows collected are at most SYMBOLS squared."""
        uniform = 1.0 / SYMBOLS
        single = np.zeros(SYMBOLS)
        alpha, gamma = _level(ones, "0")
        first = gamma.first()
        for row in alpha.collect():
            single[row["id"]] = row["alpha"]
        single += (first["gamma"] if first else 1.0) * uniform
        double = np.zeros((SYMBOLS, SYMBOLS))
        back = np.ones(SYMBOLS)
        alpha, gamma = _level(pairs, "id DIV 1024")
        cells = alpha.select("id", "alpha").toArrow()
        double.ravel()[cells.column("id").to_numpy()] = cells.column("alpha").to_numpy()
        for row in gamma.collect():
            back[row["context"]] = row["gamma"]
        return (double + back[:, None] * single[None, :]).astype(np.float32)

    def shards(self) -> DataFrame:
        """(shard, ids, alphas, contexts, gammas): chunks of the trigram table, packed."""
        alpha, gamma = _level(self.counts, "id DIV 1024")
        rows = alpha.select("id", "alpha", F.lit(0).alias("kind")).unionByName(
            gamma.select(F.col("context").alias("id"), F.col("gamma").alias("alpha"), F.lit(1).alias("kind")))

        def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, value, kind = (column(batch, n).to_numpy() for n in ("id", "alpha", "kind"))
                shard = _shard_of(np.where(kind == 0, ids >> 10, ids))
                for s in np.unique(shard):
                    seen, ctx = (shard == s) & (kind == 0), (shard == s) & (kind == 1)
                    data = [ids[seen].astype(np.uint32), value[seen].astype(np.float32), ids[ctx].astype(np.uint32), value[ctx].astype(np.float32)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(s)], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in data]],
                        ["shard", "a", "b", "c", "d"])

        return rows.mapInArrow(pack, "shard int, a binary, b binary, c binary, d binary")


def _shard_of(context: np.ndarray) -> np.ndarray:
    return (mix(context.astype(np.uint64)) % np.uint64(SHARDS)).astype(np.int32)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v, text) -> per block one row per shard, and one row (shard -1) with u, v and lengths."""
    import zstandard
    from pyspark import TaskContext

    table, press = _symbols(), zstandard.ZstdCompressor(level=3)
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        u, v = column(batch, "u").to_numpy(), column(batch, "v").to_numpy()
        for i, j, texts in _texts(batch, "text"):
            ids, owner = _trigrams(table, texts)
            key = np.sort(ids << 14 | owner)
            new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
            count = np.diff(np.concatenate((new, [len(key)])))
            id_, own = key[new] >> 14, key[new] & ((1 << 14) - 1)
            shard = _shard_of(id_ >> 10)
            rows = [(-1, [u[i:j].tobytes(), v[i:j].tobytes(), np.bincount(owner, minlength=j - i).tobytes(), b"", b""])]
            for s in range(SHARDS):
                at = np.flatnonzero(shard == s)
                if not len(at):
                    continue
                mine = id_[at]
                head = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
                parts = [np.diff(mine[head], prepend=0).astype(np.uint32), np.diff(np.concatenate((head, [len(at)]))).astype(np.uint32),
                         own[at].astype(np.uint16), count[at].astype(np.uint32)]
                rows.append((s, [press.compress(p.tobytes()) for p in parts] + [np.asarray([j - i], np.int64).tobytes()]))
            names = ["block", "shard", "a", "b", "c", "d", "e"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(rows)), pa.array([r[0] for r in rows], pa.int32()),
                 *[pa.array([r[1][k] for r in rows], pa.binary()) for k in range(5)]], names)
            number += 1


def _score(batches: Iterable[pa.RecordBatch], lower: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted stream of a shard's model chunks (kind 0), then its blocks (kind 1) -> log-probability sums per block."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    now, model = None, None
    seen: list[list[bytes]] = []

    def load() -> tuple[np.ndarray, ...]:
        out = []
        for k, kind in enumerate((np.uint32, np.float32, np.uint32, np.float32)):
            out.append(np.frombuffer(b"".join(s[k] for s in seen), kind))
        first, second = np.argsort(out[0]), np.argsort(out[2])
        return out[0][first], out[1][first], out[2][second], out[3][second]

    def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    for batch in batches:
        cols = [column(batch, n).to_pylist() for n in ("shard", "kind", "block", "a", "b", "c", "d", "e")]
        blocks, shards, sums = [], [], []
        for shard, kind, block, a, b, c, d, e in zip(*cols):
            if shard != now:
                now, model, seen = shard, None, []
            if kind == 0:
                seen.append([a, b, c, d])
                continue
            if model is None:
                model, seen = load(), []
            ids, documents, own, count = _unpacked(expand, a, b, c, d)
            at, hit = find(model[0], ids.astype(np.uint32))
            ctx, known = find(model[2], (ids >> 10).astype(np.uint32))
            p = lower[(ids >> 10) & 1023, ids & 1023].astype(np.float64)
            if len(model[2]):
                p = np.where(known, model[3][ctx], 1.0) * p
            if len(model[0]):
                p = p + np.where(hit, model[1][at], 0.0)
            logp = np.repeat(np.log(p), documents)
            (rows,) = np.frombuffer(e, np.int64)
            blocks.append(block)
            shards.append(shard)
            sums.append(np.bincount(own, logp * count, minlength=rows).tobytes())
        if blocks:
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks), pa.array(shards, pa.int32()), pa.array(sums, pa.binary())], ["block", "shard", "sums"])


def _add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream sorted by (block, shard): names and lengths first, then the shards' vectors -> (u, v, logp, n)."""
    now, names, total = None, None, None

    def give() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (names[0], names[1], total, names[2])], ["u", "v", "logp", "n"])

    for batch in batches:
        for block, a, b, c, sums in zip(*(column(batch, n).to_pylist() for n in ("block", "a", "b", "c", "sums"))):
            if block != now:
                if names is not None:
                    yield give()
                now = block
                names = np.frombuffer(a, np.int64), np.frombuffer(b, np.int32), np.frombuffer(c, np.int64)
                total = np.zeros(len(names[0]))
            else:
                total = total + np.frombuffer(sums, np.float64)
    if names is not None:
        yield give()


def packed_blocks(texts: DataFrame) -> DataFrame:
    """(u, v, text) -> the blocks of ``_blocks``, written once."""
    return cut_lineage(texts.mapInArrow(
        _blocks, "block bigint, shard int, a binary, b binary, c binary, d binary, e binary"))


def trigram_counts(blocks: DataFrame, chosen: DataFrame) -> DataFrame:
    """(id, n) over all documents of the blocks whose (u, v) is in ``chosen``."""
    places = blocks.where("shard < 0").select("block", "a", "b").mapInArrow(_places, "block bigint, place int, u bigint, v int")
    own = cut_lineage(places.join(chosen, ["u", "v"], "left_semi").groupBy("block").agg(F.collect_list("place").alias("places")))
    rows = blocks.where("shard >= 0").select("block", "a", "b", "c", "d").join(own, "block")
    return cut_lineage(rows.select("a", "b", "c", "d", "places").mapInArrow(_count, "id bigint, n bigint").groupBy("id").agg(
        F.sum("n").alias("n")))


def log_probabilities(blocks: DataFrame, model: KneserNey) -> DataFrame:
    """(u, v, logp, n): natural log-probability and characters of every text of the blocks."""
    salts = 1 + blocks.where("shard >= 0").count() // (SHARDS * BLOCKS_A_TASK)
    salt = F.pmod(F.xxhash64("block"), F.lit(salts))
    chunks = model.shards().select(
        "shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("salt"), F.lit(0).alias("kind"),
        F.lit(-1).cast("bigint").alias("block"), "a", "b", "c", "d", F.lit(b"").alias("e"))
    asked = blocks.where("shard >= 0").select("shard", salt.alias("salt"), F.lit(1).alias("kind"), "block", "a", "b", "c", "d", "e")
    lower = blocks.sparkSession.sparkContext.broadcast(model.lower)
    sums = chunks.unionByName(asked).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind").mapInArrow(
        lambda b: _score(b, lower.value), "block bigint, shard int, sums binary")
    heads = blocks.where("shard < 0").select("block", "shard", "a", "b", "c", F.lit(None).cast("binary").alias("sums"))
    empty = F.lit(None).cast("binary")
    vectors = sums.select("block", "shard", empty.alias("a"), empty.alias("b"), empty.alias("c"), "sums")
    return heads.unionByName(vectors).repartition("block").sortWithinPartitions("block", "shard").mapInArrow(
        _add, "u bigint, v int, logp double, n bigint")


def score_documents(
    docs: DataFrame, trusted: DataFrame, quantile: float = 0.995, margin: float = 0.05,
) -> DataFrame:
    """(u, v, doc_id, lang, n, score, limit, kept) of every row; ``trusted`` holds the doc_id of trusted rows."""
    rows = docs.select(
        quoted("doc_id").alias("doc_id"), quoted("lang").alias("lang"), F.xxhash64(quoted("doc_id"), quoted("text")).alias("u"),
        F.hash(quoted("text"), quoted("doc_id")).alias("v"), F.coalesce(quoted("text"), F.lit("")).alias("text"))
    names = cut_lineage(rows.select("doc_id", "lang", "u", "v"))
    ids = cut_lineage(trusted.select("doc_id").where("doc_id IS NOT NULL").distinct())
    blocks = packed_blocks(rows.select("u", "v", "text"))
    counts = trigram_counts(blocks, names.join(ids, "doc_id", "left_semi").select("u", "v"))
    scores = log_probabilities(blocks, KneserNey(counts)).groupBy("u", "v").agg(
        F.max("logp").alias("logp"), F.max("n").alias("n"))
    marked = ids.withColumn("trusted", F.lit(True))
    named = cut_lineage(names.join(scores, ["u", "v"]).join(marked, "doc_id", "left"))

    # One level per language, one over all; grouping keeps null languages apart from the total.
    base = named.where("trusted AND n > 0")
    means = cut_lineage(base.groupingSets([["lang"], []], "lang").agg(
        F.grouping("lang").alias("all"), (-F.sum("logp") / F.sum("n")).alias("mean")))
    overall = means.where("all = 1").select(F.col("mean").alias("overall"))
    mean_row = overall.first()
    overall_mean = mean_row["overall"] if mean_row and mean_row["overall"] is not None else 0.0
    per_lang = means.where("all = 0").select(F.col("lang").alias("of"), "mean")
    centred = named.join(per_lang, F.col("lang").eqNullSafe(F.col("of")), "left").withColumn(
        "mean", F.coalesce("mean", F.lit(overall_mean))).withColumn(
        "score", F.when(F.col("n") > 0, (-F.col("logp") + SHRINK * F.col("mean")) / (F.col("n") + SHRINK))).drop("of")
    centred = cut_lineage(centred)
    stepped = centred.where("trusted AND n > 0").withColumn("step", F.floor(F.col("score") / STEP).cast("bigint"))
    bins = stepped.groupingSets([["lang", "step"], ["step"]], "lang", "step").agg(
        F.grouping("lang").alias("all"), F.count("*").alias("rows"))
    w = Window.partitionBy("all", "lang")
    reached = bins.withColumn("below", F.sum("rows").over(w.orderBy("step"))).withColumn("of_all", F.sum("rows").over(w)).where(
        F.col("below") >= quantile * F.col("of_all"))
    limits = cut_lineage(reached.groupBy("all", "lang").agg(((F.min("step") + 1) * STEP + margin).alias("limit")))
    whole = limits.where("all = 1").first()
    overall_limit = float(whole["limit"]) if whole else float("inf")
    per_lang = limits.where("all = 0").select(F.col("lang").alias("of"), "limit")
    judged = centred.join(per_lang, F.col("lang").eqNullSafe(F.col("of")), "left").withColumn(
        "limit", F.coalesce("limit", F.lit(overall_limit)))
    return judged.select("u", "v", "doc_id", "lang", "n", "score", "limit", F.coalesce(F.col("score") <= F.col("limit"), F.lit(False)).alias("kept"))


def keep_good(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not rejected."""
    row = fresh(docs, "u", "v")
    good = score_documents(docs, trusted, **options).where("kept").select(*[F.col(own).alias(name) for own, name in zip("uv", row)]).distinct()
    return named_rows(docs, "doc_id", "text", *row).join(cut_lineage(good), row, "left_semi").select(*[quoted(c) for c in docs.columns])
