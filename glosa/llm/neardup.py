"""Near-duplicates by a chosen-path similarity join over minwise hashes.

A document is the set of its distinct ``width``-word shingles.  Each of ``TREES``
independent trees sends a document down random paths: at every level one or two (1.25 on
average, 1/0.8) minwise coordinates are chosen, and documents that agree on them share a
child node.  A node of at most ``SMALL`` different sets is compared exhaustively; larger
nodes branch on, level by level.  Levels up to ``FIRST`` are taken in one step.
A pair at the threshold shares a node of a tree with probability 0.64 at three levels
and 0.58 at four, so 14 trees miss it with about 1e-6.

Sets that are equal are one vertex from the start, so exact copies cost one row.  Links
are confirmed on full sets.  Components are contracted as soon as they are known, and nothing inside a
component is compared again: first the members of the nodes of two trees are compared with their node's least
member, which joins nearly all groups of copies with a few comparisons per member.  From then on
only nodes that still hold several components count.  In small ones all pairs of different components are
compared; in larger ones every member of another component is compared with the least member, and those still
open after that go down a level, as long as that leaves fewer comparisons.  Where it does not pay, and at ``DEPTH``
levels, all pairs of different components are compared, whatever the size of the node.  No node, group or list of partners is cut off.

Before texts are fetched, pairs are sieved by set sizes and by a sketch of 512 parities (both exact), by a sketch of four bits of each of the 64
coordinates, whose bound lies 5 standard deviations above the threshold, and pairs compared before are left out.

Defined results: null or white-space text is an empty set, linked with nothing; a
text with fewer than ``width`` words is one shingle, its whole sequence; repeated rows are
one vertex; the component of rows without any id is null, and a row without an id is kept
only if no row of its component has one; an empty table gives no rows; other columns are
passed on by ``keep_one`` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosa.llm.buffers import LIMIT, Rolling, Words, column, mix, row_ranges, utf8
from glosa.llm.components import components
from glosa.llm.tables import bucketed, fresh, named_rows, quoted
from glosa.session import cut_lineage, stages_removed

COORDINATES = 64
TREES = 14
FIRST, DEPTH = 3, 10
SMALL = 16
#: The descent ends where a level leaves over three quarters of the comparisons in large nodes, or a few for each set.
PAYS, FEW = 0.75, 4
#: Trees whose nodes are compared with their least members before anything else.
EARLY = 2
#: Marks of wanted texts, which are broadcast: at most so many numbers.
MARKS = 1 << 20
PERCENT = 80
#: Differing coordinates of a sketch: 12 expected at the threshold, deviation 3.1.
SKETCH_DIFFER = 28
SKETCH = [f"s{i}" for i in range(4)]
#: Words of the parity sketch: bit h tells whether an odd number of a set's shingles fall on h.
PARITY = [f"p{i}" for i in range(8)]


class Sets:
    """Distinct shingle hashes of the documents of a buffer, document after document."""

    def __init__(self, rolling: Rolling, data: np.ndarray, offsets: np.ndarray, width: int) -> None:
        words = Words(rolling, data, offsets)
        factor = np.uint64(0x9E3779B97F4A7C15)
        count = np.diff(words.bounds)
        h = words.hash
        sums = np.zeros(len(h), np.uint64)
        for k in range(width):
            part = h[k:] if k else h
            sums[: len(part)] = sums[: len(part)] * factor + part
        # Documents with fewer words than a shingle: their words in order.
        for d in np.flatnonzero((count > 0) & (count < width)):
            total = np.uint64(count[d])
            for x in h[words.bounds[d] : words.bounds[d + 1]]:
                total = np.uint64((int(total) * int(factor) + int(x)) % (1 << 64))
            sums[words.bounds[d]] = total
        number = np.where(count >= width, count - width + 1, np.minimum(count, 1))
        ends = np.cumsum(number)
        starts = ends - number
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(starts, number) + np.repeat(words.bounds[:-1], number)
        values = mix(sums[at])
        for s, e in zip(starts.tolist(), ends.tolist()):
            values[s:e].sort()
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        new[starts[number > 0]] = True
        self.values = values[new]
        place = np.concatenate(([0], np.cumsum(new)))
        self.bounds = np.concatenate((place[starts], place[-1:]))
        self.size = np.diff(self.bounds)


def _parities(sets: Sets) -> np.ndarray:
    """One row of 64 bytes per document: the parity of its shingles on every bit."""
    width = 64 * len(PARITY)
    out = np.zeros((len(sets.size), width // 8), np.uint8)
    for at in range(0, len(out), 2048):
        size = sets.size[at : at + 2048]
        values = sets.values[sets.bounds[at] : sets.bounds[at + len(size)]]
        place = np.repeat(np.arange(len(size)), size) * width + (values & np.uint64(width - 1)).astype(np.int64)
        counts = np.bincount(place, minlength=len(size) * width).reshape(len(size), width)
        out[at : at + len(size)] = np.packbits((counts & 1).astype(np.uint8), axis=1)
    return out


def _signatures(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, u, v, text) -> (doc_id, u, v, n, gid, mins, odd); gid names the set by 128 bits."""
    rolling = Rolling(21, LIMIT)
    factors = np.random.default_rng(22).integers(1 << 62, size=COORDINATES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in batches:
        data, offsets = utf8(batch.column(3))
        for i, j in row_ranges(offsets):
            sets = Sets(rolling, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
            full = np.flatnonzero(sets.size)
            heads = sets.bounds[full]
            names = np.zeros((j - i, 2), np.uint64)
            least = np.zeros((j - i, COORDINATES), np.uint32)
            if len(full):
                names[full, 0] = mix(np.add.reduceat(mix(sets.values + np.uint64(1)), heads))
                names[full, 1] = mix(np.add.reduceat(mix(sets.values ^ np.uint64(0x5851F42D4C957F2D)), heads))
                for c, factor in enumerate(factors):
                    least[full, c] = (np.minimum.reduceat(sets.values * factor, heads) >> np.uint64(32)).astype(np.uint32)
            empty = sets.size == 0
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(i, j - i) for c in batch.columns[:3]), pa.array(sets.size.astype(np.int64)),
                 pa.array([None if e else x.tobytes() for x, e in zip(names, empty)], pa.binary()),
                 pa.array([None if e else x.tobytes() for x, e in zip(least, empty)], pa.binary()),
                 pa.array([None if e else x.tobytes() for x, e in zip(_parities(sets), empty)], pa.binary())],
                ["doc_id", "u", "v", "n", "gid", "mins", "odd"])


@cache
def paths(seed: int = 23) -> list[list[tuple[int, int, tuple[int, ...]]]]:
    """Per level: (tree, place of the parent in the level above, coordinates) of every path."""
    rng = np.random.default_rng(seed)
    levels = [[(t, -1, ()) for t in range(TREES)]]
    for _ in range(DEPTH):
        below = []
        for place, (tree, _, used) in enumerate(levels[-1]):
            free = rng.permutation([c for c in range(COORDINATES) if c not in used])
            for c in free[: 2 if rng.random() < 0.25 else 1]:
                below.append((tree, place, (*used, int(c))))
        levels.append(below)
    return levels[1:]


def _mins(col: pa.Array) -> np.ndarray:
    return utf8(col)[0].view(np.uint32).reshape(-1, COORDINATES)


def _keys(level: int, places: list[int], least: np.ndarray) -> np.ndarray:
    """Node keys (rows x places) of one level."""
    out = np.zeros((len(least), len(places)), np.uint64)
    all_paths = paths()[level]
    for k, place in enumerate(places):
        tree, _, used = all_paths[place]
        h = np.full(len(least), tree * 16 + level + 1, np.uint64)
        for c in used:
            h = mix(h + least[:, c].astype(np.uint64) + np.uint64((c + 1) << 40))
        out[:, k] = h
    return out


NODE_FIELDS = "path int, key bigint, g bigint"


def _first_nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places = list(range(len(paths()[FIRST - 1])))
    for batch in batches:
        for at in range(0, len(batch), 2048):
            some = batch.slice(at, 2048)
            keys = _keys(FIRST - 1, places, _mins(column(some, "mins")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(places, len(some)), pa.int32()), pa.array(keys.ravel().view(np.int64)),
                 column(some, "g").take(pa.array(np.repeat(np.arange(len(some)), len(places))))],
                ["path", "key", "g"])


def _next_nodes(batches: Iterable[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """Rows (path at level - 1, g, mins) -> their children at ``level``."""
    children: dict[int, list[int]] = {}
    for place, (_, parent, _) in enumerate(paths()[level]):
        children.setdefault(parent, []).append(place)
    for batch in batches:
        path = column(batch, "path").to_numpy()
        least = _mins(column(batch, "mins"))
        for p in np.unique(path).tolist():
            at = np.flatnonzero(path == p)
            keys = _keys(level, children[p], least[at])
            for k, place in enumerate(children[p]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), place), pa.int32()), pa.array(np.ascontiguousarray(keys[:, k]).view(np.int64)),
                     column(batch, "g").take(pa.array(at))], ["path", "key", "g"])


def _shared(rows: DataFrame) -> DataFrame:
    """(path, key, g, members) of the nodes with at least two members."""
    counts = cut_lineage(rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"))
    return rows.join(counts, "key").select("path", "key", "g", "members")


def _open(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their roots, of the nodes that hold several components."""
    rooted = cut_lineage(nodes.join(roots, "g", "left").select("path", "key", "g", "members", F.coalesce("root", "g").alias("root")))
    several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    return cut_lineage(rooted.join(cut_lineage(several), "key"))


def _stars(members: DataFrame) -> DataFrame:
    """Pairs of the least member of every node with the members of other components."""
    least = cut_lineage(members.groupBy("key").agg(F.min(F.struct("g", "root")).alias("p")))
    return members.join(least, "key").where("root <> p.root").select(F.col("p.g").alias("a"), F.col("g").alias("b"))


def _confirm(batches: Iterable[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) -> the pairs whose full sets reach the threshold."""
    rolling = Rolling(21, LIMIT)
    for batch in batches:
        left, ends = utf8(column(batch, "text_a"))
        right, stops = utf8(column(batch, "text_b"))
        linked = []
        for i, j in row_ranges(ends + stops):
            one = Sets(rolling, left[ends[i] : ends[j]], ends[i : j + 1] - ends[i], width)
            two = Sets(rolling, right[stops[i] : stops[j]], stops[i : j + 1] - stops[i], width)
            for r in range(j - i):
                a = one.values[one.bounds[r] : one.bounds[r + 1]]
                b = two.values[two.bounds[r] : two.bounds[r + 1]]
                shared = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    linked.append(i + r)
        at = pa.array(linked, pa.int64())
        yield pa.RecordBatch.from_arrays([column(batch, "a").take(at), column(batch, "b").take(at)], ["a", "b"])


def _sieve(x: str, y: str, info: DataFrame) -> str:
    """Necessary conditions on sizes and on parities, where ``info`` has them, and the sketch bound for two vertices.

    A shingle in one set alone turns one bit, so no more bits differ than shingles do.
    """
    odd = [f"bit_count({x}.{p} ^ {y}.{p})" for p in PARITY if p in info.columns] or ["0"]
    apart = [f"({x}.{s} ^ {y}.{s})" for s in SKETCH]
    folded = [f"bit_count(({d} | shiftright({d}, 1) | shiftright({d}, 2) | shiftright({d}, 3)) & 1229782938247303441L)" for d in apart]
    return f"100 * least({x}.n, {y}.n) >= {PERCENT} * greatest({x}.n, {y}.n) AND {100 + PERCENT} * ({' + '.join(odd)}) <= {100 - PERCENT} * ({x}.n + {y}.n) AND {' + '.join(folded)} <= {SKETCH_DIFFER}"


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, n, mins, odd) -> (g, n), the low four bits of every coordinate, sixteen to a word, and the words of parities."""
    shifts = np.uint64(4) * np.arange(16, dtype=np.uint64)
    for batch in batches:
        bits = (_mins(column(batch, "mins")) & np.uint32(15)).astype(np.uint64).reshape(-1, 4, 16)
        words = np.bitwise_or.reduce(bits << shifts, axis=2).view(np.int64)
        odd = utf8(column(batch, "odd"))[0].view(np.int64).reshape(-1, len(PARITY))
        both = np.concatenate((words, odd), axis=1)
        yield pa.RecordBatch.from_arrays(
            [column(batch, "g"), column(batch, "n"), *(pa.array(np.ascontiguousarray(w)) for w in both.T)], ["g", "n", *SKETCH, *PARITY])


def _crossed(members: DataFrame, info: DataFrame) -> DataFrame:
    """Pairs of members of one node and different components that pass the sieve, each made in the least of the nodes it shares."""
    own = members.groupBy("g").agg(F.min("root").alias("root"), F.collect_list("key").alias("keys"))
    known = cut_lineage(own.join(info, "g").withColumn("key", F.explode("keys")))
    x, y = known.alias("x"), known.alias("y")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.g") < F.col("y.g")) & (F.col("x.root") != F.col("y.root"))
    first = "x.key = array_min(array_intersect(x.keys, y.keys))"
    return x.join(y, apart & F.expr(f"{_sieve('x', 'y', info)} AND {first}")).select(F.col("x.g").alias("a"), F.col("y.g").alias("b"))


class NearDuplicates:
    """Rows of ``docs`` with their sets, and the component of every set."""

    def __init__(self, docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5) -> None:
        self.width = width
        self.rows = docs.select(
            quoted(key).cast("bigint").alias("doc_id"), F.xxhash64(quoted(key), quoted(text)).alias("u"),
            F.hash(quoted(text), quoted(key)).alias("v"), quoted(text).alias("text"))
        self.signed = cut_lineage(self.rows.mapInArrow(
            lambda b: _signatures(b, width), "doc_id bigint, u bigint, v int, n bigint, gid binary, mins binary, odd binary"))
        grouped = self.signed.where("gid IS NOT NULL").groupBy("gid").agg(
            F.min("doc_id").alias("least"), F.min(F.struct("u", "v")).alias("row"), F.max("n").alias("n"), F.max("mins").alias("mins"),
            F.max("odd").alias("odd"))
        # Short numbers for the sets, fixed by writing them.
        self.groups = cut_lineage(grouped.withColumn("g", F.monotonically_increasing_id()))

    def roots(self) -> DataFrame:
        """(g, root) of the sets that are linked to a lesser one."""
        with stages_removed(self.groups.sparkSession) as keep:
            return keep(self._roots())

    def _roots(self) -> DataFrame:
        spark = self.groups.sparkSession
        # Three elements against four are below the threshold: such sets are linked to equals only.
        sets = self.groups.where("n > 3")
        with stages_removed(spark) as keep:
            nodes = keep(_shared(sets.select("g", "mins").mapInArrow(_first_nodes, NODE_FIELDS)))
        # Both are joined level after level: they lie in buckets, so only the pairs move.
        info = bucketed(sets.select("g", "n", "mins", "odd").mapInArrow(
            _sketch, "g bigint, n bigint, " + ", ".join(f"{s} bigint" for s in [*SKETCH, *PARITY])), "g")
        coordinates = bucketed(sets.select("g", "mins"), "g")
        wanted = cut_lineage(sets.select("g", "row.*").join(nodes.select("g").distinct(), "g"))
        # Most texts are in no shared node: a mark per hash, of a bounded number, leaves them out before the shuffle.
        mark = F.pmod("u", F.lit(MARKS)).alias("mark")
        marks = F.broadcast(cut_lineage(wanted.select(mark).distinct()))
        some = self.rows.select("u", "v", "text", mark).join(marks, "mark", "left_semi")
        texts = bucketed(some.join(wanted, ["u", "v"]).select("g", "text").dropDuplicates(["g"]), "g")
        width, few = self.width, FEW * wanted.count()

        seen: list[DataFrame] = []

        def confirmed(pairs: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
            x, y = info.alias("x"), info.alias("y")
            new = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            if seen:
                new = new.join(reduce(DataFrame.unionByName, seen), ["a", "b"], "left_anti")
            near = keep(new.join(x, F.col("a") == F.col("x.g")).join(y, F.col("b") == F.col("y.g")).where(F.expr(_sieve("x", "y", info))).select("a", "b"))
            seen.append(near)
            both = near.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
            return cut_lineage(both.select("a", "b", "text_a", "text_b").mapInArrow(
                lambda batches: _confirm(batches, width, PERCENT), "a bigint, b bigint"))

        early = [place for place, (tree, _, _) in enumerate(paths()[FIRST - 1]) if tree < EARLY]
        with stages_removed(spark) as keep:
            links = confirmed(_stars(nodes.where(F.col("path").isin(early)).withColumn("root", F.col("g"))), keep)
            roots = keep(components(links).toDF("g", "root"))
        before = float("inf")
        for level in range(FIRST, DEPTH + 1):
            with stages_removed(spark) as keep:
                members = _open(nodes, roots)
                large = F.col("members") > SMALL
                # Each row stands for its node's members, so this bounds the comparisons in all large nodes.
                compared = members.where(large).agg(F.sum("members")).first()[0] or 0
                last = level == DEPTH or compared <= few or compared > PAYS * before
                before = compared
                pairs = _crossed(members if last else members.where(~large), info)
                found = confirmed(pairs if last else pairs.unionByName(_stars(members.where(large))), keep)
                if not found.isEmpty():
                    # The roots stand for all links found before.
                    roots = keep(components(found.unionByName(roots.toDF("a", "b"))).toDF("g", "root"))
                if last:
                    break
                below = _open(members.where(large).drop("root"), roots)
                children = below.select("path", "g").distinct().join(coordinates, "g").select("path", "g", "mins")
                nodes = keep(_shared(children.mapInArrow(lambda batches, level=level: _next_nodes(batches, level), NODE_FIELDS)))
        return roots

    def labels(self) -> DataFrame:
        """Per row: doc_id, u, v, n, component_id."""
        rooted = self.groups.select("gid", "g", "least").join(self.roots(), "g", "left")
        rooted = cut_lineage(rooted.select("gid", "least", F.coalesce("root", "g").alias("root")))
        lowest = cut_lineage(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
        named = cut_lineage(rooted.join(lowest, "root").select("gid", "component_id"))
        return self.signed.select("doc_id", "u", "v", "n", "gid").join(named, "gid", "left").select(
            "doc_id", "u", "v", "n", F.when(F.col("gid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (least id that links reach), kept (the id is the component's)."""
    return NearDuplicates(docs, text, key, width).labels().select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.expr("doc_id <=> component_id").alias("kept"))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay: one per component, and one of each set of repeated rows."""
    row = fresh(docs, "u", "v")
    kept = NearDuplicates(docs, text, key, width).labels().where("doc_id <=> component_id").select(
        *[F.col(own).alias(name) for own, name in zip("uv", row)]).distinct()
    return named_rows(docs, key, text, *row).join(cut_lineage(kept), row).dropDuplicates(row).select(*[quoted(c) for c in docs.columns])
