"""Exact ranks and running sums that no hot group can overload.

A window over one group sorts that group in one task.  Selection by rank needs no sort:
it is a radix search.  The order is cut into digits, the most significant first.  One
aggregation counts the rows of every (group, first digit) map-side; only rows whose digit
a cut falls into go on to the next digit, as bare (group, key) rows; what is left after the
last digit is ranked.  That gives the key at every cut, and one pass over the rows compares
each with the keys of its group.  The input is read three times, whatever the number of cuts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from glosa.session import cut_lineage

KEY_SPACE = 1 << 32
DEFAULT_BUCKETS = 4096


def portable_key(row_id: Column, seed: int = 42) -> Column:
    """Multiplicative hash of an integer id into [0, 2^32); easy to repeat in any SQL engine."""
    reduced = F.pmod(row_id, F.lit(1 << 31))
    return F.pmod(reduced * F.lit(2654435761) + F.lit(seed), F.lit(KEY_SPACE))


def hashed_key(*columns: Column, seed: int = 42) -> Column:
    """64-bit hash of any columns, reduced to [0, 2^32)."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(KEY_SPACE))


def key_bucket(key: Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """Order-keeping bucket of a key from [0, 2^32)."""
    return F.floor(key / F.lit(KEY_SPACE // buckets)).cast("bigint")


def block_of(row_id: Column, width: int) -> Column:
    """Order-keeping block of a unique non-negative id: at most ``width`` (a power of two) rows each."""
    return F.shiftright(row_id, width.bit_length() - 1)


def id_blocks(df: DataFrame, row_id: str, bits: int = 16) -> Column:
    """Order-keeping block of a non-negative id, about ``2**bits`` blocks over the ids present.

    The block width follows the largest id, so dense and hashed ids both give
    blocks that are few enough to list per group and small enough to sort.  The largest id
    is a scalar subquery of the plan; building the plan runs nothing.
    """
    top = F.coalesce(df.agg(F.max(row_id).cast("bigint")).scalar(), F.lit(0).cast("bigint"))
    return F.call_function("shiftright", F.col(row_id), F.greatest(F.length(F.bin(top)) - bits, F.lit(0)))


def key_digits(key: Column) -> list[Column]:
    """Two digits of twelve bits of a key from [0, 2^32)."""
    key = key.cast("bigint")
    return [F.shiftright(key, 20), F.shiftright(key, 8).bitwiseAND(F.lit(4095))]


def id_digits(row_id: Column) -> list[Column]:
    """Three digits of any 64-bit id: its magnitude with the ten bits behind the leading one, then twice 16 bits.

    Small and hashed ids both spread over the first digit; the digits of a negative id are
    those of its complement, negated.
    """
    row_id = row_id.cast("bigint")
    size = F.when(row_id < 0, F.bitwise_not(row_id)).otherwise(row_id)
    top = F.length(F.bin(size))

    def bits(shift: Column, mask: int) -> Column:
        return F.call_function("shiftright", size, F.greatest(shift, F.lit(0))).bitwiseAND(F.lit(mask).cast("bigint"))

    digits = [top.cast("bigint") * 1024 + bits(top - 11, 1023), bits(top - 27, 65535), bits(top - 43, 65535)]
    return [F.when(row_id < 0, -1 - d).otherwise(d) for d in digits]


def _join(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``names`` that lets null match null and keeps one copy of the keys."""
    renamed = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_right_{n}")) for n in names])
    return left.join(renamed, same, how).drop(*[f"_right_{n}" for n in names])


Quotas = DataFrame | Callable[[DataFrame], DataFrame]


def _at_cut(counts: DataFrame, wanted: DataFrame, names: list[str], digit: str) -> DataFrame:
    """(names, _cut, _want, digit): the digit that holds the row of rank ``_want``, and the rank among its rows."""
    upto = Win.partitionBy(*names).orderBy(digit).rowsBetween(Win.unboundedPreceding, 0)
    running = counts.withColumn("_upto", F.sum("_n").over(upto))
    both = running if "_want" in running.columns else _join(running, wanted, names)
    inside = both.filter((F.col("_upto") - F.col("_n") < F.col("_want")) & (F.col("_want") <= F.col("_upto")))
    out = [*[n for n in names if n != "_cut"], "_cut", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_want"), digit]
    return inside.select(*out)


def cut_places(
    df: DataFrame, groups: list[str], quotas: Quotas, key: Column, tie: Column, digits: list[Column]
) -> DataFrame:
    """``quotas`` with ``edges``: for every cut inside its group, the key and tie of the row of that rank.

    ``quotas`` holds one row per group: the group columns and ``cuts``, an array of
    ranks; it may be a function that makes this table from the counted rows ``n`` of
    every group, which then cost no pass of their own.  Rows are ordered by ``key``, then
    ``tie``; ``digits`` follow that order, each among rows equal in the ones before.
    Cuts at or beyond the size of a group have no edge.
    """
    names = [f"_d{i}" for i in range(len(digits))]
    rows = df.select(*groups, *[d.alias(n) for d, n in zip(digits, names)], key.alias("_k"), tie.alias("_t"))
    counts = cut_lineage(rows.groupBy(*groups, "_d0").agg(F.count(F.lit(1)).alias("_n")))
    sizes = counts.groupBy(*groups).agg(F.sum("_n").alias("n"))
    table = quotas(sizes) if callable(quotas) else quotas
    cuts = _join(table.select(*groups, F.explode(F.array_distinct("cuts")).alias("_cut")), sizes, groups)
    wanted = cuts.filter("_cut > 0 AND _cut < n").select(*groups, "_cut", F.col("_cut").alias("_want"))
    found = _at_cut(counts, wanted, groups, "_d0")
    narrow = cut_lineage(_join(rows, found, [*groups, "_d0"]).drop("_d0"))
    of_cut = [*groups, "_cut"]
    for i, digit in enumerate(names[1:], 1):
        counted = narrow.groupBy(*of_cut, "_want", digit).agg(F.count(F.lit(1)).alias("_n"))
        found = _at_cut(counted, None, of_cut, digit).withColumnRenamed("_want", "_next")
        narrow = _join(narrow, found, [*of_cut, digit]).drop(digit, "_want").withColumnRenamed("_next", "_want")
        if i + 1 < len(names):
            narrow = cut_lineage(narrow)
    rank = F.row_number().over(Win.partitionBy(*of_cut).orderBy("_k", "_t"))
    edges = narrow.withColumn("_r", rank).filter("_r = _want").groupBy(*groups).agg(
        F.collect_list(F.struct("_cut", "_k", "_t")).alias("edges"))
    return _join(table, edges, groups, "left")


def beyond(cut: Column, key: Column, tie: Column, edges: Column) -> Column:
    """The row's rank in its group is above ``cut``."""
    def behind(e: Column) -> Column:
        return (e["_cut"] == cut) & ((e["_k"] < key) | ((e["_k"] == key) & (e["_t"] < tie)))

    return (cut <= 0) | F.coalesce(F.exists(edges, behind), F.lit(False))


def assign_slots(
    df: DataFrame,
    groups: list[str],
    quotas: Quotas,
    key: Column,
    tie: Column,
    digits: Column | list[Column],
    out: str = "slot",
) -> DataFrame:
    """Number each row by the quota its rank within the group falls into.

    ``quotas`` (see ``cut_places``) holds cumulative ranks, so cuts [10, 15] give slot 0 to
    the first ten rows, 1 to the next five, 2 to the rest.  Rows of groups without a quota
    are dropped; rows equal in ``key`` and ``tie`` share a slot.
    """
    digits = digits if isinstance(digits, list) else [digits]
    places = cut_places(df, groups, quotas, key, tie, digits).select(
        *groups, F.col("cuts").alias("_cuts"), F.col("edges").alias("_edges"))
    slot = F.size(F.filter("_cuts", lambda c: beyond(c, key, tie, F.col("_edges"))))
    return _join(df, places, groups).withColumn(out, slot).drop("_cuts", "_edges")


def first_n(df: DataFrame, groups: list[str], n: int, row_id: str) -> DataFrame:
    """The first ``n`` rows of every group in the order of ``row_id``."""
    cuts = F.array(F.lit(n).cast("bigint")).alias("cuts")
    key = F.col(row_id)
    slots = assign_slots(df, groups, lambda sizes: sizes.select(*groups, cuts), key, key, id_digits(key), "_slot")
    return slots.filter("_slot = 0").drop("_slot")


def prefix_sums(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before this one in the order of a unique column, for a table of any size.

    Rows are range-partitioned and written with their partition number, so the sums survive a
    lost executor; every partition sums its own rows, and the totals of the partitions before it are
    added.  Only those totals, one row per partition, are seen by one task.
    """
    placed = cut_lineage(df.repartitionByRange(F.col(order)).withColumn("_p", F.spark_partition_id()))
    totals = placed.groupBy("_p").agg(F.sum(value).alias("_s"))
    before = Win.orderBy("_p").rowsBetween(Win.unboundedPreceding, 0)
    starts = totals.select("_p", (F.sum("_s").over(before) - F.col("_s")).alias("_start"))
    inside = Win.partitionBy("_p").orderBy(order).rowsBetween(Win.unboundedPreceding, 0)
    own = F.sum(value).over(inside) - F.col(value)
    return placed.join(F.broadcast(starts), "_p").withColumn(out, F.col("_start") + own).drop("_p", "_start")


def running_offset(
    df: DataFrame, group: str, row_id: str, value: str, out: str, bits: int = 16, per_group: bool = False
) -> DataFrame:
    """Sum of ``value`` over all rows before this one, in the order (group, row_id).

    Three levels: inside a block of ids, over the blocks of a group,
    over the groups (by ``prefix_sums``, in parallel); ``per_group`` leaves the last
    out and starts every group at 0.
    """
    # A struct equals one with the same nulls, so the join and the window share one shuffle of the rows.
    block = F.struct(group, "_blk")
    rows = df.withColumn("_blk", id_blocks(df, row_id, bits))
    blocks = rows.groupBy(group, "_blk").agg(F.sum(value).alias("_s"))
    in_group = Win.partitionBy(group).orderBy("_blk").rowsBetween(Win.unboundedPreceding, 0)
    blocks = blocks.withColumn("_block_off", F.sum("_s").over(in_group) - F.col("_s"))
    if per_group:
        starts = blocks.select(block.alias("_blk"), F.col("_block_off").alias("_start"))
    else:
        totals = blocks.groupBy(group).agg(F.sum("_s").alias("_g"))
        totals = prefix_sums(totals, group, "_g", "_group_off").drop("_g")
        starts = _join(blocks, totals, [group]).select(
            block.alias("_blk"), (F.col("_block_off") + F.col("_group_off")).alias("_start")
        )
    in_block = Win.partitionBy("_blk").orderBy(row_id).rowsBetween(Win.unboundedPreceding, 0)
    return (
        rows.withColumn("_blk", block).join(starts, "_blk")
        .withColumn(out, F.sum(value).over(in_block) - F.col(value) + F.col("_start"))
        .drop("_blk", "_start")
    )


def chunk_of(df: DataFrame, group: str, row_id: str, width: int, out: str) -> DataFrame:
    """Number the chunks of ``width`` rows that a group, in id order, falls into; ids may be hashes."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    numbered = running_offset(ones, group, row_id, "_one", "_nr", per_group=True)
    return numbered.withColumn(out, F.floor(F.col("_nr") / width)).drop("_one", "_nr")
