"""Connected components of a link table by alternating large and small stars.

Both steps keep connectivity and shorten paths; after about log2(longest path) rounds
every vertex points at the least vertex of its component.  A hub's links are spread by
adaptive skew joins against a stored table of minima, and every round is written to the
shared folder, so nothing depends on one executor or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosa.session import cut_lineage, stages_removed


#: Links for one task and file of a round.
LINKS = 2000


def _minima(links: DataFrame, own: bool, parts: int) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return cut_lineage((least.select("a", F.least("a", "m").alias("m")) if own else least).coalesce(parts))


def _large(links: DataFrame, parts: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_minima(both, True, parts), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame, parts: int) -> DataFrame:
    down = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().coalesce(parts))
    least = _minima(down, False, parts)
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    # Repeats among moved links go in the next round; at the end none are moved.
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> (a, b) with b the least vertex of a's component, for every a that is not the least itself."""
    spark = links.sparkSession
    with stages_removed(spark) as keep_last:
        now = cut_lineage(links.select("a", "b").where("a <> b"))
        before, state = None, _state(now)
        while state != before and state[0]:
            # Few links are few tasks and files.
            parts = 1 + state[0] // LINKS
            with stages_removed(spark) as keep:
                now = keep(_small(_large(now, parts), parts).coalesce(parts))
            before, state = state, _state(now)
        return keep_last(now)
