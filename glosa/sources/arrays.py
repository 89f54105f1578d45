"""JSON array files of any size, cut at record borders.

A file that holds one array can be larger than a task's memory.  It is scanned as text whose
lines end at closing braces, which splits anywhere, and the pieces are put together to records:

1. Whether a piece starts inside a string follows from the number of quotes before it; how many braces
   are open, from the braces outside strings.  Both are running sums over the pieces of a file.
2. They are summed per split of a file first, then over the splits, then inside each split, so no task
   sees more than one split of text.
3. A record ends where the braces return to the depth of the array's elements.  Nearly all records are
   one piece; records with braces in strings or with nested objects are joined from several, also
   across splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as Win
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _quotes(value: Column) -> Column:
    """Quotes that no backslash takes away."""
    plain = F.regexp_replace(value, r"(?s)\\.", "")
    return (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))).cast("bigint")


def _opened(value: Column, inside: Column) -> Column:
    """Opening braces outside strings, of a piece that starts inside or outside a string."""
    whole = F.when(inside, F.concat(F.lit('"'), value)).otherwise(value)
    bare = F.regexp_replace(whole, r'(?s)"(?:[^"\\]|\\.)*+(?:"|$)', "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit("{"), F.lit("")))).cast("bigint")


def _running(pieces: DataFrame, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the pieces of the file up to and with this one."""
    splits = pieces.groupBy("file", "block").agg(F.sum(value).alias("_s"))
    before = Win.partitionBy("file").orderBy("block").rowsBetween(Win.unboundedPreceding, -1)
    starts = splits.select("file", "block", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_start"))
    inside = Win.partitionBy("file", "block").orderBy("pos").rowsBetween(Win.unboundedPreceding, 0)
    return pieces.join(starts, ["file", "block"]).withColumn(out, F.col("_start") + F.sum(value).over(inside)).drop("_start")


def array_records(spark: SparkSession, path: str, schema: StructType, wrapper: str = "comments") -> DataFrame:
    """(file, seq, record): the objects of all JSON array files below ``path``, numbered inside their file.

    A file holds ``[...]``, or ``{wrapper: [...]}``, or several such arrays one after the other.  Objects may hold
    other objects.  Text that is no object of the array is left out; an object that does not parse has null fields.
    """
    pieces = spark.read.option("lineSep", "}").text(path, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), "value")
    pieces = _running(pieces.withColumn("q", _quotes(F.col("value"))), "q", "quotes")
    pieces = pieces.withColumn("inside", (F.col("quotes") - F.col("q")) % 2 == 1)
    # A piece ends at a closing brace, unless that stands in a string.
    closes = F.when(F.col("quotes") % 2 == 0, 1).otherwise(0).cast("bigint")
    pieces = pieces.withColumn("step", _opened(F.col("value"), F.col("inside")) - closes).withColumn("closes", closes == 1)
    pieces = _running(pieces, "step", "depth")
    wrapped = F.max(F.when((F.col("block") == 0) & F.ltrim("value").rlike(r'^\s*\{\s*"' + wrapper + r'"\s*:\s*\['), 1).otherwise(0))
    base = pieces.where("block = 0").groupBy("file").agg(wrapped.cast("bigint").alias("base"))
    pieces = pieces.join(base, "file").withColumn("ends", F.when(F.col("closes") & (F.col("depth") == F.col("base")), 1).otherwise(0).cast("bigint"))
    pieces = _running(pieces, "ends", "upto").withColumn("seq", F.col("upto") - F.col("ends"))
    records = pieces.groupBy("file", "seq").agg(
        F.array_sort(F.collect_list(F.struct("block", "pos", "value"))).alias("parts"), F.max("ends").alias("whole")).where("whole = 1")
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "}")
    text = F.regexp_replace(text, r'^[\s,\[\]]*(?:\}?[\s,\[\]]*\{\s*"' + wrapper + r'"\s*:\s*\[[\s,\[\]]*)?', "")
    return records.select("file", "seq", F.concat(text, F.lit("}")).alias("_t")).where(F.col("_t").startswith("{")).select(
        "file", F.col("seq").cast("bigint").alias("seq"), F.from_json("_t", schema).alias("record"))


def write_arrays(rows: DataFrame, path: str, group: str, chunk: Column) -> None:
    """Array files in one folder per ``group``: the rows of every (group, chunk) are one array."""
    names = [c for c in rows.columns if c != group]
    arrays = rows.groupBy(group, chunk.alias("_chunk")).agg(F.to_json(F.collect_list(F.struct(*names))).alias("value"))
    arrays.select(group, "value").write.partitionBy(group).text(path)
