"""The given tables, and small helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosa.session import shuffles_removed, stage_dir

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the columns whose names an operator is about to give."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` does not have, for columns an operator adds for a while."""
    taken, names = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = f"_{stem}"
        while name in taken:
            name = f"_{name}"
        names.append(name)
    return names


def named_rows(df: DataFrame, key: str, text: str, u: str, v: str) -> DataFrame:
    """``df`` with two columns whose 96 bits name a row by its key and text."""
    return df.select("*", F.xxhash64(quoted(key), quoted(text)).alias(u), F.hash(quoted(text), quoted(key)).alias(v))


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written to the shared folder in one bucket of ``key`` per shuffle partition.

    Groups and joins by ``key`` read the buckets where they lie and shuffle only the other side.  The name in the
    catalog is gone at once; the frame returned keeps the files and their buckets.
    """
    spark = df.sparkSession
    name = f"glosa_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_removed(spark):
        df.write.bucketBy(parts, key).option("path", stage_dir(spark, "buckets")).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table
