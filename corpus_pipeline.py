"""The corpus pipeline: quality, near-duplicates, exact repeats, decontamination, packing.

Each stage reads the documents its predecessor kept and, but for the last one, returns the
columns of ``documents``:

1. quality: documents that the trusted-text model rejects go;
2. near-duplicates: one document of each group stays (5-word shingles, Jaccard 0.8);
3. repeats: bytes under a repeated 200-byte string leave the texts (a character that loses a byte goes whole);
   every document keeps its row, ``n_chars`` follows the text;
4. decontamination: documents that hold a benchmark item go;
5. packing: pieces of power-of-two length.

Defined results: a row with null or empty text is not scored and goes with the first stage; rows equal in id and
text are one document, of which the second stage leaves one; a document without an id is judged like any other
and stays apart from those with one; of equal texts that with the least id stays; an empty table, or empty labels
or benchmark tables, give the rows that are left (none, or all); the columns of ``documents`` keep their names, and
other columns of the table are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosa.llm import decontaminate, neardup, ngram_quality, packing, suffixes
from glosa.llm.queries import tokenizer_path, trusted
from glosa.llm.tables import read
from glosa.session import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_quality.keep_good(docs, trusted(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = suffixes.remove_repeats(docs, as_text=True)
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept")).otherwise(F.col("text"))
    return done.withColumn("text", text).withColumn(
        "n_chars", F.when(cut, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats),
    ("decontamination", decontamination), ("packing", pack),
]
#: Model scores, components and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
