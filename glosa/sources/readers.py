"""Readers of review, metadata, table and corpus files.

A directory of per-item files is one scan with the id taken from the file name,
not one open per id.  File position (``seq``) comes from the array index, so
first-wins and last-wins rules do not depend on task order.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from glosa import schemas as Sc
from glosa.functions.text import language_code, number_or_null
from glosa.sources.arrays import array_records
from glosa.sources.writers import ITEM_FOLDERS, item_folder_number

FILE_ID = r"_(\d+)_[a-z]+\.json$"


def _or_empty(spark: SparkSession, schema: StructType, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON documents, one per file; an absent path gives an empty frame."""
    return _or_empty(
        spark, schema, lambda: spark.read.schema(schema).option("multiLine", True).json(path)
    )


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header; an absent path gives an empty frame."""
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).option("header", True).csv(path))


def file_id() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), FILE_ID, 1).try_cast("bigint")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Item metadata files; the sentinel ``N/A`` becomes null and numbers are typed later."""
    raw = read_json(spark, path, Sc.RAW_METADATA)
    text = [f.name for f in Sc.RAW_METADATA.fields if f.dataType.typeName() == "string"]
    return raw.select(
        F.col("id").alias("game_id"),
        *[F.nullif(F.col(c), F.lit("N/A")).alias(c) for c in text],
        "publishers", "designers", "artists", "classifications",
    )


def reviews_of(text: Column) -> Column:
    """Reviews of a file that holds either a bare list or ``{"comments": [...]}``."""
    listed = ArrayType(Sc.RAW_REVIEW)
    wrapped = StructType().add("comments", listed)
    return F.when(
        F.ltrim(text).startswith("{"), F.from_json(text, wrapped)["comments"]
    ).otherwise(F.from_json(text, listed))


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """(game_id, seq, username, rating, comment, ts) of every review file below ``path``.

    Files hold a bare list or ``{"comments": [...]}`` and may be of any size; the item is in the name of the file, or of
    its folder.  ``seq`` counts the records of a file.
    """
    schema = StructType().add("file", "string").add("seq", "long").add("record", Sc.RAW_REVIEW)
    records = _or_empty(spark, schema, lambda: array_records(spark, path, Sc.RAW_REVIEW))
    item = F.coalesce(*[F.regexp_extract("file", p, 1).try_cast("bigint") for p in (FILE_ID, r"/game_id=(\d+)/[^/]*$")])
    return records.select(
        item.alias("game_id"), "seq", "record.username", "record.rating", "record.comment", F.col("record.timestamp").alias("ts"))


def read_items(spark: SparkSession, path: str, schema: StructType, game_ids: list[int] | None = None, folders: int = ITEM_FOLDERS) -> DataFrame:
    """Rows written by :func:`glosa.sources.writers.write_per_game`, of all items or of some, whose folders alone are read."""
    rows = _or_empty(spark, StructType(list(schema.fields)).add("folder", "integer"),
                     lambda: spark.read.schema(StructType(list(schema.fields)).add("folder", "integer")).json(path))
    if game_ids is not None:
        rows = rows.filter(F.col("folder").isin(*{item_folder_number(i, folders) for i in game_ids}) & F.col("game_id").isin(*game_ids))
    return rows.drop("folder")


def read_corpus(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(games, documents) of a corpus written by :func:`glosa.sources.writers.write_corpus`.

    ``raw_text`` wins over ``comment``; the item id comes from the parent record;
    unparsable ids become null and a missing language ``en``.  An item is one row of
    ``games`` however many records it spans, and ``seq`` counts on across its records.
    """
    saved = read_json_lines(spark, path, Sc.SAVED_GAME)
    games = saved.groupBy("game_id").agg(F.first("metadata", ignorenulls=True).alias("metadata")).select("game_id", "metadata.*")
    start = F.coalesce("first", F.lit(0).cast("bigint"))
    documents = saved.select("game_id", start.alias("start"), F.posexplode("reviews").alias("seq", "r")).select(
        F.coalesce("game_id", F.col("r.game_id").try_cast("bigint")).alias("game_id"),
        (F.col("start") + F.col("seq")).alias("seq"),
        F.col("r.review_id").alias("review_id"),
        F.col("r.username").alias("username"),
        number_or_null(F.col("r.rating")).alias("rating"),
        F.coalesce("r.raw_text", "r.comment").alias("comment"),
        F.col("r.timestamp").alias("ts"),
        F.col("r.category").alias("label"),
        F.col("r.clean_text").alias("clean_text"),
        language_code(F.col("r.language")).alias("lang"),
        F.coalesce("r.processed.tokens_no_stopwords", F.array().cast("array<string>")).alias("tokens"),
        F.col("r.processed.linguistic_features").alias("features"),
        F.col("r.is_augmented").alias("is_augmented"),
    )
    return games, documents


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON record per line; splittable unless the files are compressed."""
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path))
