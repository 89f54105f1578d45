"""Incremental jobs: review files as a stream, stats as an upsert sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from glosa.sources.buckets import BucketStore, Table
from glosa.sources.store import upsert_stats

DEDUP_KEYS = ("username", "rating", "ts")


def stream_reviews(spark: SparkSession, path: str, schema: StructType, fmt: str = "json",
                   files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def drop_repeats(stream: DataFrame, keys: tuple[str, ...] = DEDUP_KEYS, event_time: str = "event_time",
                 delay: str = "7 days") -> DataFrame:
    """Suppress repeats of ``keys``; state is dropped once the watermark passes ``delay``."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def start_dedup(stream: DataFrame, target: str, checkpoint: str, **options) -> StreamingQuery:
    """Write de-duplicated reviews to Parquet and stop when the input is used up."""
    with_time = stream.withColumn("event_time", F.timestamp_seconds("ts"))
    return (
        drop_repeats(with_time, **options)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stats_files(spark: SparkSession, target: str, schema: StructType, buckets: int = 64) -> BucketStore:
    return BucketStore(spark, target, {"stats": Table(schema, "game_id", order=("game_id",))}, buckets)


def start_stats_upsert(stream: DataFrame, target: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Keep-last upsert of stats rows; a batch rewrites only the buckets of its items.

    The number of the batch is committed with its rows, so a replayed batch is left out.
    """
    schema = StructType(list(stream.schema.fields))

    def apply(batch: DataFrame, batch_id: int) -> None:
        files = stats_files(batch.sparkSession, target, schema, buckets)
        if files.manifest().tags.get("batch", -1) >= batch_id:
            return
        rows = batch.persist()
        try:
            files.update(files.touched(rows.select("game_id")), lambda held: {"stats": upsert_stats(held["stats"], rows)}, {"batch": batch_id})
        finally:
            rows.unpersist()

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_stats(spark: SparkSession, target: str, schema: StructType, batch_id: int | None = None, buckets: int = 64) -> DataFrame:
    """The stats as of a batch, or as they are now."""
    files = stats_files(spark, target, schema, buckets)
    for version in reversed(files.versions()) if batch_id is not None else ():
        manifest = files.manifest(version)
        if manifest.tags.get("batch") == batch_id:
            return files.read("stats", manifest)
    return files.read("stats")
