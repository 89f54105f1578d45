"""Document store on Parquet: two tables, ``games`` and ``reviews``, in buckets of the item id.

Inside a bucket, reviews are partitioned by category and clustered by item, so item filters
are answered by the bucket and file statistics.  One folder per item would mean millions of
folders at scale.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glosa.operators.merge import keep_last
from glosa.operators.skew import first_n
from glosa.schemas import GAME_METADATA
from glosa.sources.buckets import BucketStore, Table

REVIEW_COLUMNS = "game_id bigint, review_id bigint, username string, rating double, comment string, " \
    "ts bigint, lang string, clean_text string, tokens array<string>, features map<string,double>, category string"


class ReviewStore:
    """Save, load, summarise and clear a corpus under one path.

    A save rewrites only the buckets of the saved items (``BucketStore``).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        games, reviews = StructType.fromDDL(self.game_schema), StructType.fromDDL(REVIEW_COLUMNS)
        self.files = BucketStore(spark, path, {
            "games": Table(games, "game_id", order=("game_id",)),
            "reviews": Table(reviews, "game_id", ("category",), ("game_id", "review_id")),
        }, buckets)

    @property
    def game_schema(self) -> str:
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in GAME_METADATA.fields)
        return f"game_id bigint, {fields}, num_reviews bigint, categories_count map<string,bigint>"

    def games(self) -> DataFrame:
        return self.files.read("games")

    def reviews(self) -> DataFrame:
        return self.files.read("reviews")

    def save(self, documents: DataFrame, games: DataFrame) -> int:
        """Upsert items by id and replace the reviews of the saved items; saving twice changes nothing.

        An item is kept with its number of reviews, in all and per category (those without one are in the first
        number only).  Returns the store's new version.
        """
        schemas = {name: table.schema for name, table in self.files.tables.items()}
        have = set(documents.columns)
        new = documents.select(*[
            (F.col("label") if f.name == "category" and "label" in have else F.col(f.name) if f.name in have else F.lit(None))
            .cast(f.dataType).alias(f.name) for f in schemas["reviews"].fields
        ])
        incoming = games.drop("num_reviews", "categories_count").join(saved_counts(new), "game_id", "left").withColumn(
            "num_reviews", F.coalesce("num_reviews", F.lit(0).cast("bigint"))).withColumn(
            "categories_count", F.coalesce("categories_count", F.map_from_arrays(
                F.array().cast("array<string>"), F.array().cast("array<bigint>"))))
        incoming = incoming.select(*[
            (F.col(f.name) if f.name in incoming.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas["games"].fields
        ])
        ids = incoming.select("game_id").unionByName(new.select("game_id")).distinct()

        def change(held: dict[str, DataFrame]) -> dict[str, DataFrame]:
            kept = held["games"].join(incoming.select("game_id"), "game_id", "left_anti")
            return {"games": kept.unionByName(incoming),
                    "reviews": held["reviews"].join(ids, "game_id", "left_anti").unionByName(new)}

        return self.files.update(self.files.touched(ids), change)

    def load(
        self, game_ids: list[int] | None = None, categories: list[str] | None = None, limit: int | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """(games, reviews) with pushed-down filters; ``limit`` counts per item, in review order."""
        manifest = self.files.manifest()
        buckets = sorted({self.files.bucket_number(i) for i in game_ids}) if game_ids else None
        games, reviews = (self.files.read(name, manifest, buckets) for name in ("games", "reviews"))
        if game_ids:
            games = games.filter(F.col("game_id").isin(*game_ids))
            reviews = reviews.filter(F.col("game_id").isin(*game_ids))
        if categories:
            reviews = reviews.filter(F.col("category").isin(*categories))
        reviews = reviews.join(games.select("game_id"), "game_id", "left_semi")
        if limit:
            reviews = first_n(reviews, ["game_id"], limit, "review_id")
        return games, reviews

    def stats(self) -> DataFrame:
        return category_totals(self.reviews())

    def reviews_by_game(self, game_id: int, category: str | None = None, limit: int | None = None) -> DataFrame:
        conditions = [F.col("game_id") == game_id]
        if category is not None:
            conditions.append(F.col("category") == category)
        found = self.files.read("reviews", buckets=[self.files.bucket_number(game_id)]).filter(reduce(lambda a, b: a & b, conditions))
        return found.orderBy("review_id").limit(limit) if limit else found

    def game_metadata(self, game_id: int) -> DataFrame:
        return self.files.read("games", buckets=[self.files.bucket_number(game_id)]).filter(F.col("game_id") == game_id)

    def clear(self) -> None:
        """Commit empty tables; earlier versions stay readable."""
        self.files.clear()

    def export_json(self, path: str, per_record: int | None = None) -> None:
        from glosa.sources.writers import REVIEWS_PER_RECORD, write_corpus

        games, reviews = self.load()
        write_corpus(
            reviews.withColumnRenamed("category", "label"), games.drop("num_reviews", "categories_count"), path,
            per_record=per_record or REVIEWS_PER_RECORD,
        )

    def import_json(self, path: str) -> None:
        from glosa.sources.readers import read_corpus

        games, documents = read_corpus(self.spark, path)
        made = F.xxhash64("game_id", "seq", "username", "ts", "comment")
        self.save(documents.withColumn("review_id", F.coalesce("review_id", made)), games)


def saved_counts(reviews: DataFrame) -> DataFrame:
    """Per item: ``num_reviews`` and ``categories_count``, a map of the categories present."""
    each = reviews.groupBy("game_id", "category").agg(F.count(F.lit(1)).alias("n"))
    entries = F.collect_list(F.when(F.col("category").isNotNull(), F.struct("category", "n")))
    return each.groupBy("game_id").agg(
        F.sum("n").alias("num_reviews"), F.map_from_entries(F.array_sort(entries)).alias("categories_count"))


def category_totals(reviews: DataFrame, category: str = "category") -> DataFrame:
    """Count and mean rating per category, and of everything, in one pass."""
    return reviews.rollup(category).agg(
        F.count(F.lit(1)).alias("n"), F.avg("rating").alias("mean_rating"),
        F.grouping(category).cast("int").alias("is_total"),
    )


def upsert_stats(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows and keep the last one per item; any new row follows every old one, whatever its ``seq``."""
    given = F.col("seq").cast("bigint") if "seq" in new.columns else F.lit(0).cast("bigint")
    old = existing.withColumn("_seq", F.struct(F.lit(False).alias("fresh"), F.lit(0).cast("bigint").alias("seq")))
    fresh = new.withColumn("_seq", F.struct(F.lit(True).alias("fresh"), given.alias("seq")))
    both = old.unionByName(fresh, allowMissingColumns=True)
    return keep_last(both, "game_id", "_seq").drop("_seq")
