"""Joins and merges of reviews and item metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosa.functions.text import THING_TAG, merge_key, number_or_null

SOURCES = ("combined", "crawler", "api")


def _side(df: DataFrame, source: str) -> DataFrame:
    return df.select(
        "game_id",
        F.coalesce("username", F.lit("unknown")).alias("username"),
        number_or_null(F.col("rating")).alias("rating"),
        F.coalesce("comment", F.lit("")).alias("comment"),
        (F.col("ts") if source == "crawler" else F.lit(None)).cast("bigint").alias("ts"),
        F.col("seq").cast("bigint").alias("seq"),
        F.lit(source).alias("src"),
    )


def merge_reviews(
    crawler: DataFrame, api: DataFrame, source: str = "combined", names: Column | None = None
) -> DataFrame:
    """Merge two review sources on (item, user, cleaned comment).

    Inputs have game_id, username, rating, comment, ts, seq, where ``seq`` is
    the position in the file.  Unrated API rows are dropped.  Among crawler rows
    of one key the last wins and the first gives the position.  A matching API
    row lends its comment when that holds a colon, the last such row winning;
    an unmatched key takes the first API row, without a timestamp.

    All rules are max/min-by aggregates, so the merge is one aggregation with
    map-side combining: a key shared by very many rows collapses before the
    shuffle, which a full outer join could not do.
    """
    if source not in SOURCES:
        raise ValueError(f"source must be one of {SOURCES}")
    left = _side(crawler, "crawler")
    right = _side(api, "api").filter(F.col("rating").isNotNull())
    if source == "crawler":
        return left.drop("src")
    if source == "api":
        return right.drop("src")
    rows = left.unionByName(right).withColumn("_key", merge_key(F.col("username"), F.col("comment")))
    is_crawler = F.col("src") == "crawler"
    colon = (F.col("src") == "api") & F.col("comment").contains(":")
    record = F.struct("username", "rating", "comment", "ts")

    def seq_when(cond: Column) -> Column:
        return F.when(cond, F.col("seq"))

    first_api = F.struct(F.col("seq").alias("seq"), record.alias("row"))
    merged = rows.groupBy(
        "game_id", F.col("_key.ukey").alias("ukey"), F.sha2(F.col("_key.ckey"), 256).alias("ckey")
    ).agg(
        F.max_by(record, seq_when(is_crawler)).alias("c"),
        F.min(seq_when(is_crawler)).alias("c_pos"),
        F.min_by(first_api, seq_when(~is_crawler)).alias("a"),
        F.max_by("comment", seq_when(colon)).alias("colon"),
    )
    inserted = F.col("c").isNull()
    return merged.select(
        "game_id",
        F.coalesce("c.username", "a.row.username").alias("username"),
        F.when(inserted, F.col("a.row.rating")).otherwise(F.col("c.rating")).alias("rating"),
        F.coalesce("colon", F.when(inserted, F.col("a.row.comment")).otherwise(F.col("c.comment"))).alias("comment"),
        F.when(~inserted, F.col("c.ts")).alias("ts"),
        F.when(inserted, F.lit(1)).otherwise(F.lit(0)).alias("origin"),
        F.when(inserted, F.col("a.seq")).otherwise(F.col("c_pos")).alias("seq"),
    )


def distinct_crawl(df: DataFrame) -> DataFrame:
    """One row per (item, user, rating, timestamp), the first in file order."""
    keys = [c for c in ("game_id", "username", "rating", "ts") if c in df.columns]
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), "seq").alias("r"))
    return picked.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*df.columns)


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` per key, by aggregation instead of a window."""
    return _pick(df, key, order, F.max_by)


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    return _pick(df, key, order, F.min_by)


def _pick(df: DataFrame, key: str, order: str, by) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(by(F.struct(*rest), F.col(order)).alias("r"))
    return picked.select(key, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*df.columns)


RANK_COLUMNS = [
    "overall_rank", "strategygames_rank", "thematic_rank", "familygames_rank", "partygames_rank",
    "cgs_rank", "childrensgames_rank", "abstracts_rank", "wargames_rank",
]
INFO_COLUMNS = [
    "name", "yearpublished", "minplayers", "maxplayers", "minplaytime", "maxplaytime", "age",
    "description", "image", "thumbnail",
]
STAT_COLUMNS = {
    "num_reviews": "total_all", "num_reviews_commented": "total_commented",
    "num_reviews_rated": "total_rated", "num_reviews_rated_and_commented": "total_rated_and_commented",
    "avg_rating": "average", "bayes_average": "bayesaverage", "avg_weight": "avgweight",
    "num_weights": "numweights",
}


def layer_metadata(games: DataFrame, ranks: DataFrame, stats: DataFrame) -> DataFrame:
    """Overlay ranks and stats on the API record, later sources winning column by column.

    Presence of the key decides, not the value: a null in a present ranks row
    still hides the API value.  NaN counts as null.  ``seq`` orders duplicates,
    of which the first is used.
    """
    ranks, stats = keep_first(ranks, "game_id", "seq"), keep_first(stats, "game_id", "seq")
    layers = [("g", games, None), ("r", ranks, F.col("r.game_id")), ("s", stats, F.col("s.game_id"))]
    joined = (
        games.alias("g")
        .join(ranks.alias("r"), F.col("g.game_id") == F.col("r.game_id"), "left")
        .join(stats.alias("s"), F.col("g.game_id") == F.col("s.game_id"), "left")
    )
    names: list[str] = []
    for _, frame, _ in layers:
        names += [c for c in frame.columns if c not in names and c not in ("game_id", "seq")]

    def pick(name: str) -> Column:
        value: Column | None = None
        for alias, frame, present in layers:
            if name not in frame.columns:
                continue
            here = F.col(f"{alias}.{name}")
            if dict(frame.dtypes)[name] in ("double", "float"):
                here = F.nanvl(here, F.lit(None))
            if value is None:
                value = here if present is None else F.when(present.isNotNull(), here)
            else:
                value = F.when(present.isNotNull(), here.cast(dict(frame.dtypes)[name])).otherwise(value)
        return value.alias(name)

    return joined.select(F.col("g.game_id").alias("game_id"), *[pick(n) for n in names])


def build_metadata(games: DataFrame, ranks: DataFrame, stats: DataFrame) -> DataFrame:
    """Nested item record: game_info, stats, rankings, classifications, polls."""
    flat = layer_metadata(games, ranks, stats)
    have = set(flat.columns)
    strings = F.array().cast("array<string>")

    def field(name: str, out: str | None = None, default: Column | None = None) -> Column:
        missing = F.lit(None).cast("string" if default is None else "array<string>")
        value = F.col(name) if name in have else missing
        return (value if default is None else F.coalesce(value, default)).alias(out or name)

    expansion = F.coalesce(number_or_null(F.col("is_expansion")), F.lit(0.0)) != 0 if "is_expansion" in have else F.lit(False)
    kinds = ("mechanics", "categories", "families")
    if "classifications" in have:
        classes = F.struct(*[F.coalesce(F.col(f"classifications.{k}"), strings).alias(k) for k in kinds])
    else:
        classes = F.struct(*[strings.alias(k) for k in kinds])
    return flat.select(
        "game_id",
        F.struct(
            *[field(n) for n in INFO_COLUMNS],
            *[field(n, default=strings) for n in ("designers", "artists", "publishers")],
            expansion.alias("is_expansion"),
        ).alias("game_info"),
        F.struct(*[field(src, out) for out, src in STAT_COLUMNS.items()]).alias("stats"),
        F.struct(*[field("rank" if n == "overall_rank" else n, n) for n in RANK_COLUMNS]).alias("rankings"),
        classes.alias("classifications"),
        F.struct(F.struct(field("poll_avg"), field("poll_votes")).alias("complexity_poll")).alias("polls"),
    )


def attach_thing_names(df: DataFrame, names: DataFrame, key: str, text: str, out: str = "thing_names") -> DataFrame:
    """Add ``map<bigint,string>`` with the names of the items each text refers to.

    Only texts that hold a reference take part in the join, and only their keys
    and ids are shuffled.
    """
    tagged = F.coalesce(F.col(text), F.lit("")).rlike(THING_TAG)
    ids = F.transform(
        F.regexp_extract_all(F.col(text), F.lit(THING_TAG), F.lit(1)), lambda s: s.try_cast("bigint")
    )
    refs = df.filter(tagged).select(key, F.explode(F.array_distinct(ids)).alias("thing_id"))
    found = (
        refs.join(names.select(F.col("id").alias("thing_id"), "name"), "thing_id")
        .filter(F.col("name").isNotNull())
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("thing_id", "name"))).alias(out))
    )
    plain = df.filter(~tagged).withColumn(out, F.lit(None).cast("map<bigint,string>"))
    return df.filter(tagged).join(found, key, "left").unionByName(plain)
