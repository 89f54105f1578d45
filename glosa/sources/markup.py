"""Shredding of XML records and of values embedded in HTML pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glosa.functions.text import number_or_null

# Element names of the record format, page patterns, placeholder bound.
GAME_XML = """
struct<
  name: array<struct<_primary: string, _VALUE: string>>,
  yearpublished: string, minplayers: string, maxplayers: string, minplaytime: string,
  maxplaytime: string, age: string, description: string, image: string, thumbnail: string,
  boardgamepublisher: array<string>, boardgamedesigner: array<string>, boardgameartist: array<string>,
  boardgamemechanic: array<string>, boardgamecategory: array<string>, boardgamefamily: array<string>,
  comment: array<struct<_username: string, _rating: string, _VALUE: string>>
>
"""
# Counts from here on are what a page shows before its data has loaded.
PLACEHOLDER_TOTAL = 999_000
TOTAL_PATTERN = r"of\s*<strong class=\"ng-binding\">([\d,]+)</strong>"
PRELOAD_PATTERN = r"(?s)itemPreload\s*=\s*(\{.*?\});"


def parse_game_xml(xml: Column) -> Column:
    """Typed struct of one item record."""
    ddl = " ".join(GAME_XML.split())
    return F.from_xml(xml, ddl, {"valueTag": "_VALUE", "attributePrefix": "_"})


def xml_metadata(game: Column) -> Column:
    """Metadata of a parsed record; missing text is ``N/A``, the primary name is chosen by attribute."""
    none = F.array().cast("array<string>")

    def text(tag: str) -> Column:
        return F.coalesce(game[tag], F.lit("N/A")).alias(tag)

    def many(tag: str, out: str) -> Column:
        return F.coalesce(game[tag], none).alias(out)

    primary = F.get(F.filter(game["name"], lambda n: n["_primary"] == "true"), F.lit(0))["_VALUE"]
    return F.struct(
        F.coalesce(primary, F.lit("N/A")).alias("name"),
        *[text(t) for t in ("yearpublished", "minplayers", "maxplayers", "minplaytime", "maxplaytime",
                            "age", "description", "image", "thumbnail")],
        many("boardgamepublisher", "publishers"),
        many("boardgamedesigner", "designers"),
        many("boardgameartist", "artists"),
        F.struct(
            many("boardgamemechanic", "mechanics"), many("boardgamecategory", "categories"),
            many("boardgamefamily", "families"),
        ).alias("classifications"),
    )


def xml_comments(game: Column) -> Column:
    """Array of (username, rating, comment); unparsable ratings are null."""
    comments = F.coalesce(
        game["comment"], F.array().cast("array<struct<_username:string,_rating:string,_VALUE:string>>")
    )
    return F.transform(
        comments,
        lambda c: F.struct(
            F.coalesce(c["_username"], F.lit("N/A")).alias("username"),
            number_or_null(c["_rating"]).alias("rating"),
            F.trim(F.coalesce(c["_VALUE"], F.lit(""))).alias("comment"),
        ),
    )


def embedded_json(html: Column, pattern: str = PRELOAD_PATTERN) -> Column:
    """JSON text assigned inside a page script, null when absent."""
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def weight_stats(json: Column) -> Column:
    """Weight and poll figures of an item; absent figures are 0, a broken page gives null."""

    def number(path: str, kind: str) -> Column:
        return F.coalesce(number_or_null(F.get_json_object(json, path), kind), F.lit(0).cast(kind))

    parsed = F.get_json_object(json, "$")
    return F.when(parsed.isNotNull(), F.struct(
        number("$.item.stats.avgweight", "double").alias("avgweight"),
        number("$.item.stats.numweights", "bigint").alias("numweights"),
        number("$.item.polls.boardgameweight.averageweight", "double").alias("poll_avg"),
        number("$.item.polls.boardgameweight.votes", "bigint").alias("poll_votes"),
    ))


def page_total(html: Column, pattern: str = TOTAL_PATTERN) -> Column:
    """Total shown on a page: 0 for "No items found", null for placeholders or no match."""
    digits = F.nullif(F.regexp_replace(F.regexp_extract(html, pattern, 1), ",", ""), F.lit(""))
    total = digits.try_cast("bigint")
    return F.when(html.contains("No items found"), F.lit(0).cast("bigint")).when(
        total < PLACEHOLDER_TOTAL, total
    )
