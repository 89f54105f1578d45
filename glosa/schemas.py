"""Fixed schemas; nothing is inferred from data."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, MapType, StringType, StructField, StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(n, t) for n, t in fields.items()])


STRINGS = ArrayType(StringType())

RAW_REVIEW = _struct(username=StringType(), rating=StringType(), comment=StringType(), timestamp=LongType())

CLASSIFICATIONS = _struct(mechanics=STRINGS, categories=STRINGS, families=STRINGS)

RAW_METADATA = _struct(
    id=LongType(), name=StringType(), yearpublished=StringType(), minplayers=StringType(),
    maxplayers=StringType(), minplaytime=StringType(), maxplaytime=StringType(), age=StringType(),
    description=StringType(), image=StringType(), thumbnail=StringType(),
    publishers=STRINGS, designers=STRINGS, artists=STRINGS, classifications=CLASSIFICATIONS,
)

STATS_ROW = _struct(
    game_id=LongType(), total_all=StringType(), total_commented=StringType(), total_rated=StringType(),
    total_rated_and_commented=StringType(), avgweight=DoubleType(), numweights=StringType(),
    poll_avg=DoubleType(), poll_votes=StringType(),
)

RANKS_ROW = _struct(
    id=LongType(), name=StringType(), yearpublished=StringType(), rank=LongType(),
    bayesaverage=DoubleType(), average=DoubleType(), is_expansion=StringType(),
    strategygames_rank=LongType(), thematic_rank=LongType(), familygames_rank=LongType(),
    partygames_rank=LongType(), cgs_rank=LongType(), childrensgames_rank=LongType(),
    abstracts_rank=LongType(), wargames_rank=LongType(),
)

PROCESSED = _struct(
    tokens_no_stopwords=STRINGS, linguistic_features=MapType(StringType(), DoubleType()),
)

SAVED_REVIEW = _struct(
    username=StringType(), rating=StringType(), timestamp=LongType(), game_id=StringType(),
    category=StringType(), raw_text=StringType(), comment=StringType(), clean_text=StringType(),
    language=StringType(), review_id=LongType(), is_augmented=BooleanType(), processed=PROCESSED,
)

GAME_INFO = _struct(
    name=StringType(), yearpublished=StringType(), minplayers=StringType(), maxplayers=StringType(),
    minplaytime=StringType(), maxplaytime=StringType(), age=StringType(), description=StringType(),
    image=StringType(), thumbnail=StringType(), designers=STRINGS, artists=STRINGS,
    publishers=STRINGS, is_expansion=BooleanType(),
)

GAME_METADATA = _struct(
    game_info=GAME_INFO,
    stats=_struct(
        num_reviews=StringType(), num_reviews_commented=StringType(), num_reviews_rated=StringType(),
        num_reviews_rated_and_commented=StringType(), avg_rating=DoubleType(), bayes_average=DoubleType(),
        avg_weight=DoubleType(), num_weights=StringType(),
    ),
    rankings=_struct(
        overall_rank=LongType(), strategygames_rank=LongType(), thematic_rank=LongType(),
        familygames_rank=LongType(), partygames_rank=LongType(), cgs_rank=LongType(),
        childrensgames_rank=LongType(), abstracts_rank=LongType(), wargames_rank=LongType(),
    ),
    classifications=CLASSIFICATIONS,
    polls=_struct(complexity_poll=_struct(poll_avg=DoubleType(), poll_votes=StringType())),
)

SAVED_GAME = _struct(game_id=LongType(), metadata=GAME_METADATA, first=LongType(), reviews=ArrayType(SAVED_REVIEW))
