"""Merges, sources, sinks, store, markup and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from glosa import schemas as Sc
from glosa.functions.text import number_or_null
from glosa.operators import merge as M
from glosa.operators.skew import block_of, portable_key
from glosa.plans import oracle_parts as P
from glosa.plans import views as V
from glosa.plans.corpus_queries import META
from glosa.plans.registry import query
from glosa.session import cut_lineage, scratch_dir
from glosa.sources import arrays, markup, readers, writers
from glosa.sources.store import ReviewStore, upsert_stats
from glosa.streaming import ingest

# ---------------------------------------------------------------------- merge
MERGE_CTES = (
    P.clean_cte("lab", "review_id", "comment").strip(),
    """
crawl AS (SELECT game_id, username, rating, CASE WHEN review_id % 5 = 0 THEN 'note: ' || comment ELSE comment END AS comment, ts,
            review_id AS seq, lower(trim(username)) AS ukey, CASE WHEN review_id % 5 = 0 THEN 'note: ' || clean_text ELSE clean_text END AS ckey
          FROM rev JOIN clean USING (review_id) WHERE review_id % 3 <> 0),
api AS (SELECT game_id, upper(username) AS username, rating, CASE WHEN review_id % 5 = 0 THEN ' NOTE: ' || comment ELSE ' ' || comment END AS comment,
          review_id AS seq, lower(trim(username)) AS ukey, CASE WHEN review_id % 5 = 0 THEN 'note: ' || clean_text ELSE clean_text END AS ckey
        FROM rev JOIN clean USING (review_id) WHERE review_id % 3 <> 1 AND rating IS NOT NULL),
c AS (SELECT game_id, ukey, ckey, max(seq) AS last_seq, min(seq) AS first_seq FROM crawl GROUP BY ALL),
a AS (SELECT game_id, ukey, ckey, min(seq) AS first_seq, max(seq) FILTER (WHERE contains(comment, ':')) AS colon_seq FROM api GROUP BY ALL)""".strip(),
)


@query(lambda: P.with_reviews("""
SELECT game_id, coalesce(cr.username, ar.username) AS username, coalesce(cr.rating, CASE WHEN c.last_seq IS NULL THEN ar.rating END) AS rating,
  coalesce(colon.comment, cr.comment, ar.comment) AS comment, cr.ts AS ts,
  CASE WHEN c.last_seq IS NULL THEN 1 ELSE 0 END AS origin, coalesce(c.first_seq, a.first_seq) AS seq
FROM c FULL JOIN a USING (game_id, ukey, ckey)
LEFT JOIN crawl cr ON cr.seq = c.last_seq LEFT JOIN api ar ON ar.seq = a.first_seq LEFT JOIN api colon ON colon.seq = a.colon_seq
""", *MERGE_CTES))
def two_source_merge(spark, sf):
    return M.merge_reviews(V.crawler_reviews(spark, sf), V.api_reviews(spark, sf))


@query(P.with_reviews("""
SELECT 'crawler' AS source, game_id, username, rating, ts, review_id AS seq FROM rev WHERE review_id % 3 <> 0
UNION ALL SELECT 'api', game_id, upper(username), rating, NULL, review_id FROM rev WHERE review_id % 3 <> 1 AND rating IS NOT NULL"""))
def single_source_reviews(spark, sf):
    left, right = V.crawler_reviews(spark, sf), V.api_reviews(spark, sf)
    keep = ["game_id", "username", "rating", "ts", "seq"]
    return M.merge_reviews(left, right, "crawler").select(F.lit("crawler").alias("source"), *keep).unionByName(
        M.merge_reviews(left, right, "api").select(F.lit("api").alias("source"), *keep))


@query(P.with_reviews("""
SELECT game_id, username, rating, min(comment) AS comment, ts, min(review_id) AS seq FROM rev
WHERE review_id % 3 <> 0 GROUP BY game_id, username, rating, ts"""))
def crawl_dedup(spark, sf):
    r = V.reviews(spark, sf).filter("review_id % 3 <> 0").select(
        "game_id", "username", "rating", "comment", "ts", F.col("review_id").alias("seq"))
    again = r.withColumn("seq", F.col("seq") + (1 << 40)).withColumn("comment", F.lit("page shown twice"))
    return M.distinct_crawl(r.unionByName(again))


# -------------------------------------------------------------------- sources
@query(P.with_reviews("""
SELECT game_id, username, rating, comment, ts, row_number() OVER (PARTITION BY game_id, review_id // 4096 ORDER BY review_id) - 1 AS seq
FROM rev"""))
def union_typed_reviews(spark, sf):
    """Review files as JSON text: bare lists for even items, wrapped for odd ones, read by one reader."""
    r = V.reviews(spark, sf)
    row = F.struct(
        "username", F.coalesce(F.col("rating").cast("string"), F.lit("N/A")).alias("rating"), "comment",
        F.col("ts").alias("timestamp"),
    )
    files = r.groupBy("game_id", block_of(F.col("review_id"), 4096).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("review_id").alias("i"), row.alias("r")))).alias("rs"))
    rows = F.transform("rs", lambda x: x["r"])
    text = F.when(F.col("game_id") % 2 == 0, F.to_json(rows)).otherwise(F.to_json(F.struct(rows.alias("comments"))))
    return files.select("game_id", F.posexplode(readers.reviews_of(text)).alias("seq", "r")).select(
        "game_id", "r.username", number_or_null(F.col("r.rating")).alias("rating"), "r.comment",
        F.col("r.timestamp").alias("ts"), F.col("seq").cast("bigint").alias("seq"))


TRICKY = ' {"not": "a record"}, \\ "} {" end'


@query(P.with_reviews(f"""
SELECT game_id, username, rating, comment || {P.lit(TRICKY)} || CASE WHEN review_id % 7 = 0 THEN '}}' ELSE '' END AS comment, ts
FROM rev WHERE game_id % 3 <> 1"""))
def array_files(spark, sf):
    """Reviews as array files with braces and quotes in their texts, read at record borders."""
    path = scratch_dir(spark, "arrays")
    r = V.reviews(spark, sf).filter("game_id % 3 <> 1")
    comment = F.concat("comment", F.lit(TRICKY), F.when(F.col("review_id") % 7 == 0, "}").otherwise(""))
    rows = r.select("game_id", "username", F.coalesce(F.col("rating").cast("string"), F.lit("N/A")).alias("rating"), comment.alias("comment"),
                    F.col("ts").alias("timestamp"), "review_id")
    arrays.write_arrays(rows, path, "game_id", block_of(F.col("review_id"), 64))
    return readers.read_reviews(spark, path).select("game_id", "username", number_or_null(F.col("rating")).alias("rating"), "comment", "ts")


REVIEW_ROW = StructType([
    StructField("game_id", LongType()), StructField("username", StringType()), StructField("rating", DoubleType()),
    StructField("comment", StringType()), StructField("ts", LongType()),
])


@query(P.with_reviews("SELECT game_id, username, rating, comment, ts FROM rev WHERE game_id IN (2, 5)"))
def item_files(spark, sf):
    """Rows of two items from files that hold all of them; only their folders are read."""
    path = scratch_dir(spark, "items")
    writers.write_per_game(V.reviews(spark, sf).select("game_id", "username", "rating", "comment", "ts"), path)
    return readers.read_items(spark, path, REVIEW_ROW, [2, 5])


@query(P.with_reviews("""
SELECT r.game_id, p_name AS name, total_all, round(avgweight, 6) AS avgweight, n_reviews FROM (
  SELECT game_id, CAST(count(*) AS VARCHAR) AS total_all, avg(rating) AS avgweight, count(*) AS n_reviews FROM rev GROUP BY game_id) r
JOIN part ON p_partkey = r.game_id"""))
def json_csv_sources(spark, sf):
    """Metadata and reviews as per-item JSON, stats as CSV, written and read back with fixed schemas."""
    games, r = V.games(spark, sf), V.reviews(spark, sf)
    meta_path, review_path, csv_path = (scratch_dir(spark, n) for n in ("metadata", "reviews", "stats"))
    have = set(games.columns)
    games.select(F.col("game_id").alias("id"), *[
        (F.col(f.name) if f.name in have else F.lit("N/A").cast("string") if isinstance(f.dataType, StringType)
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in Sc.RAW_METADATA.fields if f.name != "id"
    ]).write.json(meta_path)
    writers.write_per_game(r.select("game_id", "username", "rating", "comment", "ts"), review_path)
    r.groupBy("game_id").agg(
        F.count(F.lit(1)).cast("string").alias("total_all"), F.lit(None).cast("string").alias("total_commented"),
        F.lit(None).cast("string").alias("total_rated"), F.lit(None).cast("string").alias("total_rated_and_commented"),
        F.avg("rating").alias("avgweight"), F.lit(None).cast("string").alias("numweights"),
        F.lit(None).cast("double").alias("poll_avg"), F.lit(None).cast("string").alias("poll_votes"),
    ).write.option("header", True).csv(csv_path)
    metadata = readers.read_json_lines(spark, meta_path, Sc.RAW_METADATA).filter("age = 'N/A'")
    stats = readers.read_csv(spark, csv_path, Sc.STATS_ROW)
    counted = readers.read_items(spark, review_path, REVIEW_ROW).groupBy("game_id").agg(F.count(F.lit(1)).alias("n_reviews"))
    missing = readers.read_json(spark, scratch_dir(spark, "absent"), Sc.RAW_METADATA)  # empty frame
    return (
        stats.join(metadata.unionByName(missing).select(F.col("id").alias("game_id"), "name"), "game_id")
        .join(counted, "game_id")
        .select("game_id", "name", "total_all", F.round("avgweight", 6).alias("avgweight"), "n_reviews")
    )


@query(lambda: P.with_docs(f"""
SELECT game_id, {P.KEY} AS review_id, row_number() OVER (PARTITION BY game_id ORDER BY {P.KEY}) - 1 AS seq, username, docs.rating, ts,
  label, comment, clean_text, lang, len(tokens) AS n_tokens, name, rank AS overall_rank, total_all AS num_reviews
FROM docs JOIN meta USING (game_id)""", META))
def corpus_json_roundtrip(spark, sf):
    """Hashed ids, items over several records: order, ids, ranks and stats come back, every item once."""
    docs = V.documents(spark, sf).withColumn("review_id", portable_key(F.col("review_id")))
    metadata = M.build_metadata(V.games(spark, sf), V.game_ranks(spark, sf), V.game_stats(spark, sf))
    path = scratch_dir(spark, "corpus")
    writers.write_corpus(docs, metadata, path, per_record=4)
    games, back = readers.read_corpus(spark, path)
    # Written, so that its size is known: items that fit a broadcast leave the texts where they are.
    items = cut_lineage(games.select(
        "game_id", F.col("game_info.name").alias("name"), "rankings.overall_rank", F.col("stats.num_reviews").alias("num_reviews")))
    return back.join(items, "game_id").select(
        "game_id", "review_id", "seq", "username", "rating", "ts", "label", "comment", "clean_text", "lang",
        F.size("tokens").cast("bigint").alias("n_tokens"), "name", "overall_rank", "num_reviews")


@query(P.with_reviews(f"""
SELECT game_id, {P.KEY} AS review_id, username, lab.rating, comment, ts, label AS category, CAST(length(comment) AS DOUBLE) AS f_length,
  name, count(*) OVER (PARTITION BY game_id) AS num_reviews
FROM lab JOIN meta USING (game_id)""", META))
def store_export_import(spark, sf):
    """A store written as JSON records and read into another one: ids, features and metadata stay, items come once."""
    first, second = (ReviewStore(spark, scratch_dir(spark, n)) for n in ("store", "copy"))
    docs = V.reviews(spark, sf).withColumn("review_id", portable_key(F.col("review_id"))).withColumn(
        "features", F.create_map(F.lit("length"), F.length("comment").cast("double")))
    first.save(docs, M.build_metadata(V.games(spark, sf), V.game_ranks(spark, sf), V.game_stats(spark, sf)))
    path = scratch_dir(spark, "export")
    first.export_json(path, per_record=4)
    second.import_json(path)
    items, back = second.load()
    return back.join(items.select("game_id", "game_info.name", "num_reviews"), "game_id").select(
        "game_id", "review_id", "username", "rating", "comment", "ts", "category",
        F.col("features")["length"].alias("f_length"), "name", "num_reviews")


CATEGORY_COUNTS = """
per AS (SELECT game_id, count(*) AS total_reviews, count(*) FILTER (WHERE label = 'positive') AS n_positive,
  count(*) FILTER (WHERE label = 'neutral') AS n_neutral, count(*) FILTER (WHERE label = 'negative') AS n_negative FROM lab GROUP BY game_id)"""


@query(lambda: P.with_reviews("""
SELECT review_id, game_id, username, lab.rating, label AS category, name, rank AS overall_rank, total_all AS stats_reviews,
  count(*) OVER (PARTITION BY game_id)::BIGINT AS num_loaded, total_reviews, n_positive, n_neutral, n_negative
FROM (SELECT * FROM lab QUALIFY row_number() OVER (PARTITION BY game_id, label IN ('positive', 'negative') ORDER BY review_id) <= 5
      AND label IN ('positive', 'negative')) lab JOIN meta USING (game_id) JOIN per USING (game_id)""", META, CATEGORY_COUNTS.strip()))
def store_roundtrip(spark, sf):
    """Save everything, save one item again, load with pushed filters and a limit per item; counts are the saved ones."""
    store = ReviewStore(spark, scratch_dir(spark, "store"))
    r = V.reviews(spark, sf)
    metadata = M.build_metadata(V.games(spark, sf), V.game_ranks(spark, sf), V.game_stats(spark, sf))
    store.save(r, metadata)
    one = F.col("game_id") == 1
    store.save(r.filter(one), metadata.filter(one))
    items, loaded = store.load(categories=["positive", "negative"], limit=5)
    counts = loaded.groupBy("game_id").agg(F.count(F.lit(1)).alias("num_loaded"))
    saved = [F.coalesce(F.try_element_at("categories_count", F.lit(c)), F.lit(0).cast("bigint")).alias(f"n_{c}")
             for c in ("positive", "neutral", "negative")]
    items = items.select("game_id", F.col("game_info.name").alias("name"), "rankings.overall_rank",
                         F.col("stats.num_reviews").alias("stats_reviews"), F.col("num_reviews").alias("total_reviews"), *saved)
    return loaded.join(items, "game_id").join(counts, "game_id").select(
        "review_id", "game_id", "username", "rating", "category", "name", "overall_rank", "stats_reviews", "num_loaded",
        "total_reviews", "n_positive", "n_neutral", "n_negative")


@query(P.with_reviews("""
SELECT game_id, CASE WHEN game_id % 4 = 1 THEN 'new' ELSE 'old' END AS version,
  CASE WHEN game_id % 4 = 1 THEN count(*) + 1 ELSE count(*) END AS total_all
FROM rev GROUP BY game_id"""))
def stats_upsert(spark, sf):
    base = V.reviews(spark, sf).groupBy("game_id").agg(F.count(F.lit(1)).alias("total_all"))
    old = base.withColumn("version", F.lit("old"))
    new = base.filter("game_id % 4 = 1").withColumn("version", F.lit("new")).withColumn("total_all", F.col("total_all") + 1)
    return upsert_stats(old, new).select("game_id", "version", "total_all")


# --------------------------------------------------------------------- markup
@query(r"""
SELECT page_id, CASE WHEN page_id % 5 <> 4 THEN CAST(regexp_extract(html, 'track\((\d+)\)', 1) AS DOUBLE) / 2 END AS avgweight,
  CASE WHEN page_id % 5 <> 4 THEN CAST(regexp_extract(html, 'track\((\d+)\)', 1) AS BIGINT) END AS numweights,
  CASE WHEN page_id % 5 <> 4 THEN CASE WHEN page_id % 3 = 0 THEN 0 ELSE 2.5 END::DOUBLE END AS poll_avg,
  CASE WHEN page_id % 5 <> 4 THEN CASE WHEN page_id % 3 = 0 THEN 0 ELSE page_id END END AS poll_votes
FROM pages""")
def page_embedded_json(spark, sf):
    """The page's own tracking number is put into an embedded item object and read back."""
    p = V.spread(V.table(spark, sf, "pages"))
    n = F.regexp_extract("html", r"track\((\d+)\)", 1)
    polls = F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(F.concat(
        F.lit(', "polls": {"boardgameweight": {"averageweight": 2.5, "votes": "'), F.col("page_id").cast("string"), F.lit('"}}')))
    script = F.concat(
        F.lit("<script>site.itemPreload = {\"item\": {\"stats\": {\"avgweight\": \""), (n.cast("bigint") / 2).cast("string"),
        F.lit("\", \"numweights\": "), n, F.lit("}"), polls, F.lit("}};</script>"))
    page = F.when(F.col("page_id") % 5 != 4, F.concat("html", script)).otherwise(F.col("html"))
    stats = markup.weight_stats(markup.embedded_json(page))
    return p.select("page_id", stats.alias("s")).select("page_id", "s.*")


@query(r"""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 0 WHEN 1 THEN len(html) * 7 WHEN 2 THEN NULL ELSE NULL END AS total,
  CAST(regexp_extract(html, 'track\((\d+)\)', 1) AS BIGINT) AS tracked
FROM pages""")
def page_totals(spark, sf):
    p = V.spread(V.table(spark, sf, "pages"))
    shown = F.format_number(F.length("html") * 7, 0)
    k = F.col("page_id") % 4
    tail = (
        F.when(k == 0, F.lit("<p>No items found</p>"))
        .when(k == 1, F.concat(F.lit('of <strong class="ng-binding">'), shown, F.lit("</strong>")))
        .when(k == 2, F.lit('of <strong class="ng-binding">999,999</strong>'))
        .otherwise(F.lit(""))
    )
    return p.select(
        "page_id", markup.page_total(F.concat("html", tail)).alias("total"),
        markup.page_total(F.col("html"), r"track\((\d+)\)").alias("tracked"))


def _xml(spark, sf):
    p = V.spread(V.table(spark, sf, "part"))
    word = F.split("p_name", " ")
    xml = F.concat(
        F.lit("<boardgame><name primary=\"false\">x</name><name primary=\"true\">"), F.col("p_name"), F.lit("</name>"),
        F.lit("<yearpublished>"), F.col("p_size").cast("string"), F.lit("</yearpublished>"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(F.lit("<age>8</age>")),
        F.lit("<boardgamemechanic>"), word[0], F.lit("</boardgamemechanic><boardgamemechanic>"), word[1],
        F.lit("</boardgamemechanic><boardgamedesigner>"), F.col("p_brand"), F.lit("</boardgamedesigner>"),
        F.lit("<comment username=\"u"), F.col("p_size").cast("string"), F.lit("\" rating=\"7.5\"> "), F.col("p_type"),
        F.lit(" </comment><comment rating=\"N/A\">second</comment></boardgame>"),
    )
    return p.select("p_partkey", markup.parse_game_xml(xml).alias("g"))


@query("""
SELECT p_partkey, p_name AS name, CAST(p_size AS VARCHAR) AS yearpublished, CASE WHEN p_partkey % 3 = 0 THEN 'N/A' ELSE '8' END AS age,
  'N/A' AS description, replace(p_name, ' ', '|') AS mechanics, p_brand AS designers, '' AS artists
FROM part""")
def xml_metadata(spark, sf):
    m = _xml(spark, sf).select("p_partkey", markup.xml_metadata(F.col("g")).alias("m"))
    return m.select(
        "p_partkey", "m.name", "m.yearpublished", "m.age", "m.description",
        F.array_join("m.classifications.mechanics", "|").alias("mechanics"),
        F.array_join("m.designers", "|").alias("designers"), F.array_join("m.artists", "|").alias("artists"))


@query("""
SELECT p_partkey, 0 AS pos, 'u' || CAST(p_size AS VARCHAR) AS username, CAST(7.5 AS DOUBLE) AS rating, p_type AS comment FROM part
UNION ALL SELECT p_partkey, 1, 'N/A', NULL, 'second' FROM part""")
def xml_comments(spark, sf):
    c = _xml(spark, sf).select("p_partkey", F.posexplode(markup.xml_comments(F.col("g"))).alias("pos", "c"))
    return c.select("p_partkey", "pos", "c.username", "c.rating", "c.comment")


# ------------------------------------------------------------------ streaming
STREAM_REVIEW = StructType([
    StructField("username", StringType()), StructField("rating", DoubleType()), StructField("comment", StringType()),
    StructField("ts", LongType()),
])


@query(P.with_reviews("SELECT username, rating, ts, count(*) AS n FROM (SELECT DISTINCT username, rating, ts FROM rev) GROUP BY ALL"))
def stream_dedup(spark, sf):
    """Review files, every review twice, through the de-duplicating stream."""
    source, target, state = (scratch_dir(spark, n) for n in ("in", "out", "state"))
    r = V.reviews(spark, sf).select("username", "rating", "comment", "ts")
    r.unionByName(r).write.json(source)
    stream = ingest.stream_reviews(spark, source, STREAM_REVIEW, "json")
    job = ingest.start_dedup(stream, target, state)
    job.awaitTermination()
    out = spark.read.schema(STREAM_REVIEW).parquet(target)
    return out.groupBy("username", "rating", "ts").agg(F.count(F.lit(1)).alias("n"))


@query(P.with_reviews("SELECT game_id, count(*) AS total_all, max(review_id) AS seq FROM rev GROUP BY game_id"))
def stream_upsert(spark, sf):
    """Running totals per item as a stream of rows; the last row per item survives."""
    source, target, state = (scratch_dir(spark, n) for n in ("in", "out", "state"))
    schema = StructType([StructField(n, LongType()) for n in ("game_id", "total_all", "seq")])
    totals = V.reviews(spark, sf).groupBy("game_id").agg(
        F.count(F.lit(1)).alias("total_all"), F.max("review_id").alias("seq"))
    early = totals.withColumn("total_all", F.lit(0).cast("bigint")).withColumn("seq", F.lit(-1).cast("bigint"))
    early.unionByName(totals).coalesce(2).write.json(source)
    job = ingest.start_stats_upsert(ingest.stream_reviews(spark, source, schema, "json"), target, state)
    job.awaitTermination()
    last = max(p["batchId"] for p in job.recentProgress)
    return ingest.latest_stats(spark, target, schema, last)
