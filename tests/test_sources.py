import json

from pyspark.sql import functions as F

from glosa import schemas as Sc
from glosa.operators import models as Ml
from glosa.plans import build, catalog
from glosa.plans import views as V
from glosa.sources import markup, readers, writers
from glosa.sources.store import ReviewStore, upsert_stats


def test_review_files_of_both_shapes(spark, tmp_path):
    one = [{"username": "a", "rating": 7.5, "comment": "x\ny"}, {"username": "b", "rating": None, "comment": None}]
    (tmp_path / "x_reviews_12_api.json").write_text(json.dumps(one), encoding="utf-8")
    (tmp_path / "x_reviews_13_api.json").write_text(json.dumps({"comments": one[:1]}), encoding="utf-8")
    rows = readers.read_reviews(spark, str(tmp_path)).collect()
    assert sorted((r.game_id, r.seq, r.username, r.rating) for r in rows) == [
        (12, 0, "a", "7.5"), (12, 1, "b", None), (13, 0, "a", "7.5")]


def test_absent_files_give_empty_frames(spark, tmp_path):
    missing = str(tmp_path / "none")
    assert readers.read_json(spark, missing, Sc.RAW_METADATA).count() == 0
    assert readers.read_csv(spark, missing, Sc.STATS_ROW).count() == 0
    assert readers.read_reviews(spark, missing).count() == 0


def test_metadata_sentinels(spark, tmp_path):
    (tmp_path / "x_metadata_5_api.json").write_text(json.dumps({"id": 5, "name": "N/A", "age": "8", "artists": ["z"]}))
    row = readers.read_metadata(spark, str(tmp_path)).first()
    assert row.game_id == 5 and row.name is None and row.age == "8" and row.artists == ["z"]


def test_page_rules(spark):
    pages = [("No items found",), ('of <strong class="ng-binding">1,234</strong>',), ('of <strong class="ng-binding">999,000</strong>',), ("x",)]
    df = spark.createDataFrame(pages, "h string")
    assert [r[0] for r in df.select(markup.page_total(F.col("h"))).collect()] == [0, 1234, None, None]
    html = 'a.itemPreload = {"item": {"stats": {"avgweight": "2.5", "numweights": "3"}}};'
    row = spark.createDataFrame([(html,), ("none",), ("itemPreload = {broken};",)], "h string").select(
        markup.weight_stats(markup.embedded_json(F.col("h"))).alias("s")).collect()
    assert tuple(row[0].s) == (2.5, 3, 0.0, 0) and row[1].s is None and row[2].s is None


def test_store_is_idempotent_and_clearable(spark, tmp_path):
    store = ReviewStore(spark, str(tmp_path / "store"))
    assert store.reviews().count() == 0
    r = spark.createDataFrame(
        [(1, 1, "a", 8.0, "x", "positive"), (1, 2, "b", 2.0, "y", "negative"), (2, 3, "c", 6.0, "z", "neutral")],
        "game_id bigint, review_id bigint, username string, rating double, comment string, label string")
    games = spark.createDataFrame([(1,), (2,)], "game_id bigint")
    store.save(r, games)
    store.save(r.filter("game_id = 1"), games.filter("game_id = 1"))
    assert store.reviews().count() == 3 and {g.game_id: g.num_reviews for g in store.games().collect()} == {1: 2, 2: 1}
    games_out, loaded = store.load([1], ["positive", "negative"], limit=1)
    assert games_out.count() == 1 and [x.review_id for x in loaded.collect()] == [1]
    assert store.reviews_by_game(1, "negative").count() == 1
    total = store.stats().filter("is_total = 1").first()
    assert total.n == 3
    store.export_json(str(tmp_path / "out"))
    other = ReviewStore(spark, str(tmp_path / "other"))
    other.import_json(str(tmp_path / "out"))
    assert other.reviews().count() == 3
    store.clear()
    assert store.reviews().count() == 0 and store.games().count() == 0


def test_upsert_keeps_the_last_row(spark):
    old = spark.createDataFrame([(1, "a"), (2, "a")], "game_id bigint, v string")
    new = spark.createDataFrame([(2, "b"), (3, "b")], "game_id bigint, v string")
    assert {r.game_id: r.v for r in upsert_stats(old, new).collect()} == {1: "a", 2: "b", 3: "b"}


def test_corpus_round_trip_keeps_order_and_features(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, 1, "u", 8.5, "hello", 9, "positive", "en", ["hello"], {"f": 1.0}), (1, 0, "v", None, "x", None, None, None, [], None)],
        "game_id bigint, review_id bigint, username string, rating double, comment string, ts bigint, label string, lang string, "
        "tokens array<string>, features map<string,double>")
    metadata = spark.createDataFrame([(1, ("n",))], "game_id bigint, game_info struct<name:string>")
    writers.write_corpus(docs, metadata, str(tmp_path / "c"))
    g, back = readers.read_corpus(spark, str(tmp_path / "c"))
    rows = back.orderBy("seq").collect()
    assert [r.username for r in rows] == ["v", "u"] and rows[1].features == {"f": 1.0} and rows[0].lang == "en"
    assert g.first().game_info.name == "n"
    writers.write_flat_corpus(docs, metadata, str(tmp_path / "flat"))
    assert spark.read.json(str(tmp_path / "flat" / "reviews")).count() == 2


def test_items_of_several_records_come_back_once(spark, tmp_path):
    docs = spark.range(50).selectExpr(
        "1L AS game_id", "xxhash64(id) AS review_id", "concat('u', id) AS username", "1D AS rating", "concat('c', id) AS comment",
        "map('f', double(id)) AS features", "'positive' AS label")
    games = spark.createDataFrame([(1, ("n",)), (2, ("alone",))], "game_id bigint, game_info struct<name:string>")
    writers.write_corpus(docs, games, str(tmp_path / "c"), per_record=16)
    assert spark.read.json(str(tmp_path / "c")).filter("reviews IS NOT NULL").count() == 4
    items, back = readers.read_corpus(spark, str(tmp_path / "c"))
    assert {(g.game_id, g.game_info.name) for g in items.collect()} == {(1, "n"), (2, "alone")} and items.count() == 2
    want = [r.review_id for r in docs.orderBy("review_id").collect()]
    assert [(r.seq, r.review_id) for r in back.orderBy("seq").collect()] == list(enumerate(want))
    store = ReviewStore(spark, str(tmp_path / "s"))
    store.import_json(str(tmp_path / "c"))
    assert sorted((g.game_id, g.num_reviews) for g in store.games().collect()) == [(1, 50), (2, 0)]
    kept = store.reviews().collect()
    assert sorted(r.review_id for r in kept) == want and all(r.features["f"] == float(r.username[1:]) for r in kept)


def test_joined_texts_follow_counted_rows(spark):
    from glosa.operators.frequency import join_texts

    docs = spark.range(50).selectExpr("1L AS g", "xxhash64(id) AS i", "string(id) AS t")
    rows = join_texts(docs, "g", "i", F.col("t")).collect()
    assert [r.chunk for r in rows] == [0] and rows[0].text.split("\n") == [r.t for r in docs.orderBy("i").collect()]


def test_build_chain(spark, sf):
    built, counts, report = build.build_corpus(
        V.crawler_reviews(spark, sf), V.api_reviews(spark, sf), V.games(spark, sf), V.game_ranks(spark, sf), V.game_stats(spark, sf),
        with_features=False)
    per = {}
    for r in built.documents.groupBy("game_id", "label").count().collect():
        per.setdefault(r.game_id, set()).add(r["count"])
    assert per and all(len(v) == 1 for v in per.values())
    assert report.agg(F.sum("total_after")).first()[0] == built.documents.count()
    assert counts.agg(F.sum("kept")).first()[0] > 0


def test_vectorise_train_predict(spark):
    rows = [
        (1, "positive", "en", ["good", "game"], {"sentiment": 1.0}), (2, "negative", "en", ["bad", "game"], {"sentiment": -1.0}),
        (3, "positive", "en", ["good", "fun"], {"sentiment": 1.0}),
    ]
    df = spark.createDataFrame(rows, "review_id bigint, label string, lang string, tokens array<string>, features map<string,double>")
    vec = Ml.ReviewVectorizer(max_features=50).fit(df)
    out = vec.transform(df)
    assert out.first().ngrams.size == vec.n_terms and out.first().opinion.size == 1
    shifted = Ml.shift_positive(out, "opinion", "opinion")
    fitted, failed = Ml.train_models(shifted, ["positive", "negative"], ("naive_bayes",), ("ngrams", "opinion", "combined"))
    assert not failed and len(fitted) == 3
    scores = Ml.evaluate_all(fitted, shifted, shifted).collect()
    assert all(s.test_accuracy >= 0.5 for s in scores)


def test_failures_are_isolated(spark):
    df = spark.createDataFrame([("positive",)], "label string")
    fitted, failed = Ml.train_models(df, ["positive"], ("naive_bayes",), ("ngrams",))
    assert not fitted and ("naive_bayes", "ngrams") in failed


def test_grids():
    assert [len(Ml.grid_points(m)) for m in Ml.MODELS] == [3, 12, 24, 16]
    assert len(Ml.grid_points("random_forest", "random")) == 10
    assert Ml.grid_points("random_forest", "random") == Ml.grid_points("random_forest", "random")


def test_every_query_has_a_function_and_most_have_sql():
    assert len(catalog.QUERIES) > 70 and set(catalog.oracle_sql()) <= set(catalog.QUERIES)


def _vectors(spark):
    rows = [(i, ["positive", "negative"][i % 2], "en", [["good", "fun"], ["bad", "dull"]][i % 2] + [f"w{i}"], {"s": float(1 - 2 * (i % 2))})
            for i in range(24)]
    df = spark.createDataFrame(rows, "review_id bigint, label string, lang string, tokens array<string>, features map<string,double>")
    return Ml.ReviewVectorizer(max_features=20).fit(df).transform(df)


def test_tuning_picks_a_grid_point(spark):
    model, params, score = Ml.tune(
        _vectors(spark), "naive_bayes", "ngrams", ["positive", "negative"], folds=2, grid={"smoothing": [0.5, 1.0]})
    assert params["smoothing"] in (0.5, 1.0) and score > 0.8
    assert model.transform(_vectors(spark)).filter("label <> predicted").count() == 0


def test_vectorizer_state_survives_saving(spark, tmp_path):
    rows = [(1, "en", ["good", "fun"], {"s": 1.0}), (2, "en", ["bad"], {"t": 2.0})]
    df = spark.createDataFrame(rows, "review_id bigint, lang string, tokens array<string>, features map<string,double>")
    vec = Ml.ReviewVectorizer(max_features=10).fit(df)
    vec.save(str(tmp_path / "v"))
    again = Ml.ReviewVectorizer(max_features=10).load(spark, str(tmp_path / "v"))
    new = spark.createDataFrame([(9, "en", ["good", "unseen"], {"s": 4.0, "unseen": 1.0})], df.schema)
    a, b = vec.transform(new).first(), again.transform(new).first()
    assert a.ngrams == b.ngrams and a.opinion == b.opinion and list(a.opinion.values) == [4.0]


def test_reports_and_splits_on_disk(spark, tmp_path):
    results = spark.createDataFrame([("m1", "ngrams", 0.4), ("m2", "ngrams", 0.9)], "model string, features string, test_composite double")
    writers.write_results_csv(results, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert [r.model for r in back.collect()] == ["m2", "m1"]
    assert spark.read.json(writers.write_report(results, str(tmp_path), "x")).count() == 2
    rows = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test"), (4, "train")], "id bigint, split string")
    for kind in ("parquet", "json", "csv"):
        writers.write_splits(rows, str(tmp_path / kind), kind)
        parts = writers.read_splits(spark, str(tmp_path / kind), None if kind == "parquet" else "id bigint, split string", kind)
        assert {s: p.count() for s, p in parts.items()} == {"train": 2, "val": 1, "test": 1}


def test_large_vocabularies_are_numbered_in_order(spark):
    from glosa.operators.vectors import number_alphabetically

    words = spark.range(5000).select(F.concat(F.lit("w"), F.hex(F.xxhash64("id"))).alias("w"))
    rows = number_alphabetically(words, "w").orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(5000)) and [r.w for r in rows] == sorted(r.w for r in rows)


def _reviews(spark, rows):
    return spark.createDataFrame(rows, "game_id bigint, review_id bigint, label string")


def _files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_saving_one_item_leaves_other_buckets_alone(spark, tmp_path):
    store = ReviewStore(spark, str(tmp_path / "s"), buckets=8)
    rows = [(g, 10 * g + i, "positive" if i else None) for g in range(1, 21) for i in range(3)]
    games = spark.range(1, 21).selectExpr("id AS game_id")
    store.save(_reviews(spark, rows), games)
    before, sets = _files(tmp_path / "s"), store.files.manifest().sets
    assert {r.game_id: (r.num_reviews, r.categories_count) for r in store.games().collect()}[7] == (3, {"positive": 2})
    store.save(_reviews(spark, [(7, 1, "negative")]), games.filter("game_id = 7"))
    now = store.files.manifest().sets
    mine = str(store.files.bucket_number(7))
    assert {b for b in now["reviews"] if now["reviews"][b] != sets["reviews"][b]} == {mine}
    assert before.items() <= _files(tmp_path / "s").items()
    assert store.reviews().count() == 58 and store.reviews_by_game(7).first().category == "negative"
    assert {r.game_id: r.categories_count for r in store.games().collect()}[7] == {"negative": 1}
    assert sorted(r.game_id for r in store.load([3, 7])[0].collect()) == [3, 7]
    plan = store.load([3])[1]._jdf.queryExecution().executedPlan().toString()
    assert "(1 paths)" in plan


def test_buckets_agree_with_the_driver(spark, tmp_path):
    files = ReviewStore(spark, str(tmp_path / "s"), buckets=7).files
    keys = [0, 1, 5, 2**31, 2**40 + 3, 2**62]
    got = [r.b for r in spark.createDataFrame([(k,) for k in keys], "k bigint").select(files.bucket_of(F.col("k")).alias("b")).collect()]
    assert got == [files.bucket_number(k) for k in keys]


def test_two_writers_lose_nothing(spark, tmp_path):
    from glosa.sources.buckets import BucketStore, Table
    from pyspark.sql.types import StructType

    table = {"t": Table(StructType.fromDDL("k bigint, v bigint"), "k")}
    files = BucketStore(spark, str(tmp_path / "b"), table, 4)
    add = lambda k: lambda held: {"t": held["t"].unionByName(spark.createDataFrame([(k, 1)], "k bigint, v bigint"))}
    calls = []

    def slow(held):
        calls.append(1)
        if len(calls) == 1:  # another writer commits to the same and to another bucket meanwhile
            files.update([files.bucket_number(1)], add(1))
            files.update([files.bucket_number(2)], add(2))
        return add(1)(held)

    files.update([files.bucket_number(1)], slow)
    assert len(calls) == 2 and files.versions() == [1, 2, 3]
    assert sorted(r.k for r in files.read("t").collect()) == [1, 1, 2]
    assert files.read("t", files.manifest(1)).count() == 1
    # A writer of another bucket only has to publish again.
    calls.clear()

    def other(held):
        calls.append(1)
        files.update([files.bucket_number(1)], add(1))
        return add(2)(held)

    assert files.bucket_number(1) != files.bucket_number(2)
    files.update([files.bucket_number(2)], other)
    assert len(calls) == 1 and files.read("t").count() == 5
    assert not files._publish(f"{files.path}/manifests/1.json", "{}")


def test_replayed_batch_is_left_out(spark, tmp_path):
    from glosa.streaming import ingest

    source = tmp_path / "in"
    spark.createDataFrame([(1, 5, 1), (2, 6, 2)], "game_id bigint, total_all bigint, seq bigint").write.json(str(source))
    schema = spark.read.json(str(source)).schema
    for checkpoint in ("c1", "c2"):  # the second run replays batch 0 on the same target
        job = ingest.start_stats_upsert(ingest.stream_reviews(spark, str(source), schema), str(tmp_path / "t"), str(tmp_path / checkpoint))
        job.awaitTermination()
    files = ingest.stats_files(spark, str(tmp_path / "t"), schema)
    assert files.versions() == [1] and files.manifest().tags == {"batch": 0}
    assert sorted((r.game_id, r.total_all) for r in ingest.latest_stats(spark, str(tmp_path / "t"), schema).collect()) == [(1, 5), (2, 6)]


def test_folds_hold_their_share_of_every_class(spark):
    df = spark.range(100).selectExpr("id AS review_id", "if(id % 10 = 0, 'a', 'b') AS label")
    got = {(r.fold, r.label): r["count"] for r in Ml.fold_numbers(df, 3).groupBy("fold", "label").count().collect()}
    assert got == {(0, "a"): 3, (1, "a"): 3, (2, "a"): 4, (0, "b"): 30, (1, "b"): 30, (2, "b"): 30}


def test_grid_points_share_folds_and_fits(spark):
    scores = Ml.search_grid(_vectors(spark), "naive_bayes", "ngrams", ["positive", "negative"], folds=3)
    assert [s.params["smoothing"] for s in scores] == [0.1, 0.5, 1.0] and all(len(s.folds) == 3 for s in scores)
    assert Ml.best_point(scores) is scores[0]  # all are right, the first one wins
    mixed = Ml.search_grid(_vectors(spark), "linear_sgd", "ngrams", ["positive", "negative"], folds=2,
                           grid={"loss": ["hinge", "log_loss"], "maxIter": [5]})
    assert len(mixed) == 2 and all(0 <= s.mean <= 1 for s in mixed)


def test_a_model_run_is_written(spark, tmp_path):
    from glosa.operators import split as Sp

    rows = Sp.stratified_split(_vectors(spark).select("review_id", "label", "ngrams", "opinion"))
    ranked, summary = Ml.run_models(rows, ["positive", "negative"], str(tmp_path / "run"), ("naive_bayes", "unknown"), ("ngrams", "opinion"))
    assert ranked.count() == 2 and spark.read.option("header", True).csv(str(tmp_path / "run" / "results")).count() == 2
    row = spark.read.json(str(tmp_path / "run" / "summary")).first()
    assert (row.documents, row.trained, row.combinations, row.features) == (24, 2, 4, row.ngram_features + row.opinion_features)
    assert row.models == ["naive_bayes/ngrams", "naive_bayes/opinion"] and len(row.failed) == 2
    assert [(c.label, c.n) for c in row.classes] == [("negative", 12), ("positive", 12)]
    assert (tmp_path / "run" / "models" / "naive_bayes_ngrams").exists()


def test_zeros_stay_zero_when_shifted(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense([0.0, -2.0, 1.0]),), (Vectors.sparse(3, [0, 1], [0.0, 3.0]),)], ["v"])
    got = [r.w.toArray().tolist() for r in Ml.shift_positive(df, "v", "w").collect()]
    assert got == [[0.0, 0.0, 3.0], [0.0, 5.0, 0.0]]


def test_languages_are_learned_and_missing_ones_found(spark):
    from glosa.operators import language as La

    words = {"en": "the thing with which they think", "de": "der zug fährt durch die lange nacht"}
    rows = [(i, code, " ".join(words[code].split()[i % 3:]) + f" {i}") for i in range(40) for code in words]
    df = spark.createDataFrame(rows, "review_id long, lang string, comment string")
    model = La.train_language_model(df, size=200)
    new = spark.createDataFrame(
        [(1, "they think with the thing"), (2, "durch die nacht"), (3, "  "), (4, None), (5, "zzz")], "review_id long, comment string")
    got = {r.review_id: r.detected for r in La.detect_language(model, new).collect()}
    assert got[1] == "en" and got[2] == "de" and got[3] == got[4] == got[5] == "en"
    some = La.detect_language(model, new, default="?", where=F.col("review_id") > 1).collect()
    assert {r.review_id: r.detected for r in some} == {1: None, 2: "de", 3: "?", 4: "?", 5: "?"}
    mixed = new.withColumn("lang", F.when(F.col("review_id") == 1, "fr"))
    done = {r.review_id: r.lang for r in build.process_reviews(mixed, language=model).collect()}
    assert done == {1: "fr", 2: "de", 3: "unknown", 4: "unknown", 5: "en"}
    plan = La.detect_language(model, new)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_array_files_of_many_splits(spark, tmp_path):
    rng = __import__("random").Random(4)
    bits = ['"', "\\", "{", "}", "},{", "]", "\n", "é", "plain words", '{"username": "x"}']
    records = [{"username": f"u{i}", "rating": str(i), "comment": "".join(rng.choices(bits, k=rng.randint(0, 9))), "timestamp": i} for i in range(400)]
    extra = [{**r, "more": {"a": {"b": r["comment"]}, "c": [1, {"d": "}"}]}} for r in records]
    (tmp_path / "x_reviews_12_api.json").write_text(json.dumps(records, indent=1, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "x_reviews_13_api.json").write_text(json.dumps({"comments": extra}), encoding="utf-8")
    (tmp_path / "x_reviews_14_api.json").write_text("[]", encoding="utf-8")
    (tmp_path / "x_reviews_15_api.json").write_text('{"comments": []}', encoding="utf-8")
    for size in ("1500", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0" if size == "1500" else "4194304")
        try:
            rows = readers.read_reviews(spark, str(tmp_path)).orderBy("game_id", "seq").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        for item in (12, 13):
            mine = [r for r in rows if r.game_id == item]
            assert [(r.seq, r.username, r.rating, r.comment, r.ts) for r in mine] == [
                (i, r["username"], r["rating"], r["comment"], r["timestamp"]) for i, r in enumerate(records)]
        assert len(rows) == 800


def test_items_are_read_from_their_folders(spark, tmp_path):
    df = spark.range(200).selectExpr("id % 20 AS game_id", "id AS n")
    writers.write_per_game(df, str(tmp_path / "i"), folders=8)
    assert len([p for p in (tmp_path / "i").iterdir() if p.name.startswith("folder=")]) <= 8
    some = readers.read_items(spark, str(tmp_path / "i"), df.schema, [3, 4], folders=8)
    assert sorted((r.game_id, r.n) for r in some.collect()) == sorted((i % 20, i) for i in range(200) if i % 20 in (3, 4))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder" in plan or "PartitionFilters: [isnotnull(folder" in plan
    assert readers.read_items(spark, str(tmp_path / "i"), df.schema).count() == 200
    assert readers.read_items(spark, str(tmp_path / "none"), df.schema).count() == 0
