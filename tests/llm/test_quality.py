"""The quality model learns from every trusted row."""

import pytest

pytest.importorskip("glosa.llm.queries")

from glosa.llm import ngram_quality  # noqa: E402

WORDS = "table stone river light garden winter letter music orange market".split()


def test_no_trusted_row_is_left_out(spark):
    rows = [(i * 5000, " ".join(WORDS[(i * k + k * k) % 10] + str(i % 7) for k in range(30)), "en") for i in range(60)]
    docs = spark.createDataFrame([*rows, (7, None, "en"), (8, "", None)], "doc_id long, text string, lang string")
    many = spark.range(300_000).selectExpr("id AS doc_id")  # trusted labels, most of them of documents that are not here
    few = spark.createDataFrame([(r[0],) for r in rows], "doc_id long")
    got, want = (ngram_quality.score_documents(docs, ids).select("doc_id", "n", "score", "limit", "kept") for ids in (many, few))
    shown = lambda df: sorted((r.doc_id, r.n, r.kept, round(r.score or 0, 9), round(r.limit, 9)) for r in df.collect())
    assert shown(got) == shown(want)


def test_counts_of_trusted_rows_only(spark):
    texts = spark.createDataFrame([(1, 1, "abc"), (2, 1, "abd"), (2, 1, "abd"), (3, 1, "xyz")], "u long, v int, text string")
    chosen = spark.createDataFrame([(1, 1), (2, 1)], "u long, v int")
    counts = ngram_quality.trigram_counts(ngram_quality.packed_blocks(texts), chosen)
    code = lambda t: ord(t[0]) << 20 | ord(t[1]) << 10 | ord(t[2])
    assert {r.id: r.n for r in counts.collect()} == {
        code("\0\0a"): 3, code("\0ab"): 3, code("abc"): 1, code("abd"): 2}
