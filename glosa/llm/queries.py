"""Registered queries of the operators here, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosa.llm import bpe, collocations, decontaminate, langid, neardup, ngram_quality, packing, passages, runs, spotsigs, suffixes, urls, warc
from glosa.llm.tables import read
from glosa.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that stand under a repeated 200-byte string, removed from all documents."""
    done = suffixes.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per occurrence of a benchmark item; documents without one have no row."""
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through an archive and back."""
    path = scratch_dir(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), width=2)


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = ngram_quality.score_documents(read(spark, sf_dir, "documents"), trusted(spark, sf_dir))
    return done.select("doc_id", "lang", "n", F.exp("score").alias("perplexity"), F.exp("limit").alias("threshold"), "kept")


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with a fuzzy repeated passage; others have no row."""
    return passages.repeated_passages(read(spark, sf_dir, "documents"))


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.with_edits(read(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read(spark, sf_dir, "pages"), RULES)


def op9_sql(steps: int = 300, damping: float = 0.85) -> str:
    fits = []
    for verdict, rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
        host, _, rest = rule.partition("/")
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{rest}')", rule, verdict))
    rules = " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)
    verdicts = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    link = urls.LINK.replace("'", "''")
    return f"""
WITH RECURSIVE r AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
j AS (SELECT *, CASE {rules} END AS rule, CASE {verdicts} END AS ruled FROM h),
c AS (SELECT ruled AS kind, host, count(*) AS n FROM j WHERE ruled IS NOT NULL AND host <> '' GROUP BY ALL),
seeds AS (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) * sum(n) OVER () AS mass FROM c),
l AS (SELECT DISTINCT host AS src, translate(unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)), '{urls.UPPER}', '{urls.LOWER}') AS dst FROM h),
k AS (SELECT * FROM l WHERE src <> '' AND src <> dst),
b AS (SELECT 'allow' AS kind, src, dst FROM k UNION ALL SELECT 'block', dst, src FROM k),
edges AS (SELECT *, count(*) OVER (PARTITION BY kind, src) AS links FROM b),
moving AS (SELECT kind, host, mass * {1 - damping} AS mass, 0 AS step FROM seeds
  UNION ALL SELECT e.kind, e.dst, sum(m.mass * {damping} / e.links), step + 1
  FROM moving m JOIN edges e ON e.kind = m.kind AND e.src = m.host WHERE step < {steps} GROUP BY e.kind, e.dst, step),
t AS (SELECT host, sum(CASE WHEN kind = 'allow' THEN mass ELSE 0 END) AS trust,
      sum(CASE WHEN kind = 'block' THEN mass ELSE 0 END) AS distrust FROM moving GROUP BY host)
SELECT page_id, j.host, path, rule,
       coalesce(ruled, CASE WHEN coalesce(distrust, 0) - coalesce(trust, 0) > coalesce(distrust, 0) * {urls.SAME} THEN 'block' ELSE 'allow' END) AS verdict,
       round(coalesce(trust, 0), 9) AS trust, round(coalesce(distrust, 0), 9) AS distrust
FROM j LEFT JOIN t ON t.host = j.host
"""


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.hold_out(read(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op11_sql(threshold: int = 100, top: int = 2000) -> str:
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS m, list_slice(w, i, i + {k - 1}) AS g FROM (SELECT lang, w, unnest(generate_series(1, len(w) - {k - 1})) AS i FROM p)"
        for k in range(1, collocations.LONGEST + 1))
    return f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}') AS t FROM documents),
s AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS t FROM d),
p AS (SELECT lang, list_filter(regexp_split_to_array(t, '[\x20\x09]+'), lambda x: x <> '') AS w FROM s),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS (SELECT lang, m, array_to_string(g, ' ') AS phrase, g, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {threshold}),
inside AS (SELECT DISTINCT lang, array_to_string(list_slice(g, i, j), ' ') AS phrase, f FROM (
  SELECT lang, g, m, f, i, unnest(generate_series(i, m)) AS j FROM (SELECT lang, g, m, f, unnest(generate_series(1, m)) AS i FROM f)) WHERE j - i + 1 < m),
c AS (SELECT * FROM f WHERE m > 1 AND NOT EXISTS (FROM inside x WHERE x.lang = f.lang AND x.phrase = f.phrase AND 100 * x.f >= 100 * f.f)),
k AS (SELECT lang, phrase, g, m, f AS a, unnest(generate_series(1, m - 1)) AS k FROM c),
o AS (SELECT k.lang, k.phrase, k.k, k.a, x.f AS l, y.f AS r, n.n,
      CAST(1000 * CAST(k.a AS HUGEINT) * n.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM k JOIN n ON n.lang = k.lang
      JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(list_slice(k.g, 1, k.k), ' ')
      JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(list_slice(k.g, k.k + 1, len(k.g)), ' ')),
b AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY rank <= {top}
"""


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the vocabulary and back."""
    import public_tokenizers

    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    done = bpe.decode(bpe.encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents, a tenth of them with echoes put in."""
    found = runs.periodic_runs(runs.with_echoes(read(spark, sf_dir, "documents")))
    best = found.withColumn("best", runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


QUERIES: dict[str, Query] = {
    "op1_suffixes": op1_suffixes,
    "op2_decontaminate": op2_decontaminate,
    "op3_warc": op3_warc,
    "op4_neardup": op4_neardup,
    "op5_quality": op5_quality,
    "op6_passages": op6_passages,
    "op7_spotsigs": op7_spotsigs,
    "op8_packing": op8_packing,
    "op9_urls": op9_urls,
    "op10_langid": op10_langid,
    "op11_collocations": op11_collocations,
    "op12_bpe": op12_bpe,
    "op13_runs": op13_runs,
}


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": OP3_SQL, "op9_urls": op9_sql(), "op11_collocations": op11_sql()}
