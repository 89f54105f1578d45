"""The operators against brute force on a small, awkward table."""

import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("glosa.llm.queries")

from glosa.llm import (  # noqa: E402
    components, decontaminate, langid, neardup, ngram_quality, packing, passages, queries, spotsigs, suffixes, urls, warc,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, u bigint"
rng = np.random.default_rng(7)
VOCABULARY = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(900)]


def prose(n):
    return " ".join(rng.choice(VOCABULARY, n))


PASSAGE = prose(60)
BASE = prose(150).split()


def edited(step):
    words = list(BASE)
    for k in range(step, len(words), 29):
        words[k] = f"new{step}x{k}"
    return " ".join(words)


TEXTS = [
    None, "", " \n\t ", "one", "Two Words", "two words", "Straße É 日本語 Ελλάδα", "a b c d e f",
    "na " * 400, prose(120), PASSAGE + " " + prose(40), prose(40) + " " + PASSAGE, prose(30) + " " + PASSAGE + " " + prose(30),
    " ".join(BASE), " ".join(BASE), *[edited(s) for s in range(8)], prose(2500), "The cat and the dog of the house in a big garden is red, the end.",
    "x" * 700, "y" * 199, "z" * 200, prose(80), "The,. It's I'LL <|endoftext|> x,y.",
]
ROWS = [(i, t, ["en", "de", None][i % 3], "s", 0, "clash", 5) for i, t in enumerate(TEXTS)]
ROWS += [(22, TEXTS[22], "de", "s", 0, "clash", 5), (None, prose(90), "en", "s", 0, "clash", 5), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "t")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def removed(rows, depth=200):
    places = defaultdict(int)
    data = [(r[1] or "").encode() for r in rows]
    for b in data:
        for p in range(len(b) - depth + 1):
            places[b[p : p + depth]] += 1
    out = []
    for b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - depth + 1):
            if places[b[p : p + depth]] > 1:
                gone[p : p + depth] = b"\1" * depth
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, kept))
    return out


@pytest.mark.parametrize("group", [4000, 1])
def test_suffixes(docs, monkeypatch, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    found = suffixes.remove_repeats(docs)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "u", *suffixes.RESULTS]
    mine = [
        (r.doc_id, r.text, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found.collect()]
    want = [(r[0], r[1], *x) for r, x in zip(ROWS, removed(ROWS))]
    assert sorted(mine, key=repr) == sorted(want, key=repr)


def test_near_duplicate_pairs_come_once(spark):
    """Two sets that share three nodes are one pair, not three; sets of one component are none."""
    members = spark.createDataFrame(
        [(p, k, g, 3, root) for p, k in enumerate((-5, 7, 9)) for g, root in ((1, 1), (2, 2), (3, 2))] + [(3, 11, 1, 2, 1), (3, 11, 4, 2, 4)],
        "path int, key bigint, g bigint, members bigint, root bigint")
    info = spark.createDataFrame([(g, 10, 0, 0, 0, 0) for g in range(1, 5)], "g bigint, n bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint")
    assert sorted((r.a, r.b) for r in neardup._crossed(members, info).collect()) == [(1, 2), (1, 3), (1, 4)]


def test_near_duplicates_leave_no_stages(spark):
    """What only the search for links wrote is gone with it, and the result can still be read."""
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    words = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join([*words[:50], *(f"x{i}y{k}" for k in range(i % 3))])) for i in range(30)] + [(40, "other words here " * 3), (41, None)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=2)
    left = set(os.listdir(shared)) - before
    assert {r.doc_id: r.component_id for r in found.collect()} == {**dict.fromkeys(range(30), 0), 40: 40, 41: 41}
    assert len(left) <= 6


def test_parities_differ_by_no_more_bits_than_shingles(spark):
    """Sets a fraction over the threshold pass the sieve, sets that the minima alone let through do not."""
    rng = np.random.default_rng(5)
    same, one, two = (rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (300, 37, 37))
    def odd(*parts):
        sets = object.__new__(neardup.Sets)
        sets.values = np.concatenate(parts)
        sets.size = np.array([len(sets.values)])
        sets.bounds = np.array([0, len(sets.values)])
        return neardup._parities(sets)[0].view(np.int64).tolist()

    names = [*neardup.SKETCH, *neardup.PARITY]
    members = spark.createDataFrame([(0, 7, g, 3, g) for g in (1, 2, 3)], "path int, key bigint, g bigint, members bigint, root bigint")
    info = spark.createDataFrame(
        [(1, 337, 0, 0, 0, 0, *odd(same, one)), (2, 337, 0, 0, 0, 0, *odd(same, two)), (3, 337, 0, 0, 0, 0, *odd(same[:220], one, rng.integers(0, 1 << 62, 80).astype(np.uint64)))],
        "g bigint, n bigint, " + ", ".join(f"{n} bigint" for n in names))
    assert [(r.a, r.b) for r in neardup._crossed(members, info).collect()] == [(1, 2)]


def test_suffixes_of_nothing_and_whole_characters(spark, empty):
    assert suffixes.remove_repeats(empty).count() == 0
    two = spark.createDataFrame([(1, "é" * 150 + "a"), (2, "b" + "é" * 150)], "doc_id bigint, text string")
    kept = {r.doc_id: r.kept for r in suffixes.remove_repeats(two, as_text=True).collect()}
    assert kept == {1: "a", 2: "b"}


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, width):
    rows = [r for r in ROWS if r[0] is not None]
    sets = {r[0]: shingles(r[1], width) for r in rows}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    found = neardup.near_duplicates(docs, width=width).collect()
    assert len(found) == len(ROWS)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), top(r.doc_id), top(r.doc_id) == r.doc_id)
    kept = neardup.keep_one(docs, width=width)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect())
    assert ids == sorted({i for i in sets if top(i) == i})


def test_near_duplicates_of_nothing(empty):
    assert neardup.near_duplicates(empty).count() == 0


def test_components(spark):
    n = 300
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, n, (220, 2))] + [(1000 + k, 1001 + k) for k in range(40)] + [(2000, 2000 + k) for k in range(1, 50)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    found = {r.a: r.b for r in components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == {x: top(x) for x in root if top(x) != x}


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain = Tokenizer.from_file(path)
    ids = {r[0]: [*plain.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in ROWS if r[0] is not None}
    pieces = packing.pack(docs, path, max_len=256).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces) and all(p.offset == 0 for p in pieces)
    got = defaultdict(dict)
    for p in pieces:
        assert p.length & (p.length - 1) == 0 and p.length <= 256
        if p.doc_id is not None:
            part = np.asarray(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()
            assert (p.ids_crc32, p.doc_tokens) == (zlib.crc32(part), len(ids[p.doc_id]))
            got[p.doc_id][p.start] = p.length
    for key, parts in got.items():
        at = 0
        for start in sorted(parts):
            assert start == at
            at += parts[start]
        assert at == len(ids[key])
    assert packing.pack(empty, path).count() == 0


def test_decontaminate(spark, docs, empty):
    noisy = PASSAGE[:100].upper() + "," + PASSAGE[100:140] + "q" + PASSAGE[142:]
    bench = spark.createDataFrame([(1, noisy), (2, prose(30)), (3, None), (4, "?!"), (5, "big garden is red")], "item_id bigint, text string")
    hits = decontaminate.find_leaks(docs, bench).collect()
    holders = {r[0] for r in ROWS if r[1] and PASSAGE in r[1]}
    assert {(h.doc_id, h.item_id) for h in hits} == {(d, 1) for d in holders} | {(24, 5)}
    texts = dict(r[:2] for r in ROWS)
    assert all(texts[h.doc_id][h.start : h.end] in (PASSAGE, "big garden is red") for h in hits)
    left = decontaminate.without_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == len(ROWS) - len(holders) - 1
    assert decontaminate.find_leaks(empty, bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.where("false")).count() == 0


def test_alignment_finds_the_least_edits():
    code = lambda s: np.array([ord(c) for c in s])
    item, text = code("kitten sits"), code("the sitten sat here")
    assert decontaminate.align(item, text, 0, 12, 9)[0] == 3
    assert decontaminate.align(item, code("xx kitten sits"), 0, 12, 9) == (0, 14)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"https://{h}/{p}", b) for i, (h, p, b) in enumerate([
        ("a.example.org", "es/1", "x" * 200), ("a.Example.org", "en/12", "x" * 200), ("b.org", "en", "x" * 200),
        ("c.com", "fr/x", "small"), ("c.com", "de/x", "small"),
        ("d.net", "", '<a href="https://c2.com/fr">t</a> <a HREF=//b.org/x>u</a>' + "é" * 90),
        ("e.net", "?q", '<a href="http://bad.com/de/">t</a>' * 5), ("bad.com", "de/1", None), ("org", "x#y", ""),
    ])]
    rows += [(9, None, "x" * 200), (10, "no url", None), (0, "https://a.example.org/es/1", "x" * 200), (None, "http://q.net/a\r\nb %41", "x" * 200)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_warc_round_trip(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    back = warc.read_archive(spark, path).collect()
    rows = pages.collect()
    assert sorted((str(r.page_id), r.url) for r in back) == sorted((str(r.page_id), r.url or "") for r in rows)
    for r in back:
        body = next((p.html or "") for p in rows if p.page_id == r.page_id).encode()
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        twin = len(body) >= 100 and body == b"x" * 200 and r.page_id != 0
        assert (r.record_type, r.refers_to) == (("revisit", 0) if twin else ("response", None))
        assert twin or bytes(r.payload) == body
    index = warc.build_index(spark, path)
    ids = spark.createDataFrame([(5,), (2,)], "page_id bigint")
    got = {r.page_id: r for r in warc.lookup(spark, path, index, ids).collect()}
    assert set(got) == {2, 5} and bytes(got[5].payload).decode() == rows[5].html and got[2].refers_to == 0
    import zstandard
    file = next(f for f in os.listdir(path) if f.startswith("part-"))
    raw = open(os.path.join(path, file), "rb").read()
    assert raw[-5:] == warc.TAIL and zstandard.ZstdDecompressor().decompress(raw[: warc.seek_table(raw)[0][1]]).startswith(b"WARC/1.1")


def test_empty_archive(spark, pages, tmp_path):
    warc.write_archive(pages.where("false"), str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0


def test_urls_against_sql(pages, tmp_path):
    import duckdb

    mine = [tuple(r) for r in urls.filter_urls(pages, queries.RULES).collect()]
    pages.coalesce(1).write.parquet(str(tmp_path / "p"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'")
    assert sorted(map(repr, mine)) == sorted(map(repr, con.execute(queries.op9_sql()).fetchall()))
    verdict = {r[0]: r[4] for r in mine}
    assert verdict[6] == "block" and verdict[5] == "allow" and verdict[10] == "allow"


def test_fingerprints(docs, empty):
    rows = {(r[0], r[1] or "") for r in ROWS if r[0] is not None}
    texts = [t for _, t in sorted(rows, reverse=True)]
    tail = [r[1] or "" for r in ROWS if r[0] is None]
    found = {r.doc_id: r for r in spotsigs.with_edits(docs).collect() if r.doc_id is not None}
    order = sorted(found, reverse=True)
    for k, i in enumerate(order[:-1]):
        text, nxt = texts[k], texts[k + 1]
        n = len(text) // 3
        want = text[: len(text) - n] + nxt[:n]
        assert found[i].edited_sha256 == hashlib.sha256(want.encode()).hexdigest() and found[i].n_chars == len(text)
        a, b, c = (set(x.split()) for x in (found[i].fingerprint, found[i].edited_fingerprint, found[order[k + 1]].fingerprint))
        assert found[i].near_edited == pytest.approx(len(a & b) / len(a | b))
        assert found[i].near_next == pytest.approx(len(a & c) / len(a | c))
    assert found[13].fingerprint == found[14].fingerprint and len(tail) == 2
    assert spotsigs.with_edits(empty).count() == 0


def test_fingerprint_pairs(docs):
    some = docs.where("doc_id IS NOT NULL")
    sets = {}
    for r in some.select("doc_id", spotsigs.spots(spotsigs.F.coalesce("text", spotsigs.F.lit(""))).alias("s")).collect():
        key = frozenset(r.s)
        sets[key] = min(r.doc_id, sets.get(key, r.doc_id))
    want = {frozenset((i, j)) for a, i in sets.items() for b, j in sets.items() if i < j and 100 * len(a & b) >= 80 * len(a | b)}
    assert {frozenset((r.a, r.b)) for r in spotsigs.near_pairs(some).collect()} == want


def test_language_identification(spark, sf, empty):
    table = queries.read(spark, sf, "documents")
    found = langid.hold_out(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred <> 'und'")
    right = found.agg({"held_out": "count"}).first()[0], found.where("lang = lang_pred").count()
    assert right[1] >= 0.9 * right[0]
    assert langid.hold_out(empty).count() == 0


def test_language_edges(docs):
    found = {r.doc_id: r for r in langid.hold_out(docs).collect() if r.doc_id is not None}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (0, 1, 2))
    assert found[3].lang_pred in ("en", "de") and all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())


def test_quality_model(spark, docs, empty):
    trusted = docs.where("doc_id IN (9, 10, 11, 12, 13, 23)").select("doc_id")
    good = ngram_quality.score_documents(docs, trusted).collect()
    assert len(good) >= len(ROWS) and not any(r.kept for r in good if not r.n)
    by = {r.doc_id: r for r in good if r.doc_id is not None}
    assert by[25].score > by[28].score and not by[25].kept and by[9].kept
    kept = ngram_quality.keep_good(docs, trusted)
    assert kept.columns == docs.columns and kept.where("doc_id = 25 OR text IS NULL").count() == 0
    assert ngram_quality.score_documents(empty, trusted).count() == 0
    assert all(r.kept for r in ngram_quality.score_documents(docs, trusted.where("false")).collect() if r.n)


def test_passages(docs, empty):
    found = {r.doc_id: r for r in passages.repeated_passages(docs).collect()}
    assert {10, 11, 12, 13, 14, *range(15, 23)} <= set(found) and not {9, 23, 28} & set(found)
    words = lambda i: TEXTS[i].split()
    for i in (10, 11, 12):
        (span,) = found[i].spans
        assert PASSAGE in " ".join(words(i)[span.start : span.end]) and span.end - span.start < 70
    assert len({found[i].class_id for i in (10, 11, 12)}) == 1
    assert passages.repeated_passages(empty).count() == 0


def test_chains_beat_brute_force():
    for _ in range(30):
        matches = [tuple(map(int, m)) for m in rng.integers(0, 40, (25, 2))]
        order = sorted(set(matches))
        best = [1.0] * len(order)
        for k, (i, j) in enumerate(order):
            for p, (x, y) in enumerate(order[:k]):
                if x < i and y < j:
                    best[k] = max(best[k], 1 + best[p] - passages.GAP * (i - x + j - y))
        score = lambda c: sum(1 for _ in c) - passages.GAP * (c[-1][0] - c[0][0] + c[-1][1] - c[0][1])
        assert score(passages.chains(matches)[0]) == pytest.approx(max(best))


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = queries.read(spark, sf, "documents")
    last = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, last, sf)
        assert out.columns == docs.columns, name
        path = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"test-{name}")
        out.write.parquet(path)
        last = spark.read.parquet(path)
        assert 0 < last.count() <= docs.count() and last.schema == docs.schema, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, last, sf)
    assert pieces.select("doc_id").distinct().count() == last.select("doc_id").distinct().count()
