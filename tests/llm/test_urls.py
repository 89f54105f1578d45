"""Trust over long chains, many links and loops, against the same sums in SQL."""

from __future__ import annotations

import math

from glosa.llm import queries, urls


def link(host: str) -> str:
    return f'<a href="https://{host}/x">x</a>'


def crawl() -> list[tuple]:
    """A chain of 15 hosts and 10,000 single ones that lead to a blocked host, hosts reached from an allowed one, and a loop."""
    rows = [("https://a.com/de/1", ""), ("https://site.org/1", link("near.net") + link("l0.net"))]
    rows += [(f"https://c{i}.net/1", link(f"c{i + 1}.net") if i < 14 else link("a.com")) for i in range(15)]
    rows += [(f"https://m{i}.net/1", link("a.com")) for i in range(10_000)]
    rows += [(f"https://l{i}.net/1", link(f"l{(i + 1) % 3}.net")) for i in range(3)]
    rows += [("https://near.net/1", link("far.net")), ("https://far.net/1", link("a.com")), (None, None), ("https://alone.net/", None)]
    return [(i, u, h) for i, (u, h) in enumerate(rows)]


def test_far_hosts_and_many_links(spark, tmp_path):
    import duckdb

    pages = spark.createDataFrame(crawl(), "page_id long, url string, html string").repartition(4)
    mine = {r.page_id: r for r in urls.filter_urls(pages, queries.RULES).collect()}
    pages.coalesce(1).write.parquet(str(tmp_path / "p"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'")
    rows = con.execute(queries.op9_sql()).fetchall()
    assert len(rows) == len(mine)
    for page_id, host, path, rule, verdict, trust, distrust in rows:
        r = mine[page_id]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
        assert math.isclose(r.trust, trust, rel_tol=1e-5, abs_tol=1e-8) and math.isclose(r.distrust, distrust, rel_tol=1e-5, abs_tol=1e-8)
    by_host = {r.host: r for r in mine.values()}
    assert all(by_host[f"c{i}.net"].verdict == "block" and by_host[f"c{i}.net"].distrust > 0 for i in range(15))
    assert all(by_host[f"m{i}.net"].verdict == "block" for i in range(10_000))
    assert by_host["near.net"].verdict == "allow" and by_host["l2.net"].verdict == "allow" and by_host["alone.net"].verdict == "allow"


def test_verdicts_do_not_fade_with_the_number_of_seeds(spark):
    """Very many seed pages at one allowed host: a host that links to the one blocked page stays blocked."""
    many = spark.range(200_000).selectExpr("id AS page_id", "concat('https://big.org/', id) AS url", "CAST(NULL AS STRING) AS html")
    few = spark.createDataFrame([(-1, "https://a.com/de/1", ""), (-2, "https://x.net/", link("a.com"))], many.schema)
    got = {r.page_id: r for r in urls.filter_urls(many.unionByName(few), queries.RULES).where("page_id < 0").collect()}
    assert got[-2].verdict == "block" and got[-2].distrust > 1


def test_empty_table_and_other_columns(spark):
    pages = spark.createDataFrame([(1, "https://b.net/", None, "x", 5)], "page_id long, url string, html string, host string, mass long")
    assert urls.filter_urls(pages.limit(0), queries.RULES).collect() == []
    row = urls.filter_urls(pages, queries.RULES).first()
    assert (row.host, row.verdict, row.trust) == ("b.net", "allow", 0.0)
    assert urls.filter_urls(pages, []).first().verdict == "allow"
