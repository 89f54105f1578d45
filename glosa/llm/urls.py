"""URL filter: host and path rules, and trust that flows over the links between hosts.

Where no rule fits, a personalised PageRank decides: trust starts at hosts with allowed
pages and follows links, distrust starts at hosts with blocked pages and follows links
backwards (who links to a blocked host is suspect).  A host is blocked when its distrust
exceeds its trust by more than the share ``margin`` of it; differences below ``SAME`` of it are none.
Both kinds start with the same mass in all, one unit per seed page on average, so values do not fade as the crawl
grows.  Mass that reaches a host without links leaves the graph.  DataFrame operations only.

Only what arrived in the last step is passed on, and the steps are summed.  They end when nothing moves any more
or when no host gets more than the share ``tolerance`` of what it has; there is no limit to their number.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no
rule and is allowed; links without a host and links inside a host are no edges; a
page that is repeated is judged each time and counts each time as a seed; null html has
no links; without seeds every host is allowed; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosa.llm.tables import quoted
from glosa.session import cut_lineage

#: Steps between two looks at what still changes; share of a mass that sums in another order may differ by.
STEPS, SAME = 8, 1e-6
#: (verdict, host/path-prefix)
Rule = tuple[str, str]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\shref\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    if out is None:
        out = F.lit(None).cast("struct<rule:string,verdict:string>")
    return out


def judge_pages(pages: DataFrame, rules: list[Rule], key: str = "page_id") -> DataFrame:
    host, path = host_and_path(quoted("url"))
    rows = pages.select(quoted(key).alias(key), F.coalesce(host, F.lit("")).alias("host"),
                        F.coalesce(path, F.lit("")).alias("path"))
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    return rows.select("*", fit["rule"].alias("rule"), fit["verdict"].alias("ruled"))


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) between different hosts; a page's links are made distinct before the shuffle."""
    host, _ = host_and_path(quoted("url"))
    links = F.array_distinct(F.regexp_extract_all(F.coalesce(quoted("html"), F.lit("")), F.lit(LINK), 1))
    each = pages.select(F.coalesce(host, F.lit("")).alias("src"), F.explode(links).alias("link"))
    dst = F.translate("link", UPPER, LOWER)
    return each.select("src", dst.alias("dst")).where((F.col("src") != "") & (F.col("src") != F.col("dst"))).distinct()


def propagate(seeds: DataFrame, edges: DataFrame, damping: float, tolerance: float) -> DataFrame:
    """(kind, host, mass) that seeds (kind, host, mass) spread along edges (kind, src, dst).

    Every step is written to the shared folder, so plans stay short and lost executors cost one step.
    """
    out_degree = edges.groupBy("kind", "src").agg(F.count("*").alias("links"))
    weighted = cut_lineage(edges.join(cut_lineage(out_degree), ["kind", "src"]))
    moving = cut_lineage(seeds.select("kind", "host", (F.col("mass") * (1 - damping)).alias("mass")))
    total, recent = moving, []
    while True:
        moved = moving.withColumnRenamed("host", "src").join(weighted, ["kind", "src"]).groupBy("kind", F.col("dst").alias("host")).agg(
            F.sum(F.col("mass") * damping / F.col("links")).alias("mass"))
        moving = cut_lineage(moved)
        if moving.isEmpty():
            return reduce(DataFrame.unionByName, recent, total).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        recent.append(moving)
        if len(recent) == STEPS:
            total = cut_lineage(reduce(DataFrame.unionByName, recent, total).groupBy("kind", "host").agg(F.sum("mass").alias("mass")))
            recent = []
            share = moving.withColumnRenamed("mass", "last").join(total, ["kind", "host"]).agg(F.max(F.col("last") / F.col("mass")).alias("m"))
            if share.first()["m"] <= tolerance:
                return total


def filter_urls(
    pages: DataFrame, rules: list[Rule], damping: float = 0.85, margin: float = 0.0, tolerance: float = 1e-7, key: str = "page_id",
) -> DataFrame:
    """Per page: host, path, rule, verdict, and the host's trust and distrust (0 where none arrived)."""
    judged = judge_pages(pages, rules, key)
    counts = cut_lineage(
        judged.where(F.col("ruled").isNotNull() & (F.col("host") != "")).groupBy("ruled", "host").agg(F.count("*").alias("pages")))
    totals = counts.groupBy("ruled").agg(F.sum("pages").alias("all"))
    every = counts.agg(F.sum("pages")).scalar()
    seeds = counts.join(totals, "ruled").select(
        F.col("ruled").alias("kind"), "host", (F.col("pages") / F.col("all") * every).alias("mass"))
    links = cut_lineage(host_edges(pages))
    edges = links.select(F.lit("allow").alias("kind"), "src", "dst").unionByName(
        links.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    mass = propagate(seeds, edges, damping, tolerance)
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0))
    hosts = cut_lineage(mass.groupBy("host").agg(of("allow").alias("trust"), of("block").alias("distrust")))
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when(distrust - trust > distrust * max(margin, SAME), "block").otherwise("allow")
    return judged.join(hosts, "host", "left").select(
        key, "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"),
        F.round(trust, 9).alias("trust"), F.round(distrust, 9).alias("distrust"))
