"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once untimed (class loading, code generation) and once timed;
every result row is produced and discarded.
"""

from __future__ import annotations

import json
import os
import time

from glosa.plans import catalog
from glosa.session import build_session

HEADLINE = [
    "label_distribution", "category_lexical_stats", "token_frequency_topk", "bigram_topk",
    "two_source_merge", "special_patterns", "hedge_window_join", "compositional_polarity",
    "undersample", "stratified_split", "tfidf_topk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__glosa__inputPartitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        run = catalog.QUERIES[name]
        for timed in (False, True):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if timed:
                seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
