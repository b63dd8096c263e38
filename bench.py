"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 4)
    BENCH_QUERIES comma list of registered queries, or "all" (default: the headline list)

Every query is run to the end into Spark's noop sink, so all rows and columns are computed. One warm-up query is run
first and not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "edge_strength_by_year", "node_ranking", "item_neighbours", "connected_components", "label_communities",
    "work_grouping", "person_consolidation", "leader_resolution", "mention_resolution", "vector_calibrate",
    "topk_similarity", "unit_proximity", "top3_reference_confidence", "hash_cache_refresh", "semantic_text", "dictionary_tags", "dictionary_tags_104", "place_grades",
    "location_cascade", "class_terms", "pair_keywords", "specialisation", "growth_keywords", "gap_index",
    "territorial_rollup", "programme_matrix", "who_works_on_it", "product_theme_network", "enrichment_row",
]


def main() -> None:
    from foliograph.catalog import load
    from foliograph.plans.session import local_session

    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    queries = load()[0]
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "4"), os.environ.get("BENCH_MEMORY", "6g"))
    queries["totals_by_kind"](spark, directory).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, directory).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    sf = re.search(r"sf([\d.]+)", directory)
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else None}))


if __name__ == "__main__":
    main()
