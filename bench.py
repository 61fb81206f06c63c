"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the cores, BENCH_QUERIES (names separated
by commas, or ``all``) overrides the headline list.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "sector_exposure", "portfolio_holdings", "account_summary", "portfolio_context", "data_completeness",
    "structuring_accounts", "flow_rings", "coordinated_positions", "combined_risk", "suspicious_communities",
    "proposal_dedup", "enrichment_upsert", "upsert_nodes", "unique_key_violations",
    "node_degree", "pagerank", "fastrp", "node_similarity", "knn", "modularity",
    "html_sections", "chunk_fixed", "chunk_recursive", "chunk_postings", "vector_topk",
    "feature_table", "create_holdout", "stratified_folds", "score_unlabeled",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")

    from custgraph.plans.catalog import REGISTRY
    from custgraph.session import local_session

    names = list(REGISTRY) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = local_session(cores=cores, partitions=int(cores), memory="16g")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline query seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
