"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from weftgraph.catalog import all_queries
from weftgraph.session import local_session

HEADLINE = (
    "flagship_top_parts_of_segment",
    "g8_list_facts",
    "j2_two_hops_same_type",
    "j3_variable_length_paths",
    "j4_reachable_any_type",
    "j5_traverse_outbound",
    "j10_relationship_triples",
    "a2_count_by_type",
    "a7_rank_in_list",
    "v2_knn_cosine",
    "v2_knn_l2",
    "v3_similarity_search",
    "v5_approximate_knn",
    "t1_text_index",
    "t2_bm25_search",
    "t3_boolean",
    "t4_phrase",
    "t5_prefix",
    "t7_fuzzy",
    "t10_keyword_search",
    "x1_graph_and_vector",
    "x2_reciprocal_rank_fusion",
    "x3_weighted_fusion",
    "u1_upsert_by_name",
    "u3_upsert_edges",
    "u4_graph_document_edges",
    "u8_save_facts",
    "d1_delete_edges",
    "s1_infer_labels",
)


def run_once(run, spark, folder: str) -> float:
    """Seconds to plan the query and compute every row of it."""
    began = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, partitions=cpus)
    registered = all_queries()
    # The first query of a JVM pays for class loading; it is run once before the clock starts.
    run_once(registered[HEADLINE[0]], spark, folder)
    seconds = {name: round(run_once(registered[name], spark, folder), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
