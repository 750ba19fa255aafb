"""Time the headline queries on one machine and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark import build_session
from tidemark.plans import catalog

HEADLINE = (
    "a4_lca_cascade",
    "a5_lca_collapsed",
    "a6_assign_from_hits",
    "w8_best_hits_per_query",
    "j4_link_taxonomy",
    "a7_clean_subtract",
    "a8_cleaning_report",
    "u3_p16_occurrences",
    "w6_total_reads_per_event",
    "p24_darwin_core_records",
    "a10_collapse_replicates",
    "j9_enrich_higher_ranks",
    "a20_top_species",
    "a24_control_features",
    "v7_normalise_dates",
    "a30_migrate_manifest",
    "j14_tracking_table",
    "a1_dereplicate_samples",
    "a3_otu_counts",
    "r2_trim_five_prime",
    "r5_quality_filter",
    "r6_merge_mates",
    "r7_cluster_members",
    "r10_chimera_calls",
    "r12_denoise",
    "r16_exact_species",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        app="tidemark-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(2 * int(cpus)),
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog()
    registered["u3_p16_occurrences"].run(spark, sf_dir).limit(1).collect()  # start the executor
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        registered[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
