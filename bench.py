"""Time the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from netloom.queries import all_queries  # noqa: E402
from netloom.session import build_session  # noqa: E402

HEADLINE = (
    "dt_hybrid", "pair_freq", "pair_evidence_top10", "pair_relatedness", "prediction_topn", "prediction_topn_one_pass",
    "alias_index_three_sources", "xref_index_full_join", "gene_database", "pathway_database", "node_matching",
    "entity_network", "interaction_network", "literature_network", "merge_edges", "annotate_dictionary",
    "category_filter", "incremental_pair_sum", "incremental_annotations", "forward_fill_stanza", "sql_dump_sentences",
    "stream_intake",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # Intermediate tables of this single-machine run.
    stages = os.environ.get("BENCH_STAGES", f"{Path.cwd()}/spark-warehouse/bench-stages")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g", spark__sql__session__timeZone="UTC",
        spark__checkpoint__dir=stages,
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    # Start the engine before the clock.
    queries["merge_nodes"](spark, folder).write.mode("overwrite").format("noop").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.mode("overwrite").format("noop").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
