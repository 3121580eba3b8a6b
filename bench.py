"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_REPEAT   timed runs per query, the best counts (default 2)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from recordwell.catalog import QUERIES  # noqa: E402
from recordwell.session import local_session  # noqa: E402

HEADLINE = (
    "clean_text", "dedup_keep_first", "dedup_hot_key", "priority_union", "dense_id", "gap_fill_by_key", "lookup_key",
    "fuzzy_pairs", "fuzzy_dedup", "containment_first_match", "container_delete", "dict_match", "soundex_match",
    "edit_distance_match", "edit_distance_words", "smart_dedup", "repair_places", "clean_places", "standardise_hospitals",
    "phone_international", "email_invalid", "duplicate_report", "pk_duplicates", "fk_orphans", "delete_cascade",
    "constraint_violations", "apply_actions", "merge_fill_missing", "sample_links", "batch_prompts", "model_repair",
    "search_attributes", "normalise_hospitals", "stream_clean",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = local_session(cpus, "recordwell-bench")
    timings: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            started = time.perf_counter()
            # building counts too: some operators look at their input before they plan
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        timings[name] = round(best, 3)
        print(f"{name} {best:.2f}s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
