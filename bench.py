"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Each query runs BENCH_RUNS times (default 3) in one
session and its results are consumed by the no-op sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from drydock import catalog  # noqa: E402
from drydock.session import local_session  # noqa: E402

HEADLINE = (
    "profile_tables", "profile_first_valid_date", "profile_integer_dates", "valid_dates_only",
    "standardize_lineitem", "coerce_ids", "infer_types", "apply_types", "null_tokens", "union_members",
    "decode_text", "classify_dataset", "archive_roundtrip", "archive_documents", "ingest_report",
    "ingest_publish", "incremental_ingest", "landing_reconcile", "inventory_totals",
    "dictionary_last_wins", "variable_keep_first", "describe_columns", "section_counts",
    "explode_lines", "forward_fill", "segment_turns", "assemble_pages", "parse_stanzas",
    "clean_tables", "dictionary_strategy", "column_catalog",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries = catalog.queries()
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {[round(t, 2) for t in times]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": os.environ.get("BENCH_CPUS", "8"), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
