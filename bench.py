"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is run to completion with the ``noop`` sink (full evaluation, no
collect), once to warm up and then ``$BENCH_REPEAT`` times; the per-query
figure is the median. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import load_all  # noqa: E402
from tidemark.session import get_session  # noqa: E402

HEADLINE = [
    "cpsc_combined",            # flagship: dedupe + 2-key left join + lineage
    "cpsc_combined_summary",
    "one_per_key",              # latest record per key (skew-safe min-struct)
    "ordered_concat",           # ordered label concatenation per key
    "attach_dictionary",        # fact x dictionary (broadcast by its measured size)
    "parse_money",              # text parsers
    "parse_zoned_timestamp",
    "parse_period",
    "clean_text",               # whole documents
    "extract_links",            # whole pages
    "stamped_name",
    "canonical_names",          # pair-free typo resolution
    "remap_field_deep",         # nested rewrite
    "matrix_to_long",           # report matrix reshape
    "load_by_dictionary",       # dictionary-typed load
    "replace_slice_by_file",    # slice replacement sink
]

# measured as well, beside the headline total
MORE = ["display_matrix_to_long", "cutpoints_to_long", "typo_map_distance2", "upsert", "upsert_partitioned",
        "csv_quoted_round_trip", "wide_matrix", "replace_slice_by_date", "evolve_schema", "upsert_buckets", "records_with_breaks", "drifting_headers"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", app="tidemark-bench",
                        shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g")})
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    names = [n for n in HEADLINE + MORE if n in reg]

    def run(name: str) -> float:
        t = time.perf_counter()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    results, errors = {}, {}
    for name in names:
        try:
            run(name)  # warm-up
            results[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
        except Exception as e:  # noqa: BLE001 - report and go on with the others
            results[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    total = round(sum(results.get(n) or 0 for n in HEADLINE), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_queries_total_median", "value": total, "unit": "sec",
           "queries": results, "sf": sf, "cpus": int(cpus), "repeat": repeat}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
