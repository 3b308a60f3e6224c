"""Time the headline queries and print one JSON line.

The freight-shaped tables are derived from the star schema and stored once; the time that takes is
reported as ``prepare_sec`` and not counted, as a query reads stored tables in practice. Every
query then runs whole, all of its output produced and dropped. Each runs BENCH_RUNS times (2 unless
set) and counts with its best time, so that the start of the JVM does not weigh in.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from packetmill.plans import fixtures  # noqa: E402
from packetmill.plans.catalog import QUERIES  # noqa: E402
from packetmill.session import local_session, scratch_dir  # noqa: E402

HEADLINE = [
    "a1_scan_manifest", "d1_worklist", "g1_ordered_worklist", "g3_skip_report", "c3_triage", "b5_multi_manifest_lines",
    "e2_page_confidence", "e3_doc_confidence", "d4_docs_to_pages", "verified_documents", "e13_packet_detail",
    "e9_usage_tally_by_load", "h8_build_packets", "h1_flatten_documents", "b1_write_packets", "c14_conformance",
    "i11_load_reference", "f2_bol_copies", "i12_documents_classified", "i13_rate_confirmations", "d5_load_overview",
    "b7_export_ml", "j1_ingest_incremental", "k1_apply_extractor",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    start = time.perf_counter()
    fixtures.store(spark, sf_dir, scratch_dir(spark, "bench"))
    prepared = time.perf_counter() - start
    seconds = {}
    for name in names:
        times = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline query seconds, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "prepare_sec": round(prepared, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
