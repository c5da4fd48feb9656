"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. The derived
input tables are written first; that time is part of the total and also
reported apart. Every query runs in full into a no-op sink, twice; the better
time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spanledger.plans import registry, stored  # noqa: E402
from spanledger.session import local_session  # noqa: E402

HEADLINE = [
    "decode_topics",
    "decode_fill_data",
    "decode_refund_arrays",
    "stage_deposits",
    "stage_fills",
    "stage_refunds",
    "unified_deposits",
    "unified_fills",
    "refunds_expanded",
    "deposit_fill_matching",
    "fill_rate_by_route",
    "mart_general_overview",
    "mart_fill_latency",
    "mart_bridge_fee",
    "mart_route_concentration",
    "gas_enrichment",
    "append_dedup",
    "dq_address_format",
    "dq_reconcile",
    "raw_to_general_overview",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "spanledger-bench")
    start = time.perf_counter()
    stored.raw_logs(spark, sf_dir)
    stored.bridge_over_match(spark, sf_dir)
    stored.log_store(spark, sf_dir)
    setup = time.perf_counter() - start
    times = {name: round(min(timed(spark, name, sf_dir) for _ in range(2)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "input_setup_and_headline_queries_total",
                "value": round(setup + sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "input_setup_sec": round(setup, 3),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
