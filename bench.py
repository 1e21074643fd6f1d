"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the test tables, ``BENCH_CPUS`` the cores.  Each query is run once to warm
up and then timed to the last row, written to Spark's ``noop`` sink so that nothing is pruned.
"""

from __future__ import annotations

import json
import os
import time

from orderflow.catalog import QUERIES
from orderflow.session import local_session

HEADLINE = (
    "ingest_orders",
    "ingest_users",
    "ingest_drivers",
    "ingest_restaurants",
    "validate_orders",
    "order_delivery_chain",
    "chain_counts",
    "users_without_driver",
    "dedup_composite",
    "fk_orphans",
    "unique_email",
    "assign_keys",
    "pick_parent",
    "save_orders",
    "convert_csv_json",
    "convert_json_xml",
    "convert_xml_csv",
    "gen_users",
    "gen_orders",
    "gen_dependency_set",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times: dict[str, float] = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(run(name), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
