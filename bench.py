"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Every
query starts from the tables, so each time includes the collapse of the log.
"""

from __future__ import annotations

import json
import os
import sys
import time

from breachscope.plans.queries import registry
from breachscope.session import local_session

HEADLINE = [
    "clean_incidents",
    "q01_kpi_summary",
    "q02_priority_sla",
    "q04_resolution_distribution",
    "q05_resolution_by_priority",
    "q06_category_sla",
    "q09_breach_concentration",
    "kpi_closure",
    "sla_monthly",
    "sla_category",
    "sla_assignment_group",
    "bottlenecks",
    "risk_reference",
    "risk_scores",
    "risk_portfolio",
    "risk_concentration",
    "v02_risk_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    available = registry()

    def run(name: str) -> float:
        start = time.perf_counter()
        available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("q02_priority_sla")  # start-up and class loading are not part of any query
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir),
            }
        )
    )
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
