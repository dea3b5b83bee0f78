"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from checks.queries import QUERIES
from yardstar.session import build_session
from yardstar.sources.testbed import testbed

HEADLINE = (
    "fact_rental",
    "fact_reservation",
    "dim_vehicle",
    "dim_client",
    "surrogate_keys",
    "resolve_return_yard",
    "yard_snapshot",
    "report_a_yard_control",
    "report_b_rental_control",
    "report_b_monthly",
    "report_c_reservations",
    "report_c_next_week",
    "report_d_group_by_city",
    "report_d_top10",
    "markov_counts",
    "markov_matrix",
    "markov_steady_state",
    "src_groups_by_city",
    "audit_unique",
    "audit_order",
    "audit_unresolved",
    "expand_quantities",
)


def run(df: DataFrame) -> None:
    """Execute the whole plan without keeping the rows."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "yardstar-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    bed = testbed(spark, sf_dir)
    timed("land_rentals", lambda: bed.rentals)
    timed("warehouse_load", lambda: bed.warehouse)
    for name in HEADLINE:
        timed(name, lambda: run(QUERIES[name](spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "fleet warehouse: load and headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
