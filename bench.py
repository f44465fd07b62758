"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from stratastar.examples import QUERIES, Tables
from stratastar.session import build_session

HEADLINE = (
    "p1_silver_lines",
    "j2_star_fact",
    "j10_drill_across",
    "a3_duplicates",
    "a8_sum",
    "w1_latest",
    "w1_latest_ties",
    "u1_dim_date",
    "u4_quality_log",
    "r6_secured_fact",
    "t2_unique",
    "c5_days_to_process",
    "b14_transitions",
    "b14_transitions_skewed",
    "silver_ventes_immobilieres",
    "dim_lot_immobilier",
    "fact_vente",
    "measures_by_year",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    tables.lineitem.where("l_quantity > 0").groupBy("l_returnflag").count().collect()
    # The first run includes compilation and building what a query looks up; the second runs warm.
    seconds, warm = {}, {}
    for times in (seconds, warm):
        for name in HEADLINE:
            started = time.perf_counter()
            QUERIES[name](tables).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "warm": warm,
                "warm_total": round(sum(warm.values()), 3),
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
