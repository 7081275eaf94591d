"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then BENCH_REPEAT times (default 3); its time is the median, from building the
DataFrame to the last row written to the noop sink. Queries that keep tables write them to a new folder on each run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.compare import local_session
from checks.queries import QUERIES

HEADLINE = (
    "bi_ventas",
    "fact_columns_only",
    "bi_compras",
    "bi_facturas",
    "bi_apuntes_contables",
    "bi_crm",
    "bi_inventario",
    "bi_pagos",
    "bi_pos_ventas",
    "bi_pos_pagos",
    "bi_pos_sesiones",
    "sync_board",
    "run_summary",
    "log_parse",
    "typed_timestamps",
    "dedupe_latest",
    "upsert_insert_update",
    "sync_table",
    "rebuild",
    "stream_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    times = {}
    for name in names:
        taken = []
        for _ in range(repeat + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        times[name] = round(statistics.median(taken[1:]), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cores,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
