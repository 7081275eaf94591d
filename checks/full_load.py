"""Load all 36 tables from landed JSON made from the test orders: ``python -m checks.full_load [sf_dir] [threads]``.

Prints the seconds of a first load, of a second one with a small extract, and of building every view on the result.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import source
from checks.compare import local_session
from ledgermill.operators.store import TableStore
from ledgermill.plans.builder import build_view
from ledgermill.plans.runlog import RunLog
from ledgermill.plans.sync import Warehouse, sync_tables
from ledgermill.plans.views import BUSINESS_VIEWS
from ledgermill.registry import load_registry
from ledgermill.session import scratch_path
from ledgermill.sources.landing import Landing
from ledgermill.specs import DAY, FLAG, INTEGER, KEY, MOMENT, NUMBER, REFERENCE, TableSpec


def records(spark: SparkSession, sf_dir: str, spec: TableSpec, newer_than: str | None = None) -> DataFrame:
    """One record per order with a value of the right kind in every field of the table."""
    key = F.col("o_orderkey")
    values = {
        KEY: key,
        REFERENCE: F.parse_json(
            F.when(key % 10 != 0, F.concat(F.lit("["), key, F.lit(', "a name"]'))).otherwise("false")
        ),
        FLAG: key % 2 == 0,
        INTEGER: key % 100,
        NUMBER: F.col("o_totalprice"),
        MOMENT: F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        DAY: F.date_format("o_orderdate", "yyyy-MM-dd"),
    }
    text = F.concat_ws(" ", F.col("o_orderpriority"), key.cast("string"))
    columns = [values.get(spec.kind(f), text).alias(f) for f in spec.with_keys().fields]
    orders = source(spark, sf_dir, "orders")
    if newer_than:
        orders = orders.where(F.col("o_orderdate") >= F.lit(newer_than).cast("timestamp_ntz"))
    return orders.repartition(8).select(F.to_json(F.struct(*columns)).alias("value"))


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    threads = int(argv[1]) if len(argv) > 1 else 8
    spark = local_session()
    root = scratch_path(spark, "full")
    house = Warehouse(Landing(spark, f"{root}/landing"), TableStore(spark, f"{root}/t"), RunLog(spark, f"{root}/t"))
    specs = load_registry()
    for spec in specs:
        records(spark, sf_dir, spec).write.text(f"{house.landing.path(spec)}/landed_batch=0")
    figures = {}

    def load(label: str) -> None:
        began = time.perf_counter()
        runs = sync_tables(house, specs, threads=threads)
        figures[label] = round(time.perf_counter() - began, 2)
        figures[f"{label}_rows"] = sum(r.records_synced for r in runs)
        problems = [(r.pg_table, r.status, r.error_message) for r in runs if r.status != "success"]
        if problems:
            raise RuntimeError(problems)

    load("first_load")
    for spec in specs:
        records(spark, sf_dir, spec, "2001-07-31").write.text(f"{house.landing.path(spec)}/landed_batch=1")
    load("small_load")
    tables = {s.name: s for s in specs}
    began = time.perf_counter()
    for view in BUSINESS_VIEWS.values():
        build_view(view, lambda n: house.store.read(tables[n])).write.format("noop").mode("overwrite").save()
    figures["all_views"] = round(time.perf_counter() - began, 2)
    print(json.dumps(figures))


if __name__ == "__main__":
    main(sys.argv[1:])
