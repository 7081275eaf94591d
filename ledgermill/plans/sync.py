"""Incremental loads: one table, or all of them side by side."""

from __future__ import annotations

import hashlib
import logging
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.predicates import domain_filter, since
from ledgermill.operators.paging import record_cap
from ledgermill.operators.store import TableStore
from ledgermill.operators.upsert import UpsertResult, rebuild, upsert
from ledgermill.plans.runlog import Progress, Run, RunLog
from ledgermill.plans.views import register_views, sql_over_views
from ledgermill.registry import select_specs
from ledgermill.session import hadoop_path, path_exists
from ledgermill.sources.landing import Landing
from ledgermill.specs import TableSpec

logger = logging.getLogger(__name__)

PARSED = "_parsed-"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class Warehouse:
    """Where records land, where tables are kept, and how loads behave.

    ``reference_watermark`` starts from the finish time of the latest run if it succeeded, and else reads everything.
    ``overlap`` reads that much more before the mark; the upsert makes it harmless. ``replace_full`` makes a load of a
    table that is not incremental replace the table, so that rows the source dropped go; else they stay. ``keep_copy``
    makes upserts recoverable when the driver is lost during a commit. The views over the tables ``views_over`` (all that
    the views read) are registered anew after each load.
    """

    landing: Landing
    store: TableStore
    runlog: RunLog
    cap: int = 0
    batch_size: int = 500
    overlap: timedelta = field(default_factory=timedelta)
    arrival_wins: bool = False
    reference_watermark: bool = False
    replace_full: bool = False
    keep_copy: bool = True
    views_over: tuple[TableSpec, ...] = ()

    def __post_init__(self):
        if self.replace_full and self.cap:
            raise ValueError("a capped load reads a part of a table and cannot replace it")

    def refresh_views(self) -> None:
        """Register the views over the files as they are now; a view made before a load reads files that may be gone."""
        if self.views_over:
            tables = {s.name: s for s in self.views_over}
            register_views(lambda name: self.store.read(tables[name]), self.runlog.runs())

    def sql(self, text: str) -> DataFrame:
        """A statement over the views of ``views_over``, as the tables are now, which reads only the joins it needs."""
        tables = {s.name: s for s in self.views_over}
        return sql_over_views(
            self.store.spark, text, lambda spark, name: TableStore(spark, self.store.root).read(tables[name]), self.runlog.seen_by
        )


def changed_rows(house: Warehouse, spec: TableSpec, start: Progress, numbered: bool) -> DataFrame:
    """The typed records a load has to apply.

    New extracts are read whole: the upsert refuses what is older than the stored row. Only records that are not in
    numbered extracts, or a house with the reference's rule, are told apart by their date; one without a date passes.
    """
    rows = house.landing.read(spec, start.last_batch, start.upto).where(domain_filter(spec.domain))
    if start.mark is not None and (house.reference_watermark or not numbered):
        rows = rows.where(since(start.mark - house.overlap) | F.col("write_date").isNull())
    return rows


def parsed_once(house: Warehouse, spec: TableSpec, start: Progress, rows: DataFrame) -> DataFrame:
    """The records of a capped load, parsed by its first part; the later parts read the files that one has written.

    They lie beside the table until ``drop_parsed``. Their name tells what was read and how: a load of other extracts, or by
    other rules, or of files that have changed since, parses again.
    """
    spark = house.store.spark
    listed = []
    for folder in house.landing.folders(spec, start.last_batch, start.upto):
        fs, path = hadoop_path(spark, folder)
        listed += [(str(s.getPath()), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)]
    rules = (spec, start.mark, house.overlap, house.reference_watermark, sorted(listed))
    path = f"{house.store.root}/{spec.name}/{PARSED}{hashlib.sha256(repr(rules).encode()).hexdigest()[:32]}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        drop_parsed(house, spec)
        rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def drop_parsed(house: Warehouse, spec: TableSpec) -> None:
    """Delete the parsed records of capped loads: once the table is up to date."""
    fs, path = hadoop_path(house.store.spark, f"{house.store.root}/{spec.name}")
    for status in fs.listStatus(path) if fs.exists(path) else []:
        if status.getPath().getName().startswith(PARSED):
            fs.delete(status.getPath(), True)


def next_rows(house: Warehouse, rows: DataFrame, start: Progress) -> DataFrame:
    """The next rows by id under the cap; rows without an id come with the first ones, to be counted as rejected."""
    if start.last_id is not None:
        return record_cap(rows.where(F.col("id") > start.last_id), house.cap, house.batch_size)
    return record_cap(rows, house.cap, house.batch_size).unionByName(rows.where("id is null"))


def next_mark(started: datetime, newest: datetime | None, before: datetime | None) -> datetime | None:
    """The start of the load, or the newest change seen if that is earlier; unchanged without rows."""
    return before if newest is None else min(started, newest)


def sync_table(
    house: Warehouse, spec: TableSpec, full: bool = False, run_id: str | None = None, start: Progress | None = None
) -> Run:
    """Load one table and describe the run; the caller appends the row to the log."""
    started = utc_now()
    run_id = run_id or uuid.uuid4().hex

    def run(**facts) -> Run:
        ended = utc_now()
        return Run(run_id, spec.model, spec.name, started, ended, duration_seconds=(ended - started).total_seconds(),
                   **facts)

    try:
        if not house.landing.exists(spec):
            return run(status="skipped", error_message="no landed data for this model")
        spec = house.landing.resolve(spec)
        if start is None:
            start = house.runlog.progress(house.reference_watermark).get(spec.model, Progress())
        if full or not spec.incremental:
            start = Progress()
        batches = house.landing.batches(spec)
        if start.upto is None and batches:
            start = replace(start, upto=batches[-1])
        if not house.cap:
            start = replace(start, last_id=None, upto=batches[-1] if batches else None)
        rows = changed_rows(house, spec, start, bool(batches))
        if house.replace_full and not spec.incremental:
            facts = rebuild(house.store, spec, rows)
            return run(records_synced=facts.records, rejected=facts.rejected, bad_values=sum(facts.bad_values.values()),
                       mark=next_mark(started, facts.max_write_date, None), last_batch=facts.last_batch)
        if house.cap:
            rows = next_rows(house, parsed_once(house, spec, start, rows), start)
        facts = upsert(house.store, spec, rows, None, house.arrival_wins, house.keep_copy)
        counted = dict(records_synced=facts.records, rejected=facts.rejected, bad_values=sum(facts.bad_values.values()))
        if house.cap and facts.records >= house.cap:
            return run(status="partial", last_id=facts.last_id, last_batch=start.upto, **counted)
        drop_parsed(house, spec)
        mark = next_mark(started, facts.max_write_date, start.mark)
        return run(mark=mark, last_batch=start.upto, **counted)
    except Exception as problem:  # one table must not stop the others
        logger.exception("load of %s failed", spec.name)
        return run(status="error", error_message=str(problem))


def sync_tables(
    house: Warehouse,
    specs: Iterable[TableSpec],
    full: bool = False,
    only: Iterable[str] | None = None,
    threads: int = 8,
) -> list[Run]:
    """Load the enabled tables, several at a time in load order; each has its row in the run log as it ends."""
    chosen = select_specs(specs, only)
    run_id = f"{utc_now():%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    progress = house.runlog.progress(house.reference_watermark)
    spark = house.store.spark

    def one(spec: TableSpec) -> Run:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        done = sync_table(house, spec, full, run_id, progress.get(spec.model, Progress()))
        house.runlog.append([done])
        return done

    with ThreadPool(max(1, min(threads, len(chosen)))) as pool:
        runs = pool.map(inheritable_thread_target(spark)(one), chosen, chunksize=1)
    house.refresh_views()
    return runs


def rebuild_table(house: Warehouse, spec: TableSpec) -> UpsertResult:
    """Replace a table with everything that has landed; rows the source no longer has are gone afterwards."""
    spec = house.landing.resolve(spec)
    facts = rebuild(house.store, spec, house.landing.read(spec).where(domain_filter(spec.domain)))
    house.refresh_views()
    return facts
