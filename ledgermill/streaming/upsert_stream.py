"""The same upsert, driven by files as they land."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from ledgermill.functions.cleaning import clean
from ledgermill.functions.predicates import domain_filter
from ledgermill.operators.store import TableStore
from ledgermill.operators.upsert import upsert
from ledgermill.plans.runlog import Run, RunLog
from ledgermill.plans.sync import Warehouse, utc_now
from ledgermill.registry import select_specs
from ledgermill.sources.landing import Landing, raw_records
from ledgermill.specs import TableSpec


def stream_upsert(
    landing: Landing,
    store: TableStore,
    spec: TableSpec,
    checkpoint: str,
    every: str | None = None,
    max_files: int | None = None,
    arrival_wins: bool = False,
    runlog: RunLog | None = None,
    archive: str | None = None,
    refresh: Callable[[], object] | None = None,
) -> StreamingQuery:
    """Keep a table current from its landing folder.

    Without ``every`` the query takes what has landed and ends, for a scheduler that calls it again; with it (say,
    ``15 minutes``) the query keeps running. File arrival decides what is read, so a record with an old write_date is
    still taken, and the upsert refuses it only where the stored row is newer; fields a record lacks keep their value.
    A restart repeats the batch that was in flight, which the upsert makes harmless. Each batch has a row in ``runlog``.
    With ``archive`` files that were taken are moved there, so that the folder does not have to be listed for ever.
    ``refresh`` is called after each batch, when the files of the table have changed (``Warehouse.refresh_views``).
    """
    spec = landing.resolve(spec)
    reader = landing.spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    records = raw_records(reader.text(landing.path(spec)), spec)

    def apply(batch: DataFrame, number: int) -> None:
        started, run_id = utc_now(), f"stream-{number}-{uuid.uuid4().hex[:8]}"

        def log(**facts) -> None:
            ended = utc_now()
            seconds = (ended - started).total_seconds()
            if runlog:
                runlog.append([Run(run_id, spec.model, spec.name, started, ended, duration_seconds=seconds, **facts)])

        try:
            rows = clean(batch, spec, keep=("_batch", "_has")).where(domain_filter(spec.domain))
            done = upsert(TableStore(batch.sparkSession, store.root), spec, rows, arrival_wins=arrival_wins)
        except Exception as problem:
            log(status="error", error_message=str(problem))
            raise
        log(records_synced=done.records, rejected=done.rejected, bad_values=sum(done.bad_values.values()))
        if refresh:
            refresh()

    writer = records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stream_tables(
    house: Warehouse, specs: Iterable[TableSpec], checkpoints: str, every: str | None = None, **options
) -> dict[str, StreamingQuery]:
    """A stream for each enabled table that has a landing folder; one that fails leaves the others running.

    The views of the warehouse are registered anew after every batch of any of them.
    """
    options = {"refresh": house.refresh_views} | options
    landed = [s for s in select_specs(specs) if house.landing.exists(s)]
    return {
        s.name: stream_upsert(house.landing, house.store, s, f"{checkpoints}/{s.name}", every, runlog=house.runlog, **options)
        for s in landed
    }
