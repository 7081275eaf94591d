import contextlib

from pyspark.errors import StreamingQueryException

from ledgermill.operators.store import TableStore
from ledgermill.plans.sync import Warehouse, sync_table
from ledgermill.plans.runlog import RunLog
from ledgermill.registry import load_registry
from ledgermill.sources.landing import Landing
from ledgermill.specs import TableSpec
from ledgermill.streaming.upsert_stream import stream_tables, stream_upsert
from tests.test_cleaning import land
from tests.test_sync import SPEC, order


def drain(landing, store, checkpoint, **options):
    query = stream_upsert(landing, store, SPEC, str(checkpoint), **options)
    query.awaitTermination()
    return query


def rows(store):
    return {r.id: (r.name, r.write_date) for r in store.read(SPEC).collect()}


def test_a_stream_ends_with_the_table_of_the_batch_load(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "landing"))
    streamed, loaded = TableStore(spark, str(tmp_path / "streamed")), TableStore(spark, str(tmp_path / "loaded"))
    extracts = [
        [order(1, "a", 1), order(2, "b", 5, amount_total=4.0)],
        [{"id": 2, "amount_total": 5.0, "write_date": "2024-01-06 00:00:00"}, {"id": 5, "name": "e"}],
        [order(1, "a2", 2), order(2, "late", 3), order(3, "c", 1)],
        [order(1, "a3", 2), order(4, "d", 1)],
    ]
    for n, records in enumerate(extracts):
        land(tmp_path / "landing", "sale_order", records, n)
        drain(landing, streamed, tmp_path / "checkpoint")
    house = Warehouse(landing, loaded, RunLog(spark, loaded.root))
    assert sync_table(house, SPEC).status == "success"
    assert rows(streamed) == rows(loaded)
    assert {i: n for i, (n, _) in rows(streamed).items()} == {1: "a3", 2: "b", 3: "c", 4: "d", 5: "e"}
    assert streamed.read(SPEC).where("id = 2").first().amount_total == 5.0


def test_streams_of_many_tables_log_their_batches(spark, tmp_path):
    tables = str(tmp_path / "tables")
    house = Warehouse(Landing(spark, str(tmp_path / "landing")), TableStore(spark, tables), RunLog(spark, tables))
    good, broken = TableSpec("a", ("id", "name", "write_date")), TableSpec("b", ("id", "name"), domain=(("nobody", "=", 1),))
    for name in "ab":
        land(tmp_path / "landing", name, [order(1, name, 1)], 0)
    streams = stream_tables(house, [good, broken, TableSpec("never", ("id",))], str(tmp_path / "checkpoints"))
    assert set(streams) == {"a", "b"}
    for stream in streams.values():
        with contextlib.suppress(StreamingQueryException):
            stream.awaitTermination()
    assert {(r.pg_table, r.status, r.records_synced) for r in house.runlog.runs().collect()} == {("a", "success", 1), ("b", "error", 0)}


def test_a_restart_from_nothing_repeats_harmlessly(spark, tmp_path):
    landing, store = Landing(spark, str(tmp_path / "landing")), TableStore(spark, str(tmp_path / "tables"))
    for n in range(3):
        land(tmp_path / "landing", "sale_order", [order(n, "a", n + 1), order(9, f"v{n}", n + 1)], n)
    drain(landing, store, tmp_path / "one", max_files=1)
    once = rows(store)
    drain(landing, store, tmp_path / "two", max_files=2)
    assert rows(store) == once and once[9][0] == "v2"
    drain(landing, store, tmp_path / "two")
    assert rows(store) == once


def test_views_follow_a_stream(spark, tmp_path):
    specs = load_registry()
    tables = str(tmp_path / "tables")
    house = Warehouse(Landing(spark, str(tmp_path / "landing")), TableStore(spark, tables), RunLog(spark, tables), views_over=tuple(specs))
    session = [s for s in specs if s.name == "pos_session"]
    for n, name in enumerate("abc"):
        land(tmp_path / "landing", "pos_session", [{"id": 1, "name": name, "write_date": f"2024-01-0{n + 1} 00:00:00"}], n)
        for stream in stream_tables(house, session, str(tmp_path / "checkpoints")).values():
            stream.awaitTermination()
        assert [r.name for r in spark.sql("SELECT name FROM bi_pos_sesiones").collect()] == [name]
        assert [r.name for r in house.sql("SELECT name FROM bi_pos_sesiones").collect()] == [name]
