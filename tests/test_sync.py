from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.full_load import records
from ledgermill.operators.store import TableStore
from ledgermill.plans import sync as sync_module
from ledgermill.plans.runlog import RUN_SCHEMA, Progress, Run, RunLog, run_summary, sync_state_latest, watermark_reference
from ledgermill.plans.sync import Warehouse, next_mark, rebuild_table, sync_table, sync_tables
from ledgermill.registry import load_registry
from ledgermill.sources.landing import Landing, raw_records
from ledgermill.specs import TableSpec
from tests.test_cleaning import land

SPEC = TableSpec("sale_order", ("id", "name", "amount_total", "write_date"), bucket_width=1000, slice_width=100)
AT = lambda n: f"2024-01-{n:02d} 00:00:00"


def order(i, name, day, **more):
    return {"id": i, "name": name, "amount_total": False, "write_date": AT(day), **more}


@pytest.fixture
def house(spark, tmp_path):
    tables = str(tmp_path / "tables")
    return Warehouse(Landing(spark, str(tmp_path / "landing")), TableStore(spark, tables), RunLog(spark, tables))


@pytest.fixture
def landing(tmp_path):
    return tmp_path / "landing"


def run(house, spec=SPEC, **options):
    done = sync_table(house, spec, **options)
    house.runlog.append([done])
    return done


def names(house, spec=SPEC):
    return {r.id: r.name for r in house.store.read(spec).collect()}


def test_incremental_loads_take_new_extracts_whole(house, landing):
    land(landing, "sale_order", [order(1, "a", 1), order(2, "b", 3)], 0)
    first = run(house)
    assert (first.status, first.records_synced, first.mark, first.last_batch) == (
        "success", 2, datetime(2024, 1, 3), 0,
    )
    land(landing, "sale_order", [order(1, "late", 2), order(2, "again", 3), order(3, "c", 4)], 1)
    second = run(house)
    assert (second.records_synced, second.mark, second.last_batch) == (3, datetime(2024, 1, 4), 1)
    assert names(house) == {1: "late", 2: "again", 3: "c"}, "it is newer than the stored row, whatever the mark"


def test_records_before_the_mark_or_without_a_date_are_not_lost(house, landing):
    land(landing, "sale_order", [order(1, "a", 1), order(2, "b", 3), order(3, "c", 3)], 0)
    run(house)
    bad = [{**order(i, f"new {i}", 1), "write_date": d} for i, d in ((4, False), (5, "some day"), (3, False))]
    land(landing, "sale_order", [order(1, "a2", 2), order(2, "older", 2), *bad], 1)
    assert run(house).records_synced == 5
    assert names(house) == {1: "a2", 2: "b", 3: "new 3", 4: "new 4", 5: "new 5"}


def test_the_first_record_does_not_decide_for_the_extract(house, landing, monkeypatch):
    first = {"id": 1, "write_date": AT(1)}
    land(landing, "sale_order", [first, *[order(i, f"n{i}", 1, amount_total=float(i)) for i in range(2, 6)]], 0)
    assert run(house).bad_values == 0
    assert {r.id: (r.name, r.amount_total) for r in house.store.read(SPEC).collect()} == {
        1: (None, None), **{i: (f"n{i}", float(i)) for i in range(2, 6)}
    }
    for n in range(1, 6):  # extracts whose records carry other fields each, in one upsert
        land(landing, "sale_order", [{"id": n, ("name" if n % 2 else "amount_total"): f"{n}0", "write_date": AT(n + 1)}], n)
    calls, real = [], sync_module.upsert
    monkeypatch.setattr(sync_module, "upsert", lambda *a: calls.append(1) or real(*a))
    assert run(house).records_synced == 5 and len(calls) == 1
    assert {r.id: (r.name, r.amount_total) for r in house.store.read(SPEC).collect()} == {
        1: ("10", None), 2: ("n2", 20.0), 3: ("30", 3.0), 4: ("n4", 40.0), 5: ("50", 5.0)
    }


def test_nothing_new_leaves_the_mark(house, landing):
    land(landing, "sale_order", [order(1, "a", 1)], 0)
    run(house)
    idle = run(house)
    assert (idle.status, idle.records_synced, idle.mark, idle.last_batch) == ("success", 0, datetime(2024, 1, 1), 0)


def test_overlap_reads_a_little_more(house, landing):
    land(landing, "sale_order", [order(1, "a", 3)])
    run(house)
    land(landing, "sale_order", [order(1, "a", 3), order(2, "b", 2), order(3, "c", 1)])
    house.overlap = timedelta(days=1)
    assert run(house).records_synced == 2
    assert set(names(house)) == {1, 2}, "without extract numbers the date tells what is new"


def test_a_full_load_ignores_the_mark_and_deletes_nothing(house, landing):
    land(landing, "sale_order", [order(1, "a", 3)], 0)
    run(house)
    land(landing, "sale_order", [order(2, "b", 1)], 1)
    assert run(house).records_synced == 1
    assert run(house, full=True).records_synced == 2
    assert names(house) == {1: "a", 2: "b"}


def test_tables_that_are_not_incremental_are_read_whole(house, landing):
    spec = TableSpec("report_pos_order", ("id", "name"), incremental=False)
    land(landing, spec.name, [{"id": 1, "name": "a"}], 0)
    assert [run(house, spec).records_synced for _ in range(2)] == [1, 1]


def test_tables_that_are_not_incremental_can_be_replaced(house, landing):
    spec = TableSpec("report_pos_order", ("id", "name"), incremental=False)
    land(landing, spec.name, [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}])
    run(house, spec)
    land(landing, spec.name, [{"id": 2, "name": "b"}])
    run(house, spec)
    assert set(names(house, spec)) == {1, 2}
    house.replace_full = True
    assert run(house, spec).records_synced == 1
    assert set(names(house, spec)) == {2}


def test_the_widest_tables_load_twice(spark, house, landing):
    """Wide plans must not make the optimizer rewrite a condition once per set of columns."""
    widest = sorted(load_registry(), key=lambda s: -len(s.fields))[:2]
    for n in range(2):
        for spec in widest:
            folder = f"{landing}/{spec.name}/landed_batch={n}"
            records(spark, "/root/testdata/sf0.001", spec).write.text(folder)
        runs = sync_tables(house, widest, full=bool(n))
        assert [(r.status, r.records_synced, r.bad_values) for r in runs] == [("success", 1500 * (n + 1), 0)] * 2
    runs = sync_tables(house, widest)
    assert [(r.status, r.records_synced) for r in runs] == [("success", 0)] * 2
    assert [house.store.read(s).count() for s in widest] == [1500, 1500]


def test_mark_rule():
    start, before = datetime(2024, 1, 5), datetime(2024, 1, 1)
    assert next_mark(start, None, before) == before
    assert next_mark(start, datetime(2024, 1, 3), before) == datetime(2024, 1, 3)
    assert next_mark(start, datetime(2024, 2, 3), before) == start


def test_missing_sources_are_skipped(house):
    done = run(house)
    assert (done.status, done.records_synced) == ("skipped", 0)
    assert not house.store.exists("sale_order")


def test_no_records_are_a_success(house, landing):
    land(landing, "sale_order", [], 0)
    assert run(house).status == "success"
    assert house.store.read(SPEC).count() == 0


def test_a_capped_load_is_partial_and_keeps_the_mark(house, landing):
    land(landing, "sale_order", [order(i, "a", 1) for i in range(20)], 0)
    house.cap, house.batch_size = 7, 5
    done = run(house)
    assert (done.status, done.records_synced, done.mark) == ("partial", 10, None)
    house.cap = 0
    assert run(house).records_synced == 20


def test_capped_loads_go_on_until_they_are_done(house, landing):
    land(landing, "sale_order", [order(False, "no id", 1), *[order(i, "a", 1) for i in range(23)]], 0)
    house.cap = house.batch_size = 10
    first = run(house)
    assert (first.status, first.records_synced, first.rejected, first.last_id) == ("partial", 10, 1, 9)
    land(landing, "sale_order", [order(3, "b", 2)], 1)  # below the place the load has reached
    assert [run(house).status for _ in range(2)] == ["partial", "success"]
    assert len(names(house)) == 23 and names(house)[3] == "a"
    assert run(house).records_synced == 1 and names(house)[3] == "b"
    with pytest.raises(ValueError, match="capped"):
        Warehouse(house.landing, house.store, house.runlog, cap=5, replace_full=True)


def test_views_follow_loads_and_rebuilds(spark, house, landing):
    specs = load_registry()
    house.views_over = tuple(specs)
    session = [s for s in specs if s.name == "pos_session"]
    seen = lambda: {r.id: r.name for r in spark.sql("SELECT id, name FROM bi_pos_sesiones").collect()}
    land(landing, "pos_session", [{"id": 1, "name": "a", "write_date": AT(1)}], 0)
    sync_tables(house, session)
    assert seen() == {1: "a"}
    land(landing, "pos_session", [{"id": 1, "name": "b", "write_date": AT(2)}, {"id": 2, "name": "c", "write_date": AT(1)}], 1)
    sync_tables(house, session)
    assert seen() == {1: "b", 2: "c"}
    assert [r.status for r in spark.sql("SELECT * FROM bi_sync_status").collect()] == ["success"]
    for version in ([0], [1]):
        rebuild_table(house, session[0])
        assert house.store.drop_old_versions("pos_session") == version and seen() == {1: "b", 2: "c"}


def test_each_table_is_logged_as_it_ends(house, landing, monkeypatch):
    specs = [TableSpec(n, ("id", "name", "write_date")) for n in ("a", "b")]
    for s in specs:
        land(landing, s.name, [order(1, s.name, 1)], 0)
    real, seen = house.runlog.append, []
    monkeypatch.setattr(house.runlog, "append", lambda runs: seen.append([r.pg_table for r in runs]) or real(runs))
    sync_tables(house, specs, threads=1)
    assert seen == [["a"], ["b"]]


def test_a_failed_run_does_not_move_the_mark(house, landing, monkeypatch):
    land(landing, "sale_order", [order(1, "a", 1)], 0)
    run(house)
    land(landing, "sale_order", [order(2, "b", 2)], 1)
    monkeypatch.setattr(sync_module, "upsert", lambda *a, **k: 1 / 0)
    assert run(house).status == "error"
    monkeypatch.undo()
    house.reference_watermark = True
    assert house.runlog.progress(True) == {}, "after a failure the other rule reads everything"
    house.reference_watermark = False
    done = run(house)
    assert (done.status, done.records_synced) == ("success", 1)
    assert names(house) == {1: "a", 2: "b"}


def test_reference_watermark_starts_at_the_finish_of_the_last_run(house, landing):
    land(landing, "sale_order", [order(1, "a", 1)], 0)
    run(house)
    land(landing, "sale_order", [order(2, "b", 2)], 1)
    house.reference_watermark = True
    assert run(house).records_synced == 0, "it was written before the first run ended"


def test_extracts_with_fewer_fields_keep_the_rest(house, landing):
    land(landing, "sale_order", [order(1, "a", 1, amount_total=5.0)], 0)
    land(landing, "sale_order", [{"id": 1, "amount_total": 6.0, "write_date": AT(2)}], 1)
    assert run(house).records_synced == 2
    row = house.store.read(SPEC).first()
    assert (row.name, row.amount_total) == ("a", 6.0)


def test_domains_filter_the_source(house, landing):
    spec = TableSpec("sale_order", SPEC.fields, domain=(("amount_total", ">=", 2.0),))
    land(landing, "sale_order", [order(i, "a", 1, amount_total=float(i)) for i in range(4)], 0)
    run(house, spec)
    assert set(names(house, spec)) == {2, 3}


def test_unreadable_values_and_missing_ids_are_reported(house, landing):
    land(landing, "sale_order", [order(1, "a", 1, amount_total="x"), order(False, "b", 1), "no json"], 0)
    done = run(house)
    assert (done.records_synced, done.rejected, done.bad_values) == (1, 2, 1)


def test_one_bad_table_does_not_stop_the_others(house, landing, monkeypatch):
    specs = [TableSpec(n, ("id", "name", "write_date")) for n in ("a", "b", "c")]
    specs.append(TableSpec("off", ("id",), enabled=False))
    for n in ("a", "b", "off"):
        land(landing, n, [order(1, n, 1)], 0)
    real = sync_module.upsert
    monkeypatch.setattr(
        sync_module, "upsert", lambda store, spec, *a: 1 / 0 if spec.name == "a" else real(store, spec, *a)
    )
    runs = sync_tables(house, specs)
    assert {r.pg_table: r.status for r in runs} == {"a": "error", "b": "success", "c": "skipped"}
    assert "division" in runs[0].error_message
    summary = run_summary(house.runlog.runs()).collect()
    assert [(r.models, r.errors, r.skipped, r.total_records) for r in summary] == [(3, 1, 1, 1)]
    assert [r.pg_table for r in sync_tables(house, specs, only=["b", "nobody"])] == ["b"]


def test_rebuild_drops_what_the_source_no_longer_has(house, landing):
    land(landing, "sale_order", [order(1, "a", 1), order(2, "b", 1)])
    run(house)
    land(landing, "sale_order", [order(2, "b", 1)])
    assert run(house, full=True).records_synced == 1
    assert set(names(house)) == {1, 2}
    rebuild_table(house, SPEC)
    assert set(names(house)) == {2}


def test_state_is_the_latest_run_of_each_model(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    assert log.progress() == {} and log.runs().count() == 0
    moment = datetime(2024, 1, 1)
    make = lambda run_id, hour, status, mark: Run(
        run_id, "m", "t", moment, moment + timedelta(hours=hour), status=status, mark=mark
    )
    log.append([make("1", 1, "success", moment), make("2", 2, "error", None)])
    log.append([make("3", 2, "skipped", None)])
    assert [r.status for r in sync_state_latest(log.runs()).collect()] == ["skipped"]
    assert watermark_reference(log.runs()).count() == 0
    assert log.progress() == {"m": Progress(moment, None)}


def test_capped_loads_keep_the_versions_of_an_id_together(house, landing):
    for day in (1, 2, 3):
        land(landing, "sale_order", [order(i, f"day{day}", day) for i in (1, 2)], day)
    house.cap = house.batch_size = 1
    runs = [run(house) for _ in range(3)]
    assert [(r.status, r.records_synced, r.last_id) for r in runs] == [("partial", 3, 1), ("partial", 3, 2), ("success", 0, None)]
    assert names(house) == {1: "day3", 2: "day3"}
    assert run(house).records_synced == 0


def test_fields_of_one_extract_are_refused_by_their_own_dates(house, landing):
    land(landing, "sale_order", [order(1, "stored5", 5)], 0)
    run(house)
    land(landing, "sale_order", [{"id": 1, "name": "old3", "write_date": AT(3)}, {"id": 1, "amount_total": 9.0, "write_date": AT(10)}], 1)
    run(house)
    row = house.store.read(SPEC).first()
    assert (row.name, row.amount_total, row.write_date) == ("stored5", 9.0, datetime(2024, 1, 10))


def test_the_run_log_stays_small(spark, tmp_path):
    """Many appends leave a bounded number of files, and rows written before a compaction are all there."""
    log, moment = RunLog(spark, str(tmp_path), files=6), datetime(2024, 1, 1)
    made = [Run(str(k), f"m{k % 3}", "t", moment, moment + timedelta(hours=k), mark=moment + timedelta(hours=k)) for k in range(40)]
    for k, one in enumerate(made):
        log.append([one])
        assert len(list((tmp_path / "etl_sync_log").rglob("part-*.parquet"))) <= 7
    assert sorted(int(r.run_id) for r in log.runs().collect()) == list(range(40))
    assert log.progress() == {f"m{k % 3}": Progress(made[k].mark, None) for k in (37, 38, 39)}
    assert log.runs().columns == [f.split()[0] for f in RUN_SCHEMA.split(", ")]
    assert {r.model_name for r in sync_state_latest(RunLog(spark, str(tmp_path)).runs()).collect()} == {"m0", "m1", "m2"}


def test_the_parts_of_a_capped_load_parse_once(house, landing):
    land(landing, "sale_order", [order(i, f"n{i}", 1) for i in range(6)], 0)
    house.cap = house.batch_size = 2
    held = lambda: sorted(p.name for p in (landing.parent / "tables" / "sale_order").glob("_parsed-*"))
    assert run(house).status == "partial"
    first = held()
    assert len(first) == 1 and run(house).status == "partial" and held() == first
    land(landing, "sale_order", [order(9, "next", 2)], 1)
    assert run(house).status == "partial" and held() == first, "it goes on in the extracts it began with"
    while run(house).status == "partial":
        pass
    assert not held() and run(house).status == "success"
    assert names(house) == {i: f"n{i}" for i in range(6)} | {9: "next"} and not held()


def test_records_tell_their_fields_where_lines_are_odd(spark):
    whole = '{"id": 1, "name": "a", "amount_total": 2, "write_date": false}'
    lines = [whole, " " + whole, f"[{whole}]", whole[:-1], '{"id": 1, "name": null}', '{"id": 1, "x": 2}']
    path = F.struct(F.lit("/landing/sale_order/x.json").alias("file_path"))
    found = raw_records(spark.createDataFrame([(x,) for x in lines], "value string").withColumn("_metadata", path), SPEC)
    every = sorted(SPEC.fields)
    assert [r["_has"] for r in found.collect()] == [every, every, None, None, ["id", "name"], ["id"]]
