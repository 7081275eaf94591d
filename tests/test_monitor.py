from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgermill.operators.counts import table_counts, total_records
from ledgermill.plans import monitor
from ledgermill.plans.runlog import Run, RUN_SCHEMA
from ledgermill.registry import registry_counts, registry_frame
from ledgermill.session import local_frame
from ledgermill.specs import TableSpec

NOW = datetime(2024, 1, 10)
SPECS = [
    TableSpec("a_b", ("id", "x"), priority=1),
    TableSpec("c", ("id",), priority=62, incremental=False),
    TableSpec("d", ("id",), enabled=False),
]


@pytest.fixture
def latest(spark):
    runs = [
        Run("1", "a.b", "a_b", NOW, NOW - timedelta(hours=3), 5, 1.25, "success"),
        Run("2", "c", "c", NOW, NOW - timedelta(days=2), 0, 0.0, "error", "boom"),
        Run("3", "gone", "gone", NOW, NOW - timedelta(days=1), 0, 0.0, "error", "bang"),
    ]
    return local_frame(spark, [tuple(vars(r).values()) for r in runs], RUN_SCHEMA)


@pytest.fixture
def counts(spark):
    return table_counts(spark, {"a_b": spark.range(1200), "c": None})


def test_status_and_defaults(spark, latest, counts):
    rows = {r.pg_table: r for r in monitor.model_status(registry_frame(spark, SPECS), latest, counts).collect()}
    assert (rows["a_b"].status, rows["a_b"].records_synced, rows["a_b"].row_count) == ("success", 5, 1200)
    assert (rows["c"].status, rows["c"].row_count, rows["c"].error_message) == ("error", None, "boom")
    assert (rows["d"].status, rows["d"].records_synced, rows["d"].last_sync) == ("never", 0, None)
    assert (rows["d"].enabled, rows["d"].fields_count) == (False, 1)


def test_list_words(spark, latest, counts):
    listed = monitor.model_list(monitor.model_status(registry_frame(spark, SPECS), latest, counts))
    assert {r.pg_table: (r.area, r.mode, r.status_label) for r in listed.collect()} == {
        "a_b": ("Maestros / Configuracion", "Incr.", "OK"),
        "c": ("Punto de Venta (POS)", "Full", "Error"),
        "d": ("Otros (prioridad 99)", "Incr.", "Sin sync"),
    }


def test_detail_is_by_exact_name(spark, latest, counts):
    status = monitor.model_status(registry_frame(spark, SPECS), latest, counts)
    assert [r.mode for r in monitor.model_detail(status, "a.b").collect()] == ["Incremental"]
    assert monitor.model_detail(status, "A.B").count() == 0


def test_board(latest, counts):
    rows = {r.model_name: r for r in monitor.sync_board(latest, counts, NOW).collect()}
    assert (rows["a.b"].since_text, rows["a.b"].row_count_text, rows["a.b"].row_difference) == ("3h 0m", "1,200", 1195)
    assert (rows["gone"].row_count, rows["gone"].row_count_text) == (None, "—")


def test_figures(spark, latest, counts):
    row = monitor.sync_kpis(registry_frame(spark, SPECS), latest, counts).first()
    assert row.asDict() == dict(
        total_models=2, synced_models=1, error_models=2, skipped_models=0, total_records=1200,
        last_sync=NOW - timedelta(hours=3),
    )
    assert total_records(counts).first().total_records == 1200
    assert registry_counts(registry_frame(spark, SPECS)).first() == (3, 2)
    empty = monitor.sync_kpis(registry_frame(spark, []), latest.limit(0), table_counts(spark, {})).first()
    assert (empty.total_models, empty.total_records, empty.last_sync) == (0, 0, None)


def test_failed_models_newest_first(latest):
    assert monitor.error_models(latest).first() == (2, "gone, c")
    assert monitor.error_models(latest.limit(0)).first() == (0, "")


def test_ages_are_measured_in_utc(spark, conf, latest):
    conf(session__timeZone="Asia/Tokyo")
    now = spark.range(1).select(monitor.moment(None).alias("now")).first().now
    assert abs(now - datetime.now(tz=__import__("datetime").timezone.utc).replace(tzinfo=None)) < timedelta(minutes=1)
    age = monitor.sync_status(latest.where("model_name = 'a.b'"), NOW).select("time_since_sync").first()[0]
    assert age == timedelta(hours=3)
    assert monitor.sync_status(latest).where(F.col("time_since_sync") > F.expr("INTERVAL 1 DAY")).count() == 3
