from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgermill.functions.formats import duration_short, micros, number_text, preview_text, timestamp_text
from ledgermill.functions.labels import area_label, log_severity, mode_label, move_type_label, status_label
from ledgermill.functions.predicates import contains_text, domain_filter, literal
from ledgermill.operators.paging import recent_rows, record_cap, scan_page
from ledgermill.session import local_frame


def values(spark, rows, schema, column):
    frame = local_frame(spark, [(n, r) for n, r in enumerate(rows)], f"n int, v {schema}")
    return [r.out for r in frame.select("n", column(F.col("v")).alias("out")).orderBy("n").collect()]


def test_durations(spark, conf):
    conf(session__timeZone="America/New_York")
    start = datetime(2024, 3, 9, 23)
    spans = [
        None, timedelta(0), timedelta(milliseconds=-500), timedelta(seconds=-1), timedelta(seconds=45.9),
        timedelta(minutes=5, seconds=3), timedelta(hours=2, minutes=15, seconds=59), timedelta(days=3, hours=4),
        timedelta(hours=25),
    ]
    ends = [None if s is None else start + s for s in spans]
    shown = values(spark, ends, "timestamp_ntz", lambda c: duration_short(micros(c - literal(start))))
    assert shown == ["—", "—", "0s", "ahora", "45s", "5m 3s", "2h 15m", "3d 4h", "1d 1h"]


def test_numbers(spark):
    assert values(spark, [None, 0.0, 0.5, 1.5, 2.5, 1234567.8], "double", number_text) == [
        "—", "0", "0", "2", "2", "1,234,568",
    ]


def test_timestamps(spark):
    moment = datetime(2024, 1, 2, 3, 4, 5)
    assert values(spark, [None, moment], "timestamp_ntz", timestamp_text) == ["—", "2024-01-02 03:04:05"]


@pytest.mark.parametrize("size", [0, 59, 60, 61, 500])
def test_previews(spark, size):
    text = "é" * size
    assert values(spark, [text, None], "string", preview_text) == [text if size <= 60 else "é" * 60 + "...", "NULL"]


def test_labels(spark):
    assert values(spark, ["entry", "receipt", None], "string", move_type_label) == ["Asiento Contable", "receipt", None]
    assert values(spark, ["skipped", "other"], "string", status_label) == ["Omitido", "other"]
    assert values(spark, [62, 99], "int", area_label) == ["Punto de Venta (POS)", "Otros (prioridad 99)"]
    assert values(spark, [True, False, None], "boolean", mode_label) == ["Sí", "No", "No"]


def test_severity_is_decided_in_order(spark):
    lines = ["WARNING ERROR", "SUCCESS WARNING", "✓ done", "error", ""]
    assert values(spark, lines, "string", log_severity) == ["error", "warning", "success", None, None]


def test_domains(spark):
    frame = local_frame(spark, [(1, "a"), (2, "b"), (3, None)], "id int, v string")
    pick = lambda *domain: [r.id for r in frame.where(domain_filter(domain)).orderBy("id").collect()]
    assert pick() == [1, 2, 3]
    assert pick(("id", ">=", 2), ("v", "=", "b")) == [2]
    assert pick(("v", "in", ["a", "b"]), ("id", "!=", 1)) == [2]
    with pytest.raises(ValueError):
        domain_filter([("id", "like", "x")])


def test_search(spark):
    frame = local_frame(spark, [(1, "Sale.Order", "x"), (2, "y", "SALE_LINE"), (3, None, "z")], "id int, a string, b string")
    pick = lambda q: sorted(r.id for r in frame.where(contains_text(q, "a", "b")).collect())
    assert pick("sale") == [1, 2] and pick("") == [1, 2, 3]


def test_pages(spark):
    frame = spark.range(0, 5_000).select((F.col("id") * 7919 % 5000).alias("id"), F.lit(1).alias("v"))
    assert [r.id for r in scan_page(frame, ["id"], offset=4_998, limit=500).collect()] == [4998, 4999]
    assert [r.id for r in recent_rows(frame, rows=3).collect()] == [4999, 4998, 4997]


@pytest.mark.parametrize("cap, kept", [(0, 5000), (1, 500), (500, 500), (501, 1000), (4_900, 5000), (9_000, 5000)])
def test_record_cap_keeps_whole_batches(spark, cap, kept):
    frame = spark.range(-2_500, 2_500).select((F.col("id") * 13).alias("id"))
    ids = sorted(r.id for r in record_cap(frame, cap, width=1_000).collect())
    assert ids == [13 * n for n in range(-2_500, -2_500 + kept)]
