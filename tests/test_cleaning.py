"""Edge records of the source conventions, read from JSON files."""

import json
from datetime import date, datetime

import pytest

from ledgermill.functions.cleaning import bad_field_counts
from ledgermill.sources.landing import Landing, available_sources, missing_sources
from ledgermill.registry import registry_frame
from ledgermill.specs import TableSpec

KINDS = {"m": "m", "s": "s", "f": "f", "t": "t", "d": "d", "b": "b", "i": "i"}


def land(folder, table, records, batch=None):
    path = folder / table / (f"landed_batch={batch}" if batch is not None else "")
    path.mkdir(parents=True, exist_ok=True)
    (path / "part-0.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


@pytest.fixture
def read(spark, tmp_path):
    def run(*records, **options):
        spec = TableSpec("t", ("id", *KINDS), kinds=KINDS, **options)
        land(tmp_path, "t", [{"id": n, **r} for n, r in enumerate(records)])
        return [r.asDict() for r in Landing(spark, str(tmp_path)).read(spec).orderBy("id").collect()]

    return run


def test_false_is_null_in_every_kind(read):
    (row,) = read({k: False for k in KINDS})
    assert all(row[k] is None for k in KINDS) and row["_bad"] == []


def test_false_can_be_kept_in_flags(read):
    rows = read({"b": False}, {"b": True}, {"b": None}, keep_false=True)
    assert [r["b"] for r in rows] == [False, True, None]


def test_zero_and_empty_text_stay(read):
    (row,) = read({"i": 0, "f": 0.0, "s": ""})
    assert (row["i"], row["f"], row["s"]) == (0, 0.0, "")


@pytest.mark.parametrize(
    "raw, clean",
    [([7, "Spain"], 7), ([0, "x"], None), ([False, "x"], None), ([4, 9], 4), ([], None), (False, None), (12, 12),
     ([7, "a, [3] \"b\""], 7)],
)
def test_references_keep_the_id(read, raw, clean):
    (row,) = read({"m": raw})
    assert row["m"] == clean and row["_bad"] == []


def test_text_false_is_not_json_false(read):
    rows = read({"s": "false"}, {"s": False}, {"s": "12"}, {"s": 12}, {"s": None}, {})
    assert [r["s"] for r in rows] == ["false", None, "12", "12", None, None]


def test_a_first_record_with_false_does_not_decide_the_type(read):
    rows = read({"s": False, "f": False, "t": False}, {"s": "x", "f": 1.5, "t": "2024-01-02 03:04:05"})
    assert (rows[1]["s"], rows[1]["f"], rows[1]["t"]) == ("x", 1.5, datetime(2024, 1, 2, 3, 4, 5))


def test_moments_and_days(read):
    rows = read({"t": "2024-01-02 03:04:05", "d": "2024-01-02"}, {"t": "someday", "d": "never"})
    assert (rows[0]["t"], rows[0]["d"]) == (datetime(2024, 1, 2, 3, 4, 5), date(2024, 1, 2))
    assert (rows[1]["t"], rows[1]["d"]) == (None, None)
    assert sorted(rows[1]["_bad"]) == ["d", "t"]


def test_values_that_cannot_be_read_are_counted(spark, tmp_path):
    land(tmp_path, "t", [{"id": 1, "f": "oops", "i": 3, "m": "x"}, {"id": 2, "f": "oops", "m": True, "i": 1.5}])
    cleaned = Landing(spark, str(tmp_path)).read(TableSpec("t", ("id", *KINDS), kinds=KINDS))
    assert {r.field: r.bad_values for r in bad_field_counts(cleaned).collect()} == {"f": 2, "m": 2, "i": 1}


def test_lines_that_are_no_json_have_no_id(spark, tmp_path):
    land(tmp_path, "t", ['{"id": 1}', "not json", "{"])
    rows = Landing(spark, str(tmp_path)).read(TableSpec("t", ("id", "s"), kinds=KINDS)).collect()
    assert sorted(r.id or 0 for r in rows) == [0, 0, 1]


def test_extracts_are_numbered_and_pruned(spark, tmp_path):
    spec = TableSpec("t", ("id", "name"))
    landing = Landing(spark, str(tmp_path))
    for batch in (0, 2, 10):
        land(tmp_path, "t", [{"id": batch, "name": "x"}], batch)
    assert landing.batches(spec) == [0, 2, 10]
    assert sorted((r.id, r._batch) for r in landing.read(spec).collect()) == [(0, 0), (2, 2), (10, 10)]
    later = landing.read(spec, after_batch=2)
    assert [p.split("/")[-2] for p in later.inputFiles()] == ["landed_batch=10"]
    assert landing.read(spec, after_batch=10).count() == 0


def test_each_record_says_which_fields_it_carries(spark, tmp_path):
    spec = TableSpec("t", ("id", "name", "city", "write_date"))
    landing = Landing(spark, str(tmp_path))
    land(tmp_path, "t", [{"id": 1, "name": "a", "other": 1}, {"id": 2, "city": "b"}], 0)
    land(tmp_path, "t", [{"id": 3, "name": None, "city": False}, "no json"], 1)
    found = {r.id: (r._has, r.name, r.city, r._batch) for r in landing.read(spec).collect()}
    assert found == {
        1: (["id", "name"], "a", None, 0), 2: (["city", "id"], None, "b", 0), 3: (["city", "id", "name"], None, None, 1),
        None: (None, None, None, 1),
    }


def test_no_field_list_takes_every_field(spark, tmp_path):
    land(tmp_path, "t", [{"id": 1, "name": "a", "tag_ids": [1]}, {"id": 2, "partner_id": [5, "P"]}])
    landing = Landing(spark, str(tmp_path))
    spec = landing.resolve(TableSpec("t"))
    assert set(spec.fields) == {"id", "name", "partner_id", "write_date"}
    rows = {r.id: (r.name, r.partner_id) for r in landing.read(spec).collect()}
    assert rows == {1: ("a", None), 2: (None, 5)}


def test_field_catalogue(spark, tmp_path):
    land(tmp_path, "t", [{"id": 1, "name": False, "extra": 2.5}, {"id": 2, "name": "x"}])
    rows = Landing(spark, str(tmp_path)).field_catalogue(TableSpec("t", ("id", "name", "write_date"))).collect()
    assert [(r.field, r.type) for r in rows] == [
        ("extra", "?"), ("id", "bigint"), ("name", "string"), ("write_date", "timestamp_ntz"),
    ]
    assert rows[2].seen == "BOOLEAN, STRING" and rows[3].seen is None


def test_sources_that_are_not_there(spark, tmp_path):
    specs = [TableSpec("a", ("id",)), TableSpec("b", ("id",))]
    land(tmp_path, "a", [{"id": 1}])
    found = missing_sources(registry_frame(spark, specs), available_sources(Landing(spark, str(tmp_path)), specs))
    assert {r.model_name: r.status for r in found.collect()} == {"a": "present", "b": "skipped"}
