import shutil
from datetime import datetime, timedelta
from glob import glob
from os import stat

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermill.operators.dedupe import dedupe_latest
from ledgermill.operators.sizes import row_bytes
from ledgermill.operators.store import TableStore, range_of
import ledgermill.operators.upsert as upsert_module
from ledgermill.operators.upsert import _stage, merge_in_place, merge_rows, rebuild, restore, upsert
from ledgermill.session import local_frame
from ledgermill.specs import TableSpec

SPEC = TableSpec("t", ("id", "name", "amount_total", "write_date"), bucket_width=10, slice_width=5)
SCHEMA = "id bigint, name string, amount_total double, write_date timestamp_ntz, _batch bigint"
DAY = lambda n: None if n is None else datetime(2024, 1, 1) + timedelta(days=n)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


@pytest.fixture(params=["broadcast", "shuffle"])
def both_ways(request, conf):
    conf(autoBroadcastJoinThreshold="10mb" if request.param == "broadcast" else "-1")


def batch(spark, *rows):
    return local_frame(spark, [(i, n, a, DAY(d), b) for i, n, a, d, b in rows], SCHEMA)


def table(store, spec=SPEC):
    return {r.id: tuple(r)[1:] for r in store.read(spec).collect()}


def test_the_size_of_a_batch_is_its_size_in_memory(spark, conf, store, monkeypatch):
    """A text repeated a thousand times is small on disk and must still not be broadcast."""
    rows = spark.range(1000).select("id", F.repeat(F.lit("x"), 500).alias("name"))
    assert rows.agg(F.sum(row_bytes(rows))).first()[0] == 1000 * (16 + 2 * 8 + 500)
    upsert(store, SPEC, rows)
    used = []
    for name in ("merge_rows", "merge_in_place"):
        real = getattr(upsert_module, name)
        monkeypatch.setattr(upsert_module, name, lambda *a, name=name, real=real: used.append(name) or real(*a))
    conf(autoBroadcastJoinThreshold="600kb")
    upsert(store, SPEC, rows)
    conf(autoBroadcastJoinThreshold="500kb")
    upsert(store, SPEC, rows)
    assert used == ["merge_in_place", "merge_rows"]


def test_an_unwritten_table_is_empty_with_its_schema(store):
    assert store.read(SPEC).schema == SPEC.schema() and store.read(SPEC).count() == 0
    assert not store.exists("t")


def test_insert_and_update(spark, store, both_ways):
    upsert(store, SPEC, batch(spark, (1, "a", 1.0, 0, 0), (2, "b", 2.0, 0, 0), (-3, "c", 3.0, 0, 0)))
    result = upsert(store, SPEC, batch(spark, (2, "B", 20.0, 1, 1), (25, "d", 4.0, 1, 1), (None, "x", 0.0, 1, 1)))
    assert (result.records, result.rejected, result.buckets) == (2, 1, (0, 2))
    assert table(store) == {
        1: ("a", 1.0, DAY(0)), 2: ("B", 20.0, DAY(1)), -3: ("c", 3.0, DAY(0)), 25: ("d", 4.0, DAY(1)),
    }
    assert store.exists("t")


def test_only_the_ranges_of_the_batch_are_rewritten(spark, store, tmp_path, both_ways):
    upsert(store, SPEC, batch(spark, *[(i, "a", 1.0, 0, 0) for i in range(100)]))
    files = lambda: {f: stat(f).st_ino for f in glob(f"{tmp_path}/t/v=0/id_bucket=*/*.parquet")}
    before = files()
    upsert(store, SPEC, batch(spark, (31, "b", 2.0, 1, 1), (99, "b", 2.0, 1, 1)))
    gone = {f.split("id_bucket=")[1].split("/")[0] for f in before.keys() - files().keys()}
    assert gone == {"3", "9"}
    assert len(table(store)) == 100


def test_late_rows_do_not_replace_newer_ones(spark, store, both_ways):
    upsert(store, SPEC, batch(spark, (1, "new", 1.0, 5, 0), (2, "undated", 1.0, None, 0), (3, "new", 1.0, 5, 0)))
    late = batch(spark, (1, "old", 0.0, 4, 1), (2, "dated", 2.0, 1, 1), (3, "undated", 2.0, None, 1), (4, "in", 1.0, 0, 1))
    upsert(store, SPEC, late)
    assert {i: r[0] for i, r in table(store).items()} == {1: "new", 2: "dated", 3: "undated", 4: "in"}
    upsert(store, SPEC, late, arrival_wins=True)
    assert table(store)[1] == ("old", 0.0, DAY(4))


def test_the_last_of_equals_is_the_latest_batch(spark, store):
    rows = [(1, "a", 1.0, 1, 1), (1, "b", 2.0, 1, 2), (1, "c", 3.0, 0, 3), (2, "x", 1.0, None, 1), (2, "y", 1.0, None, 2)]
    upsert(store, SPEC, batch(spark, *rows))
    assert {i: r[0] for i, r in table(store).items()} == {1: "b", 2: "y"}
    assert {r.id: r.name for r in dedupe_latest(batch(spark, *rows), arrival_wins=True).collect()} == {1: "c", 2: "y"}


def test_absent_columns_keep_their_value_and_present_nulls_replace(spark, store, both_ways):
    upsert(store, SPEC, batch(spark, (1, "a", 1.0, 0, 0)))
    change = batch(spark, (1, None, None, 1, 1), (2, None, 7.0, 1, 1))
    upsert(store, SPEC, change, columns=["amount_total", "write_date"])
    assert table(store) == {1: ("a", None, DAY(1)), 2: (None, 7.0, DAY(1))}
    upsert(store, SPEC, batch(spark, (1, None, 2.0, 2, 2)))
    assert table(store)[1] == (None, 2.0, DAY(2))


def test_columns_are_added_and_never_dropped(spark, store, both_ways):
    upsert(store, SPEC, batch(spark, (1, "a", 1.0, 0, 0), (50, "z", 1.0, 0, 0)))
    wider = TableSpec("t", SPEC.fields[:3] + ("origin",), bucket_width=99, slice_width=99)
    rows = local_frame(spark, [(1, "b", DAY(1), "web")], "id bigint, name string, write_date timestamp_ntz, origin string")
    upsert(store, wider, rows, columns=["name", "write_date", "origin"])
    assert table(store) == {1: ("b", 1.0, DAY(1), "web"), 50: ("z", 1.0, DAY(0), None)}
    narrower = TableSpec("t", ("id", "name"))
    upsert(store, narrower, local_frame(spark, [(1, "c")], "id bigint, name string"))
    assert table(store)[1] == ("c", 1.0, DAY(1), "web")
    assert store.info("t").bucket_width == 10
    names = [(r.column_name, r.data_type) for r in store.columns("t").orderBy("ordinal").collect()]
    assert names[0] == ("id", "bigint") and names[-1] == ("origin", "string")


def test_columns_are_never_retyped(spark, store, both_ways):
    upsert(store, SPEC, batch(spark, (1, "a", 1.5, 0, 0)))
    rows = local_frame(spark, [(1, 7, "2.5"), (2, 8, "oops")], "id int, name int, amount_total string")
    upsert(store, SPEC, rows)
    assert store.read(SPEC).schema == SPEC.schema()
    assert table(store) == {1: ("7", 2.5, DAY(0)), 2: ("8", None, None)}
    rebuild(store, SPEC, rows)
    assert table(store) == {1: ("7", 2.5, None), 2: ("8", None, None)}


def test_the_tail_reads_the_last_ranges_only(spark, store):
    assert store.tail(SPEC, 5).count() == 0
    upsert(store, SPEC, batch(spark, *[(i, "a", 1.0, 0, 0) for i in (*range(0, 40), 47, -3)]))
    tail = store.tail(SPEC, 5)
    assert sorted(r.id for r in tail.collect()) == [*range(30, 40), 47]
    assert {f.split("id_bucket=")[1].split("/")[0] for f in tail.inputFiles()} >= {"3", "4"}
    assert store.tail(SPEC, 1).count() == 1 and store.tail(SPEC, 100).count() == 42


def test_rebuild_switches_to_a_new_version(spark, store, tmp_path):
    upsert(store, SPEC, batch(spark, (1, "a", 1.0, 0, 0), (2, "b", 1.0, 0, 0)))
    open_before = store.read(SPEC)
    rebuild(store, SPEC, batch(spark, (2, "b2", 1.0, 0, 0), (2, "b3", 1.0, 1, 0)))
    assert table(store) == {2: ("b3", 1.0, DAY(1))}
    assert open_before.count() == 2, "a reader of the old version is not disturbed"
    upsert(store, SPEC, batch(spark, (5, "e", 1.0, 0, 0)))
    assert set(table(store)) == {2, 5}


def test_a_commit_cut_short_can_be_finished(spark, store, tmp_path, both_ways, monkeypatch, caplog):
    upsert(store, SPEC, batch(spark, *[(i, "a", 1.0, 0, 0) for i in range(30)]))
    change = batch(spark, (1, "b", 2.0, 1, 1), (25, "b", 2.0, 1, 1), (31, "b", 2.0, 1, 1))

    def lost(rows, path):
        shutil.move(f"{tmp_path}/t/v=0/id_bucket=2", tmp_path / "lost")
        raise RuntimeError("driver lost")

    monkeypatch.setattr(upsert_module, "_write", lost)
    with caplog.at_level("INFO"), pytest.raises(RuntimeError):
        upsert(store, SPEC, change, keep_copy=True)
    monkeypatch.undo()
    assert len(table(store)) == 20
    restore(store, "t", caplog.messages[-1].split(" kept in ")[1])
    rows = table(store)
    assert len(rows) == 31 and {i for i, r in rows.items() if r[0] == "b"} == {1, 25, 31}
    upsert(store, SPEC, change, keep_copy=True)
    assert table(store) == rows


def test_an_empty_batch_changes_nothing(spark, store):
    upsert(store, SPEC, batch(spark))
    assert table(store) == {}
    upsert(store, SPEC, batch(spark, (1, "a", 1.0, 0, 0)))
    upsert(store, SPEC, batch(spark))
    assert set(table(store)) == {1}


ROW = st.tuples(
    st.integers(-20, 20), st.sampled_from("abc"), st.sampled_from([1.0, 2.0]),
    st.one_of(st.none(), st.integers(0, 3)), st.just(0),
)


def replay(stored: dict, changes, arrival_wins=False):
    """The rule in plain Python: the newest change per id, refused if older than what is stored."""
    best = {}
    for i, name, amount, day, _ in changes:
        rank = (day is not None, day or 0)
        if i not in best or rank > best[i][0]:
            best[i] = (rank, (name, amount, day))
    for i, (_, row) in best.items():
        old = stored.get(i)
        older = old is not None and None not in (old[2], row[2]) and old[2] > row[2]
        if not older or arrival_wins:
            stored[i] = row
    return stored


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    base=st.lists(ROW, max_size=20, unique_by=lambda r: r[0]),
    changes=st.lists(ROW, max_size=30, unique_by=lambda r: (r[0], r[3])),
)
def test_both_merges_follow_the_rule(spark, base, changes):
    expected = {i: (n, a, DAY(d)) for i, (n, a, d) in replay({r[0]: r[1:4] for r in base}, changes).items()}
    put = lambda df: df.withColumns({"id_bucket": range_of("id", 10), "id_slice": range_of("id", 5)})
    stored = put(batch(spark, *base).drop("_batch"))
    winners = put(dedupe_latest(batch(spark, *changes)).drop("_batch"))
    columns = ["id", "name", "amount_total", "write_date"]
    for merge in (merge_rows, merge_in_place):
        rows = merge(stored, winners, columns).collect()
        assert {r.id: (r.name, r.amount_total, r.write_date) for r in rows} == expected
        assert len(rows) == len(expected)
        assert all(r.id_bucket == r.id // 10 for r in rows)


def test_splitting_and_repeating_batches_gives_the_same_table(spark, tmp_path):
    rows = [(i % 17, "abc"[i % 3], float(i), i % 5, i // 10) for i in range(60)]
    once, split, again = (TableStore(spark, f"{tmp_path}/{n}") for n in ("once", "split", "again"))
    upsert(once, SPEC, batch(spark, *rows))
    for b in range(6):
        upsert(split, SPEC, batch(spark, *[r for r in rows if r[4] == b]))
    for _ in range(2):
        upsert(again, SPEC, batch(spark, *reversed(rows)))
    assert table(once) == table(again)
    newest = {i: max((r[3], r[4]) for r in rows if r[0] == i) for i in range(17)}
    assert {i: r[2] for i, r in table(split).items()} == {i: DAY(d) for i, (d, _) in newest.items()}
    assert set(table(split)) == set(table(once))


def test_plans(spark, conf):
    """Duplicates are limited before the shuffle, and the stored rows move once or not at all."""
    conf(adaptive__enabled="false")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rows = orders.selectExpr("o_orderkey AS id", "o_orderstatus AS name", "o_orderdate AS write_date")
    text = dedupe_latest(rows)._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    put = lambda df: df.withColumns({"id_bucket": range_of("id", 100), "id_slice": range_of("id", 10)})
    merged = merge_rows(put(rows), put(rows), rows.columns)._jdf.queryExecution().executedPlan().toString()
    assert merged.count("Exchange") == 1
    placed = merge_in_place(put(rows), put(rows), rows.columns)._jdf.queryExecution().executedPlan().toString()
    stored_side = placed.split("Exchange hashpartitioning")[0]
    assert "BroadcastHashJoin" in stored_side and "SortMergeJoin" not in stored_side


def partial(spark, *rows):
    """Records that carry some fields each: (id, day, {field: value}, batch)."""
    full = [(i, r.get("name"), r.get("amount_total"), DAY(d), b, sorted(["id", "write_date", *r])) for i, d, r, b in rows]
    return local_frame(spark, full, SCHEMA + ", _has array<string>")


def test_a_field_is_refused_by_its_own_date(spark, store, both_ways):
    upsert(store, SPEC, batch(spark, (1, "stored5", 1.0, 5, 0)))
    upsert(store, SPEC, partial(spark, (1, 3, {"name": "old3"}, 1), (1, 10, {"amount_total": 9.0}, 1)))
    assert table(store) == {1: ("stored5", 9.0, DAY(10))}
    upsert(store, SPEC, partial(spark, (1, 7, {"name": "new7"}, 2), (1, 6, {"amount_total": 6.0}, 2), (2, 1, {"name": "b"}, 2)))
    assert table(store) == {1: ("new7", 9.0, DAY(10)), 2: ("b", None, DAY(1))}
    upsert(store, SPEC, partial(spark, (2, 0, {"amount_total": 2.0}, 3)))
    assert table(store)[2] == ("b", 2.0, DAY(1)), "a field that no record has set takes any"
    assert store.read(SPEC).columns == list(SPEC.fields) == store.tail(SPEC, 5).columns
    assert [r.column_name for r in store.columns(SPEC).collect()] == list(SPEC.fields)
    rebuild(store, SPEC, partial(spark, (1, 3, {"name": "x"}, 0), (1, 2, {"amount_total": 1.0}, 0)))
    upsert(store, SPEC, partial(spark, (1, 1, {"amount_total": 5.0}, 1), (1, 2, {"name": "y"}, 1)))
    assert table(store) == {1: ("x", 1.0, DAY(3))}


def test_what_records_carry_is_staged_as_flags(spark, store, both_ways):
    """One whole number for 60 fields and not their names, which were written, shuffled and searched for every field."""
    names = [f"note{n}" for n in range(70)]
    spec = TableSpec("wide", ("id", "write_date", *names))
    schema = "id bigint, write_date timestamp_ntz, " + ", ".join(f"{n} string" for n in names) + ", _batch bigint, _has array<string>"
    one = lambda day, n, has: (1, DAY(day), *[f"{n}{day}"] * 70, day, has)
    rows = local_frame(spark, [one(1, "a", None), one(2, "b", ["id", "note0", "write_date"]), one(3, "c", ["id", "note69", "write_date"])], schema)
    with _stage(rows.drop("_batch"), 1_000_000, 100_000, "flags") as staged:
        kinds = {f.name: f.dataType.simpleString() for f in staged.rows.schema.fields if f.name.startswith("_")}
    assert kinds == {"_has_0": "bigint", "_has_1": "bigint"}
    upsert(store, spec, local_frame(spark, [one(0, "s", sorted(["id", "write_date", *names]))], schema))
    upsert(store, spec, rows)
    found = store.read(spec).first()
    assert [found[n] for n in ("note0", "note1", "note68", "note69")] == ["b2", "s0", "s0", "c3"]
    assert found["write_date"] == DAY(3)


def test_whole_records_keep_no_dates(spark, store, both_ways):
    for day in range(2):
        upsert(store, SPEC, batch(spark, (1, "a", 1.0, day, day)))
        assert "_dates" not in store.info("t").schema.names


RECORD = st.tuples(
    st.integers(0, 3), st.integers(0, 5),
    st.fixed_dictionaries({}, optional={"name": st.sampled_from("abc"), "amount_total": st.sampled_from([1.0, 2.0, None])}),
)


def newest_fields(records):
    """Per id and field the value of the newest record that carries it, the last of equals."""
    found, dates = {}, {}
    for i, day, fields in records:
        for name, value in {**fields, "write_date": DAY(day)}.items():
            if day >= dates.get((i, name), day):
                dates[i, name] = day
                found.setdefault(i, {})[name] = value
    return {i: (r.get("name"), r.get("amount_total"), r["write_date"]) for i, r in found.items()}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(records=st.lists(RECORD, min_size=1, max_size=14), cuts=st.lists(st.integers(1, 13), min_size=1, max_size=2, unique=True))
def test_partial_records_end_alike_however_they_are_split(spark, conf, tmp_path_factory, records, cuts):
    numbered = [(*r, n) for n, r in enumerate(records)]
    parts = [numbered[a:b] for a, b in zip([0, *sorted(cuts)], [*sorted(cuts), len(records)])]
    expected = newest_fields(records)
    for limit, loads in (("10mb", [numbered]), ("10mb", parts), ("-1", parts)):
        conf(autoBroadcastJoinThreshold=limit)
        own = TableStore(spark, str(tmp_path_factory.mktemp("split")))
        for load in filter(None, loads):
            upsert(own, SPEC, partial(spark, *load))
        assert table(own) == expected


def test_an_id_with_very_many_records_is_limited_before_the_shuffle(spark, store, conf, monkeypatch):
    conf(autoBroadcastJoinThreshold="-1")
    rows = [(1, f"v{k}", float(k), k % 7, k) for k in range(60)] + [(k, "x", 1.0, 0, 0) for k in range(2, 9)]
    seen, real = [], upsert_module.latest_per_key
    monkeypatch.setattr(upsert_module, "latest_per_key", lambda *a: seen.append(1) or real(*a))
    for _ in range(2):
        upsert(store, SPEC, batch(spark, *rows))
    assert len(seen) == 2 and table(store)[1] == ("v55", 55.0, DAY(6)) and len(table(store)) == 8
    upsert(store, SPEC, batch(spark, *rows[54:]))
    assert len(seen) == 3, "six records of one id are more than a slice of five ids may hold"


def test_a_load_shuffles_its_batch_once(spark, store, conf, monkeypatch):
    """The plan of the real pipeline, from the staged batch to what is written."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    plans, real = [], upsert_module._replace
    monkeypatch.setattr(upsert_module, "_replace", lambda rows, *a: plans.append(rows) or real(rows, *a))
    first, write = [], upsert_module._write
    monkeypatch.setattr(upsert_module, "_write", lambda rows, path: first.append(rows) or write(rows, path))
    for load in range(2):
        upsert(store, SPEC, batch(spark, *[(i, "a", 1.0, load, load) for i in range(30)]))
    upsert(store, SPEC, partial(spark, *[(i, 2, {"name": "b"} if i % 2 else {"amount_total": 2.0}, 2) for i in range(30)]))
    rebuild(store, SPEC, batch(spark, *[(i, "a", 1.0, 0, 0) for i in range(30)]))
    written = [p for p in (*plans, *first) if not isinstance(p, str)]
    assert len(plans) == 2 and len(written) == 4
    for rows in written:
        text = rows._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1 and "Exchange" not in text.replace("Exchange hashpartitioning", "")
    assert len(first) == 4 and [isinstance(p, str) for p in first] == [False, True, True, False], "merged ranges are moved"
