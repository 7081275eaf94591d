"""Insert or update by id, idempotently, rewriting only the id ranges a batch touches.

Parquet has no MERGE, so a batch is merged by rewriting directories with dynamic partition overwrite. The files being
replaced stay until the job commits, so lost executors only cost repeated tasks. Preconditions: one writer per table,
and a reader during the commit may see some ranges before and some after it (``rebuild`` switches a whole table). A
driver lost during the commit can leave a range out of place; the copy kept by default and ``restore`` are for that.

Every field has a date of its own: the write_date of the record that set it. A field is refused by its date and not by the
row's, so records that carry different fields end in the same row however they are split into loads. Dates that differ from
the row's write_date are kept beside it, in the hidden column ``_dates`` of tables that ever took a partial record.

A batch small enough to broadcast is merged into the stored rows where they are read, and they are not shuffled. Any
other batch is shuffled once, together with the stored rows, by (id_bucket, id_slice): the newest record of an id is found, merged
and written there. A slice holds at most ``slice_width`` ids; a sketch of the batch tells whether one id has more records
than that, and such a batch is first limited to the newest of each id in the tasks that read it.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Collection
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.operators.dedupe import latest_per_key, newest_first
from ledgermill.operators.sizes import broadcast_limit, row_bytes
from ledgermill.operators.store import TableInfo, TableStore, range_of, widened
from ledgermill.session import Staged, hadoop_path, path_exists
from ledgermill.specs import TableSpec

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class UpsertResult:
    """What a batch held: rows with an id, rows refused for having none, the newest change, the ranges rewritten."""

    records: int
    rejected: int
    max_write_date: datetime | None
    last_batch: int | None
    buckets: tuple[int, ...]
    bad_values: dict[str, int]
    last_id: int | None = None


DATES = "_dates"
HAS, FLAGS = "_has_", 60
HIDDEN = ("id", "id_bucket", "id_slice", DATES)


def _flag(names: Collection[str], name: str) -> tuple[str, int]:
    """Where the flag of a field is: the column, and its bit. A column holds the flags of ``FLAGS`` fields."""
    place = sorted(names).index(name)
    return f"{HAS}{place // FLAGS}", 1 << place % FLAGS


def _flagged(rows: DataFrame) -> DataFrame:
    """With ``_has`` as flags in whole numbers, which are cheaper to write, shuffle and test than the names; null stays null."""
    names = _data(rows)
    flags = {}
    for name in names if "_has" in rows.columns else ():
        column, bit = _flag(names, name)
        flags.setdefault(column, []).append(F.when(F.array_contains("_has", F.lit(name)), bit).otherwise(0).cast("bigint"))
    return rows.withColumns({c: F.when(F.col("_has").isNotNull(), reduce(Column.__add__, found)) for c, found in flags.items()})


def _each(rows: DataFrame) -> bool:
    return any(c.startswith(HAS) for c in rows.columns)


def _data(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if not c.startswith("_") and c not in HIDDEN[1:]]


class _Merge:
    """How the newest records of an id (``new``) and its stored row (``old``) become one row.

    With flags of what each record has, a field has a newest record of its own; else all fields in ``columns`` come from one.
    ``tracked`` keeps the dates of fields that differ from the row's.
    """

    def __init__(self, stored: DataFrame, changes: DataFrame, columns: Collection[str], arrival_wins: bool):
        self.names = [c for c in stored.columns if c not in HIDDEN]
        self.news = [n for n in self.names if n in columns]
        self.each = _each(changes)
        self.carries = {n: _flag(_data(changes), n) for n in self.news if n in changes.columns}
        self.dated = "write_date" in self.names
        self.tracked = DATES in stored.columns
        self.arrival_wins = arrival_wins
        self.order = newest_first([c for c in changes.columns if c in (*columns, "_batch")], arrival_wins)
        self.date_type = stored.schema["write_date"].dataType if self.dated else T.TimestampNTZType()
        self.written = (F.col("write_date") if "write_date" in self.news else F.lit(None)).cast(self.date_type)

    def newest(self, rows: DataFrame, keys: Collection[str], kept: Collection[str] = ()) -> DataFrame:
        """One row per id with its newest records; with ``kept``, rows that are not ``_fresh`` are stored ones of these columns."""
        fresh = F.col("_fresh") if kept else F.lit(True)
        order = Window.partitionBy(*keys).orderBy(*([F.desc("_fresh")] if kept else []), *self.order)
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        found = {}
        if self.each:
            for n in self.news:
                column, bit = self.carries[n]
                has = F.col(column).bitwiseAND(F.lit(bit).cast("bigint")) != 0
                carried = F.when(fresh & has, F.struct(F.col(n).alias("value"), self.written.alias("at")))
                found[f"_new_{n}"] = F.first(carried, ignorenulls=True).over(whole)
        else:
            found["_new"] = F.when(fresh, F.struct(*self.news, self.written.alias("_at")))
        if kept:
            found["_old"] = F.first(F.when(~fresh, F.struct(*kept)), ignorenulls=True).over(whole)
        ranked = rows.select(*keys, F.row_number().over(order).alias("_rank"), *[c.alias(n) for n, c in found.items()])
        return ranked.where("_rank = 1").drop("_rank")

    def _new(self, name: str) -> tuple[Column, Column, Column]:
        """Value, date and whether there is any."""
        if self.each:
            record = F.col(f"_new_{name}")
            return record["value"], record["at"], record.isNotNull()
        record = F.col("_new")
        return record[name], record["_at"], record.isNotNull()

    def _old_date(self, name: str, old) -> Column:
        if not self.tracked or name == "write_date":
            return old("write_date")
        known = F.coalesce(F.map_contains_key(old(DATES), F.lit(name)), F.lit(False))
        own = F.when(known, F.element_at(old(DATES), F.lit(name))).otherwise(old("write_date"))
        return F.when(old(DATES).isNull(), old("write_date")).otherwise(own)

    def rows(self, met: DataFrame, old=None) -> DataFrame:
        """The merged rows; ``old`` gives the columns of the stored row, which has nulls where there is none.

        In steps, each of which Spark computes once per row: dates that were, what is taken, values and dates, their map.
        """
        none = lambda name: F.lit(None)
        if old is None or not self.dated:
            was = {n: F.lit(None).cast(self.date_type) for n in self.names}
        else:
            met = met.withColumns({f"_was_{n}": self._old_date(n, old) for n in self.names})
            was = {n: F.col(f"_was_{n}") for n in self.names}
        takes, values, dates = {}, {}, {}
        for name in self.news:
            _, date, carried = self._new(name)
            stale = self.dated and not self.arrival_wins and old is not None
            takes[name] = carried & ~F.coalesce(was[name] > date, F.lit(False)) if stale else carried
        met = met.withColumns({f"_takes_{n}": t for n, t in takes.items()})
        for name in self.names:
            values[name], dates[name] = (old or none)(name), was[name]
            if name in takes:
                value, date, _ = self._new(name)
                values[name] = F.when(F.col(f"_takes_{name}"), value).otherwise(values[name])
                dates[name] = F.when(F.col(f"_takes_{name}"), date).otherwise(dates[name])
        made = [values[n].alias(n) for n in self.names]
        if not self.tracked:
            return met.select("id", *made, "id_bucket")
        fields = [n for n in self.names if n != "write_date"]
        met = met.select("id", *made, "id_bucket", *[dates[n].cast(self.date_type).alias(f"_at_{n}") for n in fields])
        other = {n: ~F.col(f"_at_{n}").eqNullSafe(F.col("write_date").cast(self.date_type)) for n in fields}
        entries = [F.when(d, F.struct(F.lit(n).alias("key"), F.col(f"_at_{n}").alias("value"))) for n, d in other.items()]
        known = F.when(reduce(Column.__or__, other.values(), F.lit(False)), F.map_from_entries(F.array_compact(F.array(*entries))))
        kind = T.MapType(T.StringType(), self.date_type)
        return met.select("id", *self.names, (known if fields else F.lit(None)).cast(kind).alias(DATES), "id_bucket")


def _typed(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` in its types."""
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in like.schema.fields if f.name in rows.columns])


def merge_in_place(
    stored: DataFrame, changes: DataFrame, columns: Collection[str], arrival_wins: bool = False
) -> DataFrame:
    """The same as ``merge_rows`` for changes that fit a broadcast, which the caller has checked."""
    changes = _flagged(changes)
    merge = _Merge(stored, changes, columns, arrival_wins)
    newest = merge.newest(changes, ["id", "id_bucket"]).withColumnRenamed("id", "_id")
    joined = stored.join(F.broadcast(newest.drop("id_bucket")), F.col("id") == F.col("_id"), "left")
    updated = merge.rows(joined, F.col)
    known = stored.select("id").join(F.broadcast(changes.select("id").distinct()), "id", "left_semi")
    fresh = newest.withColumnRenamed("_id", "id").join(known, "id", "left_anti").repartition("id_bucket")
    return updated.unionByName(_typed(merge.rows(fresh), updated), allowMissingColumns=True)


def merge_rows(stored: DataFrame, changes: DataFrame, columns: Collection[str], arrival_wins: bool = False) -> DataFrame:
    """Stored rows and records of a batch to the rows that remain; both carry id_bucket and id_slice.

    Columns outside ``columns``, or outside a record's own ``_has``, keep their stored value. Of several records of an id
    the newest counts, field by field. A field older than the stored one is refused, unless arrival wins or either of the
    two has no date.
    """
    changes = _flagged(changes)
    merge = _Merge(stored, changes, columns, arrival_wins)
    kept = [*merge.names, *([DATES] if merge.tracked else [])]
    both = (
        stored.withColumn("_fresh", F.lit(False))
        .unionByName(changes.withColumn("_fresh", F.lit(True)), allowMissingColumns=True)
        .repartition("id_bucket", "id_slice")
    )
    met = merge.newest(both, ["id_bucket", "id_slice", "id"], kept)
    return merge.rows(met, lambda n: F.col("_old")[n])


def first_rows(changes: DataFrame, like: DataFrame, columns: Collection[str]) -> DataFrame:
    """The rows of a table without stored rows; ``like`` has its columns and types."""
    merge = _Merge(like, changes, columns, False)
    placed = merge.newest(changes.repartition("id_bucket", "id_slice"), ["id_bucket", "id_slice", "id"])
    return _typed(merge.rows(placed), like)


def _placed(changes: DataFrame, bucket_width: int, slice_width: int) -> DataFrame:
    return changes.withColumn("id_bucket", range_of("id", bucket_width)).withColumn(
        "id_slice", range_of("id", slice_width)
    )


def _as_kept(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns in the types of the table, which a batch never changes."""
    kept = {f.name: f.dataType for f in schema.fields}
    other = {f.name: kept[f.name] for f in rows.schema.fields if f.name in kept and f.dataType != kept[f.name]}
    return rows.withColumns({name: F.col(name).try_cast(kind) for name, kind in other.items()})


def _write(rows: DataFrame | str, path: str) -> None:
    """Replace ranges: by those of ``rows``, or by the folders of a copy, which are moved and not written again."""
    if not isinstance(rows, str):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("id_bucket").parquet(path)
        return
    spark = SparkSession.active()
    fs, source = hadoop_path(spark, rows)
    for status in fs.listStatus(source):
        name = status.getPath().getName()
        if name.startswith("id_bucket="):
            target = hadoop_path(spark, f"{path}/{name}")[1]
            fs.delete(target, True)
            if not fs.rename(status.getPath(), target):
                raise OSError(f"{name} could not be moved to {path}")
    fs.delete(source, True)


def _replace(rows: DataFrame, path: str, label: str, keep_copy: bool) -> None:
    """Overwrite the ranges of ``rows``. They are written beside the table once and moved into place; a range that was not
    moved is still in the copy. Without ``keep_copy`` Spark's own commit does the same, and leaves nothing to go on from."""
    if not keep_copy:
        _write(rows, path)
        return
    copy = f"{path.rpartition('/')[0]}/_merged-{uuid.uuid4().hex}"
    rows.write.partitionBy("id_bucket").parquet(copy)
    logger.info("%s: ranges being replaced are kept in %s", label, copy)
    _write(copy, path)


def restore(store: TableStore, name: str, copy_path: str) -> None:
    """Put the rest of a copy in place: what to run when the driver was lost during a commit."""
    _write(copy_path, store.data_path(name, store.info(name)))


def _stage(changes: DataFrame, bucket_width: int, slice_width: int, label: str) -> Staged:
    """The batch in scratch files, with its facts; the set of ranges is bounded by their number, not by the rows."""
    rows = _placed(_flagged(changes), bucket_width, slice_width)
    facts = [
        F.count("id").alias("records"),
        F.max("id").alias("last_id"),
        F.count_if(F.col("id").isNull()).alias("rejected"),
        F.sort_array(F.collect_set("id_bucket")).alias("buckets"),
        F.sum(row_bytes(rows)).alias("bytes"),
    ]
    if "write_date" in rows.columns:
        facts.append(F.max("write_date").alias("newest"))
    if "_batch" in rows.columns:
        facts.append(F.max("_batch").alias("last_batch"))
    for c in rows.columns:
        if c.startswith(HAS):
            facts += [F.min(c).alias(f"low {c}"), F.max(c).alias(f"high {c}")]
    if "_bad" in rows.columns:
        fields = [c for c in changes.columns if not c.startswith("_")]
        facts += [F.count_if(F.array_contains("_bad", F.lit(f))).alias(f"bad {f}") for f in fields]
    return Staged(rows, label, facts, unwritten=["_bad", "_has"])


def _result(facts: dict) -> UpsertResult:
    bad = {k.removeprefix("bad "): n for k, n in facts.items() if k.startswith("bad ") and n}
    return UpsertResult(
        facts["records"], facts["rejected"], facts.get("newest"), facts.get("last_batch"), tuple(facts["buckets"]), bad,
        facts["last_id"],
    )


def _carried(rows: DataFrame, facts: dict) -> tuple[DataFrame, Collection[str] | None]:
    """The records with an id, and the fields that all of them carry; None where a record has flags of its own, or all."""
    rows, columns = rows.where("id is not null"), [c for c in rows.columns if c.startswith(HAS)]
    if any(facts[f"low {c}"] != facts[f"high {c}"] for c in columns):
        return rows, None
    names = _data(rows)
    places = {n: _flag(names, n) for n in names} if columns and facts[f"high {columns[0]}"] is not None else {}
    return rows.drop(*columns), [n for n, (c, bit) in places.items() if facts[f"high {c}"] & bit] if places else None


def _limited(rows: DataFrame, slice_width: int, arrival_wins: bool = False) -> DataFrame:
    """The rows, or where one id has more than a slice may hold, the newest per id and set of flags.

    The sketch reads the ids alone. The limit acts in the tasks that read the rows, before their shuffle.
    """
    top = rows.agg(F.expr("approx_top_k(id, 1, 10000)").alias("top")).first()["top"]
    if not top or top[0]["count"] <= slice_width:
        return rows
    keys = ["id", *[c for c in rows.columns if c.startswith(HAS)]]
    return latest_per_key(rows, keys, newest_first(rows.columns, arrival_wins))


def _with_dates(schema: T.StructType, columns: Collection[str] | None) -> T.StructType:
    """The schema of a table that takes records without some of its fields, whose dates it has to know."""
    names = [f.name for f in schema.fields if f.name not in HIDDEN]
    if DATES in schema.names or "write_date" not in names or (columns is not None and set(names) <= set(columns)):
        return schema
    return T.StructType(schema.fields + [T.StructField(DATES, T.MapType(T.StringType(), schema["write_date"].dataType))])


def upsert(
    store: TableStore,
    spec: TableSpec,
    changes: DataFrame,
    columns: Collection[str] | None = None,
    arrival_wins: bool = False,
    keep_copy: bool = True,
) -> UpsertResult:
    """Apply a batch of changes to the table of ``spec``, creating or widening the table first.

    ``changes`` has an ``id``, any columns of the table, and optionally ``_batch`` (arrival order), ``_bad`` (unreadable
    fields) and ``_has`` (the fields that each record carries; those it does not carry keep their stored value).
    ``columns`` limits the update of the whole batch. With ``keep_copy`` a commit that was cut short can be finished by
    ``restore``; without it such a commit can lose ranges.
    """
    data = [c for c in changes.columns if not c.startswith("_")]
    columns = [c for c in data if columns is None or c in columns or c == "id"]
    changes = changes.select(*columns, *[c for c in changes.columns if c.startswith("_")])
    declared = T.StructType([f for f in changes.schema.fields if f.name in columns])
    info = store.info(spec.name)
    if info is None:
        new_info = TableInfo(0, 0, widened(spec.schema(), declared), spec.bucket_width, spec.slice_width)
    else:
        new_info = replace(info, schema=widened(info.schema, widened(spec.schema(), declared)))
    path = store.data_path(spec.name, new_info)
    changes = _as_kept(changes, new_info.schema)

    with _stage(changes, new_info.bucket_width, new_info.slice_width, f"batch-{spec.name}") as staged:
        facts, rows = _result(staged.facts), staged.rows
        rows, carried = _carried(rows, staged.facts)
        columns = [c for c in columns if carried is None or c in carried or c == "id"]
        if facts.records:
            new_info = replace(new_info, schema=_with_dates(new_info.schema, None if _each(rows) else columns))
        if info is None or new_info != info:
            store.describe(spec.name, replace(new_info, change=new_info.change + 1))
        if not facts.records:
            return facts
        rows = _limited(rows, new_info.slice_width, arrival_wins)
        if info is None or not path_exists(store.spark, path):
            _write(first_rows(rows, store.empty(new_info), columns), path)
            return facts
        stored = store.read_buckets(spec.name, new_info).where(F.col("id_bucket").isin(list(facts.buckets)))
        if (staged.facts["bytes"] or 0) <= broadcast_limit(store.spark):
            merged = merge_in_place(stored, rows, columns, arrival_wins)
        else:
            stored = stored.withColumn("id_slice", range_of("id", new_info.slice_width))
            merged = merge_rows(stored, rows, columns, arrival_wins)
        _replace(merged, path, spec.name, keep_copy)
    return facts


def rebuild(store: TableStore, spec: TableSpec, rows: DataFrame) -> UpsertResult:
    """Replace the whole table: write a new version beside the old one, then switch to it. Nothing is dropped first."""
    info = store.info(spec.name)
    before = (info.change, info.version) if info else (0, -1)
    data = [c for c in rows.columns if not c.startswith("_")]
    schema = T.StructType([f for f in rows.schema.fields if f.name in data])
    fresh = TableInfo(before[0] + 1, before[1] + 1, widened(spec.schema(), schema), spec.bucket_width, spec.slice_width)
    rows = _as_kept(rows, fresh.schema)
    with _stage(rows, fresh.bucket_width, fresh.slice_width, f"rebuild-{spec.name}") as staged:
        facts = _result(staged.facts)
        rows, carried = _carried(staged.rows, staged.facts)
        columns = [c for c in data if carried is None or c in carried or c == "id"]
        fresh = replace(fresh, schema=_with_dates(fresh.schema, None if _each(rows) else columns))
        path = store.data_path(spec.name, fresh)
        _write(first_rows(_limited(rows, fresh.slice_width), store.empty(fresh), columns), path)
    store.describe(spec.name, fresh)
    return facts
