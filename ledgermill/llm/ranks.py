"""The place of each row in its group, without a window over the group."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ledgermill.llm.common import stage
from ledgermill.session import local_frame


def _ranked(group: str, schema: pa.Schema):
    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, held = TaskContext.get().partitionId(), None, 0
        for batch in stream:
            if not len(batch):
                continue
            keys = batch.column(group)
            new = np.ones(len(batch), bool)
            new[0] = before is None or keys[0] != before
            new[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            at = np.arange(len(batch))
            start = np.maximum.accumulate(np.where(new, at, -1))
            rank = np.where(start < 0, at + held, at - start)
            before, held = keys[-1], int(rank[-1]) + 1
            columns = [*batch.columns, pa.array(np.full(len(batch), part), pa.int64()), pa.array(rank, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def positions(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, counted from 0 in the order of the columns ``order`` (null first) in each ``group`` (not null).

    Rows are sorted by ranges of (group, order), which cut a large group into as many tasks as it needs; ``order`` should
    tell rows apart, or equal ones share a task. A task counts inside its range, and one row per task tells the driver how
    many rows of the task's first group stand in earlier tasks.
    """
    spark, by = rows.sparkSession, [F.col(c).asc_nulls_first() for c in (group, *order)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    schema = pa.schema([*to_arrow_schema(rows.schema), ("_part", pa.int64()), ("_rank", pa.int64())])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    sorted_rows = stage(ranged.mapInArrow(_ranked(group, schema), f"{fields}, _part long, _rank long"), "ranked")
    ends = sorted_rows.groupBy("_part").agg(F.min(group).alias("low"), F.max(F.struct(group, "_rank")).alias("high"))
    offsets, last, carried = [], None, 0
    for part, low, (high, rank) in ends.orderBy("_part").collect():
        before = carried if low == last else 0
        if before:
            offsets.append((part, low, before))
        last, carried = high, rank + 1 + (before if low == high else 0)
    kind = rows.schema[group].dataType.simpleString()
    known = local_frame(spark, offsets, f"_part long, _low {kind}, _before long")
    met = sorted_rows.join(F.broadcast(known), ["_part"], "left")
    before = F.when(F.col(group) == F.col("_low"), F.col("_before")).otherwise(0)
    return met.select(*rows.columns, (F.col("_rank") + before).alias("pos"))
