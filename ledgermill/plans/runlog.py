"""The run log: one appended row per table and run. Its latest row per model is the state of the loads."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable
from dataclasses import astuple, dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.dedupe import latest_per_key
from ledgermill.session import hadoop_path, local_frame, path_exists

RUN_SCHEMA = (
    "run_id string, model_name string, pg_table string, started_at timestamp_ntz, last_sync timestamp_ntz, "
    "records_synced bigint, duration_seconds double, status string, error_message string, mark timestamp_ntz, "
    "last_batch bigint, rejected bigint, bad_values bigint, last_id bigint"
)


@dataclass(frozen=True)
class Run:
    run_id: str
    model_name: str
    pg_table: str
    started_at: datetime
    last_sync: datetime
    records_synced: int = 0
    duration_seconds: float = 0.0
    status: str = "success"
    error_message: str | None = None
    mark: datetime | None = None
    last_batch: int | None = None
    rejected: int = 0
    bad_values: int = 0
    last_id: int | None = None


@dataclass(frozen=True)
class Progress:
    """Where the next incremental load of a model starts.

    A capped load that was not done goes on after ``last_id``, in the extracts up to ``upto`` that it began with.
    """

    mark: datetime | None = None
    last_batch: int | None = None
    last_id: int | None = None
    upto: int | None = None


def sync_state_latest(runs: DataFrame) -> DataFrame:
    """The latest run of each model."""
    return latest_per_key(runs, ["model_name"], [F.desc("last_sync"), F.desc("run_id")])


def watermark_reference(runs: DataFrame) -> DataFrame:
    """The finish time of the latest run, only where that run succeeded: after a failure the next load is full."""
    return sync_state_latest(runs).where("status = 'success'").select("model_name", F.col("last_sync").alias("mark"))


def watermark_last_success(runs: DataFrame) -> DataFrame:
    """The furthest mark of the successful runs: a failed run in between changes nothing."""
    done = runs.where("status = 'success'")
    columns = [F.max("mark").alias("mark")]
    if "last_batch" in runs.columns:
        columns.append(F.max("last_batch").alias("last_batch"))
    return done.groupBy("model_name").agg(*columns)


def run_summary(runs: DataFrame) -> DataFrame:
    """One row per run of the whole load."""
    return runs.groupBy("run_id").agg(
        F.count("*").alias("models"),
        F.sum("records_synced").alias("total_records"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.round(F.sum("duration_seconds"), 2).alias("total_duration"),
        F.round(F.max("duration_seconds"), 2).alias("longest_duration"),
        F.min("last_sync").alias("first_finish"),
        F.max("last_sync").alias("last_finish"),
    )


class RunLog:
    """The rows of all runs: Parquet in one folder per generation, of which the highest counts.

        <root>/etl_sync_log/gen=<n>/*.parquet     all rows of earlier generations in one file, and a file per later append
        <root>/etl_sync_log/*.parquet             generation 0

    An append that makes a folder hold more than ``files`` files is followed by a compaction: all rows go to a new folder,
    which is given its name when it is complete; then the old ones are removed. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, files: int = 100):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/etl_sync_log"
        self.files = files
        self.one_at_a_time = threading.Lock()  # appends share a folder for their temporary files

    def _generations(self) -> list[int]:
        if not path_exists(self.spark, self.path):
            return []
        fs, path = hadoop_path(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.removeprefix("gen=")) for n in names if n.startswith("gen="))

    def _folder(self, generation: int) -> str:
        return f"{self.path}/gen={generation}" if generation else self.path

    def _files(self, folder: str) -> list:
        fs, path = hadoop_path(self.spark, folder)
        return [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().endswith(".parquet")]

    def append(self, runs: Iterable[Run]) -> None:
        rows = [astuple(r) for r in runs]
        if not rows:
            return
        with self.one_at_a_time:
            generation = max(self._generations(), default=0)
            folder = self._folder(generation)
            local_frame(self.spark, rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
            if len(self._files(folder)) > self.files:
                self._compact(generation)

    def _compact(self, generation: int) -> None:
        fresh = f"{self.path}/_gen-{uuid.uuid4().hex}"
        self.runs().coalesce(1).write.parquet(fresh)
        fs, source = hadoop_path(self.spark, fresh)
        fs.rename(source, hadoop_path(self.spark, self._folder(generation + 1))[1])
        for old in self._files(self.path):
            fs.delete(old, False)
        for old in self._generations()[:-1]:
            fs.delete(hadoop_path(self.spark, self._folder(old))[1], True)

    def runs(self) -> DataFrame:
        return self.seen_by(self.spark)

    def seen_by(self, spark: SparkSession) -> DataFrame:
        """The rows as a DataFrame of another session."""
        generation = max(self._generations(), default=0)
        folder = self._folder(generation)
        if path_exists(self.spark, folder):
            return spark.read.schema(RUN_SCHEMA).parquet(*([folder] if generation else [f"{folder}/*.parquet"]))
        return local_frame(spark, [], RUN_SCHEMA)

    def progress(self, reference_watermark: bool = False) -> dict[str, Progress]:
        """Every model's progress; one row per model reaches the driver."""
        if reference_watermark:
            return {r.model_name: Progress(r.mark) for r in watermark_reference(self.runs()).collect()}
        runs = self.runs()
        marks = {r.model_name: Progress(r.mark, r.last_batch) for r in watermark_last_success(runs).collect()}
        latest = sync_state_latest(runs.where("status IN ('success', 'partial')")).where("status = 'partial'")
        for r in latest.collect():
            before = marks.get(r.model_name, Progress())
            marks[r.model_name] = replace(before, last_id=r.last_id, upto=r.last_batch)
        return marks
