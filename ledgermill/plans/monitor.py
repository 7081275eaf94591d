"""What the loads look like from outside: freshness, row counts, errors."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.formats import duration_short, micros, number_text, timestamp_text
from ledgermill.functions.labels import area_label, mode_label, status_label
from ledgermill.functions.predicates import literal

NEVER = "never"
STATE = ("model_name", "pg_table", "last_sync", "records_synced", "duration_seconds", "status", "error_message")


def moment(as_of: datetime | None) -> Column:
    """The time ages are measured at: now in UTC, unless given."""
    if as_of is not None:
        return literal(as_of)
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def sync_status(latest: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The ``bi_sync_status`` view: state and age per model. Order it by ``last_sync`` descending to show it."""
    return latest.select(*STATE, (moment(as_of) - F.col("last_sync")).alias("time_since_sync"))


def sync_board(latest: DataFrame, counts: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """State per model beside the rows its table holds."""
    return (
        sync_status(latest, as_of)
        .join(counts, "pg_table", "left")
        .select(
            "model_name",
            "pg_table",
            "status",
            status_label(F.col("status")).alias("status_label"),
            "records_synced",
            number_text(F.col("records_synced")).alias("records_text"),
            "row_count",
            number_text(F.col("row_count")).alias("row_count_text"),
            (F.col("row_count") - F.col("records_synced")).alias("row_difference"),
            "duration_seconds",
            "last_sync",
            timestamp_text(F.col("last_sync")).alias("last_sync_text"),
            duration_short(micros(F.col("time_since_sync"))).alias("since_text"),
        )
    )


def sync_kpis(registry: DataFrame, latest: DataFrame, counts: DataFrame) -> DataFrame:
    """The figures of the front page in one row, gathered by one aggregation over three small inputs."""
    flag = lambda status: (F.col("status") == status).cast("bigint")
    models = registry.select(F.coalesce("enabled", F.lit(True)).cast("bigint").alias("total_models"))
    states = latest.select(
        flag("success").alias("synced_models"),
        flag("error").alias("error_models"),
        flag("skipped").alias("skipped_models"),
        "last_sync",
    )
    stored = counts.select(F.col("row_count").alias("total_records"))
    figures = ("total_models", "synced_models", "error_models", "skipped_models", "total_records")
    together = models.unionByName(states, allowMissingColumns=True).unionByName(stored, allowMissingColumns=True)
    return together.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in figures], F.max("last_sync").alias("last_sync")
    )


def error_models(latest: DataFrame) -> DataFrame:
    """How many models failed in their latest run, and their names, newest failure first (one entry per model)."""
    failed = latest.where("status = 'error'").select(F.struct("last_sync", "model_name").alias("f"))
    names = F.transform(F.sort_array(F.collect_list("f"), asc=False), lambda f: f["model_name"])
    return failed.agg(F.count("*").alias("errors"), F.array_join(names, ", ").alias("error_models"))


def model_status(registry: DataFrame, latest: DataFrame, counts: DataFrame) -> DataFrame:
    """Every configured model with its state; one that never ran shows ``never`` and 0 records."""
    state = latest.select("model_name", "last_sync", "records_synced", "status", "error_message", F.lit(1).alias("_ran"))
    never = F.col("_ran").isNull()
    return (
        registry.join(state, "model_name", "left")
        .join(counts, "pg_table", "left")
        .select(
            "model_name",
            "pg_table",
            F.coalesce("enabled", F.lit(True)).alias("enabled"),
            F.coalesce("incremental", F.lit(True)).alias("incremental"),
            F.coalesce("priority", F.lit(99)).alias("priority"),
            F.size("fields").alias("fields_count"),
            "last_sync",
            F.when(never, F.lit(0)).otherwise(F.col("records_synced")).alias("records_synced"),
            "row_count",
            F.when(never, F.lit(NEVER)).otherwise(F.col("status")).alias("status"),
            "error_message",
        )
    )


def model_list(status: DataFrame) -> DataFrame:
    """``model_status`` as the list page words it, in load order under its area."""
    return status.select(
        "*",
        area_label(F.col("priority")).alias("area"),
        mode_label(F.col("incremental"), "badge").alias("mode"),
        status_label(F.col("status"), F.lit("Sin sync")).alias("status_label"),
    )


def model_detail(status: DataFrame, model_name: str) -> DataFrame:
    """One model by its exact name."""
    return status.where(F.col("model_name") == model_name).select(
        "*", mode_label(F.col("incremental"), "detail").alias("mode"), status_label(F.col("status")).alias("status_label")
    )
