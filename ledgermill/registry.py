"""The table registry: read from a configuration file, queried as a DataFrame."""

from __future__ import annotations

import configparser
from collections.abc import Iterable
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.session import local_frame
from ledgermill.specs import TableSpec

REGISTRY_SCHEMA = (
    "ordinal int, model_name string, pg_table string, priority int, enabled boolean, incremental boolean, "
    "fields array<string>"
)


def load_registry(text: str | None = None) -> list[TableSpec]:
    """Table specs in declaration order, from ``text`` or from the packaged ``registry.ini``."""
    if text is None:
        text = resources.files("ledgermill").joinpath("registry.ini").read_text(encoding="utf-8")
    parser = configparser.ConfigParser()
    parser.read_string(text)
    return [
        TableSpec(
            name=name,
            model=section.get("model", ""),
            fields=tuple(section.get("fields", "").split()),
            priority=section.getint("priority", 99),
            incremental=section.getboolean("incremental", True),
            enabled=section.getboolean("enabled", True),
        )
        for name, section in parser.items()
        if name != parser.default_section
    ]


def registry_frame(spark: SparkSession, specs: Iterable[TableSpec]) -> DataFrame:
    rows = [
        (i, s.model, s.name, s.priority, s.enabled, s.incremental, list(s.fields)) for i, s in enumerate(specs)
    ]
    return local_frame(spark, rows, REGISTRY_SCHEMA)


def enabled(registry: DataFrame) -> DataFrame:
    """Enabled entries in load order; equal priorities keep their declaration order."""
    return (
        registry.where(F.coalesce("enabled", F.lit(True)))
        .withColumn("priority", F.coalesce("priority", F.lit(99)))
        .orderBy("priority", "ordinal")
    )


def named(registry: DataFrame, names: list[str]) -> DataFrame:
    """Entries whose model or table name is listed; names nobody has are ignored."""
    return registry.where(F.col("model_name").isin(names) | F.col("pg_table").isin(names))


def select_specs(specs: Iterable[TableSpec], only: Iterable[str] | None = None) -> list[TableSpec]:
    """The specs a run should load, in load order: the driver-side twin of ``enabled`` and ``named``."""
    chosen = sorted((s for s in specs if s.enabled), key=lambda s: s.priority)
    if only is not None:
        wanted = set(only)
        chosen = [s for s in chosen if s.model in wanted or s.name in wanted]
    return chosen


def registry_counts(registry: DataFrame) -> DataFrame:
    return registry.agg(
        F.count("*").alias("models_total"),
        F.count_if(F.coalesce("enabled", F.lit(True))).alias("models_enabled"),
    )
