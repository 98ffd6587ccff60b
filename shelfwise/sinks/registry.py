"""Registries of ids as a growing state: entries by kind, and the last number of each kind."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sinks.state import append_state, read_state

ENTRIES = "key string, id string"
COUNTERS = "kind string, n bigint"
_COUNTERS = "counters"


def read_registries(spark: SparkSession, state: str, kinds: Iterable[str]) -> dict[str, DataFrame]:
    """The entries of each kind (``key, id``), none before the first run."""
    return {kind: read_state(spark, state, kind, ENTRIES) for kind in kinds}


def read_counters(spark: SparkSession, state: str, registries: dict[str, DataFrame]) -> dict[str, int]:
    """The highest number handed out, by kind: a row for each kind and run, whatever the registry's size.

    Only a registry that was written before there were counters is searched for it.
    """
    stored = read_state(spark, state, _COUNTERS, COUNTERS, optional=True)
    kept = {r["kind"]: r["n"] for r in stored.groupBy("kind").agg(F.max("n").alias("n")).collect()}
    return {kind: kept[kind] if kind in kept else highest_number(entries) for kind, entries in registries.items()}


def grow(state: str, added: dict[str, DataFrame], counters: dict[str, int]) -> None:
    """Append the entries a run added (``key, id, is_new``) and the numbers it went up to, all or none."""
    numbers = [
        entries.agg((F.count_if("is_new") + F.lit(counters[kind])).alias("n")).select(F.lit(kind).alias("kind"), "n")
        for kind, entries in added.items()
    ]
    tables = {kind: entries.select("key", "id") for kind, entries in added.items()}
    append_state({**tables, _COUNTERS: reduce(DataFrame.unionByName, numbers)}, state)


def highest_number(registry: DataFrame) -> int:
    """Highest number in the ids (0 for an empty registry): one row to the driver."""
    number = F.regexp_extract("id", r"(\d+)$", 1).cast("bigint")
    return registry.agg(F.coalesce(F.max(number), F.lit(0)).alias("n")).first()["n"]
