"""Identity resolution against the sequential rule."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.identity import registry_conflicts, resolve_ids


def sequential(streams, registry, counter):
    registry, ids = dict(registry), []
    for keys in streams:
        found = next((registry[k] for k in keys if k in registry), None)
        if found is None:
            counter += 1
            found = f"P6-PLC-{counter:06d}"
        for k in keys:
            registry.setdefault(k, found)
        ids.append(found)
    return ids, registry


@pytest.mark.parametrize("seed, n_keys, prefilled", [(1, 40, False), (2, 400, True), (3, 4000, False), (4, 300, True)])
def test_same_ids_and_registry_as_one_row_at_a_time(spark, seed, n_keys, prefilled):
    rng = random.Random(seed)
    streams = [rng.sample([f"k{j}" for j in range(n_keys)], rng.choice([1, 2, 2])) for _ in range(3000)]
    start = {f"k{j}": f"P6-PLC-{j // 2 + 1:06d}" for j in range(0, n_keys, 7)} if prefilled else {}
    counter = n_keys if prefilled else 0
    want_ids, want_registry = sequential(streams, start, counter)
    occurrences = spark.createDataFrame(list(enumerate(streams)), "ordinal bigint, keys array<string>").repartition(7)
    registry = spark.createDataFrame(list(start.items()), "key string, id string")
    got, added = resolve_ids(occurrences, registry, "PLC", 6, counter)
    assert [r["id"] for r in got.orderBy("ordinal").collect()] == want_ids
    new = {r["key"]: r["id"] for r in added.collect()}
    assert {**start, **new} == want_registry and not set(new) & set(start)
    again, none = resolve_ids(occurrences, registry.unionByName(added.select("key", "id")), "PLC", 6, 10**6)
    assert none.count() == 0 and [r["id"] for r in again.orderBy("ordinal").collect()] == [want_registry[s[0]] for s in streams]


def test_a_long_alias_chain(spark):
    streams = [["k0"]] + [[f"k{i + 1}", f"k{i}"] for i in range(200)]
    occurrences = spark.createDataFrame(list(enumerate(streams)), "ordinal bigint, keys array<string>")
    got, added = resolve_ids(occurrences, spark.createDataFrame([], "key string, id string"), "PLC", 6)
    assert {r["id"] for r in got.collect()} == {"P6-PLC-000001"}
    assert added.filter(F.col("is_new")).count() == 1 and added.count() == 201


def test_conflicts_are_reported_not_merged(spark):
    occurrences = spark.createDataFrame([(0, ["a"]), (1, ["b"]), (2, ["a", "b"])], "ordinal bigint, keys array<string>")
    got, added = resolve_ids(occurrences, spark.createDataFrame([], "key string, id string"), "PLC", 6)
    assert [r["id"][-1] for r in got.orderBy("ordinal").collect()] == ["1", "2", "1"]
    assert [tuple(r)[:2] for r in registry_conflicts(occurrences, added).collect()] == [("a", "b")]
