"""Numbering, ranks in large groups, first and last rows."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.indexing import first_wins, global_index, grouped_rank, last_wins, with_sequential_id


@pytest.fixture(scope="module")
def shuffled(spark):
    rng = random.Random(5)
    rows = [(i, "hot" if rng.random() < 0.4 else f"g{rng.randrange(50)}", rng.randrange(9)) for i in range(5000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "n int, g string, v int")


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_global_index_is_dense_and_ordered(shuffled, partitions):
    out = global_index(shuffled.repartition(partitions), [F.desc("v"), F.asc("n")], partitions=partitions).collect()
    ordered = sorted(out, key=lambda r: (-r["v"], r["n"]))
    assert [r["idx"] for r in ordered] == list(range(1, 5001))


@pytest.mark.parametrize("limit", [10, 500, 1_000_000])
def test_grouped_rank_does_not_depend_on_the_group_limit(shuffled, limit):
    got = {(r["n"]): r["rank"] for r in grouped_rank(shuffled, ["g"], [F.desc("v"), F.asc("n")], max_group_rows=limit).collect()}
    groups = {}
    for r in shuffled.collect():
        groups.setdefault(r["g"], []).append((-r["v"], r["n"]))
    want = {n: i for rows in groups.values() for i, (_, n) in enumerate(sorted(rows), 1)}
    assert got == want


def test_first_last_and_ids(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 3, "z")], "k string, ordinal int, c string")
    assert {tuple(r) for r in first_wins(df, ["k"]).collect()} == {("a", 1, None), ("b", 3, "z")}
    assert {tuple(r) for r in last_wins(df, ["k"]).collect()} == {("a", 2, "x"), ("b", 3, "z")}
    ids = with_sequential_id(df, ["ordinal"], "TRK", 2, start=99).orderBy("ordinal").collect()
    assert [r["id"] for r in ids] == ["P6-TRK-99", "P6-TRK-100", "P6-TRK-101"]
