"""Registries over several runs: parts, counters, stops, and what a run writes."""

import random

import pytest
from test_identity import sequential

from shelfwise.operators.identity import resolve_ids
from shelfwise.sinks import registry as reg
from shelfwise.sinks import state as st


def newest(spark, path):
    return spark.read.parquet(st._pointed(spark, path)[-1] + "/places").count()


def one_run(spark, path, streams):
    before = reg.read_registries(spark, path, ["places"])
    counters = reg.read_counters(spark, path, before)
    occurrences = spark.createDataFrame(list(enumerate(streams)), "ordinal bigint, keys array<string>").repartition(3)
    seen, added = resolve_ids(occurrences, before["places"], "PLC", 6, counters["places"])
    ids = [r["id"] for r in seen.orderBy("ordinal").collect()]
    reg.grow(path, {"places": added}, counters)
    return ids


def test_runs_equal_the_sequential_rule_and_write_new_keys_only(spark, tmp_path):
    rng = random.Random(8)
    path, known, counter = str(tmp_path / "state"), {}, 0
    streams = [rng.sample([f"k{j}" for j in range(900)], rng.choice([1, 2])) for _ in range(1200)]
    for run in (streams[::2], streams, streams, streams[:5] + [["new", "k1"], ["newer"]]):
        want, after = sequential(run, known, counter)
        assert one_run(spark, path, run) == want
        assert newest(spark, path) == len(after) - len(known)
        known, counter = after, max(int(i[-6:]) for i in after.values())
        stored = reg.read_registries(spark, path, ["places"])
        assert {r["key"]: r["id"] for r in stored["places"].collect()} == known
        assert reg.read_counters(spark, path, stored) == {"places": counter}


def entries(spark, *keys):
    return spark.createDataFrame([(k, f"P-{k}", True) for k in keys], "key string, id string, is_new boolean")


def test_a_stop_leaves_the_parts_in_force(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    reg.grow(path, {"places": entries(spark, "1")}, {"places": 0})
    with monkeypatch.context() as stopped:
        stopped.setattr(st, "point_to", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            reg.grow(path, {"places": entries(spark, "2")}, {"places": 1})
    stored = reg.read_registries(spark, path, ["places"])
    assert [r["key"] for r in stored["places"].collect()] == ["1"] and reg.read_counters(spark, path, stored) == {"places": 1}


def test_many_parts_and_old_tables_become_one(spark, tmp_path):
    path = str(tmp_path / "state")
    entries(spark, "7").select("key", "id").write.parquet(f"{path}/places")  # from before there were versions
    stored = reg.read_registries(spark, path, ["places"])
    assert reg.read_counters(spark, path, stored) == {"places": 7}
    for i in range(8, 13):
        st.append_state({"places": entries(spark, str(i)).select("key", "id")}, path, most_parts=3)
        keys = sorted(int(r["key"]) for r in reg.read_registries(spark, path, ["places"])["places"].collect())
        assert keys == list(range(7, i + 1)) and len(st._pointed(spark, path)) <= 3
    assert reg.read_counters(spark, path, {"places": entries(spark, "12")}) == {"places": 12}
