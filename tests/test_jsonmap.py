"""Entries of JSON maps cut at quotation marks against the json module."""

import json
import random

import pytest

from shelfwise.sources.files import cache_counter, import_json_cache
from shelfwise.sources.jsonmap import read_json_maps

WORDS = ['a "quoted" one', "back\\slash", "ends\\", '\\"', "{brace", "]", ",", "", " ", "line\nbreak", "tab\t", "é漢😀", ":", '"', "x" * 300]


def value(rng, deep=0):
    kind = rng.randrange(8 if deep < 3 else 5)
    if kind < 5:
        return [rng.choice(WORDS), rng.random(), True, None, rng.randrange(10**6)][kind]
    if kind == 5:
        return [value(rng, deep + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(WORDS) + str(i): value(rng, deep + 1) for i in range(rng.randrange(4))}


def same(body, want):
    if isinstance(want, str) or want is None:
        return body == want
    return json.loads(body) == want


@pytest.mark.parametrize("indent, split, ascii_only", [(None, 700, True), (2, 700, False), (None, 10**8, False)])
def test_entries_of_any_byte_range(spark, tmp_path, indent, split, ascii_only):
    rng = random.Random(split)
    data = {f"{rng.choice(WORDS)}{i}": value(rng) for i in range(120)}
    (tmp_path / "map.json").write_text(json.dumps(data, indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        tasks = spark.read.option("lineSep", '"').text(str(tmp_path)).rdd.getNumPartitions()
        got = {r["key"]: r["body"] for r in read_json_maps(spark, str(tmp_path / "map.json")).collect()}
    finally:
        for c, x in before.items():
            spark.conf.set(c, x)
    assert got.keys() == data.keys() and all(same(got[k], data[k]) for k in data)
    assert split > 10**6 or tasks > 5


def test_housekeeping_last_key_and_small_maps(spark, tmp_path):
    path = tmp_path / "cache.json"
    path.write_text('{\n "_used": 41,\n "k": {"n": 1},\n "k": {"n": 2}, "s": "", "z": {}\n}\n')
    rows = import_json_cache(spark, str(path), "n int", "track").collect()
    assert {(r["track"], r["n"]) for r in rows} == {("k", 2), ("s", None), ("z", None)}
    assert cache_counter(spark, str(path), "_used").first()[0] == 41 and cache_counter(spark, str(path), "_other").first()[0] == 0
    for text in ("{}", " { \n } ", ""):
        path.write_text(text)
        assert read_json_maps(spark, str(path)).count() == 0


@pytest.mark.parametrize("text", ['{"a": 1, "b": {"c": 2}', '{"a": "b', '{"a": [1, 2}'])
def test_a_cut_map_is_an_error(spark, tmp_path, text):
    (tmp_path / "cache.json").write_text(text)
    with pytest.raises(ValueError):
        read_json_maps(spark, str(tmp_path))
