"""Ends of pointer chains against a walk, and how many rows are written for them."""

import random

import pytest

from shelfwise.operators import matching, pointers
from shelfwise.operators.pointers import follow


def walk(links):
    ends = {}
    for start in links:
        seen, at = set(), start
        while links.get(at) is not None and at not in seen:
            seen.add(at)
            at = links[at]
        if links[start] is not None:
            ends[start] = None if at in seen else at
    return ends


@pytest.fixture
def written(monkeypatch):
    """Rows of every table that the steps write."""
    rows = []
    for module in (pointers, matching):
        plain = module.materialize

        def counted(df, name="cut", plain=plain):
            stored = plain(df, name)
            rows.append(stored.count())
            return stored

        monkeypatch.setattr(module, "materialize", counted)
    return rows


def test_chains_trees_cycles_and_dead_ends(spark):
    rng = random.Random(3)
    links = {f"c{i}": f"c{i - 1}" if i else None for i in range(150)}
    links |= {f"t{i}": f"t{rng.randrange(i)}" if i else None for i in range(300)}
    links |= {f"d{i}": f"d{i + 1}" for i in range(40)}  # d40 has no row
    links |= {f"y{i}": f"y{(i + 1) % 7}" for i in range(7)} | {"self": "self"}
    links |= {f"in{i}": f"in{i - 1}" if i else "y3" for i in range(20)} | {"leaf": "self", "alone": None}
    table = spark.createDataFrame(list(links.items()), "id string, parent string")
    got = follow(table).collect()
    assert {r["id"]: r["root"] for r in got} == walk(links) and len(got) == len(walk(links))


@pytest.mark.parametrize("links", [{}, {"a": None}, {"a": "b"}, {"a": "a"}])
def test_small_cases(spark, links):
    table = spark.createDataFrame(list(links.items()), "id bigint, parent bigint" if not links else "id string, parent string")
    assert {r["id"]: r["root"] for r in follow(table).collect()} == walk(links)


def test_a_wide_hierarchy_is_written_about_once(spark, written):
    nodes = [("r", "FR", None)] + [(f"n{i}", None, "r") for i in range(10)] + [(f"c{i}", None, f"n{i % 10}") for i in range(300)]
    nodes += [(f"o{i}", None, f"c{i % 300}") for i in range(6000)] + [("x", "", "y"), ("y", None, "x"), ("z", None, None)]
    got = matching.resolve_codes(spark.createDataFrame(nodes, "id string, code string, parent string").repartition(5))
    codes = {r["id"]: r["code"] for r in got.collect()}
    assert len(codes) == len(nodes) and {k for k, c in codes.items() if c != "FR"} == {"x", "y", "z"}
    assert sum(written) <= 1.2 * len(nodes)
