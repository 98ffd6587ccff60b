"""Exact, near and substring duplicates against brute force."""

import hashlib
import re

import pytest
from cases import edited, empty_docs, hard_docs, hard_rows, prose, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import ngram_join
from shelfwise.llm.components import components
from shelfwise.llm.dropping import without_ids
from shelfwise.llm.exact_dedup import drop_exact_copies, exact_groups
from shelfwise.llm.ngram_join import build_tree, drop_near_copies, dual_traversal, jaccard_components, signature
from shelfwise.llm.substring_dedup import without_repeats

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").translate(UPPER)


def best(ids):
    return max((i for i in ids if i is not None), default=None)


def least(ids):
    return min((i for i in ids if i is not None), default=None)


def brute_exact(rows):
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(lower(text), []).append(i)
    out = []
    for i, text, *_ in rows:
        ids = groups[lower(text)]
        out.append((i, best(ids), len(ids), i == best(ids), hashlib.sha256(lower(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def shingles(text, k=5):
    words = WORD.findall(lower(text))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_near(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    members = {}
    for i, r in enumerate(rows):
        members.setdefault(find(i), []).append(r[0])
    return sorted(((r[0], len(sets[i]), least(members[find(i)])) for i, r in enumerate(rows)), key=repr)


def brute_repeats(rows, length):
    words = [WORD.findall(r[1] or "") for r in rows]
    seen = {}
    for w in words:
        for i in range(len(w) - length + 1):
            seen[tuple(w[i:i + length])] = seen.get(tuple(w[i:i + length]), 0) + 1
    out = []
    for r, w in zip(rows, words):
        stay = [True] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                stay[i:i + length] = [False] * length
        kept = " ".join(x for x, s in zip(w, stay) if s)
        out.append((r[0], len(w), stay.count(False), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_groups(spark, clashing):
    assert rows_of(exact_groups(hard_docs(spark, clashing)), *EXACT) == brute_exact(hard_rows())


def test_exact_groups_many_levels(spark):
    """Texts that part only after several digits, and a group of many copies."""
    stem = "x" * 6000
    rows = [(i, stem + t) for i, t in enumerate(["a", "b", "a", "", "ab", "A"] + ["hot"] * 200)]
    assert rows_of(exact_groups(spark.createDataFrame(rows, "doc_id long, text string")), *EXACT) == brute_exact(rows)


def test_drop_exact_copies(spark):
    docs = hard_docs(spark, True)
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    wanted = {i for i, *_, stays, _ in brute_exact(hard_rows()) if stays}
    assert {r["doc_id"] for r in kept.collect()} == wanted
    assert len({lower(r["text"]) for r in kept.collect()}) == len({lower(r[1]) for r in hard_rows()})


@pytest.mark.parametrize("clashing", [False, True])
def test_jaccard_components(spark, clashing):
    found = rows_of(jaccard_components(hard_docs(spark, clashing)), "doc_id", "n_shingles", "component_id")
    assert found == brute_near(hard_rows())


def test_jaccard_components_in_tiles(spark, monkeypatch):
    """Clusters of near copies around the threshold, with trees dealt to several tiles and frequent tokens put last."""
    monkeypatch.setattr(ngram_join, "TILE", 7)
    line = " the very common line of many of them"
    rows = [(i, edited(prose(i % 3, 90), i, 1 + i % 5) + line * (i % 2)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(jaccard_components(docs), "doc_id", "n_shingles", "component_id") == brute_near(rows)


def test_shared_lines_make_no_blocks(spark, monkeypatch):
    """Texts that share a line, but have words of their own, are not candidates of each other, though too few to be very frequent."""
    counts = {}
    write = ngram_join.materialize
    monkeypatch.setattr(ngram_join, "materialize", lambda df, name="cut": counts.__setitem__(name, (out := write(df, name)).count()) or out)
    line = " " + prose(99, 30)
    rows = [(i, prose(i, 90) + line) for i in range(40)] + [(50, edited(prose(50, 90), 1, 1)), (51, edited(prose(50, 90), 2, 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert rows_of(jaccard_components(docs), "doc_id", "n_shingles", "component_id") == brute_near(rows)
    assert 0 < counts["stars"] < 8


def test_classes_without_like_sizes_stay_out_of_trees(spark):
    """A class goes into a tree only if a block of its own holds another component of like size; the edge of like sizes is kept."""
    blocks = [(1, s) for s in (1, 2, 3, 4)] + [(2, s) for s in (1, 5)] + [(3, s) for s in (1, 6, 7)] + [(4, s) for s in (1, 8, 9)]
    sizes = {1: 100, 2: 80, 3: 100, 4: 300, 5: 80, 6: 100, 7: 100, 8: 10, 9: 40}
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    members = frame(blocks, "block long, sid long")
    first = frame([(1, 1, 4), (2, 1, 2), (3, 1, 3), (4, 1, 3)], "block long, a long, held long")
    roots = frame([(6, 6), (7, 6)], "node long, root long")
    found = ngram_join._still_open(members, first, frame(list(sizes.items()), "sid long, n long"), roots, 80)
    assert {tuple(r) for r in found.collect()} == {(1, 2, 2), (1, 3, 3)}


def test_jaccard_components_without_ids(spark):
    """Near copies without an id, chains that only such a row links, and repeats of it."""
    words = prose(8, 200).split(" ")
    chain = [" ".join([f"edit{j}" if j < 12 * i else w for j, w in enumerate(words)]) for i in range(3)]
    near = prose(9, 100)
    rows = [(1, chain[0]), (None, chain[1]), (2, chain[2]), (3, near), (None, edited(near, 1, 1)), (None, edited(near, 2, 1))]
    rows += [(None, edited(prose(10, 100), i, 1)) for i in range(3)] + [rows[1]] * 5 + [(4, prose(11, 100))] * 3 + [(4, edited(prose(11, 100), 1, 1))] * 2
    wanted = brute_near(rows)
    assert (2, 196, 1) in wanted and (None, 96, 3) in wanted and (None, 96, None) in wanted
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(jaccard_components(docs), "doc_id", "n_shingles", "component_id") == wanted


def test_full_filter_adds_no_pairs(spark, monkeypatch):
    """Where every row passes the filter, each class still has one row in every pair."""
    monkeypatch.setattr(ngram_join, "passes", lambda filled, keys: keys == keys)
    seen = []
    count = ngram_join._with_column
    monkeypatch.setattr(ngram_join, "_with_column", lambda pairs, sets, column: seen.append((pairs.count(), (out := count(pairs, sets, column)).count(), sets.chosen.count())) or out)
    rows = [(i, edited(prose(6, 90), i % 4, 1)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(jaccard_components(docs), "doc_id", "n_shingles", "component_id") == brute_near(rows)
    assert seen and all(n == m <= 6 and classes <= 4 for n, m, classes in seen)


def test_drop_near_copies(spark):
    docs = hard_docs(spark, True)
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, c in brute_near(hard_rows()) if i == c}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=30), min_size=2, max_size=40), st.sampled_from([50, 80, 95]))
def test_tree_loses_no_link(sets, percent):
    import numpy as np

    tokens = [np.array(sorted(hash_(x) for x in s), np.uint64) for s in sets]
    groups = np.arange(len(sets))
    tree = build_tree(np.array([len(s) for s in sets]), [signature(t) for t in tokens], groups, groups * 0)
    found = {frozenset(p) for p in dual_traversal(tree, percent, False)}
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                assert frozenset((a, b)) in found


def hash_(x: int) -> int:
    return (x * 0x9E3779B97F4A7C15 + 12345) % 2**64


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3)]
    found = dict(rows_of(components(spark.createDataFrame(chain, "a long, b long")), "node", "root"))
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


@pytest.mark.parametrize("length", [12, 35])
def test_without_repeats(spark, length):
    found = rows_of(without_repeats(hard_docs(spark, True), length=length, digest=True), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == brute_repeats(hard_rows(), length)


def test_without_repeats_text(spark):
    out = {r["doc_id"]: r["text"] for r in without_repeats(hard_docs(spark).filter("doc_id = 5 or doc_id = 2")).collect()}
    assert out == {5: "two words", 2: ""}


def test_without_repeats_partial_overlaps(spark):
    """Passages of one anchor that differ on either side, and shifted repeats inside one text."""
    passage = prose(5, 60).split()
    rows = [(i, " ".join(["x%d" % i] + passage[i % 9:60 - i % 7] + ["y%d" % i])) for i in range(60)]
    rows.append((99, " ".join(passage[:40] + passage[3:50] + passage[:36])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = rows_of(without_repeats(docs, digest=True), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == brute_repeats(rows, 35)


def loose_rows():
    """Null ids with unique, copied and nearly copied texts; rows repeated whole; ids with several texts."""
    near, other = prose(9, 100), prose(12, 80)
    rows = [(None, prose(30, 40)), (None, other), (8, other), (None, near), (3, edited(near, 1, 1)), (None, edited(near, 2, 1))]
    rows += [(5, prose(31, 50))] * 4 + [(None, prose(32, 50))] * 3 + [(None, prose(33, 50).upper()), (None, prose(33, 50))]
    rows += [(6, prose(34, 60)), (6, near), (6, prose(34, 60).upper()), (7, prose(35, 90)), (7, edited(prose(35, 90), 1, 1))]
    return rows + [(None, None), (None, " "), (None, " "), (9, "")]


def one_each(rows, groups, least_id):
    """(id, number of rows) that stay of each group."""
    members = {}
    for row, group in zip(rows, groups):
        members.setdefault(group, []).append(row[0])
    return sorted(((least if least_id else best)(ids) for ids in members.values()), key=repr)


def near_groups(rows):
    """The component of each row, by brute force over the rows' places."""
    found = {i: c for i, _, c in brute_near([(i, r[1]) for i, r in enumerate(rows)])}
    return [found[i] for i in range(len(rows))]


def test_drops_keep_one_row_of_each_group(spark):
    for rows in (loose_rows(), [(r[0], r[1]) for r in hard_rows()]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        exact, near = ([(r["doc_id"], r["text"]) for r in drop(docs).collect()] for drop in (drop_exact_copies, drop_near_copies))
        assert set(exact) <= set(rows) and set(near) <= set(rows)
        assert sorted((i for i, _ in exact), key=repr) == one_each(rows, [lower(t) for _, t in rows], False)
        assert sorted(lower(t) for _, t in exact) == sorted({lower(t) for _, t in rows})
        assert sorted((i for i, _ in near), key=repr) == one_each(rows, near_groups(rows), True)
        assert len(set(near_groups(near))) == len(near)


def test_empty_tables(spark):
    docs = empty_docs(spark)
    for out in (exact_groups(docs), jaccard_components(docs), without_repeats(docs), drop_exact_copies(docs), drop_near_copies(docs)):
        assert out.collect() == []


def test_without_ids(spark):
    docs = spark.createDataFrame([(i if i else None, str(i)) for i in range(50)], "doc_id long, text string")
    gone = spark.createDataFrame([(i,) for i in (3, 4, None)], "x long")
    assert {r["text"] for r in without_ids(docs, gone).collect()} == {str(i) for i in range(1, 50)} - {"3", "4"}


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """Steps over whole texts run with small Arrow batches; the session's own setting is back afterwards."""
    import shelfwise.llm.packing as packing
    import shelfwise.llm.substring_dedup as substrings
    from shelfwise.llm.memory import TEXT_ROWS
    from shelfwise.llm.settings import bpe_file

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(key), {}
    for module in (substrings, packing):
        def noted(df, name, write=module.materialize):
            seen[name] = int(spark.conf.get(key))
            return write(df, name)

        monkeypatch.setattr(module, "materialize", noted)
    assert without_repeats(hard_docs(spark)).count()
    assert packing.pack_documents(hard_docs(spark), bpe_file()).count()
    assert {seen[n] for n in ("anchors", "seeds", "windows", "pieces")} == {TEXT_ROWS} and seen["again"] == int(before)
    assert spark.conf.get(key) == before


def test_stages_over_texts_run_in_small_batches(spark, monkeypatch):
    """Stages whose last step hands whole texts to Python write it themselves, with small Arrow batches."""
    import corpus_pipeline
    from shelfwise.llm.memory import TEXT_ROWS

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(key), []
    write = corpus_pipeline.materialize

    def noted(df, name):
        seen.append((int(spark.conf.get(key)), "ArrowEvalPython" in (plan := df._jdf.queryExecution().toString()) or "MapInArrow" in plan))
        return write(df, name)

    monkeypatch.setattr(corpus_pipeline, "materialize", noted)
    stages = dict(corpus_pipeline.STAGES)
    docs = hard_docs(spark)
    for name in ("language", "exact copies", "personal data"):
        plan = stages[name](spark, docs, "")._jdf.queryExecution().toString()
        assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan
    assert seen == [(TEXT_ROWS, True)] * 3 and spark.conf.get(key) == before


def test_exact_copies_lower_texts_once(spark):
    """Each branch of the plan runs the lower-casing once, so that a task holds no third worker."""
    plan = drop_exact_copies(hard_docs(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython [ascii_lower") == plan.count("ArrowEvalPython [may") > 0
