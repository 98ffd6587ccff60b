"""BPE, packing and sharding."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import empty_docs, hard_docs, hard_rows, prose, rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import sharding
from shelfwise.llm.bpe import Bpe, decoded, encode_texts, ids_text
from shelfwise.llm.packing import combinations, greedy, pack_documents, plan, repeat_counts, rounded
from shelfwise.llm.settings import bpe_file
from shelfwise.llm.sharding import place_items, shard_documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe_file())


@pytest.fixture(scope="module")
def bpe():
    return Bpe(bpe_file())


def strange_texts(n=4000):
    rng = random.Random(3)
    pool = list("ab 's tll\n\t  !?.,'\"09é ß 　 \x85\x1c\x1f\x0b漢字😀ـعربي́") + ["<|endoftext|>", "'ll", "  ", "\r\n", "don't"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return texts + ["".join(chr(rng.choice([rng.randrange(32, 0xD7FF), rng.randrange(32, 300)])) for _ in range(40)) for _ in range(n)]


def ids_of(bpe, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_column(pa.array(texts, pa.string()))]


def test_encoding_equals_the_library(bpe, library):
    texts = strange_texts() + [t or "" for _, t, *_ in hard_rows()] + ["x" * 3000, " " * 500, "ab" * 2000]
    assert ids_of(bpe, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_plain_merges_equal_the_library(bpe, library):
    """The merges in Python, for vocabularies that the compiled encoder does not suit."""
    texts = strange_texts(300) + [prose(1, 200)]
    compiled, bpe.compiled = bpe.compiled, None
    bpe.known.clear()
    try:
        assert ids_of(bpe, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    finally:
        bpe.compiled = compiled
        bpe.known.clear()


def test_forced_boundaries(bpe):
    with open(bpe_file(), encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    assert len(vocab) + 1 == len(bpe.token)
    assert all(bpe.inside[a, b] for token in list(bpe.token.values())[:5000] if token in bpe.token.values() and token != b"<|endoftext|>"
               for a, b in zip(token, token[1:]))
    assert not bpe.cuts.reshape(256, 256)[bpe.inside].any()


def test_decoding_equals_the_library(bpe, library):
    rng = random.Random(1)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(20)]
        assert bpe.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_encode_texts(spark, library):
    docs = hard_docs(spark, True)
    out = encode_texts(docs, bpe_file())
    assert "text" not in out.columns and "ids" in out.columns and "shard" in out.columns
    found = rows_of(out.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("a"), ids_text("ids").alias("b"),
                               decoded("ids", bpe_file()).alias("text")), "doc_id", "a", "b", "text")
    wanted = []
    for i, text, *_ in hard_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        joined = ",".join(map(str, ids))
        wanted.append((i, joined, joined, library.decode(ids, skip_special_tokens=False)))
    assert found == sorted(wanted, key=repr)
    assert encode_texts(empty_docs(spark), bpe_file()).collect() == []


def test_op5_runs_in_small_batches(spark, library, monkeypatch, tmp_path):
    """Whole texts and their ids go to Python in small Arrow batches, and the query is run to its end with them."""
    from shelfwise.llm import queries
    from shelfwise.llm.memory import TEXT_ROWS

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(key), []
    write = queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, name: seen.append(int(spark.conf.get(key))) or write(df, name))
    hard_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.bpe_encoding(spark, str(tmp_path))
    plan = out._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan
    wanted = [(i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in hard_rows()]
    assert rows_of(out, "doc_id", "n_tokens") == sorted(wanted, key=repr)
    assert seen == [TEXT_ROWS] and spark.conf.get(key) == before


def check_packing(rows, texts, library, window):
    """All ids once, in order, in gapless sequences; the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, pieces in by_doc.items():
        ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        pieces.sort(key=lambda r: r["start"])
        assert [r["start"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces])[:-1].tolist()
        for r in pieces:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids)
        assert sum(r["length"] for r in pieces) == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return padding / max(1, total + padding)


@pytest.mark.parametrize("window", [16, 1024])
def test_pack_documents(spark, library, window):
    rows = [(i, t) for i, (_, t, *_) in enumerate(hard_rows())] + [(1000 + i, prose(i, 5 + i % 37)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    packed = pack_documents(docs, bpe_file(), window=window).collect()
    assert check_packing(packed, dict(rows), library, window) < 0.03


def test_pack_hard_rows(spark, library):
    packed = pack_documents(hard_docs(spark, True), bpe_file(), keep_ids=True).collect()
    assert sum(r["start"] == 0 for r in packed) == len(hard_rows())
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in packed)
    assert pack_documents(empty_docs(spark), bpe_file()).collect() == []


def test_least_squares_plan():
    window = 64
    assert (combinations(window, np.arange(1, 65)).sum(axis=1) == window).all()
    rng = np.random.default_rng(1)
    histogram = np.concatenate([[0], rng.integers(0, 5000, window)]).astype(float)
    combos = combinations(window, np.flatnonzero(histogram))
    counts = repeat_counts(combos, histogram)
    usage = sum(np.bincount(combos[:, i], counts, window + 1) for i in range(3))
    assert (counts >= 0).all() and np.abs(usage - histogram)[1:].sum() < 0.2 * histogram.sum()
    whole = rounded(combos, counts, histogram)
    left = histogram - sum(np.bincount(combos[:, i], whole, window + 1) for i in range(3))
    assert (left[1:] >= 0).all() and left[1:].sum() < 0.3 * histogram.sum()
    assert sum(sum(parts) * n for parts, n in greedy(left.astype(int), window)) == (np.arange(1, window + 1) * left[1:]).sum()
    slots = plan(histogram.astype(int), window)
    assert len(slots.key) == len(set(slots.key))


def check_shards(rows, texts, shards):
    slots, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        slots[r["shard"]].append(r["slot"])
        groups[raw].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    return groups


def test_shard_documents(spark):
    rows = [(i, prose(i % 700, 10 + i % 90)) for i in range(1000)]
    found = shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    groups = check_shards(found, dict(rows), 8)
    assert all(len(s) == 1 for s in groups.values())
    for column in ("size", "tokens", None):
        sums = defaultdict(int)
        for r in found:
            sums[r["shard"]] += r[column] if column else 1
        assert len(sums) == 8 and max(sums.values()) - min(sums.values()) < 0.02 * sum(sums.values()) / 8


def test_shard_a_group_of_half_the_rows(spark):
    rows = [(i, "the same text of them all" if i % 2 else prose(i, 20)) for i in range(2000)]
    found = shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_shards(found, dict(rows), 8)
    sums = defaultdict(int)
    for r in found:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) - min(sums.values()) < 0.05 * sum(sums.values()) / 8


def test_shard_hard_rows(spark):
    found = shard_documents(hard_docs(spark, True)).collect()
    assert sorted(repr(r["doc_id"]) for r in found) == sorted(repr(r[0]) for r in hard_rows())
    assert shard_documents(empty_docs(spark)).collect() == []


def test_place_items_follows_residual_capacity():
    sizes = np.array([[8, 1, 1], [8, 1, 1], [1, 8, 1], [1, 8, 1]])
    shard = place_items(sizes, 2)
    assert sorted(shard[:2]) == sorted(shard[2:]) == [0, 1]
    assert len(place_items(np.zeros((0, 3), int), 8)) == 0 and sharding.BUNDLES > 0
