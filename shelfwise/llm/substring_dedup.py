"""Repeated passages of many words, by seed and extend on winnowed anchors.

A window of ``length`` words holds a fixed number of ``ANCHOR``-word runs; its anchor is the run of
least hash among them (winnowing), so equal windows have equal anchors at equal places. Windows in
a row that share their anchor are one seed. A seed meets the rest of the corpus in a join on the
anchor only:

1. anchors found once are dropped (a grouped count, then a join that AQE can split);
2. seeds are extended both ways at once over all their windows: equal extensions found twice or
   more are repeats in full;
3. where extensions of one anchor differ, each window of the seeds is compared on its own, with
   one seed for every class of equal extensions. That is linear in the seeds of an anchor; no
   pairs are made, however many texts share a passage;
4. repeated windows that touch or overlap join into maximal repeats, and their words go.

Texts are addressed by a 64-bit hash, so copies share their seeds, and a task sends a text's seeds
twice at most: twice is all that counts. Words and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.memory import released, text_batches
from shelfwise.llm.words import Block, blocks, mix, run_hashes, runs_inside, span_hashes, word_hashes
from shelfwise.session import materialize

#: Words of an anchor; windows must be at least this long.
ANCHOR = 12
_SHIFT = 20  # a span is (first window << 20 | windows - 1)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the least of values[i:i+width], the last one of equals."""
    best, size = np.arange(len(values)), 1

    def join(one, two):
        return np.where(values[two] <= values[one], two, one)

    while 2 * size <= width:
        best = join(best[:-size], best[size:]) if len(best) > size else best[:0]
        size *= 2
    if size < width and len(best):
        rest = width - size
        best = join(best[:-rest], best[rest:]) if len(best) > rest else best[:0]
    return best


def seeds(block: Block, length: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, extension, span) of each seed in a block."""
    hashes = word_hashes(block)
    grams = run_hashes(hashes, min(ANCHOR, length))
    at = np.flatnonzero(runs_inside(block, length))
    if not len(at):
        return at, grams[:0], grams[:0], at
    own = _least(grams, length - min(ANCHOR, length) + 1)[at]
    head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    first, last = at[head], at[np.append(head[1:], len(at)) - 1]
    place = own[head]
    extension = mix(span_hashes(hashes, first, last + length) + (place - first).astype(np.uint64))
    text = np.searchsorted(block.first, first, "right") - 1
    return text, grams[place], extension, (first - block.first[text] << _SHIFT) | (last - first)


def _seeds(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: Counter = Counter()
        for batch in batches:
            tids = batch["tid"].to_numpy()
            for block in blocks(batch["text"]):
                text, anchor, extension, span = seeds(block, length)
                own = tids[block.row:block.row + len(block)]
                fresh = np.zeros(len(block), bool)
                for i in np.unique(text):
                    sent[own[i]] += 1
                    fresh[i] = sent[own[i]] <= 2
                keep = fresh[text]
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor[keep].view(np.int64)), pa.array(extension[keep].view(np.int64)),
                    pa.array(own[text[keep]]), pa.array(span[keep].astype(np.int64)),
                ], ["anchor", "extension", "tid", "span"])

    return run


def _windows(length: int) -> Callable:
    """(window hash, weight, tid, first word) of each window of the seeds that came with a text."""

    def run(batches):
        for batch in batches:
            tids, lists = batch["tid"].to_numpy(), batch["spans"]
            spans = lists.flatten()
            span, weight = (spans.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            counts = pc.list_value_length(lists).to_numpy()
            edge = np.concatenate([[0], np.cumsum(counts)])
            for block in blocks(batch["text"]):
                low, high = edge[block.row], edge[block.row + len(block)]
                if low == high:
                    continue
                text = np.repeat(np.arange(len(block)), counts[block.row:block.row + len(block)])
                code, own = span[low:high], weight[low:high]
                size = (code & ((1 << _SHIFT) - 1)) + 1
                seed = np.repeat(np.arange(len(code)), size)
                step = np.arange(len(seed)) - np.repeat(np.cumsum(size) - size, size)
                word = (code >> _SHIFT)[seed] + step
                at = word + block.first[text[seed]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(span_hashes(word_hashes(block), at, at + length).view(np.int64)),
                    pa.array(own[seed].astype(np.int64)), pa.array(tids[block.row:block.row + len(block)][text[seed]]),
                    pa.array(word.astype(np.int64) << _SHIFT),
                ], ["window", "weight", "tid", "span"])

    return run


def _kept(length: int, digest: bool) -> Callable:
    """Each text, or its SHA-256, without the words of its repeated windows."""

    def run(batches):
        for batch in batches:
            n_words, n_removed, out = [], [], []
            for text, spans in zip(batch["text"], batch["spans"]):
                words = text.as_py().encode().split()
                n_words.append(len(words))
                if spans.is_valid:
                    stay = np.ones(len(words), bool)
                    for span in spans.values.to_numpy():
                        first = span >> _SHIFT
                        stay[first:first + (span & ((1 << _SHIFT) - 1)) + length] = False
                    words = list(compress(words, stay.tolist()))
                n_removed.append(n_words[-1] - len(words))
                kept = b" ".join(words)
                out.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
            yield pa.RecordBatch.from_arrays([
                batch["id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(out, pa.string()),
            ], ["id", "n_words", "n_removed", "kept"])

    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35, digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, n_removed, text), or kept_sha256 for the text.

    Words are runs of bytes other than white space, unchanged. Every word goes that lies in a window
    of ``length`` words whose sequence also starts anywhere else, in the same text or another;
    windows are judged on the input. The rest is joined by single blanks. A null, empty or blank
    text has no words and gives an empty text; texts shorter than a window lose nothing. All copies
    of a text lose their words, rows that repeat an id included. Ids are only carried along, null
    or not; other columns are not looked at. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.select("id", F.xxhash64("text").alias("tid"), "text")
    found = texts.select("tid", "text").mapInArrow(released(_seeds(length)), "anchor long, extension long, tid long, span long")
    # Written tables on the right leave both sides of each join to plain exchanges, which AQE can split.
    with text_batches(docs.sparkSession):
        shared = materialize(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "anchors")
        found = materialize(found.join(shared, "anchor"), "seeds")

    classes = materialize(
        found.groupBy("anchor", "extension").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("tid", "span")).alias("one")), "extensions")
    repeated = (
        found.join(classes.filter("n > 1").select("anchor", "extension"), ["anchor", "extension"], "left_semi").select("tid", "span")
    )
    # Anchors whose extensions differ, one seed for each extension; a class of several counts twice.
    differing = materialize(
        classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).filter("k > 1 and n = 1").select("anchor"), "differing")
    asked = (
        classes.join(differing, "anchor")
        .select("one.tid", F.struct(F.col("one.span").alias("span"), F.least("n", F.lit(2)).alias("weight")).alias("seed"))
        .groupBy("tid").agg(F.collect_list("seed").alias("spans"))
    )
    windows = (
        texts.join(asked.hint("shuffle_hash"), "tid").select("id", "tid", "text", "spans")
        .mapInArrow(released(_windows(length)), "window long, weight long, tid long, span long")
    )
    with text_batches(docs.sparkSession):
        windows = materialize(windows, "windows")
    again = materialize(windows.groupBy("window").agg(F.sum("weight").alias("n")).filter("n > 1").select("window"), "again")
    single = windows.filter("weight = 1").join(again, "window").select("tid", "span")
    gone = repeated.unionByName(single).distinct().groupBy("tid").agg(F.collect_list("span").alias("spans"))

    id_type = docs.schema[id_col].dataType.simpleString()
    out = (
        texts.join(gone.hint("shuffle_hash"), "tid", "left").select("id", "text", "spans")
        .mapInArrow(released(_kept(length, digest)), f"id {id_type}, n_words long, n_removed long, kept string")
    )
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").alias("kept_sha256" if digest else "text"))
