"""Packing token pieces into windows by non-negative least squares over shallow combinations.

Documents are cut into whole windows and one rest. The histogram of lengths has one count for each
length up to the window, whatever the corpus, and only that goes to the driver:

1. every combination of up to three lengths that fills a window is enumerated;
2. repeat counts are solved against the histogram by non-negative least squares (projected
   gradient with momentum; a combination is a sparse column of at most three entries);
3. counts are rounded along the order of combinations so that sums stay, and taken back where a
   length would be used more often than it occurs;
4. what is left of the histogram is packed greedily, longest first, with whole runs of equal
   combinations at a time.

The plan is a table of slots by length. A piece takes the slot of its rank among the pieces of its
length; ranks come from counts per task, so no length is ever brought together in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.bpe import _parts, vocabulary
from shelfwise.llm.memory import released, text_batches
from shelfwise.llm.ranks import with_ranks
from shelfwise.session import materialize

STEPS = 300
_RANK = 40  # slots are ordered by (length << 40 | first rank)


def combinations(window: int, lengths: np.ndarray) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c, of occurring lengths that fill a window; 0 stands for none."""
    present = np.zeros(window + 1, bool)
    present[lengths] = present[0] = True
    a, b = np.meshgrid(np.arange(window + 1), np.arange(window + 1), indexing="ij")
    c = window - a - b
    good = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[good], b[good], c[good]
    good = present[a] & present[b] & present[c] & (a > 0)
    return np.stack([a[good], b[good], c[good]], 1)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative x that brings sum(x * combination) close to the histogram in least squares."""
    scale = histogram.max() or 1
    target = histogram / scale
    size = len(histogram)

    def usage(x):
        out = sum(np.bincount(combos[:, i], x, size) for i in range(3))
        out[0] = 0
        return out

    # The step is the inverse of the largest curvature, found by power iteration.
    v = np.ones(len(combos))
    for _ in range(20):
        u = usage(v)
        v = u[combos].sum(axis=1)
        bound = np.linalg.norm(v)
        v /= bound
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        slope = (usage(y) - target)
        slope[0] = 0
        fresh = np.maximum(0, y - slope[combos].sum(axis=1) / bound)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y = fresh + (last - 1) / t * (fresh - x)
        x = fresh
    return x * scale


def rounded(combos: np.ndarray, counts: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Whole counts with the same running sums that use no length more often than it occurs."""
    sums = np.floor(np.cumsum(counts) + 1e-9).astype(np.int64)
    whole = np.diff(np.concatenate([[0], sums]))
    left = histogram.astype(np.int64).copy()
    left[0] = np.iinfo(np.int64).max // 2
    out = np.zeros_like(whole)
    for j in np.flatnonzero(whole):
        parts, times = np.unique(combos[j][combos[j] > 0], return_counts=True)
        out[j] = min(whole[j], int((left[parts] // times).min()))
        left[parts] -= out[j] * times
    return out


def greedy(histogram: np.ndarray, window: int) -> list[tuple[list[int], int]]:
    """Combinations with repeat counts that use up the histogram, longest lengths first."""
    left = {int(n): int(histogram[n]) for n in np.flatnonzero(histogram) if n}
    out = []
    while left:
        combo: dict[int, int] = {}
        space = window
        for n in sorted(left, reverse=True):
            if n <= space:
                combo[n] = take = min(left[n], space // n)
                space -= n * take
        times = min(left[n] // k for n, k in combo.items())
        for n, k in combo.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        out.append(([n for n, k in combo.items() for _ in range(k)], times))
    return out


@dataclass
class Slots:
    """For each length its slots, in the order of ranks."""

    key: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = (length << _RANK) | rank
        at = np.searchsorted(self.key, wanted, "right") - 1
        return self.sequence[at] + wanted - self.key[at], self.offset[at]


def plan(histogram: np.ndarray, window: int) -> Slots:
    """Slots for ``histogram[n]`` pieces of each length n."""
    chosen: list[tuple[list[int], int]] = []
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    combos = combinations(window, np.flatnonzero(left))
    if len(combos):
        counts = rounded(combos, repeat_counts(combos, left.astype(float)), left)
        for j in np.flatnonzero(counts):
            parts = [int(n) for n in combos[j] if n]
            chosen.append((parts, int(counts[j])))
            np.subtract.at(left, parts, counts[j])
    chosen += greedy(left, window)
    used, sequence = np.zeros(window + 1, np.int64), 0
    slots = []
    for parts, times in chosen:
        offset = 0
        for n in parts:
            slots.append(((n << _RANK) | int(used[n]), sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    table = np.array(sorted(slots), np.int64).reshape(-1, 3)
    return Slots(table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy())


def _pieces(path: str, window: int, end_id: int, keep_ids: bool) -> Callable:
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        bpe, task = vocabulary(path), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            for part in _parts(batch, "text"):
                row, start, length, crc, total, local, ids = [], [], [], [], [], [], []
                for i, raw in enumerate(bpe.encode_column(part["text"])):
                    raw += end
                    n = len(raw) // 4
                    for first in range(0, n, window):
                        piece = raw[4 * first:4 * (first + window)]
                        size = len(piece) // 4
                        row.append(i)
                        start.append(first)
                        length.append(size)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        local.append(seen[size])
                        seen[size] += 1
                        if keep_ids:
                            ids.append(np.frombuffer(piece, "<i4"))
                columns = [part["id"].take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                           pa.array([task] * len(row), pa.int32()), pa.array(local, pa.int64())]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens", "task", "local"]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pack_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end_id: int = 0,
    keep_ids: bool = False, keep_vocabulary: bool = True,
) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    A document is the ids of its whole text and ``end_id``; a null or empty text is ``end_id`` alone.
    Each id lies in one piece, and pieces lie in a sequence without gaps from offset 0 to at most
    ``window``. Ids of rows are only carried, null or repeated ones too; each row is a document of
    its own. An empty table gives no rows; other columns are not looked at. With ``keep_ids`` each
    piece carries its token ids. Without ``keep_vocabulary`` workers drop the vocabulary at the end of each task.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType
    fields = [("id", id_type), *((n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")),
              ("task", T.IntegerType()), ("local", T.LongType())] + [("ids", T.ArrayType(T.IntegerType()))] * keep_ids
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    make = _pieces(path, window, end_id, keep_ids)
    if not keep_vocabulary:
        make = released(make, vocabulary.cache_clear)
    with text_batches(docs.sparkSession):
        pieces = materialize(source.mapInArrow(make, schema), "pieces")

    histogram = np.zeros(window + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # a row for each length up to the window
        histogram[length] = n
    slots = plan(histogram, window)

    def place(batches):
        for batch in batches:
            sequence, offset = slots.place(batch["length"].to_numpy(), batch["rank"].to_numpy())
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    ranked = with_ranks(pieces, "length")
    out = T.StructType([*(f for f in ranked.schema.fields if f.name != "rank"),
                        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, out).withColumnRenamed("id", id_col)
