"""Exact top-k inner products by block-at-a-time pruning.

Vectors are documents whose terms are the dimensions and whose weights are whole numbers of either
sign. Ranges of documents, laid out by leading term and id, form blocks; a block keeps the maximum and the minimum of each term and a
forward index (its vectors side by side). For a query the sum over terms of the larger of weight
times maximum and weight times minimum bounds every score in a block. Blocks are taken in the order
of that bound; each is scored through its forward index, and the search ends as soon as the next
bound is below the k-th best score so far, with equal bounds still looked at, as ties go by id.

Rows are dealt to ranges and queries to chunks of fixed size; every (range, chunk) is a task of its
own with bounded memory, which returns k rows per query. A query's best k over all ranges come from a
grouped window that Spark limits to k rows per range before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize

BLOCK = 64
#: Vectors of a range and queries of a chunk.
RANGE = 16_384
CHUNK = 1_024


def whole_weights(vector: Column | str, scale: int = 64) -> Column:
    """floor(scale * x) of each component as double; null where any component is null or not finite."""
    numbers = F.transform(F.col(vector) if isinstance(vector, str) else vector, lambda x: x.cast("double"))
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(numbers, lambda x: F.floor(x * scale).cast("long")))


def _matrix(lists: pa.ChunkedArray) -> np.ndarray:
    flat = lists.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def best_of_range(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, row id, score) of the k best rows for each query, its own id aside."""
    order = np.lexsort((ids, np.abs(rows).argmax(axis=1)))  # rows with the same leading term share blocks
    rows, ids = rows[order], ids[order]
    starts = np.arange(0, len(ids), BLOCK)
    high, low = np.maximum.reduceat(rows, starts), np.minimum.reduceat(rows, starts)
    # Whole numbers below 2**53 are exact in doubles, so matrix products are.
    exact = np.abs(rows).max(initial=0).astype(float) * np.abs(queries).max(initial=0) * rows.shape[1] < 2**53
    kind = np.float64 if exact else object
    forward = [rows[s:s + BLOCK].astype(kind) for s in starts]
    q = queries.astype(kind)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    bounds = plus @ high.astype(kind).T + minus @ low.astype(kind).T
    out = []
    for i in range(len(queries)):
        scores, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = None
        for b in np.argsort(-bounds[i], kind="stable"):
            if least is not None and bounds[i, b] < least:
                break
            score = (forward[b] @ q[i]).astype(np.int64)
            here = ids[starts[b]:starts[b] + BLOCK]
            keep = here != own[i]
            if least is not None:
                keep &= score >= least
            if not keep.any():
                continue
            scores, found = np.concatenate([scores, score[keep]]), np.concatenate([found, here[keep]])
            if len(scores) > k:
                best = np.lexsort((found, -scores))[:k]
                scores, found = scores[best], found[best]
            if len(scores) == k:
                least = scores.min()
        out += [(i, int(r), int(s)) for r, s in zip(found, scores)]
    return out


def _search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        queries = left["id"].to_numpy()
        found = best_of_range(_matrix(left["v"]), queries, _matrix(right["v"]), right["id"].to_numpy(), k)
        at, ids, scores = zip(*found) if found else ((), (), ())
        return pa.table({
            "query_id": pa.array(queries[list(at)] if at else [], pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.int64())})

    return run


def exact_top_k(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64,
    block_range: int = RANGE, chunk: int = CHUNK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row where ``queries`` holds.

    Scores are inner products of ``whole_weights``; ties go to the smaller id. A row is no candidate
    for its own id. Rows with a null id or vector, or a component that is null or not finite,
    take no part; vectors of another length than the most common one are an error. Rows that repeat
    an id are candidates each, and queries once. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = materialize(
        vectors.select(F.col(id_col).cast("long").alias("id"), whole_weights(vector_col, scale).alias("v"), queries.alias("asked"))
        .filter("id is not null and v is not null and size(v) > 0"), "weights")
    n = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("asked").alias("queries"),
                 F.min(F.size("v")).alias("short"), F.max(F.size("v")).alias("long")).first()
    if not n["queries"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if n["short"] != n["long"]:
        raise ValueError(f"vectors of {n['short']} and {n['long']} components")
    ranges, chunks = -(-n["rows"] // block_range), -(-n["queries"] // chunk)

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    asked = rows.filter("asked").dropDuplicates(["id"]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))
    asked = asked.select("id", "v", "chunk", every(ranges).alias("range"))
    held = rows.withColumn("range", F.pmod(F.xxhash64("id", "v"), F.lit(ranges)).cast("int"))
    held = held.select("id", "v", every(chunks).alias("chunk"), "range")
    found = asked.groupBy("range", "chunk").cogroup(held.groupBy("range", "chunk")).applyInArrow(
        _search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
