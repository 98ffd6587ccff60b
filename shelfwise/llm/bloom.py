"""A Bloom filter of bounded size, built by Spark and sent to tasks to pass over rows early.

It only saves work: what passes by mistake is dropped by the join that follows. So its size may be
capped at any number of keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.words import mix

#: 8 MB at most, whatever the number of keys.
MOST_BITS = 1 << 26
_PROBES = 3


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    one = mix(keys)
    two = mix(one) | np.uint64(1)
    return np.concatenate([(one + np.uint64(i) * two) & np.uint64(bits - 1) for i in range(_PROBES)])


def build(keys: DataFrame, count: int) -> np.ndarray:
    """The filter, as 64-bit words, of a table with one column of 64-bit ``keys``."""
    bits = min(MOST_BITS, 1 << max(13, (16 * count).bit_length()))

    def words(batches):
        for batch in batches:
            filled = np.zeros(bits // 64, np.uint64)
            places = _places(batch.column(0).to_numpy().view(np.uint64), bits)
            np.bitwise_or.at(filled, (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63)))
            used = np.flatnonzero(filled)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(filled[used].view(np.int64))], ["word", "bits"])

    rows = keys.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def passes(filled: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter."""
    places = _places(keys, len(filled) * 64)
    hit = (filled[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1)
    return hit.reshape(_PROBES, len(keys)).all(axis=0)
